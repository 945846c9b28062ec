"""Binary formats (office, PDF) through pluggable extractors that run inside Spark tasks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomspark.sources.files import list_files, read_files


def read_binary(spark: SparkSession, folder: str, extractors: dict[str, Callable[[bytes], str]], max_depth: int = 5) -> DataFrame:
    """``(source_file, source_format, content, error)`` of the files below ``folder`` whose extension has an extractor.

    A failing extractor or an empty result gives a row with ``error`` and a null content; it doesn't stop the run.
    """
    files = list_files(spark, folder, max_depth).filter(F.col("ext").isin(list(extractors)))
    rows = read_files(files, lambda ext, data: extractors[ext](data))
    empty = F.col("error").isNull() & (F.coalesce("content", F.lit("")) == "")
    return rows.select("source_file", F.col("ext").alias("source_format"), F.when(~empty, F.col("content")).alias("content"), F.when(empty, "empty result").otherwise(F.col("error")).alias("error"))
