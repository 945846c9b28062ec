"""One table of all readable documents of a folder: text, web and structured formats, and binary ones with extractors."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomspark.operators import reflow
from loomspark.session import materialize
from loomspark.sources import html, structured
from loomspark.sources.binary import read_binary
from loomspark.sources.files import TEXT_FORMATS, read_documents

HTML = ("html", "htm")


def read_everything(spark: SparkSession, folder: str, extractors: dict[str, Callable[[bytes], str]] | None = None, max_depth: int = 5) -> DataFrame:
    """``(source_file, source_format, content, error)`` of all files below ``folder`` in a known format, the content as Markdown.

    Text formats stay as they are; HTML, CSV, JSON, XML, notebooks and source code are converted; formats of
    ``extractors`` go through them, and lines of PDF pages are put together into paragraphs. A source format is the
    extension but for text formats. What fails has a null content and the reason in ``error``.
    """
    names = ["source_file", "source_format", "content", "error"]
    kinds = {e: e for e in (*HTML, *structured.CONVERTERS)}
    rows = read_documents(spark, folder, TEXT_FORMATS | kinds, max_depth).select(names)
    is_page = F.col("source_format").isin(*HTML)
    pages = rows.filter(is_page).withColumn("content", html.to_markdown(F.col("content")))
    found = structured.to_markdown(rows.filter(~is_page)).select(names).unionByName(pages)
    if not extractors:
        return found
    binary = materialize(read_binary(spark, folder, extractors, max_depth), "binary")
    pdf = reflow.reflow(binary.filter("source_format = 'pdf'").select("source_file", "source_format", "content", "error"), "source_file", "content")
    pdf = pdf.join(binary.filter("source_format = 'pdf'").drop("content"), "source_file")
    return found.unionByName(binary.filter("source_format <> 'pdf'").select(names)).unionByName(pdf.select(names))
