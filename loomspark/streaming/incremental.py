"""Continuous processing: files that arrive in a folder flow through preparation and chunking into a versioned chunk table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from loomspark.operators import store
from loomspark.sources.files import TEXT_FORMATS, read_documents


def merge_batch(table: str, batch: DataFrame, now: str, max_size: int = 2000, buckets: int = store.BUCKETS) -> DataFrame:
    """Merge the files of a batch ``(source_file, source_format, modified, content)`` into the table; of a file that came twice the latest counts."""
    latest = F.max_by(F.struct("source_format", "content"), F.struct(F.col("modified"), F.coalesce("content", F.lit(""))))
    return store.run(batch.groupBy("source_file").agg(latest.alias("d")).select("source_file", "d.*"), table, now, max_size, buckets=buckets)


def watch_folder(spark: SparkSession, folder: str, table: str, checkpoint: str, clock: Callable[[], str], max_size: int = 2000, buckets: int = store.BUCKETS) -> StreamingQuery:
    """Process the files that are new in ``folder`` and stop; called again it goes on where it stopped.

    The stream remembers paths: a file that is changed in place, or is empty, is not seen again. ``sync_folder`` compares
    all files with the manifest instead.
    """
    root = folder.rstrip("/").removeprefix("file:").lstrip("/")
    known = F.create_map(*(x for k, v in TEXT_FORMATS.items() for x in (F.lit(k), F.lit(v))))
    path = F.url_decode(F.regexp_replace("_metadata.file_path", r"\+", "%2B"))
    rows = spark.readStream.text(folder, wholetext=True, recursiveFileLookup=True).select(
        F.regexp_replace(path, f"^(file:)?/*{root}/", "").alias("source_file"), F.col("_metadata.file_modification_time").alias("modified"), F.regexp_replace("value", "\r\n?", "\n").alias("content")
    )
    rows = rows.withColumn("source_format", F.element_at(known, F.lower(F.regexp_extract("source_file", r"\.([^./]+)$", 1)))).filter("source_format is not null")

    def each(batch: DataFrame, _: int) -> None:
        merge_batch(table, batch, clock(), max_size, buckets)

    return rows.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def sync_folder(spark: SparkSession, folder: str, table: str, now: str, max_size: int = 2000, buckets: int = store.BUCKETS) -> DataFrame:
    """Bring the table up to date with all text files of ``folder``, new, changed in place or emptied; counts as ``store.run``."""
    return store.run(read_documents(spark, folder), table, now, max_size, buckets=buckets)


def windowed_counts(events: DataFrame, watermark: str = "10 minutes", window: str = "5 minutes") -> DataFrame:
    """Counts and sums by event type over tumbling windows; the same function runs on streams and tables."""
    return (
        events.withWatermark("ts", watermark)
        .groupBy(F.window("ts", window), "event_type")
        .agg(F.count("*").alias("n"), F.sum("value").alias("total"))
        .select(F.col("window.start").alias("window_start"), "event_type", "n", F.round("total", 4).alias("total"))
    )
