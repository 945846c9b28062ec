"""A versioned chunk table with its manifest: incremental runs over documents, by hash buckets of the files.

Layout below the table's folder: ``chunks`` and ``manifest`` (Parquet, zstd, partitioned by ``bucket``) and ``errors``.
A run reads and rewrites only the buckets of changed files, so that neither folders nor files grow with the documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomspark.operators import chunking, incremental, markdown, metadata
from loomspark.session import exists, materialize

BUCKETS = 64  # the same for the life of a table; some 4,000 for tens of terabytes, so that a bucket stays within a task
MANIFEST_SCHEMA = "source_file string, version int, source_hash string, created_at string, updated_at string, schema_version string, chunking_method string"
ERROR_SCHEMA = "source_file string, error string, at string"


def read_table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A bucketed table, or an empty one where nothing was written yet."""
    if not exists(spark, path):
        return spark.createDataFrame([], f"{schema}, bucket int")
    return spark.read.schema(f"{schema}, bucket int").parquet(path)


def read_chunks(spark: SparkSession, table: str) -> DataFrame:
    return read_table(spark, f"{table}/chunks", chunking.CHUNK_SCHEMA).drop("bucket")


def read_manifest(spark: SparkSession, table: str) -> DataFrame:
    return read_table(spark, f"{table}/manifest", MANIFEST_SCHEMA).drop("bucket")


def bucket_of(file: Column, buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(file), F.lit(buckets)).cast("int")


def replace_files(rows: DataFrame, files: DataFrame, path: str, schema: str, buckets: int = BUCKETS) -> None:
    """Put ``rows`` in the place of all rows of ``files`` (source_file) in the table; other files stay as they are.

    Only the buckets of these files are read and rewritten, one Parquet file each.
    """
    spark = rows.sparkSession
    files = files.select("source_file").distinct().withColumn("bucket", bucket_of(F.col("source_file"), buckets))
    touched = [r.bucket for r in files.select("bucket").distinct().collect()]  # at most ``buckets`` numbers
    if not touched:
        return
    kept = read_table(spark, path, schema).filter(F.col("bucket").isin(touched)).join(files, ["bucket", "source_file"], "left_anti")
    names = [*kept.columns]
    after = materialize(kept.unionByName(rows.withColumn("bucket", bucket_of(F.col("source_file"), buckets)).select(names)), "bucketed")
    # a bucket that holds nothing any more keeps an empty file, since dynamic overwriting touches only partitions with rows
    gone = [b for b in touched if b not in {r.bucket for r in after.select("bucket").distinct().collect()}]
    options = {"partitionOverwriteMode": "dynamic", "compression": "zstd", "parquet.compression.codec.zstd.level": "3"}
    after.repartition(len(touched), "bucket").sortWithinPartitions("bucket", "source_file").write.mode("overwrite").options(**options).partitionBy("bucket").parquet(path)
    for b in gone:
        spark.createDataFrame([], schema).coalesce(1).write.mode("overwrite").options(**options).parquet(f"{path}/bucket={b}")


def chunk_records(prepared: DataFrame, now: Column, max_size: int = chunking.MAX_SIZE, overlap: int = chunking.OVERLAP) -> DataFrame:
    """Full chunk records of prepared documents (``front_matter``), one row per ``source_file``."""
    packed = chunking.pack(markdown.sections(prepared, "source_file", "body"), "source_file", max_size)
    named = prepared.select(F.col("source_file").alias("_id"), "source_file", "body")
    rows = chunking.chunks(named, packed.withColumnRenamed("source_file", "_id"), "_id", "body", "source_file", max_size, overlap)
    return chunking.records(rows, prepared.withColumn("_id", F.col("source_file")), "_id", now)


def run(
    docs: DataFrame, table: str, now: str, max_size: int = chunking.MAX_SIZE, overlap: int = chunking.OVERLAP, extra: dict[str, Column] | None = None, buckets: int = BUCKETS
) -> DataFrame:
    """Bring the table up to date with ``docs`` ``(source_file, source_format, content, error)``; one row of counts.

    Files whose hash of body and metadata is the one of the manifest are passed over. Chunks of the others are merged with
    those the table has of the same file: equal texts keep version and creation time, changed ones count up. A document
    with an ``error`` changes nothing and is noted in ``errors``. Files that ``docs`` doesn't have stay. Of a file given
    twice the smaller content counts.

    Counts: files, changed, failed, added, updated, unchanged, deleted.
    """
    spark = docs.sparkSession
    base = docs if "error" in docs.columns else docs.withColumn("error", F.lit(None).cast("string"))
    failed = base.filter("error is not null").select("source_file", "error").distinct()
    good = base.filter("error is null").groupBy("source_file").agg(F.min_by(F.struct("source_format", "content"), F.coalesce("content", F.lit(""))).alias("d")).select("source_file", "d.*")
    meta = metadata.front_matter(good.withColumn("content", F.coalesce("content", F.lit(""))), "content", extra=extra)
    hashed = [F.col(c) if c != "keywords" else F.array_join("keywords", "\x02") for c in ("title", "domain", "sub_domain", "keywords", "summary", "language", "content_type", "source_file", "source_format")]
    prepared = materialize(meta.withColumn("source_hash", chunking.source_hash(F.col("body"), *hashed)), "prepared")
    manifest = read_manifest(spark, table)
    changed = materialize(incremental.files_to_update(prepared.select("source_file", "source_hash"), manifest).filter("changed").select("source_file", "source_hash"), "changed-files")

    new = chunk_records(prepared.join(changed.select("source_file"), "source_file", "left_semi"), F.lit(now), max_size, overlap).drop("version", "created_at", "updated_at")
    keys = changed.select("source_file", bucket_of(F.col("source_file"), buckets).alias("bucket"))
    old = read_table(spark, f"{table}/chunks", chunking.CHUNK_SCHEMA).join(keys, ["bucket", "source_file"], "left_semi").drop("bucket")
    old = materialize(old, "old-chunks")
    merged = materialize(incremental.merge(new, old, F.lit(now), "source_file"), "merged-chunks")
    counts = incremental.merge_stats(merged, old).withColumns({"files": F.lit(prepared.count()), "changed": F.lit(changed.count()), "failed": F.lit(failed.count())})
    counts = materialize(counts.select("files", "changed", "failed", "added", "updated", "unchanged", "deleted"), "run-counts")

    rows = materialize(incremental.next_manifest(changed, manifest.join(changed.select("source_file"), "source_file", "left_semi"), F.lit(now)), "manifest-rows")
    replace_files(merged, changed, f"{table}/chunks", chunking.CHUNK_SCHEMA, buckets)
    replace_files(rows, changed, f"{table}/manifest", MANIFEST_SCHEMA, buckets)  # last, so that a broken run is done again
    if not failed.isEmpty():
        failed.withColumn("at", F.lit(now)).write.mode("append").option("compression", "zstd").parquet(f"{table}/errors")
    return counts
