"""Hash-keyed incremental merge of chunk tables and file manifests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def merge(new: DataFrame, old: DataFrame, now: Column, within: str | None = None) -> DataFrame:
    """``new`` with ``status, version, created_at, updated_at``.

    A content hash that ``old`` has keeps version and creation time of its first row (by chunk_index, then chunk_id):
    'unchanged'. A chunk_id that ``old`` has counts one version up: 'updated'. Other rows are 'added' at version 1.
    With ``within`` (a column of both, as source_file) only rows of the same value are compared.
    """
    key = [within] if within else []
    first = Window.partitionBy(*key, "content_hash").orderBy("chunk_index", "chunk_id")
    by_hash = old.withColumn("rn", F.row_number().over(first)).filter("rn = 1").select(*key, "content_hash", F.col("version").alias("hv"), F.col("created_at").alias("hc"))
    same_id = Window.partitionBy(*key, "chunk_id").orderBy("chunk_index", "content_hash")
    by_id = old.withColumn("rn", F.row_number().over(same_id)).filter("rn = 1").select(*key, "chunk_id", F.col("version").alias("iv"), F.col("created_at").alias("ic"))
    both = new.join(by_hash, [*key, "content_hash"], "left").join(by_id, [*key, "chunk_id"], "left")
    return both.select(
        *new.columns,
        F.when(F.col("hv").isNotNull(), "unchanged").when(F.col("iv").isNotNull(), "updated").otherwise("added").alias("status"),
        F.coalesce("hv", F.col("iv") + 1, F.lit(1)).cast("int").alias("version"),
        F.coalesce("hc", "ic", now).alias("created_at"),
        now.alias("updated_at"),
    )


def merge_stats(merged: DataFrame, old: DataFrame) -> DataFrame:
    """One row ``(added, updated, unchanged, deleted)``; deleted are ids of ``old`` that ``merged`` lacks."""
    n = lambda s: F.coalesce(F.sum((F.col("status") == s).cast("bigint")), F.lit(0)).alias(s)
    gone = old.select("chunk_id").distinct().join(merged.select("chunk_id"), "chunk_id", "left_anti").agg(F.count("*").alias("deleted"))
    return merged.agg(n("added"), n("updated"), n("unchanged")).crossJoin(gone)  # one row each


def files_to_update(files: DataFrame, manifest: DataFrame) -> DataFrame:
    """``files`` with ``changed``: no manifest row, or another hash in its latest version."""
    latest = manifest.groupBy("source_file").agg(F.max_by("source_hash", F.struct("version", "updated_at", "source_hash")).alias("old_hash"))
    return files.join(latest, "source_file", "left").withColumn("changed", ~F.col("source_hash").eqNullSafe(F.col("old_hash")) | F.col("old_hash").isNull())


def next_manifest(files: DataFrame, manifest: DataFrame, now: Column) -> DataFrame:
    """The manifest row each file gets: the version after its latest one, its first creation time, the new hash."""
    latest = manifest.groupBy("source_file").agg(F.max("version").alias("v"), F.min("created_at").alias("c"))
    return files.join(latest, "source_file", "left").select(
        "source_file", (F.coalesce("v", F.lit(0)) + 1).cast("int").alias("version"), "source_hash", F.coalesce("c", now).alias("created_at"), now.alias("updated_at"),
        F.lit("2.0").alias("schema_version"), F.lit("structure_based").alias("chunking_method"),
    )


def upsert(base: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """``changes`` instead of the rows of ``base`` with the same key."""
    return base.join(changes.select(key).distinct(), key, "left_anti").unionByName(changes.select(*base.columns))


def latest_per_key(df: DataFrame, key: str, *order: str) -> DataFrame:
    """One row per key, the last by ``order``."""
    w = Window.partitionBy(key).orderBy(*(F.desc_nulls_last(o) for o in order))
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")
