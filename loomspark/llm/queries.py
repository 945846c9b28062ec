"""Registered queries of the training-data operators. Problem N's queries are named pN_...."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomspark.llm import encoding, language, mojibake, nearcopies, neighbors, packing, scanned, subjects
from loomspark.operators.incremental import latest_per_key
from loomspark.session import table


def prose(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of chunks with prose."""
    return table(spark, sf_dir, "chunks").filter(~F.coalesce(F.col("chunk_type").isin("code", "table"), F.lit(False)) & (F.length("chunk_text") > 0))


def p1_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language, confidence and language segments of every chunk in its latest delivery; texts without prose have none."""
    return language.detect_segments(latest_per_key(table(spark, sf_dir, "chunks"), "chunk_id", "updated_at", "version", "chunk_index"))


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.wrong_labels(language.detect_segments(prose(spark, sf_dir)))


def _near(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Three-word sequences and a similarity of 0.6, texts of 25 words or more, as the problem states."""
    return nearcopies.near_copies(prose(spark, sf_dir), "chunk_id", "chunk_text", threshold=0.6, shingle=3, min_words=25)


def p2_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class, group and number of links of every chunk; code, tables and short texts stand alone."""
    groups = nearcopies.copy_groups(*_near(spark, sf_dir), "chunk_id")
    ids = table(spark, sf_dir, "chunks").select("chunk_id").filter("chunk_id is not null").distinct()
    alone = F.xxhash64("chunk_id")
    return ids.join(groups, "chunk_id", "left").select(
        "chunk_id", F.coalesce("class_id", alone).alias("class_id"), F.coalesce("group_id", alone).alias("group_id"), F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links")
    )


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearcopies.copy_pairs(*_near(spark, sf_dir), "chunk_id")


def _subjects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return subjects.chunk_subjects(prose(spark, sf_dir), table(spark, sf_dir, "area_labels"), table(spark, sf_dir, "subject_areas"))


def p3_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main subject and likeliest combination of areas of every chunk."""
    return _subjects(spark, sf_dir).dropDuplicates(["chunk_id"])


def p3_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The share of each area in the corpus."""
    return subjects.corpus_shares(_subjects(spark, sf_dir))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return subjects.file_subjects(_subjects(spark, sf_dir)).select("source_file", "area")


def p4_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readable paragraphs of every chunk from a scanned file."""
    return scanned.scanned_repair(prose(spark, sf_dir))[1]


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scanned.scanned_repair(prose(spark, sf_dir))[0]


def p5_neighbors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten most similar vectors of every usable vector, however similar they are."""
    return neighbors.nearest(table(spark, sf_dir, "chunk_vectors"), min_similarity=None)


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbors.similar_pairs(neighbors.nearest(table(spark, sf_dir, "chunk_vectors"), min_similarity=0.8))


def p6_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoding.encode_corpus(table(spark, sf_dir, "documents"))


def p7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), table(spark, sf_dir, "pack_targets"))


def p7_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fill and share error of each window when the handbook gets three tenths of the weight instead of its corpus share."""
    return packing.window_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "pack_targets"), {"ops-handbook": 0.3})


def p8_restored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Restored text and damaged spans of every affected document."""
    return mojibake.find_damage(table(spark, sf_dir, "documents"))


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mojibake.find_damage(table(spark, sf_dir, "documents")).select("doc_id")


QUERIES = {f.__name__: f for f in (p1_languages, p1_found, p2_groups, p2_found, p3_chunks, p3_shares, p3_found, p4_texts, p4_found, p5_neighbors, p5_found, p6_ids, p7_packing, p7_mixture, p8_restored, p8_found)}
ORACLES: dict[str, str] = {
    "p2_found": """
        with w as (select distinct chunk_id, regexp_extract_all(lower(chunk_text), '[\\p{L}\\p{N}]+') as w from chunks
                   where coalesce(chunk_type, '') not in ('code', 'table') and length(chunk_text) > 0),
        s as (select chunk_id, list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) as s from w where len(w) >= 25),
        t as (select chunk_id, len(s) as n, unnest(s) as x from s),
        p as (select a.chunk_id as a, b.chunk_id as b, count(*) as common, any_value(a.n) + any_value(b.n) as total from t a join t b on a.x = b.x and a.chunk_id < b.chunk_id group by 1, 2)
        select a as chunk_id_a, b as chunk_id_b from p where common / (total - common) >= 0.6 - 1e-12
    """,
}
