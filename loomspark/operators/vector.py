"""Vector store operators: building, export, exact nearest-neighbour search, look-ups and statistics."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loomspark.functions.lexicon import DEFAULT_DIMENSION, MODEL_DIMENSIONS
from loomspark.operators.incremental import latest_per_key
from loomspark.session import exists, materialize

QUERY_BLOCK = 16_384  # queries compared in one pass over the vectors; they are broadcast, so a block is of bounded size


def model_dimension(model: Column) -> Column:
    known = F.create_map(*(x for k, v in MODEL_DIMENSIONS.items() for x in (F.lit(k), F.lit(v))))
    return F.coalesce(F.element_at(known, model), F.lit(DEFAULT_DIMENSION))


def embed_input(model: Column, text: Column, query: bool = False) -> Column:
    """Text as a model wants it: models of the e5 family get a prefix."""
    return F.when(F.contains(F.lower(model), F.lit("e5")), F.concat(F.lit("query: " if query else "passage: "), text)).otherwise(text)


def hashed_embedding(text: Column, dim: int = 256) -> Column:
    """The offline default: hashed word counts of length one (zeros for texts without words, null texts too).

    The first 8 hexadecimal digits of a word's MD5 choose its place, the next one its sign (below 8 is negative).
    """

    @F.pandas_udf("array<float>")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        memo: dict[str, tuple[int, float]] = {}

        def place(w: str) -> tuple[int, float]:
            if w not in memo:
                if len(memo) >= 500_000:
                    memo.clear()
                h = hashlib.md5(w.encode()).hexdigest()
                memo[w] = int(h[:8], 16) % dim, 1.0 if h[8] >= "8" else -1.0
            return memo[w]

        for texts in batches:
            rows = np.zeros((len(texts), dim))
            for i, t in enumerate(texts):
                for w in re.findall(r"\w+", (t or "").lower()):
                    at, sign = place(w)
                    rows[i, at] += sign
            rows /= np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)
            yield pd.Series(list(rows.astype(np.float32)))

    return encode(text)


def stored_dimensions(vectors: DataFrame, *by: str) -> DataFrame:
    """``(by..., dim, n)``: how many vectors have which length; null vectors don't count."""
    return vectors.filter("embedding is not null").groupBy(*by, F.size("embedding").alias("dim")).agg(F.count("*").alias("n"))


def compatibility(stored: DataFrame, dimensions: DataFrame, model: str, expected: int | None = None) -> DataFrame:
    """One row ``(compatible, model_name, embedding_dim)``: whether a store fits ``model``.

    ``stored`` is the store's model_info (id 1 counts), ``dimensions`` the lengths of its vectors. A store without a row
    fits. Else a vector of another length than expected makes it unfit, which is then the dimension shown; without one
    both the model and its dimension must be the same. ``expected`` defaults to the dimension of the known model.
    """
    want = F.lit(expected) if expected is not None else model_dimension(F.lit(model))
    row = stored.filter("id = 1").agg(F.count("*").alias("rows"), F.first("model_name").alias("model_name"), F.first("embedding_dim").alias("embedding_dim"))
    other = dimensions.filter(F.col("dim") != want).agg(F.max_by("dim", F.struct("n", "dim")).alias("other"))
    return row.crossJoin(other).select(  # one row each
        ((F.col("rows") == 0) | (F.col("other").isNull() & F.coalesce((F.col("model_name") == model) & (F.col("embedding_dim") == want), F.lit(False)))).alias("compatible"),
        "model_name",
        F.when(F.col("rows") > 0, F.coalesce("other", "embedding_dim")).alias("embedding_dim"),
    )


def missing_vectors(chunks: DataFrame, vectors: DataFrame, key: str = "chunk_id") -> DataFrame:
    """Chunks that have no vector yet."""
    return chunks.join(vectors.select(key), key, "left_anti")


def build_stats(chunks: DataFrame, vectors: DataFrame, key: str = "chunk_id") -> DataFrame:
    """``(total_chunks, new_chunks, skipped_chunks)``."""
    have = vectors.select(key).distinct().withColumn("have", F.lit(1))
    return chunks.join(have, key, "left").agg(
        F.count("*").alias("total_chunks"), F.sum(F.col("have").isNull().cast("bigint")).alias("new_chunks"), F.sum(F.coalesce("have", F.lit(0)).cast("bigint")).alias("skipped_chunks")
    )


def export(chunks: DataFrame, vectors: DataFrame, dim: int, key: str = "chunk_id") -> DataFrame:
    """All chunks with their vector, zeros of length ``dim`` where there is none; a sink sorts by the key if it wants an order."""
    v = vectors.select(key, "embedding")
    return chunks.join(v, key, "left").withColumn("embedding", F.coalesce("embedding", F.array_repeat(F.lit(0.0).cast("float"), dim)))


def _block_search(queries, k: int, id_type: pa.DataType, metric: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q_ids = [q for q, _ in queries.value]
        q = np.array([v for _, v in queries.value], np.float64)
        for whole in batches:
            for at in range(0, whole.num_rows, 4096):  # bounds the distances held at once
                b = whole.slice(at, 4096)
                vec = b.column("v").flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(b.num_rows, -1)
                for lo in range(0, len(q), 1024):
                    part = q[lo : lo + 1024]
                    if metric == "l2":
                        dist = np.sqrt(np.maximum((vec * vec).sum(1) + (part * part).sum(1)[:, None] - 2 * part @ vec.T, 0))
                    else:
                        dist = 1 - (part @ vec.T) / np.maximum(np.linalg.norm(part, axis=1)[:, None] * np.linalg.norm(vec, axis=1), 1e-30)
                    dist = np.round(dist, 6)
                    keep = min(k, dist.shape[1])
                    edge = np.partition(dist, keep - 1, axis=1)[:, keep - 1 : keep]
                    i, j = np.nonzero(dist <= edge)  # ties at the edge stay in
                    yield pa.RecordBatch.from_arrays([pa.array([q_ids[lo + x] for x in i], id_type), b.column("id").take(pa.array(j)), pa.array(dist[i, j])], ["query_id", "id", "distance"])

    return run


def search(vectors: DataFrame, queries: DataFrame, id_col: str, vec_col: str, k: int = 5, metric: str = "l2") -> DataFrame:
    """``(query_id, rank, id, distance, similarity)``: the k nearest vectors of every query, exact.

    Distances are rounded to 6 decimals, ties go to the smaller id, similarity is 1 - distance. Vectors are read once for
    each ``QUERY_BLOCK`` queries and keep k candidates a query in each batch. Null vectors and those of another length than
    most queries have drop out, of queries and vectors; a query may find itself.
    """
    spark = vectors.sparkSession
    id_kind = vectors.schema[id_col].dataType.simpleString()
    base = vectors.select(F.col(id_col).alias("id"), F.col(vec_col).alias("v")).filter(F.col("v").isNotNull())
    q = queries.select(F.col(id_col).alias("id"), F.col(vec_col).alias("v")).filter(F.col("v").isNotNull())
    sizes = q.groupBy(F.size("v").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
    none = spark.createDataFrame([], f"query_id {id_kind}, rank int, id {id_kind}, distance double, similarity double")
    if sizes is None or not sizes["dim"]:
        return none
    right = (F.size("v") == sizes["dim"]) & F.forall("v", lambda x: x.isNotNull())
    base, q = base.filter(right), q.filter(right)
    n_blocks = max(1, -(-sizes["count"] // QUERY_BLOCK))
    arrow_type = pa.int64() if id_kind == "bigint" else pa.int32() if id_kind == "int" else pa.string()
    found = None
    for b in range(n_blocks):
        rows = [(r.id, r.v) for r in (q.filter(F.pmod(F.xxhash64("id"), F.lit(n_blocks)) == b) if n_blocks > 1 else q).collect()]
        if not rows:
            continue
        part = base.mapInArrow(_block_search(spark.sparkContext.broadcast(rows), k, arrow_type, metric), f"query_id {id_kind}, id {id_kind}, distance double")
        found = part if found is None else found.unionByName(part)
    if found is None:
        return none
    w = Window.partitionBy("query_id").orderBy("distance", "id")
    return found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k).select("query_id", "rank", "id", "distance", F.round(1 - F.col("distance"), 6).alias("similarity"))


def search_filtered(vectors: DataFrame, queries: DataFrame, id_col: str, vec_col: str, attributes: DataFrame, wanted: Column, k: int = 5, oversample: int = 2) -> DataFrame:
    """Search with a filter applied after it: ``oversample`` times k are fetched, so fewer than k may remain."""
    hits = search(vectors, queries, id_col, vec_col, k * oversample)
    kept = hits.join(attributes.withColumnRenamed(id_col, "id"), "id").filter(wanted)
    w = Window.partitionBy("query_id").orderBy("rank")
    return kept.withColumn("place", F.row_number().over(w)).filter(F.col("place") <= k)


#: The fields a look-up of a chunk shows.
CHUNK_FIELDS = (
    "chunk_id", "content_hash", "source_file", "chunk_index", "chunk_text", "chunk_type", "heading_level", "heading_text", "parent_heading", "section_path", "table_headers", "table_row_count",
    "domain", "sub_domain", "keywords", "language", "content_type",
)


def get_chunk(chunks: DataFrame, chunk_id: str) -> DataFrame:
    """The fields of a chunk by its id, no row where there is none, by parameterised SQL over the given rows."""
    return chunks.sparkSession.sql(f"select {', '.join(CHUNK_FIELDS)} from {{chunks}} where chunk_id = :id", args={"id": chunk_id}, chunks=chunks)


def build(chunks: DataFrame, path: str, model: str, encode: Callable[[Column], Column], dim: int, now: str, overwrite: bool = False) -> DataFrame:
    """Encode the chunks that a vector store lacks and add them to it; one row ``(total_chunks, new_chunks, skipped_chunks)``.

    The store has the tables ``model_info``, ``chunks`` (the latest row of every id, with ``embedded_at``) and
    ``chunk_vectors``. A store of another model or dimension raises an error, or is built anew with ``overwrite``. Of a chunk
    given twice the latest row counts; chunks without a text get the vector of an empty one.
    """
    spark = chunks.sparkSession
    read = lambda name, schema: spark.read.schema(schema).parquet(f"{path}/{name}") if exists(spark, f"{path}/{name}") else spark.createDataFrame([], schema)
    info_schema, vector_schema = "id int, model_name string, embedding_dim int, created_at string", "chunk_id string, embedding array<float>"
    vectors = read("chunk_vectors", vector_schema)
    fits = compatibility(read("model_info", info_schema), stored_dimensions(vectors), model, dim).first()
    mode = "append"
    if not fits.compatible:
        if not overwrite:
            raise ValueError(f"the store was built with {fits.model_name} of {fits.embedding_dim} dimensions, not {model} of {dim}")
        vectors, mode = spark.createDataFrame([], vector_schema), "overwrite"
    rows = latest_per_key(chunks, "chunk_id", "updated_at", "version", "chunk_index")
    stats = materialize(build_stats(rows, vectors), "build-stats")
    fresh = materialize(missing_vectors(rows, vectors).withColumn("embedded_at", F.lit(now)), "chunks-to-embed")
    encoded = fresh.select("chunk_id", encode(embed_input(F.lit(model), F.coalesce("chunk_text", F.lit("")))).alias("embedding"))
    fresh.write.mode(mode).option("compression", "zstd").parquet(f"{path}/chunks")
    encoded.write.mode(mode).option("compression", "zstd").parquet(f"{path}/chunk_vectors")  # after the chunks, so that a broken run is done again
    spark.createDataFrame([(1, model, dim, now)], info_schema).coalesce(1).write.mode("overwrite").parquet(f"{path}/model_info")
    return stats


def list_documents(chunks: DataFrame) -> DataFrame:
    """One row a file: its number of chunks, and domain and language of its first chunk."""
    first = F.struct("chunk_index", "chunk_id")
    return chunks.groupBy("source_file").agg(
        F.count("*").alias("chunk_count"), F.min_by(F.coalesce("domain", F.lit("")), first).alias("domain"), F.min_by(F.coalesce("language", F.lit("")), first).alias("language")
    )


def statistics(chunks: DataFrame) -> DataFrame:
    """One row: chunks, files, and the numbers of chunks by domain and by type as arrays of (name, n), largest first."""
    def histogram(col: str) -> DataFrame:
        per = chunks.groupBy(F.coalesce(F.col(col), F.lit("")).alias("name")).agg(F.count("*").alias("n"))
        return per.agg(F.transform(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("m"), "name"))), lambda r: F.concat(r["name"], F.lit("="), (-r["m"]).cast("string"))).alias(col + "s"))

    total = chunks.agg(F.count("*").alias("total_chunks"), F.count_distinct("source_file").alias("total_documents"))
    return total.crossJoin(histogram("domain")).crossJoin(histogram("chunk_type"))  # one row each


def preview(text: Column, length: int = 500) -> Column:
    return F.when(F.length(text) > length, F.concat(F.substring(text, 1, length), F.lit("..."))).otherwise(text)


def _path_text(section_path: Column) -> Column:
    return F.when(F.size(section_path) > 0, F.array_join(section_path, " > ")).otherwise("N/A")


def render_hit(place: Column, similarity: Column, source_file: Column, section_path: Column, chunk_type: Column, chunk_id: Column, text: Column) -> Column:
    """A search hit as Markdown, with the first 500 characters of its text."""
    return F.format_string(
        "## [%d] Similarity: %s\n- **File**: %s\n- **Section**: %s\n- **Type**: %s\n- **ID**: %s\n\n```\n%s\n```\n",
        place, F.format_string("%.4f", similarity), source_file, _path_text(section_path), chunk_type, chunk_id, preview(text),
    )


def render_chunk(chunk_id: Column, source_file: Column, section_path: Column, chunk_type: Column, domain: Column, language: Column, text: Column) -> Column:
    return F.format_string(
        "# Chunk: %s\n\n- **File**: %s\n- **Section**: %s\n- **Type**: %s\n- **Domain**: %s\n- **Language**: %s\n\n## Content\n\n```\n%s\n```",
        chunk_id, source_file, _path_text(section_path), chunk_type, domain, language, text,
    )


def render_document(source_file: Column, n_chunks: Column, domain: Column, language: Column) -> Column:
    """A row of the document list."""
    return F.format_string("| %s | %d | %s | %s |", source_file, n_chunks, domain, language)


def render_statistics(stats: DataFrame, model: str, dim: int) -> DataFrame:
    """``(text)``: the row of ``statistics`` as Markdown."""
    lines = lambda c: F.array_join(F.transform(c, lambda x: F.concat(F.lit("  - "), F.regexp_replace(x, "=([0-9]+)$", ": $1"))), "\n")
    return stats.select(
        F.format_string(
            "# Vector DB Statistics\n\n- **Total Chunks**: %d\n- **Total Documents**: %d\n- **Embedding Model**: %s\n- **Embedding Dimension**: %d\n\n## Distribution by Domain\n%s\n\n## Distribution by Chunk Type\n%s",
            "total_chunks", "total_documents", F.lit(model), F.lit(dim), lines("domains"), lines("chunk_types"),
        ).alias("text")
    )
