"""Command line: prepare, chunk and index a folder, search it, and show what a table holds."""

from __future__ import annotations

import argparse
from datetime import datetime, timezone

from pyspark.sql import functions as F

from loomspark.operators import chunking, enrich, metadata, store, vector
from loomspark.session import build_session, clean_up, exists
from loomspark.sources import files
from loomspark.sources.everything import read_everything

DIM = 256  # of the hashed embedding, the offline default


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="loomspark", description=__doc__)
    p.add_argument("--master", default="local[*]")
    p.add_argument("--now", default=None, help="the time to note, by default the clock's")
    sub = p.add_subparsers(dest="command", required=True)
    prepare = sub.add_parser("prepare", help="write each readable document as Markdown with front matter")
    prepare.add_argument("input")
    prepare.add_argument("output")
    prepare.add_argument("--max-depth", type=int, default=5)
    run = sub.add_parser("run", help="prepare and chunk what is new or changed, into a versioned chunk table")
    run.add_argument("input")
    run.add_argument("output")
    run.add_argument("--max-depth", type=int, default=5)
    run.add_argument("--max-chunk-size", type=int, default=chunking.MAX_SIZE)
    run.add_argument("--overlap", type=int, default=chunking.OVERLAP)
    run.add_argument("--buckets", type=int, default=store.BUCKETS, help="parts of the table; one number for its whole life")
    build = sub.add_parser("build", help="encode the chunks that a vector store lacks")
    build.add_argument("table")
    build.add_argument("store")
    build.add_argument("--model", default="hashed-words-256")
    build.add_argument("--force", action="store_true", help="build anew where the store is of another model")
    search = sub.add_parser("search", help="the nearest chunks of a text")
    search.add_argument("store")
    search.add_argument("query")
    search.add_argument("--top-k", type=int, default=5)
    search.add_argument("--domain")
    for name, text in (("stats", "numbers of chunks by domain and type"), ("list", "the documents of a table"), ("errors", "documents that failed")):
        sub.add_parser(name, help=text).add_argument("table")
    get = sub.add_parser("get", help="one chunk by its id")
    get.add_argument("table")
    get.add_argument("chunk_id")
    return p


def search_text(spark, path: str, query: str, top_k: int, domain: str | None) -> list[str]:
    """The rendered hits of a text in a vector store."""
    vectors, chunks = spark.read.parquet(f"{path}/chunk_vectors"), spark.read.parquet(f"{path}/chunks")
    model = spark.read.parquet(f"{path}/model_info").first().model_name
    asked = spark.createDataFrame([("query", query)], "chunk_id string, t string")
    asked = asked.select("chunk_id", vector.hashed_embedding(vector.embed_input(F.lit(model), F.col("t"), True), DIM).alias("embedding"))
    if domain:
        hits = vector.search_filtered(vectors, asked, "chunk_id", "embedding", chunks, F.col("domain") == domain, top_k)
    else:
        hits = vector.search(vectors, asked, "chunk_id", "embedding", top_k).withColumn("place", F.col("rank")).join(chunks.withColumnRenamed("chunk_id", "id"), "id")
    text = vector.render_hit(F.col("place"), F.col("similarity"), F.col("source_file"), F.col("section_path"), F.col("chunk_type"), F.col("id"), F.col("chunk_text"))
    return [r.t for r in hits.orderBy("place").select(text.alias("t")).collect()]  # top_k rows


def main(argv: list[str] | None = None) -> int:
    a = _parser().parse_args(argv)
    spark = build_session(a.master)
    now = a.now or datetime.now(timezone.utc).replace(tzinfo=None).isoformat()
    try:
        if a.command == "prepare":
            docs = read_everything(spark, a.input, max_depth=a.max_depth)
            good = docs.filter("error is null").withColumn("content", F.coalesce("content", F.lit("")))
            meta = metadata.front_matter(good, "content", now=F.lit(now))
            text = F.concat(files.render_front_matter(("keywords",), **{k: F.col(k) for k in metadata.FIELDS}), F.col("body"))
            written = files.write_prepared(meta.select(files.output_path(F.col("source_file")).alias("path"), text.alias("text")), a.output)
            counts = written.agg(F.count("*").alias("n"), F.count("error").alias("failed")).first()
            failed = counts.failed + docs.filter("error is not null").count()
            print(f"prepared {counts.n - counts.failed}, failed {failed}")
            return 0 if counts.n > counts.failed else 1
        if a.command == "run":
            docs = enrich.enrich(read_everything(spark, a.input, max_depth=a.max_depth), "content", "source_format").drop("content", "strategy", "changed").withColumnRenamed("enriched_text", "content")
            print(store.run(docs, a.output, now, a.max_chunk_size, a.overlap, buckets=a.buckets).first().asDict())
        elif a.command == "build":
            stats = vector.build(store.read_chunks(spark, a.table), a.store, a.model, lambda t: vector.hashed_embedding(t, DIM), DIM, now, a.force)
            print(stats.first().asDict())
        elif a.command == "search":
            print("\n".join(search_text(spark, a.store, a.query, a.top_k, a.domain)) or "No results found.")
        elif a.command == "stats":
            print(vector.render_statistics(vector.statistics(store.read_chunks(spark, a.table)), "none", 0).first().text)
        elif a.command == "list":
            vector.list_documents(store.read_chunks(spark, a.table)).orderBy("source_file").show(1000, truncate=False)
        elif a.command == "errors":
            if exists(spark, f"{a.table}/errors"):
                spark.read.schema(store.ERROR_SCHEMA).parquet(f"{a.table}/errors").orderBy("at", "source_file").show(1000, truncate=False)
        elif a.command == "get":
            row = vector.get_chunk(store.read_chunks(spark, a.table), a.chunk_id).first()
            print(row.asDict() if row else f"Chunk not found: {a.chunk_id}")
        return 0
    finally:
        clean_up(spark)


if __name__ == "__main__":
    raise SystemExit(main())
