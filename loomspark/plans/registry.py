"""Queries of the reference's operators over the given tables; their SQL is in ``oracle``.

Keys begin with the group of the operator (meta, reflow, md, c, i, v, a, k, s, t, x) so that they don't clash with the
numbered problems. Every query runs over its whole tables.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomspark.functions.lexicon import MODEL_DIMENSIONS
from loomspark.operators import chunking, enrich, incremental, markdown, metadata, reflow, store, vector
from loomspark.plans.oracle import ORACLES as ORACLES
from loomspark.session import materialize, shared_folder, spread, table
from loomspark.sources import files, html, structured
from loomspark.streaming.incremental import windowed_counts

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
NOW = "2025-01-01T00:00:00.000000"


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


def docs(spark: SparkSession, d: str) -> DataFrame:
    return spread(table(spark, d, "documents"))


def chunk_rows(spark: SparkSession, d: str) -> DataFrame:
    """Chunks with one row per id: the latest delivery."""
    return incremental.latest_per_key(table(spark, d, "chunks"), "chunk_id", "updated_at", "version", "chunk_index")


@query
def meta_title(spark, d):
    return docs(spark, d).select("doc_id", metadata.title(F.col("text")).alias("title"))


@query
def meta_keywords(spark, d):
    return docs(spark, d).select("doc_id", F.array_join(metadata.keywords(F.col("text")), "|").alias("keywords"))


@query
def meta_language(spark, d):
    return metadata.with_language(docs(spark, d).select("doc_id", "text"), "text").select("doc_id", "language")


@query
def meta_content_type(spark, d):
    return docs(spark, d).select("doc_id", metadata.content_type(F.col("text")).alias("content_type"))


@query
def meta_domain(spark, d):
    kws = docs(spark, d).select("doc_id", "text", metadata.keywords(F.col("text")).alias("kws"))
    return metadata.with_domain(kws, "text", "kws").select("doc_id", "domain", "sub_domain")


@query
def meta_summary(spark, d):
    return docs(spark, d).select("doc_id", metadata.summary(F.col("text")).alias("summary"))


def _with_front(c):
    return F.concat(F.lit("---\ntitle: x\n---\n\n"), c)


@query
def meta_without_front_matter(spark, d):
    t = F.when(F.col("doc_id") % 3 == 0, F.col("text")).otherwise(_with_front(F.col("text")))
    return docs(spark, d).select("doc_id", metadata.without_front_matter(t).alias("body"))


@query
def meta_front_matter(spark, d):
    m = metadata.front_matter(docs(spark, d).select("doc_id", "text", "source_file", "source_format"))
    return m.withColumn("keywords", F.array_join("keywords", "|")).drop("body", "prepared_at")


@query
def meta_format_histogram(spark, d):
    return docs(spark, d).groupBy(F.coalesce("source_format", F.lit("")).alias("source_format")).agg(F.count("*").alias("n"))


@query
def reflow_lines(spark, d):
    return reflow.reflow(docs(spark, d), "doc_id", "text").withColumnRenamed("text", "reflowed")


@query
def md_sections(spark, d):
    s = markdown.sections(docs(spark, d), "doc_id", "text")
    return s.withColumn("section_path", F.array_join("section_path", " > ")).withColumn("table_headers", F.array_join("table_headers", "|"))


@query
def md_sections_without_code(spark, d):
    s = markdown.sections(docs(spark, d), "doc_id", "text", keep_code=False)
    return s.groupBy("element_type").agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("chars"), F.sum("table_row_count").alias("table_rows"))


@query
def md_rendered_tables(spark, d):
    """A pipe table for each nation: its market segments with their orders (structured sources as Markdown)."""
    o, c = table(spark, d, "orders"), table(spark, d, "customer")
    per = c.join(o, o.o_custkey == c.c_custkey, "left").groupBy("c_nationkey", "c_mktsegment").agg(F.count("o_orderkey").alias("n"))
    rows = per.groupBy("c_nationkey").agg(F.array_sort(F.collect_list(F.struct("c_mktsegment", "n"))).alias("rows"))  # as many as there are segments
    body = F.transform("rows", lambda r: F.array(r["c_mktsegment"], r["n"].cast("string")))
    return rows.select("c_nationkey", markdown.render_table(F.array(F.lit("segment"), F.lit("orders")), body).alias("markdown"))


@query
def c3_sentence_split(spark, d):
    return chunking.split_documents(docs(spark, d), "doc_id", "text", "source_file", 500, 100)


def _packed(spark, d, size):
    base = docs(spark, d)
    return base, chunking.pack(markdown.sections(base, "doc_id", "text"), "doc_id", size)


@query
def c1_pack(spark, d):
    _, p = _packed(spark, d, 600)
    return p.groupBy("doc_id", "group").agg(F.count("*").alias("blocks"), F.sum(F.length("text")).alias("chars"), F.min("seq").alias("first_seq"))


@query
def c4_chunks(spark, d):
    base, p = _packed(spark, d, 600)
    out = chunking.chunks(base, p, "doc_id", "text", "source_file", 600)
    return out.withColumn("section_path", F.array_join("section_path", " > ")).withColumn("table_headers", F.array_join("table_headers", "|"))


@query
def c8_type_counts(spark, d):
    base, p = _packed(spark, d, 2000)
    return chunking.chunks(base, p, "doc_id", "text", "source_file").groupBy("chunk_type").agg(F.count("*").alias("n"), F.sum(F.length("chunk_text")).alias("chars"))


@query
def c8_records(spark, d):
    """Full chunk records with the metadata of their documents."""
    base, p = _packed(spark, d, 2000)
    rows = chunking.chunks(base, p, "doc_id", "text", "source_file")
    meta = metadata.front_matter(docs(spark, d).select("doc_id", "text", "source_file", "source_format"))
    out = chunking.records(rows, meta, "doc_id", F.lit(NOW))
    return out.withColumn("section_path", F.array_join("section_path", " > ")).withColumn("table_headers", F.array_join("table_headers", "|"))


@query
def i7_run(spark, d):
    """Counts of the second of two runs into one table, before which each tenth document was emptied."""
    base = docs(spark, d).select("doc_id", F.format_string("doc-%d.md", "doc_id").alias("source_file"), "source_format", F.col("text").alias("content"))
    path = f"{shared_folder(spark)}/table-{uuid.uuid4().hex}"
    store.run(base.drop("doc_id"), path, NOW, buckets=8)
    edited = base.withColumn("content", F.when(F.col("doc_id") % 10 == 0, "").otherwise(F.col("content")))
    return store.run(edited.drop("doc_id"), path, "2025-02-01T00:00:00.000000", buckets=8)


@query
def i1_ids_and_hashes(spark, d):
    c = table(spark, d, "chunks")
    return c.select("chunk_id", "chunk_index", chunking.chunk_id(F.col("source_file"), F.col("chunk_index"), F.col("chunk_text")).alias("new_id"), chunking.content_hash(F.col("chunk_text")).alias("new_hash")).distinct()


@query
def i3_source_hash(spark, d):
    return docs(spark, d).select("doc_id", chunking.source_hash(F.col("text"), F.col("title"), F.col("source_file")).alias("source_hash"))


@query
def i4_changed_files(spark, d):
    m = table(spark, d, "manifest")
    now = chunk_rows(spark, d).groupBy("source_file").agg(F.substring(F.sha2(F.array_join(F.array_sort(F.collect_set("content_hash")), ""), 256), 1, 32).alias("source_hash"))
    return incremental.files_to_update(now, m).select("source_file", "source_hash", "old_hash", "changed")


@query
def i6_next_manifest(spark, d):
    m = table(spark, d, "manifest")
    f = m.groupBy("source_file").agg(F.max("source_hash").alias("source_hash"))
    return incremental.next_manifest(f, m, F.lit(NOW))


def _versions(spark, d):
    """The chunks as they are, and a later version: some dropped, some edited."""
    old = chunk_rows(spark, d).select("chunk_id", "content_hash", "chunk_index", "version", "created_at")
    key = F.conv(F.substring("chunk_id", 1, 4), 16, 10).cast("int")
    new = old.filter(key % 17 != 0).select("chunk_id", F.when(key % 10 == 0, F.concat(F.lit("edited-"), F.col("content_hash"))).otherwise(F.col("content_hash")).alias("content_hash"), "chunk_index")
    return new, old


@query
def i5_merge(spark, d):
    new, old = _versions(spark, d)
    return incremental.merge(new, old, F.lit(NOW))


@query
def i5_merge_stats(spark, d):
    new, old = _versions(spark, d)
    old = materialize(old, "old-chunks")
    return incremental.merge_stats(incremental.merge(new, old, F.lit(NOW)), old)


@query
def j1_chunks_with_vectors(spark, d):
    v = table(spark, d, "chunk_vectors").filter("embedding is not null").select("chunk_id", F.size("embedding").alias("dim")).distinct()
    return chunk_rows(spark, d).join(v, "chunk_id").select("chunk_id", "source_file", "chunk_type", "dim")


@query
def j2_missing_vectors(spark, d):
    return vector.missing_vectors(chunk_rows(spark, d), table(spark, d, "chunk_vectors")).select("chunk_id", "source_file")


@query
def j3_embedded(spark, d):
    return chunk_rows(spark, d).join(table(spark, d, "chunk_vectors").select("chunk_id"), "chunk_id", "left_semi").select("chunk_id", "source_file")


@query
def k1_output_paths(spark, d):
    return docs(spark, d).select("doc_id", files.output_path(F.col("source_file")).alias("path"))


@query
def k4_upsert(spark, d):
    """Rows delivered again replace earlier ones."""
    c = table(spark, d, "chunks").select("chunk_id", "content_hash", "updated_at", "version")
    latest = incremental.latest_per_key(c.distinct(), "chunk_id", "updated_at", "version")
    first = c.groupBy("chunk_id").agg(F.min("updated_at").alias("updated_at")).join(c, ["chunk_id", "updated_at"], "left_semi")
    base = first.select("chunk_id", F.lit("old").alias("content_hash"), F.lit("").alias("updated_at"), F.lit(0).alias("version"))
    return incremental.upsert(base, latest, "chunk_id")


@query
def k6_export(spark, d):
    v = table(spark, d, "chunk_vectors").filter("embedding is not null")
    v = v.groupBy("chunk_id").agg(F.first("embedding").alias("embedding"))
    e = vector.export(chunk_rows(spark, d).select("chunk_id", "source_file"), v, 96)
    return e.select("chunk_id", "source_file", F.size("embedding").alias("dim"), F.round(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + F.abs(x.cast("double"))), 4).alias("weight"))


@query
def k8_listing(spark, d):
    c = chunk_rows(spark, d)
    line = F.concat(F.lit("**"), F.col("chunk_id"), F.lit("** ("), F.col("source_file"), F.lit(")\n"), vector.preview(F.col("chunk_text"), 200))
    return c.filter("chunk_text is not null").select("chunk_id", line.alias("listing"))


@query
def t5_enrichment_status(spark, d):
    b = docs(spark, d).select("doc_id", "source_format", (F.col("doc_id") % 5 == 0).alias("enriched"), (F.col("doc_id") % 2 == 0).alias("has_output"), (F.col("doc_id") % 7 != 0).alias("changed"))
    return b.select("doc_id", enrich.strategy(F.col("source_format")).alias("strategy"), enrich.status(F.col("enriched"), F.col("has_output"), False, True, F.col("changed")).alias("status"))


@query
def t6_enrichment_counts(spark, d):
    return t5_enrichment_status(spark, d).groupBy("status").agg(F.count("*").alias("n"))


@query
def v1_embed_inputs(spark, d):
    row = table(spark, d, "model_info").select("model_name").first()  # the table has one row
    model, e5 = F.lit(row.model_name if row else None), F.lit("intfloat/multilingual-e5-large")
    inputs = {"own": vector.embed_input(model, F.col("chunk_text")), "passage": vector.embed_input(e5, F.col("chunk_text")), "query": vector.embed_input(e5, F.col("chunk_text"), True)}
    return chunk_rows(spark, d).select("chunk_id", *(F.md5(x).alias(k) for k, x in inputs.items()))


@query
def v1_embeddings(spark, d):
    """Filled places and weight of the hashed word vector of every chunk."""
    e = chunk_rows(spark, d).select("chunk_id", vector.hashed_embedding(F.col("chunk_text")).alias("e"))
    return e.select("chunk_id", F.size(F.filter("e", lambda x: x != 0)).alias("filled"), F.round(F.aggregate("e", F.lit(0.0), lambda a, x: a + F.abs(x.cast("double"))), 4).alias("weight"))


@query
def v2_model_dimensions(spark, d):
    """The dimension each model expects beside the lengths of the stored vectors, by number of vectors."""
    names = F.explode(F.concat(F.array(F.col("model_name")), F.array(*map(F.lit, MODEL_DIMENSIONS)))).alias("model_name")
    models = table(spark, d, "model_info").select(names).select("model_name", vector.model_dimension(F.col("model_name")).alias("expected"))
    return vector.stored_dimensions(table(spark, d, "chunk_vectors")).crossJoin(F.broadcast(models))  # a handful of lengths and of models


@query
def v3_compatibility(spark, d):
    """Whether the stored vectors fit a model, for one that is theirs, one of another name and one of another dimension."""
    info, dims = table(spark, d, "model_info"), materialize(vector.stored_dimensions(table(spark, d, "chunk_vectors")), "dimensions")
    asked = [("lumen-text-96", 96), ("other", 96), ("lumen-text-96", None)]
    rows = [vector.compatibility(info, dims, m, e).select(F.lit(i).alias("case"), "*") for i, (m, e) in enumerate(asked)]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


def _built(spark, d):
    """A vector store built in two steps: a part of the chunks, then all of them."""
    path = f"{shared_folder(spark)}/vectors-{uuid.uuid4().hex}"
    c = table(spark, d, "chunks")
    vector.build(c.filter("chunk_index % 3 <> 0"), path, "hashed", vector.hashed_embedding, 256, NOW)
    return path, vector.build(c, path, "hashed", vector.hashed_embedding, 256, NOW)


@query
def v4_build(spark, d):
    return _built(spark, d)[1]


@query
def k5_vectors(spark, d):
    """What the vector store holds after building: one vector and one row for each chunk."""
    path, _ = _built(spark, d)
    v = spark.read.parquet(f"{path}/chunk_vectors").select("chunk_id", F.size("embedding").alias("dim"))
    return v.join(spark.read.parquet(f"{path}/chunks").select("chunk_id", "source_file", "embedded_at"), "chunk_id")


@query
def v4_build_stats(spark, d):
    return vector.build_stats(chunk_rows(spark, d), table(spark, d, "chunk_vectors"))


@query
def v5_search(spark, d):
    e = table(spark, d, "embeddings")
    return vector.search(e, e.filter("vec_id % 100 = 0"), "vec_id", "embedding", 5)


@query
def v5_search_cosine(spark, d):
    e = table(spark, d, "embeddings")
    return vector.search(e, e.filter("vec_id % 100 = 0"), "vec_id", "embedding", 5, "cosine")


@query
def v5_search_filtered(spark, d):
    """Twice k neighbours are fetched, those of label 0 kept, k at most."""
    e = table(spark, d, "embeddings")
    hits = vector.search_filtered(e, e.filter("vec_id % 100 = 0"), "vec_id", "embedding", e.select("vec_id", "label"), F.col("label") == 0, 5)
    return hits.select("query_id", "place", "id", "distance", "label")


@query
def v6_get_chunk(spark, d):
    """Point look-ups of the first chunk of every file, all fields."""
    rows = chunk_rows(spark, d).select(*vector.CHUNK_FIELDS)
    first = rows.groupBy("source_file").agg(F.min_by("chunk_id", F.struct("chunk_index", "chunk_id")).alias("chunk_id"))
    out = rows.join(first.select("chunk_id"), "chunk_id", "left_semi")
    return out.withColumn("section_path", F.array_join("section_path", " > ")).withColumn("table_headers", F.array_join("table_headers", "|"))


@query
def v6_get_chunk_sql(spark, d):
    """A look-up by parameterised SQL: the chunk with the smallest id."""
    rows = chunk_rows(spark, d)
    low = rows.agg(F.min("chunk_id").alias("id")).first()
    return vector.get_chunk(rows, low.id).select("chunk_id", "source_file", "chunk_index", "chunk_text", "keywords")


@query
def k8_search_results(spark, d):
    """Rendered hits of the first vector's search, texts from the documents of the same number."""
    e = table(spark, d, "embeddings")
    hits = vector.search(e, e.filter("vec_id % 100 = 0"), "vec_id", "embedding", 5).join(docs(spark, d).withColumnRenamed("doc_id", "id"), "id")
    text = vector.render_hit(F.col("rank"), F.col("similarity"), F.col("source_file"), F.split(F.coalesce("title", F.lit("")), " "), F.coalesce("content_type", F.lit("")), F.col("id"), F.coalesce("text", F.lit("")))
    return hits.select("query_id", "rank", F.regexp_replace(text, "Similarity: [^\n]*", "").alias("markdown"))


@query
def k8_chunk_texts(spark, d):
    c = chunk_rows(spark, d).filter("chunk_text is not null")
    text = vector.render_chunk(F.col("chunk_id"), F.col("source_file"), F.col("section_path"), F.col("chunk_type"), F.coalesce("domain", F.lit("")), F.coalesce("language", F.lit("")), F.col("chunk_text"))
    return c.select("chunk_id", F.md5(text).alias("text_md5"))


@query
def k8_document_list(spark, d):
    rows = vector.list_documents(chunk_rows(spark, d))
    return rows.select(vector.render_document(F.col("source_file"), F.col("chunk_count"), F.col("domain"), F.col("language")).alias("line"))


@query
def k8_statistics_text(spark, d):
    return vector.render_statistics(vector.statistics(chunk_rows(spark, d)), "lumen-text-96", 96)


@query
def v7_list_documents(spark, d):
    return vector.list_documents(chunk_rows(spark, d))


@query
def v8_statistics(spark, d):
    s = vector.statistics(chunk_rows(spark, d))
    return s.select("total_chunks", "total_documents", F.array_join("domains", ";").alias("domains"), F.array_join("chunk_types", ";").alias("chunk_types"))


@query
def a3_counts_by_domain(spark, d):
    return chunk_rows(spark, d).groupBy(F.coalesce("domain", F.lit("")).alias("domain")).agg(F.count("*").alias("n"), F.count_distinct("source_file").alias("files"))


@query
def a6_top_subdomain(spark, d):
    """The most frequent sub-domain of every domain, the first of equals."""
    per = chunk_rows(spark, d).filter("domain <> '' and sub_domain <> ''").groupBy("domain", "sub_domain").agg(F.count("*").alias("n"))
    low = per.groupBy("domain").agg(F.max("n").alias("n")).join(per, ["domain", "n"]).groupBy("domain", "n").agg(F.min("sub_domain").alias("sub_domain"))
    return low


def _pages(spark, d):
    """The documents as HTML pages with a header, a table, a script and preformatted text."""
    esc = lambda x: F.replace(F.replace(F.replace(x, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    line = F.transform(F.split("text", "\r?\n", -1), lambda x: F.concat(F.lit("<p class='x'>"), esc(x), F.lit("</p>")))
    page = F.concat(
        F.lit("<!doctype html>\n<html><head><title>t</title><style>p {}</style></head><body><header>"), esc(F.coalesce("source", F.lit("-"))), F.lit("</header><h1>"), esc(F.coalesce("title", F.lit("-"))), F.lit("</h1>"),
        F.array_join(line, ""), F.lit("<!-- <p>no</p> --><table><thead><tr><th>field</th> <th>value</th></tr></thead>\n<tbody>\n<tr><td>lang</td><td>"), esc(F.coalesce("lang", F.lit("-"))),
        F.lit("</td></tr>\n<tr><td>only</td></tr></tbody></table><script>if (a < b) { '<p>'; }</script><pre><code>x = "), F.col("doc_id").cast("string"), F.lit("\n  y &lt; 2\n</code></pre></body></html>"),
    )
    return docs(spark, d).select("doc_id", "source_file", "text", page.alias("page"))


@query
def s7_html_to_markdown(spark, d):
    return _pages(spark, d).select("doc_id", F.md5(html.to_markdown(F.col("page"))).alias("markdown_md5"))


@query
def s7_csv_to_markdown(spark, d):
    """Customers as CSV texts of fifty, and these as tables."""
    c = table(spark, d, "customer").withColumn("part", F.floor(F.col("c_custkey") / 50).cast("bigint"))
    line = F.concat(F.col("c_custkey").cast("string"), F.lit(',"'), F.col("c_name"), F.lit(', ""'), F.col("c_mktsegment"), F.lit('"""'))
    texts = c.groupBy("part").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("c_custkey", line.alias("l")))), lambda r: r["l"]), "\n").alias("content"))
    return structured.to_markdown(texts.select("part", F.lit("csv").alias("source_format"), F.concat(F.lit("key,name\r\n"), "content").alias("content"))).select("part", F.col("content").alias("markdown"), "error")


@query
def s7_json_to_markdown(spark, d):
    rows = table(spark, d, "events").select("event_id", F.lit("json").alias("source_format"), F.col("props").alias("content"))
    return structured.to_markdown(rows).select("event_id", F.col("content").alias("markdown"), "error")


@query
def u3_union(spark, d):
    """Documents of the text branch and pages of the web branch in one table, by format."""
    text = docs(spark, d).filter("doc_id % 2 = 0").select("source_file", F.lit("markdown").alias("source_format"), F.col("text").alias("content"))
    web = _pages(spark, d).filter("doc_id % 2 = 1").select("source_file", F.lit("html").alias("source_format"), html.to_markdown(F.col("page")).alias("content"))
    return text.unionByName(web).groupBy("source_format").agg(F.count("*").alias("n"), F.count("content").alias("with_content"), F.sum(F.length("content")).alias("chars"))


@query
def k2_front_matter(spark, d):
    """Prepared documents as they are written: front matter and body."""
    fields = {"title": F.col("title"), "domain": F.col("lang"), "keywords": F.filter(F.split(F.coalesce("source", F.lit("")), "-", -1), lambda x: x != ""), "source_file": F.col("source_file")}
    return docs(spark, d).select("doc_id", F.md5(F.concat(files.render_front_matter(("keywords",), **fields), F.coalesce("text", F.lit("")))).alias("file_md5"))


@query
def t2_enrich(spark, d):
    """Enrichment of every text: strategy by format, the first 48,000 characters through the model, the rest after them."""
    model = lambda text, strategy: None if strategy == "slides" else text.replace("e", "E")
    out = enrich.enrich(docs(spark, d).select("doc_id", "text", "source_format"), "text", "source_format", model)
    return out.select("doc_id", "strategy", "changed", F.md5("enriched_text").alias("text_md5"))


@query
def s11_front_matter(spark, d):
    c = F.concat(F.lit("---\ntitle: "), F.lit("'"), F.col("source_file"), F.lit("'\nid: "), F.col("doc_id").cast("string"), F.lit("\ntags:\n- a\n- \"b, c\"\nmore: [x, y]\n---\n\n"), F.col("text"))
    front, body = files.split_front_matter(c)
    tags = F.concat(files.front_matter_list(front, "tags"), files.front_matter_list(front, "more"), files.front_matter_list(front, "none"))
    return docs(spark, d).select("doc_id", files.front_matter_value(front, "title").alias("title"), files.front_matter_value(front, "id").alias("id"), F.array_join(tags, "|").alias("tags"), F.md5(body).alias("body_md5"))


@query
def s15_orders_by_segment(spark, d):
    """Structured sources: joins and grouping of a star schema."""
    o, c, n = table(spark, d, "orders"), table(spark, d, "customer"), table(spark, d, "nation")
    j = o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)
    return j.groupBy("n_name", "c_mktsegment").agg(F.count("*").alias("orders"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query
def x_event_windows(spark, d):
    """Tumbling windows over the events, by the function the streaming job runs (no operator of the reference)."""
    return windowed_counts(table(spark, d, "events"))
