"""Chunks of bounded size from blocks, and sentence-wise splitting with overlap, as folds over bounded arrays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loomspark.functions.text import WS, strip

MAX_SIZE = 2000
OVERLAP = 100


def sentence_pieces(text: Column, max_size: int = MAX_SIZE, overlap: int = OVERLAP) -> Column:
    """Pieces of whole sentences up to ``max_size`` characters; a piece begins with the last ``overlap`` of the one before.

    Blanks between sentences don't count; an over-long sentence stays whole; an empty text gives no piece.
    """
    parts = F.split(text, f"(?<=[.!?]){WS}+", -1)
    start = F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("cur"))

    def step(state: Column, s: Column) -> Column:
        cur = state["cur"]
        over = (F.length(cur) + F.length(s) > max_size) & (cur != "")
        tail = F.when(F.length(cur) > overlap, F.concat(F.substring(cur, -overlap, overlap), F.lit(" "), s)).otherwise(F.concat(F.lit(" "), s))
        grown = F.when(cur != "", F.concat(cur, F.lit(" "), s)).otherwise(s)
        return F.struct(F.when(over, F.concat(state["done"], F.array(strip(cur)))).otherwise(state["done"]).alias("done"), F.when(over, tail).otherwise(grown).alias("cur"))

    return F.aggregate(parts, start, step, lambda st: F.when(strip(st["cur"]) != "", F.concat(st["done"], F.array(strip(st["cur"])))).otherwise(st["done"]))


def split_documents(docs: DataFrame, id_col: str, text_col: str, file_col: str, max_size: int = MAX_SIZE, overlap: int = OVERLAP) -> DataFrame:
    """``(id, source_file, chunk_index, chunk_text, chunk_id, content_hash)`` of every text, sentence by sentence."""
    rows = docs.select(id_col, F.col(file_col).alias("source_file"), F.posexplode(sentence_pieces(F.col(text_col), max_size, overlap)).alias("chunk_index", "chunk_text"))
    return rows.select("*", chunk_id(F.col("source_file"), F.col("chunk_index"), F.col("chunk_text")).alias("chunk_id"), content_hash(F.col("chunk_text")).alias("content_hash"))


def chunk_id(file: Column, index: Column, text: Column) -> Column:
    return F.substring(F.md5(F.concat(file, F.lit(":"), index.cast("string"), F.lit(":"), F.substring(text, 1, 100))), 1, 16)


def content_hash(text: Column) -> Column:
    return F.sha2(text, 256)


def source_hash(body: Column, *metadata: Column) -> Column:
    """Hash of a body and its metadata values; times stay out, so that preparing again changes nothing."""
    return F.substring(F.sha2(F.concat_ws("\x01", F.coalesce(body, F.lit("")), *(F.coalesce(m.cast("string"), F.lit("")) for m in metadata)), 256), 1, 32)


SECTION = ("seq", "text", "element_type", "heading_level", "heading_text", "section_path", "table_headers", "table_row_count")


def pack(sections: DataFrame, id_col: str, max_size: int = MAX_SIZE) -> DataFrame:
    """``(id, sections..., group)``: greedy groups of blocks. A group begins at a heading, at and after an oversized block, and where the sum would pass ``max_size``.

    No state crosses a heading, so the fold runs over the blocks below one heading, not over whole documents. The blocks
    travel with the fold, so that they are neither computed nor shuffled a second time.
    """
    names = [c for c in sections.columns if c != id_col]
    by = Window.partitionBy(id_col).orderBy("seq")
    s = sections.withColumn("h", F.sum((F.col("element_type") == "header").cast("int")).over(by))
    item = F.struct("seq", *(c for c in names if c != "seq"), F.length("text").alias("_n"), (F.col("element_type") == "header").alias("_head"))
    blocks = s.groupBy(id_col, "h").agg(F.array_sort(F.collect_list(item)).alias("b"))
    # groups gather in runs of 512, so that the fold copies short arrays however many blocks a heading has
    none = F.array().cast("array<int>")
    zero = F.struct(F.array().cast("array<array<int>>").alias("full"), none.alias("starts"), F.lit(-1).alias("at"), F.lit(0).alias("run"), F.lit(False).alias("big"))

    def step(st: Column, x: Column) -> Column:
        new = x["_head"] | (x["_n"] > max_size) | st["big"] | (st["run"] + x["_n"] > max_size) | (st["at"] < 0)
        at, over = F.when(new, x["seq"]).otherwise(st["at"]), F.size(st["starts"]) >= 512
        return F.struct(
            F.when(over, F.concat(st["full"], F.array(st["starts"]))).otherwise(st["full"]).alias("full"),
            F.when(over, F.array(at)).otherwise(F.concat(st["starts"], F.array(at))).alias("starts"),
            at.alias("at"),
            F.when(new, x["_n"]).otherwise(st["run"] + x["_n"]).alias("run"),
            ((x["_n"] > max_size) & ~x["_head"]).alias("big"),
        )

    lean = F.transform("b", lambda x: F.struct(x["seq"].alias("seq"), x["_n"].alias("_n"), x["_head"].alias("_head")))
    marked = blocks.withColumn("starts", F.aggregate(lean, zero, step, lambda st: F.flatten(F.concat(st["full"], F.array(st["starts"])))))
    return marked.select(id_col, F.explode(F.arrays_zip("b", "starts")).alias("r")).select(id_col, *(F.col(f"r.b.{c}").alias(c) for c in names), F.col("r.starts").alias("group"))


def chunks(docs: DataFrame, packed: DataFrame, id_col: str, text_col: str, file_col: str, max_size: int = MAX_SIZE, overlap: int = OVERLAP) -> DataFrame:
    """Chunk records of every document.

    A group's text are its blocks joined by a blank line, its type the most common block type (the first of equals), its
    table data those of the first table with headers. A single oversized paragraph is split by sentences (its pieces
    have no parent heading and no table data). A document without blocks gives one chunk of type 'document'.
    """
    g = packed.groupBy(id_col, "group").agg(F.array_sort(F.collect_list(F.struct(*SECTION))).alias("s"))
    types = F.col("s.element_type")
    counted = F.transform(types, lambda t, i: F.struct(F.size(F.filter(types, lambda u: u == t)).alias("n"), (-i).alias("o"), t.alias("t")))
    first = F.get("s", F.lit(0))
    table = F.get(F.filter("s", lambda x: (x["element_type"] == "table") & (F.size(x["table_headers"]) > 0)), F.lit(0))
    # each step in a select of its own, so that no step is computed again for each use of its result
    g = g.select(id_col, "group", F.array_max(counted)["t"].alias("chunk_type"), first.alias("first"), table.alias("table"), F.array_join(F.col("s.text"), "\n\n").alias("text"), F.size("s").alias("size"))
    split = (F.col("size") == 1) & (F.length("text") > max_size) & ~F.col("chunk_type").isin("table", "code", "list")
    g = g.withColumn("split", split).select(
        id_col,
        "group",
        F.posexplode(F.when(F.col("split"), sentence_pieces(F.col("text"), max_size, overlap)).otherwise(F.array("text"))).alias("piece", "chunk_text"),
        "chunk_type",
        F.col("first.heading_level").alias("heading_level"),
        F.col("first.heading_text").alias("heading_text"),
        F.col("first.section_path").alias("section_path"),
        F.when(~F.col("split") & (F.size("first.section_path") >= 2), F.try_element_at("first.section_path", F.lit(-2))).alias("parent_heading"),
        F.when(~F.col("split"), F.col("table.table_headers")).alias("table_headers"),
        F.when(~F.col("split"), F.col("table.table_row_count")).alias("table_row_count"),
    )
    found = docs.select(id_col, F.col(file_col).alias("source_file"), F.coalesce(F.col(text_col), F.lit("")).alias("_body")).join(g, id_col, "left")
    index = F.row_number().over(Window.partitionBy(id_col).orderBy("group", "piece")) - 1
    text = F.coalesce("chunk_text", "_body")
    out = found.select(
        id_col,
        "source_file",
        index.alias("chunk_index"),
        text.alias("chunk_text"),
        F.coalesce("chunk_type", F.lit("document")).alias("chunk_type"),
        F.coalesce("heading_level", F.lit(0)).alias("heading_level"),
        F.coalesce("heading_text", F.lit("")).alias("heading_text"),
        F.coalesce("parent_heading", F.lit("")).alias("parent_heading"),
        F.coalesce("section_path", F.array().cast("array<string>")).alias("section_path"),
        F.coalesce("table_headers", F.array().cast("array<string>")).alias("table_headers"),
        F.coalesce("table_row_count", F.lit(0)).alias("table_row_count"),
    )
    return out.select("*", chunk_id(F.col("source_file"), F.col("chunk_index"), F.col("chunk_text")).alias("chunk_id"), content_hash(F.col("chunk_text")).alias("content_hash"))


#: The columns of a chunk table, in order.
CHUNK_SCHEMA = (
    "chunk_id string, content_hash string, source_file string, chunk_index int, chunk_text string, chunk_type string, heading_level int, heading_text string, parent_heading string, "
    "section_path array<string>, table_headers array<string>, table_row_count int, domain string, sub_domain string, keywords string, language string, content_type string, "
    "version int, created_at string, updated_at string"
)


def json_list(items: Column) -> Column:
    """A JSON list of strings with a blank after each comma, other signs than quotes, backslashes and control signs as they are."""
    quoted = F.transform(F.coalesce(items, F.array().cast("array<string>")), lambda x: F.regexp_replace(F.to_json(F.array(x)), r"^\[|\]$", ""))
    return F.concat(F.lit("["), F.array_join(quoted, ", "), F.lit("]"))


def records(chunk_rows: DataFrame, metadata: DataFrame, id_col: str, now: Column) -> DataFrame:
    """Full records (the columns of ``CHUNK_SCHEMA``) of new chunks: version 1, both times ``now``, metadata of their document.

    ``metadata`` has one row per document with ``id, domain, sub_domain, keywords (array), language, content_type``;
    missing values are ''.
    """
    meta = metadata.select(id_col, *(F.coalesce(c, F.lit("")).alias(c) for c in ("domain", "sub_domain", "language", "content_type")), json_list(F.col("keywords")).alias("keywords"))
    full = chunk_rows.join(meta, id_col, "left").withColumns({"version": F.lit(1), "created_at": now, "updated_at": now})
    return full.select(*(F.col(n).cast(t).alias(n) for n, t in (f.split(" ", 1) for f in CHUNK_SCHEMA.split(", "))))
