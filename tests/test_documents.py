"""Hand-derived small documents, and plain models compared on random inputs."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from loomspark.operators import chunking, enrich, incremental, markdown, metadata, reflow, vector


def docs(spark, *texts):
    return spark.createDataFrame([(i, f"{'abcdefgh'[i]}.md", t) for i, t in enumerate(texts)], "id int, file string, t string")


def chunked(spark, *texts, size=2000):
    d = docs(spark, *texts)
    return chunking.chunks(d, chunking.pack(markdown.sections(d, "id", "t"), "id", size), "id", "t", "file", size).orderBy("id", "chunk_index").collect()


def one(spark, f, *texts):
    return [r.x for r in docs(spark, *texts).select("id", f(F.col("t")).alias("x")).orderBy("id").collect()]


def test_single_chunk(spark):
    (c,) = chunked(spark, "# T\n\nHello.")
    assert (c.chunk_text, c.heading_level, c.section_path, c.parent_heading, c.chunk_type) == ("# T\n\nHello.", 1, ["T"], "", "header")
    assert c.chunk_id == "80869626c8cff522" and c.content_hash == hashlib.sha256(b"# T\n\nHello.").hexdigest()


def test_heading_stack(spark):
    c = chunked(spark, "# A\n## B\n### C\n## D\ntext")
    assert [x.section_path for x in c] == [["A"], ["A", "B"], ["A", "B", "C"], ["A", "D"]]
    assert [x.parent_heading for x in c] == ["", "A", "B", "A"] and c[-1].chunk_text == "## D\n\ntext"
    assert [x.section_path for x in chunked(spark, "### C\n# A\n## B")] == [["C"], ["A"], ["A", "B"]]


def test_sentence_split(spark):
    d = docs(spark, "Aaaa bbbb. Cccc dddd. Eeee.", "x" * 3000, "", None)
    got = [r.p for r in d.select(chunking.sentence_pieces(F.col("t"), 20, 5).alias("p")).collect()]
    assert got == [["Aaaa bbbb. Cccc dddd.", "dddd. Eeee."], ["x" * 3000], [], None]


def model_sentences(text, size, overlap):
    out, cur = [], ""
    for s in re.split(r"(?<=[.!?])\s+", text):
        if len(cur) + len(s) > size and cur:
            out.append(cur.strip())
            cur = (cur[-overlap:] if len(cur) > overlap else "") + " " + s
        else:
            cur = cur + " " + s if cur else s
    return out + [cur.strip()] * bool(cur.strip())


def test_sentence_split_on_random_texts(spark):
    rng = random.Random(5)
    texts = [" ".join("".join(rng.choice("ab 漢") for _ in range(rng.randint(1, 30))).strip() + rng.choice([".", "!", "?", ""]) for _ in range(rng.randint(0, 12))) for _ in range(200)]
    d = spark.createDataFrame(list(enumerate(texts)), "id int, t string").select("id", chunking.sentence_pieces(F.col("t"), 40, 7).alias("p"))
    assert {r.id: r.p for r in d.collect()} == {i: model_sentences(t, 40, 7) for i, t in enumerate(texts)}


def model_pack(sections, size):
    groups, run, big = [], 0, False
    for kind, n in sections:
        if not groups or kind == "header" or n > size or big or run + n > size:
            groups.append(1)
            run = n
        else:
            groups[-1] += 1
            run += n
        big = n > size and kind != "header"
    return groups


def test_packer_on_random_sections(spark):
    rng = random.Random(9)
    lists = [[(rng.choice(["header", "paragraph", "list", "table"]), rng.randint(1, 60)) for _ in range(rng.randint(1, 25))] for _ in range(150)]
    lists.append([("paragraph", rng.randint(1, 60)) for _ in range(1300)])  # longer than a run of the fold
    rows = [(d, i, "x" * n, k) for d, s in enumerate(lists) for i, (k, n) in enumerate(s)]
    p = chunking.pack(spark.createDataFrame(rows, "id int, seq int, text string, element_type string"), "id", 50)
    got = {}
    for r in p.groupBy("id", "group").count().orderBy("id", "group").collect():
        got.setdefault(r.id, []).append(r["count"])
    assert got == {d: model_pack(s, 50) for d, s in enumerate(lists)}


def test_blocks(spark):
    text = "| a | b |\n| --- | --- |\n| 1 | 2 |\n| 3 |\n\n- x\n- y\n\n```py\n# no heading\n\n```\n| lone |\nrest"
    s = markdown.sections(docs(spark, text), "id", "t").orderBy("seq").collect()
    assert [x.element_type for x in s] == ["table", "list", "code", "paragraph"]
    assert s[0].table_headers == ["a", "b"] and s[0].table_row_count == 2 and s[2].text.startswith("```py") and s[3].text == "| lone | rest"
    assert s[0].text == "| a | b |\n| --- | --- |\n| 1 | 2 |\n| 3 |  |" and s[1].text == "- x\n- y"


def test_lists_quotes_and_inline_marks(spark):
    def blocks(text):
        return [(x.element_type, x.text) for x in markdown.sections(docs(spark, text), "id", "t").orderBy("seq").collect()]

    assert blocks("* one\n  goes on\nlazily\n\n* two\n  - below\n\n  a second paragraph\n\nplain") == [("list", "- one goes on lazily\n- two below a second paragraph"), ("paragraph", "plain")]
    assert blocks("1. a\n2. b\n- c\n* d") == [("list", "- a\n- b"), ("list", "- c"), ("list", "- d")]
    assert blocks("text\n- item") == [("paragraph", "text"), ("list", "- item")]
    assert blocks("> a **b**\n> > c\nlazy\n\n> d\n>") == [("blockquote", "a b c lazy"), ("blockquote", "d")]
    assert blocks("see [the `x_y`](u) and ![pic](p), **very** *nice* __bold__ _it_, `**raw**` a_b_c 2 * 3\nnext") == [("paragraph", "see the x_y and pic, very nice bold it, **raw** a_b_c 2 * 3 next")]
    assert blocks("## A `b` *c*\r\nx\r\n\r\n---\r\ny ` z") == [("header", "## A b c"), ("paragraph", "x"), ("paragraph", "y ` z")]
    assert blocks(">\n\n***\n") == [] and blocks("| a | b |\n| c |") == [("table", "| a | b |\n| c |")]


def test_records(spark):
    d = docs(spark, "# T\n\nx", None).withColumn("domain", F.lit(None).cast("string"))
    meta = d.select("id", "domain", F.lit("s").alias("sub_domain"), F.array(F.lit('a"b'), F.lit("é")).alias("keywords"), F.lit("en").alias("language"), F.lit("article").alias("content_type"))
    rows = chunking.chunks(d, chunking.pack(markdown.sections(d, "id", "t"), "id"), "id", "t", "file")
    out = chunking.records(rows, meta, "id", F.lit("now"))
    assert [f.name for f in out.schema] == [f.split(" ")[0] for f in chunking.CHUNK_SCHEMA.split(", ")]
    assert {(r.source_file, r.chunk_type, r.domain, r.keywords, r.version, r.updated_at) for r in out.collect()} == {(f, k, "", '["a\\"b", "é"]', 1, "now") for f, k in (("a.md", "header"), ("b.md", "document"))}


def test_empty_document_gives_one_chunk(spark):
    assert [(c.chunk_type, c.chunk_text) for c in chunked(spark, "", None)] == [("document", ""), ("document", "")]


def test_render_table(spark):
    d = spark.range(1).select(markdown.render_table(F.array(F.lit("a"), F.lit("b")), F.array(F.array(F.lit("1")), F.array(F.lit("2"), F.lit("3"), F.lit("4")))).alias("x"))
    assert d.first().x == "| a | b |\n| --- | --- |\n| 1 |  |\n| 2 | 3 | 4 |"


def test_metadata(spark):
    assert one(spark, metadata.title, "x\n## H2\n# H1", "", None, "line one\nmore") == ["H1", "Untitled", None, "line one"]
    assert one(spark, metadata.summary, "# T\nshort\n\nThis is a long enough paragraph with **bold** text.", "") == ["This is a long enough paragraph with bold text.", ""]
    assert one(spark, metadata.content_type, "\n".join(["- a"] * 4 + ["x"] * 6), "```\n" + "x" * 50 + "\n```", None) == ["list", "code", None]
    assert one(spark, metadata.without_front_matter, "---\ntitle: x\n---\n\nBody", "---\nBody", "---\nrule\n---") == ["Body", "---\nBody", ""]
    assert one(spark, metadata.keywords, "# The Big Plan\n**very bold** `x` [link](u)\n```sql\n```") == [["Plan", "bold", "link", "very", "Big", "sql"]]
    d = metadata.with_domain(docs(spark, "html", "nothing", None).withColumn("k", F.array().cast("array<string>")), "t", "k").orderBy("id").collect()
    assert [(r.domain, r.sub_domain) for r in d] == [("machine-learning", "ml"), ("general", ""), (None, None)]


def test_reflow(spark):
    d = reflow.reflow(docs(spark, "a\nb\n\nc", "a\n\n\n# H\nb", "", None, "1. x\ny\n2. z"), "id", "t").orderBy("id")
    assert [r.t for r in d.collect()] == ["a b c", "a\n\n# H\nb", "", None, "1. x y\n2. z"]


def test_merge(spark):
    schema = "chunk_id string, content_hash string, chunk_index int, version int, created_at string"
    old = spark.createDataFrame([("id1", "h1", 0, 3, "t0"), ("gone", "h9", 1, 1, "t0")], schema)
    new = spark.createDataFrame([("id1", "h2", 0), ("id9", "h1", 1), ("x", "h3", 2)], "chunk_id string, content_hash string, chunk_index int")
    m = incremental.merge(new, old, F.lit("now"))
    assert {r.chunk_id: (r.status, r.version, r.created_at) for r in m.collect()} == {"id1": ("updated", 4, "t0"), "id9": ("unchanged", 3, "t0"), "x": ("added", 1, "now")}
    assert tuple(incremental.merge_stats(m, old).first()) == (1, 1, 1, 1)
    same = incremental.merge(old.select("chunk_id", "content_hash", "chunk_index"), old, F.lit("now"))
    assert tuple(incremental.merge_stats(same, old).first()) == (0, 0, 2, 0)
    assert tuple(incremental.merge_stats(incremental.merge(new.limit(0), old, F.lit("now")), old).first()) == (0, 0, 0, 2)


def test_vectors(spark):
    c = spark.createDataFrame([("a",), ("b",)], "chunk_id string")
    v = spark.createDataFrame([("a", [1.0, 0.0])], "chunk_id string, embedding array<float>")
    assert {r.chunk_id: list(r.embedding) for r in vector.export(c, v, 2).collect()} == {"a": [1, 0], "b": [0, 0]}
    assert [r.chunk_id for r in vector.missing_vectors(c, v).collect()] == ["b"]
    e = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [1.0, 0.0]), (4, None)], "id bigint, v array<float>")
    r = vector.search(e, e.filter("id = 1"), "id", "v", 2).orderBy("rank").collect()
    assert [(x.id, x.distance, x.similarity) for x in r] == [(1, 0.0, 1.0), (3, 0.0, 1.0)]
    labels = spark.createDataFrame([(1, "Y"), (2, "X"), (3, "Y")], "id bigint, label string")
    assert vector.search_filtered(e, e.filter("id = 1"), "id", "v", labels, F.col("label") == "X", 1).count() == 0
    assert vector.search(e.limit(0), e.limit(0), "id", "v").count() == 0
    odd = spark.createDataFrame([(5, [1.0, 0.0, 0.0, 0.0]), (6, [1.0]), (7, [])], "id bigint, v array<float>")  # other lengths drop out, the rest stays
    assert [x.id for x in vector.search(e.unionByName(odd).coalesce(1), e.filter("id = 1"), "id", "v", 2).orderBy("rank").collect()] == [1, 3]


def test_compatibility(spark):
    info = spark.createDataFrame([(1, "m", 2, "t")], "id int, model_name string, embedding_dim int, created_at string")
    vectors = lambda *ls: vector.stored_dimensions(spark.createDataFrame([("x", [0.0] * n) for n in ls] + [("n", None)], "chunk_id string, embedding array<float>"))
    fits = lambda i, v, m, d: tuple(vector.compatibility(i, v, m, d).first())
    assert fits(info.limit(0), vectors(), "m", 2) == (True, None, None)
    assert fits(info, vectors(2, 2), "m", 2) == (True, "m", 2) and fits(info, vectors(2), "other", 2) == (False, "m", 2)
    assert fits(info, vectors(2, 3, 3), "m", 2) == (False, "m", 3) and fits(info, vectors(), "m", 4) == (False, "m", 2)


def test_enrich(spark):
    def failing(text, strategy):
        if text == "bad":
            raise ValueError
        return text.upper() + strategy

    d = spark.createDataFrame([(1, "ok", "pptx"), (2, "bad", "md"), (3, None, None)], "id int, t string, f string")
    got = {r.id: (r.enriched_text, r.changed) for r in enrich.enrich(d, "t", "f", failing).collect()}
    assert got == {1: ("OKslides", True), 2: ("bad", False), 3: (None, False)}


@pytest.mark.parametrize("name", ["c3_sentence_split", "md_sections", "meta_domain", "i5_merge", "v5_search"])
def test_registered_queries_equal_their_sql(spark, name):
    from oracle_check import compare, connect

    import __spark_entry__ as entry

    sf = "/root/testdata/sf0.001"
    assert compare(spark, connect(sf), name, entry.queries()[name], entry.oracle_sql()[name], sf) == ""
