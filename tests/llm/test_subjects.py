from pyspark.sql import functions as F

from loomspark.llm import subjects

AREAS = {"law": ["court", "statute", "appeal", "tenant"], "sport": ["goalkeeper", "league", "referee", "coach"], "web": ["browser", "stylesheet", "cookie", "viewport"]}
SCHEMA = "chunk_id string, source_file string, chunk_text string, chunk_type string, domain string, language string"


def table(spark):
    rows = []
    for i in range(120):
        for j, (a, words) in enumerate(AREAS.items()):
            label = a if i % 6 else ["sport", "web", "law"][j]  # a sixth is wrong
            text = " ".join(f"The {words[(i + k) % 4]} {v} the {words[(i + 3 * k + 1) % 4]}." for k, v in enumerate(["supports", "limits", "explains"]))
            rows.append((f"{a}{i}", f"f{a}{i // 4}", text, "paragraph", label if i % 5 else None, "en"))
    return rows


def run(spark, extra=(), labels=()):
    d = spark.createDataFrame(table(spark) + list(extra), SCHEMA).withColumn("t", F.lit("clash")).withColumn("area", F.lit(0))
    l = spark.createDataFrame(list(labels), "source_file string, area string, annotator string")
    a = spark.createDataFrame([(x, "") for x in AREAS] + [(None, None), ("law", "")], "area string, description string")
    return subjects.chunk_subjects(d, l, a)


def test_main_subjects_and_files(spark):
    mixed = [(f"m{k}", "mixed", t, "list", None, None) for k, t in enumerate(["The court limits the statute.", "The appeal supports the tenant.", "The cookie limits the browser."])]
    s = run(spark, [*mixed, ("none", "nofile", "!", "header", None, None), *mixed[:1]], [("flaw1", "law", "x"), ("flaw1", "law", "x"), ("fweb1", "sport", "y")]).cache()
    one = s.filter("chunk_id rlike '^(law|sport|web)'").select("chunk_id", "area").distinct().collect()
    assert sum(r.chunk_id.startswith(r.area) for r in one) >= 0.99 * len(one)
    assert {(r.source_file, r.area) for r in subjects.file_subjects(s).filter("source_file = 'mixed'").collect()} == {("mixed", "law"), ("mixed", "web")}
    shares = subjects.corpus_shares(s).collect()
    assert abs(sum(r.share for r in shares) - 1) < 1e-9 and sum(r.n_chunks for r in shares) == 364
    assert all(0 <= r.probability <= 1 and r.area in AREAS for r in s.collect())


def test_without_labels_or_rows(spark):
    bare = spark.createDataFrame([("a", "f", "some text", "paragraph", None, None), ("b", "f", "x" * 200_000, None, None, None)], SCHEMA)
    none = spark.createDataFrame([], "source_file string, area string, annotator string")
    areas = spark.createDataFrame([("law", ""), ("web", "")], "area string, description string")
    assert {r.area for r in subjects.chunk_subjects(bare, none, areas).collect()} <= {"law", "web"}
    assert subjects.chunk_subjects(bare.limit(0), none, areas).count() == 0
    assert subjects.chunk_subjects(bare, none, areas.limit(0)).count() == 0
