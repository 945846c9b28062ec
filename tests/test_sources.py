"""File sources, sinks, streaming and the command line on temporary folders."""

from pyspark.sql import functions as F

from loomspark import cli
from loomspark.operators import metadata, store
from loomspark.session import spread
from loomspark.sources import files, html
from loomspark.streaming.incremental import sync_folder, watch_folder


def test_read_documents(spark, tmp_path):
    (tmp_path / "sub dir").mkdir()
    (tmp_path / "a.MD").write_bytes(b"# A\r\n\r\nx")
    (tmp_path / "sub dir" / "b.txt").write_text("plain")
    (tmp_path / "c.bin").write_text("no")
    deep = tmp_path / "1/2/3/4/5/6"
    deep.mkdir(parents=True)
    (deep / "z.md").write_text("too deep")
    got = {r.source_file: (r.source_format, r.content) for r in files.read_documents(spark, str(tmp_path)).collect()}
    assert got == {"a.MD": ("markdown", "# A\n\nx"), "sub dir/b.txt": ("plaintext", "plain")}


def test_listing_keeps_empty_files_and_passes_over_links(spark, tmp_path):
    import os

    (tmp_path / "sub").mkdir()
    (tmp_path / "a.md").write_text("x")
    (tmp_path / "empty.md").write_bytes(b"")
    (tmp_path / "sub" / "bad.md").write_bytes(b"\xff\xfe")
    os.symlink(tmp_path / "a.md", tmp_path / "link.md")
    os.symlink(tmp_path / "sub", tmp_path / "linked")
    got = {r.source_file: (r.content, r.error and r.error.split(":")[0]) for r in files.read_documents(spark, str(tmp_path)).collect()}
    assert got == {"a.md": ("x", None), "empty.md": ("", None), "sub/bad.md": (None, "UnicodeDecodeError")}
    missing = files.list_files(spark, str(tmp_path / "none")).collect()
    assert len(missing) == 1 and missing[0].error.startswith("FileNotFoundError")


def test_front_matter_round_trip(spark):
    d = spark.createDataFrame([("T: x", ["a", 'b "c", d'], "Body\n"), ("", [], "---\nno")], "title string, keywords array<string>, body string")
    text = F.concat(files.render_front_matter(("keywords",), title=F.col("title"), keywords=F.col("keywords")), F.col("body"))
    front, body = files.split_front_matter(text)
    rows = d.select(files.front_matter_value(front, "title").alias("t"), files.front_matter_list(front, "keywords").alias("k"), body.alias("b")).collect()
    assert [tuple(r) for r in rows] == [("T: x", ["a", 'b "c", d'], "Body"), ("", [], "---\nno")]
    yaml = ["---\nk:\n- x\n- 'it''s'\n---\nB", "---\nk: [a, \"b, c\"]\n---\nB", "---\nk: one\n---\nB", "---\nno key here\n---\nB", "---\n---\nB", "plain", None]
    y = spark.createDataFrame(list(enumerate(yaml)), "i int, c string")
    front, body = files.split_front_matter(F.col("c"))
    got = [tuple(r) for r in y.select(files.front_matter_list(front, "k").alias("k"), body.alias("b")).collect()]
    assert got == [(["x", "it's"], "B"), (["a", "b, c"], "B"), (["one"], "B"), ([], yaml[3]), ([], "B"), ([], "plain"), (None, None)]


def test_prepared_files(spark, tmp_path):
    d = spark.createDataFrame([("a/b.md", "x"), ("c.md", None)], "path string, text string")
    assert [r.error for r in files.write_prepared(d, str(tmp_path)).collect()] == [None, None]
    assert (tmp_path / "a/b.md").read_text() == "x" and (tmp_path / "c.md").read_text() == ""


def test_structured(spark):
    from loomspark.sources import structured

    assert structured.csv_to_markdown('a,b\n1,"x | y"\n\n2\n') == "| a | b |\n| --- | --- |\n| 1 | x \\| y |\n| 2 |  |"
    assert structured.json_to_markdown('[{"a": 1}, {"b": [2], "a": null}]') == "| a | b |\n| --- | --- |\n| 1 |  |\n|  | [2] |"
    assert structured.xml_to_markdown('<r x="1">t<c>u</c>v</r>') == "- **r**: x=1 t\n  - **c**: u\n  - v"
    rows = [(1, "csv", ""), (2, "json", "{"), (3, "md", "# x"), (4, None, None), (5, "py", "x = 1\n"), (6, "ipynb", '{"cells": [{"cell_type": "markdown", "source": ["# T"]}, {"cell_type": "code", "source": "x"}]}')]
    got = {r.i: (r.content, r.error and r.error.split(":")[0]) for r in structured.to_markdown(spark.createDataFrame(rows, "i int, source_format string, content string")).collect()}
    assert got == {1: ("", None), 2: (None, "JSONDecodeError"), 3: ("# x", None), 4: (None, None), 5: ("```python\nx = 1\n```", None), 6: ("# T\n\n```\nx\n```", None)}


def test_everything(spark, tmp_path):
    from loomspark.sources.everything import read_everything

    for name, data in (("a.md", "# A"), ("b.html", "<p>B</p>"), ("c.csv", "k\nv"), ("d.pdf", "one\ntwo"), ("e.xyz", "?"), ("f.json", "{")):
        (tmp_path / name).write_text(data)
    got = {r.source_file: (r.source_format, r.content) for r in read_everything(spark, str(tmp_path), {"pdf": bytes.decode}).collect()}
    assert got == {"a.md": ("markdown", "# A"), "b.html": ("html", "B"), "c.csv": ("csv", "| k |\n| --- |\n| v |"), "d.pdf": ("pdf", "one two"), "f.json": ("json", None)}


def test_html(spark):
    page = '<html><head><title>t</title></head><body><h1>Head</h1><p>One <b>two</b> <a href="u">l</a></p><ul><li>x</li><li>y</li></ul>a &lt; b<br>c</body></html>'
    assert spark.range(1).select(html.to_markdown(F.lit(page)).alias("m")).first().m == "# Head\n\nOne **two** [l](u)\n\n- x\n- y\n\na < b\nc"


def test_html_keeps_headers_tables_and_code(spark):
    page = (
        "<!doctype html><html><head><style>x</style></head><body><header>Site</header><p class=a>Kept?</p><table><thead><tr><th>a</th> <th>b</th></tr></thead>"
        "<tbody><tr><td>1</td><td>2</td></tr>\n<tr><td>3</td></tr></tbody></table><script>var x = '<p>';</script><pre><code>def f():\n    return 1 &lt; 2</code></pre>"
        "<p>caf&eacute; &#8364; &#x1F600; &amp;lt; &unknown;</p><ul><li>x<li>y</ul><link rel=x><i>it</i> <code>c</code><br/>end</body></html>"
    )
    want = "Site\n\nKept?\n\n| a | b |\n| --- | --- |\n| 1 | 2 |\n| 3 |  |\n\n```\ndef f():\n    return 1 < 2\n```\n\ncafé € 😀 &lt; &unknown;\n\n- x\n- y\n\n*it* `c`\nend"
    d = spark.createDataFrame([(page,), (None,), ("",)], "h string")
    assert [r.m for r in d.select(html.to_markdown(F.col("h")).alias("m")).collect()] == [want, None, ""]


def test_command_line(spark, tmp_path, capsys):
    src, out, vectors, prepared = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "vectors"), tmp_path / "prepared"
    (src / "sub").mkdir(parents=True)
    (src / "a.md").write_text("# A\n\ntext about docker")
    (src / "empty.md").write_text("")
    (src / "sub" / "bad.md").write_bytes(b"\xff")

    def run(*args, now="t1"):
        assert cli.main(["--master", "local[4]", "--now", now, *map(str, args)]) == 0
        return capsys.readouterr().out

    assert "'changed': 2, 'failed': 1, 'added': 2" in run("run", "--buckets", 2, src, out)
    rows = {r.source_file: (r.chunk_text, r.chunk_type, r.domain, r.version, r.created_at) for r in store.read_chunks(spark, out).collect()}
    assert rows == {"a.md": ("# A\n\ntext about docker", "header", "devops", 1, "t1"), "empty.md": ("", "document", "general", 1, "t1")}
    (src / "a.md").write_text("# A\n\ntext about docker\n\n# B\n\nmore")
    assert "'changed': 1, 'failed': 1, 'added': 1, 'updated': 0, 'unchanged': 1" in run("run", "--buckets", 2, src, out, now="t2")
    assert "'changed': 0" in run("run", "--buckets", 2, src, out, now="t3")
    rows = {(r.source_file, r.chunk_index): (r.version, r.created_at, r.updated_at) for r in store.read_chunks(spark, out).collect()}
    assert rows == {("a.md", 0): (1, "t1", "t2"), ("a.md", 1): (1, "t2", "t2"), ("empty.md", 0): (1, "t1", "t1")}
    assert {(r.source_file, r.version, r.created_at) for r in store.read_manifest(spark, out).collect()} == {("a.md", 2, "t1"), ("empty.md", 1, "t1")}
    assert "sub/bad.md" in run("errors", out) and "Total Chunks**: 3" in run("stats", out) and "a.md" in run("list", out)
    assert "'new_chunks': 3" in run("build", out, vectors) and "'new_chunks': 0, 'skipped_chunks': 3" in run("build", out, vectors)
    assert "text about docker" in run("search", vectors, "docker text", "--top-k", 1) and "No results" in run("search", vectors, "docker", "--domain", "law")
    assert "Chunk not found" in run("get", out, "none") and "'chunk_type': 'header'" in run("get", out, [r.chunk_id for r in store.read_chunks(spark, out).collect() if r.chunk_index == 1][0])
    try:
        cli.main(["--master", "local[4]", "build", out, vectors, "--model", "other"])
    except ValueError as e:
        assert "hashed-words-256" in str(e)
    else:
        raise AssertionError("another model was let in")
    assert "'new_chunks': 3" in run("build", out, vectors, "--model", "other", "--force")
    assert "prepared 2, failed 1" in run("prepare", src, prepared)
    front, body = files.split_front_matter(F.lit((prepared / "a.md").read_text()))
    r = spark.range(1).select(files.front_matter_value(front, "title").alias("t"), files.front_matter_list(front, "keywords").alias("k"), body.alias("b")).first()
    assert (r.t, r.b) == ("A", "# A\n\ntext about docker\n\n# B\n\nmore")


def test_watch_folder(spark, tmp_path):
    src, out, cp = tmp_path / "in", tmp_path / "table", tmp_path / "cp"
    (src / "sub").mkdir(parents=True)
    (src / "a.md").write_text("One. Two.")
    for t, name, text in (("t1", "b.md", "Three."), ("t2", "sub/b.md", "Four.")):
        (src / name).write_text(text)
        watch_folder(spark, str(src), str(out), str(cp), lambda t=t: t, buckets=2).awaitTermination()
    got = {r.source_file: (r.version, r.created_at) for r in store.read_chunks(spark, str(out)).collect()}
    assert got == {"a.md": (1, "t1"), "b.md": (1, "t1"), "sub/b.md": (1, "t2")}
    (src / "a.md").write_text("")
    (src / "b.md").write_text("Changed.")
    counts = sync_folder(spark, str(src), str(out), "t3", buckets=2).first()
    assert (counts.files, counts.changed, counts.updated, counts.added) == (3, 2, 0, 2)
    got = {r.source_file: (r.chunk_text, r.chunk_type) for r in store.read_chunks(spark, str(out)).collect()}
    assert got == {"a.md": ("", "document"), "b.md": ("Changed.", "paragraph"), "sub/b.md": ("Four.", "paragraph")}


def test_extra_metadata(spark):
    d = spark.createDataFrame([("a.md", "md", "# T\n\nx", "own"), ("b.md", "md", "y", None)], "source_file string, source_format string, text string, title string")
    rows = metadata.front_matter(d.withColumn("given", F.col("title")), extra={"title": F.col("given"), "team": F.lit("z")}, now=F.lit("t")).orderBy("source_file").collect()
    assert [(r.title, r.team, r.prepared_at, r.source_format) for r in rows] == [("own", "z", "t", "md"), ("y", "z", "t", "md")]


def test_binary_extractors(spark, tmp_path):
    from loomspark.sources.binary import read_binary

    for name, data in (("a.PDF", b"text"), ("b.pdf", b""), ("c.pdf", b"\xff"), ("d.doc", b"x")):
        (tmp_path / name).write_bytes(data)
    got = {r.source_file: (r.content, r.error and r.error.split(":")[0]) for r in read_binary(spark, str(tmp_path), {"pdf": bytes.decode}).collect()}
    assert got == {"a.PDF": ("text", None), "b.pdf": (None, "empty result"), "c.pdf": (None, "UnicodeDecodeError")}


def test_long_tables_and_blank_lines_between_rows(spark):
    rows = "".join(f"<tr><td>{i}</td>\n <td></td></tr>\n\n" for i in range(3000))
    page = f"<p>a\x03b</p><table>\n<tr><th>n</th><th>m</th><th>o</th></tr>\n{rows}</table><p>after</p><table><tr><td>x</td></tr></table>"
    got = spark.createDataFrame([(page,), (None,), ("",)], "p string").select(html.to_markdown(F.col("p"))).collect()
    assert got[0][0].split("\n") == ["ab", "", "| n | m | o |", "| --- | --- | --- |", *(f"| {i} |  |  |" for i in range(3000)), "", "after", "", "| x |", "| --- |"]
    assert [r[0] for r in got[1:]] == [None, ""]


def test_spread_keeps_rows_and_wide_scans(spark):
    few = spark.range(0, 100, 1, 1)
    wide = spark.range(0, 100, 1, 4 * spark.sparkContext.defaultParallelism)
    assert spread(few).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism or spark.sparkContext.defaultParallelism == 1
    assert sorted(r.id for r in spread(few).collect()) == list(range(100)) and spread(wide) is wide
