from loomspark.llm import scanned

SCHEMA = "chunk_id string, source_file string, chunk_text string, section_path array<string>, heading_text string"
CLEAN = "The container image depends on the older alert rule before anyone notices the gap. The long-standing habits change slowly. We asked about the network."


def table(spark, extra=()):
    rows = [(f"k{i}", f"clean{i % 9}.md", "## Title\n\n" + CLEAN, ["Doc – Name", "Title"], "Title") for i in range(60)]
    page = (
        "Title\n\nThe contai-\nner image depends on the older alcrt rule be-\n\n   Velbase · 2013\n        - 17 -\n\nfore anyone notices the gap. The long-\nstanding habits change s1owly.\n\n"
        "VELBASE · 2013    18\nWe askecl about the netvvork.\nxix"
    )
    return spark.createDataFrame([*rows, ("s1", "scan1.md", page, ["Known problems – Velbase", "Title"], "Title"), *extra], SCHEMA)


def test_damage_and_text(spark):
    slip = ("k99", "clean1.md", "## Title\n\nThe contaiher image and the alcrt rule.", ["Doc – Name", "Title"], "Title")
    dirty = [("e", "scan1.md", "", [], None), ("n", None, None, None, None), ("nn", None, "We asked 5ome-\none about it.", None, None), ("s2", "scan1.md", "word " * 30_000 + "net-\nwork", [], None)]
    damage, texts = scanned.scanned_repair(table(spark, [slip, *dirty, *dirty[3:]]))
    got = {(r.noise_type, r.fixed_text) for r in damage.filter("chunk_id = 's1'").collect()}
    assert got == {
        ("hyphen", "container"), ("hyphen", "before"), ("hyphen", "long-standing"), ("char", "alert"), ("char", "slowly"), ("char", "asked"), ("char", "network"),
        ("header", "Velbase · 2013"), ("header", "VELBASE · 2013    18"), ("page", "- 17 -"), ("page", "xix"),
    }
    assert damage.filter("chunk_id like 'k%'").count() == 0 and [r.fixed_text for r in damage.filter("chunk_id = 's2'").collect()] == ["network"]
    text = texts.filter("chunk_id = 's1'").first().repaired
    assert text == "Title\n\nThe container image depends on the older alert rule before anyone notices the gap. The long-standing habits change slowly.\n\nWe asked about the network."


def test_empty(spark):
    damage, texts = scanned.scanned_repair(spark.createDataFrame([], SCHEMA))
    assert damage.count() == 0 and texts.count() == 0


def test_a_heading_mark_does_not_hide_a_scanned_file(spark):
    base = table(spark, [(f"x{i}", "scan1.md", "Some alcrt rule be-\nfore the gap.\n- 18 -\nWe asked about the network.", ["D – N"], None) for i in range(3)])
    want = {tuple(r) for r in scanned.scanned_repair(base)[0].collect()}
    marked = base.selectExpr("chunk_id", "source_file", "if(chunk_id = 'x1', concat('# Heading\n', chunk_text), chunk_text) as chunk_text", "section_path", "heading_text")
    assert want == {tuple(r) for r in scanned.scanned_repair(marked)[0].collect()} and len(want) > 15


def test_long_and_heavily_damaged_words(spark):
    long = "Verfahrensdokumentationsanforderungsbeschreibungen" * 2
    seen = [(f"l{i}", f"clean{i % 9}.md", "## T\n\nDie " + long + " und Donaudampfschifffahrt.", ["D", "T"], "T") for i in range(70)]
    bad = long.replace("n", "ri", 1).replace("d", "cl", 1).replace("s", "5", 3)
    page = [("s5", "scan1.md", f"The {bad} here.\nAll Donau-\n\n- 3 -\n\ndarnpfschifffahrt be-\nfore.", ["D – N"], None)]
    got = {(r.noise_type, r.fixed_text) for r in scanned.scanned_repair(table(spark, seen + page))[0].filter("chunk_id = 's5'").collect()}
    assert ("char", long) in got and ("hyphen", "Donaudampfschifffahrt") in got and ("hyphen", "before") in got


def test_readings_equal_brute_force():
    """Every way to set at most two places right, against the check character by character."""
    for word in ("askecl", "netvvork", "darnpf", "5ome", "lii", "1n"):
        found = {word: 0}
        for cost in (1, 2):
            for w, c in list(found.items()):
                if c == cost - 1:
                    for wrong, right in scanned.MISREAD:
                        at = w.find(wrong)
                        while at >= 0:
                            if at == 0 or not right.isupper():
                                found.setdefault(w[:at] + right + w[at + len(wrong) :], cost)
                            at = w.find(wrong, at + 1)
        ones = [r for r, c in found.items() if c == 1]
        assert all(scanned.misreads(word, r, False) == 1 for r in ones), word
        assert all(scanned.misreads(word, r, False) in (1, 2, None) for r, c in found.items() if c == 2)
    assert scanned.misreads("5ome", "some", True) is None and scanned.misreads("5ome", "Some", True) == 1 and scanned.misreads("abc", "abd", False) is None
