from loomspark.llm import mojibake

SCHEMA = "doc_id bigint, text string"
SOUND = ["Die Prüfung läuft über Nacht und schließt früh.", "L’été dernier, la réponse était très différente.", "La función también añade un número.", "한국어 문장은 이렇게 끝난다.", "It’s “fine” — really.", "Não é difícil, são só três seções."]


def docs(spark, extra):
    rows = [(i, "\n\n".join(SOUND[(i + k) % len(SOUND)] for k in range(4)) + f"\n\nNr {i}.") for i in range(240)]
    return spark.createDataFrame(rows + extra, SCHEMA).selectExpr("*", "1 as restored", "2 as spans")


def test_damage_is_found_and_taken_back(spark):
    names = [p[0] for p in mojibake.PAIRS]
    text = "\n\n".join(SOUND[:3] + SOUND[4:])
    extra = [(1000 + k, mojibake.garble(text, names.index(n))) for k, n in enumerate(("utf8-as-cp1252", "utf8-as-mac", "utf8-as-cp1252-twice", "utf8-as-cp437"))]
    extra += [(1010, mojibake.garble(SOUND[3], names.index("cp949-as-cp1252")))]
    extra += [(1020, SOUND[0] + "\n\n" + mojibake.garble(SOUND[1], names.index("utf8-as-latin1")) + "\n\n" + SOUND[2])]
    sound = [(2000, "Signs such as `fÃ¼r` point to a wrong table."), (2001, ""), (2002, None), (2003, "plain ascii " * 9000), (2004, SOUND[0] * 2000), (2005, "# 요약\n\n특징 벡터는 첫 시도다.")]
    got = {r.doc_id: r for r in mojibake.find_damage(docs(spark, extra + sound)).collect()}
    assert set(got) == {i for i, _ in extra}
    assert all(got[1000 + k].restored == text for k in range(4)) and got[1010].restored == SOUND[3]
    assert got[1020].restored == "\n\n".join(SOUND[:3]) and got[1020].n_left == 0


def test_lost_signs_stay(spark):
    bad = mojibake.garble(SOUND[0] + " " + SOUND[2], [p[0] for p in mojibake.PAIRS].index("cp1252-as-utf8"))
    got = mojibake.find_damage(docs(spark, [(1, bad), (3000, bad)]).filter("doc_id <> 1")).collect()
    assert [r.doc_id for r in got] == [3000] and got[0].n_left >= 1


def test_round_trips():
    for k, (name, true, _, _) in enumerate(mojibake.PAIRS):
        for s in SOUND:
            g = mojibake.garble(s, k)
            if g is not None and "�" not in g and mojibake.restore(g, k) is not None:
                assert mojibake.restore(g, k) == s, (name, s)


def test_empty(spark):
    assert mojibake.find_damage(spark.createDataFrame([], SCHEMA)).count() == 0


def test_accents_read_as_hangul_are_found(spark):
    """Recall for each pair on accented Latin texts, those that a pair leaves as they are or can't write left out."""
    latin = "\n\n".join(s for s in SOUND if not any("가" <= c <= "힣" for c in s) and "’" not in s)
    extra = [(5000 + k, g) for k in range(len(mojibake.PAIRS)) if (g := mojibake.garble(latin, k)) not in (None, latin)]
    got = {r.doc_id for r in mojibake.find_damage(docs(spark, extra)).collect()}
    missed = [mojibake.PAIRS[i - 5000][0] for i, _ in extra if i not in got]
    assert "utf8-as-cp949" not in missed and len(missed) <= 1, missed
    assert not [i for i in got if i < 5000]


def test_fit_takes_stretches_of_long_texts(spark):
    long = [(7000 + k, (SOUND[k % 3] + " ") * 3000) for k in range(6)]
    a = mojibake.fit_on(docs(spark, long), "doc_id", "text", 400, 500)
    assert set(a) == {"common", "tables", "plain"}


def test_fit_counts_every_text_whole(spark):
    """A sign that stands only at the far end of one long text is known to the model, which equals the one of all texts at once."""
    bad = mojibake.garble(SOUND[0] + " " + SOUND[2], 0)
    far = [(8000, "plain ascii " * 9000 + "\nThe knot \u01ff\u01fd holds.\n`caf\u00c3\u00a9`"), (8001, bad), (8002, None), (8003, "\n".join(SOUND) + "\n" + bad)]
    d = docs(spark, far)
    got = mojibake.fit_on(d, "doc_id", "text")
    assert got == mojibake.fit([r.text for r in d.collect() if r.text])
    assert ("\u01ff", "\u01fd") in got["tables"][mojibake.CLEAN][0]
    assert ("\u00c3", "\u00a9") not in got["tables"][mojibake.CLEAN][0]
