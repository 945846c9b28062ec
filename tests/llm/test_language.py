from pyspark.sql import functions as F

from loomspark.llm import language

EN = "The parser reads the file before anyone notices. "
DE = "Der Parser liest die Datei, bevor es jemand bemerkt. "
FR = "La fonction lit le fichier avant que quelqu’un ne le remarque. "
KO = "파서는 파일을 읽고 나서 결과를 기록한다. "


def rows(spark):
    data = []
    for i in range(40):
        for lang, s in (("en", EN), ("de", DE), ("fr", FR), ("ko", KO)):
            data.append((f"{lang}{i}", s * (1 + i % 3) + f"Nr {i}.", lang))
    return data


SCHEMA = "chunk_id string, chunk_text string, language string"


def test_wrong_missing_and_mixed(spark):
    extra = [
        ("wrong", EN * 2, "de"), ("missing", DE * 2, None), ("unknown", FR, "n/a"), ("spelled", EN, "English"), ("mixed", EN + "\n\n" + KO, "en"), ("empty", "", "en"),
        ("null", None, "en"), ("code", "```\nfoo bar\n```", "de"), ("long", EN * 3000, "fr"), ("wrong", EN * 2, "de"),
    ]
    d = spark.createDataFrame(rows(spark) + extra, SCHEMA).withColumn("label", F.lit("clash")).withColumn("segments", F.lit(1))
    found = language.detect_segments(d)
    got = {(r.chunk_id, r.lang_code) for r in language.wrong_labels(found).collect()}
    assert got == {("wrong", "en"), ("missing", "de"), ("unknown", "fr"), ("mixed", "en"), ("mixed", "ko"), ("long", "en")}
    r = {x.chunk_id: x for x in found.collect()}
    assert [s.language for s in r["mixed"].segments] == ["en", "ko"] and all(0 <= s.confidence <= 1 for s in r["mixed"].segments)
    assert r["null"].language is None and r["empty"].segments == [] and r["code"].confidence == 0.0


def test_empty_table(spark):
    assert language.wrong_labels(language.detect_segments(spark.createDataFrame([], SCHEMA))).count() == 0


def test_kernel_equals_brute_force():
    a, b = ["abcab", "xyz"], ["abc", "bca zzz"]
    grams = lambda t: {t[i : i + n] for n in language.ORDERS for i in range(len(t) - n + 1)}
    k = language._kernel(language.presence(a), language.presence(b), 2, 2)
    for i, s in enumerate(a):
        for j, t in enumerate(b):
            assert abs(k[i, j] - len(grams(s) & grams(t)) / (len(grams(s)) * len(grams(t))) ** 0.5) < 1e-6


def test_held_out_accuracy(spark):
    from loomspark.llm.queries import prose

    d = prose(spark, "/root/testdata/sf0.01").filter(language.normalised_label(F.col("language")).isin("de", "fr", "es", "ko"))
    split = F.pmod(F.xxhash64("source_file"), F.lit(2))
    model = language.fit_on(d.filter(split == 0), "chunk_id", "chunk_text", "language", 100)
    r = language.detect_segments(d.filter(split == 1), model=model).filter(F.size("whole_languages") == 1)
    assert r.filter(F.col("label") == F.col("language")).count() > 0.93 * r.count()  # the labels themselves hold a few errors


def test_short_sentences_count(spark):
    extra = [("ko-short", "네. 맞다. 좋다.", None), ("fr-short", "Oui. Non. Si la fin.", None), ("tail", DE + "Ja. " + DE, "de")]
    r = {x.chunk_id: x for x in language.detect_segments(spark.createDataFrame(rows(spark) + extra, SCHEMA)).collect()}
    assert r["ko-short"].language == "ko" and r["fr-short"].segments[0].text == "Oui. Non. Si la fin."
    assert [s.language for s in r["tail"].segments] == ["de"] and "Ja." in r["tail"].segments[0].text


def test_no_landmark_gram_is_lost():
    import numpy as np

    same_slot = np.uint64(1 << language.KernelModel.BITS)
    who, keys, size = language.presence(["abcdef"])
    grams = np.concatenate([keys ^ same_slot, keys, keys ^ (same_slot << np.uint64(1))])
    weights = np.concatenate([np.full(len(keys), 5.0), np.ones(len(keys)), np.full(len(keys), 7.0)])[:, None]
    assert abs(language.KernelModel(grams, weights, 1.0).scores(["abcdef"])[0, 0] - len(keys) / len(keys) ** 0.5) < 1e-6
