import random

from loomspark.llm import packing

DOCS = "doc_id bigint, text string, source string"
TARGETS = "target_id int, tokenizer_name string, capacity_tokens int"


def test_all_tokens_are_packed_once(spark):
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choice(["alpha", "beta", "gamma"]) for _ in range(rng.choice([1, 5, 40, 90, 300]))), rng.choice(["hot", "hot", "hot", "b", None])) for i in range(400)]
    rows += [(1000, "", "b"), (1001, None, None), (1002, "word " * 3000, "b")]
    d = spark.createDataFrame(rows, DOCS).selectExpr("*", "0 as size", "0 as win")
    t = spark.createDataFrame([(1, "byte_bpe_50k", 100), (2, "piece_bpe_32k", 250), (2, "piece_bpe_32k", 250), (3, None, 5)], TARGETS)
    out = packing.pack(d, t, bins_per_window=8, block_rows=50).toPandas()
    count = {1: packing.token_counter("byte_bpe_50k"), 2: packing.token_counter("piece_bpe_32k")}
    for k, cap in ((1, 100), (2, 250)):
        g = out[out.target_id == k]
        want = {i: count[k](x) for i, x, _ in rows if x}
        assert g.groupby("doc_id").n_tokens.sum().to_dict() == {i: n for i, n in want.items() if n}
        assert g.groupby("container_id").n_tokens.sum().max() <= cap
        pieces = g.groupby("doc_id").size()
        assert all(pieces[i] == -(-n // cap) for i, n in want.items() if n)
        assert g.container_id.nunique() <= 1.15 * g.n_tokens.sum() / cap + 2
    assert set(out.target_id) == {1, 2}


def test_windows_keep_the_proportions(spark):
    rows = [(i, "token " * 20, "a" if i % 4 else "b") for i in range(2000)]
    t = spark.createDataFrame([(1, "byte_bpe_50k", 400)], TARGETS)
    out = packing.pack(spark.createDataFrame(rows, DOCS), t, bins_per_window=10, block_rows=100).toPandas()
    out["win"] = out.container_id.str.split("-").str[0]
    share = out.assign(b=out.doc_id % 4 == 0).groupby("win").b.mean()
    assert share.between(0.2, 0.3).mean() > 0.9  # the target is a quarter; the last window holds what is left


def test_windows_keep_a_mixture_unlike_the_corpus(spark):
    rows = [(i, "token " * 20, "a" if i % 10 else "b") for i in range(4000)] + [(9000, None, "b"), (9001, "", "c")]
    t = spark.createDataFrame([(1, "byte_bpe_50k", 400)], TARGETS)
    d = spark.createDataFrame(rows, DOCS)
    r = packing.window_report(d, t, {"a": 1.0, "b": 1.0}, bins_per_window=10, block_rows=100).orderBy("win").toPandas()
    both = r[r.n_sources == 2]
    assert len(both) >= 3 and both.share_error.iloc[:-1].max() < 0.05  # half and half while both queues serve
    assert r.fill.mean() > 0.9 and r.n_items.sum() == 4000 and (r[r.n_sources == 1].share_error >= 0.49).all()
    assert packing.window_report(d.limit(0), t, {"a": 1.0}).count() == 0


def test_word_counts_add_up():
    import public_tokenizers
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    count = packing.piece_counter("piece_bpe_32k")
    for t in ["a", " a", "a  b   c", "x\n\n y\t z ", "   ", "한국어 문장 🚀 ok", "▁ sign ▁▁x", "end "]:
        assert count(t) == len(sp.encode(t)), t


def test_empty(spark):
    t = spark.createDataFrame([(1, "byte_bpe_50k", 100)], TARGETS)
    assert packing.pack(spark.createDataFrame([], DOCS), t).count() == 0
    assert packing.pack(spark.createDataFrame([(1, "x", "a")], DOCS), t.limit(0)).count() == 0


def test_too_many_targets_are_an_error(spark):
    d = spark.createDataFrame([(1, "alpha", "a")], DOCS)
    t = spark.range(1001).selectExpr("cast(id as int) as target_id", "'byte_bpe_50k' as tokenizer_name", "10 as capacity_tokens")
    try:
        packing.pack(d, t)
    except ValueError as e:
        assert "pack targets" in str(e)
    else:
        raise AssertionError("targets were dropped")
