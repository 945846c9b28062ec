import random

from loomspark.llm import nearcopies

SCHEMA = "chunk_id string, chunk_text string"


def brute(texts, threshold, shingle, least):
    sets = {}
    for i, t in texts.items():
        w = nearcopies._WORD.findall((t or "").lower())
        if len(w) >= max(least, shingle):
            sets[i] = {tuple(w[k : k + shingle]) for k in range(len(w) - shingle + 1)}
    ids = sorted(sets)
    return {(a, b) for x, a in enumerate(ids) for b in ids[x + 1 :] if len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= threshold}


def corpus(n=150, seed=3):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    texts = {}
    for i in range(n):
        base = [rng.choice(words) for _ in range(rng.randint(30, 90))]
        texts[f"t{i:04d}"] = " ".join(base)
        for j in range(rng.choice([0, 0, 1, 2])):
            copy = list(base)
            for _ in range(rng.randint(0, 8)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            texts[f"t{i:04d}c{j}"] = ", ".join(copy)
    return texts


def test_pairs_equal_brute_force(spark):
    texts = corpus() | {"e": "", "n": None, "short": "one two", "same1": "a b c d e f g h " * 5, "same2": "A b, c d e f g h " * 5}
    d = spark.createDataFrame(list(texts.items()) + [("t0000", texts["t0000"])], SCHEMA)
    members, pairs = nearcopies.near_copies(d, "chunk_id", "chunk_text", 0.6, 3, 25)
    got = nearcopies.copy_pairs(members, pairs, "chunk_id").collect()
    assert len(got) == len(set(got))
    want = brute(texts, 0.6, 3, 25)
    assert {tuple(r) for r in got} - want == set()
    assert len({tuple(r) for r in got} & want) >= 0.99 * len(want)


def test_recursion_splits_large_buckets(spark):
    texts = corpus(120, 5)
    d = spark.createDataFrame(list(texts.items()), SCHEMA)
    sets = nearcopies.shingled(d, "chunk_id", "chunk_text", 3, 25).cache()
    ids = {r.cls: r._id for r in sets.collect()}
    for depth in (1, 6):  # with one level the large buckets are compared in blocks
        got = {tuple(sorted((ids[r.a], ids[r.b]))) for r in nearcopies.class_pairs(sets, 0.6, bucket_limit=3, max_depth=depth).collect()}
        want = {p for p in brute(texts, 0.6, 3, 25) if p[0] in ids.values() and p[1] in ids.values()}
        assert got <= want and len(got) >= 0.97 * len(want)


def test_groups_and_hot_copies(spark):
    chain = [" ".join(f"v{k + s}" for k in range(60)) for s in range(0, 60, 6)]  # each near the next, the ends far apart
    rows = [(f"c{i}", t) for i, t in enumerate(chain)] + [(f"h{i:03d}", "x " + " ".join(f"q{k}" for k in range(40))) for i in range(200)]
    d = spark.createDataFrame(rows, SCHEMA)
    g = nearcopies.copy_groups(*nearcopies.near_copies(d, "chunk_id", "chunk_text", 0.6, 3, 25), "chunk_id").collect()
    assert len(g) == 210 and len({r.group_id for r in g}) == 2 and len({r.class_id for r in g if r.chunk_id[0] == "h"}) == 1


def test_empty(spark):
    members, pairs = nearcopies.near_copies(spark.createDataFrame([], SCHEMA), "chunk_id", "chunk_text")
    assert members.count() == 0 and pairs.count() == 0


def test_hot_group_with_own_edits(spark):
    rng = random.Random(11)
    base = [f"b{i}" for i in range(60)]
    texts = {}
    for i in range(1200):  # every copy has three words of its own: the shared tokens are frequent, the own ones rare
        copy = list(base)
        for at in rng.sample(range(60), 3):
            copy[at] = f"own{i}at{at}"
        texts[f"t{i:04d}"] = " ".join(copy)
    rows = list(texts.items()) + list(texts.items())[::2]  # some delivered twice, so own edits are counted twice
    d = spark.createDataFrame(rows, SCHEMA)
    got = {tuple(r) for r in nearcopies.copy_pairs(*nearcopies.near_copies(d, "chunk_id", "chunk_text", 0.6, 3, 25, bucket_limit=50), "chunk_id").collect()}
    held = {}
    for i, t in texts.items():
        w = t.split()
        held[i] = sum(1 << k for k in range(58) if all(w[k + j] == base[k + j] for j in range(3)))
    ids = sorted(held)
    want = set()
    for x, a in enumerate(ids):
        for b in ids[x + 1 :]:
            common = (held[a] & held[b]).bit_count()
            if common / (116 - common) >= 0.6:
                want.add((a, b))
    assert len(want) > 100_000 and got <= want and len(got) >= 0.995 * len(want)


def test_runs_are_repeated_until_the_target(spark):
    texts = corpus(150, 7)
    d = spark.createDataFrame(list(texts.items()), SCHEMA)
    sets = nearcopies.shingled(d, "chunk_id", "chunk_text", 3, 25, 1).cache()
    ids = {r.cls: r._id for r in sets.collect()}
    want = {p for p in brute(texts, 0.6, 3, 25) if p[0] in ids.values() and p[1] in ids.values()}
    got = nearcopies.class_pairs(sets, 0.6, 0.99, first_runs=1, more_runs=1).collect()  # one run finds about J of the pairs
    pairs = {tuple(sorted((ids[r.a], ids[r.b]))) for r in got}
    assert max(r.runs for r in got) >= 3 and len(got) == len(pairs) and len(pairs & want) >= 0.97 * len(want)
    assert nearcopies.runs_for(0.6, 0.999) == 8 and nearcopies.runs_for(0.8, 0.999) < 8


def test_copies_of_one_text_go_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(nearcopies, "BLOCK", 7)
    members = spark.createDataFrame([(f"m{i:02d}", 1) for i in range(40)] + [("n0", 2), ("n1", 3)], "chunk_id string, cls bigint")
    pairs = spark.createDataFrame([(1, 2, 0.9)], "a bigint, b bigint, similarity double")
    got = [tuple(r) for r in nearcopies.copy_pairs(members, pairs, "chunk_id").collect()]
    assert len(got) == len(set(got)) == 40 * 39 // 2 + 40 and all(a < b for a, b in got)


def test_sketches_equal_their_definition():
    import numpy as np

    rng = np.random.default_rng(3)
    sizes = [1, 7, 300, 2, 70_000]
    tokens = rng.integers(0, 1 << 32, sum(sizes), dtype=np.uint64).astype(np.uint32)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    got = nearcopies._sketches(tokens, starts)
    for k, salt in enumerate((0x1234567, 0x89ABCDE, 0x2F0E1EB9, 0x6A09E667)):
        for i in range(len(sizes)):
            t = tokens[starts[i] : starts[i + 1]].astype(np.uint64)
            bits = np.unpackbits(nearcopies._mix(t * nearcopies._B + np.uint64(salt)).view(np.uint8).reshape(-1, 8), axis=1)
            assert got[k][i] == np.packbits(2 * bits.sum(0, dtype=np.int64) >= len(t)).view(np.int64)[0]
