import tracemalloc

import numpy as np

from loomspark.llm import neighbors

SCHEMA = "chunk_id string, embedding array<float>"


def brute(ids, x, k, least):
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    s = np.round(u @ u.T, 6)
    out = set()
    for i in range(len(ids)):
        order = [j for j in sorted(range(len(ids)), key=lambda j: (-s[i, j], ids[j])) if j != i][:k]
        out |= {(ids[i], ids[j]) for j in order if s[i, j] >= least}
    return out


def test_recall_and_dirty_rows(spark):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(60, 32))
    x = np.repeat(centres, 12, axis=0) + 0.3 * rng.normal(size=(720, 32))
    x = x.astype(np.float32)
    ids = [f"v{i:04d}" for i in range(720)]
    rows = [(i, [float(f) for f in v]) for i, v in zip(ids, x, strict=True)]
    dirty = [("null", None), ("zero", [0.0] * 32), ("short", [1.0]), ("nan", [float("nan")] * 32), ("inf", [float("inf")] * 32), rows[0]]
    d = spark.createDataFrame(rows + dirty, SCHEMA)
    got = neighbors.nearest(d, k=10).collect()
    want = brute(ids, x.astype(np.float64), 10, 0.8)
    pairs = {(r.chunk_id, r.neighbor) for r in got}
    assert len(pairs) == len(got) and len(pairs & want) >= 0.9 * len(want)
    assert all(r.similarity >= 0.8 and 1 <= r["rank"] <= 10 for r in got)


def test_many_equal_vectors(spark):
    d = spark.createDataFrame([(f"h{i:03d}", [1.0, 2.0, 3.0, 4.0]) for i in range(40)] + [("other", [-1.0, 0.0, 0.0, 0.0])], SCHEMA)
    got = {}
    for r in neighbors.nearest(d, k=3).collect():
        got.setdefault(r.chunk_id, []).append((r["rank"], r.neighbor))
    assert len(got) == 40
    assert [n for _, n in sorted(got["h039"])] == ["h000", "h001", "h002"] and [n for _, n in sorted(got["h001"])] == ["h000", "h002", "h003"]


def test_blocks_give_the_same(spark):
    rng = np.random.default_rng(2)
    d = spark.createDataFrame([(f"v{i:03d}", [float(f) for f in rng.normal(size=8)]) for i in range(300)], SCHEMA)
    a = {tuple(r) for r in neighbors.nearest(d, k=5, min_similarity=0.5, probes=40, probe_margin=9).collect()}
    b = {tuple(r) for r in neighbors.nearest(d, k=5, min_similarity=0.5, probes=40, probe_margin=9, block_rows=7, query_rows=20).collect()}
    c = {tuple(r) for r in neighbors.nearest(d.union(d), k=5, min_similarity=0.5, probes=40, probe_margin=9, block_rows=7, query_rows=10**6).collect()}
    assert a == b == c and a


def test_empty(spark):
    assert neighbors.nearest(spark.createDataFrame([], SCHEMA)).count() == 0
    assert neighbors.nearest(spark.createDataFrame([("a", None)], SCHEMA)).count() == 0


def test_every_vector_gets_k_neighbours(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(400, 24)).astype(np.float32)  # nearly all neighbours are below 0.8
    x[300:340] = 2 * x[:40]  # ties
    ids = [f"v{i:04d}" for i in range(400)]
    rows = [(i, [float(f) for f in v]) for i, v in zip(ids, x, strict=True)]
    d = spark.createDataFrame(rows + [("null", None), ("zero", [0.0] * 24), rows[7], rows[399]], SCHEMA)
    got = neighbors.nearest(d, k=10, min_similarity=None).collect()
    assert len(got) == 4000 and sorted({r["rank"] for r in got}) == list(range(1, 11))
    assert {(r.chunk_id, r.neighbor) for r in got} == brute(ids, x.astype(np.float64), 10, -1)
    usable = spark.createDataFrame(rows, "_id string, _v array<float>")
    blocks = neighbors.all_nearest(usable, 24, 400, 10, block_rows=60, stride=17).collect()
    assert sorted(map(tuple, blocks)) == sorted(map(tuple, got))
    assert neighbors.nearest(d.limit(0), min_similarity=None).count() == 0
    assert neighbors.nearest(spark.createDataFrame(rows[:3], SCHEMA), min_similarity=None).count() == 6


def test_equal_vectors_and_scaled_copies(spark):
    v = [1.0, 2.0, 3.0, 4.0]
    rows = [(f"h{i:03d}", v) for i in range(30)] + [("a000", [3 * f for f in v]), ("h001x", [0.7 * f for f in v]), ("other", [-1.0, 0.0, 0.0, 0.0])]
    want = brute([i for i, _ in rows], np.array([x for _, x in rows]), 3, 0.8)
    d = spark.createDataFrame(rows, SCHEMA)
    assert {(r.chunk_id, r.neighbor) for r in neighbors.nearest(d, k=3).collect()} == want
    every = {(r.chunk_id, r.neighbor) for r in neighbors.nearest(d, k=3, min_similarity=None).collect()}
    assert {p for p in every if p[0] != "other"} == want and len([p for p in every if p[0] == "other"]) == 3


def test_equal_vectors_in_many_groups(spark, monkeypatch):
    rng = np.random.default_rng(6)
    x = np.repeat(rng.normal(size=(20, 16)) + 1, 9, axis=0).astype(np.float32)
    rows = [(f"g{i % 9}-{i:03d}", [float(f) for f in v]) for i, v in enumerate(x)]
    want = brute([i for i, _ in rows], x.astype(np.float64), 3, 0.8)
    d = spark.createDataFrame(rows + [rows[5], rows[170]] + [("hole", [None, *[1.0] * 15]), ("nan", [float("nan"), *[1.0] * 15]), ("low", [float("-inf"), *[1.0] * 15]), ("zero", [-0.0] * 16)], SCHEMA)
    for bound in (10**6, 0):  # the later equal ids broadcast, or joined by a shuffle
        monkeypatch.setattr(neighbors, "BROADCAST_ROWS", bound)
        assert {(r.chunk_id, r.neighbor) for r in neighbors.nearest(d, k=3).collect()} == want


def test_memory_of_a_block_of_like_vectors():
    """Of a query's many like vectors only the best are listed, and a block isn't held in double precision."""
    rng = np.random.default_rng(7)
    x = (1 + 0.02 * rng.normal(size=(20_000, 96))).astype(np.float32)
    model = neighbors.fit(neighbors.unit(x[:500]), first=4, words=16)
    codes, near = model.encode(neighbors.unit(x))
    ids = np.array([f"v{i:05d}" for i in range(len(x))], object)
    tracemalloc.start()
    held = neighbors.Block(ids, x, codes.astype(np.uint16), 1 / np.linalg.norm(near, axis=1), model, 0.8)
    made = tracemalloc.get_traced_memory()[1]
    i, j, _ = held.top(ids[:256], x[:256], 10)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    u = neighbors.unit(x.astype(np.float64))
    s = np.round(u[:256] @ u.T, 6)
    s[np.arange(256), np.arange(256)] = -1
    want = {(a, b) for a in range(256) for b in np.lexsort((np.arange(len(x)), -s[a]))[:10]}
    assert set(zip(i.tolist(), j.tolist(), strict=True)) == {(a, int(b)) for a, b in want}
    assert made < 2.5 * x.nbytes and most < 150e6, (made, most)
