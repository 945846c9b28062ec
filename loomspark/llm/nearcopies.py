"""Near-duplicate texts by a chosen-path similarity join over word shingles.

Texts become sets of hashed word sequences; equal sets form one class, and only classes are joined. In each run a set
chooses the token that has the smallest hash of that run, and joins the bucket of the token. All tokens have the same
chance, whatever else is in the corpus and however often, so two sets of a Jaccard similarity J meet in a run with a
probability of J. Buckets of up to ``bucket_limit`` sets are compared by brute force as they stream past. Of the larger ones
those that hold a large part of near pairs (many copies of one text: the result itself is of that size) or did not become
half as large by the last split are compared as a whole, in pairs of blocks of bounded size; the others are split again,
each set going on to the buckets of ``picks`` tokens chosen anew, in which a near pair meets again with a probability of
1 - (1 - J) ** picks. Runs are repeated until the target recall: first as many as give it for a pair at the threshold,
then more while the numbers of pairs that one and two runs found (Chao's estimate of those no run found) say that
the recall of all pairs is below it.

Pairs in a bucket are compared by their sizes and by 256-bit sketches of their sets (a pair at the threshold falls below
``sketch_agree`` equal bits in about one case in a thousand), the rest by their exact sets.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomspark.session import materialize

_WORD = re.compile(r"[^\W_]+")
BROADCAST_ROWS = 100_000  # rows of two numbers (under 2 MB) that may be broadcast; more are joined by a shuffle
BLOCK = 5000  # rows of a bucket or members of a class that one group holds
SKETCH = ("s0", "s1", "s2", "s3")  # a set's sketch, 64 bits each
DENSE = 0.05  # a bucket with this part of near pairs is compared as a whole: splitting could save no more than the rest
_A, _B = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(33))
    x = x * _A
    x = x ^ (x >> np.uint64(33))
    x = x * _B
    return x ^ (x >> np.uint64(33))


def word_hashes(text: str, memo: dict[str, int]) -> list[int]:
    import xxhash

    out = []
    for w in _WORD.findall(text.lower()):
        h = memo.get(w)
        if h is None:
            if len(memo) > 500_000:
                memo.clear()
            h = memo[w] = xxhash.xxh3_64_intdigest(w)
        out.append(h)
    return out


def shingled(texts: DataFrame, id_col: str, text_col: str, shingle: int = 5, min_words: int = 1, runs: int = 8) -> DataFrame:
    """``(id, cls, n, tokens, s0..s3, paths)``: the set of hashed word sequences of every text of at least ``min_words`` words.

    ``cls`` is a hash of the whole set, equal for equal sets, ``s0`` to ``s3`` its sketch, ``paths`` the bucket it joins in
    each of the first runs, from 64-bit tokens; ``tokens`` are the upper 32 bits. Null texts and texts shorter than a
    sequence drop out.
    """
    kind = texts.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo: dict[str, int] = {}
        salts, least = _salts(range(runs)), max(min_words, shingle)
        for whole in batches:
            for lo in range(0, whole.num_rows, 2000):
                b = whole.slice(lo, 2000)
                keep, words, ends = [], [], [0]
                for i, t in enumerate(b.column("_text").to_pylist()):
                    h = word_hashes(t, memo) if t else []
                    if len(h) >= least:
                        keep.append(i)
                        words += h
                        ends.append(len(words))
                if not keep:
                    continue
                h = np.array(words, np.uint64)
                s = h[: len(h) - shingle + 1]
                for k in range(1, shingle):
                    s = _mix(s) + h[k : len(h) - shingle + 1 + k]
                # sequences that begin in the last words of a text would reach into the next one
                size = np.diff(ends) - shingle + 1
                owner = np.repeat(np.arange(len(keep)), size)
                s = _mix(s[np.arange(len(owner)) + (owner * (shingle - 1))])
                order = np.lexsort((s, owner))
                s, owner = s[order], owner[order]
                first = np.concatenate([[True], (s[1:] != s[:-1]) | (owner[1:] != owner[:-1])])
                s, owner = s[first], owner[first]
                starts = np.searchsorted(owner, np.arange(len(keep) + 1))
                cls = np.add.reduceat(_mix(s), starts[:-1]) + np.diff(starts).astype(np.uint64)
                paths = pa.ListArray.from_arrays(pa.array(np.arange(len(keep) + 1) * runs, pa.int32()), pa.array(_chosen(s, starts, salts).ravel()))
                t = (s >> np.uint64(32)).astype(np.uint32)
                first = np.concatenate([[True], (t[1:] != t[:-1]) | (owner[1:] != owner[:-1])])
                t, owner = t[first], owner[first]
                starts = np.searchsorted(owner, np.arange(len(keep) + 1))
                tokens = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(t.view(np.int32)))
                cols = [b.column("_id").take(pa.array(keep, pa.int32())), pa.array(cls.view(np.int64)), pa.array(np.diff(starts).astype(np.int32)), tokens, *map(pa.array, _sketches(t, starts)), paths]
                yield pa.RecordBatch.from_arrays(cols, ["_id", "cls", "n", "tokens", *SKETCH, "paths"])

    base = texts.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    return base.mapInArrow(run, f"_id {kind}, cls bigint, n int, tokens array<int>, {_SKETCHED}, paths array<bigint>")


def _flat(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The values and the row starts of a list column."""
    offsets = col.offsets.to_numpy()
    return col.values.to_numpy()[offsets[0] : offsets[-1]].view(np.uint32), offsets - offsets[0]


def _salts(runs: Iterable[int]) -> np.ndarray:
    return _mix(np.array([(r + 1) * 0x9E3779B97F4A7C15 % (1 << 64) for r in runs], np.uint64))


def _chosen(tokens: np.ndarray, starts: np.ndarray, salts: np.ndarray) -> np.ndarray:
    """(set, salt) -> bucket of the set's token with the smallest hash of the salt; salts of each set where there are rows of them."""
    out = np.empty((len(starts) - 1, salts.shape[-1]), np.uint64)
    per_set = salts.ndim == 2
    owner = np.repeat(np.arange(len(starts) - 1), np.diff(starts)) if per_set else None
    for k in range(salts.shape[-1]):
        salt = salts[:, k][owner] if per_set else salts[k]
        out[:, k] = np.minimum.reduceat(_mix(tokens.astype(np.uint64) * _B + salt), starts[:-1])
    return _mix(out + salts).view(np.int64)


#: The bits of each byte as eight counters of 16 bits.
_LANES = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.uint16).view(np.uint64)


def _sketches(tokens: np.ndarray, starts: np.ndarray) -> list[np.ndarray]:
    """The 64-bit sketches of each set: signs of sums of random signs over the tokens."""
    out = []
    for salt in map(np.uint64, (0x1234567, 0x89ABCDE, 0x2F0E1EB9, 0x6A09E667)):
        parts = []
        for lo in range(0, len(starts) - 1, 512):  # so few that the bits stay in a core's cache
            at = starts[lo : lo + 513]
            signs = _mix(tokens[at[0] : at[-1]].astype(np.uint64) * _B + salt).view(np.uint8).reshape(-1, 8)
            if not len(signs):
                sums = np.zeros((0, 64), np.int16)
            elif np.diff(at).max() < 1 << 16:  # four counters of 16 bits in one number
                sums = np.add.reduceat(_LANES[signs].reshape(len(signs), 16), at[:-1] - at[0], axis=0).view(np.uint16).astype(np.int32)
            else:
                sums = np.add.reduceat(np.unpackbits(signs, axis=1), at[:-1] - at[0], axis=0, dtype=np.int64)
            parts.append(np.packbits(2 * sums >= np.diff(at)[:, None], axis=1).view(np.int64).ravel())
        out.append(np.concatenate(parts) if parts else np.empty(0, np.int64))
    return out


def _chooser(picks: int, runs: list[int] | None):
    """Rows (path, cls, n, sketch, above, run): the buckets each set joins in ``runs``, or, where they are None, below its ``path``.

    ``above`` is the size of the bucket that was split.
    """
    names = ["path", "cls", "n", *SKETCH, "above", "run"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, whole.num_rows, 8192):
                b = whole.slice(lo, 8192)
                # copies of one set choose alike: one of them in a batch is enough
                same = np.stack([b.column(k).to_numpy() for k in (("cls", "path") if runs is None else ("cls",))], axis=1)
                b = b.take(pa.array(np.unique(same, axis=0, return_index=True)[1]))
                if not b.num_rows:
                    continue
                tokens, starts = _flat(b.column("tokens"))
                if runs is None:
                    salts = _mix(b.column("path").to_numpy().view(np.uint64)[:, None] + _salts(range(1000, 1000 + picks))[None, :])
                else:
                    salts = _salts(runs)
                path = _chosen(tokens, starts, salts)
                k = path.shape[1]
                who = np.repeat(np.arange(b.num_rows), k)
                above = b.column("above").to_numpy()[who] if runs is None else np.full(len(who), np.iinfo(np.int64).max)
                number = b.column("run").to_numpy()[who] if runs is None else np.tile(np.array(runs, np.int32), b.num_rows)
                cols = [path.ravel(), *(b.column(c).to_numpy()[who] for c in ("cls", "n", *SKETCH)), above, number]
                yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in cols], names)

    return run


def _near_in(n: np.ndarray, s: list[np.ndarray], side: np.ndarray | None, most: int, ratio: float) -> tuple[np.ndarray, np.ndarray]:
    """Places of the pairs of one bucket with near sketches and sizes; with ``side`` only pairs of different sides."""
    order = np.argsort(n, kind="stable")
    size, bits = n[order], [x[order] for x in s]
    side = None if side is None else side[order]
    until = np.searchsorted(size, np.floor(size / ratio + 1e-9), side="right")  # sizes beyond the ratio can't be near
    left, right = [], []
    for lo in range(0, len(size), 128):
        hi = min(lo + 128, len(size))
        cols = slice(lo + 1, until[hi - 1])
        differ = np.bitwise_count(bits[0][lo:hi, None] ^ bits[0][None, cols]).astype(np.uint16)
        for x in bits[1:]:
            differ += np.bitwise_count(x[lo:hi, None] ^ x[None, cols])
        i, j = np.nonzero(differ <= most)
        i, j = i + lo, j + lo + 1
        fine = (j > i) & (j < until[i])
        if side is not None:
            fine &= side[i] != side[j]
        left.append(order[i[fine]])
        right.append(order[j[fine]])
    return (np.concatenate(left), np.concatenate(right)) if left else (order[:0], order[:0])


_NAMES = ["path", "cls", "n", *SKETCH, "above", "run"]
_SKETCHED = ", ".join(f"{s} bigint" for s in SKETCH)
_ROWS = f"path bigint, cls bigint, n int, {_SKETCHED}, above bigint, run int"


def _met(bucket_limit: int, most: int, ratio: float):
    """Over rows sorted by path and class: the near pairs of each bucket, and the rows of buckets above the limit.

    Output rows are (a, b, run, path null) for pairs and (a, b null, run, path, n, sketch, above, near) for the rest; ``near``
    says whether a set is near the next one in its bucket. Classes are in the order of a hash, so that these are random pairs.
    """

    def pairs(cols: list[np.ndarray], starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        path, cls, n, *rest = cols
        bits, number = [x.view(np.uint64) for x in rest[: len(SKETCH)]], rest[-1]
        left, right = [], []
        few = np.repeat(sizes <= 24, sizes)
        at, shift = np.flatnonzero(few), 1
        while len(at):  # small buckets all at once, neighbours at a growing distance
            at = at[at + shift < len(path)]
            at = at[path[at] == path[at + shift]]
            to = at + shift
            differ = sum(np.bitwise_count(x[at] ^ x[to]).astype(np.uint16) for x in bits)
            near = (differ <= most) & (np.minimum(n[at], n[to]) >= ratio * np.maximum(n[at], n[to]))
            left.append(at[near])
            right.append(to[near])
            shift += 1
        for k in np.flatnonzero(sizes > 24):
            part = slice(starts[k], starts[k] + sizes[k])
            i, j = _near_in(n[part], [x[part] for x in bits], None, most, ratio)
            left.append(i + starts[k])
            right.append(j + starts[k])
        i, j = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (left, right))
        return np.minimum(cls[i], cls[j]), np.maximum(cls[i], cls[j]), number[i]

    def batch(cols: list[np.ndarray], found: tuple, large: np.ndarray) -> pa.RecordBatch:
        none = lambda k, kind=pa.int64(): pa.nulls(k, kind)
        at = np.flatnonzero(large)
        to = np.minimum(at + 1, len(large) - 1)
        differ = sum(np.bitwise_count(x.view(np.uint64)[at] ^ x.view(np.uint64)[to]).astype(np.uint16) for x in cols[3 : 3 + len(SKETCH)]) if len(at) else np.empty(0)
        near = (to > at) & (cols[0][at] == cols[0][to]) & (differ <= most) & (np.minimum(cols[2][at], cols[2][to]) >= ratio * np.maximum(cols[2][at], cols[2][to]))
        a, b, number = found
        k, m = len(a), len(at)
        pick = lambda c, kind=pa.int64(): pa.array(np.ascontiguousarray(c), kind)
        out = [pa.concat_arrays([pick(a), pick(cols[1][at])]), pa.concat_arrays([pick(b), none(m)]), pa.concat_arrays([pick(number, pa.int32()), pick(cols[-1][at], pa.int32())])]
        out += [pa.concat_arrays([none(k), pick(cols[0][at])]), pa.concat_arrays([none(k, pa.int32()), pick(cols[2][at], pa.int32())])]
        out += [pa.concat_arrays([none(k), pick(c[at])]) for c in cols[3:-1]]
        return pa.RecordBatch.from_arrays([*out, pa.concat_arrays([none(k), pick(near.astype(np.int64))])], ["a", "b", "run", "path", "n", *SKETCH, "above", "near"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None  # the bucket that may go on in the next batch
        large_path = None  # the bucket whose first rows are known to be above the limit

        def settle(cols: list[np.ndarray], last: bool):
            nonlocal held, large_path
            first = np.concatenate([[True], (cols[0][1:] != cols[0][:-1]) | (cols[1][1:] != cols[1][:-1])])
            cols = [c[first] for c in cols]  # a set stands once in a bucket
            path = cols[0]
            starts = np.flatnonzero(np.concatenate([[True], path[1:] != path[:-1]]))
            sizes = np.diff(np.concatenate([starts, [len(path)]]))
            big = (sizes > bucket_limit) | (path[starts] == large_path if large_path is not None else False)
            large = np.repeat(big, sizes)
            open_from = len(path) if last else starts[-1]
            held = None
            if not last:
                if large[-1]:
                    large_path, open_from = path[-1], len(path)
                else:
                    large_path, held = None, [c[open_from:] for c in cols]
            small = ~big & (starts < open_from)
            found = pairs(cols, starts[small], sizes[small]) if small.all() else pairs([c[np.repeat(small, sizes)] for c in cols], np.cumsum(sizes[small]) - sizes[small], sizes[small])
            return batch(cols, found, (np.arange(len(path)) < open_from) & large)

        for b in batches:
            if b.num_rows:
                cols = [b.column(k).to_numpy() for k in _NAMES]
                if held is not None:
                    cols = [np.concatenate(z) for z in zip(held, cols, strict=True)]
                yield settle(cols, False)
        if held is not None:
            yield settle(held, True)

    return run


def _jaccard(pairs: DataFrame, shingle_sets: DataFrame) -> DataFrame:
    """Adds the exact similarity of ``(a, b)``."""
    one = lambda x: shingle_sets.select(F.col("cls").alias(x), F.col("tokens").alias(f"t_{x}"))
    both = F.size(F.array_intersect("t_a", "t_b"))
    return pairs.join(one("a"), "a").join(one("b"), "b").select(*pairs.columns, (both / (F.size("t_a") + F.size("t_b") - both)).alias("similarity"))


def _in_blocks(rows: DataFrame, most: int, ratio: float) -> DataFrame:
    """The near pairs of whole buckets ``(path, cls, n, sketch, run, size)``: each pair of blocks of a bucket is one group of at most about twice ``BLOCK`` rows."""
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    rows = rows.withColumn("own", F.pmod(F.xxhash64("cls"), blocks).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    rows = rows.select("path", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "cls", "own", "n", *SKETCH, "run")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None

        def compare(cols: list[np.ndarray]):
            path, i, j, cls, own, n, *bits, number = cols
            first = np.concatenate([[True], cls[1:] != cls[:-1]])  # a set stands once in a group
            across = own[first] if i[0] != j[0] else None
            x, y = _near_in(n[first], [c[first].view(np.uint64) for c in bits], across, most, ratio)
            a, b = cls[first][x], cls[first][y]
            return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b)), pa.array(number[first][x])], ["a", "b", "run"])

        names = ["path", "i", "j", "cls", "own", "n", *SKETCH, "run"]
        for b in batches:
            if not b.num_rows:
                continue
            cols = [b.column(k).to_numpy() for k in names]
            if held is not None:
                cols = [np.concatenate(z) for z in zip(held, cols, strict=True)]
            cut = np.flatnonzero((cols[0][1:] != cols[0][:-1]) | (cols[1][1:] != cols[1][:-1]) | (cols[2][1:] != cols[2][:-1])) + 1
            at = [0, *cut.tolist(), len(cols[0])]
            for lo, hi in zip(at[:-2], at[1:-1], strict=True):
                yield compare([c[lo:hi] for c in cols])
            held = [c[at[-2] :] for c in cols]
        if held is not None:
            yield compare(held)

    return rows.repartition("path", "i", "j").sortWithinPartitions("path", "i", "j", "cls").mapInArrow(run, "a bigint, b bigint, run int")


def _run_candidates(sets: DataFrame, runs: list[int], first: bool, picks: int, bucket_limit: int, max_depth: int, most: int, ratio: float) -> DataFrame:
    """``(a, b, run)``: the pairs with near sketches that met in a bucket of one of the runs."""
    tokens = sets.select("cls", "n", "tokens", *SKETCH)
    if first:  # chosen while the sets were made
        chosen = sets.select("cls", "n", *SKETCH, F.posexplode("paths").alias("run", "path"))
        level = chosen.select("path", "cls", "n", *SKETCH, F.lit(2**62).cast("bigint").alias("above"), "run")
    else:
        level = tokens.mapInArrow(_chooser(picks, runs), _ROWS)
    met = _met(bucket_limit, most, ratio)
    levels = []
    for depth in range(1, max_depth + 1):
        # one shuffle brings buckets together; a bucket is compared while the sorted rows stream past
        passed = level.repartition("path").sortWithinPartitions("path", "cls").mapInArrow(met, f"a bigint, b bigint, run int, path bigint, n int, {_SKETCHED}, above bigint, near bigint")
        passed = materialize(passed, f"chosen-path-{depth}")
        levels.append(passed.filter("b is not null").select("a", "b", "run"))
        large = passed.filter("b is null").select("path", F.col("a").alias("cls"), "n", *SKETCH, "above", "near", "run")
        if large.isEmpty():
            break
        size = F.count("*")
        whole = F.lit(depth == max_depth) | (F.sum("near") >= DENSE * size) | (2 * size > F.first("above"))
        sizes = materialize(large.groupBy("path").agg(size.alias("size"), whole.alias("whole")), f"bucket-sizes-{depth}")
        few = sizes.count() <= BROADCAST_ROWS
        rows = large.drop("above", "near").join(F.broadcast(sizes) if few else sizes, "path")
        levels.append(_in_blocks(rows.filter("whole"), most, ratio))
        if sizes.filter("not whole").isEmpty():
            break
        keys = rows.filter("not whole").select("path", "cls", F.col("size").alias("above"), "run")
        level = tokens.dropDuplicates(["cls"]).join(keys, "cls").mapInArrow(_chooser(picks, None), _ROWS)
    out = levels[0]
    for x in levels[1:]:
        out = out.unionByName(x)
    return out


def runs_for(threshold: float, target_recall: float, picks: int = 4) -> int:
    """The runs after which a pair at the threshold is missed with a probability of 1 - target at most, if its bucket is split once in every run."""
    meets = threshold * (1 - (1 - threshold) ** picks)
    return max(1, math.ceil(math.log(1 - target_recall) / math.log(1 - meets)))


def class_pairs(
    sets: DataFrame, threshold: float, target_recall: float = 0.999, picks: int = 4, bucket_limit: int = BLOCK, max_depth: int = 8, sketch_agree: int | None = None, more_runs: int = 2, first_runs: int | None = None
) -> DataFrame:
    """``(a, b, similarity, runs)``: the pairs of different classes of ``sets`` with a Jaccard similarity of the threshold or more, and how many runs found each."""
    bits = 64 * len(SKETCH)
    if sketch_agree is None:
        agree = 1 - np.arccos(2 * threshold / (1 + threshold)) / np.pi
        sketch_agree = int(bits * agree - 3.1 * np.sqrt(bits * agree * (1 - agree)))
    runs = list(range(first_runs or runs_for(threshold, target_recall, picks)))
    tokens = sets.select("cls", "tokens").dropDuplicates(["cls"])
    found, first, total = None, True, 0
    while True:
        met = _run_candidates(sets, runs, first, picks, bucket_limit, max_depth, bits - sketch_agree, threshold - 1e-9)
        met = met.groupBy("a", "b").agg(F.expr("cast(bit_count(bit_or(shiftleft(1L, run % 63))) as int)").alias("runs"))
        # pairs that are known to be near keep their similarity
        fresh = met if found is None else met.join(found.select("a", "b"), ["a", "b"], "left_anti")
        near = _jaccard(fresh, tokens).filter(F.col("similarity") >= threshold - 1e-12)
        if found is not None:
            again = found.join(met.withColumnRenamed("runs", "new"), ["a", "b"], "left").select("a", "b", (F.col("runs") + F.coalesce("new", F.lit(0))).cast("int").alias("runs"), "similarity")
            near = near.unionByName(again)
        found, first, total = materialize(near, "class-pairs"), False, total + len(runs)
        # how many pairs no run found, from those that one and two runs found (Chao's estimate)
        n, one, two = found.agg(F.count("*"), F.sum((F.col("runs") == 1).cast("int")), F.sum((F.col("runs") == 2).cast("int"))).first()
        missed = (total - 1) / total * one * (one - 1) / (2 * (two + 1)) if n else 0.0
        if total >= 2 and n >= target_recall * (n + missed):
            return found
        runs = list(range(total, total + more_runs))


def components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """``(cls, group)``: the smallest class of the connected component of each class.

    Every round gives a class the smallest label among itself and its neighbours and then follows that label one step,
    so that long chains shorten by doubling; rounds end when no label changes.
    """
    both = materialize(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))), "component-edges")
    ends = both.select(F.col("a").alias("cls")).distinct()
    label = materialize(ends.select("cls", F.col("cls").alias("label")), "component-labels")
    while True:  # labels only fall, so that it ends
        seen = both.join(label, both.b == label.cls).groupBy("a").agg(F.min("label").alias("near"))
        hop = label.join(seen, label.cls == seen.a).select("cls", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        hop = materialize(hop, "component-hop")
        up = hop.select(F.col("cls").alias("up"), F.col("label").alias("up_label"))
        label = materialize(hop.join(up, hop.label == F.col("up"), "left").select("cls", "old", F.coalesce("up_label", "label").alias("label")), "component-labels")
        if label.filter("old <> label").isEmpty():
            break
        label = label.select("cls", "label")
    return nodes.select("cls").distinct().join(label.select("cls", F.col("label").alias("group")), "cls", "left").select("cls", F.coalesce("group", "cls").alias("group"))


def near_copies(texts: DataFrame, id_col: str, text_col: str, threshold: float = 0.8, shingle: int = 5, min_words: int = 1, target_recall: float = 0.999, **params) -> tuple[DataFrame, DataFrame]:
    """Members ``(id, cls)`` and class pairs ``(a, b, similarity, runs)`` of all texts with at least ``min_words`` words.

    Runs are repeated until the recall is ``target_recall``. Rows delivered twice count once. Null, empty and shorter
    texts are no members; an empty table gives empty results.
    """
    runs = params.pop("first_runs", None) or runs_for(threshold, target_recall, params.get("picks", 4))
    sets = materialize(shingled(texts, id_col, text_col, shingle, min_words, runs), "shingle-sets")
    members = sets.select(F.col("_id").alias(id_col), "cls").distinct()
    return members, class_pairs(sets, threshold, target_recall, first_runs=runs, **params)


def copy_pairs(members: DataFrame, pairs: DataFrame, id_col: str) -> DataFrame:
    """``(id_a, id_b)``, the smaller id first: all pairs of ids of near or equal classes.

    Members of a class go in blocks of about ``BLOCK``, so that no class, however many copies it has, is one join key.
    """
    ids = members.select(F.col(id_col).alias("x"), "cls")
    blocks = materialize(ids.groupBy("cls").agg(F.count("*").alias("size"), F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks")), "class-sizes")
    many = blocks.filter("blocks > 1").select("cls", "blocks")
    many = F.broadcast(many) if many.count() <= BROADCAST_ROWS else many
    ids = ids.join(many, "cls", "left").withColumn("block", F.coalesce(F.pmod(F.xxhash64("x"), F.col("blocks")).cast("int"), F.lit(0)))
    every = F.explode(F.sequence(F.lit(0), F.coalesce("blocks", F.lit(1)) - 1)).alias("block")

    def expanded(rows: DataFrame, cls: str, id_name: str) -> DataFrame:
        spread = rows.join(many.withColumnRenamed("cls", cls), cls, "left").select(*rows.columns, every)
        return spread.join(ids.select(F.col("x").alias(id_name), F.col("cls").alias(cls), "block"), [cls, "block"]).drop("block")

    near = expanded(expanded(pairs.select("a", "b"), "a", "x"), "b", "y").select("x", "y")
    twins = ids.join(blocks.filter("size > 1").select("cls"), "cls", "left_semi")
    other = twins.select(F.col("x").alias("y"), "cls", every)
    equal = twins.select("x", "cls", "block").join(other, ["cls", "block"]).filter(F.col("x") < F.col("y")).select("x", "y")
    return near.unionByName(equal).select(F.least("x", "y").alias(f"{id_col}_a"), F.greatest("x", "y").alias(f"{id_col}_b"))


def copy_groups(members: DataFrame, pairs: DataFrame, id_col: str) -> DataFrame:
    """``(id, class_id, group_id, n_links)`` for each member: its class, its group and the number of near classes."""
    links = pairs.select(F.explode(F.array("a", "b")).alias("cls")).groupBy("cls").agg(F.count("*").alias("n_links"))
    groups = components(members.select("cls"), pairs)
    return (
        members.join(groups, "cls")
        .join(links, "cls", "left")
        .select(id_col, F.col("cls").alias("class_id"), F.col("group").alias("group_id"), F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"))
    )
