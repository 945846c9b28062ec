"""Most similar vectors for every vector by additive quantisation.

A vector is coded as a sum of full-dimensional codewords, one of each codebook. The first codebook holds leaders of
dense regions of a bounded sample, the others are fitted to the residuals and then refitted together by least squares; codes come from a beam search over the codebooks. The norm of each coded vector is stored, so the cosine of a
query with all vectors of a cell is a sum of entries of the query's lookup tables times that norm. A vector lies in
the cell of the nearest first codeword; a query visits the cells of its nearest first codewords. A neighbour x with a
cosine of s scores about s times the cosine of x and its code, with a deviation of sqrt((1 - s^2) / dimensions). All
that score above that less three deviations are ranked again by exact cosines in double precision.

Cells are split into blocks of vectors and of queries by their counted rows; each pair of blocks is one group. A group's
vectors are held, its queries stream past them in Arrow batches, so that blocks of queries can be large and few, and with
them the copies of each vector.

Without a least similarity neighbours may lie in any cell, and codes tell them apart too badly to leave any vector out:
then every block of queries goes past all vectors (``all_nearest``), which is exact and grows with the square of the rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loomspark.llm.sampling import bounded_sample
from loomspark.session import materialize


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-30)


def leaders(x: np.ndarray, count: int, radius: float = 0.8) -> np.ndarray:
    """Means of the densest regions: again and again the vector with the most others within ``radius``."""
    degree = np.concatenate([((x[lo : lo + 1024] @ x.T) >= radius).sum(1) for lo in range(0, len(x), 1024)])
    left, out = np.ones(len(x), bool), []
    for i in np.argsort(-degree, kind="stable"):
        if left[i]:
            near = (x @ x[i] >= radius) & left
            out.append(x[near].mean(0))
            left &= ~near
            if len(out) == count:
                break
    return unit(np.stack(out))


def k_means(x: np.ndarray, count: int, rounds: int, rng: np.random.Generator) -> np.ndarray:
    c = x[rng.choice(len(x), count, replace=len(x) < count)].copy()
    for _ in range(rounds):
        near = (2 * x @ c.T - (c * c).sum(1)).argmax(1)
        size = np.bincount(near, minlength=count)
        total = np.zeros_like(c)
        np.add.at(total, near, x)
        c = np.where(size[:, None] > 0, total / np.maximum(size, 1)[:, None], x[rng.integers(len(x), size=count)]).astype(np.float32)
    return c


class Quantizer:
    def __init__(self, books: list[np.ndarray]):
        self.books = books

    def encode(self, x: np.ndarray, beam: int = 3) -> tuple[np.ndarray, np.ndarray]:
        """Codes (one column for each codebook) and the coded vectors, by beam search over the codebooks."""
        n = len(x)
        codes, rest, err = np.zeros((n, 1, 0), np.int32), x[:, None, :], None
        for book in self.books:
            width = rest.shape[1]
            gain = (rest.reshape(n * width, -1) @ book.T).reshape(n, width, -1)
            cost = (book * book).sum(1) - 2 * gain
            if err is not None:
                cost += err[:, :, None]
            flat = cost.reshape(n, -1)
            keep = min(beam, flat.shape[1])
            best = np.argpartition(flat, keep - 1, axis=1)[:, :keep]
            err = np.take_along_axis(flat, best, 1)
            parent, word = best // len(book), best % len(book)
            codes = np.concatenate([np.take_along_axis(codes, parent[:, :, None], 1), word[:, :, None].astype(np.int32)], axis=2)
            rest = np.take_along_axis(rest, parent[:, :, None], 1) - book[word]
        top = err.argmin(1)
        codes = codes[np.arange(n), top]
        return codes, x - rest[np.arange(n), top]

    def refit(self, x: np.ndarray, codes: np.ndarray) -> None:
        """All codewords after the first codebook together by least squares for given codes."""
        rest = x - self.books[0][codes[:, 0]]
        cols = codes[:, 1:]
        at = np.concatenate([[0], np.cumsum([len(b) for b in self.books[1:]])])
        m = at[-1]
        gram, right = np.zeros((m, m), np.float32), np.zeros((m, x.shape[1]), np.float32)
        cols = cols + at[:-1]
        for i in range(cols.shape[1]):
            np.add.at(right, cols[:, i], rest)
            for j in range(cols.shape[1]):
                np.add.at(gram, (cols[:, i], cols[:, j]), 1.0)
        ridge = 1.0  # unused codewords stay as they are
        new = np.linalg.solve(gram + ridge * np.eye(m, dtype=np.float32), right + ridge * np.concatenate(self.books[1:]))
        self.books[1:] = [new[a:b].astype(np.float32) for a, b in zip(at[:-1], at[1:], strict=True)]

    def tables(self, q: np.ndarray) -> list[np.ndarray]:
        """One table for each codebook: (codeword, query) -> dot product."""
        return [b @ q.T for b in self.books]

    def above(self, q: np.ndarray, codes: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """(coded vector, query) -> whether the dot product by table lookups reaches the vector's bound."""
        tables = self.tables(q)
        out = np.empty((len(codes), len(q)), bool)
        total, part = np.empty((512, len(q)), np.float32), np.empty((512, len(q)), np.float32)
        for lo in range(0, len(codes), 512):  # so few that the sums stay in a core's cache
            c = codes[lo : lo + 512]
            t, p = total[: len(c)], part[: len(c)]
            np.take(tables[0], c[:, 0], axis=0, out=t, mode="clip")
            for j in range(1, len(tables)):
                np.take(tables[j], c[:, j], axis=0, out=p, mode="clip")
                t += p
            np.greater_equal(t, bound[lo : lo + 512, None], out=out[lo : lo + 512])
        return out


def fit(x: np.ndarray, first: int = 64, others: int = 4, words: int = 256, seed: int = 7) -> Quantizer:
    """Codebooks from a sample of unit vectors."""
    rng = np.random.default_rng(seed)
    x = x.astype(np.float32)
    books = [leaders(x, min(first, len(x)))]
    rest = x - books[0][(x @ books[0].T).argmax(1)]
    for _ in range(others):
        books.append(k_means(rest, min(words, len(x)), 6, rng))
        b = books[-1]
        rest = rest - b[(2 * rest @ b.T - (b * b).sum(1)).argmax(1)]
    q = Quantizer(books)
    q.refit(x, q.encode(x)[0])
    return q


class Block:
    """The vectors of a block in the order of their ids, ready for queries."""

    def __init__(self, ids: np.ndarray, vec: np.ndarray, codes: np.ndarray, inverse: np.ndarray, model: Quantizer, least: float):
        self.ids, self.vec, self.codes, self.model, self.least = ids, vec, codes, model, least
        self.d32, dot = np.empty_like(vec), np.empty(len(vec), np.float32)
        for lo in range(0, len(vec), 4096):  # so that no second copy of the block is held, nor one in double precision
            hi = lo + 4096
            self.d32[lo:hi] = unit(vec[lo:hi].astype(np.float64))
            near = np.zeros_like(self.d32[lo:hi])
            for book, code in zip(model.books, codes[lo:hi].T, strict=True):
                near += book[code]
            dot[lo:hi] = (near * self.d32[lo:hi]).sum(1)
        spread = 3 * np.sqrt(max(0.0, 1 - least * least) / vec.shape[1])
        self.bound = ((least * dot * inverse - spread) / inverse).astype(np.float32)

    def top(self, q_ids: np.ndarray, q: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query's place, vector's place, cosine) of the k best vectors for each query."""
        ids, codes, least, d32 = self.ids, self.codes, self.least, self.d32
        at = np.searchsorted(ids, q_ids)
        own = np.where((at < len(ids)) & (ids[np.minimum(at, len(ids) - 1)] == q_ids), at, -1)
        found = []
        stride = max(32, min(256, 2**23 // len(ids)))
        for lo in range(0, len(q), stride):
            q64, own_s = unit(q[lo : lo + stride].astype(np.float64)), own[lo : lo + stride]
            qs = q64.astype(np.float32)
            keep = self.model.above(qs, codes, self.bound)  # (vector, query)
            cols = np.flatnonzero(own_s >= 0)
            keep[own_s[cols], cols] = False
            if np.count_nonzero(keep) > 0.03 * keep.size:  # many to rank again: first by one matrix product in single precision
                e = d32 @ qs.T
                keep &= e >= least - 1e-5
                if np.count_nonzero(keep) > 2**20 and len(e) > k:  # a query's k-th best first, so that the pairs listed are few however alike the vectors are
                    e[~keep] = -2
                    keep &= e >= np.partition(e, len(e) - k, axis=0)[len(e) - k] - 3e-6
                j, i = np.nonzero(keep)
                v = e[j, i]
                order = np.lexsort((-v, i))
                j, i, v = j[order], i[order], v[order]
                first = np.searchsorted(i, i)
                last = np.minimum(first + k - 1, np.searchsorted(i, i, side="right") - 1)
                close = v >= v[last] - 3e-6
                j, i = j[close], i[close]
            else:
                j, i = np.nonzero(keep)
                near = np.concatenate([np.einsum("ij,ij->i", d32[j[x : x + 50_000]], qs[i[x : x + 50_000]]) for x in range(0, len(j), 50_000)] or [np.empty(0)]) >= least - 1e-5
                j, i = j[near], i[near]
            cos = np.concatenate([np.einsum("ij,ij->i", unit(self.vec[j[x : x + 50_000]].astype(np.float64)), q64[i[x : x + 50_000]]) for x in range(0, len(j), 50_000)] or [np.empty(0)])
            cos = np.round(cos, 6)
            fine = cos >= least
            i, j, cos = i[fine], j[fine], cos[fine]
            order = np.lexsort((j, -cos, i))  # ids are sorted, so places break ties
            i, j, cos = i[order], j[order], cos[order]
            best = np.arange(len(i)) - np.searchsorted(i, i) < k
            found.append((i[best] + lo, j[best], cos[best]))
        i, j, cos = (np.concatenate(x) for x in zip(*found, strict=True))
        return i, j, cos


#: Up to so many ids are sent to all executors.
BROADCAST_ROWS = 200_000

#: What a placed row is: a vector, a vector and a query of its own cell, a query of its own cell, a query from another cell.
VECTOR, BOTH, HOME, VISITOR = 1, 2, 3, 4


def all_nearest(usable: DataFrame, dim: int, n_rows: int, k: int, block_rows: int = 8192, stride: int = 4096) -> DataFrame:
    """``(_id, neighbor, similarity, rank)``: the k nearest of all vectors ``(_id, _v)`` for each of them, exactly.

    The vectors are written once to the shared folder in the order of their ids; each task takes one file as its queries
    and reads all files past them, so neither shuffle nor memory grows faster than the rows.
    """
    from pyarrow import fs
    from pyarrow import parquet as pq

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for b in batches:
            ids, keep = b.column("_id").to_pylist(), []
            for i, x in enumerate(ids):
                if x != last:  # sorted: an id delivered twice counts once
                    keep.append(i)
                last = x
            if keep:
                b = b.take(pa.array(keep))
                raw = np.ascontiguousarray(b.column("_v").flatten().to_numpy().astype(np.float32))
                vec = pa.FixedSizeBinaryArray.from_buffers(pa.binary(4 * dim), len(keep), [None, pa.py_buffer(raw)]).cast(pa.binary())
                yield pa.RecordBatch.from_arrays([b.column("_id"), vec], ["_id", "vec"])

    parts = max(1, -(-n_rows // block_rows))
    packed = usable.select("_id", "_v").repartitionByRange(parts, "_id").sortWithinPartitions("_id").mapInArrow(pack, "_id string, vec binary")
    files = sorted(materialize(packed, "all-vectors").inputFiles())

    def opened(name: str) -> pq.ParquetFile:
        where, path = fs.FileSystem.from_uri(name)
        return pq.ParquetFile(where.open_input_file(path))

    def vectors_of(b: pa.RecordBatch | pa.Table) -> np.ndarray:
        return unit(np.frombuffer(b"".join(b.column("vec").to_pylist()), np.float32).reshape(-1, dim).astype(np.float64))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = [opened(f).metadata.num_rows for f in files]
        for task in (int(t) for b in batches for t in b.column("id").to_pylist()):
            mine = opened(files[task]).read()
            q64 = vectors_of(mine)
            q32, n, base = q64.astype(np.float32), len(q64), sum(sizes[:task])
            # the best so far; a vector's place in the order of ids stands for its id and breaks ties
            cos, place = np.full((n, k), -np.inf), np.full((n, k), np.iinfo(np.int64).max)
            at = 0
            for name in files:
                for b in opened(name).iter_batches(stride):
                    d64 = vectors_of(b)
                    d32 = d64.astype(np.float32)
                    for lo in range(0, n, 1024):
                        e = d32 @ q32[lo : lo + 1024].T
                        bound = cos[lo : lo + 1024, -1]
                        if np.isinf(bound).any() and len(e) > k + 1:  # the block's own k + 1 best, as a query may be among them
                            bound = np.maximum(bound, np.partition(e, len(e) - k - 1, axis=0)[len(e) - k - 1])
                        hit = np.flatnonzero(e >= (bound - 3e-6).astype(np.float32))
                        j, i = hit // e.shape[1], hit % e.shape[1] + lo
                        other = j + at != i + base
                        j, i = j[other], i[other]
                        if not len(j):
                            continue
                        new = np.concatenate([np.einsum("ij,ij->i", d64[j[x : x + 50_000]], q64[i[x : x + 50_000]]) for x in range(0, len(j), 50_000)])
                        who = np.unique(i)
                        i = np.concatenate([np.repeat(who, k), i])
                        c = np.concatenate([cos[who].ravel(), np.round(new, 6)])
                        p = np.concatenate([place[who].ravel(), j + at])
                        order = np.lexsort((p, -c, i))
                        i, c, p = i[order], c[order], p[order]
                        best = np.arange(len(i)) - np.searchsorted(i, i) < k
                        cos[who], place[who] = c[best].reshape(-1, k), p[best].reshape(-1, k)
                    at += len(d64)
            row, col = np.nonzero(np.isfinite(cos))
            place, names, at = place[row, col], np.empty(len(row), object), 0
            for name, size in zip(files, sizes, strict=True):
                here = np.flatnonzero((place >= at) & (place < at + size))
                if len(here):
                    names[here] = opened(name).read(["_id"]).column("_id").to_numpy()[place[here] - at]
                at += size
            own = mine.column("_id").to_numpy()
            for lo in range(0, len(row), 50_000):
                x = slice(lo, lo + 50_000)
                yield pa.RecordBatch.from_arrays([pa.array(own[row[x]], pa.string()), pa.array(names[x], pa.string()), pa.array(cos[row[x], col[x]]), pa.array((col[x] + 1).astype(np.int32))], ["_id", "neighbor", "similarity", "rank"])

    tasks = usable.sparkSession.range(0, len(files), 1, max(1, len(files)))
    return tasks.mapInArrow(search, "_id string, neighbor string, similarity double, rank int")


def nearest(
    vectors: DataFrame,
    id_col: str = "chunk_id",
    vec_col: str = "embedding",
    k: int = 10,
    min_similarity: float | None = 0.8,
    probes: int = 3,
    probe_margin: float = 0.06,
    sample_rows: int = 6144,
    block_rows: int = 200_000,
    query_rows: int = 1_000_000,
    seed: int = 7,
) -> DataFrame:
    """``(id, neighbor, similarity, rank)``: the k most similar vectors of every usable vector, similarity rounded to 6 decimals.

    A vector is usable if it isn't null, has the most common length, only finite numbers and not only zeros. Ids
    delivered twice count once, an id isn't its own neighbour, and of equal similarities the smaller id comes first.
    Neighbours below ``min_similarity`` are left out; if it is None every vector gets its k neighbours. An empty table gives an empty result. The codebooks are fitted on
    ``sample_rows`` vectors; all are indexed and all are queries. The number of cells grows with the root of the rows; cells
    with more than ``block_rows`` vectors or ``query_rows`` queries are split into blocks, by their counts over all rows.
    """
    spark = vectors.sparkSession
    out_schema = "_id string, neighbor string, similarity double"
    base = vectors.select(F.col(id_col).cast("string").alias("_id"), F.col(vec_col).cast("array<float>").alias("_v")).filter(F.col("_id").isNotNull() & F.col("_v").isNotNull())
    dims = base.groupBy(F.size("_v").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    if not dims or not dims[0].d:
        return spark.createDataFrame([], out_schema + ", rank int").withColumnRenamed("_id", id_col)
    dim, n_rows = dims[0].d, dims[0]["count"]
    # array_contains is null for an array with a null; NaN is the largest of all numbers. A function for each number costs ten times as much
    low, high, inf = F.array_min("_v"), F.array_max("_v"), F.lit(float("inf")).cast("float")
    usable = base.filter((F.size("_v") == dim) & ~F.array_contains("_v", F.lit(float("nan")).cast("float")) & (low > -inf) & (high < inf) & ((low != 0) | (high != 0)))

    # of many equal vectors only the first k + 1 ids can be neighbours, and the others have those of the (k + 1)-th id,
    # which may be ids of vectors that aren't equal but whose cosine with them is 1 as well
    marked = usable.select("_id", F.xxhash64("_v").alias("same"))
    hot = marked.groupBy("same").count().filter(F.col("count") > k + 1).select("same")
    late = None
    if not (hot := materialize(hot, "hot")).isEmpty():
        rows = materialize(marked.join(hot, "same").distinct(), "equal-vectors")
        rank = F.row_number().over(Window.partitionBy("same").orderBy("_id"))
        last = rows.withColumn("rn", rank).filter(F.col("rn") == k + 1).select("same", F.col("_id").alias("like"))
        late = materialize(rows.join(last, "same").filter(F.col("_id") > F.col("like")).select("_id", "like"), "late")
        gone = late.select("_id").distinct()
        if late.count() <= BROADCAST_ROWS:
            usable = usable.join(F.broadcast(gone), "_id", "left_anti")
        else:  # joined once, as five steps read it
            usable = materialize(usable.join(gone, "_id", "left_anti"), "usable")

    def whole(ranked: DataFrame) -> DataFrame:
        if late is not None:
            ranked = materialize(ranked.select("_id", "neighbor", "similarity", "rank"), "ranked")
            found = F.collect_list(F.struct("neighbor", "similarity", "rank")).alias("found")
            likes = late.select("like").distinct()
            lists = ranked.join(likes, ranked["_id"] == likes["like"]).groupBy("like").agg(found)
            ranked = ranked.unionByName(late.join(lists, "like").select("_id", F.inline("found")))
        return ranked.withColumnRenamed("_id", id_col)

    if min_similarity is None:
        return whole(all_nearest(usable, dim, n_rows, k))

    sample = bounded_sample(usable, "_id", sample_rows)
    if not sample:
        return spark.createDataFrame([], out_schema + ", rank int").withColumnRenamed("_id", id_col)
    x = unit(np.array([r["_v"] for r in sample], np.float64)).astype(np.float32)
    model = fit(x, first=int(min(4096, max(32, n_rows**0.5 / 15))), seed=seed)
    few = spark.sparkContext.broadcast(model)  # codebooks: a fixed size

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = len(few.value.books[0])
        own, asked = np.zeros(cells, np.int64), np.zeros(cells, np.int64)
        for whole in batches:
            for lo in range(0, whole.num_rows, 2048):
                order, close = _visits(few.value, _units(whole.slice(lo, 2048), dim)[1], probes, probe_margin)
                own += np.bincount(order[:, 0], minlength=cells)
                asked += np.bincount(order[close], minlength=cells)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(cells, dtype=np.int32)), pa.array(own), pa.array(asked)], ["cell", "own", "asked"])

    # one row a cell, at most 4,096
    sizes = usable.select("_v").mapInArrow(count, "cell int, own long, asked long").groupBy("cell").agg(F.sum("own").alias("own"), F.sum("asked").alias("asked")).collect()
    d_blocks, q_blocks = np.ones(len(model.books[0]), np.int64), np.ones(len(model.books[0]), np.int64)
    for r in sizes:
        d_blocks[r.cell], q_blocks[r.cell] = max(1, -(-r.own // block_rows)), max(1, -(-r.asked // query_rows))
    ship = spark.sparkContext.broadcast((model, d_blocks, q_blocks))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, nd, nq = ship.value
        import xxhash

        for whole in batches:
            for lo in range(0, whole.num_rows, 2048):
                b = whole.slice(lo, 2048)
                if not b.num_rows:
                    continue
                raw, v = _units(b, dim)
                codes, near = m.encode(v)
                inverse = (1 / np.maximum(np.linalg.norm(near, axis=1), 1e-9)).astype(np.float32)
                ids = b.column("_id")
                h = np.fromiter((xxhash.xxh3_64_intdigest(i) >> 2 for i in ids.to_pylist()), np.int64, len(v))
                order, close = _visits(m, v, probes, probe_margin)
                who, slot = np.nonzero(close)
                cells = order[who, slot]
                home = order[:, 0]
                every = np.arange(len(v))
                # (row, cell, vector block, query block, role)
                one = (nd[cells] == 1) & (nq[cells] == 1)
                both = np.zeros(len(v), bool)
                both[who[one & (cells == home[who])]] = True
                keep = ~(one & (cells == home[who]))
                parts = [(every[both], home[both], 0 * home[both], 0 * home[both], np.full(both.sum(), BOTH))]
                asks = np.where(cells == home[who], HOME, VISITOR)[keep]
                for rows, at, own, other, role in ((every[~both], home[~both], nd, nq, np.full((~both).sum(), VECTOR)), (who[keep], cells[keep], nq, nd, asks)):
                    times = other[at]
                    r, c = np.repeat(rows, times), np.repeat(at, times)
                    across = np.arange(len(r)) - np.repeat(np.cumsum(times) - times, times)
                    mine = h[r] % own[c]
                    stored = own is nd
                    parts.append((r, c, mine if stored else across, across if stored else mine, np.repeat(role, times)))
                r, c, db, qb, role = (np.concatenate(z) for z in zip(*parts, strict=True))
                data = np.empty((len(r), 4 * dim), np.uint8)
                data[:] = raw.view(np.uint8).reshape(len(raw), -1)[r]
                vec = pa.FixedSizeBinaryArray.from_buffers(pa.binary(4 * dim), len(r), [None, pa.py_buffer(data)]).cast(pa.binary())
                stored = role <= BOTH  # a row that is only a query needs no code
                code = pa.FixedSizeBinaryArray.from_buffers(pa.binary(2 * codes.shape[1]), len(r), [None, pa.py_buffer(np.ascontiguousarray(codes[r].astype(np.uint16)))]).cast(pa.binary())
                code = pc.if_else(pa.array(stored), code, pa.scalar(None, pa.binary()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c.astype(np.int32)), pa.array(db.astype(np.int32)), pa.array(qb.astype(np.int32)), pa.array(role.astype(np.int8)), ids.take(pa.array(r)), vec, code, pa.array(inverse[r], mask=~stored)],
                    ["cell", "db", "qb", "role", "_id", "vec", "code", "inv"],
                )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = ship.value[0]

        def rows(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
            return b.column("_id").to_numpy(zero_copy_only=False), np.frombuffer(b"".join(b.column("vec").to_pylist()), np.float32).reshape(-1, dim)

        def block(parts: list[pa.RecordBatch]) -> Block:
            """Empties ``parts`` but for the first batch's first row, so that a block's vectors are held once."""
            n, at, last = sum(b.num_rows for b in parts), 0, None
            ids, vec = np.empty(n, object), np.empty((n, dim), np.float32)
            codes, inverse = np.empty((n, len(m.books)), np.uint16), np.empty(n, np.float32)
            head = parts[0].slice(0, 1)
            parts.reverse()
            while parts:
                b = parts.pop()
                names = b.column("_id").to_numpy(zero_copy_only=False)
                once = np.flatnonzero(np.concatenate([[names[0] != last], names[1:] != names[:-1]]))  # sorted: an id delivered twice counts once
                last, to = names[-1], at + len(once)
                ids[at:to], vec[at:to] = names[once], rows(b)[1][once]
                codes[at:to] = np.frombuffer(b"".join(b.column("code").to_pylist()), np.uint16).reshape(len(names), -1)[once]
                inverse[at:to] = b.column("inv").to_numpy(zero_copy_only=False)[once]
                at = to
            parts.append(head)
            return Block(ids[:at], vec[:at], codes[:at], inverse[:at], m, min_similarity)

        def answer(held: Block, ids: np.ndarray, vec: np.ndarray, back: np.ndarray | None) -> Iterator[pa.RecordBatch]:
            for lo in range(0, len(ids), 4096):
                i, j, cos = held.top(ids[lo : lo + 4096], vec[lo : lo + 4096], k)
                a, b, c = ids[i + lo], held.ids[j], cos
                if back is not None:  # a visitor's pair counts for the other side too, which may not visit the visitor's cell
                    turned = back[i + lo]
                    a, b, c = np.concatenate([a, b[turned]]), np.concatenate([b, a[turned]]), np.concatenate([c, c[turned]])
                if len(a):
                    yield pa.RecordBatch.from_arrays([pa.array(a, pa.string()), pa.array(b, pa.string()), pa.array(c)], ["_id", "neighbor", "similarity"])

        key, parts, held = None, [], None
        # sorted by group, then vectors before queries
        for whole in batches:
            marks = np.stack([whole.column(c).to_numpy() for c in ("cell", "db", "qb")], axis=1)
            role = whole.column("role").to_numpy()
            cuts = np.flatnonzero((marks[1:] != marks[:-1]).any(1) | ((role[1:] > BOTH) != (role[:-1] > BOTH))) + 1
            for lo, hi in zip([0, *cuts], [*cuts, len(role)], strict=True):
                if hi == lo:
                    continue
                if tuple(marks[lo]) != key:
                    if parts and parts[0].column("role")[0].as_py() == BOTH:
                        held = held or block(parts)
                        yield from answer(held, held.ids, held.vec, None)
                    key, parts, held = tuple(marks[lo]), [], None
                b = whole.slice(lo, hi - lo)
                if role[lo] <= BOTH:
                    parts.append(b)
                elif parts:
                    if held is None:
                        held = block(parts)
                    yield from answer(held, *rows(b), role[lo:hi] == VISITOR)
        if parts and parts[0].column("role")[0].as_py() == BOTH:
            held = held or block(parts)
            yield from answer(held, held.ids, held.vec, None)

    placed = usable.mapInArrow(place, "cell int, db int, qb int, role tinyint, _id string, vec binary, code binary, inv float")
    found = placed.repartition("cell", "db", "qb").sortWithinPartitions("cell", "db", "qb", "role", "_id").mapInArrow(search, out_schema)
    best = Window.partitionBy("_id").orderBy(F.desc("similarity"), "neighbor")
    ranked = found.withColumn("rank", F.dense_rank().over(best)).filter(F.col("rank") <= k)  # a pair that came twice has one rank
    return whole(ranked.dropDuplicates(["_id", "neighbor"]))


def _units(b: pa.RecordBatch, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """The vectors of a batch as they stand and with length one."""
    raw = b.column("_v").flatten().to_numpy().astype(np.float32).reshape(-1, dim)
    return raw, unit(raw.astype(np.float64)).astype(np.float32)


def _visits(model: Quantizer, v: np.ndarray, probes: int, margin: float) -> tuple[np.ndarray, np.ndarray]:
    """The first codewords nearest to each vector, nearest first, and which of them it visits as a query."""
    book = model.books[0]
    g = 2 * v @ book.T - (book * book).sum(1)
    probes = min(probes, len(book))
    order = np.argpartition(-g, probes - 1, axis=1)[:, :probes]
    order = np.take_along_axis(order, np.argsort(-np.take_along_axis(g, order, 1), axis=1), 1)
    dot = np.take_along_axis(g, order, 1)
    return order, dot >= dot[:, :1] - 2 * margin


def similar_pairs(neighbors: DataFrame, id_col: str = "chunk_id") -> DataFrame:
    """``(id_a, id_b)``, the smaller id first: each pair of which one is among the neighbours of the other."""
    return neighbors.select(F.least(id_col, "neighbor").alias(f"{id_col}_a"), F.greatest(id_col, "neighbor").alias(f"{id_col}_b")).distinct()
