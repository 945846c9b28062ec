"""Subject areas of texts by a chain of classifiers with beam-search decoding.

Link j of the chain is a logistic regression on the terms of a text (words, word pairs, and pairs of syllables of
Hangul words), its source label, its structure, and the labels given by the links before it, so that areas that occur
together support or exclude each other. Combinations of labels are decoded by a beam search over the links; their
log-probabilities are scaled by a temperature fitted on texts left out of the training.

Training texts are a bounded sample, balanced over label languages. Their labels come from people's labels of their
file and from the file's own domain label, both of which may be wrong or hold for other parts of the file: a first
model of terms alone is fitted to them, and its areas replace labels it contradicts before the chain is fitted.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomspark.llm.language import normalised_label
from loomspark.llm.sampling import bounded_sample

#: Other spellings of area codes in the labels of files, in lower case with '-' for blanks and '_'.
SPELLINGS = {
    "programming": ["coding", "software", "development"],
    "machine-learning": ["ml", "ai", "machinelearning"],
    "data-science": ["datascience", "statistics", "analytics"],
    "devops": ["dev-ops", "operations", "ops"],
    "web": ["frontend", "front-end", "web-development"],
    "database": ["databases", "db", "sql"],
    "law": ["legal"],
    "medicine": ["health", "medical", "healthcare"],
    "sport": ["sports"],
    "finance": ["money", "financial", "banking"],
}
_WORD = re.compile(r"[^\W\d_]+")
_CODE = re.compile(r"```.*?(?:```|\Z)|`[^`]*`", re.S)
_BREAK = re.compile(r"(?<=[^\W\d_])[-­‐¬]\s*\n\s*")
STRUCTURE = ["header", "list", "blockquote", "document", "paragraph"]
MAX_AREAS = 1000  # each is a link of the chain; more are an error


def area_code(label: Column, areas: list[str]) -> Column:
    """The area a label of a file names, null for none."""
    key = F.regexp_replace(F.lower(F.trim(label)), r"[ _]+", "-")
    names = {a: a for a in areas} | {s: a for a, ss in SPELLINGS.items() if a in areas for s in ss}
    return F.element_at(F.create_map(*(x for k, v in names.items() for x in (F.lit(k), F.lit(v)))), key)


def terms(text: str) -> list[str]:
    """The different words, word pairs and Hangul syllable pairs of the prose of a text."""
    words = _WORD.findall(_BREAK.sub("", _CODE.sub(" ", text)).lower())
    out = set(words)
    out.update(f"{a} {b}" for a, b in zip(words, words[1:], strict=False))
    for w in words:
        if "가" <= w[0] <= "힣":
            out.update(w[i : i + 2] for i in range(len(w) - 1))
    return sorted(out)


class Rows:
    """Rows of feature numbers in flat form."""

    def __init__(self, lists: list[list[int]], width: int):
        self.n, self.width = len(lists), width
        self.flat = np.fromiter((f for r in lists for f in r), np.int64)
        self.owner = np.repeat(np.arange(self.n), [len(r) for r in lists])
        size = np.bincount(self.owner, minlength=self.n)
        self.value = (1 / np.sqrt(np.maximum(size, 1)))[self.owner].astype(np.float32)
        order = np.argsort(self.flat, kind="stable")
        self.by_feature = (self.flat[order], self.owner[order], self.value[order])

    def dot(self, w: np.ndarray) -> np.ndarray:
        return _sums(self.owner, w[self.flat] * self.value[:, None], self.n)

    def back(self, g: np.ndarray) -> np.ndarray:
        flat, owner, value = self.by_feature
        return _sums(flat, g[owner] * value[:, None], self.width)


def _sums(keys: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """Sums of rows by sorted keys."""
    out = np.zeros((n, rows.shape[1]), rows.dtype)
    if len(keys):
        starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        out[keys[starts]] = np.add.reduceat(rows, starts, axis=0)
    return out


def _logistic(rows: Rows, dense: np.ndarray, y: np.ndarray, masks: np.ndarray, steps: int = 50, rate: float = 0.7, decay: float = 1e-4):
    """Weights (sparse, dense) of independent logistic regressions by Adam; masks[j] marks the dense inputs of link j."""
    k = y.shape[1]
    w, v = np.zeros((rows.width, k), np.float32), np.zeros((dense.shape[1], k), np.float32)
    state = [np.zeros_like(w), np.zeros_like(w), np.zeros_like(v), np.zeros_like(v)]
    for t in range(1, steps + 1):
        z = rows.dot(w) + dense @ v
        g = (1 / (1 + np.exp(-z)) - y) / len(y) * 10
        for p, grad, a, b in ((w, rows.back(g.astype(np.float32)) + decay * w, 0, 1), (v, (dense.T @ g) * masks.T + decay * v, 2, 3)):
            state[a] = 0.9 * state[a] + 0.1 * grad
            state[b] = 0.98 * state[b] + 0.02 * grad**2
            p -= (rate * 0.3 * (state[a] / (1 - 0.9**t)) / (np.sqrt(state[b] / (1 - 0.98**t)) + 1e-6)).astype(np.float32)
        rate *= 0.985
    return w, v


class Chain:
    """A fitted chain: vocabulary, term weights, dense weights (source, structure, earlier labels, bias), temperature."""

    def __init__(self, areas, vocabulary, w, v, n_side, temperature=1.0):
        self.areas, self.vocabulary, self.w, self.v, self.n_side, self.temperature = areas, vocabulary, w, v, n_side, temperature
        self.heads = frozenset(t.split(" ")[0] for t in vocabulary if " " in t)

    def known(self, text: str) -> list[int]:
        voc, heads = self.vocabulary, self.heads
        words = _WORD.findall(_BREAK.sub("", _CODE.sub(" ", text)).lower())
        out = set()
        last = None
        for w in words:
            if last is not None:
                i = voc.get(f"{last} {w}")
                if i is not None:
                    out.add(i)
            i = voc.get(w)
            if i is not None:
                out.add(i)
            if "가" <= w[0] <= "힣":
                for j in range(len(w) - 1):
                    i = voc.get(w[j : j + 2])
                    if i is not None:
                        out.add(i)
            last = w if w in heads else None
        return sorted(out)

    def decode(self, features: list[list[int]], side: np.ndarray, beam: int = 6) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Beams of label combinations (row, rank, area), their probabilities, and the marginal of each area."""
        base = Rows(features, len(self.w)).dot(self.w) + side @ self.v[: self.n_side]
        n, k = base.shape
        combos, logp = np.zeros((n, 1, k), np.float32), np.zeros((n, 1))
        for j in range(k):
            z = (base[:, j][:, None] + combos @ self.v[self.n_side :, j]) / self.temperature
            yes, no = -np.logaddexp(0, -z), -np.logaddexp(0, z)
            with_j = combos.copy()
            with_j[:, :, j] = 1
            combos = np.concatenate([with_j, combos], axis=1)
            logp = np.concatenate([logp + yes, logp + no], axis=1)
            if logp.shape[1] > beam:
                top = np.argpartition(-logp, beam - 1, axis=1)[:, :beam]
                combos, logp = np.take_along_axis(combos, top[:, :, None], 1), np.take_along_axis(logp, top, 1)
        order = np.argsort(-logp, axis=1)
        combos, logp = np.take_along_axis(combos, order[:, :, None], 1), np.take_along_axis(logp, order, 1)
        prob = np.exp(logp - logp.max(1, keepdims=True))
        prob /= prob.sum(1, keepdims=True)
        return combos, prob, (combos * prob[:, :, None]).sum(1) + 1e-6 / (1 + np.exp(-base))


def side_features(domains: list[str | None], kinds: list[str | None], areas: list[str]) -> np.ndarray:
    """Source and structure features: the area named by the file's own label, the kind of text, and a bias."""
    out = np.zeros((len(domains), len(areas) + len(STRUCTURE) + 1), np.float32)
    out[:, -1] = 1
    for i, (d, s) in enumerate(zip(domains, kinds, strict=True)):
        if d in areas:
            out[i, areas.index(d)] = 1
        if s in STRUCTURE:
            out[i, len(areas) + STRUCTURE.index(s)] = 1
    return out


def fit(texts: list[str], domains: list[str | None], kinds: list[str | None], people: list[dict[str, int]], areas: list[str], max_terms: int = 16_000) -> Chain:
    """Fit the chain on the ``max_terms`` most telling terms; ``people`` has how often people gave the file of each text an area."""
    k = len(areas)
    found = [terms(t) for t in texts]
    count = Counter(t for f in found for t in f)
    n = len(texts)
    kept = [t for t, c in count.items() if 3 <= c <= 0.15 * n]
    noisy = np.zeros((n, k), np.float32)
    for i, (d, p) in enumerate(zip(domains, people, strict=True)):
        for a, times in p.items():
            if a in areas:
                noisy[i, areas.index(a)] += 2.0 * times
        if d in areas:
            noisy[i, areas.index(d)] += 1.0
    labelled = noisy.sum(1) > 0
    first = noisy / np.maximum(noisy.sum(1, keepdims=True), 1)
    if not labelled.any() or not kept:
        return Chain(areas, {}, np.zeros((1, k), np.float32), np.zeros((k + len(STRUCTURE) + 1 + k, k), np.float32), k + len(STRUCTURE) + 1)
    # terms that tell areas apart: the spread of their label shares against that of all texts
    index = {t: i for i, t in enumerate(kept)}
    all_rows = Rows([[index[t] for t in f if t in index] for f in found], len(kept))
    flat, owner, _ = all_rows.by_feature
    share = _sums(flat, first[owner], len(kept))
    total = np.bincount(flat, minlength=len(kept))[:, None]
    prior = first[labelled].mean(0)
    lift = share / np.maximum(share.sum(1, keepdims=True), 1e-9) - prior
    worth = (lift**2 / np.maximum(prior, 0.01)).sum(1) * np.sqrt(total[:, 0])
    best = np.sort(np.argsort(-worth)[:max_terms])
    vocabulary = {kept[i]: j for j, i in enumerate(best)}
    lists = [[vocabulary[t] for t in f if t in vocabulary] for f in found]
    rows = Rows(lists, len(vocabulary))
    # a model of terms alone, twice: first on the labels as they are, then without those it contradicts
    bias, every = np.ones((n, 1), np.float32), np.ones((k, 1), np.float32)
    target = first
    use = labelled
    for _ in range(2):
        at = np.flatnonzero(use)
        w, v = _logistic(Rows([lists[i] for i in at], len(vocabulary)), bias[at], target[at], every)
        z = rows.dot(w) + bias @ v
        p = 1 / (1 + np.exp(-z))
        p /= p.sum(1, keepdims=True)
        target = np.zeros_like(first)
        target[np.arange(n), p.argmax(1)] = 1
        target[(p >= 0.35)] = 1
        use = p.max(1) >= 0.5
        if use.sum() < 20:
            use = labelled
    at = np.flatnonzero(use)
    side = side_features(domains, kinds, areas)
    n_side = side.shape[1]
    hold = at[::5] if len(at) >= 200 else at
    train = np.setdiff1d(at, hold) if len(at) >= 200 else at
    masks = np.ones((k, n_side + k), np.float32)
    masks[:, n_side:] = np.tril(np.ones((k, k)), -1)  # link j sees the labels before it
    w, v = _logistic(Rows([lists[i] for i in train], len(vocabulary)), np.hstack([side[train], target[train]]), target[train], masks)
    v *= masks.T
    chain = Chain(areas, vocabulary, w, v, n_side)
    # temperature: the scale under which the left-out combinations are likeliest
    base = Rows([lists[i] for i in hold], len(vocabulary)).dot(w) + np.hstack([side[hold], target[hold]]) @ v
    loss = lambda t: np.logaddexp(0, np.where(target[hold] > 0, -base, base) / t).mean()
    chain.temperature = min((0.25, 0.5, 0.75, 1.0, 1.5, 2.0, 3.0, 5.0), key=loss)
    return chain


def fit_on(chunks: DataFrame, labels: DataFrame, areas: list[str], sample_rows: int) -> Chain:
    """Fit on at most ``sample_rows`` prose chunks for each label language, with people's labels of their files."""
    # counted by file and area first, so that no row grows with the number of labels of a file
    counts = labels.filter(F.col("area").isin(areas) & F.col("source_file").isNotNull()).groupBy("source_file", "area").agg(F.count("*").alias("n"))
    people = counts.groupBy("source_file").agg(F.map_from_entries(F.collect_list(F.struct("area", "n"))).alias("people"))
    lang = normalised_label(F.col("language"))
    base = chunks.select("chunk_id", "source_file", F.col("chunk_text").alias("t"), area_code(F.col("domain"), areas).alias("d"), "chunk_type", F.when(lang.isin("en", "ko", "de", "fr", "es", "pt", "nl"), lang).otherwise("").alias("l"))
    base = base.join(people, "source_file", "left").filter(F.col("d").isNotNull() | F.col("people").isNotNull())
    rows = bounded_sample(base.select("chunk_id", "t", "d", "chunk_type", "l", "people"), "chunk_id", sample_rows, by="l")
    return fit([r.t for r in rows], [r.d for r in rows], [r.chunk_type for r in rows], [r.people or {} for r in rows], areas)


def chunk_subjects(chunks: DataFrame, labels: DataFrame, subject_areas: DataFrame, sample_rows: int = 2000, beam: int = 6) -> DataFrame:
    """``(chunk_id, source_file, area, probability, areas)`` of every chunk of ``chunks`` (prose only).

    ``area`` is the main subject, the one with the highest marginal; ``areas`` the likeliest combination. Rows
    delivered twice give equal rows. The chain is fitted on at most ``sample_rows`` chunks a label language; more than
    ``MAX_AREAS`` areas are an error. Without areas or chunks the result is empty; without labels the areas are guesses
    of equal probability, ties going to the first code.
    """
    spark = chunks.sparkSession
    found = subject_areas.select("area").filter("area is not null").distinct().limit(MAX_AREAS + 1).collect()
    if len(found) > MAX_AREAS:
        raise ValueError(f"more than {MAX_AREAS} subject areas")
    areas = sorted(r.area for r in found)
    schema = "chunk_id string, source_file string, area string, probability double, areas array<string>"
    if not areas:
        return spark.createDataFrame([], schema)
    ship = spark.sparkContext.broadcast(fit_on(chunks, labels, areas, sample_rows))  # bounded by max_terms

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = ship.value
        for whole in batches:
            for lo in range(0, whole.num_rows, 4000):
                b = whole.slice(lo, 4000)
                if not b.num_rows:
                    continue
                feats = [m.known(t) for t in b.column("t").to_pylist()]
                side = side_features(b.column("d").to_pylist(), b.column("chunk_type").to_pylist(), areas)
                combos, prob, marginal = m.decode(feats, side, beam)
                top = marginal.argmax(1)
                sets = [[areas[j] for j in np.flatnonzero(c[0])] or [areas[t]] for c, t in zip(combos, top, strict=True)]
                best = marginal[np.arange(len(top)), top].clip(0, 1)
                yield pa.RecordBatch.from_arrays(
                    [b.column("chunk_id"), b.column("source_file"), pa.array([areas[j] for j in top]), pa.array(best.astype(np.float64)), pa.array(sets, pa.list_(pa.string()))],
                    ["chunk_id", "source_file", "area", "probability", "areas"],
                )

    base = chunks.select("chunk_id", "source_file", F.col("chunk_text").alias("t"), area_code(F.col("domain"), areas).alias("d"), "chunk_type")
    return base.mapInArrow(run, schema)


def file_subjects(subjects: DataFrame, least_share: float = 0.25) -> DataFrame:
    """``(source_file, area, share)``: the areas that are the main subject of at least the share of a file's chunks."""
    one = subjects.groupBy("source_file", "chunk_id").agg(F.min("area").alias("area"))
    per = one.groupBy("source_file", "area").agg(F.count("*").alias("n"))
    total = per.groupBy("source_file").agg(F.sum("n").alias("total"))
    share = F.col("n") / F.col("total")
    return per.join(total, "source_file").filter(share >= least_share).select("source_file", "area", share.alias("share"))


def corpus_shares(subjects: DataFrame) -> DataFrame:
    """``(area, n_chunks, share)`` over all different chunks."""
    one = subjects.groupBy("chunk_id").agg(F.min("area").alias("area"))
    per = one.groupBy("area").agg(F.count("*").alias("n_chunks"))
    return per.crossJoin(per.agg(F.sum("n_chunks").alias("total"))).select("area", "n_chunks", (F.col("n_chunks") / F.col("total")).alias("share"))
