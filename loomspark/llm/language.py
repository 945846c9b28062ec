"""Language of documents and of their segments by a blended-spectrum string kernel.

Two texts are compared by the n-grams (lengths 2 to 4) that occur in both, presence only, normalised by the numbers of
n-grams in each. A bounded sample of labelled chunks is split into sentences; some of them, balanced over languages,
serve as Nystroem landmarks, and one-versus-rest kernel ridge regression is fitted in the landmark space (twice: wrong
labels of the first sample are left out of the second fit). Since the kernel is a product of presence vectors, the
regression weights are folded into one weight vector per landmark n-gram, and a batch of sentences is scored by one
product of its presence matrix with that weight matrix.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomspark.llm.sampling import bounded_sample

LANGUAGES = ["en", "ko", "de", "fr", "es", "pt", "nl"]
ORDERS = (2, 3, 4)

#: Notations of the seven languages, compared in lower case without region.
NOTATIONS = {
    "en": ["en", "eng", "english"],
    "ko": ["ko", "kor", "korean"],
    "de": ["de", "deu", "ger", "german"],
    "fr": ["fr", "fra", "fre", "french"],
    "es": ["es", "spa", "spanish"],
    "pt": ["pt", "por", "portuguese"],
    "nl": ["nl", "nld", "dut", "dutch"],
}
#: Labels that stand for a language that isn't known.
NOT_KNOWN = ["", "unknown", "und", "undefined", "undetermined", "n/a", "na", "none", "null", "nan", "-", "?", "xx", "mul", "zxx"]

_CODE = re.compile(r"```.*?(?:```|\Z)|`[^`]*`", re.S)
_ASIDE = re.compile(r"\([^()]*\)|\[[^\[\]]*\]")
_BLOCK = re.compile(r"\n\s*\n|\n(?=\s*(?:[-*+>#|]|\d+[.)])\s?)")
_MARK = re.compile(r"^\s*(?:(?:[-*+>]|\d+[.)])\s+)+")
_STOP = re.compile(r"(?<=[.!?。！？])[\"'”’»)\]]*\s+")
_WHOLE = re.compile(r"(?:[^\W\d_]{2}|\d)[\"'”’»\s]*[.!?。！？][\"'”’»)\]\s]*$")
_WORD = re.compile(r"[^\W\d_]+")
_BREAK = re.compile(r"(?<=[^\W\d_])[-­‐¬]\s*\n\s*")
_MULT = np.uint64(0x9E3779B97F4A7C15)


def normalised_label(label: Column) -> Column:
    """The ISO code of a language label in any notation; '' for not known, other labels as they are in lower case."""
    base = F.lower(F.trim(F.coalesce(label, F.lit(""))))
    head = F.regexp_replace(base, "[-_].*$", "")
    known = F.create_map(*(x for code, names in NOTATIONS.items() for n in names for x in (F.lit(n), F.lit(code))))
    return F.when(base.isin(NOT_KNOWN), F.lit("")).otherwise(F.coalesce(F.element_at(known, head), base))


def pieces(text: str) -> list[str]:
    """The sentences of the prose of a text: headings, code, and asides in brackets are left out."""
    if "\r" in text:
        text = text.replace("\r\n", "\n")
    if "`" in text:
        text = _CODE.sub(" ", text)
    if "\n" in text:
        text = _BREAK.sub("", text)
    found = []
    for block in _BLOCK.split(text):
        block = block.lstrip()
        if block.startswith(("#", "|")):
            first, _, block = block.partition("\n")  # the line after a heading may be prose
            if first[0] == "|":
                continue
        block = _MARK.sub("", block)
        if "(" in block or "[" in block:
            block = _ASIDE.sub(" ", block)
        found += [s for s in _STOP.split(" ".join(block.split())) if _WORD.search(s)]
    return found


def is_whole(sentence: str) -> bool:
    """Whether a sentence ends with a stop, has three words or more, and begins like one: a few words in small letters are a rest."""
    if not _WHOLE.search(sentence[-24:]):
        return False
    return sentence.count(" ") >= 8 or (len(_WORD.findall(sentence)) >= 3 and not sentence.lstrip("\"'“”‘’«»„¿¡*_ ")[:1].islower())


def sentences(text: str) -> list[tuple[str, bool]]:
    """(sentence, whole) of a text."""
    return [(s, is_whole(s)) for s in pieces(text)]


def presence(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The presence matrix of texts in coordinate form, (text number, gram hash), and the row sizes."""
    joined = "\x00".join(texts).lower() + "\x00" * max(ORDERS)
    chars = np.frombuffer(joined.encode("utf-32-le"), np.uint32).astype(np.uint64)
    codes, h = [], chars * _MULT
    usable = chars != 0
    owner = np.cumsum(~usable).astype(np.uint64) << np.uint64(44)  # 20 bits of text number above 44 bits of hash
    for n in range(2, max(ORDERS) + 1):
        h = (h[:-1] ^ (h[:-1] >> np.uint64(29))) * _MULT
        h += chars[n - 1 :]
        usable = usable[:-1] & (chars[n - 1 :] != 0)
        if n in ORDERS:
            k = h[usable]
            k ^= k >> np.uint64(32)
            k *= _MULT
            k >>= np.uint64(20)
            k |= owner[: len(usable)][usable]
            codes.append(k)
    code = np.concatenate(codes)
    code.sort()
    if len(code):
        code = code[np.concatenate([[True], code[1:] != code[:-1]])]  # presence, not counts
    who = (code >> np.uint64(44)).astype(np.int64)
    return who, code & np.uint64((1 << 44) - 1), np.bincount(who, minlength=len(texts))[: len(texts)]


class KernelModel:
    """Weights per landmark n-gram; ``scores`` is the batched product of presence rows with them."""

    BITS = 18

    def __init__(self, grams: np.ndarray, weights: np.ndarray, beta: float):
        self.grams, self.weights, self.beta = grams, np.asarray(weights, np.float32), beta
        self._table = self._more = None

    def __getstate__(self):
        return {"grams": self.grams, "weights": self.weights, "beta": self.beta, "_table": None, "_more": None}

    def scores(self, texts: list[str]) -> np.ndarray:
        if self._table is None:  # hash bits -> first gram with them; grams are in the order of these bits, the full hash is compared
            slot = (self.grams & np.uint64((1 << self.BITS) - 1)).astype(np.int64)
            order = np.argsort(slot, kind="stable")
            self.grams, self.weights, slot = self.grams[order], self.weights[order], slot[order]
            self._table = np.full(1 << self.BITS, -1, np.int32)
            self._table[slot[::-1]] = np.arange(len(slot), dtype=np.int32)[::-1]
            self._more = np.concatenate([slot[1:] == slot[:-1], [False]])
        who, key, size = presence(texts)
        at = self._table[(key & np.uint64((1 << self.BITS) - 1)).astype(np.int64)]
        hit = at >= 0
        who, key, at = who[hit], key[hit], at[hit]
        same = self.grams[at] == key
        left = np.flatnonzero(~same & self._more[at])
        while len(left):  # the next gram with the same bits
            at[left] += 1
            same[left] = self.grams[at[left]] == key[left]
            left = left[~same[left] & self._more[at[left]]]
        who, at = who[same], at[same]
        out = np.zeros((len(texts), self.weights.shape[1]))
        if len(who):
            starts = np.flatnonzero(np.concatenate([[True], who[1:] != who[:-1]]))
            out[who[starts]] = np.add.reduceat(self.weights[at], starts, axis=0)
        return out / np.sqrt(np.maximum(size, 1))[:, None]


def _kernel(a: tuple, b: tuple, n_a: int, n_b: int) -> np.ndarray:
    """The normalised presence kernel between two lists of texts in coordinate form."""
    grams = np.unique(np.concatenate([a[1], b[1]]))
    out = np.zeros((n_a, n_b))
    ia, ib = np.searchsorted(grams, a[1]), np.searchsorted(grams, b[1])
    for lo in range(0, len(grams), 4096):  # dense blocks of columns keep the product in one matrix multiplication
        ma, mb = (ia >= lo) & (ia < lo + 4096), (ib >= lo) & (ib < lo + 4096)
        da, db = np.zeros((n_a, 4096), np.float32), np.zeros((n_b, 4096), np.float32)
        da[a[0][ma], ia[ma] - lo] = 1
        db[b[0][mb], ib[mb] - lo] = 1
        out += da @ db.T
    return out / np.sqrt(np.maximum(a[2], 1))[:, None] / np.sqrt(np.maximum(b[2], 1))[None, :]


def _fit_once(texts: list[str], labels: np.ndarray, landmarks: int, ridge: float) -> KernelModel:
    n_lang = len(LANGUAGES)
    per = max(1, landmarks // n_lang)
    chosen = np.concatenate([np.flatnonzero(labels == c)[:per] for c in range(n_lang)])
    marks = presence([texts[i] for i in chosen])
    rows = presence(texts)
    k_mm, k_nm = _kernel(marks, marks, len(chosen), len(chosen)), _kernel(rows, marks, len(texts), len(chosen))
    val, vec = np.linalg.eigh(k_mm)
    keep = val > 1e-6 * val.max()
    root = vec[:, keep] / np.sqrt(val[keep])
    phi = np.hstack([k_nm @ root])
    y = np.where(labels[:, None] == np.arange(n_lang)[None, :], 1.0, -1.0)
    share = np.bincount(labels, minlength=n_lang) / len(labels)
    w = 1 / np.maximum(share[labels], 1e-9) / n_lang  # languages count alike
    beta = np.linalg.solve(phi.T @ (phi * w[:, None]) + ridge * np.eye(phi.shape[1]), phi.T @ (y * w[:, None]))
    alpha = root @ beta / np.sqrt(np.maximum(marks[2], 1))[:, None]
    grams, inverse = np.unique(marks[1], return_inverse=True)
    folded = np.stack([np.bincount(inverse, weights=alpha[marks[0], c], minlength=len(grams)) for c in range(n_lang)], axis=1)
    return KernelModel(grams, folded, 1.0)


def fit(texts: list[str], labels: list[str], landmarks: int = 350, ridge: float = 0.1, per_language: int = 500) -> KernelModel:
    """Fit on whole sentences of texts with (partly wrong) labels, at most ``per_language`` for each label; languages without a text keep a score of -1."""
    sent, lab = [], []
    count = dict.fromkeys(LANGUAGES, 0)
    for t, l in zip(texts, labels, strict=True):
        for s, whole in sentences(t or ""):
            if whole and count[l] < per_language:
                count[l] += 1
                sent.append(s)
                lab.append(LANGUAGES.index(l))
    if not sent:
        return KernelModel(np.zeros(1, np.uint64), np.zeros((1, len(LANGUAGES))), 1.0)
    lab = np.array(lab)
    model = _fit_once(sent, lab, landmarks, ridge)
    for _ in range(2):
        right = model.scores(sent).argmax(1) == lab
        model = _fit_once([s for s, r in zip(sent, right, strict=True) if r], lab[right], landmarks, ridge)
    scores = model.scores(sent)
    right = scores.argmax(1) == lab
    best = (np.inf, 1.0)
    for b in (1, 2, 4, 6, 8, 12):  # calibrated confidence: the softmax scale with the least log loss
        z = b * scores[right]
        z = z - z.max(1, keepdims=True)
        loss = -(z[np.arange(len(z)), lab[right]] - np.log(np.exp(z).sum(1))).mean()
        best = min(best, (loss, float(b)))
    model.beta = best[1]
    return model


def label_sentences(scores: np.ndarray, doubt: float = 0.25) -> list[int]:
    """The language number of each sentence; where the two best scores are close, the better of them in the whole text."""
    order = np.argsort(-scores, axis=1)
    return _settled([(r, int(a), int(b), bool(r[a] - r[b] < doubt)) for r, (a, b) in zip(scores, order[:, :2], strict=True)], [SHORT] * len(scores))


SHORT = 8  # sentences of fewer characters say too little by themselves


def _settled(rated: list[tuple], sizes: list[int]) -> list[int]:
    """``rated`` has (scores, best, second, close) of each sentence of a text, ``sizes`` their lengths.

    Short sentences go with the one before them, at the start with the one after; where all are short they count together.
    """
    if min(sizes) >= SHORT:
        if not any(r[3] for r in rated):
            return [r[1] for r in rated]
        total = np.sum([r[0] for r in rated], axis=0)
        return [a if not close or total[a] >= total[b] else b for _, a, b, close, *_ in rated]
    long = [i for i, n in enumerate(sizes) if n >= SHORT]
    if not long:
        return [int(np.sum([r[0] for r in rated], axis=0).argmax())] * len(rated)
    labels = dict(zip(long, _settled([rated[i] for i in long], [SHORT] * len(long)), strict=True))
    out, last = [], labels[long[0]]
    for i in range(len(rated)):
        last = labels.get(i, last)
        out.append(last)
    return out


def rate(model: KernelModel, texts: list[str], doubt: float = 0.25) -> list[tuple]:
    """(scores, best, second, close, probabilities, whole) of each sentence."""
    scores = model.scores(texts)
    order = np.argsort(-scores, axis=1)
    row = np.arange(len(texts))
    close = scores[row, order[:, 0]] - scores[row, order[:, 1]] < doubt
    z = np.exp(model.beta * (scores - scores.max(1, keepdims=True)))
    prob = z / z.sum(1, keepdims=True)
    return list(zip(scores, order[:, 0].tolist(), order[:, 1].tolist(), close.tolist(), prob.tolist(), map(is_whole, texts), strict=True))


def fit_on(chunks: DataFrame, id_col: str, text_col: str, label_col: str, sample_rows: int) -> KernelModel:
    """Fit on at most ``sample_rows`` rows per language with a usable label, taken by hash of the id."""
    usable = chunks.filter(F.length(text_col) > 0).select(F.col(id_col).alias("i"), F.col(text_col).alias("t"), normalised_label(F.col(label_col)).alias("l"))
    rows = bounded_sample(usable.filter(F.col("l").isin(LANGUAGES)), "i", sample_rows, by="l")
    return fit([r.t for r in rows], [r.l for r in rows])


def detect_segments(
    chunks: DataFrame, id_col: str = "chunk_id", text_col: str = "chunk_text", label_col: str = "language", sample_rows: int = 200, model: KernelModel | None = None
) -> DataFrame:
    """``(id, label, language, confidence, segments, whole_languages)`` of every row with prose.

    The model is fitted on at most ``sample_rows`` labelled rows a language. ``language`` has the most characters, ``segments`` are runs of sentences of one language with their confidence,
    ``whole_languages`` the languages with a whole sentence, ``label`` the label's ISO code or ''. Null and empty
    texts and texts without prose give language null, confidence 0 and no segments. Rows delivered twice give equal
    rows. An empty table gives an empty result.
    """
    model = model or fit_on(chunks, id_col, text_col, label_col, sample_rows)
    ship = chunks.sparkSession.sparkContext.broadcast(model)  # landmark grams only: bounded by landmarks x text length
    kind = chunks.schema[id_col].dataType.simpleString()
    seg = "array<struct<text:string,language:string,confidence:double>>"
    seg_arrow = pa.list_(pa.struct([("text", pa.string()), ("language", pa.string()), ("confidence", pa.float64())]))
    names = ["_id", "label", "language", "confidence", "segments", "whole_languages"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = ship.value
        known: dict[str, tuple] = {}
        for whole_batch in batches:
            for at in range(0, whole_batch.num_rows, 4000):
                b = whole_batch.slice(at, 4000)
                split = [pieces(t) if t else [] for t in b.column("_text").to_pylist()]
                if len(known) > 200_000:
                    known = {}
                new = list({s for p in split for s in p if s not in known})
                for lo in range(0, len(new), 2_000):  # so few that the sorted grams stay in a core's cache
                    known.update(zip(new[lo : lo + 2_000], rate(m, new[lo : lo + 2_000]), strict=True))
                lang, conf, segs, wholes = [], [], [], []
                for p in split:
                    if not p:
                        lang.append(None), conf.append(0.0), segs.append([]), wholes.append([])
                        continue
                    rated = [known[s] for s in p]
                    labels = _settled(rated, [len(s) for s in p])
                    runs, size = [], [0] * len(LANGUAGES)
                    for s, l, r in zip(p, labels, rated, strict=True):
                        size[l] += len(s)
                        if runs and runs[-1][1] == l:
                            runs[-1][0].append(s)
                            runs[-1][2].append(r[4][l])
                        else:
                            runs.append(([s], l, [r[4][l]]))
                    top = size.index(max(size))
                    lang.append(LANGUAGES[top])
                    own = [q for _, l, c in runs if l == top for q in c]
                    conf.append(sum(own) / len(own))
                    segs.append([{"text": " ".join(t), "language": LANGUAGES[l], "confidence": sum(c) / len(c)} for t, l, c in runs])
                    wholes.append(sorted({LANGUAGES[l] for l, r in zip(labels, rated, strict=True) if r[5]}))
                yield pa.RecordBatch.from_arrays([b.column("_id"), b.column("label"), pa.array(lang, pa.string()), pa.array(conf, pa.float64()), pa.array(segs, seg_arrow), pa.array(wholes, pa.list_(pa.string()))], names)

    base = chunks.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"), normalised_label(F.col(label_col)).alias("label"))
    found = base.mapInArrow(run, f"_id {kind}, label string, language string, confidence double, segments {seg}, whole_languages array<string>")
    return found.withColumnRenamed("_id", id_col)


def wrong_labels(detected: DataFrame, id_col: str = "chunk_id") -> DataFrame:
    """``(id, lang_code)``: the languages of texts whose label is missing or wrong, or that hold several languages."""
    many = F.size("whole_languages") > 1
    off = (F.size("whole_languages") == 1) & (F.col("label") != F.element_at("whole_languages", 1))
    return detected.filter(many | off).select(id_col, F.explode("whole_languages").alias("lang_code")).distinct()
