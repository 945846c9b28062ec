"""Repair of text from scanned pages.

Whether a file was scanned is a latent state: a two-class mixture over the shares of its chunks with heading marks, words
broken at line ends, page numbers, and digits inside words, fitted by expectation-maximisation on a bounded sample of
files. Lines of scanned files are labelled as body, break (a body line that ends in a broken word), running header, page
number, title or blank by a hidden Markov model over layout features (shape of the line, a hyphen at its end, likeness to
the document's name, likeness to the section's heading), trained by Viterbi re-estimation on a bounded sample of chunks.
Body lines are put together into paragraphs across the page furniture, and words broken at the end of break lines are
joined. Words with misread characters are set right by the counts that the possible readings have in the whole corpus: a
word and its readings share a folded form in which all characters that are mistaken for each other are one, so that words
of any length meet their readings in one join; the readings are then checked character by character.
"""

from __future__ import annotations

import difflib
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loomspark.llm.sampling import bounded_sample
from loomspark.session import materialize

#: How characters are misread, (as read, right).
MISREAD = [
    ("c", "e"), ("l", "t"), ("ä", "a"), ("í", "i"), ("ri", "n"), ("0", "o"), ("1", "l"), ("5", "s"), ("ii", "u"), ("cl", "d"),
    ("rn", "m"), ("9", "g"), ("b", "h"), ("h", "li"), ("vv", "w"), ("6", "é"), ("ﬁ", "fi"), ("ﬂ", "fl"), ("ﬀ", "ff"), ("5", "S"), ("0", "O"), ("1", "I"), ("8", "B"), ("c", "ç"), ("a", "ä"), ("o", "ó"), ("e", "é"), ("i", "í"),
]
BROKEN = re.compile(r"([^\W_][\w’'\-]*)[-‐¬\xad]\s*$")
JOIN = re.compile(r"\w[-‐¬\xad][ \t]*\n\s*\w[\w’'\-]*")
HEADING = re.compile(r"^#{1,6} ", re.M)
PAGE = re.compile(
    r"^[\W_]*(?:(?:page|página|pagina|seite|pág|blz|bladzijde|p|s)\b\.?\s*)?(?:\d{1,4}|[ivxlc]{1,8})(?:\s*(?:/|of|de|von|van|sur)\s*\d{1,4})?[\W_]*$", re.I
)
EDGES = re.compile(r"^\W+|\W+$")
CODE = re.compile(r"`[^`\n]*`")
START = "\x03"
DIGIT_INSIDE = re.compile(r"[^\W\d_]{2}[0159](?=[^\W\d_])|\b[0159][^\W\d_]{3}")
_FOLD = str.maketrans("0159íä6", "olsgiaé")
_NUMBER = r"(?:\d{1,4}|[ivxlc]{1,8})"
_AROUND = re.compile(rf"^\s*{_NUMBER}\s*\|\s*|\s*[·|]\s*\d{{1,3}}(?:\s*/\s*\d+)?\s*$|\s{{2,}}{_NUMBER}\s*$|\s+\d{{1,4}}\s*/\s*\d{{1,4}}\s*$", re.I)
STATES = ["body", "break", "title", "header", "page", "blank"]
SIGNS = ("heads", "broken", "pages", "digits")  # chunks of a file with heading marks, broken words, page numbers, digits inside words


def fold(text: str) -> str:
    return text.casefold().translate(_FOLD)


def like(a: str, b: str) -> float:
    if not a or not b or abs(len(a) - len(b)) > 0.4 * max(len(a), len(b)):
        return 0.0
    return difflib.SequenceMatcher(None, a, b, autojunk=False).ratio()


def names_of(title: str | None, source_file: str | None) -> list[str]:
    """What a running header may show: the document's title and the name in it, or the name in the file name."""
    out = []
    if title:
        out.append(fold(title))
        out.append(fold(title.split(" – ")[-1]))
    stem = re.sub(r"\.\w+$", "", source_file or "")
    parts = [p for p in re.split(r"[_\-\s]", stem) if p.isalpha()]
    if not title and parts:
        out.append(fold(max(parts, key=len)))
    return [x for x in dict.fromkeys(out) if len(x) >= 3]


def is_running_name(line: str, names: list[str]) -> bool:
    """Whether the line is one of the names, alone or with a year or one more word, with or without a page number."""
    core = fold(_AROUND.sub("", line.strip()).strip())
    if not core or core[-1] in ".,;:!?)":
        return False
    head, _, rest = core.partition(" · ")
    forms = [core, head if re.fullmatch(r"[0-9olsgié]{4}", rest.strip()) else core, core.rpartition(" ")[0] or core]
    return any(like(f, n) >= 0.78 for f in forms for n in names)


def features(lines: list[str], names: list[str], heading: str | None) -> list[int]:
    """One symbol for each line: its shape, whether it is a running name, whether it is the section's heading, whether a word is broken at its end."""
    width = max((len(x) for x in lines), default=0)
    head = fold(heading or "")
    out = []
    for x in lines:
        s = x.strip()
        if not s:
            out.append(0)
            continue
        if PAGE.match(s) and not re.search(r"\d[.,;:!?)]$", s):
            shape = 1
        elif len(s) < 0.6 * width and s[-1] not in ".,;:!?":
            shape = 2
        else:
            shape = 3
        out.append(shape + 4 * is_running_name(s, names) + 8 * bool(head and like(fold(s), head) >= 0.8) + 16 * bool(BROKEN.search(s)))
    return out


class LineModel:
    """Start, transition and emission log-probabilities of the states; the first guesses count as ``prior_lines`` lines a state."""

    def __init__(self, prior_lines: float = 200.0) -> None:
        n, m = len(STATES), 32
        self.prior_lines = prior_lines
        emit = np.full((n, m), 0.01)
        body, broken, title, header, page, blank = range(n)
        emit[blank, 0] = 100
        emit[page, [1, 5]] = 50, 1
        emit[header, [5, 6, 7]] = 5, 50, 30
        emit[title, [10, 11, 14]] = 50, 20, 3
        emit[body, [2, 3]] = 10, 90
        emit[broken, [18, 19]] = 10, 90
        move = np.full((n, n), 1.0)
        move[body, body], move[body, broken], move[broken, body], move[page, header], move[header, page] = 20, 10, 20, 3, 3
        self.emit, self.move = np.log(emit / emit.sum(1, keepdims=True)), np.log(move / move.sum(1, keepdims=True))

    def label(self, symbols: list[int]) -> list[int]:
        if not symbols:
            return []
        best, came = self.emit[:, symbols[0]].copy(), []
        for s in symbols[1:]:
            step = best[:, None] + self.move
            came.append(step.argmax(0))
            best = step.max(0) + self.emit[:, s]
        state, out = int(best.argmax()), []
        for c in reversed(came):
            out.append(state)
            state = int(c[state])
        return [*out, state][::-1]

    def train(self, sequences: list[list[int]], rounds: int = 6) -> None:
        """Viterbi re-estimation until no label changes, ``rounds`` times at most."""
        emit0, move0 = np.exp(self.emit) * self.prior_lines, np.exp(self.move) * self.prior_lines
        last = None
        for _ in range(rounds):
            emit, move = emit0.copy(), move0.copy()
            labels = [self.label(symbols) for symbols in sequences]
            for states, symbols in zip(labels, sequences, strict=True):
                for s, x in zip(states, symbols, strict=True):
                    emit[s, x] += 1
                for a, b in zip(states, states[1:], strict=False):
                    move[a, b] += 1
            self.emit, self.move = np.log(emit / emit.sum(1, keepdims=True)), np.log(move / move.sum(1, keepdims=True))
            if labels == last:
                break
            last = labels


def fit_scanned(counts: np.ndarray, rounds: int = 40) -> tuple[np.ndarray, float]:
    """Two-class mixture over files: log-odds of scanned for a chunk with and without each sign, and of a file before any sign.

    ``counts`` has for each file its chunks and its chunks with each of ``SIGNS``. A file without signs is more likely not scanned.
    """
    rate = np.array([[0.02, 0.5, 0.2, 0.3], [0.5, 0.01, 0.01, 0.05]])
    share = 0.1
    n, k = counts[:, :1].astype(float), counts[:, 1:].astype(float)
    odds = lambda: np.log(share / (1 - share)) + (k * np.log(rate[0] / rate[1]) + (n - k) * np.log((1 - rate[0]) / (1 - rate[1]))).sum(1)
    for _ in range(rounds if len(counts) else 0):
        p = 1 / (1 + np.exp(-np.clip(odds(), -50, 50)))
        for c, w in ((0, p), (1, 1 - p)):
            # the first guess counts as five chunks, so that a class without files stays what it is
            start = np.array([[0.02, 0.5, 0.2, 0.3], [0.5, 0.01, 0.01, 0.05]])[c]
            rate[c] = np.clip(((w[:, None] * k).sum(0) + 5 * start) / ((w[:, None] * n).sum() + 5), 1e-3, 1 - 1e-3)
        share = float(np.clip((p.sum() + 0.5) / (len(p) + 5), 1e-3, 0.5))
    return np.stack([np.log(rate[0] / rate[1]), np.log((1 - rate[0]) / (1 - rate[1]))]), float(np.log(share / (1 - share)))


def labelled(model: LineModel, text: str, title: str | None, source_file: str | None, heading: str | None) -> list[tuple[str, str]]:
    """(line, state) of each line of a text."""
    lines = text.replace("\r\n", "\n").split("\n")
    return [(x, STATES[s]) for x, s in zip(lines, model.label(features(lines, names_of(title, source_file), heading)), strict=True)]


def words_of(text: str) -> list[str]:
    """The words between blanks without the punctuation around them; code is left out.

    A word that begins with a digit read for a letter, at the start of a sentence, has the mark START before it.
    """
    out, start = [], True
    for x in CODE.sub(" ", text).split():
        w = EDGES.sub("", x)
        if w and any(c.isalpha() for c in w):
            out.append(START + w if start and w[0] in "5018" else w)
        start = x[-1] in ".!?:"
    return out


def parts_of(lines: list[tuple[str, str]]) -> list[tuple[str, str]]:
    """Paragraphs of a text as (kind, piece): kind text, break for a word broken in two (left and right with \\x01), gap."""
    out: list[tuple[str, str]] = []
    blank = open_word = False
    for line, state in lines:
        s = line.strip()
        if state in ("header", "page"):
            continue
        if not s:
            blank = True
            continue
        last = out[-1][1] if out else ""
        broken = BROKEN.search(last) if open_word and out[-1][0] == "text" else None
        open_word = state == "break"
        if broken and state != "title" and s[0].isalpha() and (s[0].islower() or not blank):
            right, _, rest = s.partition(" ")
            tail = re.search(r"[^\w’'\-]+.*$", right)
            word = right[: tail.start()] if tail else right
            out[-1] = ("text", last[: broken.start()])
            out.append(("break", f"{broken.group(1)}\x01{word}"))
            out.append(("text", f"{tail.group() if tail else ''} {rest}".rstrip() if rest or tail else ""))
        elif not out:
            out.append(("text", s))
        elif state == "title" or (blank and not (last and last[-1] not in ".!?:”\"»)" and s[0].islower())):
            out += [("gap", "\n\n"), ("text", s)]
        else:
            out[-1] = ("text", f"{last} {s}")  # an empty piece follows a broken word
        blank = state == "title"
    return out


def folded(word: Column) -> Column:
    """A word in the form in which all characters of ``MISREAD`` that are mistaken for each other are one; a first capital counts as small."""
    low = F.concat(F.lower(F.substring(word, 1, 1)), F.substring(word, 2, F.length(word)))
    one = F.translate(low, "eéç6t1Iiíä0Oó5S9", "cccclllllaooossg")
    for sign, by in (("n", "rl"), ("u", "ll"), ("d", "cl"), ("m", "rrl"), ("b", "ll"), ("h", "ll"), ("8", "ll"), ("w", "vv"), ("ﬁ", "fl"), ("ﬂ", "fl"), ("ﬀ", "ff")):
        one = F.replace(one, F.lit(sign), F.lit(by))
    return one


_BY_FIRST: dict[str, list[tuple[str, str]]] = {}
for _wrong, _right in MISREAD:
    _BY_FIRST.setdefault(_wrong[0], []).append((_wrong, _right))


def misreads(word: str, reading: str, start: bool) -> int | None:
    """The least number of misread places that turn ``reading`` into ``word``, None if none do.

    Capitals are misread at the start of a word only; a digit that begins a sentence (``start``) isn't a small letter.
    """
    best: list[dict[int, int]] = [{} for _ in range(len(word) + 1)]
    best[0][0] = 0
    for i, c in enumerate(word):
        for j, cost in best[i].items():
            if j < len(reading) and reading[j] == c:
                best[i + 1][j + 1] = min(cost, best[i + 1].get(j + 1, cost))
            for wrong, right in _BY_FIRST.get(c, ()):
                fits = i == 0 if right.isupper() else not (start and i == 0 and wrong in "5018")
                if fits and word.startswith(wrong, i) and reading.startswith(right, j):
                    at, to = i + len(wrong), j + len(right)
                    best[at][to] = min(cost + 1, best[at].get(to, cost + 1))
    return best[len(word)].get(len(reading))


def corpus_signs(chunks: DataFrame) -> DataFrame:
    """``(key, is_word, n, heads, broken, pages, digits)``: counts of all words, and of the chunks of each file with each sign of ``SIGNS``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            words, files = Counter(), {}
            for f, t in zip(b.column("source_file").to_pylist(), b.column("chunk_text").to_pylist(), strict=True):
                if not t:
                    continue
                joined = bool(JOIN.search(t))
                words.update((JOIN.sub(" ", t) if joined else t).split())
                if f is not None:
                    c = files.setdefault(f, [0] * 5)
                    c[0] += 1
                    c[1] += bool(HEADING.search(t))
                    c[2] += joined
                    c[3] += any(PAGE.match(x) for x in map(str.strip, t.split("\n")) if x)
                    c[4] += bool(DIGIT_INSIDE.search(CODE.sub(" ", t)))
            bare = Counter()
            for w, n in words.items():
                w = EDGES.sub("", w)
                if w and not w.isdigit():
                    bare[w] += n
            rows = [(w, True, n, 0, 0, 0, 0) for w, n in bare.items()] + [(f, False, *c) for f, c in files.items()]
            kinds = [pa.string(), pa.bool_(), *[pa.int64()] * 5]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], ["key", "is_word", "n", *SIGNS])

    counted = chunks.select("source_file", "chunk_text").mapInArrow(run, "key string, is_word boolean, n bigint, " + ", ".join(f"{s} bigint" for s in SIGNS))
    return counted.groupBy("key", "is_word").agg(*(F.sum(c).alias(c) for c in ("n", *SIGNS)))


FEW_FILES = 20_000  # names of so many files (under 2 MB) may be broadcast; more are joined by a shuffle


def scanned_repair(
    chunks: DataFrame, sample_rows: int = 1500, sample_files: int = 4000, least_count: int = 3, ratio: float = 20.0, misread_share: float = 0.25, least_posterior: float = 0.1
) -> tuple[DataFrame, DataFrame]:
    """Damage ``(chunk_id, noise_type, fixed_text)`` and readable texts ``(chunk_id, repaired)`` of chunks from scanned files.

    A reading with misread places set right is taken if the corpus has it ``least_count`` times and ``ratio`` times as
    often as the word as it stands, and two places or ``misread_share`` of its characters are misread at most. A broken
    word gets the reading, with or without its own hyphen, that the corpus has most often, and is closed up if it has none.
    Null and empty texts, and files scanned with a posterior below ``least_posterior``, give no rows (it is low, since
    lines and words are still judged each for itself); rows delivered twice count once; an
    empty table gives empty results. The mixture over files is fitted on at most ``sample_files`` files, the line model on
    at most ``sample_rows`` chunks.
    """
    spark = chunks.sparkSession
    rows = chunks.filter(F.length("chunk_text") > 0).select("chunk_id", "source_file", "chunk_text", F.get("section_path", F.lit(0)).alias("title"), "heading_text")
    signs = materialize(corpus_signs(rows), "corpus-signs")
    counted = signs.filter("not is_word").select(F.col("key").alias("source_file"), "n", *SIGNS)
    sampled = bounded_sample(counted, "source_file", sample_files)
    odds, prior = fit_scanned(np.array([[r["n"], *(r[s] for s in SIGNS)] for r in sampled]).reshape(-1, 1 + len(SIGNS)))
    score = F.lit(prior)
    for j, sign in enumerate(SIGNS):
        score = score + F.col(sign) * float(odds[0, j]) + (F.col("n") - F.col(sign)) * float(odds[1, j])
    files = counted.filter(score > float(np.log(least_posterior / (1 - least_posterior)))).select("source_file")
    files = F.broadcast(files) if files.count() <= FEW_FILES else files
    pages = materialize(rows.join(files, "source_file", "left_semi").dropDuplicates(["chunk_id"]), "scanned-chunks")

    model = LineModel()
    model.train([features(r.chunk_text.replace("\r\n", "\n").split("\n"), names_of(r.title, r.source_file), r.heading_text) for r in bounded_sample(pages, "chunk_id", sample_rows)])
    ship = spark.sparkContext.broadcast(model)  # a few hundred numbers
    columns = ["chunk_id", "chunk_text", "title", "source_file", "heading_text"]

    def items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, kinds, keys = [], [], []
            for i, *rest in zip(*(b.column(c).to_pylist() for c in columns), strict=True):
                lines = labelled(ship.value, *rest)
                for x, s in lines:
                    if s in ("header", "page"):
                        ids.append(i), kinds.append(s), keys.append(x.strip())
                for kind, piece in parts_of(lines):
                    found = [("hyphen", piece)] if kind == "break" else [("char", w) for w in words_of(piece)] if kind == "text" else []
                    for k, w in found:
                        ids.append(i), kinds.append(k), keys.append(w)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(kinds, pa.string()), pa.array(keys, pa.string())], ["chunk_id", "kind", "key"])

    found = materialize(pages.mapInArrow(items, "chunk_id string, kind string, key string").distinct(), "scanned-items")
    words = found.filter(F.col("kind").isin("hyphen", "char"))

    # each word, or each way to close up a broken one, with the corpus words of the same folded form
    plain_key = F.regexp_replace("key", f"^{START}", "")
    bases = F.when(F.contains("key", F.lit("\x01")), F.array(F.replace("key", F.lit("\x01"), F.lit("")), F.replace("key", F.lit("\x01"), F.lit("-")))).otherwise(F.array(plain_key))
    keys = words.select("key").distinct().select("key", F.startswith("key", F.lit(START)).alias("start"), F.explode(bases).alias("base"))
    keys = materialize(keys.withColumn("form", folded(F.col("base"))), "scanned-words")
    lexicon = signs.filter("is_word").select(F.col("key").alias("word"), "n")
    possible = keys.join(lexicon.filter(F.col("n") >= least_count).withColumn("form", folded(F.col("word"))), "form").filter("word <> base")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for key, start, base, word, n in zip(*(b.column(c).to_pylist() for c in ("key", "start", "base", "word", "n")), strict=True):
                cost = misreads(base, word, start)
                if cost:
                    out.append((key, word, cost, n))
                capital = word[0].upper() + word[1:]
                if capital != word and (cost := misreads(base, capital, start)):  # the corpus knows it with a small letter
                    out.append((key, capital, cost + 1, n))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate((pa.string(), pa.string(), pa.int32(), pa.int64()))], ["key", "reading", "cost", "n"])

    known = possible.select("key", "start", "base", "word", "n").mapInArrow(read, "key string, reading string, cost int, n bigint")
    known = known.filter(F.col("cost") <= F.greatest(F.lit(3), F.length("reading") * misread_share))
    best = Window.partitionBy("key").orderBy(F.desc("score"), "cost", "reading")
    # each misread place set right divides the count of a reading by a hundred
    ranked = known.withColumn("score", F.col("n") / F.pow(F.lit(100.0), F.greatest(F.col("cost") - 1, F.lit(0))))
    mended = ranked.withColumn("rn", F.row_number().over(best)).filter("rn = 1").select("key", "reading", "n")
    small = F.concat(F.lower(F.substring("base", 1, 1)), F.substring("base", 2, F.length("base")))
    as_it_is = keys.select("key", F.col("base").alias("reading"), F.explode(F.array_distinct(F.array(F.col("base"), small))).alias("word")).join(lexicon, "word")
    plain = as_it_is.groupBy("key").agg(F.max("n").alias("plain"), F.max_by("reading", F.struct("n", "reading")).alias("as_is"))
    chosen = (
        words.select("kind", "key")
        .distinct()
        .join(plain, "key", "left")
        .join(mended, "key", "left")
        .withColumn("misread", F.coalesce((F.col("n") >= least_count) & (F.col("n") >= ratio * F.coalesce("plain", F.lit(0))), F.lit(False)))
        .withColumn(
            "fixed",
            F.when(F.col("misread"), F.col("reading")).when(F.col("kind") == "hyphen", F.coalesce("as_is", F.regexp_replace("key", "\x01", ""))),
        )
        .filter("fixed is not null")
        .select("kind", "key", "fixed")
    )
    chosen = materialize(chosen, "scanned-readings")
    lines = found.filter(F.col("kind").isin("header", "page")).select("chunk_id", F.col("kind").alias("noise_type"), F.col("key").alias("fixed_text"))
    damage = found.join(chosen, ["kind", "key"]).select("chunk_id", F.col("kind").alias("noise_type"), F.col("fixed").alias("fixed_text")).unionByName(lines).distinct()

    fixes = found.join(chosen, ["kind", "key"]).groupBy("chunk_id").agg(F.map_from_entries(F.collect_list(F.struct(F.concat("kind", F.lit("\x02"), "key"), "fixed"))).alias("fixes"))

    def rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, texts = [], []
            for i, fixed, *rest in zip(*(b.column(c).to_pylist() for c in ("chunk_id", "fixes", *columns[1:])), strict=True):
                fixed, out = dict(fixed or []), []
                for kind, piece in parts_of(labelled(ship.value, *rest)):
                    if kind == "break":
                        piece = fixed.get(f"hyphen\x02{piece}", piece.replace("\x01", ""))
                    elif kind == "text":
                        for w in dict.fromkeys(words_of(piece)):
                            if f"char\x02{w}" in fixed:
                                bare = re.escape(w.removeprefix(START))
                                piece = re.sub(rf"(?<!\w){bare}(?!\w)", lambda _, r=fixed[f"char\x02{w}"]: r, piece)
                    out.append(piece)
                ids.append(i)
                texts.append("".join(out))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(texts, pa.string())], ["chunk_id", "repaired"])

    repaired = pages.join(fixes, "chunk_id", "left").mapInArrow(rebuild, "chunk_id string, repaired string")
    return damage, repaired
