"""Texts decoded with the wrong character encoding: detection by a hidden Markov model and repair.

The model has one clean state and one state for each pair (true encoding, encoding used by mistake). Its observations
are the characters outside ASCII, taken in runs with the characters beside them; every pair leaves ASCII as it is, so
ASCII text has the same probability in every state and only keeps the state. Emissions are character bigrams,
counted over all sound lines of the corpus as they are and as each pair would garble them, so a state knows what its
damage looks like in the languages of the corpus. Each labelled span then gets the inverse
transform of its state.

Signs quoted as an example (inside code spans and code blocks) count as clean.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomspark.llm.sampling import bounded_sample
from loomspark.session import materialize

#: (name, true encoding, encoding used by mistake, times); "loose1252" is cp1252 with the bytes it leaves open read as Latin-1.
PAIRS = [
    ("utf8-as-cp1252", "utf-8", "loose1252", 1),
    ("utf8-as-latin1", "utf-8", "latin-1", 1),
    ("utf8-as-cp1252-twice", "utf-8", "loose1252", 2),
    ("utf8-as-mac", "utf-8", "mac_roman", 1),
    ("utf8-as-mac-twice", "utf-8", "mac_roman", 2),
    ("utf8-as-cp437", "utf-8", "cp437", 1),
    ("utf8-as-cp850", "utf-8", "cp850", 1),
    ("utf8-as-cp1250", "utf-8", "cp1250", 1),
    ("utf8-as-cp1251", "utf-8", "cp1251", 1),
    ("utf8-as-cp949", "utf-8", "cp949", 1),
    ("cp1252-as-utf8", "loose1252", "utf-8", 1),
    ("cp1252-as-mac", "loose1252", "mac_roman", 1),
    ("cp1252-as-cp437", "loose1252", "cp437", 1),
    ("cp1252-as-cp850", "loose1252", "cp850", 1),
    ("cp1252-as-cp1250", "loose1252", "cp1250", 1),
    ("cp1252-as-cp1251", "loose1252", "cp1251", 1),
    ("mac-as-cp1252", "mac_roman", "loose1252", 1),
    ("cp850-as-cp1252", "cp850", "loose1252", 1),
    ("cp949-as-cp1252", "cp949", "loose1252", 1),
    ("cp949-as-utf8", "cp949", "utf-8", 1),
    ("cp949-as-mac", "cp949", "mac_roman", 1),
]
CLEAN = 0
RUN = re.compile(r"[^\x00-\x7f]+")
EDGED = re.compile(r"(?<=(.))([^\x00-\x7f]+)(?=(.))", re.S)
QUOTED = re.compile(r"^```[^\n]*\n.*?(?:^```[^\n]*$|\Z)|`[^`\n]*`", re.M | re.S)
SIGNS = "[^\\x00-\\x7f]"  # every pair leaves ASCII as it is, so no damage is without another character
_LOOSE = {i: bytes([i]).decode("cp1252", "ignore") or chr(i) for i in range(256)}
_LOOSE_BACK = {c: i for i, c in _LOOSE.items()}


def read_as(data: bytes, enc: str) -> str:
    if enc == "loose1252":
        return data.decode("latin-1").translate(_LOOSE)
    return data.decode(enc, "replace")


def bytes_of(text: str, enc: str) -> bytes | None:
    try:
        if enc == "loose1252":
            return bytes(_LOOSE_BACK[c] for c in text)
        return text.encode(enc)
    except (UnicodeEncodeError, KeyError):
        return None


def garble(text: str, pair: int) -> str | None:
    """The text as ``PAIRS[pair]`` would damage it; None where its true encoding can't write the text."""
    _, true, wrong, times = PAIRS[pair]
    for _ in range(times):
        data = bytes_of(text, true)
        if data is None:
            return None
        text = read_as(data, wrong)
    return text


def restore(text: str, pair: int) -> str | None:
    """The inverse transform of ``PAIRS[pair]``; None where the text holds signs that can't be taken back."""
    _, true, wrong, times = PAIRS[pair]
    if "\ufffd" in text:
        return None
    for _ in range(times):
        data = bytes_of(text, wrong)
        if data is None:
            return None
        try:
            text = data.decode("cp1252" if true == "loose1252" else true)
        except UnicodeDecodeError:
            return None
    return text


def symbol(c: str, common: frozenset[str]) -> str:
    """The character itself, or the name of its block if it is rare in sound text."""
    if c in common:
        return c
    o = ord(c)
    if o < 0x80:
        return "digit" if c.isdigit() else "upper" if c.isupper() else "lower" if c.isalpha() else "space" if c.isspace() else c
    if 0xAC00 <= o <= 0xD7A3:
        return "hangul"
    if o < 0x250 or 0x2000 <= o < 0x2600 or o == 0xFFFD:
        return c
    for top, name in ((0x370, "latin"), (0x400, "greek"), (0x530, "cyrillic"), (0x2000, "other"), (0x3000, "sign"), (0x3400, "kana"), (0xA000, "han"), (0xE000, "other"), (0xF900, "private"), (0xFB00, "han")):
        if o < top:
            return name
    return "beyond"


def runs_of(text: str) -> list[tuple[int, int, str]]:
    """(start, end, run with the characters beside it) of every run of characters outside ASCII."""
    return [(m.start(), m.end(), (text[m.start() - 1] if m.start() else "\n") + m.group() + (text[m.end()] if m.end() < len(text) else "\n")) for m in RUN.finditer(text)]


class Counting:
    """Counts of the runs of sound lines with the characters beside them, and of the lines each Hangul syllable stands in.

    A text counts each of its lines once, without quoted examples. Lines with lost signs, or with a run that a mistaken
    reading of UTF-8 explains byte by byte, don't count. With a labeller only the lines that it labels as damaged do.
    """

    def __init__(self, lab: Labeller | None = None):
        self.lab, self.damaged, self.counts = lab, {}, Counter()

    def surely_damaged(self, run: str) -> bool:
        got = self.damaged.get(run)
        if got is None:
            if len(self.damaged) >= 300_000:
                self.damaged.clear()
            got = self.damaged[run] = "\ufffd" in run or any(restore(run, k) is not None for k, p in enumerate(PAIRS) if p[1] == "utf-8")
        return got

    def add(self, text: str) -> None:
        text = QUOTED.sub(" ", text) if "`" in text else text
        if self.lab and self.lab.plainly_clean(text):  # and so are its lines
            return
        for line in dict.fromkeys(text.split("\n")):
            if line.isascii():
                continue
            runs = [run for *_, run in runs_of(line)]
            if any(self.surely_damaged(run[1:-1]) for run in runs) or self.lab and not self.lab.spans(line):
                continue
            self.counts.update(runs)
            self.counts.update(c for c in set(line) if "\uac00" <= c <= "\ud7a3")


#: However many runs are counted, they weigh as so many: the price of a change of state and the smoothing are set for
#: counts of that size, and far beyond it whatever is rare in sound text passes for damage (check_s: 630 or 631 texts with
#: 10,000 to 50,000, 1,107 with 70,000).
WEIGHT = 35_000


def common_in(counts: Iterable[tuple[str, int]], least: float) -> frozenset[str]:
    """A Hangul syllable is common if it stands in several lines; other characters outside ASCII are kept as they are."""
    return frozenset(c for c, n in counts if len(c) == 1 and n >= least)


def tally(runs: Iterable[tuple[str, int]], common: frozenset[str]) -> list[Counter]:
    """Bigram counts of every state from the runs as they are and as each pair would garble them."""
    memo: dict[str, str] = {}

    def sym(c: str) -> str:
        s = memo.get(c)
        if s is None:
            s = memo[c] = "common" if c in common else symbol(c, common)
        return s

    counts: list[Counter] = [Counter() for _ in range(len(PAIRS) + 1)]

    def learn(state: int, run: str, n: int) -> None:
        s = [sym(c) for c in run]
        for pair in zip(s, s[1:], strict=False):
            counts[state][pair] += n

    for run, n in runs:
        learn(CLEAN, run, n)
        core = run[1:-1]
        for k in range(len(PAIRS)):
            g = garble(core, k)
            if g is not None and g != core:  # what a pair leaves as it is says nothing about it
                for *_, part in runs_of(run[0] + g + run[-1]):
                    learn(k + 1, part, n)
    return counts


def model_of(counts: list[Counter], common: frozenset[str], alpha: float, scale: float) -> dict:
    size = len({s for c in counts for pair in c for s in pair}) + 20
    tables = []
    for c in counts:
        c = {pair: c[pair] * scale for pair in sorted(c)}
        first, second, total = Counter(), Counter(), sum(c.values())
        for (a, b), n in c.items():
            first[a] += n
            second[b] += n
        logp = {}
        back = {b: math.log((n + alpha) / (total + alpha * size)) for b, n in second.items()}
        for (a, b), n in c.items():
            p_back = (second[b] + alpha) / (total + alpha * size)
            logp[a, b] = math.log((n + 2.0 * p_back) / (first[a] + 2.0))
        lone = {a: math.log(2.0 / (n + 2.0)) for a, n in first.items()}
        tables.append((logp, lone, back, math.log(alpha / (total + alpha * size))))
    model = {"common": common, "tables": tables, "plain": frozenset()}
    lab = Labeller(model)
    # bigrams that no state explains better than the clean one; a run of only these never leaves it
    model["plain"] = frozenset(p for p in counts[CLEAN] if (r := lab.vector([p]))[CLEAN] >= r.max())
    return model


def fit(texts: list[str], min_count: int = 3, alpha: float = 0.05) -> dict:
    """Bigram log-probabilities of every state from texts of which most are sound.

    Lines that are surely damaged stay out of the clean state. After a first fit the lines that it labels as damaged
    are left out too and the tables are made again.
    """

    def counted(lab: Labeller | None = None) -> Counter:
        c = Counting(lab)
        for t in texts:
            c.add(t)
        return c.counts

    def model(counts: Counter) -> dict:
        scale = min(1.0, WEIGHT / max(1, sum(n for x, n in counts.items() if len(x) > 1)))
        common = common_in(counts.items(), min_count / scale)
        return model_of(tally(((x, n) for x, n in counts.items() if len(x) > 1), common), common, alpha, scale)

    counts = counted()
    return model(counts - counted(Labeller(model(counts))))


class Labeller:
    """Viterbi labelling of the runs of one text after another."""

    def __init__(self, model: dict, switch: float = 9.0, memo_size: int = 300_000):
        self.model, self.switch, self.memo, self.size, self.syms, self.fine = model, switch, {}, memo_size, {}, set()

    def bigrams(self, run: str) -> list[tuple[str, str]]:
        common, syms, s = self.model["common"], self.syms, []
        for c in run:
            if c not in syms:
                syms[c] = "common" if c in common else symbol(c, common)
            s.append(syms[c])
        return list(zip(s, s[1:], strict=False))

    def vector(self, pairs: list[tuple[str, str]]) -> np.ndarray:
        return np.array([sum(logp[p] if p in logp else lone.get(p[0], 0.0) + back.get(p[1], unseen) for p in pairs) for logp, lone, back, unseen in self.model["tables"]])

    def scores(self, run: str) -> np.ndarray:
        """The log-probability of the run in each state."""
        got = self.memo.get(run)
        if got is None:
            if len(self.memo) >= self.size:
                self.memo.clear()
            got = self.memo[run] = self.vector(self.bigrams(run))
        return got

    def plainly_clean(self, text: str) -> bool:
        """Whether the clean state explains every run best; then no path is better than staying in it."""
        fine, plain = self.fine, self.model["plain"]
        for parts in EDGED.findall(f"\n{text}\n"):
            if parts not in fine:
                run = "".join(parts)
                if not plain.issuperset(self.bigrams(run)) and (r := self.scores(run))[CLEAN] < r.max():
                    return False
                if len(fine) >= self.size:
                    fine.clear()
                fine.add(parts)
        return True

    def label(self, text: str) -> tuple[list[tuple[int, int, str]], list[int]]:
        """The runs of the text and the state of each; no runs for a text that is plainly clean."""
        if self.plainly_clean(text):
            return [], []
        runs = runs_of(text)
        quoted = [m.span() for m in QUOTED.finditer(text)] if "`" in text else []
        rows, q = [], 0
        for a, _, run in runs:
            while q < len(quoted) and quoted[q][1] <= a:
                q += 1
            rows.append(None if q < len(quoted) and quoted[q][0] <= a else self.scores(run))
        if all(r is None or r[CLEAN] >= r.max() for r in rows):  # then no other path is better
            return runs, [CLEAN] * len(rows)
        k = len(PAIRS) + 1
        best = np.full(k, -self.switch)
        best[CLEAN] = 0.0
        came = []
        for r in rows:
            top = int(best.argmax())
            jump = best[top] - self.switch
            stay = best >= jump
            came.append(np.where(stay, np.arange(k), top))
            best = np.where(stay, best, jump) + (r if r is not None else 0.0)
        # the text also ends in the clean state or leaves another at the same price
        state, states = int(best.argmax()), []
        for r, c in zip(reversed(rows), reversed(came), strict=True):
            states.append(CLEAN if r is None else state)
            state = int(c[state])
        return runs, states[::-1]

    def spans(self, text: str) -> list[tuple[int, int, int]]:
        """(start, end, state) of each damaged span; neighbouring runs of one state form one span."""
        runs, states = self.label(text)
        if not any(states):
            return []
        found: list[list[int]] = []
        open_ = False
        for (a, b, _), s in zip(runs, states, strict=True):
            if s == CLEAN:
                open_ = False
            elif open_ and found[-1][2] == s:
                found[-1][1] = b
            else:
                found.append([a, b, s])
                open_ = True
        return [x for x in found if self.better(text, *x)]

    def better(self, text: str, a: int, b: int, state: int) -> bool:
        """Whether the inverse transform changes the span into likelier sound text.

        Where it can't take back the whole span, most runs must have lost signs or be taken back alone, which must be
        likelier too unless signs are lost.
        """
        fixed = restore(text[a:b], state - 1)
        if fixed is None:
            runs = RUN.findall(text[a:b])
            if 2 * sum("\ufffd" in r or restore(r, state - 1) not in (None, r) for r in runs) <= len(runs):
                return False
            if "\ufffd" in text[a:b]:
                return True
            fixed = RUN.sub(lambda m: restore(m.group(), state - 1) or m.group(), text[a:b])
        clean = lambda t: sum(self.scores(run)[CLEAN] for *_, run in runs_of(t))
        before, after = (text[a - 1] if a else "\n"), (text[b] if b < len(text) else "\n")
        return fixed != text[a:b] and clean(before + fixed + after) > clean(before + text[a:b] + after)

    def repaired(self, text: str, spans: list[tuple[int, int, int]]) -> tuple[str, int]:
        """The text with each span restored run by run or as a whole, and the number of spans left as they are."""
        out, at, left = [], 0, 0
        for a, b, s in spans:
            whole = restore(text[a:b], s - 1)
            if whole is None:
                whole = RUN.sub(lambda m, s=s: restore(m.group(), s - 1) or m.group(), text[a:b])
                left += 1
            out += [text[at:a], whole]
            at = b
        return "".join([*out, text[at:]]), left


def fit_on(docs: DataFrame, id_col: str, text_col: str, sample_docs: int | None = None, sample_chars: int = 20_000, min_count: int = 3, alpha: float = 0.05) -> dict:
    """What ``fit`` gives for all texts, counted where they lie.

    Two passes over the texts give their runs with counts, each different run is garbled once, and the driver gets the
    counts of bigrams, whose number is bounded by that of the symbols. Only if ``sample_docs`` is given do at most so many
    texts count, and of a longer text a stretch of ``sample_chars`` at a place set by the hash of its id.
    """
    usable = docs.filter(F.col(text_col).rlike(SIGNS)).select(id_col, F.col(text_col).alias("t"))
    if sample_docs is not None:
        room = F.greatest(F.length("t") - sample_chars, F.lit(0)) + 1
        start = F.pmod(F.xxhash64(F.col(id_col).cast("string"), F.lit(1)), room.cast("bigint")).cast("int") + 1
        usable = usable.select(id_col, F.substring(F.col("t"), start, F.lit(sample_chars)).alias("t"))
        return fit([r.t for r in bounded_sample(usable, id_col, sample_docs)], min_count, alpha)
    context = docs.sparkSession.sparkContext

    def rows(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["x", "n"])

    def counted(model: dict | None = None) -> DataFrame:
        ship = context.broadcast(model)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            c = Counting(Labeller(ship.value) if ship.value else None)
            for b in batches:
                for text in b.column("t").to_pylist():
                    c.add(text)
                if len(c.counts) > 200_000:
                    yield rows(c.counts)
                    c.counts.clear()
            yield rows(c.counts)

        return usable.select("t").mapInArrow(run, "x string, n long")

    def model(counts: DataFrame) -> dict:
        scale = min(1.0, WEIGHT / max(1, counts.filter(F.length("x") > 1).agg(F.sum("n")).first()[0] or 0))
        common = common_in(((r.x, r.n) for r in counts.filter(F.length("x") == 1).collect()), min_count / scale)  # at most the 11,172 Hangul syllables
        ship = context.broadcast(common)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for state, c in enumerate(tally(zip(b.column("x").to_pylist(), b.column("n").to_pylist(), strict=True), ship.value)):
                    yield pa.RecordBatch.from_arrays([pa.array([state] * len(c), pa.int32()), pa.array([a for a, _ in c], pa.string()), pa.array([b for _, b in c], pa.string()), pa.array(list(c.values()), pa.int64())], ["state", "a", "b", "n"])

        pairs = counts.filter(F.length("x") > 1).repartition(context.defaultParallelism).mapInArrow(run, "state int, a string, b string, n long")
        tallies: list[Counter] = [Counter() for _ in range(len(PAIRS) + 1)]
        for r in pairs.groupBy("state", "a", "b").agg(F.sum("n").alias("n")).collect():
            tallies[r.state][r.a, r.b] = r.n
        return model_of(tallies, common, alpha, scale)

    first = materialize(counted().groupBy("x").agg(F.sum("n").alias("n")), "runs")
    damaged = counted(model(first)).withColumn("n", -F.col("n"))
    return model(materialize(first.unionByName(damaged).groupBy("x").agg(F.sum("n").alias("n")).filter("n > 0"), "sound-runs"))


def find_damage(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample_docs: int | None = None, switch: float = 9.0) -> DataFrame:
    """``(id, restored, spans array<struct<start,end,pair>>, n_left)`` for every text with a damaged passage.

    ``restored`` is the text after the inverse transforms, ``n_left`` the number of spans that couldn't be taken back
    as a whole (their lost signs stay). Sound, null, empty and ASCII texts have no row; an empty table gives none.
    """
    model = fit_on(docs, id_col, text_col, sample_docs)
    ship = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the symbols
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"_id {kind}, restored string, spans array<struct<start:int,end:int,pair:string>>, n_left int"
    arrow_spans = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("pair", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lab = Labeller(ship.value, switch)
        for b in batches:
            ids, texts, spans, lefts = [], [], [], []
            for i, text in zip(b.column("_id"), b.column("_text").to_pylist(), strict=True):
                if found := lab.spans(text):
                    fixed, left = lab.repaired(text, found)
                    ids.append(i)
                    texts.append(fixed)
                    spans.append([{"start": x, "end": y, "pair": PAIRS[s - 1][0]} for x, y, s in found])
                    lefts.append(left)
            yield pa.RecordBatch.from_arrays([pa.array([i.as_py() for i in ids], b.schema.field("_id").type), pa.array(texts, pa.string()), pa.array(spans, arrow_spans), pa.array(lefts, pa.int32())], ["_id", "restored", "spans", "n_left"])

    base = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).filter(F.col("_text").rlike(SIGNS))
    return base.mapInArrow(run, schema).withColumnRenamed("_id", id_col)
