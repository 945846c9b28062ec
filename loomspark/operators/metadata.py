"""Metadata of Markdown documents as column expressions, and keyword and word counts in one Arrow pass: no shuffle.

All column functions take a text column; null texts give null unless stated otherwise.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomspark.functions.lexicon import DOMAINS, LANGUAGE_WORDS, STOP_WORDS
from loomspark.functions.text import LINES, WORD, WS, after_front_matter, lines, matches, strip


def title(c: Column) -> Column:
    """First level-1 heading, else first level-2 heading, else the first line cut to 100 characters, else 'Untitled'."""
    h = lambda marks: F.nullif(strip(F.regexp_extract(c, f"{LINES}^{marks}{WS}+(.+)$", 1)), F.lit(""))
    first = F.nullif(F.substring(strip(F.element_at(lines(strip(c)), 1)), 1, 100), F.lit(""))
    return F.when(c.isNotNull(), F.coalesce(h("#"), h("##"), first, F.lit("Untitled")))


def keywords(c: Column, top: int = 10) -> Column:
    """Words of headings and bold text, fence languages and link texts, longest first, equal lengths in order."""
    words = lambda texts: F.flatten(F.transform(texts, lambda t: matches(t, f"{WORD}{{2,}}")))
    heads = matches(c, f"{LINES}^#{{1,6}}{WS}+(.+)$", 1)
    bold = matches(c, r"(?d)\*\*(.+?)\*\*|__(.+?)__")
    links = F.filter(matches(c, r"\[([^\]]+)\]\([^)]+\)", 1), lambda t: (F.length(t) > 2) & (F.length(t) < 50))
    found = F.array_distinct(
        F.concat(words(heads), words(F.transform(bold, lambda t: F.substring(t, 3, F.length(t) - 4))), matches(c, f"{LINES}^```({WORD}+)", 1), F.transform(links, strip))
    )
    kept = F.filter(found, lambda w: ~F.lower(w).isin(STOP_WORDS))
    ranked = F.array_sort(F.transform(kept, lambda w: F.struct((-F.length(w)).alias("n"), w.alias("w"))))
    return F.transform(F.slice(ranked, 1, top), lambda r: r["w"])


def content_type(c: Column) -> Column:
    """code, tutorial, list, documentation or article, by shares of fenced text, list lines and headings."""
    fenced = F.aggregate(matches(c, r"```[\s\S]*?```"), F.lit(0), lambda a, x: a + F.length(x))
    share = F.when(F.length(c) > 0, fenced / F.length(c)).otherwise(0.0)
    items = F.regexp_count(c, F.lit(f"{LINES}^[-*]{WS}+")) + F.regexp_count(c, F.lit(f"{LINES}^[0-9]+\\.{WS}+"))
    n_lines = F.size(lines(c))
    return (
        F.when(c.isNull(), None)
        .when(share > 0.5, "code")
        .when(share > 0.2, "tutorial")
        .when(items > n_lines * 0.3, "list")
        .when(F.regexp_count(c, F.lit(f"{LINES}^#{{1,6}}{WS}+")) > 5, "documentation")
        .otherwise("article")
    )


KEYWORDS = [(d, w) for d, ws in DOMAINS.items() for w in ws]


def with_counts(df: DataFrame, text_col: str) -> DataFrame:
    """Adds ``_n``, the occurrences of each domain keyword in the lower-cased text, and ``_votes``: the numbers of function words of each language, of words with Hangul and of all words.

    One pass of an Arrow batch over the text; occurrences don't overlap and may lie inside words. Null texts give nulls.
    """
    names = [*df.columns, "_n", "_votes"]
    voters = {}
    for i, ws in enumerate(LANGUAGE_WORDS.values()):
        for w in ws:
            voters.setdefault(w, []).append(i)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        word, hangul = re.compile(r"\w+"), re.compile("[가-힣]")
        signs = [w for _, w in KEYWORDS]
        for b in batches:
            counts, votes = [], []
            for t in b.column("_low").to_pylist():
                if t is None:
                    counts.append(None)
                    votes.append(None)
                    continue
                counts.append([t.count(w) for w in signs])
                n, total, korean = [0] * len(LANGUAGE_WORDS), 0, 0
                for w, times in Counter(word.findall(t)).items():
                    total += times
                    for i in voters.get(w, ()):
                        n[i] += times
                    if hangul.search(w):
                        korean += times
                votes.append([*n, korean, total])
            kept = [b.column(c) for c in b.schema.names if c != "_low"]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(counts, pa.list_(pa.int32())), pa.array(votes, pa.list_(pa.int32()))], names)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema) + ", _n array<int>, _votes array<int>"
    return df.withColumn("_low", F.lower(text_col)).mapInArrow(run, schema)


def with_domain(df: DataFrame, text_col: str, keywords_col: str) -> DataFrame:
    """Adds ``domain, sub_domain``: keyword counts in the lower-cased text plus 5 for each equal keyword; first domain wins ties.

    The steps are selects of their own, so that no step is computed again for each use of its result.
    """
    one = df if "_n" in df.columns else with_counts(df, text_col)
    one = one.withColumn("_kw", F.transform(keywords_col, F.lower))
    scored = []
    for o, (name, ws) in enumerate(DOMAINS.items()):
        at = [i for i, (d, _) in enumerate(KEYWORDS) if d == name]
        n = [F.get("_n", F.lit(i)) for i in at]
        top = F.greatest(*(F.struct(x.alias("n"), F.lit(-i).alias("o"), F.lit(w).alias("w")) for i, (x, w) in enumerate(zip(n, ws, strict=True))))
        score = sum(n[1:], n[0]) + F.lit(5) * F.size(F.array_intersect("_kw", F.array(*map(F.lit, ws))))
        scored.append(F.struct(score.alias("score"), F.lit(-o).alias("o"), F.lit(name).alias("domain"), top.alias("top")))
    one = one.withColumn("_best", F.greatest(*scored))
    hit, known = F.col("_best.score") > 0, F.col(text_col).isNotNull()
    sub = F.when(hit & (F.col("_best.top.n") > 0), F.col("_best.top.w")).otherwise("")
    return one.withColumn("domain", F.when(known, F.when(hit, F.col("_best.domain")).otherwise("general"))).withColumn("sub_domain", F.when(known, sub)).drop("_n", "_votes", "_kw", "_best")


def summary(c: Column, length: int = 300) -> Column:
    """The first paragraph of more than 30 characters without markup, cut to ``length``; headings end paragraphs."""
    body = strip(F.coalesce(after_front_matter(c), c))
    marked = F.transform(F.transform(lines(body), strip), lambda s: F.when(F.startswith(s, F.lit("#")), F.lit("")).otherwise(s))
    paragraphs = F.filter(F.split(F.array_join(marked, "\n"), "\n\n+", -1), lambda p: p != "")
    clean = F.transform(paragraphs, lambda p: _bare(F.regexp_replace(F.regexp_replace(p, "^\n+|\n+$", ""), "\n", " ")))
    first = F.slice(F.filter(clean, lambda p: F.length(p) > 30), 1, 1)
    cut = F.transform(first, lambda f: F.when(F.length(f) > length, F.concat(F.substring(f, 1, length), F.lit("..."))).otherwise(f))  # evaluated once
    return F.when(c.isNotNull(), F.coalesce(F.get(cut, F.lit(0)), F.lit("")))


def _bare(p: Column) -> Column:
    for pattern in (r"\[([^\]]+)\]\([^)]+\)", r"\*\*([^*]+)\*\*", r"\*([^*]+)\*", r"`([^`]+)`"):
        p = F.regexp_replace(p, pattern, "$1")
    return p


def without_front_matter(c: Column) -> Column:
    return F.coalesce(strip(after_front_matter(c)), c)


def voted_language(c: Column, votes: Column) -> Column:
    """The language whose function words occur most often (first code wins ties), 'ko' for mostly Hangul, 'unknown' for short texts and none."""
    k = len(LANGUAGE_WORDS)
    per = [F.struct(F.get(votes, F.lit(i)).alias("n"), F.lit(-i).alias("o"), F.lit(l).alias("l")) for i, l in enumerate(LANGUAGE_WORDS)]
    best = F.greatest(*per)
    return (
        F.when(c.isNull() | (F.length(strip(c)) < 10), "unknown")
        .when(F.get(votes, F.lit(k)) * 2 > F.get(votes, F.lit(k + 1)), "ko")
        .when(best["n"] > 0, best["l"])
        .otherwise("unknown")
    )


def with_language(df: DataFrame, text_col: str) -> DataFrame:
    """Adds ``language`` by ``voted_language``."""
    counted = df if "_votes" in df.columns else with_counts(df, text_col)
    return counted.withColumn("language", voted_language(F.col(text_col), F.col("_votes")))


#: The fields of a prepared document's front matter, in order.
FIELDS = ("title", "domain", "sub_domain", "keywords", "summary", "language", "content_type", "source_file", "source_format", "prepared_at")


def front_matter(
    docs: DataFrame, text_col: str = "text", source_file_col: str = "source_file", source_format_col: str = "source_format", now: Column | None = None, extra: dict[str, Column] | None = None
) -> DataFrame:
    """The columns of ``docs`` but its text and fields, the body without its old front matter, and the fields of each document.

    ``extra`` (name to column over ``docs``, ``body`` and the fields) overrides fields and adds new ones; a null value
    of it leaves the field as it is. Without ``now`` the time of preparation is null.
    """
    kept = [c for c in docs.columns if c not in (*FIELDS, "body", text_col)]
    named = docs.withColumn("_file", F.col(source_file_col)).withColumn("_format", F.col(source_format_col)).withColumn("_text", F.col(text_col)).drop("body", text_col, *FIELDS)
    body = named.withColumn("body", without_front_matter(F.col("_text"))).drop("_text")
    counted = with_counts(body, "body").withColumn("keywords", keywords(F.col("body")))
    full = with_domain(with_language(counted, "body"), "body", "keywords")
    fields = {
        "title": title(F.col("body")), "domain": F.col("domain"), "sub_domain": F.col("sub_domain"), "keywords": F.col("keywords"), "summary": summary(F.col("body")),
        "language": F.col("language"), "content_type": content_type(F.col("body")), "source_file": F.col("_file"), "source_format": F.col("_format"),
        "prepared_at": now if now is not None else F.lit(None).cast("string"),
    }
    out = full.select(*kept, "body", *(v.alias(k) for k, v in fields.items()))
    if not extra:
        return out
    over = {k: F.coalesce(v.cast(out.schema[k].dataType), F.col(k)) if k in out.columns else v for k, v in extra.items()}
    return out.withColumns(over)
