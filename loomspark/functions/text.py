"""Text expressions with one meaning in every engine: explicit white space and word classes, '\\n' as the only line end."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space as Python's str.strip sees it, without brackets.
BLANKS = r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
WS = f"[{BLANKS}]"
WORD = r"[\p{L}\p{N}_]"
#: Python's multi-line mode: only '\n' ends a line.
LINES = "(?dm)"


def strip(c: Column) -> Column:
    return F.regexp_replace(c, f"^{WS}+|{WS}+$", "")


def matches(text: Column, pattern: str, group: int = 0) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))


def lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def after_front_matter(c: Column) -> Column:
    """What follows the second '---' of a text that begins with '---'; null for other texts."""
    second = F.locate("---", c, 4)
    return F.when(F.startswith(c, F.lit("---")) & (second > 0), F.substring(c, second + 3, F.length(c)))


def flat_inline(c: Column) -> Column:
    """Text without inline marks: links and images become their text, emphasis and code ticks go; what is inside code ticks stays as it is."""
    parts = F.split(F.regexp_replace(c, r"!?\[([^\]]*)\]\([^)]*\)", "$1"), "`", -1)

    def bare(p: Column) -> Column:
        for pattern in (r"\*\*([^*]+)\*\*", r"\*([^*\s][^*]*)\*"):
            p = F.regexp_replace(p, pattern, "$1")
        for pattern in (r"(^|[\s(])__([^_]+)__", r"(^|[\s(])_([^_]+)_"):
            p = F.regexp_replace(p, pattern, "$1$2")
        return p

    n = F.size(parts)
    # an uneven number of ticks leaves the last one as a sign of its own
    flat = F.transform(parts, lambda p, i: F.when((i % 2 == 1) & (i < n - 1), p).when(i % 2 == 1, F.concat(F.lit("`"), bare(p))).otherwise(bare(p)))
    return F.array_join(flat, "")
