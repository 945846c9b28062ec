"""HTML pages to Markdown by a chain of replacements."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from loomspark.functions.text import LINES, WS, strip
from loomspark.operators.markdown import render_table

#: Marks of preformatted text, cells, and the begin, end and borders of table rows; signs of this kind in a page are dropped.
_PRE, _CELL, _OPEN, _CLOSE, _NEXT = "\x01", "\x02", "\x03", "\x04", "\x05"
#: (pattern, replacement), in order. Names end at a word border, so that head isn't header and p isn't pre; an end tag has the name of its start tag.
STEPS = [
    ("[\x01-\x05]", ""),
    ("\r\n?", "\n"),
    (r"(?is)<!--.*?-->|<!doctype[^>]*>", ""),
    *((rf"(?is)<{name}\b[^>]*>.*?</{name}\s*>", "") for name in ("script", "style", "head", "template", "noscript")),
    (r"(?is)<pre\b[^>]*>\s*(?:<code\b[^>]*>)?(.*?)(?:</code\s*>)?\s*</pre\s*>", f"\n\n{_PRE}$1{_PRE}\n\n"),
    *((rf"(?is)<h{k}\b[^>]*>\s*(.*?)\s*</h{k}\s*>", "\n\n" + "#" * k + " $1\n\n") for k in range(1, 7)),
    (r"(?is)<img\b[^>]*\balt=[\"']([^\"']*)[\"'][^>]*>", "$1"),
    (r"(?is)<a\b[^>]*\bhref=[\"']([^\"']*)[\"'][^>]*>(.*?)</a\s*>", "[$2]($1)"),
    (r"(?is)<(b|strong)\b[^>]*>(.*?)</\1\s*>", "**$2**"),
    (r"(?is)<(i|em)\b[^>]*>(.*?)</\1\s*>", "*$2*"),
    (r"(?is)<code\b[^>]*>(.*?)</code\s*>", "`$1`"),
    (r"(?is)\s*<li\b[^>]*>\s*(.*?)\s*(?=</li\s*>|<li\b|</ul\s*>|</ol\s*>)", "\n- $1"),
    (r"(?is)\s*</t[dh]\s*>\s*<t[dh]\b[^>]*>\s*", f" {_CELL} "),
    (r"(?is)\s*<tr\b[^>]*>\s*<t[dh]\b[^>]*>\s*", f"\n{_CELL} "),
    (r"(?is)\s*</t[dh]\s*>\s*</tr\s*>\s*", f" {_CELL}\n"),
    (r"(?i)<br\b[^>]*>", "\n"),
    (r"(?i)<hr\b[^>]*>", "\n\n---\n\n"),
    (r"(?i)</?(?:p|div|ul|ol|dl|article|section|main|aside|header|nav|footer|figure|blockquote|table|form)\b[^>]*>", "\n\n"),
    (r"(?is)</?[a-z][^>]*>", ""),
]
#: Entities by name.
ENTITIES = {
    "lt": "<", "gt": ">", "quot": '"', "apos": "'", "nbsp": " ", "copy": "©", "reg": "®", "trade": "™", "hellip": "…", "mdash": "—", "ndash": "–", "lsquo": "‘", "rsquo": "’", "ldquo": "“", "rdquo": "”",
    "laquo": "«", "raquo": "»", "bull": "•", "middot": "·", "euro": "€", "pound": "£", "sect": "§", "deg": "°", "times": "×", "auml": "ä", "ouml": "ö", "uuml": "ü", "Auml": "Ä", "Ouml": "Ö", "Uuml": "Ü",
    "szlig": "ß", "eacute": "é", "egrave": "è", "ecirc": "ê", "agrave": "à", "aacute": "á", "acirc": "â", "ccedil": "ç", "ntilde": "ñ", "oacute": "ó", "iacute": "í", "uacute": "ú", "atilde": "ã", "otilde": "õ",
}


def _tables(text: Column) -> Column:
    """Runs of cell rows as pipe tables: the first row is the head, short rows are padded. Blank lines between rows belong to the source, not to the table."""
    marked = F.regexp_replace(text, f"{LINES}^{_CELL}([^\n]*)$", f"{_OPEN}$1{_CLOSE}")
    marked = F.regexp_replace(F.regexp_replace(marked, f"{_CLOSE}{WS}*{_OPEN}", _NEXT), f"{_CLOSE}{WS}*(?=\n)", _CLOSE)
    cells = lambda x: F.transform(F.split(F.regexp_replace(x, f"^ | ?{_CELL}$", ""), f" ?{_CELL} ?", -1), strip)
    # uneven parts are tables
    parts = F.transform(F.split(marked, f"[{_OPEN}{_CLOSE}]", -1), lambda p, i: F.struct(p.alias("p"), F.when(i % 2 == 1, F.transform(F.split(p, _NEXT, -1), cells)).alias("rows")))
    shown = lambda r: F.concat(F.lit("\n"), render_table(F.get(r, F.lit(0)), F.slice(r, 2, F.size(r))), F.lit("\n"))
    return F.when(F.contains(text, F.lit(_CELL)), F.array_join(F.transform(parts, lambda p: F.coalesce(shown(p["rows"]), p["p"])), "")).otherwise(text)


def unescaped(text: Column) -> Column:
    """Entities by name and by number as signs; unknown names stay, '&amp;' comes last so that nothing is read twice."""
    parts = F.split(text, r"(?=&(?:[A-Za-z]+|#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6});)", -1)
    names = F.create_map(*(F.lit(x) for kv in ENTITIES.items() for x in kv), F.lit("amp"), F.lit("&"))

    def sign(p: Column) -> Column:
        name = F.regexp_extract(p, "^&([A-Za-z]+|#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6});", 1)
        rest = F.substring(p, F.length(name) + 3, F.length(p))
        number = F.when(F.lower(name).startswith("#x"), F.conv(F.substring(name, 3, 9), 16, 10)).when(F.startswith(name, F.lit("#")), F.substring(name, 2, 9)).cast("bigint")
        # a sign beyond the first plane as the four bytes of UTF-32
        char = F.when((number > 0) & (number < 0x110000), F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32"))
        by = F.when(F.startswith(name, F.lit("#")), char).otherwise(F.element_at(names, name))
        return F.when((name != "") & by.isNotNull(), F.concat(by, rest)).otherwise(p)

    return F.when(F.contains(text, F.lit("&")), F.array_join(F.transform(parts, sign), "")).otherwise(text)


def to_markdown(html: Column) -> Column:
    """The page as Markdown: headings, links, emphasis, lists, tables with a head row, and preformatted text in fences.

    Scripts, styles and the head are left out; headers, navigation and footers are kept. Null pages give null.
    """
    for pattern, by in STEPS:
        html = F.regexp_replace(html, pattern, by)
    parts = F.split(html, _PRE, -1)  # uneven parts are preformatted
    flowing = lambda p: F.regexp_replace(F.regexp_replace(_tables(p), r"[ \t]+(?=\n)", ""), r"\n{3,}", "\n\n")
    whole = F.array_join(F.transform(parts, lambda p, i: F.when(i % 2 == 1, F.concat(F.lit("```\n"), F.regexp_replace(p, r"^\n+|\s+$", ""), F.lit("\n```"))).otherwise(flowing(p))), "")
    # as an element of an array, so that the chain isn't computed again for each use of its result
    return strip(F.get(F.transform(F.array(whole), unescaped), F.lit(0)))
