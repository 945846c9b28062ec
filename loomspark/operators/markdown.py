"""Markdown blocks with their heading path, from line classes and windows (one shuffle by document).

Block grammar: fenced code, headings, pipe tables of two lines or more, block quotes, lists and paragraphs. A list goes on
over blank lines, takes unmarked lines that follow an item and indented ones after a blank line into that item, and ends
where the bullet changes. An item line ends a paragraph, whatever its number. Lines of three or more '-', '*' or '_' only
separate blocks. Underlined headings and indented code are not told apart from paragraphs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loomspark.functions.text import WS, flat_inline, lines, strip

HEADING = f"^#{{1,6}}{WS}+.+$"
RULE = f"^((-{WS}*){{3,}}|(\\*{WS}*){{3,}}|(_{WS}*){{3,}})$"
ITEM = f"^([-*+]|[0-9]{{1,9}}[.)]){WS}+"
QUOTE = f"^(>{WS}*)+"
SEPARATOR = f"^\\|({WS}|[-:|])+\\|$"


def classified_lines(docs: DataFrame, id_col: str, text_col: str, keep_code: bool = True) -> DataFrame:
    """``(id, pos, line, s, opens, kind)`` of every line that isn't blank: code, heading, pipe, quote, item or text; ``s`` is the line without outer blanks.

    Lines from a fence to the next are code and nothing else (with ``keep_code``). Null texts have no lines.
    """
    text = F.replace(F.col(text_col), F.lit("\r\n"), F.lit("\n"))
    rows = docs.select(F.col(id_col).alias("_id"), F.posexplode(lines(text)).alias("pos", "line")).withColumn("s", strip(F.col("line")))
    if keep_code:
        fence = F.startswith("s", F.lit("```"))
        count = F.sum(fence.cast("int")).over(Window.partitionBy("_id").orderBy("pos"))
        rows = rows.withColumn("fences", count).withColumn("opens", fence & (F.col("fences") % 2 == 1)).withColumn("code", fence | (F.col("fences") % 2 == 1))
    else:
        rows = rows.withColumn("opens", F.lit(False)).withColumn("code", F.lit(False))
    kind = (
        F.when(F.col("code"), "code")
        .when((F.col("s") == "") | F.col("s").rlike(RULE), "blank")
        .when(F.col("s").rlike(HEADING), "heading")
        .when(F.startswith("s", F.lit("|")) & F.endswith("s", F.lit("|")), "pipe")
        .when(F.startswith("s", F.lit(">")), "quote")
        .when(F.col("s").rlike(ITEM), "item")
        .otherwise("text")
    )
    return rows.select("_id", "pos", "line", "s", "opens", kind.alias("kind")).filter("kind <> 'blank'")


def table_cells(s: Column) -> Column:
    """The cells between the outer pipes of a line, without inline marks."""
    cells = F.split(s, r"\|", -1)
    return F.transform(F.slice(cells, 2, F.greatest(F.size(cells) - 2, F.lit(0))), lambda x: strip(flat_inline(x)))


def sections(docs: DataFrame, id_col: str, text_col: str, keep_code: bool = True) -> DataFrame:
    """The blocks of each document in order.

    ``(id, seq, text, heading_level, heading_text, section_path, element_type, line_start, line_end, table_headers,
    table_row_count)``. A single pipe line begins a paragraph. The path of a block are the headings above it, by level; a
    heading drops those of deeper levels. Paragraphs and quotes are one line each and lists one line an item, '- ' before
    it, all without inline marks; tables are rendered anew with short rows padded; code stays as it is. Blocks without
    text drop out.
    """
    by = Window.partitionBy("_id").orderBy("pos")
    before = by.rowsBetween(Window.unboundedPreceding, -1)
    rows = classified_lines(docs, id_col, text_col, keep_code)
    at = F.struct("kind", "pos")
    rows = rows.withColumn("prev", F.lag(at).over(by)).withColumn("next", F.lead(at).over(by))
    beside = ((F.col("prev.kind") == "pipe") & (F.col("prev.pos") == F.col("pos") - 1)) | ((F.col("next.kind") == "pipe") & (F.col("next.pos") == F.col("pos") + 1))
    kind = F.when(F.col("kind") == "pipe", F.when(F.coalesce(beside, F.lit(False)), "table").otherwise("single")).otherwise(F.col("kind"))
    rows = rows.select("_id", "pos", "line", "s", "opens", kind.alias("kind"), (F.coalesce(F.col("prev.pos"), F.lit(-2)) < F.col("pos") - 1).alias("gap"), F.col("line").rlike("^( {2}|\t)").alias("indented"))
    text, item, heading = F.col("kind") == "text", F.col("kind") == "item", F.col("kind") == "heading"
    holds = F.when(~text | (F.col("gap") & ~F.col("indented")), F.col("kind"))  # lines that say what plain lines after them belong to
    mark = F.when(item & ~F.col("indented"), F.regexp_extract("s", "^([-*+]|[0-9]+([.)]))", 0))
    mark = F.when(F.length(mark) > 1, F.substring(mark, -1, 1)).otherwise(mark)
    rows = rows.withColumn("mark", mark).withColumn("under", F.coalesce(F.last(holds, True).over(before), F.lit(""))).withColumn("last_mark", F.last("mark", True).over(before))
    rows = rows.withColumn("prev", F.coalesce(F.lag("kind").over(by), F.lit("")))
    begins = (
        F.when(F.col("kind").isin("heading", "single"), True)
        .when(F.col("kind") == "code", F.col("opens"))
        .when(F.col("kind") == "table", (F.col("prev") != "table") | F.col("gap"))
        .when(F.col("kind") == "quote", (F.col("under") != "quote") | F.col("gap"))
        .when(item, (F.col("under") != "item") | F.coalesce(F.col("mark") != F.col("last_mark"), F.lit(False)))
        .otherwise((F.col("gap") & ~((F.col("under") == "item") & F.col("indented"))) | F.col("prev").isin("", "heading", "code", "table"))
    )
    rows = rows.withColumn("begins", begins).withColumn("block", F.sum(F.col("begins").cast("int")).over(by))
    level = F.when(heading, F.length(F.regexp_extract("s", "^(#{1,6})", 1)).cast("int"))
    name = F.when(heading, flat_inline(strip(F.regexp_extract("s", f"^#{{1,6}}{WS}+(.+)$", 1))))
    rows = rows.withColumn("level", level).withColumn("name", name)
    # the last heading of each level, valid while no higher one came after it
    last = F.array(*(F.last(F.when(F.col("level") == k, F.struct("pos", "name")), ignorenulls=True).over(by) for k in range(1, 7)))
    top = item & (F.col("begins") | ~F.col("indented"))
    piece = F.struct("pos", "line", "s", item.alias("item"), top.alias("top"))
    blocks = rows.withColumn("last", last).withColumn("piece", piece).groupBy("_id", "block").agg(
        F.min_by(F.when(F.col("kind") == "single", "text").otherwise(F.col("kind")), "pos").alias("kind"),
        F.min("pos").alias("line_start"),
        F.max("pos").alias("line_end"),
        F.array_sort(F.collect_list("piece")).alias("ls"),
        F.min_by(F.coalesce("level", F.lit(0)), "pos").alias("heading_level"),
        F.min_by(F.when(F.col("begins"), F.col("last")), "pos").alias("last"),
    )
    valid = F.filter(
        F.transform(F.col("last"), lambda h, i: F.when(h.isNotNull() & F.forall(F.slice(F.col("last"), 1, i), lambda u: u.isNull() | (u["pos"] < h["pos"])), h["name"])),
        lambda n: n.isNotNull(),
    )
    blocks = blocks.withColumn("section_path", valid)
    first = F.get("ls", F.lit(0))["s"]
    ruled = (F.col("kind") == "table") & (F.size("ls") > 1) & F.get("ls", F.lit(1))["s"].rlike(SEPARATOR)
    body = F.filter(F.slice("ls", 3, F.greatest(F.size("ls"), F.lit(1))), lambda r: ~r["s"].rlike(SEPARATOR))
    blocks = blocks.withColumn("headers", F.when(F.col("kind") == "table", F.when(ruled, table_cells(first)).otherwise(F.filter(table_cells(first), lambda x: x != ""))))
    spaced = lambda pieces: F.array_join(F.filter(pieces, lambda x: x != ""), " ")
    quoted = spaced(F.transform("ls", lambda r: F.regexp_replace(r["s"], QUOTE, "")))
    plain = lambda r: F.when(r["item"], F.regexp_replace(r["s"], ITEM, "")).otherwise(r["s"])
    listed = F.array_join(F.transform("ls", lambda r: F.concat(F.when(r["top"], F.lit("\x01")).otherwise(F.lit("")), plain(r))), " ")
    listed = F.array_join(F.transform(F.split(F.substring(listed, 2, F.length(listed)), " \x01", -1), lambda x: F.concat(F.lit("- "), x)), "\n")
    raw = F.array_join(F.transform("ls", lambda r: r["line"]), "\n")
    text = (
        F.when(F.col("kind") == "code", raw)
        .when(F.col("kind") == "table", F.when(ruled, render_table(F.col("headers"), F.transform(body, lambda r: table_cells(r["s"])))).otherwise(F.array_join(F.transform("ls", lambda r: r["s"]), "\n")))
        .when(F.col("kind") == "heading", F.concat(F.expr("repeat('#', heading_level)"), F.lit(" "), F.try_element_at("section_path", F.lit(-1))))
        .when(F.col("kind") == "item", flat_inline(listed))
        .when(F.col("kind") == "quote", flat_inline(quoted))
        .otherwise(flat_inline(F.array_join(F.transform("ls", lambda r: r["s"]), " ")))
    )
    kinds = {"heading": "header", "item": "list", "quote": "blockquote", "text": "paragraph", "table": "table", "code": "code"}
    blocks = blocks.select(
        "_id", "block", text.alias("text"), "heading_level", "section_path", F.element_at(F.create_map(*(F.lit(x) for kv in kinds.items() for x in kv)), F.col("kind")).alias("element_type"), "line_start", "line_end",
        F.coalesce("headers", F.array().cast("array<string>")).alias("table_headers"), F.when(F.col("kind") == "table", F.size(body)).otherwise(0).alias("table_row_count"),
    )
    return blocks.filter(strip(F.col("text")) != "").select(
        F.col("_id").alias(id_col),
        (F.row_number().over(Window.partitionBy("_id").orderBy("block")) - 1).alias("seq"),
        "text",
        "heading_level",
        F.coalesce(F.try_element_at("section_path", F.lit(-1)), F.lit("")).alias("heading_text"),
        "section_path",
        "element_type",
        "line_start",
        "line_end",
        "table_headers",
        "table_row_count",
    )


def render_table(headers: Column, rows: Column) -> Column:
    """A pipe table from an array of headers and an array of rows; short rows are padded, long ones kept."""
    line = lambda cells: F.concat(F.lit("| "), F.array_join(cells, " | "), F.lit(" |"))
    n = F.size(headers)
    padded = F.transform(rows, lambda r: line(F.concat(r, F.array_repeat(F.lit(""), F.greatest(n - F.size(r), F.lit(0))))))
    return F.array_join(F.concat(F.array(line(headers), line(F.transform(headers, lambda _: F.lit("---")))), padded), "\n")
