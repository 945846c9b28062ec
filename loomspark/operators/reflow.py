"""Reflow of extracted pages: lines wrapped by the page layout become paragraphs again, as windows over lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loomspark.functions.text import WS, lines, strip

#: Legal blocks (article, section, chapter, part with a bracketed or no title; appendix tables) and items.
LEGAL = f"^(제{WS}*[0-9]+{WS}*(조|관|장|절|편){WS}*【|제{WS}*[0-9]+{WS}*(조|관|장|절|편){WS}*$|\\(별표{WS}*[0-9]+\\)|\\(별{WS}*표{WS}*[0-9]*\\))"
ITEM = "^([①-⑳]|[0-9]+\\.)"
STRUCTURE = "^(#|[|]|```|---$|-----$|===$)"


def reflow(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(id, text)``: structure and legal lines stand alone, items begin a paragraph, other lines are joined by a blank.

    Two blank lines or more before such a line leave one. Null texts stay null, empty texts stay empty.
    """
    ids = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_t"))
    rows = ids.select("_id", F.posexplode(F.transform(lines(F.col("_t")), strip)).alias("pos", "s")).filter("s <> ''")
    by = Window.partitionBy("_id").orderBy("pos")
    rows = rows.withColumn("alone", F.col("s").rlike(STRUCTURE) | F.col("s").rlike(LEGAL)).withColumn("item", F.col("s").rlike(ITEM))
    gap = F.col("pos") - F.coalesce(F.lag("pos").over(by), F.lit(-1)) - 1
    begins = F.col("alone") | F.col("item") | F.coalesce(F.lag("alone").over(by), F.lit(True))
    rows = rows.withColumn("gap", (F.col("alone") | F.col("item")) & (gap >= 2)).withColumn("block", F.sum(begins.cast("int")).over(by))
    blocks = rows.groupBy("_id", "block").agg(
        F.concat(F.when(F.max("gap"), F.lit("\n")).otherwise(F.lit("")), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "s"))), lambda r: r["s"]), " ")).alias("line")
    )
    joined = blocks.groupBy("_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "line"))), lambda r: r["line"]), "\n").alias("out"))
    return ids.join(joined, "_id", "left").select(F.col("_id").alias(id_col), F.when(F.col("_t").isNotNull(), F.coalesce("out", F.lit(""))).alias(text_col))
