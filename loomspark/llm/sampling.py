"""Bounded samples for fitting models."""

from __future__ import annotations

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F


def bounded_sample(df: DataFrame, id_col: str, rows: int, by: str | None = None) -> list[Row]:
    """At most ``rows`` rows (for each value of ``by``), those with the smallest hashes of the id.

    The share that is read is set from a count first, so what tasks send to the driver doesn't grow with the table.
    ``by`` has few values. The sample depends only on the ids in the table.
    """
    df = df.withColumn("_h", F.xxhash64(F.col(id_col).cast("string")))
    key = F.col(by) if by else F.lit("")
    counts = {r[0]: r[1] for r in df.groupBy(key).count().collect()}
    if not counts:
        return []
    span = float(1 << 62)  # hashes are spread over -2**63 .. 2**63
    bounds = {k: -2 * span + 4 * span * min(1.0, 1.3 * rows / n + 30 / n) for k, n in counts.items()}
    bound = F.create_map(*(x for k, v in bounds.items() if k is not None for x in (F.lit(k), F.lit(v))))
    picked = df.filter(F.col("_h").cast("double") <= F.element_at(bound, key)).collect()
    out: list[Row] = []
    taken = dict.fromkeys(counts, 0)
    for r in sorted(picked, key=lambda r: r["_h"]):
        k = r[by] if by else ""
        if taken[k] < rows:
            taken[k] += 1
            out.append(r)
    return out
