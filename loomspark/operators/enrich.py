"""Enrichment of prepared documents by a pluggable text model."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

INPUT_LIMIT = 48_000


def strategy(source_format: Column) -> Column:
    """slides for presentations, document for the rest."""
    return F.when(F.lower(F.coalesce(source_format, F.lit("markdown"))).isin("pptx", "ppt"), "slides").otherwise("document")


def status(enriched: Column, output_exists: Column, force: bool, has_client: bool, changed: Column) -> Column:
    skip = F.coalesce(enriched, F.lit(False)) & output_exists & F.lit(not force)
    done = F.when(changed, "enriched").otherwise("copied (LLM failed)") if has_client else F.lit("copied")
    return F.when(skip, "skipped").otherwise(done)


def enrich(docs: DataFrame, text_col: str, format_col: str, enricher: Callable[[str, str], str] | None = None) -> DataFrame:
    """``docs`` with ``strategy, enriched_text, changed``.

    The enricher gets the first 48,000 characters and the strategy; the rest follows after a blank line. Errors, an
    empty answer and a null text leave the text as it is. Without an enricher nothing changes.
    """
    base = docs.withColumn("strategy", strategy(F.col(format_col)))
    if enricher is None:
        return base.withColumn("enriched_text", F.col(text_col)).withColumn("changed", F.lit(False))
    fields = base.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for t, s in zip(b.column(text_col).to_pylist(), b.column("strategy").to_pylist(), strict=True):
                try:
                    new = enricher(t[:INPUT_LIMIT], s) if t else t
                    out.append(t if not new else new + (f"\n\n{t[INPUT_LIMIT:]}" if len(t) > INPUT_LIMIT else ""))
                except Exception:  # noqa: BLE001  a failing model must not stop the run
                    out.append(t)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.string())], [*b.schema.names, "enriched_text"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields) + ", enriched_text string"
    return base.mapInArrow(run, schema).withColumn("changed", ~F.col("enriched_text").eqNullSafe(F.col(text_col)))
