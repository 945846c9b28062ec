"""Mixture-controlled packing of texts into containers of fixed token capacity.

Deficit round-robin over one queue per source fills windows of ``bins_per_window`` containers so that each window has
the target token proportions. A source that gets ``q`` tokens a window serves an item in the first window whose
accumulated quantum covers the queue up to and including the item; what a window leaves unserved is carried to the
next. In that closed form the window of an item depends only on the prefix sum of its queue, so the prefix sums are
taken in two steps (within blocks, then over block totals) and no queue passes through one task. Inside a window
items are put into containers best fit decreasing.

An item above the capacity is cut: its full parts fill containers of their own, the remainder queues as an item.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loomspark.llm.encoding import byte_encoding
from loomspark.session import materialize

_pieces: dict[str, object] = {}
MEMO = 400_000  # words whose piece count a worker remembers


def piece_counter(name: str, path: str | None = None):
    """Counts sentence-piece tokens word by word.

    No piece of the model has its word-start sign after another character, so no merge crosses the border before a
    run of blanks, and counts of the parts between these borders add up. Counts of repeated words are remembered.
    """
    if name not in _pieces:
        import re

        import public_tokenizers
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path or public_tokenizers.path(f"{name}.model"))
        if any("▁" in sp.id_to_piece(i).lstrip("▁") for i in range(sp.get_piece_size())):
            _pieces[name] = lambda text: len(sp.encode(text, num_threads=1))
        else:
            words = re.compile(r" *[^ ]+| +$").findall
            memo: dict[str, int] = {}

            def count(text: str) -> int:
                total = 0
                for k, w in enumerate(words(text)):
                    key = w if k else " " + w  # the model starts a text with a blank
                    n = memo.get(key)
                    if n is None:
                        n = len(sp.encode(key[1:], num_threads=1)) if len(key) > 1 else 1  # a last single blank
                        if len(memo) >= MEMO:
                            memo.clear()
                        memo[key] = n
                    total += n
                return total

            _pieces[name] = count
    return _pieces[name]


def token_counter(name: str, path: str | None = None):
    if name.startswith("piece_"):
        return piece_counter(name, path)
    enc = byte_encoding(name, path)
    return lambda text: len(enc.encode_to_numpy(text))


def measured(docs: DataFrame, tokenizers: list[str], id_col: str, text_col: str, source_col: str, paths: dict[str, str] | None = None) -> DataFrame:
    """``(_id, _source, n_0, n_1, ...)``: token counts of each text by each tokenizer, 0 for null and empty texts."""
    base = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("_source"), F.col(text_col).alias("_text"))
    kind = base.schema["_id"].dataType.simpleString()
    names = [f"n_{i}" for i in range(len(tokenizers))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters = [token_counter(t, (paths or {}).get(t)) for t in tokenizers]
        for b in batches:
            texts = b.column("_text").to_pylist()
            counts = [pa.array([c(t) if t else 0 for t in texts], pa.int64()) for c in counters]
            yield pa.RecordBatch.from_arrays([b.column("_id"), b.column("_source"), *counts], ["_id", "_source", *names])

    return base.mapInArrow(run, f"_id {kind}, _source string, " + ", ".join(f"{n} bigint" for n in names))


def _best_fit(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """The container of each item, by best fit over the items in decreasing size."""
    where = np.empty(len(sizes), np.int64)
    free: list[tuple[int, int]] = []  # (room, container), sorted
    n = 0
    for i in np.argsort(-sizes, kind="stable"):
        size = int(sizes[i])
        at = bisect.bisect_left(free, (size, -1))
        if at == len(free):
            room, box, n = capacity, n, n + 1
        else:
            room, box = free.pop(at)
        where[i] = box
        if room > size:
            bisect.insort(free, (room - size, box))
    return where


MAX_TARGETS = 1000  # they become literals of one plan


def _queues(docs: DataFrame, targets: DataFrame, id_col: str, text_col: str, source_col: str, shares: dict[str, float] | None, bins_per_window: int, block_rows: int, paths: dict[str, str] | None) -> tuple[DataFrame, DataFrame]:
    """Items ``(target_id, _source, win, _id, piece, size, cap, share)`` with their window, and the full parts of cut items."""
    spark = docs.sparkSession
    kinds = targets.filter("tokenizer_name is not null and capacity_tokens > 0 and target_id is not null").select("target_id", "tokenizer_name", "capacity_tokens").distinct()
    rows = kinds.orderBy("target_id").limit(MAX_TARGETS + 1).collect()
    if len(rows) > MAX_TARGETS:
        raise ValueError(f"more than {MAX_TARGETS} different pack targets; pack them in several calls")
    tokenizers = sorted({r.tokenizer_name for r in rows})
    id_kind = docs.schema[id_col].dataType.simpleString()
    if not rows:
        none = spark.createDataFrame([], f"target_id int, _source string, win bigint, _id {id_kind}, piece bigint, size bigint, cap bigint, share double, container_id string, n_tokens bigint")
        return none, none
    sizes = materialize(measured(docs, tokenizers, id_col, text_col, source_col, paths), "pack-sizes")

    # one row per target and text; the tables of targets and of shares are literals of bounded size
    each = F.explode(
        F.array(*(F.struct(F.lit(r.target_id).cast("int").alias("target_id"), F.lit(r.capacity_tokens).cast("bigint").alias("cap"), F.col(f"n_{tokenizers.index(r.tokenizer_name)}").alias("n")) for r in rows))
    )
    items = sizes.select("_id", "_source", each.alias("t")).select("_id", "_source", "t.*").filter("n > 0")
    cut = items.filter("n > cap").select("target_id", "_id", "cap", "n", F.explode(F.expr("sequence(0L, cast(floor(n / cap) as bigint) - 1)")).alias("piece"))
    full = cut.select("target_id", "_id", "piece", F.concat(F.lit("full-"), F.col("_id").cast("string"), F.lit("-"), F.col("piece").cast("string")).alias("container_id"), F.col("cap").alias("n_tokens"))

    queued = items.select("target_id", "_source", "_id", "cap", F.expr("if(n > cap, cast(floor(n / cap) as bigint), 0L)").alias("piece"), F.expr("if(n > cap, n % cap, n)").alias("size")).filter("size > 0")
    n_blocks = max(1, sizes.count() // block_rows)
    queued = queued.withColumn("block", F.pmod(F.xxhash64("_id"), F.lit(n_blocks)).cast("int"))
    blocks = queued.groupBy("target_id", "_source", "block").agg(F.sum("size").alias("in_block"))
    by_queue = Window.partitionBy("target_id", "_source")
    blocks = blocks.select(
        "target_id", "_source", "block",
        (F.sum("in_block").over(by_queue.orderBy("block")) - F.col("in_block")).alias("before"),
        F.sum("in_block").over(by_queue).alias("in_queue"),
    )
    totals = blocks.groupBy("target_id", "_source").agg(F.max("in_queue").alias("in_queue"))
    weight = F.col("in_queue").cast("double")
    if shares:
        given = F.create_map(*(x for k, v in shares.items() for x in (F.lit(k), F.lit(float(v)))))
        weight = F.coalesce(F.element_at(given, F.col("_source")) * F.sum("in_queue").over(Window.partitionBy("target_id")), weight)
    quanta = totals.withColumn("weight", weight).select("target_id", "_source", (F.col("weight") / F.sum("weight").over(Window.partitionBy("target_id"))).alias("share"))
    served = (
        queued.join(blocks, ["target_id", "_source", "block"])
        .join(quanta, ["target_id", "_source"])
        .withColumn("upto", F.col("before") + F.sum("size").over(Window.partitionBy("target_id", "_source", "block").orderBy("_id")))
        .withColumn("win", (F.ceil(F.col("upto") / (F.col("share") * F.col("cap") * bins_per_window)) - 1).cast("bigint"))
        .select("target_id", "_source", "win", "_id", "piece", "size", "cap", "share")
    )
    return served, full


def _filled(served: DataFrame, id_kind: str) -> DataFrame:
    """``(target_id, win, _source, _id, piece, container_id, n_tokens, cap, share)``: best fit decreasing inside each window."""

    def fill(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["size", "_id"], ascending=[False, True], kind="stable").reset_index(drop=True)
        box = _best_fit(pdf["size"].to_numpy(), int(pdf["cap"].iloc[0]))
        label = [f"w{w}-{b}" for w, b in zip(pdf["win"], box, strict=True)]
        return pd.DataFrame({k: pdf[k] for k in ("target_id", "win", "_source", "_id", "piece")} | {"container_id": label, "n_tokens": pdf["size"], "cap": pdf["cap"], "share": pdf["share"]})

    out = f"target_id int, win bigint, _source string, _id {id_kind}, piece bigint, container_id string, n_tokens bigint, cap bigint, share double"
    return served.groupBy("target_id", "win").applyInPandas(fill, out)


def pack(
    docs: DataFrame,
    targets: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    shares: dict[str, float] | None = None,
    bins_per_window: int = 256,
    block_rows: int = 10_000,
    paths: dict[str, str] | None = None,
) -> DataFrame:
    """``(target_id, doc_id, piece, container_id, n_tokens)``: the containers of every text for every target.

    ``targets`` has ``target_id, tokenizer_name, capacity_tokens`` and is a small table (it is read to the driver, one
    row per container kind, and more than ``MAX_TARGETS`` are an error; rows without a tokenizer or a positive capacity give nothing, repeated rows count once).
    ``shares`` are target token proportions by source, relative to each other; by default those of the corpus, for
    which all queues end in the same window. A source without an entry gets its corpus share. Null sources form a
    queue of their own. Null and empty texts take no container. ``n_tokens`` never exceeds the capacity and an item
    has several pieces only if it alone exceeds the capacity.
    """
    served, full = _queues(docs, targets, id_col, text_col, source_col, shares, bins_per_window, block_rows, paths)
    columns = ["target_id", "_id", "piece", "container_id", "n_tokens"]
    packed = _filled(served, docs.schema[id_col].dataType.simpleString()).select(columns)
    return packed.unionByName(full.select(columns)).withColumnRenamed("_id", id_col)


def window_report(
    docs: DataFrame,
    targets: DataFrame,
    shares: dict[str, float],
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    bins_per_window: int = 256,
    block_rows: int = 10_000,
    paths: dict[str, str] | None = None,
) -> DataFrame:
    """``(target_id, win, n_items, n_containers, n_tokens, fill, n_sources, share_error)`` of each window of ``pack``.

    ``fill`` is the used part of the containers, ``n_sources`` the number of queues that served, ``share_error`` half the
    sum of the differences between the token shares of the window and those of ``shares`` (0 is exact, 1 is disjoint).
    Queues that have run out are missing from later windows, which then count with what the others bring.
    """
    served, _ = _queues(docs, targets, id_col, text_col, source_col, shares, bins_per_window, block_rows, paths)
    packed = _filled(served, docs.schema[id_col].dataType.simpleString())
    by = ["target_id", "win"]
    parts = packed.groupBy(*by, "_source").agg(F.sum("n_tokens").alias("n"), F.count("*").alias("items"), F.max("share").alias("share"), F.max("cap").alias("cap"))
    boxes = packed.select(*by, "container_id").distinct().groupBy(*by).agg(F.count("*").alias("n_containers"))
    total = F.sum("n").over(Window.partitionBy(*by))
    per = parts.withColumn("gap", F.abs(F.col("n") / total - F.col("share"))).groupBy(*by).agg(
        F.sum("items").alias("n_items"), F.sum("n").alias("n_tokens"), F.count("*").alias("n_sources"), (0.5 * (F.sum("gap") + 1 - F.sum("share"))).alias("share_error"), F.max("cap").alias("cap")
    )
    return per.join(boxes, by).select(
        *by, "n_items", "n_containers", "n_tokens", F.round(F.col("n_tokens") / (F.col("cap") * F.col("n_containers")), 6).alias("fill"), "n_sources", F.round(F.greatest("share_error", F.lit(0.0)), 6).alias("share_error")
    )
