"""Corpus encoding with a public byte-level tokenizer by overlapping chunk encoding.

Short texts are encoded where they are read. A text longer than ``piece_chars`` is cut into overlapping windows that
are pre-tokenised in parallel; neighbouring windows are stitched at the first position of their overlap at which both
have a pre-token boundary (from there on both scans are the same, since the pattern never looks back), and the pieces
between those positions are encoded in parallel and put together in order. A pair of windows without a common boundary
is not cut, so the ids always equal those of the whole text.

Null and empty texts give an empty list. Byte-level ids decode by concatenating the raw bytes of their tokens.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

TOKENIZER = "byte_bpe_50k"
_loaded: dict[str, object] = {}


def pretoken_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def byte_encoding(name: str = TOKENIZER, path: str | None = None):
    """The tokenizer of a rank file, loaded once per worker."""
    if name not in _loaded:
        import public_tokenizers
        import tiktoken

        with open(path or public_tokenizers.path(f"{name}.tiktoken"), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _loaded[name] = tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _loaded[name]


def encode_batch(texts: list[str | None], name: str = TOKENIZER, path: str | None = None) -> pa.Array:
    enc = byte_encoding(name, path)
    empty = np.empty(0, np.uint32)
    ids = [enc.encode_to_numpy(t) if t else empty for t in texts]
    offsets = np.zeros(len(ids) + 1, np.int32)
    np.cumsum([len(x) for x in ids], out=offsets[1:])
    flat = np.concatenate(ids).astype(np.int32) if ids else np.empty(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))


def _encoder(keys: list[str], text_col: str, name: str, path: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 2000):  # bounds the ids held at once
                part = b.slice(at, 2000)
                ids = encode_batch(part.column(text_col).to_pylist(), name, path)
                yield pa.RecordBatch.from_arrays([*(part.column(k) for k in keys), ids], [*keys, "ids"])

    return run


def _windows(piece: int, overlap: int):
    """The windows of each text, cut in one pass over it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                text, own = b.column("_text")[i].as_py(), b.column("_id").slice(i, 1)
                starts = range(0, len(text), piece)
                for lo in range(0, len(starts), 512):  # bounds the batch of a very long text
                    part = starts[lo : lo + 512]
                    ids = own.take(pa.array([0] * len(part)))
                    yield pa.RecordBatch.from_arrays([ids, pa.array([s // piece for s in part], pa.int32()), pa.array([text[s : s + piece + overlap] for s in part], pa.string())], ["_id", "win", "part"])

    return run


def _boundaries(pattern: str, piece: int, overlap: int):
    """Pre-token boundaries of each window in the overlap with the window before (head) and after (tail), from its own start."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        pat = regex.compile(pattern)
        for b in batches:
            heads, tails = [], []
            for k, text in zip(b.column("win").to_pylist(), b.column("part").to_pylist(), strict=True):
                # a cut after white space could change how the white space before it is split
                ends = [m.end() for m in pat.finditer(text) if m.end() < len(text) and not text[m.end() - 1].isspace()]
                heads.append([e for e in ends if e <= overlap] if k else [])
                tails.append([e - piece for e in ends if e >= piece])
            cols = [*(b.column(c) for c in ("_id", "win", "part")), pa.array(heads, pa.list_(pa.int32())), pa.array(tails, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(cols, ["_id", "win", "part", "head", "tail"])

    return run


def encode_corpus(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer: str = TOKENIZER,
    piece_chars: int = 16384,
    overlap: int = 512,
    path: str | None = None,
) -> DataFrame:
    """``(id, ids array<int>)`` for every row of ``docs``; ``id_col`` is unique.

    Strings that look like special tokens are ordinary text. An empty table gives an empty result; other columns are
    ignored. ``path`` is the rank file, by default that of the public tokenizer's package.
    """
    base = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    kind = base.schema["_id"].dataType.simpleString()
    is_long = F.coalesce(F.length("_text") > piece_chars, F.lit(False))
    short = base.filter(~is_long).mapInArrow(_encoder(["_id"], "_text", tokenizer, path), f"_id {kind}, ids array<int>")

    windows = base.filter(is_long).mapInArrow(_windows(piece_chars, overlap), f"_id {kind}, win int, part string")
    windows = windows.repartition("_id", "win")  # the windows of one long text go to many tasks
    marks = windows.mapInArrow(_boundaries(pretoken_pattern(), piece_chars, overlap), f"_id {kind}, win int, part string, head array<int>, tail array<int>")
    by_text = Window.partitionBy("_id").orderBy("win")
    cut = marks.withColumn("cut", F.array_min(F.array_intersect("head", F.lag("tail").over(by_text))))
    # a window ends where the next one was cut, or goes on into it where no cut was found
    ranged = cut.select("_id", "win", "cut", F.lead("cut").over(by_text).alias("next"), F.lead("win").over(by_text).isNull().alias("last"), "part")
    first = F.coalesce("cut", F.lit(0))
    until = F.when(F.col("last"), F.length("part")).otherwise(F.coalesce("next", F.lit(0)) + piece_chars)
    own = ranged.select("_id", "win", F.sum(F.col("cut").isNotNull().cast("int")).over(by_text).cast("int").alias("piece"), F.expr("part").substr(first + 1, until - first).alias("own"))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("win", "own"))), lambda r: r["own"]), "")
    pieces = own.groupBy("_id", "piece").agg(joined.alias("_text"))
    coded = pieces.mapInArrow(_encoder(["_id", "piece"], "_text", tokenizer, path), f"_id {kind}, piece int, ids array<int>")
    whole = coded.groupBy("_id").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("piece", "ids"))), lambda r: r["ids"])).alias("ids"))
    return short.unionByName(whole).select(F.col("_id").alias(id_col), "ids")
