"""File sources and sinks: listings, text and Markdown files with front matter, and prepared Markdown files."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomspark.functions.text import strip
from loomspark.session import materialize

TEXT_FORMATS = {"md": "markdown", "markdown": "markdown", "txt": "plaintext", "rst": "rst"}
LISTING = "uri string, source_file string, ext string, is_dir boolean, size bigint, modified timestamp, error string"
PART_BYTES = 64 << 20  # what one task reads at least, if there is so much


def _opened(uri: str):
    """The file system of an address or path (as it is, not percent-encoded), and the path in it."""
    import re

    from pyarrow import fs

    far = re.match(r"(?!file:)(\w+://[^/]*)(.*)$", uri, re.S)
    if far:
        where, base = fs.FileSystem.from_uri(f"{far[1]}/")
        return where, base.rstrip("/") + far[2]
    return fs.LocalFileSystem(), re.sub("^file:/*", "/", uri)


def list_files(spark: SparkSession, folder: str, max_depth: int = 5) -> DataFrame:
    """``(uri, source_file, ext, size, modified, error)`` of the files below ``folder``, at most ``max_depth`` folders deep, empty ones too.

    Folders are listed by tasks, level by level. ``source_file`` is relative to the folder, ``ext`` in lower case. Symbolic
    links are passed over; a folder that can't be read gives one row with ``error`` and does not stop the listing.
    """
    root = folder.rstrip("/")
    if "://" not in root and not root.startswith("file:"):
        root = os.path.abspath(root)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        for b in batches:
            for uri, rel in zip(b.column("uri").to_pylist(), b.column("source_file").to_pylist(), strict=True):
                out = []
                try:
                    where, path = _opened(uri)
                    for f in where.get_file_info(fs.FileSelector(path)):
                        if isinstance(where, fs.LocalFileSystem) and os.path.islink(f.path):
                            continue
                        below = f"{rel}/{f.base_name}" if rel else f.base_name
                        stem, dot, ext = f.base_name.rpartition(".")
                        out.append((f"{uri}/{f.base_name}", below, ext.lower() if dot and stem else "", f.type == fs.FileType.Directory, f.size, f.mtime, None))
                except OSError as e:
                    out = [(uri, rel, "", False, None, None, f"{type(e).__name__}: {e}"[:500])]
                kinds = [pa.string(), pa.string(), pa.string(), pa.bool_(), pa.int64(), pa.timestamp("us", "UTC"), pa.string()]
                cols = [pa.array([r[k] for r in out], kind) for k, kind in enumerate(kinds)]
                yield pa.RecordBatch.from_arrays(cols, ["uri", "source_file", "ext", "is_dir", "size", "modified", "error"])

    level, found = spark.createDataFrame([(root, "")], "uri string, source_file string"), None
    for depth in range(max_depth + 1):
        listed = materialize(level.repartition(spark.sparkContext.defaultParallelism if depth else 1).mapInArrow(run, LISTING), "listing")
        found = listed.filter("not is_dir") if found is None else found.unionByName(listed.filter("not is_dir"))
        level = listed.filter("is_dir").select("uri", "source_file")
        if level.isEmpty():
            break
    return found.drop("is_dir")


def read_files(listing: DataFrame, convert: Callable[[str, bytes], str]) -> DataFrame:
    """``(source_file, ext, modified, content, error)``: the files of a listing through ``convert(ext, bytes)``.

    A file that can't be read or converted has a null content and the reason in ``error``.
    """
    total = listing.agg(F.sum("size").alias("s"), F.count("*").alias("n")).first()
    tasks = max(1, min(total["n"] or 1, max((total["s"] or 0) // PART_BYTES, listing.sparkSession.sparkContext.defaultParallelism)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                content, error = None, b.column("error")[i].as_py()
                if error is None:
                    try:
                        where, path = _opened(b.column("uri")[i].as_py())
                        with where.open_input_stream(path) as f:
                            content = convert(b.column("ext")[i].as_py(), f.read())
                    except Exception as e:  # noqa: BLE001  one bad file must not stop the run
                        error = f"{type(e).__name__}: {e}"[:500]
                own = [b.column(c).slice(i, 1) for c in ("source_file", "ext", "modified")]
                yield pa.RecordBatch.from_arrays([*own, pa.array([content], pa.string()), pa.array([error], pa.string())], ["source_file", "ext", "modified", "content", "error"])

    return listing.repartition(int(tasks), "uri").mapInArrow(run, "source_file string, ext string, modified timestamp, content string, error string")


def read_documents(spark: SparkSession, folder: str, extensions: dict[str, str] | None = None, max_depth: int = 5) -> DataFrame:
    """``(source_file, ext, source_format, modified, content, error)`` of the text files below ``folder``.

    Line ends become '\\n', an empty file has an empty content, text that isn't UTF-8 is an error of that file.
    """
    formats = extensions or TEXT_FORMATS
    rows = read_files(list_files(spark, folder, max_depth).filter(F.col("ext").isin(list(formats))), lambda _, data: data.decode("utf-8"))
    known = F.create_map(*(x for k, v in formats.items() for x in (F.lit(k), F.lit(v))))
    return rows.select("source_file", "ext", F.element_at(known, F.col("ext")).alias("source_format"), "modified", F.regexp_replace("content", "\r\n?", "\n").alias("content"), "error")


def output_path(path: Column) -> Column:
    """The path with its extension replaced by .md."""
    return F.concat(F.regexp_replace(path, r"\.[^./]+$", ""), F.lit(".md"))


FRONT = r"(?s)^---\n(.*?)\n?---[ \t]*(?:\n(.*))?$"
#: Lines a front matter may have: a key with or without a value, an item of a list, a continued value, a remark, a blank.
FRONT_LINES = r"^(?:(?:[\p{L}\p{N}_][\p{L}\p{N}_ .-]*:(?: .*)?|[ \t]*- ?.*|[ \t]+.*|#.*|)(?:\n|$))*$"


def split_front_matter(content: Column) -> tuple[Column, Column]:
    """(front matter, body): between the first line '---' and the next.

    Texts without one, and those in which something else than keys, lists and remarks stands there, have an empty front
    matter and the whole text as their body.
    """
    front = F.regexp_extract(content, FRONT, 1)
    has = content.rlike(FRONT) & front.rlike(FRONT_LINES)
    return F.when(has, front).when(content.isNotNull(), ""), F.when(has, strip(F.regexp_extract(content, FRONT, 2))).otherwise(content)


def _unquoted(value: Column) -> Column:
    """A YAML scalar: double-quoted ones as JSON strings, single-quoted ones with doubled quotes, others as they are."""
    single = F.replace(F.substring(value, 2, F.length(value) - 2), F.lit("''"), F.lit("'"))
    double = F.get_json_object(F.concat(F.lit('{"v":'), value, F.lit("}")), "$.v")
    return F.when(value.rlike(r'(?s)^".*"$'), F.coalesce(double, value)).when(value.rlike(r"(?s)^'.*'$"), single).otherwise(value)


def front_matter_value(front: Column, key: str) -> Column:
    """A flat scalar of a front matter, '' where it is missing."""
    return _unquoted(strip(F.regexp_extract(front, rf"(?m)^{key}:[ ]*(.*)$", 1)))


def front_matter_list(front: Column, key: str) -> Column:
    """A list of a front matter, written as '- ' lines or as [a, b]; a scalar is a list of one, a missing key an empty list."""
    lines = F.regexp_extract(front, rf"(?m)^{key}:[ ]*\n((?:[ \t]*- ?.*(?:\n|$))+)", 1)
    block = F.transform(F.filter(F.split(lines, "\n", -1), lambda x: strip(x) != ""), lambda x: _unquoted(strip(F.regexp_replace(x, r"^[ \t]*-", ""))))
    scalar = strip(F.regexp_extract(front, rf"(?m)^{key}:[ ]*(.*)$", 1))
    inner = strip(F.regexp_replace(scalar, r"^\[|\]$", ""))
    flow = F.transform(F.split(inner, r",(?=(?:[^\"]*\"[^\"]*\")*[^\"]*$)", -1), lambda x: _unquoted(strip(x)))
    empty = F.array().cast("array<string>")
    return F.when(front.isNull(), None).when(lines != "", block).when(scalar.rlike(r"^\[.*\]$"), F.when(inner == "", empty).otherwise(flow)).when(scalar != "", F.array(_unquoted(scalar))).otherwise(empty)


def _yaml(value: Column, is_list: bool) -> Column:
    text = lambda v: F.regexp_replace(F.to_json(F.array(v)), r"^\[|\]$", "")  # noqa: E731  a JSON string is a YAML string
    if not is_list:
        return F.concat(F.lit(" "), text(F.coalesce(value.cast("string"), F.lit(""))))
    return F.when(F.size(value) > 0, F.array_join(F.transform(value, lambda x: F.concat(F.lit("\n- "), text(x))), "")).otherwise(F.lit(" []"))


def render_front_matter(lists: tuple[str, ...] = (), **fields: Column) -> Column:
    """A front matter with the fields in their order; those named in ``lists`` are arrays of strings."""
    return F.concat(F.lit("---\n"), *(F.concat(F.lit(f"{k}:"), _yaml(v, k in lists), F.lit("\n")) for k, v in fields.items()), F.lit("---\n\n"))


def write_prepared(docs: DataFrame, folder: str, path_col: str = "path", text_col: str = "text") -> DataFrame:
    """Write each row's text to a file of its own below ``folder``, by tasks; ``(path, error)`` of every row.

    Tables are the form to work with; single files are for people and other tools. Nothing is written before an action.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            errors = []
            for path, text in zip(b.column("path").to_pylist(), b.column("text").to_pylist(), strict=True):
                try:
                    where, at = _opened(f"{folder.rstrip('/')}/{path}")
                    where.create_dir(at.rpartition("/")[0], recursive=True)
                    with where.open_output_stream(at) as f:
                        f.write((text or "").encode("utf-8"))
                    errors.append(None)
                except Exception as e:  # noqa: BLE001  one bad file must not stop the run
                    errors.append(f"{type(e).__name__}: {e}"[:500])
            yield pa.RecordBatch.from_arrays([b.column("path"), pa.array(errors, pa.string())], ["path", "error"])

    return docs.select(F.col(path_col).alias("path"), F.col(text_col).alias("text")).mapInArrow(run, "path string, error string")
