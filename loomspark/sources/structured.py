"""Structured texts (CSV, JSON, XML, notebooks, source code) as Markdown."""

from __future__ import annotations

import csv
import io
import json
import re
from collections.abc import Callable, Iterator
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Suffixes of source code, which goes into a fenced block of its language.
CODE = {"py": "python", "js": "javascript", "ts": "typescript", "java": "java", "c": "c", "cpp": "cpp", "go": "go", "rs": "rust", "sql": "sql"}


def _cell(value: object) -> str:
    if value is None:
        return ""
    text = value if isinstance(value, str) else json.dumps(value, ensure_ascii=False)
    return " ".join(text.replace("|", "\\|").split())


def table(headers: list[str], rows: list[list[object]]) -> str:
    """A pipe table; short rows are padded, long ones kept."""
    line = lambda cells: f"| {' | '.join(cells)} |"
    body = [line([_cell(x) for x in r] + [""] * (len(headers) - len(r))) for r in rows]
    return "\n".join([line([_cell(h) for h in headers]), line(["---"] * len(headers)), *body])


def csv_to_markdown(text: str) -> str:
    """A table with the first row as its head; blank lines drop out."""
    rows = [r for r in csv.reader(io.StringIO(text.removeprefix("﻿"), newline="")) if r]
    return table(rows[0], rows[1:]) if rows else ""


def json_to_markdown(text: str) -> str:
    """A list of objects becomes a table of all their keys, an object a table of key and value, anything else a code block."""
    data = json.loads(text)
    if isinstance(data, list) and data and all(isinstance(x, dict) for x in data):
        keys = list(dict.fromkeys(k for x in data for k in x))
        return table(keys, [[x.get(k) for k in keys] for x in data])
    if isinstance(data, dict):
        return table(["key", "value"], [[k, v] for k, v in data.items()])
    return f"```json\n{json.dumps(data, ensure_ascii=False, indent=2)}\n```"


def xml_to_markdown(text: str) -> str:
    """One line for each element with text or attributes, indented by depth. Documents that declare entities are refused."""
    if "<!ENTITY" in text:
        raise ValueError("entity declarations are not read")
    out: list[str] = []

    def walk(node: ElementTree.Element, depth: int) -> None:
        name = node.tag.rpartition("}")[2]
        own = " ".join([*(f"{k.rpartition('}')[2]}={v}" for k, v in node.attrib.items()), *(node.text or "").split()])
        out.append(f"{'  ' * depth}- **{name}**{': ' + own if own else ''}")
        for child in node:
            walk(child, depth + 1)
            if child.tail and child.tail.strip():
                out.append(f"{'  ' * (depth + 1)}- {' '.join(child.tail.split())}")

    walk(ElementTree.fromstring(text), 0)
    return "\n".join(out)


def notebook_to_markdown(text: str) -> str:
    """Markdown cells as they are, code cells in fenced blocks; outputs are left out."""
    parts = []
    for cell in json.loads(text).get("cells", []):
        source = "".join(cell.get("source", []))
        if source.strip():
            parts.append(source if cell.get("cell_type") == "markdown" else f"```\n{source}\n```")
    return "\n\n".join(parts)


CONVERTERS: dict[str, Callable[[str], str]] = {
    "csv": csv_to_markdown, "json": json_to_markdown, "xml": xml_to_markdown, "ipynb": notebook_to_markdown,
    **{k: (lambda text, language=v: f"```{language}\n{text.strip(chr(10))}\n```" if text.strip() else "") for k, v in CODE.items()},
}


def to_markdown(docs: DataFrame, format_col: str = "source_format", content_col: str = "content") -> DataFrame:
    """``docs`` with the content as Markdown and ``error``; formats without a converter stay as they are.

    Text that can't be parsed has a null content and the reason in ``error``; null texts stay null without an error.
    """
    base = docs if "error" in docs.columns else docs.withColumn("error", F.lit(None).cast("string"))
    names = base.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            contents, errors = [], []
            for kind, text, error in zip(*(b.column(c).to_pylist() for c in (format_col, content_col, "error")), strict=True):
                if text is not None and kind in CONVERTERS:
                    try:
                        text = CONVERTERS[kind](re.sub("\r\n?", "\n", text))
                    except Exception as e:  # noqa: BLE001  one bad file must not stop the run
                        text, error = None, f"{type(e).__name__}: {e}"[:500]
                contents.append(text)
                errors.append(error)
            new = {content_col: pa.array(contents, pa.string()), "error": pa.array(errors, pa.string())}
            yield pa.RecordBatch.from_arrays([new.get(c, b.column(c)) if c in new else b.column(c) for c in names], names)

    return base.mapInArrow(run, base.schema)
