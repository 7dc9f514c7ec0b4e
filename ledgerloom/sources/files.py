"""Readers of landed files: XML forms as tags, workbooks as cells. Python decodes single files; all else is dataflow.

Files are read with binaryFile, so Spark deals them out and a glob or a filter on path prunes before content is read.
"""

from __future__ import annotations

import io
import re
import xml.etree.ElementTree as ET
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.plans.common import send_library

TAGS = "path string, section string, row_no int, tag_ord int, tag string, text string, error string"
CELLS = "path string, sheet string, row_no int, col_no int, text string, error string"


def _decoded(raw: bytes) -> str:
    for name in ("utf-8-sig", "utf-16", "latin-1"):
        try:
            return raw.decode(name)
        except UnicodeError:
            continue
    raise ValueError("no encoding fits")


def _tags(path: str, raw: bytes) -> Iterator[tuple]:
    text = re.sub(r"^\s*<\?xml[^>]*\?>", "", _decoded(raw))
    root = ET.fromstring(text)
    for i, node in enumerate(root):
        name = node.tag.lower()
        if name == "header":
            for j, cell in enumerate(node):
                yield path, "header", 0, j, cell.tag, (cell.text or "").strip(), None
        elif name == "content":
            for r, row in enumerate(node):
                for j, cell in enumerate(row):
                    yield path, "row", r, j, cell.tag, (cell.text or "").strip(), None
        else:
            yield path, "scalar", 0, i, node.tag, (node.text or "").strip(), None


def _column(ref: str) -> int:
    n = 0
    for c in re.match("[A-Z]*", ref).group():
        n = n * 26 + ord(c) - 64
    return n - 1


def _cells(path: str, raw: bytes) -> Iterator[tuple]:
    if raw[:4] != b"PK\x03\x04":
        raise ValueError("not a zip workbook")
    with zipfile.ZipFile(io.BytesIO(raw)) as z:
        names = set(z.namelist())
        def plain(node) -> str:
            return "".join(t.text or "" for t in node.iter() if t.tag.endswith("}t"))

        shared = [plain(n) for n in ET.fromstring(z.read("xl/sharedStrings.xml"))] if "xl/sharedStrings.xml" in names else []
        for sheet in sorted(n for n in names if re.fullmatch(r"xl/worksheets/[^/]+\.xml", n)):
            r = -1
            for row in (n for n in ET.fromstring(z.read(sheet)).iter() if n.tag.endswith("}row")):
                r = int(row.get("r", r + 2)) - 1
                for c, cell in enumerate(row):
                    value = next((n.text for n in cell if n.tag.endswith("}v")), None)
                    kind = cell.get("t")
                    text = shared[int(value)] if kind == "s" and value is not None else plain(cell) if kind == "inlineStr" else value or ""
                    yield path, sheet.rsplit("/", 1)[1][:-4], r, _column(cell.get("r", "")) if cell.get("r") else c, text.strip(), None


def _each_file(files: DataFrame, decode, schema: str) -> DataFrame:
    """Rows of files (path, content). A file that can't be read is one row with its reason."""
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, raw in zip(batch["path"], batch["content"], strict=True):
                try:
                    rows = list(decode(name, raw))
                except Exception as e:
                    rows = [(name, *[None] * (len(names) - 2), f"{type(e).__name__}: {e}"[:180])]
                yield pd.DataFrame(rows, columns=names)

    send_library(files.sparkSession)
    return files.select("path", "content").mapInPandas(run, schema)


def decode_xml(files: DataFrame) -> DataFrame:
    """Tags of the XML forms among files (path, content); UTF-8, UTF-16 or Latin-1, whatever they declare."""
    return _each_file(files.filter(F.col("path").rlike(r"(?i)\.xml$")), _tags, TAGS)


def decode_grids(files: DataFrame) -> DataFrame:
    """Cells of the workbooks among files (path, content), by their first bytes rather than their name; others give a row with error."""
    return _each_file(files.filter(F.col("path").rlike(r"(?i)\.xls[^.]*$")), _cells, CELLS)


def _landed(spark: SparkSession, path: str, glob: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(path)


def read_xml_forms(spark: SparkSession, path: str) -> DataFrame:
    """Tags of all XML forms under a path."""
    return decode_xml(_landed(spark, path, "*.[xX][mM][lL]"))


def read_grids(spark: SparkSession, path: str) -> DataFrame:
    """Cells of all workbooks under a path."""
    return decode_grids(_landed(spark, path, "*.[xX][lL][sS]*"))
