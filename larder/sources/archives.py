"""Zip-based books and sheets, by the standard library: EPUB spines, spreadsheet grids, app exports.

Files come as binary rows; each file is parsed where its row is, and what leaves is block or cell rows.
"""

from __future__ import annotations

import gzip
import io
import json
import posixpath
import re
import zipfile
import zlib
from collections.abc import Iterator
from urllib.parse import unquote
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from larder.sources.html import _parsed

_HTML_TYPES = ("application/xhtml+xml", "text/html")
#: What unreadable files raise.
_BROKEN = (zipfile.BadZipFile, zlib.error, ElementTree.ParseError, KeyError, StopIteration, IndexError, ValueError, AttributeError, OSError, RuntimeError, NotImplementedError)
_SKIPPED = re.compile(r"(?:^|[/_.-])(?:nav|toc|contents)(?:[/_.-]|$)", re.I)


def binary(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(path).select("path", "content")


def mapped(df: DataFrame, parse, columns: str) -> DataFrame:
    """The rows that parse() finds in each file; of a file that it can't read one row, with the error."""
    names = ["path", *(c.split()[0] for c in columns.split(", ")), "error"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                try:
                    rows = [(path, *r, None) for r in parse(content)]
                except (*_BROKEN,) as e:
                    rows = [(path, *[None] * (len(names) - 2), f"{type(e).__name__}: {e}")]
                yield pd.DataFrame(rows, columns=names, dtype=object)

    return df.mapInPandas(run, f"path string, {columns}, error string")


def local_name(tag: str) -> str:
    return tag.rpartition("}")[2]


def spine(content: bytes) -> list[tuple[str, bytes | None]]:
    """(name, bytes) of an EPUB's reading order, without navigation and tables of contents; no bytes where the book lacks the file."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        names = set(z.namelist())
        container = ElementTree.fromstring(z.read("META-INF/container.xml"))
        package = next(e.get("full-path") for e in container.iter() if local_name(e.tag) == "rootfile")
        opf = ElementTree.fromstring(z.read(package))
        items = {e.get("id"): e for e in opf.iter() if local_name(e.tag) == "item"}
        out = []
        for ref in (e.get("idref") for e in opf.iter() if local_name(e.tag) == "itemref"):
            item = items.get(ref)
            if item is None or item.get("media-type") not in _HTML_TYPES or "nav" in (item.get("properties") or "").split():
                continue
            name = posixpath.normpath(posixpath.join(posixpath.dirname(package), unquote(item.get("href").partition("#")[0])))
            if not _SKIPPED.search(posixpath.basename(name)) and ref.lower() not in ("nav", "toc"):
                out.append((name, z.read(name) if name in names else None))
        return out


def epub_blocks(files: DataFrame) -> DataFrame:
    """path, spine, document, block, tag, depth, text, error of every EPUB of path, content; a file that the book lacks is a row of tag "missing"."""

    def parse(content: bytes) -> Iterator[tuple]:
        for i, (name, data) in enumerate(spine(content)):
            if data is None:
                yield i, name, 0, "missing", 0, None
                continue
            for k, (tag, depth, text) in enumerate(_parsed(data.decode("utf-8", "replace"))):
                yield i, name, k, tag, depth, text

    return mapped(files, parse, "spine int, document string, block int, tag string, depth int, text string")


def _cell_place(ref: str) -> tuple[int, int]:
    letters, digits = re.fullmatch(r"([A-Z]+)(\d+)", ref).groups()
    col = 0
    for c in letters:
        col = col * 26 + ord(c) - 64
    return int(digits), col


def grid(content: bytes) -> Iterator[tuple[str, int, int, str]]:
    """(sheet, row, column, text) of a workbook's cells that aren't empty; merged cells repeat their value."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        names = set(z.namelist())
        shared = []
        if "xl/sharedStrings.xml" in names:
            shared = ["".join(t.text or "" for t in s.iter() if local_name(t.tag) == "t") for s in ElementTree.fromstring(z.read("xl/sharedStrings.xml")) if local_name(s.tag) == "si"]
        links = {e.get("Id"): e.get("Target") for e in ElementTree.fromstring(z.read("xl/_rels/workbook.xml.rels"))}
        for sheet in (e for e in ElementTree.fromstring(z.read("xl/workbook.xml")).iter() if local_name(e.tag) == "sheet"):
            target = next(links[v] for k, v in sheet.attrib.items() if local_name(k) == "id" and v in links)
            root = ElementTree.fromstring(z.read(posixpath.normpath(posixpath.join("xl", target.removeprefix("/xl/")))))
            cells = {}
            for c in (e for e in root.iter() if local_name(e.tag) == "c"):
                text = "".join(x.text or "" for x in c.iter() if local_name(x.tag) in ("v", "t"))
                if c.get("t") == "s" and text:
                    text = shared[int(text)]
                if text.strip():
                    cells[_cell_place(c.get("r"))] = text.strip()
            for m in (e.get("ref") for e in root.iter() if local_name(e.tag) == "mergeCell"):
                (r1, c1), (r2, c2) = map(_cell_place, m.split(":"))
                for r in range(r1, r2 + 1):
                    for c in range(c1, c2 + 1):
                        if (r1, c1) in cells:
                            cells[r, c] = cells[r1, c1]
            for (r, c), text in sorted(cells.items()):
                yield sheet.get("name"), r, c, text


def sheet_cells(files: DataFrame) -> DataFrame:
    """path, sheet, row, col, text, error of every workbook of path, content."""
    return mapped(files, grid, "sheet string, row int, col int, text string")


#: Header names and the field they stand for.
HEADERS = {
    "title": "title", "name": "title", "recipe": "title", "ingredients": "ingredients", "ingredient": "ingredients", "instructions": "instructions", "directions": "instructions", "method": "instructions",
    "steps": "instructions", "yield": "yield", "servings": "yield", "serves": "yield", "tags": "tags", "notes": "notes", "description": "notes", "section": "section", "text": "text",
}


def field_of(text):
    key = F.regexp_replace(F.lower(F.trim(text)), r"[:\s]+$", "")
    return F.element_at(F.create_map(*(F.lit(x) for kv in HEADERS.items() for x in kv)), key)


def header_rows(cells: DataFrame, first: int = 30) -> DataFrame:
    """path, sheet, row, score: of the first rows, that with most cells, unlike labels and words; two cells at least."""
    scored = cells.filter(F.col("row") <= first).groupBy("path", "sheet", "row").agg(F.count("*").alias("n"), F.count_distinct(F.lower("text")).alias("d"), F.count_if(~F.col("text").rlike(r"^[\d.,\s]+$")).alias("w"), F.count(field_of(F.col("text"))).alias("known"))
    scored = scored.filter("n >= 2").withColumn("score", F.col("n") + F.col("d") / F.col("n") + F.col("w") / F.col("n") + F.col("known"))
    w = Window.partitionBy("path", "sheet").orderBy(F.desc("score"), "row")
    return scored.withColumn("_r", F.row_number().over(w)).filter("_r = 1").select("path", "sheet", "row", "score")


def wide_records(cells: DataFrame) -> DataFrame:
    """path, sheet, row, title, ingredients, instructions, yield, tags, notes: a record for each row under the header."""
    head = header_rows(cells).select("path", "sheet", F.col("row").alias("_h"))
    joined = cells.join(head, ["path", "sheet"])
    fields = joined.filter("row = _h").select("path", "sheet", "col", field_of(F.col("text")).alias("field")).filter("field IS NOT NULL")
    body = joined.filter("row > _h").join(fields, ["path", "sheet", "col"])
    wide = body.groupBy("path", "sheet", "row").pivot("field", ["title", "ingredients", "instructions", "yield", "tags", "notes"]).agg(F.first("text"))
    items = lambda c, by: F.filter(F.transform(F.split(F.coalesce(F.col(c), F.lit("")), by), lambda x: F.trim(x)), lambda x: x != "")
    return wide.withColumns({"ingredients": items("ingredients", r"\n|;"), "instructions": items("instructions", r"\n"), "tags": items("tags", ",")}).filter("title IS NOT NULL")


def template_records(cells: DataFrame) -> DataFrame:
    """path, sheet and the fields of sheets that hold a label in a cell and its value in the next one."""
    labels = cells.select("path", "sheet", "row", "col", field_of(F.col("text")).alias("field")).filter("field IS NOT NULL")
    values = cells.select("path", "sheet", "row", (F.col("col") - 1).alias("col"), "text")
    return labels.join(values, ["path", "sheet", "row", "col"]).groupBy("path", "sheet").pivot("field", ["title", "ingredients", "instructions", "yield", "notes"]).agg(F.min_by("text", "row"))


def tall_records(cells: DataFrame) -> DataFrame:
    """path, sheet, title, first_row, ingredients, instructions of sheets of recipe, section and text columns; blank titles repeat the last one."""
    head = header_rows(cells).select("path", "sheet", F.col("row").alias("_h"))
    joined = cells.join(head, ["path", "sheet"])
    fields = joined.filter("row = _h").select("path", "sheet", "col", field_of(F.col("text")).alias("field")).filter("field IS NOT NULL")
    body = joined.filter("row > _h").join(fields, ["path", "sheet", "col"])
    rows = body.groupBy("path", "sheet", "row").pivot("field", ["title", "section", "text"]).agg(F.first("text"))
    w = Window.partitionBy("path", "sheet").orderBy("row")
    rows = rows.withColumns({c: F.last(c, ignorenulls=True).over(w) for c in ("title", "section")}).filter("title IS NOT NULL AND text IS NOT NULL")
    part = lambda pattern: F.transform(F.array_sort(F.collect_list(F.when(F.lower("section").rlike(pattern), F.struct("row", "text")))), lambda r: r["text"])
    return rows.groupBy("path", "sheet", "title").agg(F.min("row").alias("first_row"), part("^ingredient").alias("ingredients"), part("^(instruction|direction|method|step)").alias("instructions"))


def app_records(files: DataFrame) -> DataFrame:
    """path, entry, name, ingredients, directions, servings, source, error of exports that zip a compressed JSON for each recipe."""

    def parse(content: bytes) -> Iterator[tuple]:
        with zipfile.ZipFile(io.BytesIO(content)) as z:
            for name in sorted(z.namelist()):
                raw = z.read(name)
                try:
                    data = json.loads(gzip.decompress(raw) if raw[:2] == b"\x1f\x8b" else raw)
                except (ValueError, OSError, EOFError):
                    continue
                if isinstance(data, dict):
                    yield (name, *(None if data.get(k) is None else str(data[k]) for k in ("name", "ingredients", "directions", "servings", "source")))

    return mapped(files, parse, "entry string, name string, ingredients string, directions string, servings string, source string")
