"""Word-processor files and PDF text layers, by the standard library; pictures of text go to an engine that the caller gives."""

from __future__ import annotations

import io
import re
import zipfile
import zlib
from collections.abc import Callable, Iterator
from xml.etree import ElementTree

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.sources.archives import field_of, local_name, mapped


def _text(node) -> str:
    parts = []
    for e in node.iter():
        if local_name(e.tag) == "t":
            parts.append(e.text or "")
        elif local_name(e.tag) in ("br", "tab"):
            parts.append("\n" if local_name(e.tag) == "br" else "\t")
    return "".join(parts)


def _body(content: bytes):
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        return next(e for e in ElementTree.fromstring(z.read("word/document.xml")).iter() if local_name(e.tag) == "body")


def paragraphs(files: DataFrame) -> DataFrame:
    """path, block, style, text, error of the paragraphs outside tables of every DOCX of path, content."""

    def parse(content: bytes) -> Iterator[tuple]:
        n = 0
        for e in _body(content):
            if local_name(e.tag) == "p" and (t := _text(e).strip()):
                style = next((v for s in e.iter() if local_name(s.tag) == "pStyle" for k, v in s.attrib.items() if local_name(k) == "val"), None)
                yield n, style, t
                n += 1

    return mapped(files, parse, "block int, style string, text string")


def table_cells(files: DataFrame) -> DataFrame:
    """path, sheet (the table's number), row, col, text, error of the tables of every DOCX, as cells of sheets."""

    def parse(content: bytes) -> Iterator[tuple]:
        for i, table in enumerate(e for e in _body(content) if local_name(e.tag) == "tbl"):
            for r, row in enumerate((e for e in table if local_name(e.tag) == "tr"), 1):
                for c, cell in enumerate((e for e in row if local_name(e.tag) == "tc"), 1):
                    text = "\n".join(t for p in cell if local_name(p.tag) == "p" and (t := _text(p).strip()))
                    if text:
                        yield str(i), r, c, text

    return mapped(files, parse, "sheet string, row int, col int, text string")


def header_rows(cells: DataFrame, first: int = 5, least: int = 2) -> DataFrame:
    """path, sheet, row, fields: of the first rows the one that names most different known fields, the first of equals; two at least."""
    known = cells.filter(F.col("row") <= first).select("path", "sheet", "row", field_of(F.col("text")).alias("f")).filter("f IS NOT NULL")
    counts = known.groupBy("path", "sheet", "row").agg(F.count_distinct("f").alias("fields")).filter(F.col("fields") >= least)
    w = Window.partitionBy("path", "sheet").orderBy(F.desc("fields"), "row")
    return counts.withColumn("_r", F.row_number().over(w)).filter("_r = 1").drop("_r")


def table_records(cells: DataFrame) -> DataFrame:
    """path, sheet, row, title, ingredients, instructions, yield, tags, notes: a record for each row under the header, as wide sheets have."""
    head = header_rows(cells).select("path", "sheet", F.col("row").alias("_h"))
    joined = cells.join(head, ["path", "sheet"])
    fields = joined.filter("row = _h").select("path", "sheet", "col", field_of(F.col("text")).alias("field")).filter("field IS NOT NULL")
    body = joined.filter("row > _h").join(fields, ["path", "sheet", "col"])
    wide = body.groupBy("path", "sheet", "row").pivot("field", ["title", "ingredients", "instructions", "yield", "tags", "notes"]).agg(F.first("text"))
    items = lambda c, by: F.filter(F.transform(F.split(F.coalesce(F.col(c), F.lit("")), by), lambda x: F.trim(x)), lambda x: x != "")
    return wide.withColumns({"ingredients": items("ingredients", r"\n|;"), "instructions": items("instructions", r"\n"), "tags": items("tags", ",")}).filter("title IS NOT NULL")


_OBJECT = re.compile(rb"(\d+)\s+\d+\s+obj\b(.*?)\bendobj", re.S)
_STREAM = re.compile(rb"stream\r?\n(.*?)\r?\n?endstream", re.S)
_TOKEN = re.compile(rb"\((?:[^()\\]|\\.|\((?:[^()\\]|\\.)*\))*\)|<[0-9A-Fa-f\s]*>|\[|\]|[-+]?\d*\.?\d+|[A-Za-z'\"*]+|/[^\s/<>\[\]()]+", re.S)
_ESCAPES = {b"n": b"\n", b"r": b"\r", b"t": b"\t", b"b": b"", b"f": b""}


def _string(token: bytes) -> str:
    if token[:1] == b"<":
        digits = re.sub(rb"\s", b"", token[1:-1])
        raw = bytes.fromhex((digits + b"0" * (len(digits) % 2)).decode())
    else:
        raw = re.sub(rb"\\(\d{1,3}|.)", lambda m: bytes([int(m[1], 8) & 255]) if m[1].isdigit() else _ESCAPES.get(m[1], m[1]), token[1:-1], flags=re.S)
    return raw[2:].decode("utf-16-be", "replace") if raw[:2] == b"\xfe\xff" else raw.decode("cp1252", "replace")


def _shown(content: bytes) -> Iterator[tuple[float, float, str]]:
    """(x, y, text) of a content stream's text, by its moves; fonts are taken to be of the Western encoding."""
    stack: list = []
    x = y = left = top = lead = 0.0
    for token in _TOKEN.findall(content):
        if token[:1] in b"(<":
            stack.append(_string(token))
        elif re.fullmatch(rb"[-+]?\d*\.?\d+", token):
            stack.append(float(token))
        elif token in (b"[", b"]") or token[:1] == b"/":
            continue
        else:
            numbers = [s for s in stack if isinstance(s, float)]
            if token == b"BT":
                x = y = left = top = 0.0
            elif token in (b"Td", b"TD") and len(numbers) >= 2:
                left, top = left + numbers[-2], top + numbers[-1]
                x, y = left, top
                lead = -numbers[-1] if token == b"TD" else lead
            elif token == b"Tm" and len(numbers) >= 6:
                left, top = numbers[-2:]
                x, y = left, top
            elif token == b"TL" and numbers:
                lead = numbers[-1]
            elif token in (b"T*", b"'", b'"'):
                top -= lead
                x, y = left, top
            if token in (b"Tj", b"TJ", b"'", b'"'):
                # Wide gaps between the pieces of a shown array stand for blanks.
                text = "".join(s if isinstance(s, str) else " " if s < -200 else "" for s in stack)
                if text.strip():
                    yield x, y, text
            stack = []


def pdf_lines(content: bytes, first: int = 1, last: int | None = None) -> Iterator[tuple[int, int, float, float, str]]:
    """(page, line, x, y, text) of a PDF's text layer, top down; what stands at one height is one line. Encrypted files and compressed object streams aren't read."""
    objects = {int(m[1]): m[2] for m in _OBJECT.finditer(content)}
    if not objects or b"/Encrypt" in content:
        raise ValueError("no readable PDF objects")

    def stream(number: int) -> bytes:
        body = objects.get(number, b"")
        m = _STREAM.search(body)
        if not m:
            return b""
        return zlib.decompressobj().decompress(m[1]) if b"/FlateDecode" in body else m[1]

    pages = [n for n, b in objects.items() if re.search(rb"/Type\s*/Page\b(?!s)", b)]
    order = [int(r) for b in objects.values() if re.search(rb"/Type\s*/Pages\b", b) for k in re.findall(rb"/Kids\s*\[([^\]]*)\]", b) for r in re.findall(rb"(\d+)\s+\d+\s+R", k)]
    pages = sorted(pages, key=lambda n: (order.index(n) if n in order else len(order), n))
    for number, page in enumerate(pages, 1):
        if number < first or (last is not None and number > last):
            continue
        m = re.search(rb"/Contents\s*(?:\[([^\]]*)\]|(\d+)\s+\d+\s+R)", objects[page])
        refs = [] if not m else [int(m[2])] if m[2] else [int(r) for r in re.findall(rb"(\d+)\s+\d+\s+R", m[1])]
        rows: dict[int, list[tuple[float, float, str]]] = {}
        for x, y, text in _shown(b"\n".join(map(stream, refs))):
            rows.setdefault(-round(y), []).append((x, y, text))
        for line, (_, parts) in enumerate(sorted(rows.items())):
            parts.sort(key=lambda p: p[0])
            yield number, line, parts[0][0], parts[0][1], " ".join("".join(f"{t} " for _, _, t in parts).split())


def pdf_blocks(files: DataFrame, first: int = 1, last: int | None = None) -> DataFrame:
    """path, page, line, x, y, text, error of the text layers of PDFs (path, content)."""
    return mapped(files, lambda content: pdf_lines(content, first, last), "page int, line int, x double, y double, text string")


def recognised(files: DataFrame, engine: Callable[[bytes, int, int | None], Iterator[tuple[int, str, float]]], first: int = 1, last: int | None = None, least: float = 0.0) -> DataFrame:
    """path, page, line, text, confidence, error: what an engine reads in pictures of pages. The engine gives (page, text, confidence) of the pages of a file's bytes; it is called where the file's row is."""

    def parse(content: bytes) -> Iterator[tuple]:
        line: dict[int, int] = {}
        for page, text, confidence in engine(content, first, last):
            if confidence >= least and text.strip():
                line[page] = line.get(page, -1) + 1
                yield page, line[page], text.strip(), float(confidence)

    return mapped(files, parse, "page int, line int, text string, confidence double")


def needs_recognition(files: DataFrame, lines: DataFrame, least: int = 40) -> DataFrame:
    """Files whose text layer has fewer than `least` characters."""
    chars = lines.filter("text IS NOT NULL").groupBy("path").agg(F.sum(F.char_length("text")).alias("_n"))
    return files.join(chars, "path", "left").filter(F.coalesce("_n", F.lit(0)) < least).drop("_n")


def kind_scores(cells: DataFrame, header: DataFrame) -> DataFrame:
    """path, sheet, kind, score, sure: whether a sheet is wide, a template (labels with values beside them) or tall (a section and a text column); wide and not sure under 2 or with a lead under 1. header: header_rows of sheets (path, sheet, row, score)."""
    named = cells.withColumn("f", field_of(F.col("text")))
    template = named.filter("f IS NOT NULL").select("path", "sheet", "row", (F.col("col") + 1).alias("col"), "f").join(cells.select("path", "sheet", "row", "col"), ["path", "sheet", "row", "col"]).groupBy("path", "sheet").agg((F.count_distinct("f") * 1.0).alias("template"))
    at = header.select("path", "sheet", "row", F.col("score").alias("wide"))
    tall = named.join(at, ["path", "sheet", "row"]).groupBy("path", "sheet").agg(F.max("wide").alias("wide"), F.collect_set("f").alias("fs"))
    has: Callable[[str], Column] = lambda f: F.array_contains("fs", f)
    sheets = cells.select("path", "sheet").distinct().join(tall, ["path", "sheet"], "left").join(template, ["path", "sheet"], "left")
    scored = sheets.select("path", "sheet", F.coalesce("wide", F.lit(0.0)).alias("wide"), F.coalesce("template", F.lit(0.0)).alias("template"), F.when(has("title") & has("section") & has("text"), F.col("wide") + 2).otherwise(0.0).alias("tall"))
    ranked = F.reverse(F.array_sort(F.array(*(F.struct(F.col(k).alias("s"), F.lit(-i).alias("i"), F.lit(k).alias("k")) for i, k in enumerate(("wide", "template", "tall"))))))
    out = scored.withColumn("_r", ranked)
    sure = (F.col("_r")[0]["s"] >= 2) & (F.col("_r")[0]["s"] - F.col("_r")[1]["s"] >= 1)
    return out.select("path", "sheet", F.when(sure, F.col("_r")[0]["k"]).otherwise("wide").alias("kind"), F.col("_r")[0]["s"].alias("score"), sure.alias("sure"))

