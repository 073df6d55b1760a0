"""Word-processor files, PDF text layers and pages made by hand."""

import io
import zipfile
import zlib

import pytest
from pyspark.sql import functions as F

from larder.sources import archives, documents, pages


def as_files(spark, tmp_path, name, content):
    (tmp_path / name).write_bytes(content)
    return archives.binary(spark, str(tmp_path), name)


def docx(body):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("word/document.xml", f'<w:document xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"><w:body>{body}</w:body></w:document>')
    return out.getvalue()


def paragraph(text, style=""):
    return f'<w:p><w:pPr><w:pStyle w:val="{style}"/></w:pPr><w:r><w:t>{text}</w:t></w:r></w:p>' if style else f"<w:p><w:r><w:t>{text}</w:t></w:r></w:p>"


def table(rows):
    return "<w:tbl>" + "".join("<w:tr>" + "".join(f"<w:tc>{''.join(map(paragraph, c.split('|')))}</w:tc>" for c in r) + "</w:tr>" for r in rows) + "</w:tbl>"


def test_word_files(spark, tmp_path):
    content = docx(paragraph("My Book", "Title") + paragraph(" ") + table([["Some notes", "here"], ["Name", "Ingredients", "Directions"], ["Pie", "apple|flour", "Mix.|Bake."], ["", "lost", ""]]) + paragraph("The end"))
    files = as_files(spark, tmp_path, "a.docx", content)
    assert [(r["style"], r["text"]) for r in documents.paragraphs(files).orderBy("block").collect()] == [("Title", "My Book"), (None, "The end")]
    cells = documents.table_cells(files)
    assert [(r["row"], r["fields"]) for r in documents.header_rows(cells).collect()] == [(2, 3)]
    got = documents.table_records(cells).collect()
    assert [(r["row"], r["title"], r["ingredients"], r["instructions"]) for r in got] == [(3, "Pie", ["apple", "flour"], ["Mix.", "Bake."])]
    assert documents.paragraphs(as_files(spark, tmp_path, "b.docx", b"no zip")).first()["error"].startswith("BadZipFile")


def pdf(texts, compress=True):
    objects = [b"<< /Type /Catalog /Pages 2 0 R >>", b"<< /Type /Pages /Kids [" + b" ".join(b"%d 0 R" % (3 + 2 * i) for i in range(len(texts))) + b"] /Count %d >>" % len(texts)]
    for i, t in enumerate(texts):
        data = zlib.compress(t) if compress else t
        objects += [b"<< /Type /Page /Parent 2 0 R /Contents %d 0 R >>" % (4 + 2 * i), b"<< /Length %d%s >>\nstream\n%s\nendstream" % (len(data), b" /Filter /FlateDecode" if compress else b"", data)]
    return b"%PDF-1.4\n" + b"".join(b"%d 0 obj\n%s\nendobj\n" % (i, o) for i, o in enumerate(objects, 1))


def test_pdf_text_layers(spark, tmp_path):
    first = b"BT /F1 12 Tf 72 700 Td (Apple \\(green\\) Pie) Tj 0 -20 Td [(Ser) -20 (ves) -300 (4)] TJ ET BT 1 0 0 1 300 700 Tm (right) Tj ET"
    second = b"BT 14 TL 72 500 Td (one) Tj T* (two) Tj <FEFF00E9> ' ET"
    for compress in (True, False):
        files = as_files(spark, tmp_path, "a.pdf", pdf([first, second], compress))
        got = [(r["page"], r["line"], r["text"]) for r in documents.pdf_blocks(files).orderBy("page", "line").collect()]
        assert got == [(1, 0, "Apple (green) Pie right"), (1, 1, "Serves 4"), (2, 0, "one"), (2, 1, "two"), (2, 2, "é")]
        assert [r["text"] for r in documents.pdf_blocks(files, 2, 2).orderBy("line").collect()] == ["one", "two", "é"]
    bad = documents.pdf_blocks(as_files(spark, tmp_path, "b.pdf", b"nothing")).first()
    assert bad["error"].startswith("ValueError") and bad["text"] is None
    both = archives.binary(spark, str(tmp_path), "*.pdf")
    assert [r["path"].rsplit("/", 1)[1] for r in documents.needs_recognition(both, documents.pdf_blocks(both), 5).collect()] == ["b.pdf"]


def test_recognition_by_an_engine(spark, tmp_path):
    def engine(content, first, last):
        yield from ((1, content.decode(), 0.9), (1, "faint", 0.2), (2, " ", 1.0))

    got = documents.recognised(as_files(spark, tmp_path, "a.png", b"shown"), engine, least=0.5).collect()
    assert [(r["page"], r["line"], r["text"], r["confidence"]) for r in got] == [(1, 0, "shown", 0.9)]


def page_frame(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "id int, html string")


def test_table_rows(spark):
    df = page_frame(spark, "<table><tr><th>Cut</th><th>Time &amp; heat</th></tr><tr><td>Rib<br>eye</td><td> 5 <b>min</b></td></tr><tr><td> </td></tr></table>", None)
    assert [(r["id"], r["row"], r["cells"], r["is_header"]) for r in pages.table_rows(df, "id", "html").orderBy("row").collect()] == [(0, 0, ["Cut", "Time & heat"], True), (0, 1, ["Rib eye", "5 min"], False)]


def test_elements_and_main_text(spark):
    long = "This paragraph has quite a few words that make a sentence of it."
    df = page_frame(spark, f"<nav>menu</nav><p><b>A bold line</b></p><ul><li><a href='x'>link one</a></li><li>2 cups flour</li></ul><p>{long}</p><h2>Head</h2>", "")
    got = [(r["tag"], r["kind"], r["text"]) for r in pages.elements(df, "id", "html").orderBy("block").collect()]
    assert got == [("p", "Title", "A bold line"), ("li", "ListItem", "link one"), ("li", "ListItem", "2 cups flour"), ("p", "NarrativeText", long), ("h2", "Title", "Head")]
    texts = {r["id"]: r for r in pages.main_text(df, "id", "html", "prose").collect()}
    assert texts[0]["text"] == long and (texts[1]["text"], texts[1]["way"], texts[1]["quality"]) == ("", "none", 0.0)
    best = pages.main_text(df, "id", "html").filter("id = 0").first()
    every = [pages.main_text(df, "id", "html", w).filter("id = 0").first() for w in pages.WAYS]
    assert best["quality"] == max(r["quality"] for r in every) and len(best["text"]) == max(len(r["text"]) for r in every if r["quality"] == best["quality"])
    with pytest.raises(ValueError):
        pages.main_text(df, "id", "html", "magic")


def test_breaks_and_extractors(spark):
    html = "<script>x<br></script><p class='a'>one<br/>two<br> <b>three</b></p><div><p>in<br>ner</p></div><li><br></li>"
    assert pages.split_breaks(html) == "<p class='a'>one</p><p class='a'>two</p><p class='a'> <b>three</b></p><div><p>in</p><p>ner</p></div>"
    df = page_frame(spark, html)
    assert pages.prepared(df, "id", "html", "none").first()["html"] == html and pages.prepared(df, "id", "html").first()["html"] == pages.split_breaks(html)
    md = page_frame(spark, "<h2>Head</h2><ul><li>item</li></ul><p>text</p>")
    assert pages.as_markdown(pages.EXTRACTORS["blocks"](md, "id", "html"), "id").first()["text"] == "## Head\n\n- item\n\ntext"
    assert [(r["kind"], r["text"]) for r in pages.extracted(md, "id", "html", "markdown").orderBy("block").collect()] == [("heading", "Head"), ("item", "item"), ("paragraph", "text")]
    with pytest.raises(ValueError):
        pages.extracted(md, "id", "html", "none")


def test_cleaned_blocks(spark):
    rows = [(0, "p", "Page 12"), (1, "li", "• one\n- two"), (2, "p", "a long line that goes on\nand on in the next"), (3, "p", "2 cups flour\n1 tsp salt"), (4, "p", " "), (5, "p", "a\nb\nc")]
    df = spark.createDataFrame([("b", *r) for r in rows], "k string, o int, tag string, t string")
    got = [(r["o"], r["part"], r["text"]) for r in pages.cleaned_blocks(df, ["k"], "o", "t", "tag").orderBy("o", "part").collect()]
    assert got == [(1, 0, "one"), (1, 1, "two"), (2, 0, "a long line that goes on and on in the next"), (3, 0, "2 cups flour"), (3, 1, "1 tsp salt"), (5, 0, "a"), (5, 1, "b"), (5, 2, "c")]
    h = pages.health(df, ["k"], "t").first()
    assert (h["blocks"], h["empty"], h["warnings"]) == (6, 1, ["little text"])


def test_kinds_of_sheets(spark):
    rows = [("w", 1, 1, "Title"), ("w", 1, 2, "Ingredients"), ("w", 1, 3, "Directions"), ("w", 2, 1, "Pie"), ("t", 1, 1, "Title:"), ("t", 1, 2, "Soup"), ("t", 2, 1, "Yield"), ("t", 2, 2, "4"), ("t", 3, 1, "Notes"), ("t", 3, 2, "hot"), ("t", 4, 1, "Ingredients"), ("t", 4, 2, "water"), ("t", 5, 1, "Tags"), ("t", 5, 2, "x")]
    rows += [("l", 1, 1, "Recipe"), ("l", 1, 2, "Section"), ("l", 1, 3, "Text"), ("l", 2, 3, "x")]
    cells = spark.createDataFrame([("p", *r) for r in rows], "path string, sheet string, row int, col int, text string")
    got = {r["sheet"]: r["kind"] for r in documents.kind_scores(cells, archives.header_rows(cells)).collect()}
    assert got["l"] == "tall" and got["w"] == "wide" and set(got) == {"w", "t", "l"}
    assert documents.kind_scores(cells, archives.header_rows(cells)).filter(F.col("score").isNull()).count() == 0
