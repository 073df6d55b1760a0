"""Books, sheets, exports and pages made by hand."""

import gzip
import io
import json
import zipfile

from pyspark.sql import functions as F

from larder.sources import archives, recipes


def zipped(files):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, data in files.items():
            z.writestr(name, data)
    return out.getvalue()


def as_files(spark, tmp_path, name, content):
    (tmp_path / name).write_bytes(content)
    return archives.binary(spark, str(tmp_path), name)


def workbook(sheets, merges=()):
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
    files = {
        "xl/workbook.xml": f"<workbook {ns}><sheets>" + "".join(f'<sheet name="{n}" sheetId="{i}" r:id="r{i}"/>' for i, n in enumerate(sheets)) + "</sheets></workbook>",
        "xl/_rels/workbook.xml.rels": "<Relationships>" + "".join(f'<Relationship Id="r{i}" Target="worksheets/s{i}.xml"/>' for i in range(len(sheets))) + "</Relationships>",
        "xl/sharedStrings.xml": f"<sst {ns}><si><t>Title</t></si></sst>",
    }
    for i, rows in enumerate(sheets.values()):
        cells = "".join(f'<row r="{r}">' + "".join(f'<c r="{chr(64 + c)}{r}" t="s"><v>0</v></c>' if t == "Title" else f'<c r="{chr(64 + c)}{r}" t="inlineStr"><is><t>{t}</t></is></c>' for c, t in enumerate(row, 1) if t) + "</row>" for r, row in enumerate(rows, 1))
        files[f"xl/worksheets/s{i}.xml"] = f"<worksheet {ns}><sheetData>{cells}</sheetData><mergeCells>" + "".join(f'<mergeCell ref="{m}"/>' for m in merges) + "</mergeCells></worksheet>"
    return zipped(files)


def test_wide_sheet(spark, tmp_path):
    book = workbook({"A": [["My recipes"], ["Title", "Ingredients", "Instructions", "Yield", "Tags"], ["Pie", "apple\nflour", "Mix.\nBake.", "4", "a, b"], [None, "lost", None, None, None]]})
    got = archives.wide_records(archives.sheet_cells(as_files(spark, tmp_path, "w.xlsx", book))).collect()
    assert [(r["row"], r["title"], r["ingredients"], r["instructions"], r["yield"], r["tags"]) for r in got] == [(3, "Pie", ["apple", "flour"], ["Mix.", "Bake."], "4", ["a", "b"])]


def test_template_and_tall_sheets(spark, tmp_path):
    cells = archives.sheet_cells(as_files(spark, tmp_path, "t.xlsx", workbook({"B": [["Title:", "Soup"], ["Ingredients", "water"], ["Notes", "hot"]]})))
    r = archives.template_records(cells).first()
    assert (r["title"], r["ingredients"], r["notes"], r["yield"]) == ("Soup", "water", "hot", None)
    tall = workbook({"C": [["Recipe", "Section", "Text"], ["Stew", "Ingredients", "beef"], [None, "Ingredients", "salt"], [None, "Directions", "Boil."], ["Tea", "Directions", "Steep."]]}, merges=["A2:A4"])
    got = archives.tall_records(archives.sheet_cells(as_files(spark, tmp_path, "c.xlsx", tall))).orderBy("first_row").collect()
    assert [(r["title"], r["ingredients"], r["instructions"]) for r in got] == [("Stew", ["beef", "salt"], ["Boil."]), ("Tea", [], ["Steep."])]


def test_epub(spark, tmp_path):
    opf = """<package xmlns="http://www.idpf.org/2007/opf"><manifest><item id="a" href="text/a.xhtml" media-type="application/xhtml+xml"/><item id="n" href="nav.xhtml" properties="nav" media-type="application/xhtml+xml"/>
    <item id="t" href="toc.xhtml" media-type="application/xhtml+xml"/><item id="i" href="i.png" media-type="image/png"/><item id="b" href="b.xhtml" media-type="application/xhtml+xml"/></manifest>
    <spine><itemref idref="n"/><itemref idref="b"/><itemref idref="t"/><itemref idref="i"/><itemref idref="a"/><itemref idref="gone"/></spine></package>"""
    book = zipped({"META-INF/container.xml": '<container><rootfiles><rootfile full-path="OEBPS/p.opf"/></rootfiles></container>', "OEBPS/p.opf": opf, "OEBPS/text/a.xhtml": "<p>A</p>", "OEBPS/nav.xhtml": "x", "OEBPS/toc.xhtml": "x", "OEBPS/b.xhtml": "<h1>B</h1><p>b</p>"})
    got = archives.epub_blocks(as_files(spark, tmp_path, "b.epub", book)).orderBy("spine", "block").collect()
    assert [(r["document"], r["tag"], r["text"]) for r in got] == [("OEBPS/b.xhtml", "h1", "B"), ("OEBPS/b.xhtml", "p", "b"), ("OEBPS/text/a.xhtml", "p", "A")]


def test_app_export(spark, tmp_path):
    book = zipped({"1.json.gz": gzip.compress(json.dumps({"name": "Pie", "ingredients": "a\nb", "servings": 4}).encode()), "2.json": "broken", "3.json": json.dumps({"name": "Tea"})})
    got = archives.app_records(as_files(spark, tmp_path, "x.paprikarecipes", book)).orderBy("entry").collect()
    assert [(r["entry"], r["name"], r["servings"]) for r in got] == [("1.json.gz", "Pie", "4"), ("3.json", "Tea", None)]


def test_schema_recipes(spark):
    recipe = {"@type": ["Thing", "Recipe"], "name": "Pie", "recipeIngredient": ["1  apple", ""], "recipeInstructions": [{"@type": "HowToSection", "itemListElement": [{"text": "Cut."}, {"text": "Bake."}]}, "Cut."], "recipeYield": "4"}
    script = lambda x: f'<script type="application/ld+json">{json.dumps(x)}</script>'
    page = script({"@graph": [{"@type": "WebPage"}, recipe]}) + script([recipe]) + '<script type="application/ld+json">{bad</script>'
    df = spark.createDataFrame([(1, page), (2, "<p>none</p>")], "id int, html string")
    got = recipes.schema_recipes(df, "id", "html").collect()
    assert [(r["id"], r["recipe"], r["name"], r["ingredients"], r["steps"], r["yield"]) for r in got] == [(1, 0, "Pie", ["1 apple"], ["Cut.", "Bake."], "4")]
    made = recipes.schema_recipes(df, "id", "html")
    assert made.select(recipes.schema_confidence(*map(F.col, ("name", "ingredients", "steps"))).alias("c")).first()["c"] == 0.3 + 0.2 + 0.3
    back = json.loads(made.select(recipes.json_ld_text(*map(F.col, ("name", "ingredients", "steps", "yield"))).alias("j")).first()["j"])
    assert back["recipeInstructions"][1] == {"@type": "HowToStep", "text": "Bake."}


def test_texts_with_several_recipes(spark):
    texts = [(1, "Apple Pie\nServes 4\napples\n\nBean Soup\n\nServes six\nbeans"), (2, "# One\na\n===\n# Two\nb"), (3, "# One\na\n# Two\nb"), (4, "just\ntext"), (5, "Only One\nServes 2\nx")]
    got = recipes.split_texts(spark.createDataFrame(texts, "id int, t string"), "id", "t").orderBy("id", "part").collect()
    assert [(r["id"], r["part"], r["text"]) for r in got] == [(1, 0, "Apple Pie\nServes 4\napples"), (1, 1, "Bean Soup\n\nServes six\nbeans"), (2, 0, "# One\na"), (2, 1, "# Two\nb"), (3, 0, "# One\na"), (3, 1, "# Two\nb"), (4, 0, "just\ntext"), (5, 0, "Only One\nServes 2\nx")]


def test_books_with_encoded_names_missing_files_and_no_book(spark, tmp_path):
    opf = """<package xmlns="http://www.idpf.org/2007/opf"><manifest><item id="a" href="chapter%201.xhtml#top" media-type="application/xhtml+xml"/><item id="b" href="lost.xhtml" media-type="application/xhtml+xml"/></manifest>
    <spine><itemref idref="a"/><itemref idref="b"/></spine></package>"""
    book = zipped({"META-INF/container.xml": '<container><rootfiles><rootfile full-path="p.opf"/></rootfiles></container>', "p.opf": opf, "chapter 1.xhtml": "<p>A</p>"})
    as_files(spark, tmp_path, "good.epub", book)
    as_files(spark, tmp_path, "bad.epub", b"no zip")
    as_files(spark, tmp_path, "odd.epub", zipped({"x": "y"}))
    got = archives.epub_blocks(archives.binary(spark, str(tmp_path), "*.epub")).collect()
    assert sorted((r["document"], r["tag"], r["text"]) for r in got if r["error"] is None) == [("chapter 1.xhtml", "p", "A"), ("lost.xhtml", "missing", None)]
    assert sorted((r["path"].rsplit("/", 1)[1], r["error"].split(":")[0]) for r in got if r["error"]) == [("bad.epub", "BadZipFile"), ("odd.epub", "KeyError")]


def test_schema_fields_that_are_lists(spark):
    ld = json.dumps({"@type": "Recipe", "name": ["Pie", "Tart"], "totalTime": ["PT5M"], "recipeYield": 4, "recipeIngredient": "salt", "recipeInstructions": "Mix."})
    page = f'<script type="application/ld+json">{ld}</script>'
    r = recipes.schema_recipes(spark.createDataFrame([(1, page)], "id int, html string"), "id", "html").first()
    assert (r["name"], r["total_time"], r["yield"], r["ingredients"]) == ("Pie", "PT5M", "4", ["salt"])
