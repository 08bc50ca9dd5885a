import json
import zipfile
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from loamwork.plans.sections import heading_blocks
from loamwork.sinks import files as K
from loamwork.sinks.files import NO_TEXT, bar_chart, comparison_page, docx_files, json_files, write_files
from loamwork.sources import files as S


def pdf(pages):
    body = [b"%PDF-1.4\n1 0 obj<</Type /Catalog /Pages 2 0 R>>endobj\n2 0 obj<</Type /Pages /Count 1>>endobj\n"]
    for k, lines in enumerate(pages):
        text = b"BT " + b" ".join(b"(" + x.encode("latin-1").replace(b"(", rb"\(").replace(b")", rb"\)") + b") Tj" for x in lines) + b" [(sp) -20 (lit)] TJ ET"
        packed = zlib.compress(text) if k % 2 else text
        kind = b"/Filter /FlateDecode " if k % 2 else b""
        body.append(b"%d 0 obj<</Type /Page /Contents %d 0 R>>endobj\n%d 0 obj<<%s/Length %d>>\nstream\n%s\nendstream endobj\n" % (3 + 2 * k, 4 + 2 * k, 4 + 2 * k, kind, len(packed), packed))
    return b"".join(body) + b"%" * 1000


def test_docx_round_trip(spark, tmp_path):
    pages = spark.createDataFrame([("a", 2, None), ("a", 1, "one <&>\n\ntwo\x00"), ("b", 1, "é")], "name string, page int, text string")
    assert write_files(docx_files(pages), str(tmp_path / "d"), ".docx") == 2
    got = S.docx_paragraphs(S.read_files(spark, str(tmp_path / "d"), "*.docx")).collect()
    assert [r.text for r in sorted((r for r in got if r.path.endswith("a.docx")), key=lambda r: r.paragraph)] == ["Page 1", "one <&>", "two", "Page 2", NO_TEXT]
    assert write_files(docx_files(pages.limit(0)), str(tmp_path / "e")) == 0


def test_pdf_and_zip(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "12_x.pdf").write_bytes(pdf([["Hello (1)", "world"], ["page two"]]))
    (tmp_path / "y.pdf").write_bytes(b"nothing")
    with zipfile.ZipFile(tmp_path / "z.zip", "w") as box:
        box.writestr("readme.txt", "-")
        box.writestr("in/One.PDF", b"%PDF")
    (tmp_path / "bad.zip").write_bytes(b"x")
    found = {r.name: (r.serial, r.length) for r in S.find_files(spark, str(tmp_path)).collect()}
    assert found["12_x.pdf"][0] == 12 and found["y.pdf"] == (999_999, 7)
    pages = S.pdf_pages(S.read_files(spark, str(tmp_path), "*.pdf")).collect()
    assert sorted((r.page, r.text) for r in pages if r.error is None) == [(1, "Hello (1)\nworld\nsplit"), (2, "page two\nsplit")]
    assert [r.error for r in pages if r.error] == ["ValueError: no PDF mark"]
    problems = {r.path[-5:]: r.p for r in S.read_files(spark, str(tmp_path), "*.pdf").select("path", S.pdf_problem(F.col("content")).alias("p")).collect()}
    assert problems == {"x.pdf": None, "y.pdf": "too small"}
    members = {r.path[-7:]: (r.member, r.error is None) for r in S.first_member(S.read_files(spark, str(tmp_path), "*.zip")).collect()}
    assert sorted(members.values(), key=str) == [("in/One.PDF", True), (None, False)]


def test_json(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"k": 1}, {"k": 2}]')
    (tmp_path / "b.json").write_text('{"entries": [{"k": 3}]}')
    (tmp_path / "c.json").write_text("oops")
    got = S.missing_entries(S.read_files(spark, str(tmp_path), "*.json")).collect()
    assert sorted(json.loads(r.entry)["k"] for r in got) == [1, 2, 3]
    rows = json_files(spark.createDataFrame([("r", "é", None)], "n string, t string, u string"), "n").first()
    assert json.loads(bytes(rows.content)) == {"t": "é", "u": None}


def test_pages(spark):
    data = spark.createDataFrame([("a<b", 2), ("c", 4), ("d", None)], "model string, n int")
    page = bar_chart(data, "model", "n", "T&T")
    assert page.index(">c<") < page.index("a&lt;b") and "T&amp;T" in page and bar_chart(data.limit(0), "model", "n", "")
    assert "<td>4</td>" in comparison_page(data, "t")


def xlsx(path, rows):
    shared = sorted({v for r in rows for v in r if isinstance(v, str)})
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    cell = lambda at, v: "" if v is None else f'<c r="{at}" t="s"><v>{shared.index(v)}</v></c>' if isinstance(v, str) else f'<c r="{at}"><v>{v}</v></c>'
    sheet = "".join(f'<row r="{k}">' + "".join(cell(f"{'ABCDEF'[j]}{k}", v) for j, v in enumerate(r)) + "</row>" for k, r in enumerate(rows, 1))
    with zipfile.ZipFile(path, "w") as box:
        box.writestr("xl/sharedStrings.xml", f"<sst {ns}>" + "".join(f"<si><r><t>{x[:2]}</t></r><r><t>{x[2:]}</t></r></si>" for x in shared) + "</sst>")
        box.writestr("xl/worksheets/sheet1.xml", f"<worksheet {ns}><sheetData>{sheet}</sheetData></worksheet>")


def test_registry_from_a_workbook(spark, tmp_path):
    from loamwork.plans.companies import companies, registry_json

    xlsx(tmp_path / "r.xlsx", [["Company Name ", " Symbol", "Sr. No", "Filename"], ["Alpha Ltd.", "ALP", 7, None], ["Beta Limited", None, 8, "x"], [None, "GAM", None, None], ["Delta Pvt Ltd", " DEL ", "no", "  "], ["alpha", "AL2", 2.0, "{year}"]])
    raw = S.read_registry(spark, str(tmp_path / "r.xlsx"))
    found = companies(raw, "row_index")
    got = [(r.company_name, r.symbol, r.row_index, r.serial_number, r.naming_convention) for r in found.orderBy("row_index").collect()]
    assert got == [("Alpha", "ALP", 1, 7, None), ("Delta", "DEL", 4, 4, None), ("alpha", "AL2", 5, 2, "{year}")]
    data = json.loads(registry_json(found).first().json)
    assert data["total_companies"] == 3 and data["symbol_lookup"] == {"alpha": "AL2", "delta": "DEL"} and data["companies"][0]["symbol"] == "ALP"
    raw.write.option("header", "true").csv(str(tmp_path / "r.csv"))
    assert companies(S.read_registry(spark, str(tmp_path / "r.csv")).drop("row_index").withColumn("n", F.lit(1)), "n").count() == 3


def test_tables_replaced_and_read(spark, tmp_path):
    path, schema = str(tmp_path / "status"), "symbol string, year int, error string"
    assert S.read_csv(spark, path, schema).count() == 0
    K.replace_table(spark.createDataFrame([("A", "2023"), ("B", "x")], "symbol string, year string"), path)
    read = S.read_csv(spark, path, schema)
    assert sorted((r.symbol, r.year, r.error) for r in read.collect()) == [("A", 2023, None), ("B", None, None)]
    K.replace_table(read.filter("symbol = 'A'"), path)  # read from where it is written
    assert S.read_csv(spark, path, schema).count() == 1


def test_exports_and_themes(spark, tmp_path):
    topics = spark.createDataFrame([(-1, 3, "o"), (0, 5, "a"), (1, 2, "b")], "Topic int, Count int, Name string")
    words = spark.createDataFrame([(0, 1, "x"), (0, 2, "y"), (1, 1, "z"), (-1, 1, "q")], "Topic int, place int, word string")
    done = K.topic_exports(str(tmp_path / "out"), topics, topics.select("Topic"), words)
    assert done == dict.fromkeys(["topic_info", "topic_keywords", "document_topics", "model_stats"])
    stats = spark.read.option("header", "true").csv(str(tmp_path / "out/model_stats")).first()
    assert (stats.total_documents, stats.num_topics, stats.outlier_percentage, stats.median_topic_size) == ("10", "2", "30.0", "3.5")
    assert [r.value for r in K.themes_text(words.filter("Topic >= 0")).collect()] == ["Topic 0: ['x', 'y']", "Topic 1: ['z']"]

    def fails():
        raise OSError("full")

    assert K.export_all({"a": lambda: 1, "b": fails}) == {"a": None, "b": "OSError: full"}
    assert json.loads(K.summary_json(topics.agg(F.sum("Count").alias("n")), "2024-01-01T00:00:00")) == {"timestamp": "2024-01-01T00:00:00", "n": 10}


def test_report_document(spark, tmp_path):
    text = "BUSINESS OVERVIEW\nwhat the company does, at length\n\nRisk Management And Outlook For The Next Years:\nsecond paragraph that is long enough"
    rows = spark.createDataFrame([("r", "T", text)], "name string, title string, text string").withColumn("lines", F.split("text", "\n", -1))
    assert K.write_files(K.report_docx(rows.withColumn("blocks", heading_blocks(F.col("text"), F.col("lines")))), str(tmp_path / "o"), ".docx") == 1
    got = [r.text for r in S.docx_paragraphs(S.read_files(spark, str(tmp_path / "o"), "*.docx")).orderBy("paragraph").collect()]
    assert got == ["T", "BUSINESS OVERVIEW", "what the company does, at length", "Risk Management And Outlook For The Next Years:", "second paragraph that is long enough"]


def test_pdf_info_fallbacks_and_pictures(spark, tmp_path):
    (tmp_path / "a.pdf").write_bytes(pdf([["x" * 60], ["short"]]) + b"<</Title (A \\(b\\)) /Author (C) /CreationDate (D:2024)>>")
    (tmp_path / "b.pdf").write_bytes(b"%PDF" + b" " * 2000)
    files = S.read_files(spark, str(tmp_path), "*.pdf")
    info = {r.filename: r for r in S.pdf_info(files).collect()}
    assert info["a.pdf"].pages == 2 and info["a.pdf"].author == "C" and info["a.pdf"].creation_date == "D:2024" and info["b.pdf"].pages == 0
    assert {r.path[-5:]: r.p for r in files.select("path", S.pdf_problem(F.col("content")).alias("p")).collect()} == {"a.pdf": None, "b.pdf": "no pages"}

    def broken(_):
        raise ValueError("cannot")

    one = files.filter("path LIKE '%a.pdf'")
    got = S.pages_with_fallbacks(one, [broken, S.pdf_pages_of, lambda _: ["y", "z" * 70, ""]]).orderBy("page").collect()
    assert [r.text[:5] for r in got[:2]] == ["xxxxx", "zzzzz"]
    assert "cannot" in S.pages_with_fallbacks(one, [broken]).first().error
    routed = S.routed_pages(files.withColumn("kind", F.when(F.col("path").endswith("a.pdf"), "scanned")), lambda _: ["text"], lambda _: ["ocr"]).collect()
    assert sorted((r.path[-5:], r.text) for r in routed) == [("a.pdf", "ocr"), ("b.pdf", "text")]
    assert S.binarised(np.array([[10, 20], [200, 250]])).tolist() == [[0, 0], [255, 255]]
    pages = spark.createDataFrame([("p", 2, "b"), ("p", 1, "a"), ("p", 3, "c")], "path string, page int, text string")
    assert S.first_pages(pages, 2).first().text == "a\nb"


def test_reports_and_models(spark, tmp_path):
    (tmp_path / "j").mkdir()
    (tmp_path / "j" / "a.json").write_text('{"structure": []}')
    (tmp_path / "j" / "b.json").write_text("{oops")
    got = {r.source_file: (r.json, r.error) for r in S.report_files(spark, str(tmp_path / "j")).collect()}
    assert got == {"a.json": ('{"structure": []}', None), "b.json": (None, "no JSON object")}
    words = S.placed_words(S.read_files(spark, str(tmp_path / "j"), "*.json"), lambda c: [(1, "w", 0.0, 1.0, 2.0, 3.0)] if c.startswith(b'{"') else [][0]).collect()
    assert sorted((r.path[-6:], r.text, r.bottom, (r.error or "")[:10]) for r in words) == [("a.json", "w", 3.0, ""), ("b.json", None, None, "IndexError")]
    assert [r.chars for r in S.json_sizes(S.read_files(spark, str(tmp_path / "j"), "*.json")).collect()] == [17, 5]
    assert [r.name for r in S.first_files(spark, str(tmp_path / "j"), "*.json", 1).collect()] == ["a.json"]
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    rows = spark.createDataFrame([([0.0],), ([1.0],), ([9.0],)], "v array<double>").select(array_to_vector("v").alias("features"))
    model = KMeans(k=2, seed=1).fit(rows)
    K.save_model(model, str(tmp_path / "m"))
    K.save_model(model, str(tmp_path / "m"))
    assert np.allclose(K.load_model(str(tmp_path / "m")).clusterCenters(), model.clusterCenters())


def test_more_charts(spark):
    data = spark.createDataFrame([("E", "t1", 3), ("E", "t2", 1), ("S", "t3", 4)], "category string, topic string, n int")
    assert "E: 4 (50.0%)" in K.pie_chart(data.groupBy("category").agg(F.sum("n").alias("n")), "category", "n", "p")
    page = K.sunburst(data, "s", 1)
    assert "Total: 8" in page and "<li>E: 4<ul><li>t1: 3</li><li>others: 1</li></ul></li>" in page
    assert K.table_page(data, "t", "n").index("t3") < K.table_page(data, "t", "n").index("t1")
    many = spark.range(300).select(F.col("id").cast("string").alias("k"), "id")
    assert "The first 200 of 300." in K.bar_chart(many, "k", "id", "b")
    assert "<li>topics: a</li>" in comparison_page(spark.createDataFrame([("a", 1, True), ("b", 2, False)], "model string, n int, wins_topics boolean"), "c")
