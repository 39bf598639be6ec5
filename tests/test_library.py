"""The library's functions, operators and parsers on small fixtures."""

import json

import pytest
from pyspark.sql import functions as F

from corpuslens.functions import text as X
from corpuslens.operators import corpus as C
from corpuslens.operators import search as S
from corpuslens.sources import parsers as P


@pytest.mark.parametrize("most, overlap", [(-3, 0), (0, 0), (9, -2), (7, 7), (7, 30)])
def test_splitter_rejects_sizes(most, overlap):
    with pytest.raises(ValueError):
        X.split_points("text", most, overlap)


@pytest.mark.parametrize(
    "text, most, overlap, want",
    [
        ("abc", 4, 1, ["abc"]),
        ("", 4, 1, []),
        ("ab\n\ncd\nef", 8, 0, ["ab\n\n", "cd\nef"]),
        ("ab\ncdefgh", 6, 0, ["ab\n", "cdefgh"]),
        ("abcdefgh", 3, 1, ["abc", "cde", "efg", "gh"]),
        ("日本語文字", 2, 0, ["日本", "語文", "字"]),
        ("aaaa    ", 4, 0, ["aaaa"]),
    ],
)
def test_splitter(text, most, overlap, want):
    assert [text[a:z] for a, z in X.split_points(text, most, overlap)] == want


def test_tokens_and_normalizer(spark):
    text = "Ticket QX-77  billed 12,345,678.25\r\nmax_retry_count r3.14 ＡＢｃ　請求先 Größe\r a/b"
    row = spark.createDataFrame([(text,)], "t string").select(X.normalize(F.col("t")).alias("n")).first()
    assert row.n == "ticket qx-77 billed 12,345,678.25\nmax_retry_count r3.14 abc 請求先 grösse\na/b"
    got = spark.createDataFrame([(row.n,)], "t string").select(X.word_tokens(F.col("t")).alias("w")).first().w
    assert got == ["ticket", "qx-77", "qx", "77", "billed", "12,345,678.25", "12345678.25", "12", "345", "678", "25", "max_retry_count", "max", "retry", "count", "r3.14", "r3", "14", "abc", "請求先", "gr", "sse", "a/b", "a", "b"]


def test_normalizer_equals_the_standard_library(spark):
    import random
    import re
    import unicodedata

    rng = random.Random(17)
    pools = ["abc XYZ\t\n", "ÀÉîß ÿŒš–“", "ﬁ①Ⅷ㎏ｱ½ ²…", "ΣσςΑ ΐ", "İıŞ", "é\u0301a\u0308", "한글カﾞ", "\x0b\x0c\r\u00a0\u2003", "𝔘𝟙"]
    texts = ["".join(rng.choices(rng.choice(pools) + rng.choice(pools), k=rng.randrange(25))) for _ in range(400)] + ["", None]

    def brute(t):
        if t is None:
            return None
        t = unicodedata.normalize("NFKC", t).casefold().replace("\r\n", "\n").replace("\r", "\n")
        return "\n".join(re.sub(r"[ \t\f\v]+", " ", line).strip() for line in t.split("\n")).strip()

    got = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", X.normalize(F.col("t")).alias("n")).orderBy("i").collect()
    wrong = [(t, r.n, brute(t)) for t, r in zip(texts, got, strict=True) if r.n != brute(t)]
    assert not wrong, wrong[:3]


def test_fusion_and_ranks(spark):
    rows = [(1, "a", 10, 1), (1, "a", 11, 2), (1, "b", 11, 1), (1, "b", 10, 2)]
    got = S.fuse(spark.createDataFrame(rows, "query int, channel string, record int, rank int"), 5).orderBy("rank").collect()
    assert [r.record for r in got] == [10, 11]
    assert got[0].score == pytest.approx(1 / 61 + 1 / 62)
    with pytest.raises(ValueError):
        S.fuse(spark.createDataFrame(rows, "query int, channel string, record int, rank int"), 5, 0)


def test_manual_queries_are_null(spark):
    results = spark.createDataFrame([(1, 5, 2)], "query int, record int, rank int")
    expected = spark.createDataFrame([(1, 5)], "query int, record int")
    rows = {r["query"]: r for r in S.evaluate(results, expected, spark.createDataFrame([(1,), (2,)], "query int")).collect()}
    assert rows[1].hit_at_1 is False and rows[1].hit_at_3 is True and rows[1].reciprocal_rank == 0.5
    assert rows[2].hit_at_1 is None and rows[2].reciprocal_rank is None


def test_markdown_and_fences():
    text = b"intro\n# A\n```\n# not\n```\n## B\nx\n# C #\n"
    units = list(P.markdown(text, "a.md"))
    assert [u[2] for u in units] == ["line:1-1", "line:2-5", "line:6-7", "line:8-8"]
    assert units[0][3] == {"heading": None, "heading_level": None, "heading_path": [], "start_line": 1, "end_line": 1}
    assert units[2][3] == {"heading": "B", "heading_level": 2, "heading_path": ["A", "B"], "start_line": 6, "end_line": 7}
    assert units[3][3]["heading_path"] == ["C"]
    assert [u[2] for u in P.markdown(b"\n# A", "a.md")] == ["line:2-2"] and list(P.markdown(b"", "a.md")) == []


def test_json_leaves_keep_order_and_escape():
    units = list(P.json_leaves(b'{"b": [], "a/x~": {"k": true}, "n": 1.5}', "a.json"))
    assert [(u[1], u[2]) for u in units] == [("[]", "/b"), ("true", "/a~1x~0/k"), ("1.5", "/n")]


def test_csv_headers_and_widths():
    units = list(P.delimited("\ufeffid,,id\n1,\"a\nb\"\n1,2,3,4\n\n".encode(), "t.csv"))
    assert units[0][3]["headers"] == ["id", "column_2", "id_2"] and units[0][3]["raw_headers"] == ["id", "", "id"]
    assert units[1][3]["values"] == ["1", "a\nb", ""] and units[1][3]["width_mismatch"]
    assert [(u[3]["start_line"], u[3]["end_line"]) for u in units] == [(1, 1), (2, 3), (4, 4), (5, 5)]
    assert units[2][3]["headers"][-1] == "column_4" and units[3][3]["values"] == ["", "", ""]
    assert list(P.delimited(b"", "t.csv")) == []


@pytest.mark.parametrize("raw, width, want", [(["k", "k", "k_2"], 0, ["k", "k_2", "k_2_2"]), (["column_2", ""], 3, ["column_2", "column_2_2", "column_3"]), ([], 2, ["column_1", "column_2"])])
def test_headers_probe_until_a_name_is_free(raw, width, want):
    assert P.headers_of(raw, width) == want


def test_notebook_outputs():
    outputs = [
        {"output_type": "stream", "name": "stdout", "text": "s"},
        {"output_type": "error", "ename": "E", "evalue": "v", "traceback": ["\x1b[38:5:9mred\x1b[0m", "\x1b[<1>A!"]},
        {"output_type": "display_data", "data": {"image/png": "x"}},
        {"output_type": "execute_result", "data": {"application/json": {"b": 1, "a": "é"}}},
    ]
    cells = [{"cell_type": "code", "source": ["a\n", "b"], "execution_count": 3, "outputs": outputs}, {"cell_type": "raw", "source": "r", "outputs": [1]}]
    units = list(P.notebook(json.dumps({"cells": cells}).encode(), "n.ipynb"))
    assert [u[1] for u in units] == ["a\nb", "s", "E: v\nred!", '{"b": 1, "a": "é"}', "r"]
    assert [u[2] for u in units] == ["cell:0", "cell:0/output:0", "cell:0/output:1", "cell:0/output:3", "cell:1"]
    assert units[0][3] == {"cell_index": 0, "cell_type": "code", "execution_count": 3} and units[3][3]["mime_type"] == "application/json"


@pytest.mark.parametrize("book", [[], {}, {"cells": 1}, {"cells": [{"cell_type": "odd", "source": ""}]}, {"cells": [{"cell_type": "raw", "source": [1]}]}, {"cells": [{"cell_type": "code", "source": "", "outputs": {"a": 1}}]}])
def test_broken_notebooks_raise(book):
    with pytest.raises(ValueError):
        list(P.notebook(json.dumps(book).encode(), "n.ipynb"))


def test_extraction_isolates_failures(spark):
    files = spark.createDataFrame([("a.txt", bytearray(b"x\r\ny\n")), ("b.json", bytearray(b"{")), ("c.bin", bytearray(b""))], "relative_path string, content binary")
    rows = {r.path: r for r in P.extract(files).collect()}
    assert rows["a.txt"].text == "x\ny" and rows["b.json"].error.startswith("JSONDecodeError") and rows["c.bin"].error == "unsupported"


def test_discovery(spark, tmp_path):
    for name in ("a.txt", ".git/b.txt", "d/~$c.docx", "d/~$notes.txt", "日本/e f.PDF", "d/__pycache__/x.py"):
        (tmp_path / name).parent.mkdir(exist_ok=True, parents=True)
        (tmp_path / name).write_text("x")
    files = P.listing(spark, str(tmp_path))
    assert sorted((r.relative_path, r.reason, r.suffix, r.mime_type) for r in files.collect()) == [("a.txt", None, ".txt", "text/plain"), ("d/~$c.docx", "office_temporary_file", ".docx", "application/vnd.openxmlformats-officedocument.wordprocessingml.document"), ("d/~$notes.txt", None, ".txt", "text/plain"), ("日本/e f.PDF", None, ".pdf", "application/pdf")]
    assert [tuple(r) for r in P.ignored_by_reason(files).collect()] == [("office_temporary_file", 1)]
    assert P.discover(spark, str(tmp_path)).count() == 3
    with pytest.raises(FileNotFoundError):
        P.discover(spark, str(tmp_path / "absent"))
    with pytest.raises(NotADirectoryError):
        P.discover(spark, str(tmp_path / "a.txt"))


def test_registry_takes_plug_ins(spark):
    def shout(content, path):
        yield "text", content.decode().upper(), None, {}
        yield P.Issue("low_text_content", "short")

    known = P.registry(("shout", (".LOUD",), shout))
    files = spark.createDataFrame([("a.loud", bytearray(b"hey"))], "relative_path string, content binary")
    assert [(r.unit_index, r.text, r.issue) for r in P.extract(files, known).collect()] == [(0, "HEY", None), (None, "short", "low_text_content")]
    with pytest.raises(ValueError):
        P.registry(("other", (".md",), shout))
    with pytest.raises(ValueError):
        P.registry(("markdown", (".new",), shout))


def test_diagnosis(spark):
    pdf = spark.createDataFrame([(0, True), (9, False)], "size int, header boolean")
    yes = F.lit(True)
    got = pdf.select(C.pdf_diagnosis(F.col("size"), F.col("header"), yes, yes, F.lit(False), yes, F.lit("none"), F.lit(3)).alias("d")).collect()
    assert [r.d for r in got] == ["empty_file", "not_pdf"]


def test_entry_without_the_optional_parts(tmp_path):
    """A copy without the optional folders, but with an empty one left behind, still has the library's queries."""
    import os
    import shutil
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    shutil.copytree(os.path.join(root, "corpuslens"), tmp_path / "corpuslens", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(os.path.join(root, "__spark_entry__.py"), tmp_path)
    (tmp_path / "corpuslens" / "llm" / "__pycache__").mkdir(parents=True)
    script = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 50 and set(e.oracle_sql()) <= set(q) and not any(n.startswith('op') and n[2].isdigit() for n in q), sorted(q)"
    subprocess.run([sys.executable, "-c", script], cwd=tmp_path, check=True, env={**os.environ, "PYTHONPATH": str(tmp_path)})


def test_summaries_of_empty_and_odd_input(spark):
    from corpuslens.operators import summaries

    units = spark.createDataFrame([("image_ocr_text", 0.5, 3), ("pdf_page_ocr", 1.0, 1), ("pdf_page_ocr", None, 9), ("image_ocr_text", 0.9, 0), ("plain_text", 0.1, 50)], "unit_type string, confidence double, regions int")
    assert tuple(summaries.ocr_confidence(units).first()) == (0.625, 4)
    assert tuple(summaries.ocr_confidence(units.limit(0)).first()) == (0.0, 0)
    rows = [("a", 0, '{"n": true}'), ("a", 1, '{"n": 4}'), ("a", 2, '{"n": 5}'), ("b", 0, '{"n": "7"}'), ("c", 0, "broken"), ("c", 1, None), ("d", 0, '{"n": 1.5}')]
    frame = spark.createDataFrame(rows, "path string, unit_index int, metadata string")
    issues = spark.createDataFrame([("a", 0, '{"n": 9}'), ("b", 3, '{"n": 8}')], "path string, issue_index int, metadata string")
    assert sorted(map(tuple, summaries.first_number(frame, issues, "n").collect())) == [("a", 4), ("b", 8)]
    files = spark.createDataFrame([("x.TXT", "plain_text", None), ("y", None, True)], "path string, parser string, failed boolean")
    none = spark.createDataFrame([], "text string, issue_type string")
    got = {(r.measure, r.key): r.n for r in summaries.extraction_summary(files, none, none).collect()}
    assert got == {("discovered_files", ""): 2, ("supported_files", ""): 1, ("succeeded_files", ""): 1, ("failed_files", ""): 0, ("unsupported_files", ""): 1, ("total_units", ""): 0, ("total_characters", ""): 0, ("total_issues", ""): 0, ("by_parser", "plain_text"): 1, ("by_suffix", ".txt"): 1, ("by_suffix", ""): 1}
