"""The stages of the corpus pipeline, each and together, on a small corpus with every kind of odd row."""

import random

import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")
from corpuslens.llm import vocab  # noqa: E402
from corpuslens.llm.queries import vocabulary  # noqa: E402

STAGES = dict(corpus_pipeline.STAGES)
FIELDS = "doc_id long, text string, lang string, source string, n_chars long, score string, version string, entity_kinds int, `a.b` struct<`x y`:int>"
ITEM = "seven silver swans swam slowly south since september storms started"


def corpus():
    """Rows, and the ids that must go by stage."""
    rng = random.Random(21)
    words = [f"w{i}" for i in range(400)]
    prose = lambda n: " ".join(rng.choices(words, k=n))
    texts = {i: prose(60) for i in range(1, 21)}
    toxic = {i: f"{prose(10)} you zorgling{i % 3} and {prose(5)}" for i in range(30, 50)}
    base = [prose(1) for _ in range(100)]
    copies = {60: " ".join(base), 61: " ".join(base), 62: " ".join([*base[:50], "changed", *base[51:]])}
    tainted = {70: f"{prose(40)} {ITEM.upper()} {prose(3)}"}
    odd = {80: None, 81: "", 82: "  \n", 83: "mail ann.42@corp.example.org or Mr Smith; Smith agreed", 84: "long " * 30_000}
    rows = {**texts, **toxic, **copies, **tainted, **odd}
    listed = [(i, t, "en", "s", len(t) if t is not None else None, "own", "v", 7, (i,)) for i, t in rows.items()]
    listed += [listed[0], (None, "nobody's text", None, None, 13, None, None, None, None)]
    return listed, {"toxicity": set(toxic), "near_dedup": {61, 62}, "decontamination": {70}, "surrogates": set()}


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    at = str(tmp_path_factory.mktemp("sf"))
    rows, _ = corpus()
    spark.createDataFrame(rows, FIELDS).write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame([(i, 1, int(30 <= i < 50)) for i in [*range(1, 21), *range(30, 50)] if i % 7] + [(None, 1, 1), (5, 0, None)], "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    spark.createDataFrame([(1, ITEM), (2, None), (3, "")], "item_id long, text string").write.parquet(f"{at}/benchmark.parquet")
    return at


def test_each_stage_keeps_all_but_what_it_rejects(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    _, gone = corpus()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert out.columns == docs.columns and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema], name
        out.write.parquet(str(tmp_path / name))
        after = spark.read.parquet(str(tmp_path / name))
        before_rows, rows = docs.collect(), after.collect()
        if name != "surrogates":
            assert sorted(map(str, rows)) == sorted(str(r) for r in before_rows if r.doc_id not in gone[name]), name
        docs = after
    by_id = {}
    for r in rows:
        by_id.setdefault(r.doc_id, []).append(r)
    assert len(by_id[1]) == 2 and by_id[1][0] == by_id[1][1] and by_id[80][0].text is None and by_id[80][0].n_chars is None
    made = by_id[83][0]
    assert "ann.42" not in made.text and "Smith" not in made.text and made.n_chars == len(made.text) and made.entity_kinds == 7 and made.score == "own"
    assert by_id[84][0].text == "long " * 30_000


def test_the_whole_run_equals_its_parts(spark, folder):
    """Every id of every remaining document lies in exactly one piece."""
    pieces = corpus_pipeline.run(spark, folder).collect()
    with open(vocabulary("byte_bpe_50k.json"), encoding="utf-8") as f:
        memo = vocab.WordMemo(f.read())
    rows, gone = corpus()
    left = [r for r in rows if r[0] not in set().union(*gone.values())]
    held = {}
    for p in pieces:
        held.setdefault(p.doc_id, []).append((p.start, p.length, p.doc_tokens))
    assert set(held) == {r[0] for r in left}
    for i, text, *_ in left:
        if i == 83:
            continue  # its surrogates have tokens of their own
        n, copies = len(memo.encode([text])[0]) // 4 + 1, sum(r[0] == i for r in left)
        assert {t for _, _, t in held[i]} == {n} and sum(length for _, length, _ in held[i]) == n * copies
    by_sequence = {}
    for p in pieces:
        by_sequence.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for spans in by_sequence.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 2048


@pytest.mark.parametrize("name", list(STAGES))
def test_empty_tables_pass(spark, folder, name):
    empty = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    assert STAGES[name](spark, empty, folder).count() == 0


def test_the_order_of_stages():
    assert list(STAGES) == ["toxicity", "near_dedup", "decontamination", "surrogates", "packing"] and corpus_pipeline.ORACLE_SQL is None
