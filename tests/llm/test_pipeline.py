"""The stages of the pipeline on odd rows, and their run against the operators' brute force."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from test_dedup import brute_components, brute_pairs

from tickspark.llm import common, pipeline, queries
from tickspark.sources.files import names_in

LINE = "a line with more than twenty letters"
WORDS = " ".join(f"word{k}" for k in range(40))


def stages():
    return dict(pipeline.STAGES)


def rows_of(spark, sf_dir, rows):
    """Rows (doc_id, text) with the columns of documents; the others are null."""
    schema = queries.table(spark, sf_dir, "documents").schema
    return spark.createDataFrame([tuple({"doc_id": d, "text": t}.get(c) for c in schema.names) for d, t in rows], schema)


def test_lines_of_odd_rows(spark, sf_dir):
    rows = [(1, LINE), (2, LINE + "\nown"), (None, LINE), (None, None), (3, LINE), (3, "zz " + LINE), (4, "same"), (4, "same"), (5, None), (6, "")]
    docs = rows_of(spark, sf_dir, rows)
    out = stages()["line dedup"](spark, docs, sf_dir)
    assert out.columns == docs.columns
    got = sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=repr)
    # the smaller text of 3 is emptied, the other one stays as it is
    assert got == sorted([(1, LINE), (2, "own"), (None, LINE), (None, None), (3, "zz " + LINE), (4, "same"), (5, ""), (6, "")], key=repr)


def test_groups_of_odd_rows(spark, sf_dir):
    rows = [(1, WORDS), (2, WORDS.upper()), (None, WORDS), (3, WORDS), (3, "zz"), (3, "zz"), (4, None), (5, "")]
    out = stages()["n-gram Jaccard join"](spark, rows_of(spark, sf_dir, rows), sf_dir).collect()
    # the smaller text of 3 is judged and goes as a copy of 1, the other one stays as it is
    assert sorted(((r["doc_id"], r["text"]) for r in out), key=repr) == sorted([(1, WORDS), (None, WORDS), (3, "zz"), (4, None), (5, "")], key=repr)


@pytest.mark.parametrize("name", [n for n, _ in pipeline.STAGES])
def test_empty_and_odd_tables(spark, sf_dir, name):
    docs = rows_of(spark, sf_dir, [(1, "x"), (None, None), (1, None), (2, "")])
    for some in (docs.limit(0), docs):
        out = stages()[name](spark, some, sf_dir)
        assert (name == "packing" or out.columns == docs.columns) and out.count() <= 8


@pytest.mark.parametrize("name", [n for n, _ in pipeline.STAGES])
def test_further_columns_of_any_name(spark, sf_dir, name):
    docs = rows_of(spark, sf_dir, [(1, WORDS), (2, LINE), (2, "zz"), (None, LINE)])
    more = docs.withColumns({c: F.lit(c) for c in ("_score", "_judged", "_kept", "_first", "_words", "_emptied", "_spans", "_least", "spans", "kept", "n", "h", "home", "rank", "block")})
    plain, out = (stages()[name](spark, d, sf_dir) for d in (docs, more))
    if name != "packing":
        assert out.columns == more.columns and all(r[c] == c for r in out.collect() for c in more.columns[len(docs.columns) :])
        plain, out = plain.select(docs.columns), out.select(docs.columns)
    assert sorted(map(str, out.collect())) == sorted(map(str, plain.collect()))


def test_stages_against_brute_force(spark, sf_dir):
    docs = queries.table(spark, sf_dir, "documents")
    texts = {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}
    cut = pipeline.write_shared(stages()["line dedup"](spark, docs, sf_dir), "test")
    want = {d: t for d, t in brute_pairs(texts).items() if t == (texts[d] or "") or t.strip()}
    assert {r["doc_id"]: r["text"] for r in cut.collect()} == want
    one = stages()["n-gram Jaccard join"](spark, cut, sf_dir)
    component = brute_components(want)
    assert {r["doc_id"] for r in one.collect()} == {d for d, (_, first) in component.items() if d == first}


def test_a_stage_that_leaves_nothing_is_reported(spark, sf_dir):
    half, none = (lambda s, docs, d: docs.filter("doc_id % 2 = 0")), (lambda s, docs, d: docs.filter(F.lit(False)))
    with pytest.warns(UserWarning, match="nothing stays"):
        out, report = pipeline.run_reported(spark, sf_dir, [("half", half), ("nothing stays", none), ("after", half)])
    n = queries.table(spark, sf_dir, "documents").count()
    assert out.isEmpty() and [(r.stage, r.got, r.emptied) for r in report] == [("half", n, False), ("nothing stays", report[0].left, True), ("after", 0, False)]
    assert 0 < report[0].left < n


def test_tables_of_a_stage_go_when_it_is_written(spark, sf_dir, monkeypatch):
    made = []
    real = common.shared_dir
    monkeypatch.setattr(common, "shared_dir", lambda s: made.append(f"{real(s)}/here") or made[-1])
    inner = lambda s, docs, d: pipeline.write_shared(docs, "inner").filter("doc_id < 10")
    out = pipeline.run(spark, sf_dir, [("one", inner), ("two", inner)])
    kept = sorted(n.split("-")[0] + n.split("-")[1][:3] for n in names_in(spark, made[0]))
    assert kept == ["stageone", "stagetwo"] and out.count() > 0
    pipeline.write_shared(out, "outside")
    assert len(names_in(spark, made[0])) == 3
