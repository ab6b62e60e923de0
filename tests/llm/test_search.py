"""Top-k and nearest neighbours against all pairs."""

from __future__ import annotations

import math
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickspark.llm import ann, queries, topk

SCHEMA = "vec_id long, embedding array<float>, label int, rank string, part string"


def vectors(spark, sf_dir):
    rows = queries.table(spark, sf_dir, "embeddings").orderBy("vec_id").collect()
    return np.array([r["vec_id"] for r in rows]), np.array([r["embedding"] for r in rows], np.float32).astype(float)


def test_top_k_query(spark, sf_dir):
    ids, x = vectors(spark, sf_dir)
    v = np.floor(256 * x).astype(np.int64)
    got = {}
    for r in queries.op2_topk(spark, sf_dir).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    want = {}
    for k in np.flatnonzero(ids % 50 == 0):
        s = v @ v[k]
        order = [o for o in np.lexsort((ids, -s)) if o != k][:5]
        want[ids[k]] = [(n + 1, ids[o], s[o]) for n, o in enumerate(order)]
    assert got == want


def test_elimination_skips_and_is_exact():
    rng = np.random.default_rng(0)
    x = np.concatenate([rng.normal(c, 3, (400, 8)) for c in (-200, 0, 200)]).round().astype(np.int64)
    p = topk.choose_pivots(x.astype(float), 16)
    d, norms, ids = topk.distances(x.astype(float), p), (x.astype(float) ** 2).sum(1), np.arange(len(x))
    looked = []
    for k in range(0, len(x), 60):
        found, scores, n = topk.best(x[k], d[k], k, x, d, norms, ids, 5)
        s = x @ x[k]
        order = [o for o in np.lexsort((ids, -s)) if o != k][:5]
        assert found.tolist() == order and scores.tolist() == s[order].tolist()
        looked.append(n)
    assert min(looked) < len(x) / 2


def test_known_scores_leave_out_only_worse_ones():
    rng = np.random.default_rng(4)
    x = rng.integers(-50, 50, (3000, 6))
    p = topk.choose_pivots(x.astype(float), 12)
    d, norms, ids = topk.distances(x.astype(float), p), (x.astype(float) ** 2).sum(1), np.arange(len(x))
    for k in range(0, len(x), 200):
        s = np.delete(x @ x[k], k)
        least = int(np.sort(s)[-9])
        a, b, n = topk.best(x[k], d[k], k, x, d, norms, ids, 5)
        c, e, m = topk.best(x[k], d[k], k, x, d, norms, ids, 5, least)
        assert a.tolist() == c.tolist() and b.tolist() == e.tolist() and m <= n
        assert topk.best(x[k], d[k], k, x, d, norms, ids, 5, int(s.max()) + 1)[0].size == 0


def odd_vectors(spark):
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, None), (4, [math.nan, 1.0]), (5, [math.inf, 0.0]), (6, [None, 1.0]), (7, []), (8, [0.0, 0.0]), (9, [-1.0, 2.0]), (9, [5.0, 5.0]), (None, [1.0, 1.0]), (10, [1.0, 2.0, 3.0])]
    return spark.createDataFrame([(i, v, None, "r", "p") for i, v in rows], SCHEMA)


@pytest.mark.parametrize("operator", [topk.top_k, ann.nearest])
def test_odd_rows(spark, operator):
    out = operator(odd_vectors(spark), F.col("vec_id") == 0).orderBy("rank").collect()
    ids = [r["vec_id"] for r in out]
    assert ids[:2] == [1, 2] and 9 in ids and not {3, 4, 5, 6, 7, 0, 10} & set(ids) and (8 in ids) == (operator is topk.top_k)
    assert operator(odd_vectors(spark).limit(0), F.col("vec_id") == 0).count() == 0
    assert operator(odd_vectors(spark), F.col("vec_id") == 99).count() == 0


def test_many_copies(spark):
    df = spark.range(9000).select(F.col("id").alias("vec_id"), F.array(F.lit(0.5), F.lit(0.25)).alias("embedding"))
    assert [r["vec_id"] for r in topk.top_k(df, F.col("vec_id") == 0).orderBy("rank").collect()] == [1, 2, 3, 4, 5]
    assert [r["vec_id"] for r in ann.nearest(df, F.col("vec_id") == 0, k=3).orderBy("rank").collect()] == [1, 2, 3]


def test_recall(spark):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(30, 16))
    x = (centres[rng.integers(0, 30, 6000)] + 0.4 * rng.normal(size=(6000, 16))).astype(np.float32)
    df = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<float>")
    out = ann.nearest(df, F.col("vec_id") % 100 == 0).collect()
    got = {}
    for r in out:
        got.setdefault(r["query_id"], {})[r["vec_id"]] = r["score"]
    y, hit = x.astype(float), 0
    for k, found in got.items():
        d = np.sqrt(((y - y[k]) ** 2).sum(1))
        d[k] = np.inf
        near = np.lexsort((np.arange(len(y)), d))[:10]
        hit += len(set(near) & set(found))
        assert len(found) == 10 and all(v == pytest.approx(d[i], abs=1e-12) for i, v in found.items())
    assert hit / (10 * len(got)) >= 0.9


def test_recall_on_embeddings(spark, sf_dir):
    ids, x = vectors(spark, sf_dir)
    got = {}
    for r in queries.op6_ann(spark, sf_dir).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    hit = 0
    for k in np.flatnonzero(ids % 100 == 0):
        d = ((x - x[k]) ** 2).sum(1)
        d[k] = np.inf
        hit += len(set(ids[np.argsort(d)[:10]]) & got[ids[k]])
    assert hit / (10 * len(got)) >= 0.9


def test_parts_grow_with_the_rows():
    assert [ann.parts_for(n) for n in (0, 50, 100, 500, 2000, 50_000, 250_000, 10**7, 10**12)] == [1, 1, 2, 4, 8, 64, 128, 1024, 1024]


LARGER = "/root/testdata/sf0.1"


def test_recall_through_the_router(spark):
    if not os.path.isdir(LARGER):
        pytest.skip("larger tables are absent")
    ids, x = vectors(spark, LARGER)
    assert ann.parts_for(len(ids)) >= 8
    got = {}
    for r in queries.op6_ann(spark, LARGER).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    hit = 0
    for k in np.flatnonzero(ids % 100 == 0):
        d = ((x - x[k]) ** 2).sum(1)
        d[k] = np.inf
        hit += len(set(ids[np.lexsort((ids, d))[:10]]) & got[ids[k]])
    assert len(got) == sum(ids % 100 == 0) and hit / (10 * len(got)) >= 0.9


def test_queries_find_k_rows_in_uneven_parts(spark):
    rng = np.random.default_rng(3)
    x = np.concatenate([np.tile(rng.normal(size=4), (3000, 1)), rng.normal(size=(20, 4)) * 100]).astype(np.float32)
    df = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<float>")
    n = {r["query_id"]: r["count"] for r in ann.nearest(df, F.col("vec_id") >= 2995, k=15).groupBy("query_id").count().collect()}
    assert n == {k: 15 for k in range(2995, 3020)}


def test_parts_are_balanced():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(1000, 8))
    part = ann.bisect_graph(ann.near_graph(x, 8), 8)
    assert set(np.bincount(part)) == {125}


def test_scores_that_do_not_fit_are_an_error(spark):
    rows = lambda big: [(k, [big, 1.0], 1, "x", "y") for k in (0, 50, 3)]
    assert topk.top_k(spark.createDataFrame(rows(2.0**21), SCHEMA), F.col("vec_id") % 50 == 0).count() == 4
    with pytest.raises(Exception, match="too large"):
        topk.top_k(spark.createDataFrame(rows(2.0**30), SCHEMA), F.col("vec_id") % 50 == 0).collect()
