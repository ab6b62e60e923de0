"""Ranked search against scores of all documents, and against its SQL in test_sql."""

from __future__ import annotations

import math
import re

import numpy as np
import pytest

from tickspark.llm import lexical, queries

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
SMALL = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text: str | None) -> list[str]:
    return TERM.findall((text or "").translate(SMALL))


def brute(docs: dict[int, str | None], items: dict[int, str | None], k: int = 50) -> list[tuple]:
    words = {d: t for d, text in docs.items() if (t := terms(text))}
    n_docs, length, out = len(words), sum(map(len, words.values())), []
    df: dict[str, int] = {}
    for t in words.values():
        for x in set(t):
            df[x] = df.get(x, 0) + 1
    for item, text in items.items():
        scores = []
        for d, t in words.items():
            m, score = 50 + (50 * len(t) * n_docs) // length, 0
            for x in set(terms(text)) & set(t):
                tf = t.count(x)
                score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[x] + 1))) * ((1_000_000_000 * tf) // (1000 * tf + 20 * m))
            if score > 0:
                scores.append((-score, d))
        out += [(item, r, d, -s) for r, (s, d) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out)


def found(spark, docs, items, k=50):
    d = spark.createDataFrame(docs, "doc_id long, text string, n int, terms string, score long").repartition(3)
    q = spark.createDataFrame(items, "item_id long, text string, rank int")
    return sorted(map(tuple, lexical.best_documents(d, q, k).collect()))


def test_query_equals_scores_of_all(spark, sf_dir):
    docs = {r["doc_id"]: r["text"] for r in queries.table(spark, sf_dir, "documents").collect()}
    items = {r["item_id"]: r["text"] for r in queries.table(spark, sf_dir, "benchmark").collect()}
    assert sorted(map(tuple, queries.op11_lexical(spark, sf_dir).collect())) == brute(docs, items)


@pytest.mark.parametrize("near, short, shard", [(4, 64, 10**9), (7, 1, 50), (4096, 10**9, 300), (16, 3, 10**9)])
def test_skipping_is_exact(spark, monkeypatch, near, short, shard):
    monkeypatch.setattr(lexical, "SHARD_POSTINGS", shard)
    monkeypatch.setattr(lexical.Shard.lists, "__defaults__", (short,))
    monkeypatch.setattr(lexical.Shard.__init__, "__defaults__", (near,))
    rng = np.random.default_rng(near)
    word = lambda: f"w{int(rng.zipf(1.3)) % 60}"
    docs = {int(d): " ".join(word() for _ in range(rng.integers(0, 30))) for d in rng.permutation(300)}
    items = {i: " ".join(word() for _ in range(rng.integers(0, 12))) for i in range(25)}
    known = {t.encode(): i for i, t in enumerate(sorted({t for x in items.values() for t in terms(x)}))}
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array(list(docs)), pa.array(list(docs.values()))], names=["doc_id", "text"])
    rows = list(lexical._index(known)(iter([batch])))
    n_docs, length = sum(len(r) for r in rows), sum(sum(r.column(1).to_pylist()) for r in rows)
    weights = np.zeros(len(known), np.int64)
    for r in lexical._documents_of(len(known))(iter([x.select(["terms"]) for x in rows])):
        for t, n in zip(r.column(0).to_pylist(), r.column(1).to_pylist()):
            weights[t] = lexical.weight(n_docs, n)
    asked = [(i, [known[t.encode()] for t in sorted(set(terms(x)))]) for i, x in items.items()]
    parts = [r.slice(a, 40) for r in rows for a in range(0, len(r), 40)]
    got = [(i, d, s) for r in lexical._search(asked, weights, n_docs, length, 5)(iter(parts)) for i, d, s in zip(*(c.to_pylist() for c in r.columns))]
    assert sorted(got) == sorted((i, d, s) for i, _, d, s in brute(docs, items, 5))


def test_blocks_are_skipped():
    rng = np.random.default_rng(0)
    n = 20_000
    common = np.flatnonzero(rng.random(n) < 0.6)
    rare = np.arange(40, 60)
    sizes = np.bincount(common, minlength=n) + np.bincount(rare, minlength=n)
    row, term = np.r_[common, rare], np.r_[np.zeros(len(common), int), np.ones(len(rare), int)]
    by = np.argsort(row, kind="stable")
    shard = lexical.Shard(np.arange(n), np.full(n, 10), sizes, term[by], np.ones(len(row), np.int32), np.array([500, 9000]), n, 10 * n, near=100)
    looked: list[int] = []
    ids, _ = shard.search([0, 1], 10, (np.zeros(0, np.int64), np.zeros(0, np.int64)), looked)
    assert set(ids.tolist()) <= set(range(40, 60)) and len(looked) < 5  # of 200 blocks


def test_nulls_ties_repeats_and_empty_tables(spark):
    docs = [(5, "Alpha beta", 1, "x", 1), (2, "alpha BETA", 1, "x", 1), (2, "zeta", 1, "x", 1), (None, "alpha", 1, "x", 1), (3, None, 1, "x", 1), (4, "", 1, "x", 1), (6, "--- ...", 1, "x", 1), (7, "É é alphA", 1, "x", 1)]
    items = [(1, "alpha é", 1), (1, "alpha é", 1), (2, None, 1), (None, "alpha", 1), (3, "nowhere", 1), (4, "!!", 1)]
    one = {d: t for d, t, *_ in docs if d not in (None, 2)} | {2: "alpha BETA"}
    want = brute(one, {1: "alpha é"})
    assert found(spark, docs, items) == want and [r[2] for r in want][1:] == [2, 5]
    assert found(spark, [], items) == found(spark, docs, []) == found(spark, [(1, None, 1, "", 1)], items) == []


def test_blocks_of_queries(spark, monkeypatch):
    monkeypatch.setattr(lexical, "QUERY_BYTES", 40)
    docs = {d: f"a{d % 3} b{d % 5} common" for d in range(40)}
    items = {i: f"a{i % 3} b{i % 5} common" for i in range(12)}
    assert found(spark, [(d, t, 1, "", 1) for d, t in docs.items()], [(i, t, 1) for i, t in items.items()], 7) == brute(docs, items, 7)
