"""Exact top-k search by inner product, with pivot-table elimination.

The distances of every vector to many pivots are computed once. For a query q and a
candidate x, the largest of |d(q, p) - d(x, p)| over the pivots is a lower bound of
d(q, x), and with the lengths of both it gives an upper bound of their inner product.
Candidates are evaluated from the highest bound downwards, until the k-th best score
found exceeds all bounds left. Scores are integers, so results are exact.

The rows from which the pivots are chosen are candidates as well, so each query is first
scored against them: its k-th best score there holds in every block of candidates.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import blocked, matrix, tune, valid_vectors, write_shared

#: Pivots, the rows (least by hash of the id) they are chosen from, and candidates evaluated at once.
PIVOTS, PIVOT_ROWS, STEP = 48, 2000, 128


def choose_pivots(rows: np.ndarray, n: int = PIVOTS) -> np.ndarray:
    """Rows far from each other: each next one is farthest from those chosen."""
    chosen, far = [0], ((rows - rows[0]) ** 2).sum(1)
    while len(chosen) < min(n, len(rows)) and far.max() > 0:
        chosen.append(int(far.argmax()))
        far = np.minimum(far, ((rows - rows[chosen[-1]]) ** 2).sum(1))
    return rows[chosen]


def distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum((x**2).sum(1)[:, None] + (pivots**2).sum(1)[None, :] - 2 * x @ pivots.T, 0))


def best(q: np.ndarray, dq: np.ndarray, own: int, x: np.ndarray, dx: np.ndarray, norms: np.ndarray, ids: np.ndarray, k: int, least: int | None = None) -> tuple[np.ndarray, np.ndarray, int]:
    """Ids and scores of the k best candidates for one query, and how many were evaluated.

    Scores below ``least`` are left out: k others are known to reach it.
    """
    gap = np.zeros(len(x))
    for p in range(len(dq)):
        np.maximum(gap, np.abs(dx[:, p] - dq[p]), out=gap)
    total = float(q.astype(float) @ q) + norms
    bound = (total - gap**2) / 2 + 1e-6 * (1 + np.abs(total))  # room for rounding of the distances
    bound[ids == own] = -np.inf
    order = np.argsort(-bound, kind="stable")
    order = order[: int((ids != own).sum())]
    found, scores, at = np.zeros(0, np.int64), np.zeros(0, np.int64), 0
    floor = -np.inf if least is None else least
    while at < len(order) and bound[order[at]] >= (scores[-1] if len(found) == k else floor):
        some = order[at : at + STEP]
        at += len(some)
        new = x[some] @ q
        some, new = some[new >= floor], new[new >= floor]
        found, scores = np.concatenate([found, ids[some]]), np.concatenate([scores, new])
        top = np.lexsort((found, -scores))[:k]
        found, scores = found[top], scores[top]
    return found, scores, at


def _step(x: Column, scale: int) -> Column:
    """floor(scale * x); an error where a sum of products of such steps could leave 64 bits."""
    y = F.floor(x * scale)
    return F.when(F.abs(x * scale) < F.sqrt(F.lit(2.0**62) / F.size("v")), y).otherwise(F.raise_error(F.lit("a component is too large for scores of 64 bits")).cast("bigint"))


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, scale: int = 256, key: str = "vec_id", vector: str = "embedding", pivots: int = PIVOTS) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k highest integer inner products.

    Components become floor(scale * x). Queries are the rows where ``is_query`` (over
    ``vec_id``) holds, candidates all rows with another id; ties go to the smaller id.
    Fewer candidates than k give fewer rows. Vectors that are null, empty or hold a null
    or non-finite component take no part, nor do vectors of another length than the
    query's. Vectors whose scores might not fit 64 bits are an error. An id that comes more than once keeps its smallest vector. Other columns are
    left out. An empty table gives an empty one.
    """
    tune(vectors.sparkSession)
    rows = valid_vectors(vectors, key, vector).select("vec_id", F.transform("v", lambda x: _step(x, scale)).alias("v"), F.size("v").alias("part"))
    few = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(PIVOT_ROWS).collect()
    by_size: dict[int, list] = {}
    for r in few:
        by_size.setdefault(r["part"], []).append((r["vec_id"], r["v"]))
    known = {n: (np.array([i for i, _ in v], np.int64), np.array([x for _, x in v], np.int64)) for n, v in by_size.items()}
    chosen = {n: choose_pivots(x.astype(float), pivots) for n, (_, x) in known.items()}
    lengths = rows.agg(F.countDistinct("part").alias("n")).first()["n"]

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, out = batch.column(2).to_numpy(), [np.zeros(0)] * batch.num_rows
            for n in np.unique(sizes):
                some = np.flatnonzero(sizes == n)
                if n in chosen:
                    rows_ = matrix(pa.Table.from_batches([batch.take(pa.array(some))]), "v", np.float64)
                    for i, d in zip(some.tolist(), distances(rows_, chosen[n])):
                        out[i] = d
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.list_(pa.float64()))], names=["vec_id", "v", "part", "d"])

    def with_least(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each query's k-th best score among the rows that the driver knows; null where those are fewer."""
        for batch in batches:
            least: list[int | None] = [None] * batch.num_rows
            sizes, own = batch.column(2).to_numpy(), batch.column(0).to_numpy()
            for n in np.unique(sizes):
                some = np.flatnonzero(sizes == n)
                if n in known and len(known[n][0]) > k:
                    ids, x = known[n]
                    scores = matrix(pa.Table.from_batches([batch.take(pa.array(some))]), "v", np.int64) @ x.T
                    for i, s in zip(some.tolist(), scores):
                        least[i] = int(np.sort(s[ids != own[i]])[-k])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(least, pa.int64())], names=["vec_id", "v", "part", "d", "least"])

    def search(candidates: pa.Table, queries: pa.Table) -> pa.Table:
        out: list[list[np.ndarray]] = [[np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]]
        if candidates.num_rows and queries.num_rows:
            x, dx, ids = matrix(candidates, "v", np.int64), matrix(candidates, "d"), candidates.column("vec_id").to_numpy()
            norms = (x.astype(float) ** 2).sum(1)
            for q, dq, own, least in zip(matrix(queries, "v", np.int64), matrix(queries, "d"), queries.column("vec_id").to_pylist(), queries.column("least").to_pylist()):
                found, scores, _ = best(q, dq, own, x, dx, norms, ids, k, least)
                for o, c in zip(out, (np.full(len(found), own), found, scores)):
                    o.append(c)
        return pa.table([np.concatenate(o) for o in out], names=["query_id", "vec_id", "score"])

    schema = "vec_id long, v array<long>, part int, d array<double>"
    table = write_shared(rows.mapInArrow(measured, schema), "distances")
    found = blocked(table, table.filter(is_query).mapInArrow(with_least, schema + ", least long"), lengths).applyInArrow(search, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
