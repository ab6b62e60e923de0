"""Approximate nearest neighbours over learned partitions.

A bounded sample of the vectors gives a graph of near neighbours. The graph is cut into
equal parts by recursive bisection along its slow eigenvectors, so that few neighbours
are separated. A small network learns, from a vector alone, in which parts the
neighbours of such a vector lie. It puts every row into its most probable part, and
routes a query to the most probable parts, where all rows are ranked by exact distance.
How many parts a query visits is set on the sample for a wanted recall; a query goes on
to further parts until those it visits hold enough rows.

Parts grow with the square root of the rows, so their number and their size do, too. They
are bounded by the sample, which holds ``PART_SAMPLE`` rows a part up to ``SAMPLE_ROWS``:
beyond some ten million rows the parts grow with the table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import blocked, matrix, tune, valid_vectors, write_shared

#: Bound on the rows of the sample (the least by a hash of the id), its rows for each part, neighbours in its graph, most parts.
SAMPLE_ROWS, PART_SAMPLE, GRAPH_K, MAX_PARTS = 32_768, 128, 10, 1024
#: Rows below which there is one part, which is exact.
LEAST_ROWS = 64
#: Recall on the sample that sets the number of parts a query visits.
WANTED = 0.98


def parts_for(rows: int, most: int = MAX_PARTS) -> int:
    """A power of two, about a third of the square root of the rows."""
    parts = 1
    while 2 * parts <= most and rows >= max(LEAST_ROWS, 36 * parts * parts):
        parts *= 2
    return parts


def near_graph(x: np.ndarray, k: int) -> np.ndarray:
    """The k nearest other rows of each row."""
    out, norms = np.zeros((len(x), k), np.int64), (x**2).sum(1)
    for a in range(0, len(x), 512):
        d = norms[None, :] - 2 * x[a : a + 512] @ x.T
        d[np.arange(len(d)), np.arange(a, a + len(d))] = np.inf
        out[a : a + 512] = np.argpartition(d, k, axis=1)[:, :k]
    return out


def bisect_graph(near: np.ndarray, parts: int, rounds: int = 60) -> np.ndarray:
    """A part below ``parts`` (a power of two) for each node, all of equal size but for one.

    Each set of nodes is split at the median of the second eigenvector of its own graph.
    """
    n, k = near.shape
    a, b = np.repeat(np.arange(n), k), near.ravel()
    a, b = np.concatenate([a, b]), np.concatenate([b, a])
    part, count = np.zeros(n, np.int64), 1
    rng = np.random.default_rng(0)
    while count < parts:
        nxt = part * 2
        inner = part[a] == part[b]
        x, y = a[inner], b[inner]
        degree = np.maximum(np.bincount(x, minlength=n), 1).astype(float)
        of = np.bincount(part, minlength=count)
        weight = np.bincount(part, degree, count)
        v = rng.normal(size=n)
        for _ in range(rounds):  # all sets at once: their graphs are not connected
            v -= (np.bincount(part, v * degree, count) / weight)[part]
            v = 0.5 * v + 0.5 * np.bincount(x, v[y], n) / degree
            v /= np.sqrt(np.bincount(part, v * v, count) / np.maximum(of, 1) + 1e-300)[part]
        order = np.lexsort((v, part))
        place = np.arange(n) - np.repeat(np.cumsum(of) - of, of)
        nxt[order] += place >= np.repeat((of + 1) // 2, of)
        part, count = nxt, 2 * count
    return part


@dataclass
class Router:
    """A network of one hidden layer from a vector to the parts, and how many parts to visit."""

    shift: np.ndarray
    scale: float
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: np.ndarray
    visits: int

    @property
    def parts(self) -> int:
        return len(self.b2)

    def scores(self, x: np.ndarray) -> np.ndarray:
        return np.maximum((x - self.shift) * self.scale @ self.w1 + self.b1, 0) @ self.w2 + self.b2


def train(x: np.ndarray, target: np.ndarray, hidden: int = 128, epochs: int = 40, rate: float = 3e-3, seed: int = 0) -> Router:
    """Adam on the cross entropy between the network and the shares of each row's neighbours."""
    rng = np.random.default_rng(seed)
    shift, scale = x.mean(0), float(1 / (x.std() + 1e-12))
    z = (x - shift) * scale
    w = [rng.normal(size=(z.shape[1], hidden)) * np.sqrt(2 / z.shape[1]), np.zeros(hidden), rng.normal(size=(hidden, target.shape[1])) * 0.05, np.zeros(target.shape[1])]
    m, s, t = [np.zeros_like(p) for p in w], [np.zeros_like(p) for p in w], 0
    for epoch in range(epochs):
        order = rng.permutation(len(z))
        for a in range(0, len(z), 256):
            k, t = order[a : a + 256], t + 1
            h = np.maximum(z[k] @ w[0] + w[1], 0)
            o = h @ w[2] + w[3]
            p = np.exp(o - o.max(1, keepdims=True))
            g = (p / p.sum(1, keepdims=True) - target[k]) / len(k)
            gh = (g @ w[2].T) * (h > 0)
            for i, d in enumerate((z[k].T @ gh, gh.sum(0), h.T @ g, g.sum(0))):
                m[i], s[i] = 0.9 * m[i] + 0.1 * d, 0.999 * s[i] + 0.001 * d * d
                w[i] -= rate * (1 - epoch / epochs) * (m[i] / (1 - 0.9**t)) / (np.sqrt(s[i] / (1 - 0.999**t)) + 1e-8)
    return Router(shift, scale, *w, target.shape[1])


def fit(sample: np.ndarray, parts: int, wanted: float = WANTED) -> Router:
    """The router of a sample of vectors; ``parts`` is a power of two."""
    if parts < 2:
        d = sample.shape[1] if sample.ndim == 2 else 1
        return Router(np.zeros(d), 1.0, np.zeros((d, 1)), np.zeros(1), np.zeros((1, 1)), np.zeros(1), 1)
    near = near_graph(sample, min(GRAPH_K, len(sample) - 1))
    part = bisect_graph(near, parts)
    held = np.arange(len(sample)) % 5 == 0
    target = np.zeros((len(sample), parts))
    for c in range(near.shape[1]):
        np.add.at(target, (np.arange(len(sample)), part[near[:, c]]), 1)
    np.add.at(target, (np.arange(len(sample)), part), 1)
    router = train(sample[~held], (target / target.sum(1, keepdims=True))[~held])
    scores = router.scores(sample)
    put = scores.argmax(1)
    rank = np.empty_like(scores, dtype=np.int64)
    np.put_along_axis(rank, np.argsort(-scores, axis=1), np.arange(parts)[None, :], axis=1)
    need = np.sort(np.take_along_axis(rank[held], put[near[held]], axis=1).ravel())  # visits that find a neighbour
    router.visits = int(need[min(len(need) - 1, int(np.ceil(wanted * len(need))))]) + 1
    return router


def nearest(vectors: DataFrame, is_query: Column, k: int = 10, key: str = "vec_id", vector: str = "embedding", sample_rows: int = SAMPLE_ROWS, max_parts: int = MAX_PARTS, wanted: float = WANTED) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest rows found for each query, by Euclidean distance.

    The index is fitted on at most ``sample_rows`` rows and holds every row. Queries are the
    rows where ``is_query`` (over ``vec_id``) holds; their own id is no candidate. Ties go
    to the smaller id. Vectors that are null, empty, all zero or hold a null or non-finite
    component take no part, nor do vectors of another than the commonest length. An id
    that comes more than once keeps its smallest vector. Other columns are left out. An
    empty table gives an empty one.
    """
    tune(vectors.sparkSession)
    rows = valid_vectors(vectors, key, vector, zero=False)
    usual = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    n = usual["n"] if usual else 0
    rows = rows.filter(F.size("v") == n)
    parts = parts_for(usual["count"], max_parts) if usual else 1
    most = min(sample_rows, max(1024, PART_SAMPLE * parts))
    sample = np.array([r["v"] for r in rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(most).select("v").collect()], float)
    while parts > 1 and len(sample) < 16 * parts:
        parts //= 2
    router = fit(sample, parts, wanted)

    def place(visits: int, held: np.ndarray | None = None):
        """Each row in its most probable parts: as many as ``visits``, and on until those hold k other rows (``held``: rows of each part)."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x = matrix(pa.Table.from_batches([batch]), "v") if batch.num_rows else np.zeros((0, len(router.shift)))
                top = np.argsort(-router.scores(x), axis=1, kind="stable")
                before = np.zeros(top.shape, np.int64)
                if held is not None:  # rows in the parts before
                    before[:, 1:] = np.cumsum(held[top], axis=1)[:, :-1]
                go = (np.arange(top.shape[1]) < visits) | (before < k + 1) & (held is not None)
                row = pa.array(np.repeat(np.arange(len(x)), go.sum(1)))
                yield pa.RecordBatch.from_arrays([batch.column(0).take(row), batch.column(1).take(row), pa.array(top[go].astype(np.int32))], names=["vec_id", "v", "part"])

        return run

    def search(candidates: pa.Table, queries: pa.Table) -> pa.Table:
        out: list[list[np.ndarray]] = [[np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)]]
        if candidates.num_rows and queries.num_rows:
            x, ids = matrix(candidates, "v"), candidates.column("vec_id").to_numpy()
            norms = (x**2).sum(1)
            for q, own in zip(matrix(queries, "v"), queries.column("vec_id").to_pylist()):
                square = float(q @ q)
                d = norms - 2 * (x @ q) + square
                d[ids == own] = np.inf
                room = 1e-9 * (1 + square + norms.max())  # for rounding: who may be among the k
                some = np.flatnonzero(d <= np.partition(d, min(k, len(d)) - 1)[min(k, len(d)) - 1] + room) if len(d) > k else np.flatnonzero(d < np.inf)
                some = some[ids[some] != own]
                exact = np.sqrt(((x[some] - q) ** 2).sum(1))
                top = some[o := np.lexsort((ids[some], exact))[:k]] if len(some) else some
                for c, v in zip(out, (np.full(len(top), own), ids[top], exact[o] if len(some) else exact)):
                    c.append(v)
        return pa.table([np.concatenate(o) for o in out], names=["query_id", "vec_id", "score"])

    schema = "vec_id long, v array<double>, part int"
    index = write_shared(rows.mapInArrow(place(1), schema), "index")
    held = np.zeros(router.parts, np.int64)
    for r in index.groupBy("part").count().collect():  # at most MAX_PARTS rows
        held[r["part"]] = r["count"]
    asked = rows.filter(is_query).mapInArrow(place(router.visits, held), schema)
    found = blocked(index, asked, parts).applyInArrow(search, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
