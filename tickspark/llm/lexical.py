"""Ranked lexical search: short lists term at a time, long lists document at a time.

Queries come in blocks of bounded text. For a block, tasks write an index of the documents
by the block's terms; how many documents there are, their length and the documents of
each term are aggregates over it. Then each task searches its own documents, some
hundred thousand postings together, and its best ones meet in a last ranking.

Within such a shard a query's lists are of two kinds. The short ones are summed whole into
accumulators, term at a time. The accumulators then are one more list, bounded by
their largest sum, next to the long lists, which are gone through document at a time:
a block of neighbouring documents after the other, each list with its largest score in
the block. Lists whose bounds together can't reach the k-th score known so far give no
candidates, and a block where all together can't is skipped. Candidates of the others
are completed from the rest, the largest bounds first, and dropped as soon as they
can't reach the k-th score any more. What could tie is kept, so ranks are exact.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import lean, one_row_per_id, runs, slices, tune, utf8, write_shared

#: What a term is, in the bytes of a text whose ASCII letters are small.
TERM = re.compile(rb"[0-9a-z\x80-\xff]+")
#: Bytes of query texts in a block, postings that a task searches together, and neighbouring documents in a block of them.
QUERY_BYTES, SHARD_POSTINGS, NEAR = 8_000_000, 2_000_000, 4096
#: A list of at most one document in so many is short.
SHORT = 64
#: Parts in which an item's best documents are ranked before they are ranked together.
SPREAD = 64


def terms_of(raw: bytes) -> list[bytes]:
    return TERM.findall(raw.lower())


def _query_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        raw, ends = utf8(batch.column(1))
        raw = raw.tobytes()
        lists = [sorted(set(terms_of(raw[a:b]))) for a, b in zip(ends, ends[1:])]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lists, pa.list_(pa.binary()))], names=["item_id", "terms"])


def _index(known: dict[bytes, int]):
    """(doc_id, n, terms, tfs): the length of each document with terms, and its known terms with their counts, as packed integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(x, y - x) for b in batches for x, y in slices(b.column(1))):
            raw, ends = utf8(batch.column(1))
            raw = raw.tobytes().lower()
            found = [TERM.findall(raw, a, b) for a, b in zip(ends.tolist(), ends[1:].tolist())]
            n = np.array([*map(len, found)], np.int64)
            terms = np.fromiter((known.get(t, -1) for f in found for t in f), np.int64, int(n.sum()))
            row = np.repeat(np.arange(len(n)), n)[terms >= 0]
            pairs, tf = np.unique(row << 32 | terms[terms >= 0], return_counts=True)
            cuts = np.searchsorted(pairs >> 32, np.arange(len(n) + 1))
            ids, tf = (pairs & 0xFFFFFFFF).astype(np.int32), tf.astype(np.int32)
            packed = [[x[a:b].tobytes() for a, b in zip(cuts, cuts[1:])] for x in (ids, tf)]
            out = pa.RecordBatch.from_arrays([batch.column(0), pa.array(n), *(pa.array(p, pa.binary()) for p in packed)], names=["doc_id", "n", "terms", "tfs"])
            yield out.filter(pa.array(n > 0))

    return run


def unpacked(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Packed integers of all rows, and how many each row has."""
    raw, ends = utf8(column)
    return raw.view(np.int32), np.diff(ends) // 4


def _documents_of(n_terms: int):
    """How many documents of a task have each term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(n_terms, np.int64)
        for batch in batches:
            df += np.bincount(unpacked(batch.column(0))[0], minlength=n_terms)
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(df[some])], names=["term", "df"])

    return run


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


class Shard:
    """Some documents by their terms: each list's documents in order of their ids, and what each adds to a score."""

    def __init__(self, ids: np.ndarray, n: np.ndarray, sizes: np.ndarray, terms: np.ndarray, tf: np.ndarray, weights: np.ndarray, n_docs: int, length: int, near: int = NEAR):
        order = np.argsort(ids, kind="stable")
        place = np.empty(len(ids), np.int64)
        place[order] = np.arange(len(ids))
        self.ids, self.near = ids[order], near
        m = 50 + (50 * n * n_docs) // length
        row = np.repeat(np.arange(len(ids)), sizes)
        tf = tf.astype(np.int64)
        adds = weights[terms] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m[row]))
        by = np.lexsort((place[row], terms))
        terms, self.docs, self.adds = terms[by], place[row][by], adds[by]
        first = runs(terms)
        self.of = {int(t): (int(a), int(b)) for t, a, b in zip(terms[first], first, np.r_[first[1:], len(terms)])}
        self.blocks = -(-len(ids) // near)
        self.cut: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def cuts(self, docs: np.ndarray, adds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where each block of documents starts in a list, and the most that the list adds there."""
        at = np.searchsorted(docs, np.arange(self.blocks + 1) * self.near)
        most = np.zeros(self.blocks, np.int64)
        full = np.flatnonzero(at[1:] > at[:-1])
        if len(full):
            most[full] = np.maximum.reduceat(adds, at[full])
        return at, most

    def lists(self, query: list[int], short: int = SHORT) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """The long lists of a query, and one of the sums of its short lists: documents, what they add, and both of ``cuts``."""
        sums, out = [], []
        for t in query:
            if (span := self.of.get(t)) is None:
                continue
            docs, adds = self.docs[slice(*span)], self.adds[slice(*span)]
            if len(docs) * short <= len(self.ids):
                sums.append((docs, adds))
            else:
                if t not in self.cut:
                    self.cut[t] = self.cuts(docs, adds)
                out.append((docs, adds, *self.cut[t]))
        if sums:
            docs, adds = (np.concatenate(x) for x in zip(*sums))
            by = np.argsort(docs, kind="stable")
            first = runs(docs[by])
            docs, adds = docs[by][first], np.add.reduceat(adds[by], first)
            out.append((docs, adds, *self.cuts(docs, adds)))
        return out

    def search(self, query: list[int], k: int, best: tuple[np.ndarray, np.ndarray], looked: list[int] | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The k best (ids, scores) among those known before and those of the shard."""
        ids, scores = best
        lists = self.lists(query)
        if not lists:
            return best
        bounds = np.array([most for *_, most in lists])
        total = bounds.sum(0)
        for b in range(self.blocks):
            floor = int(scores[-1]) if len(ids) == k else 1
            if total[b] < floor:
                continue
            order = np.argsort(bounds[:, b], kind="stable")
            upto = np.cumsum(bounds[order, b])
            rest = int(np.searchsorted(upto, floor))  # these lists by themselves can't reach the floor
            base, sum_ = b * self.near, np.zeros(self.near, np.int64)
            for docs, adds, at, _ in (lists[i] for i in order[rest:]):
                sum_[docs[at[b] : at[b + 1]] - base] += adds[at[b] : at[b + 1]]
            found = np.flatnonzero(sum_)
            for r in range(rest - 1, -1, -1):
                found = found[sum_[found] + upto[r] >= floor]
                if not len(found):
                    break
                docs, adds, at, _ = lists[order[r]]
                docs, adds = docs[at[b] : at[b + 1]] - base, adds[at[b] : at[b + 1]]
                if 8 * len(found) < len(docs):  # skip to the candidates
                    to = np.minimum(np.searchsorted(docs, found), len(docs) - 1)
                    sum_[found] += np.where(docs[to] == found, adds[to], 0)
                else:
                    sum_[docs] += adds
            found = found[sum_[found] >= floor]
            if looked is not None:
                looked.append(len(found))
            if len(found):
                ids, scores = np.r_[ids, self.ids[base + found]], np.r_[scores, sum_[found]]
                top = np.lexsort((ids, -scores))[:k]
                ids, scores = ids[top], scores[top]
        return ids, scores


def _search(queries: list[tuple[int, list[int]]], weights: np.ndarray, n_docs: int, length: int, k: int):
    """The k best documents of a task for each query."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.zeros(0, np.int64)
        best = [(none, none)] * len(queries)
        parts: list[list[np.ndarray]] = []

        def searched() -> None:
            shard = Shard(*(np.concatenate(x) for x in zip(*parts)), weights, n_docs, length)
            parts.clear()
            for i, (_, terms) in enumerate(queries):
                best[i] = shard.search(terms, k, best[i])

        for batch in batches:
            n = batch.column(1).to_numpy()
            if len(n) and 50 * int(n.max()) * n_docs >= 1 << 63:
                raise OverflowError("a text is too long for scores of 64 bits")
            (terms, sizes), (tf, _) = (unpacked(batch.column(c)) for c in (2, 3))
            parts.append([batch.column(0).to_numpy(), n, sizes, terms.copy(), tf.copy()])
            if sum(len(p[3]) for p in parts) >= SHARD_POSTINGS:
                searched()
        if parts:
            searched()
        items = np.repeat(np.array([i for i, _ in queries], np.int64), [len(ids) for ids, _ in best])
        yield pa.RecordBatch.from_arrays([pa.array(items), *(pa.array(np.concatenate([none, *x])) for x in zip(*best))], names=["item_id", "doc_id", "score"])

    return run


def best_documents(documents: DataFrame, items: DataFrame, k: int = 50, text: str = "text", key: str = "doc_id", item_text: str = "text", item_key: str = "item_id") -> DataFrame:
    """(item_id, rank, doc_id, score): the k documents of the highest score above 0 for each item.

    Equal scores are ranked by id. Null texts count as empty; items and documents without
    a term have no part. Rows without an id are left out, and an id that comes twice
    counts once, with its smallest text. Other columns are left out. Empty tables give an
    empty one.
    """
    tune(documents.sparkSession)
    docs = one_row_per_id(documents, key, text)
    asked = one_row_per_id(items, item_key, item_text)
    asked = asked.mapInArrow(_query_terms, "item_id long, terms array<binary>").filter(F.size("terms") > 0)
    asked = write_shared(asked.withColumn("bytes", F.aggregate("terms", F.lit(0).cast("long"), lambda n, t: n + F.octet_length(t) + 8)), "items")
    blocks = -(-(asked.agg(F.sum("bytes").alias("n")).first()["n"] or 0) // QUERY_BYTES)
    found = None
    for b in range(max(1, blocks)):
        some = [(r["item_id"], [bytes(t) for t in r["terms"]]) for r in asked.filter(F.pmod(F.xxhash64("item_id"), F.lit(max(1, blocks))) == b).collect()]
        if some:
            one = _search_block(docs, some, k)
            found = one if found is None else found.union(one)
    if found is None:
        return docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    best = lambda *keys: F.row_number().over(Window.partitionBy("item_id", *keys).orderBy(F.desc("score"), "doc_id"))
    parted = found.withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(SPREAD)))
    fewer = parted.withColumn("rank", best("part")).filter(F.col("rank") <= k)
    return fewer.withColumn("rank", best()).filter(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


def _search_block(docs: DataFrame, items: list[tuple[int, list[bytes]]], k: int) -> DataFrame:
    """The best documents of every task for some items."""
    known = {t: i for i, t in enumerate(sorted({t for _, terms in items for t in terms}))}
    index = write_shared(docs.mapInArrow(lean(_index(known)), "doc_id long, n long, terms binary, tfs binary"), "index")
    all_ = index.agg(F.count(F.lit(1)).alias("n"), F.sum("n").alias("l")).first()
    weights = np.zeros(len(known), np.int64)
    counted = index.select("terms").mapInArrow(_documents_of(len(known)), "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))
    for r in counted.collect() if all_["n"] else ():
        weights[r["term"]] = weight(all_["n"], r["df"])
    queries = [(i, [known[t] for t in terms]) for i, terms in items]
    return index.mapInArrow(lean(_search(queries, weights, all_["n"], all_["l"] or 1, k)), "item_id long, doc_id long, score long")
