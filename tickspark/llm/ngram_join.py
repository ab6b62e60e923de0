"""N-gram Jaccard join: a blocked sparse product of the document by n-gram incidence.

A document is the set of its distinct word n-grams, as 64-bit hashes. Two documents link
when their sets' Jaccard similarity reaches a threshold. The parts of the product that
cannot hold a link are left out by bounds that follow from the sizes alone:

1. Documents with equal sets are one row of the matrix (a class).
2. A link needs an overlap of at least ceil(t * size). So, in the order of the hashes,
   two linked documents share at least k of their first size - ceil(t * size) + k
   n-grams, for every k. Classes that share fewer of them with all others together
   have no link. This column count moves hashes packed in buckets.
3. For the classes left, n-grams are ordered by how many of them hold it, rarest first.
   Linked classes share one of the first size - ceil(t * size) + 1, their columns. Each
   class is first compared with the smallest one that it shares a column with, so a
   group of near copies becomes one component by as many comparisons as it has members.
   Columns of a single component are done.
4. Classes that share other columns, directly or through others, form the blocks of the
   product; no block is linked with another. A block of more than one part may have grown
   along chains of columns whose ends have nothing in common. Where that is less work, it is
   taken apart again: each set of classes that hold the same columns together is a block.
   Parts of a large block hold classes of about one size, and only parts whose sizes allow a
   link meet. Overlap counts accumulate over slices of n-grams, and pairs leave as
   soon as the columns to come can't lift them to the bound. Only a spanning forest of the
   links leaves a task.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BASE, BYTE_VALUES, buckets_for, by_bucket, components, forest, lean, mix, one_row_per_id, pack, runs, slices, text_bytes, tune, unpack, utf8, write_shared

WIDTH, PERCENT = 5, 80
#: Of every 1/SLACK of a document's n-grams, one more is looked at in step 2 and must be shared.
SLACK = 10
#: Classes in a part of a block, n-grams of all of them (8 MB of hashes), and columns in a slice of the product.
PART, PART_GRAMS, SLICE = 256, 1 << 20, 4096

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.isin(np.arange(256), [0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D])
_PLACES = mix(np.arange(101, 165, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)) | np.uint64(1)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**k and its inverse modulo 2**64, for k below n."""
    up, down = np.full(n, BASE, np.uint64), np.full(n, pow(BASE, -1, 1 << 64), np.uint64)
    up[:1], down[:1] = 1, 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


def word_hashes(raw: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word of the lower-cased texts, and the number of words before each text."""
    if not len(raw):
        return np.zeros(0, np.uint64), np.zeros(len(ends), np.int64)
    solid = ~_SPACE[raw]
    edge = np.zeros(len(raw) + 1, bool)
    edge[ends] = True
    start = solid.copy()
    start[1:] &= ~solid[:-1] | edge[1:-1]
    stop = solid.copy()
    stop[:-1] &= ~solid[1:] | edge[1:-1]
    a, b = np.flatnonzero(start), np.flatnonzero(stop) + 1
    up, down = powers(len(raw) + 1)
    total = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(BYTE_VALUES[_LOWER[raw]] * up[:-1], out=total[1:])
    return mix((total[b] - total[a]) * down[a]), np.searchsorted(a, ends)


def shingle_sets(column: pa.Array, width: int = WIDTH) -> list[np.ndarray]:
    """The sorted distinct n-gram hashes of each text; fewer words than ``width`` make one n-gram."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return [s for a, b in slices(column) for s in _sets(column.slice(a, b - a), width)]


def _sets(column: pa.Array, width: int) -> list[np.ndarray]:
    raw, ends = utf8(column)
    words, before = word_hashes(raw, ends)
    n = len(words) - width + 1
    whole = np.zeros(max(n, 0), np.uint64)
    for k in range(width):
        whole += words[k : k + len(whole)] * _PLACES[k]
    whole = mix(whole)
    out = []
    for a, b in zip(before[:-1].tolist(), before[1:].tolist()):
        if b - a >= width:
            out.append(np.unique(whole[a : b - width + 1]))
        elif b > a:
            short = (words[a:b] * _PLACES[: b - a]).sum(dtype=np.uint64, keepdims=True)
            out.append(mix(short + _PLACES[40 + b - a]))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def _fingerprints(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = shingle_sets(batch.column(1), width)
            sums = [[(mix(s ^ k)).sum(dtype=np.uint64) for s in sets] for k in (np.uint64(0x51ED270B), np.uint64(0x2545F4914F6CDD1D))]
            cols = [pa.array([len(s) for s in sets], pa.int64()), *[pa.array(np.array(x, np.uint64).view(np.int64)) for x in sums]]
            yield pa.RecordBatch.from_arrays([batch.column(0), *cols], names=["doc_id", "n", "f1", "f2"])

    return run


def _first_columns(width: int, percent: int, n_buckets: int):
    """Each document's first n-grams by hash, dealt to buckets. What a batch knows to be shared it counts itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets, ids = shingle_sets(batch.column(1), width), batch.column(0).to_numpy(zero_copy_only=False)
            first = [s[: len(s) - -(-len(s) * percent // 100) + 1 + len(s) // SLACK] for s in sets]
            h = np.concatenate(first) if first else np.zeros(0, np.uint64)
            row = np.repeat(np.arange(len(first)), [len(x) for x in first])
            order = np.argsort(h, kind="stable")
            h, row = h[order], row[order]
            at = runs(h)
            many = np.diff(np.r_[at, len(h)]) > 1
            inside = np.repeat(many, np.diff(np.r_[at, len(h)]))
            keep = np.ones(len(h), bool)
            keep[inside] = False
            keep[at] = True
            out = [(b, 0, p) for b, p in by_bucket(h[keep], n_buckets, [h[keep], ids[row[keep]], inside[keep].astype(np.uint8)])]
            counts = np.bincount(row[inside], minlength=len(ids))
            own = np.flatnonzero(counts)
            if len(own):
                out.append((int(ids[own[0]] % n_buckets), 1, pack([ids[own], counts[own].astype(np.int64)])))
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), (pa.int32(), pa.int32(), pa.binary()))] if out else [pa.array([], t) for t in (pa.int32(), pa.int32(), pa.binary())], names=["bucket", "kind", "payload"])

    return run


def _shared_counts(n_buckets: int):
    """Of each document, how many of a bucket's columns it shares: packed, dealt by document."""

    def run(group: pa.Table) -> pa.Table:
        docs, total = _shared_in(group)
        rows = list(by_bucket(mix(docs.view(np.uint64)), n_buckets, [docs, total]))
        return pa.table({"bucket": pa.array([b for b, _ in rows], pa.int32()), "payload": pa.array([p for _, p in rows], pa.binary())})

    return run


def _sum_counts(group: pa.Table) -> pa.Table:
    ids, n = unpack(group.column("payload").to_pylist(), [np.int64, np.int64])
    docs, at = np.unique(ids, return_inverse=True)
    return pa.table({"doc_id": docs, "shared": np.bincount(at, n, len(docs)).astype(np.int64)})


def _shared_in(group: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    kind, payload = group.column("kind").to_pylist(), group.column("payload").to_pylist()
    h, ids, told = unpack((p for k, p in zip(kind, payload) if k == 0), [np.uint64, np.int64, np.uint8])
    order = np.argsort(h, kind="stable")
    h, ids, told = h[order], ids[order], told[order]
    at = runs(h)
    size = np.diff(np.r_[at, len(h)])
    shared = np.repeat(size > 1, size) & (told == 0)
    if len(h):  # one entry that a batch has counted speaks for several documents
        shared |= np.repeat(np.add.reduceat(told, at, dtype=np.int64) > 0, size) & (told == 0)
    done, n = unpack((p for k, p in zip(kind, payload) if k == 1), [np.int64, np.int64])
    docs, where = np.unique(np.concatenate([ids[shared], done]), return_inverse=True)
    total = np.bincount(where, np.concatenate([np.ones(shared.sum()), n]), len(docs)).astype(np.int64)
    return docs, total


def _set_rows(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [s.view(np.int64) for s in shingle_sets(batch.column(1), width)]
            lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, sets)]).astype(np.int32)), pa.array(np.concatenate(sets) if sets else np.zeros(0, np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], names=["doc_id", "grams"])

    return run


def overlap_links(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, percent: int = PERCENT) -> tuple[np.ndarray, np.ndarray]:
    """Linked pairs of rows in ``left`` with rows in ``right``: the product of one part with another.

    Counts grow slice by slice of the shared columns. A pair is out once its count and
    what both rows still have to come stay below percent/(100 + percent) of both sizes.
    """
    sizes = np.array([len(s) for s in sets], np.int64)
    h, row = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(h, kind="stable")
    h, row = h[order], row[order]
    at = runs(h)
    df = np.diff(np.r_[at, len(h)])
    column = np.repeat(np.where(df > 1, np.cumsum(df > 1) - 1, -1), df)
    row, column = row[column >= 0], column[column >= 0]
    n_columns = int((df > 1).sum())
    need = percent * (sizes[left][:, None] + sizes[right][None, :])
    low, high = np.minimum(sizes[left][:, None], sizes[right][None, :]), np.maximum(sizes[left][:, None], sizes[right][None, :])
    live = (100 * low >= percent * high) & (low > 0)
    count = np.zeros(live.shape, np.int64)
    rest = np.bincount(row, minlength=len(sets))
    for c in range(0, n_columns, SLICE):
        a, b = np.searchsorted(column, [c, c + SLICE])
        part = np.zeros((len(sets), min(SLICE, n_columns - c)), np.float32)
        part[row[a:b], column[a:b] - c] = 1
        count += (part[left] @ part[right].T).astype(np.int64)
        rest = rest - np.bincount(row[a:b], minlength=len(sets))
        live &= (100 + percent) * (count + np.minimum(rest[left][:, None], rest[right][None, :])) >= need
        if not live.any():
            break
    i, j = np.nonzero(live & ((100 + percent) * count >= need))
    return left[i], right[j]


def _block_links(percent: int):
    def run(group: pa.Table) -> pa.Table:
        ids, part = group.column("doc_id").to_numpy(), group.column("part").to_numpy()
        lists = group.column("grams").combine_chunks()
        ends, flat = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False).view(np.uint64)
        sets = [flat[a:b] for a, b in zip(ends[:-1], ends[1:])]
        p, q = group.column("p")[0].as_py(), group.column("q")[0].as_py()
        i, j = overlap_links(sets, np.flatnonzero(part == p), np.flatnonzero(part == q), percent)
        a, b = forest(ids[i], ids[j]) if len(i) else (ids[:0], ids[:0])
        return pa.table({"a": a, "b": b}).filter(pa.array(a != b))

    return run


def meetings(rows: DataFrame) -> DataFrame:
    """Which size classes of a block meet, stored: (component, block, k, c, r, k2, r2).

    ``rows`` are the members of blocks: (doc_id, component, block, k, n) with n n-grams. A
    size class k of c members has r parts, as many as their number and their n-grams ask
    for, and meets its own parts and the r2 parts of its neighbours.
    """
    key = ["component", "block", "k"]
    parts = F.greatest(F.ceil(F.count(F.lit(1)) / PART), F.ceil(F.sum("n") / PART_GRAMS)).cast("int")
    sizes = write_shared(rows.groupBy(*key).agg(F.count(F.lit(1)).alias("c"), parts.alias("r")), "sizes")
    other = sizes.select("component", "block", F.col("k").alias("k2"), F.col("r").alias("r2"))
    near = sizes.withColumn("k2", F.explode(F.array(F.col("k") - 1, F.col("k"), F.col("k") + 1)))
    return write_shared(near.join(other, ["component", "block", "k2"]), "meetings")


def blocks_to_multiply(block: DataFrame, ahead: DataFrame, sets: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """Members of the blocks of the product, (doc_id, component, block, k, n), and their meetings.

    ``block`` is (node, component), ``ahead`` the columns (doc_id, h) that tie them. A block
    is a whole component or, where fewer copies of rows are needed so, the classes that share a
    set of its columns.
    """
    # sizes of a link differ by 100 / percent at most, so by one class at most; a little more covers rounding
    width = max(math.log(100 / percent), 0.01) * (1 + 1e-9)
    size_class = F.floor(F.log(F.size("grams")) / width).cast("int")
    node = write_shared(block.join(sets.select(F.col("doc_id").alias("node"), size_class.alias("k"), F.size("grams").cast("long").alias("n")), "node"), "nodes")
    node = node.join(write_shared(node.groupBy("component").agg(F.count(F.lit(1)).alias("members"), F.sum("n").alias("all")), "members"), "component")
    node = write_shared(node.select(F.col("node").alias("doc_id"), "component", "members", "all", "k", "n"), "nodes")
    beyond = lambda members, grams: (F.col(members) > PART) | (F.col(grams) > PART_GRAMS)
    large = beyond("members", "all")
    whole = node.select("doc_id", "component", F.col("component").alias("block"), F.when(large, F.col("k")).otherwise(0).alias("k"), "n")
    met = meetings(whole)
    chained = node.filter(large)
    if chained.isEmpty():
        return whole, met
    ties = write_shared(ahead.join(chained.drop("members", "all"), "doc_id"), "ties")
    # columns of the same classes are one block: told by their number and 128 bits of hash
    same = ties.groupBy("h").agg(F.count(F.lit(1)).alias("m"), F.sum("n").alias("all"), F.bit_xor(F.xxhash64("doc_id", F.lit(1))).alias("x"), F.bit_xor(F.xxhash64("doc_id", F.lit(2))).alias("y"))
    same = write_shared(same.filter("m > 1").groupBy("m", "all", "x", "y").agg(F.min("h").alias("h")).select("h", "m", "all"), "tied")
    tied = ties.join(same, "h").select("doc_id", "component", F.col("h").alias("block"), F.when(beyond("m", "all"), F.col("k")).otherwise(0).alias("k"), "n")
    met_tied = meetings(tied)
    copies = lambda m: m.groupBy("component").agg(F.sum(F.col("c") * F.col("r2")).alias("copies"))
    apart = copies(met_tied).withColumnRenamed("copies", "fewer").join(copies(met), "component").filter("fewer < copies").select("component")
    apart = write_shared(apart, "apart")
    pick = lambda a, b: a.join(apart, "component", "left_anti").unionByName(b.join(apart, "component", "left_semi"))
    return pick(whole, tied), pick(met, met_tied)


def ngram_components(df: DataFrame, text: str = "text", key: str = "doc_id", width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every document: its set's size and its component's smallest id.

    Words are runs of anything but ASCII white space, with A-Z lower-cased. A text of
    fewer than ``width`` words is one n-gram; one without words has none and stays alone,
    as does a null text. Rows without an id are left out, and an id that comes twice
    counts once, with its smallest text. Other columns are left out. An empty table gives
    an empty one.
    """
    spark = df.sparkSession
    tune(spark)
    docs = one_row_per_id(df, key, text)
    prints = write_shared(docs.mapInArrow(lean(_fingerprints(width)), "doc_id long, n long, f1 long, f2 long"), "fingerprints")
    # what a join looks up is stored first, so that the other side can be split where a key is hot
    classes = write_shared(prints.filter("n > 0").groupBy("n", "f1", "f2").agg(F.min("doc_id").alias("rep")), "classes")
    of_doc = write_shared(prints.filter("n > 0").join(classes, ["n", "f1", "f2"]).select("doc_id", "n", "rep"), "classes")

    size = F.expr(f"(n * {percent} + 99) div 100")
    enough = F.expr(f"shared >= 1 + ((n * {percent} + 99) div 100) div {SLACK}")
    n_buckets = buckets_for(1.3 * text_bytes(docs))
    dealt = docs.mapInArrow(lean(_first_columns(width, percent, n_buckets)), "bucket int, kind int, payload binary")
    counts = dealt.groupBy("bucket").applyInArrow(_shared_counts(n_buckets), "bucket int, payload binary")
    shared = counts.groupBy("bucket").applyInArrow(_sum_counts, "doc_id long, shared long")
    left = write_shared(shared.join(of_doc.filter("doc_id = rep"), "doc_id").filter(enough).select("doc_id"), "candidates")
    sets = write_shared(docs.join(left, "doc_id", "left_semi").mapInArrow(lean(_set_rows(width)), "doc_id long, grams array<long>"), "sets")

    cells = sets.select("doc_id", F.explode("grams").alias("h"))
    common = write_shared(cells.groupBy("h").count().filter("count > 1"), "common")
    rows = cells.join(common, "h").groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("count", "h"))).alias("c"))
    rows = rows.join(sets.select("doc_id", F.size("grams").cast("long").alias("n")), "doc_id")
    first = F.col("n") - size + 1 - (F.col("n") - F.size("c"))  # columns of one class only come first
    ahead = write_shared(rows.filter(first > 0).select("doc_id", F.explode(F.slice("c", F.lit(1), first.cast("int"))).alias("c")).select("doc_id", "c.h"), "columns")

    def hubs(entries: DataFrame) -> DataFrame:
        """(doc_id, hub): the smallest class of each column of a class."""
        least = write_shared(entries.groupBy("h").agg(F.min("doc_id").alias("hub")), "hubs")
        return entries.join(least, "h").filter("doc_id <> hub").select("doc_id", "hub")

    stars = write_shared(hubs(ahead).groupBy("doc_id").agg(F.min("hub").alias("hub")), "stars")
    near = stars.join(sets, "doc_id").join(sets.select(F.col("doc_id").alias("hub"), F.col("grams").alias("theirs")), "hub")
    both, total = F.size(F.array_intersect("grams", "theirs")).cast("long"), (F.size("grams") + F.size("theirs")).cast("long")
    near = write_shared(near.filter(both * (100 + percent) >= total * percent).select(F.col("doc_id").alias("a"), F.col("hub").alias("b")), "near")
    grown = write_shared(components(near), "grown")
    of_class = ahead.join(grown.withColumnRenamed("node", "doc_id"), "doc_id", "left").select("doc_id", "h", F.coalesce("component", "doc_id").alias("component"))
    open_ = of_class.groupBy("h").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low <> high").select("h")
    ahead = write_shared(ahead.join(write_shared(open_, "open"), "h", "left_semi"), "columns")
    block = components(hubs(ahead).select(F.col("doc_id").alias("a"), F.col("hub").alias("b")).distinct())

    member, met = blocks_to_multiply(block, ahead, sets, percent)
    part = lambda k, number: F.shiftleft(F.col(k).cast("long"), 32) + number
    member = member.join(met, ["component", "block", "k"]).withColumn("part", part("k", F.pmod(F.xxhash64("doc_id"), F.col("r"))))
    member = member.withColumn("j", F.explode(F.sequence(F.lit(0), F.col("r2") - 1))).withColumn("other", part("k2", F.col("j"))).join(sets, "doc_id")
    member = member.select("doc_id", "grams", "part", "component", "block", F.least("part", "other").alias("p"), F.greatest("part", "other").alias("q"))
    links = member.groupBy("component", "block", "p", "q").applyInArrow(_block_links(percent), "a long, b long")
    reached = write_shared(components(near.union(links)), "reached")

    found = of_doc.join(reached, of_doc["rep"] == reached["node"], "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "rep").alias("component_id"))
    alone = prints.filter("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return found.union(alone)
