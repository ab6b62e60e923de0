"""Line dedup by pairwise alignment.

A line is known by its 128-bit hash and by how often the document had it before, so each is
unique in its document, as patience diff wants it. What can be deleted are blocks of
enough letters, and each such block is made of windows: the shortest runs of lines, from a
line on or up to a line, that have enough letters. A window that two documents share is
the same window in both, so documents that overlap are found through the windows they
share, long lines and passages of short ones alike.

A pair is aligned by patience diff: of the lines of its shared windows, the longest run that
stands in the same order in both. Lines next to each other in both texts form a common
block; blocks go from the later document. A run of lines that both have is in the longest
run whole or not at all.

Documents with the same shared windows in the same order align alike with any other, so
the first of them stands for all; the others are aligned with it alone. A first one is
aligned with the first holder of each of its windows. Windows that were not in line with
it go on to the other holders, nearest first, twice as many in every round, until they
are deleted or no holder is left: what goes is what some earlier document aligns with.
Windows that no document before the first holder has are also aligned with it by
themselves, so those that are known from elsewhere don't stand in their way.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import lean, one_row_per_id, tune, write_shared

#: Letters (characters other than white space) that a common block must have to be deleted.
MIN_LETTERS = 20


def increasing(values: list[int]) -> list[int]:
    """Places of a longest strictly increasing subsequence (patience sorting)."""
    tops: list[int] = []
    at: list[int] = []
    back: list[int] = []
    for k, v in enumerate(values):
        pile = bisect_left(tops, v)
        back.append(at[pile - 1] if pile else -1)
        if pile == len(tops):
            tops.append(v)
            at.append(k)
        else:
            tops[pile], at[pile] = v, k
    out, k = [], at[-1] if at else -1
    while k >= 0:
        out.append(k)
        k = back[k]
    return out[::-1]


_BLOCKS = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64()), ("home", pa.int64())]))


def windows_of(text: str, min_letters: int = MIN_LETTERS) -> list[tuple[int, int, bytes]]:
    """(first, last, hash) of the shortest runs of ``min_letters`` letters from each line on and up to each line.

    Lines are counted from 0 without the blank ones. Equal runs are listed once.
    """
    names, letters, seen = [], [], {}
    for line in text.split("\n"):
        n = len("".join(line.split()))
        if n:
            h = hashlib.blake2b(line.encode("utf-8", "surrogatepass"), digest_size=16).digest()
            k = seen[h] = seen.get(h, -1) + 1
            names.append(h if not k else h + b"%d" % k)
            letters.append(n)
    spans, total, last = set(), 0, 0
    for first in range(len(names)):  # from a line on
        while last < len(names) and (total < min_letters or last <= first):
            total, last = total + letters[last], last + 1
        if total < min_letters:
            break
        spans.add((first, last - 1))
        total -= letters[first]
    total, first = 0, 0
    for last in range(len(names)):  # up to a line
        total += letters[last]
        while first < last and total - letters[first] >= min_letters:
            total, first = total - letters[first], first + 1
        if total >= min_letters:
            spans.add((first, last))
    return [(a, b, hashlib.blake2b(b"|".join(names[a : b + 1]), digest_size=16).digest()) for a, b in sorted(spans)]


def common_blocks(shared: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Blocks (first, last) of the aligned lines, from the windows that two documents share: (first, last) here and first there."""
    there: dict[int, int] = {}
    for first, last, other in shared:
        for k in range(last - first + 1):
            there[first + k] = other + k
    lines = sorted(there)
    out: list[tuple[int, int]] = []
    for p in (lines[k] for k in increasing([there[p] for p in lines])):
        if out and out[-1][1] == p - 1 and there[p - 1] == there[p] - 1:
            out[-1] = (out[-1][0], p)
        else:
            out.append((p, p))
    return out


def _windows(min_letters: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, first, last, hashes = [], [], [], []
            for d, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for a, b, h in windows_of(text, min_letters):
                    ids.append(d)
                    first.append(a)
                    last.append(b)
                    hashes.append(h)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(first, pa.int32()), pa.array(last, pa.int32()), pa.array(hashes, pa.binary())], names=["doc_id", "first", "last", "h"])

    return run


def _align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, others, first, last = [], [], [], []
        for d, e, shared in zip(*(batch.column(k).to_pylist() for k in range(3))):
            spans = [(w["first"], w["last"], w["there"]) for w in shared]
            first_here = [x for x, w in zip(spans, shared) if w["at_home"]]
            for a, b in {*common_blocks(spans), *common_blocks(first_here)}:
                ids.append(d)
                others.append(e)
                first.append(a)
                last.append(b)
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(others, pa.int64()), pa.array(first, pa.int32()), pa.array(last, pa.int32())], names=["doc_id", "home", "first", "last"])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Delete the blocks. Where several documents have a line, it counts for the block of the first of them."""
    for batch in batches:
        kept, n, blocks, emptied = [], [], [], []
        for text, found in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            lines = text.split("\n") if found else []
            at = [k for k, x in enumerate(lines) if x.strip()]
            gone: set[int] = set()
            own = []
            for b in sorted(found or [], key=lambda b: (b["home"], b["first"])):
                fresh = [p for p in range(at[b["first"]], at[b["last"]] + 1) if p not in gone]
                gone.update(fresh)
                for k, p in enumerate(fresh):
                    if k and fresh[k - 1] == p - 1:
                        own[-1]["last"] = p
                    else:
                        own.append({"first": p, "last": p, "home": b["home"]})
            kept.append("\n".join(x for k, x in enumerate(lines) if k not in gone) if gone else text)
            n.append(len(gone))
            blocks.append(sorted(own, key=lambda b: b["first"]))
            emptied.append(bool(gone) and not kept[-1].strip())
        columns = [batch.column(0), pa.array(kept, pa.string()), pa.array(n, pa.int64()), pa.array(blocks, _BLOCKS), pa.array(emptied)]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "kept", "n_removed", "blocks", "emptied"])


def _ranks(holders: DataFrame) -> DataFrame:
    """(h, doc_id, rank): which holder of its window a document is, from 1 on.

    Holders are dealt by ranges of (h, doc_id), so those of a hot window lie in many parts;
    a holder's rank is its place in its part and the number of holders in the parts before.
    """
    dealt = write_shared(holders.repartitionByRange("h", "doc_id").withColumn("part", F.spark_partition_id()), "holders")
    sizes = dealt.groupBy("h", "part").agg(F.count(F.lit(1)).alias("n"))
    before = sizes.select("h", "part", (F.sum("n").over(Window.partitionBy("h").orderBy("part")) - F.col("n")).alias("before"))
    place = F.row_number().over(Window.partitionBy("h", "part").orderBy("doc_id"))
    return write_shared(dealt.withColumn("place", place).join(before, ["h", "part"]).select("h", "doc_id", (F.col("before") + F.col("place")).alias("rank")), "ranks")


def _blocks_of(docs: DataFrame, min_letters: int) -> DataFrame:
    """(doc_id, home, first, last) of the common blocks of every document with earlier ones."""
    rows = write_shared(docs.mapInArrow(_windows(min_letters), "doc_id long, first int, last int, h binary"), "windows")
    homes = rows.groupBy("h").agg(F.min("doc_id").alias("home"), F.count(F.lit(1)).alias("df")).filter("df > 1").drop("df")
    homes = write_shared(homes, "homes")  # so that the join below can split a hot window
    held = write_shared(rows.join(homes, "h"), "held")
    lists = held.groupBy("doc_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("first", "last", "h"))), lambda w: F.hex(w["h"])), "").alias("all"), F.count(F.lit(1)).alias("n"))
    lists = write_shared(lists.select("doc_id", "n", F.unhex(F.md5(F.col("all").cast("binary"))).alias("form")), "lists")
    forms = write_shared(lists.groupBy("form").agg(F.min("doc_id").alias("rep")), "forms")
    lists = write_shared(lists.join(forms, "form").select("doc_id", "rep", "n"), "lists")
    held = write_shared(held.join(lists.select("doc_id", "rep"), "doc_id"), "held")
    reps = held.filter("doc_id = rep").drop("rep")
    theirs = reps.select(F.col("doc_id").alias("other"), "h", F.col("first").alias("there"))

    def align(pairs: DataFrame) -> DataFrame:
        """The blocks of pairs (doc_id, other): the windows of the one with fewer are looked up in the other."""
        size = lists.select("doc_id", "n")
        sized = write_shared(pairs.join(size, "doc_id").join(size.toDF("other", "m"), "other"), "pairs")
        by_other = sized.filter("m <= n").select("doc_id", "other").join(theirs, "other").join(held, ["doc_id", "h"])
        by_own = sized.filter("m > n").select("doc_id", "other").join(held, "doc_id").join(theirs, ["other", "h"])
        window = F.struct("first", "last", "there", (F.col("home") == F.col("other")).alias("at_home"))
        both = by_other.select("doc_id", "other", window.alias("w")).union(by_own.select("doc_id", "other", window.alias("w")))
        both = both.groupBy("doc_id", "other").agg(F.collect_list("w").alias("w"))
        return write_shared(both.mapInArrow(lean(_align), "doc_id long, home long, first int, last int"), "blocks")

    copies = lists.filter("doc_id <> rep").select("doc_id", F.col("rep").alias("other"))
    firsts = reps.select("doc_id", F.col("home").alias("other")).filter("doc_id <> other").distinct()
    blocks = align(copies.union(firsts))

    def left(windows: DataFrame, found: DataFrame) -> DataFrame:
        """The windows that no block covers whole."""
        spans = found.groupBy("doc_id").agg(F.collect_list(F.struct("first", "last")).alias("spans"))
        own = windows.join(spans, "doc_id", "left")
        return own.filter(F.expr("not coalesce(exists(spans, s -> s.first <= first and last <= s.last), false)")).drop("spans")

    open_ = write_shared(left(reps.filter("doc_id <> home").select("doc_id", "first", "last", "h"), blocks), "open")
    if open_.isEmpty():
        return blocks
    ranks = _ranks(reps.join(open_.select("h").distinct(), "h", "left_semi").select("h", "doc_id"))
    # the first holder, rank 1, has been tried
    open_, many = open_.join(ranks, ["h", "doc_id"]).filter("rank > 2"), 1
    open_ = write_shared(open_, "open")
    while not open_.isEmpty():
        tries = open_.select("doc_id", "h", F.explode(F.sequence(F.greatest(F.lit(2), F.col("rank") - many), F.col("rank") - 1)).alias("rank"))
        pairs = tries.join(ranks.withColumnRenamed("doc_id", "other"), ["h", "rank"]).select("doc_id", "other").distinct()
        fresh = align(pairs)
        blocks = blocks.union(fresh)
        open_ = write_shared(left(open_, fresh).withColumn("rank", F.col("rank") - many).filter("rank > 2"), "open")
        many *= 2
    return blocks


def dedup_lines(df: DataFrame, text: str = "text", key: str = "doc_id", min_letters: int = MIN_LETTERS) -> DataFrame:
    """(doc_id, kept, n_removed, blocks, emptied) for every document.

    ``kept`` is the text without the blocks that an earlier document (smaller id) has too,
    ``n_removed`` counts the deleted lines, ``blocks`` are (first, last, home) with lines
    counted from 0, and ``emptied`` says that nothing but white space is left of a text
    that lost lines. Lines end at line feeds; blank ones are never a reason to pair. Null
    texts count as empty. Rows without an id are left out, and an id that comes twice
    counts once, with its smallest text. Other columns are left out. An empty table gives
    an empty one.
    """
    tune(df.sparkSession)
    docs = one_row_per_id(df, key, text)
    found = _blocks_of(docs, min_letters).groupBy("doc_id").agg(F.collect_list(F.struct("first", "last", "home")).alias("found"))
    return docs.join(found, "doc_id", "left").select("doc_id", "text", "found").mapInArrow(_cut, "doc_id long, kept string, n_removed long, blocks array<struct<first:long,last:long,home:long>>, emptied boolean")
