"""Suffix-array dedup: a depth-limited radix sort, most significant digit first.

Suffixes are ordered only through their first ``size`` bytes (the threshold), since two
suffixes that agree so far are the same repeated window. Dealing every suffix by its
first bytes would send some 16 bytes for each byte of text, so the first digit is one that
neighbouring windows mostly have in common: the window's least k-gram by hash, which
equal windows share wherever they stand. A run of windows with one such digit is one
entry of the first pass, which keeps groups that several documents share. Only their
bytes go on. Then a bucket's windows are ordered by their bytes, eight at a time from the
left: each pass splits the groups of the pass before and drops those of one document,
so what goes on is still shared, and the groups left after ``size`` bytes are exactly the
repeated windows. A window is a repeat where a document with a smaller id has it too.

A digit of very many runs that still differ (a phrase with other words around it in each
document) would make one huge group. Its windows go on as plain rows with all their
bytes: the smallest document of each is an aggregate that every task first makes of its
own rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BYTE_VALUES, bucket_of, buckets_for, lean, mix, one_row_per_id, pack, runs, slices, text_bytes, tune, unpack, utf8, write_shared
from .ngram_join import powers

SIZE = 50
#: Bytes in a digit of the first pass, and different runs of one digit that a bucket may order (some 2 KB of memory each).
DIGIT, HEAVY_RUNS = 16, 50_000


def rolling(raw: np.ndarray, width: int, step: int = 1 << 20, values: np.ndarray = BYTE_VALUES) -> np.ndarray:
    """64-bit hashes of all substrings of ``width`` bytes, made piece by piece to need little memory."""
    out = np.zeros(max(0, len(raw) - width + 1), np.uint64)
    up, down = powers(min(len(raw), step + width) + 1)
    for a in range(0, len(out), step):
        part = raw[a : a + step + width - 1]
        total = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(values[part] * up[: len(part)], out=total[1:])
        n = len(part) - width + 1
        out[a : a + n] = mix((total[width:] - total[:n]) * down[:n])
    return out


def least_digits(h: np.ndarray, w: int) -> np.ndarray:
    """The least of each ``w`` neighbouring hashes."""
    if len(h) < w:
        return np.zeros(0, np.uint64)
    m, s = h, 1
    while 2 * s <= w:
        m, s = np.minimum(m[:-s], m[s:]), 2 * s
    return np.minimum(m[: len(m) - (w - s)], m[w - s :]) if s < w else m


_PACKED = [pa.int32(), pa.int32(), pa.binary()]


def _packed_rows(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else ([], [], [])
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, _PACKED)], names=["bucket", "kind", "payload"])


def _planes(ids: np.ndarray) -> np.ndarray:
    """The bytes of integers, all lowest ones first, so that the shuffle's compression sees the zeros in a row."""
    return np.ascontiguousarray(ids.view(np.uint8).reshape(-1, 8).T).ravel()


def _entries(kh: np.ndarray, ids: np.ndarray, span: np.ndarray, told: np.ndarray) -> bytes:
    """Entries of one bucket: 40 bits of the digit (the bucket says the rest), the document, where a run starts, how long it is, what is told.

    Digits that agree in those bits by chance only send bytes to the second pass that differ there.
    """
    low, high = (kh & np.uint64(0xFFFFFFFF)).astype(np.uint32), ((kh >> np.uint64(32)) & np.uint64(0xFF)).astype(np.uint8)
    length = span & 0xFFFFFFFF
    columns = [low, high, _planes(ids), (span >> 32).astype(np.uint32), (length & 0xFFFF).astype(np.uint16), (length >> 16).astype(np.uint16), told]
    return len(kh).to_bytes(8, "little") + pack(columns)


def _read_entries(bucket: int, payloads: list[bytes]) -> list[np.ndarray]:
    parts: list[list[np.ndarray]] = [[np.zeros(0, d)] for d in (np.uint64, np.int64, np.int64, np.uint8)]
    for p in payloads:
        n, at, columns = int.from_bytes(p[:8], "little"), 8, []
        for kind, width in ((np.uint32, 1), (np.uint8, 1), (np.uint8, 8), (np.uint32, 1), (np.uint16, 1), (np.uint16, 1), (np.uint8, 1)):
            columns.append(np.frombuffer(p, kind, n * width, at))
            at += n * width * np.dtype(kind).itemsize
        low, high, planes, start, length, more, told = columns
        kh = (np.uint64(bucket) << np.uint64(40)) | (high.astype(np.uint64) << np.uint64(32)) | low
        ids = np.ascontiguousarray(planes.reshape(8, n).T).view(np.int64).ravel()
        for part, x in zip(parts, (kh, ids, (start.astype(np.int64) << 32) | (more.astype(np.int64) << 16) | length, told)):
            part.append(x)
    return [np.concatenate(x) for x in parts]


def _runs_by_digit(size: int, digit: int, n_buckets: int):
    """Runs of windows with one digit, dealt by it. What a slice knows to be shared it says itself.

    Of such a digit one entry goes to the digit's bucket, marked with the binary digits of
    how many different runs the slice has; all go to a bucket by the slice's first document.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(x, y - x) for b in batches for x, y in slices(b.column(1))):
            raw, ends = utf8(batch.column(1))
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            h = rolling(raw, digit)
            m = least_digits(h, size - digit + 1)
            if not len(m):
                continue
            row = np.repeat(np.arange(len(ids)), np.diff(ends))[: len(m)]
            whole = np.arange(len(m)) + size <= ends[row + 1]
            new = whole.copy()
            new[1:] &= (m[1:] != m[:-1]) | (row[1:] != row[:-1]) | ~whole[:-1]
            at = np.flatnonzero(new)
            stop = np.flatnonzero(whole & np.r_[new[1:] | ~whole[1:], True]) + 1
            kh, doc, start, length = m[at], row[at], at - ends[row[at]], stop - at
            order = np.lexsort((doc, kh))
            kh, doc, start, length, at, stop = kh[order], doc[order], start[order], length[order], at[order], stop[order]
            first = runs(kh)
            n = np.diff(np.r_[first, len(kh)])
            several = np.repeat(doc[first] != doc[first + n - 1], n)
            keep = ~several
            keep[first] = True
            span = (start.astype(np.int64) << 32) | length
            told = np.zeros(len(kh), np.uint8)
            if several.any():  # runs of one length with the same ends count as one
                own, group = np.flatnonzero(several), np.repeat(np.arange(len(first)), n)[several]
                look = mix(h[at[own]] ^ mix(h[stop[own] - 1 + size - digit] + length[own].astype(np.uint64)))
                by = np.lexsort((look, group))
                different = np.bincount(group[by][runs(group[by], look[by])], minlength=len(first))
                told[own] = (np.ceil(np.log2(different[group])) + 1).astype(np.uint8)
            bucket = bucket_of(kh, n_buckets)
            rows = []
            own = np.flatnonzero(keep)[np.argsort(bucket[keep], kind="stable")]
            cuts = np.r_[runs(bucket[own]), len(own)]
            for a, b in zip(cuts[:-1], cuts[1:]):
                o = own[a:b]
                rows.append((int(bucket[o[0]]), 0, _entries(kh[o], ids[doc[o]], span[o], told[o])))
            if several.any():
                named = (bucket.astype(np.uint64) << np.uint64(40)) | (kh & np.uint64(0xFFFFFFFFFF))
                rows.append((int(bucket_of(ids[:1].view(np.uint64), n_buckets)[0]), 1, pack([named[several], ids[doc[several]], span[several]])))
            yield _packed_rows(rows)

    return run


def _short(kh: np.ndarray) -> np.ndarray:
    """32 bits of a digit. Digits that agree in them by chance share a bucket, where bytes tell them apart."""
    return (mix(kh) >> np.uint64(32)).astype(np.uint32).view(np.int32)


def _shared_runs(heavy: int):
    """The runs of a bucket whose digit several documents have, and a row with span -1 for each digit of more than ``heavy`` runs."""

    def run(group: pa.Table) -> pa.Table:
        kh, ids, span, large = _shared_in(group, heavy)
        none = np.full(len(large), -1)
        return pa.table({"doc_id": np.r_[ids, none], "span": np.r_[span, none], "kh": _short(np.r_[kh, large])})

    return run


def _shared_in(group: pa.Table, heavy: int) -> list[np.ndarray]:
    kind, payload = group.column("kind").to_pylist(), group.column("payload").to_pylist()
    kh, ids, span, told = _read_entries(group.column("bucket")[0].as_py(), [p for k, p in zip(kind, payload) if k == 0])
    order = np.lexsort((ids, kh))
    kh, ids, span, told = kh[order], ids[order], span[order], told[order]
    first = runs(kh)
    n = np.diff(np.r_[first, len(kh)])
    shared, large = np.zeros(0, bool), kh[:0]
    if len(kh):
        shared = np.repeat((ids[first] != ids[first + n - 1]) | (np.add.reduceat(told, first, dtype=np.int64) > 0), n)
        most = np.where(told > 0, np.exp2(told.astype(float) - 1), 1)
        large = kh[first[np.add.reduceat(most, first) > heavy]]
    shared &= told == 0
    more = unpack((p for k, p in zip(kind, payload) if k == 1), [np.uint64, np.int64, np.int64])
    return [*(np.concatenate([a[shared], b]) for a, b in zip((kh, ids, span), more)), large]


def _bytes_by_digit(size: int, n_buckets: int):
    """The bytes of shared runs, dealt by digit. A run that an earlier row of the batch holds whole is settled here."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, lists, digits = batch.column(0).to_pylist(), batch.column(2), batch.column(3)
            raw, ends = utf8(batch.column(1))
            raw, at = raw.tobytes(), lists.offsets.to_numpy()
            spans = lists.values.to_numpy(zero_copy_only=False)
            short = digits.values.to_numpy(zero_copy_only=False).view(np.uint32).astype(np.uint64)
            deals = ((short * np.uint64(n_buckets)) >> np.uint64(32)).astype(np.int64)
            seen: dict[bytes, int] = {}
            kept, doc_of, parts, done_ids, done_spans = [], [], [], [], []
            for k in sorted(range(len(ids)), key=ids.__getitem__):
                doc, base = ids[k], int(ends[k])
                for i in range(at[k], at[k + 1]):
                    s = int(spans[i])
                    start, n = s >> 32, (s & 0xFFFFFFFF) + size - 1
                    part = raw[base + start : base + start + n]
                    if seen.setdefault(part, doc) != doc:
                        done_ids.append(doc)
                        done_spans.append((start << 32) | n)
                    else:
                        kept.append(i)
                        doc_of.append(doc)
                        parts.append(part)
            rows = []
            if kept:
                kept, doc_of = np.array(kept), np.array(doc_of, np.int64)
                bucket = deals[kept]
                order = np.argsort(bucket, kind="stable")
                cuts = np.r_[runs(bucket[order]), len(order)]
                for a, b in zip(cuts[:-1], cuts[1:]):
                    o = order[a:b]
                    rows.append((int(bucket[o[0]]), 0, len(o).to_bytes(8, "little") + pack([doc_of[o], spans[kept[o]]]) + b"".join([parts[i] for i in o.tolist()])))
            if done_ids:
                rows.append((done_ids[0] % n_buckets, 1, pack([np.array(done_ids, np.int64), np.array(done_spans, np.int64)])))
            yield _packed_rows(rows)

    return run


def repeats(raw: np.ndarray, at: np.ndarray, owner: np.ndarray, size: int) -> np.ndarray:
    """Which of the windows at some places an earlier owner has too.

    Passes over the windows' bytes, from the left. In each, groups are split by the next
    digit, and windows whose group is all one owner's leave; those left in the end are
    grouped by all their bytes. A digit has as many bytes as the group's number leaves
    room for in 64 bits, so a pass is one sort.
    """
    words = np.ndarray(len(raw) + 1, ">u8", np.r_[raw, np.zeros(8, np.uint8)].tobytes(), strides=(1,))
    live, group, low, n = np.arange(len(at)), np.zeros(len(at), np.uint64), owner[:0], at[:0]
    n_groups, done = 1, 0
    while len(live) and done < size:
        width = min(8 - -(-(n_groups - 1).bit_length() // 8), size - done)
        key = words[at[live] + done].astype(np.uint64) >> np.uint64(64 - 8 * width)
        if n_groups > 1:
            key |= group << np.uint64(8 * width)
        by = np.argsort(key)
        live, key = live[by], key[by]
        first = runs(key)
        n, own = np.diff(np.r_[first, len(key)]), owner[live]
        low = np.minimum.reduceat(own, first)
        shared = low != np.maximum.reduceat(own, first)
        live, low, n = live[np.repeat(shared, n)], low[shared], n[shared]
        n_groups, done = len(n), done + width
        group = np.repeat(np.arange(n_groups, dtype=np.uint64), n)
    hit = np.zeros(len(at), bool)
    if len(live):
        hit[live] = owner[live] > np.repeat(low, n)
    return hit


def _repeated(size: int):
    """Orders all windows of a bucket by their bytes; those that a smaller document has as well become spans."""

    def run(group: pa.Table) -> pa.Table:
        ids, spans, parts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], []
        done = unpack((p for k, p in zip(group.column("kind").to_pylist(), group.column("payload").to_pylist()) if k == 1), [np.int64, np.int64])
        for kind, p in zip(group.column("kind").to_pylist(), group.column("payload").to_pylist()):
            if kind == 0:
                n = int.from_bytes(p[:8], "little")
                ids.append(np.frombuffer(p, np.int64, n, 8))
                spans.append(np.frombuffer(p, np.int64, n, 8 + 8 * n))
                parts.append(np.frombuffer(p, np.uint8, -1, 8 + 16 * n))
        ids, spans = np.concatenate(ids), np.concatenate(spans)
        raw = np.concatenate(parts) if parts else np.zeros(0, np.uint8)
        n = (spans & 0xFFFFFFFF) + size - 1
        begin = np.cumsum(n) - n
        order = np.argsort(ids, kind="stable")
        count = (n - size + 1)[order]
        entry = np.repeat(order, count)  # windows in the order of their documents
        within = np.arange(len(entry)) - np.repeat(np.cumsum(count) - count, count)
        owner = ids[entry]
        hit = repeats(raw, begin[entry] + within, owner, size)
        begins = hit & np.r_[True, (~hit[:-1]) | (entry[1:] != entry[:-1])][: len(hit)]
        stops = hit & np.r_[(~hit[1:]) | (entry[1:] != entry[:-1]), True][-len(hit) :] if len(hit) else hit
        a, b = np.flatnonzero(begins), np.flatnonzero(stops)
        start = (spans[entry[a]] >> 32) + within[a]
        found = (start << 32) | (b - a + size)
        return pa.table({"doc_id": np.concatenate([owner[a], done[0]]), "span": np.concatenate([found, done[1]])})

    return run


def _whole(size: int):
    """All windows of the given runs as rows: document, place, how many bytes, and the bytes.

    A run that an earlier row of the batch holds whole is settled here: one row without bytes.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, ends = utf8(batch.column(1))
            lists, whole, ids = batch.column(2), raw.tobytes(), batch.column(0).to_numpy(zero_copy_only=False)
            spans, at = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
            seen: dict[bytes, int] = {}
            row, kept, done = [], [], []
            for k in np.argsort(ids, kind="stable").tolist():
                for s in spans[at[k] : at[k + 1]].tolist():
                    a, n = int(ends[k]) + (s >> 32), (s & 0xFFFFFFFF) + size - 1
                    if seen.setdefault(whole[a : a + n], k) != k:
                        done.append((ids[k], s >> 32, n))
                    else:
                        row.append(k)
                        kept.append(s)
            kept, row = np.array(kept, np.int64), np.array(row, np.int64)
            n = kept & 0xFFFFFFFF
            start = np.repeat(kept >> 32, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            row, names = np.repeat(row, n), ["doc_id", "start", "n", "w"]
            for a in range(0, len(row), 50_000):
                some = slice(a, a + 50_000)
                at_ = ends[row[some]] + start[some]
                flat = raw[at_[:, None] + np.arange(size)]
                w = pa.Array.from_buffers(pa.binary(), len(at_), [None, pa.py_buffer((np.arange(len(at_) + 1, dtype=np.int32) * size).tobytes()), pa.py_buffer(np.ascontiguousarray(flat).tobytes())])
                yield pa.RecordBatch.from_arrays([pa.array(ids[row[some]]), pa.array(start[some]), pa.array(np.full(len(at_), size)), w], names=names)
            if done:
                yield pa.RecordBatch.from_arrays([*(pa.array(x, pa.int64()) for x in zip(*done)), pa.nulls(len(done), pa.binary())], names=names)

    return run


def _by_whole_window(docs: DataFrame, runs_: DataFrame, size: int) -> DataFrame:
    """(doc_id, span) of the repeats among the windows of some runs, found as rows."""
    rows = runs_.groupBy("doc_id").agg(F.collect_list("span").alias("span"))
    windows = write_shared(docs.join(rows, "doc_id").select("doc_id", "text", "span").mapInArrow(lean(_whole(size)), "doc_id long, start long, n long, w binary"), "windows")
    least = write_shared(windows.filter("w is not null").groupBy("w").agg(F.min("doc_id").alias("first")), "least")
    repeated = windows.join(least, "w").filter("doc_id > first").select("doc_id", "start", "n")
    return repeated.union(windows.filter("w is null").select("doc_id", "start", "n")).select("doc_id", F.expr("shiftleft(start, 32) | n").alias("span"))


_KEPT = "doc_id long, n_bytes long, kept binary, spans array<struct<start:long,stop:long>>"
_SPAN = pa.struct([("start", pa.int64()), ("stop", pa.int64())])


def _without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts without the union of their spans."""
    for batch in batches:
        raw, ends = utf8(batch.column(1))
        raw, lists = raw.tobytes(), batch.column(2).to_pylist()
        kept, spans = [], []
        for k, found in enumerate(lists):
            text, merged = raw[ends[k] : ends[k + 1]], []
            for s in sorted(found or ()):
                a, b = s >> 32, (s >> 32) + (s & 0xFFFFFFFF)
                if merged and a <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], b)
                else:
                    merged.append([a, b])
            at, left = 0, []
            for a, b in merged:
                left.append(text[at:a])
                at = b
            kept.append(b"".join(left) + text[at:])
            spans.append([{"start": a, "stop": b} for a, b in merged])
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(ends)), pa.array(kept, pa.binary()), pa.array(spans, pa.list_(_SPAN))], names=["doc_id", "n_bytes", "kept", "spans"])


def remove_repeats(df: DataFrame, text: str = "text", key: str = "doc_id", size: int = SIZE, digit: int = DIGIT) -> DataFrame:
    """(doc_id, n_bytes, kept, spans): texts as UTF-8 without every byte that a repeated window covers.

    A window of ``size`` bytes is repeated where a document with a smaller id holds it
    too, anywhere. ``spans`` are the maximal removed runs, ``kept`` the bytes left, which
    need not be UTF-8. Null texts count as empty; texts shorter than ``size`` stay whole.
    Rows without an id are left out, and an id that comes twice counts once, with its
    smallest text. Other columns are left out. An empty table gives an empty one.
    """
    tune(df.sparkSession)
    docs = one_row_per_id(df, key, text)
    n_bytes = text_bytes(docs)
    # a run of windows comes to about 25 packed bytes and every 18 bytes of text
    first = docs.mapInArrow(lean(_runs_by_digit(size, digit, buckets_for(1.4 * n_bytes))), "bucket int, kind int, payload binary")
    shared = write_shared(first.groupBy("bucket").applyInArrow(_shared_runs(HEAVY_RUNS), "doc_id long, span long, kh int"), "runs", codec="zstd")
    heavy, light, hot = shared.filter("span = -1").select("kh"), shared.filter("span <> -1"), None
    if not heavy.isEmpty():
        light, hot = light.join(heavy, "kh", "left_anti"), light.join(heavy, "kh", "left_semi")
    n_second = buckets_for(1.5 * n_bytes)
    rows = light.groupBy("doc_id").agg(F.collect_list(F.struct("span", "kh")).alias("r")).select("doc_id", F.col("r.span").alias("span"), F.col("r.kh").alias("kh"))
    second = docs.join(rows, "doc_id").select("doc_id", "text", "span", "kh").mapInArrow(lean(_bytes_by_digit(size, n_second)), "bucket int, kind int, payload binary")
    found = second.groupBy("bucket").applyInArrow(_repeated(size), "doc_id long, span long")
    if hot is not None:
        found = found.union(_by_whole_window(docs, hot, size))
    found = write_shared(found, "repeats")
    spans = found.groupBy("doc_id").agg(F.collect_list("span").alias("spans"))
    return docs.join(spans, "doc_id", "left").select("doc_id", "text", "spans").mapInArrow(_without, _KEPT)
