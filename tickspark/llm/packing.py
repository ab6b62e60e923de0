"""Packing: best-fit decreasing over a segment tree of open windows.

Documents are tokenized where they are read and cut at once: every full window is a
sequence of its own and is numbered there, only the tails are left to be packed. Tails
go without their ids, as a number and a length, to as many tasks as their number asks
for. A task sorts a run of them by length and puts each into the tightest open window
that holds it; a segment tree indexed by remaining capacity finds that window in
log2(window) steps. The ids are joined back by the number. No task and no driver ever
holds all tails.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bpe import model
from .common import lean, write_shared

#: Tails that are packed together, and tails that a task is meant to get.
RUN_TAILS = 65_536
TASK_TAILS = 20_000
#: Bit of a sequence id that says that the sequence is one full window.
FULL = 1 << 62


class OpenWindows:
    """Windows by what they can still take: a segment tree over the capacities 1..size."""

    def __init__(self, size: int):
        self.width = 1 << size.bit_length()
        self.count = [0] * (2 * self.width)
        self.windows: list[list[int]] = [[] for _ in range(self.width)]

    def put(self, window: int, room: int) -> None:
        if room:
            self.windows[room].append(window)
            k = room + self.width
            while k:
                self.count[k] += 1
                k >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """The window with the least room of at least ``need``, and that room; it leaves the tree."""
        k = need + self.width
        if not self.count[k]:
            while k > 1 and (k & 1 or not self.count[k + 1]):
                k >>= 1
            if k <= 1:
                return None
            k += 1
            while k < self.width:
                k = 2 * k + (not self.count[2 * k])
        room = k - self.width
        while k:
            self.count[k] -= 1
            k >>= 1
        return self.windows[room].pop(), room


def best_fit_decreasing(lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Window number and offset of each length; windows count from 0 and hold ``size``."""
    window, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    tree, n = OpenWindows(size), 0
    for k in np.argsort(-lengths, kind="stable").tolist():
        need = int(lengths[k])
        if (found := tree.take(need)) is None:
            at, room, n = n, size, n + 1
        else:
            at, room = found
        window[k], offset[k] = at, size - room
        tree.put(at, room - need)
    return window, offset


def cut_documents(df: DataFrame, vocabulary: str, size: int = 2048, end_id: int = 1, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, piece, start, length, doc_tokens, ids): each document's ids and then ``end_id``, cut into full windows and a tail.

    ``ids`` holds a piece's ids as little-endian unsigned 32-bit values, ``piece`` numbers
    the pieces: task and count within it, so a task that is run again numbers alike. A
    null text counts as empty and gives the one id ``end_id``. Rows are taken one by one:
    repeated and null keys stay. Other columns are left out. An empty table gives an
    empty one.
    """
    kind = df.schema[key].dataType.simpleString()
    names = ["key", "piece", "start", "length", "doc_tokens", "ids"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, end, first = model(vocabulary), np.array([end_id], "<u4").tobytes(), TaskContext.get().partitionId() << 40
        for batch in batches:
            row, start, length, total, pieces, held = [], [], [], [], [], 0
            for k, ids in enumerate(bpe.encode(batch.column(1).to_pylist())):
                packed = ids.tobytes() + end
                n = len(packed) // 4
                for at in range(0, n, size):
                    row.append(k)
                    start.append(at)
                    length.append(min(size, n - at))
                    total.append(n)
                    pieces.append(packed[4 * at : 4 * (at + size)])
                held += len(packed)
                if held > 4_000_000 or k == batch.num_rows - 1:
                    numbers = pa.array(np.arange(first, first + len(row)))
                    first += len(row)
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row)), numbers, *[pa.array(x, pa.int64()) for x in (start, length, total)], pa.array(pieces, pa.binary())], names=names)
                    row, start, length, total, pieces, held = [], [], [], [], [], 0

    rows = df.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return rows.mapInArrow(lean(run), f"key {kind}, piece long, start long, length long, doc_tokens long, ids binary").withColumnRenamed("key", key)


def pack_pieces(pieces: DataFrame, n_tails: int, size: int = 2048, length: str = "length", order: tuple[str, ...] = ("piece",)) -> DataFrame:
    """The pieces with ``sequence_id`` and ``offset``; any other columns are carried along.

    ``n_tails`` is about how many pieces are shorter than ``size`` and sets the number of
    tasks. A sequence id is unique and made of the task and a count within it. Pieces are
    sorted by ``order`` within a task, so a task that is run again packs alike. Columns
    named like the two new ones are replaced. Pieces longer than ``size`` are an error.
    """
    pieces = pieces.drop("sequence_id", "offset")
    schema = T.StructType([*pieces.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    at = pieces.columns.index(length)

    def numbered(table: pa.Table, window: np.ndarray, offset: np.ndarray, first: int) -> list[pa.RecordBatch]:
        return table.append_column("sequence_id", pa.array(window + first)).append_column("offset", pa.array(offset)).to_batches(max_chunksize=10_000)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, held, rows = TaskContext.get().partitionId() << 40, [], 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows >= RUN_TAILS:
                table = pa.Table.from_batches(held)
                window, offset = best_fit_decreasing(table.column(at).to_numpy(), size)
                yield from numbered(table, window, offset, first)
                first, held, rows = first + int(window.max()) + 1, [], 0
        if rows:
            table = pa.Table.from_batches(held)
            window, offset = best_fit_decreasing(table.column(at).to_numpy(), size)
            yield from numbered(table, window, offset, first)

    tasks = max(1, -(-n_tails // TASK_TAILS))
    dealt = pieces.repartition(tasks, F.xxhash64(*order)).sortWithinPartitions(*order)
    return dealt.mapInArrow(lean(run), schema)


def place_pieces(cut: DataFrame, size: int = 2048, heavy: tuple[str, ...] = ("ids",)) -> DataFrame:
    """Stored pieces of ``cut_documents`` with ``sequence_id`` and ``offset``.

    Full windows stay where they are. Of the tails all but the ``heavy`` columns are packed;
    those are joined back by ``piece``.
    """
    full = cut.filter(F.col("length") == size).withColumns({"sequence_id": F.col("piece").bitwiseOR(F.lit(FULL)), "offset": F.lit(0).cast("long")})
    tails = cut.filter(F.col("length") < size)
    n, heavy = tails.count(), [c for c in heavy if c in cut.columns]
    if not heavy:
        return full.unionByName(pack_pieces(tails, n, size))
    places = pack_pieces(tails.select("piece", "length"), n, size).drop("length")
    return full.unionByName(tails.join(places, "piece"))


def pack_documents(df: DataFrame, vocabulary: str, size: int = 2048, end_id: int = 1, text: str = "text", key: str = "doc_id") -> DataFrame:
    """All documents in sequences of at most ``size`` ids: the pieces of ``cut_documents`` with their places.

    The pieces are written to the shared folder once, so each text is encoded once.
    """
    cut = write_shared(cut_documents(df, vocabulary, size, end_id, text, key), "pieces")
    return place_pieces(cut, size).select(key, "start", "length", "doc_tokens", "ids", "sequence_id", "offset")
