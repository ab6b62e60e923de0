"""Frames over the ticks before, and previous values, per symbol, also where one symbol has most of the rows.

Partitioning by symbol alone gives a hot symbol to one task. With ``bucket`` seconds, time
is cut into buckets and a row also goes to the buckets whose rows look back at it, so
(symbol, bucket) is the group and every frame is whole. A row is copied at most
ceil(lookback / bucket) times, a copy has the values of the frames alone, and only a bucket's
own rows leave it. Spark deals and groups the rows; one exchange serves all frames.

A sliding window would aggregate each frame anew, which grows with the square of the ticks
in a frame. Here a group's aggregates over 1, 2, 4, 8 ... rows from each row on are formed
one after the other, and a frame is put together of one part for each bit of its
number of rows. Parts are joined, never subtracted, so nothing cancels: equal values have
no deviation.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.expressions import micros


class Over(NamedTuple):
    """An aggregate of a column over the ticks from ``length`` before up to ``until`` (0 or -1) microseconds or rows after."""

    kind: str
    value: str
    length: float
    until: int = 0
    less: str | None = None

    def sources(self) -> list[str]:
        return [self.value] if self.less is None else [self.value, self.less]


def mean(value: str, length: float, until: int = 0) -> Over:
    return Over("mean", value, length, until)


def total(value: str, length: float, until: int = 0) -> Over:
    return Over("total", value, length, until)


def deviation(value: str, length: float, until: int = 0) -> Over:
    """The sample deviation; null for fewer than two values."""
    return Over("deviation", value, length, until)


def least(value: str, length: float, until: int = 0) -> Over:
    return Over("least", value, length, until)


def most(value: str, length: float, until: int = 0) -> Over:
    return Over("most", value, length, until)


def difference(value: str, less: str) -> Over:
    """Row by row, no aggregate: what is framed next may be a difference of two means."""
    return Over("difference", value, 0, 0, less)


#: ``add(d, {column: Over})`` adds columns to d; an Over may be of another one's column.
Add = Callable[[DataFrame, dict[str, Over]], DataFrame]
#: Values in the order of time, and which of them are not null.
Values = tuple[np.ndarray, np.ndarray]


def add_frames(d: DataFrame, overs: dict[str, Over], *, keys: list[str], at: Column, unit: int, own: Column | None = None) -> DataFrame:
    """Columns of aggregates over frames of the groups of ``keys`` in the order of ``at``; ``unit`` of it is a length of 1.

    Rows that are not a group's ``own`` are seen by its frames and left out of the result.
    """
    inputs = list(dict.fromkeys(v for o in overs.values() for v in o.sources() if v not in overs or overs[v] is o))
    kept = [c for c in d.columns if c not in keys[1:] and c not in overs]
    mine = F.lit(True) if own is None else own
    rows = d.select(*[F.col(k).alias(f"_key{j}") for j, k in enumerate(keys)], at.alias("_at"), mine.alias("_own"), *[F.col(v).cast("double").alias(f"_x{j}") for j, v in enumerate(inputs)], F.when(mine, F.struct(*kept)).alias("_row"))
    lengths = {c: o._replace(length=int(o.length * unit)) for c, o in overs.items()}

    def framed(group: pa.Table) -> pa.Table:
        known, at = _values(group["_at"], 0)
        order = np.lexsort((at, ~known))  # rows without a time are each other's frame
        at, timed = at[order], int(known.sum())
        found = {}
        for j, v in enumerate(inputs):
            ok, x = _values(group[f"_x{j}"], 0.0)
            found[v] = (x[order], ok[order])
        _fill(found, lengths, at, timed)
        own = group["_own"].to_numpy()
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        place = place[own]
        columns = [pa.array(found[c][0][place], mask=~found[c][1][place]) for c in lengths]
        return pa.table([group["_row"].filter(group["_own"]), *columns], names=["_row", *lengths])

    schema = T.StructType([T.StructField("_row", rows.schema["_row"].dataType), *[T.StructField(c, T.DoubleType()) for c in overs]])
    out = rows.groupBy(*[f"_key{j}" for j in range(len(keys))]).applyInArrow(framed, schema)
    return out.select(*[F.col("_row")[c].alias(c) for c in kept], *overs)


def _values(column: pa.ChunkedArray, null) -> tuple[np.ndarray, np.ndarray]:
    """Which are not null, and the values with ``null`` in place of the others."""
    return column.is_valid().to_numpy(), column.fill_null(null).to_numpy()


def _fill(found: dict[str, Values], overs: dict[str, Over], at: np.ndarray, timed: int) -> None:
    """Add each Over's column to ``found``, those of one value together, and after what they are of."""
    bounds, left = {}, dict(overs)
    for o in overs.values():
        f = (o.length, o.until)
        if o.less is None and f not in bounds:
            begin, end = np.full(len(at), timed), np.full(len(at), len(at))
            begin[:timed] = np.searchsorted(at[:timed], at[:timed] - o.length, "left")
            end[:timed] = np.searchsorted(at[:timed], at[:timed] + o.until, "right")
            bounds[f] = begin, np.maximum(begin, end)
    with np.errstate(all="ignore"):  # what is divided by no rows is null
        done = {}
        while left:
            ready = {c: o for c, o in left.items() if all(v in found for v in o.sources())}
            for value in dict.fromkeys(o.value for o in ready.values() if o.less is None):
                done |= _aggregates(*found[value], {c: (o.kind, *bounds[o.length, o.until]) for c, o in ready.items() if o.value == value and o.less is None})
            for c, o in ready.items():
                if o.less is not None:
                    (x, a), (y, b) = found[o.value], found[o.less]
                    done[c] = x - y, a & b
            found |= done
            left = {c: o for c, o in left.items() if c not in ready}


def _aggregates(x: np.ndarray, ok: np.ndarray, wanted: dict[str, tuple[str, np.ndarray, np.ndarray]]) -> dict[str, Values]:
    """Aggregates of one value, each (kind, begins, ends): its frames' places from a begin up to before an end."""
    place, x = np.concatenate([[0], np.cumsum(ok)]), x[ok]
    change = np.ones(len(x), bool)
    change[1:] = x[1:] != x[:-1]
    run = np.maximum.accumulate(np.where(change, np.arange(len(x)), 0)) if len(x) else np.zeros(0, np.int64)
    x, run = (x, run) if len(x) else (np.zeros(1), np.zeros(1, np.int64))
    kinds = {k for k, _, _ in wanted.values()}
    frames = {}
    for _, begin, end in wanted.values():
        if id(begin) not in frames:
            a, b = place[begin], place[end]
            # begins of what is left, rows of it, rows so far; sum, squares, least and most so far
            frames[id(begin)] = [a.copy(), b - a, np.zeros(len(a)), np.zeros(len(a)), np.zeros(len(a)), np.full(len(a), np.nan), np.full(len(a), -np.inf)]
    longest = max(int(f[1].max(initial=0)) for f in frames.values())
    total, squares, low, high, size = x, np.zeros(len(x)), x, x, 1
    while size <= longest:
        for f in frames.values():
            rows = np.flatnonzero(f[1] & size)
            p, n = f[0][rows], f[2][rows]
            if "deviation" in kinds:
                f[4][rows] += squares[p] + (f[3][rows] / np.maximum(n, 1) - total[p] / size) ** 2 * (n * size / (n + size))
            f[3][rows] += total[p]
            if "least" in kinds:
                f[5][rows] = np.fmin(f[5][rows], low[p])
            if "most" in kinds:
                f[6][rows] = np.maximum(f[6][rows], high[p])
            f[0][rows] += size
            f[2][rows] += size
        if 2 * size <= longest:
            if "deviation" in kinds:
                squares = squares[:-size] + squares[size:] + (total[:-size] - total[size:]) ** 2 / (2 * size)
            total = total[:-size] + total[size:]
            low = np.fmin(low[:-size], low[size:]) if "least" in kinds else low
            high = np.maximum(high[:-size], high[size:]) if "most" in kinds else high
        size *= 2
    out = {}
    for c, (kind, begin, end) in wanted.items():
        n, sums, squares, low, high = frames[id(begin)][2:]
        last = np.maximum(place[end] - 1, 0)
        same = run[last] <= place[begin]  # one value in all rows of the frame
        value = {"mean": np.where(same, x[last], sums / n), "total": sums, "deviation": np.where(same, 0.0, np.sqrt(squares / (n - 1))), "least": low, "most": high}[kind]
        out[c] = value, n > (kind == "deviation")
    return out


def rolling(df: DataFrame, build: Callable[[DataFrame, Add], DataFrame], *, lookback: float, symbol: str = "symbol", ts: str = "processing_timestamp", bucket: float | None = None) -> DataFrame:
    """``build(d, add)`` adds columns; ``add(d, {column: Over})`` those over frames of seconds, all with one exchange.

    ``lookback`` is the longest reach of the columns in seconds, nested ones added.
    """
    us = micros(ts)

    def add(x: DataFrame, overs: dict[str, Over]) -> DataFrame:
        if bucket is None:
            return add_frames(x, overs, keys=[symbol], at=us, unit=1_000_000)
        size, reach = int(bucket * 1_000_000), int(lookback * 1_000_000)
        of = lambda us: F.floor(us / F.lit(size)).cast("long")
        x = x.withColumn("_bucket", F.explode_outer(F.sequence(of(us), of(us + reach))))
        return add_frames(x, overs, keys=[symbol, "_bucket"], at=us, unit=1_000_000, own=F.col("_bucket").eqNullSafe(of(us)))

    out = build(df, add)
    return out.select(*df.columns, *[c for c in out.columns if c not in df.columns])


#: Rows of one symbol that are dealt to one task.
BLOCK_ROWS = 20_000


def numbered(df: DataFrame, into: str, *, symbol: str = "symbol", ts: str = "processing_timestamp", tie: tuple[str, ...] = (), bucket: float | None = None) -> DataFrame:
    """The place of each row among its symbol's, from 0, by time and then by the tie-breakers.

    With ``bucket``, rows are numbered within (symbol, bucket of seconds), and from a table of
    one row a bucket within the symbol.
    """
    order = [micros(ts), *[c for c in tie if c in df.columns]]
    if bucket is None:
        return df.withColumn(into, F.row_number().over(Window.partitionBy(symbol).orderBy(*order)).cast("long") - 1)
    size = int(bucket * 1_000_000)
    d = df.withColumn("_bucket", F.floor(micros(ts) / F.lit(size)).cast("long"))
    sizes = d.groupBy(symbol, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(symbol).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(F.col(symbol).alias("_symbol"), F.col("_bucket").alias("_of"), F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    d = d.withColumn("_place", F.row_number().over(Window.partitionBy(symbol, "_bucket").orderBy(*order)))
    d = d.join(sizes, F.col(symbol).eqNullSafe(F.col("_symbol")) & F.col("_bucket").eqNullSafe(F.col("_of")))
    return d.withColumn(into, F.col("_before") + F.col("_place") - 1).drop("_symbol", "_of", "_before", "_bucket", "_place")


def rolling_rows(df: DataFrame, build: Callable[[DataFrame, Add], DataFrame], *, reach: int, symbol: str = "symbol", ts: str = "processing_timestamp", tie: tuple[str, ...] = (), bucket: float | None = None, block: int = BLOCK_ROWS) -> DataFrame:
    """``build(d, add)`` adds columns; ``add(d, {column: Over})`` those over the last ``length`` rows of the symbol.

    ``reach`` is how many rows the columns look back at, nested ones added. With
    ``bucket``, ``block`` rows of a symbol and copies of the ``reach`` before them make a
    partition, so a hot symbol goes to many tasks.
    """
    of, place = lambda k: F.expr(f"{k} div {block}"), F.col("_k")

    def add(x: DataFrame, overs: dict[str, Over]) -> DataFrame:
        overs = {c: o._replace(length=int(o.length) - 1) for c, o in overs.items()}
        if bucket is None:
            return add_frames(x, overs, keys=[symbol], at=place, unit=1)
        x = x.withColumn("_part", F.explode(F.sequence(of("_k"), of(f"(_k + {reach})"))))
        return add_frames(x, overs, keys=[symbol, "_part"], at=place, unit=1, own=F.col("_part") == of("_k"))

    out = build(numbered(df, "_k", symbol=symbol, ts=ts, tie=tie, bucket=bucket), add)
    return out.select(*df.columns, *[c for c in out.columns if c not in (*df.columns, "_k")])


def decayed_sums(df: DataFrame, sums: dict[str, tuple[str, float]], *, symbol: str = "symbol", at: str, block: int = BLOCK_ROWS) -> DataFrame:
    """For each row and each ``into: (value, decay)``, the sum over the symbol's rows up to it of value * decay ** (rows between).

    ``at`` numbers the rows of a symbol from 0. Within a block of them, values are divided by
    the decay since the block's start, summed as they come and multiplied again; only
    as many rows make a block as doubles have room for. A block's own sum and its decay
    are one element of the same sum over blocks, which the next block's rows start from.
    """
    if not all(0 < q < 1 for _, q in sums.values()):
        raise ValueError("a decay lies between 0 and 1")
    size = max(1, min(block, *(int(-500 / math.log(q)) for _, q in sums.values())))
    own = f"{at}_block"
    since, power = F.expr(f"{at} % {size}"), lambda q, n: F.exp(F.lit(math.log(q)) * n)
    grow = Window.partitionBy(symbol, own).orderBy(at).rowsBetween(Window.unboundedPreceding, 0)
    d = df.withColumn(own, F.expr(f"{at} div {size}"))
    d = d.withColumns({into: F.sum(F.col(v) / power(q, since)).over(grow) * power(q, since) for into, (v, q) in sums.items()})
    # a block's sums as they are at its last place; all blocks but a symbol's last are full
    ends = d.groupBy(symbol, own).agg(*[F.max_by(into, at).alias(into) for into in sums])
    longer = {into: (into, q**size) for into, (_, q) in sums.items() if q**size > 1e-40}  # what else is older is beyond the precision of a double
    if longer:
        ends = decayed_sums(ends, longer, symbol=symbol, at=own, block=block)
    ends = ends.select(F.col(symbol).alias("_symbol"), (F.col(own) + 1).alias("_next"), *[F.col(into).alias(f"_before_{into}") for into in sums])
    d = d.join(ends, F.col(symbol).eqNullSafe(F.col("_symbol")) & (F.col(own) == F.col("_next")), "left")
    whole = {into: F.col(into) + F.coalesce(F.col(f"_before_{into}") * power(q, since + 1), F.lit(0.0)) for into, (_, q) in sums.items()}
    return d.withColumns(whole).drop(own, "_symbol", "_next", *[f"_before_{into}" for into in sums])


def with_previous(df: DataFrame, value: str | Column, into: str, *, symbol: str = "symbol", ts: str = "processing_timestamp", tie: tuple[str, ...] = (), bucket: float | None = None) -> DataFrame:
    """The value of the row before, by time and then by the tie-breakers; null on a symbol's first row.

    With ``bucket``, the row before is sought within (symbol, bucket); a bucket's first row
    takes the last value of the symbol's bucket before, from a table of one row a bucket.
    """
    value = F.col(value) if isinstance(value, str) else value
    tie_cols = [c for c in tie if c in df.columns]
    if bucket is None:
        return df.withColumn(into, F.lag(value).over(Window.partitionBy(symbol).orderBy(micros(ts), *tie_cols)))
    size = int(bucket * 1_000_000)
    d = df.withColumn("_bucket", F.floor(micros(ts) / F.lit(size)).cast("long"))
    place = F.struct(micros(ts), *tie_cols)
    ends = d.groupBy(symbol, "_bucket").agg(F.max_by(F.struct(value.alias("v")), place).alias("_end"))
    ends = ends.select(symbol, "_bucket", F.lag("_end").over(Window.partitionBy(symbol).orderBy("_bucket")).alias("_bucket_before"))
    w = Window.partitionBy(symbol, "_bucket").orderBy(micros(ts), *tie_cols)
    d = d.withColumn("_row_before", F.lag(F.struct(value.alias("v"))).over(w))
    d = d.join(ends, [symbol, "_bucket"], "left")
    return d.withColumn(into, F.coalesce("_row_before", "_bucket_before")["v"]).drop("_row_before", "_bucket_before", "_bucket")
