"""Column expressions: time as integers, sessions, quality, keys, and safe conversions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The default thresholds and windows (seconds).
SHORT, LONG, RSI, BOLLINGER, VWAP = 300, 1200, 840, 1200, 300
MACD_FAST, MACD_SLOW, MACD_SIGNAL = 720, 1560, 540
ANOMALY, Z_THRESHOLD = 1200, 3.0
VOLUME_RATIOS = {"high": 2.0, "above_average": 1.5, "low": 0.5}
TURNOVER = {"large": 1_000_000.0, "medium": 100_000.0}
VOLUME_SIZES = {"high": 1_000_000, "medium": 100_000}
PRICE_BUCKET = 0.01
PRICE_CAP, VOLUME_CAP = 1_000_000.0, 1_000_000_000
MACD_CAP, NEUTRAL_RSI, NEUTRAL_MACD = 1000.0, 50.0, 0.0


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def micros(ts: str | Column) -> Column:
    """Event time in microseconds: range frames need a number, and whole seconds would lose rows."""
    return F.unix_micros(col(ts).cast("timestamp"))


def quality_score(price: str = "current_price", high: str = "high_price", low: str = "low_price", volume: str = "volume") -> Column:
    """0.0 for a price or volume that can't be, 0.7 where only the volume is missing, else 1.0.

    A null high or low makes the range test unknown, so the next rule decides.
    """
    p, h, lo, v = (F.col(c) for c in (price, high, low, volume))
    wrong = p.isNull() | (p <= 0) | (v < 0) | ~((h >= lo) & (p >= lo) & (p <= h))
    return F.when(wrong, 0.0).when(v.isNull(), 0.7).otherwise(1.0)


def hour_session(ts: str | Column) -> Column:
    """The session by hour, both ends inclusive: 9 to 16 regular, 4 to 9 before, else after."""
    h = F.hour(ts)
    return F.when(h.between(9, 16), "regular").when(h.between(4, 9), "pre_market").otherwise("after_hours")


def detailed_session(ts: str | Column) -> Column:
    """The session by hour, ends exclusive, with closed hours."""
    h = F.hour(ts)
    return F.when((h >= 4) & (h < 9), "pre_market").when((h >= 9) & (h < 16), "regular").when((h >= 16) & (h < 20), "after_hours").otherwise("closed")


def joined_key(*parts: str | Column) -> Column:
    """md5 of the parts with ``::`` between them; null where a part is null."""
    cols = [col(parts[0]).cast("string")]
    for p in parts[1:]:
        cols += [F.lit("::"), col(p).cast("string")]
    return F.md5(F.concat(*cols).cast("binary"))


def date_key(ts: str | Column) -> Column:
    return F.date_format(ts, "yyyyMMdd").cast("int")


def time_key(ts: str | Column) -> Column:
    return F.hour(ts) * 60 + F.minute(ts)


def number(text: str | Column, kind: str = "double") -> Column:
    """A number out of a string, with a trailing percent sign left out; null where it is none."""
    return F.rtrim(F.regexp_replace(F.trim(col(text)), "%$", "")).try_cast(kind)


def ratio(a: str | Column, b: str | Column) -> Column:
    """a / b, null where b is 0."""
    return F.try_divide(col(a), col(b))


def millis(ts: str | Column) -> Column:
    return F.unix_millis(col(ts).cast("timestamp"))
