"""Rolling indicators per symbol over range frames of event time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import expressions as E
from .frames import BLOCK_ROWS, Over, decayed_sums, deviation, difference, least, mean, most, numbered, rolling, rolling_rows, total, with_previous

TIE = ("offset", "event_id")


def _trend(value: str, mean: str) -> F.Column:
    return F.when(F.col(value) > F.col(mean), "up").when(F.col(value) < F.col(mean), "down").otherwise("neutral")


def averages(price: str, volume: str, windows: dict[str, float]) -> dict[str, Over]:
    return {f"sma_{n}": mean(price, s) for n, s in windows.items()} | {f"volume_ma_{n}": mean(volume, s) for n, s in windows.items()}


def moving_averages(df: DataFrame, *, symbol: str = "symbol", ts: str = "processing_timestamp", price: str = "current_price", volume: str = "volume", windows: dict[str, float] | None = None, frame: str = "range", tie: tuple[str, ...] = TIE, bucket: float | None = None) -> DataFrame:
    """Means of price and volume over each window: ``sma_<name>`` and ``volume_ma_<name>``.

    Windows are seconds, or numbers of rows with ``frame="rows"``.
    """
    windows = windows or {"5min": E.SHORT, "20min": E.LONG}
    if frame == "rows":
        return rolling_rows(df, lambda d, add: add(d, averages(price, volume, windows)), reach=int(max(windows.values())), symbol=symbol, ts=ts, tie=tie, bucket=bucket)
    return rolling(df, lambda d, add: add(d, averages(price, volume, windows)), lookback=max(windows.values()), symbol=symbol, ts=ts, bucket=bucket)


def price_trend(df: DataFrame, *, price: str = "current_price", volume: str = "volume", window: str = "5min") -> DataFrame:
    """up, down or neutral against the means of ``moving_averages``."""
    return df.withColumns({f"price_trend_{window}": _trend(price, f"sma_{window}"), "volume_trend": _trend(volume, f"volume_ma_{window}")})


def with_moves(df: DataFrame, *, symbol: str, ts: str, price: str, tie: tuple[str, ...] = TIE, bucket: float | None = None) -> DataFrame:
    """Gain and loss against the tick before, 0 on the first."""
    d = with_previous(df, price, "_last", symbol=symbol, ts=ts, tie=tie, bucket=bucket)
    change = F.col(price) - F.col("_last")
    return d.withColumns({"_gain": F.when(change > 0, change).otherwise(0.0), "_loss": F.when(change < 0, -change).otherwise(0.0)}).drop("_last")


def moves(window: float = E.RSI) -> dict[str, Over]:
    return {"_up": mean("_gain", window), "_down": mean("_loss", window)}


def finish_rsi(d: DataFrame) -> DataFrame:
    strength = 100 - 100 / (1 + F.try_divide(F.col("_up"), F.col("_down")))
    return d.withColumn("rsi_14", F.when(F.col("_down") == 0, 100.0).otherwise(strength)).drop("_up", "_down")


def rsi(df: DataFrame, *, symbol: str = "symbol", ts: str = "processing_timestamp", price: str = "current_price", window: float = E.RSI, frame: str = "range", tie: tuple[str, ...] = TIE, bucket: float | None = None) -> DataFrame:
    """Relative strength of mean gains to mean losses; 100 where nothing was lost."""
    d = with_moves(df, symbol=symbol, ts=ts, price=price, tie=tie, bucket=bucket)
    if frame == "rows":
        d = rolling_rows(d, lambda x, add: finish_rsi(add(x, moves(window))), reach=int(window), symbol=symbol, ts=ts, tie=tie, bucket=bucket)
    else:
        d = rolling(d, lambda x, add: finish_rsi(add(x, moves(window))), lookback=window, symbol=symbol, ts=ts, bucket=bucket)
    return d.drop("_gain", "_loss")


def bands(price: str, window: float = E.BOLLINGER) -> dict[str, Over]:
    return {"bollinger_middle": mean(price, window), "_dev": deviation(price, window)}


def finish_bands(d: DataFrame, width: float = 2.0) -> DataFrame:
    return d.withColumns({"bollinger_upper": F.col("bollinger_middle") + width * F.col("_dev"), "bollinger_lower": F.col("bollinger_middle") - width * F.col("_dev")}).drop("_dev")


def bollinger_bands(df: DataFrame, *, symbol: str = "symbol", ts: str = "processing_timestamp", price: str = "current_price", window: float = E.BOLLINGER, width: float = 2.0, frame: str = "range", tie: tuple[str, ...] = TIE, bucket: float | None = None) -> DataFrame:
    """Mean and ``width`` sample deviations around it; a single tick has no bands."""
    if frame == "rows":
        return rolling_rows(df, lambda d, add: finish_bands(add(d, bands(price, window)), width), reach=int(window), symbol=symbol, ts=ts, tie=tie, bucket=bucket)
    return rolling(df, lambda d, add: finish_bands(add(d, bands(price, window)), width), lookback=window, symbol=symbol, ts=ts, bucket=bucket)


def bollinger_position(df: DataFrame, *, price: str = "current_price") -> DataFrame:
    """Where the price lies between the bands: 0 at the lower, 1 at the upper."""
    span = F.col("bollinger_upper") - F.col("bollinger_lower")
    return df.withColumn("bollinger_position", F.try_divide(F.col(price) - F.col("bollinger_lower"), span))


def with_traded(d: DataFrame, price: str, volume: str) -> DataFrame:
    return d.withColumn("_traded", F.col(price) * F.col(volume))


def turnover(volume: str, window: float = E.VWAP) -> dict[str, Over]:
    return {"_turnover": total("_traded", window), "_total": total(volume, window)}


def finish_vwap(d: DataFrame, price: str, volume: str) -> DataFrame:
    return d.withColumn("vwap", F.when(F.col(volume) > 0, F.try_divide("_turnover", "_total")).otherwise(F.col(price))).drop("_turnover", "_total")


def rolling_vwap(df: DataFrame, *, symbol: str = "symbol", ts: str = "processing_timestamp", price: str = "current_price", volume: str = "volume", window: float = E.VWAP, bucket: float | None = None) -> DataFrame:
    """Price weighted by volume; the price itself where the tick has no volume."""
    traded = with_traded(df, price, volume)
    return rolling(traded, lambda d, add: finish_vwap(add(d, turnover(volume, window)), price, volume), lookback=window, symbol=symbol, ts=ts, bucket=bucket).drop("_traded")


def lines(price: str, fast: float = E.MACD_FAST, slow: float = E.MACD_SLOW, signal: float = E.MACD_SIGNAL) -> dict[str, Over]:
    """The signal is a mean of the line, which is a difference of two means."""
    return {"_fast": mean(price, fast), "_slow": mean(price, slow), "macd": difference("_fast", "_slow"), "macd_signal": mean("macd", signal)}


def finish_macd(d: DataFrame) -> DataFrame:
    return d.withColumn("macd_histogram", F.col("macd") - F.col("macd_signal")).drop("_fast", "_slow")


def ema(df: DataFrame, means: dict[str, tuple[str, int]], *, symbol: str, at: str, block: int = BLOCK_ROWS) -> DataFrame:
    """Exponential means, ``into: (column, n)``, of columns that are never null over a symbol's rows, numbered from 0; the first value seeds each."""
    share = lambda value, n: F.when(F.col(at) == 0, F.col(value)).otherwise(F.lit(2.0 / (n + 1)) * F.col(value)).cast("double")
    d = df.withColumns({f"_share_{into}": share(*m) for into, m in means.items()})
    return decayed_sums(d, {into: (f"_share_{into}", 1 - 2.0 / (n + 1)) for into, (_, n) in means.items()}, symbol=symbol, at=at, block=block).drop(*[f"_share_{into}" for into in means])


def macd(df: DataFrame, *, symbol: str = "symbol", ts: str = "processing_timestamp", price: str = "current_price", method: str = "range_mean", fast: float = E.MACD_FAST, slow: float = E.MACD_SLOW, signal: float = E.MACD_SIGNAL, periods: tuple[int, int, int] = (12, 26, 9), tie: tuple[str, ...] = TIE, bucket: float | None = None) -> DataFrame:
    """MACD, its signal and their difference.

    ``range_mean`` takes means over seconds. ``ema`` takes exponential means of the rows for
    the three ``periods``, seeded with the symbol's first price; rows without a price count
    for nothing and have none.
    """
    if method == "range_mean":
        return rolling(df, lambda d, add: finish_macd(add(d, lines(price, fast, slow, signal))), lookback=slow + signal, symbol=symbol, ts=ts, bucket=bucket)
    f, s, g = periods
    bare = df.filter(F.col(price).isNull()).withColumns({c: F.lit(None).cast("double") for c in ("macd", "macd_signal", "macd_histogram")})
    d = numbered(df.filter(F.col(price).isNotNull()), "_at", symbol=symbol, ts=ts, tie=tie, bucket=bucket)
    d = ema(d, {"_fast": (price, f), "_slow": (price, s)}, symbol=symbol, at="_at")
    d = ema(d.withColumn("macd", F.col("_fast") - F.col("_slow")), {"macd_signal": ("macd", g)}, symbol=symbol, at="_at")
    return d.withColumn("macd_histogram", F.col("macd") - F.col("macd_signal")).select(bare.columns).union(bare)


def usual(price: str, volume: str, window: float = E.ANOMALY, exclude_current: bool = False) -> dict[str, Over]:
    until = -1 if exclude_current else 0
    return {"_pm": mean(price, window, until), "_ps": deviation(price, window, until), "_vm": mean(volume, window, until), "_vs": deviation(volume, window, until)}


def finish_anomalies(d: DataFrame, price: str, volume: str, z: float = E.Z_THRESHOLD) -> DataFrame:
    score = lambda x, m, s: F.when(F.col(s).isNull() | (F.col(s) == 0), 0.0).otherwise((F.col(x) - F.col(m)) / F.col(s))
    d = d.withColumns({"price_zscore": score(price, "_pm", "_ps"), "volume_zscore": score(volume, "_vm", "_vs")}).drop("_pm", "_ps", "_vm", "_vs")
    p, v = F.abs("price_zscore"), F.abs("volume_zscore")
    return d.withColumns({"is_price_anomaly": p > z, "is_volume_anomaly": v > z, "anomaly_score": F.greatest(p, v), "volume_anomaly": v > z})


def price_anomalies(df: DataFrame, *, symbol: str = "symbol", ts: str = "processing_timestamp", price: str = "current_price", volume: str = "volume", window: float = E.ANOMALY, z_threshold: float = E.Z_THRESHOLD, exclude_current: bool = False, bucket: float | None = None) -> DataFrame:
    """z-scores of price and volume in their window, and flags beyond the threshold."""
    return rolling(df, lambda d, add: finish_anomalies(add(d, usual(price, volume, window, exclude_current)), price, volume, z_threshold), lookback=window, symbol=symbol, ts=ts, bucket=bucket)


def rsi_signal(df: DataFrame, *, rsi: str = "rsi_14", overbought: float = 70.0, oversold: float = 30.0) -> DataFrame:
    return df.withColumn("rsi_signal", F.when(F.col(rsi) > overbought, "overbought").when(F.col(rsi) < oversold, "oversold").otherwise("neutral"))


def support_resistance(df: DataFrame, *, symbol: str = "symbol", ts: str = "processing_timestamp", high: str = "high_price", low: str = "low_price", window: float = E.LONG, bucket: float | None = None) -> DataFrame:
    """The lowest low and the highest high of the window."""
    build = lambda d, add: add(d, {"support": least(low, window), "resistance": most(high, window)})
    return rolling(df, build, lookback=window, symbol=symbol, ts=ts, bucket=bucket)


def latest_per_key(df: DataFrame, key: list[str] | str, order: list[str]) -> DataFrame:
    """The row of each key that comes last by ``order`` (nulls first); give a tie-breaker in it.

    An aggregate rather than a numbered window, so each task first reduces its own rows.
    """
    keys = [key] if isinstance(key, str) else key
    rest = [c for c in df.columns if c not in keys]
    last = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_row")) if rest else df.select(*keys).distinct()
    return last.select([F.col(c) if c in keys else F.col("_row")[c].alias(c) for c in df.columns])
