"""Event-time aggregates of ticks: OHLCV bars and volume profiles, in batch or on a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import expressions as E


def _timed(df: DataFrame, ts: str, watermark: str | None) -> DataFrame:
    return df.withWatermark(ts, watermark) if watermark and df.isStreaming else df


def ohlcv_bars(df: DataFrame, *, window: str = "1 minute", slide: str | None = None, watermark: str | None = "10 minutes", symbol: str = "symbol", ts: str = "processing_timestamp", price: str = "current_price", volume: str = "volume", tie: tuple[str, ...] = ("offset", "event_id")) -> DataFrame:
    """One row for each symbol and window: open, high, low, close, volume, counts, means and spread.

    Open and close follow time and then the tie-breakers, not the order of arrival. The
    watermark counts on streams only.
    """
    order = F.struct(ts, *[c for c in tie if c in df.columns])
    p, v = F.col(price), F.col(volume)
    bars = _timed(df, ts, watermark).groupBy(symbol, F.window(ts, window, slide or window).alias("window")).agg(
        F.min_by(p, order).alias("open"),
        F.max(p).alias("high"),
        F.min(p).alias("low"),
        F.max_by(p, order).alias("close"),
        F.sum(v).alias("total_volume"),
        F.count(F.lit(1)).alias("tick_count"),
        F.avg(p).alias("avg_price"),
        F.sum(p * v).alias("_traded"),
        F.stddev_samp(p).alias("price_std"),
        F.max(ts).alias("last_update"),
    )
    return bars.select(
        symbol, "open", "high", "low", "close", "total_volume", "tick_count", "avg_price",
        E.ratio("_traded", "total_volume").alias("vwap"), "price_std", "last_update",
        (F.col("close") - F.col("open")).alias("price_change"),
        (E.ratio(F.col("close") - F.col("open"), "open") * 100).alias("price_change_percent"),
        (E.ratio("price_std", "avg_price") * 100).alias("volatility"),
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
    )


def volume_profile(df: DataFrame, *, window: str = "5 minutes", slide: str | None = None, watermark: str | None = "10 minutes", price_bucket: float = E.PRICE_BUCKET, symbol: str = "symbol", ts: str = "processing_timestamp", price: str = "current_price", volume: str = "volume") -> DataFrame:
    """Volume, ticks and mean price for each symbol, price bucket and window."""
    at = (F.floor(F.col(price) / price_bucket) * price_bucket).alias("price_bucket")
    profile = _timed(df, ts, watermark).groupBy(symbol, at, F.window(ts, window, slide or window).alias("window")).agg(F.sum(volume).alias("volume_at_price"), F.count(F.lit(1)).alias("tick_count"), F.avg(price).alias("avg_price"))
    return profile.select(symbol, "price_bucket", "volume_at_price", "tick_count", "avg_price", F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"))
