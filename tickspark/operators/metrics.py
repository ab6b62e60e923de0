"""Row-wise metrics, classes, flags and validation of ticks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import expressions as E
from .frames import with_previous


def require_columns(df: DataFrame, *names: str) -> DataFrame:
    """The frame itself; ValueError where a column is missing."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def price_metrics(df: DataFrame, *, price: str = "current_price", previous: str = "previous_close", change: str = "change", high: str = "high_price", low: str = "low_price", volume: str = "volume") -> DataFrame:
    """Absolute change, range in percent of the price, momentum against the close before, and the quality score."""
    p, c, h, lo = (F.col(x) for x in (price, previous, high, low))
    return df.withColumns(
        {
            "price_change_abs": F.abs(F.col(change)),
            "price_volatility": F.when(p > 0, (h - lo) / p * 100).otherwise(0.0),
            "price_momentum": F.when(c > 0, (p - c) / c).otherwise(0.0),
            "data_quality_score": E.quality_score(price, high, low, volume),
        }
    )


def volume_metrics(df: DataFrame, *, volume: str = "volume", average: str = "volume_ma_5min", vwap: str = "vwap", limits: dict[str, float] = E.VOLUME_RATIOS) -> DataFrame:
    """Volume against its mean, its class, and the weighted price; needs moving averages and vwap first."""
    require_columns(df, volume, average, vwap)
    r = F.when(F.col(average) > 0, F.col(volume) / F.col(average)).otherwise(1.0)
    df = df.withColumn("volume_ratio", r).withColumn("volume_weighted_price", F.col(vwap))
    r = F.col("volume_ratio")
    kind = F.when(r > limits["high"], "high").when(r > limits["above_average"], "above_average").when(r < limits["low"], "low").otherwise("normal")
    return df.withColumn("volume_category", kind)


def classify_market(df: DataFrame, *, price: str = "current_price", volume: str = "volume", ts: str = "processing_timestamp", turnover: dict[str, float] = E.TURNOVER, sizes: dict[str, int] = E.VOLUME_SIZES, size_column: str = "volume_size_class") -> DataFrame:
    """Class of the turnover, session by hour, and class of the volume's size.

    ``size_column="volume_category"`` gives the size class the name of the ratio's class.
    """
    t, v = F.col(price) * F.col(volume), F.col(volume)
    return df.withColumns(
        {
            "market_cap_category": F.when(t > turnover["large"], "large").when(t > turnover["medium"], "medium").otherwise("small"),
            "trading_session": E.hour_session(ts),
            size_column: F.when(v > sizes["high"], "high").when(v > sizes["medium"], "medium").when(v > 0, "low").otherwise("unknown"),
        }
    )


def quality_flags(df: DataFrame, *, price: str = "current_price", high: str = "high_price", low: str = "low_price", volume: str = "volume") -> DataFrame:
    """Each quality rule as a flag of its own, and the score."""
    p, h, lo, v = (F.col(x) for x in (price, high, low, volume))
    return df.withColumns(
        {
            "has_null_price": p.isNull(),
            "has_zero_price": p == 0,
            "has_negative_price": p < 0,
            "has_null_volume": v.isNull(),
            "has_negative_volume": v < 0,
            "price_range_valid": (h >= lo) & (p >= lo) & (p <= h),
            "data_quality_score": E.quality_score(price, high, low, volume),
        }
    )


def market_context(df: DataFrame, *, ts: str = "processing_timestamp") -> DataFrame:
    """Calendar and session of a tick."""
    h = F.hour(ts)
    return df.withColumns(
        {
            "trading_day": F.date_format(ts, "yyyy-MM-dd"),
            "trading_hour": h,
            "trading_minute": F.minute(ts),
            "is_market_hours": (h >= 9) & (h < 16),
            "market_session_detailed": E.detailed_session(ts),
            "day_of_week": F.dayofweek(ts),
            "is_weekend": F.dayofweek(ts).isin(1, 7),
        }
    )


def ensure_tick_columns(df: DataFrame, *, symbol: str = "symbol", ts: str = "processing_timestamp", tie: tuple[str, ...] = ("offset", "event_id"), bucket: float | None = None) -> DataFrame:
    """Add what is missing: price from the close or 0, range from the price, previous close, producer time.

    ``bucket`` seconds spread a hot symbol over many tasks.
    """
    price = F.col("close_price") if "close_price" in df.columns else F.lit(0.0)
    if "current_price" not in df.columns:
        df = df.withColumn("current_price", price.cast("double"))
    for name in ("open_price", "high_price", "low_price"):
        if name not in df.columns:
            df = df.withColumn(name, F.col("current_price"))
    if "volume" not in df.columns:
        df = df.withColumn("volume", F.lit(0).cast("long"))
    if "previous_close" not in df.columns:
        df = with_previous(df, "current_price", "_previous", symbol=symbol, ts=ts, tie=tie, bucket=bucket)
        df = df.withColumn("previous_close", F.coalesce("_previous", "current_price")).drop("_previous")
    if "change" not in df.columns:
        df = df.withColumn("change", F.col("current_price") - F.col("previous_close"))
    if "producer_timestamp" not in df.columns:
        df = df.withColumn("producer_timestamp", F.current_timestamp())
    return df


def tick_errors(price: str = "current_price", volume: str = "volume", price_cap: float = E.PRICE_CAP, volume_cap: int = E.VOLUME_CAP) -> F.Column:
    """Why a tick is not accepted; null where it is."""
    p, v = F.col(price), F.col(volume)
    return F.when(p.isNull() | ~((p > 0) & (p < price_cap)), "price out of range").when(v.isNull() | ~((v >= 0) & (v < volume_cap)), "volume out of range")


def validate_ticks(df: DataFrame, *, symbol: str = "symbol", ts: str = "processing_timestamp", price: str = "current_price", volume: str = "volume", price_cap: float = E.PRICE_CAP, volume_cap: int = E.VOLUME_CAP) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected with ``error_reason``): 0 < price < cap and 0 <= volume < cap."""
    require_columns(df, symbol, ts, price, volume)
    return split_rejects(df, tick_errors(price, volume, price_cap, volume_cap))


def split_rejects(df: DataFrame, error: F.Column) -> tuple[DataFrame, DataFrame]:
    """(rows where ``error`` is null, the others with it as ``error_reason``)."""
    marked = df.withColumn("error_reason", error)
    return marked.filter(F.col("error_reason").isNull()).drop("error_reason"), marked.filter(F.col("error_reason").isNotNull())


def volatility_level(df: DataFrame, *, low: float, high: float, volatility: str = "price_volatility") -> DataFrame:
    """low, medium or high volatility between two thresholds that the caller sets."""
    v = F.col(volatility)
    return df.withColumn("volatility_level", F.when(v < low, "low").when(v < high, "medium").when(v.isNotNull(), "high"))
