"""The three published products: prices, volumes, indicators. Enriched ticks in, contract rows out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions import expressions as E
from .metrics import require_columns

UNKNOWN = "UNKNOWN"


def have(df: DataFrame, name: str, kind: str) -> Column:
    """The column, or a null of its type where the frame lacks it."""
    return F.col(name) if name in df.columns else F.lit(None).cast(kind)


def with_product_metadata(df: DataFrame, record_type: str, *, data_layer: str = "silver", version: str = "1.0") -> DataFrame:
    return df.withColumns({"data_layer": F.lit(data_layer), "record_type": F.lit(record_type), "processing_version": F.lit(version)})


def _shaped(df: DataFrame, contract) -> DataFrame:
    return require_columns(df, *contract.names).select([F.col(f.name).cast(f.dataType).alias(f.name) for f in contract.fields])


def _producer_time(df: DataFrame, ts: str) -> Column:
    return F.coalesce(have(df, "producer_timestamp", "timestamp"), F.col(ts))


def stock_prices_product(df: DataFrame, *, ts: str = "processing_timestamp", price_cap: float = E.PRICE_CAP, volume_cap: int = E.VOLUME_CAP) -> DataFrame:
    """Price rows with their defaults, within the caps.

    The older cap on volumes was 1,000,000, which shuts out ordinary ones; it can be passed.
    """
    require_columns(df, "symbol", "current_price", ts)
    close = F.col("close_price")
    d = df.withColumn("close_price", F.col("current_price"))
    filled = {n: F.coalesce(have(d, n, "double"), close) for n in ("open_price", "high_price", "low_price", "sma_5min", "sma_20min", "vwap")}
    filled |= {
        "symbol": F.coalesce("symbol", F.lit(UNKNOWN)),
        "timestamp": F.col(ts),
        "volume": F.coalesce(have(d, "volume", "bigint"), F.lit(0)),
        "price_trend_5min": F.coalesce(have(d, "price_trend_5min", "string"), F.lit("neutral")),
        "trading_session": F.coalesce(have(d, "trading_session", "string"), F.lit("unknown")),
        "price_volatility": have(d, "price_volatility", "double"),
        "price_change_abs": F.coalesce(have(d, "price_change_abs", "double"), F.lit(0.0)),
        "price_momentum": F.coalesce(have(d, "price_momentum", "double"), F.lit(0.0)),
        "data_quality_score": F.coalesce(have(d, "data_quality_score", "double"), F.lit(1.0)),
        "producer_timestamp": _producer_time(d, ts),
        "processing_timestamp": F.col(ts),
    }
    d = d.withColumns(filled)
    d = d.filter((F.col("current_price") > 0) & (F.col("current_price") < price_cap) & (F.col("volume") >= 0) & (F.col("volume") < volume_cap))
    return _shaped(with_product_metadata(d, "stock_prices"), schemas.PRICE_PRODUCT)


def trading_volume_product(df: DataFrame, *, ts: str = "processing_timestamp") -> DataFrame:
    """Volume rows; impossible values are clamped or nulled, other nulls stay."""
    require_columns(df, "symbol", "volume", ts)
    volume, ratio, weighted = F.col("volume"), have(df, "volume_ratio", "double"), have(df, "volume_weighted_price", "double")
    d = df.withColumns(
        {
            "volume_anomaly": F.coalesce(have(df, "volume_anomaly", "boolean"), have(df, "is_volume_anomaly", "boolean")),
            "volume_ratio": F.when(ratio >= 0, ratio),
            "volume_weighted_price": F.when(weighted >= 0, weighted),
            "symbol": F.coalesce("symbol", F.lit(UNKNOWN)),
            "timestamp": F.coalesce(F.col(ts), F.current_timestamp()),
            "producer_timestamp": _producer_time(df, ts),
            "processing_timestamp": F.col(ts),
        }
        | {n: have(df, n, "double") for n in ("volume_ma_5min", "volume_ma_20min")}
        | {n: have(df, n, "string") for n in ("volume_trend", "volume_category")}
    )
    d = d.withColumn("volume", F.when(volume < 0, 0).otherwise(F.coalesce(volume, F.lit(0))))
    return _shaped(with_product_metadata(d, "trading_volume"), schemas.VOLUME_PRODUCT)


def technical_indicators_product(df: DataFrame, *, ts: str = "processing_timestamp", band_fallback: str = "price", macd_cap: float = E.MACD_CAP) -> DataFrame:
    """Indicator rows with neutral defaults. Missing bands become the price, or with ``pct`` 2 % around it."""
    require_columns(df, "symbol", "current_price", ts)
    wide = {"upper": 1.02, "lower": 0.98, "middle": 1.0} if band_fallback == "pct" else {"upper": 1.0, "lower": 1.0, "middle": 1.0}
    strength, m = have(df, "rsi_14", "double"), have(df, "macd", "double")
    d = df.withColumns(
        {
            "rsi_14": F.least(F.greatest(F.coalesce(strength, F.lit(E.NEUTRAL_RSI)), F.lit(0.0)), F.lit(100.0)),
            "macd": F.when(m.isNull() | (F.abs(m) > macd_cap), E.NEUTRAL_MACD).otherwise(m),
            "macd_signal": F.coalesce(have(df, "macd_signal", "double"), F.lit(E.NEUTRAL_MACD)),
            "macd_histogram": F.coalesce(have(df, "macd_histogram", "double"), F.lit(E.NEUTRAL_MACD)),
            "data_quality_score": F.coalesce(have(df, "data_quality_score", "double"), F.lit(1.0)),
            "symbol": F.coalesce("symbol", F.lit(UNKNOWN)),
            "timestamp": F.coalesce(F.col(ts), F.current_timestamp()),
            "producer_timestamp": _producer_time(df, ts),
            "processing_timestamp": F.col(ts),
        }
        | {f"bollinger_{n}": F.coalesce(have(df, f"bollinger_{n}", "double"), F.col("current_price") * w) for n, w in wide.items()}
    )
    return _shaped(with_product_metadata(d, "technical_indicators"), schemas.INDICATOR_PRODUCT)


def serialize_product(df: DataFrame, *, key: str = "symbol", fmt: str = "json", avro_schema: str | None = None) -> DataFrame:
    """(key, value): the whole row as JSON, or as Avro where that package is on the class path."""
    if fmt == "avro":
        from pyspark.sql.avro.functions import to_avro

        return df.select(F.col(key).cast("string").alias("key"), to_avro(F.struct(*df.columns), avro_schema or "").alias("value"))
    return df.select(F.col(key).cast("string").alias("key"), F.to_json(F.struct(*df.columns)).alias("value"))


def to_output_contract(df: DataFrame, times: tuple[str, ...] = ("timestamp", "producer_timestamp", "processing_timestamp")) -> DataFrame:
    """Times, as timestamps or ISO strings, as epoch milliseconds."""
    return df.withColumns({c: F.unix_millis(F.col(c).try_cast("timestamp")) for c in times if c in df.columns})
