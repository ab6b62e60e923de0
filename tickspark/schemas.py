"""Every contract as a StructType. Readers use these; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T

STRING, DOUBLE, LONG, BOOL, TIME, INT = T.StringType(), T.DoubleType(), T.LongType(), T.BooleanType(), T.TimestampType(), T.IntegerType()


def struct(required: str = "", **fields: T.DataType) -> T.StructType:
    """Fields in order; those named in ``required`` (space-separated) may not be null."""
    needed = set(required.split())
    return T.StructType([T.StructField(k, v, k not in needed) for k, v in fields.items()])


ENVELOPE = struct(key=STRING, value=T.BinaryType(), topic=STRING, partition=INT, offset=LONG, timestamp=TIME)

PRODUCER = struct("producer_timestamp producer_version data_source", producer_timestamp=STRING, producer_version=STRING, data_source=STRING)

STOCK_QUOTE = struct(
    "symbol current_price timestamp producer_metadata",
    symbol=STRING, open_price=DOUBLE, high_price=DOUBLE, low_price=DOUBLE, current_price=DOUBLE, volume=LONG,
    latest_trading_day=STRING, previous_close=DOUBLE, change=DOUBLE, change_percent=DOUBLE, timestamp=LONG, producer_metadata=PRODUCER,
)

INTRADAY_BAR = struct(
    "symbol timestamp open_price high_price low_price close_price volume interval producer_metadata",
    symbol=STRING, timestamp=LONG, open_price=DOUBLE, high_price=DOUBLE, low_price=DOUBLE, close_price=DOUBLE, volume=LONG,
    interval=STRING, producer_metadata=PRODUCER,
)

CANONICAL_TICK = struct(
    "symbol processing_timestamp",
    topic=STRING, partition=INT, offset=LONG, kafka_timestamp=TIME, symbol=STRING, current_price=DOUBLE, open_price=DOUBLE,
    high_price=DOUBLE, low_price=DOUBLE, previous_close=DOUBLE, change=DOUBLE, volume=LONG, payload_timestamp_ms=LONG, processing_timestamp=TIME,
)

_META = {"data_layer": STRING, "record_type": STRING, "processing_version": STRING}

PRICE_PRODUCT = struct(
    "symbol",
    symbol=STRING, timestamp=TIME, current_price=DOUBLE, close_price=DOUBLE, open_price=DOUBLE, high_price=DOUBLE, low_price=DOUBLE,
    volume=LONG, sma_5min=DOUBLE, sma_20min=DOUBLE, price_trend_5min=STRING, price_volatility=DOUBLE, trading_session=STRING,
    producer_timestamp=TIME, processing_timestamp=TIME, vwap=DOUBLE, price_change_abs=DOUBLE, price_momentum=DOUBLE, data_quality_score=DOUBLE, **_META,
)

VOLUME_PRODUCT = struct(
    "symbol",
    symbol=STRING, timestamp=TIME, volume=LONG, volume_ma_5min=DOUBLE, volume_ma_20min=DOUBLE, volume_trend=STRING, volume_anomaly=BOOL,
    producer_timestamp=TIME, processing_timestamp=TIME, volume_ratio=DOUBLE, volume_weighted_price=DOUBLE, volume_category=STRING, **_META,
)

INDICATOR_PRODUCT = struct(
    "symbol",
    symbol=STRING, timestamp=TIME, rsi_14=DOUBLE, macd=DOUBLE, macd_signal=DOUBLE, macd_histogram=DOUBLE, bollinger_upper=DOUBLE,
    bollinger_lower=DOUBLE, bollinger_middle=DOUBLE, producer_timestamp=TIME, processing_timestamp=TIME, data_quality_score=DOUBLE, **_META,
)

GOLD_RAW = struct(kafka_key=STRING, kafka_value=STRING, kafka_partition=INT, kafka_offset=LONG, kafka_timestamp=TIME, refresh_time=TIME)

COMPANY_SOURCE = struct("symbol", symbol=STRING, company_name=STRING, exchange=STRING, market_cap=DOUBLE, source_timestamp=TIME)

#: The raw quote document: numbered keys, every value a string.
QUOTE_DOCUMENT = T.StructType().add("Global Quote", T.MapType(STRING, STRING))
#: The raw intraday document: a map of bar times under a key that names the interval.
BAR_FIELDS = T.MapType(STRING, STRING)
