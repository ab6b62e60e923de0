"""The driver tables as inputs of the operators: ticks, messages, documents, company snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import expressions as E
from ..operators.frames import with_previous
from ..operators.metrics import ensure_tick_columns  # noqa: F401  (re-exported for callers of fixtures)

#: The start of the events, and by what their time is divided.
START, SHRINK = 1704067200000000, 30


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as ticks: 30 days in one, price from the value, volume from the properties."""
    us = F.expr(f"{START} + ((unix_micros(cast(ts as timestamp)) - {START}) div {SHRINK})")
    d = table(spark, sf_dir, "events").select(
        "event_id", F.upper("event_type").alias("symbol"), us.alias("us"), F.timestamp_micros(us).alias("processing_timestamp"),
        F.col("value").alias("current_price"), (F.get_json_object("props", "$.k").cast("bigint") * 10000).alias("volume"),
    )
    d = with_previous(d, "current_price", "_before", tie=("event_id",), bucket=1800).withColumn("previous_close", F.coalesce("_before", "current_price")).drop("_before")
    p, c = F.col("current_price"), F.col("previous_close")
    return d.withColumns({"open_price": c, "high_price": F.greatest(c, p), "low_price": F.least(c, p), "change": p - c})


def dirty_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticks with faults in fixed places; of two faults in one column the first rule counts."""
    e, p, v = F.col("event_id"), F.col("current_price"), F.col("volume")
    return ticks(spark, sf_dir).withColumns(
        {
            "high_price": F.when(e % 97 == 0, F.col("low_price") - 1).otherwise(F.col("high_price")),
            "volume": F.when(e % 89 == 0, F.lit(None)).when(e % 73 == 0, -1).otherwise(v).cast("bigint"),
            "current_price": F.when(e % 83 == 0, F.lit(None)).when(e % 79 == 0, -p).otherwise(p),
        }
    )


QUOTES, INTRADAY = "stock-quotes", "intraday-data"


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticks as message envelopes on two topics, with some payloads that can't be decoded."""
    e = F.col("event_id")
    meta = F.struct(F.lit("2024-01-01T00:00:00").alias("producer_timestamp"), F.lit("1.0").alias("producer_version"), F.lit("events").alias("data_source")).alias("producer_metadata")
    ms = F.unix_millis("processing_timestamp").alias("timestamp")
    prices = ["open_price", "high_price", "low_price"]
    quote = F.to_json(F.struct("symbol", *prices, "current_price", "volume", "previous_close", "change", ms, meta))
    bar = F.to_json(F.struct("symbol", *prices, F.col("current_price").alias("close_price"), "volume", F.lit("5min").alias("interval"), ms, meta))
    body = F.when(e % 101 == 0, F.lit("{broken")).otherwise(F.when(e % 2 == 0, quote).otherwise(bar))
    header = F.unhex(F.lit("0000000001"))
    value = F.when(e % 103 == 0, F.unhex(F.lit("000000"))).otherwise(F.concat(header, body.cast("binary")))
    return ticks(spark, sf_dir).select(
        F.col("symbol").alias("key"), value.alias("value"), F.when(e % 2 == 0, QUOTES).otherwise(INTRADAY).alias("topic"),
        (e % 3).cast("int").alias("partition"), e.alias("offset"), F.timestamp_micros(F.col("us") + 1_000_000).alias("timestamp"),
    )


def _two(c: str) -> F.Column:
    return F.format_string("%.2f", F.floor(F.col(c) * 100 + 0.5) / 100)


def quote_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(event_id, document): each tick as a quote document with numbered keys and text values.

    After a price of 0 there is no change in percent.
    """
    t = ticks(spark, sf_dir)
    percent = F.concat(F.format_string("%.4f", F.floor(E.ratio("change", "previous_close") * 1_000_000 + 0.5) / 10_000), F.lit("%"))
    fields = {
        "01. symbol": F.col("symbol"), "02. open": _two("open_price"), "03. high": _two("high_price"), "04. low": _two("low_price"),
        "05. price": _two("current_price"), "06. volume": F.col("volume").cast("string"), "07. latest trading day": F.date_format("processing_timestamp", "yyyy-MM-dd"),
        "08. previous close": _two("previous_close"), "09. change": _two("change"), "10. change percent": percent,
    }
    quote = F.struct(*[v.alias(k) for k, v in fields.items()]).alias("Global Quote")
    return t.select("event_id", F.to_json(F.struct(quote)).alias("document"))


def five_minute_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = ticks(spark, sf_dir)
    order = F.struct("us", "event_id")
    bars = t.groupBy("symbol", F.window("processing_timestamp", "5 minutes").alias("w")).agg(F.min_by("current_price", order).alias("o"), F.max("current_price").alias("h"), F.min("current_price").alias("l"), F.max_by("current_price", order).alias("c"), F.sum("volume").alias("v"))
    return bars.select("symbol", F.col("w.start").alias("bar_time"), "o", "h", "l", "c", "v")


def intraday_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(document): one document a symbol and hour, a map of bar times to bars."""
    b = five_minute_bars(spark, sf_dir)
    bar = F.struct(*[_two(c).alias(k) for k, c in (("1. open", "o"), ("2. high", "h"), ("3. low", "l"), ("4. close", "c"))], F.col("v").cast("string").alias("5. volume"))
    entry = F.struct(F.date_format("bar_time", "yyyy-MM-dd HH:mm:ss").alias("key"), bar.alias("value"))
    hours = b.groupBy("symbol", F.date_trunc("hour", "bar_time").alias("hour")).agg(F.map_from_entries(F.collect_list(entry)).alias("series"))
    meta = F.struct(F.lit("Intraday prices").alias("1. Information"), F.col("symbol").alias("2. Symbol")).alias("Meta Data")
    return hours.select(F.to_json(F.struct(meta, F.col("series").alias("Time Series (5min)"))).alias("document"))


def gold_raw(product: DataFrame, ts: str = "processing_timestamp") -> DataFrame:
    """Product rows as rows of a raw gold table, loaded at their own time."""
    return product.select(F.col("symbol").alias("kafka_key"), F.to_json(F.struct(*product.columns), {"timestampFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS"}).alias("kafka_value"), F.lit(0).alias("kafka_partition"), F.unix_micros(ts).alias("kafka_offset"), F.col(ts).alias("kafka_timestamp"), F.current_timestamp().alias("refresh_time"))


def company_snapshot(spark: SparkSession, sf_dir: str, *, later: bool) -> DataFrame:
    """Companies out of orders: those before 1998, or those from then on."""
    cut = F.col("o_orderdate") >= "1998-01-01" if later else F.col("o_orderdate") < "1998-01-01"
    o = table(spark, sf_dir, "orders").filter(cut)
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name")
    return o.join(c, "o_custkey").select(F.col("o_custkey").cast("string").alias("symbol"), F.col("c_name").alias("company_name"), F.col("o_orderpriority").alias("exchange"), F.col("o_totalprice").alias("market_cap"), F.col("o_orderdate").cast("timestamp").alias("source_timestamp"), "o_orderkey")
