"""Archives, products, gold landing and dead letters. Formats whose package is absent can be chosen, not tested here."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from .readers import HOUR_PARTS, with_hour_parts


def archive_bronze(df: DataFrame, path: str, *, checkpoint: str | None = None, ts: str = "timestamp", fmt: str = "parquet", trigger: dict | None = None):
    """Raw messages in hourly folders by record time. A stream gives its query, a batch nothing."""
    d = with_hour_parts(df, ts)
    if df.isStreaming:
        return d.writeStream.format(fmt).partitionBy(*HOUR_PARTS).option("path", path).option("checkpointLocation", checkpoint).trigger(**(trigger or {"processingTime": "30 seconds"})).start()
    d.write.format(fmt).mode("append").partitionBy(*HOUR_PARTS).save(path)


def archive_silver(df: DataFrame, path: str, *, ts: str = "processing_timestamp", mode: str = "append") -> None:
    """Product rows in hourly folders by processing time; rows without one are left out.

    Rows of one hour go to few files: they are dealt by hour and, within it, at random.
    """
    d = with_hour_parts(df.filter(F.col(ts).isNotNull()), ts)
    d.hint("rebalance", *HOUR_PARTS).write.mode(mode).partitionBy(*HOUR_PARTS).parquet(path)


def write_product(df: DataFrame, *, sink: str, path: str | None = None, topic: str | None = None, servers: str | None = None, mode: str = "append") -> None:
    """Serialised (key, value) rows to a topic, or to files of the same shape."""
    if sink == "kafka":
        df.write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).save()
    else:
        df.write.format(sink).mode(mode).save(path)


def gold_rows(messages: DataFrame) -> DataFrame:
    """Messages (key, value, partition, offset, timestamp) as rows of a raw gold table."""
    return messages.select(F.col("key").alias("kafka_key"), F.col("value").cast("string").alias("kafka_value"), F.col("partition").alias("kafka_partition"), F.col("offset").alias("kafka_offset"), F.col("timestamp").alias("kafka_timestamp"), F.current_timestamp().alias("refresh_time"))


def land_gold_raw(messages: DataFrame, *, path: str | None = None, jdbc: dict | None = None) -> None:
    """Append to a raw gold table: Parquet, or a database in batches of 100."""
    rows = gold_rows(messages)
    if jdbc:
        rows.write.format("jdbc").options(batchsize="100", **jdbc).mode("append").save()
    else:
        rows.write.mode("append").parquet(path)


def dead_letters(rejected: DataFrame, *, source: str) -> DataFrame:
    """Rejected rows as letters: the reason, where they came from, and the row as JSON."""
    have = lambda n, k: F.col(n).cast(k) if n in rejected.columns else F.lit(None).cast(k)
    body = [c for c in rejected.columns if c != "error_reason"]
    return rejected.select("error_reason", F.lit(source).alias("source"), have("topic", "string").alias("topic"), have("partition", "int").alias("partition"), have("offset", "long").alias("offset"), F.to_json(F.struct(*body)).alias("record"))


def write_dead_letters(rejected: DataFrame, path: str, *, source: str) -> None:
    dead_letters(rejected, source=source).write.mode("append").parquet(path)


def debug_sink(df: DataFrame, *, kind: str = "memory", name: str = "debug", checkpoint: str | None = None) -> DataStreamWriter:
    """A stream shown on the console or kept in a table of the session."""
    writer = df.writeStream.format(kind).queryName(name)
    return writer.option("checkpointLocation", checkpoint) if checkpoint else writer
