"""Batch and streaming readers, all with explicit schemas."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas


def read_ticks_stream(spark: SparkSession, *, path: str | None = None, fmt: str = "parquet", servers: str | None = None, topics: list[str] | None = None, starting_offsets: str = "latest", max_files: int | None = None, schema: T.StructType = schemas.ENVELOPE) -> DataFrame:
    """A stream of message envelopes: from topics, or from files of the same shape.

    Topics need the Kafka package on the class path.
    """
    if path is None:
        options = {"kafka.bootstrap.servers": servers, "subscribe": ",".join(topics or []), "startingOffsets": starting_offsets, "failOnDataLoss": "false"}
        return spark.readStream.format("kafka").options(**options).load()
    reader = spark.readStream.schema(schema).format(fmt)
    return (reader.option("maxFilesPerTrigger", max_files) if max_files else reader).load(path)


HOUR_PARTS = ["year", "month", "day", "hour"]


def with_hour_parts(df: DataFrame, ts: str) -> DataFrame:
    """Partition columns of the hour that a row belongs to."""
    return df.withColumns({"year": F.year(ts), "month": F.month(ts), "day": F.dayofmonth(ts), "hour": F.hour(ts)})


def hour_bounds(since: datetime.datetime, until: datetime.datetime) -> Column:
    """A predicate on the partition columns alone, so whole hours are pruned before any file is opened."""
    number = ((F.col("year") * 100 + F.col("month")) * 100 + F.col("day")) * 100 + F.col("hour")
    as_number = lambda t: int(t.strftime("%Y%m%d%H"))
    return (number >= as_number(since)) & (number <= as_number(until))


def read_silver(spark: SparkSession, path: str, schema: T.StructType, *, ts: str = "processing_timestamp", since: datetime.datetime | None = None, until: datetime.datetime | None = None) -> DataFrame:
    """A silver archive between two times (both inclusive); other hours are not read."""
    full = T.StructType(list(schema.fields) + [T.StructField(c, T.IntegerType()) for c in HOUR_PARTS])
    df = spark.read.schema(full).parquet(path)
    if since is not None or until is not None:
        a, b = since or datetime.datetime(1970, 1, 1), until or datetime.datetime(9999, 1, 1)
        df = df.filter(hour_bounds(a, b) & (F.col(ts) >= F.lit(a)) & (F.col(ts) <= F.lit(b)))
    return df.drop(*HOUR_PARTS)
