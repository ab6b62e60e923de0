"""Streams that keep state: redelivered messages, late ticks that are counted, prices joined with indicators, and what queries report."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from ..operators.bars import ohlcv_bars
from ..sources.files import put_text

#: What a message is known by, wherever and however often it is delivered.
MESSAGE = ("topic", "partition", "offset")


def once(stream: DataFrame, *, key: tuple[str, ...] = MESSAGE, ts: str = "timestamp", delay: str = "10 minutes") -> DataFrame:
    """Each key once, however often it is delivered within ``delay`` of its time; rows later than that are dropped.

    A key is forgotten once the watermark has passed its time and the delay, so the state
    holds what came lately, not all that ever came. On a batch, each key's first row by time.
    """
    if not stream.isStreaming:
        rest = [c for c in stream.columns if c not in key]
        first = stream.groupBy(*key).agg(F.min_by(F.struct(*rest), F.struct(ts)).alias("_row"))
        return first.select([F.col(c) if c in key else F.col("_row")[c].alias(c) for c in stream.columns])
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(key))


def closed_bars(stream: DataFrame, *, key: tuple[str, ...], window: str = "1 minute", delay: str = "10 minutes", ts: str = "processing_timestamp") -> DataFrame:
    """Bars that no later tick can change, for append mode. Late ticks are dropped one by one, so the query's progress counts them."""
    return ohlcv_bars(once(stream, key=key, ts=ts, delay=delay), window=window, watermark=None, ts=ts)


def prices_with_indicators(prices: DataFrame, indicators: DataFrame, *, ts: str = "timestamp", symbol: str = "symbol", delay: str = "10 minutes") -> DataFrame:
    """Prices left joined with the indicators of the same symbol and time, two streams that may run apart by ``delay``.

    A price waits for its indicators until both watermarks have passed it, then goes
    without. Columns of the indicators that prices have too are left out. Indicators of one
    symbol and time count once, so several prices of it have a row each.
    """
    own = [c for c in indicators.columns if c not in (symbol, ts, *prices.columns)]
    p = prices.withWatermark(ts, delay)
    i = indicators.select(F.col(symbol).alias("_symbol"), F.col(ts).alias("_ts"), *own).withWatermark("_ts", delay)
    i = i.dropDuplicatesWithinWatermark(["_symbol", "_ts"]) if i.isStreaming else i.dropDuplicates(["_symbol", "_ts"])
    return p.join(i, (F.col(symbol) == F.col("_symbol")) & (F.col(ts) == F.col("_ts")), "left_outer").drop("_symbol", "_ts")


PROGRESS = "query string, name string, batch_id long, at timestamp, rows long, milliseconds long, dropped long, watermark string, observed map<string,string>, error string"


class Reports(StreamingQueryListener):
    """Writes a line for each batch of every query: rows, duration, rows dropped as late, observed metrics, and how a query ended.

    Lines are files of their own below ``path``, written by the driver without any job.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _put(self, **line) -> None:
        put_text(self.spark, f"{self.path}/{uuid.uuid4().hex}.json", json.dumps(line) + "\n")

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        p = event.progress
        seen = {f"{name}.{k}": str(v) for name, row in p.observedMetrics.items() for k, v in row.asDict().items()}
        self._put(query=str(p.id), name=p.name, batch_id=p.batchId, at=p.timestamp, rows=p.numInputRows, milliseconds=p.batchDuration, dropped=sum(s.numRowsDroppedByWatermark for s in p.stateOperators), watermark=p.eventTime.get("watermark"), observed=seen)

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        if event.exception:
            self._put(query=str(event.id), error=event.exception[:2000])


def reports(spark: SparkSession, path: str) -> DataFrame:
    """One row for each line that ``Reports`` wrote."""
    return spark.read.schema(PROGRESS).json(path)


def await_reported(query: StreamingQuery) -> StreamingQuery:
    """Wait until a query has ended and listeners have heard of all its batches."""
    query.awaitTermination()
    SparkSession.active()._jsparkSession.sparkContext().listenerBus().waitUntilEmpty(60_000)
    return query
