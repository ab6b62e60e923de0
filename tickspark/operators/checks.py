"""Declarative data checks, their stored failures, and quality alerts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import expressions as E

#: Rules by name: a condition that a failing tick meets.
RULES = ("price_validation", "volume_validation", "timestamp_validation", "symbol_validation")


def check_not_null(df: DataFrame, *columns: str) -> DataFrame:
    """The rows in which one of the columns is null."""
    bad = F.lit(False)
    for c in columns:
        bad = bad | F.col(c).isNull()
    return df.filter(bad)


def check_unique(df: DataFrame, *columns: str) -> DataFrame:
    """Each value that comes more than once, with ``n``; nulls aren't compared."""
    some = df.dropna(subset=list(columns))
    return some.groupBy(*columns).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def check_relationship(df: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """The rows whose value, not null, the parent lacks."""
    known = parent.select(F.col(parent_column).alias(column)).distinct()
    return df.filter(F.col(column).isNotNull()).join(known, column, "left_anti")


def store_failures(failing: DataFrame, path: str) -> int:
    """Write failing rows as Parquet; how many there are."""
    failing.write.mode("overwrite").parquet(path)
    return failing.sparkSession.read.schema(failing.schema).parquet(path).count()


def rule_failures(price: str = "current_price", volume: str = "volume", ts: str = "processing_timestamp", symbol: str = "symbol") -> dict[str, Column]:
    p, v = F.col(price), F.col(volume)
    unset = lambda c: F.coalesce(c, F.lit(True))  # noqa: E731  a null fails
    return {
        "price_validation": unset(~((p > 0) & (p < E.PRICE_CAP))),
        "volume_validation": unset(~((v >= 0) & (v < E.VOLUME_CAP))),
        "timestamp_validation": F.col(ts).isNull(),
        "symbol_validation": F.col(symbol).isNull() | (F.trim(symbol) == ""),
    }


def quality_alerts(df: DataFrame, *, window: str = "1 hour", warning: float = 0.01, error: float = 0.05, minimum: float = 0.0, ts: str = "processing_timestamp", watermark: str | None = None, rules: dict[str, Column] | None = None) -> DataFrame:
    """One row for each rule and window whose share of failing rows is above ``minimum``.

    Severity is ERROR from ``error`` on, WARNING from ``warning`` on, else INFO. One pass
    counts all rules; rows become one per rule only after the aggregation.
    """
    rules = rules or rule_failures(ts=ts)
    if watermark and df.isStreaming:
        df = df.withWatermark(ts, watermark)
    counts = df.groupBy(F.window(ts, window).alias("window")).agg(F.count(F.lit(1)).alias("total_count"), *[F.count_if(c).alias(n) for n, c in rules.items()])
    each = counts.select("window", "total_count", F.explode(F.array(*[F.struct(F.lit(n).alias("rule"), F.col(n).alias("failed_count")) for n in rules])).alias("r"))
    rate = F.col("r.failed_count") / F.col("total_count")
    out = each.select("r.rule", F.when(rate >= error, "ERROR").when(rate >= warning, "WARNING").otherwise("INFO").alias("severity"), "r.failed_count", "total_count", rate.alias("failure_rate"), F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"))
    return out.filter(F.col("failure_rate") > minimum)
