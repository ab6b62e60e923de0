"""Frames and exponential means against definitions row by row, and how their cost grows."""

from __future__ import annotations

import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickspark.operators import frames, indicators


def long_rows(spark, n, symbol="A"):
    """n ticks of one symbol within 19 minutes."""
    k = F.col("id")
    return spark.range(n).select(k.alias("event_id"), F.lit(symbol).alias("symbol"), F.timestamp_micros(F.lit(1_704_067_200_000_000) + k * (1_140_000_000 // n)).alias("processing_timestamp"), (100 + k % 37).cast("double").alias("current_price"), (k % 11).alias("volume"))


SPECS = {
    "mean": frames.mean("x", 10), "total": frames.total("x", 10), "dev": frames.deviation("x", 10), "low": frames.least("x", 10), "high": frames.most("y", 7),
    "before": frames.mean("x", 10, -1), "dev_before": frames.deviation("y", 10, -1), "wide": frames.total("y", 25.5), "none": frames.mean("x", 0),
}


def by_definition(rows, name):
    o, out = SPECS[name], {}
    for r in rows:
        own = [q[o.value] for q in rows if q["s"] == r["s"] and r["us"] - int(o.length * 1e6) <= q["us"] <= r["us"] + o.until and q[o.value] is not None]
        if not own or o.kind == "deviation" and len(own) < 2:
            out[r["id"]] = None
        else:
            out[r["id"]] = {"mean": np.mean, "total": np.sum, "deviation": lambda v: np.std(v, ddof=1), "least": min, "most": max}[o.kind](own)
    return out


@pytest.mark.parametrize("bucket", [None, 8, 60, 10_000])
def test_frames_equal_their_definition(spark, bucket):
    rng = random.Random(7)
    rows = [{"id": k, "s": rng.choice("AAB"), "us": rng.choice([-1, 1]) * 10**7 * rng.randrange(5) + rng.choice([0, 0, 1, 10**6 * rng.randrange(60)]), "x": rng.choice([None, 0.1, 0.1, 5.0, -3.5]), "y": rng.choice([None, 1.5, 1e6])} for k in range(220)]
    d = spark.createDataFrame([tuple(r.values()) for r in rows], "id long, s string, us long, x double, y double").withColumn("processing_timestamp", F.timestamp_micros("us"))
    out = frames.rolling(d, lambda x, add: add(x, SPECS), lookback=26, symbol="s", bucket=bucket)
    assert out.columns == [*d.columns, *SPECS]
    got = {r["id"]: r for r in out.collect()}
    assert len(got) == len(rows)
    for name in SPECS:
        want = by_definition(rows, name)
        for k, w in want.items():
            assert got[k][name] == (None if w is None else pytest.approx(w, rel=1e-12, abs=1e-9)), (name, rows[k])


def test_equal_values_have_no_deviation(spark):
    d = long_rows(spark, 50).withColumn("current_price", F.when(F.col("event_id") < 5, 1e9).otherwise(0.1))
    dev = frames.rolling(d, lambda x, add: add(x, {"dev": frames.deviation("current_price", 300)}), lookback=300).filter("event_id > 30").select("dev").distinct().collect()
    assert [r["dev"] for r in dev] == [0.0]


def seconds(action) -> float:
    return min(timed(action) for _ in range(2))


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


@pytest.mark.parametrize("bucket", [None, 21600])
def test_cost_follows_the_ticks_of_a_frame(spark, bucket):
    few, many = (long_rows(spark, n) for n in (20_000, 80_000))
    run = lambda d: indicators.price_anomalies(indicators.moving_averages(d, bucket=bucket), bucket=bucket).write.format("noop").mode("overwrite").save()
    run(few)
    assert seconds(lambda: run(many)) < 5 * seconds(lambda: run(few))


@pytest.mark.parametrize("n, block, bucket", [(9, 37, None), (9, 5, 60), (26, 20_000, 60), (500, 11, None), (100_000, 13, 60)])
def test_ema_in_blocks_equals_the_recursion(spark, n, block, bucket):
    prices = [100 + (k * 7919 % 1000) / 10 for k in range(400)]
    d = spark.createDataFrame([(k, s, k, p * m) for s, m in (("A", 1.0), (None, -2.0)) for k, p in enumerate(prices)], "id long, symbol string, us long, x double")
    d = frames.numbered(d.withColumn("ts", F.timestamp_micros(F.col("us") * 1_000_000)), "at", ts="ts", bucket=bucket)
    got = {(r["symbol"], r["id"]): r["e"] for r in indicators.ema(d, {"e": ("x", n), "f": ("x", 12)}, symbol="symbol", at="at", block=block).collect()}
    for s, m in (("A", 1.0), (None, -2.0)):
        e = prices[0] * m
        for k, p in enumerate(prices):
            e = e if not k else e + 2 / (n + 1) * (p * m - e)
            assert got[s, k] == pytest.approx(e, rel=1e-12)


def test_ema_of_a_long_symbol(spark):
    n = 100_000
    out = indicators.macd(long_rows(spark, n), method="ema", bucket=300).select("event_id", "current_price", "macd", "macd_signal").orderBy("event_id").toPandas()
    fast = slow = out["current_price"][0]
    signal, worst = 0.0, 0.0
    for k, (p, m, g) in enumerate(zip(out["current_price"], out["macd"], out["macd_signal"])):
        if k:
            fast, slow = fast + 2 / 13 * (p - fast), slow + 2 / 27 * (p - slow)
            signal += 0.2 * (fast - slow - signal)
        worst = max(worst, abs(m - (fast - slow)), abs(g - signal))
    assert len(out) == n and worst < 1e-9


def test_ema_without_prices(spark):
    d = long_rows(spark, 6).withColumn("current_price", F.when(F.col("event_id").isin(0, 3), None).otherwise(F.col("current_price")))
    out = indicators.macd(d, method="ema", periods=(2, 4, 2)).orderBy("event_id").collect()
    assert [r["macd"] is None for r in out] == [True, False, False, True, False, False] and out[1]["macd"] == out[1]["macd_signal"] == 0
    with pytest.raises(ValueError):
        frames.decayed_sums(d, {"x": ("volume", 1.0)}, at="event_id")
