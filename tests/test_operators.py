"""Operators on rows made by hand."""

import datetime
import math

import pytest
from pyspark.sql import functions as F

from tickspark.operators import checks, gold, indicators, metrics, products
from tickspark.operators.frames import with_previous
from tickspark.plans import pipelines, queries
from tickspark.sources import decode, readers, sinks
from tickspark import schemas

UTC = datetime.timezone.utc


def at(seconds: float) -> datetime.datetime:
    return datetime.datetime(2024, 1, 2, 10, tzinfo=UTC) + datetime.timedelta(seconds=seconds)


def tick_frame(spark, prices, step=60, symbol="A", volume=100):
    return spark.createDataFrame([(k, symbol, at(step * k), float(p), volume) for k, p in enumerate(prices)], "event_id long, symbol string, processing_timestamp timestamp, current_price double, volume long")


@pytest.mark.parametrize("prices,mean", [((100, 102, 101, 103, 105, 104), 102.5), ((148.5, 149.2, 150.1, 149.8, 150.5, 150.25), 149.725)])
@pytest.mark.parametrize("bucket", [None, 400, 86400])
def test_five_minute_mean(spark, prices, mean, bucket):
    out = indicators.moving_averages(tick_frame(spark, prices), bucket=bucket).orderBy("event_id").collect()
    assert len(out) == 6 and out[-1]["sma_5min"] == pytest.approx(mean)


def test_first_rows(spark):
    one = tick_frame(spark, [50])
    assert indicators.rsi(one).first()["rsi_14"] == 100
    bands = indicators.bollinger_bands(one)
    assert bands.first()["bollinger_upper"] is None
    product = products.technical_indicators_product(bands).first()
    assert product["bollinger_upper"] == 50 and product["rsi_14"] == 50 and product["macd"] == 0
    wide = products.technical_indicators_product(bands.drop("bollinger_middle"), band_fallback="pct").first()
    assert wide["bollinger_upper"] == pytest.approx(51) and wide["bollinger_lower"] == pytest.approx(49)


def test_band_position(spark):
    df = spark.createDataFrame([(150.25, 151.9, 147.1)], "current_price double, bollinger_upper double, bollinger_lower double")
    assert indicators.bollinger_position(df).first()["bollinger_position"] == pytest.approx(0.65625)


def test_ten_rows_cannot_exceed_three_deviations(spark):
    flagged = lambda n, **o: indicators.price_anomalies(tick_frame(spark, [10] * (n - 1) + [99], step=10), **o).filter("is_price_anomaly").count()
    assert flagged(10) == 0 and flagged(12) == 1
    assert flagged(10, z_threshold=2.0) == 1


def test_quality_and_sessions(spark):
    rows = [(None, 2.0, 1.0, 5), (0.0, 2.0, 1.0, 5), (3.0, 2.0, 1.0, 5), (1.5, 2.0, 1.0, None), (1.5, None, 1.0, 5), (1.5, 2.0, 1.0, -1)]
    df = spark.createDataFrame(rows, "current_price double, high_price double, low_price double, volume long")
    assert [r["data_quality_score"] for r in metrics.quality_flags(df).collect()] == [0.0, 0.0, 0.0, 0.7, 1.0, 0.0]
    hours = spark.createDataFrame([(datetime.datetime(2024, 1, 1, h, tzinfo=UTC), 1.0, 2_000_000) for h in (3, 4, 8, 9, 16, 17)], "processing_timestamp timestamp, current_price double, volume long")
    out = metrics.classify_market(hours).collect()
    assert [r["trading_session"] for r in out] == ["after_hours", "pre_market", "pre_market", "regular", "regular", "after_hours"]
    assert out[0]["volume_size_class"] == "high"


@pytest.mark.parametrize("bucket", [60, 300, 7200])
def test_previous_over_buckets(spark, bucket):
    df = tick_frame(spark, [5, 4, 7, 7, 1], step=170).union(tick_frame(spark, [9, 8], step=4000, symbol="B"))
    plain = {(r["symbol"], r["event_id"]): r["p"] for r in with_previous(df, "current_price", "p", tie=("event_id",)).collect()}
    cut = {(r["symbol"], r["event_id"]): r["p"] for r in with_previous(df, "current_price", "p", tie=("event_id",), bucket=bucket).collect()}
    assert plain == cut and plain["A", 0] is None and plain["B", 1] == 9


def test_ema(spark):
    prices = [10 + math.sin(k) for k in range(60)]
    out = indicators.macd(tick_frame(spark, prices), method="ema").orderBy("event_id").collect()

    def ema(xs, n):
        e = xs[0]
        for x in xs[1:]:
            e += 2 / (n + 1) * (x - e)
        return e

    line = [ema(prices[: k + 1], 12) - ema(prices[: k + 1], 26) for k in range(60)]
    assert [r["macd"] for r in out] == pytest.approx(line)
    assert out[-1]["macd_signal"] == pytest.approx(ema(line, 9))


def test_ema_beyond_its_frames(spark):
    prices = [100 + 10 * math.sin(k / 9) + k % 7 for k in range(400)]
    out = indicators.macd(tick_frame(spark, prices), method="ema").orderBy("event_id").collect()
    fast = slow = prices[0]
    for p, r in zip(prices, out):
        fast, slow = (e + 2 / (n + 1) * (p - e) for e, n in ((fast, 12), (slow, 26)))
        assert r["macd"] == pytest.approx(fast - slow, abs=1e-6)


def test_ema_query_against_the_whole_recursion(spark, sf_dir):
    got = {r["event_id"]: r for r in queries.QUERIES["macd_ema"](spark, sf_dir).collect()}
    rows = queries.ticks(spark, sf_dir).select("symbol", F.unix_micros("processing_timestamp").alias("us"), "event_id", "current_price").collect()
    by = {}
    for r in sorted(rows, key=lambda r: (r["symbol"], r["us"], r["event_id"])):
        by.setdefault(r["symbol"], []).append(r)
    longest = max(by.values(), key=len)
    assert len(longest) > 150 and len(got) == len(rows)
    for own in by.values():
        fast = slow = own[0]["current_price"]
        signal = 0.0
        for k, r in enumerate(own):
            if k:
                fast, slow = (e + 2 / (n + 1) * (r["current_price"] - e) for e, n in ((fast, 12), (slow, 26)))
            signal = signal + 0.2 * (fast - slow - signal) if k else fast - slow
            assert got[r["event_id"]]["macd"] == pytest.approx(fast - slow, abs=2e-6)
            assert got[r["event_id"]]["macd_signal"] == pytest.approx(signal, abs=2e-6)


def test_invariants(spark, sf_dir):
    e = queries.enriched(spark, sf_dir)
    assert e.filter("rsi_14 < 0 or rsi_14 > 100 or bollinger_lower > bollinger_middle or bollinger_middle > bollinger_upper").isEmpty()
    b = queries.ohlcv_bars(spark, sf_dir)
    assert b.filter("low > open or low > close or high < open or high < close").isEmpty()
    assert b.agg(F.sum("total_volume")).first()[0] == queries.ticks(spark, sf_dir).agg(F.sum("volume")).first()[0]


def test_indicator_chain_has_one_exchange(spark):
    df = tick_frame(spark, range(1, 50)).withColumn("previous_close", F.col("current_price")).withColumn("change", F.lit(0.0))
    plan = pipelines.enrich_ticks(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_enrich_same_with_buckets(spark, sf_dir):
    t = queries.ticks(spark, sf_dir)
    cols = ["event_id", *[queries.r6(c) for c in ("sma_20min", "rsi_14", "macd_signal", "anomaly_score", "vwap")]]
    a, b = (pipelines.enrich_ticks(t, bucket=x).select(cols) for x in (None, 3000))
    assert a.exceptAll(b).isEmpty() and b.count() == t.count()


def test_missing_columns(spark):
    with pytest.raises(ValueError, match="volume"):
        metrics.validate_ticks(tick_frame(spark, [1]).drop("volume"))
    made = metrics.ensure_tick_columns(tick_frame(spark, [1, 2]).drop("current_price").withColumn("close_price", F.col("event_id") + 1.0)).orderBy("event_id").collect()
    assert made[1]["current_price"] == 2 and made[1]["previous_close"] == 1


def test_wire_header_and_payloads(spark):
    df = spark.createDataFrame([(bytearray(5),), (bytearray(b"\0\0\0\0\1{"),), (None,)], "value binary")
    assert [None if r["payload"] is None else bytes(r["payload"]) for r in decode.strip_wire_header(df).collect()] == [None, b"{", None]
    j = spark.createDataFrame([(b'{"a": 1}',), (b"{no",), (None,)], "payload binary")
    s = schemas.struct(a=schemas.LONG)
    assert [r["data"]["a"] for r in decode.decode_payload(j, s).collect()] == [1]
    assert sorted(r["error_reason"] for r in decode.undecodable(j, s).collect()) == ["no payload", "undecodable payload"]


def test_quotes_with_missing_values(spark):
    doc = '{"Global Quote": {"01. symbol": "X", "02. open": "None", "05. price": "12.5", "06. volume": "", "10. change percent": "1.23%"}}'
    r = decode.parse_quotes(spark.createDataFrame([(doc,), ("broken",)], "document string")).collect()
    assert (r[0]["current_price"], r[0]["open_price"], r[0]["volume"], r[0]["change_percent"]) == (12.5, None, None, 1.23)
    assert (r[1]["symbol"], r[1]["current_price"]) == ("UNKNOWN", 0.0)


def test_contract_types(spark):
    with pytest.raises(ValueError):
        decode.validate_contract(spark.createDataFrame([("1",)], "a string"), schemas.struct("a", a=schemas.LONG))


def test_products_clamp(spark):
    df = tick_frame(spark, [10, 20]).withColumns({"volume": F.when(F.col("event_id") == 0, -5).otherwise(F.col("volume")).cast("long"), "volume_ratio": F.lit(-1.0), "macd": F.lit(5000.0), "rsi_14": F.lit(140.0), "symbol": F.lit(None).cast("string")})
    v = products.trading_volume_product(df).orderBy("timestamp").collect()
    assert v[0]["volume"] == 0 and v[0]["volume_ratio"] is None and v[0]["symbol"] == "UNKNOWN" and v[0]["record_type"] == "trading_volume"
    i = products.technical_indicators_product(df).first()
    assert i["macd"] == 0 and i["rsi_14"] == 100
    assert products.stock_prices_product(df).count() == 1
    assert products.stock_prices_product(df, price_cap=15).count() == 0
    kv = products.serialize_product(products.to_output_contract(products.stock_prices_product(df))).first()
    assert kv["key"] == "UNKNOWN" and '"timestamp":17041896' in kv["value"]


def test_archives_prune_hours(spark, tmp_path):
    df = tick_frame(spark, range(1, 10), step=1800)
    sinks.archive_silver(df, f"{tmp_path}/silver")
    got = readers.read_silver(spark, f"{tmp_path}/silver", df.schema, since=at(3600), until=at(7200))
    assert sorted(r["event_id"] for r in got.collect()) == [2, 3, 4]
    assert "PartitionFilters: [isnotnull" in got._jdf.queryExecution().executedPlan().toString()
    sinks.archive_bronze(df, f"{tmp_path}/bronze", ts="processing_timestamp")
    assert spark.read.parquet(f"{tmp_path}/bronze").count() == 9


def test_landing_and_dead_letters(spark, tmp_path):
    m = spark.createDataFrame([("k", b"{}", "t", 0, 1, at(0))], "key string, value binary, topic string, partition int, offset long, timestamp timestamp")
    sinks.land_gold_raw(m, path=f"{tmp_path}/raw")
    assert spark.read.parquet(f"{tmp_path}/raw").columns == schemas.GOLD_RAW.names
    _, bad = metrics.validate_ticks(tick_frame(spark, [-1, 5]))
    sinks.write_dead_letters(bad, f"{tmp_path}/dead", source="ticks")
    assert spark.read.parquet(f"{tmp_path}/dead").first()["error_reason"] == "price out of range"
    sinks.write_product(products.serialize_product(tick_frame(spark, [1])), sink="parquet", path=f"{tmp_path}/product")
    assert spark.read.parquet(f"{tmp_path}/product").columns == ["key", "value"]


def test_upsert_and_publish(spark, tmp_path):
    t = spark.createDataFrame([(1, "a", 1), (2, "b", 1)], "id long, v string, t long")
    s = spark.createDataFrame([(2, "c", 2, True), (2, "old", 1, True), (3, "d", 2, True), (None, "x", 9, True)], "id long, v string, t long, extra boolean")
    once = gold.upsert(t, s, "id", ["t"])
    twice = gold.upsert(once, s, "id", ["t"])
    assert sorted((r["id"], r["v"]) for r in once.collect()) == [(1, "a"), (2, "c"), (3, "d")] == sorted((r["id"], r["v"]) for r in twice.collect())
    gold.publish(once, f"{tmp_path}/x", "v1", cluster_by=["id"])
    gold.publish(gold.current(spark, f"{tmp_path}/x").filter("id < 3"), f"{tmp_path}/x", "v2")
    assert gold.current(spark, f"{tmp_path}/x").count() == 2


def test_history(spark):
    cols = "symbol string, company_name string, exchange string, market_cap double, source_timestamp timestamp"
    first = spark.createDataFrame([("A", "a", "x", 1.0, at(0)), ("B", "b", "x", 1.0, at(0)), ("C", None, "x", 1.0, at(0))], cols)
    second = spark.createDataFrame([("A", "a2", "x", 1.0, at(9)), ("D", "d", "x", 1.0, at(9))], cols)
    h1 = gold.scd2_snapshot(None, first, as_of=at(10))
    assert gold.scd2_snapshot(h1, first, as_of=at(20)).exceptAll(h1).isEmpty()
    h2 = gold.scd2_snapshot(h1, second, as_of=at(30))
    assert sorted((r["symbol"], r["valid_to"] is None) for r in h2.collect()) == [("A", False), ("A", True), ("B", False), ("D", True)]
    assert gold.scd2_snapshot(h1, second, as_of=at(30), invalidate_hard_deletes=False).filter("symbol = 'B' and valid_to is null").count() == 1
    gap = spark.createDataFrame([("A", "a2", "x", 1.0, at(9)), ("A", "a2", None, 1.0, at(12)), ("D", "d", "x", 1.0, at(9))], cols)
    assert gold.scd2_snapshot(h2, gap, as_of=at(35)).exceptAll(h2).isEmpty()  # the newest whole row is in force
    h3 = gold.scd2_snapshot(h2, first, as_of=at(40))
    assert h3.filter("symbol = 'B'").count() == 2 and checks.check_unique(h3.filter("valid_to is null"), "symbol").isEmpty()


def test_late_indicator_joins(spark):
    key = "symbol string, timestamp timestamp, record_id string, kafka_timestamp timestamp"
    price = spark.createDataFrame([("A", at(0), "r", at(1))], key)
    price = price.withColumns({c: F.lit(1.0) for c in gold.PRICE_MEASURES} | {"producer_timestamp": F.col("timestamp"), "processing_timestamp": F.col("timestamp")})
    ind = spark.createDataFrame([("A", at(0), "i", at(100)), ("A", at(0), "i2", at(90))], key).withColumns({c: F.lit(2.0) for c in gold.INDICATOR_MEASURES})
    company = gold.dim_company(gold.scd2_snapshot(None, spark.createDataFrame([("A", "a", "x", 1.0, at(0))], schemas.COMPANY_SOURCE), as_of=at(0)))
    before = gold.increment_fact_prices(None, price, ind.limit(0), company)
    assert before.first()["rsi_14"] is None
    after = gold.increment_fact_prices(before, price, ind, company, prices_since=at(1), indicators_since=at(1))
    assert after.count() == 1 and after.first()["rsi_14"] == 2.0 and after.first()["company_key"]


def test_time_dimension(spark):
    d = {r["time_key"]: r["market_session"] for r in gold.dim_time(spark).collect()}
    assert [d[k] for k in (569, 570, 959, 960)] == ["pre-market", "regular", "regular", "after-hours"]
    assert gold.dim_date(spark).count() == 4018


def test_gold_build(spark, sf_dir, tmp_path):
    e = queries.enriched(spark, sf_dir)
    raw = {n: queries.landed(p) for n, p in pipelines.all_products(e).items()}
    source = e.select("symbol").distinct().select("symbol", F.col("symbol").alias("company_name"), F.lit("x").alias("exchange"), F.lit(1.0).alias("market_cap"), F.lit(at(0)).alias("source_timestamp"))
    found = pipelines.build_gold(spark, raw, source, f"{tmp_path}/gold", as_of=at(0), version="v1", failures=f"{tmp_path}/failures")
    assert {k: v for k, v in found.items() if k != "date_of_price"} == {k: 0 for k in found if k != "date_of_price"}
    assert gold.current(spark, f"{tmp_path}/gold/fact_stock_prices").filter("company_key is null").isEmpty()


def test_stored_failures(spark, tmp_path):
    assert checks.store_failures(checks.check_not_null(tick_frame(spark, [1, 2]).withColumn("x", F.lit(None).cast("int")), "x"), f"{tmp_path}/f") == 2


def test_alert_severities(spark):
    df = tick_frame(spark, [-1] * 10 + [5] * 90, step=1)
    a = checks.quality_alerts(df).collect()
    assert [(r["rule"], r["severity"], r["failed_count"]) for r in a] == [("price_validation", "ERROR", 10)]


def test_rows_frames_in_blocks(spark, sf_dir, monkeypatch):
    """A symbol's rows in many blocks give what one partition gives, nulls among keys and times included."""
    from tickspark.operators import frames

    monkeypatch.setattr(frames.rolling_rows, "__kwdefaults__", frames.rolling_rows.__kwdefaults__ | {"block": 37})
    t = queries.ticks(spark, sf_dir).filter("event_id < 600")
    odd = t.filter("event_id < 5").withColumns({"processing_timestamp": F.lit(None).cast("timestamp"), "event_id": F.col("event_id") + 1000})
    odd = odd.unionByName(t.filter("event_id < 5").withColumns({"symbol": F.lit(None).cast("string"), "event_id": F.col("event_id") + 2000}))
    t = t.unionByName(odd).select("event_id", "symbol", "processing_timestamp", "current_price", "volume")
    for build in (
        lambda **k: indicators.moving_averages(t, windows={"9": 9, "50": 50}, frame="rows", **k),
        lambda **k: indicators.macd(t, method="ema", periods=(3, 6, 2), **k),
        lambda **k: indicators.bollinger_bands(t, window=20, frame="rows", **k),
    ):
        plain, cut = build(), build(bucket=3600)
        cols = ["event_id", *[queries.r6(c) for c in plain.columns if c not in t.columns]]
        assert cut.columns == plain.columns and cut.count() == t.count()
        assert cut.select(cols).exceptAll(plain.select(cols)).isEmpty()
