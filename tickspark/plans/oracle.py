"""DuckDB SQL of the registered queries, over the same tables."""

from __future__ import annotations

TICKS = """
t0 AS (SELECT event_id, upper(event_type) AS symbol,
         1704067200000000 + ((epoch_us(ts) - 1704067200000000) // 30) AS us,
         value AS current_price, CAST(json_extract_string(props, '$.k') AS BIGINT) * 10000 AS volume FROM events),
t1 AS (SELECT *, make_timestamp(us) AS processing_timestamp,
         coalesce(lag(current_price) OVER (PARTITION BY symbol ORDER BY us, event_id), current_price) AS previous_close FROM t0),
ticks AS (SELECT event_id, symbol, us, processing_timestamp, current_price, volume, previous_close,
         previous_close AS open_price, greatest(previous_close, current_price) AS high_price,
         least(previous_close, current_price) AS low_price, current_price - previous_close AS change FROM t1)"""

DIRTY = TICKS + """,
dirty AS (SELECT event_id, symbol, us, processing_timestamp, previous_close, open_price, low_price, change,
  CASE WHEN event_id % 97 = 0 THEN low_price - 1 ELSE high_price END AS high_price,
  CASE WHEN event_id % 89 = 0 THEN NULL WHEN event_id % 73 = 0 THEN -1 ELSE volume END AS volume,
  CASE WHEN event_id % 83 = 0 THEN NULL WHEN event_id % 79 = 0 THEN -current_price ELSE current_price END AS current_price
  FROM ticks)"""


#: Values with few decimals average to exact halves of 1e-6, so the border of rounding lies elsewhere.
def r6(x: str, name: str | None = None) -> str:
    return f"floor(({x}) * 1e6 + 0.3) / 1e6" + (f" AS {name}" if name else "")


def over(seconds: int, extra: str = "") -> str:
    return f"OVER (PARTITION BY symbol ORDER BY us RANGE BETWEEN {seconds * 1_000_000} PRECEDING AND CURRENT ROW{extra})"


SCORE = """CASE WHEN current_price IS NULL OR current_price <= 0 OR volume < 0
  OR NOT (high_price >= low_price AND current_price >= low_price AND current_price <= high_price) THEN 0.0
  WHEN volume IS NULL THEN 0.7 ELSE 1.0 END"""


def session(ts: str = "processing_timestamp") -> str:
    return f"CASE WHEN hour({ts}) BETWEEN 9 AND 16 THEN 'regular' WHEN hour({ts}) BETWEEN 4 AND 9 THEN 'pre_market' ELSE 'after_hours' END"


def trend(x: str, m: str) -> str:
    return f"CASE WHEN {x} > {m} THEN 'up' WHEN {x} < {m} THEN 'down' ELSE 'neutral' END"


ENRICHED = TICKS + f""",
e0 AS (SELECT *, current_price - lag(current_price) OVER (PARTITION BY symbol ORDER BY us, event_id) AS move FROM ticks),
e1 AS (SELECT *, CASE WHEN move > 0 THEN move ELSE 0 END AS gain, CASE WHEN move < 0 THEN -move ELSE 0 END AS loss,
  abs(change) AS price_change_abs, CASE WHEN current_price > 0 THEN (high_price - low_price) / current_price * 100 ELSE 0 END AS price_volatility,
  CASE WHEN previous_close > 0 THEN (current_price - previous_close) / previous_close ELSE 0 END AS price_momentum,
  {SCORE} AS data_quality_score FROM e0),
e2 AS (SELECT *, avg(current_price) {over(300)} AS sma_5min, avg(current_price) {over(1200)} AS sma_20min,
  avg(volume) {over(300)} AS volume_ma_5min, avg(volume) {over(1200)} AS volume_ma_20min,
  CASE WHEN volume > 0 THEN sum(current_price * volume) {over(300)} / nullif(sum(volume) {over(300)}, 0) ELSE current_price END AS vwap,
  avg(gain) {over(840)} AS up, avg(loss) {over(840)} AS down,
  avg(current_price) {over(1200)} AS bollinger_middle, stddev_samp(current_price) {over(1200)} AS dev,
  stddev_samp(volume) {over(1200)} AS vdev,
  avg(current_price) {over(720)} - avg(current_price) {over(1560)} AS macd FROM e1),
e3 AS (SELECT *, avg(macd) {over(540)} AS macd_signal, CASE WHEN down = 0 THEN 100 ELSE 100 - 100 / (1 + up / down) END AS rsi_14,
  bollinger_middle + 2 * dev AS bollinger_upper, bollinger_middle - 2 * dev AS bollinger_lower,
  CASE WHEN dev IS NULL OR dev = 0 THEN 0 ELSE (current_price - bollinger_middle) / dev END AS price_zscore,
  CASE WHEN vdev IS NULL OR vdev = 0 THEN 0 ELSE (volume - volume_ma_20min) / vdev END AS volume_zscore,
  CASE WHEN volume_ma_5min > 0 THEN volume / volume_ma_5min ELSE 1 END AS volume_ratio FROM e2),
enriched AS (SELECT *, macd - macd_signal AS macd_histogram, abs(price_zscore) > 3 AS is_price_anomaly, abs(volume_zscore) > 3 AS is_volume_anomaly,
  greatest(abs(price_zscore), abs(volume_zscore)) AS anomaly_score,
  {trend("current_price", "sma_5min")} AS price_trend_5min, {trend("volume", "volume_ma_5min")} AS volume_trend,
  CASE WHEN volume_ratio > 2 THEN 'high' WHEN volume_ratio > 1.5 THEN 'above_average' WHEN volume_ratio < 0.5 THEN 'low' ELSE 'normal' END AS volume_category,
  {session()} AS trading_session FROM e3)"""

PRICES = ["sma_5min", "sma_20min", "vwap", "price_volatility", "price_change_abs", "price_momentum"]
BANDS = ["bollinger_middle", "bollinger_upper", "bollinger_lower"]


def enriched(*columns: str, rounded: tuple[str, ...] = ()) -> str:
    return f"WITH {ENRICHED} SELECT {', '.join([*columns, *[r6(c, c) for c in rounded]])} FROM enriched"


TWO = "floor(({}) * 100 + 0.5) / 100"
BARS = """bars AS (SELECT symbol, time_bucket(INTERVAL '{}', processing_timestamp) AS w, arg_min(current_price, us) AS o, max(current_price) AS h,
  min(current_price) AS l, arg_max(current_price, us) AS c, sum(volume) AS v, count(*) AS n, avg(current_price) AS a,
  sum(current_price * volume) AS pv, stddev_samp(current_price) AS sd, max(us) AS last_us FROM ticks GROUP BY ALL)"""

OHLCV = f"""WITH {TICKS}, {BARS.format('1 minute')}
SELECT symbol, epoch_us(w) AS window_start_us, o AS open, h AS high, l AS low, c AS close, CAST(v AS BIGINT) AS total_volume, n AS tick_count,
  {r6('a', 'avg_price')}, {r6('pv / nullif(v, 0)', 'vwap')}, {r6('sd', 'price_std')}, {r6('c - o', 'price_change')},
  {r6('(c - o) / nullif(o, 0) * 100', 'price_change_percent')}, {r6('sd / nullif(a, 0) * 100', 'volatility')}, last_us AS last_update_us FROM bars"""

COMPANIES = """src AS (SELECT CAST(o_custkey AS VARCHAR) AS symbol, c_name AS company_name, o_orderpriority AS exchange, o_totalprice AS market_cap,
  o_orderdate AS source_timestamp, o_orderkey FROM orders JOIN customer ON o_custkey = c_custkey),
s1 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY source_timestamp DESC, o_orderkey DESC) AS k FROM src
  WHERE source_timestamp < TIMESTAMP '1998-01-01') WHERE k = 1),
s2 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY source_timestamp DESC, o_orderkey DESC) AS k FROM src
  WHERE source_timestamp >= TIMESTAMP '1998-01-01') WHERE k = 1),
history AS (
  SELECT a.symbol, a.company_name, a.exchange, a.market_cap, '1998-01-01' AS valid_from,
    CASE WHEN b.symbol IS NULL OR a.company_name IS DISTINCT FROM b.company_name OR a.exchange IS DISTINCT FROM b.exchange
      OR a.market_cap IS DISTINCT FROM b.market_cap THEN '1999-01-01' END AS valid_to FROM s1 a LEFT JOIN s2 b USING (symbol)
  UNION ALL
  SELECT b.symbol, b.company_name, b.exchange, b.market_cap, '1999-01-01', NULL FROM s2 b LEFT JOIN s1 a USING (symbol)
  WHERE a.symbol IS NULL OR a.company_name IS DISTINCT FROM b.company_name OR a.exchange IS DISTINCT FROM b.exchange OR a.market_cap IS DISTINCT FROM b.market_cap)"""

HISTORY_KEYS = "md5(symbol || '|' || valid_from || ' 00:00:00') AS company_key"
KEYED = "md5(symbol || '::' || strftime(make_timestamp(us), '%Y-%m-%d %H:%M:%S') || CASE WHEN us % 1000000 = 0 THEN '' ELSE rtrim('.' || lpad(CAST(us % 1000000 AS VARCHAR), 6, '0'), '0') END)"
DATE_KEY = "CAST(strftime(processing_timestamp, '%Y%m%d') AS INTEGER) AS date_key"
CALENDAR = f"{DATE_KEY}, CAST(hour(processing_timestamp) * 60 + minute(processing_timestamp) AS INTEGER) AS time_key"


def decimal(x: str, kind: str) -> str:
    return f"CAST(CAST(CAST({r6(x)} AS VARCHAR) AS {kind}) AS DOUBLE) AS {x}"


STAGED_PRICES = ", ".join([*[decimal(c, "DECIMAL(10,2)") for c in ("current_price", "open_price", "high_price", "low_price")], *[decimal(c, "DECIMAL(10,4)") for c in PRICES]])

REASON = """CASE WHEN current_price IS NULL OR NOT (current_price > 0 AND current_price < 1000000) THEN 'price out of range'
  WHEN volume IS NULL OR NOT (volume >= 0 AND volume < 1000000000) THEN 'volume out of range' END"""


def rows(n: int) -> str:
    return f"OVER (PARTITION BY symbol ORDER BY us, event_id ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


def ema_step(before: str, x: str, n: int) -> str:
    a = 2.0 / (n + 1)
    return f"{before} * (1 - CAST({a!r} AS DOUBLE)) + {x} * CAST({a!r} AS DOUBLE)"


HOUR_OF = "CAST(year({0}) AS INTEGER) AS year, CAST(month({0}) AS INTEGER) AS month, CAST(day({0}) AS INTEGER) AS day, CAST(hour({0}) AS INTEGER) AS hour"

SQL: dict[str, str] = {
    "moving_averages": enriched("event_id", "symbol", "us", rounded=("sma_5min", "sma_20min", "volume_ma_5min", "volume_ma_20min")),
    "moving_averages_1hour": f"WITH {TICKS} SELECT event_id, {r6(f'avg(current_price) {over(3600)}', 'sma_1hour')}, {r6(f'avg(current_price) {over(3000)}', 'sma_50min')}, {r6(f'avg(volume) {over(3600)}', 'volume_ma_1hour')} FROM ticks",
    "moving_averages_rows": f"WITH {TICKS} SELECT event_id, {r6('avg(current_price) OVER (PARTITION BY symbol ORDER BY us, event_id ROWS BETWEEN 13 PRECEDING AND CURRENT ROW)', 'sma_14')}, {r6('avg(current_price) OVER (PARTITION BY symbol ORDER BY us, event_id ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)', 'sma_20')} FROM ticks",
    "rsi_rows": f"""WITH {TICKS}, m AS (SELECT *, current_price - lag(current_price) OVER (PARTITION BY symbol ORDER BY us, event_id) AS move FROM ticks),
      g AS (SELECT *, avg(CASE WHEN move > 0 THEN move ELSE 0 END) {rows(14)} AS up, avg(CASE WHEN move < 0 THEN -move ELSE 0 END) {rows(14)} AS down FROM m)
      SELECT event_id, {r6('CASE WHEN down = 0 THEN 100 ELSE 100 - 100 / (1 + up / down) END', 'rsi_14')} FROM g""",
    "bollinger_rows": f"""WITH {TICKS}, m AS (SELECT event_id, avg(current_price) {rows(20)} AS mid, stddev_samp(current_price) {rows(20)} AS dev FROM ticks)
      SELECT event_id, {r6('mid', 'bollinger_middle')}, {r6('mid + 2 * dev', 'bollinger_upper')}, {r6('mid - 2 * dev', 'bollinger_lower')} FROM m""",
    "macd_ema": f"""WITH RECURSIVE {TICKS}, n AS MATERIALIZED (SELECT event_id, symbol, current_price AS x, row_number() OVER (PARTITION BY symbol ORDER BY us, event_id) AS k FROM ticks),
      e AS (SELECT event_id, symbol, k, x AS f, x AS s, CAST(0 AS DOUBLE) AS g FROM n WHERE k = 1
        UNION ALL SELECT event_id, symbol, k, f, s, {ema_step('g', '(f - s)', 9)} FROM (
          SELECT n.event_id, n.symbol, n.k, {ema_step('e.f', 'n.x', 12)} AS f, {ema_step('e.s', 'n.x', 26)} AS s, e.g FROM e JOIN n ON n.symbol = e.symbol AND n.k = e.k + 1))
      SELECT event_id, {r6('f - s', 'macd')}, {r6('g', 'macd_signal')}, {r6('f - s - g', 'macd_histogram')} FROM e""",
    "output_contract": f"""WITH {ENRICHED} SELECT symbol, us // 1000 AS "timestamp", us // 1000 AS processing_timestamp, {r6('current_price', 'current_price')} FROM enriched WHERE current_price > 0""",
    "serialized_prices": f"WITH {ENRICHED} SELECT symbol AS key, symbol, 'stock_prices' AS record_type, trading_session, volume, {r6('current_price', 'current_price')}, {r6('sma_5min', 'sma_5min')} FROM enriched WHERE current_price > 0",
    "archived_products": f"WITH {ENRICHED} SELECT symbol, us, volume FROM enriched WHERE processing_timestamp BETWEEN TIMESTAMP '2024-01-01 00:00:00' AND TIMESTAMP '2024-01-01 12:00:00'",
    "gold_build": f"""WITH {ENRICHED}, co AS (SELECT count(DISTINCT upper(event_type)) AS n FROM events JOIN orders ON o_orderkey = event_id),
      p AS (SELECT count(*) AS n, count(DISTINCT (symbol, us)) AS k FROM enriched WHERE current_price > 0), v AS (SELECT count(*) AS n, count(DISTINCT (symbol, us)) AS k FROM enriched)
      SELECT 'stg_stock_prices' AS name, n FROM p UNION ALL SELECT 'fact_stock_prices', k FROM p UNION ALL SELECT 'stg_trading_volume', n FROM v UNION ALL SELECT 'stg_technical_indicators', n FROM v
      UNION ALL SELECT 'fact_trading_volume', k FROM v UNION ALL SELECT unnest(['company_history', 'dim_company']), n FROM co UNION ALL SELECT 'dim_date', DATE '2031-01-01' - DATE '2020-01-01' UNION ALL SELECT 'dim_time', 1440
      UNION ALL SELECT unnest(['stock_price_key_unique', 'stock_price_key_not_null', 'trading_volume_key_unique', 'company_of_price', 'company_of_volume', 'date_of_price', 'time_of_price', 'one_current_company']), 0""",
    "price_trend": enriched("event_id", "price_trend_5min", "volume_trend"),
    "price_metrics": f"""WITH {DIRTY} SELECT event_id, {r6('abs(change)', 'price_change_abs')},
      {r6('CASE WHEN current_price > 0 THEN (high_price - low_price) / current_price * 100 ELSE 0 END', 'price_volatility')},
      {r6('CASE WHEN previous_close > 0 THEN (current_price - previous_close) / previous_close ELSE 0 END', 'price_momentum')}, CAST({SCORE} AS DOUBLE) AS data_quality_score FROM dirty""",
    "quality_flags": f"""WITH {DIRTY} SELECT event_id, current_price IS NULL AS has_null_price, current_price = 0 AS has_zero_price, current_price < 0 AS has_negative_price,
      volume IS NULL AS has_null_volume, volume < 0 AS has_negative_volume,
      (high_price >= low_price AND current_price >= low_price AND current_price <= high_price) AS price_range_valid, CAST({SCORE} AS DOUBLE) AS data_quality_score FROM dirty""",
    "classify_market": f"""WITH {TICKS} SELECT event_id, CASE WHEN current_price * volume > 1000000 THEN 'large' WHEN current_price * volume > 100000 THEN 'medium' ELSE 'small' END AS market_cap_category,
      {session()} AS trading_session, CASE WHEN volume > 1000000 THEN 'high' WHEN volume > 100000 THEN 'medium' WHEN volume > 0 THEN 'low' ELSE 'unknown' END AS volume_size_class FROM ticks""",
    "market_context": f"""WITH {TICKS} SELECT event_id, strftime(processing_timestamp, '%Y-%m-%d') AS trading_day, CAST(hour(processing_timestamp) AS INTEGER) AS trading_hour,
      CAST(minute(processing_timestamp) AS INTEGER) AS trading_minute, hour(processing_timestamp) >= 9 AND hour(processing_timestamp) < 16 AS is_market_hours,
      CASE WHEN hour(processing_timestamp) BETWEEN 4 AND 8 THEN 'pre_market' WHEN hour(processing_timestamp) BETWEEN 9 AND 15 THEN 'regular'
        WHEN hour(processing_timestamp) BETWEEN 16 AND 19 THEN 'after_hours' ELSE 'closed' END AS market_session_detailed,
      CAST(dayofweek(processing_timestamp) + 1 AS INTEGER) AS day_of_week, dayofweek(processing_timestamp) IN (0, 6) AS is_weekend FROM ticks""",
    "ensure_columns": f"WITH {TICKS} SELECT event_id, current_price, current_price AS open_price, current_price AS high_price, current_price AS low_price, previous_close, change FROM ticks",
    "rsi": enriched("event_id", rounded=("rsi_14",)),
    "rsi_signal": enriched("event_id", "CASE WHEN rsi_14 > 70 THEN 'overbought' WHEN rsi_14 < 30 THEN 'oversold' ELSE 'neutral' END AS rsi_signal"),
    "bollinger": enriched("event_id", rounded=tuple(BANDS)),
    "bollinger_position": f"WITH {ENRICHED} SELECT event_id, {r6('(current_price - bollinger_lower) / nullif(bollinger_upper - bollinger_lower, 0)', 'bollinger_position')} FROM enriched",
    "macd": enriched("event_id", rounded=("macd", "macd_signal", "macd_histogram")),
    "rolling_vwap": enriched("event_id", rounded=("vwap",)),
    "volume_metrics": enriched("event_id", "volume_category", rounded=("volume_ratio", "vwap")).replace(" AS vwap", " AS volume_weighted_price", 2).replace("END AS volume_weighted_price", "END AS vwap", 1),
    "price_anomalies": enriched("event_id", "is_price_anomaly", "is_volume_anomaly", rounded=("price_zscore", "volume_zscore", "anomaly_score")),
    "support_resistance": f"WITH {TICKS} SELECT event_id, min(low_price) {over(1200)} AS support, max(high_price) {over(1200)} AS resistance FROM ticks",
    "volatility_level": enriched("event_id", "CASE WHEN price_volatility < 10 THEN 'low' WHEN price_volatility < 50 THEN 'medium' WHEN price_volatility IS NOT NULL THEN 'high' END AS volatility_level"),
    "enrich_full": enriched("event_id", "symbol", "price_trend_5min", "volume_trend", "volume_category", "trading_session", "is_price_anomaly", "strftime(processing_timestamp, '%Y-%m-%d') AS trading_day", rounded=("sma_5min", "sma_20min", "vwap", "rsi_14", "bollinger_upper", "macd", "macd_signal", "anomaly_score", "volume_ratio")),
    "validate_ticks": f"WITH {DIRTY} SELECT event_id, coalesce({REASON}, 'accepted') AS outcome FROM dirty",
    "ohlcv_bars": OHLCV,
    "stream_ohlcv": OHLCV,
    "sliding_bars": f"""WITH {TICKS}, s AS (SELECT symbol, unnest([us // 60000000 * 60000000 - k * 60000000 FOR k IN range(5)]) AS window_start_us, current_price, volume FROM ticks)
      SELECT symbol, window_start_us, max(current_price) AS high, min(current_price) AS low, CAST(sum(volume) AS BIGINT) AS total_volume, count(*) AS tick_count FROM s GROUP BY ALL""",
    "volume_profile": f"""WITH {TICKS} SELECT symbol, floor(current_price / 0.5) * 0.5 AS price_bucket, epoch_us(time_bucket(INTERVAL '5 minutes', processing_timestamp)) AS window_start_us,
      CAST(sum(volume) AS BIGINT) AS volume_at_price, count(*) AS tick_count, {r6('avg(current_price)', 'avg_price')} FROM ticks GROUP BY ALL""",
    "lineitem_profile": f"""SELECT CAST(l_partkey % 50 AS VARCHAR) AS symbol, floor(l_extendedprice / 1000.0) * 1000.0 AS price_bucket, epoch_us(time_bucket(INTERVAL '7 days', CAST(l_shipdate AS TIMESTAMP), TIMESTAMP '1970-01-01')) AS window_start_us,
      CAST(sum(l_quantity) AS DOUBLE) AS volume_at_price, count(*) AS tick_count, floor(avg(l_extendedprice) * 1e4 + 0.5) / 1e4 AS avg_price FROM lineitem GROUP BY ALL""",
    "product_prices": enriched("symbol", "us", "current_price", "current_price AS close_price", "open_price", "high_price", "low_price", "volume", "price_trend_5min", "trading_session", "CAST(data_quality_score AS DOUBLE) AS data_quality_score", "'silver' AS data_layer", "'stock_prices' AS record_type", "'1.0' AS processing_version", rounded=tuple(PRICES)) + " WHERE current_price > 0 AND current_price < 1000000 AND volume >= 0 AND volume < 1000000000",
    "product_volume": enriched("symbol", "us", "volume", "volume_trend", "volume_category", "is_volume_anomaly AS volume_anomaly", "'trading_volume' AS record_type", r6("CASE WHEN vwap >= 0 THEN vwap END", "volume_weighted_price"), rounded=("volume_ma_5min", "volume_ma_20min", "volume_ratio")),
    "product_indicators": enriched("symbol", "us", "'technical_indicators' AS record_type", r6("least(greatest(rsi_14, 0), 100)", "rsi_14"), r6("CASE WHEN abs(macd) > 1000 THEN 0 ELSE macd END", "macd"), *[r6(f"coalesce({b}, current_price)", b) for b in BANDS], rounded=("macd_signal", "macd_histogram")),
    "decode_envelope": f"""WITH {TICKS} SELECT event_id AS "offset", CASE WHEN event_id % 2 = 0 THEN 'stock-quotes' ELSE 'intraday-data' END AS topic, CAST(event_id % 3 AS INTEGER) AS "partition", symbol,
      {r6('current_price', 'current_price')}, {r6('open_price', 'open_price')}, {r6('CASE WHEN event_id % 2 = 0 THEN previous_close ELSE current_price END', 'previous_close')},
      {r6('CASE WHEN event_id % 2 = 0 THEN change ELSE 0 END', 'change')}, volume, us // 1000 AS payload_timestamp_ms FROM ticks
      WHERE event_id % 101 <> 0 AND event_id % 103 <> 0 AND current_price > 0 AND current_price < 1000000""",
    "undecodable": f"WITH {TICKS} SELECT event_id AS \"offset\", CASE WHEN event_id % 103 = 0 THEN 'no payload' ELSE 'undecodable payload' END AS error_reason FROM ticks WHERE event_id % 2 = 0 AND (event_id % 101 = 0 OR event_id % 103 = 0)",
    "parse_quotes": f"""WITH {TICKS} SELECT event_id, symbol, {', '.join(f"{TWO.format(c)} AS {c}" for c in ('open_price', 'high_price', 'low_price', 'current_price', 'previous_close', 'change'))}, volume,
      floor(change / nullif(previous_close, 0) * 1000000 + 0.5) / 10000 AS change_percent, strftime(processing_timestamp, '%Y-%m-%d') AS latest_trading_day FROM ticks""",
    "parse_intraday": f"""WITH {TICKS}, {BARS.format('5 minutes')} SELECT symbol, epoch_us(w) // 1000 AS "timestamp", '5min' AS "interval", {TWO.format('o')} AS open_price, {TWO.format('h')} AS high_price, {TWO.format('l')} AS low_price, {TWO.format('c')} AS close_price, CAST(v AS BIGINT) AS volume FROM bars""",
    "parse_intraday_latest": f"""WITH {TICKS}, {BARS.format('5 minutes')}, k AS (SELECT *, row_number() OVER (PARTITION BY symbol, date_trunc('hour', w) ORDER BY w DESC) AS k FROM bars)
      SELECT symbol, epoch_us(w) // 1000 AS "timestamp", {TWO.format('c')} AS close_price, CAST(v AS BIGINT) AS volume FROM k WHERE k = 1""",
    "contract_rejects": f"WITH {DIRTY} SELECT event_id, coalesce(CASE WHEN current_price IS NULL THEN 'missing: current_price' END, 'accepted') AS outcome FROM dirty",
    "dead_letters": f"""WITH {DIRTY} SELECT event_id, symbol, error_reason, 'ticks' AS source, CAST(NULL AS VARCHAR) AS topic FROM (SELECT *, {REASON} AS error_reason FROM dirty) WHERE error_reason IS NOT NULL""",
    "stage_prices": f"WITH {ENRICHED} SELECT {KEYED} AS record_id, symbol, us, volume, price_trend_5min, trading_session, {STAGED_PRICES} FROM enriched WHERE current_price > 0",
    "stage_indicators": f"WITH {ENRICHED} SELECT {KEYED} AS record_id, symbol, us, {decimal('rsi_14', 'DECIMAL(5,2)')}, {decimal('macd_signal', 'DECIMAL(10,4)')}, {decimal('bollinger_middle', 'DECIMAL(10,4)')} FROM enriched",
    "stage_volume": f"WITH {ENRICHED} SELECT {KEYED} AS record_id, symbol, us, volume, volume_trend, is_volume_anomaly AS volume_anomaly, volume_category, {decimal('volume_ma_5min', 'DECIMAL(15,2)')}, {decimal('volume_ratio', 'DECIMAL(10,4)')} FROM enriched",
    "incremental_stage": f"WITH {ENRICHED} SELECT symbol, us, volume FROM enriched WHERE us > (SELECT max(us) FROM ticks WHERE hour(processing_timestamp) < 12)",
    "dim_date": """WITH d AS (SELECT CAST(unnest(generate_series(DATE '1992-01-01', DATE '1999-12-31', INTERVAL 1 DAY)) AS DATE) AS d), o AS (SELECT CAST(o_orderdate AS DATE) AS d, count(*) AS n FROM orders GROUP BY 1)
      SELECT CAST(strftime(d.d, '%Y%m%d') AS INTEGER) AS date_key, CAST(year(d.d) AS INTEGER) AS year, CAST(quarter(d.d) AS INTEGER) AS quarter, CAST(month(d.d) AS INTEGER) AS month, CAST(day(d.d) AS INTEGER) AS day,
      CAST(dayofweek(d.d) AS INTEGER) AS day_of_week, monthname(d.d) AS month_name, dayname(d.d) AS day_name, dayofweek(d.d) BETWEEN 1 AND 5 AS is_weekday, coalesce(n, 0) AS n_orders FROM d LEFT JOIN o USING (d)""",
    "dim_time": f"""WITH {TICKS}, m AS (SELECT CAST(range AS INTEGER) AS time_key FROM range(1440)), n AS (SELECT CAST(hour(processing_timestamp) * 60 + minute(processing_timestamp) AS INTEGER) AS time_key, count(*) AS n FROM ticks GROUP BY 1)
      SELECT time_key, lpad(CAST(time_key // 60 AS VARCHAR), 2, '0') || ':' || lpad(CAST(time_key % 60 AS VARCHAR), 2, '0') || ':00' AS time_value, time_key // 60 AS hour, time_key % 60 AS minute,
      time_key BETWEEN 570 AND 959 AS is_trading_hours, CASE WHEN time_key < 720 THEN 'AM' ELSE 'PM' END AS am_pm,
      CASE WHEN time_key BETWEEN 240 AND 569 THEN 'pre-market' WHEN time_key BETWEEN 570 AND 959 THEN 'regular' WHEN time_key BETWEEN 960 AND 1199 THEN 'after-hours' ELSE 'closed' END AS market_session,
      coalesce(n, 0) AS n_ticks FROM m LEFT JOIN n USING (time_key)""",
    "scd2_company": f"WITH {COMPANIES} SELECT symbol, company_name, exchange, market_cap, valid_from, valid_to, {HISTORY_KEYS} FROM history",
    "dim_company": f"WITH {COMPANIES} SELECT symbol, company_name, valid_to IS NULL AS is_current, {HISTORY_KEYS}, coalesce(valid_to, valid_from) AS updated_at FROM history",
    "latest_per_key": f"WITH {COMPANIES} SELECT symbol, o_orderkey, market_cap FROM s1",
    "fact_prices": f"""WITH {ENRICHED} SELECT {KEYED} AS stock_price_key, {CALENDAR}, symbol, us, volume, trading_session, {STAGED_PRICES}, {decimal('rsi_14', 'DECIMAL(5,2)')}, {decimal('macd_signal', 'DECIMAL(10,4)')} FROM enriched WHERE current_price > 0""",
    "fact_volume": f"WITH {ENRICHED} SELECT {KEYED} AS trading_volume_key, {CALENDAR}, symbol, us, volume, volume_trend, volume_category, {decimal('volume_ratio', 'DECIMAL(10,4)')} FROM enriched",
    "fact_by_company": f"""WITH {ENRICHED}, co AS (SELECT symbol, min(o_orderpriority) AS exchange FROM (SELECT upper(event_type) AS symbol, o_orderpriority FROM (SELECT event_type, event_id FROM events) e JOIN orders ON o_orderkey = event_id) GROUP BY 1)
      SELECT symbol, exchange, count(*) AS n, CAST(sum(volume) AS BIGINT) AS volume FROM enriched LEFT JOIN co USING (symbol) WHERE current_price > 0 GROUP BY ALL""",
    "upsert_merge": f"""WITH {TICKS}, target AS (SELECT event_id, current_price, volume FROM ticks WHERE event_id % 3 <> 0), source AS (SELECT event_id, current_price + 1 AS current_price, volume, symbol FROM ticks WHERE event_id % 2 = 0)
      SELECT event_id, {r6('current_price', 'current_price')}, volume, symbol FROM source UNION ALL SELECT event_id, {r6('current_price')}, volume, NULL FROM target WHERE event_id NOT IN (SELECT event_id FROM source)""",
    "check_unique": "SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1 HAVING count(*) > 1",
    "check_not_null": f"WITH {DIRTY} SELECT event_id, symbol FROM dirty WHERE current_price IS NULL OR volume IS NULL",
    "check_relationship": "SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)",
    "quality_alerts": f"""WITH {DIRTY}, c AS (SELECT epoch_us(time_bucket(INTERVAL '1 hour', processing_timestamp)) AS window_start_us, count(*) AS total_count,
        count(*) FILTER (WHERE coalesce(NOT (current_price > 0 AND current_price < 1000000), true)) AS price_validation,
        count(*) FILTER (WHERE coalesce(NOT (volume >= 0 AND volume < 1000000000), true)) AS volume_validation FROM dirty GROUP BY 1),
      r AS (SELECT 'price_validation' AS rule, window_start_us, price_validation AS failed_count, total_count FROM c UNION ALL SELECT 'volume_validation', window_start_us, volume_validation, total_count FROM c)
      SELECT rule, CASE WHEN failed_count / total_count >= 0.05 THEN 'ERROR' WHEN failed_count / total_count >= 0.01 THEN 'WARNING' ELSE 'INFO' END AS severity, failed_count, total_count, window_start_us FROM r WHERE failed_count > 0""",
    "stream_silver": enriched("event_id", rounded=("sma_5min", "sma_20min", "rsi_14", "macd_signal", "vwap", "bollinger_middle")),
}
GAPS = COMPANIES.replace("o_orderpriority AS exchange", "CASE WHEN o_orderkey % 7 <> 0 THEN o_orderpriority END AS exchange").replace("WHERE source_timestamp", "WHERE exchange IS NOT NULL AND source_timestamp")
SQL["scd2_gaps"] = f"WITH {GAPS} SELECT symbol, company_name, exchange, market_cap, valid_from, valid_to FROM history"
SQL["stream_late_ticks"] = SQL["stream_silver"]
SQL["volume_metrics"] = f"WITH {ENRICHED} SELECT event_id, volume_category, {r6('volume_ratio', 'volume_ratio')}, {r6('vwap', 'volume_weighted_price')} FROM enriched"

HELD = 10 * 60 * 1_000_000
SQL["stream_dropped"] = f"""WITH {TICKS}, marked AS (SELECT *, (us // 300000000) % 7 = 3 AND hour(processing_timestamp) < 12 AS late FROM ticks),
  mark AS (SELECT (max(us) // 1000 - {HELD // 1000}) * 1000 AS us FROM marked WHERE NOT late),
  kept AS (SELECT * FROM marked WHERE NOT late OR us > (SELECT us FROM mark)),
  bars AS (SELECT symbol, us // 60000000 * 60000000 AS w, arg_min(current_price, us) AS o, arg_max(current_price, us) AS c, sum(volume) AS v, count(*) AS n FROM kept GROUP BY ALL)
  SELECT symbol, w AS window_start_us, o AS open, c AS close, CAST(v AS BIGINT) AS total_volume, n AS tick_count,
    (SELECT count(*) FROM marked) - (SELECT count(*) FROM kept) AS dropped FROM bars WHERE w + 60000000 <= (SELECT us FROM mark)"""
PAYLOAD = "CASE WHEN event_id % 101 <> 0 AND event_id % 103 <> 0 THEN {} END"
PAID = f"{r6(PAYLOAD.format('current_price'), 'price')}, coalesce({PAYLOAD.format('volume')}, -1) AS volume"
SQL["archived_messages"] = f"""WITH {TICKS}, m AS (SELECT *, make_timestamp(us + 1000000) AS arrived FROM ticks)
  SELECT event_id AS "offset", CASE WHEN event_id % 2 = 0 THEN 'stock-quotes' ELSE 'intraday-data' END AS topic, CAST(event_id % 3 AS INTEGER) AS "partition", {PAID}, {HOUR_OF.format('arrived')} FROM m"""
SQL["landed_rows"] = f"WITH {TICKS} SELECT symbol AS kafka_key, CAST(event_id % 3 AS INTEGER) AS kafka_partition, event_id AS kafka_offset, us + 1000000 AS us, {PAID} FROM ticks"
SQL["stream_redelivered"] = f"""WITH {TICKS} SELECT event_id AS "offset", CASE WHEN event_id % 2 = 0 THEN 'stock-quotes' ELSE 'intraday-data' END AS topic, CAST(event_id % 3 AS INTEGER) AS "partition", us + 1000000 AS us, {PAID} FROM ticks"""
SQL["product_indicators_pct"] = enriched("symbol", "us", r6("bollinger_middle", "bollinger_middle"), r6("coalesce(bollinger_upper, current_price * 1.02)", "bollinger_upper"), r6("coalesce(bollinger_lower, current_price * 0.98)", "bollinger_lower"))
SQL["stream_facts"] = f"WITH {ENRICHED} SELECT symbol, us, volume, trading_session, {r6('current_price', 'current_price')}, {r6('least(greatest(rsi_14, 0), 100)', 'rsi_14')}, {r6('macd_signal', 'macd_signal')} FROM enriched WHERE current_price > 0"
SQL["stream_health"] = f"""WITH {DIRTY}, n AS (SELECT count(*) AS n, count(*) FILTER (WHERE {REASON} IS NOT NULL) AS bad, count(DISTINCT hour(processing_timestamp) < 12) AS b FROM dirty)
  SELECT 'ticks' AS part, b AS batches, n AS records, bad AS errors, 0 AS n_messages, bad / n < 0.01 AS healthy FROM n
  UNION ALL SELECT unnest(['stock_prices', 'trading_volume', 'technical_indicators']), b, n - bad, 0, 0, true FROM n"""
SQL["merged_hours"] = f"""WITH {TICKS}, m AS (SELECT *, event_id % 2 = 0 AND hour(processing_timestamp) < 12 AS hit FROM ticks)
  SELECT event_id, symbol, us, volume, CAST(hit AS INTEGER) AS round, {r6('current_price + CAST(hit AS INTEGER)', 'current_price')} FROM m"""
SQL["bucketed_facts"] = f"""WITH {ENRICHED} SELECT {KEYED} AS stock_price_key, {DATE_KEY}, symbol, us, volume, {decimal('rsi_14', 'DECIMAL(5,2)')}, {decimal('macd_signal', 'DECIMAL(10,4)')}, {decimal('sma_5min', 'DECIMAL(10,4)')} FROM enriched WHERE current_price > 0"""
SQL["incremental_gold"] = SQL["fact_prices"]
