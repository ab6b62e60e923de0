"""From message bytes and API documents to canonical ticks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions import expressions as E
from ..operators.metrics import split_rejects


def project_envelope(df: DataFrame) -> DataFrame:
    """Key as text, value as bytes, and where and when the message lay."""
    return df.select(F.col("key").cast("string").alias("key"), F.col("value").cast("binary").alias("value"), "topic", "partition", "offset", F.col("timestamp").alias("kafka_timestamp"))


def strip_wire_header(df: DataFrame, value: str = "value", into: str = "payload") -> DataFrame:
    """The bytes after the five of the wire header; null where there are none."""
    return df.withColumn(into, F.when(F.length(value) > 5, F.expr(f"substring(`{value}`, 6)")))


def decode_payload(df: DataFrame, schema: T.StructType | str, *, payload: str = "payload", into: str = "data", fmt: str = "json") -> DataFrame:
    """The payload as a struct; rows that can't be decoded are left out (see ``undecodable``).

    ``fmt="avro"`` takes an Avro schema as JSON and needs the Avro package on the class path.
    """
    if fmt == "avro":
        from pyspark.sql.avro.functions import from_avro

        decoded = df.withColumn(into, from_avro(payload, schema, {"mode": "PERMISSIVE"}))
        return decoded.filter(F.col(into).isNotNull())
    return _json(df, schema, payload, into).filter(F.col(into).isNotNull())


def _json(df: DataFrame, schema: T.StructType, payload: str, into: str) -> DataFrame:
    loose = T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields] + [T.StructField("_corrupt", T.StringType())])
    parsed = F.from_json(F.col(payload).cast("string"), loose, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    df = df.withColumn(into, parsed)
    return df.withColumn(into, F.when(F.col(f"{into}._corrupt").isNull() & F.col(into).isNotNull(), F.struct(*[F.col(f"{into}.{f.name}").alias(f.name) for f in schema.fields])))


def undecodable(df: DataFrame, schema: T.StructType, *, payload: str = "payload") -> DataFrame:
    """The rows that ``decode_payload`` leaves out, with a reason."""
    d = _json(df, schema, payload, "_data").filter(F.col("_data").isNull()).drop("_data")
    return d.withColumn("error_reason", F.when(F.col(payload).isNull(), "no payload").otherwise("undecodable payload"))


def decode_by_topic(df: DataFrame, topics: dict[str, T.StructType], *, fmt: str = "json") -> DataFrame:
    """Each topic decoded with its own schema, joined by name; columns one topic lacks are null."""
    out = None
    for topic, schema in topics.items():
        part = decode_payload(df.filter(F.col("topic") == topic), schema, fmt=fmt)
        part = part.select("topic", "partition", "offset", "kafka_timestamp", "data.*")
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def to_canonical_ticks(df: DataFrame) -> DataFrame:
    """Decoded rows as canonical ticks: casts, event time, defaults; no null symbol or time.

    Event time is the payload's milliseconds, else the message's. A missing price is the
    close of a bar, else the low, else 0, which validation turns away with a reason.
    """
    have = lambda n, k: F.col(n).cast(k) if n in df.columns else F.lit(None).cast(k)
    price = F.coalesce(have("current_price", "double"), have("close_price", "double"), have("low_price", "double"), F.lit(0.0))
    ms = have("timestamp", "long")
    d = df.select(
        "topic", "partition", "offset", "kafka_timestamp", F.col("symbol").cast("string").alias("symbol"), price.alias("current_price"),
        *[F.coalesce(have(n, "double"), price).alias(n) for n in ("open_price", "high_price", "low_price", "previous_close")],
        F.coalesce(have("change", "double"), F.lit(0.0)).alias("change"), F.coalesce(have("volume", "long"), F.lit(0).cast("long")).alias("volume"),
        ms.alias("payload_timestamp_ms"), F.coalesce(F.timestamp_millis(ms), F.col("kafka_timestamp")).alias("processing_timestamp"),
    )
    return d.filter(F.col("symbol").isNotNull() & F.col("processing_timestamp").isNotNull())


def parse_quotes(df: DataFrame, *, document: str = "document", version: str = "1.0", source: str = "api") -> DataFrame:
    """Quote documents as typed rows, beside the other columns.

    Keys are numbered ("05. price"); values that are no number are null, a missing price is
    0.0, a missing symbol UNKNOWN. Percent signs are taken off.
    """
    q = F.from_json(F.col(document), schemas.QUOTE_DOCUMENT)["Global Quote"]
    text = lambda k: F.when(~F.trim(q[k]).isin("", "None"), q[k])
    now = F.current_timestamp()
    return df.select(
        *[c for c in df.columns if c != document],
        F.coalesce(text("01. symbol"), F.lit("UNKNOWN")).alias("symbol"),
        E.number(text("02. open")).alias("open_price"), E.number(text("03. high")).alias("high_price"), E.number(text("04. low")).alias("low_price"),
        F.coalesce(E.number(text("05. price")), F.lit(0.0)).alias("current_price"), E.number(text("06. volume"), "bigint").alias("volume"),
        text("07. latest trading day").alias("latest_trading_day"), E.number(text("08. previous close")).alias("previous_close"),
        E.number(text("09. change")).alias("change"), E.number(text("10. change percent")).alias("change_percent"),
        F.unix_millis(now).alias("timestamp"),
        F.struct(now.cast("string").alias("producer_timestamp"), F.lit(version).alias("producer_version"), F.lit(source).alias("data_source")).alias("producer_metadata"),
    )


def parse_intraday(df: DataFrame, *, document: str = "document", latest_only: bool = False) -> DataFrame:
    """Intraday documents as one row a bar, beside the other columns; with ``latest_only`` the last bar of each.

    The series lies under any key "Time Series (<interval>)". Values that are no number are 0.
    """
    whole = T.MapType(T.StringType(), T.StringType())
    top = F.from_json(F.col(document), whole)
    name = F.filter(F.map_keys(top), lambda k: k.startswith("Time Series"))[0]
    symbol = F.coalesce(F.from_json(top["Meta Data"], whole)["2. Symbol"], F.lit("UNKNOWN"))
    series = F.from_json(F.element_at(top, name), T.MapType(T.StringType(), schemas.BAR_FIELDS))
    rest = [c for c in df.columns if c != document]
    d = df.select(*rest, symbol.alias("symbol"), F.regexp_extract(name, r"\((.*)\)", 1).alias("interval"), series.alias("_series"))
    if latest_only:
        last = F.array_max(F.map_keys("_series"))
        d = d.withColumn("_series", F.when(F.size("_series") > 0, F.create_map(last, F.element_at("_series", last))))
    d = d.select(*rest, "symbol", "interval", F.explode("_series").alias("_time", "_bar"))
    value = lambda k, t="double": F.coalesce(E.number(F.col("_bar")[k], t), F.lit(0).cast(t))
    return d.select(
        *rest, "symbol", F.unix_millis(F.col("_time").try_cast("timestamp")).alias("timestamp"),
        value("1. open").alias("open_price"), value("2. high").alias("high_price"), value("3. low").alias("low_price"), value("4. close").alias("close_price"),
        value("5. volume", "bigint").alias("volume"), "interval",
    )


def contract_errors(schema: T.StructType, columns: list[str]) -> Column:
    """Which required fields are absent or null, joined; null where none is."""
    bad = [F.when(F.col(f.name).isNull() if f.name in columns else F.lit(True), f.name) for f in schema.fields if not f.nullable]
    return F.nullif(F.array_join(F.filter(F.array(*bad) if bad else F.array().cast("array<string>"), lambda x: x.isNotNull()), ", "), F.lit(""))


def validate_contract(df: DataFrame, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """(rows that fulfil the contract, the others with ``error_reason``). Types must agree or ValueError."""
    for f in schema.fields:
        if f.name in df.columns and df.schema[f.name].dataType.simpleString() != f.dataType.simpleString():
            raise ValueError(f"{f.name} is {df.schema[f.name].dataType.simpleString()}, not {f.dataType.simpleString()}")
    return split_rejects(df, F.concat(F.lit("missing: "), contract_errors(schema, df.columns)))
