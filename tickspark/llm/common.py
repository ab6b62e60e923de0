"""Shared pieces of the operators: the shared folder, packed shuffles and components."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows an Arrow batch may hold. Texts can be long, so batches are kept short.
BATCH_ROWS = 500
#: Bytes of packed entries that one bucket should hold; sets how many buckets there are.
BUCKET_BYTES = 4_000_000
#: Parts of a search whose counts may be broadcast.
MOST_PARTS = 10_000
#: Rows of two ids that may be broadcast: 16 MB.
MOST_JUMPS = 1_000_000


def tune(spark: SparkSession) -> None:
    """Short Arrow batches, and shuffle files that go when the job that needs them ends."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir`` where it is set.

    Unset, a local session takes a new temporary folder and any other the warehouse.
    """
    base = spark.conf.get("spark.checkpoint.dir", "")
    if not base:
        if spark.sparkContext.master.startswith(("local[", "local")) and "cluster" not in spark.sparkContext.master:
            base = "file://" + tempfile.mkdtemp(prefix="spark-tickspark-")
        else:
            base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


#: Folders that ``write_shared`` wrote within ``scratch``.
_SCRATCH: ContextVar[list[str] | None] = ContextVar("scratch", default=None)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """What ``write_shared`` writes within is deleted at the end, unless it is kept. No frame that still reads it may leave."""
    made: list[str] = []
    token = _SCRATCH.set(made)
    try:
        yield
    finally:
        _SCRATCH.reset(token)
        for path in made:
            p = spark._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def write_shared(df: DataFrame, name: str, *, keep: bool = False, codec: str = "snappy") -> DataFrame:
    """Write ``df`` as Parquet below the shared folder and read it back: lineage ends here. Within ``scratch`` it goes at the end unless ``keep``."""
    spark, made = df.sparkSession, _SCRATCH.get()
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    if made is not None and not keep:
        made.append(path)
    schema = df.schema
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(schema).parquet(path)


def text_bytes(df: DataFrame, text: str = "text") -> int:
    """Total bytes of a text column."""
    return df.agg(F.sum(F.octet_length(text)).alias("n")).first()["n"] or 0


def one_row_per_id(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text) with null texts empty, rows without an id left out, each id once.

    An id that comes more than once keeps its smallest text. Looking for such ids costs
    one aggregation over the ids alone; texts are shuffled only where there are some.
    """
    rows = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.filter(F.col("doc_id").isNotNull())
    if not rows.groupBy("doc_id").count().filter("count > 1").isEmpty():
        rows = rows.groupBy("doc_id").agg(F.min("text").alias("text"))
    return rows


def buckets_for(n_bytes: float) -> int:
    """How many buckets hold so many bytes of packed entries."""
    return int(max(8, -(-n_bytes // BUCKET_BYTES)))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """An Arrow string column as its bytes (uint8) and its offsets, one more than rows. Nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64) if len(column) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None and at[-1] > at[0] else np.zeros(0, np.uint8)
    return raw, at - at[0]


def lean(run):
    """A batch function whose worker gives its freed memory back when a task ends: workers live on for other stages."""

    def wrapped(batches):
        import ctypes
        import gc

        yield from run(batches)
        gc.collect()
        pa.default_memory_pool().release_unused()
        try:
            ctypes.CDLL(None).malloc_trim(0)
        except (AttributeError, OSError):  # another C library
            pass

    return wrapped


def slices(column: pa.Array, limit: int = 1_500_000) -> Iterator[tuple[int, int]]:
    """Row ranges of a string column that hold at most ``limit`` bytes each, or one row."""
    _, ends = utf8(column)
    at = 0
    while at < len(column):
        to = max(at + 1, int(np.searchsorted(ends, ends[at] + limit, "right")) - 1)
        yield at, to
        at = to


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit values that spreads every bit over all others."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


#: One odd random value for each byte, and the odd base of the rolling sums.
BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
BASE = 0x9E3779B97F4A7C15 | 5


def pack(columns: Iterable[np.ndarray]) -> bytes:
    """Equally long arrays, one after the other."""
    return b"".join(np.ascontiguousarray(c).tobytes() for c in columns)


def unpack(payloads: Iterable[bytes], dtypes: list) -> list[np.ndarray]:
    """The arrays of all payloads, each column concatenated."""
    width = sum(np.dtype(d).itemsize for d in dtypes)
    parts: list[list[np.ndarray]] = [[] for _ in dtypes]
    for p in payloads:
        n, at = len(p) // width, 0
        for k, d in enumerate(dtypes):
            parts[k].append(np.frombuffer(p, d, n, at))
            at += n * np.dtype(d).itemsize
    return [np.concatenate(x) if x else np.zeros(0, d) for x, d in zip(parts, dtypes)]


def bucket_of(keys: np.ndarray, n_buckets: int) -> np.ndarray:
    """The bucket of each 64-bit key. Keys are mixed first: the least of several hashes are small numbers."""
    return (((mix(keys ^ np.uint64(0xA0761D6478BD642F)) >> np.uint64(32)) * np.uint64(n_buckets)) >> np.uint64(32)).astype(np.int64)


def by_bucket(keys: np.ndarray, n_buckets: int, columns: list[np.ndarray]) -> Iterator[tuple[int, bytes]]:
    """Entries dealt to buckets by their 64-bit keys: (bucket, packed columns)."""
    bucket = bucket_of(keys, n_buckets)
    order = np.argsort(bucket, kind="stable")
    bucket, columns = bucket[order], [c[order] for c in columns]
    cuts = np.r_[runs(bucket), len(bucket)]
    for a, b in zip(cuts[:-1], cuts[1:]):
        yield int(bucket[a]), pack(c[a:b] for c in columns)


def runs(*keys: np.ndarray) -> np.ndarray:
    """Starts of the runs of equal rows in sorted key columns."""
    if not len(keys[0]):
        return np.zeros(0, np.int64)
    new = np.zeros(len(keys[0]), bool)
    new[0] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(new)


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes of the edges (a, b) and the smallest node that each reaches."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    low = np.arange(len(nodes))
    while True:
        m = np.minimum(low[x], low[y])
        before = low.copy()
        np.minimum.at(low, x, m)
        np.minimum.at(low, y, m)
        np.minimum.at(low, before, low)
        low = low[low]
        if (low == before).all():
            return nodes, nodes[low]


def _local_forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    a, b = np.zeros(0, np.int64), np.zeros(0, np.int64)
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    for batch in batches:
        a = np.concatenate([a, batch.column(0).to_numpy(zero_copy_only=False)])
        b = np.concatenate([b, batch.column(1).to_numpy(zero_copy_only=False)])
        if len(a) >= 1_000_000:
            a, b = forest(a, b)
            if len(a) >= 500_000:
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], schema=schema)
                a, b = a[:0], b[:0]
    if len(a):
        a, b = forest(a, b)
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], schema=schema)


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the undirected edges (a, b): the smallest node it reaches.

    Each task first joins its own edges into stars, so every edge leads from a node down to a
    smaller one. Rounds of large-star and small-star over the whole cluster follow: first
    each edge goes on to the smallest node below its lower end, then each node's lower ends
    are tied to their smallest. Edges into a node that has none below it stay as they
    are, so the many edges of a large component's centre are never gathered: only lower
    ends that still have to move are looked up, by a broadcast where they are at most
    ``MOST_JUMPS`` and by a join that can be split beyond. Every round is written to the
    shared folder, so a lost executor costs at most one round.
    """
    stars = edges.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")).filter("a <> b")
    stars = write_shared(stars.mapInArrow(_local_forest, "a long, b long").filter("a <> b").distinct(), "links")
    while True:
        below = write_shared(stars.groupBy("a").agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("n")), "below")
        ends = stars.select(F.col("b").alias("a")).distinct()
        jumps = write_shared(below.join(ends, "a", "left_semi").select(F.col("a").alias("b"), "m"), "jumps")
        n_jumps = jumps.count()
        if not n_jumps and below.filter("n > 1").isEmpty():
            return below.select(F.col("a").alias("node"), F.col("m").alias("component")).union(ends.select("a", "a"))
        if n_jumps:
            stars = stars.join(F.broadcast(jumps) if n_jumps <= MOST_JUMPS else jumps, "b", "left").select("a", F.coalesce("m", "b").alias("b"))
        least = stars.groupBy("a").agg(F.min("b").alias("m"))
        tied = stars.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        stars = write_shared(tied.union(least).toDF("a", "b").filter("a <> b").distinct(), "links")


def valid_vectors(df: DataFrame, key: str = "vec_id", vector: str = "embedding", zero: bool = True) -> DataFrame:
    """(vec_id, v array<double>) of the rows with an id and only finite components.

    Null and empty vectors, and with ``zero=False`` those of zeros only, are left out. An
    id that comes more than once keeps its smallest vector.
    """
    v = F.col(vector).cast("array<double>")
    sound = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = df.select(F.col(key).cast("long").alias("vec_id"), v.alias("v")).filter(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0)).filter(sound)
    if not zero:
        rows = rows.filter(F.exists("v", lambda x: x != 0))
    if not rows.groupBy("vec_id").count().filter("count > 1").isEmpty():
        rows = rows.groupBy("vec_id").agg(F.min("v").alias("v"))
    return rows


def matrix(table: pa.Table, column: str, dtype=np.float64) -> np.ndarray:
    """A list column whose lists are equally long, as a matrix."""
    lists = table.column(column).combine_chunks()
    values = lists.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(lists), len(values) // max(1, len(lists))).astype(dtype, copy=False)


def blocked(candidates: DataFrame, queries: DataFrame, parts: int, candidate_rows: int = 4096, query_rows: int = 2048):
    """Cogroups in which every query of a part meets every candidate of it, block by block.

    Both sides have ``part`` (one of ``parts`` values; their counts are broadcast where
    those are at most ``MOST_PARTS``) and ``vec_id``. A part of many rows is cut into blocks of about the given
    sizes, and each side is repeated for the blocks of the other, so no task holds more
    than one block of both, however large a part is.
    """
    many = candidates.groupBy("part").agg(F.ceil(F.count(F.lit(1)) / candidate_rows).cast("int").alias("nc"))
    sizes = many.join(queries.groupBy("part").agg(F.ceil(F.count(F.lit(1)) / query_rows).cast("int").alias("nq")), "part")
    sizes = write_shared(sizes, "parts")
    sizes = F.broadcast(sizes) if parts <= MOST_PARTS else sizes
    queries = queries.select([F.col(c).alias(c) for c in queries.columns])  # both sides may come from one table
    own = F.xxhash64("vec_id", F.lit(7))
    c = candidates.join(sizes, "part").withColumn("c", F.pmod(own, F.col("nc")).cast("int")).withColumn("q", F.explode(F.sequence(F.lit(0), F.col("nq") - 1))).drop("nc", "nq")
    q = queries.join(sizes, "part").withColumn("q", F.pmod(own, F.col("nq")).cast("int")).withColumn("c", F.explode(F.sequence(F.lit(0), F.col("nc") - 1))).drop("nc", "nq")
    return c.groupBy("part", "c", "q").cogroup(q.groupBy("part", "c", "q"))
