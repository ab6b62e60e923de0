"""Quality classifier by compression.

Two zstandard dictionaries are built, one from labelled good and one from labelled bad
text. A text that shares its habits with one of them compresses better beside it. The
difference of the two compressed sizes, normalised by the sizes and by the length,
goes through a logistic calibration fitted on labelled rows that the dictionaries
have not seen. Scores come from the text alone.

A fit takes a bounded number of labelled rows. Their texts stay on the executors: pieces
for the dictionaries come to the driver, spaced evenly over each whole text, and of each
whole calibration text its four sizes' ratios.
"""

from __future__ import annotations

import random
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import tune, write_shared

#: Bound on the labelled rows of each class that a fit takes, the least by a hash of the id.
FIT_ROWS = 4000
#: Pieces that a text of the dictionary half gives and the bytes of a piece (a shorter text goes
#: in whole), and the size of a dictionary.
PIECES, PIECE_BYTES, DICTIONARY_BYTES = 16, 256, 112_640
#: Standard deviations beyond which a feature counts as just so far.
FAR = 6.0


@dataclass
class QualityModel:
    """Two dictionaries, the compression level, and the weights of the calibration."""

    good: bytes
    bad: bytes
    level: int
    weights: np.ndarray
    centre: np.ndarray
    scale: np.ndarray


def _compressor(dictionary: bytes, level: int):
    import zstandard

    data = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_FULLDICT)
    data.precompute_compress(level=level)
    return zstandard.ZstdCompressor(dict_data=data, level=level, write_content_size=False, write_checksum=False, write_dict_id=False)


def _features(texts: list[bytes], good, bad) -> np.ndarray:
    """The normalised size differences of each text; all 0 for an empty one."""
    a = np.array([len(good.compress(t)) for t in texts], float)
    b = np.array([len(bad.compress(t)) for t in texts], float)
    n = np.array([len(t) for t in texts], float)
    diff = np.where(n > 0, b - a, 0)
    whole = np.maximum(n, 1)
    return np.column_stack([diff / whole, diff / (a + b), np.sign(diff) * np.log1p(np.abs(diff)), np.where(n > 0, np.minimum(a, b) / (whole + 16), 0.5)])


def spread_pieces(text: bytes, pieces: int = PIECES, size: int = PIECE_BYTES) -> list[bytes]:
    """Pieces spaced evenly over the whole text, the first at its start and the last at its end."""
    if len(text) <= pieces * size:
        return [text] if text else []
    return [text[a : a + size] for a in ((len(text) - size) * k // (pieces - 1) for k in range(pieces))]


def _terms(x: np.ndarray) -> np.ndarray:
    """Features within ``FAR``, their squares and a product, all about as large as one another."""
    x = np.clip(x, -FAR, FAR)
    return np.column_stack([np.ones(len(x)), x, x**2 / FAR, x[:, :1] * x[:, 2:3] / FAR])


def _loss(x: np.ndarray, y: np.ndarray, w: np.ndarray, ridge: float) -> float:
    z = x @ w
    return float(np.logaddexp(0, z).sum() - y @ z + ridge / 2 * w @ w)


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.1, rounds: int = 200) -> np.ndarray:
    """Weights of the least penalised loss: Newton steps, each halved until the loss falls as it should.

    The loss is strictly convex, so there is one least value; an ArithmeticError says that
    it wasn't reached.
    """
    w = np.zeros(x.shape[1])
    loss = _loss(x, y, w, ridge)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -500, 500)))
        g = x.T @ (p - y) + ridge * w
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), g)
        fall, t = float(g @ step), 1.0
        if fall <= 1e-12 * (1 + abs(loss)):
            return w
        while (new := _loss(x, y, w - t * step, ridge)) > loss - 1e-4 * t * fall:
            t /= 2
            if t < 1e-12:  # no smaller loss can be told from this one
                if fall <= 1e-6 * (1 + abs(loss)):
                    return w
                raise ArithmeticError("the calibration found no step that lowers its loss")
        w, loss = w - t * step, new
    raise ArithmeticError("the calibration did not converge")


def _pieces_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        pieces = [spread_pieces(t.encode("utf-8", "surrogatepass")) for t in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(pieces, pa.list_(pa.binary()))], names=["doc_id", "quality", "pieces"])


def _dictionary(pieces: list[bytes]) -> bytes:
    import zstandard

    try:
        return zstandard.train_dictionary(min(DICTIONARY_BYTES, max(1024, sum(map(len, pieces)) // 8)), pieces).as_bytes()
    except (zstandard.ZstdError, ValueError):  # too few for the trainer: repeat them
        more = [t[k : k + 64] for t in pieces for k in range(0, len(t), 16)] or [b"%d" % k * 8 for k in range(64)]
        return zstandard.train_dictionary(1024, (more * (1 + 2000 // len(more)))[:20_000]).as_bytes()


def fit(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS, level: int = 3) -> QualityModel | None:
    """Fit on at most ``rows`` labelled documents of each class; None where a class has none.

    ``docs`` needs doc_id and text, ``labels`` doc_id and a 0/1 quality. Null labels and
    ids are left out, null texts count as empty. An id that is labelled twice counts once,
    with its smaller label, and an id with several texts with its smallest. About half of
    the rows build the dictionaries, the others calibrate; where a class has none in one
    half, its other rows serve for both. The share of good labels among *all* given rows
    sets the prior of the calibration.
    """
    tune(docs.sparkSession)
    marks = labels.filter("doc_id is not null and quality in (0, 1)").groupBy("doc_id").agg(F.min("quality").cast("int").alias("quality"))
    share = {r["quality"]: r["count"] for r in marks.groupBy("quality").count().collect()}
    if len(share) < 2:
        return None
    picked = [marks.filter(F.col("quality") == q).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows) for q in (0, 1)]
    few = picked[0].union(picked[1])
    texts = docs.filter("doc_id is not null").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    # at most 2 * rows ids: a proven bound
    chosen = texts.join(F.broadcast(few), "doc_id").groupBy("doc_id", "quality").agg(F.min("text").alias("text"))
    chosen = write_shared(chosen.select("doc_id", "quality", "text", (F.xxhash64("doc_id", F.lit(1)) % 2 == 0).alias("shown")), "labelled")
    halves = {(r["quality"], r["shown"]) for r in chosen.select("quality", "shown").distinct().collect()}
    if len({q for q, _ in halves}) < 2:
        return None
    serves = lambda half: F.col("shown") == half if len(halves) == 4 else F.lit(True)

    given = chosen.filter(serves(True)).select("doc_id", "quality", "text").mapInArrow(_pieces_of, "doc_id long, quality int, pieces array<binary>").collect()
    given = sorted(given, key=lambda r: r["doc_id"])
    random.Random(0).shuffle(given)
    dictionaries = [_dictionary([bytes(p) for r in given if r["quality"] == q for p in r["pieces"]]) for q in (1, 0)]

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        good, bad = (_compressor(d, level) for d in dictionaries)
        for batch in batches:
            x = _features([t.encode("utf-8", "surrogatepass") for t in batch.column(1).to_pylist()], good, bad)
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c) for c in x.T]], names=["quality", "a", "b", "c", "d"])

    seen = chosen.filter(serves(False)).select("quality", "text").mapInArrow(measured, "quality int, a double, b double, c double, d double")
    seen = np.array(sorted(tuple(r) for r in seen.collect()), float)
    y, x = seen[:, 0], seen[:, 1:]
    centre, scale = x.mean(0), x.std(0) + 1e-9
    w = logistic(_terms((x - centre) / scale), y)
    # the sample holds the classes in other shares than the labels do
    w[0] += np.log(share[1] / share[0]) - np.log(y.sum() / (len(y) - y.sum()))
    return QualityModel(*dictionaries, level, w, centre, scale)


def score(df: DataFrame, fitted: QualityModel | None, text: str = "text", into: str = "score") -> DataFrame:
    """All columns of ``df`` and ``into``: 0 to 1, higher for what looks like good text.

    Null and empty texts get the score of an empty text. Without a model (no labels of
    one class) every score is 0.5. A column that has the name ``into`` is replaced.
    """
    kept = [c for c in df.columns if c != into]
    if fitted is None:
        return df.select(*kept, F.lit(0.5).alias(into))
    schema = df.select(*kept).schema.add(into, "double")
    at = kept.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        good, bad = _compressor(fitted.good, fitted.level), _compressor(fitted.bad, fitted.level)
        for batch in batches:
            texts = [t.encode("utf-8", "surrogatepass") if t else b"" for t in batch.column(at).to_pylist()]
            x = _terms((_features(texts, good, bad) - fitted.centre) / fitted.scale)
            p = 1 / (1 + np.exp(-np.clip(x @ fitted.weights, -30, 30)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(p)], names=[*kept, into])

    return df.select(*kept).mapInArrow(run, schema)
