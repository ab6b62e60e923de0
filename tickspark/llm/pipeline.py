"""The stages of the corpus pipeline. Each takes (spark, docs, sf_dir) and returns a DataFrame.

Null texts count as empty. Line dedup and the n-gram join know a document by its id, so
they leave rows without an id as they are, and of several texts of one id they judge the
smallest and leave the others as they are; rows with one id and one text count once.
"""

from __future__ import annotations

import functools
import warnings
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import line_dedup, ngram_join, packing, pii, quality
from .common import scratch, tune, write_shared
from .queries import PSEUDONYM_KEY, held_out, table, vocabulary

#: Documents that score below this go.
KEEP_SCORE = 0.3

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def own_columns(stage: Stage) -> Stage:
    """A stage for documents whose further columns may have any names: those that begin like a stage's own are renamed within it."""

    @functools.wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        inner = {c: f"further{c}" for c in docs.columns if c.startswith("_")}
        out = stage(spark, docs.withColumnsRenamed(inner), sf_dir)
        return out.withColumnsRenamed({v: k for k, v in inner.items() if v in out.columns})

    return run


@own_columns
def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores at least ``KEEP_SCORE``, unchanged."""
    tune(spark)
    model = quality.fit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels").filter(~held_out()))
    return quality.score(docs, model, into="_score").filter(F.col("_score") >= KEEP_SCORE).select(docs.columns)


def with_text(docs: DataFrame, text: F.Column) -> DataFrame:
    """The documents with another text, and ``n_chars`` after it where they have it."""
    out = docs.withColumn("text", text)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def judged(docs: DataFrame) -> DataFrame:
    """The documents with ``_judged``: whether operators that know documents by their id see the row.

    Looking for ids that come twice costs one aggregation over the ids; texts are shuffled for such ids only.
    """
    has_id, words = F.col("doc_id").isNotNull(), F.coalesce(F.col("text"), F.lit(""))
    twice = write_shared(docs.filter(has_id).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("doc_id"), "twice")
    if twice.isEmpty():
        return docs.withColumn("_judged", has_id)
    rest = docs.join(twice, "doc_id", "left_anti").withColumn("_judged", has_id)
    mine = docs.join(twice, "doc_id", "left_semi").withColumn("_words", words)
    least = mine.groupBy("doc_id").agg(F.min("_words").alias("_least"))
    mine = mine.dropDuplicates(["doc_id", "_words"]).join(least, "doc_id").withColumn("_judged", F.expr("_words = _least"))
    return rest.unionByName(mine.select(rest.columns))


@own_columns
def deduped_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the blocks of lines that an earlier one has; those left empty by that go."""
    cut = line_dedup.dedup_lines(docs).select("doc_id", F.col("kept").alias("_kept"), F.col("emptied").alias("_emptied"))
    both = judged(docs).join(cut, "doc_id", "left").filter("not (_judged and _emptied)")
    return with_text(both, F.when(F.col("_judged"), F.col("_kept")).otherwise(F.col("text"))).select(docs.columns)


@own_columns
def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that are linked by similarity, directly or through others, the one with the smallest id."""
    first = ngram_join.ngram_components(docs).filter("doc_id = component_id").select("doc_id", F.lit(True).alias("_first"))
    return judged(docs).join(first, "doc_id", "left").filter("_first or not _judged").select(docs.columns)


@own_columns
def pseudonymised(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with pseudonyms for personal data."""
    tune(spark)
    out = pii.pseudonymise(docs, PSEUDONYM_KEY, into="_spans")
    return with_text(out, F.col("text")).select(docs.columns)


@own_columns
def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 2048 ids: where each piece lies, and its ids."""
    tune(spark)
    return packing.pack_documents(docs, vocabulary())


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", good_documents),
    ("line dedup", deduped_lines),
    ("n-gram Jaccard join", one_of_each_group),
    ("PII", pseudonymised),
    ("packing", packed),
]


class Left(NamedTuple):
    """How many rows a stage got and left; ``emptied`` where it left nothing of something, which is likelier a fault than such input."""

    stage: str
    got: int
    left: int

    @property
    def emptied(self) -> bool:
        return self.got > 0 and self.left == 0


def run_reported(spark: SparkSession, sf_dir: str, stages: list[tuple[str, Stage]]) -> tuple[DataFrame, list[Left]]:
    """Apply the stages to the documents, and what each left.

    Each result is written and read as the next one's input. What a stage wrote besides is
    deleted once its result is written, so the shared folder holds one stage's tables at a time.
    """
    docs = table(spark, sf_dir, "documents")
    n, report = docs.count(), []
    for name, stage in stages:
        with scratch(spark):
            docs = write_shared(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}", keep=True)
        got, n = n, docs.count()
        report.append(Left(name, got, n))
        if report[-1].emptied:
            warnings.warn(f"the stage {name} left no document", stacklevel=2)
    return docs, report


def run(spark: SparkSession, sf_dir: str, stages: list[tuple[str, Stage]]) -> DataFrame:
    """``run_reported`` without the report; a stage that leaves nothing of something gives a warning."""
    return run_reported(spark, sf_dir, stages)[0]
