"""From raw documents to packed training sequences, in five stages."""

from __future__ import annotations

import sys

from pyspark.sql import DataFrame, SparkSession

from tickspark.llm import pipeline

#: (name, function) of each stage, in order.
STAGES = pipeline.STAGES

#: SQL cannot express these stages; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each result is written to the shared folder and read again."""
    return pipeline.run(spark, sf_dir, STAGES)


def main(sf_dir: str, out: str) -> int:
    """Write the sequences to ``out``; 1 where a stage left nothing of something, so a job that went wrong doesn't look done."""
    spark = SparkSession.builder.appName("corpus pipeline").getOrCreate()
    docs, report = pipeline.run_reported(spark, sf_dir, STAGES)
    docs.write.parquet(out)
    for line in report:
        print(f"{line.stage}: {line.got} rows, {line.left} left", file=sys.stderr)
    return int(any(line.emptied for line in report))


if __name__ == "__main__":
    sys.exit(main(*sys.argv[1:3]))
