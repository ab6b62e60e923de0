"""Small files of the driver, on whatever store a path names."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def put_text(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file that nobody sees before it is whole; False where the name is taken."""
    p, fs = _at(spark, path)
    hidden = spark._jvm.org.apache.hadoop.fs.Path(p.getParent(), f".{p.getName()}.{spark._jvm.java.util.UUID.randomUUID()}")
    out = fs.create(hidden)
    out.write(bytearray(text.encode()))
    out.close()
    done = not fs.exists(p) and fs.rename(hidden, p)
    if not done:
        fs.delete(hidden, False)
    return done


def get_text(spark: SparkSession, path: str) -> str:
    return spark.read.text(path, wholetext=True).first()["value"]


def names_in(spark: SparkSession, path: str) -> dict[str, int]:
    """Names of what lies in a folder, with the bytes of files (0 for folders); nothing where it doesn't exist."""
    p, fs = _at(spark, path)
    return {f.getPath().getName(): f.getLen() for f in fs.listStatus(p)} if fs.exists(p) else {}
