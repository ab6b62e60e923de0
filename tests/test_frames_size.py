"""What frames move: a tick goes to its bucket once, bare copies of it to those that look back at it."""

from pyspark.sql import functions as F
from test_frames import long_rows

from tickspark.operators import frames
from tickspark.plans import pipelines


def test_frames_multiply_no_rows(spark):
    d = long_rows(spark, 100).withColumns({"previous_close": F.col("current_price"), "change": F.lit(0.0)})
    plan = pipelines.enrich_ticks(d)._jdf.queryExecution().executedPlan().toString()
    assert "Generate explode" not in plan and plan.count("Window [") == 1  # the value of the row before


def test_no_bucket_holds_a_large_part_of_a_day(spark, sf_dir):
    assert pipelines.BUCKET <= pipelines.LOOKBACK <= 2 * pipelines.BUCKET


def test_differences_are_framed_in_the_same_round(spark):
    d = long_rows(spark, 60).withColumn("volume", F.when(F.col("event_id") % 4 != 0, F.col("volume")))
    overs = {"a": frames.mean("current_price", 60), "b": frames.mean("volume", 60), "c": frames.difference("a", "b"), "e": frames.total("c", 120, -1)}
    for bucket in (None, 100):
        out = {r["event_id"]: r for r in frames.rolling(d, lambda x, add: add(x, overs), lookback=180, bucket=bucket).collect()}
        assert all((r["c"] is None) == (r["b"] is None) and (r["c"] is None or r["c"] == r["a"] - r["b"]) for r in out.values())
        assert out[0]["c"] is None and out[0]["e"] is None
        for k in (5, 30, 59):
            want = sum(out[j]["c"] for j in range(max(0, k - 6), k) if out[j]["c"] is not None)
            assert abs(out[k]["e"] - want) < 1e-9
