"""Rows are new once, whatever batch brings them first."""

from __future__ import annotations

from pyspark.sql import functions as F

from goldrow.operators import history
from goldrow.session import scratch_path

KINDS = "k int, a string, loaded int"


def taken(spark, path, rows, batch):
    df = spark.createDataFrame(rows, KINDS)
    got = history.unseen(df, path, batch, ignore=["loaded"])
    assert "scanned-layer" not in got._jdf.queryExecution().executedPlan().toString()
    return sorted((r["k"], r["a"]) for r in got.select(F.coalesce("k", F.lit(-1)).alias("k"), F.coalesce("a", F.lit("?")).alias("a")).collect())


def test_rows_are_new_once(spark):
    path = scratch_path(spark, "history")
    first = [(1, "x", 1), (1, "x", 2), (None, "y", 1), (2, None, 1)]
    assert taken(spark, path, first, 1) == [(-1, "y"), (1, "x"), (2, "?")]
    # Loaded at another time, but known; nulls in other places are other rows.
    assert taken(spark, path, [(1, "x", 9), (None, "y", 9)], 2) == []
    assert taken(spark, path, [(None, "2", 1), (1, "x", 1), (3, "z", 1)], 3) == [(-1, "2"), (3, "z")]
    # A batch again: its own digests do not count against it, those of others do.
    assert taken(spark, path, first, 1) == [(2, "?")]
    assert taken(spark, path, [], 2) == [] and taken(spark, path, [], 3) == []
    assert taken(spark, path, first, 1) == [(-1, "y"), (1, "x"), (2, "?")]
