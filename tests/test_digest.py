"""Content digests find every kind of unlike row, and nothing else."""

from __future__ import annotations

from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from goldrow.operators import digest
from goldrow.session import scratch_path
from goldrow.sinks import versions, writers

KINDS = "k int, a string, b string"
ROWS = [(1, "x", None), (2, None, "x"), (3, "y", "z"), (3, "y", "z"), (None, "n", "n"), (4, "p", "q"), (6, "a", "b")]


def found(spark, source, target, **options):
    s, t = spark.createDataFrame(source, KINDS), spark.createDataFrame(target, KINDS)
    rows = digest.differences(s, t, ["k"], **options).collect()
    return {r["k"]: (r["difference"], r["source_rows"], r["target_rows"]) for r in rows}


@pytest.mark.parametrize("buckets", [1, 3, 1024])
def test_every_kind_is_named(spark, buckets):
    target = [(1, None, "x"), (2, None, "x"), (3, "y", "z"), (None, "n", "n"), (None, "n", "n"), (5, "p", "q"), (6, "a", "b")]
    assert found(spark, ROWS, target, buckets=buckets) == {
        1: ("changed", 1, 1),
        3: ("thinned", 2, 1),
        None: ("doubled", 1, 2),
        4: ("missing", 1, 0),
        5: ("added", 0, 1),
    }
    assert found(spark, ROWS, ROWS[::-1], buckets=buckets) == {}


def test_two_rows_that_swap_values_are_changed(spark):
    source, target = [(1, "a", "c"), (2, "b", "c")], [(1, "b", "c"), (2, "a", "c")]
    assert found(spark, source, target) == {1: ("changed", 1, 1), 2: ("changed", 1, 1)}


values = st.lists(st.tuples(st.integers(0, 3), st.sampled_from(["a", None]), st.sampled_from(["b", None])), max_size=8)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(source=values, target=values)
def test_unlike_keys_are_those_with_unlike_rows(spark, source, target):
    def by_key(rows, k):
        return Counter(r for r in rows if r[0] == k)

    unlike = {k for k in range(4) if by_key(source, k) != by_key(target, k)}
    assert set(found(spark, source, target, buckets=2)) == unlike


def test_nested_values_and_other_spelling(spark):
    source = spark.range(5).selectExpr("id", "named_struct('x', id, 'y', CAST(NULL AS BIGINT)) AS s", "map('k', id) AS m")
    target = source.selectExpr("m AS M", "s", "CAST(id AS INT) AS ID").orderBy("ID", ascending=False)
    status = lambda t: digest.verify_content({"t": (source, t)}).first()["status"]
    assert status(target) == "PASS"
    assert status(target.withColumn("s", F.expr("named_struct('x', CAST(NULL AS BIGINT), 'y', CAST(ID AS BIGINT))"))) == "MISMATCH"
    assert status(target.limit(4)) == "MISMATCH"
    assert digest.table_digest(source.where("false")).first().asDict() == {"rows": 0, "d0": 0, "d1": 0}


def test_reconciliation_compares_content(spark, monkeypatch):
    path = scratch_path(spark, "egress")
    rows = spark.range(6).selectExpr("id", "'a' AS x", "CAST(id % 2 AS BIGINT) AS BATCH_ID")
    assert writers.reconcile_write(rows.where("BATCH_ID = 1"), path, 1) == writers.Reconciled(3, 3)
    assert writers.reconcile_write(rows.where("false"), path, 1) == writers.Reconciled(0, 0)
    plain = versions.stage
    monkeypatch.setattr(versions, "stage", lambda df, *a: plain(df.withColumn("x", F.lit("b")), *a))
    with pytest.raises(RuntimeError, match="unlike rows"):
        writers.reconcile_write(rows.where("BATCH_ID = 1"), path, 1)
