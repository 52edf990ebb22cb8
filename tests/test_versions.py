"""Layer tables change as a whole, and readers keep what they opened."""

from __future__ import annotations

import threading
import time
from datetime import timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from goldrow.session import scratch_path
from goldrow.sinks import versions, writers
from goldrow.sources.files import children, create_new, modified, read_text


def table(spark, rows, kinds="x int, batch_id int"):
    return spark.createDataFrame(rows, kinds)


def held(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture
def path(spark):
    path = scratch_path(spark, "versioned")
    writers.replace_batches(table(spark, [(1, 1), (2, 1), (3, 2)]), path)
    return path


def test_readers_before_during_and_after(spark, path):
    before = writers.read_layer(spark, path)
    # The first rows of the write are there, its version is not.
    staged = versions.stage(table(spark, [(9, 1), (8, 3)]), path, ["batch_id"])
    during = writers.read_layer(spark, path)
    assert staged.rows == 2
    versions.commit(spark, path, staged, versions.version(spark, path), mode="batches")
    after = writers.read_layer(spark, path)
    first = [(1, 1), (2, 1), (3, 2)]
    assert held(before) == held(during) == first
    assert held(after) == [(3, 2), (8, 3), (9, 1)]
    assert held(writers.read_layer(spark, path, version=1)) == first
    with pytest.raises(ValueError, match="no version 7"):
        writers.read_layer(spark, path, version=7)


def test_a_write_killed_half_way_changes_nothing(spark, path):
    before = writers.read_layer(spark, path)
    rows = spark.range(100).select(
        F.col("id").cast("int").alias("x"),
        F.when(F.col("id") == 99, F.raise_error(F.lit("killed"))).otherwise(F.col("id") % 3).cast("int").alias("batch_id"),
    )
    with pytest.raises(Exception, match="killed"):
        writers.replace_batches(rows.repartition(4), path)
    assert held(before) == held(writers.read_layer(spark, path)) == [(1, 1), (2, 1), (3, 2)]
    assert versions.numbers(spark, path) == [1]
    # Killed between its rows and its version; what it left behind goes once it is old.
    versions.stage(table(spark, [(7, 7)]), path, ["batch_id"])
    assert len(children(spark, f"{path}/_data")) == 2
    time.sleep(0.01)
    dropped = versions.expire(spark, path, timedelta(0))
    assert len(dropped) == 1 and len(children(spark, f"{path}/_data")) == 1
    assert held(before) == [(1, 1), (2, 1), (3, 2)]


def test_retired_folders_go_after_the_age(spark, path):
    for x in (5, 6):
        writers.replace_batches(table(spark, [(x, 1)]), path)
    assert versions.numbers(spark, path) == [1, 2, 3]
    assert versions.expire(spark, path, timedelta(hours=1)) == []
    old = writers.read_layer(spark, path, version=2)
    assert held(old) == [(3, 2), (5, 1)]
    time.sleep(0.01)
    dropped = versions.expire(spark, path, timedelta(0))
    # Batch 2 still lies in the first commit; the second commit is named by nothing.
    assert sorted(d.count("/") for d in dropped) == [0, 1]
    assert versions.numbers(spark, path) == [3]
    assert held(writers.read_layer(spark, path)) == [(3, 2), (6, 1)]
    with pytest.raises(ValueError, match="no version 2"):
        writers.read_layer(spark, path, version=2)


def test_a_reader_of_the_age_keeps_its_version(spark, path):
    time.sleep(0.3)
    writers.replace_batches(table(spark, [(5, 1)]), path)
    # The age begins just before version 2, when version 1 was the newest one.
    newest = dict(modified(spark, f"{path}/_versions"))[f"{2:012d}"]
    since = timedelta(milliseconds=time.time_ns() // 1_000_000 - newest + 100)
    assert versions.expire(spark, path, since) == []
    assert versions.numbers(spark, path) == [1, 2]


def test_numbers_are_taken_once(spark, path):
    place = f"{path}/_versions/{2:012d}"
    assert create_new(spark, place, "mine") and not create_new(spark, place, "yours")
    assert read_text(spark, place) == "mine"
    assert children(spark, f"{path}/_versions").count(f"{2:012d}") == 1


def test_second_writer_of_other_batches_goes_on(spark, path):
    base = versions.version(spark, path)
    one = versions.stage(table(spark, [(10, 1)]), path, ["batch_id"])
    two = versions.stage(table(spark, [(20, 2)]), path, ["batch_id"])
    versions.commit(spark, path, one, base, mode="batches")
    versions.commit(spark, path, two, base, mode="batches")
    assert held(writers.read_layer(spark, path)) == [(10, 1), (20, 2)]
    with pytest.raises(versions.ConflictError):
        versions.commit(spark, path, one, base, mode="batches")
    with pytest.raises(versions.ConflictError):
        versions.commit(spark, path, two, base, mode="all")
    more = versions.stage(table(spark, [(20, 2)]), path, ["batch_id"])
    versions.commit(spark, path, more, base, mode="append")
    assert held(writers.read_layer(spark, path)) == [(10, 1), (20, 2), (20, 2)]


def test_writers_at_once(spark, path):
    def load(n):
        writers.replace_batches(table(spark, [(n, 10 + n)]), path)

    threads = [threading.Thread(target=load, args=(n,)) for n in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert held(writers.read_layer(spark, path).where("batch_id >= 10")) == [(n, 10 + n) for n in range(4)]
    assert versions.version(spark, path).number == 5


def test_odd_partition_values(spark):
    path = scratch_path(spark, "odd")
    values = ["007", None, "a b/c=d:%", "é", "7"]
    rows = [(i, v, i) for i, v in enumerate(values)]
    kinds = "x int, s string, batch_id int"
    writers.replace_batches(table(spark, rows, kinds), path, ("s", "BATCH_ID"))
    assert sorted(map(tuple, writers.read_layer(spark, path).collect())) == sorted((i, v, i) for i, v in enumerate(values))
    writers.replace_batches(
        table(spark, [(9, "007", 0)], kinds).withColumnRenamed("batch_id", "Batch_Id"),
        path, ("s", "BATCH_ID"), emptied=[(None, 1), ("a b/c=d:%", 2), ("é", 99)],
    )
    assert {tuple(r) for r in writers.read_layer(spark, path).collect()} == {(9, "007", 0), (3, "é", 3), (4, "7", 4)}
    with pytest.raises(ValueError, match="has the partitions"):
        writers.replace_batches(table(spark, rows, kinds), path, ("s",))


def test_widened_column_keeps_pushed_filters(spark):
    path = scratch_path(spark, "widened")
    for i, kind in enumerate(("smallint", "int", "bigint", "decimal(12,2)")):
        writers.append_evolving(spark.range(5).selectExpr(f"CAST(id AS {kind}) AS x", f"{i} AS batch_id"), path)
    df = writers.read_layer(spark, path)
    assert df.schema["x"].dataType == T.DecimalType(22, 2)
    assert held(df.where("x > 3").select("batch_id")) == [(0,), (1,), (2,), (3,)]
    two = scratch_path(spark, "widened")
    for i, kind in enumerate(("int", "bigint", "int")):
        writers.append_evolving(spark.range(5).selectExpr(f"CAST(id AS {kind}) AS x", f"{i} AS batch_id"), two)
    df = writers.read_layer(spark, two).where("x > 3")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert df.schema["x"].dataType == T.LongType() and df.count() == 3
    assert plan.count("GreaterThan(x,3)") == 2


def test_table_of_others_becomes_the_first_version(spark):
    path = scratch_path(spark, "plain")
    table(spark, [(1, 1), (2, 2)]).write.partitionBy("batch_id").parquet(path)
    assert held(writers.read_layer(spark, path)) == [(1, 1), (2, 2)]
    writers.replace_batches(table(spark, [(3, 2)]), path)
    assert held(writers.read_layer(spark, path)) == [(1, 1), (3, 2)]


def test_a_write_may_read_its_own_table(spark, path):
    doubled = writers.read_layer(spark, path).withColumn("x", F.col("x") * 10)
    assert writers.replace_table(doubled, path) == 3
    assert held(writers.read_layer(spark, path)) == [(10, 1), (20, 1), (30, 2)]
    assert writers.replace_table(doubled.where("false"), path) == 0
    empty = writers.read_layer(spark, path)
    assert empty.count() == 0 and empty.columns == ["x", "batch_id"]


def test_snapshot_is_replaced_as_a_whole(spark):
    from datetime import date

    root = scratch_path(spark, "snapshots")
    path = writers.snapshot(spark.range(3), root, "HCP", date(2024, 1, 31))
    opened = writers.read_layer(spark, path)
    with pytest.raises(Exception, match="killed"):
        broken = spark.range(5).where(F.raise_error(F.lit("killed")).isNull())
        writers.snapshot(broken, root, "HCP", date(2024, 1, 31))
    assert writers.read_layer(spark, path).count() == 3
    writers.snapshot(spark.range(7), root, "HCP", date(2024, 1, 31))
    assert (opened.count(), writers.read_layer(spark, path).count()) == (3, 7)


def test_batches_outside_of_the_window_are_not_read(spark):
    path = scratch_path(spark, "ranges")
    rows = spark.range(300).selectExpr(
        "id", "date_add(DATE'2024-01-01', CAST(id AS INT)) AS day", "CAST(id DIV 100 AS STRING) AS s",
        "CAST(id DIV 50 AS BIGINT) AS batch_id",
    )
    none = spark.range(1).selectExpr("1000L AS id", "CAST(NULL AS DATE) AS day", "'x' AS s", "99L AS batch_id")
    writers.replace_batches(rows.unionByName(none), path, watch=["DAY", "id", "s"])
    whole = writers.read_layer(spark, path)
    assert len(whole.inputFiles()) == 7
    for within, files in (
        ({"day": ("2024-01-05", "2024-01-06")}, 1),
        ({"id": (40, 120)}, 3),
        ({"id": (40, 120), "S": ("1", "1")}, 1),
        ({"day": ("2024-02-19", "2024-02-20")}, 2),
        ({"id": (5000, 6000)}, 0),
    ):
        got = writers.read_layer(spark, path, within=within)
        want = whole
        for c, (low, high) in within.items():
            want = want.where(F.col(c).cast("string" if isinstance(low, str) else "long").between(low, high))
        assert held(got) == held(want)
        assert len(got.inputFiles()) == files
    plan = writers.read_layer(spark, path, within={"id": (40, 120)})._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(id,40)" in plan
    # A batch written without watching it may hold anything.
    writers.replace_batches(rows.where("batch_id = 5"), path)
    assert len(writers.read_layer(spark, path, within={"id": (40, 120)}).inputFiles()) == 4


def test_counts_follow_every_change_without_reading(spark, path):
    def recount():
        table = writers.read_layer(spark, path)
        return sorted((str(r["batch_id"]), r["count"]) for r in table.groupBy("batch_id").count().collect())

    changes = [
        ([(5, 1), (6, 1), (7, 1)], []), ([], [(2,)]), ([(1, 2), (1, None)], []), ([], [(1,), (None,)]), ([(4, 1)], [(2,)]),
    ]
    for rows, emptied in changes:
        writers.replace_batches(table(spark, rows), path, emptied=emptied)
        counts = versions.batch_rows(spark, path)
        plan = counts._jdf.queryExecution().executedPlan().toString()
        assert "FileScan" not in plan
        assert sorted((str(r["batch_id"]), r["row_count"]) for r in counts.collect()) == recount()
    writers.write_table(table(spark, [(8, 1)]), path, "append")
    assert [tuple(r) for r in versions.batch_rows(spark, path).collect()] == [("1", 2)]
