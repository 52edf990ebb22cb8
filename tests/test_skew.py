"""Spread joins give the rows of plain joins, whatever the keys look like."""

from __future__ import annotations

from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from goldrow.operators import audit, marts, quality, search, skew
from goldrow.plans.specs import DQRule
from tests.conftest import SMALL
from workload import Data
from workload.marts import organization_views, person_views

FORCED = {"pieces": 30}


def rows(df):
    return Counter(map(tuple, df.select(*sorted(df.columns)).collect()))


def frame(spark, pairs, value):
    return spark.createDataFrame(pairs, f"k string, {value} int")


def skewed(spark):
    """A key heavy on the left, one on the right, one on both, copies, nulls, strangers."""
    left = [("a", 1)] * 40 + [("b", i) for i in range(3)] + [("c", i % 2) for i in range(12)]
    left += [(None, 7)] * 9 + [("d", 1), ("only", 5)]
    right = [("a", 10)] + [("b", i) for i in range(50)] + [("c", 4)] * 11
    right += [(None, 1)] * 5 + [("d", 2), ("d", 3), ("x", 1)]
    return frame(spark, left, "l").repartition(5), frame(spark, right, "r").repartition(3)


@pytest.mark.parametrize("how", ["left", "inner"])
def test_spread_join_equals_plain(spark, how):
    left, right = skewed(spark)
    got = skew.spread_join(left, right, ["k"], how, **FORCED)
    assert got.columns == ["k", "l", "r"]
    assert rows(got) == rows(left.join(right, ["k"], how))


@pytest.mark.parametrize("how", ["left", "inner"])
def test_spread_join_known_heavy_keys(spark, how):
    left, right = skewed(spark)
    unique = right.select("k").distinct().where("k IS NOT NULL").withColumn("u", F.lit(1))
    got = skew.spread_join(left, unique, ["k"], how, right_unique=True, **FORCED)
    assert rows(got) == rows(left.join(unique, ["k"], how))


def test_heavy_rows_are_spread(spark):
    left, right = skewed(spark)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = skew.spread_join(left, right, ["k"], "left", **FORCED)
        partitions = got.where("k = 'a'").select(F.spark_partition_id()).distinct().count()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert partitions > 1


def test_ways_are_shares_of_the_rows(spark):
    left, _ = skewed(spark)
    ways = {r["k"]: r["w"] for r in skew.key_ways(left, ["k"], 30, "w").collect()}
    # 57 rows with a key, so a piece is 1.9 rows.
    assert ways == {"a": 22, "b": 2, "c": 7}
    ten_times = left.crossJoin(spark.range(10)).select("k", "l")
    assert {r["k"]: r["w"] for r in skew.key_ways(ten_times, ["k"], 30, "w").collect()} == ways


@pytest.mark.parametrize("pieces", [1, 4, 100])
def test_heavy_keys_are_bounded_by_the_pieces(spark, pieces):
    left, _ = skewed(spark)
    assert skew.key_ways(left, ["k"], pieces, "w").count() <= pieces


@pytest.fixture
def sixteen_tasks(spark):
    settings = {
        "spark.sql.shuffle.partitions": "16",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


@pytest.mark.parametrize("hot", [None, "hot"])
@pytest.mark.parametrize("join", ["mark_known", "spread_join", "left_join_all"])
def test_no_task_holds_over_twice_the_mean(spark, sixteen_tasks, hot, join):
    ids = spark.range(200_000)
    key = F.when(F.col("id") % 10 == 0, F.concat(F.lit("k"), F.col("id") % 5000)).otherwise(hot)
    left = ids.select(key.alias("k"), F.col("id").alias("l"))
    other = ids.where("id < 5000").select(F.concat(F.lit("k"), F.col("id")).alias("k"), "id")
    if hot:
        other = other.unionByName(spark.createDataFrame([(hot, -1)], "k string, id long"))
    if join == "mark_known":
        got = skew.mark_known(left, other, ["k"], "known")
    elif join == "spread_join":
        got = skew.spread_join(left, other.withColumnRenamed("id", "r"), ["k"])
    else:
        got = skew.left_join_all(left, [other.withColumnRenamed("id", "r")], ["k"])
    sizes = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 200_000
    # Rows without a key that need no join stay in the tasks that read them.
    assert max(sizes) <= 2 * 200_000 / 16


def test_composite_keys(spark):
    left = spark.createDataFrame([(1, "x", i) for i in range(9)] + [(1, None, 1)], "a int, b string, l int")
    right = spark.createDataFrame([(1, "x", 1), (1, "x", 2), (2, "x", 3)], "a int, b string, r int")
    got = skew.spread_join(left, right, ["a", "b"], "left", **FORCED)
    assert rows(got) == rows(left.join(right, ["a", "b"], "left"))


def test_left_join_all_equals_chain(spark):
    left, right = skewed(spark)
    third = frame(spark, [("b", i) for i in range(8)] + [("only", 1)], "t")
    got = skew.left_join_all(left, [right, third], ["k"], **FORCED)
    want = left.join(right, ["k"], "left").join(third, ["k"], "left")
    assert rows(got) == rows(want)


def test_mark_known(spark):
    left, right = skewed(spark)
    got = skew.mark_known(left, right, ["k"], "known", **FORCED)
    known = {"a", "b", "c", "d"}
    assert got.count() == left.count()
    assert all(r["known"] == (r["k"] in known) for r in got.collect())


keys = st.lists(st.tuples(st.sampled_from(["a", "b", "c", None]), st.integers(0, 3)), max_size=25)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(left=keys, right=keys, how=st.sampled_from(["left", "inner"]))
def test_spread_join_property(spark, left, right, how):
    l, r = frame(spark, left, "l"), frame(spark, right, "r")
    assert rows(skew.spread_join(l, r, ["k"], how, **FORCED)) == rows(l.join(r, ["k"], how))


def test_consolidations_forced(spark):
    data = Data(spark, SMALL)
    people, places = person_views(data), organization_views(data)
    forced = {"pieces": 500}
    assert rows(marts.consolidate_person(people, **forced)) == rows(marts.consolidate_person(people))
    assert rows(marts.consolidate_organization(places, **forced)) == rows(
        marts.consolidate_organization(places)
    )


def test_rule_chain_forced(spark):
    data = Data(spark, SMALL)
    rules = [
        DQRule("t", "mdr_check", "orphan", "iqvia_id", "t"),
        DQRule("t", "null_check", "no city", "city", "t"),
        DQRule("t", "name_address_completeness_check", "orphan", "city", "t"),
    ]
    reference = data["hcp_name"].withColumn("city", F.lit("F"))
    stamp = F.lit("2024-01-31").cast("timestamp")
    plain = quality.run_chain(data["dirty_address"], rules, reference, processed_at=stamp)
    forced = quality.run_chain(
        data["dirty_address"], rules, reference, processed_at=stamp, **FORCED
    )
    assert rows(forced.rejected) == rows(plain.rejected)
    assert rows(forced.passed) == rows(plain.passed)


def test_search_forced(spark):
    from workload.search import THRESHOLD, asked, primary, secondary

    data = Data(spark, SMALL)
    text = lambda df: df.withColumn("record", F.col("record").cast("string"))
    args = (asked(data), primary(data), secondary(data), THRESHOLD)
    plain, forced = search.include_secondary(*args), search.include_secondary(*args, **FORCED)
    assert rows(forced) == rows(plain)
    first = text(primary(data)).drop("score")
    got = search.combine(first, plain, **FORCED)
    assert rows(got) == rows(search.combine(first, plain))


def test_missing_keys_forced(spark):
    left, right = skewed(spark)
    got = audit.missing_keys(left, right, "k", **FORCED)
    assert rows(got) == rows(left.join(right, "k", "left_anti"))
