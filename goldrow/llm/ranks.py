"""Ranks of rows within groups that may hold a third of all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Ranges per shuffle partition; more ranges even out the partitions.
RANGES_PER_PARTITION = 4


def ranges(df: DataFrame) -> int:
    return RANGES_PER_PARTITION * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def before(column: str, window) -> Column:
    """Sum of the column over the rows before."""
    total = F.sum(column).over(window.rowsBetween(Window.unboundedPreceding, -1))
    return F.coalesce(total, F.lit(0))


def rank_in_groups(df: DataFrame, groups: list[str], key: str, ties: list[str]) -> DataFrame:
    """Add ``rank`` (from 1, by ``key``, then ``ties``) and ``total``, the group's rows.

    ``key`` is a 64-bit hash. A rank is the row's place within its range of the hash plus
    the rows of the ranges before, so no group meets in one task, and the number of ranges
    does not change a rank. No group column may be null.
    """
    n = ranges(df)
    rows = df.withColumn("range", F.floor((F.col(key) / F.lit(2.0**64) + 0.5) * n).cast("int"))
    along = Window.partitionBy(*groups).orderBy("range")
    starts = (
        rows.groupBy(*groups, "range")
        .count()
        .select(
            *groups,
            "range",
            before("count", along).alias("start"),
            F.sum("count").over(Window.partitionBy(*groups)).alias("total"),
        )
    )
    within = Window.partitionBy(*groups, "range").orderBy(key, *ties)
    return (
        rows.withColumn("rank", F.row_number().over(within))
        .join(starts, [*groups, "range"])
        .withColumn("rank", F.col("start") + F.col("rank"))
        .drop("range", "start")
    )
