"""Joins that stay spread out when one key, or the null key, holds most of the rows.

Adaptive execution splits a skewed shuffle join only where both inputs come straight
from a shuffle and the skewed side may be split for that join type. A join against
distinct keys, an outer join whose inner side is skewed, or the second of two joins on
one key is outside of that.

Here rows are counted per key first. The rows with a key are thought of as cut into
``pieces``, some per shuffle partition. A key with more rows than a piece is dealt out over
as many salts as it fills pieces, and there are at most ``pieces`` such keys, so their
table has a proven size and is broadcast. Both limits are shares of the rows. Rows without
a key match nothing; they are dealt out over all pieces.

``spread_join`` and ``mark_known`` count in the plan of the join, which is one and the same
whatever the size. ``left_join_all`` counts in a job of its own while its plan is made: it
joins many tables, and without heavy keys none of them has to leave the plain path.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from goldrow.session import write_through

#: Pieces for each shuffle partition; many even out how salts fall to partitions.
PIECES_PER_PARTITION = 16


def default_pieces(df: DataFrame) -> int:
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return PIECES_PER_PARTITION * partitions


def key_ways(df: DataFrame, keys: Sequence[str], pieces: int, ways: str) -> DataFrame:
    """Keys with more rows than a piece, and the number of pieces they fill (``ways``).

    Lazy. Counts combine before the shuffle; at most ``pieces`` rows come out. The total is
    a plain count, for which no key is shuffled.
    """
    rows = _with_key(df.select(*keys), keys)
    counted = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    total = rows.select(F.count(F.lit(1))).scalar()
    filled = F.col("_rows") * pieces
    return counted.where(filled > total).select(
        *keys, F.ceil(filled / total).cast("int").alias(ways)
    )


def _with_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.where(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]))


def _spread(df: DataFrame, n: Column | int) -> Column:
    """Retry-stable salt: row content plus the task's partition number.

    Content alone would put all copies of one row on one salt; a random number would
    differ when a lost task runs again and so drop or double rows.
    """
    unhashable = (T.MapType, T.VariantType)
    columns = [f.name for f in df.schema if not isinstance(f.dataType, unhashable)]
    n = n if isinstance(n, Column) else F.lit(n)
    return F.pmod(F.xxhash64(*columns) + F.spark_partition_id(), n).cast("int")


def spread_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    how: str = "left",
    *,
    pieces: int | None = None,
    left_source: DataFrame | None = None,
    right_unique: bool = False,
    grid: DataFrame | None = None,
) -> DataFrame:
    """Equi-join on same-named ``keys`` ('left' or 'inner') safe against heavy keys.

    Same rows and columns as ``left.join(right, keys, how)`` with the left columns first.
    Left rows are counted on ``left_source`` where it has the left keys with fewer steps
    behind it; a side that is unique in the keys is not counted. ``grid`` gives the ways of
    heavy keys (``_an`` left, ``_bn`` right) where they are known.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"unsupported join type: {how}")
    keys = list(keys)
    pieces = default_pieces(left) if pieces is None else pieces
    l_columns, r_columns = left.columns, [c for c in right.columns if c not in keys]
    one, zero = F.lit(1), F.lit(0)

    # Grid per heavy key: _an ways across the left rows, _bn across the right ones.
    if grid is None:
        grid = key_ways(left if left_source is None else left_source, keys, pieces, "_an")
        if right_unique:
            grid = grid.withColumn("_bn", one)
        else:
            grid = grid.join(key_ways(right, keys, pieces, "_bn"), keys, "full")
    grid = F.broadcast(grid)

    no_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])

    def every(ways: str) -> Column:
        return F.explode(F.sequence(zero, F.coalesce(F.col(ways), one) - 1))

    def one_of(df: DataFrame, ways: str) -> Column:
        return F.when(F.col(ways) > 1, _spread(df, F.col(ways))).otherwise(zero)

    # A salt is taken by the counted side's rows and copied over by the other side's.
    l = left.join(grid, keys, "left").select(
        *l_columns,
        F.when(no_key, _spread(left, pieces)).otherwise(one_of(left, "_an")).alias("_a"),
        F.coalesce(F.col("_bn"), one).alias("_copies"),
        (zero if right_unique else every("_bn")).alias("_b"),
    )
    r = _with_key(right, keys).join(grid, keys, "left").select(
        *keys,
        *r_columns,
        F.lit(True).alias("_hit"),
        (zero if right_unique else one_of(right, "_bn")).alias("_b"),
        every("_an").alias("_a"),
    )
    joined = l.join(r, [*keys, "_a", "_b"], how)
    if how == "left" and not right_unique:
        # A left row copied over b meets its right rows on some of the b only. A copy
        # without one is surplus: a key is copied only if the right side was counted to
        # hold it, so another copy of the row did match.
        joined = joined.where(F.col("_hit") | (F.col("_copies") == 1))
    return joined.select(*l_columns, *r_columns)


def mark_known(
    df: DataFrame,
    known: DataFrame,
    keys: Sequence[str],
    flag: str,
    *,
    pieces: int | None = None,
    left_source: DataFrame | None = None,
    heavy: DataFrame | None = None,
) -> DataFrame:
    """Add boolean ``flag``: whether the row's key occurs in ``known``.

    The known keys are made distinct, on the map side first, so rows are never doubled.
    Heavy keys are looked up before, and their answers are broadcast; their rows, and rows
    without a key, take any salt and meet nothing in the join. ``heavy`` gives these keys,
    at most ``pieces``, where they are known; else rows are counted on ``left_source``,
    which has the keys with fewer steps behind it, or on ``df``.
    """
    keys = list(keys)
    pieces = default_pieces(df) if pieces is None else pieces
    if heavy is None:
        heavy = key_ways(df if left_source is None else left_source, keys, pieces, "_ways")
    marked = _with_key(known.select(*keys), keys).distinct().withColumn("_hit", F.lit(True))
    answers = heavy.select(*keys).join(marked, keys, "left").select(
        *keys, F.coalesce("_hit", F.lit(False)).alias("_answer")
    )
    no_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    apart = no_key | F.col("_answer").isNotNull()
    rows = df.join(F.broadcast(answers), keys, "left").select(
        *df.columns,
        "_answer",
        F.when(apart, _spread(df, pieces) + 1).otherwise(0).alias("_salt"),
    )
    # Not a literal: the join would lose the salt as one of its keys.
    none = F.pmod(F.xxhash64(*keys), F.lit(1)).cast("int")
    joined = rows.join(marked.withColumn("_salt", none), [*keys, "_salt"], "left")
    found = F.coalesce("_answer", "_hit", F.lit(False))
    return joined.select(*df.columns, found.alias(flag))


def left_join_all(
    anchor: DataFrame,
    others: Sequence[DataFrame],
    keys: Sequence[str],
    *,
    pieces: int | None = None,
) -> DataFrame:
    """Left-join many tables onto one by the same keys.

    Rows of ordinary keys take plain joins: every table is shuffled once and all joins run
    where the rows already are. Only rows of keys that are heavy in any table leave that
    path and are joined spread out. Anchor rows without a key join nothing.
    """
    keys = list(keys)
    pieces = default_pieces(anchor) if pieces is None else pieces
    tables = (anchor, *others)
    # One counting pass over the keys of all tables. A piece is a share of all their rows, so
    # a key of a small table is not heavy however few keys that has.
    counted = reduce(
        lambda a, b: a.unionByName(b),
        [_with_key(t.select(*keys), keys).withColumn("_table", F.lit(i)) for i, t in enumerate(tables)],
    )
    counted = counted.groupBy(*keys, "_table").agg(F.count(F.lit(1)).alias("_rows"))
    total = counted.agg(F.sum("_rows")).scalar()
    filled = F.col("_rows") * pieces
    ways = counted.where(filled > total).withColumn("_ways", F.ceil(filled / total).cast("int"))
    # One row per key that is heavy in any table, with its ways in each.
    each = [F.max(F.when(F.col("_table") == i, F.col("_ways"))) for i in range(len(tables))]
    heavy = ways.groupBy(*keys).agg(
        *[F.coalesce(w, F.lit(1)).alias(f"_w{i}") for i, w in enumerate(each)]
    )
    # Stored, as every join below reads it.
    heavy = write_through(heavy, "heavy-keys")
    hot = F.broadcast(heavy.select(*keys))

    no_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    with_key = [_with_key(t, keys) for t in tables]
    split = not heavy.isEmpty()
    cold = [t.join(hot, keys, "left_anti") for t in with_key] if split else with_key
    ordinary = reduce(lambda l, r: l.join(r, keys, "left"), cold)
    columns = ordinary.columns
    absent = [
        F.lit(None).cast(f.dataType).alias(f.name)
        for f in ordinary.schema
        if f.name not in anchor.columns
    ]
    alone = anchor.where(no_key).select(*anchor.columns, *absent)
    ordinary = ordinary.unionByName(alone)
    if not split:
        return ordinary
    out = _with_key(anchor, keys).join(hot, keys, "left_semi")
    # What is joined already fills the product of its tables' ways.
    filled = F.col("_w0")
    for i, table in enumerate(others, 1):
        grid = heavy.select(
            *keys, F.least(filled, F.lit(pieces)).alias("_an"), F.col(f"_w{i}").alias("_bn")
        )
        rows = table.join(hot, keys, "left_semi")
        out = spread_join(out, rows, keys, "left", pieces=pieces, grid=grid)
        filled = F.least(filled * F.col(f"_w{i}"), F.lit(pieces))
    return ordinary.unionByName(out.select(*columns))
