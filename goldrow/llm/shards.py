"""Proportional stratified interleaving of rows into shards, in DataFrame functions only.

Rows are shuffled by a seeded hash and ranked within their source. A row of rank r out of
n stands at the fraction (r - 1/2) / n of its source; all rows sorted by that fraction
interleave the sources in proportion, so any contiguous cut holds the mixture of the
whole. Shards are equal cuts: their row counts differ by one at most.

Ranks come from buckets, because one source may hold a third of all rows: a row's rank is
its place in its bucket plus the rows of the buckets before. Buckets are ranges of the
uniform hash, later of the uniform fraction, so they are even whatever the sources are,
and their number does not change the result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from goldrow.llm.ranks import before, rank_in_groups, ranges

def interleave(
    df: DataFrame, source: str, keys: list[str], shards: int = 8, seed: int = 42
) -> DataFrame:
    """Add ``shard`` (0 .. shards-1) and ``slot`` (gapless from 0 within a shard).

    ``keys`` are the columns that tell rows apart; they decide the seeded order. Rows equal
    in all keys are interchangeable. A null source is a source of its own; an empty table
    gives an empty result. Input columns named ``shard`` or ``slot`` are replaced; any
    other names are kept whatever they are.
    """
    if shards < 1:
        raise ValueError("shards must be positive")
    ties = [f"k{i}" for i in range(len(keys))]
    rows = df.select(
        F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"),
        F.coalesce(F.col(f"`{source}`").cast("string"), F.lit("")).alias("source"),
        F.col(f"`{source}`").isNull().alias("no_source"),
        F.xxhash64(F.lit(seed), *[F.col(f"`{k}`") for k in keys]).alias("key"),
        *[F.col(f"`{k}`").alias(f"k{i}") for i, k in enumerate(keys)],
    )
    stratum = ["source", "no_source"]
    placed = (
        rank_in_groups(rows, stratum, "key", ties)
        .withColumn("fraction", (F.col("rank") - 0.5) / F.col("total"))
        .withColumn("cut", F.floor(F.col("fraction") * ranges(df)).cast("int"))
        .drop("rank", "total")
    )

    per_cut = placed.groupBy("cut").count()
    # One row per range: bounded by the number of shuffle partitions.
    cuts = per_cut.select(
        "cut",
        before("count", Window.orderBy("cut")).alias("start"),
        F.sum("count").over(Window.partitionBy()).alias("n"),
    )
    mixed = Window.partitionBy("cut").orderBy(
        "fraction", F.xxhash64(F.lit(seed), *stratum), *stratum, "key", *ties
    )
    position = F.col("start") + F.col("rank") - 1
    return (
        placed.withColumn("rank", F.row_number().over(mixed))
        .join(cuts, "cut")
        .withColumn("position", position)
        .withColumn("shard", F.expr(f"int(position * {shards} div n)"))
        .withColumn("slot", F.expr(f"position - (shard * n + {shards - 1}) div {shards}"))
        .select(
            *[F.col("row")[c].alias(c) for c in df.columns if c not in ("shard", "slot")],
            "shard",
            "slot",
        )
    )


def text_bytes(text: Column) -> Column:
    """UTF-8 bytes of a text plus one; a null text has none."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def text_crc32(text: Column) -> Column:
    """CRC-32 of the UTF-8 bytes; that of a null text is 0, as of an empty one."""
    return F.coalesce(F.crc32(text.cast("binary")), F.lit(0)).cast("long")


def write_shards(df: DataFrame, path: str) -> None:
    """Write interleaved rows as one folder per shard, in slot order within each file."""
    df.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy(
        "shard"
    ).parquet(path)
