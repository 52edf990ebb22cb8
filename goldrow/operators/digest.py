"""Content of tables compared by digests that do not depend on the order of rows.

A row is two 64-bit hashes of all its columns. A table, or a bucket of its keys, is the
number of its rows and the sums of their hashes: sums merge, do not care for order, and
count a row as often as it is there. Tables are equal if the sums of every bucket are. For
those that are not, the descent reads only buckets that differ and names the keys.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from goldrow.operators.schema import col, union_filled

SEEDS = (42, 43)
#: Buckets of a table's keys.
BUCKETS = 1024


def _value(field: T.StructField) -> list[Column]:
    """What is hashed of a column: its value, and whether it has one."""
    value = col(field.name)
    if isinstance(field.dataType, (T.StructType, T.ArrayType, T.MapType, T.VariantType)):
        value = F.to_json(F.struct(value.alias("v")), {"ignoreNullFields": "false"})
    return [value, col(field.name).isNull()]


def row_hashes(df: DataFrame) -> list[Column]:
    """Two 64-bit hashes of a row; nulls count, columns go by their names."""
    fields = sorted(df.schema, key=lambda f: f.name.lower())
    values = [v for f in fields for v in _value(f)]
    return [F.xxhash64(F.lit(seed), *values) for seed in SEEDS]


def sums(hashes: Sequence[Column]) -> list[Column]:
    """Aggregates of rows: ``rows``, ``d0`` and ``d1``."""
    wide = [F.sum(h.cast("decimal(28,0)")) for h in hashes]
    none = F.lit(0).cast("decimal(38,0)")
    return [
        F.count(F.lit(1)).alias("rows"),
        *[F.coalesce(w, none).alias(f"d{i}") for i, w in enumerate(wide)],
    ]


def _nullable(kind: T.DataType) -> T.DataType:
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _nullable(f.dataType)) for f in kind])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_nullable(kind.elementType))
    if isinstance(kind, T.MapType):
        return T.MapType(_nullable(kind.keyType), _nullable(kind.valueType))
    return kind


def shaped_like(df: DataFrame, other: DataFrame) -> DataFrame:
    """The columns of ``other``, in its types, found in any spelling."""
    names = {c.lower(): c for c in df.columns}
    return df.select(
        *[col(names[f.name.lower()]).cast(_nullable(f.dataType)).alias(f.name) for f in other.schema]
    )


def table_digest(df: DataFrame) -> DataFrame:
    """One row: rows, d0, d1."""
    return df.agg(*sums(row_hashes(df)))


def _bucket(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*[col(k) for k in keys]), F.lit(buckets)).cast("int")


def bucket_digests(df: DataFrame, keys: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """Rows (bucket, rows, d0, d1); sums combine before the shuffle."""
    return df.groupBy(_bucket(keys, buckets).alias("bucket")).agg(*sums(row_hashes(df)))


def unlike_buckets(
    source: DataFrame, target: DataFrame, keys: Sequence[str], buckets: int = BUCKETS
) -> DataFrame:
    """Buckets whose digests differ, ``buckets`` at most."""
    names = ("rows", "d0", "d1")
    s = bucket_digests(source, keys, buckets)
    t = bucket_digests(shaped_like(target, source), keys, buckets)
    t = t.withColumnsRenamed({n: f"t_{n}" for n in names})
    same = [F.col(n).eqNullSafe(F.col(f"t_{n}")) for n in names]
    return s.join(t, "bucket", "full").where(~(same[0] & same[1] & same[2])).select("bucket")


def differences(
    source: DataFrame, target: DataFrame, keys: Sequence[str], buckets: int = BUCKETS
) -> DataFrame:
    """Rows (keys, difference, source_rows, target_rows), one per key that is unlike.

    ``missing`` and ``added`` keys are on one side only; ``doubled`` and ``thinned`` ones
    have the same rows, in the target more or less often; others are ``changed``. A key
    that was replaced by another is one missing and one added. Null keys are keys. Rows
    meet by their hashes, combined before the shuffle.
    """
    target = shaped_like(target, source)
    unlike = F.broadcast(unlike_buckets(source, target, keys, buckets))
    names = [f"k{i}" for i in range(len(keys))]

    def counted(df: DataFrame, side: str) -> DataFrame:
        h0, h1 = row_hashes(df)
        rows = df.select(
            *[col(k).alias(n) for k, n in zip(keys, names, strict=True)],
            h0.alias("h0"),
            h1.alias("h1"),
            _bucket(keys, buckets).alias("bucket"),
            F.lit(int(side == "s")).alias("s"),
            F.lit(int(side == "t")).alias("t"),
        )
        return rows.join(unlike, "bucket", "left_semi")

    contents = (
        counted(source, "s")
        .unionByName(counted(target, "t"))
        .groupBy(*names, "h0", "h1")
        .agg(F.sum("s").alias("s"), F.sum("t").alias("t"))
    )
    s, t = F.col("s"), F.col("t")
    per_key = contents.groupBy(*names).agg(
        F.sum(s).alias("source_rows"),
        F.sum(t).alias("target_rows"),
        F.bool_or(s != t).alias("unlike"),
        F.bool_or((s == 0) | (t == 0)).alias("other"),
        F.bool_or(s > t).alias("less"),
    )
    kind = (
        F.when(F.col("target_rows") == 0, "missing")
        .when(F.col("source_rows") == 0, "added")
        .when(F.col("other"), "changed")
        .when(~F.col("less"), "doubled")
        .when(F.col("source_rows") > F.col("target_rows"), "thinned")
        .otherwise("changed")
    )
    return per_key.where("unlike").select(
        *[F.col(n).alias(k) for n, k in zip(names, keys, strict=True)],
        kind.alias("difference"),
        "source_rows",
        "target_rows",
    )


def verify_content(pairs: Mapping[str, tuple[DataFrame | None, DataFrame | None]]) -> DataFrame:
    """AGG-17 by content: per table PASS, MISMATCH, SKIP (no source) or ERROR (no target).

    Rows and digests of a table come from one scan of each side. Unlike rows are a MISMATCH
    whatever their number.
    """
    names = ("rows", "d0", "d1")
    sides = []
    for table, (source, target) in pairs.items():
        if source is not None and target is not None:
            target = shaped_like(target, source)
        for side, df in (("source", source), ("target", target)):
            if df is not None:
                tags = F.lit(table).alias("table_name"), F.lit(side).alias("side")
                sides.append(table_digest(df).select(*tags, *names))
    of_side = lambda side, n: F.max(F.when(F.col("side") == side, F.col(n))).alias(f"{side}_{n}")
    every = union_filled(sides).groupBy("table_name").agg(
        *[of_side(side, n) for side in ("source", "target") for n in names]
    )
    same = [F.col(f"source_{n}") == F.col(f"target_{n}") for n in names]
    status = (
        F.when(F.col("target_rows").isNull(), "ERROR")
        .when(F.col("source_rows").isNull(), "SKIP")
        .when(same[0] & same[1] & same[2], "PASS")
        .otherwise("MISMATCH")
    )
    return every.select("table_name", "source_rows", "target_rows", status.alias("status"))
