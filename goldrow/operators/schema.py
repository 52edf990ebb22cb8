"""Column lookup, lineage columns and schema alignment."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def find_column(df: DataFrame, name: str) -> str | None:
    """Actual spelling of a column, looked up without regard to case."""
    return next((c for c in df.columns if c.lower() == name.lower()), None)


def require_column(df: DataFrame, name: str) -> str:
    actual = find_column(df, name) if name else None
    if actual is None:
        raise ValueError(f"column {name!r} not found; available: {df.columns}")
    return actual


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def col(name: str) -> Column:
    """Column by exact name, dots and blanks included."""
    return F.col(quoted(name))


def underscore_names(df: DataFrame) -> DataFrame:
    """PRJ-06: blanks in column names become underscores."""
    return df.toDF(*[c.replace(" ", "_") for c in df.columns])


def keep_order(df: DataFrame, order: Iterable[str]) -> DataFrame:
    """PRJ-07: the columns of ``order`` that exist, in that order."""
    present = set(df.columns)
    return df.select(*[col(c) for c in order if c in present])


def stamp_raw(df: DataFrame, batch_ids: Iterable[int], source: str, load_time: Column) -> DataFrame:
    """PRJ-20: RAW lineage; the batch is the greatest pending id."""
    return df.withColumns(
        {
            "LOAD_DATE": load_time,
            "BATCH_ID": F.lit(max(batch_ids)).cast("long"),
            "Source_Name": F.lit(source),
        }
    )


def stamp_egress(df: DataFrame, source: str, batch_id: int, load_time: Column) -> DataFrame:
    """PRJ-19: add outbound lineage columns that are not there yet, in any spelling."""
    stamps = {
        "SOURCE_SYSTEM_NAME": F.lit(source),
        "BATCH_ID": F.lit(batch_id).cast("long"),
        "EGRESS_LOAD_DATE": load_time,
    }
    return df.withColumns({n: c for n, c in stamps.items() if find_column(df, n) is None})


def align(df: DataFrame, target: T.StructType) -> DataFrame:
    """SNK-04: shape rows like ``target``.

    Per target field: same-named source column in any spelling, cast where the type
    differs (a value that cannot be cast becomes null), null where absent. Columns the
    target lacks are dropped; ``BATCH_ID`` is always a long.
    """
    out = []
    for field in target:
        source = find_column(df, field.name)
        wanted = T.LongType() if field.name.upper() == "BATCH_ID" else field.dataType
        if source is None:
            value = F.lit(None).cast(wanted)
        elif df.schema[source].dataType == wanted:
            value = col(source)
        else:
            value = col(source).try_cast(wanted)
        out.append(value.alias(field.name))
    return df.select(*out)


def all_strings(df: DataFrame) -> DataFrame:
    """SNK-05: first load as text, except timestamps and the long batch id."""

    def as_loaded(field: T.StructField) -> Column:
        if field.name.upper() == "BATCH_ID":
            return col(field.name).try_cast("long").alias(field.name)
        if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            return col(field.name)
        return col(field.name).cast("string").alias(field.name)

    return df.select(*[as_loaded(f) for f in df.schema])


def json_complex_columns(df: DataFrame) -> DataFrame:
    """SNK-09: maps, structs and arrays as JSON text, for targets without such types."""
    complex_types = (T.MapType, T.StructType, T.ArrayType)
    return df.select(
        *[
            F.to_json(col(f.name), {"ignoreNullFields": "false"}).alias(f.name)
            if isinstance(f.dataType, complex_types)
            else col(f.name)
            for f in df.schema
        ]
    )


def empty_like(df: DataFrame) -> DataFrame:
    """SNK-12: no rows, same schema."""
    return df.sparkSession.createDataFrame([], df.schema)


def union_filled(frames: Iterable[DataFrame]) -> DataFrame:
    """SET-01: union by name; columns one side lacks are null there."""
    frames = list(frames)
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out


def rename(df: DataFrame, pairs: Mapping[str, str] | Iterable[tuple[str, str]]) -> DataFrame:
    """Select source columns under target names; a source may appear twice."""
    items = pairs.items() if isinstance(pairs, Mapping) else pairs
    return df.select(*[col(source).alias(target) for source, target in items])


def unnest(
    df: DataFrame, keep: Iterable[str | Column], array: str | Column, element: str = "record"
) -> DataFrame:
    """One row per array element, with its ``position``; rows without elements vanish.

    Spark guards a plain explode by a filter on the array's size and moves it below the
    projection that computes the array, which then runs twice. The outer form has no such
    filter; its placeholder rows are dropped afterwards.
    """
    rows = df.select(*keep, F.posexplode_outer(array).alias("position", element))
    return rows.where(F.col("position").isNotNull())
