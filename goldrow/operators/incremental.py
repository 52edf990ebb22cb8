"""Which rows a load takes: filters, windows, high-water marks, changed keys (PRJ-01..05)."""

from __future__ import annotations

import logging
from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from goldrow.functions.temporal import parse_timestamp
from goldrow.operators.schema import col, find_column

log = logging.getLogger(__name__)


def active_records(df: DataFrame, sql: str | None, view: str = "raw_table_vw") -> DataFrame:
    """PRJ-01: replace the input by a configured query over it, named ``view`` there."""
    if sql is None or not sql.strip() or sql.strip().lower() == "none":
        return df
    df.createOrReplaceTempView(view)
    return df.sparkSession.sql(sql)


def as_timestamp(df: DataFrame, column: str) -> Column:
    kind = df.schema[column].dataType
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return col(column).cast("timestamp")
    return parse_timestamp(col(column).cast("string"))


def incremental_window(
    df: DataFrame,
    *,
    full_load: bool,
    load_type: str,
    date_column: str,
    start: datetime | Column,
    end: datetime | Column,
    high_water: datetime | Column | None = None,
    condition: str | None = None,
) -> DataFrame:
    """PRJ-02/03: configured filter, then ``start < ts <= end`` or newer than ``high_water``.

    A full load returns everything, the configured filter included: it is not applied.
    Rows whose date does not parse are dropped.
    """
    if full_load:
        return df
    if condition is not None:
        df = df.filter(condition)
    actual = find_column(df, date_column) if date_column else None
    if load_type != "delta" or actual is None:
        return df
    ts = as_timestamp(df, actual)
    lit = lambda v: v if isinstance(v, Column) else F.lit(v)
    # As the output of a generator, the date is parsed once however often it is compared.
    dated = df.withColumn("_ts", F.explode_outer(F.array(ts)))
    at = F.col("_ts")
    keep = (at > lit(start)) & (at <= lit(end))
    if high_water is not None:
        keep = keep | (at > lit(high_water))
    return dated.where(keep).drop("_ts")


def high_water_mark(df: DataFrame, date_column: str) -> DataFrame:
    """PRJ-04: one row, ``high_water``; read it after the batch's own rows are replaced."""
    return df.agg(F.max(col(date_column)).alias("high_water"))


def changed_keys(
    tables: Mapping[str, tuple[DataFrame, str, str]],
    start: datetime | str,
    end: datetime | str,
) -> DataFrame:
    """PRJ-05: distinct keys (``delta_id``) with a change in ``(start, end]`` in any table.

    ``tables`` maps a label to (frame, key column, timestamp column). A table lacking
    its columns is a warning. The keys stay distributed.
    """
    low, high = F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp")
    parts = []
    for label, (df, key, ts) in tables.items():
        missing = [c for c in (key, ts) if find_column(df, c) is None]
        if missing:
            log.warning("changed keys: %s skipped, it lacks %s", label, missing)
            continue
        at = F.col(ts).cast("timestamp")
        parts.append(
            df.where((at > low) & (at <= high) & F.col(key).isNotNull()).select(
                F.col(key).cast("string").alias("delta_id")
            )
        )
    if not parts:
        raise ValueError("no table to look for changes in")
    out = parts[0]
    for part in parts[1:]:
        out = out.unionAll(part)
    return out.distinct()
