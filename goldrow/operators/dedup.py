"""Latest row per key (WIN-01..03)."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from goldrow.operators.schema import col, find_column

# Recency columns per layer, in order of preference.
LANDING_ORDER = ("last_update_date", "LOAD_DATE")
CANONICAL_ORDER = ("last_update_date", "batch_id")
INGRESS_ORDER = ("LOAD_DATE",)


def parse_keys(text: str | None) -> list[str]:
    """Key columns from configuration text separated by commas or blanks."""
    return re.findall(r"[^\s,]+", text or "")


def existing_keys(df: DataFrame, keys: Sequence[str]) -> list[str]:
    found = [c for c in (find_column(df, k) for k in keys) if c is not None]
    if keys and not found:
        raise ValueError(f"none of the key columns {list(keys)} exist; available: {df.columns}")
    return found


def _comparable(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return _comparable(kind.elementType)
    if isinstance(kind, T.StructType):
        return all(_comparable(f.dataType) for f in kind)
    return not isinstance(kind, (T.MapType, T.VariantType))


def latest_per_key(
    df: DataFrame,
    keys: str | Sequence[str] | None,
    order: Sequence[str] = LANDING_ORDER,
    tiebreak: Sequence[Column] | None = None,
) -> DataFrame:
    """The most recent row of every key; without keys the input is returned as it is.

    The first existing column of ``order`` decides, newest first and nulls last. Ties,
    and inputs without any such column, fall to ``tiebreak``: by default all remaining
    columns descending, so the result does not depend on how the input is split.

    The filter on ``row_number`` lets Spark keep one row per key and task before the
    shuffle (WindowGroupLimit), so a key holding most rows costs one row per task.
    """
    names = parse_keys(keys) if isinstance(keys, str) else list(keys or [])
    names = existing_keys(df, names)
    if not names:
        return df
    recency = next((c for c in (find_column(df, o) for o in order) if c), None)
    if tiebreak is None:
        taken = {*names, recency}
        tiebreak = [
            col(f.name).desc_nulls_last()
            for f in df.schema
            if f.name not in taken and _comparable(f.dataType)
        ]
    ordering = ([col(recency).desc_nulls_last()] if recency else []) + list(tiebreak)
    if not ordering:
        return df.dropDuplicates(names)
    window = Window.partitionBy(*[col(n) for n in names]).orderBy(*ordering)
    return df.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")


def latest_for_canonical(
    df: DataFrame, keys: str | Sequence[str] | None, tiebreak: Sequence[Column] | None = None
) -> DataFrame:
    """WIN-02: as above on the canonical layer's order columns; composite keys included."""
    return latest_per_key(df, keys, CANONICAL_ORDER, tiebreak)


def latest_for_ingress(
    df: DataFrame, key: str, tiebreak: Sequence[Column] | None = None
) -> DataFrame:
    """WIN-03: one row per business key by load date."""
    return latest_per_key(df, [key], INGRESS_ORDER, tiebreak)
