"""Configured source-to-canonical mapping (PRJ-08, PRJ-09, JON-13, AGG-03, JON-16)."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldrow.operators.schema import quoted
from goldrow.plans.specs import FieldMap, JoinSpec

# A source text holding one of these keeps its own type.
TYPED_WORDS = ("timestamp", "date", "datetime", "time", "dob", "cast")


def mapping_rows(
    config: DataFrame, source: str, system: str, source_table: str, target_table: str
) -> list[FieldMap]:
    """Mapping rows of one source and target from the control table (configuration)."""
    same = lambda c, v: F.lower(F.trim(F.col(c))) == v.strip().lower()
    rows = config.where(
        same("source_identifier", source)
        & same("source_system_name", system)
        & same("src_tbl_nm", source_table)
        & same("tgt_tbl_nm", target_table)
    ).select("src_attribute", "tgt_attribute", "join_condition")
    found = [FieldMap(*r) for r in rows.collect()]
    if not found:
        raise ValueError(f"no mapping from {source_table} to {target_table} for {source}/{system}")
    return found


def projection(mappings: Iterable[FieldMap]) -> list[str]:
    """PRJ-08: SQL select items of the mapping rows."""
    items = []
    for m in mappings:
        if not m.target or m.target.strip().lower() == "load_date":
            continue
        target = quoted(m.target.strip())
        if m.source is None:
            items.append(f"CAST(NULL AS STRING) AS {target}")
        elif any(word in m.source.lower() for word in TYPED_WORDS):
            items.append(f"{m.source} AS {target}")
        else:
            items.append(f"CAST({m.source} AS STRING) AS {target}")
    if not items:
        raise ValueError("no usable mapping row")
    return items


def join_text(config: DataFrame) -> DataFrame:
    """AGG-03: distinct join fragments as one text, sorted so that it is stable."""
    fragments = F.sort_array(F.collect_set("join_condition"))
    return config.agg(F.concat_ws(" ", fragments).alias("join_condition"))


def join_fragments(mappings: Iterable[FieldMap]) -> list[str]:
    """Distinct join fragments in configuration order."""
    return list(dict.fromkeys(m.join for m in mappings if m.join))


def to_canonical(
    delta: DataFrame,
    mappings: Sequence[FieldMap],
    joins: Sequence[JoinSpec] = (),
    *,
    load_time: Column,
    batch_column: str = "Batch_ID",
) -> DataFrame:
    """PRJ-09 / JON-13: joined, mapped and distinct rows plus batch id and load time.

    The delta is ``n`` in every expression. The load time is added after the distinct,
    so it takes no part in comparing rows.
    """
    frame = delta.alias("n")
    for join in joins:
        frame = frame.join(join.table.alias(join.alias), F.expr(join.on), join.how)
    mapped = frame.selectExpr(*projection(mappings), f"n.{quoted(batch_column)} AS Batch_ID")
    return mapped.distinct().withColumn("Load_Date", load_time)


def insert_absent(existing: DataFrame, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """JON-16: the configuration rows whose key, in any case and spacing, is not there yet."""
    norm = lambda alias, k: F.lower(F.trim(F.col(f"{alias}.{k}")))
    condition = [norm("n", k).eqNullSafe(norm("e", k)) for k in keys]
    return rows.alias("n").join(existing.alias("e"), condition, "left_anti")
