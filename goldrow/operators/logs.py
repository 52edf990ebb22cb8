"""Stage event rows (LOG-01)."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Columns of the stage log.
STAGE_LOG_SCHEMA = (
    "run_id string, source_identifier string, source_system_name string, job_id string, "
    "module string, sub_module string, run_status string, error_description string, "
    "run_url string, start_time timestamp, end_time timestamp, time_elapsed double, "
    "user_id string, cluster_id string"
)


def stage_event(
    outcome: DataFrame, *, start_time: datetime, end_time: datetime, **fields: str | None
) -> DataFrame:
    """One stage log row per row of ``outcome``, which says what a stage did.

    Columns of ``outcome`` and the named fields fill the log's columns; others are null.
    """
    elapsed = (end_time - start_time).total_seconds()
    schema = T.StructType.fromDDL(STAGE_LOG_SCHEMA)
    unknown = {*fields, *outcome.columns} - set(schema.names)
    if unknown:
        raise ValueError(f"unknown stage log columns: {sorted(unknown)}")
    known = fields | {"start_time": start_time, "end_time": end_time, "time_elapsed": elapsed}
    return outcome.select(
        *[
            (F.lit(known[f.name]) if f.name in known else F.col(f.name))
            .cast(f.dataType)
            .alias(f.name)
            if f.name in known or f.name in outcome.columns
            else F.lit(None).cast(f.dataType).alias(f.name)
            for f in schema
        ]
    )
