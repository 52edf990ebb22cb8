"""Batch ledger: which batches a stage may take, and their status over time.

Statuses are appended as events and never updated; the state of a batch is its latest
event per stage (PRJ-22..25, AGG-01, AGG-02).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldrow.plans.catalog import STAGES

# Load window that stands for "everything".
FULL_LOAD_START = "1900-01-01 00:00:00"

EVENT_SCHEMA = (
    "batch_id long, source_system_name string, stage string, status string, event_seq long, "
    "event_time timestamp, batch_start_time timestamp, batch_end_time timestamp"
)


def status_column(stage: str) -> str:
    """Ledger column of a stage; names that are not stages pass through."""
    key = stage.strip().lower()
    key = "raw_ingestion" if key == "rawingestion" else key
    return f"{key}_status" if key in (*STAGES, "snowflake_sync") else stage


def gate(stage: str, source: str | None = None) -> Column:
    """PRJ-22: all earlier stages are 'Y' and this one is not."""
    key = status_column(stage).removesuffix("_status")
    if key not in STAGES:
        raise ValueError(f"unsupported stage: {stage}")
    own = STAGES.index(key)
    condition = F.coalesce(F.col(f"{key}_status"), F.lit("N")) != "Y"
    for earlier in STAGES[:own]:
        condition = condition & (F.col(f"{earlier}_status") == "Y")
    if source is not None:
        condition = condition & (F.col("source_system_name") == source)
    return condition


def eligible(ledger: DataFrame, stage: str, source: str | None = None) -> DataFrame:
    return ledger.where(gate(stage, source))


def ordered(batches: DataFrame) -> DataFrame:
    """SRT-01: batches of every source in the order they are processed."""
    return batches.orderBy("source_system_name", "batch_id")


def assert_gate(ledger: DataFrame, stage: str, source: str, batch_id: int) -> None:
    """PRJ-23: raise, naming the reason, unless the batch may enter the stage.

    One aggregated row is read, whatever the ledger's size.
    """
    own = STAGES.index(stage)
    batch = ledger.where((F.col("source_system_name") == source) & (F.col("batch_id") == batch_id))
    checks = [F.count(F.lit(1)).alias("rows")] + [
        F.max(F.coalesce(F.col(f"{s}_status"), F.lit("null"))).alias(s) for s in STAGES[: own + 1]
    ]
    row = batch.agg(*checks).first()
    if row["rows"] == 0:
        raise RuntimeError(f"no ledger record for {source}/{batch_id}")
    for earlier in STAGES[:own]:
        if row[earlier] != "Y":
            raise RuntimeError(f"gate failed: {earlier}_status={row[earlier]}, expected=Y")
    if row[stage] == "Y":
        raise RuntimeError(f"batch {batch_id} is already {stage} complete")


def gate_reason(stage: str) -> Column:
    """The first earlier stage that is not 'Y', else 'done' or 'open'."""
    own = STAGES.index(stage)
    blocked = [
        F.when(~F.col(f"{s}_status").eqNullSafe(F.lit("Y")), F.lit(s)) for s in STAGES[:own]
    ]
    state = F.when(F.col(f"{stage}_status") == "Y", "done").otherwise("open")
    return F.coalesce(*blocked, state)


def pending_window(pending: DataFrame) -> DataFrame:
    """AGG-01: earliest start and latest end over the pending batches."""
    return pending.agg(
        F.min("batch_start_time").alias("batch_start_date"),
        F.max("batch_end_time").alias("batch_end_date"),
    )


def pending_ids(pending: DataFrame) -> DataFrame:
    """AGG-02: the batch ids as rows, each with the latest of all."""
    latest = pending.agg(F.max("batch_id")).scalar()
    return pending.select("batch_id").distinct().withColumn("latest_batch_id", latest)


def transition(
    batches: DataFrame,
    stage: str,
    status: str,
    *,
    event_seq: int,
    event_time: Column,
    close: bool = False,
) -> DataFrame:
    """PRJ-24: events moving ``batches`` (ledger rows) to ``status`` at ``stage``.

    ``close`` also ends a batch whose end is still open.
    """
    end = F.col("batch_end_time")
    return batches.select(
        F.col("batch_id").cast("long"),
        "source_system_name",
        F.lit(status_column(stage)).alias("stage"),
        F.lit(status).alias("status"),
        F.lit(event_seq).cast("long").alias("event_seq"),
        event_time.cast("timestamp").alias("event_time"),
        F.col("batch_start_time").cast("timestamp").alias("batch_start_time"),
        (F.coalesce(end, event_time) if close else end)
        .cast("timestamp")
        .alias("batch_end_time"),
    )


def reset_latest(
    ledger: DataFrame, source: str, stages: Iterable[str], *, event_seq: int, event_time: Column
) -> DataFrame:
    """PRJ-25: events setting the latest batch of a source back to 'N' at the stages."""
    own = ledger.where(F.col("source_system_name") == source)
    latest = own.where(F.col("batch_id") == own.select(F.max("batch_id")).scalar())
    events = [
        transition(latest, s, "N", event_seq=event_seq, event_time=event_time) for s in stages
    ]
    out = events[0]
    for more in events[1:]:
        out = out.unionByName(more)
    return out


def events_of(ledger: DataFrame, *, event_seq: int = 0) -> DataFrame:
    """A wide ledger as events, one per batch, source and known status."""
    names = [f"{s}_status" for s in (*STAGES, "snowflake_sync") if f"{s}_status" in ledger.columns]
    return (
        ledger.unpivot(
            ["batch_id", "source_system_name", "batch_start_time", "batch_end_time"],
            names,
            "stage",
            "status",
        )
        .where(F.col("status").isNotNull())
        .select(
            F.col("batch_id").cast("long"),
            "source_system_name",
            "stage",
            "status",
            F.lit(event_seq).cast("long").alias("event_seq"),
            F.col("batch_start_time").cast("timestamp").alias("event_time"),
            F.col("batch_start_time").cast("timestamp").alias("batch_start_time"),
            F.col("batch_end_time").cast("timestamp").alias("batch_end_time"),
        )
    )


def latest_events(events: DataFrame) -> DataFrame:
    """Of each batch, source and stage the event that decides its state."""
    names = ("batch_id", "source_system_name", "stage")
    others = [c for c in events.columns if c not in names]
    last = F.max_by(F.struct(*others), F.struct("event_seq", "event_time", "status"))
    return (
        events.groupBy(*names)
        .agg(last.alias("_last"))
        .select(*[F.col(c) if c in names else F.col("_last")[c].alias(c) for c in events.columns])
    )


def current_state(events: DataFrame, stages: Iterable[str] = STAGES) -> DataFrame:
    """The wide ledger: latest status per batch, source and stage, by one aggregation.

    A batch's times come from the latest events of all of its stages.
    """
    stages = list(stages)
    every = dict.fromkeys([*stages, *STAGES, "snowflake_sync"])
    value = F.struct("status", "batch_start_time", "batch_end_time")
    order = F.struct("event_seq", "event_time", "status")

    def last(stage: str) -> Column:
        own = F.col("stage") == f"{stage}_status"
        return F.max_by(F.when(own, value), F.when(own, order)).alias(stage)

    latest = events.groupBy("batch_id", "source_system_name").agg(*[last(s) for s in every])
    return latest.select(
        "batch_id",
        "source_system_name",
        F.least(*[F.col(s)["batch_start_time"] for s in every]).alias("batch_start_time"),
        F.greatest(*[F.col(s)["batch_end_time"] for s in every]).alias("batch_end_time"),
        *[F.col(s)["status"].alias(f"{s}_status") for s in stages],
    )
