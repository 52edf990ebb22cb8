"""Ledger gates, selections and transitions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldrow.operators import audit, ledger, logs
from goldrow.plans.catalog import STAGES
from workload.base import Data, derive, query
from workload.quality import RUN

_LEDGER = f"WITH {derive('ledger')} "


def _gate_sql(stage: str) -> str:
    own = STAGES.index(stage)
    earlier = "".join(f" AND {s}_status = 'Y'" for s in STAGES[:own])
    return f"coalesce({stage}_status, 'N') <> 'Y'{earlier}"


@query(
    "prj_22_stage_gates",
    _LEDGER
    + " UNION ALL ".join(
        f"SELECT '{s}' AS stage, batch_id, source_system_name FROM ledger WHERE {_gate_sql(s)} "
        "AND source_system_name = 'CRM_A'"
        for s in STAGES
    ),
)
def prj_22(data: Data) -> DataFrame:
    # All six gates in one pass over the ledger.
    stages = F.array(*[F.when(ledger.gate(s, "CRM_A"), F.lit(s)) for s in STAGES])
    return (
        data["ledger"]
        .select(F.explode(stages).alias("stage"), "batch_id", "source_system_name")
        .where(F.col("stage").isNotNull())
    )


@query(
    "prj_23_gate_reasons",
    _LEDGER
    + """SELECT batch_id, source_system_name, CASE
      WHEN raw_ingestion_status IS DISTINCT FROM 'Y' THEN 'raw_ingestion'
      WHEN stdz_status IS DISTINCT FROM 'Y' THEN 'stdz'
      WHEN canonical_status IS DISTINCT FROM 'Y' THEN 'canonical'
      WHEN dq_status IS DISTINCT FROM 'Y' THEN 'dq'
      WHEN ingress_status IS DISTINCT FROM 'Y' THEN 'ingress'
      WHEN egress_status = 'Y' THEN 'done' ELSE 'open' END AS reason FROM ledger""",
)
def prj_23(data: Data) -> DataFrame:
    """Why a batch may or may not enter egress, for every batch at once."""
    return data["ledger"].select(
        "batch_id", "source_system_name", ledger.gate_reason("egress").alias("reason")
    )


@query(
    "prj_24_transition_state",
    _LEDGER
    + """SELECT batch_id, source_system_name, raw_ingestion_status,
      CASE WHEN raw_ingestion_status = 'Y' AND stdz_status IS NULL THEN 'Y' ELSE stdz_status END
        AS stdz_status, CAST(epoch_us(coalesce(batch_end_time, CASE WHEN
          raw_ingestion_status = 'Y' AND stdz_status IS NULL THEN TIMESTAMP '2024-01-31' END))
          AS BIGINT) AS ended FROM ledger""",
)
def prj_24(data: Data) -> DataFrame:
    """Batches waiting for standardization are marked done; state is the latest event."""
    wide = data["ledger"]
    done = ledger.transition(
        wide.where(ledger.gate("stdz") & F.col("stdz_status").isNull()),
        "stdz",
        "Y",
        event_seq=1,
        event_time=F.lit("2024-01-31").cast("timestamp"),
        close=True,
    )
    state = ledger.current_state(ledger.events_of(wide).unionByName(done))
    return state.select(
        "batch_id",
        "source_system_name",
        "raw_ingestion_status",
        "stdz_status",
        F.unix_micros("batch_end_time").alias("ended"),
    )


@query(
    "prj_25_reset_latest",
    _LEDGER
    + """SELECT batch_id, stage, status FROM (SELECT max(batch_id) AS batch_id FROM ledger
      WHERE source_system_name = 'CRM_B') CROSS JOIN (VALUES ('egress_status', 'N'),
      ('snowflake_sync_status', 'N')) AS v(stage, status)""",
)
def prj_25(data: Data) -> DataFrame:
    events = ledger.reset_latest(
        data["ledger"],
        "CRM_B",
        ["egress", "snowflake_sync"],
        event_seq=9,
        event_time=F.lit("2024-01-31").cast("timestamp"),
    )
    return events.select("batch_id", "stage", "status")


@query(
    "agg_01_pending_window",
    _LEDGER
    + f"""SELECT CAST(epoch_us(min(batch_start_time)) AS BIGINT) AS start_micros,
      CAST(epoch_us(max(batch_end_time)) AS BIGINT) AS end_micros FROM ledger
    WHERE {_gate_sql("dq")}""",
)
def agg_01(data: Data) -> DataFrame:
    window = ledger.pending_window(ledger.eligible(data["ledger"], "dq"))
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    return window.select(
        micros("batch_start_date").alias("start_micros"),
        micros("batch_end_date").alias("end_micros"),
    )


@query(
    "agg_02_pending_ids",
    _LEDGER
    + f"""SELECT batch_id, max(batch_id) OVER () AS latest_batch_id FROM (SELECT DISTINCT batch_id
      FROM ledger WHERE {_gate_sql("egress")} AND source_system_name = 'CRM_A')""",
)
def agg_02(data: Data) -> DataFrame:
    return ledger.pending_ids(ledger.eligible(data["ledger"], "egress", "CRM_A"))


@query(
    "agg_21_stuck_batches",
    _LEDGER
    + """SELECT batch_id, source_system_name, egress_status FROM ledger
    WHERE raw_ingestion_status = 'Y' AND coalesce(egress_status, 'N') <> 'Y'
      AND batch_start_time < TIMESTAMP '1997-06-01 03:00:00' - INTERVAL 6 HOURS""",
)
def agg_21(data: Data) -> DataFrame:
    now = F.lit("1997-06-01 03:00:00").cast("timestamp_ntz")
    return audit.stuck_batches(data["ledger"], now).select(
        "batch_id", "source_system_name", "egress_status"
    )


@query(
    "srt_01_ordered_batches",
    _LEDGER + "SELECT batch_id, source_system_name FROM ledger ORDER BY source_system_name, batch_id",
)
def srt_01(data: Data) -> DataFrame:
    return ledger.ordered(data["ledger"]).select("batch_id", "source_system_name")


@query(
    "log_01_stage_events",
    " UNION ALL ".join(
        f"SELECT '{t}' AS source_identifier, 'Passed' AS run_status, 5400.0 AS time_elapsed, "
        f"CAST(count(*) AS STRING) AS sub_module FROM {t}"
        for t in ("orders", "lineitem")
    ),
)
def log_01(data: Data) -> DataFrame:
    """One event per loaded table, with its row count, which is counted as the rows are read."""
    orders, lineitem = (
        logs.stage_event(
            data[table].agg(F.count(F.lit(1)).cast("string").alias("sub_module")),
            start_time=RUN,
            end_time=RUN.replace(hour=1, minute=30),
            source_identifier=table,
            run_status="Passed",
        )
        for table in ("orders", "lineitem")
    )
    events = orders.unionByName(lineitem)
    return events.select("source_identifier", "run_status", "time_elapsed", "sub_module")
