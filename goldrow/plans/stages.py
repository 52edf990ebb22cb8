"""The stages from source to master, each one call per entity table.

A stage reads one layer, writes the next and returns what it wrote; it keeps no state
but the tables. Whoever schedules stages asks the ledger first and records the outcome
after, with ``pending`` and ``record``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from goldrow.operators import canonical, dedup, incremental, ingress, ledger, quality, schema
from goldrow.operators.standardize import standardize
from goldrow.plans.catalog import REFERENCE_TABLE, rules_for
from goldrow.plans.specs import FieldMap, JoinSpec, StandardizeRule
from goldrow.sinks import versions, writers


@dataclass(frozen=True)
class Layers:
    """Where the layer tables are: ``<root>/<layer>/<table>``."""

    spark: SparkSession
    root: str

    def path(self, layer: str, table: str) -> str:
        return f"{self.root.rstrip('/')}/{layer}/{table}"

    def has(self, layer: str, table: str) -> bool:
        return writers.table_exists(self.spark, self.path(layer, table))

    def read(self, layer: str, table: str) -> DataFrame:
        return writers.read_layer(self.spark, self.path(layer, table))


@dataclass(frozen=True)
class Entity:
    """Configuration of one entity table of one source system."""

    table: str
    source_system: str
    keys: str = "iqvia_id"
    load_type: str = "delta"
    full_load: bool = False
    date_column: str = ""
    condition: str | None = None
    active_sql: str | None = None
    rules: Sequence[StandardizeRule] = ()
    mapping: Sequence[FieldMap] = ()
    joins: Sequence[JoinSpec] = field(default_factory=tuple)


# ------------------------------------------------------------------ ledger


def record(layers: Layers, events: DataFrame) -> None:
    """Append ledger events, as one numbered version: all of them are seen or none."""
    writers.write_table(events, layers.path("control", "ledger"), "append", ())


def ledger_events(layers: Layers) -> DataFrame:
    kinds = layers.spark.createDataFrame([], ledger.EVENT_SCHEMA).schema
    return writers.read_layer(layers.spark, layers.path("control", "ledger"), kinds)


def ledger_state(layers: Layers) -> DataFrame:
    return ledger.current_state(ledger_events(layers))


def compact_ledger(layers: Layers) -> int:
    """Keep the latest event per batch, source and stage; the state stays what it is.

    Events that are recorded meanwhile are not lost: the compaction starts anew.
    """
    path = layers.path("control", "ledger")
    while True:
        base = versions.version(layers.spark, path)
        latest = ledger.latest_events(versions.read(layers.spark, path, base))
        try:
            return versions.write(latest, path, (), mode="all", base=base)
        except versions.ConflictError:
            continue


CLAIM_SCHEMA = (
    "stage string, source_system_name string, batch_id long, runner string, until timestamp"
)


def claim(
    layers: Layers,
    stage: str,
    source: str,
    batch_ids: Sequence[int],
    runner: str,
    at: datetime,
    lease: timedelta = timedelta(hours=1),
) -> datetime:
    """Take pending batches for one runner until the lease ends, which is returned.

    Of two runners that take one batch at once, one is refused: claims are one versioned
    table, and a claim is its next number. A batch that may not enter the stage, or that
    another runner holds, is refused as well; the same runner may claim again.
    """
    wanted = set(batch_ids)
    missing = sorted(wanted - set(pending(layers, stage, source)))
    if missing:
        raise RuntimeError(f"batches {missing} of {source} may not enter {stage}")
    spark, path = layers.spark, layers.path("control", "claims")
    base = versions.version(spark, path)
    kinds = spark.createDataFrame([], CLAIM_SCHEMA).schema
    # Open claims are few, at most one per batch that is being worked on.
    held = versions.read(spark, path, base, kinds).where(F.col("until") > F.lit(at)).collect() if base else []
    ours = lambda c: (c["stage"], c["source_system_name"]) == (stage, source) and c["batch_id"] in wanted
    taken = sorted(c["batch_id"] for c in held if ours(c) and c["runner"] != runner)
    if taken:
        raise versions.ConflictError(f"batches {taken} of {source} are taken at {stage}")
    rows = [tuple(c) for c in held if not ours(c)]
    rows += [(stage, source, b, runner, at + lease) for b in sorted(wanted)]
    if base is None:
        versions.commit(
            spark, path, versions.stage(spark.createDataFrame([], kinds), path, ()), None, mode="all"
        )
        base = versions.version(spark, path, 1)
    versions.write(spark.createDataFrame(rows, kinds), path, (), mode="all", base=base)
    return at + lease


def pending(layers: Layers, stage: str, source: str) -> list[int]:
    """Ids of the batches a stage may take, ascending; a ledger decision, so few values."""
    rows = ledger.eligible(ledger_state(layers), stage, source).select("batch_id")
    return [r[0] for r in rows.distinct().orderBy("batch_id").collect()]


def mark_done(
    layers: Layers, stage: str, source: str, batch_ids: Iterable[int], at: datetime, seq: int
) -> None:
    """Set batches to 'Y' at a stage; ingest and egress also end an open batch."""
    batches = ledger_state(layers).where(
        (F.col("source_system_name") == source) & F.col("batch_id").isin(list(batch_ids))
    )
    record(
        layers,
        ledger.transition(
            batches,
            stage,
            "Y",
            event_seq=seq,
            event_time=F.lit(at).cast("timestamp"),
            close=stage in ("raw_ingestion", "egress"),
        ),
    )


# ------------------------------------------------------------------ stages


def ingest(
    layers: Layers,
    entity: Entity,
    source: DataFrame,
    batch_ids: Sequence[int],
    window: tuple[datetime, datetime],
    load_time: Column,
) -> int:
    """Source -> RAW: window the rows, drop whole-row copies, stamp, load.

    The high-water mark is taken over the rows the load leaves in place, as a scalar
    subquery of the same plan.
    """
    path, high_water = layers.path("raw", entity.table), None
    if entity.load_type == "delta" and layers.has("raw", entity.table):
        target = layers.read("raw", entity.table)
        own = (F.col("Source_Name") == entity.source_system) & F.col("BATCH_ID").isin(
            list(batch_ids)
        )
        column = schema.find_column(target, entity.date_column) if entity.date_column else None
        if column is not None:
            stamps = target.where(~own).select(incremental.as_timestamp(target, column).alias("ts"))
            high_water = stamps.agg(F.max("ts")).scalar()
    rows = incremental.incremental_window(
        source,
        full_load=entity.full_load,
        load_type=entity.load_type,
        date_column=entity.date_column,
        start=window[0],
        end=window[1],
        high_water=high_water,
        condition=entity.condition,
    )
    rows = schema.underscore_names(rows).distinct()
    rows = schema.stamp_raw(rows, batch_ids, entity.source_system, load_time)
    emptied = [(entity.source_system, b) for b in batch_ids]
    return writers.load_raw(rows, path, load_type=entity.load_type, emptied=emptied)


def land(layers: Layers, entity: Entity, batch_ids: Sequence[int]) -> int:
    """RAW -> LANDING: newest row per key of the pending batches, standardized."""
    raw = incremental.active_records(layers.read("raw", entity.table), entity.active_sql)
    rows = raw.where(
        F.col("BATCH_ID").isin(list(batch_ids)) & (F.col("Source_Name") == entity.source_system)
    )
    latest = schema.underscore_names(dedup.latest_per_key(rows, entity.keys))
    return writers.load_landing(
        standardize(latest, entity.rules),
        layers.path("landing", entity.table),
        full_load=entity.full_load,
        batches=batch_ids,
    )


def canonicalize(
    layers: Layers, entity: Entity, batch_ids: Sequence[int], load_time: Column
) -> int:
    """LANDING -> CANONICAL: newest row per key, mapped and distinct."""
    landing = layers.read("landing", entity.table)
    rows = landing.where(F.col("BATCH_ID").isin(list(batch_ids)))
    rows = dedup.latest_for_canonical(rows, entity.keys)
    mapped = canonical.to_canonical(rows, entity.mapping, entity.joins, load_time=load_time)
    path = layers.path("canonical", entity.table)
    return writers.append_evolving(mapped, path, ("Batch_ID",), batch_ids)


@dataclass(frozen=True)
class GateOutcome:
    staged: int
    log: DataFrame
    trail: DataFrame


def gate(
    layers: Layers,
    table: str,
    *,
    run_id: str,
    source_system: str,
    at: Column,
    batch_id: int | None = None,
    rules: Sequence | None = None,
) -> GateOutcome:
    """CANONICAL -> STAGING: the rules run once; passed rows replace the staging table.

    The rule log and the reject trail come from the same flagged rows and are appended.
    """
    rows = quality.choose_batch(layers.read("canonical", table), batch_id)
    reference = layers.read("canonical", REFERENCE_TABLE[table])
    chosen = list(rules) if rules is not None else list(rules_for(table))
    result = quality.run_chain(rows, chosen, reference, processed_at=at).written()
    # A batch that is rejected as a whole leaves an empty staging table.
    staged = writers.replace_table(result.staged, layers.path("staging", table), ("Batch_ID",))
    taken = batch_id
    if taken is None:
        flagged = result.flagged
        taken = flagged.agg(F.max(schema.require_column(flagged, "Batch_ID"))).scalar()
    common = {"run_id": run_id, "batch_id": taken, "source_system": source_system}
    log = quality.outcome_log(
        result, source_identifier=table, table=table, started=at, ended=at, **common
    )
    trail = quality.reject_trail(result, table=table, rejected_at=at, **common)
    log.write.mode("append").parquet(layers.path("control", "dq_log"))
    trail.write.mode("append").parquet(layers.path("control", "dq_rejects"))
    return GateOutcome(staged, log, trail)


def to_hub(
    layers: Layers,
    table: str,
    batch_ids: Sequence[int],
    mapping: Mapping[str, str] | None = None,
    key: str = "iqvia_id",
) -> dict[str, int]:
    """STAGING -> MDM: per target the mapped rows of the batches, replacing earlier ones."""
    staging = layers.read("staging", table)
    rows = staging.where(F.col("Batch_ID").cast("long").isin(list(batch_ids)))
    # One row per key within each batch: batches are handled together but stay apart.
    latest = dedup.latest_per_key(rows, [key, "Batch_ID"], dedup.INGRESS_ORDER)
    written = {}
    for target, df in ingress.to_targets(latest, table, mapping).items():
        path = layers.path("mdm", target)
        written[target] = writers.append_evolving(df, path, ("Batch_ID",), batch_ids)
    return written


def to_master(
    layers: Layers, target: str, source: str, batch_id: int, load_time: Column
) -> writers.Reconciled:
    """MDM -> MASTER: one gated batch, written and counted again."""
    ledger.assert_gate(ledger_state(layers), "egress", source, batch_id)
    rows = layers.read("mdm", target).where(F.col("Batch_ID") == batch_id)
    stamped = schema.stamp_egress(rows, source, batch_id, load_time)
    return writers.reconcile_write(stamped, layers.path("master", target), batch_id)


def for_each(tables: Iterable[str], stage: Callable[[str], object]) -> dict[str, object]:
    """Run a stage for every table; failures are kept per table and raised at the end."""
    results, failures = {}, {}
    for table in tables:
        try:
            results[table] = stage(table)
        except Exception as error:  # noqa: BLE001 - reported together
            failures[table] = error
    if failures:
        texts = "; ".join(f"{t}: {str(e).splitlines()[0]}" for t, e in failures.items())
        raise RuntimeError(f"{len(failures)} tables failed: {texts}") from next(
            iter(failures.values())
        )
    return results
