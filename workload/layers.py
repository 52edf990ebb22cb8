"""Versions of layer tables, and batches taken through all layers."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldrow.operators import audit, history, ledger
from goldrow.plans import stages
from goldrow.plans.specs import FieldMap
from goldrow.session import scratch_path
from goldrow.sinks import versions, writers
from workload.base import Data, derive, query
from workload.quality import now
from workload.sinks import _BATCH, customers

_HELD = f"SELECT c_custkey, c_mktsegment, {_BATCH} AS batch_id"


@query(
    "snk_02_readers_and_versions",
    f"""WITH first AS ({_HELD} FROM customer), second AS (
      SELECT c_custkey, CASE WHEN c_nationkey < 5 THEN 'again' ELSE c_mktsegment END
        AS c_mktsegment, {_BATCH} AS batch_id FROM customer WHERE c_nationkey <> 7)
    SELECT 'opened before' AS reader, * FROM first UNION ALL SELECT 'version 1', * FROM first
    UNION ALL SELECT 'opened after', * FROM second
    UNION ALL SELECT 'version 3', * FROM second WHERE batch_id <> 20240110""",
)
def snk_02_readers(data: Data) -> DataFrame:
    """A reader that was opened before a replacement keeps its rows, as does one that names
    a version."""
    path = scratch_path(data.spark, "versions")
    rows = customers(data)
    writers.replace_batches(rows, path)
    before = writers.read_layer(data.spark, path)
    again = rows.where("batch_id < 20240106").withColumn("c_mktsegment", F.lit("again"))
    writers.replace_batches(again, path, emptied=[(20240108,)])
    after = writers.read_layer(data.spark, path)
    writers.replace_batches(rows.where("false"), path, emptied=[(20240110,)])
    named = {f"version {n}": writers.read_layer(data.spark, path, version=n) for n in (1, 3)}
    readers = {"opened before": before, "opened after": after} | named
    out = None
    for name, held in readers.items():
        tagged = held.withColumn("reader", F.lit(name))
        out = tagged if out is None else out.unionByName(tagged)
    return out


@query(
    "snk_07_wider_types",
    """SELECT p_partkey AS key, CAST(p_size AS BIGINT) + 3000000000 * (p_partkey % 2) AS size,
      CAST(2 - p_partkey % 2 AS BIGINT) AS batch_id FROM part WHERE p_size > 20""",
)
def snk_07_wider(data: Data) -> DataFrame:
    """A column was int in the first batches and is long now; both are read as long."""
    path = scratch_path(data.spark, "wider")
    part = data["part"].selectExpr(
        "p_partkey AS key", "CAST(p_size AS INT) AS size", "CAST(2 - p_partkey % 2 AS BIGINT) AS batch_id"
    )
    writers.append_evolving(part.where("batch_id = 2"), path)
    long = part.where("batch_id = 1").withColumn("size", F.col("size") + F.lit(3_000_000_000))
    writers.append_evolving(long, path)
    table = writers.read_layer(data.spark, path)
    return table.where("size > 20 AND size % 3000000000 > 20")


_MAPPED = ("iqvia_id", "first_name", "country_code", "response_json", "source_name")
LAYERS = ("raw", "landing", "canonical", "mdm")


def _entity(table: str) -> stages.Entity:
    columns = [c for c in _MAPPED if table == "hcp_name" or c != "first_name"]
    mapping = [FieldMap(f"n.{c}", c) for c in columns]
    return stages.Entity(table, "CRM", date_column="updated", mapping=mapping)


def _take(layers: stages.Layers, table: str, source: DataFrame, batch: int) -> None:
    """One batch of a table from its source to the hub."""
    rows = source.drop("batch_id").withColumn("updated", F.lit(f"2024-01-0{batch} 12:00:00"))
    window = (datetime(2024, 1, batch), datetime(2024, 1, batch + 1))
    entity = _entity(table)
    stages.ingest(layers, entity, rows, [batch], window, now())
    stages.land(layers, entity, [batch])
    stages.canonicalize(layers, entity, [batch], now())
    if table == "hcp_name":
        stages.gate(layers, table, run_id=f"{batch}", source_system="CRM", at=now(), batch_id=batch)
        stages.to_hub(layers, table, [batch])


def _held(layers: stages.Layers, moment: str) -> list[DataFrame]:
    """Rows per batch of every layer, as it is at the moment of the call."""
    found = []
    for layer in LAYERS:
        table = layers.read(layer, "hcp" if layer == "mdm" else "hcp_name")
        counts = table.groupBy(F.col("Batch_ID").cast("long").alias("batch_id")).count()
        found.append(
            counts.select(F.lit(moment).alias("moment"), F.lit(layer).alias("layer"), "batch_id", "count")
        )
    return found


@query(
    "snk_02_emptied_batch_leaves_all_layers",
    f"""WITH {derive("hcp_name", "hcp_address")}, n AS (
      SELECT *, CASE WHEN batch_id < 20240113 THEN 1 ELSE 2 END AS batch FROM hcp_name
    ), passed AS (
      SELECT * FROM n WHERE trim(coalesce(first_name, '')) <> ''
        AND iqvia_id IN (SELECT iqvia_id FROM hcp_address)
    ), all_rows AS (
      SELECT layer, batch FROM n, (VALUES ('raw'), ('landing'), ('canonical')) l(layer)
      UNION ALL SELECT 'mdm', batch FROM passed
    )
    SELECT moment, layer, CAST(batch AS BIGINT) AS batch_id, count(*) AS count
    FROM all_rows, (VALUES ('loaded'), ('emptied')) m(moment)
    WHERE moment = 'loaded' OR batch = 1 GROUP BY ALL""",
)
def snk_02_emptied(data: Data) -> DataFrame:
    """The second batch is loaded again without rows, and every layer drops it."""
    layers = stages.Layers(data.spark, scratch_path(data.spark, "layers"))
    names = data["hcp_name"]
    _take(layers, "hcp_address", data["hcp_address"], 1)
    _take(layers, "hcp_name", names.where("batch_id < 20240113"), 1)
    second = names.where("batch_id >= 20240113")
    _take(layers, "hcp_name", second, 2)
    found = _held(layers, "loaded")
    _take(layers, "hcp_name", second.where("false"), 2)
    out = None
    for counts in [*found, *_held(layers, "emptied")]:
        out = counts if out is None else out.unionByName(counts)
    return out


@query(
    "prj_03_skipped_batches",
    """SELECT o_orderkey, o_orderstatus, CAST(year(o_orderdate) AS BIGINT) AS batch_id FROM orders
    WHERE o_orderdate >= TIMESTAMP '1995-03-01' AND o_orderdate <= TIMESTAMP '1996-02-15'""",
)
def prj_03_skipped(data: Data) -> DataFrame:
    """A window over a table whose batches keep the ranges of its date: two are read."""
    return dated_orders(data).drop("o_orderdate")


def dated_orders(data: Data) -> DataFrame:
    path = scratch_path(data.spark, "dated")
    orders = data["orders"].select(
        "o_orderkey", "o_orderstatus", "o_orderdate", F.year("o_orderdate").cast("long").alias("batch_id")
    )
    writers.replace_batches(orders, path, watch=["o_orderdate"])
    window = {"o_orderdate": ("1995-03-01 00:00:00", "1996-02-15 00:00:00")}
    return writers.read_layer(data.spark, path, within=window)


@query(
    "agg_07_maintained_counts",
    f"""WITH held AS (SELECT {_BATCH} AS batch_id, CASE WHEN c_nationkey = 3 THEN 2 ELSE 1 END AS times
      FROM customer WHERE c_nationkey <> 7)
    SELECT 'CUSTOMER' AS table_name, NULL AS batch_id, CAST(sum(times) AS BIGINT) AS row_count FROM held
    UNION ALL SELECT 'EMPTY', NULL, 0
    UNION ALL SELECT 'CUSTOMER', CAST(batch_id AS STRING), CAST(sum(times) AS BIGINT) FROM held GROUP BY 2""",
)
def agg_07_maintained(data: Data) -> DataFrame:
    """Counts after a replacement, an emptied batch and one loaded again, from the versions."""
    path, empty = scratch_path(data.spark, "counted"), scratch_path(data.spark, "counted")
    rows = customers(data)
    writers.replace_batches(rows, path)
    third = rows.where("batch_id = 20240104")
    writers.replace_batches(third.unionAll(third), path)
    writers.replace_batches(rows.where("false"), path, emptied=[(20240108,), (20240110,)])
    writers.replace_batches(rows.where("batch_id = 20240110"), path)
    writers.replace_batches(rows, empty)
    writers.replace_table(rows.where("false"), empty)
    batches = {t: versions.batch_rows(data.spark, p) for t, p in (("CUSTOMER", path), ("EMPTY", empty))}
    totals = audit.stored_counts(batches).withColumn("batch_id", F.lit(None).cast("string"))
    own = batches["CUSTOMER"].withColumn("table_name", F.lit("CUSTOMER"))
    return totals.unionByName(own.select(*totals.columns))


@query(
    "prj_24_compacted_ledger",
    f"""WITH {derive("ledger")} SELECT moment, batch_id, source_system_name, raw_ingestion_status,
      CASE WHEN raw_ingestion_status = 'Y' AND stdz_status IS NULL THEN 'Y' ELSE stdz_status END AS stdz_status
    FROM ledger, (VALUES ('before'), ('after')) m(moment)""",
)
def prj_24_compacted(data: Data) -> DataFrame:
    """The state of the recorded ledger before and after its events are compacted."""
    layers = stages.Layers(data.spark, scratch_path(data.spark, "ledger"))
    wide = data["ledger"]
    stages.record(layers, ledger.events_of(wide))
    waiting = wide.where(ledger.gate("stdz") & F.col("stdz_status").isNull())
    stages.record(layers, ledger.transition(waiting, "stdz", "Y", event_seq=1, event_time=now()))
    before = stages.ledger_state(layers)
    stages.compact_ledger(layers)
    states = {"before": before, "after": stages.ledger_state(layers)}
    columns = ("batch_id", "source_system_name", "raw_ingestion_status", "stdz_status")
    tagged = [df.select(F.lit(m).alias("moment"), *columns) for m, df in states.items()]
    return tagged[0].unionByName(tagged[1])


@query(
    "set_03_distinct_against_history",
    """SELECT 1 AS load, o_orderkey, o_orderstatus, o_orderpriority FROM orders WHERE o_orderstatus = 'F'
    UNION ALL SELECT 2, o_orderkey, o_orderstatus, o_orderpriority FROM orders WHERE o_orderstatus = 'O'
    UNION ALL SELECT 4, o_orderkey, o_orderstatus, o_orderpriority FROM orders
      WHERE o_orderstatus = 'F' AND o_orderpriority <> '5-LOW'
    UNION ALL SELECT 4, o_orderkey, o_orderstatus, o_orderpriority FROM orders WHERE o_orderstatus = 'P'""",
)
def set_03_history(data: Data) -> DataFrame:
    """The second file holds the first again, the third nothing new; then the first is
    replaced by a part of itself, and the fourth has all rows."""
    path = scratch_path(data.spark, "history")
    orders = data["orders"].select("o_orderkey", "o_orderstatus", "o_orderpriority")
    first = orders.where("o_orderstatus = 'F'")
    second = orders.where("o_orderstatus <> 'P'")
    found = [history.unseen(first.unionAll(first), path, 1), history.unseen(second, path, 2)]
    found.append(history.unseen(second.where("o_orderpriority = '5-LOW'"), path, 3))
    history.unseen(first.where("o_orderpriority = '5-LOW'"), path, 1)
    history.unseen(second.where("o_orderstatus = 'O'"), path, 2)
    found.append(history.unseen(orders, path, 4))
    out = None
    for load, rows in enumerate(found, 1):
        tagged = rows.withColumn("load", F.lit(load))
        out = tagged if out is None else out.unionByName(tagged)
    return out
