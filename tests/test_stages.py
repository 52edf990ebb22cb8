"""The stages end to end on two batches, and the feed stream."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from goldrow.operators import ledger
from goldrow.plans import stages
from goldrow.plans.specs import FieldMap, StandardizeRule
from goldrow.session import scratch_path
from goldrow.sinks import versions, writers
from goldrow.streaming.feed import FEED_SCHEMA, stream_feed
from tests.conftest import SMALL
from workload import Data

AT = datetime(2024, 1, 31)
SOURCE = "CRM"


def now():
    return F.lit("2024-01-31").cast("timestamp")


def entity(table):
    columns = ("iqvia_id", "first_name", "country_code", "response_json", "source_name")
    return stages.Entity(
        table,
        SOURCE,
        date_column="updated",
        rules=[StandardizeRule("null_if_blank", "first_name")] if table == "hcp_name" else (),
        mapping=[FieldMap(f"n.{c}", c) for c in columns if table == "hcp_name" or c != "first_name"],
    )


@pytest.fixture(scope="module")
def layers(spark):
    """Two batches of names and addresses taken through all stages."""
    data = Data(spark, SMALL)
    out = stages.Layers(spark, scratch_path(spark, "layers"))
    opened = spark.createDataFrame(
        [(b, SOURCE, datetime(2024, 1, b), None) for b in (1, 2)],
        "batch_id long, source_system_name string, batch_start_time timestamp, "
        "batch_end_time timestamp",
    )
    stages.record(
        out, ledger.transition(opened, "raw_ingestion", "N", event_seq=0, event_time=now())
    )
    for seq, batch in enumerate((1, 2), 1):
        day = f"2024-01-0{batch} 12:00:00"
        for table in ("hcp_name", "hcp_address"):
            source = data[table].drop("batch_id").withColumn("updated", F.lit(day))
            stages.ingest(
                out,
                entity(table),
                source.unionAll(source),
                [batch],
                (datetime(2024, 1, batch), datetime(2024, 1, batch + 1)),
                now(),
            )
            stages.land(out, entity(table), [batch])
            stages.canonicalize(out, entity(table), [batch], now())
        stages.for_each(
            ("hcp_name", "hcp_address"),
            lambda t, b=batch: stages.gate(
                out, t, run_id=f"run-{b}", source_system=SOURCE, at=now(), batch_id=b
            ),
        )
        for table in ("hcp_name", "hcp_address"):
            stages.to_hub(out, table, [batch])
        for stage in ("raw_ingestion", "stdz", "canonical", "dq", "ingress"):
            stages.mark_done(out, stage, SOURCE, [batch], AT, seq)
    return out


def test_raw_drops_copies_and_keeps_batches(spark, layers):
    raw = layers.read("raw", "hcp_name")
    people = Data(spark, SMALL)["hcp_name"].count()
    assert {r["BATCH_ID"]: r["count"] for r in raw.groupBy("BATCH_ID").count().collect()} == {
        1: people,
        2: people,
    }


def test_second_batch_keeps_document_fields(layers):
    """A mapping must not lose its document fields after its first use."""
    hub = layers.read("mdm", "hcp")
    filled = hub.where(F.col("X_hcp_status").isNotNull()).groupBy("Batch_ID").count().collect()
    assert len(filled) == 2 and filled[0]["count"] == filled[1]["count"] > 0


def test_gate_log_and_trail_agree(layers):
    log = layers.spark.read.parquet(layers.path("control", "dq_log"))
    trail = layers.spark.read.parquet(layers.path("control", "dq_rejects"))
    logged = log.agg(F.sum("record_count")).first()[0]
    assert logged == trail.count() > 0
    failed = log.where("rule_status = 'FAIL'").select("error_description").collect()
    assert failed and all(r[0] for r in failed)


def test_egress_is_gated_and_reconciled(layers):
    assert stages.pending(layers, "egress", SOURCE) == [1, 2]
    done = stages.to_master(layers, "hcp", SOURCE, 1, now())
    assert done.source_records == done.written_records > 0
    again = stages.to_master(layers, "hcp", SOURCE, 1, now())
    assert again == done
    stages.mark_done(layers, "egress", SOURCE, [1], AT, 9)
    assert stages.pending(layers, "egress", SOURCE) == [2]
    with pytest.raises(RuntimeError, match="already egress complete"):
        stages.to_master(layers, "hcp", SOURCE, 1, now())
    with pytest.raises(RuntimeError, match="no ledger record"):
        stages.to_master(layers, "hcp", SOURCE, 7, now())


def test_rerun_changes_nothing(spark, layers):
    before = layers.read("landing", "hcp_name").count()
    stages.land(layers, entity("hcp_name"), [2])
    assert layers.read("landing", "hcp_name").count() == before


@pytest.fixture
def opened(spark):
    out = stages.Layers(spark, scratch_path(spark, "claims"))
    batches = spark.createDataFrame(
        [(b, SOURCE, datetime(2024, 1, b), None) for b in (1, 2, 3)],
        "batch_id long, source_system_name string, batch_start_time timestamp, "
        "batch_end_time timestamp",
    )
    stages.record(out, ledger.transition(batches, "raw_ingestion", "Y", event_seq=0, event_time=now()))
    return out


def test_a_batch_is_taken_by_one_runner(opened):
    until = stages.claim(opened, "stdz", SOURCE, [1, 2], "a", AT)
    assert until == AT + timedelta(hours=1)
    with pytest.raises(versions.ConflictError, match=r"\[2\] of CRM are taken"):
        stages.claim(opened, "stdz", SOURCE, [2, 3], "b", AT)
    stages.claim(opened, "stdz", SOURCE, [3], "b", AT)
    stages.claim(opened, "stdz", SOURCE, [1, 2], "a", AT)
    with pytest.raises(RuntimeError, match=r"\[1\] of CRM may not enter canonical"):
        stages.claim(opened, "canonical", SOURCE, [1], "a", AT)
    # The lease of a runner that is gone ends.
    stages.claim(opened, "stdz", SOURCE, [2, 3], "c", AT + timedelta(hours=2))


def test_two_runners_at_once(opened, monkeypatch):
    """Both see the batch free; the one that commits second is refused."""
    plain, order = versions.write, []

    def late(df, path, partitions, **options):
        if path.endswith("claims") and not order:
            order.append("other")
            stages.claim(opened, "stdz", SOURCE, [1], "b", AT)
        return plain(df, path, partitions, **options)

    monkeypatch.setattr(versions, "write", late)
    with pytest.raises(versions.ConflictError):
        stages.claim(opened, "stdz", SOURCE, [1], "a", AT)
    with pytest.raises(versions.ConflictError, match="are taken"):
        stages.claim(opened, "stdz", SOURCE, [1], "a", AT)


def test_compaction_keeps_the_state(opened):
    for seq, status in enumerate(("N", "Y", "N"), 1):
        stages.mark_done(opened, "stdz", SOURCE, [1, 2], AT, seq)
        reset = ledger.reset_latest(
            stages.ledger_state(opened), SOURCE, ["stdz"], event_seq=seq + 1, event_time=now()
        )
        if status == "N":
            stages.record(opened, reset)
    state = lambda: sorted(map(tuple, stages.ledger_state(opened).collect()), key=repr)
    before, events = state(), stages.ledger_events(opened).count()
    kept = stages.compact_ledger(opened)
    assert state() == before and kept < events
    assert stages.pending(opened, "stdz", SOURCE) == [3]


def test_failures_are_collected():
    def stage(table):
        if table != "good":
            raise ValueError(f"bad {table}")
        return 1

    with pytest.raises(RuntimeError, match="2 tables failed: a: bad a; b: bad b"):
        stages.for_each(("a", "good", "b"), stage)


def test_feed_stream_takes_each_drop_once(spark):
    data = Data(spark, SMALL)
    folder, target = scratch_path(spark, "drops"), scratch_path(spark, "stream-raw")
    documents = data["hcp_name"].selectExpr(
        "iqvia_id AS entity_id", "'HCP' AS entity_type", "country_code", "response_json"
    )
    valid = documents.where("try_parse_json(response_json) IS NOT NULL").count()
    assert documents.schema.simpleString().count(":") == len(FEED_SCHEMA.split(","))
    for expected in (valid, 2 * valid, 2 * valid):
        if expected != 2 * valid or writers.read_layer(spark, target).count() < expected:
            documents.write.mode("append").json(folder)
        stream_feed(spark, folder, target, "HCP", AT, "test-feed").awaitTermination()
        assert writers.read_layer(spark, target).count() == expected
