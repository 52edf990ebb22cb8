"""Plans keep the shape that makes them scale."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from goldrow.operators import dedup, quality
from goldrow.plans.catalog import DQ_RULES
from goldrow.plans.specs import DQRule
from goldrow.session import scratch_path
from goldrow.sinks import writers
from tests.conftest import SMALL
from workload import REGISTRY, Data
from workload.base import DERIVED


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_no_cross_join_and_no_python_rows(spark, name):
    plan = physical(REGISTRY[name].run(Data(spark, SMALL)))
    assert "CartesianProduct" not in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    assert not re.search(r"BroadcastNestedLoopJoin", plan)


def test_latest_row_is_reduced_before_the_shuffle(spark):
    plan = physical(dedup.latest_per_key(Data(spark, SMALL)["events"], "user_id"))
    assert plan.count("WindowGroupLimit") == 2
    assert plan.rindex("Partial") > plan.index("Exchange")


def test_batch_choice_prunes_partitions(spark):
    path = scratch_path(spark, "pruned")
    writers.replace_batches(Data(spark, SMALL)["hcp_address"], path)
    table = writers.read_layer(spark, path)
    chosen = quality.choose_batch(table)
    plan = physical(chosen)
    assert re.search(r"PartitionFilters: \[[^\]]*batch_id", plan)
    assert chosen.count() == table.where(F.col("batch_id") == 20240125).count() > 0


def test_filters_and_columns_reach_the_scan(spark):
    plan = physical(REGISTRY["prj_02_configured_filter"].run(Data(spark, SMALL)))
    assert "PushedFilters: [Or(EqualTo(o_orderstatus,F),StringStartsWith(o_orderpriority,1))]" in plan
    assert "o_totalprice" not in plan


def test_documents_are_parsed_once(spark):
    for name in ("doc_05_secondary_records", "doc_06_primary_records", "doc_07_post_addresses"):
        plan = physical(REGISTRY[name].run(Data(spark, SMALL)))
        assert plan.count("from_json(") == 1, name


def test_search_records_are_stored_once_parsed(spark):
    for name in ("jon_18_drop_known", "sbc_06_conditional_fallback"):
        plan = physical(REGISTRY[name].run(Data(spark, SMALL)))
        # What is left are the identifiers of the primary records.
        assert plan.count("from_json(") <= 2, name


def test_rule_chain_joins_its_reference_once(spark):
    data = Data(spark, SMALL)
    from workload.quality import ADDRESS_CHAIN

    rules = [ADDRESS_CHAIN[1], ADDRESS_CHAIN[0], ADDRESS_CHAIN[1]]
    plan = physical(quality.run_chain(data["dirty_address"], rules, data["hcp_name"]).flagged)
    # Other joins only bring the small table of heavy keys to the rows.
    assert len(re.findall(r"Join \[_dq_key#\d+, _salt#", plan)) == 1


def scans(plan: str) -> dict[str, int]:
    """Scans per file, in all stages and subqueries of a plan."""
    names = re.findall(r"FileScan parquet .*?/(\w+)\.parquet\]", plan)
    return {n: names.count(n) for n in names}


def test_sweep_reads_each_table_once(spark):
    data = Data(spark, SMALL)
    tables = {r.table: data[r.table] for r in DQ_RULES}
    plan = physical(quality.sweep_summary(tables))
    derived_from = [DERIVED[t][0] for t in tables]
    assert scans(plan) == {n: derived_from.count(n) for n in derived_from}
    assert "Join" not in plan
    assert plan.count("hashpartitioning(_key#") == 2


def test_sweep_results_read_each_table_twice(spark):
    """Once for the stored index, once for the rows themselves."""
    data = Data(spark, SMALL)
    tables = {r.table: data[r.table] for r in DQ_RULES}
    results, skipped = quality.sweep(tables)
    assert len(results) == 22 and not skipped
    for table, result in results.items():
        plan = physical(result.flagged)
        assert sum(scans(plan).values()) == 1, table


def test_lookup_scans(spark):
    """Rows, their keys' counts and total; the reference for heavy keys and for the others."""
    data = Data(spark, SMALL)
    rules = [DQRule("", "mdr_check", "", "iqvia_id", "")]
    plan = physical(quality.run_chain(data["dirty_address"], rules, data["hcp_name"]).flagged)
    found = scans(plan)
    assert found["orders"] <= 4 and found["customer"] <= 2
