"""Data-quality gate: splits, rule chain, outcome log, reject trail, sweep."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldrow.operators import dedup, quality, standardize
from goldrow.plans.catalog import DQ_RULES, rules_for
from goldrow.plans.specs import DQRule
from workload.base import Data, derive, query
from workload.scalars import _RULED_COLUMNS, PERSON_RULES



def now():
    return F.lit("2024-01-31").cast("timestamp")


RUN = datetime(2024, 1, 31)


def halves(pair: tuple[DataFrame, DataFrame], *columns: str) -> DataFrame:
    """Both halves of a split in one frame."""
    passed, rejected = pair
    tag = lambda df, name: df.select(*columns, F.lit(name).alias("half"))
    return tag(passed, "passed").unionByName(tag(rejected, "rejected"))


@query(
    "jon_01_null_check",
    f"""WITH {derive("dirty_address")} SELECT order_id, CASE WHEN city IS NOT NULL
      AND trim(city) <> '' THEN 'passed' ELSE 'rejected' END AS half FROM dirty_address""",
)
def jon_01(data: Data) -> DataFrame:
    return halves(quality.split(data["dirty_address"], "null_check", "CITY"), "order_id")


@query(
    "jon_02_completeness_check",
    f"""WITH {derive("hcp_name", "dirty_address")} SELECT iqvia_id, CASE WHEN iqvia_id IN (
      SELECT iqvia_id FROM dirty_address WHERE trim(iqvia_id) <> '') THEN 'passed'
      ELSE 'rejected' END AS half FROM hcp_name""",
)
def jon_02(data: Data) -> DataFrame:
    pair = quality.split(
        data["hcp_name"], "name_address_completeness_check", "iqvia_id", data["dirty_address"]
    )
    return halves(pair, "iqvia_id")


_ADDRESS_HALVES = f"""WITH {derive("hcp_name", "dirty_address")} SELECT order_id,
  CASE WHEN trim(iqvia_id) <> '' AND iqvia_id IN (SELECT iqvia_id FROM hcp_name) THEN 'passed'
  ELSE 'rejected' END AS half FROM dirty_address"""


@query("jon_03_address_check", _ADDRESS_HALVES)
def jon_03(data: Data) -> DataFrame:
    # The parent key goes by a preferred name in another place and spelling.
    parent = data["hcp_name"].selectExpr("first_name", "iqvia_id AS source_fk")
    pair = quality.split(data["dirty_address"], "address_mdr_check", "iqvia_id", parent)
    return halves(pair, "order_id")


@query(
    "jon_04_parent_check",
    """SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_suppkey IN (SELECT s_suppkey
      FROM supplier WHERE s_acctbal >= 0) THEN 'passed' ELSE 'rejected' END AS half
    FROM lineitem""",
)
def jon_04(data: Data) -> DataFrame:
    """Suppliers in debt count as unknown parents."""
    parent = data["supplier"].selectExpr(
        "CASE WHEN s_acctbal >= 0 THEN s_suppkey END AS individualId"
    )
    pair = quality.split(data["lineitem"], "mdr_check", "l_suppkey", parent)
    return halves(pair, "l_orderkey", "l_linenumber", "l_partkey")


@query("jon_05_affiliation_check", _ADDRESS_HALVES)
def jon_05(data: Data) -> DataFrame:
    pair = quality.split(
        data["dirty_address"], "affiliation_mdr_check", "iqvia_id", data["hcp_name"]
    )
    return halves(pair, "order_id")


@query(
    "jon_06_hierarchy_check",
    """SELECT c_custkey, CASE WHEN c_custkey IN (SELECT p_partkey FROM part WHERE p_size < 25)
      THEN 'passed' ELSE 'rejected' END AS half FROM customer""",
)
def jon_06(data: Data) -> DataFrame:
    parent = data["part"].selectExpr("CASE WHEN p_size < 25 THEN p_partkey END AS Source_ID")
    pair = quality.split(data["customer"], "hierarchy_mdr_check", "c_custkey", parent)
    return halves(pair, "c_custkey")


ADDRESS_CHAIN = (
    DQRule("hcp_address", "null_check", "no city", "city", "hcp_address"),
    DQRule("hcp_address", "address_mdr_check", "unknown person", "iqvia_id", "hcp_address"),
    DQRule("hcp_address", "null_check", "no batch", "batch_id", "hcp_address"),
)
_CHAIN_SQL = f"""WITH {derive("hcp_name", "dirty_address")}, chained AS (SELECT *,
  CASE WHEN city IS NULL OR trim(city) = '' THEN 1
       WHEN iqvia_id IS NULL OR trim(iqvia_id) = ''
         OR iqvia_id NOT IN (SELECT iqvia_id FROM hcp_name) THEN 2
       WHEN batch_id IS NULL THEN 3 END AS failed FROM dirty_address) """


def address_chain(data: Data) -> quality.DQResult:
    return quality.run_chain(
        data["dirty_address"], ADDRESS_CHAIN, data["hcp_name"], processed_at=now()
    )


@query(
    "jon_07_rule_chain_rejects",
    _CHAIN_SQL
    + """SELECT order_id, iqvia_id, city, batch_id,
      CASE failed WHEN 2 THEN 'address_mdr_check' ELSE 'null_check' END AS "DQ_RULE",
      'REJECT' AS "DQ_STATUS", CASE failed WHEN 1 THEN 'no city' WHEN 2 THEN 'unknown person'
        ELSE 'no batch' END AS "DQ_DESCRIPTION", CASE failed WHEN 1 THEN 'city'
        WHEN 2 THEN 'iqvia_id' ELSE 'batch_id' END AS "DQ_APPL_COLUMN",
      '2024-01-31 00:00:00' AS "DQ_PROCESSED_AT" FROM chained WHERE failed IS NOT NULL""",
)
def jon_07_rejects(data: Data) -> DataFrame:
    return address_chain(data).rejected.withColumn(
        "DQ_PROCESSED_AT", F.col("DQ_PROCESSED_AT").cast("string")
    )


@query(
    "jon_07_rule_chain_passed",
    _CHAIN_SQL
    + """SELECT order_id, iqvia_id, city, batch_id, 'null_check' AS "DQ_RULE",
      'PASS' AS "DQ_STATUS" FROM chained WHERE failed IS NULL""",
)
def jon_07_passed(data: Data) -> DataFrame:
    passed = address_chain(data).passed
    return passed.drop("DQ_DESCRIPTION", "DQ_APPL_COLUMN", "DQ_PROCESSED_AT")


@query(
    "jon_08_configured_rules",
    f"""WITH {derive("dirty_address")} SELECT order_id, CASE WHEN trim(city) = '' THEN 'city'
      ELSE 'iqvia_id' END AS failed_on FROM dirty_address
    WHERE trim(city) = '' OR iqvia_id IS NULL OR trim(iqvia_id) = ''""",
)
def jon_08(data: Data) -> DataFrame:
    """Rules come from a rule table, where two of four rows are in force."""
    config = data.spark.createDataFrame(
        [
            ("addr", "CRM_A", "hcp_address", c, n, "null_check", None, d, s, a, o)
            for c, n, d, s, a, o in (
                ("iqvia_id", "key", None, " active ", True, 2),
                ("city", "city", "no city", "ACTIVE", True, 1),
                ("batch_id", "off", "off", "ACTIVE", False, 0),
                ("order_id", "old", "old", "INACTIVE", True, 3),
            )
        ],
        "source_identifier string, source_system_name string, table_name string, "
        "column_name string, rule_name string, rule_type string, rule_expression string, "
        "rule_description string, rule_status string, active_flag boolean, execution_order int",
    )
    rules = quality.resolve_rules("hcp_address", config, "ADDR", "crm_a")
    result = quality.run_chain(data["dirty_address"], rules, processed_at=now())
    return result.rejected.select("order_id", F.col("DQ_APPL_COLUMN").alias("failed_on"))


def _sweep_sql() -> str:
    """Oracle of the sweep, written per table from the catalogue's rules."""
    parts = []
    tables = {r.table: None for r in DQ_RULES}
    for table in tables:
        conditions = []
        for rule in rules_for(table):
            column = rule.column
            family = table[:3]
            if rule.rule == "null_check":
                conditions.append(f"({column} IS NOT NULL AND trim({column}) <> '')")
            else:
                other = "address" if rule.rule.startswith("name_address") else "name"
                conditions.append(f"{column} IN (SELECT iqvia_id FROM {family}_{other})")
        good = " AND ".join(conditions)
        parts.append(
            f"SELECT '{table}' AS table_name, CAST(sum(CASE WHEN {good} THEN 1 ELSE 0 END) "
            f"AS BIGINT) AS passed_count, CAST(sum(CASE WHEN {good} THEN 0 ELSE 1 END) AS BIGINT) "
            f"AS rejected_count FROM {table}"
        )
    return f"WITH {derive(*tables)} " + " UNION ALL ".join(parts)


@query("jon_09_sweep", _sweep_sql())
def jon_09(data: Data) -> DataFrame:
    return quality.sweep_summary({r.table: data[r.table] for r in DQ_RULES})


def _sweep_rows_sql() -> str:
    """Rejected rows by table and rule; written out, not from the catalogue."""
    unknown = {
        "hcp": ("address", "affiliation", "alternate_name", "education", "email", "identification",
                "language", "origin_university", "phone", "specialty", "tax", "tendencies"),
        "hco": ("address", "alternate_name", "email", "identification", "phone", "specialty", "tax",
                "hierarchy"),
    }
    spelled = {"affiliation": "hcp_hco_affiliation", "hierarchy": "hco_hco_hierarchy"}
    rules = {"address": "address_mdr_check", "affiliation": "affiliation_mdr_check",
             "hierarchy": "hierarchy_mdr_check"}
    parts = [
        f"SELECT '{spelled.get(t, f'{family}_{t}')}' AS table_name, '{rules.get(t, 'mdr_check')}' AS rule, "
        f"iqvia_id FROM {spelled.get(t, f'{family}_{t}')} WHERE iqvia_id IS NULL "
        f"OR iqvia_id NOT IN (SELECT iqvia_id FROM {family}_name)"
        for family, tables in unknown.items()
        for t in tables
    ]
    for family, name in (("hcp", "first_name"), ("hco", "organization_name")):
        no_name = f"trim(coalesce({name}, '')) = ''"
        parts.append(
            f"SELECT '{family}_name', CASE WHEN {no_name} THEN 'null_check' ELSE "
            f"'name_address_completeness_check' END, iqvia_id FROM {family}_name WHERE {no_name} "
            f"OR iqvia_id NOT IN (SELECT iqvia_id FROM {family}_address)"
        )
    names = [spelled.get(t, f"{f}_{t}") for f, ts in unknown.items() for t in ts]
    tables = [*names, "hcp_name", "hco_name"]
    return f"WITH {derive(*tables)} " + " UNION ALL ".join(parts)


@query("jon_09_sweep_rejects", _sweep_rows_sql())
def jon_09_rejects(data: Data) -> DataFrame:
    """Every rejected row of the sweep, through the stored membership index."""
    results, _ = quality.sweep({r.table: data[r.table] for r in DQ_RULES}, processed_at=now())
    out = None
    for table, result in results.items():
        rows = result.rejected.select(
            F.lit(table).alias("table_name"), F.col("DQ_RULE").alias("rule"), "iqvia_id"
        )
        out = rows if out is None else out.unionByName(rows)
    return out


@query(
    "jon_10_reject_trail",
    _CHAIN_SQL
    + """SELECT 'run-1' AS run_id, CAST(20240131 AS BIGINT) AS batch_id,
      'CRM_A' AS source_system_name, 'hcp_address' AS table_name, iqvia_id AS record_key,
      CASE failed WHEN 2 THEN 'address_mdr_check' ELSE 'null_check' END AS rule_name,
      CASE failed WHEN 1 THEN 'no city' WHEN 2 THEN 'unknown person' ELSE 'no batch' END
        AS error_description, '2024-01-31 00:00:00' AS rejected_at
    FROM chained WHERE failed IS NOT NULL""",
)
def jon_10(data: Data) -> DataFrame:
    trail = quality.reject_trail(
        address_chain(data),
        run_id="run-1",
        batch_id=20240131,
        source_system="CRM_A",
        table="hcp_address",
        rejected_at=now(),
    )
    return trail.withColumn("rejected_at", F.col("rejected_at").cast("string"))


_LOG_SQL = """, rules(n, rule_name, description) AS (VALUES (1, 'null_check', 'no city'),
    (2, 'address_mdr_check', 'unknown person'), (3, 'null_check', 'no batch')),
  counted AS (SELECT n, rule_name, description, (SELECT count(*) FROM chained WHERE failed = n)
    AS record_count FROM rules)
  SELECT rule_name, CAST(record_count AS BIGINT) AS record_count,
    CASE WHEN record_count = 0 THEN 'PASS' ELSE 'FAIL' END AS rule_status,
    CASE WHEN record_count > 0 THEN description END AS error_description"""


@query("agg_04_outcome_log", _CHAIN_SQL.rstrip() + _LOG_SQL + " FROM counted")
def agg_04(data: Data) -> DataFrame:
    log = address_log(data)
    return log.select("rule_name", "record_count", "rule_status", "error_description")


def address_log(data: Data) -> DataFrame:
    return quality.outcome_log(
        address_chain(data),
        run_id="run-1",
        batch_id=None,
        source_identifier="addr",
        source_system="CRM_A",
        table="hcp_address",
        started=now(),
        ended=now() + F.expr("INTERVAL 5 SECONDS"),
    )


@query(
    "agg_05_totals",
    _CHAIN_SQL
    + """SELECT count(*) FILTER (WHERE failed IS NULL) AS passed_count,
      count(failed) AS rejected_count FROM chained""",
)
def agg_05(data: Data) -> DataFrame:
    return address_chain(data).totals()


@query(
    "log_02_rule_log",
    _CHAIN_SQL.rstrip()
    + _LOG_SQL
    + """, 'run-1' AS run_id, NULL AS batch_id, 'addr' AS source_identifier,
      'CRM_A' AS source_system_name, 'hcp_address' AS table_name,
      '2024-01-31 00:00:00' AS start_time, '2024-01-31 00:00:05' AS end_time FROM counted""",
)
def log_02(data: Data) -> DataFrame:
    text = lambda c: F.col(c).cast("string")
    return address_log(data).withColumns({c: text(c) for c in ("start_time", "end_time")})


@query(
    "prj_21_batch_selection",
    f"""WITH {derive("hcp_address")} SELECT iqvia_id, batch_id, response_json FROM hcp_address
    WHERE batch_id = (SELECT max(batch_id) FROM hcp_address)""",
)
def prj_21(data: Data) -> DataFrame:
    chosen = quality.choose_batch(data["hcp_address"])
    return chosen.select("iqvia_id", "batch_id", "response_json")


def flagship(data: Data) -> quality.DQResult:
    """Standardize the raw feed, keep the newest row per person, run the quality gate."""
    raw = data["hcp_name"].withColumn("LOAD_DATE", F.col("batch_id"))
    landed = standardize.standardize(raw, PERSON_RULES)
    latest = dedup.latest_per_key(landed, "iqvia_id")
    return quality.run_chain(
        latest, rules_for("hcp_name"), data["dirty_address"], processed_at=now()
    )


@query(
    "flagship_outcome_log",
    f"""WITH {derive("hcp_name", "dirty_address")}, landed AS (SELECT {_RULED_COLUMNS}, batch_id
      FROM hcp_name), latest AS (SELECT * FROM (SELECT *, row_number() OVER (
        PARTITION BY iqvia_id ORDER BY batch_id DESC) AS rn FROM landed) WHERE rn = 1),
    chained AS (SELECT *, CASE WHEN first_name IS NULL OR trim(first_name) = '' THEN 1
      WHEN iqvia_id NOT IN (SELECT iqvia_id FROM dirty_address WHERE trim(iqvia_id) <> '') THEN 2
      END AS failed FROM latest)
    SELECT 1 AS execution_order, 'null_check' AS rule_name, count(*) AS record_count
      FROM chained WHERE failed = 1
    UNION ALL SELECT 2, 'name_address_completeness_check', count(*) FROM chained WHERE failed = 2""",
)
def flagship_outcome_log(data: Data) -> DataFrame:
    return flagship(data).rule_counts().select("execution_order", "rule_name", "record_count")
