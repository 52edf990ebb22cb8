"""Reconciliation and profiling reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldrow.operators import audit, digest, marts
from goldrow.plans import catalog
from workload.base import ORGANIZATION_VIEWS, PERSON_VIEWS, Data, derive, query
from workload.marts import (
    ORGANIZATION_SQL,
    PERSON_SQL,
    hub_child,
    organization_views,
    person_views,
    views_sql,
)
from workload.quality import _CHAIN_SQL, address_chain

STAGED = PERSON_VIEWS + ORGANIZATION_VIEWS


def _counts(tables, prefix: str = "", extra: str = "") -> str:
    return " UNION ALL ".join(
        f"SELECT {extra}'{t.upper()}' AS table_name, count(*) AS row_count FROM {prefix}{t}"
        for t in tables
    )


def staged(data: Data) -> dict[str, DataFrame]:
    return {t.upper(): data[t] for t in STAGED}


@query(
    "agg_06_reject_rates",
    _CHAIN_SQL.rstrip()
    + """, counted AS (SELECT n, rule_name, count(*) FILTER (WHERE failed IS NULL OR failed > n)
        AS passed_count, count(*) FILTER (WHERE failed = n) AS rejected_count
      FROM chained CROSS JOIN (VALUES (1, 'city'), (2, 'iqvia_id'), (3, 'batch_id'))
        AS r(n, rule_name) GROUP BY ALL)
    SELECT rule_name, passed_count, rejected_count, round(100.0 * rejected_count
      / nullif(passed_count + rejected_count, 0), 2) AS reject_pct FROM counted""",
)
def agg_06(data: Data) -> DataFrame:
    return audit.reject_rates(
        address_chain(data)
        .rule_outcomes()
        .select(F.col("column_name").alias("rule_name"), "passed_count", "rejected_count")
    )


@query("agg_07_table_counts", f"WITH {derive(*STAGED)} {_counts(STAGED)}")
def agg_07(data: Data) -> DataFrame:
    return audit.table_counts(staged(data))


_LAYERED = ("hcp_name", "hcp_address", "hco_address")
_LAYERS_SQL = (
    f"WITH {views_sql(*_LAYERED)} "
    + _counts(_LAYERED, extra="'STAGING' AS layer, ")
    + " UNION ALL "
    + _counts(_LAYERED, prefix="stg_", extra="'MDM' AS layer, ")
)


def layers(data: Data) -> DataFrame:
    return audit.layer_counts(
        {
            "STAGING": {t.upper(): data[t] for t in _LAYERED},
            "MDM": {t.upper(): marts.staging_view(data[t], t) for t in _LAYERED},
        }
    )


@query("agg_07_layer_counts", _LAYERS_SQL)
def agg_07_layers(data: Data) -> DataFrame:
    return layers(data)


@query(
    "agg_08_entity_rollup",
    f"""WITH {derive(*STAGED)}, counts AS ({_counts(STAGED)}) SELECT left(table_name, 3)
      AS entity_group, CAST(sum(row_count) AS BIGINT) AS total_rows,
      CAST(sum(CASE WHEN row_count > 0 THEN 1 ELSE 0 END) AS BIGINT) AS tables_with_data,
      count(*) AS total_tables FROM counts GROUP BY 1""",
)
def agg_08(data: Data) -> DataFrame:
    return audit.entity_rollup(audit.table_counts(staged(data)))


_PROFILED = ("iqvia_id", "first_name", "middle_name", "response_json")


@query(
    "agg_09_null_profile",
    f"WITH {derive('hcp_name')} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) AS total_rows, count({c}) AS non_null, "
        f"count(*) - count({c}) AS nulls FROM hcp_name"
        for c in _PROFILED
    ),
)
def agg_09(data: Data) -> DataFrame:
    return audit.null_profile(data["hcp_name"], _PROFILED)


@query(
    "agg_10_extraction_completeness",
    f"WITH {views_sql('hcp_name', 'hcp_email')} "
    """SELECT 'stg_HCP_NAME' AS view_name, count(*) AS total_rows, count("firstName") AS field_1,
      count("middleName") AS field_2 FROM stg_hcp_name UNION ALL
    SELECT 'stg_HCP_EMAIL', count(*), count("ElectronicAddress"), count("SOURCE_FK")
      FROM stg_hcp_email""",
)
def agg_10(data: Data) -> DataFrame:
    view = lambda v: marts.staging_view(data[v], v)
    return audit.extraction_completeness(
        {
            "stg_HCP_NAME": (view("hcp_name"), {"firstName": "field_1", "middleName": "field_2"}),
            "stg_HCP_EMAIL": (
                view("hcp_email"),
                {"ElectronicAddress": "field_1", "SOURCE_FK": "field_2"},
            ),
        }
    )


_DOCUMENTED = ("hcp_name", "hcp_email", "hco_tax")


@query(
    "agg_11_json_validity",
    f"WITH {derive(*_DOCUMENTED)} "
    + " UNION ALL ".join(
        f"""SELECT '{t}' AS table_name, count(*) AS total_rows,
      count(*) FILTER (WHERE coalesce(json_valid(response_json), false)) AS valid_json_count,
      count(*) FILTER (WHERE NOT coalesce(json_valid(response_json), false))
        AS invalid_json_count FROM {t}"""
        for t in _DOCUMENTED
    ),
)
def agg_11(data: Data) -> DataFrame:
    return audit.json_validity({t: data[t] for t in _DOCUMENTED})


@query(
    "agg_12_by_batch",
    f"WITH {derive('hcp_address')} SELECT batch_id, count(*) AS record_count "
    "FROM hcp_address GROUP BY 1",
)
def agg_12_batch(data: Data) -> DataFrame:
    return audit.distribution(data["hcp_address"], "batch_id")


@query(
    "agg_12_by_source",
    f"WITH {derive('hcp_address')} SELECT source_name, count(*) AS record_count "
    "FROM hcp_address GROUP BY 1",
)
def agg_12_source(data: Data) -> DataFrame:
    return audit.distribution(data["hcp_address"], "source_name")


@query(
    "agg_12_by_load_day",
    "SELECT CAST(CAST(ts AS DATE) AS STRING) AS load_date, count(*) AS record_count "
    "FROM events GROUP BY 1",
)
def agg_12_day(data: Data) -> DataFrame:
    return audit.distribution(
        data["events"], F.to_date("ts").cast("string").alias("load_date")
    )


@query(
    "agg_13_duplicate_keys_top",
    f"""WITH {derive("hcp_address")} SELECT iqvia_id, count(*) AS duplicate_count
    FROM hcp_address GROUP BY 1 HAVING count(*) > 1 ORDER BY 2 DESC, 1 LIMIT 10""",
)
def agg_13(data: Data) -> DataFrame:
    return audit.duplicate_keys(data["hcp_address"], ["iqvia_id"])


@query(
    "agg_13_duplicate_keys_by_batch",
    """SELECT l_orderkey, l_suppkey, count(*) AS duplicate_count FROM lineitem
    GROUP BY 1, 2 HAVING count(*) > 1""",
)
def agg_13_batch(data: Data) -> DataFrame:
    return audit.duplicate_keys(data["lineitem"], ["l_orderkey", "l_suppkey"], top=None)


@query(
    "agg_14_excess_rows",
    f"""WITH {derive("hcp_alternate_name", "dirty_address")}
    SELECT 'hcp_alternate_name' AS table_name, count(*) AS total_rows,
      count(DISTINCT iqvia_id) AS distinct_keys, count(*) - count(DISTINCT iqvia_id)
      AS duplicate_count FROM hcp_alternate_name
    UNION ALL SELECT 'dirty_address', count(*), count(DISTINCT iqvia_id),
      count(*) - count(DISTINCT iqvia_id) FROM dirty_address""",
)
def agg_14(data: Data) -> DataFrame:
    tables = ("hcp_alternate_name", "dirty_address")
    return audit.excess_rows({t: (data[t], "iqvia_id") for t in tables})


@query(
    "agg_15_batch_sets",
    f"WITH {derive('hcp_phone', 'hcp_tendencies')} "
    + " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, string_agg(DISTINCT CAST(batch_id AS STRING), ',' "
        f"ORDER BY CAST(batch_id AS STRING)) AS batch_ids FROM {t}"
        for t in ("hcp_phone", "hcp_tendencies")
    ),
)
def agg_15(data: Data) -> DataFrame:
    sets = audit.batch_sets({t: data[t] for t in ("hcp_phone", "hcp_tendencies")})
    ids = F.concat_ws(",", F.col("batch_ids").cast("array<string>"))
    return sets.withColumn("batch_ids", ids)


@query(
    "agg_16_layer_difference",
    f"WITH {views_sql(*_LAYERED, 'hcp_license')} "
    + " UNION ALL ".join(
        f"SELECT '{t}' AS entity, (SELECT count(*) FROM {t}) AS source_rows, "
        f"(SELECT count(*) FROM stg_{t}) AS view_rows, "
        f"(SELECT count(*) FROM {t}) - (SELECT count(*) FROM stg_{t}) AS difference"
        for t in (*_LAYERED, "hcp_license")
    ),
)
def agg_16(data: Data) -> DataFrame:
    tables = (*_LAYERED, "hcp_license")
    source = audit.table_counts({t: data[t] for t in tables})
    views = audit.table_counts({t: marts.staging_view(data[t], t) for t in tables})
    return audit.layer_difference(source, views)


_ERROR = "'ERROR: marts has MORE rows than staging'"


@query(
    "agg_16_anchor_check",
    PERSON_SQL.rstrip()
    + ORGANIZATION_SQL.replace("WITH ", ", ", 1).rstrip()
    + f""", flows AS (SELECT 'name -> person' AS flow, (SELECT count(*) FROM stg_hcp_name)
        AS staging_rows, (SELECT count(*) FROM person) AS marts_rows UNION ALL
      SELECT 'address -> organization', (SELECT count(*) FROM stg_hco_address),
        (SELECT count(*) FROM organization))
    SELECT *, CASE WHEN marts_rows > staging_rows THEN {_ERROR} ELSE 'OK' END AS status
    FROM flows""",
)
def agg_16_anchor(data: Data) -> DataFrame:
    people, places = person_views(data), organization_views(data)
    return audit.anchor_check(
        {
            "name -> person": (people["hcp_name"], marts.person_rows(people)),
            "address -> organization": (
                places["hco_address"],
                marts.organization_rows(places),
            ),
        }
    )


@query(
    "agg_17_copy_verification",
    f"""WITH {derive("hcp_name", "hcp_address", "hcp_phone")}, v AS (SELECT 'HCP_NAME'
      AS table_name, (SELECT count(*) FROM hcp_name) AS source_rows,
      (SELECT count(*) FROM hcp_name) AS target_rows
    UNION ALL SELECT 'HCP_ADDRESS', (SELECT count(*) FROM hcp_address),
      (SELECT count(DISTINCT iqvia_id) FROM hcp_address)
    UNION ALL SELECT 'HCP_PHONE', NULL, (SELECT count(*) FROM hcp_phone)
    UNION ALL SELECT 'HCP_EMAIL', (SELECT count(*) FROM customer), NULL)
    SELECT *, CASE WHEN target_rows IS NULL THEN 'ERROR' WHEN source_rows IS NULL THEN 'SKIP'
      WHEN source_rows = target_rows THEN 'PASS' ELSE 'MISMATCH' END AS status FROM v""",
)
def agg_17(data: Data) -> DataFrame:
    source = audit.table_counts(
        {t.upper(): data[t] for t in ("hcp_name", "hcp_address", "hcp_email")}
    )
    distinct = data["hcp_address"].select("iqvia_id").distinct()
    target = audit.table_counts(
        {"HCP_NAME": data["hcp_name"], "HCP_ADDRESS": distinct, "HCP_PHONE": data["hcp_phone"]}
    )
    return audit.verify_copy(source, target)


def copied(data: Data) -> DataFrame:
    """Orders as a faulty copy: some rows changed, some doubled, some under another key."""
    doubled = "o_orderstatus = 'P' AND o_orderpriority = '1-URGENT'"
    swapped = "o_orderstatus = 'P' AND o_orderpriority = '5-LOW'"
    changed = "o_orderstatus = 'P' AND o_orderpriority = '3-MEDIUM'"
    orders = data["orders"].select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    return (
        orders.withColumn("copies", F.expr(f"explode(array_repeat(0, CASE WHEN {doubled} THEN 2 ELSE 1 END))"))
        .withColumn("o_orderkey", F.expr(f"CASE WHEN {swapped} THEN -o_orderkey ELSE o_orderkey END"))
        .withColumn("o_custkey", F.expr(f"CASE WHEN {changed} THEN NULL ELSE o_custkey END"))
        .select("o_orderpriority", "O_CUSTKEY", "o_orderstatus", "o_orderkey")
    )


_COPIED_SQL = """WITH source AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority
    FROM orders), target AS (SELECT
      CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN -o_orderkey ELSE o_orderkey END AS o_orderkey,
      CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '3-MEDIUM' THEN NULL ELSE o_custkey END AS o_custkey,
      o_orderstatus, o_orderpriority FROM orders
    UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority FROM orders
      WHERE o_orderstatus = 'P' AND o_orderpriority = '1-URGENT') """


@query(
    "agg_17_content_differences",
    _COPIED_SQL
    + """, gone AS (SELECT * FROM source EXCEPT ALL SELECT * FROM target),
      more AS (SELECT * FROM target EXCEPT ALL SELECT * FROM source),
      s AS (SELECT o_orderkey, count(*) AS n FROM source GROUP BY 1),
      t AS (SELECT o_orderkey, count(*) AS n FROM target GROUP BY 1)
    SELECT o_orderkey, CASE WHEN t.n IS NULL THEN 'missing' WHEN s.n IS NULL THEN 'added'
        WHEN o_orderkey NOT IN (SELECT o_orderkey FROM gone) THEN 'doubled' ELSE 'changed' END
        AS difference, coalesce(s.n, 0) AS source_rows, coalesce(t.n, 0) AS target_rows
    FROM (SELECT o_orderkey FROM gone UNION SELECT o_orderkey FROM more)
      LEFT JOIN s USING (o_orderkey) LEFT JOIN t USING (o_orderkey)""",
)
def agg_17_differences(data: Data) -> DataFrame:
    """Every row that a copy has lost, got, changed or doubled, found through digests."""
    source = data["orders"].select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    return digest.differences(source, copied(data), ["o_orderkey"])


@query(
    "agg_17_content_verification",
    _COPIED_SQL
    + """, v AS (SELECT 'ORDERS' AS table_name, (SELECT count(*) FROM source) AS source_rows,
        (SELECT count(*) FROM target) AS target_rows, 'MISMATCH' AS status
      UNION ALL SELECT 'SWAPPED', count(*), count(*), 'MISMATCH' FROM source
      UNION ALL SELECT 'CUSTOMER', count(*), count(*), 'PASS' FROM customer
      UNION ALL SELECT 'PART', NULL, count(*), 'SKIP' FROM part
      UNION ALL SELECT 'NATION', count(*), NULL, 'ERROR' FROM nation) SELECT * FROM v""",
)
def agg_17_content(data: Data) -> DataFrame:
    """A faulty copy, one with as many rows but unlike ones, and a true one in another order."""
    source = data["orders"].select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    swapped = source.withColumn(
        "o_custkey", F.when(F.col("o_orderstatus") == "P", -F.col("o_custkey")).otherwise(F.col("o_custkey"))
    )
    customer = data["customer"]
    return digest.verify_content(
        {
            "ORDERS": (source, copied(data)),
            "SWAPPED": (source, swapped),
            "CUSTOMER": (customer, customer.repartition(7, "c_nationkey")),
            "PART": (None, data["part"]),
            "NATION": (data["nation"], None),
        }
    )


_TESTED = list(catalog.STAGING_VIEWS)


@query(
    "agg_18_not_null_tests",
    f"WITH {views_sql(*_TESTED)}, {derive('dirty_address')}, t AS ("
    + " UNION ALL ".join(
        f"SELECT 'stg_{v}' AS table_name, count(*) FILTER (WHERE \"SOURCE_FK\" IS NULL) "
        f"AS failures FROM stg_{v}"
        for v in _TESTED
    )
    + """ UNION ALL SELECT 'dirty_address', count(*) FILTER (WHERE iqvia_id IS NULL)
      FROM dirty_address)
    SELECT *, CASE WHEN failures = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM t""",
)
def agg_18(data: Data) -> DataFrame:
    views = {f"stg_{v}": (marts.staging_view(data[v], v), "SOURCE_FK") for v in _TESTED}
    return audit.not_null_tests(views | {"dirty_address": (data["dirty_address"], "iqvia_id")})


#: A key that some rows of a table lack.
_SOME_LACK = "CASE WHEN {0} LIKE '%7' THEN NULL ELSE {0} END"


def _lacking(df: DataFrame, key: str = "SOURCE_FK") -> DataFrame:
    return df.withColumn(key, F.expr(_SOME_LACK.format(key)))


def mart_tables(data: Data) -> dict[str, DataFrame]:
    """The 23rd view and the 16 marts; anchors and some children lack keys."""
    people, places = person_views(data), organization_views(data)
    for views, anchor in ((people, catalog.PERSON_ANCHOR), (places, catalog.ORGANIZATION_ANCHOR)):
        views[anchor] = _lacking(views[anchor])
    person, place = marts.consolidate_person(people), marts.consolidate_organization(places)
    tables = {
        "stg_hcp_license": marts.staging_view(data["hcp_license"], "hcp_license"),
        "mdm_hcp": person,
        "master_hcp": marts.person_master(person),
        "mdm_hco": place,
        "master_hco": marts.organization_master(place),
    }
    for child in catalog.PERSON_CHILD_MASTERS:
        items = [i.replace('"', "`") for i in hub_child(child)]
        rows = data["lineitem"].selectExpr(*items)
        rows = _lacking(rows) if child == "hcp_specialty" else rows
        tables[f"master_{child}"] = marts.person_child_master(child, rows)
    for target, view in catalog.ORGANIZATION_INGRESS_VIEW.items():
        rows = marts.staging_view(data[view], view)
        rows = _lacking(rows) if target == "hco_name" else rows
        tables[f"mdm_{target}"] = marts.organization_ingress(target, rows)
        tables[f"master_{target}"] = marts.organization_child_master(
            target, tables[f"mdm_{target}"]
        )
    return tables


@query(
    "agg_18_not_null_marts",
    f"""WITH {derive("hcp_name", "hco_address", "hco_name")}, failing AS (
      SELECT t AS table_name, count(*) AS failures FROM hcp_name,
        (VALUES ('mdm_hcp'), ('master_hcp')) v(t) WHERE iqvia_id LIKE '%7' GROUP BY t
      UNION ALL SELECT t, count(*) FROM hco_address, (VALUES ('mdm_hco'), ('master_hco')) v(t)
        WHERE iqvia_id LIKE '%7' GROUP BY t
      UNION ALL SELECT t, count(*) FROM hco_name,
        (VALUES ('mdm_hco_name'), ('master_hco_name')) v(t) WHERE iqvia_id LIKE '%7' GROUP BY t
      UNION ALL SELECT 'master_hcp_specialty', count(*) FROM lineitem
        WHERE CAST(l_orderkey AS STRING) LIKE '%7'
      UNION ALL SELECT t, 0 FROM (VALUES ('stg_hcp_license'), ('master_hcp_alternate_name'),
        ('master_hcp_license'), ('master_hcp_therapeutic_area'), ('mdm_hco_phone'),
        ('master_hco_phone'), ('mdm_hco_specialty'), ('master_hco_specialty'),
        ('mdm_hco_alternate_identifier'), ('master_hco_alternate_identifier')) v(t))
    SELECT *, CASE WHEN failures = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM failing""",
)
def agg_18_marts(data: Data) -> DataFrame:
    return audit.not_null_tests({t: (df, "SOURCE_FK") for t, df in mart_tables(data).items()})


_CATALOGED = ("customer", "orders", "part", "documents")


def _column_sql(table: str) -> str:
    return f"""SELECT '{table}' AS table_name, count(*) AS column_count,
      count(*) FILTER (value > 0) AS filled_columns
    FROM (UNPIVOT (SELECT count(COLUMNS(*)) FROM {table}) ON COLUMNS(*))"""


@query(
    "agg_19_tables_with_column",
    " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{c}' AS column_name, count({c}) AS filled_rows FROM {t}"
        for t, c in (
            ("customer", "c_custkey"),
            ("customer", "c_nationkey"),
            ("orders", "o_orderkey"),
            ("orders", "o_custkey"),
            ("part", "p_partkey"),
        )
    ),
)
def agg_19(data: Data) -> DataFrame:
    columns = audit.column_catalog({t: data[t] for t in _CATALOGED})
    found = audit.tables_with_column(columns, "KEY")
    return found.select("table_name", "column_name", "filled_rows")


@query(
    "agg_19_column_counts",
    f"""WITH {views_sql("hco_specialty", "hcp_name")}, counted AS (
      {" UNION ALL ".join(_column_sql(t) for t in ("customer", "orders", "stg_hco_specialty", "stg_hcp_name"))})
    SELECT table_name, CAST(e AS BIGINT) AS expected_count, column_count, filled_columns,
      CASE WHEN column_count = e THEN 'PASS' ELSE 'MISMATCH' END AS status
    FROM (VALUES ('customer', 5), ('orders', 7), ('stg_hco_specialty', 5), ('stg_hcp_name', 10),
      ('gone', 1)) AS x(table_name, e) LEFT JOIN counted USING (table_name)""",
)
def agg_19_counts(data: Data) -> DataFrame:
    """Two tables, and two views of which some columns are null by definition."""
    views = {f"stg_{v}": marts.staging_view(data[v], v) for v in ("hco_specialty", "hcp_name")}
    columns = audit.column_catalog({t: data[t] for t in ("customer", "orders")} | views)
    expected = {"customer": 5, "orders": 7, "stg_hco_specialty": 5, "stg_hcp_name": 10, "gone": 1}
    return audit.column_counts(columns, expected)


@query(
    "agg_20_count_status",
    f"""SELECT *, CASE WHEN layer = 'STAGING' AND row_count = 0 AND table_name <> 'HCP_NAME'
      THEN 'WARNING: 0 rows in STAGING table' WHEN layer IN ('MASTER', 'MDM') AND row_count > 0
      THEN 'WARNING: unexpected data in placeholder table' ELSE 'OK' END AS status
    FROM ({_LAYERS_SQL})""",
)
def agg_20(data: Data) -> DataFrame:
    return audit.count_status(layers(data))


@query(
    "agg_20_layer_summary",
    f"""SELECT layer, count(*) AS table_count, CAST(sum(row_count) AS BIGINT) AS total_rows
    FROM ({_LAYERS_SQL}) GROUP BY layer""",
)
def agg_20_summary(data: Data) -> DataFrame:
    return audit.layer_summary(layers(data))


@query(
    "jon_14_missing_keys",
    f"""WITH {derive("hcp_name", "hcp_phone")} SELECT iqvia_id FROM hcp_name n WHERE NOT EXISTS
      (SELECT 1 FROM hcp_phone p WHERE p.iqvia_id = n.iqvia_id)""",
)
def jon_14(data: Data) -> DataFrame:
    return audit.missing_keys(data["hcp_name"], data["hcp_phone"], "iqvia_id").select("iqvia_id")


def _overlap(name: str, left: str, right: str) -> str:
    return f"""SELECT '{name}' AS comparison,
      (SELECT count(DISTINCT iqvia_id) FROM {left}) AS left_keys,
      (SELECT count(DISTINCT iqvia_id) FROM {right}) AS right_keys,
      (SELECT count(DISTINCT l.iqvia_id) FROM {left} l JOIN (SELECT DISTINCT iqvia_id
        FROM {right}) r ON l.iqvia_id = r.iqvia_id) AS shared_keys"""


@query(
    "jon_15_key_overlap",
    f"WITH {derive('hcp_name', 'dirty_address', 'hcp_phone')} "
    + _overlap("name vs address", "hcp_name", "dirty_address")
    + " UNION ALL "
    + _overlap("address vs phone", "dirty_address", "hcp_phone"),
)
def jon_15(data: Data) -> DataFrame:
    name, address, phone = (data[t] for t in ("hcp_name", "dirty_address", "hcp_phone"))
    return audit.key_overlap(
        {
            "name vs address": (name, address, "iqvia_id"),
            "address vs phone": (address, phone, "iqvia_id"),
        }
    )


@query(
    "jon_17_side_by_side",
    f"""WITH {views_sql("hcp_email")} SELECT r.iqvia_id, left(r.response_json, 500)
      AS raw_json_preview, v."ElectronicAddress" FROM hcp_email r LEFT JOIN stg_hcp_email v
      ON r.iqvia_id = v."SOURCE_FK" """,
)
def jon_17(data: Data) -> DataFrame:
    raw = data["hcp_email"]
    return audit.side_by_side(raw, marts.staging_view(raw, "hcp_email"))


@query(
    "set_02_tagged_union",
    """SELECT 'customer' AS table_name, count(*) AS row_count FROM customer
    UNION ALL SELECT 'orders', count(*) FROM orders
    UNION ALL SELECT 'lineitem', count(*) FROM lineitem""",
)
def set_02(data: Data) -> DataFrame:
    return audit.table_counts({t: data[t] for t in ("customer", "orders", "lineitem")})


@query(
    "srt_03_emptiness",
    f"WITH {views_sql('hcp_license', 'hcp_name')} "
    + " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, (SELECT count(*) FROM {t}) = 0 AS is_empty"
        for t in ("lineitem", "stg_hcp_license", "stg_hcp_name")
    ),
)
def srt_03(data: Data) -> DataFrame:
    views = {f"stg_{v}": marts.staging_view(data[v], v) for v in ("hcp_license", "hcp_name")}
    return audit.emptiness({"lineitem": data["lineitem"]} | views)
