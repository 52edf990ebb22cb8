"""Scalar and text functions, incremental windows, latest row per key, canonical mapping."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldrow.functions import (
    full_name,
    hashed_key,
    non_blank,
    parse_timestamp,
    parsed,
    preview,
    variant_text,
)
from goldrow.functions.text import STANDARDIZERS
from goldrow.operators import canonical, dedup, incremental, ingress, schema, standardize
from goldrow.plans.specs import FieldMap, JoinSpec, StandardizeRule
from workload.base import Data, derive, query

# The given texts are never blank or padded, so both are added by language.
DIRTY = (
    "CASE lang WHEN 'de' THEN NULL WHEN 'fr' THEN '   ' WHEN 'es' THEN '  ' || text || '  ' "
    "ELSE text || '(+31) 20-555 01.23 é' END"
)


def dirty(data: Data) -> DataFrame:
    return data["documents"].selectExpr("doc_id", "lang", "source", f"{DIRTY} AS value")


DIRTY_SQL = f"WITH d AS (SELECT doc_id, lang, source, {DIRTY} AS value FROM documents) "

_WORDS = (
    "array_to_string(list_transform(string_split(trim(value), ' '), "
    "lambda w: replace(upper(substr(replace(w, 'ß', '~'), 1, 1)), '~', 'Ss') "
    "|| lower(substr(w, 2))), ' ')"
)

# Function name -> (query number, oracle expression). The oracle engine writes an upper
# case sharp s as one letter, so it is replaced first.
_STANDARD = {
    "trim": ("01", "trim(value)"),
    "upper": ("02", "upper(replace(trim(value), 'ß', 'SS'))"),
    "lower": ("03", "lower(trim(value))"),
    "proper": ("04", _WORDS),
    "null_if_blank": ("05", "CASE WHEN trim(value) = '' THEN NULL ELSE value END"),
    "remove_special_chars": ("06", "regexp_replace(value, '[^A-Za-z0-9 ]', '', 'g')"),
    "normalize_phone": ("07", "regexp_replace(value, '[^0-9]', '', 'g')"),
    "normalize_postal_code": ("08", "upper(replace(trim(value), 'ß', 'SS'))"),
    "normalize_code": ("09", "upper(trim(source))"),
}


def _register_standard(name: str, number: str, expression: str) -> None:
    column = "source" if name == "normalize_code" else "value"

    @query(f"scl_{number}_{name}", f"{DIRTY_SQL} SELECT doc_id, {expression} AS result FROM d")
    def _(data: Data) -> DataFrame:
        return dirty(data).select(
            "doc_id", STANDARDIZERS[name](F.col(column)).alias("result")
        )


for _name, (_number, _expression) in _STANDARD.items():
    _register_standard(_name, _number, _expression)


@query(
    "scl_10_full_name",
    f"""WITH {derive("hcp_name")}
    SELECT iqvia_id, trim(regexp_replace(coalesce(first_name, '') || ' ' ||
      coalesce(middle_name, '') || ' ' || coalesce(last_name, ''), '[ \\t\\r\\n]+', ' ', 'g'))
      AS full_name FROM hcp_name""",
)
def scl_10(data: Data) -> DataFrame:
    name = full_name(F.col("first_name"), F.col("middle_name"), F.col("last_name"))
    return data["hcp_name"].select("iqvia_id", name.alias("full_name"))


@query(
    "scl_11_hashed_key",
    f"""WITH {derive("dirty_address")}
    SELECT order_id, upper(md5(coalesce(iqvia_id, ''))) AS key FROM dirty_address""",
)
def scl_11(data: Data) -> DataFrame:
    return data["dirty_address"].select("order_id", hashed_key(F.col("iqvia_id")).alias("key"))


# Order dates written in four layouts, and one that none of them fits.
_DAY = (
    "substr(CAST(o_orderdate AS STRING), 9, 2)",
    "substr(CAST(o_orderdate AS STRING), 6, 2)",
    "substr(CAST(o_orderdate AS STRING), 1, 4)",
)
DATE_TEXT = f"""CASE o_orderpriority
  WHEN '1-URGENT' THEN {_DAY[2]} || '-' || {_DAY[1]} || '-' || {_DAY[0]} || ' 10:20:30'
  WHEN '2-HIGH' THEN {_DAY[2]} || '-' || {_DAY[1]} || '-' || {_DAY[0]} || 'T10:20:30.250+02:00'
  WHEN '3-MEDIUM' THEN {_DAY[1]} || '/' || {_DAY[0]} || '/' || {_DAY[2]} || ' 10:20:30.123456'
  WHEN '4-NOT SPECIFIED' THEN {_DAY[1]} || '/' || {_DAY[0]} || '/' || {_DAY[2]} || ' 10:20:30'
  ELSE {_DAY[0]} || '.' || {_DAY[1]} || '.' || {_DAY[2]} END"""

_PARSED_SQL = """coalesce(try_strptime(t, '%Y-%m-%d %H:%M:%S'),
  CASE WHEN t LIKE '%T%' THEN try_strptime(substr(t, 1, 23), '%Y-%m-%dT%H:%M:%S.%g')
    - INTERVAL 2 HOURS END,
  try_strptime(t, '%m/%d/%Y %H:%M:%S.%f'), try_strptime(t, '%m/%d/%Y %H:%M:%S'))"""
DATED_SQL = f"""WITH dated AS (SELECT o_orderkey, o_custkey, o_orderstatus, {DATE_TEXT} AS t
  FROM orders), stamped AS (SELECT *, {_PARSED_SQL} AS ts FROM dated) """


def dated(data: Data) -> DataFrame:
    return data["orders"].selectExpr(
        "o_orderkey", "o_custkey", "o_orderstatus", f"{DATE_TEXT} AS t"
    )


@query(
    "scl_12_parse_timestamp",
    DATED_SQL + "SELECT o_orderkey, t, CAST(epoch_us(ts) AS BIGINT) AS micros FROM stamped",
)
def scl_12(data: Data) -> DataFrame:
    ts = parse_timestamp(F.col("t"))
    return dated(data).select("o_orderkey", "t", F.unix_micros(ts).alias("micros"))


@query(
    "scl_13_try_casts",
    """SELECT c_custkey, TRY_CAST(c_mktsegment AS INTEGER) AS as_int,
      TRY_CAST(CASE c_mktsegment WHEN 'BUILDING' THEN '17' ELSE c_name END AS INTEGER) AS mixed,
      CAST(TRY_CAST(CASE c_mktsegment WHEN 'BUILDING' THEN '2024-02-30'
        WHEN 'FURNITURE' THEN '2024-02-29' ELSE c_name END AS DATE) AS STRING) AS day
    FROM customer""",
)
def scl_13(data: Data) -> DataFrame:
    rows = data["customer"].selectExpr(
        "c_custkey",
        "c_mktsegment AS HCO_Type",
        "CASE c_mktsegment WHEN 'BUILDING' THEN '17' ELSE c_name END AS Bed_Count",
        "CASE c_mktsegment WHEN 'BUILDING' THEN '2024-02-30' WHEN 'FURNITURE' THEN '2024-02-29' "
        "ELSE c_name END AS Activation_Date",
    )
    cast = lambda c, t: F.col(c).try_cast(t)
    return rows.select(
        "c_custkey",
        cast("HCO_Type", "int").alias("as_int"),
        cast("Bed_Count", "int").alias("mixed"),
        cast("Activation_Date", "date").cast("string").alias("day"),
    )


@query(
    "scl_14_json_path",
    f"""WITH {derive("hcp_phone", "hcp_email")}, docs AS (
      SELECT 'phone' AS tbl, iqvia_id, response_json AS j FROM hcp_phone UNION ALL
      SELECT 'email', iqvia_id, CASE WHEN json_valid(response_json) THEN response_json END
      FROM hcp_email)
    SELECT tbl, iqvia_id, json_extract_string(j, '$.Phone[0].Kind') AS object_text,
      json_extract_string(j, '$.Phone[0].Kind.a[1]') AS scalar_text,
      json_extract_string(j, '$.Email[0]') AS email, json_extract_string(j, '$.none[3].x') AS none
    FROM docs""",
)
def scl_14(data: Data) -> DataFrame:
    docs = [
        data[t].select(F.lit(label).alias("tbl"), "iqvia_id", "response_json")
        for t, label in (("hcp_phone", "phone"), ("hcp_email", "email"))
    ]
    paths = ["Phone[0].Kind", "Phone[0].Kind.a[1]", "Email[0]", "none[3].x"]
    out = ingress.extract_paths(schema.union_filled(docs), paths).drop("response_json")
    return out.toDF("tbl", "iqvia_id", "object_text", "scalar_text", "email", "none")


@query(
    "scl_15_variant_path",
    f"""WITH {derive("hcp_name")}, n AS (SELECT iqvia_id,
      CASE WHEN json_valid(response_json) THEN response_json END AS j FROM hcp_name)
    SELECT iqvia_id, json_extract_string(j, '$."First Name"') AS first_name,
      json_extract_string(j, '$."Middle Name"') AS middle_name,
      json_extract_string(j, '$."HCP Status".Name') AS status,
      json_extract_string(j, '$.Type') AS type_object FROM n""",
)
def scl_15(data: Data) -> DataFrame:
    doc = F.col("doc")
    return (
        data["hcp_name"]
        .select("iqvia_id", parsed(F.col("response_json")).alias("doc"))
        .select(
            "iqvia_id",
            variant_text(doc, "First Name").alias("first_name"),
            variant_text(doc, "Middle Name").alias("middle_name"),
            variant_text(doc, "HCP Status", "Name").alias("status"),
            variant_text(doc, "Type").alias("type_object"),
        )
    )


@query(
    "scl_16_misc_scalars",
    """SELECT o_orderkey, left(o_orderpriority, 3) AS preview,
      CAST(CAST(o_orderdate AS DATE) AS STRING) AS day, nullif(o_orderstatus, 'F') AS status,
      coalesce(nullif(o_orderstatus, 'F'), 'done') AS filled,
      CASE WHEN o_orderdate < TIMESTAMP '1998-01-01 00:00:00' - INTERVAL 6 HOURS
        THEN 'old' ELSE 'new' END AS age FROM orders""",
)
def scl_16(data: Data) -> DataFrame:
    status = F.nullif(F.col("o_orderstatus"), F.lit("F"))
    limit = F.expr("TIMESTAMP '1998-01-01 00:00:00' - INTERVAL 6 HOURS")
    return data["orders"].select(
        "o_orderkey",
        preview(F.col("o_orderpriority"), 3).alias("preview"),
        F.to_date("o_orderdate").cast("string").alias("day"),
        status.alias("status"),
        F.coalesce(status, F.lit("done")).alias("filled"),
        F.when(F.col("o_orderdate") < limit, "old").otherwise("new").alias("age"),
    )


@query(
    "scl_17_person_name",
    f"""WITH {derive("hcp_name")}
    SELECT upper(md5(iqvia_id)) AS "Name_PK", first_name AS "firstName",
      middle_name AS "middleName", last_name AS "lastName",
      trim(regexp_replace(coalesce(first_name, '') || ' ' || coalesce(middle_name, '') || ' ' ||
        coalesce(last_name, ''), '[ \\t\\r\\n]+', ' ', 'g')) AS "Full_Name",
      gender AS "genderCode", country_code AS "Country", iqvia_id AS "individualEid",
      source_name AS "Source_Name", NULL AS "LOAD_DATE", batch_id AS "BATCH_ID" FROM hcp_name""",
)
def scl_17(data: Data) -> DataFrame:
    landing = data["hcp_name"].selectExpr(
        "country_code AS countryCode",
        "first_name AS firstName",
        "gender AS genderCode",
        "iqvia_id AS individualEid",
        "last_name AS lastName",
        "middle_name AS middleName",
        "'not a date' AS LOAD_DATE",
        "CAST(batch_id AS STRING) AS BATCH_ID",
        "source_name AS Source_Name",
    )
    return standardize.person_name(landing)


PERSON_RULES = (
    StandardizeRule("null_if_blank", "first_name"),
    StandardizeRule("trim", "FIRST_NAME"),
    StandardizeRule("rename_columns", "first_name"),
    StandardizeRule("proper", "last_name"),
    StandardizeRule("normalize_code", "country_code"),
    StandardizeRule("normalize_phone", "full_name"),
)
_RULED_COLUMNS = """iqvia_id, trim(CASE WHEN trim(first_name) = '' THEN NULL ELSE first_name END)
  AS first_name, array_to_string(list_transform(string_split(trim(last_name), ' '),
    lambda w: upper(substr(w, 1, 1)) || lower(substr(w, 2))), ' ') AS last_name,
  upper(trim(country_code)) AS country_code,
  regexp_replace(full_name, '[^0-9]', '', 'g') AS full_name"""


@query(
    "scl_18_rule_interpreter", f"WITH {derive('hcp_name')} SELECT {_RULED_COLUMNS} FROM hcp_name"
)
def scl_18(data: Data) -> DataFrame:
    rows = data["hcp_name"].select(
        "iqvia_id", "first_name", "last_name", "country_code", "full_name"
    )
    return standardize.standardize(rows, PERSON_RULES)


# ------------------------------------------------------------------ projections, filters


@query(
    "prj_01_active_records",
    "SELECT o_custkey, max(o_orderkey) AS last_order FROM orders GROUP BY o_custkey",
)
def prj_01(data: Data) -> DataFrame:
    sql = "SELECT o_custkey, max(o_orderkey) AS last_order FROM raw_table_vw GROUP BY o_custkey"
    return incremental.active_records(data["orders"], sql)


_START, _END, _MARK = datetime(1996, 1, 1), datetime(1997, 6, 30, 12), datetime(2000, 1, 1)


@query(
    "prj_02_configured_filter",
    """SELECT o_orderkey, o_orderpriority FROM orders
    WHERE o_orderstatus = 'F' OR o_orderpriority LIKE '1%'""",
)
def prj_02(data: Data) -> DataFrame:
    rows = incremental.incremental_window(
        data["orders"],
        full_load=False,
        load_type="overwrite",
        date_column="o_orderdate",
        start=_START,
        end=_END,
        condition="o_orderstatus = 'F' OR o_orderpriority LIKE '1%'",
    )
    return rows.select("o_orderkey", "o_orderpriority")


@query(
    "prj_03_incremental_window",
    DATED_SQL
    + """SELECT o_orderkey, t FROM stamped WHERE (ts > TIMESTAMP '1996-01-01 00:00:00'
      AND ts <= TIMESTAMP '1997-06-30 12:00:00') OR ts > TIMESTAMP '2000-01-01 00:00:00'""",
)
def prj_03(data: Data) -> DataFrame:
    rows = incremental.incremental_window(
        dated(data),
        full_load=False,
        load_type="delta",
        date_column="T",
        start=_START,
        end=_END,
        high_water=_MARK,
    )
    return rows.select("o_orderkey", "t")


@query("prj_03_full_load", DATED_SQL + "SELECT o_orderkey, t FROM stamped")
def prj_03_full(data: Data) -> DataFrame:
    rows = incremental.incremental_window(
        dated(data),
        full_load=True,
        load_type="delta",
        date_column="t",
        start=_START,
        end=_END,
        condition="o_orderstatus = 'F'",
    )
    return rows.select("o_orderkey", "t")


@query(
    "prj_04_high_water_mark",
    "SELECT CAST(epoch_us(max(o_orderdate)) AS BIGINT) AS micros FROM orders",
)
def prj_04(data: Data) -> DataFrame:
    mark = incremental.high_water_mark(data["orders"], "o_orderdate")
    return mark.select(F.unix_micros(F.col("high_water").cast("timestamp")).alias("micros"))


@query(
    "prj_05_changed_keys",
    """SELECT CAST(o_custkey AS STRING) AS delta_id FROM orders
      WHERE o_orderdate > TIMESTAMP '1996-03-01' AND o_orderdate <= TIMESTAMP '1996-03-31'
    UNION SELECT CAST(l_orderkey AS STRING) FROM lineitem
      WHERE l_shipdate > TIMESTAMP '1996-03-01' AND l_shipdate <= TIMESTAMP '1996-03-31'""",
)
def prj_05(data: Data) -> DataFrame:
    tables = {
        "orders": (data["orders"], "o_custkey", "o_orderdate"),
        "lineitem": (data["lineitem"], "l_orderkey", "l_shipdate"),
        "absent": (data["nation"], "no_key", "no_ts"),
    }
    return incremental.changed_keys(tables, "1996-03-01", "1996-03-31")


@query(
    "prj_06_underscore_names",
    """SELECT p_partkey AS "Part_Key", p_name AS "Part_Full_Name" FROM part""",
)
def prj_06(data: Data) -> DataFrame:
    spaced = data["part"].selectExpr("p_partkey AS `Part Key`", "p_name AS `Part Full Name`")
    return schema.underscore_names(spaced)


@query("prj_07_keep_order", "SELECT p_brand, p_partkey, p_name FROM part")
def prj_07(data: Data) -> DataFrame:
    return schema.keep_order(data["part"], ["p_brand", "gone", "p_partkey", "p_name"])


CANONICAL_MAP = (
    FieldMap("n.o_custkey", "customer_key"),
    FieldMap("upper(n.o_orderstatus)", "status"),
    FieldMap("CAST(n.o_orderkey AS BIGINT)", "order_key"),
    FieldMap(None, "comment"),
    FieldMap("n.o_orderdate", "load_date"),
    FieldMap("n.o_orderpriority", ""),
    FieldMap("c.c_mktsegment", "segment", "LEFT JOIN customer c ON n.o_custkey = c.c_custkey"),
    FieldMap("na.n_name", "nation", "LEFT JOIN nation na ON c.c_nationkey = na.n_nationkey"),
)


@query(
    "prj_08_canonical_projection",
    """SELECT CAST(o_custkey AS STRING) AS customer_key, upper(o_orderstatus) AS status,
      o_orderkey AS order_key, CAST(NULL AS STRING) AS comment FROM orders""",
)
def prj_08(data: Data) -> DataFrame:
    return data["orders"].alias("n").selectExpr(*canonical.projection(CANONICAL_MAP[:6]))


@query(
    "prj_08_configured_mapping",
    """SELECT DISTINCT CAST(o_custkey AS STRING) AS customer_key, upper(o_orderstatus) AS status,
      CAST(NULL AS STRING) AS comment, CAST(o_custkey AS BIGINT) AS "Batch_ID",
      '2024-01-31' AS "Load_Date" FROM orders""",
)
def prj_08_configured(data: Data) -> DataFrame:
    """The mapping comes from rows of the control table, which also holds another system's."""
    config = data.spark.createDataFrame(
        [
            (" ERP ", system, "Orders", "canonical_orders", source, target, None)
            for system, source, target in (
                ("Sales", "n.o_custkey", "customer_key"),
                ("sales ", "upper(n.o_orderstatus)", "status"),
                ("sales", None, "comment"),
                ("other", "n.o_totalprice", "price"),
            )
        ],
        "source_identifier string, source_system_name string, src_tbl_nm string, "
        "tgt_tbl_nm string, src_attribute string, tgt_attribute string, join_condition string",
    )
    mapping = canonical.mapping_rows(config, "erp", "SALES", "orders", "canonical_orders")
    delta = data["orders"].withColumn("Batch_ID", F.col("o_custkey"))
    return canonical.to_canonical(delta, mapping, load_time=F.lit("2024-01-31"))


@query(
    "prj_09_canonical_distinct",
    """SELECT DISTINCT o_orderstatus AS status, CAST(o_custkey AS STRING) AS customer_key,
      CAST(o_custkey AS BIGINT) AS "Batch_ID", '2024-01-31' AS "Load_Date" FROM orders""",
)
def prj_09(data: Data) -> DataFrame:
    delta = data["orders"].withColumn("Batch_ID", F.col("o_custkey"))
    mapping = [FieldMap("n.o_orderstatus", "status"), FieldMap("n.o_custkey", "customer_key")]
    return canonical.to_canonical(delta, mapping, load_time=F.lit("2024-01-31"))


@query(
    "jon_13_configured_join",
    """SELECT DISTINCT CAST(o_custkey AS STRING) AS customer_key, upper(o_orderstatus) AS status,
      o_orderkey AS order_key, CAST(NULL AS STRING) AS comment, c_mktsegment AS segment,
      n_name AS nation, CAST(o_custkey AS BIGINT) AS "Batch_ID", '2024-01-31' AS "Load_Date"
    FROM orders LEFT JOIN customer ON o_custkey = c_custkey
      LEFT JOIN nation ON c_nationkey = n_nationkey""",
)
def jon_13(data: Data) -> DataFrame:
    joins = [
        JoinSpec(data["customer"], "c", "n.o_custkey = c.c_custkey"),
        JoinSpec(data["nation"], "na", "c.c_nationkey = na.n_nationkey"),
    ]
    delta = data["orders"].withColumn("Batch_ID", F.col("o_custkey"))
    return canonical.to_canonical(delta, CANONICAL_MAP, joins, load_time=F.lit("2024-01-31"))


@query(
    "set_01_union_filled",
    """SELECT c_custkey AS key, c_name AS name, c_mktsegment AS segment, NULL AS brand
      FROM customer UNION ALL SELECT p_partkey, p_name, NULL, p_brand FROM part""",
)
def set_01(data: Data) -> DataFrame:
    people = data["customer"].selectExpr("c_custkey AS key", "c_name AS name", "c_mktsegment AS segment")
    parts = data["part"].selectExpr("p_brand AS brand", "p_partkey AS key", "p_name AS name")
    return schema.union_filled([people, parts])


@query("set_03_distinct_rows", "SELECT DISTINCT l_orderkey, l_returnflag, l_linestatus FROM lineitem")
def set_03(data: Data) -> DataFrame:
    return data["lineitem"].select("l_orderkey", "l_returnflag", "l_linestatus").distinct()


@query(
    "prj_20_raw_stamp",
    """SELECT s_suppkey, '2024-01-31' AS "LOAD_DATE", CAST(7 AS BIGINT) AS "BATCH_ID",
      'ERP' AS "Source_Name" FROM supplier""",
)
def prj_20(data: Data) -> DataFrame:
    return schema.stamp_raw(data["supplier"].select("s_suppkey"), [3, 7, 5], "ERP", F.lit("2024-01-31"))


@query(
    "prj_19_egress_stamp",
    f"""WITH {derive("hcp_phone")} SELECT iqvia_id, batch_id, 'HUB' AS "SOURCE_SYSTEM_NAME",
      '2024-01-31' AS "EGRESS_LOAD_DATE" FROM hcp_phone""",
)
def prj_19(data: Data) -> DataFrame:
    rows = data["hcp_phone"].select("iqvia_id", "batch_id")
    return schema.stamp_egress(rows, "HUB", 9, F.lit("2024-01-31"))


@query(
    "prj_26_non_blank",
    f"""WITH {derive("dirty_address")} SELECT order_id,
      iqvia_id IS NOT NULL AND trim(iqvia_id) <> '' AS filled FROM dirty_address""",
)
def prj_26(data: Data) -> DataFrame:
    return data["dirty_address"].select("order_id", non_blank(F.col("iqvia_id")).alias("filled"))


# ------------------------------------------------------------------ latest row per key


@query(
    "win_01_latest_per_key",
    """SELECT event_id, user_id, event_type, CAST(epoch_us(ts) AS BIGINT) AS micros FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
      FROM events) WHERE rn = 1""",
)
def win_01(data: Data) -> DataFrame:
    rows = data["events"].withColumnRenamed("ts", "LOAD_DATE")
    latest = dedup.latest_per_key(rows, "user_id", tiebreak=[F.desc("event_id")])
    micros = F.unix_micros(F.col("LOAD_DATE").cast("timestamp"))
    return latest.select("event_id", "user_id", "event_type", micros.alias("micros"))


@query(
    "win_01_without_order",
    """SELECT l_orderkey, l_suppkey, l_partkey, l_linenumber FROM (SELECT *, row_number() OVER (
      PARTITION BY l_orderkey, l_suppkey ORDER BY l_partkey DESC, l_linenumber DESC) AS rn
      FROM lineitem) WHERE rn = 1""",
)
def win_01_keys(data: Data) -> DataFrame:
    rows = data["lineitem"].select("l_orderkey", "l_suppkey", "l_partkey", "l_linenumber")
    return dedup.latest_per_key(rows, "l_orderkey, l_suppkey gone")


@query(
    "win_02_latest_canonical",
    """SELECT l_orderkey, l_returnflag, batch_id, l_linenumber FROM (SELECT l_orderkey,
      l_returnflag, l_partkey AS batch_id, l_linenumber, row_number() OVER (
      PARTITION BY l_orderkey, l_returnflag ORDER BY l_partkey DESC, l_linenumber DESC) AS rn
      FROM lineitem) WHERE rn = 1""",
)
def win_02(data: Data) -> DataFrame:
    rows = data["lineitem"].selectExpr(
        "l_orderkey", "l_returnflag", "l_partkey AS batch_id", "l_linenumber"
    )
    return dedup.latest_for_canonical(rows, "l_orderkey,l_returnflag")


@query(
    "win_03_latest_ingress",
    """SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey
      ORDER BY CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderdate END DESC NULLS LAST,
      o_orderkey DESC) AS rn FROM orders) WHERE rn = 1""",
)
def win_03(data: Data) -> DataFrame:
    rows = data["orders"].selectExpr(
        "o_custkey",
        "o_orderkey",
        "CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderdate END AS LOAD_DATE",
    )
    return dedup.latest_for_ingress(rows, "o_custkey").select("o_custkey", "o_orderkey")


@query(
    "srt_02_top_rows",
    """SELECT o_orderkey, o_custkey, o_orderpriority FROM orders
    ORDER BY o_orderpriority, o_orderkey DESC LIMIT 25""",
)
def srt_02(data: Data) -> DataFrame:
    rows = data["orders"].select("o_orderkey", "o_custkey", "o_orderpriority")
    return rows.orderBy("o_orderpriority", F.desc("o_orderkey")).limit(25)


@query(
    "agg_03_join_fragments",
    """SELECT string_agg(f, ' ' ORDER BY f) AS join_condition FROM (SELECT DISTINCT
      CASE WHEN p_type <> 'ECONOMY' THEN 'JOIN ' || p_brand || ' ON ' || p_type END AS f FROM part)
    WHERE f IS NOT NULL""",
)
def agg_03(data: Data) -> DataFrame:
    config = data["part"].selectExpr(
        "CASE WHEN p_type <> 'ECONOMY' THEN 'JOIN ' || p_brand || ' ON ' || p_type END "
        "AS join_condition"
    )
    return canonical.join_text(config)


@query(
    "jon_16_insert_absent",
    """SELECT p_partkey, p_type FROM part WHERE NOT EXISTS (SELECT 1 FROM customer
      WHERE lower(trim(' ' || c_mktsegment)) = lower(trim(p_type))
        AND lower(trim(CAST(c_custkey AS STRING))) = lower(trim(CAST(p_partkey AS STRING))))""",
)
def jon_16(data: Data) -> DataFrame:
    existing = data["customer"].selectExpr("c_custkey AS p_partkey", "' ' || c_mktsegment AS p_type")
    rows = data["part"].select("p_partkey", "p_type")
    return canonical.insert_absent(existing, rows, ["p_partkey", "p_type"])


