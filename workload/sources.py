"""Sources: the given tables written in each format, then read by the readers."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldrow.session import scratch_path
from goldrow.sources import feeds, readers
from workload.base import Data, derive, query

_PART = "SELECT p_partkey, p_name, p_brand, p_type, p_size FROM part"
_COLUMNS = ("p_partkey", "p_name", "p_brand", "p_type", "p_size")


def part(data: Data) -> DataFrame:
    return data["part"].select(*_COLUMNS)


@query("src_01_csv", _PART)
def src_01(data: Data) -> DataFrame:
    path = scratch_path(data.spark, "csv")
    part(data).write.options(header="true", sep="|").csv(path)
    options = {"delimiter": "|", "header": "true", "inferSchema": "true"}
    return readers.read_file(data.spark, path, "txt", options)


@query("src_02_json", "SELECT c_custkey, c_name, c_mktsegment FROM customer")
def src_02(data: Data) -> DataFrame:
    path = scratch_path(data.spark, "json")
    data["customer"].select("c_custkey", "c_name", "c_mktsegment").write.json(path)
    return readers.read_file(data.spark, path, "json")


@query("src_03_parquet", "SELECT l_orderkey, l_linenumber, l_returnflag FROM lineitem")
def src_03(data: Data) -> DataFrame:
    rows = readers.read_file(data.spark, data.path("lineitem"), "parquet", {"header": "true"})
    return rows.select("l_orderkey", "l_linenumber", "l_returnflag")


@query("src_04_lakehouse_table", "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders")
def src_04(data: Data) -> DataFrame:
    path = scratch_path(data.spark, "lakehouse")
    data["orders"].select("o_orderkey", "o_custkey", "o_orderstatus").write.parquet(path)
    data.spark.conf.set(readers.LAKEHOUSE_SETTING, "parquet")
    return readers.read_file(data.spark, path, "delta")


@query("src_05_orc", _PART)
def src_05(data: Data) -> DataFrame:
    path = scratch_path(data.spark, "orc")
    part(data).write.orc(path)
    return readers.read_file(data.spark, path, "orc")


@query("src_06_catalog_table", "SELECT s_suppkey, s_name, s_nationkey FROM supplier")
def src_06(data: Data) -> DataFrame:
    name = f"supplier_{uuid.uuid4().hex}"
    data.spark.catalog.createTable(name, path=data.path("supplier"), source="parquet")
    spec = readers.SourceSpec("catalog_table", "default", name)
    return readers.read_source(data.spark, spec).select("s_suppkey", "s_name", "s_nationkey")


@query(
    "src_07_json_documents",
    """SELECT CAST(o_orderkey AS STRING) AS id, o_orderstatus AS status, 'true' AS flag,
      NULL AS note, '{"a":"1"}' AS nested FROM orders
    UNION ALL SELECT CAST(o_custkey AS STRING), NULL, 'false', 'n', NULL FROM orders""",
)
def src_07(data: Data) -> DataFrame:
    """One landed document per order, each with two items under ``data``."""
    path = scratch_path(data.spark, "documents")
    item = "named_struct('id', {0}, 'status', {1}, 'flag', {2}, 'note', {3}, 'nested', {4})"
    first = item.format("o_orderkey", "o_orderstatus", "true", "NULL", "named_struct('a', 1)")
    second = item.format("o_custkey", "NULL", "false", "'n'", "NULL")
    data["orders"].selectExpr(f"array({first}, {second}) AS data").write.json(path)
    rows = readers.read_documents(data.spark, path, per_line=True)
    return rows.select("id", "status", "flag", "note", "nested")


@query(
    "src_07_records_in_one_pass",
    """SELECT 0 AS position, CAST(o_orderkey AS STRING) AS id, o_orderstatus AS status, 'true' AS flag,
      NULL AS data, '{"a":1}' AS nested FROM orders WHERE o_orderstatus = 'F'
    UNION ALL SELECT 1, CAST(o_custkey AS STRING), NULL, 'false', NULL, NULL FROM orders
      WHERE o_orderstatus = 'F'
    UNION ALL SELECT 0, CAST(o_orderkey AS STRING), NULL, NULL, NULL, '[1,null]' FROM orders
      WHERE o_orderstatus = 'O'
    UNION ALL SELECT 0, CAST(o_orderkey AS STRING), o_orderstatus, NULL, NULL, NULL FROM orders
      WHERE o_orderstatus = 'P' AND o_orderpriority <> '5-LOW'
    UNION ALL SELECT 0, NULL, NULL, NULL, NULL, NULL FROM orders
      WHERE o_orderstatus = 'P' AND o_orderpriority = '5-LOW'""",
)
def src_07_records(data: Data) -> DataFrame:
    """Documents of four shapes in one folder: items under ``data``, a list, one object whose
    ``data`` is null, and text that is no JSON."""
    path = scratch_path(data.spark, "records")
    document = """CASE WHEN o_orderstatus = 'F' THEN '{"data":[{"id":' || o_orderkey || ',"status":"F",'
        || '"flag":true,"nested":{"a":1}},{"id":' || o_custkey || ',"status":null,"flag":false}]}'
      WHEN o_orderstatus = 'O' THEN '[{"id":' || o_orderkey || ',"nested":[1,null]}]'
      WHEN o_orderpriority <> '5-LOW' THEN '{"id":"' || o_orderkey || '","status":"P","data":null}'
      ELSE '{"id": broken' END AS value"""
    data["orders"].selectExpr(document).write.text(path)
    records = readers.read_records(data.spark, path, per_line=True)
    return readers.record_text(records, ["id", "status", "flag", "data", "nested"]).drop("file")


def _feed_folder(data: Data) -> str:
    """Three dated drops of one feed and a stray file beside them."""
    folder = scratch_path(data.spark, "feed")
    drops = ("orders_20240101000000", "orders_20240301000000", "orders_20240201000000")
    for name in drops:
        drop = data["orders"].select("o_orderkey", F.lit(name).alias("drop"))
        drop.write.parquet(f"{folder}/{name}.parquet")
    data["orders"].select("o_orderkey").write.parquet(f"{folder}/zz_other.parquet")
    return folder


_NEWEST = """SELECT o_orderkey, 'orders_20240301000000' AS "drop" FROM orders"""


@query("src_08_newest_file", _NEWEST)
def src_08(data: Data) -> DataFrame:
    folder = _feed_folder(data)
    path = readers.newest_file(data.spark, folder, "orders_YYYYMMDDHHMMSS.parquet")
    return readers.read_file(data.spark, path, "parquet")


@query("src_09_format_dispatch", _NEWEST)
def src_09(data: Data) -> DataFrame:
    spec = readers.SourceSpec("file", _feed_folder(data), "orders_YYYYMMDDHHMMSS.parquet")
    return readers.read_source(data.spark, spec)


_WORK = f"""WITH {derive("work_list")} SELECT entity_id, entity_type, country_code, priority
  FROM work_list WHERE status IN ('ACTIVE', 'PENDING')"""


@query("src_10_pending_entities", f"{_WORK} AND entity_type = 'HCO'")
def src_10(data: Data) -> DataFrame:
    return feeds.pending_entities(data["work_list"], ["HCO"])


@query("src_10_pending_limited", f"{_WORK} ORDER BY priority, entity_id LIMIT 50")
def src_10_limited(data: Data) -> DataFrame:
    return feeds.pending_entities(data["work_list"], limit=50)


RUN_TIME = datetime(2024, 1, 31, 10, 20, 30)
_RAW = """'2024-01-31T10:20:30' AS create_date, '2024-01-31T10:20:30' AS load_date,
  'IQVIA_API' AS source_name, 'API_{0}_20240131_102030' AS batch_id"""


@query(
    "src_11_person_feed",
    f"""WITH {derive("hcp_name")}, n AS (SELECT *, CASE WHEN json_valid(response_json)
      THEN response_json END AS j FROM hcp_name)
    SELECT iqvia_id, 'HCP' AS mdm_entity_type, country_code, response_json, {_RAW.format("HCP")},
      json_extract_string(j, '$.Title') AS title, json_extract_string(j, '$."First Name"')
        AS first_name, json_extract_string(j, '$."Middle Name"') AS middle_name,
      json_extract_string(j, '$."Last Name"') AS last_name,
      json_extract_string(j, '$."Full Name"') AS full_name,
      json_extract_string(j, '$.Gender') AS gender, '' AS professional_type
    FROM n WHERE j IS NOT NULL""",
)
def src_11_person(data: Data) -> DataFrame:
    documents = data["hcp_name"].selectExpr(
        "iqvia_id AS entity_id", "mdm_entity_type AS entity_type", "country_code", "response_json"
    )
    return feeds.feed_to_raw(documents, "HCP", RUN_TIME)


@query(
    "src_11_organization_feed",
    f"""WITH {derive("hco_name")} SELECT iqvia_id, 'HCO' AS mdm_entity_type, country_code,
      response_json, {_RAW.format("HCO")},
      json_extract_string(response_json, '$."Organization Name"') AS organization_name,
      NULL AS organization_type FROM hco_name""",
)
def src_11_organization(data: Data) -> DataFrame:
    documents = data["hco_name"].selectExpr(
        "iqvia_id AS entity_id", "mdm_entity_type AS entity_type", "country_code", "response_json"
    )
    return feeds.feed_to_raw(documents, "HCO", RUN_TIME)
