"""Sinks: each query writes whole tables to a fresh path and returns what is read back."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldrow.operators import schema
from goldrow.operators.quality import choose_batch
from goldrow.session import scratch_path
from goldrow.sinks import writers
from workload.base import Data, derive, query
from workload.quality import _CHAIN_SQL, address_chain

_BATCH = "CAST(20240101 + c_nationkey AS BIGINT)"


def customers(data: Data) -> DataFrame:
    return data["customer"].selectExpr("c_custkey", "c_mktsegment", f"{_BATCH} AS batch_id")


@query(
    "snk_01_append_table",
    f"""SELECT c_custkey, c_mktsegment, {_BATCH} AS batch_id FROM customer
    UNION ALL SELECT c_custkey, c_mktsegment, {_BATCH} FROM customer""",
)
def snk_01(data: Data) -> DataFrame:
    path = scratch_path(data.spark, "append")
    rows = customers(data)
    writers.write_table(rows, path, "overwrite")
    writers.write_table(rows, path, "append")
    writers.write_table(rows.where("false"), path, "append")
    return writers.read_layer(data.spark, path, rows.schema)


@query(
    "snk_02_batch_replace",
    f"""SELECT c_custkey, CASE WHEN c_nationkey < 5 THEN 'again' ELSE c_mktsegment END
      AS c_mktsegment, {_BATCH} AS batch_id FROM customer WHERE c_nationkey <> 7""",
)
def snk_02(data: Data) -> DataFrame:
    """Batches of five nations are loaded again, twice; one batch has become empty."""
    path = scratch_path(data.spark, "replace")
    rows = customers(data)
    writers.replace_batches(rows, path)
    again = rows.where("batch_id < 20240106").withColumn("c_mktsegment", F.lit("again"))
    for _ in range(2):
        writers.replace_batches(again, path, emptied=[(20240108,)])
    return writers.read_layer(data.spark, path, rows.schema)


@query(
    "snk_03_source_scoped_replace",
    """SELECT CAST(o_orderkey AS STRING) AS o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'again'
      ELSE 'first' END AS load, CAST(1 AS BIGINT) AS "BATCH_ID",
      CASE o_orderstatus WHEN 'F' THEN 'ERP' WHEN 'O' THEN '007' ELSE '7' END AS "Source_Name"
    FROM orders""",
)
def snk_03(data: Data) -> DataFrame:
    """The same batch comes from three sources; one of them is loaded again."""
    path = scratch_path(data.spark, "scoped")
    rows = data["orders"].selectExpr(
        "o_orderkey",
        "'first' AS load",
        "CAST(1 AS BIGINT) AS BATCH_ID",
        "CASE o_orderstatus WHEN 'F' THEN 'ERP' WHEN 'O' THEN '007' ELSE '7' END AS Source_Name",
    )
    writers.load_raw(rows.where("Source_Name = '007'"), path, load_type="delta")
    writers.load_raw(rows, path, load_type="delta")
    again = rows.where("Source_Name = 'ERP'").withColumn("load", F.lit("again"))
    writers.load_raw(again, path, load_type="delta")
    return writers.read_layer(data.spark, path)


@query(
    "snk_04_aligned_write",
    """SELECT p_partkey AS "ID", p_name AS name, CASE p_type WHEN 'ECONOMY' THEN NULL ELSE p_size
      END AS size, NULL AS gone, CAST(20240101 + p_size AS BIGINT) AS "BATCH_ID" FROM part""",
)
def snk_04(data: Data) -> DataFrame:
    rows = data["part"].selectExpr(
        "CAST(20240101 + p_size AS STRING) AS batch_id",
        "p_name AS NAME",
        "CASE p_type WHEN 'ECONOMY' THEN 'big' ELSE CAST(p_size AS STRING) END AS size",
        "p_brand AS extra",
        "p_partkey AS id",
    )
    target = data.spark.createDataFrame(
        [], "ID long, name string, size int, gone date, BATCH_ID string"
    )
    return schema.align(rows, target.schema)


@query(
    "snk_05_first_load",
    """SELECT CAST(o_orderkey AS STRING) AS o_orderkey, o_orderstatus,
      CAST(epoch_us(o_orderdate) AS BIGINT) AS micros, CAST(5 AS BIGINT) AS "BATCH_ID",
      'string,string,timestamp_ntz,bigint' AS types FROM orders""",
)
def snk_05(data: Data) -> DataFrame:
    rows = data["orders"].select(
        "o_orderkey", "o_orderstatus", "o_orderdate", F.lit("5").alias("BATCH_ID")
    )
    loaded = schema.all_strings(rows)
    types = ",".join(t for _, t in loaded.dtypes)
    micros = F.unix_micros(F.col("o_orderdate").cast("timestamp"))
    return loaded.withColumn("micros", micros).drop("o_orderdate").withColumn("types", F.lit(types))


@query(
    "snk_06_load_modes",
    """SELECT CAST(s_suppkey AS STRING) AS s_suppkey, s_name, '2' AS load, CAST(2 AS BIGINT)
      AS "BATCH_ID", 'ERP' AS "Source_Name" FROM supplier""",
)
def snk_06(data: Data) -> DataFrame:
    """A first load, an append, then an overwrite load that leaves only itself."""
    path = scratch_path(data.spark, "modes")
    for load, kind in (("0", "delta"), ("1", "append"), ("2", "overwrite")):
        rows = data["supplier"].select(
            "s_suppkey", "s_name", F.lit(load).alias("load"), F.lit(int(load)).alias("BATCH_ID")
        )
        rows = rows.withColumn("Source_Name", F.lit("ERP"))
        writers.load_raw(rows, path, load_type=kind)
    return writers.read_layer(data.spark, path, schema.all_strings(rows).schema)


@query(
    "snk_07_schema_evolution",
    """SELECT p_partkey AS key, p_name AS name, NULL AS brand, 1 AS batch_id FROM part
    UNION ALL SELECT p_partkey, p_name, p_brand, 2 FROM part""",
)
def snk_07(data: Data) -> DataFrame:
    path = scratch_path(data.spark, "evolve")
    old = data["part"].selectExpr("p_partkey AS key", "p_name AS name", "1 AS batch_id")
    new = data["part"].selectExpr(
        "p_partkey AS key", "p_name AS name", "p_brand AS brand", "2 AS batch_id"
    )
    writers.append_evolving(old, path)
    writers.append_evolving(new, path)
    return writers.read_layer(data.spark, path)


@query(
    "snk_08_full_refresh",
    "SELECT o_orderkey, o_custkey, 'second' AS load FROM orders",
)
def snk_08(data: Data) -> DataFrame:
    path = scratch_path(data.spark, "publish")
    first = data["lineitem"].select("l_orderkey", "l_linenumber")
    writers.publish(first, path, "20240130")
    second = data["orders"].select("o_orderkey", "o_custkey", F.lit("second").alias("load"))
    writers.publish(second, path, "20240131")
    return writers.read_published(data.spark, path)


@query(
    "snk_09_json_columns",
    """SELECT n_nationkey, '{"name":"' || n_name || '","region":' || n_regionkey || ',"none":null}'
      AS record, '[' || n_nationkey || ',' || n_regionkey || ']' AS numbers,
      '{"' || n_name || '":1}' AS lookup FROM nation""",
)
def snk_09(data: Data) -> DataFrame:
    rows = data["nation"].selectExpr(
        "n_nationkey",
        "named_struct('name', n_name, 'region', n_regionkey, 'none', CAST(NULL AS INT)) AS record",
        "array(n_nationkey, n_regionkey) AS numbers",
        "map(n_name, 1) AS lookup",
    )
    return schema.json_complex_columns(rows)


@query(
    "snk_10_publish_set",
    f"""WITH {derive("hcp_name", "hcp_phone")} SELECT 'hcp_name' AS table_name,
      'HCP_NAME' AS target_name, count(*) AS source_rows, count(*) AS inserted_rows, false AS failed
    FROM hcp_name UNION ALL SELECT 'hcp_phone', 'HCP_PHONE', count(*), count(*), false
    FROM hcp_phone UNION ALL SELECT 'hco_hco_hierarchy', 'HCO_HIERARCHY', NULL, NULL, true""",
)
def snk_10(data: Data) -> DataFrame:
    tables = {t: data[t] for t in ("hcp_name", "hcp_phone")}
    names = {"hcp_name": "HCP_NAME", "hcp_phone": "HCP_PHONE", "hco_hco_hierarchy": "HCO_HIERARCHY"}
    root = scratch_path(data.spark, "publish-set")
    results = writers.publish_all(data.spark, tables, names, root, "20240131")
    failed = F.col("error").isNotNull().alias("failed")
    return results.select("table_name", "target_name", "source_rows", "inserted_rows", failed)


@query("snk_11_snapshot", "SELECT c_custkey, c_name, 'HCP_SNAPSHOT_20240131' AS tbl FROM customer")
def snk_11(data: Data) -> DataFrame:
    root = scratch_path(data.spark, "snapshots")
    rows = data["customer"].select("c_custkey", "c_name")
    writers.snapshot(rows.unionAll(rows), root, "HCP", date(2024, 1, 31))
    path = writers.snapshot(rows, root, "HCP", date(2024, 1, 31))
    return writers.read_layer(data.spark, path).withColumn("tbl", F.lit(path.rsplit("/", 1)[-1]))


@query("snk_12_empty_clone", "SELECT c_custkey, c_name, c_mktsegment FROM customer")
def snk_12(data: Data) -> DataFrame:
    """An empty clone, then filled: its schema takes the rows as they are."""
    rows = data["customer"].select("c_custkey", "c_name", "c_mktsegment")
    return schema.empty_like(rows).unionAll(rows)


@query(
    "snk_13_staged_pass",
    _CHAIN_SQL + "SELECT order_id, iqvia_id, city, batch_id FROM chained WHERE failed IS NULL",
)
def snk_13(data: Data) -> DataFrame:
    path = scratch_path(data.spark, "staging")
    staged = address_chain(data).staged
    writers.write_table(staged, path, "overwrite")
    return writers.read_layer(data.spark, path, staged.schema)


@query(
    "snk_14_reconciled_write",
    f"""WITH {derive("hcp_address")} SELECT iqvia_id, response_json, batch_id AS "BATCH_ID"
    FROM hcp_address WHERE batch_id = (SELECT max(batch_id) FROM hcp_address)""",
)
def snk_14(data: Data) -> DataFrame:
    path = scratch_path(data.spark, "egress")
    rows = choose_batch(data["hcp_address"]).select(
        "iqvia_id", "response_json", F.col("batch_id").alias("BATCH_ID")
    )
    writers.reconcile_write(rows, path, 20240125)
    return writers.read_layer(data.spark, path, rows.schema)
