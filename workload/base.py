"""Query registry and the feed tables derived from the given data.

A derived table is one base table plus SQL expressions that Spark and the oracle engine
read alike, so both sides start from the same rows. Defects (nulls, blanks, orphans,
broken documents) come from attribute values; every row of the base table is used.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from goldrow.session import apply_settings

TABLES = (
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
    "events",
    "documents",
    "embeddings",
    "pages",
    "benchmark",
    "labels",
    "conversations",
)


def _child(key: str, source: str, country: str, batch: str, document: str) -> dict[str, str]:
    return {
        "iqvia_id": f"CAST({key} AS STRING)",
        "source_name": source,
        "country_code": country,
        "batch_id": f"CAST({batch} AS BIGINT)",
        "response_json": document,
    }


def _json(*pieces: str) -> str:
    """Text pieces and SQL columns in turn: 'literal', column, 'literal', ..."""
    return " || ".join(f"'{p}'" if i % 2 == 0 else p for i, p in enumerate(pieces))


DERIVED: dict[str, tuple[str, dict[str, str]]] = {
    # --- person tables
    "hcp_name": (
        "customer",
        _child(
            "c_custkey",
            "CASE WHEN c_nationkey < 12 THEN 'CRM_A' ELSE 'CRM_B' END",
            "CASE WHEN c_nationkey < 8 THEN ' nl ' WHEN c_nationkey < 16 THEN 'BE' ELSE 'de' END",
            "20240101 + c_nationkey",
            "CASE c_mktsegment WHEN 'MACHINERY' THEN '{\"First Name\": broken' ELSE "
            + _json(
                '{"First Name":"',
                "c_name",
                '","Middle Name":null,"Last Name":"',
                "c_mktsegment",
                '","Full Name":"',
                "c_name || ' ' || c_mktsegment",
                '","Title":"Dr","Gender":{"Name":"',
                "CASE WHEN c_acctbal > 5000 THEN 'M' ELSE 'F' END",
                '"},"Type":{"Code":1},"HCP Status":{"Name":"',
                "CASE WHEN c_acctbal < 0 THEN 'Inactive' ELSE 'Active' END",
                '"},"Prefix Name":{"Name":"Prof"},"Transparency Reporting Name":"',
                "upper(c_name)",
                '"}',
            )
            + " END",
        )
        | {
            "first_name": "CASE c_mktsegment WHEN 'BUILDING' THEN NULL WHEN 'FURNITURE' THEN '  ' "
            "ELSE '  ' || c_name || ' ' END",
            "middle_name": "CASE WHEN c_acctbal < 0 THEN '' ELSE 'de  la' END",
            "last_name": "lower(c_mktsegment) || ' mc-kay'",
            "gender": "CASE WHEN c_acctbal > 5000 THEN 'M' ELSE 'F' END",
            "full_name": "c_name || ' ' || c_mktsegment",
            "mdm_entity_type": "'HCP'",
        },
    ),
    "hcp_address": (
        "orders",
        _child(
            "o_custkey",
            "CASE o_orderstatus WHEN 'F' THEN 'CRM_A' ELSE 'CRM_B' END",
            "CASE o_orderpriority WHEN '1-URGENT' THEN 'NL' ELSE 'BE' END",
            "20240101 + o_custkey % 25",
            _json(
                '{"HCP Address":[{"Address Line 1":"',
                "o_orderpriority || ' ' || CAST(o_orderkey AS STRING)",
                '","City":"',
                "o_orderstatus",
                '","Postal Code":"',
                "CAST(o_custkey AS STRING)",
                '","Country":{"Code":"',
                "substr(o_orderpriority, 1, 1)",
                '","Name":"',
                "o_orderpriority",
                '"}}]}',
            ),
        ),
    ),
    # Addresses whose key is missing, blank or unknown for some priorities.
    "dirty_address": (
        "orders",
        {
            "order_id": "o_orderkey",
            "iqvia_id": "CASE o_orderpriority WHEN '5-LOW' THEN NULL "
            "WHEN '4-NOT SPECIFIED' THEN '   ' "
            "WHEN '3-MEDIUM' THEN 'X' || CAST(o_custkey AS STRING) "
            "ELSE CAST(o_custkey AS STRING) END",
            "city": "CASE o_orderstatus WHEN 'P' THEN ' ' ELSE o_orderstatus END",
            "batch_id": "CAST(20240101 + o_custkey % 25 AS BIGINT)",
        },
    ),
    "hcp_phone": (
        "supplier",
        _child(
            "s_suppkey",
            "'CRM_A'",
            "'NL'",
            "20240101 + s_nationkey",
            _json(
                '{"Phone":[{"Phone Number":"',
                "s_name",
                '","Phone Type":{"Code":"W","Name":"Work ',
                "CAST(s_nationkey AS STRING)",
                '"},"Kind":{"a":[1,2]}}]}',
            ),
        ),
    ),
    "hcp_specialty": (
        "part",
        _child(
            "p_partkey",
            "p_brand",
            "'BE'",
            "20240101 + p_size",
            _json(
                '{"Specialty":[{"Specialty Class":"',
                "p_type",
                '","Specialty Type":"',
                "p_brand",
                '","Specialty Rank":{"Code":"R","Name":"',
                "CAST(p_size AS STRING)",
                '"},"Specialty Status":{"Name":"',
                "CASE WHEN p_size > 25 THEN 'Active' ELSE 'Closed' END",
                '"}}]}',
            ),
        ),
    ),
    "hcp_email": (
        "customer",
        _child(
            "c_custkey",
            "'CRM_A'",
            "'NL'",
            "20240101 + c_nationkey",
            "CASE c_mktsegment WHEN 'BUILDING' THEN NULL WHEN 'FURNITURE' THEN 'no json' ELSE "
            + _json('{"Email":["', "lower(c_mktsegment) || '@x.org'", '"]}')
            + " END",
        ),
    ),
    "hcp_identification": (
        "documents",
        _child(
            "doc_id",
            "source",
            "upper(lang)",
            "20240101 + doc_id % 25",
            _json(
                '{"Alternate Identifier":[{"Identifier Value":"',
                "source || '/' || lang",
                '"}],"License":[{"License Number":"L',
                "CAST(doc_id AS STRING)",
                '"}]}',
            ),
        ),
    ),
    "hcp_alternate_name": (
        "conversations",
        _child(
            "conv_id",
            "role",
            "'NL'",
            "20240101 + turn",
            _json(
                '{"Alternate Name":[{"Alternate Name":"',
                "role || CAST(turn AS STRING)",
                '","Alternate Name Type":"',
                "role",
                '"}]}',
            ),
        ),
    ),
    "hcp_tax": (
        "benchmark",
        _child(
            "item_id",
            "'CRM_B'",
            "'NL'",
            "20240101 + item_id % 25",
            _json('{"DEA":[{"DEA Number":"D', "CAST(item_id AS STRING)", '"}]}'),
        ),
    ),
    "hcp_education": (
        "pages",
        _child("page_id", "'CRM_B'", "'NL'", "20240101 + page_id % 25", "'{}'"),
    ),
    "hcp_language": (
        "documents",
        _child("doc_id", "source", "upper(lang)", "20240101 + doc_id % 25", "'{}'"),
    ),
    "hcp_tendencies": (
        "labels",
        _child("doc_id", "'CRM_B'", "'NL'", "20240101 + quality", "'{}'"),
    ),
    "hcp_origin_university": (
        "nation",
        _child("n_nationkey", "'CRM_B'", "n_name", "20240101 + n_regionkey", "'{}'"),
    ),
    "hcp_hco_affiliation": (
        "region",
        _child("r_regionkey", "'CRM_B'", "r_name", "20240101 + r_regionkey", "'{}'"),
    ),
    "hcp_license": (
        "region",
        _child("r_regionkey", "'CRM_B'", "r_name", "20240101 + r_regionkey", "'{}'"),
    ),
    # --- organization tables
    "hco_address": (
        "supplier",
        _child(
            "s_suppkey",
            "'ERP'",
            "'BE'",
            "20240101 + s_nationkey",
            _json(
                '{"Addresses":[{"addressLine1":"',
                "s_name",
                '","city":"City',
                "CAST(s_nationkey AS STRING)",
                '","postalCode":"',
                "CAST(1000 + s_nationkey AS STRING)",
                '","country":"BE"},{"city":"second"}]}',
            ),
        ),
    ),
    "hco_name": (
        "part",
        _child(
            "p_partkey",
            "p_brand",
            "'BE'",
            "20240101 + p_size",
            _json('{"Organization Name":"', "p_name", '","Organization Type":null}'),
        )
        | {
            "organization_name": "CASE p_type WHEN 'ECONOMY' THEN NULL WHEN 'SMALL' THEN ' ' "
            "ELSE p_name END",
            "organization_type": "p_type",
            "mdm_entity_type": "'HCO'",
        },
    ),
    "hco_alternate_name": (
        "nation",
        _child("n_nationkey", "'ERP'", "n_name", "20240101 + n_regionkey", "'{}'"),
    ),
    "hco_email": (
        "customer",
        _child("c_custkey", "'ERP'", "'NL'", "20240101 + c_nationkey", "'{}'"),
    ),
    "hco_hierarchy": (
        "region",
        _child("r_regionkey", "'ERP'", "r_name", "20240101 + r_regionkey", "'{}'"),
    ),
    "hco_hco_hierarchy": (
        "region",
        _child("r_regionkey", "'ERP'", "r_name", "20240101 + r_regionkey", "'{}'"),
    ),
    "hco_tax": (
        "orders",
        _child(
            "o_orderkey",
            "'ERP'",
            "'NL'",
            "20240101 + o_custkey % 25",
            _json('{"Tax Id":"T', "CAST(o_custkey AS STRING)", '"}'),
        ),
    ),
    "hco_identification": (
        "supplier",
        _child(
            "s_suppkey",
            "'ERP'",
            "'BE'",
            "20240101 + s_nationkey",
            _json('{"Identifiers":[{"identifierValue":"', "s_name", '"}]}'),
        ),
    ),
    "hco_phone": (
        "customer",
        _child(
            "c_custkey",
            "c_mktsegment",
            "'BE'",
            "20240101 + c_nationkey",
            _json('{"Phones":[{"phoneNumber":"', "c_name", '","phoneType":"', "c_mktsegment", '"}]}'),
        ),
    ),
    "hco_specialty": (
        "part",
        _child("p_partkey", "p_brand", "'BE'", "20240101 + p_size", "'{}'"),
    ),
    # --- control tables
    "ledger": (
        "orders",
        {
            "batch_id": "o_orderkey",
            "source_system_name": "CASE o_orderstatus WHEN 'F' THEN 'CRM_A' ELSE 'CRM_B' END",
            "batch_start_time": "o_orderdate",
            "batch_end_time": "CASE o_orderpriority WHEN '5-LOW' THEN NULL ELSE o_orderdate END",
            "raw_ingestion_status": "CASE WHEN o_orderpriority = '5-LOW' THEN 'N' ELSE 'Y' END",
            "stdz_status": "CASE WHEN o_orderpriority IN ('5-LOW', '4-NOT SPECIFIED') THEN NULL "
            "ELSE 'Y' END",
            "canonical_status": "CASE WHEN o_orderpriority < '3' THEN 'Y' ELSE 'N' END",
            "dq_status": "CASE WHEN o_orderpriority < '3' AND o_totalprice > 100000 THEN 'Y' "
            "ELSE NULL END",
            "ingress_status": "CASE WHEN o_orderpriority < '3' AND o_totalprice > 200000 THEN 'Y' "
            "ELSE 'N' END",
            "egress_status": "CASE WHEN o_orderpriority < '2' AND o_totalprice > 300000 THEN 'Y' "
            "ELSE NULL END",
        },
    ),
    "work_list": (
        "orders",
        {
            "entity_id": "o_orderkey",
            "entity_type": "CASE o_orderstatus WHEN 'F' THEN 'HCP' ELSE 'HCO' END",
            "country_code": "o_orderstatus",
            "priority": "CAST(substr(o_orderpriority, 1, 1) AS INT)",
            "status": "CASE o_orderpriority WHEN '1-URGENT' THEN 'ACTIVE' WHEN '2-HIGH' "
            "THEN 'PENDING' ELSE 'DONE' END",
        },
    ),
}

PERSON_VIEWS = tuple(t for t in DERIVED if t.startswith("hcp_"))
ORGANIZATION_VIEWS = tuple(t for t in DERIVED if t.startswith("hco_"))


class Data:
    """Given and derived tables of one data folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = apply_settings(spark), folder.rstrip("/")
        self._frames: dict[str, DataFrame] = {}

    def path(self, table: str) -> str:
        return f"{self.folder}/{table}.parquet"

    def __getitem__(self, name: str) -> DataFrame:
        # Opening a parquet path reads a footer to learn its schema; once is enough.
        if name not in self._frames:
            if name in DERIVED:
                base, columns = DERIVED[name]
                items = [f"{e} AS `{c}`" for c, e in columns.items()]
                self._frames[name] = self[base].selectExpr(*items)
            else:
                self._frames[name] = self.spark.read.parquet(self.path(name))
        return self._frames[name]


def derive(*names: str) -> str:
    """CTE list of derived tables for oracle SQL, without the leading WITH."""
    ctes = []
    for name in names:
        base, columns = DERIVED[name]
        items = ", ".join(f'{e} AS "{c}"' for c, e in columns.items())
        ctes.append(f"{name} AS (SELECT {items} FROM {base})")
    return ", ".join(ctes)


@dataclass(frozen=True)
class Query:
    run: Callable[[Data], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    """Register ``f(data) -> DataFrame`` with the SQL that must give the same rows."""

    def add(run: Callable[[Data], DataFrame]):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(run, sql)
        return run

    return add
