"""Ingress mappings, staging views, consolidations and masters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldrow.operators import dedup, ingress, marts, schema
from goldrow.plans import catalog
from goldrow.plans.specs import Col, Json
from workload.base import Data, derive, query

_VIEW_TABLE = {"hco_hco_hierarchy": "hco_hierarchy"}


def sql_path(path: str) -> str:
    """Document path of a mapping in the oracle's spelling."""
    quoted = path.replace("['", '."').replace("']", '"').lstrip(".")
    return f"$.{quoted}"


def _document(column: str = "response_json") -> str:
    """A document the oracle can read: one that is no JSON counts as null."""
    return f"(CASE WHEN json_valid({column}) THEN {column} END)"


def _view_sql(view: str) -> str:
    """Oracle select list of one staging view."""
    if view in catalog.EMPTY_VIEWS:
        names = ("SOURCE_FK", *catalog.EMPTY_VIEWS[view])
        items = ", ".join(f'CAST(NULL AS STRING) AS "{n}"' for n in names)
        return f"SELECT {items} FROM {view} WHERE 1 = 0"
    items = ['iqvia_id AS "SOURCE_FK"']
    for name, item in catalog.STAGING_VIEWS[view].items():
        if isinstance(item, Json):
            steps = "".join(f"[{s}]" if isinstance(s, int) else f'."{s}"' for s in item.steps)
            value = f"json_extract_string({_document()}, '${steps}')"
        elif isinstance(item, Col):
            value = f'"{item.name}"'
        else:
            value = "CAST(NULL AS STRING)"
        items.append(f'{value} AS "{name}"')
    return f"SELECT {', '.join(items)} FROM {view}"


def views_sql(*views: str) -> str:
    return derive(*views) + ", " + ", ".join(f"stg_{v} AS ({_view_sql(v)})" for v in views)


def _register_view(prefix: str, view: str) -> None:
    @query(f"{prefix}_view_{view}", f"WITH {views_sql(view)} SELECT * FROM stg_{view}")
    def _(data: Data) -> DataFrame:
        return marts.staging_view(data[view], view)


for _view, _spec in catalog.STAGING_VIEWS.items():
    _reads = any(isinstance(i, Json) for i in _spec.values())
    _prefix = ("doc_02" if _view.startswith("hcp") else "doc_03") if _reads else "doc_04"
    _register_view(_prefix, _view)


@query(
    "prj_18_view_hcp_license",
    f"WITH {views_sql('hcp_license')} SELECT (SELECT count(*) FROM hcp_license) AS source_rows, "
    "(SELECT count(*) FROM stg_hcp_license) AS view_rows",
)
def prj_18(data: Data) -> DataFrame:
    """The view that is empty by definition, beside the rows it leaves out."""
    rows = data["hcp_license"]
    view = marts.staging_view(rows, "hcp_license")
    left_out = view.agg(F.count(F.lit(1))).scalar()
    return rows.agg(F.count(F.lit(1)).alias("source_rows")).withColumn("view_rows", left_out)


@query(
    "prj_17_null_columns",
    f"WITH {views_sql('hco_specialty')} SELECT * FROM stg_hco_specialty",
)
def prj_17(data: Data) -> DataFrame:
    return marts.staging_view(data["hco_specialty"], "hco_specialty")


# ------------------------------------------------------------------ ingress


# Written by hand from the documents' shape, so that a wrong path in the engine's catalogue
# is not wrong here too.
_DOCUMENT_PATHS = {
    ("hcp_specialty", "X_informatica_Specialty"): '$.Specialty[0]."Specialty Class"',
    ("hcp_specialty", "X_specialty_type"): '$.Specialty[0]."Specialty Type"',
    ("hcp_specialty", "X_informatica_rank"): '$.Specialty[0]."Specialty Rank".Name',
    ("hcp_specialty", "X_specialty_status"): '$.Specialty[0]."Specialty Status".Name',
    ("hcp_alternate_name", "AlternateName"): '$."Alternate Name"[0]."Alternate Name"',
    ("hcp_alternate_name", "AlternateNameType"): '$."Alternate Name"[0]."Alternate Name Type"',
    ("hcp_address", "X_hcp_address"): '$."HCP Address"[0]."Address Line 1"',
    ("hcp_address", "X_hcp_city"): '$."HCP Address"[0].City',
    ("hcp_address", "X_hcp_postal_code"): '$."HCP Address"[0]."Postal Code"',
    ("hcp_address", "X_hcp_country"): '$."HCP Address"[0].Country.Name',
    ("hcp_phone", "Phone"): '$.Phone[0]."Phone Number"',
    ("hcp_phone", "X_phone_type"): '$.Phone[0]."Phone Type".Name',
    ("hcp_identification", "X_informatica_License"): '$.License[0]."License Number"',
}


def _ingress_sql(table: str) -> str:
    items = []
    for source, target in ingress.field_mapping(table).items():
        if source.startswith("json:"):
            path = _DOCUMENT_PATHS.get((table, target)) or sql_path(source.removeprefix("json:"))
            value = f"json_extract_string({_document()}, '{path}')"
        else:
            value = f'"{source}"'
        items.append(f'{value} AS "{target}"')
    return f"SELECT {', '.join(items)}, source_name, batch_id FROM {table}"


def _register_ingress(table: str) -> None:
    base = _VIEW_TABLE.get(table, table)
    sql = _ingress_sql(table).replace(f"FROM {table}", f"FROM {base}")

    @query(f"doc_01_ingress_{table}", f"WITH {derive(base)} {sql}")
    def _(data: Data) -> DataFrame:
        return ingress.map_fields(data[base], ingress.field_mapping(table))


for _table in catalog.INGRESS_FIELDS:
    _register_ingress(_table)


@query(
    "prj_10_fallback_mapping",
    f"""WITH {derive("hcp_phone")} SELECT iqvia_id AS "individualEid",
      source_name AS origin, batch_id FROM hcp_phone""",
)
def prj_10(data: Data) -> DataFrame:
    mapping = {"IQVIA_ID": "individualEid", "no_such": "gone", "Source_Name": "origin"}
    rows = ingress.map_fields(data["hcp_phone"], mapping)
    return rows.drop("source_name")


def typed_source(data: Data) -> DataFrame:
    """Organization rows with numbers and dates as text, some of them not readable."""
    return data["part"].selectExpr(
        "CAST(p_partkey AS STRING) AS Third_Party_ID",
        "p_name AS HCO_Name",
        "p_type AS hco_type",
        "CASE p_type WHEN 'ECONOMY' THEN 'many' ELSE CAST(p_size AS STRING) END AS Bed_Count",
        "p_size > 25 AS Profit_Flag",
        "CASE WHEN p_size > 25 THEN '2024-02-29 10:00:00' ELSE '2024-02-30' END AS Activation_Date",
        "CAST(20240101 + p_size AS BIGINT) AS Batch_ID",
        "p_brand AS Source_Name",
    )


@query(
    "prj_11_typed_mapping",
    """SELECT p_brand AS "sourceSystem", p_name AS "HCO_name", p_type AS "HCO_X_informatica_type",
      CASE p_type WHEN 'ECONOMY' THEN NULL ELSE p_size END AS "HCO_X_informatica_bedCount",
      CASE WHEN p_size > 25 THEN 1 ELSE 0 END AS "HCO_X_ProfitFlag",
      CASE WHEN p_size > 25 THEN '2024-02-29 10:00:00' END AS "HCO_X_ActivationDate",
      CAST(p_partkey AS STRING) AS "HCO_X_third_party_id",
      CAST(20240101 + p_size AS BIGINT) AS "Batch_ID" FROM part""",
)
def prj_11(data: Data) -> DataFrame:
    physical = {t: f"mdm.{t}" for t in ("hco_name", "hco_phone", "hco_specialty")}
    targets = ingress.typed_targets(typed_source(data), "staging.hco_name", physical)
    rows = targets["mdm.hco_name"]
    date = F.col("HCO_X_ActivationDate").cast("string")
    return rows.withColumn("HCO_X_ActivationDate", date).drop("Source_Name")


@query(
    "prj_12_two_targets",
    f"""WITH {derive("hco_name")}, rows AS ({_ingress_sql("hco_name")}) SELECT 'hco' AS target, *
    FROM rows UNION ALL SELECT 'hco_name', * FROM rows""",
)
def prj_12(data: Data) -> DataFrame:
    targets = ingress.to_targets(data["hco_name"], "hco_name")
    return schema.union_filled([df.withColumn("target", F.lit(t)) for t, df in targets.items()])


# ------------------------------------------------------------------ consolidation


def person_views(data: Data) -> dict[str, DataFrame]:
    names = dict.fromkeys(v for v, _, _ in catalog.PERSON_COLUMNS)
    return {v: marts.staging_view(data[v], v) for v in names}


def organization_views(data: Data) -> dict[str, DataFrame]:
    names = {catalog.ORGANIZATION_ANCHOR: None} | dict.fromkeys(
        v for v, _, _ in catalog.ORGANIZATION_COLUMNS
    )
    return {v: marts.staging_view(data[v], v) for v in names}


def consolidated_sql(anchor: str, columns: tuple[tuple[str, str, str], ...]) -> str:
    """CTE body of a consolidation: the anchor view left-joined with all others."""
    views = [v for v in dict.fromkeys(v for v, _, _ in columns) if v != anchor]
    items = ", ".join(f'{v}."{s}" AS "{t}"' for v, s, t in columns)
    joins = " ".join(
        f'LEFT JOIN stg_{v} AS {v} ON {anchor}."SOURCE_FK" = {v}."SOURCE_FK"' for v in views
    )
    return f'SELECT {anchor}."SOURCE_FK", {items} FROM stg_{anchor} AS {anchor} {joins}'


_PERSON_VIEWS = list(dict.fromkeys(v for v, _, _ in catalog.PERSON_COLUMNS))
_ORGANIZATION_VIEWS = list(dict.fromkeys(v for v, _, _ in catalog.ORGANIZATION_COLUMNS))
PERSON_SQL = (
    f"WITH {views_sql(*_PERSON_VIEWS)}, "
    f"person AS ({consolidated_sql(catalog.PERSON_ANCHOR, catalog.PERSON_COLUMNS)}) "
)
ORGANIZATION_SQL = (
    f"WITH {views_sql(*_ORGANIZATION_VIEWS)}, organization AS "
    f"({consolidated_sql(catalog.ORGANIZATION_ANCHOR, catalog.ORGANIZATION_COLUMNS)}) "
)


@query("jon_11_person_consolidation", PERSON_SQL + "SELECT * FROM person")
def jon_11(data: Data) -> DataFrame:
    return marts.consolidate_person(person_views(data))


@query("jon_12_organization_consolidation", ORGANIZATION_SQL + "SELECT * FROM organization")
def jon_12(data: Data) -> DataFrame:
    return marts.consolidate_organization(organization_views(data))


@query(
    "jon_11_one_row_per_person",
    f"""WITH {views_sql("hcp_name", "hcp_address")}, newest AS (SELECT * FROM (SELECT *,
      row_number() OVER (PARTITION BY "SOURCE_FK" ORDER BY "X_hcp_address" DESC) AS rn
      FROM stg_hcp_address) WHERE rn = 1)
    SELECT n."SOURCE_FK", n."firstName", a."X_hcp_address" FROM stg_hcp_name n
      LEFT JOIN newest a ON n."SOURCE_FK" = a."SOURCE_FK" """,
)
def jon_11_unique(data: Data) -> DataFrame:
    """Addresses reduced to one per person first, so the consolidation does not fan out."""
    views = person_views(data)
    views["hcp_address"] = dedup.latest_per_key(views["hcp_address"], ["SOURCE_FK"])
    views["hcp_alternate_name"] = dedup.latest_per_key(views["hcp_alternate_name"], ["SOURCE_FK"])
    person = marts.consolidate_person(views)
    return person.select("SOURCE_FK", "firstName", "X_hcp_address")


def _renames(pairs) -> str:
    items = pairs.items() if isinstance(pairs, dict) else pairs
    return ", ".join(f'"{s}" AS "{t}"' for s, t in items)


@query("prj_13_person_master", PERSON_SQL + f"SELECT {_renames(catalog.PERSON_MASTER)} FROM person")
def prj_13(data: Data) -> DataFrame:
    return marts.person_master(marts.consolidate_person(person_views(data)))


def hub_child(table: str) -> list[str]:
    """Select list giving a hub child table its columns from lineitem rows."""
    sources = list(catalog.PERSON_CHILD_MASTERS[table])
    values = (
        "CAST(l_orderkey AS STRING)",
        "l_returnflag",
        "l_linestatus",
        "CAST(l_linenumber AS STRING)",
        "CAST(l_partkey AS STRING)",
    )
    return [f'{values[i % len(values)]} AS "{s}"' for i, s in enumerate(sources)]


def _register_child_master(table: str) -> None:
    items = hub_child(table)
    sql = (
        f"WITH hub AS (SELECT {', '.join(items)} FROM lineitem) "
        f"SELECT {_renames(catalog.PERSON_CHILD_MASTERS[table])} FROM hub"
    )

    @query(f"prj_14_master_{table}", sql)
    def _(data: Data) -> DataFrame:
        rows = data["lineitem"].selectExpr(*[i.replace('"', "`") for i in items])
        return marts.person_child_master(table, rows)


for _table in catalog.PERSON_CHILD_MASTERS:
    _register_child_master(_table)


def _register_organization_children(target: str) -> None:
    view = catalog.ORGANIZATION_INGRESS_VIEW[target]
    pairs = catalog.ORGANIZATION_INGRESS[target]
    head = f"WITH {views_sql(view)} "

    @query(f"prj_15_ingress_{target}", f"{head} SELECT {_renames(pairs)} FROM stg_{view}")
    def _(data: Data) -> DataFrame:
        return marts.organization_ingress(target, marts.staging_view(data[view], view))

    kept = [
        (s, t)
        for s, t in pairs
        if t != "sourceSystem" or target not in catalog.MASTERS_WITHOUT_SOURCE
    ]

    @query(f"prj_16_master_{target}", f"{head} SELECT {_renames(kept)} FROM stg_{view}")
    def _(data: Data) -> DataFrame:
        rows = marts.organization_ingress(target, marts.staging_view(data[view], view))
        return marts.organization_child_master(target, rows)


for _target in catalog.ORGANIZATION_INGRESS:
    _register_organization_children(_target)


@query("prj_16_master_hco", ORGANIZATION_SQL + "SELECT * FROM organization")
def prj_16(data: Data) -> DataFrame:
    return marts.organization_master(marts.consolidate_organization(organization_views(data)))
