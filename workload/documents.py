"""Nested documents built from whole texts: every line of a text is one record of its document."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldrow.operators import documents
from goldrow.operators.schema import unnest
from goldrow.session import spread_scan
from workload.base import Data, query

LINES = "split(text, '\\n')"
LINES_SQL = """WITH lines AS (SELECT doc_id AS request_id, lang, source, x,
  CAST(i AS INTEGER) AS i FROM (SELECT doc_id, lang, source,
    unnest(string_split(text, chr(10))) AS x,
    generate_subscripts(string_split(text, chr(10)), 1) - 1 AS i FROM documents)) """


def built(data: Data, *expressions: str) -> DataFrame:
    return spread_scan(data["documents"]).selectExpr("doc_id AS request_id", "lang", "source", *expressions)


# Records without a score count as 0; identifiers of long lines with a comma are known ids.
PRIMARY_JSON = f"""to_json(named_struct('searchResult', named_struct('records', transform({LINES},
  (x, i) -> named_struct(
    '_meta', named_struct('businessId', 'B' || doc_id || '-' || i,
      'score', CASE WHEN x LIKE '%q%' THEN NULL ELSE length(x) % 100 END),
    'data', named_struct('firstName', split_part(x, ' ', 1), 'fullName', x, 'lastName', lang,
      'gender', CASE WHEN x LIKE '%e%' THEN named_struct('Name', 'F') END,
      'X_hcp_address', array(named_struct('x_address_line_1', x, 'x_city', source,
        'x_country', named_struct('Code', upper(lang), 'Name', lang))),
      'AlternateIdentifier', array(named_struct(
        'alternateIdentifierType', named_struct('Code',
          CASE WHEN x LIKE '%,%' AND length(x) > 50 THEN ' iqvia id ' ELSE 'NPI' END,
          'Name', CASE WHEN x LIKE '%,%' THEN 'Known' END),
        'alternateIdentifierValue', md5(x)))))))))"""
PRIMARY_SCORE = "CASE WHEN x LIKE '%q%' THEN 0 ELSE length(x) % 100 END"


def primary_responses(data: Data) -> DataFrame:
    return built(data, f"{PRIMARY_JSON} AS response_json")


@query(
    "doc_06_primary_records",
    LINES_SQL
    + f""", kept AS (SELECT *, {PRIMARY_SCORE} AS score FROM lines WHERE {PRIMARY_SCORE} >= 40)
    SELECT request_id, CAST(row_number() OVER (PARTITION BY request_id ORDER BY i) - 1 AS INTEGER)
      AS position, CAST(count(*) OVER (PARTITION BY request_id) AS INTEGER) AS total_records,
      'B' || request_id || '-' || i AS hub_id, CAST(score AS INTEGER) AS score,
      split_part(x, ' ', 1) AS first_name, x AS full_name, lang AS last_name,
      CASE WHEN x LIKE '%e%' THEN 'F' ELSE '' END AS gender, x AS address, source AS city,
      '' AS primary_flag, upper(lang) AS country,
      CASE WHEN x LIKE '%,%' THEN 'Known' ELSE '' END AS id_type, md5(x) AS id_value FROM kept""",
)
def doc_06(data: Data) -> DataFrame:
    rows = documents.normalize_primary(primary_responses(data), 40)
    rows = unnest(rows, ["request_id", "total_records"], "records", "r")
    address, identifier = F.col("r.HCP Address")[0], F.col("r.AlternateIdentifier")[0]
    return rows.select(
        "request_id",
        "position",
        "total_records",
        F.col("r.mdm_hubid").alias("hub_id"),
        F.col("r.score").cast("int").alias("score"),
        F.col("r.First Name").alias("first_name"),
        F.col("r.Full Name").alias("full_name"),
        F.col("r.Last Name").alias("last_name"),
        F.col("r.Gender").alias("gender"),
        address["Address Line 1"].alias("address"),
        address["City"].alias("city"),
        address["Primary Flag"].alias("primary_flag"),
        address["Country"]["Code"].alias("country"),
        identifier["Identifier Type"].alias("id_type"),
        identifier["Identifier Value"].alias("id_value"),
    )


SECONDARY_JSON = f"""to_json(named_struct('response', named_struct('results', transform({LINES},
  x -> named_struct(
    'individual', named_struct('individualeId', md5(x), 'firstName', split_part(x, ' ', 1),
      'middleName', split_part(x, ' ', 2), 'lastName', lang),
    'workplace', named_struct('workplaceAddresses', map(
      '1', named_struct('typeCodeCorporateLabel', 'Main', 'address', named_struct(
        'addressLongLabel', x, 'longPostalCode', CAST(length(x) AS STRING),
        'postalTownReference', named_struct('villageLabel', source, 'subdivisions',
          map('COUNTRY', named_struct('externalId', upper(lang), 'longLocalizedLabel', lang))))),
      '2', named_struct('typeCodeCorporateLabel', NULL, 'address', NULL))))))))"""


@query(
    "doc_05_secondary_records",
    LINES_SQL
    + """SELECT request_id, i AS position, CAST(count(*) OVER (PARTITION BY request_id) AS INTEGER)
      AS total_records, md5(x) AS record_id, split_part(x, ' ', 1) AS first_name,
      concat_ws(' ', nullif(split_part(x, ' ', 1), ''), nullif(split_part(x, ' ', 2), ''), lang)
        AS full_name, lang AS last_name, '' AS gender, 2 AS addresses, x AS line_1,
      source AS city, 'Main' AS flag, CAST(length(x) AS STRING) AS postal,
      upper(lang) || '/' || lang AS country, '' AS line_2,
      '[{"Identifier Type":"","Identifier Value":""},'
        || '{"Identifier Type":"","alternateIdentifierValue":""}]' AS identifiers FROM lines""",
)
def doc_05(data: Data) -> DataFrame:
    rows = documents.normalize_secondary(built(data, f"{SECONDARY_JSON} AS response_json"))
    rows = unnest(rows, ["request_id", "total_records"], "records", "r")
    first, second = F.col("r.HCP Address")[0], F.col("r.HCP Address")[1]
    country = first["Country"]
    return rows.select(
        "request_id",
        "position",
        "total_records",
        F.col("r.individualeId").alias("record_id"),
        F.col("r.First Name").alias("first_name"),
        F.col("r.Full Name").alias("full_name"),
        F.col("r.Last Name").alias("last_name"),
        F.col("r.Gender").alias("gender"),
        F.size("r.HCP Address").alias("addresses"),
        first["Address Line 1"].alias("line_1"),
        first["City"].alias("city"),
        first["Primary Flag"].alias("flag"),
        first["Postal Code"].alias("postal"),
        F.concat_ws("/", country["Code"], country["Name"]).alias("country"),
        second["Address Line 1"].alias("line_2"),
        F.to_json("r.AlternateIdentifier").alias("identifiers"),
    )


# Lines starting with one word share a workplace, so its addresses repeat in the document.
POST_JSON = f"""to_json(named_struct('response', named_struct('results', transform({LINES},
  (x, i) -> named_struct('country', upper(lang),
    'activity', named_struct('isMainActivity', i = 0),
    'individual', named_struct('individualId', 'I' || doc_id || '-' || i,
      'firstName', split_part(x, ' ', 1), 'lastName', lang,
      'usualFirstName', CASE lang WHEN 'fr' THEN 'Usual' END,
      'genderCode', 'F', 'thesisYear', CASE lang WHEN 'de' THEN '1999' END,
      'ada', map('1SP,1', named_struct('listCode', 'SP', 'code', source, 'codeCorporateLabel', lang),
        '1GS,1', named_struct('listCode', 'GS', 'code', 'G' || lang, 'codeCorporateLabel', ''),
        '1SP', named_struct('listCode', 'SP', 'code', '', 'codeCorporateLabel', 'none')),
      'externalKeys', map('111', named_struct('value', lang, 'typeLabel', 'NPI'),
        '999', named_struct('value', 'no', 'typeLabel', 'no'))),
    'workplace', named_struct('workplaceId', split_part(x, ' ', 1),
      'workplaceAddresses', map(
        'a,1', named_struct('typeCode', 'P', 'address', named_struct('addressLongLabel', x,
          'longPostalcode', CAST(i AS STRING), 'postalTownReference', named_struct(
            'dispatchLabel', source, 'country', upper(lang), 'subdivisions',
            map('SUB.3', named_struct('longLocalizedLabel', 'State'))))),
        'b', named_struct('typeCode', NULL, 'address', NULL)),
      'telephones', map('t,1', named_struct('typeCorporateLabel', 'Main FAX line',
          'callNumberForDisplay', CAST(length(x) AS STRING)),
        't,2', named_struct('typeCorporateLabel', 'Office', 'callNumberForDisplay', NULL))))))))"""


def posted(data: Data) -> DataFrame:
    responses = built(data, f"{POST_JSON} AS response_json")
    return documents.build_post(responses, F.lit(1700000000000).cast("long"))


@query(
    "doc_07_post_addresses",
    LINES_SQL
    + """, firsts AS (SELECT *, row_number() OVER (PARTITION BY request_id, split_part(x, ' ', 1)
        ORDER BY i) AS rn FROM lines),
    kept AS (SELECT *, row_number() OVER (PARTITION BY request_id ORDER BY i) - 1 AS p
      FROM firsts WHERE rn = 1)
    SELECT request_id, CAST(2 * p + k AS INTEGER) AS position,
      split_part(x, ' ', 1) || '_' || CASE k WHEN 0 THEN 'a,1' ELSE 'b' END AS id,
      CASE k WHEN 0 THEN x ELSE '' END AS line_1, CASE k WHEN 0 THEN source ELSE '' END AS city,
      CASE k WHEN 0 THEN CAST(i AS STRING) ELSE '' END AS postal, i = 0 AS main,
      CASE k WHEN 0 THEN upper(lang) ELSE '' END AS country,
      CASE k WHEN 0 THEN 'State' ELSE '' END AS state, CASE k WHEN 0 THEN 'P' ELSE '' END AS type
    FROM kept CROSS JOIN (VALUES (0), (1)) AS t(k)""",
)
def doc_07_addresses(data: Data) -> DataFrame:
    rows = unnest(posted(data), ["request_id"], "post.X_hcp_address", "a")
    return rows.select(
        "request_id",
        "position",
        "a.id",
        F.col("a.x_address_line_1").alias("line_1"),
        F.col("a.x_city").alias("city"),
        F.col("a.x_postal_code").alias("postal"),
        F.col("a.x_primary_flag").alias("main"),
        F.col("a.x_country.Code").alias("country"),
        F.col("a.x_state.Name").alias("state"),
        F.col("a.x_address_type.Code").alias("type"),
    )


@query(
    "doc_07_post_person",
    LINES_SQL
    + """, n AS (SELECT request_id, 2 * count(DISTINCT split_part(x, ' ', 1)) AS addresses
      FROM lines GROUP BY 1), f AS (SELECT *, split_part(x, ' ', 1) AS w FROM lines WHERE i = 0)
    SELECT f.request_id, w AS first_name, trim(w || '  ' || lang) AS full_name,
      CASE lang WHEN 'fr' THEN 'Usual' ELSE trim(w || '  ' || lang) END AS transparency,
      '{"Code":"F"}' AS gender, '{"Code":""}' AS title,
      '[{"X_informatica_specialtyClass":{"Code":"' || source || '","Name":"' || lang
        || '"},"X_group_specialty":{"Code":"G' || lang || '"},"X_global_specialty":{"Code":"'
        || source || '"}},{"X_informatica_specialtyClass":{"Code":"","Name":"none"},'
        || '"X_group_specialty":{"Code":"G' || lang || '"},"X_global_specialty":{"Code":"'
        || source || '"}}]' AS specialties,
      CASE lang WHEN 'de' THEN '[{"X_informatica_degreeYear":"1999"}]' ELSE '[]' END AS degrees,
      '[{"alternateIdentifierValue":"I' || f.request_id || '-0","alternateIdentifierType":'
        || '{"Code":"iqvia ID","Name":"iqvia ID"}},{"alternateIdentifierValue":"' || lang
        || '","alternateIdentifierType":{"Code":"111","Name":"NPI"}}]' AS identifiers,
      '[{"id":"ph_t_1","phoneNumber":"' || length(x) || '","iso":"' || upper(lang)
        || '","phoneType":{"Code":"Fax","Name":"Fax"}},{"id":"ph_t_2","phoneNumber":"","iso":"'
        || upper(lang) || '","phoneType":{"Code":"Mobile","Name":"Mobile"}}]' AS phones,
      CAST(n.addresses + 3 AS INTEGER) AS trail_entries, 'x_hcp_address[' || w || '_a,1]'
        AS first_ref, '/' AS last_ref, 1700000000000 AS updated
    FROM f JOIN n ON f.request_id = n.request_id""",
)
def doc_07_person(data: Data) -> DataFrame:
    trail = F.col("post._contentMeta.trust.fieldData")
    return posted(data).select(
        "request_id",
        F.col("post.firstName").alias("first_name"),
        F.col("post.fullName").alias("full_name"),
        F.col("post.X_transparency_reporting_name").alias("transparency"),
        F.to_json("post.gender").alias("gender"),
        F.to_json("post.X_iqvia_title").alias("title"),
        F.to_json("post.X_informatica_Specialty").alias("specialties"),
        F.to_json("post.Qualification").alias("degrees"),
        F.to_json("post.AlternateIdentifier").alias("identifiers"),
        F.to_json("post.Phone").alias("phones"),
        F.size(trail).alias("trail_entries"),
        trail[0]["fieldRef"].alias("first_ref"),
        F.element_at(trail, -1)["fieldRef"].alias("last_ref"),
        F.element_at(trail, -1)["sourceLastUpdateDate"].alias("updated"),
    )


DOWNLOAD_JSON = f"""to_json(named_struct('firstName', source, 'lastName', lang,
  'X_third_party_id', 'T' || doc_id, 'gender', named_struct('Code', 'F'),
  '_meta', named_struct('id', 'M' || doc_id, 'state', 'ACTIVE'),
  'Phone', transform({LINES}, x -> named_struct('phoneNumber', x,
    'iso', CASE WHEN x LIKE '%,%' THEN upper(lang) END,
    'phoneType', CASE WHEN x LIKE '%e%' THEN named_struct('Code', 'M') END)),
  'X_hcp_address', array(named_struct('X_address_line_1', text, 'X_primary_flag', lang = 'en',
    'X_state', named_struct('Name', 'S'))),
  'X_informatica_Specialty', CASE lang WHEN 'fr' THEN array(named_struct(
    'X_informatica_specialtyClass', named_struct('Name', source))) END))"""


@query(
    "doc_08_download_phones",
    LINES_SQL
    + """SELECT request_id, i AS position, x AS number, CASE WHEN x LIKE '%,%' THEN upper(lang)
      ELSE '' END AS iso, CASE WHEN x LIKE '%e%' THEN 'M' ELSE '' END AS type_code,
      '' AS type_name, '' AS usage_code, '' AS extension FROM lines""",
)
def doc_08_phones(data: Data) -> DataFrame:
    docs = documents.reshape_download(built(data, f"{DOWNLOAD_JSON} AS response_json"))
    rows = unnest(docs, ["request_id"], "body.Phone", "p")
    return rows.select(
        "request_id",
        "position",
        F.col("p.Phone Number").alias("number"),
        F.col("p.ISO").alias("iso"),
        F.col("p.Phone Type.Code").alias("type_code"),
        F.col("p.Phone Type.Name").alias("type_name"),
        F.col("p.Phone Usage Type.Code").alias("usage_code"),
        F.col("p.Phone Number Extension").alias("extension"),
    )


@query(
    "doc_08_download_body",
    """SELECT doc_id AS request_id, source AS first_name, lang AS last_name, '' AS title,
      'T' || doc_id AS third_party, '{"Code":"F","Name":""}' AS gender, text AS address,
      lang = 'en' AS main, '{"Code":"","Name":"S"}' AS state,
      CASE lang WHEN 'fr' THEN 1 ELSE 0 END AS specialties,
      CASE lang WHEN 'fr' THEN source END AS class, 0 AS emails,
      'M' || doc_id || '|ACTIVE||T' || doc_id AS meta FROM documents""",
)
def doc_08_body(data: Data) -> DataFrame:
    docs = documents.reshape_download(built(data, f"{DOWNLOAD_JSON} AS response_json"))
    address = F.col("body.HCP Address")[0]
    meta = [F.col(f"body._meta.{m}") for m in ("id", "state", "validation", "sourcePrimaryKey")]
    return docs.select(
        "request_id",
        F.col("body.First Name").alias("first_name"),
        F.col("body.Last Name").alias("last_name"),
        F.col("body.Title").alias("title"),
        F.col("body.Third Party Id").alias("third_party"),
        F.to_json("body.Gender").alias("gender"),
        address["Address Line 1"].alias("address"),
        address["Primary Flag"].alias("main"),
        F.to_json(address["State/Province"]).alias("state"),
        F.size("body.Specialty").alias("specialties"),
        F.get("body.Specialty", F.lit(0))["Specialty Class"].alias("class"),
        F.size("body.Email").alias("emails"),
        F.concat_ws("|", *meta).alias("meta"),
    )


def nested_person(data: Data) -> DataFrame:
    """One nested model per text: its lines are addresses and, with a comma, phones."""
    empty = "array_remove(array(named_struct('code', '')), named_struct('code', ''))"
    lists = [
        f"{empty} AS {name}"
        for name in documents.PERSON_LISTS
        if name not in ("addresses", "phones")
    ]
    return data["documents"].selectExpr(
        "named_struct('individualEid', CAST(doc_id AS STRING), 'lastName', lang) AS individual",
        f"""transform({LINES}, x -> named_struct('individualEid', 'own', 'addressLine1', x,
          'city', source)) AS addresses""",
        f"""transform(filter({LINES}, x -> x LIKE '%,%'), x -> named_struct('phoneNumber', x))
          AS phones""",
        *lists,
    )


@query(
    "doc_09_child_addresses",
    LINES_SQL
    + """SELECT CAST(request_id AS STRING) AS "individualEid", i AS position,
      x AS "addressLine1", source AS city FROM lines""",
)
def doc_09_addresses(data: Data) -> DataFrame:
    tables = documents.split_children(
        nested_person(data), "individual", "individualEid", documents.PERSON_LISTS
    )
    return tables["addresses"]


@query(
    "doc_09_all_tables",
    LINES_SQL
    + """, c AS (SELECT 'individual' AS child, count(*) AS n FROM documents UNION ALL
      SELECT 'addresses', count(*) FROM lines UNION ALL
      SELECT 'phones', count(*) FILTER (WHERE x LIKE '%,%') FROM lines)
    SELECT child, n FROM c UNION ALL SELECT child, 0 FROM (VALUES ('alternativeNames'),
      ('identifiers'), ('specialties'), ('education'), ('tendencies'), ('originUniversity'),
      ('affiliations')) AS t(child)""",
)
def doc_09_all(data: Data) -> DataFrame:
    tables = documents.split_children(
        nested_person(data), "individual", "individualEid", documents.PERSON_LISTS
    )
    counts = [
        df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(t).alias("child"), "n")
        for t, df in tables.items()
    ]
    out = counts[0]
    for more in counts[1:]:
        out = out.unionAll(more)
    return out


#: List of the organization model -> the lines of a text that are its entries.
_ORGANIZATION_LINES = {
    "identifiers": "x LIKE '%.'",
    "addresses": "true",
    "specialties": "length(x) > 60",
    "phones": "x LIKE '%a%' AND x LIKE '%n%'",
    "alternativeNames": "x NOT LIKE '% %'",
    "relations": "x LIKE '%,%'",
}


_PLAIN_ENTRY = "named_struct('text', x)"


def nested_organization(data: Data) -> DataFrame:
    """One nested model per text: its lines are entries of all six lists."""
    entry = {
        "addresses": "named_struct('text', x, 'city', source)",
        "relations": "named_struct('organizationEid', 'own', 'parent', lang, 'text', x)",
    }
    lists = [
        f"transform(filter({LINES}, x -> {condition}), x -> "
        f"{entry.get(name, _PLAIN_ENTRY)}) AS {name}"
        for name, condition in _ORGANIZATION_LINES.items()
    ]
    return data["documents"].selectExpr(
        "named_struct('organizationEid', CAST(doc_id AS STRING), 'name', source) AS organization",
        *lists,
    )


@query(
    "doc_09_organization_relations",
    LINES_SQL
    + """SELECT "organizationEid", row_number() OVER (PARTITION BY "organizationEid" ORDER BY i) - 1
      AS position, parent, text FROM (SELECT CAST(request_id AS STRING) AS "organizationEid", i,
      lang AS parent, x AS text FROM (SELECT l.*, d.lang FROM lines l JOIN documents d
      ON d.doc_id = l.request_id) WHERE x LIKE '%,%')""",
)
def doc_09_relations(data: Data) -> DataFrame:
    tables = documents.split_children(
        nested_organization(data), "organization", "organizationEid", documents.ORGANIZATION_LISTS
    )
    return tables["relations"]


def _organization_sql() -> str:
    """Rows, and sums of positions and lengths, of every list."""
    parts = ["SELECT 'organization' AS child, count(*) AS n, 0 AS positions, 0 AS chars FROM documents"]
    parts += [
        f"SELECT '{name}', count(*), CAST(coalesce(sum(p), 0) AS BIGINT), CAST(coalesce(sum(length(x)), 0) "
        f"AS BIGINT) FROM (SELECT x, row_number() OVER (PARTITION BY request_id ORDER BY i) - 1 AS p "
        f"FROM lines WHERE {condition})"
        for name, condition in _ORGANIZATION_LINES.items()
    ]
    return LINES_SQL + " UNION ALL ".join(parts)


@query("doc_09_organization_tables", _organization_sql())
def doc_09_organization_tables(data: Data) -> DataFrame:
    tables = documents.split_children(
        nested_organization(data), "organization", "organizationEid", documents.ORGANIZATION_LISTS
    )
    none = F.lit(0).cast("bigint")
    counts = []
    for name, df in tables.items():
        held = name in documents.ORGANIZATION_LISTS
        positions = F.sum(F.col("position").cast("bigint")) if held else none
        chars = F.sum(F.char_length("text").cast("bigint")) if held else none
        counts.append(
            df.agg(
                F.count(F.lit(1)).alias("n"),
                F.coalesce(positions, none).alias("positions"),
                F.coalesce(chars, none).alias("chars"),
            ).select(F.lit(name).alias("child"), "n", "positions", "chars")
        )
    return reduce(DataFrame.unionAll, counts)
