"""Search before create over requests and responses built from whole texts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldrow.operators import search
from workload.base import Data, query
from workload.documents import LINES, LINES_SQL, PRIMARY_SCORE, built, primary_responses

MANDATORY = ("hcp.firstName", "hcp.lastName", "address.countryCode", "places.city")

# The last names of a request are the lines of its text; its places are absent, a list
# or an object by language.
PAYLOAD = f"""'{{"requestID":"R' || doc_id || '","clientName":"' || source || '"'
  || CASE lang WHEN 'en' THEN ',"hcp.firstName":"  Ann "' WHEN 'fr' THEN ',"hcp.firstName":" "'
       WHEN 'de' THEN ',"hcp.firstName":null' ELSE '' END
  || ',"hcp.lastName":' || to_json({LINES})
  || ',"hcp":{{"firstName":"Ann","lastName":' || to_json({LINES}) || ',"middleName":["B",null," "]}}'
  || CASE lang WHEN 'en' THEN ',"places":[{{"city":"A"}},{{"town":"x"}},{{"city":""}},{{"city":null}}]'
       WHEN 'fr' THEN ',"places":{{"city":"B"}}' WHEN 'de' THEN ',"places":[]'
       ELSE ',"places":[{{"town":"x"}}]' END
  || CASE lang WHEN 'en' THEN ',"mdmEntityType":" hcp "' WHEN 'fr' THEN ',"mdmEntityType":"HCO"'
       WHEN 'de' THEN ',"mdmEntityType":"  "' ELSE '' END
  || CASE lang WHEN 'en' THEN ',"hcp.specialty":["x"]' WHEN 'fr' THEN ',"hcp.specialty":"x"'
       ELSE ',"hcp.specialty":null' END
  || ',"hcp.email":"' || CASE lang WHEN 'en' THEN 'a@b' WHEN 'fr' THEN '@b' WHEN 'de' THEN ''
       ELSE 'ab@' END
  || '","address":{{"countryCode":' || CASE lang WHEN 'en' THEN '" nl"' WHEN 'fr' THEN '"be"'
       WHEN 'de' THEN '""' ELSE '"US"' END || ',"primary":"' || source || '","city":7}}'
  || ',"address.primary":["' || source || '"],"address.countryCode":"'
  || CASE lang WHEN 'en' THEN 'nl' ELSE 'be ' END
  || '"' || CASE lang WHEN 'es' THEN ',"address.country":"SPAIN"' ELSE '' END || '}}'""".replace(
    "{{", "{"
).replace("}}", "}")


def requests(data: Data) -> DataFrame:
    return built(data, f"{PAYLOAD} AS payload")


_NULL, _BLANK = "Null value for mandatory field: ", "Blank value for mandatory field: "


@query(
    "sbc_01_validation",
    LINES_SQL
    + f""", fixed(lang, field_path, error_type, message) AS (VALUES
      ('fr', 'hcp.firstName', 'BLANK', '{_BLANK}hcp.firstName'),
      ('de', 'hcp.firstName', 'NULL', '{_NULL}hcp.firstName'),
      ('de', 'address.countryCode', '-', '-'),
      ('en', 'places.city[2]', 'BLANK', '{_BLANK}places.city[2]'),
      ('en', 'places.city[3]', 'NULL', '{_NULL}places.city[3]'),
      ('de', 'places.city', 'MISSING', 'Missing mandatory field: places.city'),
      ('es', 'places.city', 'MISSING', 'Missing mandatory field: places.city'),
      ('fr', 'mdmEntityType', 'INVALID', 'mdmEntityType must be ''HCP'''),
      ('de', 'mdmEntityType', 'MISSING', 'mdmEntityType must be provided and should be HCP'),
      ('es', 'mdmEntityType', 'MISSING', 'mdmEntityType must be provided and should be HCP'),
      ('fr', 'hcp.specialty', 'INVALID_TYPE', 'hcp.specialty must be an array/list'),
      ('fr', 'hcp.email', 'INVALID_FORMAT', 'hcp.email must be a valid email address'),
      ('es', 'hcp.email', 'INVALID_FORMAT', 'hcp.email must be a valid email address'))
    SELECT doc_id AS request_id, field_path, error_type, message FROM documents
      JOIN fixed ON documents.lang = fixed.lang WHERE error_type <> '-'
    UNION ALL SELECT request_id, 'hcp.lastName[' || i || ']', 'BLANK',
      '{_BLANK}hcp.lastName[' || i || ']' FROM lines WHERE regexp_full_match(x, '\\s*')""",
)
def sbc_01(data: Data) -> DataFrame:
    checked = search.validate_search(requests(data), MANDATORY)
    return search.error_rows(checked, "request_id")


LOOKUP = """'{"mdmEntityType":"' || CASE lang WHEN 'en' THEN 'hcp' WHEN 'fr' THEN ' HCO ' WHEN 'de'
  THEN 'XYZ' ELSE ' ' END || '"' || CASE WHEN doc_id > 500 THEN ',"MdmHubId":"M"' ELSE '' END
  || CASE lang WHEN 'de' THEN ',"iqviaId":" "' ELSE ',"iqviaId":"' || source || '"' END
  || ',"externalId":null}'"""


@query(
    "sbc_02_lookup_validation",
    """WITH d AS (SELECT doc_id AS request_id, lang, CASE WHEN doc_id > 500 THEN 1 ELSE 0 END
      + CASE lang WHEN 'de' THEN 0 ELSE 1 END AS ids FROM documents)
    SELECT request_id, 'mdmEntityType' AS field_path, 'INVALID' AS error_type,
      'mdmEntityType must be ''HCP''' AS message FROM d WHERE lang = 'de'
    UNION ALL SELECT request_id, 'mdmEntityType', 'MISSING',
      'mdmEntityType is required and must be ''HCP''' FROM d WHERE lang = 'es'
    UNION ALL SELECT request_id, 'MdmHubId/iqviaId/externalId',
      CASE ids WHEN 0 THEN 'MISSING' ELSE 'INVALID' END, CASE ids
        WHEN 0 THEN 'One of MdmHubId, iqviaId or externalId must be provided'
        ELSE 'Only one of MdmHubId, iqviaId or externalId should be provided' END
      FROM d WHERE ids <> 1""",
)
def sbc_02(data: Data) -> DataFrame:
    checked = search.validate_lookup(built(data, f"{LOOKUP} AS payload"))
    return search.error_rows(checked, "request_id")


@query(
    "sbc_03_secondary_request",
    LINES_SQL
    + """, names AS (SELECT request_id, string_agg(x, '~' ORDER BY i) FILTER (WHERE NOT
        regexp_full_match(x, '\\s*')) AS last FROM lines GROUP BY 1)
    SELECT doc_id AS request_id, CASE lang
        WHEN 'de' THEN 'Missing mandatory field: address.countryCode for iqvia codBase mapping'
        WHEN 'es' THEN 'Unsupported country for iqvia codBase mapping: US' END AS error,
      CASE lang WHEN 'en' THEN 'WNL' WHEN 'fr' THEN 'WBE' END AS base,
      CASE WHEN lang IN ('en', 'fr') THEN 'EXACT|individual.firstName|Ann;'
        || 'Fuzzy|individual.middleName|B;Fuzzy|individual.lastName|' || last
        || ';Fuzzy|address.shortlabel|' || source || ';EXACT|address.country|'
        || CASE lang WHEN 'en' THEN 'nl' ELSE 'be' END
        || ';Fuzzy|address.villagelabel|7' END AS fields
    FROM documents JOIN names ON doc_id = request_id""",
)
def sbc_03(data: Data) -> DataFrame:
    built_requests = search.secondary_request(requests(data))
    text = F.transform(
        "request.fields",
        lambda f: F.concat_ws("|", f["method"], f["name"], F.concat_ws("~", f["values"])),
    )
    return built_requests.select(
        "request_id",
        "error",
        F.col("request.codBases")[0].alias("base"),
        F.when(F.col("request").isNotNull(), F.concat_ws(";", text)).alias("fields"),
    )


@query(
    "sbc_04_primary_request",
    """SELECT doc_id AS request_id, CASE lang WHEN 'en' THEN 'netherlands' WHEN 'es' THEN 'spain'
        ELSE 'belgium' END AS population,
      CASE lang WHEN 'en' THEN '  Ann ' WHEN 'fr' THEN ' ' ELSE '' END AS first_name,
      string_split(text, chr(10))[1] AS last_name, CASE lang WHEN 'en' THEN '  Ann  '
        WHEN 'fr' THEN '  ' ELSE '' END || string_split(text, chr(10))[1] AS full_name,
      source AS line_1, CASE lang WHEN 'en' THEN 'nl' ELSE 'be ' END AS country, '' AS city,
      '{"maxRecordsToReturn":"20","searchLevel":"Typical","fileRecordLimit":"1000","population":"'
        || CASE lang WHEN 'en' THEN 'netherlands' WHEN 'es' THEN 'spain' ELSE 'belgium' END
        || '"}' AS controls FROM documents""",
)
def sbc_04(data: Data) -> DataFrame:
    built_requests = search.primary_request(requests(data))
    record = F.col("request.data.searchRecord")
    address = record["X_hcp_address"][0]
    return built_requests.select(
        "request_id",
        F.col("request.searchControls.population").alias("population"),
        record["firstName"].alias("first_name"),
        record["lastName"].alias("last_name"),
        record["fullName"].alias("full_name"),
        address["X_address_line_1"].alias("line_1"),
        address["X_country"]["Code"].alias("country"),
        address["X_city"].alias("city"),
        F.to_json("request.searchControls").alias("controls"),
    )


# ------------------------------------------------------------------ result records

THRESHOLD = 95
SECONDARY_ID = """CASE WHEN x LIKE '%,%' THEN md5(x) WHEN x LIKE '% %' THEN 'X' || md5(x) END"""
SECONDARY_JSON = f"""to_json(named_struct('response', named_struct('results', transform({LINES},
  x -> named_struct('individual', named_struct('individualEid', {SECONDARY_ID},
    'lastName', x))))))"""

SEARCH_SQL = (
    LINES_SQL
    + f""", prim AS (SELECT request_id, i AS position, {PRIMARY_SCORE} AS score, x FROM lines),
  sec AS (SELECT request_id, i AS position, {SECONDARY_ID} AS record_id, x FROM lines),
  known AS (SELECT DISTINCT request_id, md5(x) AS record_id FROM lines
    WHERE x LIKE '%,%' AND length(x) > 50),
  flags AS (SELECT request_id, lang <> 'en' AS asked,
    max({PRIMARY_SCORE}) >= {THRESHOLD} AS has_high_score FROM lines GROUP BY request_id, lang),
  fresh AS (SELECT s.* FROM sec s LEFT JOIN known k ON s.request_id = k.request_id
    AND s.record_id = k.record_id WHERE k.record_id IS NULL),
  included AS (SELECT f.* FROM fresh f JOIN flags ON f.request_id = flags.request_id WHERE asked
    UNION ALL SELECT s.* FROM sec s JOIN flags ON s.request_id = flags.request_id
      WHERE NOT asked AND NOT has_high_score) """
)


def primary(data: Data) -> DataFrame:
    return search.primary_rows(primary_responses(data))


def secondary(data: Data) -> DataFrame:
    return search.secondary_rows(built(data, f"{SECONDARY_JSON} AS response_json"))


def asked(data: Data) -> DataFrame:
    return built(data, "lang <> 'en' AS search_secondary")


def last_name(column: str = "record"):
    return F.get_json_object(column, "$.individual.lastName").alias("x")


@query("jon_18_drop_known", SEARCH_SQL + "SELECT request_id, position, record_id, x FROM fresh")
def jon_18(data: Data) -> DataFrame:
    known = search.known_secondary_ids(primary(data))
    rows = search.drop_known(secondary(data), known)
    return rows.select("request_id", "position", "record_id", last_name())


@query(
    "jon_18_recounts",
    SEARCH_SQL + "SELECT request_id, count(*) AS total_records FROM fresh GROUP BY 1",
)
def jon_18_counts(data: Data) -> DataFrame:
    known = search.known_secondary_ids(primary(data))
    return search.result_counts(search.drop_known(secondary(data), known))


@query("sbc_05_high_score", SEARCH_SQL + "SELECT request_id, has_high_score FROM flags")
def sbc_05(data: Data) -> DataFrame:
    return search.high_score(primary(data), THRESHOLD)


@query(
    "sbc_06_conditional_fallback",
    SEARCH_SQL + "SELECT request_id, position, record_id, x FROM included",
)
def sbc_06(data: Data) -> DataFrame:
    rows = search.include_secondary(asked(data), primary(data), secondary(data), THRESHOLD)
    return rows.select("request_id", "position", "record_id", last_name())


@query(
    "sbc_07_combined_answer",
    SEARCH_SQL.rstrip()
    + f""", answer AS (SELECT request_id, 1 AS source_order, position, x FROM prim
      WHERE score >= {THRESHOLD} UNION ALL SELECT request_id, 2, position, x FROM included)
    SELECT *, count(*) OVER (PARTITION BY request_id) AS total_records FROM answer""",
)
def sbc_07(data: Data) -> DataFrame:
    high = primary(data).where(F.col("score") >= THRESHOLD)
    name = lambda c: F.col(c).alias("record")
    first = high.select("request_id", "position", name("record.data.fullName"))
    second = search.include_secondary(asked(data), primary(data), secondary(data), THRESHOLD)
    second = second.select("request_id", "position", last_name().alias("record"))
    return search.combine(first, second).withColumnRenamed("record", "x")


@query(
    "sbc_08_audit_rows",
    """SELECT 'R' || doc_id AS request_id, source AS initiated_by, CAST(n_chars AS BIGINT)
      AS response_time, lang = 'fr' AS searched_in_secondary, text AS primary_original_response,
      '{}' AS primary_structured_response, '{}' AS secondary_original_response,
      '{}' AS secondary_structured_response,
      '2024-01-31T10:00:00.000000+00:00' AS request_received_time FROM documents""",
)
def sbc_08(data: Data) -> DataFrame:
    rows = requests(data).join(
        data["documents"].selectExpr("doc_id AS request_id", "text", "n_chars"), "request_id"
    )
    start = "TIMESTAMP '2024-01-31 10:00:00'"
    none = "CAST(NULL AS STRING)"
    rows = rows.selectExpr(
        "payload",
        "CASE lang WHEN 'fr' THEN 'True' WHEN 'en' THEN 'no' END AS secondary_header",
        f"{start} AS received_at",
        f"{start} + make_dt_interval(0, 0, 0, CAST(n_chars AS DECIMAL(18, 6)) / 1000) AS sent_at",
        "text AS primary_original_response",
        f"{none} AS primary_structured_response",
        f"{none} AS secondary_original_response",
        f"{none} AS secondary_structured_response",
    )
    return search.audit_rows(rows).drop("request_payload", "response_sent_time").withColumn(
        "request_received_time", F.replace("request_received_time", F.lit("Z"), F.lit("+00:00"))
    )


ERROR_TEXT = """CASE lang WHEN 'en' THEN text
  WHEN 'fr' THEN to_json(named_struct('status', 404, 'errorCode', source, 'errorSummary', text,
    'errorDetail', named_struct('details', array(named_struct('code', 'D1', 'message', text)))))
  WHEN 'de' THEN to_json(named_struct('response', named_struct('errors', array(named_struct(
    'httpStatusCode', 503, 'message', text, 'details', source)))))
  ELSE '{"other":1}' END"""


@query(
    "sbc_09_error_documents",
    """SELECT doc_id AS request_id, CASE lang WHEN 'fr' THEN 404 WHEN 'de' THEN 503 ELSE 500 END
      AS status_code, CASE lang WHEN 'fr' THEN source END AS error_code,
      '[SEARCH] ' || CASE lang WHEN 'es' THEN '{"other":1}' ELSE text END AS message,
      CASE WHEN lang IN ('fr', 'de') THEN 1 ELSE 0 END AS details,
      CASE lang WHEN 'fr' THEN text WHEN 'de' THEN source END AS detail, true AS retryable,
      'error' AS answer_status FROM documents""",
)
def sbc_09(data: Data) -> DataFrame:
    rows = search.normalize_errors(built(data, f"{ERROR_TEXT} AS error_text"), "SEARCH")
    return search.structured_error(rows).select(
        "request_id",
        "status_code",
        "error_code",
        "message",
        F.size("details").alias("details"),
        F.get("details", F.lit(0))["message"].alias("detail"),
        "retryable",
        F.col("answer.status").alias("answer_status"),
    )
