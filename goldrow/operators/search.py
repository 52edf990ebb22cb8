"""Search before create, as a batch over requests and result records (SBC-01..09, JON-18).

Requests and responses are documents, one per row; result records are rows keyed by
request id. Deciding what a request returns is joins and flags per request, so no list
is gathered into one row.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldrow.functions.jsontext import parsed, step_path, variant_text
from goldrow.operators.documents import PRIMARY_SCHEMA, record_score
from goldrow.operators.schema import unnest
from goldrow.operators.skew import mark_known, spread_join
from goldrow.session import write_through

ERRORS = "array<struct<field_path: string, error_type: string, message: string>>"


def _error(path: Column | str, kind: str, message: Column | str) -> Column:
    lit = lambda v: v if isinstance(v, Column) else F.lit(v)
    return F.struct(
        lit(path).alias("field_path"),
        F.lit(kind).alias("error_type"),
        lit(message).alias("message"),
    )


def _present(errors: Sequence[Column]) -> Column:
    return F.filter(F.array(*errors), lambda e: e.isNotNull()).cast(ERRORS)


def _none() -> Column:
    return F.array().cast(ERRORS)


def _variant(v: Column, path: str) -> Column:
    return F.try_variant_get(v, path, "variant")


def _is(v: Column, kind: str) -> Column:
    return F.coalesce(F.startswith(F.schema_of_variant(v), F.lit(kind)), F.lit(False))


def _value_error(v: Column, path: Column) -> Column:
    """NULL or BLANK finding of one value, else null."""
    text = F.try_variant_get(v, "$", "string")
    return F.when(
        v.isNull() | F.is_variant_null(v),
        _error(path, "NULL", F.concat(F.lit("Null value for mandatory field: "), path)),
    ).when(
        _is(v, "STRING") & text.rlike(r"^\s*$"),
        _error(path, "BLANK", F.concat(F.lit("Blank value for mandatory field: "), path)),
    )


def _at_rest(rest: str) -> Callable[[Column, Column], Column]:
    """List element -> its position and the value it holds under the rest of a path."""
    return lambda x, i: F.struct(i.alias("i"), _variant(x, rest).alias("v"))


def _field_values(doc: Column, field: str, number: int) -> dict[str, Column]:
    """Columns holding what a mandatory field resolves to.

    ``_v`` is the value under the field's own name or at the end of its path. ``_l`` are
    the elements, with their positions, of a list the path meets on its way; no document
    has a list at two of the depths at once.
    """
    parts = field.split(".")
    value = F.coalesce(_variant(doc, step_path(field)), _variant(doc, step_path(*parts)))
    lists = [
        F.transform(
            F.try_variant_get(doc, step_path(*parts[:depth]), "array<variant>"),
            _at_rest(step_path(*parts[depth:])),
        )
        for depth in range(1, len(parts))
    ]
    nested = F.filter(F.coalesce(*lists), lambda e: e["v"].isNotNull()) if lists else None
    return {f"_v{number}": value} | ({} if nested is None else {f"_l{number}": nested})


def _mandatory(field: str, value: Column, nested: Column | None) -> Column:
    """Findings of one mandatory field, from the columns above."""
    at = lambda i: F.concat(F.lit(f"{field}["), i.cast("string"), F.lit("]"))

    def found_in(items: Column, check: Callable) -> Column:
        return F.filter(F.transform(items, check), lambda e: e.isNotNull()).cast(ERRORS)

    items = F.try_variant_get(value, "$", "array<variant>")
    empty = _error(field, "NULL", f"Null value for mandatory field: {field}")
    of_list = F.concat(
        F.when(F.size(items) == 0, F.array(empty).cast(ERRORS)).otherwise(_none()),
        found_in(items, lambda x, i: _value_error(x, at(i))),
    )
    found = F.when(_is(value, "ARRAY"), of_list).otherwise(
        _present([_value_error(value, F.lit(field))])
    )
    missing = F.array(_error(field, "MISSING", f"Missing mandatory field: {field}")).cast(ERRORS)
    out = F.when(value.isNotNull(), found)
    if nested is not None:
        checked = found_in(nested, lambda e: _value_error(e["v"], at(e["i"])))
        out = out.when(F.size(nested) > 0, checked)
    return out.otherwise(missing)


def _plain(doc: Column, key: str) -> Column:
    """Trimmed text of a top-level key, '' if missing."""
    return F.regexp_replace(
        F.coalesce(variant_text(doc, key), F.lit("")), r"^\s+|\s+$", ""
    )


def validate_search(
    requests: DataFrame, mandatory: Sequence[str], payload: str = "payload"
) -> DataFrame:
    """SBC-01: add ``errors``; a request is valid iff the array is empty.

    A mandatory field may be a key of that very name, a path through objects, or a path
    that meets a list on its way; then every element holding the rest of it is checked.
    """
    doc = F.col("_doc")
    entity, email = _plain(doc, "mdmEntityType"), _plain(doc, "hcp.email")
    specialty = _variant(doc, step_path("hcp.specialty"))
    # Messages of the general checks.
    general = [
        F.when(
            entity == "",
            _error(
                "mdmEntityType", "MISSING", "mdmEntityType must be provided and should be HCP"
            ),
        ).when(
            F.upper(entity) != "HCP",
            _error("mdmEntityType", "INVALID", "mdmEntityType must be 'HCP'"),
        ),
        F.when(
            specialty.isNotNull() & ~F.is_variant_null(specialty) & ~_is(specialty, "ARRAY"),
            _error("hcp.specialty", "INVALID_TYPE", "hcp.specialty must be an array/list"),
        ),
        F.when(
            (email != "")
            & (
                ~F.contains(email, F.lit("@"))
                | F.startswith(email, F.lit("@"))
                | F.endswith(email, F.lit("@"))
            ),
            _error("hcp.email", "INVALID_FORMAT", "hcp.email must be a valid email address"),
        ),
    ]
    values = {
        name: c
        for number, field in enumerate(mandatory)
        for name, c in _field_values(doc, field, number).items()
    }
    per_field = [
        _mandatory(f, F.col(f"_v{n}"), F.col(f"_l{n}") if f"_l{n}" in values else None)
        for n, f in enumerate(mandatory)
    ]
    return (
        requests.withColumn("_doc", parsed(F.col(payload)))
        .withColumns(values)
        .withColumn("errors", F.concat(*per_field, _present(general)))
        .drop("_doc", *values)
    )


def validate_lookup(requests: DataFrame, payload: str = "payload") -> DataFrame:
    """SBC-02: add ``errors``: known entity type and exactly one of three ids."""
    doc = F.col("_doc")
    entity = _plain(doc, "mdmEntityType")
    # Id keys and messages.
    ids = ("MdmHubId", "iqviaId", "externalId")
    given = sum(((_plain(doc, k) != "").cast("int") for k in ids), F.lit(0))
    path = "/".join(ids)
    errors = _present(
        [
            F.when(
                entity == "",
                _error(
                    "mdmEntityType", "MISSING", "mdmEntityType is required and must be 'HCP'"
                ),
            ).when(
                ~F.upper(entity).isin("HCP", "HCO"),
                _error("mdmEntityType", "INVALID", "mdmEntityType must be 'HCP'"),
            ),
            F.when(
                given == 0,
                _error(
                    path, "MISSING", "One of MdmHubId, iqviaId or externalId must be provided"
                ),
            ).when(
                given > 1,
                _error(
                    path,
                    "INVALID",
                    "Only one of MdmHubId, iqviaId or externalId should be provided",
                ),
            ),
        ]
    )
    return (
        requests.withColumn("_doc", parsed(F.col(payload)))
        .withColumn("errors", errors)
        .drop("_doc")
    )


# Secondary request, (path, target, method, precision), base per country.
SECONDARY_FIELDS = (
    ("hcp.firstName", "individual.firstName", "EXACT", 1),
    ("hcp.middleName", "individual.middleName", "Fuzzy", 1),
    ("hcp.lastName", "individual.lastName", "Fuzzy", 1),
    ("address.primary", "address.shortlabel", "Fuzzy", 1),
    ("address.countryCode", "address.country", "EXACT", 1),
    ("address.city", "address.villagelabel", "Fuzzy", 1),
    ("address.longPostalCode", "address.longPostalCode", "EXACT", 1),
    ("address.type", "address.type", "Fuzzy", 1),
)
COUNTRY_BASES = {"NL": "WNL", "BE": "WBE"}
COUNTRY_POPULATIONS = {"NL": "netherlands", "BE": "belgium"}


def _lookup(key: Column, values: dict[str, str]) -> Column:
    pairs = [F.lit(v) for item in values.items() for v in item]
    return F.try_element_at(F.create_map(*pairs), key)


def _values(v: Column) -> Column:
    """Non-blank values of a scalar or list; only a single text is trimmed."""
    text = F.try_variant_get(v, "$", "string")
    items = F.transform(
        F.try_variant_get(v, "$", "array<variant>"),
        lambda x: F.try_variant_get(x, "$", "string"),
    )
    kept = F.filter(items, lambda x: x.isNotNull() & ~x.rlike(r"^\s*$"))
    single = F.regexp_replace(text, r"^\s+|\s+$", "")
    empty = F.array().cast("array<string>")
    return (
        F.when(_is(v, "ARRAY"), kept)
        .when(text.isNull() | (single == ""), empty)
        .otherwise(F.array(single))
    )


def secondary_request(requests: DataFrame, payload: str = "payload") -> DataFrame:
    """SBC-03: add ``request`` (struct) or, where the country does not serve, ``error``."""
    doc = F.col("_doc")
    country_text = variant_text(doc, "address", "countryCode")
    country = F.upper(F.trim(F.coalesce(country_text, F.lit(""))))
    base = _lookup(country, COUNTRY_BASES)
    fields = [
        F.struct(
            F.lit(method).alias("method"),
            F.lit(target).alias("name"),
            _values(_variant(doc, step_path(*source.split(".")))).alias("values"),
            F.lit(precision).alias("fuzzyPrecision"),
        )
        for source, target, method, precision in SECONDARY_FIELDS
    ]
    # Request constants and error texts.
    request = F.struct(
        F.lit("20").alias("resultSize"),
        F.lit("Activity").alias("entityType"),
        F.array(base).alias("codBases"),
        F.filter(F.array(*fields), lambda f: F.size(f["values"]) > 0).alias("fields"),
    )
    error = F.when(
        country == "",
        F.lit("Missing mandatory field: address.countryCode for iqvia codBase mapping"),
    ).when(
        base.isNull(),
        F.concat(F.lit("Unsupported country for iqvia codBase mapping: "), country),
    )
    return (
        requests.withColumn("_doc", parsed(F.col(payload)))
        .withColumn("error", error)
        .withColumn("request", F.when(F.col("error").isNull(), request))
        .drop("_doc")
    )


def _pair(code: Column | str = "", name: Column | str = "") -> Column:
    lit = lambda v: v if isinstance(v, Column) else F.lit(v)
    return F.struct(lit(code).alias("Code"), lit(name).alias("Name"))


def primary_request(requests: DataFrame, payload: str = "payload") -> DataFrame:
    """SBC-04: add ``request``, the primary source's search document."""
    doc = F.col("_doc")

    def flat(key: str) -> Column:
        v = _variant(doc, step_path(key))
        first = F.get(F.try_variant_get(v, "$", "array<variant>"), F.lit(0))
        text = F.when(_is(v, "ARRAY"), F.try_variant_get(first, "$", "string")).otherwise(
            F.try_variant_get(v, "$", "string")
        )
        return F.coalesce(text, F.lit(""))

    first, middle, last = (flat(f"hcp.{k}") for k in ("firstName", "middleName", "lastName"))
    full = F.concat_ws(" ", F.filter(F.array(first, middle, last), lambda p: p != ""))
    code = flat("address.countryCode")
    country = flat("address.country")
    population = F.when(country != "", country).otherwise(
        F.coalesce(_lookup(F.upper(F.trim(code)), COUNTRY_POPULATIONS), F.lit(""))
    )
    blank = F.lit("")
    # The search template.
    record = F.struct(
        first.alias("firstName"),
        middle.alias("middleName"),
        full.alias("fullName"),
        last.alias("lastName"),
        blank.alias("X_vlkp_url"),
        blank.alias("X_informatica_department"),
        _pair().alias("gender"),
        _pair().alias("X_informatica_type"),
        _pair().alias("X_hcp_status"),
        F.array(F.struct(blank.alias("AlternateName"))).alias("AlternateName"),
        F.array(
            F.struct(
                flat("address.primary").alias("X_address_line_1"),
                flat("address.city").alias("X_city"),
                _pair().alias("X_state"),
                flat("address.longPostalCode").alias("X_postal_code"),
                _pair(code).alias("X_country"),
                blank.alias("X_primary_flag"),
                _pair(flat("address.type")).alias("X_address_type"),
                _pair().alias("X_address_status"),
            )
        ).alias("X_hcp_address"),
        F.array(
            F.struct(
                blank.alias("X_informatica_specialtyType"),
                _pair().alias("X_informatica_specialtyRank"),
                _pair().alias("X_specialty_status"),
            )
        ).alias("X_informatica_Specialty"),
        F.array(
            F.struct(
                blank.alias("X_informatica_licenseNumber"),
                blank.alias("X_informatica_licenseType"),
            )
        ).alias("X_informatica_License"),
        F.array(F.struct(blank.alias("X_informatica_deaNumber"))).alias("X_informatica_dea"),
        F.array(
            F.struct(
                _pair().alias("alternateIdentifierType"),
                blank.alias("alternateIdentifierValue"),
            )
        ).alias("AlternateIdentifier"),
        F.array(F.struct(blank.alias("phoneNumber"))).alias("Phone"),
        F.array(F.struct(blank.alias("taxNumber"), _pair().alias("taxNumberType"))).alias(
            "TaxDetail"
        ),
        F.array(F.struct(blank.alias("electronicAddress"))).alias("ElectronicAddress"),
    )
    request = F.struct(
        F.struct(
            F.lit("20").alias("maxRecordsToReturn"),
            F.lit("Typical").alias("searchLevel"),
            F.lit("1000").alias("fileRecordLimit"),
            F.lower(population).alias("population"),
        ).alias("searchControls"),
        F.struct(record.alias("searchRecord")).alias("data"),
    )
    return (
        requests.withColumn("_doc", parsed(F.col(payload)))
        .withColumn("request", request)
        .drop("_doc")
    )


def error_rows(checked: DataFrame, *keep: str) -> DataFrame:
    """Findings of a validation, one per row."""
    return unnest(checked, keep, "errors", "_error").select(*keep, "_error.*")


# ---------------------------------------------------------------- result records

KNOWN_ID_TYPE = "IQVIA ID"  # Fixed value: identifier type naming a secondary record.


def primary_rows(responses: DataFrame, document: str = "response_json") -> DataFrame:
    """Raw primary records as rows: request_id, position, score, record (struct)."""
    records = F.from_json(document, PRIMARY_SCHEMA)["searchResult"]["records"]
    rows = unnest(responses, ["request_id"], records)
    return rows.where(F.col("record").isNotNull()).withColumn("score", record_score(F.col("record")))


def secondary_rows(responses: DataFrame, document: str = "response_json") -> DataFrame:
    """Raw secondary records as rows: request_id, position, record_id, record (JSON text)."""
    schema = "response struct<results: array<string>>"
    results = F.from_json(document, schema)["response"]["results"]
    rows = unnest(responses, ["request_id"], results)
    return rows.withColumn(
        "record_id", F.get_json_object("record", "$.individual.individualEid")
    )


def known_secondary_ids(primary: DataFrame) -> DataFrame:
    """Secondary ids the primary records list: request_id, record_id.

    Here the identifier type is its code.
    """
    return _one_per_id(primary.select("request_id", _listed_ids()))


def _listed_ids() -> Column:
    """The secondary ids that a primary record lists, as ``record_ids``."""
    identifiers = F.coalesce("record.data.AlternateIdentifier", F.array())
    kind = lambda i: F.upper(F.trim(i["alternateIdentifierType"]["Code"]))
    value = lambda i: i["alternateIdentifierValue"]
    listed = F.filter(identifiers, lambda i: (kind(i) == KNOWN_ID_TYPE) & (value(i) != ""))
    return F.transform(listed, value).alias("record_ids")


def _one_per_id(primary: DataFrame) -> DataFrame:
    return primary.select("request_id", F.explode("record_ids").alias("record_id"))


def drop_known(
    secondary: DataFrame,
    known: DataFrame,
    *,
    pieces: int | None = None,
) -> DataFrame:
    """JON-18: secondary records whose id the request's primary records do not list.

    The records are stored first: they are read for their keys' counts and for the rows,
    and parsed once.
    """
    marked = mark_known(
        write_through(secondary, "secondary"),
        known,
        ["request_id", "record_id"],
        "_known",
        pieces=pieces,
    )
    return marked.where(~F.col("_known")).select(*secondary.columns)


def result_counts(records: DataFrame) -> DataFrame:
    """Records per request."""
    return records.groupBy("request_id").agg(F.count(F.lit(1)).alias("total_records"))


def high_score(primary: DataFrame, threshold: float) -> DataFrame:
    """SBC-05: request_id, has_high_score."""
    return primary.groupBy("request_id").agg(
        (F.max("score") >= F.lit(float(threshold))).alias("has_high_score")
    )


def include_secondary(
    requests: DataFrame,
    primary: DataFrame,
    secondary: DataFrame,
    threshold: float,
    *,
    pieces: int | None = None,
) -> DataFrame:
    """SBC-06: the secondary records that go into each request's answer.

    A request asking for both sources (``search_secondary``) gets all secondary records
    the primary ones do not already list. Any other gets all of them, and only if no
    primary record scores high enough.
    """
    options = {"pieces": pieces}
    # Parsed once; counts and joins read the stored rows.
    secondary = write_through(secondary, "secondary")
    primary = write_through(primary.select("request_id", "score", _listed_ids()), "primary")
    asked = requests.select(
        "request_id", F.coalesce("search_secondary", F.lit(False)).alias("_asked")
    )
    # One row per request on both sides, and then one row per request against records.
    flags = asked.join(high_score(primary, threshold), "request_id", "left")
    rows = spread_join(secondary, flags, ["request_id"], "inner", right_unique=True, **options)
    rows = mark_known(
        rows,
        _one_per_id(primary),
        ["request_id", "record_id"],
        "_known",
        left_source=secondary,
        **options,
    )
    high = F.coalesce("has_high_score", F.lit(False))
    keep = F.when(F.col("_asked"), ~F.col("_known")).otherwise(~high)
    return rows.where(keep).select(*secondary.columns)


def combine(
    primary: DataFrame,
    secondary: DataFrame,
    *,
    pieces: int | None = None,
) -> DataFrame:
    """SBC-07: a request's answer: primary records, then secondary, with their number.

    Both inputs have request_id, position and record. The order of the answer is
    (source_order, position); the records stay rows, so a long answer is no single row.
    """
    columns = ["request_id", "source_order", "position", "record"]
    both = (
        primary.withColumn("source_order", F.lit(1))
        .select(*columns)
        .unionByName(secondary.withColumn("source_order", F.lit(2)).select(*columns))
    )
    # Read for the rows, their number and their distribution; computed once.
    both = write_through(both, "answer")
    return spread_join(
        both,
        result_counts(both),
        ["request_id"],
        "inner",
        pieces=pieces,
        right_unique=True,
    )


def audit_rows(requests: DataFrame) -> DataFrame:
    """SBC-08: one audit row per request.

    Reads payload, secondary_header, received_at, sent_at and the four response texts;
    a response that was not fetched is '{}'.
    """
    top = F.from_json("payload", "map<string,string>")

    def of_payload(key: str) -> Column:
        return F.coalesce(top.getItem(key), F.lit(""))

    def text(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit("{}")).alias(name)

    elapsed = F.expr("unix_micros(sent_at) - unix_micros(received_at)")
    iso = lambda c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")
    return requests.select(
        of_payload("requestID").alias("request_id"),
        F.col("payload").alias("request_payload"),
        of_payload("clientName").alias("initiated_by"),
        iso("received_at").alias("request_received_time"),
        iso("sent_at").alias("response_sent_time"),
        (F.floor(elapsed / 1000)).cast("long").alias("response_time"),
        (F.lower(F.coalesce("secondary_header", F.lit(""))) == "true").alias(
            "searched_in_secondary"
        ),
        text("primary_original_response"),
        text("primary_structured_response"),
        text("secondary_original_response"),
        text("secondary_structured_response"),
    )


# ---------------------------------------------------------------- error documents

ERROR_SCHEMA = """
status string, errorCode string, errorSummary string,
errorDetail struct<details: array<struct<code: string, message: string,
  localizedMessage: string>>>,
response struct<errors: array<struct<httpStatusCode: string, message: string,
  details: string>>>
"""


def normalize_errors(df: DataFrame, api: str = "", document: str = "error_text") -> DataFrame:
    """SBC-09: add status_code, error_code, message, details and retryable.

    Text that is no JSON object becomes the summary itself.
    """
    text = F.col(document)
    e = F.col("_error")
    detail = F.get(e["errorDetail"]["details"], F.lit(0))
    error = F.get(e["response"]["errors"], F.lit(0))
    given = lambda c: F.when(F.coalesce(c, F.lit("")) != "", c)
    message = F.coalesce(given(e["errorSummary"]), given(error["message"]), text)
    details = F.array(
        F.struct(
            detail["code"].alias("code"),
            F.coalesce(given(detail["message"]), error["details"]).alias("message"),
            detail["localizedMessage"].alias("localizedMessage"),
        )
    )
    is_object = _is(parsed(text), "OBJECT")
    return (
        df.withColumn("_error", F.when(is_object, F.from_json(text, ERROR_SCHEMA)))
        .withColumn(
            "status_code",
            F.coalesce(
                given(e["status"]).try_cast("int"),
                given(error["httpStatusCode"]).try_cast("int"),
                F.lit(500),
            ),
        )
        .withColumn("error_code", e["errorCode"])
        .withColumn("message", F.concat(F.lit(f"[{api}] " if api else ""), message))
        .withColumn(
            "details",
            F.when(detail.isNotNull() | error.isNotNull(), details).otherwise(
                F.filter(details, lambda _: F.lit(False))
            ),
        )
        .withColumn("retryable", F.lit(True))
        .drop("_error")
    )


def structured_error(df: DataFrame, request_id: str = "request_id") -> DataFrame:
    """The error answer of a request, built from the columns above."""
    return df.withColumn(
        "answer",
        F.struct(
            F.lit("error").alias("status"),
            F.coalesce("status_code", F.lit(500)).alias("statusCode"),
            F.struct(
                F.coalesce("error_code", F.lit("")).alias("code"),
                F.coalesce("message", F.lit("")).alias("message"),
                F.col("details").alias("details"),
                F.col("retryable").alias("retryable"),
                F.col(request_id).alias("requestId"),
            ).alias("error"),
        ),
    )
