"""Nested search and download documents as column expressions (DOC-05..09).

One document per row. Each is parsed once with an explicit schema; arrays and maps are
walked with built-in higher-order functions, so no document is exploded and regrouped.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldrow.operators.schema import unnest

Struct = Mapping[str, object]


def _text(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def _joined(*parts: Column) -> Column:
    """Non-empty parts with one blank between them."""
    return F.concat_ws(" ", F.filter(F.array(*parts), lambda p: p != ""))


def _named(fields: Mapping[str, Column]) -> Column:
    return F.struct(*[c.alias(n) for n, c in fields.items()])


def _list(c: Column, each: Callable[[Column], Column]) -> Column:
    """``each`` over the elements that are structs; a missing list is an empty one."""
    return F.coalesce(F.transform(F.filter(c, lambda e: e.isNotNull()), each), F.array())


# --------------------------------------------------------------------------- DOC-05

SECONDARY_SCHEMA = """
response struct<results: array<struct<
  individual: struct<individualeId: string, firstName: string, middleName: string,
    lastName: string>,
  workplace: struct<workplaceAddresses: map<string, struct<
    typeCodeCorporateLabel: string,
    address: struct<addressLongLabel: string, longPostalCode: string,
      postalTownReference: struct<villageLabel: string,
        subdivisions: map<string, struct<externalId: string, longLocalizedLabel: string>>>>>>>
>>>
"""


def secondary_record(result: Column) -> Column:
    """One secondary-source result as a search record."""
    person = result["individual"]
    first, middle, last = (_text(person[k]) for k in ("firstName", "middleName", "lastName"))

    def address(wrapper: Column) -> Column:
        place = wrapper["address"]
        town = place["postalTownReference"]
        country = town["subdivisions"].getItem("COUNTRY")
        return _named(
            {
                "Address Line 1": _text(place["addressLongLabel"]),
                "City": _text(town["villageLabel"]),
                "State": F.lit(""),
                "Primary Flag": _text(wrapper["typeCodeCorporateLabel"]),
                "Postal Code": _text(place["longPostalCode"]),
                "Country": _named(
                    {
                        "Code": _text(country["externalId"]),
                        "Name": _text(country["longLocalizedLabel"]),
                    }
                ),
            }
        )

    none = F.lit(None).cast("string")
    # The two identifier stubs differ in the name of their value.
    stubs = F.array(
        _named(
            {
                "Identifier Type": F.lit(""),
                "Identifier Value": F.lit(""),
                "alternateIdentifierValue": none,
            }
        ),
        _named(
            {
                "Identifier Type": F.lit(""),
                "Identifier Value": none,
                "alternateIdentifierValue": F.lit(""),
            }
        ),
    )
    return _named(
        {
            "individualeId": _text(person["individualeId"]),
            "First Name": first,
            "Full Name": _joined(first, middle, last),
            "Last Name": last,
            "Gender": F.lit(""),
            "HCP Address": _list(
                F.map_values(result["workplace"]["workplaceAddresses"]), address
            ),
            "AlternateIdentifier": stubs,
        }
    )


def normalize_secondary(df: DataFrame, document: str = "response_json") -> DataFrame:
    """DOC-05: add ``records`` (array) and ``total_records`` of a secondary response."""
    doc = F.from_json(document, SECONDARY_SCHEMA)
    return (
        df.withColumn("_doc", doc)
        .withColumn("records", _list(F.col("_doc.response.results"), secondary_record))
        .withColumn("total_records", F.size("records"))
        .drop("_doc")
    )


# --------------------------------------------------------------------------- DOC-06

PRIMARY_SCHEMA = """
searchResult struct<records: array<struct<
  _meta: struct<businessId: string, score: double>,
  data: struct<firstName: string, fullName: string, lastName: string,
    gender: struct<Name: string>,
    X_hcp_address: array<struct<x_address_line_1: string, x_city: string,
      x_primary_flag: string, x_postal_code: string,
      x_country: struct<Code: string, Name: string>>>,
    AlternateIdentifier: array<struct<
      alternateIdentifierType: struct<Code: string, Name: string>,
      alternateIdentifierValue: string>>>
>>>
"""


def record_score(record: Column) -> Column:
    """Match score; a missing one counts as 0."""
    return F.coalesce(record["_meta"]["score"], F.lit(0.0))


def primary_record(record: Column) -> Column:
    data = record["data"]

    def address(a: Column) -> Column:
        return _named(
            {
                "Address Line 1": _text(a["x_address_line_1"]),
                "City": _text(a["x_city"]),
                "State": F.lit(""),
                "Primary Flag": _text(a["x_primary_flag"]),
                "Postal Code": _text(a["x_postal_code"]),
                "Country": a["x_country"],
            }
        )

    def identifier(i: Column) -> Column:
        return _named(
            {
                "Identifier Type": _text(i["alternateIdentifierType"]["Name"]),
                "Identifier Value": _text(i["alternateIdentifierValue"]),
            }
        )

    return _named(
        {
            "mdm_hubid": _text(record["_meta"]["businessId"]),
            "score": record_score(record),
            "First Name": _text(data["firstName"]),
            "Full Name": _text(data["fullName"]),
            "Last Name": _text(data["lastName"]),
            "Gender": _text(data["gender"]["Name"]),
            "HCP Address": _list(data["X_hcp_address"], address),
            "AlternateIdentifier": _list(data["AlternateIdentifier"], identifier),
        }
    )


def normalize_primary(
    df: DataFrame, threshold: float, document: str = "response_json"
) -> DataFrame:
    """DOC-06: add ``records`` scoring at least ``threshold`` and ``total_records``."""
    doc = F.from_json(document, PRIMARY_SCHEMA)
    kept = F.filter(
        F.col("_doc.searchResult.records"),
        lambda r: r.isNotNull() & (record_score(r) >= F.lit(float(threshold))),
    )
    return (
        df.withColumn("_doc", doc)
        .withColumn("records", _list(kept, primary_record))
        .withColumn("total_records", F.size("records"))
        .drop("_doc")
    )


# --------------------------------------------------------------------------- DOC-07

POST_SCHEMA = """
response struct<results: array<struct<
  country: string,
  activity: struct<isMainActivity: boolean>,
  individual: struct<individualId: string, firstName: string, middleName: string,
    lastName: string, usualFirstName: string, genderCode: string, typeCode: string,
    stateCode: string, prefixNameCode: string, titleCode: string, thesisYear: string,
    ada: map<string, struct<listCode: string, code: string, codeCorporateLabel: string>>,
    externalKeys: map<string, struct<value: string, typeLabel: string>>>,
  workplace: struct<workplaceId: string,
    workplaceAddresses: map<string, struct<typeCode: string, typeCodeCorporateLabel: string,
      address: struct<addressLongLabel: string, extensionLabel: string, longPostalcode: string,
        segmentations: map<string, struct<brickEid: string>>,
        postalTownReference: struct<villageLabel: string, dispatchLabel: string, country: string,
          subdivisions: map<string, struct<longLocalizedLabel: string>>>>>>,
    telephones: map<string, struct<typeCorporateLabel: string, callNumberForDisplay: string>>>
>>>
"""


def _code(c: Column) -> Column:
    return _named({"Code": _text(c)})


def _code_or_none(entry: Column) -> Column:
    """Code object of a map entry, null if the entry or its code is missing or empty."""
    return F.when(_text(entry["code"]) != "", _named({"Code": entry["code"]}))


def _specialties(ada: Column) -> Column:
    def each(entry: Column) -> Column:
        key, value = entry["key"], entry["value"]
        rank = F.when(F.contains(key, F.lit(",")), F.split_part(key, F.lit(","), F.lit(2)))
        rank = rank.otherwise(F.lit("1"))
        return _named(
            {
                "X_informatica_specialtyClass": _named(
                    {"Code": _text(value["code"]), "Name": _text(value["codeCorporateLabel"])}
                ),
                "X_informatica_specialtyRank": F.lit(None).cast("string"),
                "X_group_specialty": _code_or_none(
                    F.try_element_at(ada, F.concat(F.lit("1GS,"), rank))
                ),
                "X_global_specialty": _code_or_none(
                    F.try_element_at(ada, F.concat(F.lit("1SP,"), rank))
                ),
            }
        )

    return _list(F.filter(F.map_entries(ada), lambda e: e["value"]["listCode"] == "SP"), each)


def _identifiers(person: Column) -> Column:
    own = _named(
        {
            "alternateIdentifierValue": person["individualId"],
            # Type of the record's own identifier.
            "alternateIdentifierType": _named(
                {"Code": F.lit("iqvia ID"), "Name": F.lit("iqvia ID")}
            ),
        }
    )

    def each(entry: Column) -> Column:
        return _named(
            {
                "alternateIdentifierValue": _text(entry["value"]["value"]),
                "alternateIdentifierType": _named(
                    {"Code": entry["key"], "Name": _text(entry["value"]["typeLabel"])}
                ),
            }
        )

    # External key types taken over.
    wanted = F.filter(
        F.map_entries(person["externalKeys"]),
        lambda e: e["key"].isin("111", "121") & e["value"].isNotNull(),
    )
    return F.concat(F.array(own), _list(wanted, each))


def _result_addresses(result: Column) -> Column:
    """All addresses of one result, tagged with their id."""
    work = result["workplace"]
    main = F.coalesce(result["activity"]["isMainActivity"], F.lit(False))

    def each(entry: Column) -> Column:
        place = entry["value"]["address"]
        town = place["postalTownReference"]
        parts = town["subdivisions"]
        state = _text(parts.getItem("SUB.3")["longLocalizedLabel"])
        village = F.when(_text(town["villageLabel"]) != "", town["villageLabel"])
        address_id = F.concat(_text(work["workplaceId"]), F.lit("_"), entry["key"])
        return _named(
            {
                "id": address_id,
                "x_address_line_1": _text(place["addressLongLabel"]),
                "x_address_line_2": _text(place["extensionLabel"]),
                "x_city": F.coalesce(village, _text(town["dispatchLabel"])),
                "x_postal_code": _text(place["longPostalcode"]),
                "x_primary_flag": main,
                "x_country": _named(
                    {
                        "Code": _text(town["country"]),
                        "Name": _text(parts.getItem("COUNTRY")["longLocalizedLabel"]),
                    }
                ),
                "x_state": _named({"Code": state, "Name": state}),
                "x_address_type": _named(
                    {
                        "Code": _text(entry["value"]["typeCode"]),
                        "Name": _text(entry["value"]["typeCodeCorporateLabel"]),
                    }
                ),
                "x_brick_code": _text(place["segmentations"].getItem("UG1")["brickEid"]),
            }
        )

    return _list(F.map_entries(work["workplaceAddresses"]), each)


def first_per_id(df: DataFrame, column: str) -> DataFrame:
    """Keep the first element per ``id`` in an array column, in order.

    The array is sorted by (id, position) and each element compared with the one before
    it, so a long list costs n log n and not n squared.
    """
    tagged = F.transform(
        F.col(column), lambda x, i: F.struct(x["id"].alias("k"), i.alias("i"), x.alias("v"))
    )
    before = F.concat(
        F.array(F.lit(None).cast("string")), F.transform("_sorted", lambda x: x["k"])
    )
    pairs = F.arrays_zip(F.col("_sorted").alias("cur"), before.alias("prev"))
    firsts = F.filter(
        pairs, lambda p: p["cur"].isNotNull() & ~p["cur"]["k"].eqNullSafe(p["prev"])
    )
    back = F.array_sort(
        F.transform(firsts, lambda p: F.struct(p["cur"]["i"].alias("i"), p["cur"]["v"].alias("v")))
    )
    return (
        df.withColumn("_sorted", F.array_sort(tagged))
        .withColumn(column, F.transform(back, lambda x: x["v"]))
        .drop("_sorted")
    )


def _phones(result: Column) -> Column:
    def each(entry: Column) -> Column:
        fax = F.contains(F.lower(_text(entry["value"]["typeCorporateLabel"])), F.lit("fax"))
        kind = F.when(fax, F.lit("Fax")).otherwise(F.lit("Mobile"))
        return _named(
            {
                "id": F.concat(F.lit("ph_"), F.replace(entry["key"], F.lit(","), F.lit("_"))),
                "phoneNumber": _text(entry["value"]["callNumberForDisplay"]),
                "iso": _text(result["country"]),
                "phoneType": _named({"Code": kind, "Name": kind}),
            }
        )

    return _list(F.map_entries(result["workplace"]["telephones"]), each)


def build_post(df: DataFrame, updated_ms: Column, document: str = "response_json") -> DataFrame:
    """DOC-07: add ``post``, the document that creates a person in the hub.

    Person fields come from the first result, addresses from all of them with the first
    of every id kept, and one update entry is made per address, phone and document.
    """
    empty = F.array().cast("array<string>")
    parsed = df.withColumn("_results", F.from_json(document, POST_SCHEMA)["response"]["results"])
    parsed = parsed.withColumn("_first", F.get("_results", F.lit(0))).withColumn(
        "_addresses", F.flatten(_list(F.col("_results"), _result_addresses))
    )
    parsed = first_per_id(parsed, "_addresses").withColumn("_phones", _phones(F.col("_first")))

    person = F.col("_first")["individual"]
    first, middle, last = (_text(person[k]) for k in ("firstName", "middleName", "lastName"))
    whole = F.trim(F.concat(first, F.lit(" "), middle, F.lit(" "), last))
    usual, thesis = _text(person["usualFirstName"]), _text(person["thesisYear"])

    def entry(ref: Column) -> Column:
        return _named({"fieldRef": ref, "sourceLastUpdateDate": updated_ms})

    def refs(column: str, prefix: str) -> Column:
        return F.transform(
            F.col(column),
            lambda x: entry(F.concat(F.lit(f"{prefix}["), x["id"], F.lit("]"))),
        )

    degree = F.array(_named({"X_informatica_degreeYear": person["thesisYear"]}))
    post = _named(
        {
            "X_transparency_reporting_name": F.when(usual != "", usual).otherwise(whole),
            "firstName": first,
            "middleName": middle,
            "lastName": last,
            "fullName": whole,
            "gender": _code(person["genderCode"]),
            "X_informatica_type": _code(person["typeCode"]),
            "X_hcp_status": _code(person["stateCode"]),
            "X_iqvia_title": _code(person["titleCode"]),
            "prefixName": _code(person["prefixNameCode"]),
            "AlternateName": empty,
            "X_hcp_address": F.col("_addresses"),
            "Phone": F.col("_phones"),
            "X_informatica_Specialty": _specialties(person["ada"]),
            "Qualification": F.when(thesis != "", degree).otherwise(
                F.filter(degree, lambda _: F.lit(False))
            ),
            "X_informatica_License": empty,
            "X_informatica_dea": empty,
            "AlternateIdentifier": _identifiers(person),
            "ElectronicAddress": empty,
            "_contentMeta": _named(
                {
                    "trust": _named(
                        {
                            "fieldData": F.concat(
                                refs("_addresses", "x_hcp_address"),
                                refs("_phones", "x_phone"),
                                F.array(entry(F.lit("/"))),
                            )
                        }
                    )
                }
            ),
        }
    )
    return parsed.withColumn("post", post).drop("_results", "_first", "_addresses", "_phones")


# --------------------------------------------------------------------------- DOC-08

# Download shape. Text fields are (source key); "code" is a Code/Name pair,
# "name" the Name of such a pair, "flag" a boolean.
DOWNLOAD_LISTS = {
    "HCP Address": (
        "X_hcp_address",
        {
            "Address Line 1": "X_address_line_1",
            "Address Line 2": "X_address_line_2",
            "Address Line 3": "X_address_line_3",
            "City": "X_city",
            "Postal Code": "X_postal_code",
            "Primary Flag": ("flag", "X_primary_flag"),
            "Address Rank": "X_AddressRank",
            "Country": ("code", "X_country"),
            "State/Province": ("code", "X_state"),
            "Address Type": ("code", "X_address_type"),
            "Address Status": ("code", "X_address_status"),
            "Longitude": "X_longitude",
            "Latitude": "X_latitude",
            "Effective Date": "X_EffectiveDate",
            "End Date": "X_EndDate",
        },
    ),
    "Alternate Identifier": (
        "AlternateIdentifier",
        {
            "Identifier Value": "alternateIdentifierValue",
            "Identifier Type": ("code", "alternateIdentifierType"),
        },
    ),
    "Specialty": (
        "X_informatica_Specialty",
        {
            "Specialty Type": "X_informatica_specialtyType",
            "Specialty Class": ("name", "X_informatica_specialtyClass"),
            "Specialty Rank": ("code", "X_informatica_specialtyRank"),
            "Specialty Status": ("code", "X_specialty_status"),
            "Global Specialty": ("code", "X_global_specialty"),
            "Group Specialty": ("code", "X_group_specialty"),
        },
    ),
    "Alternate Name": (
        "AlternateName",
        {
            "Alternate Name": "AlternateName",
            "Alternate Name Type": ("name", "alternateNameType"),
            "Alternate Name Status": ("name", "X_alternate_name_status"),
        },
    ),
    "Phone": (
        "Phone",
        {
            "Phone Number": "phoneNumber",
            "Phone Number Extension": "X_phone_number_extension",
            "National Format": "nationalFormat",
            "International Format": "internationalFormat",
            "ISO": "iso",
            "Phone Status": "X_phone_status",
            "Primary Phone": "X_primary_phone",
            "Phone Type": ("code", "phoneType"),
            "Phone Usage Type": ("code", "X_phone_usage_type"),
            "Effective Start Date": "X_effective_start_date",
            "Effective End Date": "X_effective_end_date",
        },
    ),
    "License": (
        "X_informatica_License",
        {
            "License Number": "X_informatica_licenseNumber",
            "License Type": "X_informatica_licenseType",
        },
    ),
    "DEA": ("X_informatica_dea", {"DEA Number": "X_informatica_deaNumber"}),
    "Tax Details": (
        "TaxDetail",
        {"Tax Number": "taxNumber", "Tax Number Type": ("code", "taxNumberType")},
    ),
    "Email": (
        "ElectronicAddress",
        {
            "Email": "X_email",
            "Email Usage Type": "X_email_usage_type",
            "Email Status": "X_status",
            "Effective Start Date": "X_effective_start_date",
            "Effective End Date": "X_effective_end_date",
        },
    ),
}
DOWNLOAD_FIELDS = {
    "Title": "X_iqvia_title",
    "First Name": "firstName",
    "Middle Name": "middleName",
    "Full Name": "fullName",
    "Last Name": "lastName",
    "HCP Institution Name": "X_informatica_department",
    "VLKP URL": "X_vlkp_url",
    "Transparency Reporting Name": "X_transparency_reporting_name",
    "Third Party Id": "X_third_party_id",
    "Website": "X_informatica_website",
    "Gender": ("code", "gender"),
    "HCP Status": ("code", "X_hcp_status"),
    "Type": ("code", "X_informatica_type"),
    "Prefix Name": ("code", "prefixName"),
    "Suffix Name": ("code", "suffixName"),
    "Birth Date": "birthDate",
}
DOWNLOAD_META = (
    "id",
    "businessId",
    "businessEntity",
    "createdBy",
    "creationDate",
    "updatedBy",
    "lastUpdatedDate",
    "state",
    "consolidation",
    "searchIndex",
    "validation",
)

_READ_TYPES = {
    "text": "string",
    "flag": "boolean",
    "code": "struct<Code: string, Name: string>",
    "name": "struct<Name: string>",
}


def _kind(item: str | tuple[str, str]) -> tuple[str, str]:
    return ("text", item) if isinstance(item, str) else item


def _read_schema(fields: Struct) -> str:
    kinds = (_kind(item) for item in fields.values())
    return ", ".join(f"`{source}`: {_READ_TYPES[kind]}" for kind, source in kinds)


def _reshape(source: Column, fields: Struct) -> dict[str, Column]:
    out = {}
    for target, item in fields.items():
        kind, key = _kind(item)
        value = source[key]
        if kind == "code":
            out[target] = _named({"Code": _text(value["Code"]), "Name": _text(value["Name"])})
        elif kind == "name":
            out[target] = _text(value["Name"])
        elif kind == "flag":
            out[target] = F.coalesce(value, F.lit(False))
        else:
            out[target] = _text(value)
    return out


def _reshaper(fields: Struct) -> Callable[[Column], Column]:
    return lambda element: _named(_reshape(element, fields))


def download_schema() -> str:
    lists = [
        f"`{source}`: array<struct<{_read_schema(fields)}>>"
        for source, fields in DOWNLOAD_LISTS.values()
    ]
    meta = "_meta: struct<" + ", ".join(f"{m}: string" for m in DOWNLOAD_META) + ">"
    return f"struct<{', '.join([_read_schema(DOWNLOAD_FIELDS), *lists, meta])}>"


def reshape_download(df: DataFrame, document: str = "response_json") -> DataFrame:
    """DOC-08: add ``body``, the hub document under business names.

    A missing or null text gives '', a missing flag false, a missing list no elements.
    """
    base = df.withColumn("_doc", F.from_json(document, download_schema()))
    doc = F.col("_doc")
    fields = _reshape(doc, DOWNLOAD_FIELDS)
    for target, (source, spec) in DOWNLOAD_LISTS.items():
        fields[target] = _list(doc[source], _reshaper(spec))
    meta = {m: _text(doc["_meta"][m]) for m in DOWNLOAD_META}
    meta["sourcePrimaryKey"] = _text(doc["X_third_party_id"])
    fields["_meta"] = _named(meta)
    return base.withColumn("body", _named(fields)).drop("_doc")


# --------------------------------------------------------------------------- DOC-09

# Child lists of the nested models.
PERSON_LISTS = (
    "alternativeNames",
    "identifiers",
    "addresses",
    "specialties",
    "phones",
    "education",
    "tendencies",
    "originUniversity",
    "affiliations",
)
ORGANIZATION_LISTS = (
    "identifiers",
    "addresses",
    "specialties",
    "phones",
    "alternativeNames",
    "relations",
)


def split_children(
    df: DataFrame, parent: str, key: str, lists: tuple[str, ...]
) -> dict[str, DataFrame]:
    """DOC-09: parent struct and child lists as one flat table each.

    Child rows carry the parent's key under its own name and their position; a child's
    own copy of the key is dropped.
    """
    out = {parent: df.select(f"{parent}.*")}
    for name in lists:
        rows = unnest(df, [F.col(f"{parent}.{key}").alias(key)], name, "_child")
        fields = [f for f in rows.schema["_child"].dataType.names if f.lower() != key.lower()]
        out[name] = rows.select(key, "position", *[F.col(f"_child.`{f}`") for f in fields])
    return out
