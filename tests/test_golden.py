"""Known inputs and outputs: requests, documents, rules, readers, writers, ledger."""

from __future__ import annotations

import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from goldrow.functions import parse_timestamp
from goldrow.functions.temporal import TIMESTAMP_FORMATS
from goldrow.operators import (
    audit,
    canonical,
    dedup,
    documents,
    incremental,
    ingress,
    ledger,
    logs,
    quality,
    schema,
    search,
    standardize,
)
from goldrow.plans import catalog
from goldrow.plans.specs import DQRule, FieldMap, StandardizeRule
from goldrow.session import scratch_path
from goldrow.sinks import writers
from goldrow.sources import feeds, readers


def one_document(spark, document):
    return spark.createDataFrame([(1, json.dumps(document))], "request_id int, response_json string")


def payloads(spark, *documents_):
    rows = [(i, json.dumps(d)) for i, d in enumerate(documents_)]
    return spark.createDataFrame(rows, "request_id int, payload string")


# ------------------------------------------------------------------ catalogue


def test_catalogue_sizes():
    assert len(catalog.DQ_RULES) == 24 and len(catalog.REFERENCE_TABLE) == 22
    assert len(catalog.TYPED_INGRESS) == 56
    assert len(catalog.STAGING_VIEWS) + len(catalog.EMPTY_VIEWS) == 23
    assert len(catalog.PERSON_COLUMNS) + 1 == 27 and len(catalog.ORGANIZATION_COLUMNS) + 1 == 37
    assert len(catalog.PERSON_MASTER) == 24
    sizes = [len(c) for c in catalog.PERSON_CHILD_MASTERS.values()]
    assert sizes == [7, 19, 10, 5]
    assert len(catalog.PUBLISHED_STAGING) == 22 and len(catalog.PUBLISHED_MASTER) == 10
    assert [r.rule for r in catalog.rules_for("x.canonical.HCP_NAME_canonical")] == [
        "null_check",
        "name_address_completeness_check",
    ]


# ------------------------------------------------------------------ requests


def test_secondary_request_countries(spark):
    out = search.secondary_request(
        payloads(
            spark,
            {"address": {"countryCode": "NL"}, "hcp": {"firstName": " Ilse ", "lastName": [" A", ""]}},
            {"address": {"countryCode": "be"}},
            {"address": {"countryCode": "US"}},
            {},
        )
    ).orderBy("request_id").collect()
    assert out[0]["request"]["codBases"] == ["WNL"] and out[1]["request"]["codBases"] == ["WBE"]
    assert out[0]["request"]["resultSize"] == "20"
    fields = {f["name"]: (f["method"], f["values"]) for f in out[0]["request"]["fields"]}
    assert fields == {
        "individual.firstName": ("EXACT", ["Ilse"]),
        "individual.lastName": ("Fuzzy", [" A"]),
        "address.country": ("EXACT", ["NL"]),
    }
    assert out[2]["request"] is None and out[2]["error"].endswith("mapping: US")
    assert out[3]["error"].startswith("Missing mandatory field: address.countryCode")


def test_primary_request(spark):
    row = search.primary_request(
        payloads(
            spark,
            {
                "hcp.firstName": "Ilse",
                "hcp.middleName": "Q",
                "hcp.lastName": ["Brandt", "Unused"],
                "address.primary": "Elm Row 7",
                "address.countryCode": "NL",
                "address.city": "Zwolle",
                "address.longPostalCode": "8011ZZ",
                "address.type": "Visiting",
            },
        )
    ).first()["request"]
    record = row["data"]["searchRecord"]
    assert row["searchControls"]["population"] == "netherlands"
    assert record["fullName"] == "Ilse Q Brandt"
    address = record["X_hcp_address"][0]
    assert address["X_city"] == "Zwolle" and address["X_address_line_1"] == "Elm Row 7"
    assert address["X_country"]["Code"] == "NL" and address["X_postal_code"] == "8011ZZ"
    assert address["X_address_type"]["Code"] == "Visiting"


def test_validation_of_unreadable_payload(spark):
    rows = spark.createDataFrame([(1, "not json")], "request_id int, payload string")
    errors = search.validate_search(rows, ["hcp.firstName"]).first()["errors"]
    assert [(e["field_path"], e["error_type"]) for e in errors] == [
        ("hcp.firstName", "MISSING"),
        ("mdmEntityType", "MISSING"),
    ]


def test_validation_accepts_good_request(spark):
    good = {"mdmEntityType": "HCP", "hcp": {"firstName": "A"}, "hcp.email": "a@b.c"}
    assert search.validate_search(payloads(spark, good), ["hcp.firstName"]).first()["errors"] == []


# ------------------------------------------------------------------ documents


SECONDARY = {
    "country": "FI",
    "activity": {"isMainActivity": True},
    "individual": {
        "individualId": "P-77",
        "firstName": "Sanna",
        "middleName": "",
        "lastName": "Korpi",
        "genderCode": "F",
        "thesisYear": "1998",
        "ada": {
            "1SP,1": {"listCode": "SP", "code": "ZQ9", "codeCorporateLabel": "Hand medicine"},
            "1GS,1": {"code": "GRP"},
        },
        "externalKeys": {"111": {"value": "K-40", "typeLabel": "Register"}, "5": {"value": "unused"}},
    },
    "workplace": {
        "workplaceId": "W9",
        "workplaceAddresses": {
            "1": {
                "typeCode": "P",
                "typeCodeCorporateLabel": "Clinic",
                "address": {
                    "addressLongLabel": "Koivutie 4",
                    "longPostalcode": "70110",
                    "segmentations": {"UG1": {"brickEid": "BK8"}},
                    "postalTownReference": {
                        "villageLabel": "Kuopio",
                        "country": "FI",
                        "subdivisions": {
                            "COUNTRY": {"longLocalizedLabel": "Finland"},
                            "SUB.3": {"longLocalizedLabel": "Savo"},
                        },
                    },
                },
            }
        },
        "telephones": {"1": {"typeCorporateLabel": "Desk", "callNumberForDisplay": "017 55"}},
    },
}


def test_post_document(spark):
    doc = {"response": {"results": [SECONDARY, SECONDARY]}}
    row = documents.build_post(one_document(spark, doc), F.lit(5).cast("long")).first()["post"]
    assert row["fullName"] == "Sanna  Korpi" and row["X_transparency_reporting_name"] == "Sanna  Korpi"
    assert [a["id"] for a in row["X_hcp_address"]] == ["W9_1"]
    assert row["X_hcp_address"][0]["x_state"]["Name"] == "Savo"
    assert row["X_hcp_address"][0]["x_brick_code"] == "BK8"
    specialty = row["X_informatica_Specialty"][0]
    assert specialty["X_group_specialty"]["Code"] == "GRP"
    assert specialty["X_global_specialty"]["Code"] == "ZQ9"
    codes = [i["alternateIdentifierType"]["Code"] for i in row["AlternateIdentifier"]]
    assert codes == ["iqvia ID", "111"]
    assert row["Phone"][0]["phoneType"]["Code"] == "Mobile"
    assert row["Qualification"][0]["X_informatica_degreeYear"] == "1998"
    refs = [f["fieldRef"] for f in row["_contentMeta"]["trust"]["fieldData"]]
    assert refs == ["x_hcp_address[W9_1]", "x_phone[ph_1]", "/"]


def test_post_document_without_results(spark):
    row = documents.build_post(one_document(spark, {"response": {}}), F.lit(5).cast("long")).first()
    assert row["post"]["X_hcp_address"] == [] and row["post"]["firstName"] == ""
    assert len(row["post"]["_contentMeta"]["trust"]["fieldData"]) == 1


def test_written_post_reads_back(spark):
    """The download reads what the post wrote, identifiers and phones included."""
    doc = {"response": {"results": [SECONDARY]}}
    post = documents.build_post(one_document(spark, doc), F.lit(5).cast("long"))
    body = documents.reshape_download(post.select(F.to_json("post").alias("response_json")))
    row = body.first()["body"]
    assert row["Alternate Identifier"][0]["Identifier Value"] == "P-77"
    assert row["Phone"][0]["Phone Number"] == "017 55" and row["Email"] == []


def test_primary_threshold_and_missing_parts(spark):
    records = [{"_meta": {"score": 90}, "data": {"firstName": "A"}}, None, {"data": {}}]
    doc = {"searchResult": {"records": records}}
    row = documents.normalize_primary(one_document(spark, doc), 0).first()
    assert row["total_records"] == 2 and row["records"][1]["score"] == 0
    assert documents.normalize_primary(one_document(spark, doc), 50).first()["total_records"] == 1
    assert documents.normalize_primary(one_document(spark, {}), 50).first()["records"] == []


def test_secondary_without_addresses(spark):
    doc = {"response": {"results": [{"individual": {"firstName": "A", "lastName": "B"}}]}}
    record = documents.normalize_secondary(one_document(spark, doc)).first()["records"][0]
    assert record["Full Name"] == "A B" and record["HCP Address"] == []


def test_first_per_id_keeps_order(spark):
    ids = ["b", "a", "b", "c", "a"]
    rows = spark.createDataFrame([([(x, i) for i, x in enumerate(ids)],)], "xs array<struct<id: string, n: int>>")
    kept = documents.first_per_id(rows, "xs").first()["xs"]
    assert [(x["id"], x["n"]) for x in kept] == [("b", 0), ("a", 1), ("c", 3)]


def test_error_documents(spark):
    texts = ["plain", json.dumps({"status": 404, "errorSummary": "gone"}), "[1]", None]
    rows = spark.createDataFrame(list(enumerate(texts)), "request_id int, error_text string")
    out = search.normalize_errors(rows, "api").orderBy("request_id").collect()
    assert [(r["status_code"], r["message"]) for r in out[:3]] == [
        (500, "[api] plain"),
        (404, "[api] gone"),
        (500, "[api] [1]"),
    ]


# ------------------------------------------------------------------ quality and dedup


def test_person_name_gate(spark):
    names = spark.createDataFrame([("1", "Ann"), ("2", None), ("3", "Bo")], "iqvia_id string, first_name string")
    passed, rejected = quality.split(names, "null_check", "first_name")
    assert (passed.count(), rejected.count()) == (2, 1)


def test_two_rules_of_one_kind_are_counted_apart(spark):
    rows = spark.createDataFrame([(None, "x"), ("a", " "), ("a", "b")], "p string, q string")
    rules = [DQRule("t", "null_check", c, c, "t") for c in ("p", "q")]
    counts = quality.run_chain(rows, rules).rule_counts().orderBy("execution_order").collect()
    assert [(r["column_name"], r["record_count"]) for r in counts] == [("p", 1), ("q", 1)]


def test_rule_errors(spark):
    rows = spark.createDataFrame([("a",)], "p string")
    with pytest.raises(ValueError, match="no active rule"):
        quality.run_chain(rows, [])
    with pytest.raises(ValueError, match="unsupported rule"):
        quality.split(rows, "no_such_check", "p")
    with pytest.raises(ValueError, match="needs a reference"):
        quality.split(rows, "mdr_check", "p")
    with pytest.raises(ValueError, match="not found"):
        quality.split(rows, "null_check", "gone")
    with pytest.raises(ValueError, match="no parent key"):
        quality.split(rows, "mdr_check", "p", rows)


def test_written_outcome_is_the_same(spark):
    rows = spark.createDataFrame([(None,), ("a",)], "p string")
    result = quality.run_chain(rows, [DQRule("t", "null_check", "d", "p", "t")]).written()
    assert (result.staged.count(), result.rejected.count()) == (1, 1)


def test_all_null_batches_are_not_filtered(spark):
    rows = spark.createDataFrame([(1, None), (2, None)], "k int, Batch_ID long")
    assert quality.choose_batch(rows).count() == 2
    some = spark.createDataFrame([(1, 5), (2, 7), (3, None)], "k int, Batch_ID long")
    assert [r["k"] for r in quality.choose_batch(some).collect()] == [2]
    assert quality.choose_batch(some, 5).count() == 1


def test_latest_per_key(spark):
    rows = spark.createDataFrame(
        [("a", 1, "x"), ("a", 3, "y"), ("a", 3, "z"), ("b", None, "n"), (None, 1, "q")],
        "k string, LOAD_DATE int, v string",
    )
    got = {(r["k"], r["v"]) for r in dedup.latest_per_key(rows, "K").collect()}
    assert got == {("a", "z"), ("b", "n"), (None, "q")}
    assert dedup.latest_per_key(rows, None).count() == 5
    assert dedup.parse_keys(" a, b c,,") == ["a", "b", "c"]
    with pytest.raises(ValueError, match="none of the key columns"):
        dedup.latest_per_key(rows, "gone")


# ------------------------------------------------------------------ standardize, map


def test_unknown_rule_lists_the_known(spark):
    rows = spark.createDataFrame([("a",)], "p string")
    with pytest.raises(ValueError, match="normalize_phone"):
        standardize.standardize(rows, [StandardizeRule("shout", "p")])


def test_rules_from_control_table(spark):
    config = spark.createDataFrame(
        [("s", "trim", "p", "true"), ("s", "upper", "p", "FALSE"), ("t", "lower", "p", "TRUE")],
        "source_identifier string, rule_function string, column_name string, rule_status string",
    )
    assert standardize.active_rules(config, "s") == [StandardizeRule("trim", "p")]


def test_mapping_is_not_consumed(spark):
    first = ingress.field_mapping("hcp_name")
    first.clear()
    assert len(ingress.field_mapping("staging.HCP_NAME")) == 12
    camel = ingress.field_mapping("hcp_address", "camel")
    assert "json:addresses[0].city" in camel


def test_camel_dialect(spark):
    doc = {"addresses": [{"addressLine1": "L", "city": "C"}]}
    rows = spark.createDataFrame([("1", json.dumps(doc))], "iqvia_id string, response_json string")
    mapped = ingress.map_fields(rows, ingress.field_mapping("hcp_address", "camel")).first()
    assert (mapped["X_hcp_address"], mapped["X_hcp_city"]) == ("L", "C")


def test_mapping_errors(spark):
    rows = spark.createDataFrame([("a",)], "p string")
    with pytest.raises(ValueError, match="no mapped column"):
        ingress.map_fields(rows, {"gone": "x"})
    with pytest.raises(ValueError, match="no physical target"):
        ingress.typed_targets(rows.toDF("HCO_Name"), "hco_name", {})
    with pytest.raises(ValueError, match="no usable mapping"):
        canonical.projection([FieldMap("a", "load_date")])


def test_projection_keeps_types_of_dates():
    got = canonical.projection([FieldMap("n.birth_date", "b"), FieldMap("n.x", "x"), FieldMap(None, "z")])
    assert got == ["n.birth_date AS `b`", "CAST(n.x AS STRING) AS `x`", "CAST(NULL AS STRING) AS `z`"]
    rows = [FieldMap("a", "b", "J2"), FieldMap("a", "c", "J1"), FieldMap("a", "d", "J2")]
    assert canonical.join_fragments(rows) == ["J2", "J1"]


def test_timestamp_guards_change_nothing(spark):
    texts = ["2024-01-01 00:00:07", "2024-01-01T00:00:07.123+02:00", "01/02/2024 03:04:05.123456"]
    texts += ["01/02/2024 03:04:05", "2024-01-01", "1/2/2024 03:04:05", "", None, "2024-01-01 0:0:7"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    plain = F.coalesce(*[F.try_to_timestamp("t", F.lit(f)) for f in TIMESTAMP_FORMATS])
    assert rows.where(~parse_timestamp(F.col("t")).eqNullSafe(plain)).count() == 0


def test_full_load_ignores_the_configured_filter(spark):
    rows = spark.createDataFrame([(1,), (2,)], "x int")
    got = incremental.incremental_window(
        rows, full_load=True, load_type="delta", date_column="", start=datetime(2024, 1, 1),
        end=datetime(2024, 1, 2), condition="x = 1",
    )
    assert got.count() == 2


# ------------------------------------------------------------------ readers, feeds


def test_reader_errors_and_absent_files(spark):
    folder = scratch_path(spark, "reader")
    spark.range(3).write.csv(f"{folder}/feed.csv")
    spec = readers.SourceSpec("file", folder, "feed_YYYYMMDDHHMMSS.csv")
    assert readers.read_source(spark, spec) is None
    assert readers.read_source(spark, readers.SourceSpec("file", folder, "feed.csv")).count() == 3
    assert readers.newest_file(spark, f"{folder}/none", "x") is None
    with pytest.raises(ValueError, match="unsupported source kind"):
        readers.read_source(spark, readers.SourceSpec("ftp", folder))
    with pytest.raises(ValueError, match="unsupported file format"):
        readers.read_file(spark, folder, "xml")


def test_json_documents_of_all_shapes(spark, tmp_path):
    (tmp_path / "list.json").write_text('[{"a": 1}, {"a": null, "b": {"c": 2}}]')
    (tmp_path / "data.json").write_text('{"data": [{"a": 1.50}, {"a": true}], "total": 2}')
    (tmp_path / "single.json").write_text('{"a": "x"}')
    rows = readers.read_documents(spark, str(tmp_path))
    got = sorted((r["a"], r["b"]) for r in rows.na.fill("-").select("a", "b").collect())
    assert got == [("-", '{"c":"2"}'), ("1", "-"), ("1.50", "-"), ("true", "-"), ("x", "-")]


def test_feed_presence_is_not_value(spark):
    docs = ['{"First Name":null,"Last Name":"L"}', '{"Last Name":"L"}', "{}", "bad"]
    rows = spark.createDataFrame(
        [(str(i), "HCP", "NL", d) for i, d in enumerate(docs)],
        "entity_id string, entity_type string, country_code string, response_json string",
    )
    out = feeds.feed_to_raw(rows, "HCP", datetime(2024, 1, 2, 3, 4, 5)).collect()
    assert len(out) == 1 and out[0]["first_name"] is None and out[0]["title"] == ""
    assert out[0]["batch_id"] == "API_HCP_20240102_030405"


# ------------------------------------------------------------------ writers, ledger, reports


def test_write_modes():
    assert writers.write_mode(False, "delta") == "overwrite"
    assert writers.write_mode(True, "overwrite") == "overwrite"
    assert writers.write_mode(True, "delta", "yes") == "overwrite"
    assert writers.write_mode(True, "delta", "no") == "append"


def test_empty_overwrite_keeps_the_table(spark):
    path = scratch_path(spark, "keep")
    rows = spark.createDataFrame([(1, 1)], "x int, batch_id int")
    assert writers.write_table(rows, path, "overwrite") == 1
    assert writers.write_table(rows.where("false"), path, "overwrite") == 0
    assert writers.read_layer(spark, path).count() == 1
    with pytest.raises(ValueError, match="unsupported write mode"):
        writers.write_table(rows, path, "merge")


def test_publish_replaces_clears_and_survives_failure(spark):
    path = scratch_path(spark, "publish")
    rows = spark.range(4)
    assert writers.publish(rows, path, "1") == {"source_rows": 4, "deleted_rows": 0, "inserted_rows": 4}
    broken = rows.select(F.raise_error(F.lit("broken")).cast("string").alias("id"))
    with pytest.raises(Exception, match="broken"):
        writers.publish(broken, path, "2")
    assert writers.read_published(spark, path).count() == 4
    assert writers.publish(rows.where("false"), path, "3")["deleted_rows"] == 4
    assert writers.read_published(spark, path).count() == 0
    with pytest.raises(ValueError, match="nothing published"):
        writers.read_published(spark, scratch_path(spark, "none"))


def test_publish_set_totals(spark):
    root = scratch_path(spark, "set")
    names = {"a": "A", "b": "B"}
    results = writers.publish_all(spark, {"a": spark.range(3)}, names, root, "1")
    row = writers.publish_totals(results).first()
    assert (row["tables_synced"], row["total_rows"], row["errors"]) == (1, 3, 1)


def test_snapshot_entities(spark):
    path = writers.snapshot(spark.range(1), scratch_path(spark, "snap"), "HCO", date(2024, 2, 3))
    assert path.endswith("HCO_SNAPSHOT_20240203")
    with pytest.raises(ValueError, match="HCP or HCO"):
        writers.snapshot(spark.range(1), "x", "PET", date(2024, 2, 3))


def test_align_gives_the_target_schema(spark):
    target = spark.createDataFrame([], "A int, b string, batch_id int").schema
    got = schema.align(spark.createDataFrame([("1", "x", "9")], "a string, c string, BATCH_ID string"), target)
    assert got.columns == ["A", "b", "batch_id"]
    assert got.first().asDict() == {"A": 1, "b": None, "batch_id": 9}


def test_gate_names(spark):
    assert ledger.status_column("RawIngestion") == "raw_ingestion_status"
    assert ledger.status_column("other") == "other"
    with pytest.raises(ValueError, match="unsupported stage"):
        ledger.gate("publish")


def test_copy_check_fails_on_mismatch(spark):
    counts = "table_name string, row_count long"
    good = spark.createDataFrame([("A", 1), ("B", 2)], counts)
    audit.assert_copied(audit.verify_copy(good, good))
    bad = spark.createDataFrame([("A", 1), ("B", 3)], counts)
    with pytest.raises(RuntimeError, match="0 errors, 1 mismatches"):
        audit.assert_copied(audit.verify_copy(good, bad))


def test_stage_event(spark):
    outcome = spark.range(7).agg(F.count("id").alias("sub_module"))
    row = logs.stage_event(
        outcome, start_time=datetime(2024, 1, 1), end_time=datetime(2024, 1, 1, 0, 1), module="dq"
    ).first()
    assert row["sub_module"] == "7"
    assert row["time_elapsed"] == 60.0 and row["module"] == "dq" and row["run_id"] is None
    assert len(row) == 14
    with pytest.raises(ValueError, match="unknown stage log"):
        logs.stage_event(
            outcome, start_time=datetime(2024, 1, 1), end_time=datetime(2024, 1, 1), x=""
        )


@pytest.mark.parametrize("table", ["hcp_address", "hcp_specialty", "hcp_alternate_name", "hcp_phone"])
def test_document_fields_reach_the_ingress(spark, table):
    """No field that the derived documents carry is lost on the way."""
    from goldrow.operators import ingress
    from workload import Data
    from tests.conftest import SMALL

    rows = ingress.map_fields(Data(spark, SMALL)[table], ingress.field_mapping(table))
    filled = rows.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in rows.columns]).first().asDict()
    assert not [c for c, n in filled.items() if n == 0 and c != "Qualification"]
