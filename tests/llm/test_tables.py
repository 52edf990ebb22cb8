"""Vectors, archives, the registered queries and the pipeline."""

from __future__ import annotations

import base64
import hashlib
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from goldrow.llm import queries, vectors, warc
from goldrow.session import scratch_path
from tests.conftest import SMALL


def planted(spark):
    """Vectors with copies, scaled copies, near ones, a dense group, and unusable ones."""
    rng = np.random.default_rng(4)
    rows, number = [], 0
    for label in (0, 1, None):
        for _ in range(30):
            v = rng.normal(size=12)
            for k in range(int(rng.integers(1, 4))):
                rows.append((number, (v + 0.12 * k * rng.normal(size=12)).tolist(), label))
                number += 1
    centre = rng.normal(size=12)
    for _ in range(60):
        rows.append((number, (centre + 0.03 * rng.normal(size=12)).tolist(), 1))
        number += 1
    for again in (rows[0][1], [3 * x for x in rows[0][1]], [0.0] * 12, None, [], [float("nan")] * 12):
        rows.append((number, again, 0))
        number += 1
    rows += [(number, [float("inf")] + [1.0] * 11, 0), (number + 1, [None] * 12, 0)]
    rows += [(number + 2, rows[5][1][:6], 0), (number + 3, [1e-200] * 12, 1), (number + 4, [1e200] * 12, 1)]
    return rows


def brute(rows):
    ok = [
        (i, np.array(v, float), label)
        for i, v, label in rows
        if label is not None and v and None not in v and np.isfinite(v).all() and np.any(v)
    ]
    links = {i: set() for i, _, _ in rows}
    for i, v, a in ok:
        for j, w, b in ok:
            if i != j and a == b and len(v) == len(w):
                x, y = v / np.abs(v).max(), w / np.abs(w).max()
                if x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.93:
                    links[i].add(j)
    component = {i: i for i in links}
    changed = True
    while changed:
        changed = False
        for i, others in links.items():
            least = min([component[i], *(component[j] for j in others)])
            changed |= least != component[i]
            component[i] = least
    return {i: (len(links[i]), component[i], component[i] == i) for i in links}


@pytest.mark.parametrize(
    "options",
    [{}, {"cell_rows": 12, "block_rows": 7}, {"cell_rows": 20, "max_pivots": 5, "block_rows": 50}],
)
def test_range_join_equals_brute_force(spark, options):
    rows = planted(spark)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = vectors.near_duplicates(df.withColumn("weight", F.lit("mine")), **options).collect()
    want = brute(rows)
    assert {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in got} == want
    assert sum(n for n, _, _ in want.values()) > 3000


def test_range_join_of_odd_tables(spark):
    kinds = "vec_id long, embedding array<float>, label int"
    assert vectors.near_duplicates(spark.createDataFrame([], kinds)).count() == 0
    same = spark.createDataFrame([(1, [1.0, 2.0], 3), (1, [1.0, 2.0], 3), (None, [1.0, 2.0], 3)], kinds)
    rows = [(r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in vectors.near_duplicates(same).collect()]
    assert sorted(rows, key=repr) == [(1, 1, 1, True), (1, 1, 1, True), (None, 0, None, True)]


def test_one_id_with_two_vectors(spark):
    """Each row has the links of its own vector."""
    kinds = "vec_id long, embedding array<double>, label int"
    rows = [(1, [1.0, 0.0], 0), (1, [0.0, 1.0], 0), (2, [1.0, 0.01], 0), (0, [0.02, 1.0], 0), (0, [5.0, 0.0], 1)]
    df = spark.createDataFrame(rows, kinds).selectExpr("*", "1 AS id", "2 AS cell", "3 AS home", "4 AS first")
    got = sorted(tuple(r) for r in vectors.near_duplicates(df).collect())
    assert got == [(0, 0, 0, True), (0, 1, 0, True), (1, 1, 0, False), (1, 1, 1, True), (2, 1, 1, False)]


@pytest.fixture
def archive(spark):
    pages = [
        (3, "http://a/ b\r\nX: y", "<p>one</p>"),
        (1, None, "<p>one</p>"),
        (2, "http://c", None),
        (5, "http://d", ""),
        (4, "http://e", "WARC/1.1\r\nWARC-Type: response\r\n\r\nné 😀\r\n\r\n"),
        (6, "http://f", "<p>ONE</p>"),
        (6, "http://f", "<p>ONE</p>"),
        (None, "http://g", "<p>one</p>"),
        (7, "http://long", "x" * 3_000_000),
    ]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    path = scratch_path(spark, "archive")
    warc.write_warc(df.withColumn("digest", F.lit("mine")), path)
    return pages, path


def test_archive_round_trip(spark, archive):
    pages, path = archive
    records = warc.read_warc(spark, path, verify="true")
    rows = warc.page_columns(records).collect()
    kind = {r["page_id"]: (r["record_type"], r["refers_to"]) for r in rows}
    assert kind == {
        1: ("response", None), 3: ("revisit", 1), None: ("revisit", 1), 2: ("response", None),
        5: ("revisit", 2), 4: ("response", None), 6: ("response", None), 7: ("response", None),
    }
    assert len(rows) == len(pages)
    html = {p: (h or "").encode() for p, _, h in pages}
    for r in rows:
        data = html[r["page_id"]]
        assert r["payload_bytes"] == len(data)
        assert r["payload_digest"] == base64.b32encode(hashlib.sha1(data).digest()).decode()
    stored = {r["headers"].get("warc-x-page-id"): r["payload"] for r in records.collect()}
    assert bytes(stored["4"]) == html[4] and stored["3"] is None


def test_predicates_reach_the_reader(spark, archive):
    _, path = archive
    columns = "record_type string, target_uri string, payload_bytes bigint"
    revisits = warc.read_warc(spark, path, columns).where("record_type = 'revisit'")
    assert not re.search(r"\bFilter\b", revisits._jdf.queryExecution().executedPlan().toString())
    assert revisits.count() == 3
    assert warc.read_warc(spark, path, columns).where("target_uri IN ('http://c', 'http://e')").count() == 2
    digest = base64.b32encode(hashlib.sha1(b"<p>ONE</p>").digest()).decode()
    assert warc.read_warc(spark, path).where(F.col("payload_digest") == digest).count() == 2
    by_header = warc.read_warc(spark, path, columns, **{"header.WARC-Target-URI": "http://c"})
    assert by_header.count() == 1
    reader = warc.WarcReader(by_header.schema, {"path": path})
    assert "payload" not in reader.columns and len(reader.partitions()) >= 1


def test_small_payloads_are_stored_again(spark):
    df = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab")], "page_id long, url string, html string")
    path = scratch_path(spark, "small")
    warc.write_warc(df, path, min_bytes=3)
    rows = warc.page_columns(warc.read_warc(spark, path)).collect()
    assert {r["record_type"] for r in rows} == {"response"}
    empty = scratch_path(spark, "none")
    warc.write_warc(df.where("false"), empty)
    assert warc.read_warc(spark, empty).count() == 0


def test_damage_is_found(spark, archive):
    _, path = archive
    stored = spark.read.text(path, wholetext=True)
    broken = scratch_path(spark, "broken")
    stored.select(F.regexp_replace("value", "<p>one", "<p>two").alias("value")).write.text(broken)
    assert warc.read_warc(spark, broken).count() > 0
    with pytest.raises(Exception, match="was changed"):
        warc.read_warc(spark, broken, verify="true").collect()


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_queries_equal_their_sql(spark, name):
    connection = duckdb.connect()
    for table in ("pages", "embeddings", "documents", "conversations"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    result = connection.execute(queries.SQL[name])
    names = [d[0] for d in result.description]
    df = queries.QUERIES[name](spark, SMALL)
    assert sorted(df.columns) == sorted(names)
    assert sorted(map(tuple, df.select(*names).collect()), key=repr) == sorted(
        result.fetchall(), key=repr
    )


COLUMNS = {
    "op2_toxicity": "doc_id held_out score predicted",
    "op3_sentencepiece": "doc_id n_tokens ids_sha256 decoded_sha256",
    "op4_suffixes": "doc_id n_bytes n_removed n_spans kept_sha256",
    "op5_simhash": "doc_id fingerprint component_id",
    "op6_packing": "doc_id piece start length ids_crc32 sequence_id offset",
    "op7_quality": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
    "op9_sharding": "doc_id size text_crc32 law shard slot grown_shard",
    "op10_language": "doc_id held_out lang_pred score",
}


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_queries_cover_the_documents(spark, name):
    df = queries.QUERIES[name](spark, SMALL)
    assert set(COLUMNS[name].split()) <= set(df.columns)
    assert df.select("doc_id").distinct().count() == 200


def test_pipeline_stages_follow_each_other(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    kept = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, kept, SMALL).persist()
        assert after.columns == docs.columns
        assert after.join(kept, "doc_id", "left_anti").count() == 0
        kept = after
    packed = corpus_pipeline.STAGES[-1][1](spark, kept, SMALL)
    assert packed.select("doc_id").distinct().count() == kept.count() > 100
    rows = corpus_pipeline.run(spark, SMALL).collect()
    columns = ("doc_id", "piece", "length", "ids_crc32")
    assert sorted(tuple(r[c] for c in columns) for r in rows) == sorted(
        tuple(r[c] for c in columns) for r in packed.collect()
    )
