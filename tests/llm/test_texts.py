"""Operators on texts against plain versions of what they compute."""

from __future__ import annotations

import hashlib
import random
import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from goldrow.llm import (
    kneser_ney,
    language,
    packing,
    pieces,
    quality_rules,
    shards,
    simhash,
    suffixes,
    tokens,
    toxicity,
    words,
)
from tests.conftest import SMALL
from tests.llm.conftest import TEXTS

public_tokenizers = pytest.importorskip("public_tokenizers")
MODEL = public_tokenizers.path("piece_bpe_32k.model")
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
strange = st.text(st.sampled_from("ab A.,'▁\n\t  é́İΣ日<|>_12s") | st.characters(codec="utf-8"))


def large(texts):
    return pa.array(texts, pa.large_string())


# --- words


@settings(max_examples=200, deadline=None)
@given(st.lists(strange, max_size=6))
def test_words_are_those_of_the_pattern(texts):
    table = words.word_table(large(texts))
    names = table.words.to_pylist()
    for i, text in enumerate(texts):
        own = table.codes[table.starts[i] : table.starts[i + 1]]
        assert [names[c] for c in own] == WORD.findall(text)


def test_blocks_hold_all_rows_and_compact_texts():
    batch = pa.RecordBatch.from_pydict({"text": ["aaa", None, "B" * 100, "", "cC", "d"]})
    parts = [words.texts_of(b).to_pylist() for b in words.blocks([batch], "text", 5)]
    assert [t for p in parts for t in p] == ["aaa", "", "B" * 100, "", "cC", "d"]
    assert len(parts) > 2


# --- SentencePiece


@settings(max_examples=200, deadline=None)
@given(st.lists(strange, min_size=1, max_size=5))
def test_pieces_equal_the_library(texts):
    model = pieces._read(MODEL)
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    ids = pieces._Encoder(model, True).encode(large(texts))
    assert ids.to_pylist() == [sp.encode(t) + [sp.eos_id()] for t in texts]
    assert pieces._Decoder(model).decode(ids) == [sp.decode(sp.encode(t)) for t in texts]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 31_999), max_size=12))
def test_any_ids_decode_as_in_the_library(ids):
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    lists = pa.array([ids, []], pa.list_(pa.int32()))
    assert pieces._Decoder(pieces._read(MODEL)).decode(lists) == [sp.decode(ids), ""]


def test_pieces_job(texts, nothing):
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    df = pieces.decode(pieces.encode(texts, MODEL), MODEL)
    assert {*texts.columns} < {*df.columns}
    for r in df.collect():
        want = sp.encode(r["text"] or "") + [2]
        assert (r["ids"], r["decoded"]) == (want, sp.decode(want))
    both = pieces.round_trip(texts.select("doc_id", "text"), MODEL)
    assert both.count() == texts.count()
    assert pieces.round_trip(nothing, MODEL).count() == 0


# --- tokens and packing


@settings(max_examples=200, deadline=None)
@given(st.lists(strange, min_size=1, max_size=5))
def test_tokens_equal_the_library(texts):
    with open(TOKENIZER, encoding="utf-8") as file:
        encoder = tokens.Encoder(file.read())
    library = Tokenizer.from_file(TOKENIZER)
    got = encoder.encode(words.word_table(large(texts)), 7).to_pylist()
    assert got == [library.encode(t, add_special_tokens=False).ids + [7] for t in texts]


def test_packing_job(texts, nothing):
    library = Tokenizer.from_file(TOKENIZER)
    cut = packing.token_pieces(texts.drop("row"), TOKENIZER, 1, capacity=64)
    rows = cut.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("crc"))
    placed = packing.pack(rows, ["doc_id", "piece", "length", "crc"], capacity=64).collect()
    want = Counter()
    for i, text in [*enumerate(TEXTS), (None, "no id at all")]:
        ids = library.encode(text or "", add_special_tokens=False).ids + [1]
        for piece, at in enumerate(range(0, len(ids), 64)):
            part = np.array(ids[at : at + 64], "<u4")
            want[i, piece, at, len(part), zlib.crc32(part.tobytes())] += 1
    assert Counter(tuple(r)[:5] for r in placed) == want
    sequences: dict = {}
    for r in placed:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64
    empty = packing.token_pieces(nothing, TOKENIZER, 1).drop("ids")
    assert packing.pack(empty, ["doc_id", "piece"]).count() == 0


def test_packing_rejects_lengths_beyond_the_capacity(spark):
    with pytest.raises(ValueError, match="9 tokens"):
        packing.pack(spark.createDataFrame([(1, 9)], "k int, length long"), ["k"], capacity=8)


def best(sizes, capacity):
    """Fewest bins by trying every placement."""
    found = len(sizes)

    def place(i, bins):
        nonlocal found
        if len(bins) >= found:
            return
        if i == len(sizes):
            found = len(bins)
            return
        for room in {b for b in bins if b >= sizes[i]}:
            rest = list(bins)
            rest[rest.index(room)] -= sizes[i]
            place(i + 1, rest)
        place(i + 1, [*bins, capacity - sizes[i]])

    place(0, [])
    return found


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=9))
def test_bin_completion_is_near_the_optimum(sizes):
    counts = np.bincount(sizes, minlength=21)
    plan = packing.pack_counts(counts, 20)
    used = Counter()
    for filling in plan:
        assert sum(filling.lengths) <= 20
        for s in filling.lengths:
            used[s] += filling.times
    assert used == Counter(sizes)
    assert sum(f.times for f in plan) <= best(sorted(sizes, reverse=True), 20) + (len(sizes) > 7)


def test_packing_search_keeps_no_table_of_counts_per_node():
    lengths = np.random.default_rng(3).lognormal(6, 1, 3_000).astype(int).clip(1, 4096)
    counts = np.bincount(lengths, minlength=4097)
    tracemalloc.start()
    try:
        plan = packing.pack_counts(counts, max_nodes=1)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    used = np.zeros_like(counts)
    for filling in plan:
        np.add.at(used, list(filling.lengths), filling.times)
    assert (used == counts).all() and len(plan) > 200
    assert peak < 100 * counts.nbytes


# --- suffix arrays


def brute_spans(texts):
    seen = Counter(t[k : k + 200] for t in texts for k in range(len(t) - 199))
    out = []
    for t in texts:
        gone = np.zeros(len(t) + 1, bool)
        for k in range(len(t) - 199):
            if seen[t[k : k + 200]] > 1:
                gone[k : k + 200] = True
        edges = np.flatnonzero(np.diff(np.r_[False, gone].astype(int))).tolist()
        out.append(list(zip(edges[::2], edges[1::2], strict=True)))
    return out


@pytest.mark.parametrize("contexts", [4096, 1])
def test_repeats_equal_brute_force(spark, monkeypatch, contexts):
    monkeypatch.setattr(suffixes, "GROUP_CONTEXTS", contexts)
    rng = random.Random(5)
    base = ["".join(rng.choice("ab cdé\n") for _ in range(1500)) for _ in range(3)]
    texts = []
    for _ in range(40):
        parts = []
        for _ in range(rng.randrange(5)):
            start = rng.randrange(1200)
            size = rng.choice([60, 198, 199, 200, 201, 260, 700])
            parts.append(rng.choice(base)[start : start + size] + rng.choice(["", "x", "yy"]))
        texts.append("".join(parts))
    texts += ["a" * 199, "a" * 200, "b" * 200, "b" * 201, "ab" * 250, texts[0], texts[0], "", None]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r["doc_id"]: r for r in suffixes.remove_repeats(df).collect()}
    plain = [(t or "").encode() for t in texts]
    for i, spans in enumerate(brute_spans(plain)):
        assert [(s["start"], s["stop"]) for s in rows[i]["removed"]] == spans
        gone = {k for a, b in spans for k in range(a, b)}
        assert bytes(rows[i]["kept"]) == bytes(c for k, c in enumerate(plain[i]) if k not in gone)
        assert rows[i]["n_bytes"] == len(plain[i])


def test_repeats_job(texts, nothing):
    rows = suffixes.remove_repeats(texts.drop("kept"), as_text=True).collect()
    assert len(rows) == len(TEXTS) + 1 and all(r["id"] == "mine" for r in rows)
    by_id = {r["doc_id"]: r["kept"] for r in rows}
    assert by_id[9] == by_id[10] == "" and by_id[4] == "one" and by_id[0] == ""
    assert suffixes.remove_repeats(nothing).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.binary(min_size=20, max_size=20).map(lambda b: bytes(c & 1 for c in b)), max_size=30))
def test_suffix_order_is_sorted(rows):
    data = np.frombuffer(b"".join(rows), np.uint8).reshape(-1, 20)
    for shallow in (0, 1, 3):
        order, common = suffixes.suffix_order(data, shallow)
        got = [rows[i] for i in order]
        assert got == sorted(rows)
        for a, b, n in zip(got, got[1:], common[1:], strict=False):
            same = next((k for k in range(20) if a[k] != b[k]), 20)
            assert n == same


# --- SimHash


def plain_fingerprint(text):
    found = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    some = [found[i : i + 3] for i in range(len(found) - 2)] or ([found] if found else [])
    hashes = [xxhash.xxh64_intdigest(" ".join(s).encode(), 42) for s in some]
    return sum(
        1 << k for k in range(64) if hashes and 2 * sum(h >> k & 1 for h in hashes) > len(hashes)
    )


@settings(max_examples=60, deadline=None)
@given(st.lists(strange, min_size=1, max_size=5))
def test_fingerprints_equal_the_definition(texts):
    lowered = [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in texts]
    got = simhash._fingerprints(large(lowered), 3, 42).tolist()
    assert got == [plain_fingerprint(t) for t in texts]


def linked(items, near):
    """Smallest place that each item can reach."""
    label = list(range(len(items)))
    changed = True
    while changed:
        changed = False
        for i in range(len(items)):
            for j in range(i):
                if label[i] != label[j] and near(items[i], items[j]):
                    label[i] = label[j] = min(label[i], label[j])
                    changed = True
    return label


@pytest.mark.parametrize("rows", [1024, 1])
def test_links_equal_brute_force(spark, monkeypatch, rows):
    monkeypatch.setattr(simhash, "GROUP_ROWS", rows)
    rng = random.Random(9)
    fps = [0, (1 << 64) - 1]
    for _ in range(12):
        fp = rng.getrandbits(64)
        fps.append(fp)
        for _ in range(4):
            for bit in rng.sample(range(64), rng.randrange(1, 5)):
                fp ^= 1 << bit
            fps.append(fp)
    signed = [fp - (fp >> 63 << 64) for fp in fps]
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    from goldrow.llm.components import components

    found = {r["node"]: r["component"] for r in components(simhash.links(df)).collect()}
    label = linked(fps, lambda a, b: (a ^ b).bit_count() <= 3)
    got = [found.get(f, f) for f in signed]
    want = [min(s for s, m in zip(signed, label, strict=True) if m == l) for l in label]
    assert got == want


@pytest.mark.parametrize("max_bits", [3, 7])
@pytest.mark.parametrize("rows", [3, 10_000])
def test_near_pairs_equal_brute_force(spark, max_bits, rows):
    rng = random.Random(max_bits)
    fps = [0, 0, (1 << 64) - 1]
    for _ in range(30):
        fp = rng.getrandbits(64)
        fps.append(fp)
        for bits in (2, 3, 4, 7, 8):
            fps.append(fp ^ sum(1 << bit for bit in rng.sample(range(64), bits)))
    df = spark.createDataFrame([(f - (f >> 63 << 64), i) for i, f in enumerate(fps)], "fp long, node long")
    size = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(size)
    spark.conf.set(size, str(rows))
    try:
        got = sorted(tuple(sorted(r)) for r in simhash.near_pairs(df, max_bits).collect())
    finally:
        spark.conf.set(size, before)
    near = lambda i, j: (fps[i] ^ fps[j]).bit_count() <= max_bits
    assert got == [(j, i) for j in range(len(fps)) for i in range(j + 1, len(fps)) if near(i, j)]


@pytest.mark.parametrize("size", [1, 4, 50])
def test_crowded_signatures_give_some_pairs_of_each_row(size):
    task = simhash._pairs_in_order(7, pairs=2, reach=3)
    # Two signatures without bit 0, and one without bit 1, where the pairs are known already.
    fp = [0] * 20 + [2] * 10 + [0] * 20
    columns = {"key": [0] * 20 + [2] * 10 + [1 << 32] * 20, "fp": fp, "node": list(range(50))}
    table = pa.table({c: pa.array(v, pa.int64()) for c, v in columns.items()})
    out = pa.Table.from_batches(task(table.to_batches(max_chunksize=size))).to_pylist()
    groups = [(0, 20), (20, 30)]
    want = [(i, j) for s, e in groups for i in range(s, e) for j in (i + 1, i + 2) if j < e]
    assert sorted((r["a"], r["b"]) for r in out) == want


def test_simhash_job(texts, nothing):
    rows = {r["doc_id"]: r for r in simhash.near_duplicates(texts, "doc_id").collect()}
    assert len(rows) == len(TEXTS) + 1
    for i, text in enumerate(TEXTS):
        assert rows[i]["fp"] & (1 << 64) - 1 == plain_fingerprint(text)
    component = {i: rows[i]["component_id"] for i in range(len(TEXTS))}
    assert [component[i] for i in range(4)] == [0] * 4
    assert component[7] == 6 and component[10] == 9 and rows[None]["component_id"] is None
    assert simhash.near_duplicates(nothing, "doc_id").count() == 0


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 14), st.integers(0, 14)), max_size=25))
def test_components_equal_brute_force(spark, edges):
    from goldrow.llm.components import components

    df = spark.createDataFrame(edges, "a long, b long")
    got = {r["node"]: r["component"] for r in components(df).collect()}
    nodes = sorted({n for e in edges for n in e})
    pairs = {frozenset(e) for e in edges}
    label = linked(nodes, lambda a, b: frozenset((a, b)) in pairs)
    assert got == {n: nodes[l] for n, l in zip(nodes, label, strict=True)}


def test_components_of_a_path_and_a_star(spark):
    from goldrow.llm.components import components

    path = spark.range(200).selectExpr("id AS a", "id + 1 AS b")
    star = spark.range(500).selectExpr("1000 AS a", "1001 + id AS b")
    rows = components(path.unionAll(star)).collect()
    assert {r["component"] for r in rows if r["node"] <= 200} == {0}
    assert {r["component"] for r in rows if r["node"] >= 1000} == {1000}


def test_equal_rows_meet_once_per_row(spark, monkeypatch):
    """Many equal rows without a key: contexts grow with the rows, not with their square."""
    text = " ".join(f"v{i * i % 7919}" for i in range(300))
    contexts = []
    plain = suffixes.write_through

    def seen(df, label):
        out = plain(df, label)
        if label == "contexts":
            contexts.append(out.count())
        return out

    monkeypatch.setattr(suffixes, "write_through", seen)
    for copies in (20, 200):
        rows = [(None, text)] * copies + [(1, "short"), (2, "x" + text[:150])]
        df = spark.createDataFrame(rows, "doc_id long, text string")
        for r in suffixes.remove_repeats(df).collect():
            gone = sum(s["stop"] - s["start"] for s in r["removed"])
            assert gone == (len(text) if r["doc_id"] is None else 0)
    assert contexts[1] == 10 * contexts[0]


# --- quality rules


def plain_counts(text):
    text = text or ""
    found = WORD.findall(text)
    windows = Counter(tuple(found[i : i + 3]) for i in range(len(found) - 2))
    covered = {
        i + k for i in range(len(found) - 2) if windows[tuple(found[i : i + 3])] > 1 for k in range(3)
    }
    lines = [line for line in text.split("\n") if WORD.search(line)]
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return len(found), sum(map(len, found)), symbols, len(lines) - len(set(lines)), len(covered)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab \n#é")), min_size=1, max_size=4))
def test_counts_equal_the_definition(texts):
    data = large(texts)
    got = quality_rules._counts(data, words.word_table(data))
    assert [tuple(c[i] for c in got) for i in range(len(texts))] == [plain_counts(t) for t in texts]


def test_windows_of_different_texts_are_not_repeats():
    rng = random.Random(4)
    some = [" ".join(rng.choices("abcdefgh", k=rng.randrange(12))) for _ in range(400)]
    for texts in (["a b c", "b b c"], some):
        data = large(texts)
        got = quality_rules.repeated_words(words.word_table(data)).tolist()
        assert got == [plain_counts(t)[4] for t in texts]


def test_windows_of_equal_hash_are_compared(monkeypatch):
    monkeypatch.setattr(quality_rules, "_MIX", np.uint64(0))
    texts = ["a b c d e f", "a b c d", "x a b c y a b c", "c b a"]
    got = quality_rules.repeated_words(words.word_table(large(texts))).tolist()
    assert got == [plain_counts(t)[4] for t in texts] == [0, 0, 6, 0]


def test_quality_job(texts, nothing):
    models = quality_rules.train(texts)
    rows = quality_rules.apply_rules(texts, models).collect()
    assert len(rows) == len(TEXTS) + 1
    for r in rows:
        text = "no id at all" if r["doc_id"] is None else TEXTS[r["doc_id"]]
        counts = plain_counts(text)
        assert tuple(r[c] for c in quality_rules.COUNTS) == counts
        failed = counts[0] < 50 or 100 * counts[4] > 50 * counts[0]
        assert r["base_failed"] == failed and (not failed or not r["kept"])
    assert quality_rules.apply_rules(nothing, quality_rules.train(nothing)).count() == 0


def test_perplexity_bands_reject_foreign_text(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").where("lang = 'en'")
    odd = spark.createDataFrame(
        [(-1, "ΧΨΩ ЖШЩ qzx " * 5 + " ".join(f"ж{i}щ" for i in range(60)), "en")],
        "doc_id long, text string, lang string",
    )
    both = docs.select("doc_id", "text", "lang").unionByName(odd)
    rows = quality_rules.apply_rules(both, quality_rules.train(both)).collect()
    sound = [r for r in rows if not r["base_failed"] and r["doc_id"] >= 0]
    assert sum(r["kept"] for r in sound) > 0.95 * len(sound)
    assert [r["kept"] for r in rows if r["doc_id"] == -1] == [False]


@pytest.mark.parametrize("modified", [False, True])
def test_probabilities_sum_to_one(spark, modified):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    counts = kneser_ney.count_grams(docs).persist()
    rows = counts.where("language = 'en'").toArrow()
    model = kneser_ney.fit(counts, modified)["en"]
    grams = rows["gram"].to_numpy().view(np.uint64)
    symbols = np.unique(grams & np.uint64(0xFFFF))
    for context in np.unique(grams >> np.uint64(16))[:: max(1, len(grams) // 20)]:
        some = np.append((context << np.uint64(16)) | symbols, (context << np.uint64(16)) | np.uint64(0xFFFE))
        assert np.exp(model.log_probability(some)).sum() == pytest.approx(1, abs=5e-3)
    total = sum(len(w) + 1 for r in docs.where("lang = 'en'").collect() for w in WORD.findall(r["text"] or ""))
    assert rows["n"].to_numpy().sum() == total


# --- language and toxicity


def test_languages_of_held_out_texts(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3)) == 1
    models = language.train(docs.where(~held_out))
    rows = language.identify(docs.where(held_out), models).collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in rows]) >= 0.95
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_language_job(texts, nothing):
    models = language.train(texts)
    rows = {r["doc_id"]: r for r in language.identify(texts, models, accepted=F.lit(True)).collect()}
    assert len(rows) == len(TEXTS) + 1
    for i, text in enumerate(TEXTS):
        letters = any(c.isalpha() for c in text or "")
        assert rows[i]["lang_pred"] == ("en" if letters else "und")
    assert language.identify(nothing, models).count() == 0
    none = language.identify(texts, language.train(nothing)).collect()
    assert {r["lang_pred"] for r in none} == {"und"}


def test_toxicity_is_learned(spark):
    rng = random.Random(2)
    rows = []
    for i in range(600):
        parts = [rng.choice("abcdefgh") + rng.choice("ijklm") for _ in range(30)]
        toxic = i % 10 == 0
        if toxic:
            parts[rng.randrange(30)] = rng.choice(["nasty", "nastily", "vile"])
            parts[rng.randrange(30)] = "vile"
        rows.append((i, " ".join(parts), toxic))
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic boolean")
    known = docs.where("doc_id % 20 = 0")
    classifier = toxicity.train(docs, known.select("doc_id"), 0.1)
    scored = toxicity.score(docs, classifier).collect()
    assert np.mean([r["predicted"] == r["toxic"] for r in scored]) > 0.98


def test_toxicity_job(texts, nothing):
    untaught = toxicity.train(texts, texts.where("false"), 0.1)
    rows = toxicity.score(texts, untaught).collect()
    assert len(rows) == len(TEXTS) + 1 and {round(r["score"], 6) for r in rows} == {0.1}
    taught = toxicity.train(texts, texts.where("doc_id = 9").select("doc_id"), 0.1)
    assert all(0 <= r["score"] <= 1 for r in toxicity.score(texts, taught).collect())
    assert toxicity.score(nothing, taught).count() == 0


def test_negative_risk_is_not_fitted():
    rows = [np.array([i % 2]) for i in range(40)]
    weights, bias = toxicity.fit_nnpu(rows, np.arange(40) % 2 == 1, 2, 0.3)
    assert weights[1] > weights[0] and np.isfinite([*weights, bias]).all()


# --- shards


@pytest.mark.parametrize("partitions", ["3", "8"])
def test_shards_match_the_mixture(spark, texts, nothing, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        kind = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 7 == 0, None).otherwise(
            F.concat(F.lit("s"), F.col("id") % 5)
        )
        df = spark.range(1003).withColumn("source", kind)
        rows = shards.interleave(df, "source", ["id"], shards=8).collect()
        odd = shards.interleave(texts, "source", ["doc_id", "text"], shards=3).collect()
        empty = shards.interleave(nothing, "source", ["doc_id"]).count()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    sizes = Counter(r["shard"] for r in rows)
    assert len(rows) == 1003 and max(sizes.values()) - min(sizes.values()) <= 1
    for shard in range(8):
        assert sorted(r["slot"] for r in rows if r["shard"] == shard) == list(range(sizes[shard]))
    for source, total in Counter(r["source"] for r in rows).items():
        held = Counter(r["shard"] for r in rows if r["source"] == source)
        assert all(abs(held[s] - total / 8) <= 2 for s in range(8))
    digest = hashlib.sha256(repr(sorted((r["id"], r["shard"], r["slot"]) for r in rows)).encode())
    first = getattr(test_shards_match_the_mixture, "seen", None)
    test_shards_match_the_mixture.seen = digest.hexdigest()
    assert first in (None, digest.hexdigest()), "the number of partitions changed the order"
    assert len(odd) == len(TEXTS) + 1 and empty == 0 and all(r["a.b"] == "dot" for r in odd)
