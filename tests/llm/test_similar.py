"""Near-duplicates of the pipeline against brute force."""

from __future__ import annotations

import random

import pyarrow as pa
from pyspark.sql import functions as F

import corpus_pipeline
from goldrow.llm import simhash, similar
from tests.conftest import SMALL
from tests.llm.conftest import TEXTS


def shingles(text):
    words = (text or "").lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(len(words) - 4, 1))} if words else set()


def alike(a, b):
    return a == b or 5 * len(a & b) >= 4 * len(a | b)


def smallest_reached(texts):
    sets = [shingles(t) for t in texts]
    label = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if alike(sets[i], sets[j]) and label[i] != label[j]:
                low, high = sorted((label[i], label[j]))
                label = [low if x == high else x for x in label]
    return label


def edited(rng, words, changes):
    out = list(words)
    for at in rng.sample(range(len(out)), changes):
        out[at] = f"x{rng.randrange(10**6)}"
    return out


def test_stage_drops_copies_of_similarity_four_fifths(spark):
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(3000)]
    texts = []
    for _ in range(60):
        base = [rng.choice(vocabulary) for _ in range(300)]
        texts += [" ".join(base), " ".join(edited(rng, base, rng.randrange(1, 12)))]
    label = smallest_reached(texts)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kept = {r["doc_id"] for r in corpus_pipeline.distinct(spark, df, SMALL).collect()}
    assert sum(label[i] != i for i in range(len(texts))) > 30
    assert kept == {i for i in range(len(texts)) if label[i] == i}


def test_large_groups_stay_together(spark, monkeypatch):
    monkeypatch.setattr(similar, "BUCKET", 4)
    rng = random.Random(5)
    base = [f"w{rng.randrange(3000)}" for _ in range(300)]
    texts = [" ".join(edited(rng, base, rng.randrange(4))) for _ in range(80)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in similar.near_duplicates(df, "doc_id").collect()}
    assert [got[i] for i in range(80)] == smallest_reached(texts)


def templated(rng, groups, words=400, shared=300):
    """Texts of one template, unlike ones about 0.6 alike, each with twins of about 0.8."""
    template = [f"t{i}" for i in range(shared)]
    texts = []
    for _ in range(groups):
        own = template + [f"w{rng.randrange(10**6)}" for _ in range(words - shared)]
        texts.append(" ".join(own))
        for changes in rng.sample((2, 4, 6, 8, 9, 10), 2):
            texts.append(" ".join(edited(rng, own, changes)))
    rng.shuffle(texts)
    return texts


def components_of(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in similar.near_duplicates(df, "doc_id").collect()}
    return [got[i] for i in range(len(texts))]


def test_twins_of_one_template_are_found(spark):
    texts = templated(random.Random(7), 120)
    want = smallest_reached(texts)
    assert 80 < len(set(want)) < 240
    assert components_of(spark, texts) == want


def test_crowded_rare_shingles_go_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(similar, "BUCKET", 4)
    monkeypatch.setattr(similar, "GROUP", 2)
    monkeypatch.setattr(similar, "BLOCK", 3)
    rng = random.Random(9)
    # Chains: neighbours are alike, the ends are not, and all share rare words.
    base = [f"c{rng.randrange(10**6)}" for _ in range(200)]
    texts, words = [], base
    for _ in range(25):
        words = edited(rng, words, 3)
        texts.append(" ".join(words))
    texts += templated(rng, 15, words=120, shared=90)
    assert components_of(spark, texts) == smallest_reached(texts)


def test_fingerprints_alone_find_what_is_within_their_bits(spark, monkeypatch):
    no_pairs = lambda shared: shared.select(F.col("node").alias("a"), F.col("node").alias("b")).where("false")
    no_nodes = lambda shared, grouped: grouped.selectExpr("node", "component AS label").where("false")
    monkeypatch.setattr(similar, "_candidates", no_pairs)
    monkeypatch.setattr(similar, "_open_nodes", no_nodes)
    texts = templated(random.Random(11), 60)
    sets = [shingles(t) for t in texts]
    values = simhash.fingerprint_array(pa.array(texts, pa.large_string())).to_pylist()
    close = lambda i, j: ((values[i] ^ values[j]) & (2**64 - 1)).bit_count() <= 7
    pairs = [(i, j) for i in range(len(texts)) for j in range(i) if close(i, j)]
    linked = [(i, j) for i, j in pairs if alike(sets[i], sets[j])]
    assert 20 < len(linked) < len(pairs)  # the others are verified away
    label = list(range(len(texts)))
    for i, j in linked:
        low, high = sorted((label[i], label[j]))
        label = [low if x == high else x for x in label]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kept = {r["doc_id"] for r in corpus_pipeline.distinct(spark, df, SMALL).collect()}
    assert kept == {i for i in range(len(texts)) if label[i] == i}


def test_similar_job(texts, nothing):
    rows = similar.near_duplicates(texts, "doc_id").collect()
    got = {r["doc_id"]: r["component_id"] for r in rows}
    assert len(rows) == len(TEXTS) + 1 and got[None] is None
    assert [got[i] for i in range(len(TEXTS))] == smallest_reached(
        [t and t.lower() for t in TEXTS]
    )
    assert similar.near_duplicates(nothing, "doc_id").count() == 0
