"""Models keep all grams, also where one gram has almost all tokens."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from goldrow.llm import kneser_ney, quality_rules

#: Each gram but those of ``aaaa`` has less than a 2^-20 share of the tokens.
RARE = [(1, 40), (2, 12), (3, 5), (4, 3)]


def skewed(spark):
    rows = [("en", 97 * 0x1000100010001, 1 << 30)]
    symbol = 200
    for n, times in RARE:
        for _ in range(times):
            rows.append(("en", 32 << 48 | 32 << 32 | 32 << 16 | symbol, n))
            symbol += 1
    return spark.createDataFrame(rows, "language string, gram long, n long")


def test_rare_grams_count_for_the_discounts(spark):
    model = kneser_ney.fit(skewed(spark), True)["en"]
    assert len(model.grams[-1].hashes) == 1 + sum(times for _, times in RARE)
    of_counts = Counter(dict(RARE))
    y = of_counts[1] / (of_counts[1] + 2 * of_counts[2])
    once = 1 - 2 * y * of_counts[2] / of_counts[1]
    twice = 2 - 3 * y * of_counts[3] / of_counts[2]
    got = kneser_ney._discounts(np.array([1] * 40 + [2] * 12 + [3] * 5 + [4] * 3), True)
    assert got[0] == pytest.approx(once) and got[40] == pytest.approx(twice)
    # A seen gram is likelier than one of the same context that never occurs.
    seen = np.array([32 << 48 | 32 << 32 | 32 << 16 | 200], np.uint64)
    unseen = np.array([32 << 48 | 32 << 32 | 32 << 16 | 9000], np.uint64)
    assert model.log_probability(seen)[0] > model.log_probability(unseen)[0]


def test_too_many_grams_are_an_error(spark):
    with pytest.raises(ValueError, match="61 distinct grams"):
        kneser_ney.fit(skewed(spark), True, max_grams=60)


def plain_grams(text):
    """Four symbols each, ending at every symbol and at the border behind the text."""
    symbols = "   " + re.sub("[\t-\r]", " ", text) + " "
    return [symbols[i : i + 4] for i in range(len(text) + 1)]


odd_texts = st.lists(st.text(st.sampled_from("ab \n\té日😀")), min_size=1, max_size=5)


@settings(max_examples=100, deadline=None)
@given(odd_texts)
def test_running_grams_are_those_of_the_texts(texts):
    got = kneser_ney.text_grams(texts)
    code = lambda gram: sum((ord(c) & 0xFFFF) << 16 * (3 - i) for i, c in enumerate(gram))
    for i, text in enumerate(texts):
        own = got.grams[got.codes[got.starts[i] : got.starts[i + 1]]]
        assert own.tolist() == [code(g) for g in plain_grams(text)]


class PlainModel:
    """Interpolated Kneser-Ney over dictionaries of strings, straight from its definition."""

    def __init__(self, grams, modified):
        self.counts = {4: Counter(grams)}
        for k in (3, 2, 1):
            self.counts[k] = Counter(g[1:] for g in self.counts[k + 1])
        self.symbols, self.modified = len(self.counts[1]) + 1, modified

    def discount(self, k, n):
        times = Counter(self.counts[k].values())
        one, two, three, four = (max(times[i], 1) for i in (1, 2, 3, 4))
        y = one / (one + 2 * two)
        if not self.modified:
            return y
        steps = [1 - 2 * y * two / one, 2 - 3 * y * three / two, 3 - 4 * y * four / three]
        step = steps[min(n, 3) - 1]
        return step if 0 < step < min(n, 3) else y

    def p(self, gram):
        if not gram:
            return 1 / self.symbols
        k = len(gram)
        after = {g: n for g, n in self.counts[k].items() if g[:-1] == gram[:-1]}
        if not after:
            return self.p(gram[1:])
        total = sum(after.values())
        left = sum(self.discount(k, n) for n in after.values()) / total
        n = after.get(gram, 0)
        return (n - self.discount(k, n) if n else 0) / total + left * self.p(gram[1:])


@pytest.mark.parametrize("modified", [False, True])
def test_models_equal_a_plain_one(spark, modified):
    rng = random.Random(4)
    texts = ["".join(rng.choice("aab ce.") for _ in range(rng.randrange(60))) for _ in range(25)]
    df = spark.createDataFrame([(t, "x") for t in texts], "text string, lang string")
    model = kneser_ney.fit(kneser_ney.count_text_grams(df), modified)["x"]
    plain = PlainModel([g for t in texts for g in plain_grams(t)], modified)
    asked = sorted({g for t in [*texts, "ca  .zq", "bbbbb", "é"] for g in plain_grams(t)})
    codes = [sum(ord(c) << 16 * (3 - i) for i, c in enumerate(g)) for g in asked]
    got = np.exp(model.log_probability(np.array(codes, np.uint64)))
    assert got == pytest.approx([plain.p(g) for g in asked], rel=1e-4)
    # The models of op10 are built alike, from the grams of single words.
    words = kneser_ney.count_grams(df).toArrow()
    own = kneser_ney.Model(words["gram"].to_numpy().view(np.uint64), words["n"].to_numpy(), modified)
    inside = [f"   {w}   "[i : i + 4] for t in texts for w in t.split() for i in range(len(w) + 1)]
    plain = PlainModel(inside, modified)
    asked = sorted({*inside, "  ab", "zaaa"})
    codes = [sum(ord(c) << 16 * (3 - i) for i, c in enumerate(g)) for g in asked]
    got = np.exp(own.log_probability(np.array(codes, np.uint64)))
    assert got == pytest.approx([plain.p(g) for g in asked], rel=1e-4)


def test_word_salad_is_rejected_and_sound_text_kept(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    models = quality_rules.train(docs)
    first = quality_rules.apply_rules(docs, models).collect()
    sound = [r["doc_id"] for r in first if not r["base_failed"]]
    assert np.mean([r["kept"] for r in first if not r["base_failed"]]) >= 0.95
    texts = {r["doc_id"]: (r["text"], r["lang"]) for r in docs.collect()}
    rng = random.Random(6)
    english = [i for i in sound if texts[i][1] == "en" and len(texts[i][0]) > 600]
    pool = [w for i in english for w in texts[i][0].split()]
    salad = []
    for at, i in enumerate(rng.sample(english, 40)):
        words = texts[i][0].split()
        shuffled = rng.sample(words, len(words))
        salad.append((10_000 + at, " ".join(shuffled), "en"))
        salad.append((20_000 + at, " ".join(rng.choice(pool) for _ in words), "en"))
    both = docs.unionByName(spark.createDataFrame(salad, docs.schema))
    rows = {r["doc_id"]: r for r in quality_rules.apply_rules(both, models).collect()}
    for kind in (10_000, 20_000):
        assert np.mean([rows[kind + at]["kept"] for at in range(40)]) <= 0.1
    assert np.mean([rows[i]["kept"] for i in sound]) >= 0.95
    for row in list(rows.values())[:50]:
        inside = row["perplexity"] is None or row["low"] <= row["perplexity"] <= row["high"]
        assert row["kept"] == (not row["base_failed"] and inside)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 1500), min_size=1, max_size=4))
def test_best_windows(lengths):
    rng = np.random.default_rng(sum(lengths))
    starts = np.concatenate([[0], np.cumsum(lengths)])
    loss = rng.random(starts[-1])
    got = quality_rules.best_windows(loss, starts)
    for i, n in enumerate(lengths):
        k = max(1, round(n / quality_rules.WINDOW))
        own = loss[starts[i] : starts[i + 1]]
        means = sorted(own[j * n // k : (j + 1) * n // k].mean() for j in range(k))
        left, total = k * 2 / 3, 0.0
        for m in means:
            total += min(1, max(0, left)) * m
            left -= 1
        assert got[i] == pytest.approx(total / (k * 2 / 3))


def test_a_foreign_passage_does_not_decide(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    models = quality_rules.train(docs)
    sound = [r["doc_id"] for r in quality_rules.apply_rules(docs, models).collect() if r["kept"]]
    texts = {r["doc_id"]: (r["text"], r["lang"]) for r in docs.collect()}
    chosen = lambda lang: [i for i in sound if texts[i][1] == lang and 1500 < len(texts[i][0]) < 4000]
    mixed = [
        (10_000 + at, texts[i][0] + " " + texts[j][0][: len(texts[i][0]) // 4], "en")
        for at, (i, j) in enumerate(zip(chosen("en")[:25], chosen("fr") * 3, strict=False))
    ]
    both = docs.unionByName(spark.createDataFrame(mixed, docs.schema))
    rows = [r for r in quality_rules.apply_rules(both, models).collect() if r["doc_id"] >= 10_000]
    assert len(rows) > 10 and np.mean([r["kept"] for r in rows]) >= 0.9
