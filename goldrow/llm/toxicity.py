"""Toxicity by non-negative positive-unlabelled learning.

There are texts confirmed as toxic, and texts of which nothing is said. With the share of
toxic texts among all (the class prior) the risk of a classifier follows from these two
alone: the risk on unlabelled texts, taken as clean, less the part that toxic ones among
them would add, cannot be negative; where its estimate turns negative, learning steps back.

The classifier is linear over which words, and beginnings of words, a text has. Spark
counts these over a bounded sample; the most telling ones are the features, and numpy fits
their weights on the driver. All texts are scored inside Arrow tasks, from word tables.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldrow.llm.words import WordTable, blocks, schema_with, segment_sums, texts_of, word_table
from goldrow.session import write_through

#: Most sampled texts to learn from, about: confirmed toxic ones and unlabelled ones.
POSITIVES, UNLABELLED = 4_000, 12_000
#: Most features kept: those that tell toxic texts from others best.
FEATURES = 2_048
#: Least log-likelihood ratio of a feature, in nats; chance alone hardly gives as much.
MIN_RATIO = 10.0
#: Least texts of the sample that have a feature.
MIN_TEXTS = 4
#: Beginnings of words that are features beside the words.
PREFIXES = (4, 5, 6, 7, 8)
#: Steps and rate of the fit, its weight decay, and the size of a step back.
STEPS, RATE, DECAY, BACK = 400, 0.05, 1e-4, 0.5
#: A text is called toxic from this score on.
TOXIC_SCORE = 0.3

_LETTERS = re.compile(r"[^\W\d_]+")


def _features(word: str) -> set[str]:
    """A word's letter runs and their beginnings (marked by ``-``), case ignored."""
    found = set()
    for run in _LETTERS.findall(word.lower()):
        found.add(run)
        found.update(f"{run[:k]}-" for k in PREFIXES if len(run) > k)
    return found


def _of_texts(table: WordTable, numbers: dict[str, int] | None):
    """Pairs (text, feature), each once, and the features' names if none were given."""
    known = numbers if numbers is not None else {}
    per_word: list[list[int]] = []
    for word in table.words.to_pylist():
        names = _features(word)
        if numbers is None:
            per_word.append([known.setdefault(n, len(known)) for n in names])
        else:
            per_word.append([known[n] for n in names if n in known])
    sizes = np.fromiter(map(len, per_word), np.int64, len(per_word))
    flat = np.array([i for own in per_word for i in own], np.int64)
    text = np.repeat(np.arange(len(table.starts) - 1), np.diff(table.starts))
    held = sizes[table.codes] > 0
    text, codes = text[held], table.codes[held]
    # Each word of a text once, then each feature once.
    width = len(per_word) + 1
    once = np.unique(text * width + codes)
    text, codes = once // width, once % width
    times = sizes[codes]
    begins = np.cumsum(sizes) - sizes
    where = np.repeat(begins[codes] - (np.cumsum(times) - times), times)
    where += np.arange(len(where))
    width = len(known) + 1
    pairs = np.unique(np.repeat(text, times) * width + flat[where])
    return pairs // width, pairs % width, known


@dataclass
class Classifier:
    numbers: dict[str, int]
    weights: np.ndarray
    bias: float

    def scores(self, texts: pa.Array) -> np.ndarray:
        table = word_table(texts)
        text, feature, _ = _of_texts(table, self.numbers)
        starts = np.searchsorted(text, np.arange(len(texts) + 1))
        margin = segment_sums(self.weights[feature], starts) + self.bias
        return 1 / (1 + np.exp(-np.clip(margin, -50, 50)))


def fit_nnpu(
    rows: list[np.ndarray], positive: np.ndarray, n_features: int, prior: float
) -> tuple[np.ndarray, float]:
    """Weights and bias that minimise the non-negative risk with the logistic loss.

    ``rows`` hold each text's features, ``positive`` marks confirmed texts; the others are
    unlabelled. Adam on the whole sample.
    """
    sizes = np.fromiter(map(len, rows), np.int64, len(rows))
    index = np.concatenate([np.zeros(0, np.int64), *rows])
    owner = np.repeat(np.arange(len(rows)), sizes)
    share_p = np.where(positive, 1 / max(positive.sum(), 1), 0.0)
    share_u = np.where(positive, 0.0, 1 / max((~positive).sum(), 1))
    theta = np.zeros(n_features + 1)
    theta[-1] = np.log(prior / (1 - prior))
    mean, square = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, STEPS + 1):
        margin = np.bincount(owner, theta[index], len(rows)) + theta[-1]
        p = 1 / (1 + np.exp(-np.clip(margin, -50, 50)))
        loss_clean = np.logaddexp(0, margin)
        negative_risk = (share_u - prior * share_p) @ loss_clean
        # d loss_toxic = p - 1, d loss_clean = p
        clean = (share_u - prior * share_p) * p
        slope = -BACK * clean if negative_risk < 0 else prior * share_p * (p - 1) + clean
        gradient = np.append(np.bincount(index, slope[owner], n_features), slope.sum())
        gradient[:-1] += DECAY * theta[:-1]
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.999 * square + 0.001 * gradient**2
        rate = RATE / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
        theta -= rate * mean / (1 - 0.9**step)
    return theta[:-1], float(theta[-1])


def _count_features(batches) -> Iterator[pa.RecordBatch]:
    for block in blocks(batches, "text"):
        table = word_table(texts_of(block))
        text, feature, names = _of_texts(table, None)
        toxic = np.array(block.column("positive").to_pylist(), bool)[text]
        n, n_toxic = (np.bincount(f, minlength=len(names)) for f in (feature, feature[toxic]))
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(names), pa.string()), pa.array(n_toxic), pa.array(n - n_toxic)],
            names=["feature", "toxic", "unlabelled"],
        )


def _telling(sample: DataFrame, positives: int, unlabelled: int) -> dict[str, int]:
    """The features that toxic texts have most surely more often than unlabelled ones."""
    counted = sample.mapInArrow(_count_features, "feature string, toxic bigint, unlabelled bigint")
    counted = counted.groupBy("feature").agg(
        F.sum("toxic").alias("t"), F.sum("unlabelled").alias("u")
    )
    every = positives + unlabelled
    both = F.col("t") + F.col("u")

    def part(n, share):
        return F.when(n > 0, n * F.log(n / (both * share))).otherwise(0.0)

    ratio = part(F.col("t"), positives / every) + part(F.col("u"), unlabelled / every)
    more_toxic = F.col("t") * unlabelled > F.col("u") * positives
    best = (
        counted.where((both >= MIN_TEXTS) & more_toxic)
        .withColumn("ratio", ratio)
        .where(F.col("ratio") >= MIN_RATIO)
        .orderBy(F.desc("ratio"), "feature")
        .limit(FEATURES)
        .select("feature")
        .collect()
    )
    return {row["feature"]: i for i, row in enumerate(best)}


def train(
    docs: DataFrame,
    confirmed: DataFrame,
    prior: float,
    key: str = "doc_id",
    text: str = "text",
    positives: int = POSITIVES,
    unlabelled: int = UNLABELLED,
) -> Classifier:
    """Learn from the texts of ``docs`` whose key is in ``confirmed``, and of the others.

    Hashes of keys decide the sample: about ``positives`` confirmed and ``unlabelled`` of all
    texts, or all there are. ``prior`` is the share of toxic texts among all. Without
    confirmed texts every score is the prior.
    """
    place = F.xxhash64(F.lit(5), F.col("id")) / F.lit(2.0**64) + 0.5
    rows = docs.select(F.col(f"`{key}`").alias("id"), F.col(f"`{text}`").alias("text"))
    rows = rows.where("id IS NOT NULL")
    toxic = confirmed.select(F.col(f"`{key}`").alias("id")).where("id IS NOT NULL").distinct()
    n_toxic, n_docs = toxic.count(), rows.count()
    toxic = toxic.where(place < positives / max(n_toxic, 1))
    some = rows.where(place < unlabelled / max(n_docs, 1)).withColumn("positive", F.lit(False))
    # Hashes are even, so the sampled keys are about ``positives`` at any size.
    chosen = rows.join(F.broadcast(toxic), "id", "left_semi").withColumn("positive", F.lit(True))
    sample = write_through(chosen.unionByName(some), "toxicity-sample")
    counts = {r["positive"]: r["count"] for r in sample.groupBy("positive").count().collect()}
    prior = min(max(prior, 1e-6), 1 - 1e-6)
    if not counts.get(True) or not counts.get(False):
        return Classifier({}, np.zeros(0), float(np.log(prior / (1 - prior))))
    numbers = _telling(sample, counts[True], counts[False])

    def task(batches) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text"):
            table = word_table(texts_of(block))
            text, feature, _ = _of_texts(table, numbers)
            starts = np.searchsorted(text, np.arange(block.num_rows + 1))
            lists = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(feature, pa.int32()))
            yield pa.RecordBatch.from_arrays([block.column("positive"), lists], names=["positive", "own"])

    # Bounded by the sample's texts times FEATURES.
    table = sample.mapInArrow(task, "positive boolean, own array<int>").toArrow()
    own = table["own"].combine_chunks()
    offsets, flat = own.offsets.to_numpy(), own.values.to_numpy().astype(np.int64)
    lists = [flat[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
    positive = np.array(table["positive"].to_pylist(), bool)
    weights, bias = fit_nnpu(lists, positive, len(numbers), prior)
    return Classifier(numbers, weights, bias)


def score(
    df: DataFrame, classifier: Classifier, text: str = "text", keep_text: bool = False
) -> DataFrame:
    """Add ``score`` (0 to 1) and ``predicted`` (1 from ``TOXIC_SCORE`` on).

    A null text scores as an empty one. Input columns of these names are replaced.
    """
    kept = [c for c in df.columns if c not in ("score", "predicted") and (keep_text or c != text)]
    rows = df.select(
        F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), F.col(f"`{text}`").alias("text")
    )
    shared = df.sparkSession.sparkContext.broadcast(classifier)
    schema = schema_with(rows, ["row"], "score double")

    def task(batches) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text"):
            scores = shared.value.scores(texts_of(block))
            yield pa.RecordBatch.from_arrays([block.column("row"), pa.array(scores)], names=schema.names)

    return rows.mapInArrow(task, schema).select(
        *[F.col("row")[c].alias(c) for c in kept],
        "score",
        (F.col("score") >= TOXIC_SCORE).cast("int").alias("predicted"),
    )
