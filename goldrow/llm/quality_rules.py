"""Quality rules: counts of a text, and bands of its perplexity.

The counts reject texts that are too short or repeat themselves. The verdict on the others
is by perplexity: modified Kneser-Ney character models of running text, one per language,
are counted by Spark over all documents (``kneser_ney``); a document's perplexity under its
language's model must lie in that language's band. The models see how words follow each
other, where sentences end and begin, and what a word looks like, so shuffled words, words
at random, foreign text and noise lie above; texts that say little new lie below.

A passage in another language should not decide about a document: perplexity is that of
the ``KEPT_SHARE`` of a text's windows that the model expects best. Salad and noise are
unexpected everywhere.

Bands come from the documents that pass the counts. The mean of a short text varies more:
deviations from the median of the cross-entropy are scaled by the root of n / (n + SPREAD)
for n symbols, and a band reaches so many interquartile ranges of these down and up.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldrow.llm.kneser_ney import Model, count_text_grams, fit, parts_by_language
from goldrow.llm.words import WordTable, blocks, schema_with, segment_sums, texts_of, word_table
from goldrow.session import write_through

MIN_WORDS = 50
#: Largest percentage of words in windows that are found twice or more.
MAX_REPEAT_PERCENT = 50
WINDOW_WORDS = 3
#: Interquartile ranges from the median to either end of the band.
BELOW, ABOVE = 3.0, 2.0
#: Symbols of a window, and the share of a text's windows, the best, that is judged.
WINDOW, KEPT_SHARE = 256, 2 / 3
#: Symbols of a text whose own subject varies its mean as much as its length does.
SPREAD = 10_000

_SPACE = " \t\n\x0b\x0c\r"
_SYMBOLS = "#*$%&|<>"
_MIX = np.uint64(0x9E3779B97F4A7C15)

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def repeated_words(table: WordTable, window: int = WINDOW_WORDS) -> np.ndarray:
    """Per text, the words that lie in a window of words found twice or more in it."""
    n = len(table.codes)
    n_texts = len(table.starts) - 1
    if n < window:
        return np.zeros(n_texts, np.int64)
    text = np.repeat(np.arange(n_texts, dtype=np.uint64), np.diff(table.starts))
    codes = table.codes.astype(np.uint64)
    # 64-bit hash of the text's number and the window's words; the number is spread first, as
    # it and the codes are small numbers, of which many have the same XOR.
    h = text[: n - window + 1] * _MIX
    for k in range(window):
        h = (h ^ codes[k : n - window + 1 + k]) * _MIX
        h ^= h >> np.uint64(29)
    inside = np.flatnonzero(text[: n - window + 1] == text[window - 1 :])
    h = h[inside]
    ordered = np.sort(h)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    covered = np.zeros(n, np.int64)
    if len(twice):
        at = np.minimum(np.searchsorted(twice, h), len(twice) - 1)
        first = inside[twice[at] == h]
        # The hash only picks: windows are equal if their text and all their words are.
        keys = [text[first], *(table.codes[first + k] for k in range(window))]
        order = np.lexsort(keys)
        equal = np.logical_and.reduce([np.diff(key[order]) == 0 for key in keys])
        first = first[order[np.append(equal, False) | np.insert(equal, 0, False)]]
        for k in range(window):
            covered[first + k] = 1
    return segment_sums(covered, table.starts)


def _line_repeats(text: str) -> int:
    lines = [line for line in text.split("\n") if line.strip(_SPACE)]
    return len(lines) - len(set(lines))


def _counts(texts: pa.Array, table: WordTable) -> list[np.ndarray]:
    plain = texts.to_pylist()
    spaces = [sum(map(t.count, _SPACE)) for t in plain]
    lengths = pc.utf8_length(texts).to_numpy().astype(np.int64)
    return [
        np.diff(table.starts),
        lengths - np.array(spaces, np.int64),
        np.array([sum(map(t.count, _SYMBOLS)) for t in plain], np.int64),
        np.array([_line_repeats(t) for t in plain], np.int64),
        repeated_words(table),
    ]


def best_windows(loss: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Mean loss of the best windows of each text, whose symbols are
    ``loss[starts[i]:starts[i + 1]]``. The last window that fits in the share counts in part;
    a short text is one window."""
    n = np.diff(starts)
    windows = np.maximum(1, np.rint(n / WINDOW)).astype(np.int64)
    first = np.concatenate([[0], np.cumsum(windows)])
    text = np.repeat(np.arange(len(n)), windows)
    place = np.arange(first[-1]) - first[text]
    begin = starts[text] + place * n[text] // windows[text]
    mean = np.add.reduceat(loss, begin) / np.diff(np.append(begin, starts[-1]))
    ordered = mean[np.lexsort((mean, text))]
    weight = np.clip(KEPT_SHARE * windows[text] - place, 0, 1)
    return segment_sums(weight * ordered, first) / (KEPT_SHARE * windows)


def _cross_entropy(block: pa.RecordBatch, models: dict[str, Model]) -> np.ndarray:
    """Nats per symbol of the best windows under the own language's model; NaN without one."""
    out = np.full(block.num_rows, np.nan)
    for name, rows, grams in parts_by_language(block):
        if name in models:
            loss = -models[name].log_probability(grams.grams)[grams.codes]
            out[rows] = best_windows(loss, grams.starts)
    return out


def train(docs: DataFrame, text: str = "text", language: str = "lang") -> dict[str, Model]:
    """Modified Kneser-Ney models of all languages, from all documents."""
    return fit(
        write_through(count_text_grams(docs, text, language), "quality-grams"), modified=True
    )


def apply_rules(
    df: DataFrame,
    models: dict[str, Model],
    text: str = "text",
    language: str = "lang",
    keep_text: bool = False,
    min_words: int = MIN_WORDS,
    max_repeat_percent: int = MAX_REPEAT_PERCENT,
    below: float = BELOW,
    above: float = ABOVE,
) -> DataFrame:
    """Add the counts, ``base_failed``, ``perplexity``, ``low``, ``high`` and ``kept``.

    Words are runs without white space. A null text has no words, and a text without words
    fails the counts. A null language is a language of its own, and a null text an empty one.
    A band needs documents that pass the counts; a document without a band or a perplexity is
    judged by counts alone. Equal rows get equal verdicts; an empty table gives an empty result.
    The text is left out unless ``keep_text``; input columns named as new ones are replaced.
    """
    new = (*COUNTS, "base_failed", "perplexity", "low", "high", "kept")
    kept = [c for c in df.columns if c not in new and (keep_text or c != text)]
    shared = df.sparkSession.sparkContext.broadcast(models)
    rows = df.select(
        F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"),
        F.coalesce(F.col(f"`{language}`").cast("string"), F.lit("")).alias("language"),
        F.col(f"`{text}`").alias("text"),
    )
    numbers = ", ".join(f"{c} bigint" for c in COUNTS)
    schema = schema_with(
        rows, ["row", "language"], f"{numbers}, length bigint, cross_entropy double"
    )

    def task(batches) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text"):
            texts = texts_of(block)
            table = word_table(texts)
            columns = [pa.array(c) for c in _counts(texts, table)]
            columns.append(pc.utf8_length(texts).cast(pa.int64()))
            columns.append(pa.array(_cross_entropy(block, shared.value), from_pandas=True))
            yield pa.RecordBatch.from_arrays(
                [block.column("row"), block.column("language"), *columns], names=schema.names
            )

    failed = (F.col("n_words") < min_words) | (
        100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words")
    )
    counted = write_through(
        rows.mapInArrow(task, schema).withColumn("base_failed", failed), "quality"
    )
    passing = counted.where("NOT base_failed")
    middle = F.percentile_approx("cross_entropy", 0.5, 10_000).alias("median")
    medians = passing.groupBy("language").agg(middle)
    # One row per language that has a model; models are on every machine already.
    n = F.col("length") + 1
    scale = F.sqrt(n / (n + SPREAD))
    deviation = (F.col("cross_entropy") - F.col("median")) * scale
    quarters = F.percentile_approx(deviation, [0.25, 0.75], 10_000)
    bands = (
        passing.join(F.broadcast(medians), "language")
        .groupBy("language")
        .agg(F.first("median").alias("median"), quarters.alias("q"))
        .select("language", "median", (F.col("q")[1] - F.col("q")[0]).alias("range"))
    )
    banded = (
        counted.join(F.broadcast(bands), "language", "left")
        .withColumn("least", F.col("median") - below * F.col("range") / scale)
        .withColumn("most", F.col("median") + above * F.col("range") / scale)
    )
    inside = F.col("cross_entropy").between(F.col("least"), F.col("most"))
    return banded.select(
        *[F.col("row")[c].alias(c) for c in kept],
        *COUNTS,
        "base_failed",
        F.exp("cross_entropy").alias("perplexity"),
        F.exp("least").alias("low"),
        F.exp("most").alias("high"),
        (~F.col("base_failed") & F.coalesce(inside, F.lit(True))).alias("kept"),
    )
