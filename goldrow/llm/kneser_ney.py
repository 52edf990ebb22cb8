"""Interpolated Kneser-Ney character models, one per language, counted by Spark.

A symbol is predicted from the up to three before it. Models of words (``grams_of``) stop at
the borders of a word, which are a symbol too, so a word's score is the same wherever it
stands: blocks of texts count and score each distinct word once. Models of running text
(``text_grams``) go over the borders, so the order of words and their sentence marks count;
white space of any kind is a border there. A symbol is the low 16 bits of a code point:
characters beyond the first plane fall on others.

Spark counts the four-symbol grams of all texts, and a model keeps every one of them: the
discounts are estimated from how many grams occur once to four times, and shorter contexts
count the distinct symbols before them, so a gram left out would bend both. Grams are those
of distinct words, whose number grows far slower than the text.
A model is stored as sorted arrays of gram hashes beside log probabilities, and of context
hashes beside log back-off weights.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldrow.llm.words import blocks, texts_of, word_table

ORDER = 4
#: Distinct grams of all languages that models are built from in the driver's memory.
MAX_GRAMS = 1 << 23
#: Bits of a symbol in a gram; symbols of equal low bits are one.
_BITS = 16
_BORDER = " "


@dataclass
class Grams:
    """Grams of distinct words: word w has the grams ``codes[starts[w]:starts[w + 1]]``,
    which are places in ``grams``."""

    grams: np.ndarray
    codes: np.ndarray
    starts: np.ndarray


def grams_of(words: pa.Array, fold_case: bool) -> Grams:
    """One gram per symbol of a word and one for its end."""
    if not len(words):
        return Grams(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(1, np.int64))
    between = _BORDER * (ORDER - 1)
    text = between + between.join(words.to_pylist()) + between
    if fold_case:
        text = text.lower()
    symbols = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    border = symbols == ord(_BORDER)
    symbols = (symbols & ((1 << _BITS) - 1)).astype(np.uint64)
    code = symbols[ORDER - 1 :].copy()
    for back in range(1, ORDER):
        code |= symbols[ORDER - 1 - back : len(symbols) - back] << np.uint64(_BITS * back)
    # Symbols, and the first border behind each word.
    wanted = ~border[ORDER - 1 :] | ~border[ORDER - 2 : -1]
    last = np.cumsum(wanted)[border[ORDER - 1 :] & wanted]
    encoded = pa.array(code[wanted]).dictionary_encode()
    return Grams(
        encoded.dictionary.to_numpy(), encoded.indices.to_numpy(), np.concatenate([[0], last])
    )


def text_grams(texts: list[str]) -> Grams:
    """One gram per symbol of a text and one for its end, each after the three before it;
    before a text stand borders."""
    lengths = np.array([len(t) for t in texts], np.int64)
    between = _BORDER * (ORDER - 1)
    text = between + between.join(texts) + between
    symbols = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    space = (symbols >= 9) & (symbols <= 13)
    symbols = np.where(space, np.uint32(ord(_BORDER)), symbols & ((1 << _BITS) - 1)).astype(np.uint64)
    code = symbols[ORDER - 1 :].copy()
    for back in range(1, ORDER):
        code |= symbols[ORDER - 1 - back : len(symbols) - back] << np.uint64(_BITS * back)
    # Of the borders behind a text only the first is predicted.
    ends = np.cumsum(lengths + ORDER - 1)
    wanted = np.ones(len(code), bool)
    for back in range(1, ORDER - 1):
        wanted[ends - back] = False
    encoded = pa.array(code[wanted]).dictionary_encode()
    return Grams(
        encoded.dictionary.to_numpy(),
        encoded.indices.to_numpy(),
        np.concatenate([[0], np.cumsum(lengths + 1)]),
    )


#: Bytes of text whose running grams are at hand at a time.
PART_BYTES = 2 << 20


def parts_by_language(block: pa.RecordBatch) -> Iterator[tuple[str, np.ndarray, Grams]]:
    """The running grams of a block (language, text), in parts of one language: its name, the
    rows of the part, and their grams."""
    languages = block.column("language").dictionary_encode()
    for code, name in enumerate(languages.dictionary.to_pylist()):
        rows = np.flatnonzero(languages.indices.to_numpy() == code)
        own = block.select(["text"]).append_column("row", pa.array(np.arange(block.num_rows)))
        for part in blocks([own.take(pa.array(rows))], "text", PART_BYTES):
            yield name, part.column("row").to_numpy(), text_grams(texts_of(part).to_pylist())


def count_text_grams(df: DataFrame, text: str = "text", language: str = "lang") -> DataFrame:
    """Rows (language, gram, n) of the running grams of all texts.

    A null language counts as the language '', a null text as an empty one.
    """

    def task(batches) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text"):
            held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
            for name, _, grams in parts_by_language(block):
                n = np.bincount(grams.codes, minlength=len(grams.grams))
                held.setdefault(name, []).append((grams.grams, n))
            for name, parts in held.items():
                found, codes = np.unique(np.concatenate([g for g, _ in parts]), return_inverse=True)
                n = np.bincount(codes, np.concatenate([n for _, n in parts]), len(found))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([name], pa.string()).take(pa.array(np.zeros(len(found), np.int32))),
                        pa.array(found.view(np.int64)),
                        pa.array(n.astype(np.int64)),
                    ],
                    names=["language", "gram", "n"],
                )

    rows = df.select(
        F.coalesce(F.col(f"`{language}`").cast("string"), F.lit("")).alias("language"),
        F.col(f"`{text}`").alias("text"),
    )
    counted = rows.mapInArrow(task, "language string, gram bigint, n bigint")
    return counted.groupBy("language", "gram").agg(F.sum("n").alias("n"))


def count_grams(
    df: DataFrame, text: str = "text", language: str = "lang", fold_case: bool = False
) -> DataFrame:
    """Rows (language, gram, n) over all words of all texts.

    A null language counts as the language ''. A null text has no words.
    """

    def task(batches) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text"):
            table = word_table(texts_of(block))
            grams = grams_of(table.words, fold_case)
            per_gram = np.repeat(np.arange(len(table.words)), np.diff(grams.starts))
            languages = block.column("language").dictionary_encode()
            of_text = np.repeat(languages.indices.to_numpy(), np.diff(table.starts))
            for code, name in enumerate(languages.dictionary.to_pylist()):
                times = np.bincount(table.codes[of_text == code], minlength=len(table.words))
                n = np.bincount(grams.codes, times[per_gram], len(grams.grams)).astype(np.int64)
                held = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([name], pa.string()).take(pa.array(np.zeros(len(held), np.int32))),
                        pa.array(grams.grams[held].view(np.int64)),
                        pa.array(n[held]),
                    ],
                    names=["language", "gram", "n"],
                )

    rows = df.select(
        F.coalesce(F.col(f"`{language}`").cast("string"), F.lit("")).alias("language"),
        F.col(f"`{text}`").alias("text"),
    )
    counted = rows.mapInArrow(task, "language string, gram bigint, n bigint")
    return counted.groupBy("language", "gram").agg(F.sum("n").alias("n"))


def _hash(grams: np.ndarray, order: int) -> np.ndarray:
    """64-bit finalizer over the gram and its order."""
    h = grams + np.uint64(order * 0x9E3779B97F4A7C15 & (2**64 - 1))
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class _HashArray:
    """Values by the sorted hashes of their grams."""

    def __init__(self, grams: np.ndarray, order: int, values: np.ndarray):
        hashes = _hash(grams, order)
        by_hash = np.argsort(hashes)
        self.order, self.hashes = order, hashes[by_hash]
        self.values = values[by_hash].astype(np.float32)

    def get(self, grams: np.ndarray, default: float) -> np.ndarray:
        if not len(self.hashes):
            return np.full(len(grams), default)
        wanted = _hash(grams, self.order)
        at = np.minimum(np.searchsorted(self.hashes, wanted), len(self.hashes) - 1)
        return np.where(self.hashes[at] == wanted, self.values[at], default)


def _discounts(n: np.ndarray, modified: bool) -> np.ndarray:
    """Discount of each count; those of 1, 2, and 3 or more differ if ``modified``."""
    ones, twos, threes, fours = (max(int((n == k).sum()), 1) for k in (1, 2, 3, 4))
    y = ones / (ones + 2 * twos)
    if not modified:
        return np.full(len(n), y)
    steps = [1 - 2 * y * twos / ones, 2 - 3 * y * threes / twos, 3 - 4 * y * fours / threes]
    # Counts of counts that do not fall make an estimate leave its range.
    steps = [s if 0 < s < k else y for k, s in enumerate(steps, 1)]
    return np.array([0.0, *steps])[np.minimum(n, 3)]


class Model:
    """Log probabilities of grams of one language."""

    def __init__(self, grams: np.ndarray, n: np.ndarray, modified: bool):
        low = np.uint64(_BITS)
        by_order: list[tuple[np.ndarray, np.ndarray]] = [(grams, n)]
        for order in range(ORDER - 1, 0, -1):
            shorter = by_order[0][0] & np.uint64((1 << (_BITS * order)) - 1)
            by_order.insert(0, np.unique(shorter, return_counts=True))
        self.grams: list[_HashArray] = []
        self.contexts: list[_HashArray] = []
        symbols = len(by_order[0][0]) + 1
        self.unknown = -np.log(symbols)
        below_keys, below = np.zeros(0, np.uint64), np.zeros(0)
        for order, (keys, count) in enumerate(by_order, 1):
            by_key = np.argsort(keys)
            keys, count = keys[by_key], count[by_key]
            context = keys >> low if order > 1 else np.zeros(len(keys), np.uint64)
            contexts, starts = np.unique(context, return_index=True)
            discount = _discounts(count, modified)
            total = np.add.reduceat(count, starts).astype(float) if len(keys) else np.zeros(0)
            weight = np.add.reduceat(discount, starts) / total if len(keys) else np.zeros(0)
            at = np.searchsorted(contexts, context)
            if order == 1:
                lower = np.full(len(keys), 1 / symbols)
            else:
                suffix = keys & np.uint64((1 << (_BITS * (order - 1))) - 1)
                lower = below[np.searchsorted(below_keys, suffix)]
            p = (count - discount) / total[at] + weight[at] * lower
            self.grams.append(_HashArray(keys, order, np.log(p)))
            self.contexts.append(_HashArray(contexts, order, np.log(weight)))
            below_keys, below = keys, p

    def log_probability(self, grams: np.ndarray) -> np.ndarray:
        """Per gram, the log probability of its last symbol after the others."""
        out = np.zeros(len(grams))
        left = np.arange(len(grams))
        for order in range(ORDER, 0, -1):
            keys = grams[left] & np.uint64((1 << (_BITS * order)) - 1 if order < 4 else 2**64 - 1)
            found = self.grams[order - 1].get(keys, np.nan)
            known = ~np.isnan(found)
            out[left[known]] += found[known]
            left, keys = left[~known], keys[~known]
            if not len(left):
                return out
            context = keys >> np.uint64(_BITS) if order > 1 else np.zeros(len(keys), np.uint64)
            # A context never seen leaves everything to the shorter one.
            out[left] += self.contexts[order - 1].get(context, 0.0)
        out[left] += self.unknown
        return out


def fit(counts: DataFrame, modified: bool, max_grams: int = MAX_GRAMS) -> dict[str, Model]:
    """A model per language from a stored table of counts, of all grams in it.

    The grams come to the driver once their number is known to fit there; more than
    ``max_grams`` are an error, and none is left out.
    """
    found = counts.count()
    if found > max_grams:
        raise ValueError(f"{found} distinct grams are more than the {max_grams} that fit")
    kept = counts.select("language", "gram", "n").toArrow()
    models = {}
    for name in sorted(pc.unique(kept["language"]).to_pylist()):
        own = kept.filter(pc.equal(kept["language"], name))
        grams = own["gram"].to_numpy().view(np.uint64)
        models[name] = Model(grams, own["n"].to_numpy(), modified)
    return models


def word_scores(model: Model, grams: Grams) -> np.ndarray:
    """Log probability of each word."""
    values = model.log_probability(grams.grams)[grams.codes]
    return np.add.reduceat(values, grams.starts[:-1]) if len(values) else np.zeros(0)

