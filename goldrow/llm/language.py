"""Language identification by character models.

Each language of the labelled rows gets an interpolated Kneser-Ney model. A text goes to the
language whose model needs the fewest nats per symbol over all of its words. A text that
even the best model finds unusual is marked as rejected: its cross-entropy lies above what
all but one in a thousand of that language's own training texts need.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldrow.llm.kneser_ney import Model, count_grams, fit, grams_of, word_scores
from goldrow.llm.words import blocks, schema_with, texts_of, word_table
from goldrow.session import write_through

#: The language of texts without letters.
UNDETERMINED = "und"
#: Share of a language's training texts whose cross-entropy is accepted.
ACCEPTED = 0.999
#: Symbols from which on more text makes a score no surer.
SURE_SYMBOLS = 50


def train(labelled: DataFrame, text: str = "text", language: str = "lang") -> dict[str, Model]:
    """Models from all rows with a language. Case is ignored."""
    rows = labelled.where(F.col(f"`{language}`").isNotNull())
    counts = count_grams(rows, text, language, fold_case=True)
    return fit(write_through(counts, "language-grams"), modified=False)


def _identify(texts: pa.Array, models: dict[str, Model]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Language, score and cross-entropy of each text."""
    names = sorted(models)
    table = word_table(texts)
    letters = pc.match_substring_regex(table.words, r"\pL").to_numpy(zero_copy_only=False)
    grams = grams_of(table.words, fold_case=True)
    lengths = np.where(letters, np.diff(grams.starts), 0)
    symbols = table.sums(lengths)
    n = np.maximum(symbols, 1)
    entropy = np.full((len(names), len(symbols)), np.inf)
    for i, name in enumerate(names):
        entropy[i] = -table.sums(np.where(letters, word_scores(models[name], grams), 0.0)) / n
    some = symbols > 0
    if not names:
        nothing = np.zeros(len(symbols))
        return pa.array([UNDETERMINED] * len(symbols)), nothing, nothing
    best = entropy.argmin(axis=0)
    least = entropy.min(axis=0)
    # Odds of the best language over all, from the nats of up to SURE_SYMBOLS symbols.
    odds = np.exp(-(entropy - least) * np.minimum(n, SURE_SYMBOLS)).sum(axis=0)
    language = pa.array([*names, UNDETERMINED]).take(pa.array(np.where(some, best, len(names))))
    return language, np.where(some, 1 / odds, 0.0), np.where(some, least, 0.0)


def identify(
    df: DataFrame, models: dict[str, Model], text: str = "text", accepted: Column | None = None
) -> DataFrame:
    """Add ``lang_pred``, ``score`` (0 to 1), ``cross_entropy`` and ``rejected``; leave the
    text out.

    A null text, or one without letters, is ``und`` with score 0, as every text is if there
    is no model. ``accepted`` says which rows calibrate the rejection: of each predicted
    language, the share ``ACCEPTED`` of these is below its threshold. Without such rows no
    text is rejected.
    """
    new = ("lang_pred", "score", "cross_entropy", "rejected")
    kept = [c for c in df.columns if c not in new and c != text]
    rows = df.select(
        F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"),
        (F.lit(False) if accepted is None else F.coalesce(accepted, F.lit(False))).alias("own"),
        F.col(f"`{text}`").alias("text"),
    )
    shared = df.sparkSession.sparkContext.broadcast(models)
    schema = schema_with(
        rows, ["row", "own"], "lang_pred string, score double, cross_entropy double"
    )

    def task(batches) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text"):
            found = _identify(texts_of(block), shared.value)
            columns = [block.column("row"), block.column("own"), found[0]]
            columns += [pa.array(found[1]), pa.array(found[2])]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    scored = write_through(rows.mapInArrow(task, schema), "languages")
    limits = scored.where("own").groupBy("lang_pred").agg(
        F.percentile_approx("cross_entropy", ACCEPTED, 100_000).alias("limit")
    )
    return scored.join(F.broadcast(limits), "lang_pred", "left").select(
        *[F.col("row")[c].alias(c) for c in kept],
        "lang_pred",
        "score",
        "cross_entropy",
        F.coalesce(F.col("cross_entropy") > F.col("limit"), F.lit(False)).alias("rejected"),
    )
