"""The corpus pipeline: operators in a row, each over all that the one before kept.

Every stage takes and returns the columns of ``documents``, but for the last one, which
returns the place of each piece of text in the packed sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from goldrow.llm import quality_rules, similar, suffixes, toxicity
from goldrow.llm.queries import learn_toxicity, pack_documents
from goldrow.session import share_package, write_through


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    share_package(spark)
    judged = quality_rules.apply_rules(docs, quality_rules.train(docs), keep_text=True)
    return judged.where("kept").select(*docs.columns)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted to be toxic."""
    share_package(spark)
    classifier = learn_toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = toxicity.score(docs, classifier, keep_text=True)
    return scored.where("predicted = 0").select(*docs.columns)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id, and documents
    without an id, which belong to no group.

    Near-duplicates share four fifths of their five-word shingles. ``op5``'s fingerprints,
    up to seven bits apart and not three, give the first candidates; minima of the shingles
    give those that are further apart."""
    share_package(spark)
    found = similar.near_duplicates(docs, "doc_id")
    dropped = write_through(
        found.where("doc_id <> component_id").select("doc_id").distinct(), "near-duplicates"
    )
    return docs.join(dropped, "doc_id", "left_anti").select(*docs.columns)


def unrepeated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages that occur elsewhere too."""
    share_package(spark)
    left = suffixes.remove_repeats(docs, as_text=True)
    renewed = {"text": F.col("kept"), "n_chars": F.char_length("kept").cast("bigint")}
    return left.select(*[renewed.get(c, F.col(f"`{c}`")).alias(c) for c in docs.columns])


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequence and offset of every piece of every document."""
    share_package(spark)
    return pack_documents(docs)


STAGES = [
    ("quality rules", quality),
    ("toxicity", clean),
    ("SimHash near-dedup", distinct),
    ("suffix-array dedup", unrepeated),
    ("best-fit packing", packed),
]

#: The stages learn models and hash text, which SQL does not express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES[:-1], 1):
        docs = write_through(stage(spark, docs, sf_dir), f"stage-{number}")
    return STAGES[-1][1](spark, docs, sf_dir)
