"""Document feed: work list and RAW rows (SRC-10, SRC-11)."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Work-list states, source name, keys a document must have, promoted fields.
OPEN_STATES = ("ACTIVE", "PENDING")
FEED_SOURCE = "IQVIA_API"
REQUIRED_KEYS = {"HCP": ("First Name", "Last Name"), "HCO": ("Organization Name",)}
PROMOTED = {
    "HCP": {
        "title": "Title",
        "first_name": "First Name",
        "middle_name": "Middle Name",
        "last_name": "Last Name",
        "full_name": "Full Name",
        "gender": "Gender",
        "professional_type": "Professional Type",
    },
    "HCO": {
        "organization_name": "Organization Name",
        "organization_type": "Organization Type",
    },
}


def pending_entities(
    work: DataFrame, types: Sequence[str] | None = None, limit: int | None = None
) -> DataFrame:
    """SRC-10: open entities by priority, then id."""
    out = work.where(F.col("status").isin(*OPEN_STATES))
    if types:
        out = out.where(F.col("entity_type").isin(*types))
    out = out.select("entity_id", "entity_type", "country_code", "priority")
    out = out.orderBy("priority", "entity_id")
    return out.limit(limit) if limit else out


def feed_to_raw(documents: DataFrame, entity_type: str, run_time: datetime) -> DataFrame:
    """SRC-11: RAW rows from (entity_id, entity_type, country_code, response_json).

    Documents of the other type, unreadable ones and those lacking a required key are
    dropped. A key with a JSON null is present and gives null; an absent promoted field
    gives ''. The top level is parsed once into a map of texts.
    """
    required, promoted = REQUIRED_KEYS[entity_type], PROMOTED[entity_type]
    top = F.from_json("response_json", "map<string,string>")
    present: Column = reduce(
        lambda a, b: a & b, [F.map_contains_key("_top", F.lit(k)) for k in required]
    )

    def field(key: str) -> Column:
        known = F.map_contains_key("_top", F.lit(key))
        return F.when(known, F.col("_top").getItem(key)).otherwise(F.lit(""))

    stamp = F.lit(run_time.isoformat())
    return (
        documents.where(F.col("entity_type") == entity_type)
        .withColumn("_top", top)
        .where(present)
        .select(
            F.col("entity_id").cast("string").alias("iqvia_id"),
            F.col("entity_type").alias("mdm_entity_type"),
            "country_code",
            "response_json",
            stamp.alias("create_date"),
            stamp.alias("load_date"),
            F.lit(FEED_SOURCE).alias("source_name"),
            F.lit(f"API_{entity_type}_{run_time:%Y%m%d_%H%M%S}").alias("batch_id"),
            *[field(key).alias(name) for name, key in promoted.items()],
        )
    )
