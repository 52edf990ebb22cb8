"""Staging views, consolidations and masters (DOC-02..04, JON-11, JON-12, PRJ-13..18)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldrow.functions.jsontext import parsed, variant_text
from goldrow.operators.schema import rename
from goldrow.operators.skew import left_join_all
from goldrow.plans import catalog
from goldrow.plans.specs import Col, Json, Null

KEY = "SOURCE_FK"


def staging_view(df: DataFrame, view: str, key: str = "iqvia_id") -> DataFrame:
    """One staging view: the key plus values from the document, a column, or null.

    Documents that do not parse give nulls. Each document is parsed once.
    """
    if view in catalog.EMPTY_VIEWS:
        names = (KEY, *catalog.EMPTY_VIEWS[view])
        return df.where(F.lit(False)).select(
            *[F.lit(None).cast("string").alias(n) for n in names]
        )
    spec = catalog.STAGING_VIEWS[view]

    def value(item: Json | Col | Null) -> Column:
        if isinstance(item, Json):
            return variant_text(F.col("_doc"), *item.steps)
        if isinstance(item, Col):
            return F.col(item.name)
        return F.lit(None).cast("string")

    base = df
    if any(isinstance(i, Json) for i in spec.values()):
        base = df.withColumn("_doc", parsed(F.col("response_json")))
    return base.select(
        F.col(key).alias(KEY), *[value(item).alias(name) for name, item in spec.items()]
    )


def _consolidate(
    views: Mapping[str, DataFrame],
    anchor: str,
    columns: Sequence[tuple[str, str, str]],
    pieces: int | None,
) -> DataFrame:
    """Left-join every other view onto the anchor by key; only needed columns travel."""

    def side(view: str) -> DataFrame:
        own = [(s, t) for v, s, t in columns if v == view]
        return rename(views[view], [(KEY, KEY), *own])

    others = dict.fromkeys(v for v, _, _ in columns if v != anchor)
    out = left_join_all(
        side(anchor),
        [side(v) for v in others],
        [KEY],
        pieces=pieces,
    )
    return out.select(KEY, *[t for _, _, t in columns])


def _consolidated_rows(
    views: Mapping[str, DataFrame], anchor: str, columns: Sequence[tuple[str, str, str]]
) -> DataFrame:
    """Rows a consolidation has (``row_count``), without building it.

    A key gives the product of its rows in the views; a view without it counts once. Rows
    without a key stay alone. Views are counted per key in one shuffle.
    """
    names = [anchor, *dict.fromkeys(v for v, _, _ in columns if v != anchor)]
    keys = reduce(
        lambda a, b: a.unionByName(b),
        [views[v].select(F.col(KEY).alias("k"), F.lit(i).alias("v")) for i, v in enumerate(names)],
    )
    per_key = keys.groupBy("k").agg(
        *[F.count_if(F.col("v") == i).alias(f"n{i}") for i in range(len(names))]
    )
    product = F.col("n0")
    for i in range(1, len(names)):
        product = product * F.when(F.col("k").isNull(), 1).otherwise(F.greatest(F.col(f"n{i}"), F.lit(1)))
    return per_key.agg(F.coalesce(F.sum(product), F.lit(0)).alias("row_count"))


def person_rows(views: Mapping[str, DataFrame]) -> DataFrame:
    """Rows of ``consolidate_person``."""
    return _consolidated_rows(views, catalog.PERSON_ANCHOR, catalog.PERSON_COLUMNS)


def organization_rows(views: Mapping[str, DataFrame]) -> DataFrame:
    """Rows of ``consolidate_organization``."""
    return _consolidated_rows(views, catalog.ORGANIZATION_ANCHOR, catalog.ORGANIZATION_COLUMNS)


def consolidate_person(
    views: Mapping[str, DataFrame],
    *,
    pieces: int | None = None,
) -> DataFrame:
    """JON-11: the name view with 13 child views; several child rows fan the person out."""
    return _consolidate(
        views, catalog.PERSON_ANCHOR, catalog.PERSON_COLUMNS, pieces
    )


def consolidate_organization(
    views: Mapping[str, DataFrame],
    *,
    pieces: int | None = None,
) -> DataFrame:
    """JON-12: the address view with five others."""
    return _consolidate(
        views, catalog.ORGANIZATION_ANCHOR, catalog.ORGANIZATION_COLUMNS, pieces
    )


def person_master(person: DataFrame) -> DataFrame:
    """PRJ-13."""
    return rename(person, catalog.PERSON_MASTER)


def person_child_master(table: str, rows: DataFrame) -> DataFrame:
    """PRJ-14: hub child table under its master names."""
    return rename(rows, catalog.PERSON_CHILD_MASTERS[table])


def organization_ingress(target: str, view: DataFrame) -> DataFrame:
    """PRJ-15."""
    return rename(view, catalog.ORGANIZATION_INGRESS[target])


def organization_master(consolidated: DataFrame) -> DataFrame:
    """PRJ-16: the consolidated columns as they are."""
    return consolidated.select(KEY, *[t for _, _, t in catalog.ORGANIZATION_COLUMNS])


def organization_child_master(target: str, ingress: DataFrame) -> DataFrame:
    """PRJ-16: ingress columns; three of the four children leave out the source system."""
    if target in catalog.MASTERS_WITHOUT_SOURCE:
        return ingress.drop("sourceSystem")
    return ingress
