"""Ingress: document flattening and column mapping onto the hub's tables."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldrow.functions.jsontext import json_text, parsed
from goldrow.operators.schema import col, find_column
from goldrow.plans.catalog import INGRESS_FIELDS, INGRESS_TARGETS, SPACED_PATHS, TYPED_INGRESS

DOCUMENT = "response_json"
# Lineage columns carried along unless a mapping already produced them.
CARRIED = ("BATCH_ID", "LOAD_DATE", "SOURCE_NAME")
# Ingress type names -> Spark types.
INGRESS_TYPES = {"integer": "int", "date/time": "timestamp", "date": "date", "string": "string"}


def field_mapping(table: str, dialect: str = "spaced") -> dict[str, str]:
    """Mapping of an entity table; a new dict each time, so no caller can alter it.

    ``spaced`` reads the document names the feed writes, ``camel`` the single-word ones.
    """
    short = table.rsplit(".", 1)[-1].lower()
    spaced = SPACED_PATHS.get(short, {}) if dialect == "spaced" else {}
    out = {}
    for source, target in INGRESS_FIELDS[short].items():
        if source.startswith("json:"):
            path = source.removeprefix("json:")
            source = f"json:{spaced.get(path, path)}"
        out[source] = target
    return out


def _variant_path(path: str) -> str:
    return f"${path}" if path.startswith("[") else f"$.{path}"


def map_fields(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """DOC-01 / PRJ-10: known source columns and document paths under target names.

    ``json:`` keys are read from the document, which is parsed once per row. A plain
    key without a column is left out; if nothing matches the mapping is wrong.
    """
    has_document = find_column(df, DOCUMENT) is not None
    paths = [s for s in mapping if s.startswith("json:")] if has_document else []
    base = df.withColumn("_doc", parsed(col(find_column(df, DOCUMENT)))) if paths else df
    out: list[Column] = []
    taken = set()
    for source, target in mapping.items():
        if source in paths:
            path = _variant_path(source.removeprefix("json:"))
            value = F.try_variant_get("_doc", path, "string")
        else:
            actual = find_column(df, source)
            if actual is None:
                continue
            value = col(actual)
        out.append(value.alias(target))
        taken.add(target.lower())
    if not out:
        raise ValueError(f"no mapped column found; available: {df.columns}")
    out += [col(c) for c in df.columns if c.upper() in CARRIED and c.lower() not in taken]
    return base.select(*out)


def extract_paths(df: DataFrame, paths: Sequence[str], document: str = DOCUMENT) -> DataFrame:
    """SCL-14: add one text column per dotted path, named after the path."""
    name = lambda p: "_json_" + re.sub(r"[.\[]", "_", p).replace("]", "")
    return df.withColumns({name(p): json_text(col(document), p) for p in paths})


def to_targets(df: DataFrame, table: str, mapping: Mapping[str, str] | None = None) -> dict:
    """PRJ-12: target name -> rows; one plan shared by all targets of the table."""
    short = table.rsplit(".", 1)[-1].lower()
    rows = map_fields(df, mapping or field_mapping(short))
    return {target: rows for target in INGRESS_TARGETS[short]}


def typed_targets(df: DataFrame, table: str, physical: Mapping[str, str]) -> dict[str, DataFrame]:
    """PRJ-11 / SCL-13: typed organization mapping, grouped per physical target.

    A value that does not fit its target type becomes null.
    """
    short = table.rsplit(".", 1)[-1].lower()
    grouped: dict[str, list[Column]] = {}
    for f in TYPED_INGRESS:
        actual = find_column(df, f.source) if f.source_table == short else None
        if actual is None:
            continue
        if f.target_table not in physical:
            raise ValueError(f"no physical target configured for {f.target_table}")
        value = col(actual).try_cast(INGRESS_TYPES[f.type])
        grouped.setdefault(physical[f.target_table], []).append(value.alias(f.target))
    carried = [col(c) for c in df.columns if c.upper() in CARRIED]
    return {target: df.select(*columns, *carried) for target, columns in grouped.items()}
