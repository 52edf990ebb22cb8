"""Frozen descriptions of tables, rules and mappings."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame


@dataclass(frozen=True)
class StandardizeRule:
    """One configured text rule: registered function name and the column it rewrites."""

    function: str
    column: str


@dataclass(frozen=True)
class DQRule:
    table: str
    rule: str
    description: str
    column: str
    target: str


@dataclass(frozen=True)
class FieldMap:
    """Canonical mapping row. ``source`` may be any SQL expression, or None for null."""

    source: str | None
    target: str | None
    join: str | None = None


@dataclass(frozen=True)
class JoinSpec:
    """A table joined to the delta (alias ``n``) before canonical mapping."""

    table: DataFrame
    alias: str
    on: str
    how: str = "left"


@dataclass(frozen=True)
class TypedField:
    """Ingress mapping row: physical source column, target table, target column, type."""

    source_table: str
    source: str
    target_table: str
    target: str
    type: str


@dataclass(frozen=True)
class Json:
    """Mart value read from the document at these steps."""

    steps: tuple[str | int, ...]


@dataclass(frozen=True)
class Col:
    """Mart value copied from a column."""

    name: str


@dataclass(frozen=True)
class Null:
    """Mart value the feed lacks."""
