"""Two-valued predicates shared by the quality rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def non_blank(c: Column) -> Column:
    """PRJ-26: not null and not only spaces. Never null, so ``~`` is its exact negation."""
    return c.isNotNull() & (F.trim(c.cast("string")) != "")
