"""Text standardization as Column -> Column functions (SCL-01..11, SCL-16).

All of them are built-in expressions, so a whole rule set folds into one
code-generated projection.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

Standardizer = Callable[[Column], Column]


def trim(c: Column) -> Column:
    """Strip spaces at both ends (spaces only; a tab stays)."""
    return F.trim(c)


def upper(c: Column) -> Column:
    return F.upper(F.trim(c))


def lower(c: Column) -> Column:
    return F.lower(F.trim(c))


def proper(c: Column) -> Column:
    """Title case per blank-separated word."""
    return F.initcap(F.trim(c))


def null_if_blank(c: Column) -> Column:
    """Blank becomes null; any other value keeps its surrounding spaces."""
    return F.when(F.trim(c.cast("string")) == "", F.lit(None)).otherwise(c)


def remove_special_chars(c: Column) -> Column:
    return F.regexp_replace(c.cast("string"), "[^A-Za-z0-9 ]", "")


def normalize_phone(c: Column) -> Column:
    """Digits only; a value without digits becomes '' and not null."""
    return F.regexp_replace(c.cast("string"), "[^0-9]", "")


def normalize_postal_code(c: Column) -> Column:
    return F.upper(F.trim(c.cast("string")))


def normalize_code(c: Column) -> Column:
    return F.upper(F.trim(c.cast("string")))


#: Names that configuration rows use. Extend a copy to add a rule.
STANDARDIZERS: dict[str, Standardizer] = {
    "trim": trim,
    "upper": upper,
    "lower": lower,
    "proper": proper,
    "null_if_blank": null_if_blank,
    "remove_special_chars": remove_special_chars,
    "normalize_phone": normalize_phone,
    "normalize_postal_code": normalize_postal_code,
    "normalize_code": normalize_code,
}


def full_name(*parts: Column) -> Column:
    """Parts joined by one blank, runs of white space collapsed, ends trimmed."""
    joined = F.concat_ws(" ", *[F.coalesce(p, F.lit("")) for p in parts])
    return F.trim(F.regexp_replace(joined, r"\s+", " "))


def hashed_key(c: Column) -> Column:
    return F.upper(F.md5(F.coalesce(c.cast("string"), F.lit("")).cast("binary")))


def preview(c: Column, length: int) -> Column:
    """Leading characters of a text for a report line."""
    return F.left(c, F.lit(length))
