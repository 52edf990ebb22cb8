"""Reading values out of JSON text (SCL-14, SCL-15)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def json_text(c: Column, path: str) -> Column:
    """Dotted path with ``[i]``: scalar as text, object as JSON text, else null."""
    return F.get_json_object(c, f"$.{path}")


def step_path(*steps: str | int) -> str:
    """``('HCP Address', 0, 'City')`` -> ``$['HCP Address'][0]['City']``."""
    return "$" + "".join(f"[{s}]" if isinstance(s, int) else f"['{s}']" for s in steps)


def parsed(c: Column) -> Column:
    """JSON text as a variant; bad text gives null instead of failing the job."""
    return F.try_parse_json(c)


def variant_text(v: Column, *steps: str | int) -> Column:
    """Text at a path of a parsed document; keys may hold blanks and dots."""
    return F.try_variant_get(v, step_path(*steps), "string")
