"""Multi-format timestamp parsing (SCL-12)."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted date layouts, tried in this order.
TIMESTAMP_FORMATS = (
    "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd'T'HH:mm:ss.SSSxxx",
    "MM/dd/yyyy HH:mm:ss.SSSSSS",
    "MM/dd/yyyy HH:mm:ss",
)


def _fixed_characters(layout: str) -> set[str]:
    """Characters every text in this layout holds: separators and quoted letters."""
    quoted = re.findall(r"'([^']*)'", layout)
    plain = re.sub(r"'[^']*'|[A-Za-z]", "", layout)
    return set(plain) | set("".join(quoted))


def parse_timestamp(c: Column, formats: tuple[str, ...] = TIMESTAMP_FORMATS) -> Column:
    """First layout that parses; null when none does (never an ANSI error).

    A failing parse costs an exception inside the parser, many times a search for a
    character. So a layout is tried only on texts that hold the fixed characters setting
    it apart from the other layouts; texts without them could not match it.
    """
    shared = set.intersection(*map(_fixed_characters, formats))

    def attempt(layout: str) -> Column:
        telling = sorted(_fixed_characters(layout) - shared)
        parsed = F.try_to_timestamp(c, F.lit(layout))
        if not telling:
            return parsed
        possible = reduce(lambda a, b: a & b, [F.contains(c, F.lit(x)) for x in telling])
        return F.when(possible, parsed)

    return F.coalesce(*[attempt(f) for f in formats])
