from goldrow.functions.jsontext import json_text, parsed, step_path, variant_text
from goldrow.functions.predicates import non_blank
from goldrow.functions.temporal import TIMESTAMP_FORMATS, parse_timestamp
from goldrow.functions.text import STANDARDIZERS, full_name, hashed_key, preview

__all__ = [
    "STANDARDIZERS",
    "TIMESTAMP_FORMATS",
    "full_name",
    "hashed_key",
    "json_text",
    "non_blank",
    "parse_timestamp",
    "parsed",
    "preview",
    "step_path",
    "variant_text",
]
