"""Column helpers; every one is a composition of built-in Spark functions."""

from aeroflow.functions.bands import band, min_max_scale
from aeroflow.functions.casts import (
    array_size,
    as_double,
    as_numeric,
    as_time,
    json_number,
    typed_null,
)
from aeroflow.functions.text import (
    any_selected,
    json_paths,
    json_record,
    message_text,
    paths_schema,
)

__all__ = [
    "any_selected",
    "array_size",
    "as_double",
    "as_numeric",
    "as_time",
    "band",
    "json_number",
    "json_paths",
    "json_record",
    "message_text",
    "min_max_scale",
    "paths_schema",
    "typed_null",
]
