"""Casts of external text. Bad text gives NULL whether or not ANSI mode is on."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from aeroflow.schemas import NUMERIC


def as_numeric(text: Column) -> Column:
    return text.try_cast(NUMERIC)


def as_double(text: Column) -> Column:
    return text.try_cast("double")


def as_time(text: Column) -> Column:
    """ISO-8601 text to an instant; an offset in the text is honoured."""
    return F.try_to_timestamp(text)


def json_number(json_text: Column, path: str) -> Column:
    return as_double(F.get_json_object(json_text, path))


def typed_null(ddl_type: str) -> Column:
    return F.lit(None).cast(ddl_type)


def array_size(array: str | Column) -> Column:
    """Number of elements; 0 for a NULL array in every ANSI setting."""
    return F.coalesce(F.array_size(array), F.lit(0))
