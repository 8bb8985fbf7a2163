"""Text and JSON helpers for message values."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

ALL = "$__all"


def message_text(value: Column) -> Column:
    """The bytes of a message value as UTF-8 text."""
    return value.cast("string")


def json_paths(json_text: Column, paths: Mapping[str, str]) -> list[Column]:
    """One text column per ``name -> JsonPath``."""
    return [F.get_json_object(json_text, path).alias(name) for name, path in paths.items()]


PLAIN_PATH = re.compile(r"\$(\.[A-Za-z_][A-Za-z0-9_]*)+")


def paths_schema(paths: Iterable[str]) -> str | None:
    """DDL of a document with text fields at these paths.

    None when that cannot be said in a schema: for paths with an index, and when
    one path leads into another.
    """
    tree: dict = {}
    for path in paths:
        if not PLAIN_PATH.fullmatch(path):
            return None
        *parents, leaf = path.split(".")[1:]
        node = tree
        for name in parents:
            node = node.setdefault(name, {})
            if node is None:
                return None
        if node.setdefault(leaf, None) is not None:
            return None
    return _struct(tree)


def _struct(tree: dict) -> str:
    fields = (f"`{n}`:{'string' if t is None else _struct(t)}" for n, t in tree.items())
    return f"struct<{','.join(fields)}>"


def json_record(columns: Iterable[str]) -> Column:
    """A flat JSON object holding the named columns; NULL fields are left out."""
    return F.to_json(F.struct(*columns))


def any_selected(column: Column, selected: Iterable[str]) -> Column:
    """Membership test of a multi-select variable; the "All" entry lifts it."""
    values = list(selected)
    return F.lit(True) if ALL in values else column.isin(values)
