"""Messages to typed documents.

``inline(array(from_json(...)))`` is how a document is opened here. It gives the
same columns as ``select(doc.*)``, but as the output of a generator, so a filter
on a document field stays above the parse. With a plain projection Catalyst
moves that filter below it, together with a second ``from_json``, and every
document is parsed twice.
"""

from __future__ import annotations

import functools
import operator
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aeroflow import schemas
from aeroflow.functions import (
    array_size,
    json_paths,
    json_record,
    message_text,
    paths_schema,
)

RAW = "raw"
# Holds a document's text if any of its fields did not have the declared type.
CORRUPT = "_corrupt"
CHILDREN = {"frequencies": schemas.FREQUENCY_FIELDS, "runways": schemas.RUNWAY_FIELDS}


def open_document(
    messages: DataFrame, fields: dict[str, str], *keep: str | Column, corrupt: bool = False
) -> DataFrame:
    """One row per message: the kept columns, then one column per document field.

    ``corrupt`` adds ``_corrupt``, the text of documents of which a field was lost.
    """
    shape, options = fields, {}
    if corrupt:
        shape, options = fields | {CORRUPT: "string"}, {"columnNameOfCorruptRecord": CORRUPT}
    doc = F.from_json(message_text(F.col("value")), schemas.ddl_row(shape), options)
    return messages.select(*keep, F.inline(F.array(doc)))


def _good_elements(text: Column, array: str, fields: dict[str, str]) -> Column:
    """The objects in an array that did not parse as a whole, each parsed by itself.

    One bad element so costs one element. An object in place of the array is its only element.
    """
    raw = F.from_json(text, f"`{array}` string")[array]
    items = F.flatten(F.transform(F.array(raw), lambda json: F.when(
        json.startswith("{"), F.array(json)).otherwise(F.from_json(json, "array<string>"))))
    objects = F.filter(items, lambda item: item.startswith("{"))
    return F.transform(objects, lambda item: F.from_json(item, schemas.ddl_row(fields)))


def parse_airports(
    messages: DataFrame, fields: Iterable[str] | None = None, *, keep_raw: bool = False
) -> DataFrame:
    """Airport documents with their source columns.

    ``fields`` narrows the parse to the document fields a caller needs. A value
    that is no airport document gives a row without an ``_id``; a field of another
    type is NULL, of children only those that are no objects are lost. ``keep_raw`` adds the
    text of both kinds as ``raw``.
    """
    chosen = schemas.AIRPORT_DOC
    if fields is not None:
        chosen = {name: chosen[name] for name in fields}
    source = ["key", *schemas.SOURCE_COLUMNS]
    children = [name for name in CHILDREN if name in chosen]
    if not keep_raw and not children:
        return open_document(messages, chosen, *source)
    opened = open_document(messages, chosen, *source, "value", corrupt=True)
    text = message_text(F.col("value"))
    lost = F.col(CORRUPT).isNotNull()
    repaired = {
        name: F.when(lost & F.col(name).isNull(), _good_elements(text, name, CHILDREN[name])).otherwise(F.col(name))
        for name in children
    }
    if keep_raw:
        repaired[RAW] = F.when(F.col("_id").isNull() | lost, text)
    columns = [repaired.get(name, F.col(name)).alias(name) for name in [*chosen, *([RAW] if keep_raw else ())]]
    # Once more as the output of a generator, so that the repair is not repeated above.
    return opened.select(*source, F.inline(F.array(F.struct(*columns))))


def with_id(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("_id").isNotNull())


def is_rejected_airport() -> Column:
    """No airport, or an airport of which something was lost."""
    return F.col("_id").isNull() | F.col(RAW).isNotNull()


def airport_rejects(messages: DataFrame) -> DataFrame:
    """Messages that hold no airport, or not all of one, with their text and the reason."""
    return rejected_airports(parse_airports(messages, keep_raw=True))


def rejected_airports(parsed: DataFrame) -> DataFrame:
    return _rejects(parsed.where(is_rejected_airport()), F.col("_id").isNull(), "missing_id")


def parse_flight_pages(
    messages: DataFrame, fields: dict[str, str] | None = None, *, keep_raw: bool = False
) -> DataFrame:
    """One row per message with ``flights``, the array of flights it holds.

    A message is either a page ``{"data": [...]}`` or a single flight without
    the page around it. ``flights`` is NULL or empty when it is neither; elements that
    hold no field of a flight are left out. ``fields`` narrows the parse to fields of a flight, with
    their types; it also narrows what counts as one. ``keep_raw`` adds the text of messages without
    flights, and of those of which something was lost, as ``raw``.
    """
    source = ["key", *schemas.SOURCE_COLUMNS]
    flight = schemas.FLIGHT_DOC if fields is None else fields
    opened = open_document(messages, schemas.flight_message(flight), *source, "value", corrupt=True)
    text, lost = message_text(F.col("value")), F.col(CORRUPT).isNotNull()
    columns = [F.col(name) for name in flight]
    bare_flight = F.when(_any_value(columns), F.array(F.struct(*columns)))
    data = F.when(lost & F.col("data").isNull(), _good_elements(text, "data", flight)).otherwise(F.col("data"))
    sent = opened.select(*source, "value", CORRUPT, F.explode(F.array(F.coalesce(data, bare_flight))).alias("sent"))
    flights = F.filter("sent", lambda f: _any_value([f[name] for name in flight]))
    pages = sent.withColumn("flights", flights)
    if keep_raw:
        missing = array_size("flights") < F.greatest(array_size("sent"), F.lit(1))
        pages = pages.withColumn(RAW, F.when(missing | F.col(CORRUPT).isNotNull(), text))
    return pages.drop("value", CORRUPT, "sent")


def _any_value(fields: Iterable[Column]) -> Column:
    return functools.reduce(operator.or_, (f.isNotNull() for f in fields))


def split_flights(pages: DataFrame, *keep: str) -> DataFrame:
    """One row per flight, as the struct column ``f``."""
    return pages.select(*keep, F.explode("flights").alias("f"))


def flight_rejects(messages: DataFrame) -> DataFrame:
    return rejected_pages(parse_flight_pages(messages, keep_raw=True))


def is_rejected_page() -> Column:
    """No flights, or a page of which something was lost."""
    return (array_size("flights") == 0) | F.col(RAW).isNotNull()


def rejected_pages(pages: DataFrame) -> DataFrame:
    return _rejects(pages.where(is_rejected_page()), array_size("flights") == 0, "no_flights")


def _rejects(rows: DataFrame, nothing: Column, otherwise: str) -> DataFrame:
    """Text and reason; a message that gave something has a ``bad_field``."""
    text = F.col(RAW)
    reason = (
        F.when(~nothing, F.lit("bad_field"))
        .when(text.isNull() | (F.trim(text) == ""), F.lit("empty"))
        .when(F.try_parse_json(text).isNull(), F.lit("malformed"))
        .otherwise(F.lit(otherwise))
    )
    return rows.select("topic", "partition", "offset", RAW, reason.alias("reason"))


def split_records(messages: DataFrame, array_field: str = "data") -> DataFrame:
    """``$.<array_field>[*]``: one row per element, the element kept as JSON text.

    No element schema is needed: a text element type makes ``from_json`` keep
    the raw JSON of each element.
    """
    doc = F.from_json(message_text(F.col("value")), f"`{array_field}` array<string>")
    return messages.select(
        "key", *schemas.SOURCE_COLUMNS, F.posexplode(doc[array_field]).alias("pos", "record")
    )


def extract_paths(records: DataFrame, paths: dict[str, str], *keep: str) -> DataFrame:
    """Fields of the JSON text in ``record`` as text columns.

    Several plain paths are read in one parse of the record. ``get_json_object``,
    which parses it again for every path, is left for a single path and for
    paths with an index.
    """
    schema = paths_schema(paths.values()) if len(paths) > 1 else None
    if schema is None:
        return records.select(*keep, *json_paths(F.col("record"), paths))
    doc = F.explode(F.array(F.from_json("record", schema))).alias("doc")
    fields = [F.col(f"doc.{path[2:]}").alias(name) for name, path in paths.items()]
    return records.select(*keep, doc).select(*keep, *fields)


def split_variants(messages: DataFrame, array_field: str = "data") -> DataFrame:
    """``$.<array_field>[*]`` of documents of unknown shape, each element as a variant.

    A message is parsed once, to the binary form, and paths are then read from that. One that is
    no JSON, or has no such array, gives no row.
    """
    elements = F.try_variant_get(F.try_parse_json(message_text(F.col("value"))), f"$.{array_field}", "array<variant>")
    return messages.select("key", *schemas.SOURCE_COLUMNS, F.posexplode(elements).alias("pos", "record"))


def variant_records(records: DataFrame) -> DataFrame:
    """The JSON text in ``record`` as a variant, NULL where it is no JSON."""
    return records.withColumn("record", F.try_parse_json("record"))


def extract_variants(records: DataFrame, paths: dict[str, str], *keep: str) -> DataFrame:
    """Fields of the variant in ``record`` by path; ``paths`` gives ``$.path`` or ``$.path: type`` for each name.

    A field that is missing, or cannot have the type, is NULL and costs no other. Without a type it is
    text: the JSON of an object or array.
    """
    columns = []
    for name, path in paths.items():
        where, _, kind = path.partition(": ")
        columns.append(F.try_variant_get("record", where, kind or "string").alias(name))
    return records.select(*keep, *columns)


def variant_shapes(records: DataFrame, *keys: str) -> DataFrame:
    """How many records of each shape there are; NULL for what is no JSON."""
    return records.groupBy(*keys, F.schema_of_variant("record").alias("shape")).agg(F.count("*").alias("n"))


def normalize_records(records: DataFrame, paths: dict[str, str], *keep: str) -> DataFrame:
    """The extracted fields as a flat JSON object in ``record``."""
    return extract_paths(records, paths, *keep).select(
        *keep, json_record(paths).alias("record")
    )


def rewrite_records(records: DataFrame, ddl: str, *keep: str) -> DataFrame:
    """Reads the JSON text in ``record`` with a schema and writes it back with it."""
    return records.select(
        *keep, F.to_json(F.from_json("record", ddl)).alias("record")
    )
