"""Documents of unknown shape, as variants."""

from __future__ import annotations

from aeroflow.operators import decode

DOCS = [
    '{"data": [{"a": 1, "b": {"c": "x"}}, {"a": "1", "b": [2]}, {"a": true}, 7, null, "t"]}',
    '{"data": {"a": 1}}', '{"other": []}', "no json", "", None, '{"data": []}', '[1, 2]',
]


def test_elements_and_paths_of_mixed_types(spark, messages):
    records = decode.split_variants(messages(DOCS))
    paths = {"text": "$.a", "number": "$.a: int", "flag": "$.a: boolean", "c": "$.b.c", "first": "$.b[0]: double", "b": "$.b"}
    found = decode.extract_variants(records, paths, "offset", "pos").orderBy("offset", "pos").collect()
    assert [tuple(r)[:2] for r in found] == [(0, i) for i in range(6)]
    assert [tuple(r)[2:] for r in found] == [
        ("1", 1, True, "x", None, '{"c":"x"}'), ("1", 1, True, None, 2.0, "[2]"), ("true", 1, True, None, None, None),
        *[(None,) * 6] * 3,
    ]


def test_shapes(spark):
    rows = [(1, '{"k": 1}'), (2, '{"k": 300}'), (3, '{"k": "x"}'), (4, "words"), (5, None)]
    records = decode.variant_records(spark.createDataFrame(rows, "id int, record string"))
    found = {r["shape"]: r["n"] for r in decode.variant_shapes(records).collect()}
    assert found == {"OBJECT<k: BIGINT>": 2, "OBJECT<k: STRING>": 1, None: 2}


def test_as_split_records(spark, messages):
    pages = messages(['{"data": [{"flight": {"iata": "A"}, "n": 1.50}, {"flight": null}]}'])
    plain = decode.extract_paths(decode.split_records(pages), {"iata": "$.flight.iata"}, "pos")
    assert decode.extract_variants(decode.split_variants(pages), {"iata": "$.flight.iata"}, "pos").collect() == plain.collect()
