"""Positions by cell: the key, its ranges, and what a box reads."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from aeroflow.operators import cells
from aeroflow.plans import airports as ap
from aeroflow.plans import build
from aeroflow.registry import QUERIES


def key(latitude, longitude):
    """The cell bit by bit."""
    row, column = cells._step_of(latitude, -90.0, 180.0), cells._step_of(longitude, -180.0, 360.0)
    return sum((row >> i & 1) << 2 * i + 1 | (column >> i & 1) << 2 * i for i in range(cells.BITS))


EDGES = [(0.0, 0.0), (90.0, 180.0), (-90.0, -180.0), (89.9999, 179.9999), (1e-9, -1e-9), (91.0, 200.0), (-91.0, -200.0)]


def test_cells_interleave_bits(spark):
    rng = random.Random(1)
    points = EDGES + [(rng.uniform(-90, 90), rng.uniform(-180, 180)) for _ in range(300)]
    rows = spark.createDataFrame([*points, (None, 1.0), (1.0, None)], "lat double, lon double")
    found = {(r["lat"], r["lon"]): r["c"] for r in rows.select("*", cells.cell(F.col("lat"), F.col("lon")).alias("c")).collect()}
    assert [found[p] for p in points] == [key(*p) for p in points]
    assert found[(None, 1.0)] is None and found[(1.0, None)] is None


@pytest.mark.parametrize("most", [1, 4, 16, 200])
def test_ranges_hold_every_cell_of_the_box(most):
    rng = random.Random(most)
    for _ in range(40):
        bottom, left = rng.uniform(-90, 80), rng.uniform(-180, 170)
        top, right = bottom + rng.uniform(0, 90 - bottom), left + rng.uniform(0, 180 - left)
        ranges = cells.cell_ranges((bottom, top), (left, right), most)
        assert 1 <= len(ranges) <= max(most, 4)
        assert all(a[1] + 1 < b[0] for a, b in zip(ranges, ranges[1:], strict=False))
        corners = [(bottom, left), (top, right), (bottom, right), (top, left)]
        inside = corners + [(rng.uniform(bottom, top), rng.uniform(left, right)) for _ in range(50)]
        assert all(any(a <= key(*p) <= b for a, b in ranges) for p in inside)
    assert cells.cell_ranges((10, 5), (0, 1)) == []
    assert cells.cell_ranges((-90, 90), (-180, 180)) == [(0, (1 << 2 * cells.BITS) - 1)]


def airports(spark, n):
    latitude, longitude = F.rand(3) * 180 - 90, F.rand(4) * 360 - 180
    placed = F.format_string('{"type":"Point","coordinates":[%.4f,%.4f]}', longitude, latitude)
    names = {c: F.concat(F.lit(c), F.col("id")) for c in ("name", "icao_code", "country")}
    rows = spark.range(n).withColumns(names | {"_id": F.col("id").cast("string")})
    return rows.withColumn("geometry", F.when(F.col("id") % 50 > 0, placed))


def read_rows(frame):
    """Rows that the scan decodes."""
    executed = frame._jdf.queryExecution().executedPlan()
    executed.execute().count()
    while executed.children().size():
        executed = executed.children().apply(0)
    return executed.metrics().apply("numOutputRows").value()


@pytest.fixture(scope="module")
def positions(spark, tmp_path_factory):
    rows = airports(spark, 200_000)
    path = str(tmp_path_factory.mktemp("positions") / "t")
    rows.write.parquet(path + "-airports")
    rows = spark.read.parquet(path + "-airports")
    build.store_positions(rows, path)
    return rows, spark.read.parquet(path)


BOXES = [((40.0, 50.0), (-5.0, 10.0)), ((-90.0, -80.0), (-180.0, 180.0)), ((5.0, 5.5), (170.0, -170.0)), ((1.0, 0.0), (0.0, 1.0))]


@pytest.mark.parametrize("box", BOXES)
def test_a_box_reads_few_pages_and_gives_all_rows(positions, box):
    rows, placed = positions
    found = ap.positions_in_box(placed, *box)
    if box[1][0] <= box[1][1]:
        expected = ap.airports_in_box(rows, *box)
    else:
        expected = ap.airports_in_box(rows, box[0], (box[1][0], 180.0)).unionByName(ap.airports_in_box(rows, box[0], (-180.0, box[1][1])))
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, expected.collect()))
    # A strip around the globe is the worst of boxes: it holds a part of very many pages.
    assert read_rows(found) < (200_000 / 3 if box[1] == (-180.0, 180.0) else 200_000 / 8)
    assert placed.where("latitude is null").count() == 4_000


def test_the_box_reaches_the_scan(spark, small_dir):
    text = QUERIES["positions_bbox"](spark, small_dir)._jdf.queryExecution().executedPlan().toString()
    scan = next(l for l in text.splitlines() if "FileScan" in l)
    pushed = scan[scan.index("PushedFilters:"):].split("ReadSchema")[0]
    assert "GreaterThanOrEqual(latitude,40.0)" in pushed and "LessThanOrEqual(longitude,180.0)" in pushed and "cell" in pushed
