"""A sort key for positions, and the ranges of it that a box touches.

Latitude and longitude are cut into equal steps and the bits of both steps are
interleaved (a Z-order curve). Positions near each other have keys near each other,
so a table sorted by the key answers a box from few of its pages.
"""

from __future__ import annotations

from collections import deque

from pyspark.sql import Column
from pyspark.sql import functions as F

Range = tuple[float, float]

CELL = "cell"
BITS = 16  # for each axis; a step is about 300 m of latitude
_STEPS = 1 << BITS


def _step(value: Column, low: float, extent: float) -> Column:
    steps = F.floor((value - low) * (_STEPS / extent))
    on_globe = F.greatest(F.lit(0), F.least(steps, F.lit(_STEPS - 1)))  # of NULL, the others
    return F.when(value.isNotNull(), on_globe)


def _bits_apart(step: Column) -> Column:
    """Binary digits read as digits of base 4: each bit gets a zero in front."""
    return F.conv(F.bin(step), 4, 10).cast("bigint")


def cell(latitude: Column, longitude: Column) -> Column:
    """The key of a position; NULL without one. Positions off the globe count as on its edge."""
    return _bits_apart(_step(latitude, -90.0, 180.0)) * 2 + _bits_apart(_step(longitude, -180.0, 360.0))


def _step_of(value: float, low: float, extent: float) -> int:
    return max(0, min(int((value - low) * (_STEPS / extent) // 1), _STEPS - 1))


def cell_ranges(latitudes: Range, longitudes: Range, most: int = 64) -> list[tuple[int, int]]:
    """At most ``most`` ranges of keys, both ends included, that hold all keys in the box.

    Squares that lie partly in the box are cut into four, the largest first, while there is
    room for more ranges; what is still partly outside then counts as a whole.
    """
    bottom, top = (_step_of(v, -90.0, 180.0) for v in latitudes)
    left, right = (_step_of(v, -180.0, 360.0) for v in longitudes)
    if bottom > top or left > right:
        return []
    whole: list[tuple[int, int]] = []
    partly = deque([(0, 0, 0, BITS)])  # first key, row, column, bits of the side
    while partly:
        key, row, column, bits = partly.popleft()
        side = 1 << bits
        if row > top or row + side <= bottom or column > right or column + side <= left:
            continue
        inside = bottom <= row and row + side - 1 <= top and left <= column and column + side - 1 <= right
        if inside or len(whole) + len(partly) + 4 > most:
            whole.append((key, key + side * side - 1))
            continue
        half = side // 2
        for i in range(4):
            partly.append((key + i * half * half, row + (i >> 1) * half, column + (i & 1) * half, bits - 1))
    merged: list[tuple[int, int]] = []
    for first, last in sorted(whole):
        if merged and merged[-1][1] + 1 >= first:
            merged[-1] = merged[-1][0], last
        else:
            merged.append((first, last))
    return merged


def in_box(latitudes: Range, longitudes: Range) -> Column:
    """Rows of a table with ``latitude, longitude, cell`` that lie in a box, its edges included.

    The comparisons are plain, so a Parquet reader answers them from statistics. A box whose
    western edge is greater than its eastern one reaches over the date line.
    """
    if longitudes[0] > longitudes[1]:
        west, east = (longitudes[0], 180.0), (-180.0, longitudes[1])
        return in_box(latitudes, west) | in_box(latitudes, east)
    near = F.lit(False)
    for first, last in cell_ranges(latitudes, longitudes):
        near = near | F.col(CELL).between(first, last)
    return F.col("latitude").between(*latitudes) & F.col("longitude").between(*longitudes) & near
