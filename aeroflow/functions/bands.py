"""Threshold colours and scaling for panel values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The default steps of the dashboards, lower bound -> colour.
GREEN_RED_80 = ((None, "green"), (80.0, "red"))
GREEN_ONLY = ((None, "green"),)


def min_max_scale(value: Column, low: Column, high: Column) -> Column:
    """Value on a 0..1 scale; 0 when all values are equal, NULL for no value."""
    return F.when(value.isNotNull() & (high == low), F.lit(0.0)).otherwise(
        (value - low) / F.nullif(high - low, F.lit(0.0))
    )


def band(
    value: Column,
    steps: Sequence[tuple[float | None, str]] = GREEN_RED_80,
    *,
    low: Column | None = None,
    high: Column | None = None,
) -> Column:
    """Colour of the highest step reached; NULL values take the base colour.

    With ``low`` and ``high`` the steps are percentages of that range.
    """
    if (low is None) != (high is None):
        raise ValueError("give both low and high, or neither")
    measured = value if low is None else min_max_scale(value, low, high) * 100
    (_, base), *rest = steps
    colour = F.lit(base)
    for bound, name in rest:
        colour = F.when(measured >= F.lit(bound), F.lit(name)).otherwise(colour)
    return colour
