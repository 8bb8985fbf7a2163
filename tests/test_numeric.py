"""Sums of decimal texts of any length."""

from __future__ import annotations

import random
from decimal import Decimal, localcontext

import pytest
from pyspark.sql import functions as F

from aeroflow.operators.numeric import is_number, numeric_order, sum_numeric, with_limbs


def exact(values):
    with localcontext() as context:
        context.prec = 200_000
        total = sum(map(Decimal, values), Decimal(0))
        sign, digits, exponent = (total.normalize() if total else Decimal(0)).as_tuple()
        whole, _, decimals = f"{abs(total):f}".partition(".")
        return ("-" if sign and total else "") + whole + "." + decimals.rstrip("0").ljust(8, "0")


def total(spark, values):
    rows = spark.createDataFrame([(v,) for v in values], "value string").repartition(3)
    (row,) = sum_numeric(rows, "value", [], "total").collect()
    return row["total"]


@pytest.mark.parametrize("values", [
    ["123456789012345678901", "1.5", "0.000000004"],
    ["999999999999999999", "1"], ["-1", "0.5"], ["-0.5", "0.25"], ["0"], ["-0.0"], ["1", "-1"], ["1e5", "1E-3", "-2.5e1", "+7", ".5", "5."],
    ["9" * 300, "1"], ["0." + "0" * 299 + "1", "-" + "9" * 40], ["  12.5 ", "1" * 18 + "." + "9" * 8], ["1" * 19 + "." + "9" * 9] * 3,
    ["1e300", "-1e300", "1e-300"],
])
def test_hard_sums(spark, values):
    assert total(spark, values) == exact(values)
    assert total(spark, values[::-1]) == exact(values)


def test_random_sums(spark):
    pick = random.Random(3)

    def number():
        whole, decimals = ("".join(pick.choice("0123456789") for _ in range(pick.randrange(n))) for n in (40, 30))
        return pick.choice(["", "-", "+"]) + (whole or "0") + pick.choice(["", "." + decimals])

    for _ in range(2):
        values = [number() for _ in range(1000)]
        assert total(spark, values) == exact(values)


def test_other_text_adds_nothing(spark):
    bad = ["", " ", "abc", "1,5", "--1", ".", "+", "e5", "1e", "1.2.3", "0x10", "NaN", "1e999999", None, "1 2"]
    assert total(spark, bad) is None
    assert total(spark, [*bad, "2"]) == "2.00000000"
    assert total(spark, []) is None


def test_groups(spark):
    rows = spark.createDataFrame([("a", "1" * 30), ("a", "1"), ("b", "x"), (None, "2.5"), (None, "-5")], "k string, value string")
    got = {r["k"]: r["total"] for r in sum_numeric(rows, "value", ["k"], "total").collect()}
    assert got == {"a": "1" * 29 + "2.00000000", "b": None, None: "-2.50000000"}


def test_order_of_totals(spark):
    values = ["-100000000000000000000.00000000", "-20.50000000", "-20.40000000", "-20.400000001", "-3.00000000", "0.00000000",
              "0.000000001", "3.00000000", "20.40000000", "20.400000001", "20.50000000", "100000000000000000000.00000000"]
    rows = spark.createDataFrame([(v,) for v in values[::-1]], "v string")
    got = [r["v"] for r in rows.orderBy(*numeric_order(F.col("v"))).collect()]
    assert got == sorted(values, key=Decimal)


def test_ordinary_numbers_are_one_limb(spark):
    rows = spark.createDataFrame([("118.700",), ("1" * 18 + ".12345678",), ("1" * 19,), ("x",)], "text string")
    assert [r["limbs"] and len(r["limbs"]) for r in with_limbs(rows).collect()] == [1, 1, 3, None]
    assert [r[0] for r in rows.select(is_number(F.col("text"))).collect()] == [True, True, True, False]
