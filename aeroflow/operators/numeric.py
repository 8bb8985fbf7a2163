"""Sums of decimal texts of any length, exact as PostgreSQL's ``numeric``.

A number is cut into limbs of nine digits on both sides of its point. Limbs of one place are
summed as whole numbers, merged before the shuffle like any sum, and carries are made once
for each total. Numbers of ordinary length are one limb, so they cost one addition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DIGITS = 9
BASE = 10**DIGITS
# What one limb holds: 18 digits before the point and 8 after it, so that 10^12 of them can be added.
_LIMB, _TOTAL, _WHOLE = "decimal(28,8)", "decimal(38,8)", "decimal(38,0)"
_SHORT = r"^\s*[+-]?(\d{1,18}(\.\d{0,8})?|\.\d{1,8})\s*$"
_NUMBER = r"^\s*([+-]?)(\d*)\.?(\d*)(?:[eE]([+-]?\d{1,6}))?\s*$"
# Digits of a `numeric` before and after the point, at most.
MOST_WHOLE, MOST_FRACTION = 131_072, 16_383
# Totals have so many decimals at least.
LEAST_DECIMALS = 8


_LIMBS = f"array<struct<place: int, amount: {_LIMB}>>"


def is_number(text: Column) -> Column:
    """Whether a text is a decimal number, with or without an exponent."""
    return F.regexp_like(text, F.lit(_NUMBER)) & F.regexp_like(text, F.lit(r"^\s*[+-]?\.?\d"))


def _cut(digits: str, first_place: Column) -> Column:
    """Limbs of digits whose number is a multiple of nine; the first one has the given place."""
    last = F.floor(F.length(digits) / DIGITS).cast("int") - 1

    def limb(i: Column) -> Column:
        amount = F.col("sign") * F.substr(digits, i * DIGITS + 1, F.lit(DIGITS)).try_cast("int")
        return F.struct((first_place - i).cast("int").alias("place"), amount.cast(_LIMB).alias("amount"))

    return F.when(F.length(digits) > 0, F.transform(F.sequence(F.lit(0), last), limb)).otherwise(F.array().cast(_LIMBS))


def with_limbs(texts: DataFrame) -> DataFrame:
    """Adds ``limbs`` to the column ``text``: ``(place, amount)``, a place being a power of 10^9.

    NULL for text that is no number, or has more digits than a ``numeric``. Step by step, each in a
    column of its own, so that no step is repeated in the next ones; short numbers skip them.
    """
    text = F.col("text")
    steps = texts.withColumn("short", F.regexp_like(text, F.lit(_SHORT)))
    steps = steps.withColumn("long", F.when(~F.col("short") & is_number(text), text))
    exponent = F.coalesce(F.regexp_extract("long", _NUMBER, 4).try_cast("int"), F.lit(0))
    steps = steps.withColumns({
        "sign": F.when(F.regexp_extract("long", _NUMBER, 1) == "-", -1).otherwise(1),
        "before": F.regexp_extract("long", _NUMBER, 2), "after": F.regexp_extract("long", _NUMBER, 3), "exponent": exponent,
    })
    steps = steps.withColumns({"digits": F.concat("before", "after"), "point": F.length("before") + F.col("exponent")})
    size, point = F.length("digits"), F.col("point")
    whole = F.when(point <= 0, "").when(point <= size, F.substr("digits", F.lit(1), point)).otherwise(F.rpad("digits", point, F.lit("0")))
    fraction = F.when(point >= size, "").when(point >= 0, F.substr("digits", point + 1)).otherwise(F.lpad("digits", size - point, F.lit("0")))
    fits = (point <= MOST_WHOLE) & (size - point <= MOST_FRACTION)
    steps = steps.withColumns({"whole": F.when(fits, whole), "fraction": F.when(fits, fraction)})
    steps = steps.withColumns({f"n_{c}": (F.ceil(F.length(c) / DIGITS) * DIGITS).cast("int") for c in ("whole", "fraction")})
    steps = steps.withColumns({"whole": F.lpad("whole", F.col("n_whole"), F.lit("0")), "fraction": F.rpad("fraction", F.col("n_fraction"), F.lit("0"))})
    long = F.concat(_cut("whole", F.col("n_whole") / DIGITS - 1), _cut("fraction", F.lit(-1)))
    one = F.array(F.struct(F.lit(0).alias("place"), F.trim(text).try_cast(_LIMB).alias("amount")))
    limbs = F.when(F.col("short"), one).when(F.col("whole").isNotNull(), long)
    return steps.withColumn("limbs", limbs).select(*texts.columns, "limbs")


def _carried(places: str) -> Column:
    """Digits of the limbs from ``low`` to ``high``, nine for each, and what is carried beyond."""

    def step(done: Column, place: Column) -> Column:
        limb = (F.coalesce(F.try_element_at(places, place), F.lit(0).cast(_WHOLE)) + done["carry"]).cast(_WHOLE)
        digits = F.pmod(limb, F.lit(BASE).cast(_WHOLE)).cast(_WHOLE)
        return F.struct(
            ((limb - digits) / F.lit(BASE).cast(_WHOLE)).cast(_WHOLE).alias("carry"),
            F.concat(F.lpad(digits.cast("string"), DIGITS, "0"), done["digits"]).alias("digits"),
        )

    nothing = F.struct(F.lit(0).cast(_WHOLE).alias("carry"), F.lit("").alias("digits"))
    return F.aggregate(F.sequence("low", "high"), nothing, step)


def _with_text(sums: DataFrame, name: str) -> DataFrame:
    """Adds a total as text, from ``limb_sums``, ``(place, amount)`` once for each place; NULL for none.

    Step by step, each in a column of its own, so that no step is repeated in the next ones.
    """
    one, base = F.lit(1).cast("decimal(1,0)"), F.lit(BASE).cast("decimal(10,0)")
    ordinary = F.get(F.filter("limb_sums", lambda s: s["place"] == 0), F.lit(0))["amount"]
    # Decimals of ordinary numbers are in place 0; they move on to place -1. (A remainder keeps them all.)
    rest = (F.pmod(F.coalesce(ordinary, F.lit(0).cast(_TOTAL)), one).cast("decimal(9,8)") * base).cast(_WHOLE)
    whole = F.transform("limb_sums", lambda s: F.struct(s["place"].alias("place"), F.floor(s["amount"]).cast(_WHOLE).alias("n")))
    steps = sums.withColumns({"rest": rest, "whole": whole})
    steps = steps.withColumn("places", F.map_from_entries("whole"))
    below = (F.coalesce(F.try_element_at("places", F.lit(-1)), F.lit(0).cast(_WHOLE)) + F.col("rest")).cast(_WHOLE)
    steps = steps.withColumn("below", F.create_map(F.lit(-1), below))
    steps = steps.withColumn("places", F.map_concat(F.map_filter("places", lambda k, _: k != -1), "below"))
    steps = steps.withColumns({
        "low": F.least(F.array_min(F.map_keys("places")), F.lit(-1)), "high": F.greatest(F.array_max(F.map_keys("places")), F.lit(0)),
        "negated": F.transform_values("places", lambda _, v: (-v).cast(_WHOLE)),
    })
    steps = steps.withColumn("up", _carried("places"))
    steps = steps.withColumn("total", F.when(F.col("up.carry") < 0, _carried("negated")).otherwise(F.col("up")))
    steps = steps.withColumns({
        "digits": F.concat(F.col("total.carry").cast("string"), "total.digits"), "n_decimals": -F.col("low") * DIGITS,
        "sign": F.when(F.col("up.carry") < 0, "-").otherwise(""),
    })
    steps = steps.withColumn("decimals", F.regexp_replace(F.substr("digits", F.length("digits") - F.col("n_decimals") + 1), "0+$", ""))
    head = F.regexp_replace(F.substr("digits", F.lit(1), F.length("digits") - F.col("n_decimals")), "^0+(?=.)", "")
    tail = F.rpad("decimals", F.greatest(F.length("decimals"), F.lit(LEAST_DECIMALS)), F.lit("0"))
    return steps.withColumn(name, F.when(F.size("limb_sums") > 0, F.concat("sign", head, F.lit("."), tail)))


def sum_numeric(rows: DataFrame, value: str, keys: Sequence[str], name: str) -> DataFrame:
    """``keys`` and the sum of the numbers in the text column ``value``, as text in ``name``.

    Other text adds nothing; a group without numbers has a NULL sum. The sum is exact whatever the
    length of the numbers and the order of the rows. Without keys there is one row.
    """
    key = F.struct(*keys).alias("key") if keys else F.lit(0).alias("key")
    values = rows.select(key, F.col(value).alias("value"))
    short = F.coalesce(F.regexp_like("value", F.lit(_SHORT)), F.lit(False))
    ordinary = values.where(short).groupBy("key").agg(F.sum(F.col("value").try_cast(_LIMB)).alias("amount"))
    cut = with_limbs(values.where(~short).withColumnRenamed("value", "text")).select("key", F.explode_outer("limbs").alias("limb"))
    by_place = cut.groupBy("key", "limb.place").agg(F.sum("limb.amount").alias("amount"))
    by_place = by_place.unionByName(ordinary.withColumn("place", F.lit(0)))
    # Both may have a sum in place 0.
    by_place = by_place.groupBy("key", "place").agg(F.sum("amount").cast(_TOTAL).alias("amount"))
    there = F.when(F.col("place").isNotNull(), F.struct("place", "amount"))
    # Without keys there is a row for no rows, too.
    sums = by_place.groupBy(*(["key"] if keys else [])).agg(F.collect_list(there).alias("limb_sums"))
    return _with_text(sums, "sum").select(*[F.col(f"key.{k}").alias(k) for k in keys], F.col("sum").alias(name))


def numeric_order(text: Column) -> tuple[Column, Column]:
    """Two columns that sort texts as ``sum_numeric`` writes them by their value."""
    negative = text.startswith("-")
    digits = F.when(negative, F.substr(text, F.lit(2))).otherwise(text)
    length = F.length(F.substring_index(digits, ".", 1))
    # Of negative numbers the one with greater digits comes first.
    turned = F.concat(F.translate(digits, "0123456789", "9876543210"), F.lit("~"))
    return F.when(negative, -length).otherwise(length), F.when(negative, turned).otherwise(digits)
