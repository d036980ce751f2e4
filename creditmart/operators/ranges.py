"""Ranks and running totals over one long sorted column, by the bits of its values.

A double has an order-preserving 64-bit image: its sign, exponent and mantissa as one number. The
image's leading bits name a slot, the next ones a slot within it. How many slots there can be, and
how many values one of the last level can hold, follows from the number of bits alone, so no sketch
of the data, no job ahead of the query and no search among cuts is needed, and no task outgrows its
bound whatever the data: with (24, 20) bits a slot has at most 2^20 parts and a part 2^20 values. A slot
of no more rows than that is taken as one part, so that there are not as many parts as rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BITS = (24, 20)  # of the first and the second level
WHOLE = 1 << 20  # rows of a slot that one task takes unparted, no more than a part can hold
IMAGE, SLOT, PART = "_image", "_slot", "_part"
_TOP = (1 << 63) - 1


def with_image(df: DataFrame, column: str, out: str = IMAGE) -> DataFrame:
    """Adds the order-preserving image of a double as a long; null stays null, NaN is the largest.

    For a positive number it is its IEEE bits, found exactly by arithmetic with powers of two;
    zeros are 0 and a negative number is the negated image of its absolute value.
    """
    value = F.col(column).cast("double")
    size = F.abs(value)
    plain = (size > 0) & (size < float("inf"))  # false for NaN, the largest of all
    about = F.greatest(F.lit(-1022.0), F.floor(F.log2(size)).cast("double"))
    # The logarithm may be off next to a power of two: one step up or down makes the exponent exact.
    df = df.withColumn("_about", F.when(plain, about))
    two = F.lit(2.0)
    step = F.when(F.pow(two, F.col("_about") + 1) <= size, 1.0).when(
        (F.pow(two, "_about") > size) & (F.col("_about") > -1022), -1.0).otherwise(0.0)
    df = df.withColumn("_about", F.col("_about") + step)
    bits = ((F.col("_about") + 1022) * float(1 << 52)).cast("long") + (size / F.pow(two, "_about") * float(1 << 52)).cast("long")
    image = F.when(F.isnan(value), _TOP).when(size == 0, 0).when(~plain, _TOP - 1).otherwise(bits)
    signed = F.when(value < 0, -image).otherwise(image)
    return df.withColumn(out, F.when(value.isNotNull(), signed)).drop("_about")


def with_slots(df: DataFrame, column: str, descending: bool = False, bits: Sequence[int] = BITS) -> DataFrame:
    """Adds the image of ``column`` (inverted when descending) and its slot and part: a shift each."""
    df = with_image(df, column)
    image = F.bitwise_not(IMAGE) if descending else F.col(IMAGE)
    first, second = 64 - bits[0], 64 - bits[0] - bits[1]
    return df.withColumn(IMAGE, image).withColumns({
        SLOT: F.shiftright(IMAGE, first), PART: F.shiftright(IMAGE, second).bitwiseAND((1 << bits[1]) - 1)})


def running_totals(
    df: DataFrame,
    groups: Sequence[str],
    order: str,
    sums: Mapping[str, str],
    descending: bool = False,
    bits: Sequence[int] = BITS,
    group_totals: Mapping[str, str] | None = None,
    whole: int = WHOLE,
) -> DataFrame:
    """Adds, per group, the total of each column up to and including the row.

    ``sums`` maps new names to summed columns, ``group_totals`` names further columns that get
    the total of the whole group, taken from ``sums``' new names. (group, order) must be unique
    and not null. Totals are taken of slots and, in slots of more than ``whole`` rows, of their parts; what lies before a
    slot or part enters its window as a first row.
    """
    group_totals = group_totals or {}
    keys = list(groups)
    rows = with_slots(df, order, descending, bits)
    partial, totals = {new: f"_sum_{new}" for new in sums}, {name: f"_all_{name}" for name in group_totals}

    def earlier(window, column: str) -> Column:
        return F.coalesce(F.sum(column).over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

    slots = rows.groupBy(*keys, SLOT).agg(*[F.sum(old).alias(partial[new]) for new, old in sums.items()],
                                          F.count(F.lit(1)).alias("_in_slot"))
    # Every use of the slots asks for all their columns, so that the slots' shuffle is shared.
    slots = slots.withColumn("_large", reduce(and_, [F.col(c).isNotNull() for c in partial.values()], F.col("_in_slot") > whole))
    # One row per ``whole`` rows at most, so this side cannot outgrow a broadcast.
    large = F.broadcast(slots.where("_large").select(*[F.col(c).alias(f"_large_{c}") for c in (*keys, SLOT)]))
    is_large = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_large_{c}")) for c in (*keys, SLOT)])
    parts = rows.join(large, is_large).groupBy(*keys, SLOT, PART).agg(*[F.sum(old).alias(partial[new]) for new, old in sums.items()])
    rows = rows.join(large, is_large, "left").withColumn(
        PART, F.when(F.col(f"_large_{SLOT}").isNotNull(), F.col(PART)).otherwise(F.lit(0).cast("long")))

    group = Window.partitionBy(*(keys or [F.lit(0)]))
    before_slot = slots.select(
        *keys, SLOT, "_large", *[earlier(group.orderBy(SLOT), c).alias(c) for c in partial.values()],
        *[F.sum(partial[new]).over(group).alias(totals[name]) for name, new in group_totals.items()])
    at = {end: before_slot.where(test).drop("_large").withColumn(PART, F.lit(end).cast("long"))
          for end, test in ((0, "not _large"), (-1, "_large"))}
    in_slot = Window.partitionBy(*keys, SLOT).orderBy(PART)
    before_part = parts.unionByName(at[-1], allowMissingColumns=True).select(
        *keys, SLOT, PART, *[earlier(in_slot, c).alias(c) for c in partial.values()],
        *[F.first(c, ignorenulls=True).over(in_slot).alias(c) for c in totals.values()]).where(F.col(PART) >= 0)
    before_part = before_part.unionByName(at[0])

    with_sums = rows.withColumns({partial[new]: F.col(old) for new, old in sums.items()}).withColumn("_row", F.lit(True))
    in_part = Window.partitionBy(*keys, SLOT, PART).orderBy(F.col("_row").asc_nulls_first(), IMAGE)
    upto = in_part.rowsBetween(Window.unboundedPreceding, 0)
    found = with_sums.unionByName(before_part, allowMissingColumns=True).select(
        *df.columns, "_row", *[F.sum(partial[new]).over(upto).alias(new) for new in sums],
        *[F.first(totals[name], ignorenulls=True).over(upto).alias(name) for name in group_totals])
    return found.where("_row").drop("_row")
