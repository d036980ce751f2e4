"""Key overlap, coverage and missing-key checks.

All of them tag keys with the frames they occur in and aggregate once, instead of joining
distinct key lists pair by pair.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditmart import constants as K
from creditmart.functions.cleaning import id_key, id_norm
from creditmart.functions.dates import month_key, month_text


def with_match_keys(df: DataFrame, id_col: str = "customer_id", month: str | None = None) -> DataFrame:
    """Adds ``cid_key`` and ``ym_key``; a given month overrides the row's own."""
    ym = F.lit(month) if month else month_key(df.columns)
    return df.withColumns({"cid_key": id_key(id_col), "ym_key": ym})


def month_key_join(base: DataFrame, features: Sequence[DataFrame], id_col: str = "customer_id") -> DataFrame:
    """Left join by normalised id and month; the base keeps its own date and column order."""
    def keyed(df: DataFrame) -> DataFrame:
        return df.withColumns({id_col: id_norm(id_col), "ym_norm": month_key(df.columns)})

    result = keyed(base)
    for frame in features:
        result = result.join(keyed(frame).drop("snapshot_date"), [id_col, "ym_norm"], "left")
    return result.drop("ym_norm")


def key_presence(frames: Mapping[str, DataFrame], keys: Sequence[str]) -> DataFrame:
    """One row per distinct key with a flag ``in_<name>`` per frame."""
    tagged = None
    for name, frame in frames.items():
        rows = frame.select(*keys).withColumn("_frame", F.lit(name))
        tagged = rows if tagged is None else tagged.unionByName(rows)
    return tagged.groupBy(*keys).agg(
        *[F.max(F.col("_frame") == name).alias(f"in_{name}") for name in frames]
    )


def key_overlap(frames: Mapping[str, DataFrame], keys: Sequence[str]) -> DataFrame:
    """Distinct keys per frame and shared keys per pair, as (left_side, right_side, keys)."""
    known = key_presence(frames, keys)
    for key in keys:
        known = known.where(F.col(key).isNotNull())
    pairs = [(name, name) for name in frames] + list(combinations(frames, 2))
    counts = known.agg(*[
        F.count_if(F.col(f"in_{a}") & F.col(f"in_{b}")).alias(f"{a}|{b}") for a, b in pairs
    ])
    rows = F.array(*[
        F.struct(F.lit(a).alias("left_side"), F.lit(b).alias("right_side"),
                 F.col(f"`{a}|{b}`").alias("n_keys"))
        for a, b in pairs
    ])
    return counts.select(F.inline(rows))


def key_sketches(frames: Mapping[str, DataFrame], keys: Sequence[str], month: str, bits: int = K.THETA_BITS) -> DataFrame:
    """(source, month, apart, slots, slot, sketch): Theta sketches of the complete keys per frame and month, of bounded size.

    Keys are dealt by hash to as many slots, a power of two and the same for all frames, as leave at most half of
    2^``bits`` rows to one on average, so that every sketch stays exact. Where the month is one of the keys, months
    share none (``apart`` names the month) and each has slots of its own; most have one. Else all months share them.
    """
    rows = None
    for name, frame in frames.items():
        apart = F.col(month) if month in keys else F.lit(None)
        part = frame.dropna(subset=list(keys)).select(
            F.lit(name).alias("source"), F.col(month).cast("string").alias("month"), apart.cast("string").alias("apart"),
            F.to_json(F.struct(*keys)).alias("key"))
        rows = part if rows is None else rows.unionByName(part)
    needed = F.greatest(F.lit(0.0), F.ceil(F.log2(F.max("n") / (1 << bits - 1))))
    slots = rows.groupBy("apart", "source").agg(F.count(F.lit(1)).alias("n")).groupBy(F.col("apart").alias("_apart")).agg(
        F.pow(F.lit(2.0), needed).cast("long").alias("slots"))
    # One row per month, so this side cannot outgrow a broadcast.
    dealt = rows.join(F.broadcast(slots), F.col("apart").eqNullSafe(F.col("_apart"))).withColumn("slot", F.pmod(F.xxhash64("key"), "slots"))
    return dealt.groupBy("source", "month", "apart", "slots", "slot").agg(F.theta_sketch_agg("key", bits).alias("sketch"))


def sketched_overlap(sketches: DataFrame, sources: Sequence[str], first: str | None = None, last: str | None = None,
                     bits: int = K.THETA_BITS) -> DataFrame:
    """``key_overlap`` of a span of months from stored sketches: every pair of sources from the same rows.

    Slots share no key, so their counts add up. Exact for sketches of one call, and of several where the month is one
    of the keys and comes in one call; else slots of different numbers meet in the fewest, and full ones are estimates.
    """
    rows = sketches
    if first is not None:
        rows = rows.where(F.col("month") >= first)
    if last is not None:
        rows = rows.where(F.col("month") <= last)
    fewest = rows.groupBy(F.col("apart").alias("_apart")).agg(F.min("slots").alias("fewest"))  # one row per month
    met = rows.join(F.broadcast(fewest), F.col("apart").eqNullSafe(F.col("_apart")))
    slots = met.groupBy("apart", (F.col("slot") % F.col("fewest")).alias("slot")).agg(*[
        F.theta_union_agg(F.when(F.col("source") == name, F.col("sketch")), bits).alias(name) for name in sources])
    pairs = [(name, name) for name in sources] + list(combinations(sources, 2))
    whole = slots.agg(*[
        F.sum(F.theta_sketch_estimate(F.theta_intersection(F.col(a), F.col(b)))).alias(f"{a}|{b}") for a, b in pairs])
    lines = F.array(*[
        F.struct(F.lit(a).alias("left_side"), F.lit(b).alias("right_side"), F.col(f"`{a}|{b}`").alias("n_keys")) for a, b in pairs])
    return whole.select(F.inline(lines)).withColumn("n_keys", F.coalesce("n_keys", F.lit(0)).cast("long"))


def overlap_rows(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Number of row pairs an inner join would give, from per-key counts only."""
    names = list(keys)
    a = left.groupBy(*names).agg(F.count(F.lit(1)).alias("_a"))
    b = right.groupBy(*names).agg(F.count(F.lit(1)).alias("_b"))
    pairs = F.coalesce(F.sum(F.col("_a") * F.col("_b")), F.lit(0))
    return a.join(b, names, "inner").agg(pairs.alias("n_pairs"))


def missing_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct left keys that never occur on the right."""
    return left.select(*keys).distinct().join(right.select(*keys).distinct(), list(keys), "left_anti")


def coverage(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """How many of the distinct left keys the right side has."""
    known = key_presence({"left": left, "right": right}, keys).where("in_left")
    complete = F.lit(True)
    for key in keys:
        complete = complete & F.col(key).isNotNull()
    n_keys, n_covered = F.count(F.lit(1)), F.count_if(F.col("in_right") & complete)
    return known.agg(
        n_keys.alias("n_keys"),
        n_covered.alias("n_covered"),
        F.coalesce(F.try_divide(n_covered, n_keys), F.lit(0.0)).alias("coverage"),
    )


def covered_categories(left: DataFrame, right: DataFrame, keys: Sequence[str], category: str) -> DataFrame:
    """Rows per category of the right side within the distinct left keys."""
    return (
        left.select(*keys).distinct()
        .join(right.select(*keys, category), list(keys), "left")
        .groupBy(category).agg(F.count(F.lit(1)).alias("n_rows"))
    )


def month_key_nulls(df: DataFrame) -> DataFrame:
    """How often each way to get a month key fails."""
    from_date = month_key([])
    from_month = month_text("snap_ym")
    both = month_key(df.columns)
    return df.agg(
        F.count_if(from_date.isNull()).alias("from_date_nulls"),
        F.count_if(from_month.isNull()).alias("from_month_nulls"),
        F.count_if(both.isNull()).alias("month_key_nulls"),
    )
