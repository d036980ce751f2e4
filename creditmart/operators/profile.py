"""Profiling and exploration: counts, null rates, distributions, correlations.

Wide results are computed in one aggregation over all columns and turned into long format
afterwards, on one row.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from creditmart import constants as K
from creditmart.functions.dates import month_of
from creditmart.operators.ranges import IMAGE, with_image


def long_form(wide: DataFrame, lines: Sequence[Mapping[str, Column]], keep: Sequence[str] = ()) -> DataFrame:
    """One row per line from each wide row; a line maps result columns to expressions."""
    rows = F.array(*[F.struct(*[c.alias(name) for name, c in line.items()]) for line in lines])
    return wide.select(*keep, F.inline(rows))


def melt(df: DataFrame, columns: Sequence[str], kind: str = "double", keep: Sequence[str] = ()) -> DataFrame:
    """(column, value) rows of the given columns."""
    return long_form(df, [{"column": F.lit(c), "value": F.col(c).cast(kind)} for c in columns], keep)


# ---- counts -----------------------------------------------------------------------------

def count_rows(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows"))


def count_by(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return count_by(df, [column]).orderBy(F.desc("n_rows"), F.asc(column))


def class_share(df: DataFrame, column: str = "label") -> DataFrame:
    """Percent of all rows per value; the total is a scalar subquery over the counts."""
    counts = count_by(df, [column])
    total = counts.agg(F.sum("n_rows").alias("total")).scalar()
    return counts.withColumn("percent", F.col("n_rows") / total * 100)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return count_by(df, keys).where("n_rows > 1")


def distinct_keys(df: DataFrame, keys: Sequence[str], approximate: bool = False) -> DataFrame:
    """Distinct key combinations, null keys included."""
    if approximate:
        return df.agg(F.approx_count_distinct(F.struct(*keys)).alias("n_keys"))
    return df.select(*keys).distinct().agg(F.count(F.lit(1)).alias("n_keys"))


def rows_per_snapshot(df: DataFrame, column: str = "snapshot_date") -> DataFrame:
    return count_by(df, [column]).orderBy(column)


# ---- nulls, ranges ----------------------------------------------------------------------

def null_rates(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Nulls and null percent per column, worst first."""
    columns = list(columns or df.columns)
    wide = df.agg(F.count(F.lit(1)).alias("_all"),
                  *[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    lines = [{"column": F.lit(c), "nulls": F.col(c),
              "null_rate": F.try_divide(F.col(c), F.col("_all")) * 100} for c in columns]
    return long_form(wide, lines).orderBy(F.desc("null_rate"), F.asc("column"))


def null_rates_by(df: DataFrame, by: str, columns: Sequence[str]) -> DataFrame:
    return df.groupBy(by).agg(*[
        (F.avg(F.col(c).isNull().cast("double")) * 100).alias(c) for c in columns if c in df.columns
    ])


def filled_rates(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.agg(*[
        (1 - F.avg(F.col(c).isNull().cast("double"))).alias(f"{c}_non_null_rate")
        for c in columns if c in df.columns
    ])


def value_ranges(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Minimum, maximum and mean per column."""
    wide = df.agg(*[f(c).cast("double").alias(f"{name}_{c}") for c in columns
                    for name, f in (("min", F.min), ("max", F.max), ("mean", F.avg))])
    return long_form(wide, [
        {"column": F.lit(c), **{name: F.col(f"{name}_{c}") for name in ("min", "max", "mean")}}
        for c in columns
    ])


def share_where(df: DataFrame, tests: Mapping[str, Column]) -> DataFrame:
    """Percent of rows that meet each test; a null test counts as not met."""
    wide = df.agg(*[(F.avg(F.when(test, 1.0).otherwise(0.0)) * 100).alias(name)
                    for name, test in tests.items()])
    return long_form(wide, [{"column": F.lit(name), "percent": F.col(name)} for name in tests])


def negative_share(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return share_where(df, {c: F.col(c) < 0 for c in columns if c in df.columns})


def not_two_decimals(c: str) -> Column:
    return F.abs(F.col(c) - F.round(c, 2)) > K.TWO_DP_TOLERANCE


def two_dp_share(df: DataFrame, columns: Sequence[str] = K.TWO_DP_COLUMNS) -> DataFrame:
    return share_where(df, {c: not_two_decimals(c) for c in columns if c in df.columns})


def length_profile(df: DataFrame, column: str) -> DataFrame:
    return df.agg(
        F.max(F.length(column)).alias("max_len"),
        F.percentile_approx(F.length(column), 0.99).alias("p99_len"),
    )


# ---- labels -----------------------------------------------------------------------------

def label_rate(df: DataFrame, by: str | None = None, label: str = "label") -> DataFrame:
    """Rows and mean label, overall or per value of a column."""
    groups = [by] if by else []
    return df.groupBy(*groups).agg(F.count(F.lit(1)).alias("n_rows"), F.avg(label).alias("label_rate"))


def label_rate_by_month(df: DataFrame, date: str = "snapshot_date", label: str = "label") -> DataFrame:
    return label_rate(df.withColumn("month", month_of(date)), "month", label)


def bad_rate_curve(df: DataFrame, flag: Column, by: str = "mob") -> DataFrame:
    return df.groupBy(by).agg(F.avg(flag).alias("bad_rate"))


# ---- distributions ----------------------------------------------------------------------

ROUNDS = (20, 22, 22)  # leading bits of a value, then the next ones: all 64 in three rounds


def exact_percentiles(df: DataFrame, columns: Sequence[str], shares: Sequence[float]) -> DataFrame:
    """Interpolated percentiles per column as (column, share, value), exact at any size.

    Radix selection on the values' order-preserving bits, in one lazy plan: values are counted by their
    leading bits, which tells the slot of every wanted rank; only the values of these slots are
    counted by the next bits, and so on. No round ranks more than its 2^22 slots, and nothing is sorted but counts.
    The rows are read once, to count them per distinct value: all rounds read that shuffle.
    """
    values = melt(df, columns).where("value is not null").groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    shift, slot, found = 64, [], None  # the slots' bits so far; (column, slot, its ends, ranks in it)
    for number, width in enumerate(ROUNDS):
        shift -= width
        rows, keys = values, ["column", *slot]
        if found is not None:
            # At most two ranks per column and share, so this side cannot outgrow a broadcast. A slot's values are all those
            # between its ends, so bits are only found for values in wanted slots. The ranks go on as a key, one list
            # per slot, so that the round before stands once in the plan.
            rows = rows.join(F.broadcast(found), "column").where(F.col("value").between(F.col("_low"), F.col("_high")))
            keys = [*keys, "_ranks"]
        bits = F.shiftright(IMAGE, shift) if not number else F.shiftright(IMAGE, shift).bitwiseAND((1 << width) - 1)
        rows = with_image(rows, "value").withColumn(f"_bits{number}", bits)
        counts = rows.groupBy(*keys, f"_bits{number}").agg(F.sum("n").alias("n"), F.min("value").alias("value"), F.max("value").alias("_high"))
        inside = Window.partitionBy("column", *slot).orderBy(f"_bits{number}")
        before = F.coalesce(F.sum("n").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        counts = counts.withColumn("_before", before)
        if found is None:
            last = F.sum("n").over(Window.partitionBy("column")) - 1
            ranks = [(F.lit(float(s)), F.lit(float(s)) * last, end(F.lit(float(s)) * last)) for s in shares for end in (F.floor, F.ceil)]
            counts = counts.withColumn("_ranks", F.array(*[
                F.struct(s.alias("share"), rank.alias("rank"), place.alias("place"), place.alias("left")) for s, rank, place in ranks]))
        slot.append(f"_bits{number}")
        here = F.filter("_ranks", lambda r: (r["left"] >= F.col("_before")) & (r["left"] < F.col("_before") + F.col("n")))
        found = counts.select("column", *slot, F.col("value").alias("_low"), "_high", F.transform(here, lambda r: r.withField(
            "left", r["left"] - F.col("_before"))).alias("_ranks")).where(F.size("_ranks") > 0)
    found = found.select("column", F.col("_low").alias("value"), F.inline("_ranks"))
    low, high = F.min_by("value", "place"), F.max_by("value", "place")
    part = F.max(F.col("rank") - F.floor("rank"))
    return found.groupBy("column", "share").agg((low + (high - low) * part).alias("value"))


def describe(df: DataFrame, columns: Sequence[str], shares: Sequence[float] = K.SUMMARY_PERCENTILES) -> DataFrame:
    """Count, mean, sample deviation, minimum, maximum and percentiles, one row per column."""
    stats = {"count": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    wide = df.agg(*[f(F.col(c).cast("double")).alias(f"{name}_{c}")
                    for c in columns for name, f in stats.items()])
    basics = long_form(wide, [
        {"column": F.lit(c), **{name: F.col(f"{name}_{c}") for name in stats}} for c in columns
    ])
    names = {s: f"p{s * 100:g}" for s in shares}
    places = exact_percentiles(df, columns, shares).groupBy("column").agg(*[
        F.max(F.when(F.col("share") == s, F.col("value"))).alias(name) for s, name in names.items()
    ])
    return basics.join(places, "column", "left")


def histogram(df: DataFrame, columns: Sequence[str], bins: int = K.HISTOGRAM_BINS) -> DataFrame:
    """Rows per equal-width bin between minimum and maximum, the top value in the last bin."""
    ends = df.agg(*[F.struct(F.min(F.col(c).cast("double")).alias("lo"),
                             F.max(F.col(c).cast("double")).alias("hi")).alias(c) for c in columns])
    limits = long_form(ends, [
        {"column": F.lit(c), "lo": F.col(f"{c}.lo"), "hi": F.col(f"{c}.hi")} for c in columns
    ])
    # One row per column of the frame, so this side cannot outgrow a broadcast.
    rows = melt(df, columns).where("value is not null").join(F.broadcast(limits), "column")
    width = (F.col("hi") - F.col("lo")) / bins
    place = F.floor(F.try_divide(F.col("value") - F.col("lo"), width))
    bin_no = F.least(F.coalesce(place, F.lit(0)), F.lit(bins - 1)).cast("int")
    return rows.withColumn("bin", bin_no).groupBy("column", "bin").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.max(F.col("lo") + F.col("bin") * width).alias("bin_start"),
    )


def variance_rank(df: DataFrame, columns: Sequence[str], top: int = K.VARIANCE_TOP) -> DataFrame:
    wide = df.agg(*[F.var_samp(c).alias(c) for c in columns])
    lines = [{"column": F.lit(c), "variance": F.col(c)} for c in columns]
    return long_form(wide, lines).orderBy(F.desc_nulls_last("variance"), F.asc("column")).limit(top)


def _pair_corr(a: str, b: str) -> Column:
    """Pearson correlation over the rows that have both values, null where one is constant.

    Built from a covariance and the variances over the same rows; ``corr`` divides by zero for a
    constant column.
    """
    x, y = F.col(a).cast("double"), F.col(b).cast("double")
    spread = F.var_pop(F.when(y.isNotNull(), x)) * F.var_pop(F.when(x.isNotNull(), y))
    return F.try_divide(F.covar_pop(x, y), F.sqrt(spread))


def _self_corr(c: str) -> Column:
    return F.when(F.var_pop(F.col(c).cast("double")) > 0, 1.0)


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_a, column_b, corr) for every ordered pair, from one aggregation."""
    pairs = list(combinations(columns, 2))
    wide = df.agg(*[_pair_corr(a, b).alias(f"{a}|{b}") for a, b in pairs],
                  *[_self_corr(c).alias(f"{c}|{c}") for c in columns])
    cells = [(a, b, f"{a}|{b}") for a, b in pairs] + [(b, a, f"{a}|{b}") for a, b in pairs]
    cells += [(c, c, f"{c}|{c}") for c in columns]
    return long_form(wide, [
        {"column_a": F.lit(a), "column_b": F.lit(b), "corr": F.col(f"`{name}`")} for a, b, name in cells
    ])


def label_correlation(df: DataFrame, columns: Sequence[str], label: str = "label") -> DataFrame:
    """Correlation of each column with the label, strongest first."""
    wide = df.agg(*[_pair_corr(c, label).alias(c) for c in columns])
    lines = [{"column": F.lit(c), "corr": F.col(c)} for c in columns]
    return long_form(wide, lines).orderBy(F.abs("corr").desc_nulls_last(), F.asc("column"))
