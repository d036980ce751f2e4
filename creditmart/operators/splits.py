"""Time splits, rolling windows and the exact stratified split."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from creditmart import constants as K
from creditmart.functions.dates import first_of_month, month_list, months_back
from creditmart.operators.lookup import looked_up


def between_dates(column: str, start: str, end: str) -> Column:
    return F.col(column).between(F.lit(start).cast("date"), F.lit(end).cast("date"))


def time_split(df: DataFrame, dates: Mapping[str, tuple[str, str]] = K.SPLIT_DATES,
               column: str = "snapshot_date") -> DataFrame:
    """Adds ``split`` by inclusive date ranges; rows outside all of them drop out."""
    split = F
    for name, (start, end) in dates.items():
        split = split.when(between_dates(column, start, end), name)
    return df.withColumn("split", split).where("split is not null")


def split_summary(df: DataFrame, label: str = "label") -> DataFrame:
    return df.groupBy("split").agg(
        F.count(F.lit(1)).alias("n_rows"), F.round(F.avg(label), 2).alias("label_rate"))


def window_months(spark, first_run: str, last_run: str, mode: str = "month",
                  windows: Mapping[str, tuple[int, int]] = K.ROLLING_WINDOWS) -> DataFrame:
    """(run_month, split, month): the months each monthly run trains and tests on.

    ``mode='days'`` steps back by 30 days and then to the first of the month.
    """
    runs = month_list(spark, first_run, last_run, "run_month")
    lines = F.array(*[
        F.struct(F.lit(name).alias("split"),
                 months_back("run_month", start, mode).alias("start"),
                 months_back("run_month", end, mode).alias("end"))
        for name, (start, end) in windows.items()
    ])
    spans = runs.select("run_month", F.inline(lines))
    return spans.select("run_month", "split", F.explode(
        F.sequence("start", "end", F.expr("interval 1 month"))).alias("month"))


def rolling_windows(df: DataFrame, first_run: str, last_run: str, mode: str = "month",
                    column: str = "snapshot_date") -> DataFrame:
    """Each row once per run and split that uses its month.

    The window list has at most a handful of rows per run month, so it is joined as a
    broadcast: its size follows the calendar, not the data.
    """
    windows = window_months(df.sparkSession, first_run, last_run, mode)
    return df.withColumn("month", first_of_month(column)).join(F.broadcast(windows), "month").drop("month")


def training_window(train_date: str, train_test_months: int = 12, oot_months: int = 2) -> dict[str, Column]:
    """Bounds of the train/test span and the out-of-time span before a training date."""
    day = F.lit(train_date).cast("date")
    oot_start = F.add_months(day, -oot_months)
    return {
        "train_test_start": F.add_months(oot_start, -train_test_months),
        "train_test_end": F.date_sub(oot_start, 1),
        "oot_start": oot_start,
        "oot_end": F.date_sub(day, 1),
    }


def training_split(df: DataFrame, train_date: str, column: str = "snapshot_date", **months: int) -> DataFrame:
    """Adds ``split`` of 'train_test' or 'oot' around a training date; other rows drop out."""
    at = training_window(train_date, **months)
    day = F.col(column)
    split = F.when(day.between(at["oot_start"], at["oot_end"]), "oot").when(
        day.between(at["train_test_start"], at["train_test_end"]), "train_test")
    return df.withColumn("split", split).where("split is not null")


def stratified_split(df: DataFrame, keys: Sequence[str], ratio: float = 0.8, label: str = "label",
                     seed: int = 88, digits: int = 4) -> DataFrame:
    """Adds ``part`` ('train'/'test') with the exact train share in every label stratum.

    Rows are ranked by a seeded hash of their key (the first 15 hex digits of an MD5, which order as text like
    numbers), but no stratum is sorted or shuffled as a whole. Rows are counted per hash slot (the first
    ``digits``), the slot with the cut is found from those counts, and
    only that slot's hashes are ranked to get the cut hash of the stratum. Rows then compare
    their hash with it. The split is exact when keys are unique; copies of a key share a side.
    """
    slot = F.substring("_hash", 1, digits)
    text = F.concat_ws("|", F.lit(seed), *[F.col(k).cast("string") for k in keys])
    hashed = df.withColumn("_hash", F.substring(F.md5(text), 1, 15))
    slotted = hashed.select(label, "_hash", slot.alias("_slot"))

    per_slot = slotted.groupBy(label, "_slot").agg(F.count(F.lit(1)).alias("_in_slot"))
    stratum = Window.partitionBy(label)
    earlier = stratum.orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    placed = per_slot.withColumns({
        "_before": F.coalesce(F.sum("_in_slot").over(earlier), F.lit(0)),
        "_take": F.floor(F.sum("_in_slot").over(stratum) * ratio + 1e-9),
    })
    has_cut = (F.col("_before") < F.col("_take")) & (F.col("_take") <= F.col("_before") + F.col("_in_slot"))
    cut_slot = placed.where(has_cut).select(label, "_slot", "_before", "_take")

    # Slots before the cut slot are train throughout; in it, hashes count up to the share.
    draws = slotted.join(cut_slot, [label, "_slot"]).groupBy(label, "_before", "_take", "_hash").agg(
        F.count(F.lit(1)).alias("_n"))
    upto = Window.partitionBy(label).orderBy("_hash").rowsBetween(Window.unboundedPreceding, -1)
    rank = F.col("_before") + F.coalesce(F.sum("_n").over(upto), F.lit(0))
    cut = (draws.withColumn("_rank", rank).where(F.col("_rank") < F.col("_take"))
           .groupBy(label).agg(F.max("_hash").alias("_cut")))
    part = F.when(F.col("_hash") <= F.col("_cut"), "train").otherwise("test")
    return hashed.withColumn("_cut", looked_up(cut, [label], "_cut")).withColumn("part", part).drop("_hash", "_cut")
