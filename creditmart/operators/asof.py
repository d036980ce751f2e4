"""Point-in-time join: the latest feature row known at each label date.

The search for the right date runs on key columns only. Labels and feature histories are first
reduced to one mark per (customer, date), with map-side combine, so a customer with any number
of rows has at most one mark per calendar day. One window over those marks finds, for every
label date and every history at once, the newest feature date that is not later. The wide
feature rows are fetched afterwards by plain equi-joins on (customer, feature date), which AQE
can split when a key is hot. Work is linear in rows; no row pair is built and thrown away, and
nothing is broadcast unless Spark sees that it is small.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from creditmart.operators.dedupe import keep_first, row_hash


def as_of_dates(
    base: DataFrame,
    histories: Sequence[DataFrame],
    key: str = "customer_id",
    base_date: str = "label_date",
    feature_date: str = "feat_date",
) -> DataFrame:
    """One row per (key, base date) with the date to use from each history (``_date_0``...)."""
    marks = base.select(key, F.col(base_date).alias("_at"), F.lit(-1).alias("_from"))
    for place, history in enumerate(histories):
        marks = marks.unionByName(
            history.select(key, F.col(feature_date).alias("_at"), F.lit(place).alias("_from"))
        )
    marks = marks.where(F.col(key).isNotNull() & F.col("_at").isNotNull())

    dates = [f"_date_{place}" for place in range(len(histories))]
    days = marks.groupBy(key, "_at").agg(
        F.max(F.col("_from") == -1).alias("_wanted"),
        *[F.max(F.when(F.col("_from") == place, F.col("_at"))).alias(name)
          for place, name in enumerate(dates)],
    )
    so_far = Window.partitionBy(key).orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    return (
        days.withColumns({name: F.max(name).over(so_far) for name in dates})
        .where("_wanted")
        .select(key, F.col("_at").alias(base_date), *dates)
    )


def as_of_join(
    base: DataFrame,
    histories: Sequence[DataFrame],
    key: str = "customer_id",
    base_date: str = "label_date",
    feature_date: str = "feat_date",
    tie_breaks: Sequence[Sequence[Column]] | None = None,
) -> DataFrame:
    """Every base row with the payload of the newest history row at or before its date.

    Base rows without such a row stay, with nulls. Several history rows of one day are cut to
    one by ``tie_breaks`` (per history; default: a hash of the row, so that reruns agree).
    """
    dates = as_of_dates(base, histories, key, base_date, feature_date)
    # The used days of all histories in one frame: no date column can be pruned, so all readers of ``dates`` share its shuffles.
    used = dates.select(key, F.inline(F.array(*[
        F.struct(F.lit(place).alias("_from"), F.col(f"_date_{place}").alias(feature_date)) for place in range(len(histories))
    ]))).where(F.col(feature_date).isNotNull()) if histories else None
    result = base.join(dates, [key, base_date], "left")
    for place, history in enumerate(histories):
        date = f"_date_{place}"
        order = list(tie_breaks[place]) if tie_breaks else [row_hash(history)]
        # At most one row per label key survives, so only days that were found are cut to one row.
        days = used.where(F.col("_from") == place).select(key, feature_date).distinct()
        known = history.join(days, [key, feature_date], "left_semi")
        rows = keep_first(known, [key, feature_date], order).withColumnRenamed(feature_date, date)
        result = result.join(rows, [key, date], "left").drop(date)
    front = list(base.columns)
    return result.select(*front, *[name for name in result.columns if name not in front])


def exact_join(base: DataFrame, features: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Base rows with the feature rows of the very same keys."""
    result = base
    for frame in features:
        result = result.join(frame, list(keys), "left")
    return result
