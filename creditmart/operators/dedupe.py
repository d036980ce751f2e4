"""Keep-one-row-per-key operators.

Spark turns ``row_number() == 1`` into a group limit that already runs before the shuffle, so
even a key with a huge number of copies reaches its reducer as one row per map task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(window)).where("_rn = 1").drop("_rn")


def row_hash(df: DataFrame) -> Column:
    """Hash of all columns, a stable last resort for equal rows."""
    return F.xxhash64(*[F.col(name) for name in df.columns])


def keep_latest(
    df: DataFrame,
    keys: Sequence[str] = ("customer_id", "snapshot_date"),
    latest: str = "ingest_dt",
    tie_break: Sequence[Column] = (),
) -> DataFrame:
    """Newest row per key, nulls last; any row per key when there is no load date."""
    ties = list(tie_break) or [row_hash(df)]
    if latest not in df.columns:
        return keep_first(df, keys, ties)
    return keep_first(df, keys, [F.col(latest).desc_nulls_last(), *ties])
