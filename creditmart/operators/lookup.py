"""Values of a side with one row per model, stratum or the like."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def looked_up(side: DataFrame, keys: Sequence[str], value: str) -> Column:
    """``value`` of the row of ``side`` with the same keys, null if there is none.

    ``side`` becomes one map in a subquery of the query that uses it, so nothing runs before and
    the large side is not shuffled onto its few keys. Only for sides whose keys are few by their
    meaning and occur once; rows with a null key find nothing.
    """
    known = side.dropna(subset=list(keys))
    entry = F.struct(F.struct(*keys).alias("key"), F.col(value).alias("value"))
    table = known.agg(F.map_from_entries(F.collect_list(entry)).alias("table")).scalar()
    return F.try_element_at(table, F.struct(*keys))
