"""Projections, renames and filters."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditmart import constants as K
from creditmart.functions.cleaning import to_int
from creditmart.functions.dates import any_date, month_of, month_text


def snake_case(df: DataFrame) -> DataFrame:
    return df.toDF(*[name.strip().lower().replace(" ", "_") for name in df.columns])


def lower_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[name.lower() for name in df.columns])


def rename_absent(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename columns whose new name is not taken yet."""
    wanted = {old: new for old, new in names.items() if old in df.columns and new not in df.columns}
    return df.withColumnsRenamed(wanted)


def rename_customer(df: DataFrame) -> DataFrame:
    return df.withColumnRenamed("Customer_ID", "customer_id")


def select_present(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """The wanted columns the frame has, in the wanted order."""
    return df.select(*[name for name in wanted if name in df.columns])


def select_prefix(df: DataFrame, prefix: str, keep: Sequence[str] = (), any_case: bool = False) -> DataFrame:
    return df.select(*keep, *prefixed(df, prefix, any_case))


def prefixed(df: DataFrame, prefix: str, any_case: bool = False) -> list[str]:
    if any_case:
        return [name for name in df.columns if name.lower().startswith(prefix.lower())]
    return [name for name in df.columns if name.startswith(prefix)]


def ensure_columns(df: DataFrame, expected: Mapping[str, str]) -> DataFrame:
    """Expected columns in order; those the frame lacks come as nulls of the given type."""
    present = set(df.columns)
    return df.select(*[
        F.col(name) if name in present else F.lit(None).cast(kind).alias(name)
        for name, kind in expected.items()
    ])


def require_columns(df: DataFrame, names: Iterable[str], any_of: bool = False) -> DataFrame:
    """Fail while the plan is built when needed columns are absent."""
    names = list(names)
    missing = [name for name in names if name not in df.columns]
    if (any_of and len(missing) == len(names)) or (missing and not any_of):
        raise ValueError(f"missing column(s) {missing}; the frame has {df.columns}")
    return df


def cast_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Enforce a type map in one projection; values that do not fit become null.

    Columns that have their type already stay untouched, so filters on them reach the scan.
    """
    def typed(name: str, given: str) -> Column:
        kind = types.get(name, given)
        if kind == given:
            return F.col(name)
        value = to_int(name) if kind == "int" and given == "string" else F.col(name).try_cast(kind)
        return value.alias(name)
    return df.select(*[typed(name, given) for name, given in df.dtypes])


def trim_strings(df: DataFrame) -> DataFrame:
    return df.select(*[
        F.trim(name).alias(name) if kind == "string" else F.col(name) for name, kind in df.dtypes
    ])


def with_lineage(df: DataFrame, run_date: str, month: Column, source_file: Column) -> DataFrame:
    """Load date, month and file name. The load date is given, so that reruns repeat."""
    return df.withColumns({
        "ingest_dt": F.lit(run_date).cast("date"),
        "snap_ym": month,
        "source_file": source_file,
    })


def row_month(df: DataFrame) -> Column:
    """Month of a raw row, from ``snap_ym`` or from ``snapshot_date`` in any known format."""
    require_columns(df, ["snap_ym", "snapshot_date"], any_of=True)
    if "snap_ym" in df.columns:
        return month_text("snap_ym")
    return month_of(any_date("snapshot_date"))


def filter_month(df: DataFrame, month: str) -> DataFrame:
    """Rows of one 'yyyy-MM' month."""
    return df.where(row_month(df) == month)


def filter_snapshot(df: DataFrame, snapshot: str, column: str = "snapshot_date") -> DataFrame:
    return df.where(F.col(column) == F.lit(snapshot).cast("date"))


def filter_dates(df: DataFrame, start: str, end: str, column: str = "snapshot_date") -> DataFrame:
    return df.where(F.col(column).between(F.lit(start).cast("date"), F.lit(end).cast("date")))


def filter_mob(df: DataFrame, mob: int) -> DataFrame:
    return df.where(F.col("mob") == mob)


def completed_loans(df: DataFrame, before: str) -> DataFrame:
    """Loans started before a date, i.e. old enough to have run their term."""
    return df.where(F.col("loan_start_date") < F.lit(before).cast("date"))


def outside(df: DataFrame, column: str, low: float, high: float) -> DataFrame:
    return df.where((F.col(column) < low) | (F.col(column) > high))


def union_months(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by name; columns missing in some months are null there."""
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame, allowMissingColumns=True)
    return result


def top_rows(df: DataFrame, order: Sequence[Column], rows: int = K.PREVIEW_ROWS) -> DataFrame:
    return df.orderBy(*order).limit(rows)


def seeded_sample(df: DataFrame, keys: Sequence[str], rows: int = K.SAMPLE_POSITIVES, seed: int = 42) -> DataFrame:
    """A repeatable sample of at most ``rows`` rows: the smallest MD5 of seed and key."""
    draw = F.md5(F.concat_ws("|", F.lit(seed), *[F.col(k).cast("string") for k in keys]))
    return df.orderBy(draw, *keys).limit(rows)
