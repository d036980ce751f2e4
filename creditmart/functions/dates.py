"""Date and month expressions."""

from __future__ import annotations

import re
from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

from creditmart import constants as K
from creditmart.functions.cleaning import ColumnLike, col


_SHAPES = {"d": "_%", "dd": "__", "M": "_%", "MM": "__", "yy": "__", "yyyy": "____%"}


def date_shape(form: str) -> str:
    """LIKE pattern that every text of a date format meets, after the least and most digits of its fields."""
    return re.sub("[a-zA-Z]+", lambda field: _SHAPES[field[0]], form)


def any_date(c: ColumnLike) -> Column:
    """Date from text in any of the known formats; day-first readings win.

    A format is tried only on text of its shape: a failed reading throws, which costs far more than all else here.
    Text without a slash can only be an ISO date, which the cast reads like the format, at less cost.
    """
    text = col(c).cast("string")
    iso = text.try_cast("date")
    readings = [F.when(text.like(date_shape(form)), F.try_to_date(text, form)) for form in K.DATE_FORMATS]
    return F.coalesce(F.when(~text.contains("/"), iso), *readings, iso)


def iso_date(c: ColumnLike) -> Column:
    return col(c).try_cast("date")


def month_of(c: ColumnLike) -> Column:
    """'yyyy-MM' of a date or timestamp."""
    return F.date_format(col(c), "yyyy-MM")


def month_text(c: ColumnLike) -> Column:
    """'yyyy-MM' of a month column that holds either that text or a timestamp."""
    text = col(c).cast("string")
    return F.when(F.length(text) == 7, text).otherwise(month_of(text.try_cast("timestamp")))


def month_key(columns: list[str], date_col: str = "snapshot_date", month_col: str = "snap_ym") -> Column:
    """Month from the date, else from the month column where the frame has one."""
    parts = [month_of(iso_date(date_col))]
    if month_col in columns:
        parts.append(month_text(month_col))
    return F.coalesce(*parts)


def feature_date(columns: list[str], date_col: str = "snapshot_date", month_col: str = "snap_ym") -> Column:
    """Snapshot date, else the first day of the month column."""
    parts = [iso_date(date_col)]
    if month_col in columns:
        parts.append(col(month_col).cast("string").try_cast("timestamp").cast("date"))
    return F.coalesce(*parts)


def first_of_month(c: ColumnLike) -> Column:
    return F.trunc(col(c), "MM").cast("date")


def months_back(c: ColumnLike, steps: int, mode: str = "month") -> Column:
    """First day of the month that lies ``steps`` months (or 30-day steps) before ``c``."""
    if mode == "month":
        return first_of_month(F.add_months(col(c), -steps))
    if mode == "days":
        return first_of_month(F.date_sub(col(c), 30 * steps))
    raise ValueError(f"unknown window mode {mode!r}")


def month_list(spark, start: str | date, end: str | date, name: str = "month"):
    """Frame with one row per first of month from the month of ``start`` up to ``end``."""
    first = F.lit(str(start)).cast("date")
    last = F.lit(str(end)).cast("date")
    months = F.sequence(first_of_month(first), first_of_month(last), F.expr("interval 1 month"))
    return spark.range(1).select(F.explode(months).alias(name))
