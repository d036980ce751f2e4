"""Feature expressions: loan ageing, ratios, buckets, flags, loan mix."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from creditmart import constants as K
from creditmart.functions.cleaning import ColumnLike, col, label_definition


# ---- loan ageing ------------------------------------------------------------------------

def installments_missed(overdue: ColumnLike, due: ColumnLike) -> Column:
    """Whole instalments covered by the overdue amount; 0 where the ratio is undefined."""
    ratio = F.try_divide(col(overdue).cast("double"), col(due).cast("double"))
    return F.coalesce(F.ceil(ratio).cast("int"), F.lit(0))


def first_missed_date(snapshot: ColumnLike, missed: ColumnLike) -> Column:
    return F.when(col(missed) > 0, F.add_months(col(snapshot), -col(missed)))


def days_past_due(snapshot: ColumnLike, overdue: ColumnLike, first_missed: ColumnLike) -> Column:
    late = F.datediff(col(snapshot), col(first_missed))
    return F.when(col(overdue) > 0, late).otherwise(0).cast("int")


def arrears_flag(dpd: ColumnLike, days: int) -> Column:
    return F.when(col(dpd) >= days, 1).otherwise(0)


def label_columns(dpd_days: int, mob: int, dpd: ColumnLike = "dpd") -> dict[str, Column]:
    return {
        "label": arrears_flag(dpd, dpd_days).cast("int"),
        "label_def": F.lit(label_definition(dpd_days, mob)),
    }


# ---- buckets ----------------------------------------------------------------------------

def _first_true(tests: Sequence[Column], values: Sequence) -> Column:
    chain = F
    for test, value in zip(tests, values):
        chain = chain.when(test, value)
    return chain.otherwise(values[-1])


def bucket(value: ColumnLike, edges: Sequence, names: Sequence) -> Column:
    """Name of the first edge above the value; the last name also takes nulls."""
    return _first_true([col(value) < edge for edge in edges], names)


def inquiry_bucket(value: ColumnLike, names: Sequence) -> Column:
    """Nulls have a bucket of their own here, and negatives count as few."""
    v = col(value)
    return _first_true([v.isNull(), v == 0, v <= 2, v <= 5], names)


def bucket_pairs() -> dict[str, Column]:
    """Label and position of the utilisation, history and inquiry buckets."""
    places = list(range(len(K.UTIL_LABELS)))
    util, months, asked = "credit_utilization_ratio", "credit_history_age", "num_credit_inquiries"
    return {
        "util_bucket": bucket(util, K.UTIL_EDGES, K.UTIL_LABELS),
        "util_bucket_idx": bucket(util, K.UTIL_EDGES, places),
        "hist_bucket": bucket(months, K.HISTORY_EDGES, K.HISTORY_LABELS),
        "hist_bucket_idx": bucket(months, K.HISTORY_EDGES, places),
        "inq_bucket": inquiry_bucket(asked, K.INQUIRY_LABELS),
        "inq_bucket_idx": inquiry_bucket(asked, places),
    }


# ---- ratios and interactions ------------------------------------------------------------

def ratios() -> dict[str, Column]:
    """Affordability ratios; null where the denominator is null or zero."""
    income = F.col("annual_income")
    emi = F.col("total_emi_per_month")
    return {
        "dti": F.try_divide(F.col("outstanding_debt"), income),
        "emi_to_income": F.try_divide(emi * 12.0, income),
        "emi_to_balance": F.try_divide(emi, F.abs("monthly_balance")),
        "invest_to_income": F.try_divide(F.col("amount_invested_monthly") * 12.0, income),
    }


def utilisation() -> dict[str, Column]:
    util = F.col("credit_utilization_ratio").cast("double")
    capped = F.when(util > K.UTIL_CAP, K.UTIL_CAP).otherwise(util)
    return {"util_capped": capped, "util_sq": F.pow(capped, F.lit(2.0))}


def interactions() -> dict[str, Column]:
    return {
        "emi_x_util": F.col("total_emi_per_month") * F.col("credit_utilization_ratio"),
        "interest_x_loans": F.col("interest_rate") * F.col("num_of_loan"),
        "dti_x_inq": ratios()["dti"] * F.col("num_credit_inquiries"),
    }


# ---- flags and classes ------------------------------------------------------------------

def null_flag(c: ColumnLike) -> Column:
    return col(c).isNull().cast("int")


def missing_flags() -> dict[str, Column]:
    minimum = F.upper("payment_of_min_amount")
    unknown = minimum.isNull() | minimum.isin(*K.MIN_PAYMENT_UNKNOWN)
    return {
        "is_income_null": null_flag("annual_income"),
        "is_outstanding_debt_null": null_flag("outstanding_debt"),
        "is_util_null": null_flag("credit_utilization_ratio"),
        "is_hist_null": null_flag("credit_history_age"),
        "is_inquiry_null": null_flag("num_credit_inquiries"),
        "is_minpay_null": unknown.cast("int"),
        "is_behav_null": null_flag("payment_behaviour"),
        "is_type_of_loan_null": null_flag("type_of_loan"),
    }


def yes_no(c: ColumnLike) -> Column:
    answer = F.upper(col(c))
    return F.when(answer == "YES", 1).when(answer == "NO", 0)


def behaviour_class(c: ColumnLike) -> Column:
    """First class with one of its marks in the text; 'unknown' otherwise."""
    text = F.upper(F.coalesce(col(c), F.lit("")))
    tests, names = [], []
    for name, marks in K.BEHAVIOUR_CLASSES:
        test = F.lit(False)
        for mark in marks:
            test = test | text.contains(mark)
        tests.append(test)
        names.append(name)
    return _first_true(tests, [*names, "unknown"])


def one_hot(value: ColumnLike, vocabulary: Sequence[str], prefix: str) -> dict[str, Column]:
    """One 0/1 column per word; fixed words keep the schema the same in every month."""
    return {f"{prefix}{word}": F.when(col(value) == word, 1).otherwise(0) for word in vocabulary}


# ---- loan mix ---------------------------------------------------------------------------

def loan_list_text(c: ColumnLike) -> Column:
    """Loan list in upper case with commas between names; one pass per rule, names untrimmed."""
    text = F.upper(F.coalesce(col(c).cast("string"), F.lit("")))
    for pattern, put in K.LOAN_LIST_RULES:
        text = F.regexp_replace(text, pattern, put)
    return text


def loan_types(c: ColumnLike) -> Column:
    names = F.split(loan_list_text(c), r"\s*,\s*")
    return F.array_distinct(F.filter(names, lambda name: name != ""))


def loan_mix(types: ColumnLike) -> dict[str, Column]:
    """Number of different loan types and a flag for each known one."""
    held = col(types)
    flags = {name: F.array_contains(held, loan) for name, loan in K.LOAN_FLAGS.items()}
    return {"loan_types_count_unique": F.size(held), **flags}
