"""Frame-level builds of every layer; no paths here."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditmart import constants as K
from creditmart.functions import cleaning as C
from creditmart.functions import features as X
from creditmart.functions.dates import feature_date, iso_date
from creditmart.operators.asof import as_of_join, exact_join
from creditmart.operators.dedupe import keep_latest
from creditmart.operators.projection import (
    cast_columns,
    filter_mob,
    prefixed,
    rename_absent,
    rename_customer,
    require_columns,
    row_month,
    select_present,
    snake_case,
    trim_strings,
    with_lineage,
)


# ---- bronze -----------------------------------------------------------------------------

def bronze(raw: DataFrame, run_date: str, months: Sequence[str] | None = None) -> DataFrame:
    """Raw rows of all months (or the given ones) with lineage, in one pass over the source.

    A row whose month cannot be read belongs to no month and is left out.
    """
    month = row_month(raw)
    rows = with_lineage(raw, run_date, month, F.col("_metadata.file_name"))
    rows = rows.where(F.col("snap_ym").isNotNull())
    return rows.where(F.col("snap_ym").isin(*months)) if months else rows


# ---- silver -----------------------------------------------------------------------------

def latest_per_month(df: DataFrame, tie_break: Sequence[Column] = ()) -> DataFrame:
    """Latest load per customer and snapshot within a month.

    The month is part of the key, because rows with an unreadable date are told apart by it when
    several months are built at once.
    """
    keys = [k for k in ("customer_id", "snapshot_date", "snap_ym") if k in df.columns]
    return keep_latest(df, keys, tie_break=tie_break)


def silver_loans(bronze_loans: DataFrame) -> DataFrame:
    """Typed loans with month on book, missed instalments, first missed date, days past due."""
    typed = cast_columns(bronze_loans, K.LOAN_TYPES)
    aged = typed.withColumns({
        "mob": F.col("installment_num"),
        "installments_missed": X.installments_missed("overdue_amt", "due_amt"),
    }).na.fill(0)
    return aged.withColumn(
        "first_missed_date", X.first_missed_date("snapshot_date", "installments_missed")
    ).withColumn("dpd", X.days_past_due("snapshot_date", "overdue_amt", "first_missed_date"))


def silver_attributes(bronze_attributes: DataFrame) -> DataFrame:
    rows = bronze_attributes.withColumns({
        "customer_id": F.col("Customer_ID").cast("string"),
        "occupation": C.occupation_text("Occupation"),
        "snapshot_date": iso_date("snapshot_date"),
    })
    return rows.select(*K.ATTRIBUTE_COLUMNS)


def silver_clickstream(bronze_clickstream: DataFrame, tie_break: Sequence[Column] = ()) -> DataFrame:
    """Keys, lineage and all features as doubles; the latest load per (customer, snapshot)."""
    names = prefixed(bronze_clickstream, "fe_", any_case=True)
    rows = bronze_clickstream.withColumns({
        "customer_id": F.col("Customer_ID").cast("string"),
        "snapshot_date": iso_date("snapshot_date"),
        **{name: C.to_double(name) for name in names},
    })
    keys = ("customer_id", "snapshot_date", *K.LINEAGE)
    return latest_per_month(rows.select(*[k for k in keys if k in rows.columns], *names), tie_break)


def financial_columns(columns: Sequence[str]) -> dict[str, Column]:
    """Cleaning expression per financial column that the frame has."""
    rules = {
        "annual_income": C.money, "outstanding_debt": C.money,
        "monthly_inhand_salary": C.two_decimals, "amount_invested_monthly": C.two_decimals,
        "monthly_balance": C.two_decimals,
        "interest_rate": C.interest_percent,
        "delay_from_due_date": C.to_int, "num_credit_inquiries": C.to_int,
        "num_of_delayed_payment": C.digits_int,
        "changed_credit_limit": C.to_double, "credit_utilization_ratio": C.to_double,
        "total_emi_per_month": C.to_double,
        "credit_history_age": C.history_months,
        "credit_mix": C.category_title, "payment_behaviour": C.behaviour_text,
    }
    cleaned = {name: rule(name) for name, rule in rules.items() if name in columns}
    if "type_of_loan" in columns:
        cleaned["num_of_loan"] = C.loan_count("type_of_loan")
    return cleaned


def _named_financials(bronze_financials: DataFrame) -> DataFrame:
    """Canonical headers and typed, trimmed keys; all other values still raw."""
    rows = rename_absent(snake_case(bronze_financials), K.HEADER_TYPOS)
    typed = {"ingest_dt": "timestamp", "snapshot_date": "date"}
    keys = {c: F.col(c).try_cast(kind) for c, kind in typed.items() if c in rows.columns}
    return rows.withColumns({**keys, "customer_id": F.trim("customer_id")})


def _cleaned(named: DataFrame) -> DataFrame:
    rows = trim_strings(named)
    return rows.withColumns(financial_columns(rows.columns))


def clean_financials(bronze_financials: DataFrame) -> DataFrame:
    """Every cleaning rule in one projection, duplicates still in."""
    return _cleaned(_named_financials(bronze_financials))


def latest_financials(bronze_financials: DataFrame, tie_break: Sequence[Column] = ()) -> DataFrame:
    """Cleaned financials without duplicates, all columns kept.

    Duplicates go first, on the keys alone, so that only surviving rows are cleaned.
    """
    return _cleaned(latest_per_month(_named_financials(bronze_financials), tie_break))


def silver_financials(bronze_financials: DataFrame, tie_break: Sequence[Column] = ()) -> DataFrame:
    return select_present(latest_financials(bronze_financials, tie_break), K.FINANCIAL_COLUMNS)


# ---- gold -------------------------------------------------------------------------------

def gold_attributes(silver: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Feature table and wide audit table of the attributes."""
    occupation = C.occupation_norm("occupation")
    flags = {"is_occupation_null": X.null_flag(occupation),
             **X.one_hot(occupation, K.OCCUPATIONS, "occ_")}
    wide = silver.withColumns(flags)
    return wide.select(*K.FEATURE_KEYS, *flags), wide


def engineer_financials(silver: DataFrame) -> DataFrame:
    """Silver financials without the delinquency fields, plus all engineered columns.

    No join: the engineered columns sit in the same projection, also where the date is null.
    """
    kept = silver.drop(*K.DELINQUENCY_COLUMNS)
    engineered = {
        **X.ratios(), **X.utilisation(), **X.bucket_pairs(), **X.interactions(), **X.missing_flags(),
        "minpay_flag": X.yes_no("payment_of_min_amount"),
        "pay_behav_coarse": X.behaviour_class("payment_behaviour"),
    }
    rows = kept.withColumns({**engineered, "_types": X.loan_types("type_of_loan")})
    rows = rows.withColumns(X.loan_mix("_types"))
    return rows.select(*kept.columns, *K.FINANCIAL_ENGINEERED)


def gold_financials(silver: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Feature table (without base amounts) and wide audit table of the financials."""
    wide = engineer_financials(silver)
    features = [*K.FEATURE_KEYS, *K.FINANCIAL_PASS_THROUGH, *K.FINANCIAL_ENGINEERED]
    return wide.select(*features), wide


def gold_labels(silver: DataFrame, dpd: int = K.DEFAULT_DPD, mob: int = K.DEFAULT_MOB,
                keep: Sequence[str] = ()) -> DataFrame:
    """Label of every loan that has reached month ``mob``: 1 from ``dpd`` days past due on."""
    rows = filter_mob(silver, mob).withColumns(X.label_columns(dpd, mob))
    return rows.select("loan_id", "Customer_ID", "label", "label_def", "snapshot_date", *keep)


def dated_features(features: DataFrame) -> DataFrame:
    """Features by normalised customer and day (``feat_date``), as the as-of join takes them."""
    rows = rename_customer(features)
    rows = rows.withColumns({"customer_id": C.id_norm("customer_id"), "feat_date": feature_date(rows.columns)})
    return rows.drop("snapshot_date", "snap_ym")


def gold_model_dataset(labels: DataFrame, features: Sequence[DataFrame],
                       tie_breaks: Sequence[Sequence[Column]] | None = None,
                       keep: Sequence[str] = ()) -> DataFrame:
    """Labels with what was known about the customer on the label date."""
    base = rename_customer(labels).select(
        C.id_norm("customer_id").alias("customer_id"), iso_date("snapshot_date").alias("label_date"),
        "loan_id", "label", "label_def", *keep)
    joined = as_of_join(base, [dated_features(f) for f in features], tie_breaks=tie_breaks)
    return joined.withColumnRenamed("label_date", "snapshot_date")


def gold_model_dataset_exact(labels: DataFrame, financials: DataFrame, attributes: DataFrame) -> DataFrame:
    """The older variant: features of exactly the label's customer and date."""
    keys = ["customer_id", "snapshot_date"]
    base = rename_customer(labels).select(*K.MODEL_KEYS)
    return exact_join(base, [rename_customer(financials), rename_customer(attributes).drop("snap_ym")], keys)


def check_model_dataset(df: DataFrame) -> DataFrame:
    return require_columns(df, ["snapshot_date", "label"])
