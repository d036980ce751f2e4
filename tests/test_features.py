"""Loan ageing, labels and feature expressions."""

import datetime as dt

from pyspark.sql import functions as F

from creditmart import constants as K
from creditmart.functions import features as X
from creditmart.plans import layers


def loans(spark, rows):
    raw = spark.createDataFrame(rows, "due_amt string, overdue_amt string, snapshot_date string, installment_num string")
    return layers.silver_loans(raw.withColumns({
        "loan_id": F.lit("l"), "Customer_ID": F.lit("c"), "loan_start_date": F.lit("2023-01-01"),
        "tenure": F.lit("10"), "loan_amt": F.lit("100"), "paid_amt": F.lit(None).cast("string"), "balance": F.lit("1.5")}))


def test_ageing(spark):
    out = loans(spark, [("100", "0", "2023-07-01", "6"), ("100", "150", "2023-07-01", "6"),
                        ("0", "10", "2023-07-01", "6"), ("100", None, "2023-07-01", None)])
    got = [(r["installments_missed"], r["first_missed_date"], r["dpd"]) for r in out.collect()]
    assert got == [(0, None, 0), (2, dt.date(2023, 5, 1), 61), (0, None, None), (0, None, 0)]
    last = out.collect()[3]
    assert (last["mob"], last["paid_amt"], last["overdue_amt"]) == (0, 0.0, 0.0)
    types = dict(out.dtypes)
    assert types["due_amt"] == "float" and types["mob"] == "int" and types["dpd"] == "int"


def test_label_of_unknown_delay_is_zero(spark):
    out = layers.gold_labels(loans(spark, [("0", "10", "2023-07-01", "6"), ("100", "150", "2023-07-01", "6"),
                                           ("100", "150", "2023-07-01", "5")]))
    assert out.columns == ["loan_id", "Customer_ID", "label", "label_def", "snapshot_date"]
    assert [(r["label"], r["label_def"]) for r in out.collect()] == [(0, "30dpd_6mob"), (1, "30dpd_6mob")]


def one(spark, column, value, kind):
    return spark.createDataFrame([(value,)], f"v {kind}").select(column).first()[0]


def test_buckets_with_nulls_and_negatives(spark):
    util = lambda v: one(spark, X.bucket("v", K.UTIL_EDGES, K.UTIL_LABELS), v, "double")
    assert [util(v) for v in (None, -1.0, 9.99, 10.0, 79.0, 80.0)] == [
        "U4:[80,+)", "U0:[0,10)", "U0:[0,10)", "U1:[10,30)", "U3:[50,80)", "U4:[80,+)"]
    hist = lambda v: one(spark, X.bucket("v", K.HISTORY_EDGES, K.HISTORY_LABELS), v, "int")
    assert [hist(v) for v in (None, -1, 11, 12, 119, 120)] == [
        "H4:>=10y", "H0:<1y", "H0:<1y", "H1:1-3y", "H3:5-10y", "H4:>=10y"]
    asked = lambda v: one(spark, X.inquiry_bucket("v", K.INQUIRY_LABELS), v, "int")
    assert [asked(v) for v in (None, 0, -1, 2, 5, 6)] == ["I0:NA", "I1:0", "I2:1-2", "I2:1-2", "I3:3-5", "I4:>5"]


def test_behaviour_order(spark):
    cls = lambda v: one(spark, X.behaviour_class("v"), v, "string")
    assert [cls(v) for v in ("late, regular", "IRREGULAR", "min", "Regular", "on time", "x", None)] == [
        "late", "irregular", "irregular", "regular", "regular", "unknown", "unknown"]


def test_loan_types_keep_untrimmed_names(spark):
    types = lambda v: one(spark, X.loan_types("v"), v, "string")
    assert types("Not Specified, Auto Loan") == [" AUTO LOAN"]
    assert types(None) == [] and types("") == []
    assert types("Auto Loan, and Home Loan") == ["AUTO LOAN", "HOME LOAN"]
    df = spark.createDataFrame([("Credit-Builder Loan, Credit Card, and Auto Loan, Auto Loan",), ("Not Specified, Auto Loan",)], "v string")
    mix = df.select(X.loan_types("v").alias("t")).select(*[c.alias(n) for n, c in X.loan_mix("t").items()]).collect()
    assert (mix[0]["loan_types_count_unique"], mix[0]["has_CC"], mix[0]["has_AUTO"], mix[0]["has_HOME"]) == (3, True, True, False)
    assert (mix[1]["loan_types_count_unique"], mix[1]["has_AUTO"]) == (1, False)


def financials(spark, **values):
    base = {c: None for c in K.FINANCIAL_COLUMNS}
    base.update(customer_id="c1", snapshot_date=dt.date(2023, 7, 1), snap_ym="2023-07", **values)
    kinds = {"snapshot_date": "date", "ingest_dt": "timestamp"}
    numbers = {"num_of_loan", "delay_from_due_date", "num_of_delayed_payment", "num_credit_inquiries", "credit_history_age"}
    texts = {"customer_id", "snap_ym", "source_file", "credit_mix", "payment_of_min_amount", "payment_behaviour", "type_of_loan"}
    schema = ", ".join(f"{c} {kinds.get(c) or ('int' if c in numbers else 'string' if c in texts else 'double')}" for c in base)
    return spark.createDataFrame([tuple(base.values())], schema)


def test_ratios_are_null_on_zero_or_null(spark):
    row = layers.gold_financials(financials(spark, annual_income=0.0, outstanding_debt=5.0, monthly_balance=-4.0,
                                            total_emi_per_month=2.0))[0].first()
    assert row["dti"] is None and row["emi_to_income"] is None and row["emi_to_balance"] == 0.5
    row = layers.gold_financials(financials(spark, annual_income=100.0, outstanding_debt=50.0, num_credit_inquiries=4,
                                            total_emi_per_month=2.0, amount_invested_monthly=5.0,
                                            credit_utilization_ratio=200.0))[0].first()
    assert (row["dti"], row["emi_to_income"], row["invest_to_income"], row["dti_x_inq"]) == (0.5, 0.24, 0.6, 2.0)
    assert (row["util_capped"], row["util_sq"], row["emi_x_util"]) == (150.0, 22500.0, 400.0)


def test_gold_financials_schema_and_flags(spark):
    features, wide = layers.gold_financials(financials(spark, payment_of_min_amount="NM", type_of_loan="Auto Loan"))
    assert len(features.columns) == 41
    assert "delay_from_due_date" not in wide.columns and "annual_income" in wide.columns
    assert "annual_income" not in features.columns
    row = features.first()
    assert (row["is_minpay_null"], row["minpay_flag"], row["is_income_null"], row["has_AUTO"]) == (1, None, 1, True)


def test_wide_keeps_engineered_columns_of_undated_rows(spark):
    """An earlier build joined the wide table by date and lost them; here there is no join."""
    undated = financials(spark, annual_income=10.0, outstanding_debt=5.0).withColumn("snapshot_date", F.lit(None).cast("date"))
    assert layers.gold_financials(undated)[1].first()["dti"] == 0.5


def test_one_hot_is_stable(spark):
    rows = [("ENGINEER",), (None,), ("NULL",), ("ASTRONAUT",)]
    silver = spark.createDataFrame(rows, "occupation string").withColumns({
        "customer_id": F.lit("c"), "snapshot_date": F.lit("2023-01-01").cast("date"), "ingest_dt": F.lit(None),
        "snap_ym": F.lit("2023-01"), "source_file": F.lit("f")}).select(*K.ATTRIBUTE_COLUMNS)
    features, wide = layers.gold_attributes(silver)
    assert len(features.columns) == 3 + 1 + 15 and "occupation" in wide.columns
    got = [(r["is_occupation_null"], r["occ_ENGINEER"], sum(r[f"occ_{w}"] for w in K.OCCUPATIONS)) for r in features.collect()]
    assert got == [(0, 1, 1), (1, 0, 0), (1, 0, 0), (0, 0, 0)]
