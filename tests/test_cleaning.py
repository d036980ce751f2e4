"""Cleaning expressions on the values that are easy to get wrong."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from creditmart.functions import cleaning as C
from creditmart.functions.dates import any_date, feature_date, month_key, month_list, month_text, months_back
from creditmart.operators import projection as J
from creditmart.plans import layers


def apply(spark, rule, values):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "i int, v string")
    return [r[0] for r in df.orderBy("i").select(rule("v")).collect()]


CASES = {
    "money": (C.money, {"52312.68_": 52312.68, "$3,500": 3500.0, "_": None, "1,20,000.0": 120000.0,
                        "₹1,20,000.0": 120000.0, "-5.555": -5.56, None: None, "1-2": None}),
    "two_decimals": (C.two_decimals, {"1234.567": 1234.57, "__10000__": None, "": None}),
    "digits": (C.digits_int, {"14_": 14, "-1": 1, "14.5": 145, "": None, None: None, "99999999999": None}),
    "int": (C.to_int, {"3": 3, "3.0": 3, "-1": -1, "-1.9": -1, "x": None, "1e3": None, "99999999999": None,
                       " 7 ": 7}),
    "interest": (C.interest_percent, {"14%": 14.0, "14": 14.0, "0.14_": 14.0, "1,060": 10.6, "5059": 50.59,
                                      "1": 100.0, "100": 100.0, "20000": 20000.0, "-0.5": -50.0, "x": None,
                                      "10000": 100.0}),
    "history": (C.history_months, {"15 Years and 10 Months": 190, "3 Months": 3, "1 Year": 12, "junk": 0, None: None}),
    "loans": (C.loan_count, {"Auto Loan, and Home Loan": 2, "": 0, None: 0, "NULL": 0, " null ": 0, "Auto Loan": 1}),
    "mix": (C.category_title, {"good": "Good", "GOOD": "Good", "_": None, "NULL": None, "N/A": None, "na": None,
                               "": None, None: None}),
    "behaviour": (C.behaviour_text, {"!@9#%8": None, "NA": None, "Late x": "Late x", None: None}),
    "occupation": (C.occupation_text, {"Engineer": "ENGINEER", " media_manager ": "MEDIA_MANAGER", "_______": None,
                                       "NULL": "NULL", "": ""}),
    "occupation_norm": (C.occupation_norm, {"NULL": None, "": None, " teacher": "TEACHER", None: None}),
    "id_key": (C.id_key, {" cus_0x1 ": "CUS_0X1", "cus\t0-x​1": "CUS0X1"}),
}


@pytest.mark.parametrize("name", CASES)
def test_rule(spark, name):
    rule, cases = CASES[name]
    assert apply(spark, rule, list(cases)) == list(cases.values())


def test_dates_are_day_first(spark):
    cases = {
        "3/4/2023": dt.date(2023, 4, 3), "1/7/23": dt.date(2023, 7, 1), "13/7/2023": dt.date(2023, 7, 13),
        "7/13/2023": dt.date(2023, 7, 13), "2023-07-01": dt.date(2023, 7, 1), "03/04/23": dt.date(2023, 4, 3),
        "2023-07-01 00:00:00": dt.date(2023, 7, 1), "junk": None, None: None,
    }
    assert apply(spark, any_date, list(cases)) == list(cases.values())


def test_dates_of_any_shape_read_as_if_every_format_was_tried(spark):
    from creditmart import constants as K
    from creditmart.functions.dates import date_shape
    assert [date_shape(form) for form in ("d/M/yy", "dd/MM/yyyy", "yyyy-MM-dd")] == ["_%/_%/__", "__/__/____%", "____%-__-__"]
    texts = ["3/4/2023", "1/7/23", "13/7/2023", "7/13/2023", "31/2/2023", "1/1/02023", "+1/1/23", "1/1/-23", "1/7/3", "1/7/123", " 1/7/23",
             "1/7/23 ", "2023-07-01", " 2023-07-01 ", "2023-7-1", "2023-07", "2023", "+12345-01-02", "12345-01-02", "0000-01-01",
             "-0001-01-01", "2023-02-30", "2023-01-01 1/7/23", "2023-01-01T1/7/23", "1-7-23", "//", "/", "", "junk", "1/7/23/4", None]

    def tried(c):
        text = F.col(c)
        return F.coalesce(*[F.try_to_date(text, form) for form in K.DATE_FORMATS], text.try_cast("date")).cast("string")
    assert apply(spark, lambda c: any_date(c).cast("string"), texts) == apply(spark, tried, texts)


def test_month_text_takes_month_or_timestamp(spark):
    assert apply(spark, month_text, ["2023-01", "2023-02-01 00:00:00", "2023-03-05", "x"]) == [
        "2023-01", "2023-02", "2023-03", None]


def test_month_and_feature_date_fall_back_to_month(spark):
    df = spark.createDataFrame([("2023-05-01", "2023-01"), (None, "2023-02"), ("5/1/2023", "2023-03")],
                               "snapshot_date string, snap_ym string")
    rows = df.select(month_key(df.columns), feature_date(df.columns)).collect()
    assert [tuple(r) for r in rows] == [
        ("2023-05", dt.date(2023, 5, 1)), ("2023-02", dt.date(2023, 2, 1)), ("2023-03", dt.date(2023, 3, 1))]


def test_month_list_starts_with_the_first_month(spark):
    got = [r[0] for r in month_list(spark, "2023-11-15", "2024-02-10").orderBy("month").collect()]
    assert got == [dt.date(2023, 11, 1), dt.date(2023, 12, 1), dt.date(2024, 1, 1), dt.date(2024, 2, 1)]


def test_months_back_modes_differ_where_thirty_days_miss_a_month(spark):
    day = F.lit("2024-03-01").cast("date")
    row = spark.range(1).select(months_back(day, 1, "days"), months_back(day, 2, "days"),
                                months_back(day, 1), months_back(day, 2)).first()
    assert list(row) == [dt.date(2024, 1, 1), dt.date(2024, 1, 1), dt.date(2024, 2, 1), dt.date(2024, 1, 1)]
    with pytest.raises(ValueError):
        months_back(day, 1, "weeks")


def test_projections(spark):
    df = spark.createDataFrame([(" a ", "1", "x")], ["Customer ID", "interst_rate", "fe_1"])
    snake = J.rename_absent(J.snake_case(df), {"interst_rate": "interest_rate"})
    assert snake.columns == ["customer_id", "interest_rate", "fe_1"]
    assert J.trim_strings(snake).first()["customer_id"] == "a"
    assert J.select_present(snake, ["fe_1", "no", "customer_id"]).columns == ["fe_1", "customer_id"]
    full = J.ensure_columns(snake, {"score": "double", "fe_1": "string"})
    assert full.dtypes == [("score", "double"), ("fe_1", "string")] and full.first()["score"] is None
    assert J.prefixed(spark.createDataFrame([(1, 2)], ["FE_a", "fe_b"]), "fe_") == ["fe_b"]
    assert J.prefixed(spark.createDataFrame([(1, 2)], ["FE_a", "fe_b"]), "fe_", any_case=True) == ["FE_a", "fe_b"]
    with pytest.raises(ValueError):
        J.row_month(snake)
    with pytest.raises(ValueError):
        J.require_columns(snake, ["label"])


def test_month_filter_accepts_both_columns(spark):
    dates = spark.createDataFrame([("3/7/2023",), ("2023-07-31",), ("1/8/23",)], "snapshot_date string")
    assert J.filter_month(dates, "2023-07").count() == 2
    months = spark.createDataFrame([("2023-07",), ("2023-07-01 00:00:00",), ("2023-08",)], "snap_ym string")
    assert J.filter_month(months, "2023-07").count() == 2


def test_silver_financials_columns_and_order(spark):
    raw = spark.createDataFrame(
        [(" c1 ", "2023-07-01", "2023-08-01", "2023-07", "f.csv", "$1,000.555", "0.14_", "yes", "-3.0"),
         ("c1", "2023-07-01", "2023-08-02", "2023-07", "f.csv", "2000", "5059", "NM", "x")],
        "Customer_ID string, snapshot_date string, ingest_dt string, snap_ym string, source_file string, "
        "Annual_Income string, Interst_Rate string, Payment_of_Min_Amount string, Delay_from_due_date string")
    out = layers.silver_financials(raw)
    assert out.columns == ["customer_id", "snapshot_date", "ingest_dt", "snap_ym", "source_file", "annual_income",
                           "interest_rate", "delay_from_due_date", "payment_of_min_amount"]
    rows = out.collect()
    assert len(rows) == 1 and rows[0]["annual_income"] == 2000.0 and rows[0]["interest_rate"] == 50.59
    assert rows[0]["delay_from_due_date"] is None and rows[0]["ingest_dt"] == dt.datetime(2023, 8, 2)
