"""The mart end to end: raw files to monitoring, idempotence and the mart's invariants."""

import csv
import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from creditmart import constants as K
from creditmart.operators import quality as Q
from creditmart.operators.modeling import Features, fit_boosted, score, search
from creditmart.plans import jobs
from creditmart.sources.readers import read_any, read_labels, read_month, read_scored, text_schema
from creditmart.sources.writers import write_csv, write_preview, write_scores
from creditmart.streaming import ingest
from creditmart.streaming.ingest import ingest_available

MONTHS = [f"2023-{m:02d}-01" for m in range(1, 10)]
CUSTOMERS = [f"CUS_{i:03d}" for i in range(40)]
LOANS = ["loan_id", "Customer_ID", "loan_start_date", "tenure", "installment_num", "loan_amt", "due_amt", "paid_amt",
         "overdue_amt", "balance", "snapshot_date"]
CLICKS = ["Customer_ID", "snapshot_date", "fe_1", "fe_2"]
ATTRIBUTES = ["Customer_ID", "Name", "Age", "SSN", "Occupation", "snapshot_date"]
FINANCIALS = ["Customer_ID", "Annual_Income", "Monthly_Inhand_Salary", "Interst_Rate", "Type_of_Loan", "Delay_from_due_date",
              "Num_of_Delayed_Payment", "Changed_Credit_Limit", "Num_Credit_Inquiries", "Credit_Mix", "Outstanding_Debt",
              "Credit_Utilization_Ratio", "Credit_History_Age", "Payment_of_Min_Amount", "Total_EMI_per_month",
              "Amount_invested_monthly", "Payement_behaviour", "Monthly_Balance", "snapshot_date"]


def rows_of(months):
    """Raw rows; a customer's lateness follows the parity of its number."""
    data = {"lms_loan_daily.csv": [LOANS], "feature_clickstream.csv": [CLICKS], "features_attributes.csv": [ATTRIBUTES],
            "features_financials.csv": [FINANCIALS]}
    for place, month in enumerate(months):
        day = dt.date.fromisoformat(month)
        for i, customer in enumerate(CUSTOMERS):
            late = i % 2 and (i + place) % 5
            data["lms_loan_daily.csv"].append([f"{customer}_L", customer, "2022-12-01", 10, 6 if (i + place) % 2 else 5, 1000, 100,
                                               0 if late else 100, 150 if late else 0, 500, month])
            data["feature_clickstream.csv"].append([customer, month, i + place, "" if i % 7 == 0 else i % 3])
            if place % 3 == 0:
                data["features_attributes.csv"].append([customer, f"N {i}", 30, "x", ["Engineer", "_______", "Writer"][i % 3], month])
                text = f"{day.day}/{day.month}/{day.year}" if i == 0 else month
                data["features_financials.csv"].append([
                    customer, f"{1000 * (i + 1)}.5_", "100.126", "14%" if i % 2 else "0.14_", "Auto Loan,\nand Home Loan", "3", "14_",
                    "_" if i % 5 == 0 else "2.5", "4", "good" if i % 2 else "_", "50.25", str(10 + 60 * (i % 2)),
                    "15 Years and 10 Months", "NM", "10", "__10000__", "!@9#%8", "-20.5", text])
    return data


def write_raw(folder, months, suffix=""):
    folder.mkdir(exist_ok=True)
    for name, rows in rows_of(months).items():
        with open(folder / name.replace(".csv", f"{suffix}.csv"), "w", newline="") as f:
            csv.writer(f).writerows(rows)
    return str(folder)


@pytest.fixture(scope="module")
def mart(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("mart")
    raw = write_raw(base / "raw", MONTHS)
    log = jobs.build_mart(spark, str(base / "tables"), raw, "2024-01-01")
    return jobs.Mart(spark, str(base / "tables")), raw, log


def snapshot(mart, table):
    df = mart.all_months(table)
    return sorted(map(repr, df.select(*sorted(df.columns)).collect()))


def test_log_counts_rows_on_the_way(mart):
    table, _, log = mart
    by_path = {entry["path"].split("/tables/")[1]: entry["rows"] for entry in log}
    assert by_path["bronze/loan_daily"] == len(MONTHS) * 40 and by_path["silver/clickstream"] == len(MONTHS) * 40
    assert by_path["gold/label_store"] == by_path["gold/model_dataset"] == len(MONTHS) * 20
    for path, rows in by_path.items():
        assert table.all_months(path).count() == rows


def test_bronze_has_lineage_and_months(mart):
    df = mart[0].all_months("bronze/financials")
    row = df.where("Customer_ID = 'CUS_000' and snap_ym = '2023-04'").first()
    assert (row["ingest_dt"], row["source_file"], row["snapshot_date"]) == (dt.date(2024, 1, 1), "features_financials.csv", "1/4/2023")
    assert row["Type_of_Loan"] == "Auto Loan,\nand Home Loan"


def test_silver_values(mart):
    row = mart[0].all_months("silver/financials").where("customer_id = 'CUS_001' and snap_ym = '2023-01'").first()
    assert (row["annual_income"], row["interest_rate"], row["num_of_loan"], row["credit_history_age"]) == (2000.5, 14.0, 2, 190)
    assert (row["num_of_delayed_payment"], row["payment_behaviour"], row["amount_invested_monthly"]) == (14, None, None)
    loans = mart[0].all_months("silver/loan_daily")
    assert loans.where("dpd > 0").first()["installments_missed"] == 2


def test_invariants(mart):
    table = mart[0]
    fin = table.all_months("silver/financials").withColumn("ds_token", F.col("snap_ym"))
    got = {(r["check"], r["column_name"]): r["value"] for r in Q.financials_suite(fin).where("month is null").collect()}
    for check in (("duplicate_groups", None), ("out_of_range_rows", "interest_rate"), ("out_of_range_rows", "credit_history_age"),
                  ("junk_token_rows", "payment_behaviour"), ("loan_count_mismatch_rows", "num_of_loan"),
                  *[("not_two_decimals_share", c) for c in K.TWO_DP_COLUMNS]):
        assert got[check] == 0, check
    labels = {r["check"]: r["value"] for r in Q.label_store_suite(table.all_months("gold/label_store")).where("month is null").collect()}
    assert labels["duplicate_labels"] == 0 and labels["non_binary_rows"] == 0
    _, per_month = jobs.check_mart(table)
    want = {r["snapshot_date"]: r["count"] for r in table.all_months("gold/label_store").groupBy("snapshot_date").count().collect()}
    assert {r["snapshot_date"]: r["n_rows"] for r in per_month.collect()} == want


def test_as_of_uses_the_latest_known_row(mart):
    md = mart[0].all_months("gold/model_dataset")
    assert md.where("dti is null").count() == 0
    # Attributes of January apply in February, where there is no row of that month.
    feb = md.where("snapshot_date = '2023-02-01' and is_occupation_null is null")
    assert feb.count() == 0
    assert len(md.columns) == 5 + 38 + 16 + 1


def test_rerun_gives_the_same_tables(mart):
    table, raw, _ = mart
    names = ["silver/financials", "silver/loan_daily", "gold/financials_wide", "gold/label_store", "gold/model_dataset"]
    before = {n: snapshot(table, n) for n in names}
    jobs.build_mart(table.spark, table.root, raw, "2024-01-01", months=["2023-04", "2023-05"])
    for n in names:
        assert snapshot(table, n) == before[n], n


def test_month_reads_touch_one_partition(mart):
    table = mart[0]
    df = read_month(table.spark, table.path("silver/loan_daily"), "2023-03")
    assert df.count() == 40 and len(df.inputFiles()) >= 1
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(snap_ym" in plan


def test_exact_variant_and_label_store_job(mart, tmp_path):
    table, raw, _ = mart
    log = jobs.build_label_store(table.spark, str(tmp_path / "t"), raw, "2024-01-01", dpd=30, mob=5)
    assert log[-1]["rows"] == len(MONTHS) * 20
    out = jobs.layers.gold_model_dataset_exact(
        table.all_months("gold/label_store"), table.all_months("gold/financials_features"), table.all_months("gold/attributes_features"))
    assert out.count() == len(MONTHS) * 20 and out.where("dti is not null").count() == 59


def test_customer_clickstream(mart):
    table = mart[0]
    jobs.build_customer_clickstream(table)
    df = table.all_months("silver/customer_clickstream")
    assert df.count() == 40 and df.first()["n_rows"] == len(MONTHS)
    assert table.spark.read.option("header", True).csv(table.path("silver/customer_clickstream_preview")).count() == 40


DATES = {"Train": ("2023-01-01", "2023-04-30"), "Valid": ("2023-05-01", "2023-06-30"), "Test": ("2023-07-01", "2023-08-31"),
         "OOT": ("2023-09-01", "2023-12-31")}


def test_train_score_monitor(mart, tmp_path):
    table = mart[0]
    md = table.all_months("gold/model_dataset").withColumn("label", F.col("label").cast("int"))
    comparison = jobs.train_models(md, str(tmp_path), DATES, max_trees=4)
    rows = {r["model"]: r for r in comparison.collect()}
    assert set(rows) == {"lr", "xgb"} and all(r["roc_auc_valid"] > 0.7 for r in rows.values())
    grid = table.spark.read.parquet(f"{tmp_path}/metrics/parquet")
    assert grid.count() == 16

    for ts, month in (("2024-01-01 10:00:00", "2023-07-01"), ("2024-02-01 10:00:00", "2023-08-01")):
        batch = md.where(F.col("snapshot_date") == month).drop("label")
        # Threshold and columns come from the cards; the batch lacks a column.
        log = jobs.score_batch(batch.drop("dti"), f"{tmp_path}/models", ts, f"{tmp_path}/scored",
                               keep=["loan_id", "customer_id", "snapshot_date"])
        assert log["rows"] == 20
    tuned = {r["model"]: r["threshold"] for r in grid.where("split = 'Valid_tuned'").collect()}
    for name in ("lr", "xgb"):
        threshold, columns = jobs.read_card(table.spark, f"{tmp_path}/models/{name}")
        assert threshold == tuned[name] and "dti" in columns
        for r in table.spark.read.parquet(f"{tmp_path}/scored").collect():
            assert r[f"pred_{name}"] == int(r[f"proba_{name}"] >= threshold)
    with pytest.raises(ValueError):
        jobs.monitor(table.spark, f"{tmp_path}/scored", None, f"{tmp_path}/trend", min_points=3)
    trend = jobs.monitor(table.spark, f"{tmp_path}/scored", table.path("gold/label_store"), f"{tmp_path}/trend").orderBy("batch_ts")
    got = trend.collect()
    assert [r["batch_month"] for r in got] == ["2024-01", "2024-02"]
    # In the second batch nobody is late: one class, no AUC.
    assert 0 <= got[0]["auc_lr"] <= 1 and got[1]["auc_lr"] is None and got[1]["mean_proba_xgb"] is not None


def test_monitor_state_reads_new_batches_only(spark, tmp_path):
    draw = random.Random(4)
    rows = [(f"l{i}", f"c{i}", draw.random(), i % 2, round(draw.random(), 1), i % 3 % 2) for i in range(90)]
    frame = spark.createDataFrame(rows, "loan_id string, customer_id string, proba_lr double, pred_lr int, proba_xgb double, pred_xgb int")
    labels = spark.createDataFrame([(f"l{i}", int(draw.random() < 0.4)) for i in range(90)], "loan_id string, label int")
    scored, state = f"{tmp_path}/scored", f"{tmp_path}/state"
    labels.write.parquet(f"{tmp_path}/labels")
    days = [f"2025-0{m}-01 00:00:00" for m in (1, 2, 3)]
    for at, day in enumerate(days[:2]):
        write_scores(frame.where(F.col("loan_id") != f"l{at}"), scored, day)

    def same_as_a_full_run():
        full = jobs.monitor(spark, scored, f"{tmp_path}/labels", f"{tmp_path}/full")
        kept = jobs.monitor(spark, scored, f"{tmp_path}/labels", f"{tmp_path}/kept", state=state)
        assert kept.columns == full.columns
        for a, b in zip(kept.orderBy("batch_ts").collect(), full.orderBy("batch_ts").collect(), strict=True):
            assert a["auc_lr"] is not None and all(x == pytest.approx(y, abs=1e-12) if isinstance(x, float) else x == y for x, y in zip(a, b))

    same_as_a_full_run()
    assert jobs.update_metric_state(spark, scored, f"{tmp_path}/labels", state) == []
    write_scores(frame.where("proba_lr < 0.7"), scored, days[2])
    assert [str(t) for t in jobs.update_metric_state(spark, scored, f"{tmp_path}/labels", state)] == days[2:]
    same_as_a_full_run()
    # A batch scored again, and one asked for because labels came late.
    write_scores(frame.where("proba_lr > 0.2"), scored, days[0])
    assert [str(t) for t in jobs.update_metric_state(spark, scored, f"{tmp_path}/labels", state, again=[days[1]])] == days[:2]
    same_as_a_full_run()
    with pytest.raises(ValueError):
        jobs.monitor(spark, scored, None, f"{tmp_path}/trend", min_points=4, state=state)


def test_unseen_category_scores(mart):
    md = mart[0].all_months("gold/model_dataset").select("label", "dti", "credit_mix", "has_AUTO", "snapshot_date")
    parts = [md.where("snapshot_date < '2023-05-01'"), md.where("snapshot_date >= '2023-05-01'")]
    model = fit_boosted(*parts, Features.of(md), max_trees=2)
    odd = md.withColumns({"credit_mix": F.lit("Never seen"), "dti": F.lit(None).cast("double")})
    assert score(odd, {"xgb": (model, 0.5)}, ["label"]).where("proba_xgb is null").count() == 0


def test_clickstream_model(mart, tmp_path):
    table = mart[0]
    labels = table.all_months("gold/label_store").drop("snap_ym")
    clicks = table.all_months("silver/clickstream").withColumnRenamed("customer_id", "Customer_ID")
    card = jobs.train_clickstream_model(labels, clicks, "2023-10-01", str(tmp_path), draws=1, folds=2, months=6)
    rows = {r["part"]: r for r in card.collect()}
    assert set(rows) == {"train", "test", "oot"} and rows["oot"]["n_rows"] == 40
    assert all(r["gini"] == pytest.approx(2 * r["roc_auc"] - 1, abs=1e-3) for r in rows.values())
    log = jobs.predict_months(clicks, f"{tmp_path}/models/clickstream", "m1", f"{tmp_path}/pred", "2023-02-01", "2023-03-01")
    assert log["rows"] == 80
    got = table.spark.read.parquet(f"{tmp_path}/pred")
    assert got.columns[:2] == ["Customer_ID", "model_predictions"] and got.select("snapshot_date").distinct().count() == 2


def test_search_with_hard_scoring(mart):
    df = mart[0].all_months("gold/model_dataset").select("label", "util_capped", "dti")
    _, tuned = search(df, ["util_capped", "dti"], draws=2, folds=2, scoring="hard", space={"maxIter": (1, 2), "maxDepth": (2,)})
    assert len(tuned.avgMetrics) == 2 and all(0 <= m <= 1 for m in tuned.avgMetrics)


def test_scored_files_by_name_and_time(spark, tmp_path):
    df = spark.createDataFrame([("l1", 0.5, 1)], "loan_id string, proba_lr double, pred_lr int")
    df.write.parquet(f"{tmp_path}/a/score_20250101_120000.parquet")
    df.write.parquet(f"{tmp_path}/b/other.parquet")
    named = read_scored(spark, f"{tmp_path}/a/*").first()["batch_ts"]
    assert named == dt.datetime(2025, 1, 1, 12)
    assert read_scored(spark, f"{tmp_path}/b/*").first()["batch_ts"].year >= 2024
    write_scores(df, f"{tmp_path}/t", "2025-02-01 00:00:00")
    write_scores(df, f"{tmp_path}/t", "2025-02-01 00:00:00")
    assert read_scored(spark, f"{tmp_path}/t").count() == 1


def test_readers_and_previews(spark, tmp_path):
    df = spark.createDataFrame([("c", "2023-01-01", "1", 5), ("d", "x", "y", 9)], "Customer_ID string, snapshot_date string, label string, n_rows int")
    df.write.parquet(f"{tmp_path}/labels")
    rows = {r["customer_id"]: (r["snapshot_date"], r["label"]) for r in read_labels(spark, f"{tmp_path}/labels").collect()}
    assert rows == {"c": (dt.date(2023, 1, 1), 1), "d": (None, None)}
    write_csv(df, f"{tmp_path}/t.csv")
    assert read_any(spark, f"{tmp_path}/t.csv").count() == read_any(spark, f"{tmp_path}/labels").count() == 2
    write_preview(df, f"{tmp_path}/p", rows=1)
    assert spark.read.option("header", True).csv(f"{tmp_path}/p").first()["Customer_ID"] == "d"


def test_incremental_ingestion_equals_one_build(mart, spark, tmp_path):
    table = mart[0]
    raw = tmp_path / "raw"
    schemas = {"loan_daily": text_schema(LOANS), "clickstream": text_schema(CLICKS), "attributes": text_schema(ATTRIBUTES),
               "financials": text_schema(FINANCIALS)}
    root, state = str(tmp_path / "tables"), str(tmp_path / "state")
    half = rows_of(MONTHS)
    raw.mkdir()
    for part, keep in (("_1", lambda m: m < "2023-05"), ("_2", lambda m: m >= "2023-05")):
        for name, rows in half.items():
            with open(raw / name.replace(".csv", f"{part}.csv"), "w", newline="") as f:
                place = rows[0].index("snapshot_date")
                def month(row):
                    text = row[place]
                    return text[:7] if "-" in text else f"{text.split('/')[2]}-{int(text.split('/')[1]):02d}"
                csv.writer(f).writerows([rows[0], *[r for r in rows[1:] if keep(month(r))]])
        run = "2024-01-01" if part == "_1" else "2024-01-02"
        ingest_available(spark, root, str(raw), schemas, state, run)
    assert ingest_available(spark, root, str(raw), schemas, state, "2024-01-03") == []
    streamed = jobs.Mart(spark, root)
    for name in ("gold/label_store", "gold/model_dataset", "gold/financials_features"):
        assert snapshot(streamed, name) == snapshot(table, name), name


def test_late_features_change_only_the_labels_they_reach(spark, tmp_path):
    """Features of three customers arrive late for February and May: joined anew until the next known day, equal to one full build."""
    raw = tmp_path / "raw"
    write_raw(raw, MONTHS, "_1")
    schemas = {"loan_daily": text_schema(LOANS), "clickstream": text_schema(CLICKS), "attributes": text_schema(ATTRIBUTES),
               "financials": text_schema(FINANCIALS)}
    root = str(tmp_path / "tables")
    ingest_available(spark, root, str(raw), schemas, str(tmp_path / "state"), "2024-01-01")
    before = {r["snap_ym"]: r["n"] for r in jobs.Mart(spark, root).all_months("gold/model_dataset").groupBy("snap_ym").agg(F.count("*").alias("n")).collect()}
    line = lambda i, month: [CUSTOMERS[i], "777.5", "1.1", "14%", "Auto Loan", "3", "14_", "2.5", "4", "good", "50.25", "10", "15 Years and 10 Months",
                             "NM", "10", "5", "x", "9", month]
    late = {"features_financials_2.csv": [FINANCIALS, line(1, "2023-02-01"), line(2, "2023-02-01"), line(3, "2023-05-01")],
            "features_attributes_2.csv": [ATTRIBUTES, [CUSTOMERS[1], "N", 30, "x", "Lawyer", "2023-02-01"]]}
    for name, rows in late.items():
        with open(raw / name, "w", newline="") as f:
            csv.writer(f).writerows(rows)
    log = ingest_available(spark, root, str(raw), schemas, str(tmp_path / "state"), "2024-01-02")
    # Next known days are April and July. Of the later months that were not rebuilt anyway, customer 1 has a label in March,
    # customer 2 none, and customer 3 none in June: one row is joined anew, and March is written.
    (delta,) = [e for e in log if "joined" in e]
    assert delta["joined"] == 1 and delta["rows"] == before["2023-03"]
    again = str(tmp_path / "again")
    ingest_available(spark, again, str(raw), schemas, str(tmp_path / "state2"), "2024-01-02")
    drop = lambda root: sorted(map(repr, (lambda d: d.select(*sorted(d.columns)).collect())(jobs.Mart(spark, root).all_months("gold/model_dataset"))))
    assert drop(root) == drop(again)
    assert ingest_available(spark, root, str(raw), schemas, str(tmp_path / "state"), "2024-01-03") == []


LAYERS = ["bronze/loan_daily", "bronze/clickstream", "silver/loan_daily", "silver/clickstream", "gold/label_store", "gold/model_dataset"]


@pytest.mark.parametrize("named", [["2023-02"], []])
def test_an_emptied_month_is_empty_in_every_layer(spark, tmp_path, named):
    months = ["2023-01-01", "2023-02-01", "2023-03-01"]
    root = str(tmp_path / "tables")
    jobs.build_mart(spark, root, write_raw(tmp_path / "raw", months), "2024-01-01")
    fewer = write_raw(tmp_path / "fewer", [months[0], months[2]])
    log = jobs.build_mart(spark, root, fewer, "2024-01-01", months=named)
    mart = jobs.Mart(spark, root)
    for name in LAYERS:
        left = {r["snap_ym"] for r in mart.all_months(name).select(F.col("snap_ym").cast("string").alias("snap_ym")).distinct().collect()}
        assert left == {"2023-01", "2023-03"}, name
    if named:
        assert all(entry["rows"] == 0 for entry in log)
    else:
        assert {e["path"].split("/tables/")[1]: e["rows"] for e in log}["silver/clickstream"] == 80


def test_a_run_that_ends_after_bronze_is_made_up_for(spark, tmp_path, monkeypatch):
    raw = write_raw(tmp_path / "raw", MONTHS[:2])
    schemas = {"loan_daily": text_schema(LOANS), "clickstream": text_schema(CLICKS), "attributes": text_schema(ATTRIBUTES),
               "financials": text_schema(FINANCIALS)}
    root, state = str(tmp_path / "tables"), str(tmp_path / "state")

    def lost(*_):
        raise RuntimeError("lost")
    with monkeypatch.context() as patch:
        patch.setattr(ingest, "build_silver", lost)
        with pytest.raises(RuntimeError):
            ingest_available(spark, root, raw, schemas, state, "2024-01-01")
    log = ingest_available(spark, root, raw, schemas, state, "2024-01-02")
    assert {e["path"].split("/tables/")[1]: e["rows"] for e in log}["silver/loan_daily"] == 80
    assert ingest_available(spark, root, raw, schemas, state, "2024-01-03") == []


def test_first_source_name_counts_and_a_missing_source_is_skipped(spark, tmp_path):
    raw = tmp_path / "raw"
    write_raw(raw, MONTHS[:1])
    (raw / "feature_financials.csv").write_text((raw / "features_financials.csv").read_text())
    (raw / "lms_loan_daily.csv.bak").write_text((raw / "lms_loan_daily.csv").read_text())
    (raw / "feature_clickstream.csv").unlink()
    log = jobs.build_mart(spark, str(tmp_path / "t"), str(raw), "2024-01-01")
    by_path = {e["path"].split("/t/")[1]: e for e in log}
    assert by_path["bronze/clickstream"]["skipped"] and "silver/clickstream" not in by_path
    assert by_path["bronze/financials"]["rows"] == by_path["bronze/loan_daily"]["rows"] == 40


def test_mixed_formats_are_read_together(spark, tmp_path):
    both = spark.createDataFrame([("a", "2023-01-01", 1)], "Customer_ID string, snapshot_date string, label int")
    both.write.parquet(f"{tmp_path}/labels")
    (tmp_path / "labels/more.csv").write_text("Customer_ID,snapshot_date,label\nb,2023-02-01,0\nc,junk,\n")
    got = {r["customer_id"]: (r["snapshot_date"], r["label"]) for r in read_labels(spark, f"{tmp_path}/labels").collect()}
    assert got == {"a": (dt.date(2023, 1, 1), 1), "b": (dt.date(2023, 2, 1), 0), "c": (None, None)}
    scored = spark.createDataFrame([("a", 0.25, 0)], "customer_id string, proba_lr double, pred_lr int")
    scored.write.parquet(f"{tmp_path}/scored/score_20250101_120000.parquet")
    (tmp_path / "scored/score_20250201_120000.csv").write_text("customer_id,proba_lr,pred_lr\nb,1,1\n")
    rows = {r["customer_id"]: (r["batch_ts"].month, r["proba_lr"]) for r in read_scored(spark, f"{tmp_path}/scored/*").collect()}
    assert rows == {"a": (1, 0.25), "b": (2, 1.0)}
    (tmp_path / "t.txt").write_text("x\n1\n")
    assert read_any(spark, f"{tmp_path}/t.txt").first()["x"] == 1


def test_boosting_waits_for_a_late_gain(spark):
    """The number of trees is the best before 50 without a gain, not the first small step."""
    import numpy as np

    from pyspark.ml.linalg import Vectors

    from creditmart.operators import modeling as L
    draw = np.random.default_rng(3)
    x = draw.normal(size=(1200, 3))
    y = (x[:, 0] * x[:, 1] + draw.normal(size=1200) > 0).astype(float)
    rows = spark.createDataFrame([(Vectors.dense(a), float(b)) for a, b in zip(x, y)], ["features", "label"]).repartition(1)
    parts = rows.limit(800), rows.subtract(rows.limit(800))
    trees = L.best_trees(*parts, max_trees=24, patience=4, first=8)
    losses = L._boosting(maxIter=24, **K.BOOSTING).fit(parts[0]).evaluateEachIteration(parts[1])
    best = since = 0
    for i, loss in enumerate(losses):
        best = i if loss < losses[best] else best
        if i - best >= 4:
            break
    assert trees == best + 1


def test_rolling_training_compares_runs(mart, tmp_path):
    md = mart[0].all_months("gold/model_dataset").withColumn("label", F.col("label").cast("int"))
    rows = jobs.train_rolling(md, str(tmp_path), "2023-07-01", "2023-08-01", models=("lr",)).collect()
    assert sorted((str(r["run_month"]), r["model"]) for r in rows) == [("2023-07-01", "lr"), ("2023-08-01", "lr")]


def test_a_write_of_one_month_lists_that_month_only(spark, tmp_path):
    from creditmart.sources import writers

    df = spark.createDataFrame([("2023-01", 1), ("2023-02", 2), ("2023-02", 3), ("a=b/c", 4)], "snap_ym string, v int")
    path = str(tmp_path / "t")
    assert writers.write_months(df, path)["rows"] == 4
    seen = []
    real = writers._table_files
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(writers, "_table_files", lambda *a: seen.append(real(*a)) or seen[-1])
        log = writers.write_months(df.where("v = 2"), path, months=["2023-02"])
        assert log["rows"] == 1 and all(len(folders) == 1 and next(iter(folders)).endswith("2023-02") for folders in seen)
        assert writers.write_months(df.where("v = 4"), path, months=["a=b/c"])["rows"] == 1
        assert writers.write_months(df.where("v = 9"), path, months=["2023-02", "2030-01"])["rows"] == 0
    assert sorted(r["v"] for r in spark.read.parquet(path).collect()) == [1, 4]


def test_a_written_table_leaves_no_shuffle_files(spark, tmp_path):
    """A run of many writes holds the tables and one write's shuffle, not those of all writes before."""
    from creditmart.sources import writers as W

    def shuffled():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}
    before, setting = shuffled(), spark.conf.get(W.CLEAN_UP)
    rows = spark.range(1000).selectExpr("id % 200 as k", "cast(id % 3 as string) as snap_ym").groupBy("k", "snap_ym").count()
    with W.shuffles_dropped(spark):
        rows.write.parquet(f"{tmp_path}/plain")
    assert shuffled() <= before
    assert W.write_months(rows, f"{tmp_path}/t")["rows"] == 600 == rows.count()
    assert spark.conf.get(W.CLEAN_UP) == setting
    with pytest.raises(ZeroDivisionError):
        with W.shuffles_dropped(spark):
            1 / 0
    assert spark.conf.get(W.CLEAN_UP) == setting
