"""As-of join, duplicate removal and key checks."""

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from creditmart.operators import keys as Y
from creditmart.operators.asof import as_of_dates, as_of_join
from creditmart.operators.dedupe import keep_latest
from creditmart.plans import layers
from creditmart.plans.star import star_input


def d(text):
    return dt.date.fromisoformat(text)


def test_as_of_cases(spark):
    labels = spark.createDataFrame(
        [("l1", " a ", 1, "d", d("2023-03-01")), ("l2", "A", 0, "d", d("2023-04-01")), ("l3", "a", 0, "d", d("2022-12-01")),
         ("l4", "A", 1, "d", d("2023-03-01")), ("l5", "nobody", 0, "d", d("2023-03-01")), ("l6", "b", 0, "d", d("2023-02-15"))],
        "loan_id string, Customer_ID string, label int, label_def string, snapshot_date date")
    fin = spark.createDataFrame(
        [("a", d("2023-01-01"), "2023-01", 1, None), ("a", d("2023-04-01"), "2023-04", 2, "x"), ("b", None, "2023-02", 3, "y"),
         ("b", None, "2023-03", 4, "z")],
        "customer_id string, snapshot_date date, snap_ym string, dti int, note string")
    att = spark.createDataFrame([("A", d("2023-03-01"), "2023-03", 7)], "customer_id string, snapshot_date date, snap_ym string, occ int")
    out = layers.gold_model_dataset(labels, [fin, att])
    assert out.columns == ["customer_id", "snapshot_date", "loan_id", "label", "label_def", "dti", "note", "occ"]
    got = {r["loan_id"]: (r["customer_id"], r["dti"], r["note"], r["occ"]) for r in out.collect()}
    # The January row holds a null note: it is still the newest row and must not be skipped.
    assert got == {"l1": ("A", 1, None, 7), "l2": ("A", 2, "x", 7), "l3": ("A", None, None, None), "l4": ("A", 1, None, 7),
                   "l5": ("NOBODY", None, None, None), "l6": ("B", 3, "y", None)}


def test_as_of_dates_are_shuffled_once_for_all_histories(spark):
    rows = spark.range(200).selectExpr("concat('c', id % 9) as customer_id", "date_add(date '2023-01-01', cast(id as int)) as at", "id")
    base = rows.selectExpr("customer_id", "at as label_date", "id as loan_id")
    histories = [rows.where(f"id % {n} = 0").selectExpr("customer_id", "at as feat_date", f"id as v{n}") for n in (3, 5)]
    out = as_of_join(base, histories)
    assert out.count() == 200
    for n in (3, 5):
        known = out.where(f"v{n} is not null").select("customer_id", "loan_id", f"v{n}").collect()
        assert known and all(r[2] % n == 0 and r[2] <= r[1] and (r[1] - r[2]) % 9 == 0 and r[1] - r[2] < 9 * n for r in known)
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString().partition("Initial Plan")[0]
    assert plan.count("ReusedExchange") >= 2


def test_one_table_is_dealt_to_tasks_before_an_input_is_derived(spark, tmp_path):
    rows = spark.range(4_000).selectExpr(
        "id as o_orderkey", "id % 97 as o_custkey", "timestamp '1996-01-01' as o_orderdate", "id * 1.25d as o_totalprice")
    rows.coalesce(1).write.parquet(str(tmp_path / "orders.parquet"))
    merge = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(merge, "false")  # so few rows would be merged into one task again
    try:
        spread = star_input(spark, str(tmp_path), "financials", spread=True).withColumn("_task", F.spark_partition_id()).collect()
    finally:
        spark.conf.set(merge, "true")
    plain = star_input(spark, str(tmp_path), "financials").collect()
    assert len({r["_task"] for r in spread}) > 1
    assert sorted(map(str, (r[:-1] for r in spread))) == sorted(map(str, (r[:] for r in plain)))


def test_as_of_equals_ranked_form(spark, small):
    """The linear form against a full join that ranks every earlier feature row."""
    base = star_input(spark, small, "loan_daily").select(
        F.lower("Customer_ID").alias("customer_id"), F.col("snapshot_date").alias("label_date"), "loan_id", "installment_num")
    history = star_input(spark, small, "financials").select(
        F.trim(F.lower("Customer_ID")).alias("customer_id"), F.col("ingest_dt").cast("date").alias("feat_date"), "row_id")
    fast = as_of_join(base, [history], tie_breaks=[[F.col("row_id").desc()]])
    rank = F.row_number().over(Window.partitionBy("customer_id", "label_date").orderBy(F.desc("feat_date"), F.desc("row_id")))
    keys = base.select("customer_id", "label_date").distinct()
    slow = keys.join(history, "customer_id").where("feat_date <= label_date").withColumn("rn", rank).where("rn = 1")
    slow = base.join(slow.select("customer_id", "label_date", "row_id"), ["customer_id", "label_date"], "left")
    columns = ["customer_id", "label_date", "loan_id", "installment_num", "row_id"]
    assert sorted(map(repr, fast.select(*columns).collect())) == sorted(map(repr, slow.select(*columns).collect()))


def test_as_of_marks_stay_few_for_a_hot_customer(spark):
    """A customer with most rows has one mark per day, however many rows there are."""
    base = spark.range(20000).select(
        F.when(F.col("id") % 3 < 2, "hot").otherwise(F.concat(F.lit("c"), F.col("id"))).alias("customer_id"),
        F.date_add(F.lit("2023-01-01").cast("date"), (F.col("id") % 31).cast("int")).alias("label_date"))
    history = base.select("customer_id", F.date_sub("label_date", 3).alias("feat_date"), F.lit(1).alias("x"))
    picks = as_of_dates(base, [history])
    assert picks.where("customer_id = 'hot'").count() == 31
    joined = as_of_join(base, [history])
    assert joined.count() == 20000 and joined.where("x is null").count() == 0


def test_as_of_plan_neither_crosses_nor_forces_broadcast(spark, small):
    from creditmart.plans.catalog import QUERIES
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = QUERIES["asof_multi"](spark, small)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert "Cartesian" not in plan and "NestedLoop" not in plan and "BroadcastHashJoin" not in plan
    assert "SortMergeJoin" in plan


def test_keep_latest(spark):
    rows = [("a", "2023-01-01", None, 1), ("a", "2023-01-01", "2023-02-01", 2), ("a", "2023-01-01", "2023-02-03", 3),
            ("b", "2023-01-01", None, 4)]
    df = spark.createDataFrame(rows, "customer_id string, snapshot_date string, ingest_dt string, v int")
    assert sorted(r["v"] for r in keep_latest(df).collect()) == [3, 4]
    assert keep_latest(df.drop("ingest_dt")).count() == 2
    again = [sorted(r["v"] for r in keep_latest(df.drop("ingest_dt").repartition(n)).collect()) for n in (1, 3, 7)]
    assert again[0] == again[1] == again[2]


def test_duplicates_are_cut_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("id % 2 customer_id", "id % 3 snapshot_date", "id ingest_dt")
    plan = keep_latest(df)._jdf.queryExecution().executedPlan().toString()
    before = plan[plan.index("Exchange"):]
    assert "WindowGroupLimit" in before and "Partial" in before


def test_key_checks(spark):
    left = spark.createDataFrame([(" a", "2023-01-01"), ("A ", "2023-01-20"), ("b", "2023-01-01"), (None, "2023-01-01")],
                                 "customer_id string, snapshot_date string")
    right = spark.createDataFrame([("A", "2023-01-05"), ("C", "2023-01-01")], "customer_id string, snapshot_date string")
    a, b = Y.with_match_keys(left), Y.with_match_keys(right)
    keys = ["cid_key", "ym_key"]
    got = {(r[0], r[1]): r[2] for r in Y.key_overlap({"l": a, "r": b}, keys).collect()}
    assert got == {("l", "l"): 2, ("r", "r"): 2, ("l", "r"): 1}
    assert Y.overlap_rows(a, b, keys).first()[0] == 2
    assert sorted(map(str, (r["cid_key"] for r in Y.missing_keys(a, b, keys).collect()))) == ["B", "None"]
    row = Y.coverage(a, b, keys).first()
    assert (row["n_keys"], row["n_covered"]) == (3, 1)
    fixed = Y.with_match_keys(left, month="2024-01")
    assert fixed.select("ym_key").distinct().collect()[0][0] == "2024-01"


def test_month_join_fans_out_and_keeps_the_base(spark):
    base = spark.createDataFrame([("a", "2023-01-15", "l1")], "customer_id string, snapshot_date string, loan_id string")
    feats = spark.createDataFrame([(" A", None, "2023-01", 1), ("a", "2023-01-01", "2023-09", 2), ("a", "2023-02-01", None, 3)],
                                  "customer_id string, snapshot_date string, snap_ym string, x int")
    out = Y.month_key_join(base, [feats])
    assert sorted(r["x"] for r in out.collect()) == [1, 2]
    assert out.columns == ["customer_id", "snapshot_date", "loan_id", "snap_ym", "x"]


def test_looked_up_is_lazy_and_null_safe(spark):
    from creditmart.operators.lookup import looked_up
    rows = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, n int")
    side = spark.createDataFrame([("a", 0.5), (None, 0.9)], "k string, v double")
    before = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    out = rows.withColumn("v", looked_up(side, ["k"], "v"))
    assert spark.sparkContext.statusTracker().getJobIdsForGroup(None) == before
    assert {r["n"]: r["v"] for r in out.collect()} == {1: 0.5, 2: None, 3: None}
    assert {r["v"] for r in rows.withColumn("v", looked_up(side.limit(0), ["k"], "v")).collect()} == {None}


def test_as_of_drops_duplicates_below_the_days_found(spark):
    """The wide history meets the found days before duplicates of a day are dropped."""
    from creditmart.operators.asof import as_of_join
    base = spark.createDataFrame([("a", "2023-03-01")], "customer_id string, label_date string")
    history = spark.createDataFrame([("a", "2023-02-01", 1), ("a", "2023-02-01", 1), ("a", "2022-01-01", 2)], "customer_id string, feat_date string, x int")
    out = as_of_join(base, [history])
    assert [r["x"] for r in out.collect()] == [1]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Window [row_number()") < plan.index("LeftSemi")
