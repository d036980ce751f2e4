"""Profiles, quality suites, entity statistics, splits and preprocessing."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from creditmart.operators import preprocess as P
from creditmart.operators import profile as R
from creditmart.operators import quality as Q
from creditmart.operators import splits as S
from creditmart.operators.entity_stats import busiest_entities, entity_stats
from creditmart.operators.projection import seeded_sample
from creditmart.operators.ranges import running_totals, with_image


@pytest.fixture(scope="module")
def numbers(spark):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({"a": rng.normal(size=501), "b": np.round(rng.random(501), 1), "c": np.full(501, 3.0)})
    pdf.loc[::7, "b"] = np.nan
    df = spark.createDataFrame(pdf).withColumn("b", F.when(~F.isnan("b"), F.col("b"))).repartition(5)
    return pdf, df


def test_exact_percentiles(numbers):
    pdf, df = numbers
    shares = [0.01, 0.25, 0.5, 0.99, 0.0, 1.0]
    got = {(r["column"], r["share"]): r["value"] for r in R.exact_percentiles(df, ["a", "b", "c"], shares).collect()}
    for c in "abc":
        for s in shares:
            assert got[(c, s)] == pytest.approx(pdf[c].quantile(s), abs=1e-12)


def test_describe_histogram_and_correlation(numbers):
    pdf, df = numbers
    rows = {r["column"]: r for r in R.describe(df, ["a", "b"]).collect()}
    assert rows["b"]["count"] == pdf["b"].count() and rows["a"]["std"] == pytest.approx(pdf["a"].std())
    assert rows["a"]["p95"] == pytest.approx(pdf["a"].quantile(0.95))
    bins = {(r["column"], r["bin"]): r["n_rows"] for r in R.histogram(df, ["a", "c"]).collect()}
    want, _ = np.histogram(pdf["a"], 30)
    assert [bins.get(("a", i), 0) for i in range(30)] == want.tolist() and bins[("c", 0)] == 501
    corr = {(r["column_a"], r["column_b"]): r["corr"] for r in R.correlation_matrix(df, ["a", "b", "c"]).collect()}
    assert corr[("a", "b")] == pytest.approx(pdf["a"].corr(pdf["b"])) == corr[("b", "a")]
    assert corr[("a", "c")] is None and corr[("a", "a")] == pytest.approx(1.0)


def test_running_totals_do_not_depend_on_slots(spark):
    df = spark.createDataFrame([("g", float(i), i) for i in range(50)] + [("h", 3.5, 7)], "g string, x double, n long")
    want = None
    for bits in ((24, 20), (1, 1), (12, 0), (16, 48), (13, 3)):
        for down in (False, True):
            rows = running_totals(df, ["g"], "x", {"t": "n"}, down, bits, {"all": "t"}).collect()
            got = {(r["g"], r["x"]): (r["t"], r["all"]) for r in rows}
            assert got[("g", 49.0)] == ((49 if down else 1225), 1225) and got[("h", 3.5)] == (7, 7)
            if not down:
                want = want or got
                assert got == want


def test_image_is_the_order_of_doubles(spark):
    """The image equals the IEEE bits, in ascending order, next to powers of two and for subnormals too."""
    import struct

    draw = np.random.default_rng(0)
    powers = [2.0**e for e in range(-1074, 1024)]
    values = [0.0, -0.0, 1.7976931348623157e308, 5e-324, 3e-310, float("inf"), *powers, *(float(np.nextafter(p, 0)) for p in powers),
              *(float(np.nextafter(p, np.inf)) for p in powers), *draw.normal(size=500).tolist(), *(10.0 ** draw.uniform(-300, 300, 500)).tolist()]
    values += [-v for v in values]
    rows = with_image(spark.createDataFrame([(v,) for v in [*values, None, float("nan")]], "v double"), "v").collect()
    for r in rows:
        if r["v"] is None or r["v"] != r["v"]:
            assert r["_image"] == (None if r["v"] is None else (1 << 63) - 1)
        elif abs(r["v"]) == float("inf"):
            assert abs(r["_image"]) == (1 << 63) - 2
        else:
            bits = struct.unpack("<q", struct.pack("<d", abs(r["v"])))[0]
            assert r["_image"] == (bits if r["v"] > 0 else -bits), r["v"]


def test_percentiles_of_many_values_rank_few(spark):
    """10^6 distinct values: no job while the plan is built, and windows order slots, at most 1/200 as many."""
    df = spark.range(1_000_000).selectExpr("(id * 7919 % 1000003) / 1000003.0d as v")
    jobs = lambda: len(spark.sparkContext.statusTracker().getJobIdsForGroup(None))
    before = jobs()
    found = R.exact_percentiles(df, ["v"], [0.0, 0.37, 0.5])
    assert jobs() == before
    want = np.sort((np.arange(1_000_000) * 7919 % 1000003) / 1000003.0)
    got = {r["share"]: r["value"] for r in found.collect()}
    assert got[0.0] == want[0] and got[0.5] == pytest.approx((want[499_999] + want[500_000]) / 2, abs=0)
    assert got[0.37] == pytest.approx(np.quantile(want, 0.37), abs=1e-15)
    # Slots of the first round over all values, and parts of one slot: what the windows order.
    slots = with_image(df, "v").selectExpr("shiftright(_image, 44) as s", "shiftright(_image, 22) as p")
    assert slots.select("s").distinct().count() < 5000
    assert slots.groupBy("s").agg(F.count_distinct("p").alias("n")).agg(F.max("n")).first()[0] <= 4096


def test_percentiles_of_negative_odd_and_equal_values(spark):
    values = [-5.5, -0.0, 0.0, 3e-310, -1e300, 1e300, 7.0, 7.0, 7.0, None, -5.5]
    df = spark.createDataFrame([(v, None, 2.5) for v in values], "a double, b double, c double")
    got = {(r["column"], r["share"]): r["value"] for r in R.exact_percentiles(df, ["a", "b", "c"], [0.0, 0.3, 0.5, 1.0]).collect()}
    for s in (0.0, 0.3, 0.5, 1.0):
        assert got["a", s] == pytest.approx(np.quantile([v for v in values if v is not None], s)) and got["c", s] == 2.5
    assert not [k for k in got if k[0] == "b"]


def test_percentile_rounds_do_not_repeat_the_image(spark):
    """The arithmetic of the bits stands a few times in the plan, not in the joins' tests of their keys."""
    df = spark.range(10).selectExpr("id / 7.0d as a", "id / 3.0d as b")
    plan = R.describe(df, ["a", "b"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("POWER") <= 5 * len(R.ROUNDS)


def test_percentile_rounds_find_bits_of_wanted_slots_only(spark):
    """After the first round a comparison with a slot's ends tells its values; the bits of the others are not found."""
    values = [-7.25, -0.0, 0.0, 1.0, 1.0000001, 2.0, float("inf"), float("nan"), float("nan"), float("nan"), None, -1e300]
    df = spark.createDataFrame([(v,) for v in values], "a double")
    found = R.exact_percentiles(df, ["a"], [0.0, 0.3, 0.4, 1.0])
    joins = [x for x in found._jdf.queryExecution().optimizedPlan().toString().split("\n") if "Join Inner" in x]
    assert len(joins) == len(R.ROUNDS) - 1 and all("_low" in x and "_high" in x and "_bits" not in x for x in joins)
    got = {r["share"]: r["value"] for r in found.collect()}
    assert got[0.0] == -1e300 and got[0.3] == 0.0 and got[0.4] == 1.0 and got[1.0] != got[1.0]


def test_medians_read_the_rows_once(spark):
    from creditmart.operators.preprocess import medians
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    df = spark.range(5_000, numPartitions=4).selectExpr("id % 997 / 7.0d as a").mapInArrow(counted, "a double")
    assert medians(df, ["a"]).first()["value"] == pytest.approx(np.median(np.arange(5_000) % 997 / 7.0))
    assert seen.value == 5_000


def test_null_and_class_rates(spark):
    df = spark.createDataFrame([(1, None), (1, "x"), (0, "x"), (None, "x")], "label int, v string")
    assert {r["column"]: r["null_rate"] for r in R.null_rates(df).collect()} == {"label": 25.0, "v": 25.0}
    assert {r["label"]: r["percent"] for r in R.class_share(df).collect()} == {1: 50.0, 0: 25.0, None: 25.0}
    assert R.filled_rates(df, ["v", "no"]).first()[0] == 0.75
    assert R.distinct_keys(df, ["label", "v"]).first()[0] == 4


def test_quality_of_financials(spark):
    from test_features import financials
    day = F.lit("2023-07-01").cast("date")
    good = financials(spark, annual_income=10.0, num_of_loan=2, type_of_loan="A, B", interest_rate=5.0, credit_mix="Good")
    bad = financials(spark, annual_income=1.005, num_of_loan=1, type_of_loan="A, B", interest_rate=200.0,
                     delay_from_due_date=-1, payment_behaviour="!@9#%8")
    nulls = financials(spark, type_of_loan="A").withColumn("customer_id", F.lit("c2"))
    df = good.unionByName(bad).unionByName(nulls).withColumns({"snapshot_date": day, "ds_token": F.lit("2023-07")})
    got = {(r["check"], r["month"], r["column_name"]): r["value"] for r in Q.financials_suite(df.drop("monthly_balance")).collect()}
    assert got[("duplicate_groups", None, None)] == 1 and got[("rows", "2023-07", None)] == 3
    assert got[("out_of_range_rows", None, "interest_rate")] == 1 and got[("junk_token_rows", None, "payment_behaviour")] == 1
    assert got[("loan_count_mismatch_rows", None, "num_of_loan")] == 1  # the row without a count is skipped
    assert got[("not_two_decimals_share", None, "annual_income")] == pytest.approx(1 / 3)
    assert got[("missing_column", None, "monthly_balance")] == 1 and got[("credit_mix_rows", None, "Good")] == 1
    assert Q.missing_columns(df.drop("monthly_balance", "ds_token")) == ["monthly_balance"]
    assert ("early_payment_percent", None, "delay_from_due_date") in got
    old = {r["check"] for r in Q.financials_suite(df, rule="parsed").collect()}
    assert "early_payment_percent" not in old


def test_label_store_suite(spark):
    df = spark.createDataFrame([("l1", "2023-01-01", 1, "30dpd_6mob"), ("l1", "2023-01-01", 0, "30dpd_6mob"),
                                ("l2", "2023-01-01", 3, "30dpd_0mob")], "loan_id string, snapshot_date string, label int, label_def string")
    got = {(r["check"], r["month"], r["column_name"]): r["value"] for r in Q.label_store_suite(df).collect()}
    assert got[("duplicate_labels", None, None)] == 1 and got[("non_binary_rows", None, None)] == 1
    assert got[("class_percent", None, "1")] == 33.33 and got[("definition_rows", None, "30dpd_0mob")] == 1
    assert Q.labels_of_mob(df, 0).count() == 1


def test_schema_and_files(spark, small):
    orders = spark.read.parquet(f"{small}/orders.parquet")
    assert Q.files_per_layer({"orders": orders}).first()["n_files"] == 1
    assert Q.schema_rows(orders, "orders").count() == len(orders.columns)
    assert Q.snapshots_per_file(orders, "o_orderstatus").count() == 3


def test_seeded_sample_repeats(spark):
    df = spark.range(100).withColumnRenamed("id", "k")
    first = {r["k"] for r in seeded_sample(df, ["k"], 10).collect()}
    assert len(first) == 10 and first == {r["k"] for r in seeded_sample(df.repartition(7), ["k"], 10).collect()}
    assert first != {r["k"] for r in seeded_sample(df, ["k"], 10, seed=1).collect()}


def test_entity_stats(spark):
    df = spark.createDataFrame([("a", "2024-01-01", 1.0, "2"), ("a", "2024-01-03", None, "4"), ("b", None, 5.0, "x")],
                               "Customer_ID string, snapshot_date string, fe_1 double, fe_2 string")
    rows = {r["Customer_ID"]: r for r in entity_stats(df).collect()}
    a, b = rows["a"], rows["b"]
    assert (a["n_rows"], a["days_active"], a["fe_1_mean"], a["fe_1_missing_rate"], a["fe_2_sum"]) == (2, 2.0, 1.0, 0.5, 6.0)
    assert b["days_active"] is None and b["fe_1_std"] is None and b["fe_2_missing_rate"] == 1.0
    assert len(entity_stats(df).columns) == 5 + 14
    assert busiest_entities(entity_stats(df), 1).first()["Customer_ID"] == "a"


# ---- splits -----------------------------------------------------------------------------

def test_stratified_split_is_exact_and_repeatable(spark):
    df = spark.range(1003).select("id", (F.col("id") % 4 == 0).cast("int").alias("label"))
    out = S.stratified_split(df, ["id"], 0.8).cache()
    sizes = {(r["label"], r["part"]): r["count"] for r in out.groupBy("label", "part").count().collect()}
    ones = 251
    assert sizes[(1, "train")] == int(ones * 0.8) and sizes[(0, "train")] == int((1003 - ones) * 0.8)
    again = S.stratified_split(df.repartition(9), ["id"], 0.8)
    assert {r["id"] for r in out.where("part = 'train'").collect()} == {r["id"] for r in again.where("part = 'train'").collect()}
    assert S.stratified_split(df, ["id"], 0.0).where("part = 'train'").count() == 0
    assert S.stratified_split(df, ["id"], 1.0).where("part = 'test'").count() == 0


def test_copies_of_a_key_share_a_side(spark):
    df = spark.range(900).select(F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"), F.lit(1).alias("label"))
    assert S.stratified_split(df, ["k"]).where("k = -1").select("part").distinct().count() == 1


def test_windows(spark):
    months = S.window_months(spark, "2024-03-01", "2024-03-01", "days")
    got = {(r["split"], r["month"]) for r in months.collect()}
    assert ("Test", dt.date(2024, 1, 1)) in got and ("Valid", dt.date(2024, 1, 1)) in got
    plain = {r["split"]: r["month"] for r in S.window_months(spark, "2024-03-01", "2024-03-01").where("split <> 'Train'").collect()}
    assert plain == {"Valid": dt.date(2024, 1, 1), "Test": dt.date(2024, 2, 1), "OOT": dt.date(2024, 3, 1)}
    df = spark.createDataFrame([(dt.date(2024, 1, 1), 1)], "snapshot_date date, label int")
    used = {(r["run_month"], r["split"]) for r in S.rolling_windows(df, "2023-12-01", "2024-06-01").collect()}
    assert used == {(dt.date(2024, 1, 1), "OOT"), (dt.date(2024, 2, 1), "Test"), (dt.date(2024, 3, 1), "Valid"),
                    (dt.date(2024, 4, 1), "Train"), (dt.date(2024, 5, 1), "Train")}


def test_training_split(spark):
    at = spark.range(1).select(*[c.alias(n) for n, c in S.training_window("2024-09-01").items()]).first()
    assert at.asDict() == {"train_test_start": dt.date(2023, 7, 1), "train_test_end": dt.date(2024, 6, 30),
                           "oot_start": dt.date(2024, 7, 1), "oot_end": dt.date(2024, 8, 31)}


def test_time_split_drops_outside_rows(spark):
    df = spark.createDataFrame([(dt.date(2023, 6, 30),), (dt.date(2024, 4, 30),), (dt.date(2024, 12, 31),)], "snapshot_date date")
    assert [r["split"] for r in S.time_split(df).orderBy("snapshot_date").collect()] == ["Train", "OOT"]


# ---- preprocessing ----------------------------------------------------------------------

def test_imputation(spark):
    df = spark.createDataFrame([(1.0, "b"), (4.0, "a"), (None, None), (2.0, "b"), (3.0, "a")], "n double, c string")
    fills = P.fill_values(df, ["n"], ["c"])
    assert fills == {"n": 2.5, "c": "a"}  # mean of the middle values; least value on ties
    row = P.impute(df, fills).where("n = 2.5").first()
    assert (row["n"], row["c"]) == (2.5, "a")
    assert P.fill_values(df, ["n"], [], exact=False)["n"] == 2.0


def test_scaling_uses_population_deviation(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "x double, k double")
    rows = P.standardise(df, ["x", "k"]).orderBy("x").collect()
    assert [(r["x"], r["k"]) for r in rows] == [(-1.0, 0.0), (1.0, 0.0)]
    staged = P.standardise_stage(df, ["x", "k"]).transform(df).orderBy("x").collect()
    assert [(r["x_f"], r["k_f"]) for r in staged] == [(-1.0, 0.0), (1.0, 0.0)]


def test_monthly_states_merge_into_one_pass(spark):
    from creditmart.operators.entity_stats import entity_month_states, stats_of_states
    draw = np.random.default_rng(6)
    rows = [(f"c{i % 7}", f"2024-{1 + i % 5:02d}-{1 + i % 28:02d}", None if i % 11 == 0 else float(draw.normal(50, 9)), None if i % 7 == 3 else float(i % 9))
            for i in range(900)] + [("one", "2024-01-05", 2.5, None)]
    df = spark.createDataFrame(rows, "Customer_ID string, snapshot_date string, fe_1 double, fe_2 double")
    want = {r["Customer_ID"]: r.asDict() for r in entity_stats(df).collect()}
    # States of each month, made from two halves of its rows, as two batches would.
    halves = [entity_month_states(df.where(F.pmod(F.hash("fe_1", "snapshot_date"), F.lit(2)) == h)) for h in (0, 1)]
    got = {r["Customer_ID"]: r.asDict() for r in stats_of_states(halves[0].unionByName(halves[1]), ["fe_1", "fe_2"]).collect()}
    assert set(got) == set(want)
    for key, row in want.items():
        for name, value in row.items():
            assert got[key][name] == (pytest.approx(value, abs=1e-9) if isinstance(value, float) else value), (key, name)
    assert got["one"]["fe_1_std"] is None and got["one"]["fe_2_median"] is None and got["one"]["fe_2_missing_rate"] == 1


def test_median_of_many_values_is_within_the_sketch_error(spark):
    from creditmart.operators.entity_stats import entity_month_states, stats_of_states
    df = spark.range(60_000).selectExpr(
        "'c' as Customer_ID", "concat('2024-0', id % 6 + 1, '-01') as snapshot_date", "(id * 7919 % 60013) / 1.0d as fe_1")
    median = stats_of_states(entity_month_states(df), ["fe_1"]).first()["fe_1_median"]
    rank = df.where(F.col("fe_1") <= median).count() / 60_000
    assert abs(rank - 0.5) < 0.0266  # twice the stated error


def test_theta_overlap_is_exact_when_small_and_near_when_large(spark):
    from creditmart.operators import keys as Y
    left = spark.range(90_000).selectExpr("id as k", "concat('2024-0', id % 3 + 1) as m")
    frames = {"a": left, "b": left.where("k % 3 = 0").withColumn("k", F.col("k") + 15_000), "none": left.where("k < 0")}
    exact = {(r["left_side"], r["right_side"]): r["n_keys"] for r in Y.key_overlap(frames, ["k"]).collect()}
    for bits in (17, 12):
        sketches = Y.key_sketches(frames, ["k"], "m", bits)
        got = {(r["left_side"], r["right_side"]): r["n_keys"] for r in Y.sketched_overlap(sketches, list(frames), bits=bits).collect()}
        assert set(got) == set(exact)
        for pair, n in exact.items():
            assert got[pair] == n if bits == 17 else abs(got[pair] - n) <= 0.08 * 90_000
    one = {(r["left_side"], r["right_side"]): r["n_keys"] for r in Y.sketched_overlap(Y.key_sketches(frames, ["k"], "m"), list(frames), "2024-02", "2024-02").collect()}
    assert one["a", "a"] == 30_000 and one["none", "none"] == 0


@pytest.mark.parametrize("keys", [["k"], ["k", "m"]])
def test_theta_overlap_is_exact_beyond_the_size_of_a_sketch(spark, keys):
    from creditmart.operators import keys as Y
    left = spark.range(6_000).selectExpr("id as k", "concat('2024-0', id % 2 + 1) as m")
    again = left.where("k < 900").withColumn("m", F.lit("2024-02"))  # the same k in two months
    frames = {"a": left.unionByName(again), "b": left.where("k % 3 = 0").withColumn("k", F.col("k") + 1500), "none": left.where("k < 0")}
    exact = sorted(map(tuple, Y.key_overlap(frames, keys).collect()))
    sketches = Y.key_sketches(frames, keys, "m", 8)
    assert sorted(map(tuple, Y.sketched_overlap(sketches, list(frames), bits=8).collect())) == exact


def test_compressible_rows_are_not_joined_into_few_tasks(spark):
    """3,000,000 narrow rows of one shuffle stay in parts whose tables a task can hold."""
    few = spark.range(3_000_000, numPartitions=8).selectExpr("id % 1500000 as k", "id % 7 as v").groupBy("k").agg(F.sum("v").alias("v"))
    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "8m"
    sizes = few.select(F.spark_partition_id().alias("p")).groupBy("p").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0]
    assert sizes < 1_000_000
