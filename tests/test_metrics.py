"""Ranking metrics against hand-made cases and a brute-force count."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from creditmart.operators import metrics as M
from creditmart.operators import monitoring as O
from creditmart.operators.modeling import apply_thresholds, pick_threshold, tuned_thresholds


def frame(spark, scores, labels, **extra):
    rows = [(float(s) if s is not None else None, y) for s, y in zip(scores, labels)]
    return spark.createDataFrame(rows, "score double, label int").withColumns({k: F.lit(v) for k, v in extra.items()})


def brute(scores, labels):
    s, y = np.asarray(scores), np.asarray(labels)
    diff = s[y == 1][:, None] - s[y == 0][None, :]
    auc = ((diff > 0) + 0.5 * (diff == 0)).mean()
    cuts = np.unique(s)[::-1]
    tp = np.array([((s >= c) & (y == 1)).sum() for c in cuts])
    fp = np.array([((s >= c) & (y == 0)).sum() for c in cuts])
    precision, recall = tp / (tp + fp), tp / tp[-1]
    ap = (np.diff(np.concatenate([[0], recall])) * precision).sum()
    f1 = 2 * precision * recall / (precision + recall + 1e-9)
    best = cuts[::-1][int(np.argmax(f1[::-1]))]
    return auc, ap, best


def test_small_case(spark):
    row = M.ranking_metrics(M.score_curve(frame(spark, [.1, .4, .35, .8], [0, 0, 1, 1]))).first()
    assert row["roc_auc"] == 0.75 and abs(row["pr_auc"] - 0.8333333) < 1e-6 and row["gini"] == 0.5
    assert (row["n_pos"], row["n_neg"]) == (2, 2)


@pytest.mark.parametrize("digits", [1, 6])
def test_against_brute_force_with_ties(spark, digits):
    rng = np.random.default_rng(3)
    scores = np.round(rng.random(700), digits)
    labels = (rng.random(700) < scores * 0.6).astype(int)
    auc, ap, best = brute(scores, labels)
    df = frame(spark, scores, labels.tolist(), model="m")
    for bits in ((24, 20), (1, 1), (14, 2), (16, 48)):
        curve = M.score_curve(df, ["model"], bits=bits)
        row = M.ranking_metrics(curve, ["model"]).first()
        assert row["roc_auc"] == pytest.approx(auc, abs=1e-12) and row["pr_auc"] == pytest.approx(ap, abs=1e-12)
        assert M.best_threshold(curve, ["model"]).first()["threshold"] == best


def test_hot_score_is_one_row_of_the_curve(spark):
    """A third of all rows with one score collapses before the shuffle."""
    df = spark.range(9000).select(F.when(F.col("id") % 3 == 0, 0.25).otherwise(F.rand(5)).alias("score"),
                                  (F.col("id") % 2).cast("int").alias("label"))
    counts = M.score_counts(df)
    assert counts.where("score = 0.25").select("rows").first()[0] >= 3000
    assert counts.agg(F.sum("rows")).first()[0] == 9000


def test_bad_rows_do_not_count(spark):
    df = frame(spark, [.1, None, float("nan"), .9, .5], [0, 1, 1, 1, 2])
    row = M.ranking_metrics(M.score_curve(df)).first()
    assert (row["n_pos"], row["n_neg"], row["roc_auc"]) == (1, 1, 1.0)


def test_one_class_has_no_auc(spark):
    assert M.ranking_metrics(M.score_curve(frame(spark, [.1, .2], [1, 1]))).first()["roc_auc"] is None


def test_guard_needs_ten_rows_of_both_classes(spark):
    nine = M.guarded_auc(M.score_curve(frame(spark, np.arange(9) / 10, [0, 1] * 4 + [1])))
    ten = M.guarded_auc(M.score_curve(frame(spark, np.arange(10) / 10, [0, 1] * 5)))
    same = M.guarded_auc(M.score_curve(frame(spark, np.arange(10) / 10, [1] * 10)))
    assert nine.first()["auc"] is None and same.first()["auc"] is None
    assert ten.first()["auc"] == pytest.approx(0.6)


def test_confusion_without_hits_is_zero(spark):
    row = M.confusion(frame(spark, [.1, .2], [0, 1]), threshold=0.9).first()
    assert (row["tn"], row["fp"], row["fn"], row["tp"], row["precision_1"], row["f1_1"]) == (1, 0, 1, 0, 0.0, 0.0)


def grid(spark):
    parts = [frame(spark, [.1, .4, .35, .8], [0, 0, 1, 1], model="m", split=s) for s in ("Train", "Valid", "Test", "OOT")]
    df = parts[0]
    for part in parts[1:]:
        df = df.unionByName(part)
    return df, M.metric_grid(df)


def test_grid_has_eight_rows(spark):
    _, out = grid(spark)
    rows = {r["split"]: r for r in out.collect()}
    assert set(rows) == {s + t for s in ("Train", "Valid", "Test", "OOT") for t in ("", "_tuned")}
    assert rows["Valid"]["threshold"] == 0.5 and rows["Valid_tuned"]["threshold"] == 0.35
    assert (rows["Test_tuned"]["tp"], rows["Test_tuned"]["fp"], rows["Test"]["tp"]) == (2, 1, 1)
    best = M.compare_models(out).first()
    assert (best["roc_auc_valid"], best["tuned_threshold"]) == (0.75, 0.35)


def test_thresholds(spark):
    assert pick_threshold(None, None) == 0.5 and pick_threshold(0.0, 0.3) == 0.3 and pick_threshold(0.7, 0.3) == 0.7
    df, out = grid(spark)
    scored = apply_thresholds(df.where("split = 'OOT'"), tuned_thresholds(out))
    assert scored.where("pred = 1").count() == 3
    assert apply_thresholds(df.where("split = 'OOT'"), tuned_thresholds(out), override=0.0).where("pred = 1").count() == 3
    assert apply_thresholds(df.where("split = 'OOT'"), tuned_thresholds(out), override=0.9).where("pred = 1").count() == 0


# ---- monitoring -------------------------------------------------------------------------

def scored_batches(spark):
    rows = [(f"2025-0{m}-01 00:00:00", f"l{i}", "2024-01-01", i / 10, int(i >= 5), i / 20, 0) for m in (2, 1) for i in range(10)]
    return spark.createDataFrame(rows, "batch_ts string, loan_id string, snapshot_date string, proba_lr double, pred_lr int, "
                                       "proba_xgb double, pred_xgb int").withColumn("batch_ts", F.col("batch_ts").cast("timestamp"))


def test_trend(spark):
    labels = spark.createDataFrame([(f"l{i}", "2024-01-01", i % 2) for i in range(10)] + [("l0", "2024-01-01", 0)],
                                   "loan_id string, snapshot_date string, label int")
    rows = O.trend(scored_batches(spark), labels).collect()
    assert [r["batch_month"] for r in rows] == ["2025-01", "2025-02"]
    assert rows[0]["pos_rate_lr"] == 0.5 and rows[0]["auc_lr"] == pytest.approx(0.6) and rows[0]["mean_proba_lr"] == pytest.approx(0.45)


def test_conflicting_labels_duplicate_rows(spark):
    labels = spark.createDataFrame([("l0", "2024-01-01", 0), ("l0", "2024-01-01", 1), ("l0", "2024-01-01", 1)],
                                   "loan_id string, snapshot_date string, label int")
    joined = O.join_labels(scored_batches(spark), labels)
    assert joined.count() == 22 and joined.where("label is not null").count() == 4


def test_join_keys():
    assert O.join_keys(["loan_id", "customer_id", "snapshot_date"], ["loan_id", "snapshot_date"]) == ["snapshot_date", "loan_id"]
    assert O.join_keys(["customer_id"], ["loan_id", "customer_id", "snapshot_date"]) == ["customer_id"]
    assert O.join_keys(["x"], ["loan_id"]) is None


def test_primary_metrics_fall_back(spark):
    df = spark.createDataFrame([(1, 0.7, None, 0.2), (2, 0.6, 0.8, 0.3)], "batch_ts int, auc_lr double, auc_xgb double, pos_rate_lr double")
    rows = O.primary_metrics(df).orderBy("batch_ts").collect()
    assert [(r["primary_model"], r["auc"], r["rate"]) for r in rows] == [("xgb", 0.7, 0.2), ("xgb", 0.8, 0.3)]
    assert O.primary_metrics(df, prefer="lr").first()["primary_model"] == "lr"
    assert O.enough_points(O.primary_metrics(df)).count() == 2
    assert O.enough_points(O.primary_metrics(df), least=3).count() == 0


def test_one_dominant_score_does_not_gather_the_others(spark):
    """99 % equal scores: no job and no subquery in the curve, and no part holds most of the distinct scores."""
    from creditmart.operators.ranges import PART, SLOT, with_slots
    df = spark.range(100_000).selectExpr(
        "case when id % 100 = 0 then id / 100000.0d else 0.0d end as score", "cast(id % 3 = 0 as int) as label", "'m' as model", "'Valid' as split")
    jobs = lambda: len(spark.sparkContext.statusTracker().getJobIdsForGroup(None))
    before = jobs()
    grid = M.metric_grid(df)
    counts = M.score_counts(df, ["model", "split"])
    ranged = with_slots(counts, "score").groupBy(SLOT, PART).count()
    plan = M.score_curve(df, ["model", "split"])._jdf.queryExecution().executedPlan().toString()
    assert "ubquery" not in plan
    assert jobs() == before
    assert max(r["count"] for r in ranged.collect()) <= 1000 // 8
    assert grid.count() == 2


def test_grid_reads_the_scored_rows_once(spark):
    """All passes over the scores share the shuffle of their counts, the one that tunes the threshold too."""
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    rows = spark.range(4_000, numPartitions=4).selectExpr(
        "'m' as model", "case when id % 4 = 0 then 'Valid' else 'Train' end as split", "id * 7919 % 4003 / 4003.0d as score",
        "cast(id % 3 = 0 as int) as label").mapInArrow(counted, "model string, split string, score double, label int")
    out = M.metric_grid(rows).collect()
    assert len(out) == 4 and {sum(r[c] for c in ("tn", "fp", "fn", "tp")) for r in out} == {1_000, 3_000}
    assert seen.value == 4_000


def test_large_slots_are_parted(spark):
    """Totals are the same whether all, some or no slots are taken in parts, for several groups and a null one."""
    from creditmart.operators.ranges import running_totals
    draw = np.random.default_rng(5)
    values = np.unique(np.concatenate([draw.normal(size=300), 0.3 + draw.random(300) * 1e-5, [0.0]]))
    rows = [(g, float(v), i % 5) for g in ("a", "b", None) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "g string, x double, n long")
    want = np.cumsum(np.arange(len(values)) % 5)
    for whole in (0, 20, 1 << 20):
        got = running_totals(df, ["g"], "x", {"t": "n"}, group_totals={"all": "t"}, whole=whole).collect()
        assert len(got) == len(rows) and {r["all"] for r in got} == {int(want[-1])}
        for g in ("a", "b", None):
            assert [r["t"] for r in sorted((r for r in got if r["g"] == g), key=lambda r: r["x"])] == want.tolist()
