"""Exact ranking and threshold metrics of scored rows.

Rows are first counted per distinct score, which collapses ties map-side. Everything else works
on those counts: the curve adds running totals from the highest score down, and ROC-AUC, average
precision, best F1 and confusion cells are sums over it. Group columns (batch, model, split)
must not be null.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from creditmart import constants as K
from creditmart.operators.ranges import BITS, running_totals


def melt_models(df: DataFrame, models: Mapping[str, str], keep: Sequence[str]) -> DataFrame:
    """One row per input row and model: ``keep`` columns, ``model``, ``score``."""
    pairs = F.array(*[
        F.struct(F.lit(name).alias("model"), F.col(score).cast("double").alias("score"))
        for name, score in models.items()
    ])
    return df.select(*keep, F.inline(pairs))


def score_counts(df: DataFrame, groups: Sequence[str] = (), score: str = "score",
                 label: str = "label") -> DataFrame:
    """Positives and negatives per distinct score; rows without score or 0/1 label do not count."""
    value = F.col(score)
    if score != "score" or dict(df.dtypes).get(score) != "double":
        # Only where it changes something: a needless alias is dropped from some copies of the plan and kept in
        # others, which then do not share the shuffle of the counts.
        value = value.try_cast("double").alias("score")
    truth = F.round(F.col(label).try_cast("double"), 0)
    valid = df.select(*groups, value, truth.alias("_truth")).where(
        F.col("score").isNotNull() & ~F.isnan("score") & F.col("_truth").isin(0.0, 1.0)
    )
    counts = valid.groupBy(*groups, "score").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("_truth") == 1.0).alias("pos"))
    return counts.withColumn("neg", F.col("rows") - F.col("pos"))


def score_curve(df: DataFrame, groups: Sequence[str] = (), score: str = "score",
                label: str = "label", bits: Sequence[int] = BITS) -> DataFrame:
    """Per distinct score the hits ``tp`` and false alarms ``fp`` when cutting right there.

    ``all_pos`` is the number of positives of the whole group. Rows are counted once per distinct
    score; the running totals are taken over slots of the scores' bits, so a score that most rows
    share does not matter.
    """
    return curve_of_counts(score_counts(df, groups, score, label), groups, bits)


def curve_of_counts(counts: DataFrame, groups: Sequence[str] = (), bits: Sequence[int] = BITS) -> DataFrame:
    """The curve from ``score_counts``, one row per group and score; stored counts add up to it too."""
    # Totals of rows and hits, not of hits and misses: every metric then needs both columns, so
    # that Spark computes the counts once and reads their shuffle twice.
    curve = running_totals(counts, groups, "score", {"seen": "rows", "tp": "pos"}, descending=True,
                           bits=bits, group_totals={"all_pos": "tp"})
    return curve.withColumn("fp", F.col("seen") - F.col("tp")).drop("seen", "rows")


def _area_under_roc() -> Column:
    """Share of (positive, negative) pairs in the right order, ties counting half."""
    wrong = F.col("fp") - F.col("neg") / 2  # doubles: the products outgrow 64-bit integers
    pairs = F.sum("pos").cast("double") * F.sum("neg").cast("double")
    return 1 - F.try_divide(F.sum(F.col("pos") * wrong), pairs)


def _average_precision() -> Column:
    step = F.col("pos") * (F.col("tp") / (F.col("tp") + F.col("fp")))
    return F.try_divide(F.sum(step), F.sum("pos"))


def ranking_metrics(curve: DataFrame, groups: Sequence[str] = ()) -> DataFrame:
    """Counts, ROC-AUC, Gini and PR-AUC (average precision) per group."""
    auc = _area_under_roc()
    return curve.groupBy(*groups).agg(
        F.coalesce(F.sum("pos"), F.lit(0)).alias("n_pos"),
        F.coalesce(F.sum("neg"), F.lit(0)).alias("n_neg"),
        auc.alias("roc_auc"),
        _average_precision().alias("pr_auc"),
    ).withColumn("gini", gini(F.col("roc_auc")))


def gini(auc: Column, places: int = 3) -> Column:
    return F.round(2 * auc - 1, places)


def guarded_auc(curve: DataFrame, groups: Sequence[str] = (), least: int = K.MIN_AUC_ROWS) -> DataFrame:
    """ROC-AUC only where at least ``least`` labelled rows of both classes exist."""
    enough = (F.col("n_pos") + F.col("n_neg") >= least) & (F.col("n_pos") > 0) & (F.col("n_neg") > 0)
    return ranking_metrics(curve, groups).select(*groups, F.when(enough, F.col("roc_auc")).alias("auc"))


def _best_cut() -> Column:
    """Score, precision, recall and F1 where F1 is highest, the lowest such score on ties."""
    precision = F.col("tp") / (F.col("tp") + F.col("fp"))
    recall = F.coalesce(F.try_divide(F.col("tp"), F.col("all_pos")), F.lit(0.0))
    f1 = 2 * (precision * recall) / (precision + recall + K.F1_EPSILON)
    cut = F.struct("score", precision.alias("precision"), recall.alias("recall"), f1.alias("f1"))
    return F.max_by(cut, F.struct(f1.alias("f1"), -F.col("score")))


def best_threshold(curve: DataFrame, groups: Sequence[str] = ()) -> DataFrame:
    """Score with the highest F1 per group, the lowest such score on ties."""
    return curve.groupBy(*groups).agg(_best_cut().alias("_best")).select(
        *groups, F.col("_best.score").alias("threshold"), "_best.precision", "_best.recall",
        "_best.f1",
    )


def confusion_cells(score: Column, threshold: Column, pos: Column, neg: Column) -> dict[str, Column]:
    """Cells as weighted sums; a row is positive from the threshold on."""
    hit = score >= threshold
    return {
        "tn": F.sum(F.when(~hit, neg).otherwise(0)),
        "fp": F.sum(F.when(hit, neg).otherwise(0)),
        "fn": F.sum(F.when(~hit, pos).otherwise(0)),
        "tp": F.sum(F.when(hit, pos).otherwise(0)),
    }


def with_rates(df: DataFrame) -> DataFrame:
    """Precision, recall and F1 of class 1 from the cells; 0 where undefined."""
    def rate(part: Column, whole: Column) -> Column:
        return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return df.withColumns({
        "precision_1": rate(tp, tp + fp),
        "recall_1": rate(tp, tp + fn),
        "f1_1": rate(2 * tp, 2 * tp + fp + fn),
    })


def confusion(df: DataFrame, groups: Sequence[str] = (), score: str = "score", label: str = "label",
              threshold: float = K.DEFAULT_THRESHOLD) -> DataFrame:
    """Cells and rates at one threshold, all groups in one pass."""
    counts = score_counts(df, groups, score, label)
    cells = confusion_cells(F.col("score"), F.lit(threshold), F.col("pos"), F.col("neg"))
    return with_rates(counts.groupBy(*groups).agg(*[c.alias(name) for name, c in cells.items()]))


def metric_grid(df: DataFrame, score: str = "score", label: str = "label",
                tune_on: str = "Valid", default: float = K.DEFAULT_THRESHOLD) -> DataFrame:
    """All metrics per model and split, at the default and at the tuned threshold.

    ``df`` holds ``model``, ``split``, score and label. The tuned threshold of a model is the
    best-F1 score of its ``tune_on`` rows; splits at that threshold get the suffix ``_tuned``.
    """
    counts = score_counts(df, ["model", "split"], score, label)
    curve = curve_of_counts(counts, ["model", "split"])
    plans = {"": F.lit(default), "_tuned": F.col("threshold")}

    def cells(suffix: str) -> Column:
        return F.struct(*[c.alias(name) for name, c in confusion_cells(
            F.col("score"), plans[suffix], F.col("pos"), F.col("neg")).items()]).alias(f"at{suffix}")

    # One pass over the curve of all splits also finds their best thresholds, so that no curve is made twice.
    graded = curve.groupBy("model", "split").agg(
        _area_under_roc().alias("roc_auc"), _average_precision().alias("pr_auc"), cells(""), _best_cut().alias("_best"))
    tuned = F.max(F.when(F.col("model").isNotNull() & (F.col("split") == tune_on), F.col("_best.score")))
    graded = graded.withColumn("threshold", tuned.over(Window.partitionBy("model"))).select(
        F.col("model").alias("_model"), F.col("split").alias("_split"),
        F.struct("threshold", "roc_auc", "pr_auc", "at").alias("_graded"))
    # One row per model and split, so this side cannot outgrow a broadcast.
    same = F.col("model").eqNullSafe(F.col("_model")) & F.col("split").eqNullSafe(F.col("_split"))
    graded = counts.join(F.broadcast(graded), same).withColumn("threshold", F.col("_graded.threshold")).groupBy(
        "model", "split", "_graded").agg(cells("_tuned")).select("model", "split", "_graded.*", "at_tuned")
    lines = F.array(*[
        F.struct(F.concat("split", F.lit(suffix)).alias("split"), at.alias("threshold"),
                 F.col("roc_auc"), F.col("pr_auc"), F.col(f"at{suffix}").alias("cells"))
        for suffix, at in plans.items()
    ])
    flat = graded.select("model", F.inline(lines)).where("threshold is not null")
    return with_rates(flat.select("model", "split", "threshold", "roc_auc", "pr_auc", "cells.*"))


def compare_models(grid: DataFrame, keys: Sequence[str] = (), split: str = "Valid") -> DataFrame:
    """ROC-AUC, PR-AUC and tuned threshold of every model on one split, one row per key."""
    wanted = F.col("split").isin(split, f"{split}_tuned")
    tuned = F.col("split") == f"{split}_tuned"
    return grid.where(wanted).groupBy(*keys, "model").agg(
        F.max(F.when(~tuned, F.col("roc_auc"))).alias("roc_auc_valid"),
        F.max(F.when(~tuned, F.col("pr_auc"))).alias("pr_auc_valid"),
        F.max(F.when(tuned, F.col("threshold"))).alias("tuned_threshold"),
    )
