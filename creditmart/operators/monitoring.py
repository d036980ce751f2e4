"""Monitoring of scored batches: rates and AUC per batch, all batches in one job."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from creditmart.functions.dates import month_of
from creditmart.operators.metrics import curve_of_counts, guarded_auc, melt_models, score_counts
from creditmart.operators.projection import lower_names

MODELS = ("lr", "xgb")


def join_keys(scored: Sequence[str], labels: Sequence[str]) -> list[str] | None:
    """Keys shared by both sides: the snapshot when both have it, then loan, else customer."""
    date = ["snapshot_date"] if "snapshot_date" in scored and "snapshot_date" in labels else []
    for name in ("loan_id", "customer_id"):
        if name in scored and name in labels:
            return [*date, name]
    return None


def join_labels(scored: DataFrame, labels: DataFrame) -> DataFrame | None:
    """Scored rows with their labels; two different labels of one key give two rows."""
    scored, labels = lower_names(scored), lower_names(labels)
    keys = join_keys(scored.columns, labels.columns)
    if keys is None or "label" not in labels.columns:
        return None
    right = labels.select(*keys, "label")
    if "snapshot_date" in keys:
        day = F.col("snapshot_date").try_cast("date")
        scored, right = scored.withColumn("snapshot_date", day), right.withColumn("snapshot_date", day)
    own = [c for c in scored.columns if c != "label"]
    return scored.select(*own).join(right.dropDuplicates([*keys, "label"]), keys, "left")


def batch_rates(scored: DataFrame, batch: str = "batch_ts") -> DataFrame:
    """Positive rate and mean probability per batch for the models that are present."""
    have = set(scored.columns)
    rates = [F.avg(f"{column}_{m}").alias(f"{name}_{m}")
             for column, name in (("pred", "pos_rate"), ("proba", "mean_proba"))
             for m in MODELS if f"{column}_{m}" in have]
    return scored.groupBy(batch).agg(*rates)


def batch_auc(joined: DataFrame, batch: str = "batch_ts") -> DataFrame:
    """Guarded AUC per batch, one column per model that is present."""
    return _auc_columns(batch_counts(joined, batch), _present(joined), batch)


def _present(scored: DataFrame) -> list[str]:
    return [m for m in MODELS if f"proba_{m}" in scored.columns]


def batch_counts(joined: DataFrame, batch: str = "batch_ts") -> DataFrame:
    """Labelled rows and positives per batch, model and distinct score."""
    long = melt_models(joined, {m: f"proba_{m}" for m in _present(joined)}, [batch, "label"])
    return score_counts(long, [batch, "model"])


def _auc_columns(counts: DataFrame, models: Sequence[str], batch: str) -> DataFrame:
    aucs = guarded_auc(curve_of_counts(counts, [batch, "model"]), [batch, "model"])
    return aucs.groupBy(batch).agg(*[
        F.max(F.when(F.col("model") == m, F.col("auc"))).alias(f"auc_{m}") for m in models])


def trend(scored: DataFrame, labels: DataFrame | None = None, batch: str = "batch_ts") -> DataFrame:
    """One row per batch in time order: rates, probabilities, AUC, month.

    Without ``labels`` the scored rows must carry ``label`` themselves.
    """
    joined = scored if labels is None else join_labels(scored, labels)
    result = batch_rates(scored, batch)
    if joined is None:
        result = result.withColumns({f"auc_{m}": F.lit(None).cast("double") for m in MODELS})
    else:
        result = result.join(batch_auc(joined, batch), batch, "left")
    return result.withColumn("batch_month", month_of(batch)).orderBy(batch)


# ---- stored state: what a batch contributes, kept so that it is read once -----------------

def batch_sums(scored: DataFrame, batch: str = "batch_ts") -> DataFrame:
    """(batch, name, n, total): values and their sum per batch and column of the trend's rates.

    Sums of disjoint rows add up. They are decimals, so the order of rows and merges does not matter.
    """
    have = set(scored.columns)
    names = [f"{kind}_{m}" for kind in ("pred", "proba") for m in MODELS if f"{kind}_{m}" in have]
    lines = F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("decimal(18,12)").alias("value")) for c in names])
    return scored.select(batch, F.inline(lines)).groupBy(batch, "name").agg(F.count("value").alias("n"), F.sum("value").alias("total"))


def merge_sums(sums: DataFrame, batch: str = "batch_ts") -> DataFrame:
    return sums.groupBy(batch, "name").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))


def merge_counts(counts: DataFrame, batch: str = "batch_ts") -> DataFrame:
    return counts.groupBy(batch, "model", "score").agg(*[F.sum(c).alias(c) for c in ("rows", "pos", "neg")])


def trend_of_state(sums: DataFrame, counts: DataFrame, models: Sequence[str] = MODELS, batch: str = "batch_ts") -> DataFrame:
    """``trend`` from merged ``batch_sums`` and ``batch_counts``; the scored rows are not needed any more."""
    rates = sums.groupBy(batch).agg(*[
        F.max(F.when(F.col("name") == f"{kind}_{m}", F.try_divide(F.col("total").cast("double"), "n"))).alias(f"{name}_{m}")
        for kind, name in (("pred", "pos_rate"), ("proba", "mean_proba")) for m in models])
    result = rates.join(_auc_columns(counts, models, batch), batch, "left")
    return result.withColumn("batch_month", month_of(batch)).orderBy(batch)


def primary_model(columns: Sequence[str], prefer: str | None = None) -> str:
    if prefer and any(c.endswith(f"_{prefer}") for c in columns):
        return prefer
    return "xgb" if any(c.endswith("_xgb") for c in columns) else "lr"


def primary_metrics(trend_rows: DataFrame, prefer: str | None = None, batch: str = "batch_ts") -> DataFrame:
    """AUC and rate of the primary model with its fallbacks, for the two monitoring lines."""
    have = trend_rows.columns
    first = primary_model(have, prefer)
    other = "lr" if first == "xgb" else "xgb"

    def pick(*names: str):
        found = [F.col(n) for n in names if n in have]
        return F.coalesce(*found) if found else F.lit(None).cast("double")
    return trend_rows.select(
        batch,
        F.lit(first).alias("primary_model"),
        pick(f"auc_{first}", f"auc_{other}").alias("auc"),
        pick(f"pos_rate_{first}", f"pos_rate_{other}", f"mean_proba_{first}").alias("rate"),
    )


def enough_points(primary: DataFrame, least: int = 2) -> DataFrame:
    """The lines, or no rows when either has fewer than ``least`` points; a window over the few batches."""
    every = Window.partitionBy(F.lit(0))
    enough = F.least(F.count("auc").over(every), F.count("rate").over(every)) >= least
    return primary.withColumn("_enough", enough).where("_enough").drop("_enough")
