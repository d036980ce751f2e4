"""Data mart, scoring and monitoring jobs over a table root.

Every layer is one table partitioned by month. A job reads the months it is asked for (all by
default), builds them in one plan and overwrites just their partitions, so running it again
gives the same tables.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditmart import constants as K
from creditmart.operators.entity_stats import busiest_entities, entity_stats
from creditmart.operators.metrics import compare_models, melt_models, metric_grid, ranking_metrics, score_curve
from creditmart.operators.modeling import (
    Features,
    fit_boosted,
    fit_logistic,
    pick_threshold,
    prepare,
    score,
    score_months,
    search,
    tuned_thresholds,
)
from creditmart.operators.monitoring import MODELS, batch_counts, batch_sums, join_labels, trend, trend_of_state
from creditmart.operators.profile import count_rows, rows_per_snapshot
from creditmart.operators.projection import ensure_columns, prefixed
from creditmart.operators.splits import split_summary, stratified_split, time_split, training_split, window_months
from creditmart.plans import layers
from creditmart.sources.readers import found, read_labels, read_raw, read_scored, read_table
from creditmart.sources.writers import (
    write_csv,
    write_metrics,
    write_months,
    write_predictions,
    write_scores,
)

DATASETS = ("loan_daily", "clickstream", "attributes", "financials")


@dataclass(frozen=True)
class Mart:
    """Tables of one mart under a common root."""

    spark: SparkSession
    root: str
    months: tuple[str, ...] = field(default=())

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def read(self, table: str, months: Sequence[str] | None = None) -> DataFrame:
        df = read_table(self.spark, self.path(table))
        wanted = tuple(months if months is not None else self.months)
        return df.where(F.col("snap_ym").isin(*wanted)) if wanted else df

    def all_months(self, table: str) -> DataFrame:
        return read_table(self.spark, self.path(table))

    def has(self, table: str) -> bool:
        return found(self.spark, self.path(table))

    def write(self, df: DataFrame, table: str) -> dict:
        return write_months(df, self.path(table), months=self.months)


# ---- layers -----------------------------------------------------------------------------

def build_bronze(mart: Mart, raw_dir: str, run_date: str, datasets: Sequence[str] = DATASETS) -> list[dict]:
    """All months of the raw data sets in one pass per data set."""
    log = []
    for name in datasets:
        raw = read_raw(mart.spark, raw_dir, name)
        if raw is None:
            log.append({"path": mart.path(f"bronze/{name}"), "rows": 0, "cols": 0, "skipped": "no source"})
            continue
        log.append(mart.write(layers.bronze(raw, run_date, mart.months), f"bronze/{name}"))
    return log


def build_bronze_loans(mart: Mart, raw_dir: str, run_date: str) -> dict:
    """Bronze of the loan file only, for the label-store build."""
    return build_bronze(mart, raw_dir, run_date, ["loan_daily"])[0]


_SILVER: dict[str, Callable[[DataFrame], DataFrame]] = {
    "loan_daily": layers.silver_loans,
    "attributes": layers.silver_attributes,
    "clickstream": layers.silver_clickstream,
    "financials": layers.silver_financials,
}


def build_silver(mart: Mart, datasets: Sequence[str] = DATASETS) -> list[dict]:
    """Silver of the data sets that are in bronze."""
    return [mart.write(_SILVER[name](mart.read(f"bronze/{name}")), f"silver/{name}")
            for name in datasets if mart.has(f"bronze/{name}")]


def build_gold_features(mart: Mart) -> list[dict]:
    """Feature and wide tables of financials and attributes."""
    log = []
    for name, build in (("financials", layers.gold_financials), ("attributes", layers.gold_attributes)):
        if not mart.has(f"silver/{name}"):
            continue
        features, wide = build(mart.read(f"silver/{name}"))
        stored = mart.write(wide, f"gold/{name}_wide")
        # The feature table is some columns of the wide one, which is there now: nothing is computed twice.
        chosen = mart.read(f"gold/{name}_wide").select(*features.columns)
        log += [mart.write(chosen, f"gold/{name}_features"), stored]
    return log


def build_labels(mart: Mart, dpd: int = K.DEFAULT_DPD, mob: int = K.DEFAULT_MOB) -> dict:
    labels = layers.gold_labels(mart.read("silver/loan_daily"), dpd, mob, keep=["snap_ym"])
    return mart.write(labels, "gold/label_store")


def build_model_dataset(mart: Mart, exact: bool = False) -> dict:
    """Model dataset of the mart's months; as-of reads the feature history up to the last of them."""
    labels = mart.read("gold/label_store")
    if exact:
        built = layers.gold_model_dataset_exact(
            labels, mart.read("gold/financials_features").drop("snap_ym"), mart.read("gold/attributes_features"))
        built = built.withColumn("snap_ym", F.date_format("snapshot_date", "yyyy-MM"))
    else:
        history = [mart.all_months(t) for t in ("gold/financials_features", "gold/attributes_features") if mart.has(t)]
        if mart.months:
            history = [h.where(F.col("snap_ym") <= max(mart.months)) for h in history]
        built = layers.gold_model_dataset(labels, history, keep=["snap_ym"])
    return mart.write(built, "gold/model_dataset")


def build_mart(spark: SparkSession, root: str, raw_dir: str, run_date: str, months: Sequence[str] = (),
               skip_bronze: bool = False, skip_clickstream: bool = False,
               dpd: int = K.DEFAULT_DPD, mob: int = K.DEFAULT_MOB) -> list[dict]:
    """Back-fill of bronze, silver and gold for a set of months (all by default)."""
    mart = Mart(spark, root, tuple(months))
    datasets = [name for name in DATASETS if not (skip_clickstream and name == "clickstream")]
    log = [] if skip_bronze else build_bronze(mart, raw_dir, run_date, datasets)
    log += build_silver(mart, datasets)
    log += build_gold_features(mart)
    log += [build_labels(mart, dpd, mob), build_model_dataset(mart)]
    return log


def build_label_store(spark: SparkSession, root: str, raw_dir: str, run_date: str, months: Sequence[str] = (),
                      dpd: int = K.DEFAULT_DPD, mob: int = K.DEFAULT_MOB) -> list[dict]:
    """Label store only: loans through bronze and silver."""
    mart = Mart(spark, root, tuple(months))
    return [build_bronze_loans(mart, raw_dir, run_date), *build_silver(mart, ["loan_daily"]),
            build_labels(mart, dpd, mob)]


def build_customer_clickstream(mart: Mart, table: str = "silver/customer_clickstream") -> None:
    """Per-customer clickstream statistics with a preview of the busiest customers."""
    stats = entity_stats(mart.read("bronze/clickstream"))
    stats.write.mode("overwrite").parquet(mart.path(table))
    write_csv(busiest_entities(mart.all_months(table)).coalesce(1), mart.path(f"{table}_preview"))


def check_mart(mart: Mart) -> tuple[DataFrame, DataFrame]:
    """Row count and rows per snapshot of the model dataset."""
    df = layers.check_model_dataset(mart.all_months("gold/model_dataset"))
    return count_rows(df), rows_per_snapshot(df)


# ---- training ---------------------------------------------------------------------------

def train_models(df: DataFrame, out: str, dates=K.SPLIT_DATES, models: Sequence[str] = ("lr", "xgb"),
                 max_trees: int = K.MAX_TREES, exact: bool = True) -> DataFrame:
    """Train on time splits, store pipelines and metrics, return the model comparison.

    ``df`` is the gold model dataset. Both models are refitted on train and validation rows; the
    metric grid has every split at the default and at the tuned threshold.
    """
    features = Features.of(df.drop("snap_ym"))
    parts = time_split(df, dates)
    train, valid = (parts.where(F.col("split") == name).drop("split") for name in ("Train", "Valid"))
    whole = train.unionByName(valid)
    prep = prepare(whole, features, exact)
    fitted: dict[str, PipelineModel] = {}
    if "lr" in models:
        fitted["lr"] = fit_logistic(whole, features, prep=prep)
    if "xgb" in models:
        fitted["xgb"] = fit_boosted(train, valid, features, max_trees, exact, prep=prep)
    for name, model in fitted.items():
        model.write().overwrite().save(f"{out}/models/{name}")

    scored = score(parts, {n: (m, K.DEFAULT_THRESHOLD) for n, m in fitted.items()}, ["split", "label"])
    long = melt_models(scored, {n: f"proba_{n}" for n in fitted}, ["split", "label"])
    write_metrics(metric_grid(long), f"{out}/metrics", ("parquet", "csv"))
    grid = df.sparkSession.read.parquet(f"{out}/metrics/parquet")
    comparison = compare_models(grid)
    write_metrics(comparison, f"{out}/comparison", ("json",))
    tuned = {r["model"]: r["tuned_threshold"] for r in tuned_thresholds(grid).collect()}  # one row per model
    types = dict(df.dtypes)
    for name in fitted:
        write_card(df.sparkSession, f"{out}/models/{name}", name, tuned.get(name),
                   {c: types[c] for c in (*features.numeric, *features.category)})
    return comparison


CARD = "model string, threshold double, columns array<string>, types array<string>"


def write_card(spark: SparkSession, path: str, name: str, threshold: float | None, columns: dict[str, str]) -> None:
    """One row beside a stored pipeline: its tuned threshold and the columns it was fitted on."""
    row = spark.createDataFrame([(name, threshold, list(columns), list(columns.values()))], CARD)
    write_metrics(row, f"{path}_card")


def read_card(spark: SparkSession, path: str) -> tuple[float | None, dict[str, str]]:
    """Threshold and columns with types of a stored pipeline; nothing if it has no card."""
    if not found(spark, f"{path}_card/parquet"):
        return None, {}
    row = spark.read.schema(CARD).parquet(f"{path}_card/parquet").first()
    return row["threshold"], dict(zip(row["columns"], row["types"]))


def train_rolling(df: DataFrame, out: str, first_run: str, last_run: str, mode: str = "month",
                  models: Sequence[str] = ("lr", "xgb"), max_trees: int = K.MAX_TREES, exact: bool = True) -> DataFrame:
    """One training run per run month on its own windows; returns the comparison by run and model.

    Each run is stored under its month; the metrics of all runs are compared in one query.
    """
    spark = df.sparkSession
    windows = window_months(spark, first_run, last_run, mode)
    spans = windows.groupBy("run_month", "split").agg(
        F.min("month").alias("start"), F.last_day(F.max("month")).alias("end")).orderBy("run_month").collect()  # a few per month
    runs: dict[str, dict[str, tuple[str, str]]] = {}
    for r in spans:
        runs.setdefault(str(r["run_month"]), {})[r["split"]] = (str(r["start"]), str(r["end"]))
    for run, dates in runs.items():
        train_models(df, f"{out}/run_month={run}", dates, models, max_trees, exact)
    grids = [spark.read.parquet(f"{out}/run_month={run}/metrics/parquet").withColumn("run_month", F.lit(run).cast("date"))
             for run in runs]
    return compare_models(reduce(DataFrame.unionByName, grids), ["run_month"])


def with_clickstream(labels: DataFrame, features: DataFrame) -> DataFrame:
    """Labels with the clickstream features of the same customer and snapshot."""
    keys = ["Customer_ID", "snapshot_date"]
    return labels.join(features.select(*keys, *prefixed(features, "fe_")), keys, "left")


def train_clickstream_model(labels: DataFrame, features: DataFrame, train_date: str, out: str,
                            draws: int = K.SEARCH_DRAWS, folds: int = K.SEARCH_FOLDS, scoring: str = "hard",
                            months: int = 12, oot_months: int = 2) -> DataFrame:
    """Search a boosted model on clickstream features; returns AUC and Gini per part.

    Rows before the out-of-time span are split 80/20 within each label.
    """
    keys = ["Customer_ID", "snapshot_date"]
    parts = training_split(with_clickstream(labels, features), train_date, train_test_months=months, oot_months=oot_months)
    inside = stratified_split(parts.where("split = 'train_test'"), ["loan_id", *keys])
    whole = inside.unionByName(parts.where("split = 'oot'").withColumn("part", F.lit("oot")))
    columns = prefixed(features, "fe_")
    model, _ = search(whole.where("part = 'train'"), columns, draws, folds, scoring)
    model.write().overwrite().save(f"{out}/models/clickstream")

    scored = score(whole, {"click": (model, K.DEFAULT_THRESHOLD)}, ["part", "label"])
    results = ranking_metrics(score_curve(scored, ["part"], "proba_click"), ["part"])
    sizes = split_summary(whole.drop("split").withColumnRenamed("part", "split")).withColumnRenamed("split", "part")
    write_metrics(sizes.join(results, "part", "left"), f"{out}/card")
    return labels.sparkSession.read.parquet(f"{out}/card/parquet")


# ---- scoring and monitoring -------------------------------------------------------------

def score_batch(df: DataFrame, model_dir: str, batch_ts: str, out: str, keep: Sequence[str] = (),
                models: Sequence[str] = ("lr", "xgb"), overrides: dict[str, float] | None = None,
                grid: DataFrame | None = None, expected: dict[str, str] | None = None) -> dict:
    """Score a batch with the stored models and append it by time.

    Threshold and expected columns come from the cards stored beside the models, unless they are
    given: an override counts before the tuned threshold of ``grid``, and that before the card's.
    """
    overrides = overrides or {}
    tuned = {} if grid is None else {
        r["model"]: r["tuned_threshold"] for r in tuned_thresholds(grid).collect()}  # one row per model
    cards = {name: read_card(df.sparkSession, f"{model_dir}/{name}") for name in models}
    if expected is None:
        expected = {c: kind for _, columns in cards.values() for c, kind in columns.items()}
    ids = [c for c in keep if c in df.columns]
    if expected:
        df = df.select(*ids, *[c for c in df.columns if c not in ids])
        filled = ensure_columns(df, {**{c: dict(df.dtypes)[c] for c in ids}, **expected})
    else:
        filled = df
    loaded = {
        name: (PipelineModel.load(f"{model_dir}/{name}"), pick_threshold(overrides.get(name), tuned.get(name), cards[name][0]))
        for name in models
    }
    return write_scores(score(filled, loaded, ids), out, batch_ts)


def monitor(spark: SparkSession, scored_path: str, labels_path: str | None, out: str,
            scored_form: str | None = None, min_points: int = 2, state: str | None = None, again: Sequence[str] = ()) -> DataFrame:
    """Metric trend over all scored batches, stored as Parquet and CSV.

    With fewer than ``min_points`` batches there is no trend and an error says so. With ``state``, a folder,
    what every batch contributes is kept there: only batches that are new, or whose files have
    changed, are read; ``again`` names the times of batches to read once more, e.g. after late labels.
    """
    if state is not None:
        update_metric_state(spark, scored_path, labels_path, state, scored_form, again)
        sums, counts = read_metric_state(spark, state)
        if sums.select("batch_ts").distinct().limit(min_points).count() < min_points:
            raise ValueError(f"a trend needs at least {min_points} scored batches in {scored_path}")
        models = [m for m in MODELS if sums.where(F.col("name") == f"proba_{m}").limit(1).count()]
        rows = trend_of_state(sums, counts, models)
    else:
        scored = read_scored(spark, scored_path, scored_form)
        if scored.select("batch_ts").distinct().limit(min_points).count() < min_points:
            raise ValueError(f"a trend needs at least {min_points} scored batches in {scored_path}")
        labels = read_labels(spark, labels_path) if labels_path else None
        rows = trend(scored, labels) if labels is not None else trend(scored.withColumn("label", F.lit(None).cast("int")))
    write_metrics(rows, out, ("parquet", "csv"))
    return spark.read.parquet(f"{out}/parquet")


def pending_batches(scored: DataFrame, seen: DataFrame | None, again: Sequence[str] = ()) -> list:
    """Times of the batches that ``seen`` does not know with the same files, from file names and times alone."""
    now = batch_files(scored)
    if seen is None:
        return sorted(r["batch_ts"] for r in now.select("batch_ts").collect())
    asked = F.col("batch_ts").cast("string").isin([str(t) for t in again])
    known = seen.groupBy("batch_ts").agg(F.max_by("files", "number").alias("files"))
    changed = now.join(known.withColumnRenamed("files", "_before"), "batch_ts", "left").where(
        F.col("_before").isNull() | (F.col("_before") != F.col("files")) | asked)
    return sorted(r["batch_ts"] for r in changed.select("batch_ts").collect())


def batch_files(scored: DataFrame) -> DataFrame:
    """(batch_ts, files): a hash of the names and times of each batch's files."""
    files = scored.select("batch_ts", "_file", "_changed").distinct()
    return files.groupBy("batch_ts").agg(F.sum(F.xxhash64("_file", "_changed").cast("decimal(38,0)")).cast("string").alias("files"))


def update_metric_state(spark: SparkSession, scored_path: str, labels_path: str | None, state: str,
                        scored_form: str | None = None, again: Sequence[str] = ()) -> list:
    """Bring new and changed batches into the state; returns their times.

    A run writes its own numbered part and then one line per batch that names it, so a run that
    ends midway leaves nothing that counts.
    """
    scored = read_scored(spark, scored_path, scored_form, files=True)
    seen = read_table(spark, f"{state}/batches") if found(spark, f"{state}/batches") else None
    pending = pending_batches(scored, seen, again)
    if not pending:
        return []
    number = 1 + (-1 if seen is None else seen.agg(F.max("number")).first()[0])
    fresh = scored.where(F.col("batch_ts").isin(pending))
    rows = fresh.drop("_file", "_changed")
    labels = read_labels(spark, labels_path) if labels_path else None
    joined = rows.withColumn("label", F.lit(None).cast("int")) if labels is None else join_labels(rows, labels)
    batch_sums(rows).write.mode("overwrite").parquet(f"{state}/sums/number={number}")
    counts = batch_counts(rows.withColumn("label", F.lit(None).cast("int")) if joined is None else joined)
    counts.write.mode("overwrite").parquet(f"{state}/counts/number={number}")
    batch_files(fresh).withColumn("number", F.lit(number)).coalesce(1).write.mode("append").parquet(f"{state}/batches")
    return pending


def read_metric_state(spark: SparkSession, state: str) -> tuple[DataFrame, DataFrame]:
    """Sums and score counts of every batch, each from the last run that read it."""
    last = read_table(spark, f"{state}/batches").groupBy("batch_ts").agg(F.max("number").alias("number"))

    def current(name: str) -> DataFrame:
        return read_table(spark, f"{state}/{name}").join(last, ["batch_ts", "number"], "left_semi").drop("number")
    return current("sums"), current("counts")


def predict_months(features: DataFrame, model_path: str, model_name: str, out: str,
                   first: str | None = None, last: str | None = None) -> dict:
    """Clickstream predictions of one month or a range, stored per model and month."""
    model = PipelineModel.load(model_path)
    return write_predictions(score_months(features, model, model_name, prefixed(features, "fe_"), first, last), out)

