"""Upkeep of the model dataset after late features.

A feature row that appears, changes or goes at date d can matter only to labels of its customer
from d up to the customer's next known feature date. These labels are found from key columns
alone, only they are joined anew, and they replace their rows in the months they lie in; all
other rows of those months are copied as they are, all other months are left alone.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditmart.functions.cleaning import id_norm
from creditmart.functions.dates import iso_date
from creditmart.operators.asof import as_of_dates
from creditmart.operators.dedupe import row_hash
from creditmart.operators.projection import rename_customer
from creditmart.plans import layers
from creditmart.plans.jobs import Mart
from creditmart.session import checkpoint_dir
from creditmart.sources.readers import found, read_table
from creditmart.sources.writers import remove_folder, write_months

HISTORIES = ("gold/financials_features", "gold/attributes_features")
BEFORE = "log/before"


def feature_marks(mart: Mart, months: Sequence[str]) -> DataFrame | None:
    """(history, snap_ym, customer_id, feat_date, content) of the feature days in the given months."""
    parts = []
    for name in HISTORIES:
        if mart.has(name):
            rows = mart.all_months(name).where(F.col("snap_ym").isin(*months))
            dated = layers.dated_features(rows).withColumn("snap_ym", F.date_format("feat_date", "yyyy-MM"))
            content = F.struct(F.count(F.lit(1)), F.sum(row_hash(dated).cast("decimal(38,0)"))).cast("string")
            parts.append(dated.groupBy("snap_ym", "customer_id", "feat_date").agg(content.alias("content")).withColumn("history", F.lit(name)))
    return reduce(DataFrame.unionByName, parts) if parts else None


def save_marks(mart: Mart, months: Sequence[str]) -> None:
    """Keep the marks of months about to be rebuilt; those an unfinished run has kept stay as they are."""
    path = mart.path(BEFORE)
    kept = {r["month"] for r in read_table(mart.spark, path).select("month").distinct().collect()} if found(mart.spark, path) else set()
    fresh = [m for m in months if m not in kept]
    marks = feature_marks(mart, fresh) if fresh else None
    nothing = mart.spark.createDataFrame([(m,) for m in fresh], "month string")  # a month without features is kept too
    if fresh:
        rows = nothing if marks is None else nothing.join(marks.withColumn("month", F.col("snap_ym")), "month", "left")
        columns = {"history": "string", "customer_id": "string", "feat_date": "date", "content": "string"}
        rows.select("month", *[(F.col(c) if marks is not None else F.lit(None)).cast(kind).alias(c) for c, kind in columns.items()]).write.mode(
            "append").parquet(path)


def changed_marks(mart: Mart, months: Sequence[str]) -> DataFrame:
    """(history, customer_id, feat_date) of the feature days that differ from what ``save_marks`` kept."""
    keys = ["history", "customer_id", "feat_date"]
    before = read_table(mart.spark, mart.path(BEFORE)).where("customer_id is not null").select(*keys, "content")
    now = feature_marks(mart, months)
    both = before if now is None else before.unionByName(now.select(*keys, "content"))
    return both.groupBy(*keys, "content").agg(F.count(F.lit(1)).alias("n")).where("n = 1").select(*keys).distinct()


def affected_labels(labels: DataFrame, histories: dict[str, DataFrame], changed: DataFrame) -> DataFrame:
    """(customer_id, label_date) of the labels whose newest feature day, before or now, is a changed one.

    ``labels`` has these columns, a history customer_id and feat_date.
    """
    customers = changed.select("customer_id").distinct()
    base = labels.select("customer_id", "label_date").join(customers, "customer_id", "left_semi")
    known = [
        rows.select("customer_id", "feat_date").join(customers, "customer_id", "left_semi")
        .unionByName(changed.where(F.col("history") == name).select("customer_id", "feat_date"))
        for name, rows in histories.items()]
    dates = as_of_dates(base, known)
    marked = [
        dates.withColumnRenamed(f"_date_{place}", "feat_date").join(changed.where(F.col("history") == name), ["customer_id", "feat_date"], "left_semi")
        .select("customer_id", "label_date")
        for place, name in enumerate(histories)]
    return reduce(DataFrame.unionByName, marked).distinct()


def update_model_dataset(mart: Mart, months: Sequence[str], later: Sequence[str]) -> list[dict]:
    """Bring the labels of the ``later`` months up to date after the features of ``months`` were rebuilt.

    Returns one log entry, with the number of rows joined anew, or none if nothing is affected.
    """
    spark, table = mart.spark, "gold/model_dataset"
    checkpoint_dir(spark)
    changed = changed_marks(mart, months).checkpoint()
    labels = rename_customer(mart.all_months("gold/label_store").where(F.col("snap_ym").isin(*later)))
    keyed = labels.withColumns({"customer_id": id_norm("customer_id"), "label_date": iso_date("snapshot_date")})
    features = {name: mart.all_months(name).where(F.col("snap_ym") <= max(later)) for name in HISTORIES if mart.has(name)}
    if not features:
        return []
    affected = affected_labels(keyed, {n: layers.dated_features(f) for n, f in features.items()}, changed).checkpoint()
    hit = keyed.join(affected, ["customer_id", "label_date"], "left_semi")
    touched = sorted(str(r["snap_ym"]) for r in hit.select("snap_ym").distinct().collect())
    if not touched:
        return []
    ids = affected.select("customer_id").distinct()
    histories = [
        f.withColumn("_id", id_norm(_customer(f))).join(ids.withColumnRenamed("customer_id", "_id"), "_id", "left_semi").drop("_id")
        for f in features.values()]
    fresh = layers.gold_model_dataset(hit.drop("label_date"), histories, keep=["snap_ym"])
    stored = mart.all_months(table).where(F.col("snap_ym").isin(*touched)).withColumn("snap_ym", F.col("snap_ym").cast("string"))
    others = stored.join(affected.withColumnRenamed("label_date", "snapshot_date"), ["customer_id", "snapshot_date"], "left_anti")
    fresh = fresh.checkpoint()
    merged = others.unionByName(fresh.withColumn("snap_ym", F.col("snap_ym").cast("string")), allowMissingColumns=True)
    entry = write_months(merged.checkpoint(), mart.path(table), months=touched)
    return [{**entry, "joined": fresh.count()}]


def forget_marks(mart: Mart) -> None:
    remove_folder(mart.spark, mart.path(BEFORE))


def _customer(df: DataFrame) -> str:
    return next(c for c in df.columns if c.lower() == "customer_id")
