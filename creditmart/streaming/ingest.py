"""Incremental monthly ingestion: new raw files flow through all layers.

Every raw data set is a file stream. A run takes all files that arrived since the last one
(``availableNow``) and ends; the stream checkpoint replaces a scheduler's catch-up. Bronze keeps
one partition per month and batch, so a batch that is repeated after a failure replaces its own
rows. The later layers are rebuilt for the months of all bronze parts that a log does not name as
processed yet. Bronze has a batch column here, so a root is filled either by this or by the batch job.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from creditmart import constants as K
from creditmart.plans import layers
from creditmart.plans.delta import forget_marks, save_marks, update_model_dataset
from creditmart.plans.jobs import (
    DATASETS,
    Mart,
    build_gold_features,
    build_labels,
    build_model_dataset,
    build_silver,
)
from creditmart.sources.readers import read_raw
from creditmart.sources.writers import write_months


def ingest_dataset(spark: SparkSession, root: str, raw_dir: str, dataset: str, schema: StructType,
                   checkpoint: str, run_date: str) -> None:
    """Bring all new files of one data set into bronze and wait for the end."""
    def store(batch: DataFrame, batch_id: int) -> None:
        rows = batch.withColumn("batch_id", F.lit(batch_id))
        write_months(rows, f"{root}/bronze/{dataset}", by=["snap_ym", "batch_id"])

    source = layers.bronze(read_raw(spark, raw_dir, dataset, schema, streaming=True), run_date)
    query = (source.writeStream.foreachBatch(store).option("checkpointLocation", f"{checkpoint}/{dataset}")
             .trigger(availableNow=True).start())
    query.awaitTermination()


PROCESSED = "log/processed"


def bronze_parts(spark: SparkSession, root: str, datasets: Sequence[str]) -> DataFrame:
    """(dataset, snap_ym, batch_id) of everything in bronze; partition values only."""
    parts = None
    for name in datasets:
        found = spark.read.parquet(f"{root}/bronze/{name}").select(
            F.lit(name).alias("dataset"), F.col("snap_ym").cast("string").alias("snap_ym"), F.col("batch_id").cast("long").alias("batch_id"))
        parts = found if parts is None else parts.unionByName(found)
    return parts.distinct()


def pending_parts(spark: SparkSession, root: str, datasets: Sequence[str]) -> DataFrame:
    """What is in bronze but has not been carried through all layers yet.

    The log of processed parts is written last, so a run that ends between two layers leaves its
    parts pending for the next one, whatever that one's date is.
    """
    parts = bronze_parts(spark, root, datasets)
    try:
        done = spark.read.parquet(f"{root}/{PROCESSED}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return parts
    return parts.join(done, ["dataset", "snap_ym", "batch_id"], "left_anti")


def ingest_available(spark: SparkSession, root: str, raw_dir: str, schemas: dict[str, StructType],
                     checkpoint: str, run_date: str, dpd: int = K.DEFAULT_DPD, mob: int = K.DEFAULT_MOB) -> list[dict]:
    """One incremental run over all data sets, then silver and gold of the months not yet carried through.

    Labels of later months look back at the features: those of them whose newest feature day has
    changed are joined anew (``plans/delta.py``).
    """
    for name, schema in schemas.items():
        ingest_dataset(spark, root, raw_dir, name, schema, checkpoint, run_date)
    return process_pending(spark, root, list(schemas), dpd, mob)


def process_pending(spark: SparkSession, root: str, datasets: Sequence[str] = DATASETS,
                    dpd: int = K.DEFAULT_DPD, mob: int = K.DEFAULT_MOB) -> list[dict]:
    """Silver and gold of all pending months; at most as many as the calendar has."""
    parts = pending_parts(spark, root, datasets)
    pending = parts.collect()  # one row per data set, month and batch
    months = sorted({row["snap_ym"] for row in pending})
    if not months:
        return []
    mart = Mart(spark, root, tuple(months))
    save_marks(mart, months)
    log = build_silver(mart, datasets) + build_gold_features(mart) + [build_labels(mart, dpd, mob), build_model_dataset(mart)]
    known = mart.all_months("gold/label_store").select(F.col("snap_ym").cast("string")).distinct().collect()
    later = sorted(r["snap_ym"] for r in known if r["snap_ym"] > months[0] and r["snap_ym"] not in months)
    if later:
        log += update_model_dataset(mart, months, later)
    spark.createDataFrame(pending, parts.schema).coalesce(1).write.mode("append").parquet(f"{root}/{PROCESSED}")
    forget_marks(mart)
    return log
