"""Layer tables, previews, scores and metrics.

Layer tables are partitioned by month and overwritten partition by partition, so a rerun of a
month replaces exactly that month, also when it has no rows any more. The rebalance hint lets AQE size the files of every month:
it splits a month that is far bigger than the others and merges small ones.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from creditmart import constants as K
from creditmart.operators.projection import top_rows


def _folders(spark: SparkSession, path: str, by: str, values: Sequence[str]) -> list[str]:
    """Folders of the given values of the first partition column that exist."""
    name = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    found = []
    for value in values:
        place = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{by}={name(value)}")
        if place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
            found.append(f"{path}/{by}={name(value)}")
    return found


def _table_files(spark: SparkSession, path: str, schema: StructType, form: str, by: str, values: Sequence[str] | None) -> dict[str, set[str]]:
    """Files of a table by partition folder; empty if there is no table yet.

    With ``values`` of the first partition column only their folders are listed.
    """
    try:
        reader = spark.read.schema(schema).format(form)
        if values:
            folders = _folders(spark, path, by, values)
            files = reader.option("basePath", path).load(folders).inputFiles() if folders else []
        else:
            files = reader.load(path).inputFiles()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return {}
    found: dict[str, set[str]] = {}
    for name in map(unquote, files):
        found.setdefault(name.rpartition("/")[0], set()).add(name)
    return found


def remove_folder(spark: SparkSession, folder: str) -> None:
    """Delete a folder in whatever store it is."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a query that runs inside go when it ends, not when the driver's memory is next cleared.

    For writes: their plan runs once, so nothing reads the files again.
    """
    before = spark.conf.get(CLEAN_UP)
    spark.conf.set(CLEAN_UP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEAN_UP, before)


def write_months(df: DataFrame, path: str, by: Sequence[str] = ("snap_ym",), form: str = "parquet",
                 rebalance: bool = True, months: Sequence[str] | None = None, only: Sequence[str] | None = None) -> dict:
    """Overwrite the partitions of ``df`` in a table and return a small log entry.

    ``months`` names the values of the first partition column that the frame stands for (none: all). Of these,
    partitions that the frame has no rows for are removed, so that an emptied month does not keep
    its old rows; without ``months`` other partitions are left alone. ``only`` names all values that the
    frame can hold, where the caller knows them. Where values are named, no other folder is listed. The rows are
    counted in the written table, from the file footers, so the plan of ``df`` runs once.
    """
    spark = df.sparkSession
    named = months or only
    before = _table_files(spark, path, df.schema, form, by[0], named)
    rows = df.hint("rebalance", *[F.col(c) for c in by]) if rebalance else df
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by)
    if form == "csv":
        writer = writer.option("header", True)
    if form == "parquet":
        writer = writer.option("compression", "zstd")
    with shuffles_dropped(spark):
        writer.format(form).save(path)
    after = _table_files(spark, path, df.schema, form, by[0], named)
    written = [folder for folder, files in after.items() if files != before.get(folder)]
    if months is not None:
        meant = {f"{by[0]}={month}" for month in months}
        for folder in after.keys() - set(written):
            if not meant or meant & set(folder.split("/")):
                remove_folder(spark, folder)
    stored = 0
    if written:
        stored = spark.read.schema(df.schema).option("basePath", path).format(form).load(written).count()
    return {"path": path, "rows": stored, "cols": len(df.columns)}


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_preview(df: DataFrame, path: str, order: str = "n_rows", rows: int = K.PREVIEW_ROWS) -> None:
    """The top rows as one CSV file; a fixed number of rows, so one task is fine."""
    write_csv(top_rows(df, [F.desc(order)], rows).coalesce(1), path)


def write_scores(df: DataFrame, path: str, batch_ts: str) -> dict:
    """One scored batch as a partition; scoring the same batch again replaces it."""
    batch = df.withColumn("batch_ts", F.lit(batch_ts).cast("timestamp"))
    stamp = df.sparkSession.range(1).select(F.lit(batch_ts).cast("timestamp").cast("string")).first()[0]
    return write_months(batch, path, by=["batch_ts"], only=[stamp])


def write_predictions(df: DataFrame, path: str) -> dict:
    return write_months(df, path, by=["model_name", "snapshot_date"])


def write_metrics(df: DataFrame, path: str, forms: Sequence[str] = ("parquet",)) -> None:
    """A small metrics table in one or more formats, each in its own folder.

    The plan of ``df`` runs once; the other formats are written from the first one's files.
    """
    for number, form in enumerate(forms):
        rows = df if number == 0 else df.sparkSession.read.schema(df.schema).format(forms[0]).load(f"{path}/{forms[0]}")
        writer = rows.coalesce(1).write.mode("overwrite")
        if form == "csv":
            writer = writer.option("header", True)
        writer.format(form).save(f"{path}/{form}")
