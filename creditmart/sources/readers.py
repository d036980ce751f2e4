"""Raw files, layer tables, scored batches and labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from creditmart import constants as K
from creditmart.functions.dates import first_of_month
from creditmart.operators.projection import rename_customer


def text_schema(columns: Sequence[str]) -> StructType:
    return StructType([StructField(name, StringType()) for name in columns])


def raw_reader(spark: SparkSession, quoted: bool = False, schema: StructType | None = None,
               streaming: bool = False):
    """CSV reader that keeps every value as text.

    ``quoted`` reads fields with line breaks inside quotes. Spark cannot split such files, so a
    data set of that kind should come as many files.
    """
    reader = (spark.readStream if streaming else spark.read).option("header", True).option("inferSchema", False)
    if schema is not None:
        reader = reader.schema(schema)
    if quoted:
        reader = (reader.option("mode", "PERMISSIVE").option("quote", '"').option("escape", '"')
                  .option("multiLine", True))
    return reader


def found(spark: SparkSession, pattern: str) -> bool:
    """Does any file or folder match a path pattern, in whatever store it is?"""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    hits = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return hits is not None and len(hits) > 0


def source_path(spark: SparkSession, folder: str, dataset: str, streaming: bool = False) -> str | None:
    """Pattern of the first known name of a data set that exists, or None.

    A name stands for ``name.csv`` or a folder ``name``; for streams also for numbered parts
    ``name_1.csv``, which arrive one by one (and need not be there yet).
    """
    end = "{,.csv,_[0-9]*.csv}" if streaming else "{,.csv}"
    names = K.SOURCE_NAMES[dataset]
    for name in names:
        if found(spark, f"{folder}/{name}{end}"):
            return f"{folder}/{name}{end}"
    return f"{folder}/{names[0]}{end}" if streaming else None


def read_raw(spark: SparkSession, folder: str, dataset: str, schema: StructType | None = None,
             streaming: bool = False) -> DataFrame | None:
    """One raw data set of a folder under its first known name, None if there is none."""
    path = source_path(spark, folder, dataset, streaming)
    return None if path is None else raw_reader(spark, dataset in K.MULTI_LINE, schema, streaming).csv(path)


def explore_csv(spark: SparkSession, path: str) -> DataFrame:
    """CSV with guessed types, for looking around; jobs read text and cast."""
    return spark.read.csv(path, header=True, inferSchema=True)


def read_table(spark: SparkSession, path: str, form: str = "parquet") -> DataFrame:
    """A layer table with all its months."""
    if form == "csv":
        return spark.read.option("header", True).csv(path)
    return spark.read.format(form).load(path)


def read_month(spark: SparkSession, path: str, month: str, form: str = "parquet") -> DataFrame:
    """One 'yyyy-MM' month of a layer table; only that partition is listed and read."""
    return read_table(spark, path, form).where(F.col("snap_ym") == month)


def read_any(spark: SparkSession, path: str) -> DataFrame:
    """Parquet for folders and the endings .parquet and .pq, CSV for everything else."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder = where.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(where).isDirectory()
    if path.lower().endswith((".parquet", ".pq")) or folder and not path.lower().endswith(".csv"):
        return spark.read.parquet(path)
    return explore_csv(spark, path)


def read_mixed(spark: SparkSession, path: str, change=lambda df: df) -> DataFrame:
    """All Parquet and CSV files below a path in one frame.

    ``change`` is applied to each format's frame. Columns are matched by name; those of the CSV
    files take the types of the Parquet files, null where a value cannot.
    """
    frames = []
    for form, ending in (("parquet", "*.parquet"), ("csv", "*.csv")):
        files = spark.read.format("binaryFile").option("pathGlobFilter", ending).load(path).inputFiles()
        if files:
            reader = spark.read.option("pathGlobFilter", ending)
            frames.append(change(reader.parquet(path) if form == "parquet" else reader.csv(path, header=True, inferSchema=True)))
    if not frames:
        return change(spark.read.parquet(path))
    if len(frames) == 1:
        return frames[0]
    types = dict(frames[0].dtypes)
    text = frames[1].select(*[
        F.col(c).cast("string").try_cast(types[c]).alias(c) if c in types and types[c] != kind else F.col(c)
        for c, kind in frames[1].dtypes])
    return frames[0].unionByName(text, allowMissingColumns=True)


def normalise_labels(labels: DataFrame) -> DataFrame:
    """Customer header, date and label types in the shape the monitor joins on."""
    labels = rename_customer(labels) if "customer_id" not in labels.columns else labels
    casts = {}
    if "snapshot_date" in labels.columns:
        casts["snapshot_date"] = F.col("snapshot_date").try_cast("timestamp").cast("date")
    if "label" in labels.columns:
        casts["label"] = F.col("label").try_cast("double").cast("bigint")
    return labels.withColumns(casts)


def read_labels(spark: SparkSession, path: str, form: str | None = None) -> DataFrame:
    """Labels of one format, or without ``form`` of all Parquet and CSV files there."""
    if form is None:
        return read_mixed(spark, path, normalise_labels)
    return normalise_labels(read_table(spark, path, form))


def with_batch_time(df: DataFrame) -> DataFrame:
    """Adds ``batch_ts`` from the file name, else from the file's modification time."""
    stamp = F.regexp_extract(F.col("_metadata.file_path"), K.SCORE_NAME_PATTERN, 1)
    named = F.try_to_timestamp(stamp, F.lit(K.SCORE_NAME_FORMAT))
    return df.withColumn("batch_ts", F.coalesce(named, F.col("_metadata.file_modification_time")))


def read_scored(spark: SparkSession, path: str, form: str | None = None, files: bool = False) -> DataFrame:
    """All scored batches with their time; a table partitioned by ``batch_ts`` has it already.

    Without ``form`` Parquet and CSV batches are read together. With ``files`` the rows also carry
    ``_file`` and ``_changed``, the file they come from and when it was last written.
    """
    def timed(scored: DataFrame) -> DataFrame:
        if files:
            scored = scored.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_modification_time").alias("_changed"),
                                   *([] if "batch_ts" in scored.columns else [F.col("_metadata")]))
        return scored if "batch_ts" in scored.columns else with_batch_time(scored).drop("_metadata")
    return read_mixed(spark, path, timed) if form is None else timed(read_table(spark, path, form))


def months_in(df: DataFrame, column: str = "snapshot_date") -> DataFrame:
    """Months that occur in a frame."""
    return df.select(first_of_month(column).alias("month")).distinct().orderBy("month")
