"""Helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from creditmart.session import checkpoint_dir

ROWS_PER_BATCH = 1000  # texts can be long; small Arrow batches bound a Python worker's memory


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def prepare(spark: SparkSession) -> SparkSession:
    """Bound the Arrow batches; no result depends on it."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS_PER_BATCH))
    return spark


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and go on from there."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def held_out(doc_id: str | Column = "doc_id") -> Column:
    """True for the quarter of ids that no model may learn from; an absent id counts as held out."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(column.cast("string").cast("binary")) % 4 == 2, F.lit(True))


def utf8(column: str = "text") -> Column:
    """The text's bytes, so that Python neither decodes nor encodes it."""
    return F.col(column).cast("binary")


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores added until no column of ``df`` has it in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def ship(spark: SparkSession, thing) -> Callable:
    """Broadcast a model of bounded size; the result, called in a task, gives it back.

    It travels as bytes that need no module of this package where they are read.
    """
    import pickle

    from pyspark import cloudpickle

    data = spark.sparkContext.broadcast(cloudpickle.dumps(thing))
    return lambda: pickle.loads(data.value)
