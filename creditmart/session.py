"""Session settings the jobs rely on."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Runtime SQL settings. None of them needs a restart, so they can be applied to a
# session somebody else made.
SQL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.legacy.timeParserPolicy": "CORRECTED",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Narrow rows compress well: 64 MB of them, the default, take gigabytes in one task's hash table or sort.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Chained joins on one key have no exchange between them; splitting a hot key is
    # worth the extra exchange it then needs.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # A sort-merge join streams both sides, so a hot key never has to fit a hash table.
    "spark.sql.join.preferSortMergeJoin": "true",
}


def apply_settings(spark: SparkSession) -> SparkSession:
    """Set the SQL options the operators assume and return the same session."""
    for key, value in SQL_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def build_session(app: str = "creditmart", master: str | None = None, **extra: str) -> SparkSession:
    """Session for scripts and tests; on a cluster the submitter's settings win."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return apply_settings(builder.getOrCreate())


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session without that
    setting (tests, benches) gets a folder of its own.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
        folder = tempfile.mkdtemp(prefix="creditmart-checkpoint-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return folder
