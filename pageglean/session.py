"""Session settings and the places where lineage is cut."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str = "pageglean", **extra: str) -> SparkSession:
    """Session with the settings the jobs expect; a cluster's own settings come from spark-submit."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.autoBroadcastJoinThreshold", "64m")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder for stored intermediate tables: the cluster's, or the one set on the session, or else one in the warehouse.

    The warehouse serves only where driver and executors share it: on one machine, or if it is not in a local file system.
    Elsewhere ``spark.checkpoint.dir`` has to be set, and it is an error if it is not.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
            if not context.master.startswith("local") and warehouse.startswith(("/", "file:")):
                raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
            folder = f"{warehouse}/_checkpoints"
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def materialize(df: DataFrame) -> DataFrame:
    """The same rows, stored in the shared folder, so that a lost executor loses nothing."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)
