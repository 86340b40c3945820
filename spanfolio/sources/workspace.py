"""The shared folder that holds written intermediate tables."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def workspace(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``, else the one the context checkpoints to.

    Where neither is set a temporary folder is made, but only in local mode: on a
    cluster no executor could read a folder of the driver's machine.
    """
    context = spark.sparkContext
    folder = spark.conf.get(CHECKPOINT_CONF, None) or context.getCheckpointDir()
    if folder:
        return folder
    if context.master != "local" and not context.master.startswith("local["):
        raise ValueError(f"set {CHECKPOINT_CONF} to a folder every executor can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="spanfolio-"))
    return context.getCheckpointDir()


def run_folder(spark: SparkSession) -> str:
    """The folder in the workspace that holds all tables of this application."""
    return f"{workspace(spark).rstrip('/')}/tables-{spark.sparkContext.applicationId}"


def new_path(spark: SparkSession, label: str) -> str:
    return f"{run_folder(spark)}/{label}-{uuid.uuid4().hex}"


def drop_tables(spark: SparkSession) -> None:
    """Delete the tables of this application. For the caller, when no result that reads them is needed any more."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(run_folder(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def discard(*tables: DataFrame) -> None:
    """Delete written tables that no plan reads any more, one that ``materialise`` returned each.

    Also has the driver collect its garbage: Spark deletes the shuffle files of finished
    jobs only then, and by itself a driver may go on for half an hour.
    """
    for table in tables:
        spark = table.sparkSession
        files = table.inputFiles()
        if not files:
            continue
        folder = files[0].rsplit("/", 1)[0]
        if f"/tables-{spark.sparkContext.applicationId}/" not in folder:
            raise ValueError(f"not a table of this application: {folder}")
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    if tables:
        gc.collect()
        tables[0].sparkSession.sparkContext._jvm.System.gc()


def materialise(df: DataFrame, label: str = "table") -> DataFrame:
    """Write ``df`` once as parquet and return a scan of it.

    Used where several branches of one plan read the same expensive input. The
    scan survives lost executors, and its file sizes are what the optimizer
    compares with the broadcast threshold, so no join side needs a hint.
    """
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
