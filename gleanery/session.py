"""Session settings, the shared work folder and lineage cuts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot key's join partition even where that costs one more shuffle
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # texts and pages are large rows: bound an Arrow batch by rows and by bytes
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": "64m",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # an object store or an unreliable executor must never publish half a task
    "spark.hadoop.mapreduce.fileoutputcommitter.algorithm.version": "1",
}


def build_session(master: str | None = None, app: str = "gleanery", **extra) -> SparkSession:
    """A session with the settings above; on a cluster `master` stays unset."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, str(value))
    return builder.getOrCreate()


def bound_batches(spark: SparkSession) -> None:
    """Give the session's Arrow batches the bound of rows above, unless it has a lower one.

    For stages that also run in sessions not built here: a batch of Spark's own 10,000 texts is
    held several times over, in the executor's JVM and in each of its Python workers.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= int(SETTINGS[key]):
        spark.conf.set(key, SETTINGS[key])


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh path in the shared folder that `spark.checkpoint.dir` names.

    A machine-local folder is only ever used by a local master, where driver
    and executors are one process.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="gleanery-")
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame, purpose: str = "stage") -> DataFrame:
    """Write the frame to the shared folder and read it back.

    Used where several outputs hang on one expensive or Python-backed stage:
    the stage runs once and a lost executor re-reads files instead of
    recomputing it.
    """
    path = work_folder(df.sparkSession, purpose)
    df.write.mode("errorifexists").parquet(path)
    cut = df.sparkSession.read.schema(df.schema).parquet(path)
    cut.work_path = path
    return cut


def drop_work(*frames: DataFrame) -> None:
    """Remove the files behind frames of `cut_lineage`, once nothing reads them any more."""
    for df in frames:
        spark, path = df.sparkSession, df.work_path
        jvm = spark._jvm
        place = jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(place, True)
