"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


# Settings the operators rely on; all of them can be changed in a running session.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A skewed join is split even where that costs one more exchange downstream.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session made elsewhere."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build_session(app: str = "fieldstay", master: str | None = None, **conf: str) -> SparkSession:
    """A session for the operators. On a cluster the master comes from the submit command."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        **RUNTIME_SETTINGS,
        # Recording the call site of every column expression doubles the time to build a query.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        "spark.ui.enabled": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local session without that setting (tests) falls back to a folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="fieldstay-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder; whatever is written there goes when the application ends."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    return path


def durable(df: DataFrame, **options: str) -> DataFrame:
    """Materialise ``df`` once in the shared folder, so that several readers share one computation
    and a lost executor costs a re-read, not a re-run. Columns, row order within a file and the row
    set are frozen from here on. ``options`` are the writer's, such as ``compression``.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "stage")
    df.write.options(**options).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._stage = path
    return out


def discard(*stages: DataFrame) -> None:
    """Delete the files of stages that nothing reads any more, as after a batch of a long-running stream."""
    for stage in stages:
        path = getattr(stage, "_stage", None)
        if path:
            hadoop = stage.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
            hadoop.getFileSystem(stage.sparkSession._jsc.hadoopConfiguration()).delete(hadoop, True)
