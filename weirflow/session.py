"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


#: Settings every session of this library needs; all of them may change at run time.
SETTINGS = {
    # Telemetry clocks are UTC; text and timestamps must agree everywhere.
    "spark.sql.session.timeZone": "UTC",
    # Records are wide and rules many. Above 8000 bytes the JVM only interprets a generated
    # method; below this limit Spark uses its split, compilable form instead (10-30 times faster).
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # State of streams lives on disk, not on the heap; operators with timers need it.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def local_session(
    app: str = "weirflow", cores: str = "*", shuffle_partitions: int = 8, shared: str | None = None
) -> SparkSession:
    """Session for tests and the benchmark; on a cluster spark-submit brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        # Wide records mean many column expressions; do not record a call site for each.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", os.environ.get("WEIRFLOW_DRIVER_MEMORY", "8g"))
    )
    if shared:
        builder = builder.config("spark.checkpoint.dir", shared)
    return prepared(builder.getOrCreate())


def prepared(spark: SparkSession) -> SparkSession:
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, for written tables and stream checkpoints.

    The cluster names it in ``spark.checkpoint.dir``. Where neither that nor a checkpoint
    folder of the context is set, only a local master may use the machine's temporary folder.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="run-weirflow-"))
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder; never reused, so retries cannot collide."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def discard(spark: SparkSession, path: str) -> None:
    """Removes a table of this library that nothing reads any more; one that is gone already is no error."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
