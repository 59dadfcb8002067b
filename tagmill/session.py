"""Session settings and the shared scratch space used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs expect; on a cluster these usually come from spark-submit."""
    builder = SparkSession.builder.appName("tagmill")
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # The adaptive planner may hash a join side whose partitions it has measured below this, and sorts otherwise.
        "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # Stream state (seen ids, open windows) may outgrow the executor's heap.
        "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.ui.enabled": "false",
    }
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a single-host session that names none gets a temporary folder; a cluster without a shared folder is an
    error, since a machine-local path would be lost with its executor.
    """
    context = spark.sparkContext
    configured = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    current = context._jsc.sc().getCheckpointDir()
    if configured:
        if not current.isDefined():
            context.setCheckpointDir(configured)
        return configured
    if current.isDefined():
        return current.get()
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="tagmill-"))
    return context._jsc.sc().getCheckpointDir().get()


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends there, and every branch sees the same rows.

    Parquet rather than an RDD checkpoint, because the passes that follow read few of the columns and the planner
    learns the true size. The folder is scratch space and is emptied by its owner.
    """
    path = scratch_path(df.sparkSession, "cut")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


#: Rows that one task takes, about, where rows cost much time or memory: compact files hold many in a split.
TASK_ROWS = 1 << 17


def tasks_for(spark: SparkSession, rows: int) -> int:
    """How many tasks share ``rows``: one a core at least, and so many that none takes more than about TASK_ROWS."""
    return max(spark.sparkContext.defaultParallelism, -(-rows // TASK_ROWS))


def spread(df: DataFrame, key: str) -> DataFrame:
    """Hash-partition a scan that has fewer splits than the session has cores, as one small file does, or than its rows need.

    What a task takes then does not grow with the table. Splits are dealt by bytes, which say little about a compact file's rows.
    """
    tasks = tasks_for(df.sparkSession, df.count())
    return df.repartition(tasks, key) if df.rdd.getNumPartitions() < tasks else df
