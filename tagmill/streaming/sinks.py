"""Idempotent epoch-partitioned sink shared by the streaming jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def write_epochs(stream: DataFrame, path: str, checkpoint: str, mode: str = "append", once: bool = True) -> StreamingQuery:
    """Write every micro-batch to its own ``epoch=`` directory.

    A batch that is retried after a failure overwrites its own directory, so each input counts once.
    """

    def save(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/epoch={epoch}")

    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(save)
    return (writer.trigger(availableNow=True) if once else writer).start()


def read_epochs(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).option("basePath", path).parquet(path)


def latest_by_key(epochs: DataFrame, keys: list[str]) -> DataFrame:
    """The newest row per key of an update-mode sink."""
    newest = Window.partitionBy(*keys).orderBy(F.desc("epoch"))
    return epochs.withColumn("_rn", F.row_number().over(newest)).where("_rn = 1").drop("_rn", "epoch")
