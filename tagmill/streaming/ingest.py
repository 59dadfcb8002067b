"""Landed listing documents -> keep-latest item store."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tagmill.operators.catalog import upsert_latest
from tagmill.schemas import PAGE
from tagmill.streaming.sinks import read_epochs, write_epochs

STORE_ORDER = ("landed_at", "epoch", "page_pos")


def page_stream(spark: SparkSession, path: str, files_per_trigger: int = 100) -> DataFrame:
    """Items of pages as they land, with the landing time of their file."""
    pages = spark.readStream.schema(PAGE).option("maxFilesPerTrigger", files_per_trigger).json(path)
    rows = pages.select(
        F.posexplode("items").alias("page_pos", "i"), F.col("_metadata.file_modification_time").alias("landed_at")
    )
    return rows.select("i.*", "page_pos", "landed_at").withColumnRenamed("user", "user_name")


def ingest(spark: SparkSession, pages: str, store: str, checkpoint: str, files_per_trigger: int = 100, once: bool = True) -> StreamingQuery:
    """Append every landed version to the store. Nothing already stored is rewritten; readers take the latest."""
    return write_epochs(page_stream(spark, pages, files_per_trigger), store, checkpoint, once=once)


def _stored_schema() -> T.StructType:
    items = PAGE["items"].dataType.elementType
    fields = [T.StructField("user_name" if f.name == "user" else f.name, f.dataType) for f in items.fields]
    return T.StructType(
        fields + [T.StructField("page_pos", T.IntegerType()), T.StructField("landed_at", T.TimestampType()), T.StructField("epoch", T.LongType())]
    )


def read_store(spark: SparkSession, store: str) -> DataFrame:
    """The latest version of every item."""
    return upsert_latest(read_epochs(spark, store, _stored_schema()), STORE_ORDER)


def compact(spark: SparkSession, store: str, target: str) -> None:
    """Write the latest versions as a new store of one epoch, clustered by id."""
    latest = read_store(spark, store).drop("epoch")
    latest.repartitionByRange("id").sortWithinPartitions("id").write.mode("errorifexists").parquet(f"{target}/epoch=0")


def new_item_stream(stream: DataFrame, held: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Items neither held nor seen earlier in the stream (repeats within ``delay`` of landing are dropped)."""
    unseen = stream.withWatermark("landed_at", delay).dropDuplicatesWithinWatermark(["id"])
    return unseen.join(held.select("id").distinct(), "id", "left_anti")
