"""Datasets, vocabularies, CSV exchange files and runs on shared storage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagmill.functions.text import file_extension, has_media_extension
from tagmill.schemas import DATASET, VOCABULARY, WIDE_TAGS
from tagmill.sources.listing import list_tree

DEFAULT_IMAGE_SIZE = (224, 224)


def list_media(spark: SparkSession, root: str, include_videos: bool = False) -> DataFrame:
    """``image, length, modified`` of the files below ``root`` with an allowed extension; contents are not read."""
    listed = list_tree(spark, root).withColumnRenamed("path", "image")
    return listed.where((file_extension(F.col("image")) != "") & has_media_extension(F.col("image"), include_videos))


class DatasetContractError(ValueError):
    """A dataset that training must not start on."""


def check_dataset(df: DataFrame) -> DataFrame:
    """Fail before any job if a column is missing or has another type (nullability aside)."""
    actual = {f.name: f.dataType for f in df.schema.fields}
    wrong = []
    for field in DATASET.fields:
        found = actual.get(field.name)
        if found is None:
            wrong.append(f"{field.name} is missing")
        elif found.simpleString() != field.dataType.simpleString():
            wrong.append(f"{field.name} is {found.simpleString()}, not {field.dataType.simpleString()}")
    if wrong:
        raise DatasetContractError("; ".join(wrong))
    return df.select(*DATASET.fieldNames())


def read_dataset(spark: SparkSession, path: str) -> DataFrame:
    return check_dataset(spark.read.parquet(path))


def image_size(spark: SparkSession, metadata_path: str | None) -> tuple[int, int]:
    """(width, height) from the run's metadata row, the default without one."""
    if metadata_path is None:
        return DEFAULT_IMAGE_SIZE
    schema = T.StructType([T.StructField("width", T.IntegerType()), T.StructField("height", T.IntegerType()), T.StructField("images_embedded", T.BooleanType())])
    row = spark.read.schema(schema).json(metadata_path).first()
    if row is None or not row["images_embedded"]:
        raise DatasetContractError("the metadata does not state embedded images")
    return (row["width"] or DEFAULT_IMAGE_SIZE[0], row["height"] or DEFAULT_IMAGE_SIZE[1])


def write_wide_csv(wide: DataFrame, path: str) -> None:
    wide.write.mode("errorifexists").option("header", True).csv(path)


def read_wide_csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(WIDE_TAGS).option("header", True).csv(path)


def write_vocabulary(vocab: DataFrame, path: str) -> None:
    vocab.write.mode("errorifexists").parquet(path)


def read_vocabulary(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(VOCABULARY).parquet(path)


def latest_run(runs: DataFrame, order: str = "run_ts") -> DataFrame:
    """The rows of the newest run."""
    return runs.where(F.col(order) == runs.agg(F.max(order)).scalar())


def read_latest_run(spark: SparkSession, root: str) -> DataFrame:
    """The newest ``run_ts=`` partition below ``root``; the other partitions are pruned."""
    runs = spark.read.parquet(root)
    newest = spark.read.parquet(root).select(F.max("run_ts")).scalar()
    return runs.where(F.col("run_ts") == newest)


def newest_path(listing: DataFrame, path: Column | None = None) -> DataFrame:
    """The most recently modified path of a listing."""
    return listing.agg(F.max_by(path if path is not None else F.col("image"), "modified").alias("path"))
