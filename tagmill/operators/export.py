"""Safe-only export, deterministic splits and the numbers of a dataset card."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagmill.functions.text import base64_text
from tagmill.operators.ordered import smallest

SPLIT_BUCKETS = 10_000

# Size classes of a dataset card by their smallest number of samples.
SIZE_CLASSES = {"100K<n<1M": 100_000, "10K<n<100K": 10_000, "1K<n<10K": 0}


def id_hash(key: Column) -> Column:
    """A 32-bit hash of the id that other engines reproduce."""
    return F.conv(F.substr(F.md5(key.cast("string").cast("binary")), F.lit(1), F.lit(8)), 16, 10).cast("long")


def safe_only(dataset: DataFrame, require_rows: bool = False) -> DataFrame:
    """Rows with none of the three rating flags. ``require_rows`` fails at once if nothing is left."""
    safe = dataset.where(~(F.col("is_nsfw") | F.col("is_nsfl") | F.col("is_nsfp")))
    if require_rows and safe.isEmpty():
        raise ValueError("no safe rows to export")
    return safe


def export_columns(safe: DataFrame) -> DataFrame:
    """Columns of the public files; image bytes as text when there are any."""
    columns = [F.col("id"), F.col("image"), F.col("tags"), F.col("confidences").cast("array<double>").alias("confidences")]
    if "image_data" in safe.columns:
        columns.append(base64_text(F.col("image_data")).alias("image_bytes_b64"))
    return safe.select(*columns)


def sample_cap(df: DataFrame, max_samples: int | None) -> DataFrame:
    """At most ``max_samples`` rows, chosen by id hash: the same rows whatever the partitioning."""
    if not max_samples:
        return df
    return smallest(df.withColumn("_h", id_hash(F.col("id"))), max_samples, "_h", "id").drop("_h")


def with_split(df: DataFrame, test_share: float = 0.1) -> DataFrame:
    """Add ``split`` (train/test) from the id alone, without a shuffle."""
    is_test = id_hash(F.col("id")) % SPLIT_BUCKETS < round(test_share * SPLIT_BUCKETS)
    return df.withColumn("split", F.when(is_test, F.lit("test")).otherwise(F.lit("train")))


def card_stats(dataset: DataFrame, test_share: float = 0.1) -> DataFrame:
    """The numbers on the card, in one row, from the whole dataset with its flags."""
    flagged = F.col("is_nsfw") | F.col("is_nsfl") | F.col("is_nsfp")
    counted = with_split(dataset, test_share).agg(
        F.count("*").alias("total_items"),
        F.count_if(~flagged).alias("safe_items"),
        F.count_if(flagged).alias("excluded_items"),
        F.count_if(~flagged & (F.col("split") == "train")).alias("train_samples"),
        F.count_if(~flagged & (F.col("split") == "test")).alias("test_samples"),
    )
    names = safe_only(dataset).select(F.explode("tags").alias("tag")).distinct().agg(F.count("*")).scalar()
    n = F.col("safe_items")
    size = F.coalesce(*[F.when(n >= least, F.lit(name)) for name, least in SIZE_CLASSES.items()])
    return counted.select(
        "*",
        F.coalesce(F.try_divide(n * 100, F.col("total_items")), F.lit(0.0)).alias("safe_percent"),
        names.alias("unique_tags"),
        size.alias("size_class"),
        F.lit("image_data" in dataset.columns).alias("has_image_data"),
    )
