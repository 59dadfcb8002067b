"""Running tag counts over arriving item details."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagmill.operators.tags import occurrences
from tagmill.schemas import DETAIL


def detail_stream(spark: SparkSession, path: str, files_per_trigger: int = 100) -> DataFrame:
    return spark.readStream.schema(DETAIL).option("maxFilesPerTrigger", files_per_trigger).json(path)


def running_tag_counts(details: DataFrame) -> DataFrame:
    """Occurrences and confidence sum per normalised tag so far (update mode). Quantiles are recomputed in batch."""
    rows = details.select(F.explode(occurrences(F.col("tags"))).alias("o"))
    return rows.groupBy(F.col("o.tag").alias("tag")).agg(F.count("*").alias("frequency"), F.sum("o.conf").alias("conf_sum"))
