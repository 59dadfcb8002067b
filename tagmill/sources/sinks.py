"""Writers. Every writer produces a directory of files; nothing is gathered into one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagmill.operators import export
from tagmill.operators.catalog import apply_delta
from tagmill.operators.images import CHANNEL_MEANS
from tagmill.operators.requests import results_rows
from tagmill.sources.tables import check_dataset


def write_dataset(dataset: DataFrame, path: str, rows_per_file: int = 2_000) -> None:
    """The prepared dataset as snappy Parquet; files are kept small because a row carries a tensor."""
    check_dataset(dataset).write.mode("errorifexists").option("compression", "snappy").option(
        "maxRecordsPerFile", rows_per_file
    ).parquet(path)


def describe_run(metadata: DataFrame, size: tuple[int, int], errors: DataFrame, trash_sample: DataFrame) -> DataFrame:
    """The metadata row with the image format, the error counts and the named trash tags (at most 50) nested in."""
    error_list = errors.agg(F.collect_list(F.struct("reason", "n"))).scalar()
    trash_list = trash_sample.agg(F.sort_array(F.collect_list(F.struct("tag", "trash_reason")))).scalar()
    return metadata.select(
        F.current_timestamp().alias("created"),
        "*",
        F.lit(True).alias("images_embedded"),
        F.lit(size[0]).alias("width"),
        F.lit(size[1]).alias("height"),
        F.lit("float32").alias("dtype"),
        F.lit("BGR").alias("color_order"),
        F.array(*[F.lit(m) for m in CHANNEL_MEANS]).alias("channel_means"),
        error_list.alias("image_errors"),
        trash_list.alias("trash_tags_sample"),
    )


def write_metadata(row: DataFrame, path: str) -> None:
    row.write.mode("errorifexists").json(path)


def export_dataset(dataset: DataFrame, path: str, name: str, max_samples: int | None = None, test_share: float = 0.1) -> DataFrame:
    """Write the safe rows as ``data/split=train|test`` Parquet, a manifest and a card; returns the card numbers.

    Totals, exclusions and the safe share describe the whole dataset; samples, splits and tags what was written.
    """
    spark = dataset.sparkSession
    safe = export.sample_cap(export.safe_only(dataset, require_rows=True), max_samples)
    rows = export.with_split(export.export_columns(safe), test_share)
    rows.write.mode("errorifexists").partitionBy("split").parquet(f"{path}/data")
    manifest = spark.range(1).select(
        F.array(F.lit("train"), F.lit("test")).alias("splits"),
        F.struct(F.lit("data/split=train").alias("train"), F.lit("data/split=test").alias("test")).alias("data_files"),
    )
    manifest.write.mode("errorifexists").json(f"{path}/manifest")
    whole = export.card_stats(dataset, test_share)
    of_all = ("total_items", "excluded_items", "safe_percent")
    numbers = export.card_stats(safe, test_share).withColumns({c: whole.select(c).scalar() for c in of_all})
    card = numbers.select(render_card(name, test_share).alias("value"))
    card.write.mode("errorifexists").text(f"{path}/card")
    return numbers


def render_card(name: str, test_share: float = 0.1):
    """The card text as a column over ``card_stats``."""
    n = lambda c: F.format_number(c, 0)
    test = round(test_share * 100)
    lines = [
        F.concat(F.lit("# "), F.lit(name)),
        F.lit("Safe images only: every item with a restricted rating is left out."),
        F.concat(F.lit("size category: "), "size_class"),
        F.concat(F.lit("samples: "), n("safe_items"), F.lit(", unique tags: "), n("unique_tags")),
        F.concat(F.lit("train: "), n("train_samples"), F.lit(f" ({100 - test}%), test: "), n("test_samples"), F.lit(f" ({test}%)")),
        F.lit("Columns: id (integer), image (path), tags (list of text), confidences (list of numbers, same order)."),
        F.when(
            F.col("has_image_data"),
            F.lit("image_bytes_b64: base64 of float32 values, height x width x 3, blue-green-red, channel means subtracted."),
        ),
    ]
    return F.concat_ws("\n\n", *lines)


def write_results(summary: DataFrame, path: str) -> None:
    results_rows(summary).write.mode("errorifexists").json(path)


def write_predictions(records: DataFrame, path: str) -> None:
    """``image, tags`` rows as JSON lines."""
    records.select("image", "tags").write.mode("errorifexists").json(path)


def write_run(df: DataFrame, root: str, run_ts: int) -> None:
    """One run as its own partition; readers resolve the newest one, so the data being read is never overwritten."""
    df.write.mode("errorifexists").parquet(f"{root}/run_ts={run_ts}")


def upsert_run(spark: SparkSession, root: str, delta: DataFrame, run_ts: int) -> None:
    """The next snapshot: the newest run with the delta applied, range-clustered by id for lookups."""
    from tagmill.sources.tables import read_latest_run

    base = read_latest_run(spark, root).drop("run_ts")
    write_run(apply_delta(base, delta).repartitionByRange("id").sortWithinPartitions("id"), root, run_ts)
