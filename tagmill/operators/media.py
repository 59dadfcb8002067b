"""Catalog paths against a listing of stored media."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagmill.functions.text import extension, file_name, has_media_extension, join_path, parent_dir


def catalog_media(items: DataFrame, include_videos: bool = False) -> DataFrame:
    """``id, image`` of the items with an allowed media extension."""
    return items.where(F.col("image").isNotNull() & has_media_extension(F.col("image"), include_videos)).select("id", "image")


def missing_media(catalog: DataFrame, listing: DataFrame, media_root: str | None = None) -> DataFrame:
    """Catalog rows whose path is not stored; a path used twice is reported twice."""
    # Listed paths are made distinct before they are shuffled; the join then reuses that partitioning.
    missing = catalog.join(listing.select("image").distinct(), "image", "left_anti")
    return missing if media_root is None else missing.withColumn("local_path", join_path(F.lit(media_root), F.col("image")))


def missing_media_distinct(catalog: DataFrame, listing: DataFrame) -> DataFrame:
    """Each missing path once."""
    return catalog.select("image").distinct().join(listing.select("image").distinct(), "image", "left_anti")


def missing_by_dir(catalog: DataFrame, listing: DataFrame) -> DataFrame:
    """Per directory of the catalog: distinct names, missing names, and whether the directory is stored at all.

    Names are compared row by row and then counted, so a directory with very many files is never gathered.
    """
    paths = catalog.select("image").distinct()
    marked = paths.join(listing.select("image", F.lit(True).alias("_held")).distinct(), "image", "left")
    per_dir = marked.groupBy(parent_dir(F.col("image")).alias("dir")).agg(
        F.count("*").alias("n_files"), F.count_if(F.col("_held").isNull()).alias("n_missing")
    )
    stored = listing.select(parent_dir(F.col("image")).alias("dir"), F.lit(True).alias("dir_exists")).distinct()
    return per_dir.join(stored, "dir", "left").withColumn("dir_exists", F.coalesce("dir_exists", F.lit(False)))


def media_presence(catalog: DataFrame, listing: DataFrame) -> DataFrame:
    """``id, image, present`` for every catalog row."""
    held = listing.select("image", F.lit(True).alias("_held")).distinct()
    return catalog.join(held, "image", "left").select("id", "image", F.col("_held").isNotNull().alias("present"))


def media_summary(catalog: DataFrame, listing: DataFrame, seconds: float | None = None) -> DataFrame:
    """Totals in one row; ``files_per_second`` is 0 without a positive duration."""
    held = listing.select("image").distinct()
    on_disk = held.agg(F.count("*")).scalar()
    marked = catalog.join(held.withColumn("_held", F.lit(True)), "image", "left")
    to_fetch = F.count_if(F.col("_held").isNull())
    totals = marked.agg(F.count("*").alias("total_in_db"), to_fetch.alias("to_download"))
    rate = F.coalesce(F.try_divide(F.col("to_download").cast("double"), F.lit(float(seconds or 0))), F.lit(0.0))
    return totals.select(
        "total_in_db",
        on_disk.alias("total_on_disk"),
        "to_download",
        (F.col("total_in_db") - F.col("to_download")).alias("skipped"),
        rate.alias("files_per_second"),
    )


def verify_sizes(catalog: DataFrame, local: DataFrame, remote: DataFrame) -> DataFrame:
    """Add ``needs_download``: not stored -> yes; remote size unknown -> no; otherwise whether the sizes differ.

    A path has one size on either side.
    """
    one = lambda df, size: df.groupBy("image").agg(F.max(size).alias(size))
    sized = catalog.join(one(local, "local_size"), "image", "left").join(one(remote, "remote_size"), "image", "left")
    needs = (
        F.when(F.col("local_size").isNull(), True)
        .when(F.col("remote_size").isNull(), False)
        .otherwise(F.col("local_size") != F.col("remote_size"))
    )
    return sized.withColumn("needs_download", needs)


def extension_counts(catalog: DataFrame) -> DataFrame:
    """Number of paths per extension (an empty text for none)."""
    return catalog.where("image IS NOT NULL").groupBy(extension(F.col("image")).alias("ext")).agg(F.count("*").alias("n"))


def split_paths(catalog: DataFrame) -> DataFrame:
    """Directory and file name of every path."""
    path = F.col("image")
    return catalog.where(path.isNotNull()).select("image", parent_dir(path).alias("dir"), file_name(path).alias("name"))
