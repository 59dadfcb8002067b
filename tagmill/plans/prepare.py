"""Items -> curated dataset."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagmill.functions.text import is_image
from tagmill.operators import curate, tags
from tagmill.schemas import NAMED_TAGS
from tagmill.session import cut


@dataclass(frozen=True)
class Analysis:
    """What the data itself says about its tags; everything here is a DataFrame."""

    items: DataFrame  # id, image, occ: images with enough raw tags
    stats: DataFrame  # per tag, materialised
    percentiles: DataFrame  # one row
    limits: DataFrame  # one row
    classified: DataFrame  # stats with trash_reason


def eligible(items: DataFrame, min_tags: int = 5, limit: int | None = None) -> DataFrame:
    """Still images with at least ``min_tags`` raw tags: ``id, image, tags``. ``limit`` is the development row cap."""
    scanned = items.where(F.col("tags_data").isNotNull()).select("id", "image", "tags_data")
    images = scanned.where(is_image(F.col("image")))
    parsed = tags.filter_min_tags(tags.parse_tags(images, schema=NAMED_TAGS), min_tags)
    return parsed if limit is None else parsed.orderBy("id").limit(limit)


def stage(items: DataFrame, min_tags: int = 5, limit: int | None = None) -> DataFrame:
    """Eligible items with normalised occurrences (``id, image, occ``), written once to the shared folder.

    Decoding the JSON text is the expensive part of a pass, and several passes follow (corpus size, statistics,
    confidences, curation); they read this compact form instead.
    """
    return cut(tags.with_occurrences(eligible(items, min_tags, limit)))


def analyze(items: DataFrame, min_tags: int = 5, exact: bool = True, limit: int | None = None) -> Analysis:
    """Statistics, thresholds and trash classification."""
    staged = stage(items, min_tags, limit)
    stats = cut(tags.with_idf(tags.tag_stats(staged), staged))
    percentiles = cut(tags.confidence_percentiles(staged, exact))
    limits = cut(tags.thresholds(stats, percentiles))
    return Analysis(staged, stats, percentiles, limits, tags.trash_tags(stats, limits))


def build(items: DataFrame, min_tags: int = 5, exact: bool = True, limit: int | None = None) -> DataFrame:
    """The curated items (without image data)."""
    found = analyze(items, min_tags, exact, limit)
    return curate.curate_items(found.items, found.classified, found.limits, min_tags)


def metadata(found: Analysis, curated: DataFrame, min_tags: int = 5) -> DataFrame:
    """One row describing the run: thresholds, confidence statistics, counts and backfill."""
    kept = curated.agg(F.struct(F.count("*").alias("n"), F.sum("trash_used").alias("trash_used"))).scalar()
    considered = found.items.agg(F.count("*")).scalar()
    trash = found.classified.where(F.col("trash_reason").isNotNull()).agg(F.count("*")).scalar()
    summary = tags.confidence_summary(found.items, found.percentiles).select(F.struct("*")).scalar()
    return found.limits.withColumns({"_k": kept, "_c": considered, "_t": trash, "_s": summary}).select(
        F.col("_k.n").alias("total_items"),
        (F.col("_c") - F.col("_k.n")).alias("items_skipped"),
        F.lit(min_tags).alias("min_tags"),
        "unique_tags",
        F.col("total_tags").alias("total_tag_occurrences"),
        "high_confidence",
        "min_corpus_frequency",
        F.col("_s.mean").alias("conf_mean"),
        F.col("_s.std").alias("conf_std"),
        F.col("_s.median").alias("conf_median"),
        F.col("_s.p75").alias("conf_p75"),
        F.col("_s.p90").alias("conf_p90"),
        F.col("_t").alias("trash_tags_count"),
        F.coalesce(F.col("_k.trash_used"), F.lit(0)).alias("trash_tags_kept_for_min"),
    )
