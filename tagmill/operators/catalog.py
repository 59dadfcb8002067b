"""Id ranges, gaps, fetch planning, keep-latest versions and catalog profiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagmill.functions.flags import matches_mask
from tagmill.operators.tags import tag_counts

GAP_BUCKET = 1_000_000


def id_range(items: DataFrame) -> DataFrame:
    """``min_id, max_id, item_count``; -1 for the bounds of an empty table."""
    return items.agg(
        F.coalesce(F.min("id"), F.lit(-1)).alias("min_id"),
        F.coalesce(F.max("id"), F.lit(-1)).alias("max_id"),
        F.count("*").alias("item_count"),
    )


def gap_analysis(ids: DataFrame, remote_max: int | Column) -> DataFrame:
    """One row of gap counts between the held ids and ``1..remote_max``.

    Distinct ids are counted through one 4 KB bitmap per 32,768 consecutive ids, combined map-side, so the exchange
    carries bitmaps instead of ids.
    """
    bitmaps = ids.groupBy(F.bitmap_bucket_number("id").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("id")).alias("bits"), F.min("id").alias("lo"), F.max("id").alias("hi")
    )
    held = bitmaps.agg(
        F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0)).alias("n")
    )
    remote = remote_max if isinstance(remote_max, Column) else F.lit(remote_max)
    some = F.col("n") > 0
    counted = held.withColumn("remote", remote.cast("long")).select(
        F.col("n").alias("local_count"),
        F.coalesce("lo", F.lit(0)).alias("local_min"),
        F.coalesce("hi", F.lit(0)).alias("local_max"),
        F.when(some, F.greatest(F.col("remote") - F.col("hi"), F.lit(0))).otherwise(F.col("remote")).alias("top_gap"),
        F.when(some, F.greatest(F.col("lo") - 1, F.lit(0))).otherwise(F.lit(0)).alias("bottom_gap"),
        F.when(some, F.greatest(F.col("hi") - F.col("lo") + 1 - F.col("n"), F.lit(0))).otherwise(F.lit(0)).alias("internal_gaps"),
    )
    missing = F.col("top_gap") + F.col("bottom_gap") + F.col("internal_gaps")
    return counted.withColumn("total_missing", missing).withColumn(
        "is_complete", (F.col("local_count") > 0) & (F.col("total_missing") == 0)
    )


def gap_ranges(ids: DataFrame, bucket: int = GAP_BUCKET) -> DataFrame:
    """Every internal run of missing ids: ``gap_start, gap_end, gap_length``.

    Neighbours are found inside buckets of ``bucket`` consecutive ids, then across bucket edges; ids are a dense
    sequence, so the edge table has about max(id) / bucket rows.
    """
    keyed = ids.select("id").distinct().withColumn("b", F.floor(F.col("id") / bucket))
    inner = keyed.withColumn("next", F.lead("id").over(Window.partitionBy("b").orderBy("id"))).select("id", "next")
    edges = (
        keyed.groupBy("b")
        .agg(F.min("id").alias("lo"), F.max("id").alias("hi"))
        .select(F.col("hi").alias("id"), F.lead("lo").over(Window.orderBy("b")).alias("next"))
    )
    return (
        inner.unionByName(edges)
        .where(F.col("next") > F.col("id") + 1)
        .select(
            (F.col("id") + 1).alias("gap_start"),
            (F.col("next") - 1).alias("gap_end"),
            (F.col("next") - F.col("id") - 1).alias("gap_length"),
        )
    )


def fetch_plan(
    gaps: DataFrame,
    remote_max: int | Column,
    full: bool = False,
    start_from: int | None = None,
    fill_gaps: bool = False,
) -> DataFrame:
    """Which id window to fetch next: ``mode, start_id, end_id, estimated``; mode ``none`` has null bounds.

    Priority: full, explicit start, new ids on top, old ids at the bottom, internal gaps if asked for.
    """
    remote = (remote_max if isinstance(remote_max, Column) else F.lit(remote_max)).cast("long")
    one = F.lit(1).cast("long")
    choices = [
        ("full", F.lit(full), remote, one),
        ("start_from", F.lit(start_from is not None), F.lit(start_from).cast("long"), one),
        ("top", F.col("top_gap") > 0, remote, F.col("local_max") + 1),
        ("bottom", F.col("bottom_gap") > 0, F.col("local_min") - 1, one),
        ("internal", F.lit(fill_gaps) & (F.col("internal_gaps") > 0), F.col("local_max"), F.col("local_min")),
    ]
    picked = F.coalesce(
        *[
            F.when(cond, F.struct(F.lit(mode).alias("mode"), start.alias("start_id"), end.alias("end_id")))
            for mode, cond, start, end in choices
        ],
        F.struct(F.lit("none").alias("mode"), F.lit(None).cast("long").alias("start_id"), F.lit(None).cast("long").alias("end_id")),
    )
    return gaps.select(picked.alias("p")).select("p.*", (F.col("p.start_id") - F.col("p.end_id") + 1).alias("estimated"))


def in_window(page_items: DataFrame, plan: DataFrame) -> DataFrame:
    """Page items inside the planned window (none for mode ``none``)."""
    window = plan.select(F.struct("start_id", "end_id")).scalar()
    return page_items.withColumn("_w", window).where(F.col("id").between(F.col("_w.end_id"), F.col("_w.start_id"))).drop("_w")


def new_items(page_items: DataFrame, held: DataFrame) -> DataFrame:
    """Page items whose id is not held."""
    return page_items.join(held.select("id").distinct(), "id", "left_anti")


def attach_details(items: DataFrame, details: DataFrame) -> DataFrame:
    """Items with their tags and comments; items without a detail document are left out."""
    return items.join(details.withColumnRenamed("item_id", "id"), "id")


def failed_details(items: DataFrame, details: DataFrame) -> DataFrame:
    """Items whose detail document is missing."""
    return items.join(details.select(F.col("item_id").alias("id")).distinct(), "id", "left_anti")


def upsert_latest(versions: DataFrame, order: Sequence[str] = ("updated_at", "seq")) -> DataFrame:
    """The latest version per id. The rank filter runs before the shuffle too, so a much-rewritten id stays cheap."""
    latest = Window.partitionBy("id").orderBy(*[F.desc(c) for c in order])
    return versions.withColumn("_rn", F.row_number().over(latest)).where("_rn = 1").drop("_rn")


def apply_delta(base: DataFrame, delta: DataFrame, order: Sequence[str] = ("updated_at", "seq")) -> DataFrame:
    """Replace semantics for a base that holds each id once: the delta always wins.

    The base is only filtered, never re-sorted; a small set of delta ids is broadcast by the adaptive planner.
    """
    newest = upsert_latest(delta, order)
    return base.join(newest.select("id"), "id", "left_anti").unionByName(newest, allowMissingColumns=True)


def flag_mask_filter(items: DataFrame, mask: int = 15) -> DataFrame:
    return items.where(matches_mask(F.col("flags"), mask))


def newest_page(items: DataFrame, older: int | None = None, limit: int = 120) -> DataFrame:
    """The next page downwards: ids below the cursor, newest first."""
    below = items if older is None else items.where(F.col("id") < older)
    return below.orderBy(F.desc("id")).limit(limit)


def sample_paths(items: DataFrame, count: int = 100, mask: int = 1) -> DataFrame:
    """The newest ``count`` still paths under a rating mask (suffixes are case-sensitive here)."""
    image = F.col("image")
    stills = image.endswith(".jpg") | image.endswith(".png") | image.endswith(".gif")
    return flag_mask_filter(items, mask).where(stills).select("id", "image").orderBy(F.desc("id")).limit(count)


def has_enough(items: DataFrame, needed: int) -> DataFrame:
    """Whether at least ``needed`` items are held; counting stops there."""
    counted = items.select("id").limit(needed).agg(F.count("*").alias("n"))
    return counted.select(F.lit(needed).cast("long").alias("needed"), (F.col("n") >= needed).alias("enough"))


def catalog_profile(items: DataFrame, top: int = 10) -> DataFrame:
    """``section, name, value``: item count, id range and the most frequent raw tags."""
    r = id_range(items).select(
        F.explode(
            F.array(
                *[
                    F.struct(F.lit("items").alias("section"), F.lit(c).alias("name"), F.col(c).alias("value"))
                    for c in ("item_count", "min_id", "max_id")
                ]
            )
        ).alias("r")
    )
    tags = tag_counts(items, top).select(F.lit("top_tag").alias("section"), F.col("tag").alias("name"), F.col("n").alias("value"))
    return r.select("r.*").unionByName(tags)


RUN_COUNTERS = ("items_processed", "items_skipped", "items_failed", "files_downloaded", "files_skipped", "bytes_downloaded")


def run_summary(stages: Sequence[DataFrame]) -> DataFrame:
    """Merge stage counters (``stage`` plus any of RUN_COUNTERS) into one row per stage and a ``total`` row."""
    union = stages[0]
    for s in stages[1:]:
        union = union.unionByName(s, allowMissingColumns=True)
    counters = [
        (F.sum(F.coalesce(c, F.lit(0))) if c in union.columns else F.lit(0).cast("long")).alias(c) for c in RUN_COUNTERS
    ]
    per_stage = union.groupBy("stage").agg(*counters)
    total = per_stage.agg(*[F.sum(c).alias(c) for c in RUN_COUNTERS]).select(F.lit("total").alias("stage"), *RUN_COUNTERS)
    handled = F.col("items_processed") + F.col("items_skipped") + F.col("items_failed")
    return per_stage.unionByName(total).withColumn("total_items", handled)
