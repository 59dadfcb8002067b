"""Exactly ``min_tags`` tags per item: trusted tags first, the most confident trash as backfill."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagmill.functions.flags import RATING_TAGS


def item_flags(items: DataFrame) -> DataFrame:
    """Add ``is_nsfw``, ``is_nsfl``, ``is_nsfp`` from ``occ``; evaluated inside the row."""
    names = F.transform("occ", lambda o: o["tag"])
    return items.withColumns({f"is_{t}": F.array_contains(names, t) for t in ("nsfw", "nsfl", "nsfp")})


def merged_tags(occ: Column) -> Column:
    """Content tags of one item, duplicates summed, in first-seen order: ``array<struct<tag, conf>>``.

    Items almost never repeat a tag; only those that do pay for the pairwise merge.
    """
    names = F.transform(occ, lambda o: o["tag"])
    distinct = F.array_distinct(names)
    summed = F.transform(
        distinct,
        lambda t: F.struct(
            t.alias("tag"),
            F.aggregate(F.filter(occ, lambda o: o["tag"] == t), F.lit(0.0), lambda acc, o: acc + o["conf"]).alias("conf"),
        ),
    )
    merged = F.when(F.size(distinct) == F.size(names), occ).otherwise(summed)
    return F.filter(merged, lambda m: ~m["tag"].isin(*RATING_TAGS))


def merge_item_tags(items: DataFrame) -> DataFrame:
    """One row per (item, content tag): ``id, pos, tag, conf``; ``pos`` ranks first occurrences. No shuffle."""
    return items.select("id", F.posexplode(merged_tags(F.col("occ"))).alias("pos", "m")).select(
        "id", "pos", F.col("m.tag").alias("tag"), F.col("m.conf").alias("conf")
    )


def rank_tags(items: DataFrame, classified: DataFrame, limits: DataFrame, min_tags: int = 5) -> DataFrame:
    """The up to ``min_tags`` best rows per item: ``id, tag, conf, is_trash, pos``.

    The rank filter is applied before the shuffle as well (window group limit), so an item with very many tags sends
    ``min_tags`` rows per task.
    """
    verdicts = classified.select("tag", "frequency", F.col("trash_reason").isNotNull().alias("is_trash"))
    limit = limits.select(F.struct("high_confidence", "min_corpus_frequency")).scalar()
    known = merge_item_tags(items).join(verdicts, "tag").withColumn("_th", limit)
    keep = (
        F.col("is_trash")
        | (F.col("conf") >= F.col("_th.high_confidence"))
        | (F.col("frequency") >= F.col("_th.min_corpus_frequency"))
    )
    best = Window.partitionBy("id").orderBy("is_trash", F.desc("conf"), "pos")
    return (
        known.where(keep)
        .select("id", "tag", "conf", "is_trash", "pos", F.row_number().over(best).alias("rank"))
        .where(F.col("rank") <= min_tags)
        .drop("rank")
    )


def curate_items(items: DataFrame, classified: DataFrame, limits: DataFrame, min_tags: int = 5) -> DataFrame:
    """``id, image, is_nsfw, is_nsfl, is_nsfp, tags, confidences, trash_used``; items that stay short are dropped.

    Takes ``id, image, occ``. The lists hold ``min_tags`` rows at most before they are collected.
    """
    ranked = rank_tags(items, classified, limits, min_tags)
    entry = F.struct((-F.col("conf")).alias("neg"), "is_trash", "pos", "tag", "conf")
    lists = (
        ranked.groupBy("id")
        .agg(F.sort_array(F.collect_list(entry)).alias("kept"), F.count("*").alias("n"))
        .where(F.col("n") == min_tags)
        .select(
            "id",
            F.transform("kept", lambda k: k["tag"]).alias("tags"),
            F.transform("kept", lambda k: k["conf"]).alias("confidences"),
            F.size(F.filter("kept", lambda k: k["is_trash"])).alias("trash_used"),
        )
    )
    # Paths and flags rejoin here instead of travelling with every tag through two shuffles.
    base = item_flags(items).select("id", "image", "is_nsfw", "is_nsfl", "is_nsfp")
    return base.join(lists, "id").select("id", "image", "is_nsfw", "is_nsfl", "is_nsfp", "tags", "confidences", "trash_used")
