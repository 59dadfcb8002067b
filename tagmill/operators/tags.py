"""Tag statistics, data-driven thresholds and trash classification.

Items are keyed by ``id``; ``tags`` is ``array<struct<id, confidence, tag>>``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from tagmill.functions.flags import is_rating_tag
from tagmill.functions.text import normalize_tag, percent
from tagmill.operators.once import compute_once
from tagmill.operators.ordered import order_statistics
from tagmill.schemas import TAGS

# Quantiles and limits of the classification rules.
CONFIDENCE_QUANTILES = {"p10": 0.10, "p25": 0.25, "p50": 0.50, "p75": 0.75, "p90": 0.90, "p95": 0.95, "p99": 0.99}
FREQUENCY_QUANTILE = 0.25
MIN_FREQUENCY_FLOOR = 3
DOC_RATIO_QUANTILE = 0.95
IDF_QUANTILE = 0.10
VARIANCE_FACTOR = 2
VARIANCE_MIN_TAGS = 100


def parse_tags(items: DataFrame, source: str = "tags_data", schema: ArrayType = TAGS) -> DataFrame:
    """Decode JSON text into ``tags``; empty text is an empty list, malformed text is null (see ``count_rejects``)."""
    text = F.col(source)
    parsed = F.when(text == "", F.array().cast(schema)).otherwise(F.from_json(text, schema))
    return compute_once(items, tags=parsed).drop(source)


def count_rejects(items: DataFrame, source: str = "tags_data") -> DataFrame:
    """How many rows have text, and how many of those do not decode."""
    bad = F.col("tags").isNull()
    return parse_tags(items.where(F.col(source).isNotNull()).withColumn("_text", F.col(source)), "_text").agg(
        F.count("*").alias("with_text"), F.count_if(bad).alias("rejected")
    )


def filter_min_tags(items: DataFrame, min_tags: int = 5) -> DataFrame:
    """Raw tag count, before duplicates are merged and rating tags removed."""
    return items.where(F.size("tags") >= min_tags)


def occurrences(tags: Column) -> Column:
    """Normalised ``array<struct<tag, conf>>`` in source order; null elements are dropped."""
    present = F.filter(tags, lambda t: t["tag"].isNotNull())
    return F.transform(
        present,
        lambda t: F.struct(
            normalize_tag(t["tag"]).alias("tag"), F.coalesce(t["confidence"], F.lit(0.0)).alias("conf")
        ),
    )


def with_occurrences(items: DataFrame) -> DataFrame:
    """Replace ``tags`` by ``occ`` (normalised occurrences), so that later passes read the compact form."""
    return items.withColumn("occ", occurrences(F.col("tags"))).drop("tags")


def explode_tags(items: DataFrame) -> DataFrame:
    """One row per occurrence: ``id, pos, tag, confidence``."""
    return items.select("id", F.posexplode(occurrences(F.col("tags"))).alias("pos", "t")).select(
        "id", "pos", F.col("t.tag").alias("tag"), F.col("t.conf").alias("confidence")
    )


def tag_stats(items: DataFrame) -> DataFrame:
    """Per tag: frequency, document frequency and confidence moments. Takes ``id, occ``.

    An item states its distinct tags itself, so documents are counted by one extra element per distinct tag instead of
    a distinct aggregation over (tag, id): one exchange, combined map-side.
    """
    tags = F.transform("occ", lambda o: o["tag"])
    marks = F.transform(F.array_distinct(tags), lambda t: F.struct(t.alias("tag"), F.lit(None).cast("double").alias("conf")))
    rows = items.select(F.explode(F.concat("occ", marks)).alias("t")).select("t.tag", "t.conf")
    return rows.groupBy("tag").agg(
        F.count("conf").alias("frequency"),
        F.count_if(F.col("conf").isNull()).alias("doc_frequency"),
        F.avg("conf").alias("conf_mean"),
        F.coalesce(F.stddev_samp("conf"), F.lit(0.0)).alias("conf_std"),
        F.min("conf").alias("conf_min"),
        F.max("conf").alias("conf_max"),
    )


def with_idf(stats: DataFrame, items: DataFrame) -> DataFrame:
    """Add ``idf`` and ``doc_freq_ratio``; the corpus is the given items."""
    total = items.agg(F.count("*")).scalar()
    return (
        stats.withColumn("_total", total)
        .withColumn("idf", F.log(F.col("_total") / F.col("doc_frequency")))
        .withColumn("doc_freq_ratio", F.col("doc_frequency") / F.col("_total"))
        .drop("_total")
    )


def _confidences(items: DataFrame) -> DataFrame:
    return items.select(F.explode("occ.conf").alias("conf"))


def confidence_percentiles(items: DataFrame, exact: bool = True) -> DataFrame:
    """One row with the confidence quantiles over all occurrences; ``exact=False`` uses a sketch (rank error 1e-5)."""
    conf = _confidences(items)
    if exact:
        return order_statistics(conf, "conf", linear=CONFIDENCE_QUANTILES)
    marks = list(CONFIDENCE_QUANTILES.values())
    sketch = conf.agg(F.percentile_approx("conf", marks, 100_000).alias("q"))
    return sketch.select(*[F.col("q")[i].alias(n) for i, n in enumerate(CONFIDENCE_QUANTILES)])


def confidence_summary(items: DataFrame, percentiles: DataFrame) -> DataFrame:
    """Mean, sample deviation, median, p75, p90 in one row."""
    q = percentiles.select(F.struct("p50", "p75", "p90")).scalar()
    return (
        _confidences(items)
        .agg(F.avg("conf").alias("mean"), F.stddev_samp("conf").alias("std"))
        .withColumn("_q", q)
        .select(
            "mean", "std", F.col("_q.p50").alias("median"), F.col("_q.p75").alias("p75"), F.col("_q.p90").alias("p90")
        )
    )


def thresholds(stats: DataFrame, percentiles: DataFrame) -> DataFrame:
    """One row with every cut-off. ``stats`` carries idf and ratio and should be materialised, as it is read thrice.

    Quantiles over tags run on value counts. Frequencies are integers that add up to the number of occurrences, so
    there are at most sqrt(2 * occurrences) distinct ones and the aggregation state stays small.
    """
    by_frequency = (
        stats.groupBy("frequency")
        .agg(F.count("*").alias("n"))
        .agg(F.percentile("frequency", F.lit(FREQUENCY_QUANTILE), F.col("n")))
        .scalar()
    )
    by_documents = (
        stats.groupBy("doc_frequency")
        .agg(F.first("doc_freq_ratio").alias("ratio"), F.first("idf").alias("idf"), F.count("*").alias("n"))
        .agg(
            F.struct(
                F.percentile("ratio", F.lit(DOC_RATIO_QUANTILE), F.col("n")).alias("ratio"),
                F.percentile("idf", F.lit(IDF_QUANTILE), F.col("n")).alias("idf"),
            )
        )
        .scalar()
    )
    q = percentiles.select(F.struct("p50", "p75")).scalar()
    return (
        stats.agg(
            F.count("*").alias("unique_tags"),
            F.coalesce(F.sum("frequency"), F.lit(0)).alias("total_tags"),
            F.avg("conf_std").alias("mean_std"),
        )
        .withColumns({"_f": by_frequency, "_d": by_documents, "_q": q})
        .select(
            "unique_tags",
            "total_tags",
            F.col("_q.p75").alias("high_confidence"),
            F.col("_q.p50").alias("median_confidence"),
            F.greatest(F.lit(MIN_FREQUENCY_FLOOR).cast("long"), F.col("_f").cast("long")).alias("min_corpus_frequency"),
            F.col("_d.ratio").alias("doc_ratio_limit"),
            F.col("_d.idf").alias("idf_limit"),
            "mean_std",
        )
    )


def _criteria(limits: DataFrame) -> tuple[Column, dict[str, Column]]:
    t = limits.select(F.struct("*")).scalar()
    th = lambda name: F.col("_th")[name]
    content = ~is_rating_tag(F.col("tag"))
    unsure = F.col("conf_mean") < th("median_confidence")
    return t, {
        "high_doc_freq": (F.col("doc_freq_ratio") > th("doc_ratio_limit")) & content,
        "low_idf_low_conf": (F.col("idf") < th("idf_limit")) & unsure & content,
        "high_conf_variance": (th("unique_tags") > VARIANCE_MIN_TAGS)
        & (F.col("conf_std") > VARIANCE_FACTOR * th("mean_std"))
        & content,
        "singleton_low_conf": (F.col("doc_frequency") == 1) & unsure,
    }


def trash_tags(stats: DataFrame, limits: DataFrame) -> DataFrame:
    """Add ``trash_reason`` (null for tags to keep); the first criterion that applies names the reason."""
    row, criteria = _criteria(limits)
    text = {n: F.lit(n) for n in criteria}
    text["high_doc_freq"] = F.concat(F.lit("high_doc_freq (>"), percent(F.col("_th.doc_ratio_limit")), F.lit(")"))
    reason = F.coalesce(*[F.when(cond, text[n]) for n, cond in criteria.items()])
    return stats.withColumn("_th", row).withColumn("trash_reason", reason).drop("_th")


def trash_breakdown(stats: DataFrame, limits: DataFrame) -> DataFrame:
    """Counts in one row: all trash, and each criterion on its own (a tag may meet several)."""
    row, criteria = _criteria(limits)
    hit = F.lit(False)
    for cond in criteria.values():
        hit = hit | cond
    return stats.withColumn("_th", row).agg(
        F.count("*").alias("unique_tags"),
        F.count_if(hit).alias("trash_tags"),
        *[F.count_if(cond).alias(name) for name, cond in criteria.items()],
    )


def trash_sample(classified: DataFrame, limit: int = 50) -> DataFrame:
    """The first ``limit`` trash tags by name, with their reasons."""
    return classified.where(F.col("trash_reason").isNotNull()).select("tag", "trash_reason").orderBy("tag").limit(limit)


def unique_tags(items: DataFrame) -> DataFrame:
    """Distinct raw tag texts (not normalised), sorted."""
    return items.select(F.explode("tags").alias("t")).select("t.tag").where("tag is not null").distinct().orderBy("tag")


def tag_counts(items: DataFrame, limit: int | None = 100) -> DataFrame:
    """Raw tag texts by number of occurrences, ties by text; all of them when ``limit`` is None."""
    counted = items.select(F.explode("tags").alias("t")).where("t.tag is not null").groupBy("t.tag").agg(F.count("*").alias("n"))
    ordered = counted.orderBy(F.desc("n"), "tag")
    return ordered if limit is None else ordered.limit(limit)
