"""Multi-label metrics on long tables.

``scores``: ``sample_id, class_idx, score`` for every sample and class. ``truth``: ``sample_id, class_idx`` of the true
ones. The dense sample-by-class matrix never exists: only positive cells and the best k per sample leave a task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Decision threshold and the constant that keeps a ratio defined.
DECISION = 0.5
EPSILON = 1e-10


def _size(scores: DataFrame) -> DataFrame:
    return scores.agg(F.count_distinct("sample_id").alias("n"), F.count_distinct("class_idx").alias("c"))


def sample_counts(scores: DataFrame, truth: DataFrame) -> DataFrame:
    """``sample_id, tp, fp, fn`` of the samples with any predicted or true class."""
    predicted = scores.where(F.col("score") > DECISION).select("sample_id", "class_idx", F.lit(1).alias("p"), F.lit(0).alias("t"))
    actual = truth.select("sample_id", "class_idx", F.lit(0).alias("p"), F.lit(1).alias("t"))
    cells = predicted.unionByName(actual).groupBy("sample_id", "class_idx").agg(F.max("p").alias("p"), F.max("t").alias("t"))
    return cells.groupBy("sample_id").agg(
        F.count_if((F.col("p") == 1) & (F.col("t") == 1)).alias("tp"),
        F.count_if((F.col("p") == 1) & (F.col("t") == 0)).alias("fp"),
        F.count_if((F.col("p") == 0) & (F.col("t") == 1)).alias("fn"),
    )


def precision_recall_f1(scores: DataFrame, truth: DataFrame) -> DataFrame:
    """Mean per-sample precision and recall, and the F1 of those means."""
    n = scores.agg(F.count_distinct("sample_id")).scalar()
    per_sample = sample_counts(scores, truth).select(
        (F.col("tp") / (F.col("tp") + F.col("fp") + EPSILON)).alias("p"), (F.col("tp") / (F.col("tp") + F.col("fn") + EPSILON)).alias("r")
    )
    # Samples without any positive cell contribute 0 to both sums but count in n.
    means = per_sample.agg(F.coalesce(F.sum("p"), F.lit(0.0)).alias("p"), F.coalesce(F.sum("r"), F.lit(0.0)).alias("r"))
    means = means.withColumn("_n", n).select((F.col("p") / F.col("_n")).alias("precision"), (F.col("r") / F.col("_n")).alias("recall"))
    p, r = F.col("precision"), F.col("recall")
    return means.withColumn("f1_score", 2 * p * r / (p + r + EPSILON))


def hamming_accuracy(scores: DataFrame, truth: DataFrame) -> DataFrame:
    """Share of cells decided right, from the wrong ones."""
    size = _size(scores).select(F.struct("n", "c")).scalar()
    wrong = sample_counts(scores, truth).agg(F.coalesce(F.sum(F.col("fp") + F.col("fn")), F.lit(0)).alias("wrong"))
    return wrong.withColumn("_s", size).select((1 - F.col("wrong") / (F.col("_s.n") * F.col("_s.c"))).alias("hamming_accuracy"))


def top_k(scores: DataFrame, k: int = 5) -> DataFrame:
    """The ``k`` best classes per sample with ``rank``; ties by class. Cut to k before the shuffle."""
    best = Window.partitionBy("sample_id").orderBy(F.desc("score"), "class_idx")
    return scores.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def _top_hits(scores: DataFrame, truth: DataFrame, k: int) -> DataFrame:
    marked = truth.select("sample_id", "class_idx", F.lit(1).alias("hit")).distinct()
    return top_k(scores, k).join(marked, ["sample_id", "class_idx"], "left").withColumn("hit", F.coalesce("hit", F.lit(0)))


def top_k_accuracy(scores: DataFrame, truth: DataFrame, k: int = 5) -> DataFrame:
    """Share of samples with at least one true class among the best ``k``."""
    per_sample = _top_hits(scores, truth, k).groupBy("sample_id").agg(F.max("hit").alias("hit"))
    return per_sample.agg(F.avg("hit").alias(f"top_{k}_accuracy"))


def mean_average_precision(scores: DataFrame, truth: DataFrame, k: int = 5) -> DataFrame:
    """mAP@k over the samples that have a true class."""
    ranks = Window.partitionBy("sample_id").orderBy("rank").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    at_hit = F.when(F.col("hit") == 1, F.sum("hit").over(ranks) / F.col("rank")).otherwise(F.lit(0.0))
    gained = _top_hits(scores, truth, k).withColumn("gain", at_hit).groupBy("sample_id").agg(F.sum("gain").alias("gain"))
    true_counts = truth.distinct().groupBy("sample_id").agg(F.count("*").alias("n_true"))
    ap = gained.join(true_counts, "sample_id").select((F.col("gain") / F.least("n_true", F.lit(k))).alias("ap"))
    return ap.agg(F.avg("ap").alias("mean_average_precision"))


def metrics(scores: DataFrame, truth: DataFrame, k: int = 5) -> DataFrame:
    """All metrics in one row."""
    parts = [
        hamming_accuracy(scores, truth),
        top_k_accuracy(scores, truth, k),
        mean_average_precision(scores, truth, k),
    ]
    row = precision_recall_f1(scores, truth)
    for part in parts:
        name = part.columns[0]
        row = row.withColumn(name, part.scalar())
    return row


def sample_predictions(scores: DataFrame, truth: DataFrame, vocab: DataFrame, k: int = 5, samples: int = 3, names: int = 5) -> DataFrame:
    """For the first ``samples`` samples: true tag names (at most ``names``) next to the predicted ones with scores."""
    tags = vocab.select(F.col("idx").alias("class_idx"), "tag")
    shown = scores.select("sample_id").distinct().orderBy("sample_id").limit(samples)
    by_class = Window.partitionBy("sample_id").orderBy("class_idx")
    actual = (
        truth.join(shown, "sample_id").join(tags, "class_idx").withColumn("rn", F.row_number().over(by_class)).where(F.col("rn") <= names)
    )
    actual = actual.groupBy("sample_id").agg(F.sort_array(F.collect_list(F.struct("rn", "tag"))).alias("t"))
    predicted = top_k(scores.join(shown, "sample_id"), k).join(tags, "class_idx")
    text = F.concat("tag", F.lit(" ("), F.format_string("%.3f", "score"), F.lit(")"))
    predicted = predicted.groupBy("sample_id").agg(F.sort_array(F.collect_list(F.struct("rank", text.alias("tag")))).alias("p"))
    join = lambda c: F.array_join(F.transform(c, lambda x: x["tag"]), ", ")
    return (
        shown.join(actual, "sample_id", "left")
        .join(predicted, "sample_id", "left")
        .select("sample_id", F.coalesce(join("t"), F.lit("")).alias("true_tags"), F.coalesce(join("p"), F.lit("")).alias("predicted_tags"))
    )
