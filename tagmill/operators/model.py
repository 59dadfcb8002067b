"""Independent logistic units per tag on fixed features: fitting and batch scoring.

Samples are packed into slabs (a matrix in a row) where they are read, weights into blocks of classes. Slabs and blocks meet by an
equi-join on the block, and only sums of gradients or the best scores leave a task. Neither classes nor weights pass the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tagmill.session import cut

#: Samples of a slab, bytes of a block of weights, and of the gradients that a task sums before it hands them on.
SLAB, BLOCK_BYTES, SUMMED_BYTES = 256, 8 << 20, 64 << 20
#: All blocks are broadcast if their counted bytes stay below this; else slabs and blocks are shuffled together.
BROADCAST_BYTES = 64 << 20


def _usable(features: DataFrame, d: int) -> DataFrame:
    """(sample_id, features) of the samples whose features have ``d`` finite components."""
    fine = F.forall("features", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    rows = features.select("sample_id", F.col("features").cast("array<double>").alias("features"))
    return rows.where("sample_id IS NOT NULL").where((F.size("features") == F.lit(d)) & fine)


def _slabs(features: DataFrame, d: int) -> DataFrame:
    """(ids, x): up to SLAB usable samples, each with a last component 1."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), SLAB):
                part = batch.iloc[at : at + SLAB]
                x = np.stack([np.asarray(f, np.float64) for f in part["features"]])
                yield pd.DataFrame({"ids": [part["sample_id"].to_numpy()], "x": [np.c_[x, np.ones(len(x))].tobytes()]})

    return _usable(features, d).mapInPandas(run, "ids array<long>, x binary")


def _met(slabs: DataFrame, weights: DataFrame, d: int, fn: Callable, schema: str, add: bool = False) -> DataFrame:
    """``fn(ids, x, classes, w)`` of every slab with every block of ``weights`` (class_idx, w: d + 1 values).

    With ``add``, ``fn`` gives a gradient row for each class, and a task hands on their sums.
    """
    n = weights.count()
    blocks = max(1, -(-n * (d + 1) * 8 // BLOCK_BYTES))
    packed = weights.withColumn("block", F.pmod(F.xxhash64("class_idx"), F.lit(blocks)).cast("int")).groupBy("block").agg(F.sort_array(F.collect_list(F.struct("class_idx", "w"))).alias("m"))
    packed = packed.select("block", F.col("m.class_idx").alias("classes"), F.flatten("m.w").alias("w"))
    if n * (d + 1) * 8 <= BROADCAST_BYTES:
        packed = F.broadcast(packed)
    pairs = slabs.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).join(packed, "block").select("ids", "x", "classes", "w")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for ids, x, classes, w in zip(batch["ids"], batch["x"], batch["classes"], batch["w"]):
                yield fn(np.asarray(ids), np.frombuffer(x).reshape(-1, d + 1), np.asarray(classes), np.asarray(w, np.float64).reshape(-1, d + 1))

    def summed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[bytes, list] = {}
        for batch in batches:
            for ids, x, classes, w in zip(batch["ids"], batch["x"], batch["classes"], batch["w"]):
                key = np.asarray(classes).tobytes()
                g = fn(None, np.frombuffer(x).reshape(-1, d + 1), classes, np.asarray(w, np.float64).reshape(-1, d + 1))
                if key in held:
                    held[key][1] += g
                else:
                    held[key] = [classes, g]
                if len(held) * BLOCK_BYTES > SUMMED_BYTES:
                    yield from (_gradients(*v) for v in held.values())
                    held = {}
        yield from (_gradients(*v) for v in held.values())

    return pairs.mapInPandas(summed if add else run, schema)


def _gradients(classes: np.ndarray, g: np.ndarray) -> pd.DataFrame:
    return pd.DataFrame({"class_idx": np.asarray(classes, np.int64), "g": list(g)})


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-z))


def _summed(parts: DataFrame) -> DataFrame:
    """(class_idx, g) added up over the tasks' partial sums, a component at a time."""
    cells = parts.select("class_idx", F.posexplode("g").alias("j", "v")).groupBy("class_idx", "j").agg(F.sum("v").alias("v"))
    return cells.groupBy("class_idx").agg(F.sort_array(F.collect_list(F.struct("j", "v"))).alias("m")).select("class_idx", F.col("m.v").alias("g"))


def _positive_sums(features: DataFrame, labels: DataFrame, d: int) -> DataFrame:
    """(class_idx, g): the sum of the features of each class's samples, and their number last."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for c, f in zip(batch["class_idx"], batch["features"]):
                g = held.setdefault(c, np.zeros(d + 1))
                g[:d] += f
                g[d] += 1
            if len(held) * (d + 1) * 8 > SUMMED_BYTES:
                yield pd.DataFrame({"class_idx": list(held), "g": list(held.values())})
                held = {}
        if held:
            yield pd.DataFrame({"class_idx": list(held), "g": list(held.values())})

    rows = _usable(features, d).join(labels, "sample_id")
    return _summed(rows.select("class_idx", "features").mapInPandas(run, "class_idx long, g array<double>"))


def fit(features: DataFrame, labels: DataFrame, classes: DataFrame | None = None, iterations: int = 25, regularisation: float = 0.01) -> DataFrame:
    """One logistic unit per class, all fitted together: ``class_idx, coef, intercept``.

    ``features``: ``sample_id, features`` (array); ``labels``: ``sample_id, class_idx``; ``classes``: ``class_idx`` of a smaller
    model, else every class of the labels. Each iteration is one job that reads the slabs once and writes the weights: an
    accelerated gradient step on the mean log-loss, the coefficients (not the intercept) shrunk by ``regularisation``. The step
    length follows from the features alone. The part of the gradient that the labels make is constant and summed once.

    Samples whose features are null, of another length than most, or not finite take no part; a repeated (sample, class) counts
    once; a class without samples becomes unlikely everywhere. Without samples every weight is 0.
    """
    wanted = cut((labels if classes is None else classes).select(F.col("class_idx").cast("long").alias("class_idx")).where("class_idx IS NOT NULL").distinct())
    length = features.where("features IS NOT NULL").groupBy(F.size("features").alias("d")).agg(F.count("*").alias("n")).agg(F.max_by("d", F.struct("n", -F.col("d"))).alias("d")).first()["d"]
    if length is None:
        return wanted.select("class_idx", F.array().cast("array<double>").alias("coef"), F.lit(0.0).alias("intercept"))
    d = length
    slabs = cut(_slabs(features, d))

    def sizes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n, square = 0, 0.0
        for batch in batches:
            for x in batch["x"]:
                v = np.frombuffer(x)
                n, square = n + len(v) // (d + 1), square + float(v @ v)
        yield pd.DataFrame({"n": [n], "square": [square]})

    size = slabs.select("x").mapInPandas(sizes, "n long, square double").agg(F.sum("n").alias("n"), F.sum("square").alias("square")).first()
    n = size["n"] or 0
    zero = F.array_repeat(F.lit(0.0), d + 1)
    if not n:
        return wanted.select("class_idx", F.slice(zero, 1, d).alias("coef"), F.lit(0.0).alias("intercept"))
    step = 1.0 / (0.25 * size["square"] / n + regularisation)
    once = labels.select("sample_id", F.col("class_idx").cast("long").alias("class_idx")).distinct().join(wanted, "class_idx", "left_semi")
    positive = cut(_positive_sums(features, once, d).withColumnRenamed("g", "s"))
    state = cut(wanted.join(positive, "class_idx", "left").select("class_idx", F.coalesce("s", zero).alias("s"), zero.alias("v"), zero.alias("w")))
    gradient = lambda _, x, __, w: _sigmoid(x @ w.T).T @ x
    for k in range(iterations):
        sums = _summed(_met(slabs, state.select("class_idx", F.col("w")), d, gradient, "class_idx long, g array<double>", add=True))
        moved = F.expr(f"transform(w, (y, j) -> y - {step!r}D * ((g[j] - s[j]) / {n}D + if(j < {d}, {regularisation!r}D * y, 0D)))")
        ahead = F.expr(f"zip_with(next, v, (a, b) -> a + {k / (k + 3.0)!r}D * (a - b))")
        state = cut(state.join(sums, "class_idx").withColumn("next", moved).select("class_idx", "s", F.col("next").alias("v"), ahead.alias("w")))
    return state.select("class_idx", F.slice("v", 1, d).alias("coef"), F.get("v", F.lit(d)).alias("intercept"))


def class_centroids(features: DataFrame, labels: DataFrame) -> DataFrame:
    """Mean feature vector per class as unit weights: a closed-form stand-in for ``fit``."""
    cells = features.join(labels, "sample_id").select("class_idx", F.posexplode(F.col("features").cast("array<double>")).alias("d", "x"))
    means = cells.groupBy("class_idx", "d").agg(F.avg("x").alias("w"))
    # A group here is one value per feature dimension, whatever the number of samples.
    packed = means.groupBy("class_idx").agg(F.sort_array(F.collect_list(F.struct("d", "w"))).alias("m"))
    return packed.select("class_idx", F.transform("m", lambda e: e["w"]).alias("coef"), F.lit(0.0).alias("intercept"))


def predict_top_k(features: DataFrame, weights: DataFrame, k: int = 5) -> DataFrame:
    """``sample_id, top`` with the ``k`` best (class, score); unusable features keep their row with an empty list.

    Each block of classes keeps its k best of a sample, and these are merged; ties go to the smaller class.
    """
    weights = weights.where(F.size("coef") >= 0)
    d = weights.agg(F.max(F.size("coef")).alias("d")).first()["d"] or 0
    rows = weights.where(F.size("coef") == d).select(F.col("class_idx").cast("long").alias("class_idx"), F.concat(F.col("coef").cast("array<double>"), F.array(F.col("intercept").cast("double"))).alias("w"))

    def best(ids: np.ndarray, x: np.ndarray, classes: np.ndarray, w: np.ndarray) -> pd.DataFrame:
        p = _sigmoid(x @ w.T)
        order = np.lexsort((np.broadcast_to(classes, p.shape), -p), axis=1)[:, :k]
        top = [[(int(classes[c]), float(line[c])) for c in cols] for cols, line in zip(order, p)]
        return pd.DataFrame({"sample_id": ids, "top": top})

    parts = _met(_slabs(features, d), cut(rows), d, best, "sample_id long, top array<struct<class_idx:long,score:double>>")
    every = features.select("sample_id", F.array().cast("array<struct<class_idx:long,score:double>>").alias("top"))
    # A sample has one row for each block, each with k scores at most, and an empty one.
    merged = parts.unionByName(every).groupBy("sample_id").agg(F.flatten(F.collect_list("top")).alias("top"))
    ranked = F.array_sort(F.transform("top", lambda t: F.struct((-t["score"]).alias("s"), t["class_idx"].alias("c"))))
    return merged.select(
        "sample_id", F.transform(F.slice(ranked, 1, k), lambda t: F.struct(t["c"].alias("class_idx"), (-t["s"]).alias("score"))).alias("top")
    )


def name_predictions(predicted: DataFrame, vocab: DataFrame) -> DataFrame:
    """``sample_id, rank, tag, confidence`` with class names; unknown classes are dropped."""
    rows = predicted.select("sample_id", F.posexplode("top").alias("p", "t"))
    tags = vocab.select(F.col("idx").alias("class_idx"), "tag")
    return rows.select("sample_id", (F.col("p") + 1).alias("rank"), F.col("t.class_idx").alias("class_idx"), F.col("t.score").alias("confidence")).join(
        tags, "class_idx"
    ).select("sample_id", "rank", "tag", "confidence")


def prediction_records(named: DataFrame, samples: DataFrame, top: int = 5) -> DataFrame:
    """``image, tags: array<struct<tag, confidence>>`` for every sample, failures with an empty list.

    ``samples``: ``sample_id, image``; ``named`` holds at most k rows per sample.
    """
    best = Window.partitionBy("sample_id").orderBy(F.desc("confidence"), "tag")
    kept = named.withColumn("rn", F.row_number().over(best)).where(F.col("rn") <= top)
    lists = kept.groupBy("sample_id").agg(F.sort_array(F.collect_list(F.struct("rn", "tag", "confidence"))).alias("l"))
    tags = F.transform("l", lambda e: F.struct(e["tag"].alias("tag"), e["confidence"].alias("confidence")))
    empty = F.array().cast("array<struct<tag:string,confidence:double>>")
    return samples.join(lists, "sample_id", "left").select("image", F.coalesce(tags, empty).alias("tags"))


def feature_array(column: str = "features"):
    """An ``ml`` vector column as an array."""
    return vector_to_array(F.col(column))
