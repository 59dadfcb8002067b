"""Quality scores by naive Bayes support vectors.

Features are indicators of hashed byte n-grams. Each is scaled by its class log-count ratio, which is counted over all
labelled rows; a linear hinge-loss model over the scaled indicators is then fitted by dual coordinate descent on a bounded
sample of them, and its margins are turned into probabilities by a logistic curve.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagmill.llm.common import bounded_batches, broadcast_if_bounded, narrow, text_or_empty

BITS = 17
DIMS = 1 << BITS
ORDERS = 4
#: Bound of the labelled rows of each class that the hinge-loss fit sees (about; rows are chosen by a hash of their id).
FIT_ROWS = 4_000
#: Bytes of a text whose n-grams are hashed at a time, which bounds memory for very long texts.
CHUNK = 1 << 20


class Grams:
    """Distinct hashed n-grams of texts; one per task, since it reuses its table of marks."""

    def __init__(self) -> None:
        self.marks = np.zeros(DIMS, bool)

    def of(self, text: str | None) -> np.ndarray:
        raw = np.frombuffer((text or "").encode(), np.uint8)
        for at in range(0, max(1, len(raw)), CHUNK):
            part = raw[max(0, at - ORDERS + 1) : at + CHUNK].astype(np.uint32) + np.uint32(1)
            code = np.zeros(len(part), np.uint32)
            for n in range(1, min(ORDERS, len(part)) + 1):
                code = (code[: len(part) - n + 1] * np.uint32(0x01000193)) ^ part[n - 1 :]
                mixed = (code ^ np.uint32(n * 0x3C6EF372)) * np.uint32(0x9E3779B1)
                self.marks[(mixed ^ (mixed >> np.uint32(15))) >> np.uint32(32 - BITS)] = True
        found = np.flatnonzero(self.marks)
        self.marks[found] = False
        return found


@dataclass(frozen=True)
class Model:
    """Score of a text: logistic(slope * mean weight of its grams * sqrt(their number) + intercept)."""

    weights: np.ndarray
    slope: float
    intercept: float

    def margin(self, grams: np.ndarray) -> float:
        return float(self.weights[grams].sum() / np.sqrt(max(1, len(grams))))

    def score(self, grams: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.slope * self.margin(grams) + self.intercept, -30, 30))))


def held_out(doc_id: Column, folds: int = 5) -> Column:
    """Whether a row is kept from training: crc32 of the id's text is divisible by ``folds``."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == 0, F.lit(False))


def class_counts(labelled: DataFrame) -> DataFrame:
    """(gram, good, bad): number of rows of each class that hold a gram; summed inside each task first."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        grams, counts = Grams(), np.zeros((2, DIMS), np.int64)
        for batch in batches:
            for text, label in zip(batch["text"], batch["label"]):
                counts[int(label), grams.of(text)] += 1
        seen = np.flatnonzero(counts.any(0))
        yield pd.DataFrame({"gram": seen, "good": counts[1, seen], "bad": counts[0, seen]})

    parts = labelled.select("text", "label").mapInPandas(run, "gram long, good long, bad long")
    return parts.groupBy("gram").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"))


def log_count_ratios(good: np.ndarray, bad: np.ndarray, smoothing: float = 1.0) -> np.ndarray:
    p, q = good + smoothing, bad + smoothing
    return np.log(p / p.sum()) - np.log(q / q.sum())


def dual_coordinate_descent(rows: list[np.ndarray], ratios: np.ndarray, labels: np.ndarray, cost: float = 1.0, epochs: int = 12) -> tuple[np.ndarray, float]:
    """Hinge-loss weights over the scaled, length-normalised indicators, and the bias."""
    rng = np.random.default_rng(7)
    y = np.where(labels > 0, 1.0, -1.0)
    upper = cost * np.where(y > 0, len(y) / max(1, 2 * (y > 0).sum()), len(y) / max(1, 2 * (y < 0).sum()))
    inverse = [1 / np.sqrt(max(1, len(r))) for r in rows]
    square = np.array([(ratios[r] ** 2).sum() * s * s + 1 for r, s in zip(rows, inverse)])
    alpha, w, bias = np.zeros(len(y)), np.zeros(len(ratios)), 0.0  # w: weights times ratios, summed unscaled
    for _ in range(epochs):
        moved = 0.0
        for i in rng.permutation(len(y)):
            r, s = rows[i], inverse[i]
            gradient = y[i] * ((w[r] * ratios[r]).sum() * s + bias) - 1
            new = min(max(alpha[i] - gradient / square[i], 0.0), upper[i])
            step = (new - alpha[i]) * y[i]
            if step:
                w[r] += step * s * ratios[r]
                bias += step
                moved = max(moved, abs(step))
                alpha[i] = new
        if moved < 1e-3:
            break
    return w * ratios, bias


def logistic_fit(margins: np.ndarray, labels: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """Slope and intercept of a lightly regularised logistic curve (Newton steps)."""
    x = np.c_[margins, np.ones(len(margins))]
    n1, n0 = labels.sum(), (1 - labels).sum()
    target = np.where(labels > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))  # keeps separable margins finite
    beta = np.array([1.0, 0.0])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        hessian = x.T @ (x * (p * (1 - p))[:, None]) + 1e-3 * np.eye(2)
        step = np.linalg.solve(hessian, x.T @ (target - p) - 1e-3 * (beta - [1.0, 0.0]))
        beta = beta + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(max(beta[0], 1e-6)), float(beta[1])


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", fit_rows: int = FIT_ROWS) -> Model:
    """A model of ``label_col`` (1 good, 0 bad) from all rows whose id is labelled and not held out.

    Null ids, null labels and labels other than 0 and 1 are ignored; an id labelled twice takes the lower label; null texts are
    empty. Without rows of both classes the model scores every text with the share of good rows (0.5 without any row).
    """
    bounded_batches(docs.sparkSession)
    marks = narrow(labels, id_col, label_col).select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label"))
    marks = marks.where("id is not null and label in (0, 1)").where(~held_out(F.col("id"))).groupBy("id").agg(F.min("label").alias("label"))
    texts = narrow(docs, id_col, text_col).select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    labelled = texts.where(~held_out(F.col("id"))).join(broadcast_if_bounded(marks, 32), "id")
    sizes = {r["label"]: r["n"] for r in marks.groupBy("label").agg(F.count("*").alias("n")).collect()}
    n1, n0 = sizes.get(1, 0), sizes.get(0, 0)
    if not n1 or not n0:
        share = (n1 + 1) / (n1 + n0 + 2)
        return Model(np.zeros(DIMS), 1.0, float(np.log(share / (1 - share))))
    counts = class_counts(labelled).toArrow()  # at most DIMS rows, as columns rather than as Python objects
    gram, good, bad = counts["gram"].to_numpy(), np.zeros(DIMS), np.zeros(DIMS)
    good[gram], bad[gram] = counts["good"].to_numpy(), counts["bad"].to_numpy()
    ratios = log_count_ratios(good, bad)

    # A bounded share of ids, by hash, so the choice does not depend on how the rows are partitioned.
    draw = F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < F.when(F.col("label") == 1, F.lit(fit_rows / n1)).otherwise(fit_rows / n0) * (1 << 20)
    sample = texts.join(F.broadcast(marks.where(draw)), "id").select("id", "text", "label").repartition(1)

    def train(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        grams, rows, ids, y = Grams(), [], [], []
        for batch in batches:
            rows += [grams.of(t).astype(np.int32) for t in batch["text"]]
            ids += batch["id"].tolist()
            y += batch["label"].tolist()
        order = sorted(range(len(ids)), key=lambda i: (ids[i], len(rows[i])))  # whatever order the rows came in
        rows, y = [rows[i] for i in order], np.array(y)[order]
        # Margins for the curve come from models that did not see the row.
        fold, margins = np.arange(len(y)) % 3, np.zeros(len(y))
        for k in range(3):
            w, b = dual_coordinate_descent([r for r, f in zip(rows, fold) if f != k], ratios, y[fold != k])
            margins[fold == k] = [w[r].sum() / np.sqrt(max(1, len(r))) + b for r, f in zip(rows, fold) if f == k]
        prior = np.where(y > 0, n1, n0) / np.where(y > 0, max(1, (y > 0).sum()), max(1, (y == 0).sum()))
        slope, intercept = logistic_fit(margins, y)
        intercept += float(np.log(prior[y > 0].mean() / prior[y == 0].mean())) if 0 < y.sum() < len(y) else 0.0
        w, b = dual_coordinate_descent(rows, ratios, y)
        yield pd.DataFrame({"weights": [w.tobytes()], "slope": [slope], "intercept": [intercept + slope * b]})

    row = sample.mapInPandas(train, "weights binary, slope double, intercept double").first()
    if row is None:
        return Model(np.zeros(DIMS), 1.0, float(np.log((n1 + 1) / (n0 + 1))))
    return Model(np.frombuffer(row["weights"]), row["slope"], row["intercept"])


def score(docs: DataFrame, model: Model, threshold: float = 0.3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` unchanged, with quality_score in [0, 1] and quality_predicted (1 from ``threshold`` on) for every row.

    Empty and null texts get the score of a text without grams; whole texts are read; an empty table stays empty. Only the
    text enters the score. Input columns with those two names are replaced.
    """

    @F.pandas_udf("double")
    def run(texts: pd.Series) -> pd.Series:
        grams = Grams()
        return pd.Series([model.score(grams.of(t)) for t in texts], dtype="float64")

    bounded_batches(docs.sparkSession)
    scored = docs.withColumn("quality_score", run(text_or_empty(text_col)))
    return scored.withColumn("quality_predicted", (F.col("quality_score") >= threshold).cast("int"))
