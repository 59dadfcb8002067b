"""Approximate nearest neighbours through learned partitions.

A neighbour graph of a bounded sample is cut into balanced parts, a small network learns from it which parts hold a vector's
neighbours, every row is filed in its most probable part, and a query is routed to its several most probable parts, whose rows are
ranked by their exact inner products.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tagmill.llm.common import narrow
from tagmill.session import cut

#: Bound (about) of the rows that the partition is learned on, chosen by a hash of their id.
FIT_ROWS = 8_192
PARTS = 16
#: A part has at least so many rows of the sample, so a small table is not cut at all.
PART_ROWS = 256
GRAPH_DEGREE = 16
HIDDEN = 128
#: Probability of holding a neighbour that the visited parts must add up to, and the fewest visited.
COVER, LEAST_PARTS = 0.97, 3
#: Rows of an index block and of a query block: larger parts are split, so a hot part is no hot task.
INDEX_BLOCK, QUERY_BLOCK = 16_384, 2_048

Network = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def graph(x: np.ndarray, degree: int) -> np.ndarray:
    """For each row the ``degree`` others of largest inner product."""
    out = []
    for at in range(0, len(x), 1024):
        s = x[at : at + 1024] @ x.T
        s[np.arange(len(s)), np.arange(at, at + len(s))] = -np.inf
        out.append(np.argpartition(-s, min(degree, len(x) - 1) - 1, axis=1)[:, :degree])
    return np.concatenate(out)


def balanced_parts(x: np.ndarray, links: np.ndarray, parts: int, sweeps: int = 12, slack: float = 1.1) -> np.ndarray:
    """A part for each row, none above ``slack`` times the mean, that cuts few links.

    Start: halves along the direction of largest spread, again and again. Sweeps: rows move to the part of most of their
    neighbours, largest gain first, while it has room.
    """
    part = np.zeros(len(x), np.int64)
    todo, free = [(np.arange(len(x)), parts, 0)], 0
    while todo:
        rows, n, name = todo.pop()
        part[rows] = name
        if n < 2 or len(rows) < 2:
            continue
        centred = x[rows] - x[rows].mean(0)
        along = centred @ np.linalg.svd(centred.T @ centred)[0][:, 0]
        order, left = rows[np.argsort(along, kind="stable")], n // 2
        at = len(rows) * left // n
        free += 1
        todo += [(order[:at], left, name), (order[at:], n - left, free)]
    room = int(np.ceil(slack * len(x) / parts))
    sources = np.repeat(np.arange(len(x)), links.shape[1])
    for _ in range(sweeps):
        pull = np.zeros((len(x), parts))
        np.add.at(pull, (sources, part[links.ravel()]), 1)
        np.add.at(pull, (links.ravel(), part[sources]), 1)
        best = pull.argmax(1)
        gain = pull[np.arange(len(x)), best] - pull[np.arange(len(x)), part]
        size, moved = np.bincount(part, minlength=parts), 0
        for i in np.argsort(-gain, kind="stable"):
            if gain[i] <= 0:
                break
            if size[best[i]] < room:
                size[part[i]] -= 1
                size[best[i]] += 1
                part[i] = best[i]
                moved += 1
        if not moved:
            break
    return part


def probabilities(net: Network, x: np.ndarray) -> np.ndarray:
    """Probability of each part for each row."""
    w1, b1, w2, b2 = net
    z = np.maximum(_scaled(x) @ w1 + b1, 0) @ w2 + b2
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def _scaled(x: np.ndarray) -> np.ndarray:
    """Unit rows: the order of inner products with one query does not depend on the query's length."""
    return x * (np.sqrt(x.shape[1]) / np.linalg.norm(x, axis=1, keepdims=True))


def train(x: np.ndarray, target: np.ndarray, hidden: int = HIDDEN, steps: int = 300, rate: float = 0.01) -> Network:
    """One hidden layer, cross-entropy against the shares of parts among each row's neighbours, Adam on full batches."""
    rng = np.random.default_rng(11)
    inputs, n = _scaled(x), len(x)
    weights = [rng.normal(0, np.sqrt(2 / x.shape[1]), (x.shape[1], hidden)), np.zeros(hidden), rng.normal(0, np.sqrt(1 / hidden), (hidden, target.shape[1])), np.zeros(target.shape[1])]
    mean, square = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    for step in range(1, steps + 1):
        h = np.maximum(inputs @ weights[0] + weights[1], 0)
        z = h @ weights[2] + weights[3]
        e = np.exp(z - z.max(1, keepdims=True))
        dz = (e / e.sum(1, keepdims=True) - target) / n
        dh = (dz @ weights[2].T) * (h > 0)
        for i, g in enumerate((inputs.T @ dh + 1e-4 * weights[0], dh.sum(0), h.T @ dz + 1e-4 * weights[2], dz.sum(0))):
            mean[i] = 0.9 * mean[i] + 0.1 * g
            square[i] = 0.999 * square[i] + 0.001 * g * g
            weights[i] -= rate * (mean[i] / (1 - 0.9**step)) / (np.sqrt(square[i] / (1 - 0.999**step)) + 1e-8)
    return tuple(weights)


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, np.float64) for v in column]) if len(column) else np.zeros((0, 1))


def usable(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, v): rows with an id and a vector that has components, all finite and not all zero; an id that repeats counts once."""
    fine = F.forall("v", lambda c: c.isNotNull() & (F.abs(c) < float("inf")) & ~F.isnan(c)) & F.exists("v", lambda c: c != 0)
    base = narrow(rows, id_col, vector_col).select(F.col(id_col).alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    return base.where("vec_id is not null and v is not null and size(v) > 0").where(fine).dropDuplicates(["vec_id"])


def fit(rows: DataFrame, fit_rows: int = FIT_ROWS, parts: int = PARTS) -> Network | None:
    """The routing network, learned in one task from a bounded sample of ``rows`` (vec_id, v); None without rows."""
    n = rows.count()
    sample = rows.where(F.pmod(F.xxhash64("vec_id"), F.lit(1 << 20)) < min(1.0, fit_rows / max(n, 1)) * (1 << 20)).repartition(1)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        df = pd.concat([*batches, pd.DataFrame({"vec_id": [], "v": []})]).sort_values("vec_id")
        if not len(df):
            return
        x = _matrix(df["v"])
        k = max(1, min(parts, len(x) // PART_ROWS))
        target = np.ones((len(x), 1))
        if k > 1:
            links = graph(x, GRAPH_DEGREE)
            part = balanced_parts(x, links, k)
            target = np.zeros((len(x), k))
            np.add.at(target, (np.repeat(np.arange(len(x)), links.shape[1]), part[links.ravel()]), 1)
            target = 0.9 * target / target.sum(1, keepdims=True)
            target[np.arange(len(x)), part] += 0.1
        net = train(x, target) if k > 1 else train(x, target, hidden=1, steps=1)
        yield pd.DataFrame({"shape": [list(w.shape) for w in net], "data": [w.tobytes() for w in net], "i": range(len(net))})

    found = sorted(sample.mapInPandas(run, "shape array<int>, data binary, i int").collect(), key=lambda r: r["i"])
    return tuple(np.frombuffer(r["data"]).reshape(r["shape"]) for r in found) or None


def _routed(rows: DataFrame, net: Network, searching: bool) -> DataFrame:
    """(vec_id, v, parts): the most probable part of each row, or for a search as many as add up to COVER."""

    @F.pandas_udf("array<int>")
    def run(vectors: pd.Series) -> pd.Series:
        p = probabilities(net, _matrix(vectors))
        order = np.argsort(-p, axis=1, kind="stable")
        if not searching:
            return pd.Series(list(order[:, :1].astype(np.int32)))
        total = np.cumsum(np.take_along_axis(p, order, 1), 1)
        need = np.maximum((total < COVER).sum(1) + 1, LEAST_PARTS)
        return pd.Series([o[:n].astype(np.int32) for o, n in zip(order, need)])

    return rows.select("vec_id", "v", run("v").alias("parts"))


def search(rows: DataFrame, queries: DataFrame, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", **options) -> DataFrame:
    """(query_id, rank, vec_id, score): for each query its ``k`` nearest among the rows of the parts it is routed to.

    Nearness is the inner product in double precision; ties go to the smaller id; a query does not find its own id. Vectors that
    are null, empty, zero or hold null or non-finite components take no part on either side; of rows that repeat an id one counts.
    Vectors must have one length. An empty table gives an empty result. A query finds fewer than ``k`` rows only if its parts hold
    fewer; every part is read whole, split into blocks where it is large.
    """
    index, wanted = cut(usable(rows, id_col, vector_col)), cut(usable(queries, id_col, vector_col))
    net = fit(index, **options)
    schema = "query_id long, vec_id long, score double"
    if net is None:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    filed = cut(_routed(index, net, False).select("vec_id", "v", F.col("parts")[0].alias("part")))
    asked = cut(_routed(wanted, net, True).select("vec_id", "v", F.explode("parts").alias("part")))
    # Numbers of blocks by part: as many rows as there are parts.
    blocks = filed.groupBy("part").agg(F.ceil(F.count("*") / INDEX_BLOCK).cast("int").alias("ib"))
    blocks = blocks.join(asked.groupBy("part").agg(F.ceil(F.count("*") / QUERY_BLOCK).cast("int").alias("qb")), "part")
    blocks = F.broadcast(cut(blocks))
    salt = lambda n, seed: F.pmod(F.xxhash64("vec_id", F.lit(seed)), F.col(n)).cast("int")
    left = filed.join(blocks, "part").select("part", salt("ib", 1).alias("b"), F.explode(F.sequence(F.lit(0), F.col("qb") - 1)).alias("q"), "vec_id", "v")
    right = asked.join(blocks, "part").select("part", F.explode(F.sequence(F.lit(0), F.col("ib") - 1)).alias("b"), salt("qb", 2).alias("q"), "vec_id", "v")

    def run(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(a) and len(b):
            x, ids = _matrix(a["v"]), a["vec_id"].to_numpy()
            y, names = _matrix(b["v"]), b["vec_id"].to_numpy()
            for at in range(0, len(y), 256):
                s = y[at : at + 256] @ x.T
                s[names[at : at + 256, None] == ids[None, :]] = -np.inf
                n = min(k, s.shape[1])
                bar = np.partition(s, s.shape[1] - n, axis=1)[:, s.shape[1] - n]
                for i, row in enumerate(s):
                    near = np.flatnonzero((row >= bar[i] - 1e-9 * max(1.0, abs(bar[i]) if np.isfinite(bar[i]) else 1.0)) & (row > -np.inf))
                    exact = (x[near] * y[at + i]).sum(1)  # the same for equal vectors wherever they lie in the block
                    best = np.lexsort((ids[near], -exact))[:k]
                    out.append(pd.DataFrame({"query_id": names[at + i], "vec_id": ids[near][best], "score": exact[best]}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})

    found = left.groupBy("part", "b", "q").cogroup(right.groupBy("part", "b", "q")).applyInPandas(run, schema)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
