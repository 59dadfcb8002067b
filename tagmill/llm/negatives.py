"""Hard negatives through a multiway hyperplane tree, in the manner of a geometric near-neighbour access tree.

A node of the tree has several split points, and a row belongs to the subtree of its nearest one. Each split point stores the range of its
distances to the rows of every sibling subtree. A search for scores within a window is a search within an annulus around the anchor; a
subtree is eliminated where a stored range, or the hyperplane between two split points, shows that the annulus misses it. The leaves that
stay are read whole, in blocks, by exact integer inner products.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagmill.session import cut

POSITIVES, NEGATIVES = 5, 10
#: A negative's score lies between these hundredths of the positive's.
LEAST, MOST = 30, 90
#: Components become floor(SCALE * x); rows with larger ones than BOUND have no inner product that a long can hold for sure.
SCALE, BOUND = 256, 1 << 27
#: Bound (about) of the rows that split points are drawn from, split points of a node, and rows of a leaf to aim at.
FIT_ROWS, FAN, LEAF_ROWS = 16_384, 8, 4_096
#: Fewest rows of the sample in a node that is split.
LEAST_SAMPLE = 64
#: Rows of an index block and of an anchor block: larger leaves are split, so a hot leaf is no hot task.
INDEX_BLOCK, ANCHOR_BLOCK = 16_384, 1_024


@dataclass
class Tree:
    """Node t has split points ``first[t]`` to ``first[t + 1]``; ``child`` of a point is the node below, or -1 - leaf."""

    points: np.ndarray
    first: np.ndarray
    child: np.ndarray
    leaves: int

    @classmethod
    def grow(cls, x: np.ndarray, leaf_rows: int, fan: int = FAN) -> Tree:
        """A tree over a sample: split points are drawn by chance and thinned to those far apart from each other."""
        rng, points, first, child, leaves = np.random.default_rng(5), [], [0], [], 0
        todo: list[tuple[np.ndarray, int]] = [(np.arange(len(x)), -1)]
        while todo:
            rows, above = todo.pop(0)
            chosen = _far_apart(x, rng.choice(rows, min(len(rows), 3 * fan), replace=False), fan) if len(rows) > leaf_rows else rows[:0]
            if above >= 0:
                child[above] = len(first) - 1 if len(chosen) > 1 else -1 - leaves
            if len(chosen) < 2:
                leaves += 1
                if above < 0:  # a tree of one leaf
                    points, child = [np.zeros(x.shape[1])], [-1]
                    first.append(1)
                continue
            near = squares(x[rows], x[chosen]).argmin(1)
            for j in range(len(chosen)):
                todo.append((rows[near == j], len(points) + j))
            points += list(x[chosen])
            child += [0] * len(chosen)
            first.append(len(points))
        return cls(np.array(points), np.array(first), np.array(child), leaves)

    def descend(self, x: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """(node, rows that come to it, their squared distances to its split points, the place of the nearest)."""
        at = {0: np.arange(len(x))}
        for node in range(len(self.first) - 1):
            rows = at.pop(node, None)
            if rows is None or not len(rows):
                continue
            d = squares(x[rows], self.points[self.first[node] : self.first[node + 1]])
            near = d.argmin(1)
            yield node, rows, d, near
            for j in np.unique(near):
                below = self.child[self.first[node] + j]
                if below >= 0:
                    at[below] = rows[near == j]

    def leaf_of(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros(len(x), np.int32)
        for node, rows, _, near in self.descend(x):
            below = self.child[self.first[node] + near]
            out[rows[below < 0]] = -1 - below[below < 0]
        return out


def squares(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Squared distances, a row for each of x."""
    return np.maximum((x * x).sum(1)[:, None] + (y * y).sum(1)[None, :] - 2 * (x @ y.T), 0)


def _far_apart(x: np.ndarray, candidates: np.ndarray, n: int) -> np.ndarray:
    """``n`` of the candidates at most, each the farthest from those before it; none that equals another."""
    chosen = [candidates[0]]
    nearest = squares(x[candidates], x[candidates[:1]])[:, 0]
    while len(chosen) < n and nearest.max() > 0:
        chosen.append(candidates[nearest.argmax()])
        nearest = np.minimum(nearest, squares(x[candidates], x[chosen[-1:]])[:, 0])
    return np.array(chosen)


@dataclass
class Ranges:
    """Least and largest distance of each split point to the rows of each sibling subtree, and of squared lengths of each leaf's rows."""

    low: np.ndarray
    high: np.ndarray
    shortest: np.ndarray
    longest: np.ndarray

    @classmethod
    def empty(cls, tree: Tree) -> Ranges:
        shape = (len(tree.points), int(np.diff(tree.first).max()))
        return cls(np.full(shape, np.inf), np.full(shape, -np.inf), np.full(tree.leaves, np.inf), np.full(tree.leaves, -np.inf))

    def add(self, tree: Tree, x: np.ndarray) -> None:
        length = (x * x).sum(1)
        for node, rows, d, near in tree.descend(x):
            a, b = tree.first[node], tree.first[node + 1]
            d = np.sqrt(d)
            for j in np.unique(near):
                inside = near == j
                self.low[a:b, j] = np.minimum(self.low[a:b, j], d[inside].min(0))
                self.high[a:b, j] = np.maximum(self.high[a:b, j], d[inside].max(0))
                leaf = -1 - tree.child[a + j]
                if leaf >= 0:
                    self.shortest[leaf] = min(self.shortest[leaf], length[rows[inside]].min())
                    self.longest[leaf] = max(self.longest[leaf], length[rows[inside]].max())

    def scores(self, tree: Tree, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(least, largest) inner product that each anchor (a row of x) can have with a row of each leaf; an empty leaf has none."""
        length = (x * x).sum(1)
        least, most = np.full((len(x), tree.leaves), np.inf), np.full((len(x), tree.leaves), -np.inf)
        todo = [(0, np.zeros(len(x)), np.full(len(x), np.inf))]
        while todo:
            node, near, far = todo.pop()
            a, b = tree.first[node], tree.first[node + 1]
            points = tree.points[a:b]
            square = squares(x, points)
            d, apart = np.sqrt(square), np.sqrt(squares(points, points))
            for j in range(b - a):
                if not np.isfinite(self.low[a, j]):
                    continue  # nothing was filed below
                low = np.maximum(near, np.maximum(d - self.high[a:b, j], self.low[a:b, j] - d).max(1))
                others = apart[:, j] > 0
                if others.any():  # the rows lie on this point's side of each hyperplane
                    low = np.maximum(low, ((square[:, j, None] - square[:, others]) / (2 * apart[others, j])).max(1))
                high = np.minimum(far, (d + self.high[a:b, j]).min(1))
                leaf = -1 - tree.child[a + j]
                if leaf < 0:
                    todo.append((tree.child[a + j], low, high))
                    continue
                slack = 1e-6 * (length + self.longest[leaf] + 1)  # distances are rounded
                most[:, leaf] = (length + self.longest[leaf] - low**2) / 2 + slack
                least[:, leaf] = (length + self.shortest[leaf] - high**2) / 2 - slack
        return least, most


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, np.float64) for v in column]) if len(column) else np.zeros((0, 1))


def products(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Exact inner products of integers held as doubles: in doubles where every sum stays exact, else in long integers."""
    if not x.size or not y.size or np.abs(x).max() * np.abs(y).max() * x.shape[1] < 2.0**53:
        return (x @ y.T).astype(np.int64)
    return x.astype(np.int64) @ y.astype(np.int64).T


def first(scores: np.ndarray, ids: np.ndarray, n: int) -> np.ndarray:
    """Places of the ``n`` largest scores, ties by the smaller id."""
    if len(scores) > n:
        bar = np.partition(scores, len(scores) - n)[len(scores) - n]
        at = np.flatnonzero(scores >= bar)
        return at[np.lexsort((ids[at], -scores[at]))[:n]]
    return np.lexsort((ids, -scores))


def usable(rows: DataFrame, anchors: Column, id_col: str, label_col: str, vector_col: str) -> DataFrame:
    """(vec_id, label, y, anchor): rows that take part, components as integers; of rows that repeat an id the least (label, vector)."""
    base = rows.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{label_col}`").cast("long").alias("label"), F.col(f"`{vector_col}`").cast("array<double>").alias("v"), F.coalesce(anchors, F.lit(False)).alias("anchor"))
    fine = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < BOUND / SCALE))
    base = base.where("vec_id is not null and label is not null and v is not null").where(fine)
    base = base.select("vec_id", "label", F.transform("v", lambda c: F.floor(c * SCALE).cast("int")).alias("y"), "anchor")
    base = cut(base.groupBy("vec_id").agg(F.min(F.struct("label", "y", "anchor")).alias("r")).select("vec_id", "r.label", "r.y", "r.anchor"))
    # One length: the most frequent one, the smaller of two.
    length = base.groupBy(F.size("y").alias("d")).agg(F.count("*").alias("n")).agg(F.max_by("d", F.struct("n", -F.col("d")))).scalar()
    return base.where(F.size("y") == length)


def grow(rows: DataFrame, n: int, fit_rows: int = FIT_ROWS, leaf_rows: int = LEAF_ROWS) -> Tree | None:
    """The tree's split points, drawn in one task from about ``fit_rows`` of ``rows`` (vec_id, y) at most; None without rows."""
    sample = rows.where(F.pmod(F.xxhash64("vec_id"), F.lit(1 << 20)) < min(1.0, fit_rows / max(n, 1)) * (1 << 20)).select("vec_id", "y")
    in_sample = max(LEAST_SAMPLE, int(leaf_rows * min(1.0, fit_rows / max(n, 1))))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        df = pd.concat([*batches, pd.DataFrame({"vec_id": [], "y": []})]).sort_values("vec_id")
        if len(df):
            tree = Tree.grow(_matrix(df["y"]), in_sample)
            yield pd.DataFrame({"points": [tree.points.tobytes()], "first": [tree.first.tolist()], "child": [tree.child.tolist()], "leaves": [tree.leaves]})

    row = sample.repartition(1).mapInPandas(run, "points binary, first array<int>, child array<int>, leaves int").first()
    if row is None:
        return None
    return Tree(np.frombuffer(row["points"]).reshape(len(row["child"]), -1), np.array(row["first"]), np.array(row["child"]), row["leaves"])


def ranges(rows: DataFrame, tree: Tree) -> Ranges:
    """The tree's ranges over all ``rows`` (y), reduced inside each task first: as many numbers as split points times siblings."""
    shared = rows.sparkSession.sparkContext.broadcast(tree)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tree = shared.value
        found = Ranges.empty(tree)
        for batch in batches:
            if len(batch):
                found.add(tree, _matrix(batch["y"]))
        point, j = np.nonzero(np.isfinite(found.low))
        leaf = np.flatnonzero(np.isfinite(found.shortest))
        low, high = np.r_[found.low[point, j], found.shortest[leaf]], np.r_[found.high[point, j], found.longest[leaf]]
        yield pd.DataFrame({"a": np.r_[point, leaf], "j": np.r_[j, np.full(len(leaf), -1)], "low": low, "high": high})

    cells = rows.select("y").mapInPandas(run, "a int, j int, low double, high double")
    out = Ranges.empty(tree)
    for r in cells.groupBy("a", "j").agg(F.min("low").alias("low"), F.max("high").alias("high")).collect():
        if r["j"] < 0:
            out.shortest[r["a"]], out.longest[r["a"]] = r["low"], r["high"]
        else:
            out.low[r["a"], r["j"]], out.high[r["a"], r["j"]] = r["low"], r["high"]
    return out


def _filed(rows: DataFrame, tree: Tree) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast(tree)

    @F.pandas_udf("int")
    def leaf(y: pd.Series) -> pd.Series:
        return pd.Series(shared.value.leaf_of(_matrix(y)), dtype="int32")

    return rows.withColumn("leaf", leaf("y"))


def _visited(anchors: DataFrame, tree: Tree, known: Ranges) -> DataFrame:
    """``anchors`` (…, y, low, high, skip) once for each leaf but ``skip`` whose possible scores meet a window from low to high."""
    shared = anchors.sparkSession.sparkContext.broadcast((tree, known))

    @F.pandas_udf("array<int>")
    def leaves(y: pd.Series, low: pd.Series, high: pd.Series, skip: pd.Series) -> pd.Series:
        least, most = shared.value[1].scores(shared.value[0], _matrix(y))
        out = []
        for a, b, lows, highs, no in zip(least, most, low, high, skip):
            meets = np.zeros(len(a), bool)
            for p, q in zip(lows, highs):
                meets |= (a <= q) & (b >= p)
            if no >= 0:
                meets[no] = False
            out.append(np.flatnonzero(meets).astype(np.int32))
        return pd.Series(out)

    return anchors.select("*", F.explode(leaves("y", "low", "high", "skip")).alias("leaf"))


def _scan(index: DataFrame, visits: DataFrame, fn: Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """``fn`` of the rows and the visiting anchors of each leaf; large leaves and crowds of anchors meet in blocks."""
    sizes = index.groupBy("leaf").agg(F.ceil(F.count("*") / INDEX_BLOCK).cast("int").alias("ib"))
    crowds = visits.groupBy("leaf").agg(F.ceil(F.count("*") / ANCHOR_BLOCK).cast("int").alias("ab"))
    blocks = F.broadcast(cut(sizes.join(crowds, "leaf")))  # a row for each leaf, whose number the sample bounds
    salt = lambda n, seed: F.pmod(F.xxhash64("vec_id", F.lit(seed)), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = index.join(blocks, "leaf").select("leaf", salt("ib", 1).alias("b"), every("ab").alias("c"), *[c for c in index.columns if c != "leaf"])
    right = visits.join(blocks, "leaf").select("leaf", every("ib").alias("b"), salt("ab", 2).alias("c"), *[c for c in visits.columns if c != "leaf"])

    def run(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        return fn(a, b) if len(a) and len(b) else fn(a[:0], b[:0])

    return left.groupBy("leaf", "b", "c").cogroup(right.groupBy("leaf", "b", "c")).applyInPandas(run, schema)


def _positives(n: int) -> Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame]:
    """Of each anchor the first ``n`` rows of its label at or above the start of its window."""

    def run(rows: pd.DataFrame, anchors: pd.DataFrame) -> pd.DataFrame:
        out: list[list] = [[], [], []]
        if len(rows):
            ids, labels = rows["vec_id"].to_numpy(), rows["label"].to_numpy()
            scores = products(_matrix(anchors["y"]), _matrix(rows["y"]))
            for name, label, low, line in zip(anchors["vec_id"], anchors["label"], anchors["low"], scores):
                at = np.flatnonzero((labels == label) & (ids != name) & (line >= low[0]))
                at = at[first(line[at], ids[at], n)]
                for column, values in zip(out, (np.full(len(at), name), ids[at], line[at])):
                    column.append(values)
        columns = [np.concatenate(c) if c else np.empty(0, np.int64) for c in out]
        return pd.DataFrame(dict(zip(("anchor_id", "positive_id", "positive_score"), columns)))

    return run


def _negatives(n: int) -> Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame]:
    """Of each window of each anchor the first ``n`` rows of other labels inside."""

    def run(rows: pd.DataFrame, anchors: pd.DataFrame) -> pd.DataFrame:
        out: list[list] = [[], [], [], []]
        if len(rows):
            ids, labels = rows["vec_id"].to_numpy(), rows["label"].to_numpy()
            scores = products(_matrix(anchors["y"]), _matrix(rows["y"]))
            for name, label, lows, highs, wanted, line in zip(anchors["vec_id"], anchors["label"], anchors["low"], anchors["high"], anchors["wanted"], scores):
                for low, high, score in zip(lows, highs, wanted):
                    at = np.flatnonzero((line >= low) & (line <= high) & (labels != label))
                    at = at[first(line[at], ids[at], n)]
                    for column, values in zip(out, (np.full(len(at), name), np.full(len(at), score), ids[at], line[at])):
                        column.append(values)
        columns = [np.concatenate(c) if c else np.empty(0, np.int64) for c in out]
        return pd.DataFrame(dict(zip(("anchor_id", "positive_score", "negative_id", "negative_score"), columns)))

    return run


def mine(
    rows: DataFrame,
    anchors: Column,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    id_col: str = "vec_id",
    label_col: str = "label",
    vector_col: str = "embedding",
    **options,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score), exact.

    ``anchors`` is a condition on ``rows``. An anchor's positives are the first other rows of its label by integer inner product, ties by
    the smaller id; a positive's negatives the first rows of other labels whose score s satisfies LEAST * p <= 100 * s <= MOST * p. Rows
    with a null id, label, vector or component, a non-finite one or one of BOUND / SCALE or more take no part, nor do vectors of another
    length than most have; of rows that repeat an id one counts. A negative positive score has an empty window. An empty table gives an
    empty result; other columns are ignored.

    Rows of one vector and one label score alike, so only the smallest ids among them can be returned: the others are set aside before
    the search, which keeps a crowd of copies out of one leaf.
    """
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    base = cut(usable(rows, anchors, id_col, label_col, vector_col))
    copies = Window.partitionBy(F.xxhash64("y"), "label", "y").orderBy("vec_id")
    index = cut(base.withColumn("copy", F.row_number().over(copies)).where(F.col("copy") <= max(positives + 1, negatives)).select("vec_id", "label", "y"))
    tree = grow(index, index.count(), **options)
    if tree is None:
        return rows.sparkSession.createDataFrame([], schema)
    known = ranges(index, tree)
    index = cut(_filed(index, tree))
    asked = cut(_filed(base.where("anchor").select("vec_id", "label", "y"), tree).withColumnRenamed("leaf", "own"))

    # The own leaf first: what it holds bounds the search elsewhere.
    anything, top = F.array(F.lit(-(1 << 62)).cast("long")), F.array(F.lit(1 << 62).cast("long"))
    pairs = "anchor_id long, positive_id long, positive_score long"
    best = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    at_home = asked.select("vec_id", "label", "y", anything.alias("low"), F.col("own").alias("leaf"))
    home = _scan(index, at_home, _positives(positives), pairs).withColumn("rn", F.row_number().over(best)).where(F.col("rn") <= positives)
    home = cut(home)
    bounds = home.where(F.col("rn") == positives).select(F.col("anchor_id").alias("vec_id"), F.array("positive_score").alias("low"))
    away = asked.join(bounds, "vec_id", "left").select("vec_id", "label", "y", F.coalesce("low", anything).alias("low"), top.alias("high"), F.col("own").alias("skip"))
    more = _scan(index, cut(_visited(away, tree, known).drop("high", "skip")), _positives(positives), pairs)
    chosen = home.drop("rn").unionByName(more).withColumn("rn", F.row_number().over(best)).where(F.col("rn") <= positives).drop("rn")
    chosen = cut(chosen)

    # Windows by distinct positive scores: an anchor has few of them.
    low = F.expr(f"({LEAST} * positive_score + if({LEAST} * positive_score > 0, 99, 0)) div 100")
    high = F.expr(f"({MOST} * positive_score) div 100")
    windows = chosen.where("positive_score >= 0").select("anchor_id", "positive_score", low.alias("l"), high.alias("h")).distinct()
    windows = windows.groupBy("anchor_id").agg(F.sort_array(F.collect_list(F.struct("positive_score", "l", "h"))).alias("w"))
    windows = windows.select(F.col("anchor_id").alias("vec_id"), F.col("w.l").alias("low"), F.col("w.h").alias("high"), F.col("w.positive_score").alias("wanted"))
    within = asked.drop("own").join(windows, "vec_id").withColumn("skip", F.lit(-1))
    found = _scan(index, cut(_visited(within, tree, known).drop("skip")), _negatives(negatives), "anchor_id long, positive_score long, negative_id long, negative_score long")
    order = Window.partitionBy("anchor_id", "positive_score").orderBy(F.desc("negative_score"), "negative_id")
    found = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    return chosen.join(found, ["anchor_id", "positive_score"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def oracle_sql() -> str:
    """The query's rows in DuckDB, from all pairs of an anchor and another row."""
    return f"""
WITH r AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS y
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same, list_inner_product(a.y, b.y)::BIGINT AS score
  FROM r a JOIN r b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= {POSITIVES})
SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other)::INT AS rank,
       other AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND {LEAST} * positive_score <= 100 * score AND 100 * score <= {MOST} * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other) <= {NEGATIVES}"""
