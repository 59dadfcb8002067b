import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tagmill.operators import ordered


@pytest.fixture(scope="module")
def frame(spark):
    """One key holds two thirds of the rows; one key is null."""
    rng = random.Random(5)
    rows = [("hot" if i % 3 else rng.choice(["a", "b", None]), rng.randrange(500), i, rng.randrange(2)) for i in range(1500)]
    return rows, spark.createDataFrame(rows, "k string, o long, i long, x long")


def test_running_totals_match_pandas(frame):
    rows, df = frame
    out = ordered.running_totals(
        df,
        ["o", "i"],
        {"n": F.lit(1).cast("long"), "s": F.col("x")},
        ["k"],
        last={"at": ("n", F.col("x") == 1)},
    )
    pdf = pd.DataFrame(rows, columns=["k", "o", "i", "x"]).fillna("none").sort_values(["k", "o", "i"])
    pdf["n"] = pdf.groupby("k").cumcount() + 1
    pdf["s"] = pdf.groupby("k")["x"].cumsum()
    pdf["at"] = pdf["n"].where(pdf["x"] == 1)
    pdf["at"] = pdf.groupby("k")["at"].ffill().fillna(0).astype(int)
    expected = {r.i: (r.n, r.s, r.at) for r in pdf.itertuples()}
    assert {r.i: (r.n, r.s, r["at"]) for r in out.collect()} == expected


def test_positions_over_the_whole_table(spark):
    df = spark.range(1000).select((F.lit(999) - F.col("id")).alias("v"))
    assert {(r.v, r.position) for r in ordered.positions(df, ["v"]).collect()} == {(i, i) for i in range(1000)}


@pytest.mark.parametrize("distinct", [False, True])
def test_order_statistics_of_one_hot_or_all_distinct_values(spark, distinct):
    rows = [(float(i) if distinct else float(i % 3 == 0 and i),) for i in range(900)]
    got = ordered.order_statistics(spark.createDataFrame(rows, "v double"), "v", {"p10": 0.1, "p50": 0.5, "p97": 0.97}).first()
    assert list(got) == pytest.approx(list(np.quantile([v for v, in rows], [0.1, 0.5, 0.97])))


def test_order_statistics_match_numpy(frame):
    rows, df = frame
    got = ordered.order_statistics(df, "o", {"p25": 0.25, "p50": 0.5, "p99": 0.99}, {"i95": 0.95}, ["k"]).collect()
    assert len(got) == 4
    for r in got:
        values = sorted(o for k, o, _, _ in rows if k == r.k)
        assert [r.p25, r.p50, r.p99] == pytest.approx(list(np.quantile(values, [0.25, 0.5, 0.99])))
        assert r.i95 == values[int(len(values) * 0.95)]
    whole = ordered.order_statistics(df, "o", {"p10": 0.1}).first()
    assert whole.p10 == pytest.approx(np.quantile([r[1] for r in rows], 0.1))


def test_order_statistics_of_nothing(spark):
    empty = spark.createDataFrame([], "v double")
    assert ordered.order_statistics(empty, "v", {"p50": 0.5}).first().p50 is None


@pytest.mark.parametrize("n", [1, 7, 40, 100, 500])
def test_smallest_is_exact_with_ties(spark, n):
    rows = [(i, i % 6) for i in range(100)]
    got = ordered.smallest(spark.createDataFrame(rows, "id long, h long"), n, "h", "id").collect()
    assert sorted((r.h, r.id) for r in got) == sorted((h, i) for i, h in rows)[:n]


@pytest.mark.parametrize("bins", [1 << 14])
def test_order_statistics_by_refinement(spark, monkeypatch, bins):
    """Values of many magnitudes, ties, infinities and NaN."""
    monkeypatch.setattr(ordered, "BINS", bins)
    rng = random.Random(8)
    values = [rng.choice([-1, 1]) * 10.0 ** rng.uniform(-300, 300) for _ in range(60)] + [0.0] * 9 + [-0.0] * 3 + [5e-324, 1.7e308, -1.7e308] + [2.5] * 20
    rows = [("a", v) for v in values] + [("b", float("inf")), ("b", float("-inf")), ("b", 1.0), ("b", float("nan"))] + [("c", None)]
    df = spark.createDataFrame(rows, "k string, v double").repartition(3)
    marks = {f"i{p}": p / 100 for p in (0, 25, 50, 75, 99)}
    got = {r["k"]: r for r in ordered.order_statistics(df, "v", indexed=marks, keys=["k"]).collect()}
    assert set(got) == {"a", "b"}
    ordered_values = sorted(values)
    for name, q in marks.items():
        assert got["a"][name] == ordered_values[int(len(values) * q)]
    assert [got["b"][n] for n in ("i0", "i25", "i50")] == [float("-inf"), 1.0, float("inf")] and got["b"]["i99"] != got["b"]["i99"]


def test_order_statistics_neither_sort_nor_shuffle_values(spark, monkeypatch):
    df = spark.range(20_000).select(F.rand(3).alias("v"))
    plans = []
    real = ordered.cut
    monkeypatch.setattr(ordered, "cut", lambda d: plans.append(d._jdf.queryExecution().executedPlan().toString()) or real(d))
    got = ordered.order_statistics(df, "v", {"p50": 0.5, "p90": 0.9}).first()
    assert list(got) == pytest.approx(list(np.quantile([r.v for r in df.collect()], [0.5, 0.9])))
    assert len(plans) <= 4 and not any("rangepartitioning" in p for p in plans)
