"""Order-dependent computations that do not put a key, or the whole table, into one task.

A window over a hot key sorts all its rows in a single task. Here rows are range-partitioned by (keys, order), so a
hot key is spread over many partitions; running values are computed inside each partition and shifted by the totals
of the partitions before it. The shift table has one row per (partition, key that occurs in it).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagmill.session import cut

#: Bins of a range of values whose ranks are looked for.
BINS = 1 << 14


def running_totals(
    df: DataFrame,
    order_by: Sequence[str],
    sums: Mapping[str, Column],
    keys: Sequence[str] = (),
    last: Mapping[str, tuple[str, Column]] | None = None,
) -> DataFrame:
    """Add inclusive running sums of non-negative values per ``keys`` in ``order_by`` order.

    ``last`` maps a new column to ``(running sum, condition)``: the value that sum had at the latest row so far that
    met the condition, 0 before the first such row. (keys, order_by) should identify a row.
    """
    keys, order_by, last = list(keys), list(order_by), dict(last or {})
    tagged = df.repartitionByRange(*keys, *order_by).withColumn("_part", F.spark_partition_id())
    frame = (
        Window.partitionBy("_part", *keys).orderBy(*order_by).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    local = tagged.withColumns({name: F.sum(expr).over(frame) for name, expr in sums.items()})
    if last:
        local = local.withColumns({name: F.max(F.when(cond, F.col(of))).over(frame) for name, (of, cond) in last.items()})
    # Both branches below must see one and the same partitioning, so it is materialised.
    saved = cut(local)

    totals = saved.groupBy("_part", *keys).agg(*[F.max(n).alias(n) for n in [*sums, *last]])
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shift = totals.withColumns({f"_shift_{n}": F.coalesce(F.sum(n).over(before), F.lit(0)) for n in sums})
    if last:
        # A partition's latest match, expressed on the whole key's scale, carries into the partitions after it.
        shift = shift.withColumns({n: F.col(n) + F.col(f"_shift_{of}") for n, (of, _) in last.items()})
        shift = shift.withColumns({f"_shift_{n}": F.coalesce(F.max(n).over(before), F.lit(0)) for n in last})
    shift = shift.select(
        F.col("_part").alias("_p"),
        *[F.col(k).alias(f"_k_{k}") for k in keys],
        *[f"_shift_{n}" for n in [*sums, *last]],
    )
    on = F.col("_part") == F.col("_p")
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    joined = saved.join(shift, on, "left")
    out = {n: F.col(n) + F.col(f"_shift_{n}") for n in sums}
    for n, (of, _) in last.items():
        out[n] = F.coalesce(F.col(n) + F.col(f"_shift_{of}"), F.col(f"_shift_{n}"))
    return joined.select(*[F.col(c) for c in df.columns], *[c.alias(n) for n, c in out.items()])


def positions(df: DataFrame, order_by: Sequence[str], keys: Sequence[str] = (), name: str = "position") -> DataFrame:
    """Add the 0-based position in ``order_by`` order, per ``keys`` or over the whole table."""
    out = running_totals(df, order_by, {name: F.lit(1).cast("long")}, keys)
    return out.withColumn(name, F.col(name) - 1)


def order_statistics(
    df: DataFrame,
    value: str,
    linear: Mapping[str, float] | None = None,
    indexed: Mapping[str, float] | None = None,
    keys: Sequence[str] = (),
) -> DataFrame:
    """Exact order statistics per ``keys`` (one row over the whole table without keys).

    ``linear`` maps a column name to a quantile with linear interpolation, ``indexed`` to a quantile ``q`` taken as the
    element at index ``int(n * q)`` of the sorted values. Nulls take no part; infinities and NaN (the largest) do.

    Values are neither sorted nor shuffled. Each wanted rank has a range of values that it lies in. A pass counts the
    values of these ranges in BINS bins each, and the bin that holds the rank, cut to its own least and largest value,
    is the next range; a range of one value is the answer. Two passes after the first are usual; from then on linear bins
    take turns with logarithmic ones, so that values of many magnitudes do not keep falling into one bin.
    """
    linear, indexed, keys = dict(linear or {}), dict(indexed or {}), list(keys)
    total, names = F.col("_total"), []
    ranks: list[Column] = []
    for name, q in linear.items():
        names += [f"{name}__lo", f"{name}__hi"]
        ranks += [F.floor((total - 1) * F.lit(float(q))), F.ceil((total - 1) * F.lit(float(q)))]
    for name, q in indexed.items():
        names.append(name)
        ranks.append(F.floor(total * F.lit(float(q))))

    by = [f"_g{i}" for i in range(len(keys))] or ["_g0"]
    groups = [F.col(k).alias(g) for k, g in zip(keys, by)] or [F.lit(0).alias("_g0")]
    values = df.where(F.col(value).isNotNull()).select(*groups, F.col(value).cast("double").alias("_v"))
    v, inf = F.col("_v"), F.lit(float("inf"))
    finite = F.abs(v) < inf
    state = values.groupBy(*by).agg(
        F.count("*").alias("_total"), F.count_if(v == -inf).alias("_low"), F.count_if(finite).alias("_mid"), F.count_if(v == inf).alias("_high"),
        F.min(F.when(finite, v)).alias("_min"), F.max(F.when(finite, v)).alias("_max"),
    )
    rank = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), r.cast("long").alias("r")) for i, r in enumerate(ranks)]))
    r, below, upto = F.col("x.r"), F.col("_low"), F.col("_low") + F.col("_mid")
    outside = F.when(r < below, -inf).when(r < upto + F.col("_high"), inf).otherwise(float("nan"))
    inside = (r >= below) & (r < upto)
    # A row for each key and rank: the range of values that the rank lies in, and how many values are below the range.
    state = state.withColumn("x", rank).select(
        *by, "_total", F.col("x.i").alias("i"), r.alias("r"), below.alias("before"),
        F.when(inside, F.col("_min")).otherwise(outside).alias("lo"), F.when(inside, F.col("_max")).otherwise(outside).alias("hi"),
    )
    state = cut(state)
    passes = 0
    while not (unknown := state.where("lo < hi")).isEmpty():
        ranges = unknown.select(*[F.col(g).alias(f"_s{g}") for g in by], "lo", "hi").distinct()
        held = _same_keys(by, [f"_s{g}" for g in by]) & (v >= F.col("lo")) & (v <= F.col("hi"))
        joined = values.join(ranges if keys else F.broadcast(ranges), held)
        place = (v / 2 - F.col("lo") / 2) / (F.col("hi") / 2 - F.col("lo") / 2)
        if passes > 1 and passes % 2 == 0:
            place = F.when(place > 0, 1 + F.log2(place) / 1100).otherwise(0.0)
        counts = joined.groupBy(*by, F.col("lo").alias("of"), F.floor(place * BINS).cast("int").alias("bin")).agg(F.count("*").alias("n"), F.min("_v").alias("least"), F.max("_v").alias("most"))
        upto = F.sum("n").over(Window.partitionBy(*by, "of").orderBy("bin"))  # of BINS + 1 rows at most
        counts = counts.withColumn("upto", upto).select(*[F.col(g).alias(f"_c{g}") for g in by], "of", "least", "most", "n", "upto")
        need = F.col("r") - F.col("before")
        found = unknown.join(counts, _same_keys(by, [f"_c{g}" for g in by]) & (F.col("lo") == F.col("of")))
        found = found.where((need < F.col("upto")) & (need >= F.col("upto") - F.col("n")))
        found = found.select(*by, "_total", "i", "r", (F.col("before") + F.col("upto") - F.col("n")).alias("before"), F.col("least").alias("lo"), F.col("most").alias("hi"))
        state = cut(state.where("NOT lo < hi").unionByName(found))
        passes += 1

    valid = F.col("r").between(0, total - 1)
    picked = state.groupBy(*by, "_total").agg(*[F.max(F.when((F.col("i") == i) & valid, F.col("lo"))).alias(n) for i, n in enumerate(names)])
    columns = {}
    for name, q in linear.items():
        at = (total - 1) * F.lit(float(q))
        lo, hi = F.col(f"{name}__lo"), F.col(f"{name}__hi")
        columns[name] = F.when(lo == hi, lo).otherwise(lo + (hi - lo) * (at - F.floor(at)))
    columns |= {name: F.col(name) for name in indexed}
    if not keys:
        return picked.agg(*[F.max(c).alias(n) for n, c in columns.items()])
    return picked.select(*[F.col(g).alias(k) for g, k in zip(by, keys)], *[c.alias(n) for n, c in columns.items()])


def _same_keys(left: Sequence[str], right: Sequence[str]) -> Column:
    on = F.lit(True)
    for a, b in zip(left, right):
        on = on & F.col(a).eqNullSafe(F.col(b))
    return on


def smallest(df: DataFrame, n: int, order_by: str, tie_break: str) -> DataFrame:
    """Exactly the ``n`` rows with the smallest ``order_by`` (then ``tie_break``), without gathering them in one task."""
    counts = df.groupBy(F.col(order_by).alias("_o")).agg(F.count("*").alias("_n"))
    cum = running_totals(counts, ["_o"], {"_cum": F.col("_n")})
    # The value at which the running count first reaches n, and how many rows of that value still fit.
    edge = cum.where(F.col("_cum") >= n).agg(F.min_by(F.struct("_o", (n - (F.col("_cum") - F.col("_n"))).alias("room")), "_cum"))
    bound = edge.scalar()
    tied = Window.partitionBy(order_by).orderBy(tie_break)
    inside = df.withColumn("_edge", bound).where(F.col("_edge").isNull() | (F.col(order_by) <= F.col("_edge._o")))
    return (
        inside.withColumn("_rn", F.row_number().over(tied))
        .where(F.col("_edge").isNull() | (F.col(order_by) < F.col("_edge._o")) | (F.col("_rn") <= F.col("_edge.room")))
        .drop("_edge", "_rn")
    )
