"""Request-log analytics: summaries, best configuration, stop rules, streaks, flag probes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagmill.operators.ordered import order_statistics, running_totals

# Status classes, shares and intervals of the reports.
OK, LIMITED = 200, 429
GOOD_SHARE, FAIR_SHARE = 0.05, 0.20
STOP_SHARE = 0.10
PROGRESS_EVERY = 20
COOLDOWN_SECONDS = 60
MAX_BACKOFF_SECONDS = 300
FLAG_BITS = 6


def micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def request_summary(log: DataFrame) -> DataFrame:
    """Per test: counts, latency of the successes, throughput, bytes, duration and the rate-limited share.

    p50 interpolates; p95 and p99 are the elements at index ``int(n * q)`` of the sorted latencies.
    """
    ok = F.col("status_code") == OK
    t = micros(F.col("ts"))
    counts = log.groupBy("test_name").agg(
        F.count("*").alias("total_requests"),
        F.count_if(ok).alias("successful"),
        F.count_if(F.col("status_code") == LIMITED).alias("rate_limited"),
        F.count_if(~F.col("status_code").isin(OK, LIMITED)).alias("other_errors"),
        F.coalesce(F.avg(F.when(ok, F.col("latency_ms"))), F.lit(0.0)).alias("avg_latency_ms"),
        F.coalesce(F.sum(F.when(ok, F.col("size_bytes"))), F.lit(0)).alias("total_bytes"),
        ((F.max(t) - F.min(t)) / 1e6).alias("duration_seconds"),
    )
    latencies = order_statistics(
        log.where(ok),
        "latency_ms",
        linear={"p50_latency_ms": 0.5},
        indexed={"p95_latency_ms": 0.95, "p99_latency_ms": 0.99},
        keys=["test_name"],
    )
    joined = counts.join(latencies, "test_name", "left")
    filled = joined.withColumns({c: F.coalesce(c, F.lit(0.0)) for c in ("p50_latency_ms", "p95_latency_ms", "p99_latency_ms")})
    seconds = F.col("duration_seconds")
    return filled.withColumn(
        "requests_per_second", F.when(seconds > 0, F.col("successful") / seconds).otherwise(F.lit(0.0))
    ).withColumn("rate_limited_share", F.col("rate_limited") / F.col("total_requests"))


def with_light(summary: DataFrame) -> DataFrame:
    """Add ``light``: good, fair or bad by the rate-limited share."""
    share = F.col("rate_limited_share")
    return summary.withColumn("light", F.when(share < GOOD_SHARE, "good").when(share < FAIR_SHARE, "fair").otherwise("bad"))


def best_config(summary: DataFrame, max_share: float = GOOD_SHARE, default: str = "default") -> DataFrame:
    """The configuration with the highest throughput among those below ``max_share``; ``default`` if none qualifies.

    Of equal throughputs the smallest name wins.
    """
    fit = F.when(F.col("rate_limited_share") < max_share, F.struct((-F.col("requests_per_second")).alias("order"), "test_name", "requests_per_second"))
    row = summary.agg(F.min(fit).alias("b"))
    return row.select(
        F.coalesce("b.test_name", F.lit(default)).alias("test_name"),
        F.coalesce("b.requests_per_second", F.lit(0.0)).alias("throughput"),
    )


def results_rows(summary: DataFrame) -> DataFrame:
    """Rows of the results file."""
    return summary.select(
        F.col("test_name").alias("name"), F.col("requests_per_second").alias("throughput"), F.col("rate_limited_share").alias("rate_limited_pct")
    )


def rate_threshold(configs: DataFrame, stop_share: float = STOP_SHARE) -> DataFrame:
    """Configurations tried in ``rate`` order until the first one above ``stop_share``.

    ``configs``: ``rate, rate_limited_share``. Adds ``is_stop`` and, on the stopping row, the last rate that held
    (0 if there was none). The stop is found by aggregation, so no ordered pass is needed.
    """
    over = F.col("rate_limited_share") > stop_share
    stop = configs.where(over).agg(F.min("rate")).scalar()
    tried = configs.withColumn("_stop", stop).where(F.col("_stop").isNull() | (F.col("rate") <= F.col("_stop")))
    held = configs.withColumn("_stop", stop).where(F.col("rate") < F.col("_stop")).agg(F.max("rate")).scalar()
    is_stop = F.coalesce(F.col("rate") == F.col("_stop"), F.lit(False))
    return tried.withColumn("is_stop", is_stop).withColumn(
        "last_good_rate", F.when(F.col("is_stop"), F.coalesce(held, F.lit(0).cast("long")))
    ).drop("_stop")


def sustained_progress(log: DataFrame, every: int = PROGRESS_EVERY) -> DataFrame:
    """At every ``every``-th request of a test: requests so far, elapsed seconds, rate, and 429s so far."""
    rows = log.select("test_name", "request_id", micros(F.col("ts")).alias("us"), "status_code")
    running = running_totals(
        rows,
        ["us", "request_id"],
        {"n": F.lit(1).cast("long"), "limited": (F.col("status_code") == LIMITED).cast("long")},
        ["test_name"],
    )
    starts = rows.groupBy("test_name").agg(F.min("us").alias("us0"))
    marks = running.where(F.col("n") % every == 0).join(starts, "test_name")
    elapsed = (F.col("us") - F.col("us0")) / 1e6
    rate = F.when(elapsed > 0, F.col("n") / elapsed).otherwise(F.lit(0.0))
    return marks.select("test_name", "request_id", "n", elapsed.alias("elapsed_seconds"), rate.alias("rate"), "limited")


def fibonacci_waits(max_seconds: int = MAX_BACKOFF_SECONDS) -> list[int]:
    """1, 1, 2, 3, ... up to the first value that reaches the cap, which replaces it."""
    waits = [1, 1]
    while waits[-1] < max_seconds:
        waits.append(waits[-1] + waits[-2])
    return [min(w, max_seconds) for w in waits]


def fibonacci_backoff(attempt: Column, max_seconds: int = MAX_BACKOFF_SECONDS) -> Column:
    waits = fibonacci_waits(max_seconds)
    table = F.array(*[F.lit(w).cast("long") for w in waits])
    return F.element_at(table, F.greatest(F.least(attempt, F.lit(len(waits))), F.lit(1)).cast("int"))


def exponential_backoff(attempt: Column, base: int = 2, max_seconds: int = MAX_BACKOFF_SECONDS) -> Column:
    return F.least(F.pow(F.lit(base), attempt), F.lit(float(max_seconds))).cast("long")


def retry_streaks(log: DataFrame, max_seconds: int = MAX_BACKOFF_SECONDS, cooldown: int = COOLDOWN_SECONDS) -> DataFrame:
    """For every 429: its place in the run of 429s since the last success of its test, and the waits that follow.

    Running counts give the place directly (429s so far minus 429s up to the last success), so a long run or a busy
    test is never gathered.
    """
    rows = log.select("test_name", "request_id", micros(F.col("ts")).alias("us"), "status_code")
    running = running_totals(
        rows,
        ["us", "request_id"],
        {"_limited": (F.col("status_code") == LIMITED).cast("long"), "_ok": (F.col("status_code") == OK).cast("long")},
        ["test_name"],
        last={"_at_success": ("_limited", F.col("status_code") == OK)},
    )
    attempt = F.col("_limited") - F.col("_at_success")
    return running.where(F.col("status_code") == LIMITED).select(
        "test_name",
        "request_id",
        F.col("_ok").alias("streak"),
        attempt.alias("attempt"),
        fibonacci_backoff(attempt, max_seconds).alias("fibonacci_wait"),
        exponential_backoff(attempt, 2, max_seconds).alias("exponential_wait"),
        F.greatest(F.lit(cooldown).cast("long"), fibonacci_backoff(attempt, max_seconds)).alias("cooldown_wait"),
    )


def rate_windows(log: DataFrame, width: str, slide: str | None = None) -> DataFrame:
    """Requests and 429s per time window and test."""
    window = F.window(F.col("ts").cast("timestamp"), width, slide) if slide else F.window(F.col("ts").cast("timestamp"), width)
    counted = log.groupBy("test_name", window.alias("w")).agg(
        F.count("*").alias("requests"), F.count_if(F.col("status_code") == LIMITED).alias("limited")
    )
    return counted.select("test_name", F.unix_micros("w.start").alias("start_us"), F.unix_micros("w.end").alias("end_us"), "requests", "limited")


def busy_windows(log: DataFrame, width: str, slide: str, threshold: int) -> DataFrame:
    """Sliding windows with more than ``threshold`` requests over all tests."""
    counted = log.groupBy(F.window(F.col("ts").cast("timestamp"), width, slide).alias("w")).agg(F.count("*").alias("requests"))
    return counted.where(F.col("requests") > threshold).select(
        F.unix_micros("w.start").alias("start_us"), F.unix_micros("w.end").alias("end_us"), "requests"
    )


def cooldown_sessions(log: DataFrame, gap_seconds: int = COOLDOWN_SECONDS) -> DataFrame:
    """Bursts of 429s per test that are separated by more than ``gap_seconds``.

    Points in one gap-wide slot always belong together, so slots are reduced first (map-side) and only slots, at most
    duration / gap of them per test, are ordered.
    """
    gap = gap_seconds * 1_000_000
    limited = log.where(F.col("status_code") == LIMITED).select("test_name", micros(F.col("ts")).alias("us"))
    slots = limited.groupBy("test_name", F.floor(F.col("us") / gap).alias("slot")).agg(
        F.min("us").alias("lo"), F.max("us").alias("hi"), F.count("*").alias("n")
    )
    in_order = Window.partitionBy("test_name").orderBy("slot")
    starts = F.coalesce((F.col("lo") - F.lag("hi").over(in_order) > gap).cast("int"), F.lit(1))
    numbered = slots.withColumn("new", starts).withColumn(
        "session", F.sum("new").over(in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    )
    return (
        numbered.groupBy("test_name", "session")
        .agg(F.min("lo").alias("start_us"), F.max("hi").alias("last_us"), F.sum("n").alias("errors"))
        .select("test_name", "start_us", "last_us", "errors")
    )


def error_histogram(failures: DataFrame, total: Column, reason: str = "error", top: int = 10) -> DataFrame:
    """``reason, n, share`` of the ``top`` most frequent reasons and one row for the others, if any.

    ``total``: number of attempts the share refers to.
    """
    counts = failures.groupBy(F.col(reason).alias("reason")).agg(F.count("*").alias("n"))
    first = counts.orderBy(F.desc("n"), "reason").limit(top)
    rest = failures.agg(F.count("*").alias("all")).withColumn("_top", first.agg(F.sum("n")).scalar())
    others = rest.select(F.lit("(other reasons)").alias("reason"), (F.col("all") - F.coalesce("_top", F.lit(0))).alias("n")).where("n > 0")
    return first.unionByName(others).withColumn("_total", total).select("reason", "n", (F.col("n") / F.col("_total")).alias("share"))


def flag_status(probes: DataFrame) -> DataFrame:
    """Per requested flag value: status class, items returned and the item flags seen (``flag_value, status_code, item_flags``).

    Equal item flags are merged before the few distinct ones are gathered; they may be of any size.
    """
    ok = F.col("status_code") == OK
    verdict = F.when(ok, 0).when(F.col("status_code") == 403, 1).otherwise(2)
    names = F.array(F.lit("works"), F.lit("forbidden"), F.lit("fails"))
    merged = probes.groupBy("flag_value", F.when(ok, F.col("item_flags")).cast("long").alias("_flag")).agg(
        F.min(verdict).alias("_verdict"), F.count_if(ok).alias("_items")
    )
    seen = F.sort_array(F.collect_list("_flag")).cast("array<string>")
    return (
        merged.groupBy("flag_value")
        .agg(F.min("_verdict").alias("_verdict"), F.sum("_items").alias("items"), F.array_join(seen, ",").alias("flags_seen"))
        .select("flag_value", F.get(names, F.col("_verdict")).alias("status"), "items", "flags_seen")
    )


def flag_bits(status: DataFrame, bits: int = FLAG_BITS) -> DataFrame:
    """Per bit: how many working values have it, lack it, and how many failing values have it."""
    exploded = status.select("flag_value", "status", F.explode(F.sequence(F.lit(0), F.lit(bits - 1))).alias("bit"))
    has = F.getbit(F.col("flag_value"), F.col("bit")) == 1
    works = F.col("status") == "works"
    return exploded.groupBy("bit").agg(
        F.count_if(works & has).alias("works_with"),
        F.count_if(works & ~has).alias("works_without"),
        F.count_if(~works & has).alias("fails_with"),
    )


def consensus_values(pairs: DataFrame) -> DataFrame:
    """The most common value per key (``key, value``), ties by the smallest value, with its count."""
    counted = pairs.groupBy("key", "value").agg(F.count("*").alias("n"))
    best = counted.groupBy("key").agg(F.max(F.struct("n", (-F.col("value")).alias("neg"))).alias("m"))
    return best.select("key", (-F.col("m.neg")).alias("value"), F.col("m.n").alias("n"))
