import datetime as dt

import pytest

from tagmill.operators import requests
from tagmill.schemas import REQUEST

START = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)


def log(spark, rows):
    """rows: (seconds, test, status, latency)."""
    data = [(i, START + dt.timedelta(seconds=s), t, c, float(l), 10) for i, (s, t, c, l) in enumerate(rows)]
    return spark.createDataFrame(data, REQUEST)


def test_summary_uses_index_percentiles_of_successes(spark):
    rows = [(i, "a", 200, i) for i in range(20)] + [(20, "a", 429, 999), (21, "a", 500, 999), (5, "b", 429, 1)]
    got = {r.test_name: r for r in requests.with_light(requests.request_summary(log(spark, rows))).collect()}
    a, b = got["a"], got["b"]
    assert (a.total_requests, a.successful, a.rate_limited, a.other_errors, a.total_bytes) == (22, 20, 1, 1, 200)
    assert (a.p50_latency_ms, a.p95_latency_ms, a.p99_latency_ms, a.avg_latency_ms) == (9.5, 19.0, 19.0, 9.5)
    assert a.requests_per_second == pytest.approx(20 / 21) and a.light == "good"
    assert (b.p50_latency_ms, b.requests_per_second, b.light) == (0.0, 0.0, "bad")


def test_best_config_falls_back(spark):
    s = spark.createDataFrame([("a", 5.0, 0.01), ("b", 9.0, 0.04), ("c", 50.0, 0.05)], "test_name string, requests_per_second double, rate_limited_share double")
    assert tuple(requests.best_config(s).first()) == ("b", 9.0)
    assert tuple(requests.best_config(s, 0.0).first()) == ("default", 0.0)


def test_stop_rule(spark):
    c = spark.createDataFrame([(1, 0.0), (3, 0.1), (5, 0.2), (7, 0.0)], "rate long, rate_limited_share double")
    got = {r.rate: (r.is_stop, r.last_good_rate) for r in requests.rate_threshold(c).collect()}
    assert got == {1: (False, None), 3: (False, None), 5: (True, 3)}
    first = {r.rate: (r.is_stop, r.last_good_rate) for r in requests.rate_threshold(c.where("rate = 5")).collect()}
    assert first == {5: (True, 0)}
    assert requests.rate_threshold(c, 0.5).count() == 4


def test_streaks_and_waits(spark):
    statuses = [429, 429, 404, 429, 200, 429, 200] + [429] * 20
    rows = [(i, "a", s, 1) for i, s in enumerate(statuses)]
    got = sorted(requests.retry_streaks(log(spark, rows)).collect(), key=lambda r: r.request_id)
    assert [r.attempt for r in got] == [1, 2, 3, 1] + list(range(1, 21))
    assert [r.fibonacci_wait for r in got[4:]] == [1, 1, 2, 3, 5, 8, 13, 21, 34, 55, 89, 144, 233] + [300] * 7
    assert [r.exponential_wait for r in got[4:13]] == [2, 4, 8, 16, 32, 64, 128, 256, 300]
    assert got[-1].cooldown_wait == 300 and got[0].cooldown_wait == 60
    assert requests.fibonacci_waits(10) == [1, 1, 2, 3, 5, 8, 10]


def test_progress_marks(spark):
    rows = [(i, "hot", 429 if i % 5 == 0 else 200, 1) for i in range(61)]
    got = sorted(requests.sustained_progress(log(spark, rows)).collect(), key=lambda r: r.n)
    assert [(r.n, r.limited, r.elapsed_seconds) for r in got] == [(20, 4, 19.0), (40, 8, 39.0), (60, 12, 59.0)]
    assert got[0].rate == pytest.approx(20 / 19)


def test_sessions_split_on_quiet_gaps(spark):
    seconds = [0, 30, 60, 119, 180, 300, 361, 421]
    rows = [(s, "a", 429, 1) for s in seconds] + [(250, "a", 200, 1)]
    got = sorted(requests.cooldown_sessions(log(spark, rows), 60).collect(), key=lambda r: r.start_us)
    base = int(START.timestamp())
    assert [(r.start_us // 10**6 - base, r.last_us // 10**6 - base, r.errors) for r in got] == [(0, 119, 4), (180, 180, 1), (300, 300, 1), (361, 421, 2)]


def test_error_histogram_keeps_the_rest(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(f"e{i}",) for i in range(15) for _ in range(i + 1)], "error string")
    got = {r.reason: r.n for r in requests.error_histogram(df, F.lit(240), top=10).collect()}
    assert sum(got.values()) == 120 and got["(other reasons)"] == 15 and len(got) == 11
    few = requests.error_histogram(df.where("error = 'e1'"), F.lit(4)).collect()
    assert [(r.reason, r.n, r.share) for r in few] == [("e1", 2, 0.5)]


def test_flag_probes(spark):
    p = spark.createDataFrame([(1, 200, 1), (1, 200, 9), (3, 403, None), (9, 200, 1), (32, 400, None)], "flag_value long, status_code int, item_flags int")
    status = requests.flag_status(p)
    assert {r.flag_value: (r.status, r["items"], r.flags_seen) for r in status.collect()} == {
        1: ("works", 2, "1,9"), 3: ("forbidden", 0, ""), 9: ("works", 1, "1"), 32: ("fails", 0, ""),
    }
    bits = {r.bit: (r.works_with, r.works_without, r.fails_with) for r in requests.flag_bits(status).collect()}
    assert bits[0] == (2, 0, 1) and bits[1] == (0, 2, 1) and bits[3] == (1, 1, 0) and bits[5] == (0, 2, 1)


def test_flags_of_any_size_are_reported(spark):
    p = spark.createDataFrame([(64, 200, 64), (64, 200, 1 << 40), (64, 200, 0), (64, 200, 64), (64, 403, 2)], "flag_value long, status_code int, item_flags long")
    row = requests.flag_status(p).first()
    assert (row.status, row["items"], row.flags_seen) == ("works", 4, "0,64,1099511627776")


def test_numbers_beyond_a_long_are_no_matches(spark):
    from pyspark.sql import functions as F

    from tagmill.functions.text import key_number_pairs

    df = spark.createDataFrame([("SFW = 99999999999999999999; NSFW: 1 << 70; nsfl = 4",)], "t string")
    row = df.select(key_number_pairs(F.col("t"), ["sfw", "nsfw", "nsfl"]).alias("p")).first()
    assert [(p["key"], p["value"]) for p in row["p"]] == [("NSFW", 1), ("NSFL", 4)]


def test_equal_throughputs_take_the_smallest_name(spark):
    from tagmill.operators.requests import best_config

    rows = [("b", 5.0, 0.0), ("a", 5.0, 0.0), ("c", 9.0, 0.9)]
    summary = spark.createDataFrame(rows, "test_name string, requests_per_second double, rate_limited_share double")
    assert tuple(best_config(summary).first()) == ("a", 5.0)


def test_pairs_are_looked_for_in_tasks_bounded_by_rows(spark, sf_dir, monkeypatch):
    from tagmill import session
    from tagmill.plans.registry import all_queries

    rows = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    monkeypatch.setattr(session, "TASK_ROWS", rows // 20, raising=False)
    assert all_queries()["regex_pairs"][0](spark, sf_dir).rdd.getNumPartitions() >= 20
