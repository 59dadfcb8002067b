"""Request-log analytics and text extraction over the event and page tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tagmill.functions import text
from tagmill.operators import requests
from tagmill.plans import fixtures
from tagmill.plans.fixtures import derive, in_duckdb, table
from tagmill.sources.tables import latest_run as latest_run_op

MAX_SHARE = 0.2
RATE_KEYS = ["SFW", "NSFW", "NSFL", "NSFP"]
WIDTH, SLIDE, BUSY = "10 minutes", "5 minutes", 3
WIDTH_US, SLIDE_US = 600_000_000, 300_000_000
GAP_SECONDS = 1200


def _log(spark, sf_dir):
    # Event times carry no zone; they are read as UTC.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return derive(spark, sf_dir, fixtures.REQUESTS)


LOG_CTE = f"""WITH log AS (SELECT *, epoch_us(ts) AS us FROM ({in_duckdb(fixtures.REQUESTS)}) r),
summary AS (
  SELECT test_name, count(*) AS total_requests, count(*) FILTER (status_code = 200) AS successful,
         count(*) FILTER (status_code = 429) AS rate_limited, count(*) FILTER (status_code NOT IN (200, 429)) AS other_errors,
         avg(latency_ms) FILTER (status_code = 200) AS avg_latency_ms,
         CAST(sum(size_bytes) FILTER (status_code = 200) AS bigint) AS total_bytes, (max(us) - min(us)) / 1e6::double AS duration_seconds,
         quantile_cont(latency_ms, 0.5) FILTER (status_code = 200) AS p50_latency_ms,
         (list_sort(list(latency_ms) FILTER (status_code = 200)))[CAST(floor((count(*) FILTER (status_code = 200)) * 0.95::double) AS bigint) + 1] AS p95_latency_ms,
         (list_sort(list(latency_ms) FILTER (status_code = 200)))[CAST(floor((count(*) FILTER (status_code = 200)) * 0.99::double) AS bigint) + 1] AS p99_latency_ms,
         (count(*) FILTER (status_code = 200)) / ((max(us) - min(us)) / 1e6::double) AS requests_per_second,
         (count(*) FILTER (status_code = 429)) / count(*) AS rate_limited_share
  FROM log GROUP BY test_name)
"""


def _rounded(df):
    return df.select(*[F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def request_summary(spark, sf_dir):
    return _rounded(requests.with_light(requests.request_summary(_log(spark, sf_dir))))


def best_config(spark, sf_dir):
    return _rounded(requests.best_config(requests.request_summary(_log(spark, sf_dir)), MAX_SHARE))


def results_rows(spark, sf_dir):
    return _rounded(requests.results_rows(requests.request_summary(_log(spark, sf_dir))))


def rate_threshold(spark, sf_dir):
    summary = requests.request_summary(_log(spark, sf_dir))
    configs = summary.select(F.regexp_extract("test_name", r"(\d+)$", 1).cast("long").alias("rate"), "rate_limited_share")
    return _rounded(requests.rate_threshold(configs, MAX_SHARE))


def sustained_progress(spark, sf_dir):
    return _rounded(requests.sustained_progress(_log(spark, sf_dir)))


def retry_streaks(spark, sf_dir):
    return requests.retry_streaks(_log(spark, sf_dir))


def rate_tumbling(spark, sf_dir):
    return requests.rate_windows(_log(spark, sf_dir), WIDTH)


def rate_sliding(spark, sf_dir):
    return requests.busy_windows(_log(spark, sf_dir), WIDTH, SLIDE, BUSY)


def cooldown_sessions(spark, sf_dir):
    return requests.cooldown_sessions(_log(spark, sf_dir), GAP_SECONDS)


SESSIONS_SQL = LOG_CTE + f"""
, marked AS (SELECT test_name, us, CASE WHEN us - lag(us) OVER w > {GAP_SECONDS * 1_000_000} THEN 1 ELSE 0 END AS new
             FROM log WHERE status_code = 429 WINDOW w AS (PARTITION BY test_name ORDER BY us)),
numbered AS (SELECT *, sum(new) OVER (PARTITION BY test_name ORDER BY us) AS session FROM marked),
sessions AS (SELECT test_name, min(us) AS start_us, max(us) AS last_us, count(*) AS errors FROM numbered GROUP BY test_name, session)
"""


def error_histogram(spark, sf_dir):
    """Failed events by the reason their properties carry, as a share of all events."""
    events = table(spark, sf_dir, "events")
    total = events.agg(F.count("*")).scalar()
    reasons = events.where("event_type = 'error'").select(F.concat(F.lit("code "), F.get_json_object("props", "$.k")).alias("error"))
    return _rounded(requests.error_histogram(reasons, total))


def _probes(spark, sf_dir):
    """Flag values asked for, with the status and the flags of what came back."""
    return table(spark, sf_dir, "events").select(
        (F.col("user_id") % 40).alias("flag_value"),
        F.when((F.col("user_id") % 40 >= 32) & (F.col("event_type") != "error"), 400)
        .when((F.col("user_id") % 40) % 2 == 1, 200)
        .otherwise(403)
        .alias("status_code"),
        (F.get_json_object("props", "$.k").cast("int") % 16).alias("item_flags"),
    )


_PROBES_CTE = """WITH probes AS (SELECT user_id % 40 AS flag_value, CASE WHEN user_id % 40 >= 32 AND event_type <> 'error' THEN 400 WHEN (user_id % 40) % 2 = 1 THEN 200 ELSE 403 END AS status_code,
  CAST(json_extract(props, '$.k') AS integer) % 16 AS item_flags FROM events),
status AS (SELECT flag_value, CASE WHEN bool_or(status_code = 200) THEN 'works' WHEN bool_or(status_code = 403) THEN 'forbidden' ELSE 'fails' END AS status,
  count(*) FILTER (status_code = 200) AS items,
  coalesce(array_to_string(list_sort(list(DISTINCT item_flags) FILTER (status_code = 200)), ','), '') AS flags_seen FROM probes GROUP BY flag_value)
"""


def flag_status(spark, sf_dir):
    return requests.flag_status(_probes(spark, sf_dir))


def flag_bits(spark, sf_dir):
    return requests.flag_bits(requests.flag_status(_probes(spark, sf_dir)))


def _pairs(spark, sf_dir):
    docs = derive(spark, sf_dir, fixtures.KEY_TEXT)
    found = docs.select("doc_id", F.explode(text.key_number_pairs(F.col("text"), RATE_KEYS)).alias("p"))
    return found.select("doc_id", F.col("p.key").alias("key"), F.col("p.value").alias("value"))


def regex_pairs(spark, sf_dir):
    return _pairs(spark, sf_dir)


def consensus_values(spark, sf_dir):
    return requests.consensus_values(_pairs(spark, sf_dir))


_PAIRS_CTE = f"""WITH docs AS ({in_duckdb(fixtures.KEY_TEXT)}),
m AS (
  SELECT doc_id, f, upper(k) AS key, CAST(CASE WHEN f >= 2 THEN pow(2, v::bigint) ELSE v::bigint END AS bigint) AS value, pos FROM (
    SELECT doc_id, f, unnest(ks) AS k, unnest(vs) AS v, unnest(range(len(ks))) AS pos FROM (
      SELECT doc_id, 0 AS f, regexp_extract_all(text, '\\b(SFW|NSFW|NSFL|NSFP)\\b\\s*[:=]\\s*(\\d+)', 1) AS ks, regexp_extract_all(text, '\\b(SFW|NSFW|NSFL|NSFP)\\b\\s*[:=]\\s*(\\d+)', 2) AS vs FROM docs
      UNION ALL SELECT doc_id, 1, regexp_extract_all(text, '\\b(sfw|nsfw|nsfl|nsfp)\\b\\s*[:=]\\s*(\\d+)', 1), regexp_extract_all(text, '\\b(sfw|nsfw|nsfl|nsfp)\\b\\s*[:=]\\s*(\\d+)', 2) FROM docs
      UNION ALL SELECT doc_id, 2, regexp_extract_all(text, '\\b(SFW|NSFW|NSFL|NSFP)\\b\\s*[:=]\\s*1\\s*<<\\s*(\\d+)', 1), regexp_extract_all(text, '\\b(SFW|NSFW|NSFL|NSFP)\\b\\s*[:=]\\s*1\\s*<<\\s*(\\d+)', 2) FROM docs
      UNION ALL SELECT doc_id, 3, regexp_extract_all(text, '\\b(sfw|nsfw|nsfl|nsfp)\\b\\s*[:=]\\s*1\\s*<<\\s*(\\d+)', 1), regexp_extract_all(text, '\\b(sfw|nsfw|nsfl|nsfp)\\b\\s*[:=]\\s*1\\s*<<\\s*(\\d+)', 2) FROM docs) a) b),
pairs AS (SELECT doc_id, key, arg_max(value, f * 1000000 + pos) AS value FROM m GROUP BY doc_id, key)
"""


def page_links(spark, sf_dir):
    """The first 20 anchors of every page as absolute addresses."""
    pages = table(spark, sf_dir, "pages")
    links = text.attribute_urls(F.col("html"), F.col("url"), "a", "href")
    return pages.select("page_id", F.posexplode(links).alias("pos", "link"))


_LINKS_SQL = """
WITH found AS (
  SELECT page_id, url, unnest(refs[1:20]) AS ref, unnest(range(least(len(refs), 20))) AS pos
  FROM (SELECT page_id, url, regexp_extract_all(html, '<a[^>]+href=["'']([^"'']+)["'']', 1) AS refs FROM pages) p),
parts AS (SELECT *, regexp_extract(url, '^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)', 1) AS origin, regexp_replace(url, '[?#].*$', '') AS no_query,
                 regexp_replace(url, '#.*$', '') AS no_fragment FROM found)
SELECT page_id, CAST(pos AS integer) AS pos,
       CASE WHEN regexp_matches(ref, '^[a-zA-Z][a-zA-Z0-9+.-]*:') THEN ref WHEN ref LIKE '//%' THEN regexp_extract(url, '^[a-zA-Z]+:') || ref
            WHEN ref LIKE '/%' THEN origin || ref WHEN ref LIKE '#%' THEN no_fragment || ref WHEN ref LIKE '?%' THEN no_query || ref
            ELSE CASE WHEN no_query = origin THEN origin || '/' ELSE regexp_extract(no_query, '^(.*/)', 1) END || ref END AS link
FROM parts
"""


def latest_run(spark, sf_dir):
    """The newest version of the item store per id range, by run time."""
    runs = derive(spark, sf_dir, fixtures.VERSIONS).groupBy(F.col("updated_at").alias("run_ts")).agg(F.count("*").alias("n_rows"))
    return latest_run_op(runs, "run_ts")


QUERIES = {
    "request_summary": (
        request_summary,
        LOG_CTE
        + """SELECT test_name, total_requests, successful, rate_limited, other_errors, round(avg_latency_ms, 6) AS avg_latency_ms, total_bytes,
             round(duration_seconds, 6) AS duration_seconds, round(p50_latency_ms, 6) AS p50_latency_ms, round(p95_latency_ms, 6) AS p95_latency_ms,
             round(p99_latency_ms, 6) AS p99_latency_ms, round(requests_per_second, 6) AS requests_per_second,
             round(rate_limited_share, 6) AS rate_limited_share,
             CASE WHEN rate_limited_share < 0.05 THEN 'good' WHEN rate_limited_share < 0.2 THEN 'fair' ELSE 'bad' END AS light FROM summary""",
    ),
    "best_config": (
        best_config,
        LOG_CTE
        + f"""SELECT coalesce(max(test_name), 'default') AS test_name, round(coalesce(max(requests_per_second), 0), 6) AS throughput
              FROM (SELECT * FROM summary WHERE rate_limited_share < {MAX_SHARE} ORDER BY requests_per_second DESC LIMIT 1) b""",
    ),
    "results_rows": (
        results_rows,
        LOG_CTE + "SELECT test_name AS name, round(requests_per_second, 6) AS throughput, round(rate_limited_share, 6) AS rate_limited_pct FROM summary",
    ),
    "rate_threshold": (
        rate_threshold,
        LOG_CTE
        + f""", c AS (SELECT CAST(regexp_extract(test_name, '(\\d+)$', 1) AS bigint) AS rate, rate_limited_share FROM summary),
        w AS (SELECT *, rate_limited_share > {MAX_SHARE} AS over,
                     max(CASE WHEN rate_limited_share > {MAX_SHARE} THEN 1 ELSE 0 END) OVER (ORDER BY rate ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS stopped,
                     lag(rate) OVER (ORDER BY rate) AS prev FROM c)
        SELECT rate, round(rate_limited_share, 6) AS rate_limited_share, over AS is_stop, CASE WHEN over THEN coalesce(prev, 0) END AS last_good_rate
        FROM w WHERE coalesce(stopped, 0) = 0""",
    ),
    "sustained_progress": (
        sustained_progress,
        LOG_CTE
        + """SELECT test_name, request_id, n, round(elapsed, 6) AS elapsed_seconds, round(CASE WHEN elapsed > 0 THEN n / elapsed ELSE 0 END, 6) AS rate, limited
             FROM (SELECT test_name, request_id, row_number() OVER w AS n, (us - min(us) OVER (PARTITION BY test_name)) / 1e6::double AS elapsed,
                          CAST(sum(CASE WHEN status_code = 429 THEN 1 ELSE 0 END) OVER w AS bigint) AS limited
                   FROM log WINDOW w AS (PARTITION BY test_name ORDER BY us, request_id)) p WHERE n % 20 = 0""",
    ),
    "retry_streaks": (
        retry_streaks,
        LOG_CTE
        + """, s AS (SELECT *, CAST(sum(CASE WHEN status_code = 200 THEN 1 ELSE 0 END) OVER (PARTITION BY test_name ORDER BY us, request_id) AS bigint) AS streak FROM log),
        a AS (SELECT *, row_number() OVER (PARTITION BY test_name, streak ORDER BY us, request_id) AS attempt FROM s WHERE status_code = 429),
        fib AS (SELECT unnest([1, 1, 2, 3, 5, 8, 13, 21, 34, 55, 89, 144, 233, 300]) AS wait, unnest(range(1, 15)) AS n)
        SELECT test_name, request_id, streak, attempt, CAST(wait AS bigint) AS fibonacci_wait, CAST(least(pow(2, attempt), 300) AS bigint) AS exponential_wait,
               CAST(greatest(60, wait) AS bigint) AS cooldown_wait FROM a JOIN fib ON fib.n = least(a.attempt, 14)""",
    ),
    "rate_tumbling": (
        rate_tumbling,
        LOG_CTE
        + f"""SELECT test_name, us // {WIDTH_US} * {WIDTH_US} AS start_us, us // {WIDTH_US} * {WIDTH_US} + {WIDTH_US} AS end_us, count(*) AS requests,
              count(*) FILTER (status_code = 429) AS limited FROM log GROUP BY 1, 2, 3""",
    ),
    "rate_sliding": (
        rate_sliding,
        LOG_CTE
        + f"""SELECT start_us, start_us + {WIDTH_US} AS end_us, count(*) AS requests
              FROM (SELECT us // {SLIDE_US} * {SLIDE_US} - unnest([0, {SLIDE_US}]) AS start_us FROM log) s GROUP BY start_us HAVING count(*) > {BUSY}""",
    ),
    "cooldown_sessions": (cooldown_sessions, SESSIONS_SQL + "SELECT * FROM sessions"),
    "error_histogram": (
        error_histogram,
        """WITH c AS (SELECT 'code ' || CAST(json_extract(props, '$.k') AS varchar) AS reason, count(*) AS n FROM events WHERE event_type = 'error' GROUP BY 1),
           r AS (SELECT *, row_number() OVER (ORDER BY n DESC, reason) AS rank FROM c),
           h AS (SELECT CASE WHEN rank <= 10 THEN reason ELSE '(other reasons)' END AS reason, CAST(sum(n) AS bigint) AS n FROM r GROUP BY 1)
           SELECT reason, n, round(n / (SELECT count(*) FROM events), 6) AS share FROM h""",
    ),
    "flag_status": (flag_status, _PROBES_CTE + "SELECT flag_value, status, items, flags_seen FROM status"),
    "flag_bits": (
        flag_bits,
        _PROBES_CTE
        + """SELECT CAST(b AS integer) AS bit, count(*) FILTER (status = 'works' AND (flag_value >> b) & 1 = 1) AS works_with,
             count(*) FILTER (status = 'works' AND (flag_value >> b) & 1 = 0) AS works_without,
             count(*) FILTER (status <> 'works' AND (flag_value >> b) & 1 = 1) AS fails_with
             FROM (SELECT *, unnest(range(6)) AS b FROM status) s GROUP BY b""",
    ),
    "regex_pairs": (regex_pairs, _PAIRS_CTE + "SELECT doc_id, key, value FROM pairs"),
    "consensus_values": (
        consensus_values,
        _PAIRS_CTE
        + """SELECT key, value, n FROM (SELECT key, value, count(*) AS n, row_number() OVER (PARTITION BY key ORDER BY count(*) DESC, value) AS rn
             FROM pairs GROUP BY key, value) c WHERE rn = 1""",
    ),
    "page_links": (page_links, _LINKS_SQL),
    "latest_run": (
        latest_run,
        f"SELECT updated_at AS run_ts, count(*) AS n_rows FROM ({in_duckdb(fixtures.VERSIONS)}) v GROUP BY 1 ORDER BY 1 DESC LIMIT 1",
    ),
}
