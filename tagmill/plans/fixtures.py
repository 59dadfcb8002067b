"""The given tables seen as the engine's own inputs.

Each text is valid in Spark SQL and in DuckDB, so the same derivation feeds a query and its check. Curly names are
tables. Every derivation is one row in, one row out (joins are on primary keys), so no key can gather rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagmill.operators.once import compute_once
from tagmill.session import spread

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def _tag(number: int, confidence: str | None, tag: str) -> str:
    """SQL for one JSON tag object."""
    conf = f""" || ',"confidence":' || CAST({confidence} AS string)""" if confidence else ""
    return f"""'{{{{"id":{number}'{conf} || ',"tag":"' || {tag} || '"}}}}'"""


_PATH = """CAST(year(o_orderdate) AS string) || '/' || CAST(month(o_orderdate) AS string) || '/' || CAST(o_orderkey AS string) ||
       CASE o_orderpriority WHEN '1-URGENT' THEN '.jpg' WHEN '2-HIGH' THEN '.JPEG' WHEN '3-MEDIUM' THEN '.png'
                            WHEN '4-NOT SPECIFIED' THEN '.gif' ELSE CASE o_orderstatus WHEN 'O' THEN '.mp4' ELSE '' END END"""
_IMAGE = f"CASE WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'P' THEN NULL ELSE {_PATH} END"
_FLAGS = """CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2
            ELSE CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 4 ELSE 8 END END"""

# Stored items with JSON text. u and v are a price share and a balance share, both about uniform in [0, 1].
# Duplicate tags, padding, mixed case, missing confidences, empty and null texts all occur.
ITEMS = f"""
SELECT o_orderkey AS id, {_IMAGE} AS image,
       CASE WHEN o_orderstatus = 'F' THEN CAST(floor(u * 1000) AS bigint) END AS promoted,
       CAST(floor(o_totalprice) AS bigint) AS up, CAST(floor(v * 100) AS bigint) AS down,
       CAST(year(o_orderdate) * 10000 + month(o_orderdate) * 100 + day(o_orderdate) AS bigint) AS created,
       CASE WHEN o_orderstatus = 'O' THEN NULL ELSE CAST(640 AS bigint) END AS width, CAST(480 AS bigint) AS height,
       CAST(0 AS bigint) AS audio, CASE WHEN o_orderstatus = 'P' THEN o_orderpriority END AS source,
       {_FLAGS} AS flags, c_name AS user_name, CAST(c_nationkey AS bigint) AS mark, CAST(NULL AS bigint) AS gift,
       CASE WHEN o_orderstatus = 'P' AND u < 0.02 THEN NULL WHEN o_orderstatus = 'P' AND u < 0.025 THEN ''
            ELSE '[' || {_tag(1, "u", "' ' || c_mktsegment || ' '")} || ',' || {_tag(2, "0.5 * v + 0.1 * u", "c_name")} ||
            ',' || CASE WHEN o_orderstatus = 'P' THEN {_tag(3, None, "n_name")} ELSE {_tag(3, "u * v", "n_name")} END ||
            CASE WHEN o_orderstatus = 'O' AND o_orderpriority = '3-MEDIUM' THEN ''
                 ELSE ',' || {_tag(4, "v * 0.3", "o_orderpriority")} ||
                      ',' || {_tag(5, "0.2 + 0.6 * (1 - u)", "'month ' || CAST(year(o_orderdate) * 100 + month(o_orderdate) AS string)")} ||
                      ',' || {_tag(6, "0.15 + 0.4 * v", "'status ' || o_orderstatus || chr(92) || 't'")} END ||
            CASE WHEN o_orderstatus = 'F' THEN ',' || {_tag(7, "0.1 * v", "lower(c_mktsegment)")} ELSE '' END ||
            CASE WHEN u >= 0.92 THEN ',' || {_tag(8, "CASE WHEN v > 0.5 THEN 0.9 ELSE 0.02 END", "'Order ' || CAST(o_orderkey AS string)")} ELSE '' END ||
            CASE WHEN u >= 0.95 THEN ',' || {_tag(9, "0.9", "'NSFW'")} WHEN u >= 0.90 THEN ',' || {_tag(9, "0.9", "' sfw'")}
                 WHEN u < 0.035 THEN ',' || {_tag(9, "0.8", "'nsfl'")} WHEN u < 0.055 THEN ',' || {_tag(9, "0.7", "'NSFP '")} ELSE '' END ||
            ']' END AS tags_data,
       CASE WHEN o_orderstatus = 'F' THEN NULL
            ELSE '[{{{{"id":' || CAST(o_orderkey AS string) || ',"content":"' || o_orderpriority || '","name":"' || c_name || '"}}}}]'
       END AS comments_data,
       CAST(1 AS bigint) AS updated_at
FROM (SELECT *, o_totalprice / 499979 AS u, (c_acctbal + 1000) / 11003 AS v
      FROM {{orders}} JOIN {{customer}} ON o_custkey = c_custkey JOIN {{nation}} ON c_nationkey = n_nationkey) j
"""

# Media paths with a local and a remote size; the media that are held belong to orders with a returned line.
CATALOG = f"""
SELECT o_orderkey AS id, {_IMAGE} AS image, {_FLAGS} AS flags, CAST(floor(o_totalprice) AS bigint) AS local_size,
       CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '2-HIGH' THEN NULL
            WHEN o_orderstatus = 'O' AND o_orderpriority = '1-URGENT' THEN CAST(floor(o_totalprice) AS bigint) + 1
            ELSE CAST(floor(o_totalprice) AS bigint) END AS remote_size
FROM {{orders}}
"""
LISTING = f"""
SELECT image, local_size FROM ({CATALOG}) c
WHERE image IS NOT NULL AND id IN (SELECT DISTINCT l_orderkey FROM {{lineitem}} WHERE l_returnflag = 'R')
"""

# Ids that are held: orders without any line are the natural gaps. Ids repeat, as lines do.
HELD_IDS = "SELECT l_orderkey AS id FROM {lineitem}"

REQUESTS = """
SELECT event_id AS request_id, ts, 'conf' || CAST(user_id % 5 AS string) AS test_name,
       CASE event_type WHEN 'error' THEN 429 WHEN 'signup' THEN 404 ELSE 200 END AS status_code,
       value AS latency_ms, event_id % 1000 AS size_bytes
FROM {events}
"""

# Base rows, newer versions of some, and new ids; seq orders versions written in one batch.
VERSIONS = """
SELECT o_orderkey AS id, o_totalprice AS up, CAST(1 AS bigint) AS updated_at, CAST(0 AS bigint) AS seq FROM {orders}
UNION ALL SELECT o_orderkey, o_totalprice + 1, CAST(2 AS bigint), CAST(1 AS bigint) FROM {orders} WHERE o_orderstatus = 'F'
UNION ALL SELECT o_orderkey, o_totalprice + 2, CAST(2 AS bigint), CAST(2 AS bigint) FROM {orders} WHERE o_orderstatus = 'F' AND o_orderpriority = '2-HIGH'
UNION ALL SELECT o_orderkey + 10000000, o_totalprice, CAST(2 AS bigint), CAST(3 AS bigint) FROM {orders} WHERE o_orderpriority = '1-URGENT'
"""

RATED = """
SELECT d.doc_id AS id, d.source || '/' || CAST(d.doc_id AS string) || '.png' AS image,
       coalesce(l.toxic = 1, false) AS is_nsfw, coalesce(l.quality = 0, false) AS is_nsfl, d.n_chars > 8000 AS is_nsfp, d.lang, d.source, d.text,
       CAST(d.n_chars AS double) / 20000 AS weight
FROM {documents} d LEFT JOIN {labels} l ON d.doc_id = l.doc_id
"""

KEY_TEXT = """
SELECT event_id AS doc_id, event_type || ' SFW=' || CAST(user_id % 3 AS string) || '; nsfl: 1 << ' || CAST(user_id % 4 AS string) ||
       CASE WHEN event_type = 'view' THEN ' sfw = 7' ELSE '' END || ' NSFP:' || CAST(user_id % 2 AS string) AS text
FROM {events}
"""

COMMENTS = """
SELECT conv_id AS item_id, turn AS id, CASE WHEN turn = 0 THEN 0 ELSE turn - 1 END AS parent, role AS name, text AS content
FROM {conversations}
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# Tables that drive a derivation row by row, with their keys.
DRIVING = {"orders": "o_orderkey", "events": "event_id"}


def derive(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    """Run a derivation over the tables in ``sf_dir``."""
    used = {t: table(spark, sf_dir, t) for t in TABLES if "{" + t + "}" in text}
    for name in DRIVING.keys() & used.keys():
        used[name] = spread(used[name], DRIVING[name])
    return spark.sql(text, **used)


def stored_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ITEMS with its JSON text computed once per row, as a stored column would be."""
    return compute_once(derive(spark, sf_dir, ITEMS), tags_data=F.col("tags_data"))


def in_duckdb(text: str) -> str:
    """The same derivation as a DuckDB subquery."""
    return text.format(**{t: t for t in TABLES})


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per (sample, class): every embedding dimension is a class, scored from its value."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "label", F.posexplode("embedding").alias("class_idx", "x"))
    is_true = F.col("class_idx") % 10 == F.col("label")
    return vectors.select(
        F.col("vec_id").alias("sample_id"),
        F.col("class_idx").cast("long").alias("class_idx"),
        (F.lit(0.4) + F.col("x").cast("double") + F.when(is_true, F.lit(0.15)).otherwise(F.lit(0.0))).alias("score"),
        is_true.cast("int").alias("is_true"),
    )


SCORES_SQL = """
SELECT vec_id AS sample_id, CAST(d AS bigint) AS class_idx,
       CAST(0.4 AS double) + CAST(embedding[d + 1] AS double) + CASE WHEN d % 10 = label THEN CAST(0.15 AS double) ELSE CAST(0 AS double) END AS score,
       CASE WHEN d % 10 = label THEN 1 ELSE 0 END AS is_true
FROM (SELECT vec_id, label, embedding, unnest(range(len(embedding))) AS d FROM embeddings) e
"""
