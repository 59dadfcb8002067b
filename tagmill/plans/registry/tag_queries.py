"""Tag statistics, classification and curation over the whole item table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagmill.functions import text
from tagmill.operators import curate, tags
from tagmill.plans import fixtures, prepare
from tagmill.plans.fixtures import derive, in_duckdb
from tagmill.sources.items import scan_tagged

MIN_TAGS = 5


def _items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.stored_items(spark, sf_dir)


def _parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tags.parse_tags(_items(spark, sf_dir).select("id", "image", "tags_data").where("tags_data IS NOT NULL"))


def _staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare.stage(_items(spark, sf_dir), MIN_TAGS)


def _round(df: DataFrame) -> DataFrame:
    return df.select(*[F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


# --- DuckDB text -------------------------------------------------------------------------------------------------

_JSON_SHAPE = '[{"id":"BIGINT","confidence":"DOUBLE","tag":"VARCHAR"}]'
_WS = r"E' \t\n\r\f\v'"

ITEMS_CTE = f"""
items AS ({in_duckdb(fixtures.ITEMS)}),
parsed AS (
  SELECT * EXCLUDE (tags_data), CASE WHEN tags_data = '' THEN [] ELSE from_json(tags_data, '{_JSON_SHAPE}') END AS tags
  FROM items WHERE tags_data IS NOT NULL)"""

CORPUS_CTE = (
    ITEMS_CTE
    + f""",
eligible AS (SELECT * FROM parsed WHERE regexp_matches(lower(image), '\\.(jpg|jpeg|png)$') AND len(tags) >= {MIN_TAGS}),
raw AS (SELECT id, unnest(tags) AS t, unnest(range(len(tags))) AS pos FROM eligible),
occ AS (SELECT id, pos, trim(lower(t.tag), {_WS}) AS tag, coalesce(t.confidence, 0) AS conf FROM raw),
corpus AS (SELECT count(DISTINCT id) AS n FROM eligible),
base_stats AS (
  SELECT tag, count(*) AS frequency, count(DISTINCT id) AS doc_frequency, avg(conf) AS conf_mean,
         coalesce(stddev_samp(conf), 0) AS conf_std, min(conf) AS conf_min, max(conf) AS conf_max
  FROM occ GROUP BY tag),
stats AS (SELECT s.*, ln(n / doc_frequency) AS idf, doc_frequency / n AS doc_freq_ratio FROM base_stats s, corpus),
q AS (SELECT quantile_cont(conf, 0.10) AS p10, quantile_cont(conf, 0.25) AS p25, quantile_cont(conf, 0.50) AS p50,
             quantile_cont(conf, 0.75) AS p75, quantile_cont(conf, 0.90) AS p90, quantile_cont(conf, 0.95) AS p95,
             quantile_cont(conf, 0.99) AS p99, avg(conf) AS mean, stddev_samp(conf) AS std FROM occ),
limits AS (
  SELECT count(*) AS unique_tags, CAST(sum(frequency) AS bigint) AS total_tags, max(q.p75) AS high_confidence, max(q.p50) AS median_confidence,
         greatest(3, CAST(floor(quantile_cont(frequency, 0.25)) AS bigint)) AS min_corpus_frequency,
         quantile_cont(doc_freq_ratio, 0.95) AS doc_ratio_limit, quantile_cont(idf, 0.10) AS idf_limit, avg(conf_std) AS mean_std
  FROM stats, q),
judged AS (
  SELECT s.*, l.high_confidence, l.min_corpus_frequency,
         s.doc_freq_ratio > l.doc_ratio_limit AND s.tag NOT IN ('nsfw','nsfl','nsfp','sfw') AS c1,
         s.idf < l.idf_limit AND s.conf_mean < l.median_confidence AND s.tag NOT IN ('nsfw','nsfl','nsfp','sfw') AS c2,
         l.unique_tags > 100 AND s.conf_std > 2 * l.mean_std AND s.tag NOT IN ('nsfw','nsfl','nsfp','sfw') AS c3,
         s.doc_frequency = 1 AND s.conf_mean < l.median_confidence AS c4,
         printf('high_doc_freq (>%.1f%%)', l.doc_ratio_limit * 100) AS c1_text
  FROM stats s, limits l),
classified AS (
  SELECT *, CASE WHEN c1 THEN c1_text WHEN c2 THEN 'low_idf_low_conf' WHEN c3 THEN 'high_conf_variance'
                 WHEN c4 THEN 'singleton_low_conf' END AS trash_reason FROM judged),
merged AS (
  SELECT id, tag, sum(conf) AS conf, min(pos) AS pos FROM occ WHERE tag NOT IN ('nsfw','nsfl','nsfp','sfw') GROUP BY id, tag),
ranked AS (
  SELECT m.id, m.tag, m.conf, m.pos, c.trash_reason IS NOT NULL AS is_trash,
         row_number() OVER (PARTITION BY m.id ORDER BY c.trash_reason IS NOT NULL, m.conf DESC, m.pos) AS rank
  FROM merged m JOIN classified c ON m.tag = c.tag
  WHERE c.trash_reason IS NOT NULL OR m.conf >= c.high_confidence OR c.frequency >= c.min_corpus_frequency),
full_items AS (SELECT id FROM ranked WHERE rank <= {MIN_TAGS} GROUP BY id HAVING count(*) = {MIN_TAGS}),
curated AS (
  SELECT r.*, row_number() OVER (PARTITION BY r.id ORDER BY r.conf DESC, r.is_trash, r.pos) AS slot
  FROM ranked r JOIN full_items f ON r.id = f.id WHERE r.rank <= {MIN_TAGS})"""
)


def corpus_sql(select: str) -> str:
    return f"WITH {CORPUS_CTE}\n{select}"


def items_sql(select: str) -> str:
    return f"WITH {ITEMS_CTE}\n{select}"


# --- queries -----------------------------------------------------------------------------------------------------


def scan_tagged_items(spark, sf_dir):
    """The minimal scan; the text is summarised by its number of tag objects, since numbers print differently elsewhere."""
    scanned = scan_tagged(_items(spark, sf_dir))
    return scanned.select("id", "image", F.regexp_count("tags_data", F.lit('"tag":')).alias("n_objects"))


def filter_images(spark, sf_dir):
    return derive(spark, sf_dir, fixtures.ITEMS).where(text.is_image(F.col("image"))).select("id", "image")


def parse_tags(spark, sf_dir):
    parsed = _parsed(spark, sf_dir)
    return parsed.select("id", F.posexplode("tags").alias("pos", "t")).select(
        "id", "pos", F.col("t.id").alias("tag_id"), F.round("t.confidence", 6).alias("confidence"), F.col("t.tag").alias("raw_tag")
    )


def parse_rejects(spark, sf_dir):
    return tags.count_rejects(_items(spark, sf_dir).select("tags_data"))


def filter_min_tags(spark, sf_dir):
    return tags.filter_min_tags(_parsed(spark, sf_dir), MIN_TAGS).select("id", F.size("tags").alias("n_tags"))


def explode_tags(spark, sf_dir):
    return _round(tags.explode_tags(_parsed(spark, sf_dir)))


def normalize_tags(spark, sf_dir):
    raw = _parsed(spark, sf_dir).select(F.explode("tags").alias("t")).select(F.col("t.tag").alias("raw_tag"))
    return raw.groupBy("raw_tag", text.normalize_tag(F.col("raw_tag")).alias("tag")).agg(F.count("*").alias("n"))


def tag_stats(spark, sf_dir):
    return _round(tags.tag_stats(_staged(spark, sf_dir)))


def tag_idf(spark, sf_dir):
    staged = _staged(spark, sf_dir)
    return _round(tags.with_idf(tags.tag_stats(staged), staged).select("tag", "doc_frequency", "idf", "doc_freq_ratio"))


def confidence_percentiles(spark, sf_dir):
    return _round(tags.confidence_percentiles(_staged(spark, sf_dir)))


def confidence_summary(spark, sf_dir):
    found = prepare.analyze(_items(spark, sf_dir), MIN_TAGS)
    return _round(tags.confidence_summary(found.items, found.percentiles))


def thresholds(spark, sf_dir):
    return _round(prepare.analyze(_items(spark, sf_dir), MIN_TAGS).limits)


def trash_tags(spark, sf_dir):
    found = prepare.analyze(_items(spark, sf_dir), MIN_TAGS)
    return found.classified.where("trash_reason IS NOT NULL").select("tag", "frequency", "doc_frequency", "trash_reason")


def trash_breakdown(spark, sf_dir):
    found = prepare.analyze(_items(spark, sf_dir), MIN_TAGS)
    return tags.trash_breakdown(found.stats, found.limits)


def trash_sample(spark, sf_dir):
    return tags.trash_sample(prepare.analyze(_items(spark, sf_dir), MIN_TAGS).classified)


def merge_item_tags(spark, sf_dir):
    merged = curate.merge_item_tags(_staged(spark, sf_dir))
    return merged.select("id", "tag", F.round("conf", 6).alias("conf"))


def item_flags(spark, sf_dir):
    return curate.item_flags(_staged(spark, sf_dir)).select("id", "is_nsfw", "is_nsfl", "is_nsfp")


def curate_items(spark, sf_dir):
    """Curated items, one row per kept tag with its slot."""
    built = prepare.build(_items(spark, sf_dir), MIN_TAGS)
    return built.select(
        "id", "image", "is_nsfw", "is_nsfl", "is_nsfp", "trash_used", F.posexplode(F.arrays_zip("tags", "confidences")).alias("p", "e")
    ).select(
        "id", "image", "is_nsfw", "is_nsfl", "is_nsfp", "trash_used", (F.col("p") + 1).alias("slot"),
        F.col("e.tags").alias("tag"), F.round("e.confidences", 6).alias("confidence"),
    )


def dataset_metadata(spark, sf_dir):
    found = prepare.analyze(_items(spark, sf_dir), MIN_TAGS)
    curated = curate.curate_items(found.items, found.classified, found.limits, MIN_TAGS)
    return _round(prepare.metadata(found, curated, MIN_TAGS))


def unique_tags(spark, sf_dir):
    return tags.unique_tags(_parsed(spark, sf_dir))


def top_tags(spark, sf_dir):
    return tags.tag_counts(_parsed(spark, sf_dir), 100)


def tag_counts_all(spark, sf_dir):
    return tags.tag_counts(_parsed(spark, sf_dir), None)


def array_ops(spark, sf_dir):
    """Length, leading slice and cast of the tag lists."""
    conf = F.transform("tags", lambda t: F.coalesce(t["confidence"], F.lit(0.0)))
    return _parsed(spark, sf_dir).select(
        "id",
        F.size("tags").alias("n_tags"),
        F.array_join(F.slice(F.transform("tags", lambda t: t["tag"]), 1, MIN_TAGS), "|").alias("first_tags"),
        F.round(F.aggregate(F.slice(conf, 1, MIN_TAGS), F.lit(0.0), lambda a, x: a + x), 6).alias("first_conf"),
    )


def dev_limit(spark, sf_dir):
    return prepare.eligible(_items(spark, sf_dir), MIN_TAGS, limit=1000).select("id", "image", F.size("tags").alias("n_tags"))


QUERIES = {
    "scan_tagged_items": (
        scan_tagged_items,
        items_sql("""SELECT id, image, CAST(len(regexp_extract_all(tags_data, '"tag":')) AS integer) AS n_objects
                     FROM items WHERE tags_data IS NOT NULL"""),
    ),
    "filter_images": (filter_images, items_sql("SELECT id, image FROM items WHERE regexp_matches(lower(image), '\\.(jpg|jpeg|png)$')")),
    "parse_tags": (
        parse_tags,
        items_sql("""SELECT id, pos, t.id AS tag_id, round(t.confidence, 6) AS confidence, t.tag AS raw_tag
                     FROM (SELECT id, unnest(tags) AS t, unnest(range(len(tags))) AS pos FROM parsed) p"""),
    ),
    "parse_rejects": (parse_rejects, items_sql("SELECT count(*) AS with_text, count(*) FILTER (tags IS NULL) AS rejected FROM parsed")),
    "filter_min_tags": (filter_min_tags, items_sql(f"SELECT id, len(tags) AS n_tags FROM parsed WHERE len(tags) >= {MIN_TAGS}")),
    "explode_tags": (
        explode_tags,
        items_sql(f"""SELECT id, pos, trim(lower(t.tag), {_WS}) AS tag, round(coalesce(t.confidence, 0), 6) AS confidence
                      FROM (SELECT id, unnest(tags) AS t, unnest(range(len(tags))) AS pos FROM parsed) p"""),
    ),
    "normalize_tags": (
        normalize_tags,
        items_sql(f"""SELECT t.tag AS raw_tag, trim(lower(t.tag), {_WS}) AS tag, count(*) AS n
                      FROM (SELECT unnest(tags) AS t FROM parsed) p GROUP BY ALL"""),
    ),
    "tag_stats": (
        tag_stats,
        corpus_sql("""SELECT tag, frequency, doc_frequency, round(conf_mean, 6) AS conf_mean, round(conf_std, 6) AS conf_std,
                      round(conf_min, 6) AS conf_min, round(conf_max, 6) AS conf_max FROM stats"""),
    ),
    "tag_idf": (tag_idf, corpus_sql("SELECT tag, doc_frequency, round(idf, 6) AS idf, round(doc_freq_ratio, 6) AS doc_freq_ratio FROM stats")),
    "confidence_percentiles": (
        confidence_percentiles,
        corpus_sql("SELECT " + ", ".join(f"round({p}, 6) AS {p}" for p in tags.CONFIDENCE_QUANTILES) + " FROM q"),
    ),
    "confidence_summary": (
        confidence_summary,
        corpus_sql("SELECT round(mean, 6) AS mean, round(std, 6) AS std, round(p50, 6) AS median, round(p75, 6) AS p75, round(p90, 6) AS p90 FROM q"),
    ),
    "thresholds": (
        thresholds,
        corpus_sql("""SELECT unique_tags, total_tags, round(high_confidence, 6) AS high_confidence, round(median_confidence, 6) AS median_confidence,
                      min_corpus_frequency, round(doc_ratio_limit, 6) AS doc_ratio_limit, round(idf_limit, 6) AS idf_limit,
                      round(mean_std, 6) AS mean_std FROM limits"""),
    ),
    "trash_tags": (trash_tags, corpus_sql("SELECT tag, frequency, doc_frequency, trash_reason FROM classified WHERE trash_reason IS NOT NULL")),
    "trash_breakdown": (
        trash_breakdown,
        corpus_sql("""SELECT count(*) AS unique_tags, count(*) FILTER (c1 OR c2 OR c3 OR c4) AS trash_tags, count(*) FILTER (c1) AS high_doc_freq,
                      count(*) FILTER (c2) AS low_idf_low_conf, count(*) FILTER (c3) AS high_conf_variance,
                      count(*) FILTER (c4) AS singleton_low_conf FROM classified"""),
    ),
    "trash_sample": (
        trash_sample,
        corpus_sql("SELECT tag, trash_reason FROM classified WHERE trash_reason IS NOT NULL ORDER BY tag LIMIT 50"),
    ),
    "merge_item_tags": (merge_item_tags, corpus_sql("SELECT id, tag, round(conf, 6) AS conf FROM merged")),
    "item_flags": (
        item_flags,
        corpus_sql("SELECT id, bool_or(tag = 'nsfw') AS is_nsfw, bool_or(tag = 'nsfl') AS is_nsfl, bool_or(tag = 'nsfp') AS is_nsfp FROM occ GROUP BY id"),
    ),
    "curate_items": (
        curate_items,
        corpus_sql("""
        , flags AS (SELECT id, bool_or(tag = 'nsfw') AS is_nsfw, bool_or(tag = 'nsfl') AS is_nsfl, bool_or(tag = 'nsfp') AS is_nsfp FROM occ GROUP BY id)
        SELECT c.id, e.image, f.is_nsfw, f.is_nsfl, f.is_nsfp,
               CAST(sum(CASE WHEN c.is_trash THEN 1 ELSE 0 END) OVER (PARTITION BY c.id) AS integer) AS trash_used,
               CAST(c.slot AS integer) AS slot, c.tag, round(c.conf, 6) AS confidence
        FROM curated c JOIN eligible e ON c.id = e.id JOIN flags f ON c.id = f.id"""),
    ),
    "dataset_metadata": (
        dataset_metadata,
        corpus_sql(f"""
        SELECT (SELECT count(*) FROM full_items) AS total_items, n - (SELECT count(*) FROM full_items) AS items_skipped, {MIN_TAGS} AS min_tags,
               unique_tags, total_tags AS total_tag_occurrences, round(high_confidence, 6) AS high_confidence, min_corpus_frequency,
               round(mean, 6) AS conf_mean, round(std, 6) AS conf_std, round(p50, 6) AS conf_median, round(p75, 6) AS conf_p75,
               round(p90, 6) AS conf_p90, (SELECT count(*) FROM classified WHERE trash_reason IS NOT NULL) AS trash_tags_count,
               (SELECT count(*) FROM curated WHERE is_trash) AS trash_tags_kept_for_min
        FROM limits, q, corpus"""),
    ),
    "unique_tags": (unique_tags, items_sql("SELECT DISTINCT t.tag AS tag FROM (SELECT unnest(tags) AS t FROM parsed) p")),
    "top_tags": (
        top_tags,
        items_sql("SELECT t.tag AS tag, count(*) AS n FROM (SELECT unnest(tags) AS t FROM parsed) p GROUP BY t.tag ORDER BY n DESC, tag LIMIT 100"),
    ),
    "tag_counts_all": (tag_counts_all, items_sql("SELECT t.tag AS tag, count(*) AS n FROM (SELECT unnest(tags) AS t FROM parsed) p GROUP BY t.tag")),
    "array_ops": (
        array_ops,
        items_sql(f"""SELECT id, len(tags) AS n_tags, array_to_string(list_transform(tags[1:{MIN_TAGS}], lambda t: t.tag), '|') AS first_tags,
                      round(coalesce(list_sum(list_transform(tags[1:{MIN_TAGS}], lambda t: coalesce(t.confidence, 0))), 0), 6) AS first_conf FROM parsed"""),
    ),
    "dev_limit": (
        dev_limit,
        corpus_sql("SELECT id, image, len(tags) AS n_tags FROM eligible ORDER BY id LIMIT 1000"),
    ),
}
