"""Catalog reconciliation: ids, versions and media over the whole order tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tagmill.functions import flags, text
from tagmill.operators import catalog, media
from tagmill.operators import tags as tag_ops
from tagmill.plans import fixtures
from tagmill.plans.fixtures import derive, in_duckdb, table
from tagmill.plans.registry.tag_queries import items_sql
from tagmill.sources import items as item_source

REMOTE_AHEAD = 250
LOOKUP_ID = 777
PAGE_AFTER = 500
PAGE_SIZE = 1000


def _items(spark, sf_dir):
    return derive(spark, sf_dir, fixtures.ITEMS)


def _parsed(spark, sf_dir):
    return tag_ops.parse_tags(fixtures.stored_items(spark, sf_dir).where("tags_data IS NOT NULL"))


def _catalog(spark, sf_dir):
    return derive(spark, sf_dir, fixtures.CATALOG)


def _listing(spark, sf_dir):
    return derive(spark, sf_dir, fixtures.LISTING)


def _held(spark, sf_dir):
    return derive(spark, sf_dir, fixtures.HELD_IDS)


def _remote_max(spark, sf_dir):
    return table(spark, sf_dir, "orders").agg(F.max("o_orderkey") + REMOTE_AHEAD).scalar()


CATALOG_CTE = f"""WITH catalog AS ({in_duckdb(fixtures.CATALOG)}),
listing AS ({in_duckdb(fixtures.LISTING)}),
media AS (SELECT id, image FROM catalog WHERE image IS NOT NULL
          AND lower(regexp_extract(image, '(\\.[^.]+)$', 1)) IN ('.jpg', '.jpeg', '.png', '.gif'))
"""
GAPS_CTE = f"""WITH held AS (SELECT DISTINCT id FROM ({in_duckdb(fixtures.HELD_IDS)}) h),
r AS (SELECT max(o_orderkey) + {REMOTE_AHEAD} AS remote FROM orders),
gaps AS (SELECT count(*) AS local_count, min(id) AS local_min, max(id) AS local_max, greatest(max(remote) - max(id), 0) AS top_gap,
                greatest(min(id) - 1, 0) AS bottom_gap, greatest(max(id) - min(id) + 1 - count(*), 0) AS internal_gaps, max(remote) AS remote
         FROM held, r)
"""


def id_range(spark, sf_dir):
    return catalog.id_range(_items(spark, sf_dir).select("id"))


def gap_analysis(spark, sf_dir):
    return catalog.gap_analysis(_held(spark, sf_dir), _remote_max(spark, sf_dir))


def gap_ranges(spark, sf_dir):
    return catalog.gap_ranges(_held(spark, sf_dir))


def fetch_plan(spark, sf_dir):
    remote = _remote_max(spark, sf_dir)
    gaps = catalog.gap_analysis(_held(spark, sf_dir), remote)
    return catalog.fetch_plan(gaps, remote)


def fetch_window(spark, sf_dir):
    """Catalog rows inside the planned window that are not held: internal gaps are filled."""
    held = _held(spark, sf_dir)
    own_max = held.agg(F.max("id")).scalar()
    plan = catalog.fetch_plan(catalog.gap_analysis(held, own_max), own_max, fill_gaps=True)
    return catalog.new_items(catalog.in_window(_catalog(spark, sf_dir).select("id", "image"), plan), held)


def new_items(spark, sf_dir):
    return catalog.new_items(_catalog(spark, sf_dir).select("id", "image"), _held(spark, sf_dir))


def upsert_latest(spark, sf_dir):
    return catalog.upsert_latest(derive(spark, sf_dir, fixtures.VERSIONS)).select("id", "up", "updated_at")


def apply_delta(spark, sf_dir):
    versions = derive(spark, sf_dir, fixtures.VERSIONS)
    base, delta = versions.where("updated_at = 1"), versions.where("updated_at = 2")
    return catalog.apply_delta(base, delta).select("id", "up", "updated_at")


_UPSERT_SQL = f"""SELECT id, up, updated_at FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY updated_at DESC, seq DESC) AS rn FROM ({in_duckdb(fixtures.VERSIONS)}) v) w WHERE rn = 1"""


def decode_items(spark, sf_dir):
    """Decoded items with every default applied; list contents as counts and first values."""
    d = item_source.decode_items(fixtures.stored_items(spark, sf_dir))
    return d.select(
        "id", "image", "promoted", "width", "source", "flags", "user_name", "gift",
        F.size("tags").alias("n_tags"),
        F.round(F.aggregate("tags", F.lit(0.0), lambda a, t: a + t["confidence"]), 6).alias("conf_sum"),
        F.size("comments").alias("n_comments"),
        F.try_element_at("comments", F.lit(1))["content"].alias("first_content"),
        F.try_element_at("comments", F.lit(1))["up"].alias("first_up"),
    )


def item_lookup(spark, sf_dir):
    return item_source.item_lookup(_items(spark, sf_dir), LOOKUP_ID).select("id", "image", "up", "flags")


def page_items(spark, sf_dir):
    return item_source.page_items(_items(spark, sf_dir), PAGE_AFTER, PAGE_SIZE).select("id", "image")


def page_by_offset(spark, sf_dir):
    return item_source.page_items_by_offset(_items(spark, sf_dir).select("id", "image"), 1, PAGE_SIZE)


def items_min_tags(spark, sf_dir):
    return item_source.items_min_tags(_parsed(spark, sf_dir), 8).select("id", "image", F.size("tags").alias("n_tags"))


def newest_page(spark, sf_dir):
    return catalog.newest_page(_catalog(spark, sf_dir).select("id", "image"), older=1200, limit=120)


def sample_paths(spark, sf_dir):
    return catalog.sample_paths(_catalog(spark, sf_dir), 100, 1)


def flag_mask_filter(spark, sf_dir):
    return catalog.flag_mask_filter(_catalog(spark, sf_dir), 6).select("id", "flags")


def flag_decode(spark, sf_dir):
    """Rating names of every item, from its mask and from the mask combined with the next rating."""
    both = F.col("flags").bitwiseOR(F.lit(2))
    return _catalog(spark, sf_dir).select(
        "id", flags.flag_names(F.col("flags")).alias("names"), flags.flag_names(both).alias("names_with_2")
    )


def has_enough(spark, sf_dir):
    return catalog.has_enough(_items(spark, sf_dir), 1000)


def catalog_profile(spark, sf_dir):
    return catalog.catalog_profile(tag_ops.parse_tags(fixtures.stored_items(spark, sf_dir)), 10)


def catalog_media(spark, sf_dir):
    return media.catalog_media(_catalog(spark, sf_dir))


def catalog_media_videos(spark, sf_dir):
    return media.catalog_media(_catalog(spark, sf_dir), include_videos=True)


def ext_counts(spark, sf_dir):
    return media.extension_counts(_catalog(spark, sf_dir))


def split_paths(spark, sf_dir):
    return media.split_paths(_catalog(spark, sf_dir))


def missing_media(spark, sf_dir):
    return media.missing_media(media.catalog_media(_catalog(spark, sf_dir)), _listing(spark, sf_dir))


def missing_media_distinct(spark, sf_dir):
    return media.missing_media_distinct(media.catalog_media(_catalog(spark, sf_dir)), _listing(spark, sf_dir))


def missing_by_dir(spark, sf_dir):
    return media.missing_by_dir(media.catalog_media(_catalog(spark, sf_dir)), _listing(spark, sf_dir))


def media_presence(spark, sf_dir):
    return media.media_presence(media.catalog_media(_catalog(spark, sf_dir)), _listing(spark, sf_dir))


def media_summary(spark, sf_dir):
    return media.media_summary(media.catalog_media(_catalog(spark, sf_dir)), _listing(spark, sf_dir), seconds=10)


def verify_sizes(spark, sf_dir):
    c = _catalog(spark, sf_dir)
    remote = c.where("image IS NOT NULL").select("image", "remote_size")
    return media.verify_sizes(media.catalog_media(c), _listing(spark, sf_dir), remote).select("id", "image", "needs_download")


def human_bytes(spark, sf_dir):
    scaled = F.col("local_size") * F.col("local_size")
    return _catalog(spark, sf_dir).select(
        "id", text.human_bytes(F.col("local_size")).alias("size_text"), text.human_bytes(scaled).alias("large_text")
    )


def human_duration(spark, sf_dir):
    return _catalog(spark, sf_dir).select("id", text.human_duration(F.floor(F.col("local_size") / 37)).alias("duration_text"))


def run_summary(spark, sf_dir):
    """Fetch and download counters of one reconciliation, merged."""
    c, held = _catalog(spark, sf_dir), _held(spark, sf_dir)
    m, listing = media.catalog_media(c), _listing(spark, sf_dir)
    fetched = catalog.new_items(c.select("id"), held).agg(F.count("*").alias("items_processed"))
    fetch = fetched.select(F.lit("fetch").alias("stage"), "items_processed", (c.agg(F.count("*")).scalar() - F.col("items_processed")).alias("items_skipped"))
    down = media.missing_media(m.join(c.select("id", "local_size"), "id"), listing)
    download = down.agg(F.count("*").alias("files_downloaded"), F.sum("local_size").alias("bytes_downloaded")).select(
        F.lit("download").alias("stage"), "*"
    )
    return catalog.run_summary([fetch, download])


def attach_details(spark, sf_dir):
    """Items with the comments that landed for them, one row per comment."""
    items, details = _item_details(spark, sf_dir)
    return catalog.attach_details(items, details)


def failed_details(spark, sf_dir):
    items, details = _item_details(spark, sf_dir)
    return catalog.failed_details(items, details)


def _item_details(spark, sf_dir):
    items = _catalog(spark, sf_dir).select("id", "image")
    details = derive(spark, sf_dir, fixtures.COMMENTS).select(
        "item_id", F.col("id").alias("comment_id"), "parent", "name", F.length("content").alias("n_chars")
    )
    return items, details


QUERIES = {
    "id_range": (id_range, "SELECT min(o_orderkey) AS min_id, max(o_orderkey) AS max_id, count(*) AS item_count FROM orders"),
    "gap_analysis": (
        gap_analysis,
        GAPS_CTE
        + """SELECT local_count, local_min, local_max, top_gap, bottom_gap, internal_gaps,
             top_gap + bottom_gap + internal_gaps AS total_missing, top_gap + bottom_gap + internal_gaps = 0 AS is_complete FROM gaps""",
    ),
    "gap_ranges": (
        gap_ranges,
        GAPS_CTE
        + """SELECT id + 1 AS gap_start, nxt - 1 AS gap_end, nxt - id - 1 AS gap_length
             FROM (SELECT id, lead(id) OVER (ORDER BY id) AS nxt FROM held) n WHERE nxt > id + 1""",
    ),
    "fetch_plan": (
        fetch_plan,
        GAPS_CTE
        + """SELECT CASE WHEN top_gap > 0 THEN 'top' WHEN bottom_gap > 0 THEN 'bottom' ELSE 'none' END AS mode,
             CASE WHEN top_gap > 0 THEN remote WHEN bottom_gap > 0 THEN local_min - 1 END AS start_id,
             CASE WHEN top_gap > 0 THEN local_max + 1 WHEN bottom_gap > 0 THEN 1 END AS end_id,
             CASE WHEN top_gap > 0 THEN remote - local_max WHEN bottom_gap > 0 THEN local_min - 1 END AS estimated FROM gaps""",
    ),
    "fetch_window": (
        fetch_window,
        f"""SELECT id, image FROM ({in_duckdb(fixtures.CATALOG)}) c
            WHERE id NOT IN (SELECT l_orderkey FROM lineitem)
              AND CASE WHEN (SELECT min(l_orderkey) FROM lineitem) > 1 THEN id BETWEEN 1 AND (SELECT min(l_orderkey) - 1 FROM lineitem)
                       ELSE id BETWEEN (SELECT min(l_orderkey) FROM lineitem) AND (SELECT max(l_orderkey) FROM lineitem) END""",
    ),
    "new_items": (new_items, f"SELECT id, image FROM ({in_duckdb(fixtures.CATALOG)}) c WHERE id NOT IN (SELECT l_orderkey FROM lineitem)"),
    "upsert_latest": (upsert_latest, _UPSERT_SQL),
    "apply_delta": (apply_delta, _UPSERT_SQL),
    "decode_items": (
        decode_items,
        items_sql("""SELECT i.id, coalesce(i.image, '') AS image, coalesce(i.promoted, 0) AS promoted, coalesce(i.width, 0) AS width,
            coalesce(i.source, '') AS source, i.flags, i.user_name, coalesce(i.gift, 0) AS gift, CAST(coalesce(len(p.tags), 0) AS integer) AS n_tags,
            round(coalesce(list_sum(list_transform(p.tags, lambda t: coalesce(t.confidence, 0))), 0), 6) AS conf_sum,
            CASE WHEN i.comments_data IS NULL THEN 0 ELSE 1 END AS n_comments,
            json_extract_string(i.comments_data, '$[0].content') AS first_content,
            CASE WHEN i.comments_data IS NULL THEN NULL ELSE 0 END AS first_up
            FROM items i LEFT JOIN parsed p ON i.id = p.id"""),
    ),
    "item_lookup": (item_lookup, items_sql(f"SELECT id, image, up, flags FROM items WHERE id = {LOOKUP_ID}")),
    "page_items": (page_items, items_sql(f"SELECT id, image FROM items WHERE id > {PAGE_AFTER} ORDER BY id LIMIT {PAGE_SIZE}")),
    "page_by_offset": (page_by_offset, items_sql(f"SELECT id, image FROM items ORDER BY id LIMIT {PAGE_SIZE} OFFSET {PAGE_SIZE}")),
    "items_min_tags": (
        items_min_tags,
        items_sql("""SELECT id, image, len(tags) AS n_tags FROM parsed
                     WHERE len(tags) >= 8 AND (image ILIKE '%.jpg' OR image ILIKE '%.jpeg' OR image ILIKE '%.png')"""),
    ),
    "newest_page": (newest_page, CATALOG_CTE + "SELECT id, image FROM catalog WHERE id < 1200 ORDER BY id DESC LIMIT 120"),
    "sample_paths": (
        sample_paths,
        CATALOG_CTE + """SELECT id, image FROM catalog WHERE (flags & 1) <> 0 AND (image LIKE '%.jpg' OR image LIKE '%.png' OR image LIKE '%.gif')
                         ORDER BY id DESC LIMIT 100""",
    ),
    "flag_mask_filter": (flag_mask_filter, CATALOG_CTE + "SELECT id, flags FROM catalog WHERE (flags & 6) <> 0"),
    "flag_decode": (
        flag_decode,
        CATALOG_CTE + """SELECT id, CASE flags WHEN 1 THEN 'SFW' WHEN 2 THEN 'NSFW' WHEN 4 THEN 'NSFL' ELSE 'NSFP' END AS names,
                         CASE flags WHEN 1 THEN 'SFW+NSFW' WHEN 2 THEN 'NSFW' WHEN 4 THEN 'NSFW+NSFL' ELSE 'NSFW+NSFP' END AS names_with_2 FROM catalog""",
    ),
    "has_enough": (has_enough, "SELECT CAST(1000 AS bigint) AS needed, count(*) >= 1000 AS enough FROM orders"),
    "catalog_profile": (
        catalog_profile,
        items_sql("""SELECT 'items' AS section, 'item_count' AS name, count(*) AS value FROM items UNION ALL
                     SELECT 'items', 'min_id', min(id) FROM items UNION ALL SELECT 'items', 'max_id', max(id) FROM items UNION ALL
                     SELECT * FROM (SELECT 'top_tag', t.tag, count(*) AS n FROM (SELECT unnest(tags) AS t FROM parsed) u
                                    GROUP BY t.tag ORDER BY n DESC, t.tag LIMIT 10) top"""),
    ),
    "catalog_media": (catalog_media, CATALOG_CTE + "SELECT id, image FROM media"),
    "catalog_media_videos": (
        catalog_media_videos,
        CATALOG_CTE + "SELECT id, image FROM catalog WHERE regexp_matches(lower(image), '\\.(jpg|jpeg|png|gif|mp4|webm)$')",
    ),
    "ext_counts": (
        ext_counts,
        CATALOG_CTE + "SELECT lower(regexp_extract(image, '(\\.[^.]+)$', 1)) AS ext, count(*) AS n FROM catalog WHERE image IS NOT NULL GROUP BY 1",
    ),
    "split_paths": (
        split_paths,
        CATALOG_CTE + """SELECT image, regexp_replace(image, '/[^/]*$', '') AS dir, regexp_extract(image, '[^/]*$') AS name
                         FROM catalog WHERE image IS NOT NULL""",
    ),
    "missing_media": (missing_media, CATALOG_CTE + "SELECT id, image FROM media WHERE image NOT IN (SELECT image FROM listing)"),
    "missing_media_distinct": (
        missing_media_distinct,
        CATALOG_CTE + "SELECT image FROM media EXCEPT SELECT image FROM listing",
    ),
    "missing_by_dir": (
        missing_by_dir,
        CATALOG_CTE + """SELECT dir, count(*) AS n_files, count(*) FILTER (image NOT IN (SELECT image FROM listing)) AS n_missing,
               dir IN (SELECT regexp_replace(image, '/[^/]*$', '') FROM listing) AS dir_exists
               FROM (SELECT DISTINCT image, regexp_replace(image, '/[^/]*$', '') AS dir FROM media) d GROUP BY dir""",
    ),
    "media_presence": (media_presence, CATALOG_CTE + "SELECT id, image, image IN (SELECT image FROM listing) AS present FROM media"),
    "media_summary": (
        media_summary,
        CATALOG_CTE + """SELECT count(*) AS total_in_db, (SELECT count(DISTINCT image) FROM listing) AS total_on_disk,
               count(*) FILTER (image NOT IN (SELECT image FROM listing)) AS to_download,
               count(*) FILTER (image IN (SELECT image FROM listing)) AS skipped,
               count(*) FILTER (image NOT IN (SELECT image FROM listing)) / 10.0::double AS files_per_second FROM media""",
    ),
    "verify_sizes": (
        verify_sizes,
        CATALOG_CTE + """SELECT m.id, m.image, CASE WHEN l.image IS NULL THEN true WHEN c.remote_size IS NULL THEN false
               ELSE l.local_size <> c.remote_size END AS needs_download
               FROM media m JOIN catalog c ON m.id = c.id LEFT JOIN listing l ON m.image = l.image""",
    ),
    "human_bytes": (
        human_bytes,
        CATALOG_CTE
        + "SELECT id, "
        + ", ".join(
            f"""CASE WHEN {x} < 1024 THEN printf('%.1f B', {x}::double) WHEN {x} < 1048576 THEN printf('%.1f KB', {x} / 1024.0::double)
                WHEN {x} < 1073741824 THEN printf('%.1f MB', {x} / 1048576.0::double) WHEN {x} < 1099511627776 THEN printf('%.1f GB', {x} / 1073741824.0::double)
                ELSE printf('%.1f TB', {x} / 1099511627776.0::double) END AS {name}"""
            for x, name in (("local_size", "size_text"), ("(local_size * local_size)", "large_text"))
        )
        + " FROM catalog",
    ),
    "human_duration": (
        human_duration,
        CATALOG_CTE
        + """SELECT id, CASE WHEN s < 60 THEN printf('%.1fs', s) WHEN s / 60 < 60 THEN printf('%.1fm', s / 60) ELSE printf('%.1fh', s / 60 / 60) END AS duration_text
             FROM (SELECT id, floor(local_size / 37)::double AS s FROM catalog) c""",
    ),
    "run_summary": (
        run_summary,
        CATALOG_CTE
        + """, f AS (SELECT count(*) FILTER (id NOT IN (SELECT l_orderkey FROM lineitem)) AS p, count(*) FILTER (id IN (SELECT l_orderkey FROM lineitem)) AS s FROM catalog),
        d AS (SELECT count(*) AS n, CAST(sum(c.local_size) AS bigint) AS b FROM media m JOIN catalog c ON m.id = c.id WHERE m.image NOT IN (SELECT image FROM listing)),
        z AS (SELECT CAST(0 AS bigint) AS z)
        SELECT 'fetch' AS stage, p AS items_processed, s AS items_skipped, z AS items_failed, z AS files_downloaded, z AS files_skipped, z AS bytes_downloaded, p + s AS total_items FROM f, z
        UNION ALL SELECT 'download', z, z, z, n, z, b, z FROM d, z
        UNION ALL SELECT 'total', p, s, z, n, z, b, p + s FROM f, d, z""",
    ),
    "attach_details": (
        attach_details,
        CATALOG_CTE + """SELECT c.id, c.image, m.turn AS comment_id, CASE WHEN m.turn = 0 THEN 0 ELSE m.turn - 1 END AS parent, m.role AS name,
               CAST(length(m.text) AS integer) AS n_chars FROM catalog c JOIN conversations m ON c.id = m.conv_id""",
    ),
    "failed_details": (failed_details, CATALOG_CTE + "SELECT id, image FROM catalog WHERE id NOT IN (SELECT conv_id FROM conversations)"),
}
