"""Streaming jobs run to completion over data landed from the given tables, and landed-file sources."""

from __future__ import annotations

from pyspark.sql import functions as F

from tagmill.functions.text import file_name, parent_dir
from tagmill.operators import tags as tag_ops
from tagmill.plans import fixtures
from tagmill.plans.fixtures import derive, in_duckdb, table
from tagmill.plans.registry import request_queries as rq
from tagmill.plans.registry.catalog_queries import CATALOG_CTE
from tagmill.plans.registry.tag_queries import items_sql
from tagmill.schemas import COMMENTS, DETAIL
from tagmill.session import scratch_path
from tagmill.sources import items as item_source
from tagmill.sources.listing import list_tree
from tagmill.streaming import ingest, requests, sinks
from tagmill.streaming import tags as stream_tags

PAGE_ITEMS = 120
DELAY_US = 600_000_000


def _utc(spark):
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def _land_pages(items, path):
    """Write items as listing documents of up to PAGE_ITEMS ids each (ids are unique, so a page is small)."""
    # to_json leaves out null fields, as the wire format does.
    pages = items.groupBy(F.floor(F.col("id") / PAGE_ITEMS).alias("page")).agg(F.sort_array(F.collect_list(F.struct(*items.columns)), False).alias("items"))
    doc = F.struct("items", F.lit(False).alias("atEnd"), (F.col("page") == 0).alias("atStart"))
    pages.select(F.to_json(doc).alias("value")).write.mode("append").text(path)


def ingest_pages(spark, sf_dir):
    """Landed listing documents joined with landed details: items with the number of their comments."""
    pages, details = scratch_path(spark, "pages"), scratch_path(spark, "details")
    _land_pages(derive(spark, sf_dir, fixtures.CATALOG).select("id", "image", "flags"), pages)
    comments = derive(spark, sf_dir, fixtures.COMMENTS)
    # One detail document per comment keeps a much-discussed item from being gathered.
    doc = F.struct("item_id", F.array(F.struct("id", "parent", "content", "name")).alias("comments"))
    comments.select(F.to_json(doc).alias("value")).write.text(details)
    landed = item_source.read_details(spark, details)
    counts = landed.groupBy("item_id").agg(F.sum(F.size("comments")).alias("n_comments"), F.sum(F.length(F.get("comments", F.lit(0))["content"])).alias("n_chars"))
    joined = item_source.read_pages(spark, pages).join(counts.withColumnRenamed("item_id", "id"), "id", "left")
    return joined.select("id", "image", "flags", F.coalesce("n_comments", F.lit(0)).alias("n_comments"), F.coalesce("n_chars", F.lit(0)).alias("n_chars"))


def media_listing(spark, sf_dir):
    """Directories and files found below a root that holds one file of paths per year and month."""
    root = scratch_path(spark, "media")
    dated = table(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("y"), F.month("o_orderdate").alias("m"), "o_orderkey")
    # Salted, so that a busy month is written by several tasks.
    dated.repartition("y", "m", F.col("o_orderkey") % 4).write.partitionBy("y", "m").csv(root)
    found = list_tree(spark, root).where(F.col("path").endswith(".csv") & ~file_name(F.col("path")).startswith("."))
    return found.groupBy(parent_dir(F.col("path")).alias("dir")).agg((F.sum("length") > 0).alias("has_data"))


def stream_upsert(spark, sf_dir):
    """Base pages, then two waves of newer pages, ingested in micro-batches; the store's latest versions."""
    _utc(spark)
    pages, store, state = scratch_path(spark, "pages"), scratch_path(spark, "store"), scratch_path(spark, "state")
    versions = derive(spark, sf_dir, fixtures.VERSIONS).withColumn("up", F.floor("up"))
    for wave in ("seq = 0", "seq = 1", "seq >= 2"):
        _land_pages(versions.where(wave).select("id", "up"), pages)
    ingest.ingest(spark, pages, store, state, files_per_trigger=8).awaitTermination()
    return ingest.read_store(spark, store).select("id", "up")


def stream_new_items(spark, sf_dir):
    """Pages landed twice: ids are reported once, and held ids not at all."""
    _utc(spark)
    pages, out, state = scratch_path(spark, "pages"), scratch_path(spark, "new"), scratch_path(spark, "state")
    catalog = derive(spark, sf_dir, fixtures.CATALOG).select("id", "image")
    _land_pages(catalog, pages)
    _land_pages(catalog.where("image IS NOT NULL"), pages)
    fresh = ingest.new_item_stream(ingest.page_stream(spark, pages, 8), derive(spark, sf_dir, fixtures.HELD_IDS)).select("id", "image")
    sinks.write_epochs(fresh, out, state).awaitTermination()
    return sinks.read_epochs(spark, out, "id long, image string, epoch long").select("id", "image")


def _log_stream(spark, sf_dir):
    """The event table as a stream of request rows."""
    schema = table(spark, sf_dir, "events").schema
    events = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    view = f"events_stream_{abs(hash(sf_dir))}"
    events.createOrReplaceTempView(view)
    return requests.with_event_time(spark.sql(fixtures.REQUESTS.replace("{events}", view)))


def stream_rate_tumbling(spark, sf_dir):
    _utc(spark)
    out, state = scratch_path(spark, "rates"), scratch_path(spark, "state")
    rates = requests.tumbling_rates(_log_stream(spark, sf_dir), rq.WIDTH)
    sinks.write_epochs(rates, out, state, "update").awaitTermination()
    schema = "test_name string, start_us long, end_us long, requests long, limited long, epoch long"
    return sinks.latest_by_key(sinks.read_epochs(spark, out, schema), ["test_name", "start_us"])


def stream_rate_sliding(spark, sf_dir):
    _utc(spark)
    out, state = scratch_path(spark, "busy"), scratch_path(spark, "state")
    busy = requests.busy_windows(_log_stream(spark, sf_dir), rq.WIDTH, rq.SLIDE, rq.BUSY)
    sinks.write_epochs(busy, out, state, "update").awaitTermination()
    return sinks.latest_by_key(sinks.read_epochs(spark, out, "start_us long, end_us long, requests long, epoch long"), ["start_us"])


def stream_cooldown_sessions(spark, sf_dir):
    """Sessions the watermark has closed by the end of the data."""
    _utc(spark)
    out, state = scratch_path(spark, "sessions"), scratch_path(spark, "state")
    sessions = requests.cooldown_sessions(_log_stream(spark, sf_dir), rq.GAP_SECONDS)
    sinks.write_epochs(sessions, out, state).awaitTermination()
    return sinks.read_epochs(spark, out, "test_name string, start_us long, last_us long, errors long, epoch long").drop("epoch")


def stream_tag_counts(spark, sf_dir):
    """Running counts per tag after all landed details."""
    landed, out, state = scratch_path(spark, "details"), scratch_path(spark, "counts"), scratch_path(spark, "state")
    items = fixtures.stored_items(spark, sf_dir).select("id", "tags_data").where("tags_data IS NOT NULL")
    details = tag_ops.parse_tags(items).select(F.col("id").alias("item_id"), "tags", F.lit(None).cast(COMMENTS).alias("comments"))
    details.select(F.to_json(F.struct(*DETAIL.fieldNames())).alias("value")).write.text(landed)
    counts = stream_tags.running_tag_counts(stream_tags.detail_stream(spark, landed, 2))
    sinks.write_epochs(counts, out, state, "update").awaitTermination()
    rows = sinks.latest_by_key(sinks.read_epochs(spark, out, "tag string, frequency long, conf_sum double, epoch long"), ["tag"])
    return rows.withColumn("conf_sum", F.round("conf_sum", 4))


QUERIES = {
    "media_listing": (
        media_listing,
        """SELECT DISTINCT 'y=' || CAST(year(o_orderdate) AS varchar) || '/m=' || CAST(month(o_orderdate) AS varchar) AS dir, true AS has_data FROM orders""",
    ),
    "ingest_pages": (
        ingest_pages,
        CATALOG_CTE
        + """SELECT c.id, c.image, c.flags, count(m.conv_id) AS n_comments, CAST(coalesce(sum(length(m.text)), 0) AS bigint) AS n_chars
             FROM catalog c LEFT JOIN conversations m ON c.id = m.conv_id GROUP BY c.id, c.image, c.flags""",
    ),
    "stream_upsert": (
        stream_upsert,
        f"""SELECT id, CAST(floor(up) AS bigint) AS up FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY seq DESC) AS rn
            FROM ({in_duckdb(fixtures.VERSIONS)}) v) w WHERE rn = 1""",
    ),
    "stream_new_items": (stream_new_items, CATALOG_CTE + "SELECT id, image FROM catalog WHERE id NOT IN (SELECT l_orderkey FROM lineitem)"),
    "stream_rate_tumbling": (stream_rate_tumbling, rq.QUERIES["rate_tumbling"][1]),
    "stream_rate_sliding": (stream_rate_sliding, rq.QUERIES["rate_sliding"][1]),
    "stream_cooldown_sessions": (
        stream_cooldown_sessions,
        rq.SESSIONS_SQL
        + f"SELECT * FROM sessions WHERE last_us + {rq.GAP_SECONDS * 1_000_000} <= (SELECT max(us) // 1000 * 1000 FROM log) - {DELAY_US}",
    ),
    "stream_tag_counts": (
        stream_tag_counts,
        items_sql("""SELECT trim(lower(t.tag), E' \\t\\n\\r\\f\\v') AS tag, count(*) AS frequency, round(sum(coalesce(t.confidence, 0)), 4) AS conf_sum
                     FROM (SELECT unnest(tags) AS t FROM parsed) p GROUP BY 1"""),
    ),
}
