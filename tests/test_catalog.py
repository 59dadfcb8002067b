import random

import pytest
from pyspark.sql import functions as F

from tagmill.functions import flags, text
from tagmill.operators import catalog, media
from tagmill.plans import sync
from tagmill.schemas import ITEM, STORED_ITEM
from tagmill.sources import items as item_source


def ids(spark, values):
    return spark.createDataFrame([(v,) for v in values], "id long")


def test_empty_store_is_all_missing(spark):
    row = catalog.gap_analysis(ids(spark, []), 100).first()
    assert (row.local_min, row.local_max, row.top_gap, row.bottom_gap, row.internal_gaps, row.total_missing, row.is_complete) == (0, 0, 100, 0, 0, 100, False)
    assert tuple(catalog.id_range(ids(spark, [])).first()) == (-1, -1, 0)


def test_gaps_agree_with_sets(spark):
    rng = random.Random(3)
    held = sorted(rng.sample(range(5, 200_000), 3000)) * 2
    row = catalog.gap_analysis(ids(spark, held), 210_000).first()
    missing = set(range(1, 210_001)) - set(held)
    assert row.total_missing == len(missing) and not row.is_complete
    ranges = catalog.gap_ranges(ids(spark, held), bucket=1000).collect()
    low, high = min(held), max(held)
    inside = {m for m in missing if low < m < high}
    assert {i for r in ranges for i in range(r.gap_start, r.gap_end + 1)} == inside
    assert sum(r.gap_length for r in ranges) == row.internal_gaps == len(inside)


def test_complete_store(spark):
    assert catalog.gap_analysis(ids(spark, range(1, 51)), 50).first().is_complete


@pytest.mark.parametrize(
    "held,remote,options,expected",
    [
        ([5, 6, 9], 20, {"full": True}, ("full", 20, 1, 20)),
        ([5, 6, 9], 20, {"start_from": 7}, ("start_from", 7, 1, 7)),
        ([5, 6, 9], 20, {}, ("top", 20, 10, 11)),
        ([5, 6, 9], 9, {}, ("bottom", 4, 1, 4)),
        ([1, 2, 9], 9, {}, ("none", None, None, None)),
        ([1, 2, 9], 9, {"fill_gaps": True}, ("internal", 9, 1, 9)),
    ],
)
def test_fetch_plan_priority(spark, held, remote, options, expected):
    plan = catalog.fetch_plan(catalog.gap_analysis(ids(spark, held), remote), remote, **options)
    assert tuple(plan.first()) == expected


def test_ingest_keeps_new_items_with_details(spark):
    pages = spark.createDataFrame([(i, f"{i}.jpg") for i in range(1, 11)], "id long, image string")
    details = spark.createDataFrame([(i, [(1, 0.5, "x")], None) for i in range(1, 10)], "item_id long, tags array<struct<id:long,confidence:double,tag:string>>, comments array<struct<id:long>>")
    held = ids(spark, [1, 2, 5])
    plan = catalog.fetch_plan(catalog.gap_analysis(held, 10), 10)
    assert {r.id for r in sync.ingest(pages, details, held, plan).collect()} == {6, 7, 8, 9}
    assert {r.id for r in catalog.failed_details(pages, details).collect()} == {10}
    full = catalog.fetch_plan(catalog.gap_analysis(held, 10), 10, full=True)
    assert {r.id for r in sync.ingest(pages, details, held, full, full=True).collect()} == set(range(1, 10))


def test_sizes(spark):
    c = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (4, "d")], "id long, image string")
    local = spark.createDataFrame([("b", 5), ("c", 5), ("d", 5)], "image string, local_size long")
    remote = spark.createDataFrame([("a", 5), ("c", 5), ("d", 6)], "image string, remote_size long")
    got = {r.image: r.needs_download for r in media.verify_sizes(c, local, remote).collect()}
    assert got == {"a": True, "b": False, "c": False, "d": True}


def test_missing_and_present_make_up_the_catalog(spark):
    c = spark.createDataFrame([(1, "x/a.jpg"), (2, "x/a.jpg"), (3, "y/b.jpg"), (4, "z.png")], "id long, image string")
    held = spark.createDataFrame([("x/c.jpg",), ("z.png",), ("z.png",)], "image string")
    assert sorted(r.id for r in media.missing_media(c, held).collect()) == [1, 2, 3]
    assert sorted(r.image for r in media.missing_media_distinct(c, held).collect()) == ["x/a.jpg", "y/b.jpg"]
    assert {r.id for r in media.media_presence(c, held).where("present").collect()} == {4}
    assert media.media_presence(c, held).count() == 4
    dirs = {r.dir: (r.n_files, r.n_missing, r.dir_exists) for r in media.missing_by_dir(c, held).collect()}
    assert dirs == {"x": (1, 1, True), "y": (1, 1, False), ".": (1, 0, True)}
    assert media.missing_media(c, held, "/m/").where("id = 3").first().local_path == "/m/y/b.jpg"
    s = media.media_summary(c, held, 2).first()
    assert (s.total_in_db, s.total_on_disk, s.to_download, s.skipped, s.files_per_second) == (4, 2, 3, 1, 1.5)


def test_latest_version_and_delta(spark):
    schema = "id long, up long, updated_at long, seq long"
    base = spark.createDataFrame([(1, 10, 1, 0), (2, 20, 1, 0)], schema)
    delta = spark.createDataFrame([(2, 21, 2, 0), (2, 22, 2, 1), (3, 30, 2, 0)], schema)
    expected = {1: 10, 2: 22, 3: 30}
    assert {r.id: r.up for r in catalog.upsert_latest(base.union(delta)).collect()} == expected
    assert {r.id: r.up for r in catalog.apply_delta(base, delta).collect()} == expected
    plan = catalog.upsert_latest(base)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_decode_and_encode_round_trip(spark):
    rows = [(1, None, None, 3, None, None, None, None, None, None, None, None, None, None, '[{"id": 7, "tag": "x"}]', None, 5)]
    decoded = item_source.decode_items(spark.createDataFrame(rows, STORED_ITEM))
    assert [f.name for f in decoded.schema] == ITEM.fieldNames()
    r = decoded.first()
    assert (r.image, r.promoted, r.up, r.source, r.flags, r.comments) == ("", 0, 3, "", 0, [])
    assert tuple(r.tags[0]) == (7, 0.0, "x")
    again = item_source.decode_items(item_source.encode_items(decoded).select(*STORED_ITEM.fieldNames())).first()
    assert again == r


def test_paging(spark):
    df = ids(spark, range(10))
    assert [r.id for r in item_source.page_items(df, 3, 4).collect()] == [4, 5, 6, 7]
    assert [r.id for r in item_source.page_items_by_offset(df, 2, 4).collect()] == [8, 9]
    assert [r.id for r in catalog.newest_page(df, None, 2).collect()] == [9, 8]
    assert not catalog.has_enough(df, 11).first().enough


def test_scalar_functions(spark):
    one = spark.range(1)
    value = lambda c: one.select(c.alias("v")).first().v
    assert value(text.normalize_tag(F.lit("\t\x1f Ärger　"))) == "ärger"
    for n in (0, 1, 1023, 1024, 1075, 1177, 1536, 10**6, 3 * 2**40, 2**52):
        x, unit = float(n), "B"
        for unit in ("B", "KB", "MB", "GB", "TB", "PB"):
            if x < 1024 or unit == "PB":
                break
            x /= 1024
        assert value(text.human_bytes(F.lit(n))) == f"{x:.1f} {unit}"
    for s in (0.05, 0.15, 0.45, 59.95, 6.55, 63, 117, 3599, 3600, 7020, 123456):
        expected = f"{s:.1f}s" if s < 60 else f"{s / 60:.1f}m" if s / 60 < 60 else f"{s / 60 / 60:.1f}h"
        assert value(text.human_duration(F.lit(float(s)))) == expected
    assert value(flags.flag_names(F.lit(15))) == "SFW+NSFW+NSFL+NSFP"
    assert flags.encode_flags(["sfw", "NSFP"]) == 9
    assert value(text.extension(F.lit("a/b.JPG"))) == ".jpg"
    assert value(text.file_extension(F.lit("a/.jpg"))) == ""
    assert value(text.base64_text(F.lit(b"x" * 200))).count("\n") == 0
    assert value(text.base64_text(F.lit(b""))) is None


def test_url_resolution(spark):
    from urllib.parse import urljoin

    base = "https://a.example.org/b/c/d.html?q=1#top"
    refs = ["x.js", "/x.js", "//cdn.example.org/x.js", "http://o.example/x", "../y.js", "../../y/./z.js?k=../1", "./", "..", "?p=2", "#f", "mailto:a@b", "a/../b.js"]
    df = spark.createDataFrame([(r,) for r in refs], "r string").select("r", text.resolve_url(F.lit(base), F.col("r")).alias("u"))
    assert {r.r: r.u for r in df.collect()} == {r: urljoin(base, r) for r in refs}
    html = '<script src="a.js"></script><script async src=\'b.css\'></script><script src="c.js">'
    got = spark.range(1).select(text.attribute_urls(F.lit(html), F.lit("http://h.example"), "script", "src", ".js").alias("u")).first().u
    assert got == ["http://h.example/a.js", "http://h.example/c.js"]
