"""Time the headline queries (the better of two runs each); prints one JSON line.

BENCH_SF_DIR  tables to read (default /root/testdata/sf0.1)
BENCH_CPUS    local cores (default 8)
BENCH_IDS     size of the generated id range for the reconciliation rows (default 6000000, 0 to skip)
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from tagmill.operators import catalog, media  # noqa: E402
from tagmill.plans.registry import all_queries  # noqa: E402
from tagmill.session import build_session  # noqa: E402

HEADLINE = [
    "tag_stats",
    "confidence_percentiles",
    "thresholds",
    "trash_tags",
    "curate_items",
    "dataset_metadata",
    "gap_analysis",
    "gap_ranges",
    "upsert_latest",
    "decode_items",
    "missing_media",
    "missing_by_dir",
    "media_summary",
    "verify_sizes",
    "export_safe",
    "dataset_card_stats",
    "tag_vocab",
    "encode_labels",
    "eval_all",
    "predict_topk",
    "request_summary",
    "sustained_progress",
    "retry_streaks",
    "cooldown_sessions",
    "regex_pairs",
    "page_links",
]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(action, runs: int = 2) -> float:
    best = float("inf")
    for _ in range(runs):
        start = time.perf_counter()
        action()
        best = min(best, time.perf_counter() - start)
    return best


def scale_rows(spark, n: int) -> dict[str, float]:
    """The published operations at their published size: gap analysis, and catalog against listing."""
    held = spark.range(1, n + 1).where(F.xxhash64("id") % 50 != 0)
    path = F.concat(F.lit("2024/"), (F.col("id") % 365).cast("string"), F.lit("/"), F.col("id").cast("string"), F.lit(".jpg"))
    items = spark.range(1, n + 1).select("id", path.alias("image"))
    listing = items.where(F.xxhash64("id") % 20 != 0).select("image")
    return {
        f"gap_analysis_{n}_ids": timed(lambda: run(catalog.gap_analysis(held, n))),
        f"gap_ranges_{n}_ids": timed(lambda: run(catalog.gap_ranges(held))),
        f"reconcile_{n}_paths": timed(lambda: run(media.missing_media(media.catalog_media(items), listing))),
    }


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64KB",
            "spark.log.level": "ERROR",
        },
    )
    registered = all_queries()
    seconds = {name: round(timed(lambda: run(registered[name][0](spark, sf_dir))), 3) for name in HEADLINE}
    n = int(os.environ.get("BENCH_IDS", "6000000"))
    if n:
        seconds.update({k: round(v, 3) for k, v in scale_rows(spark, n).items()})
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/"))}))
    spark.stop()


if __name__ == "__main__":
    main()
