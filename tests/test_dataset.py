"""Images, sinks, export and the whole chain."""

import json
import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tagmill.operators import export, images
from tagmill.plans import workflow
from tagmill.sources import sinks, tables
from tests.conftest import png


@pytest.fixture(scope="module")
def media(tmp_path_factory):
    root = tmp_path_factory.mktemp("media")
    rng = random.Random(2)
    for i in range(40):
        folder = root / f"d{i % 3}"
        folder.mkdir(exist_ok=True)
        pixels = [[(rng.randrange(256), rng.randrange(256), rng.randrange(256)) for _ in range(9 + i % 2)] for _ in range(8)]
        (folder / f"{i}.png").write_bytes(png(pixels))
    (root / "flat.png").write_bytes(png([[(10, 20, 30)] * 8] * 8))
    (root / "empty.jpg").write_bytes(b"")
    (root / "tiny.jpg").write_bytes(b"x" * 50)
    (root / "junk.jpg").write_bytes(b"junk" * 40)
    (root / "note.txt").write_text("no image")
    (root / "clip.mp4").write_bytes(b"v" * 200)
    return str(root)


def test_listing(spark, media):
    listed = {r.image: r.length for r in tables.list_media(spark, media).collect()}
    assert len(listed) == 44 and listed["empty.jpg"] == 0 and "d1/1.png" in listed
    assert "clip.mp4" in {r.image for r in tables.list_media(spark, media, include_videos=True).collect()}


def test_embedding_reports_every_failure(spark, media):
    names = ["flat.png", "empty.jpg", "tiny.jpg", "junk.jpg", "gone.png", "d0/0.png", "d0/0.png"]
    wanted = spark.createDataFrame(list(enumerate(names)), "id long, image string")
    out = images.embed(wanted, tables.list_media(spark, media), images.read_images(spark, media), (6, 4)).collect()
    errors = {r.id: r.error for r in out}
    assert errors == {0: None, 1: "file_empty", 2: "file_too_small", 3: "image_load_failed", 4: "file_not_found", 5: None, 6: None}
    flat = np.frombuffer(next(r.image_data for r in out if r.id == 0), dtype=np.float32).reshape(4, 6, 3)
    means = np.array([103.939, 116.779, 123.68], dtype=np.float32)
    assert np.allclose(flat, np.array([30, 20, 10], dtype=np.float32) - means)


def test_resampling():
    for source, target in ((9, 9), (9, 4), (4, 9), (100, 7)):
        w = images.axis_weights(source, target)
        assert w.shape == (target, source) and np.allclose(w.sum(axis=1), 1)
    assert np.allclose(images.axis_weights(5, 5), np.eye(5))
    block = np.random.default_rng(0).integers(0, 256, (8, 10, 3)).astype(float)
    assert (images.resize(block, 8, 10) == block).all()
    shrunk = images.resize(block, 3, 4)
    assert shrunk.shape == (3, 4, 3) and shrunk.min() >= 0 and shrunk.max() <= 255


def test_contract_is_checked_before_any_job(spark):
    with pytest.raises(tables.DatasetContractError, match="image_data is missing"):
        tables.check_dataset(spark.range(1).select("id", F.lit("a").alias("image")))


def test_no_safe_rows_is_an_error(spark):
    df = spark.createDataFrame([(1, True, False, False)], "id long, is_nsfw boolean, is_nsfl boolean, is_nsfp boolean")
    with pytest.raises(ValueError):
        export.safe_only(df, require_rows=True)


def test_split_does_not_depend_on_partitioning(spark):
    df = spark.range(5000)
    one = {r.id: r.split for r in export.with_split(df.coalesce(1), 0.2).collect()}
    many = {r.id: r.split for r in export.with_split(df.repartition(7), 0.2).collect()}
    assert one == many and 800 < sum(s == "test" for s in one.values()) < 1200


def test_runs_and_snapshots(spark, tmp_path):
    root = str(tmp_path / "runs")
    schema = "id long, up long, updated_at long, seq long"
    sinks.write_run(spark.createDataFrame([(1, 1, 1, 0), (2, 2, 1, 0)], schema), root, 100)
    sinks.upsert_run(spark, root, spark.createDataFrame([(2, 5, 2, 0), (3, 6, 2, 0)], schema), 200)
    assert {r.id: r.up for r in tables.read_latest_run(spark, root).collect()} == {1: 1, 2: 5, 3: 6}
    assert spark.read.parquet(root).where("run_ts = 100").count() == 2


@pytest.fixture(scope="module")
def chain(spark, media, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("out"))
    rng = random.Random(4)
    rows = []
    for i in range(40):
        tags = [{"id": 1, "tag": t, "confidence": rng.random()} for t in rng.sample([f"t{j}" for j in range(9)], 6)]
        if i % 8 == 0:
            tags.append({"id": 2, "tag": "NSFW", "confidence": 0.9})
        rows.append((i, f"d{i % 3}/{i}.png", json.dumps(tags)))
    rows.append((40, "gone.png", rows[0][2]))
    items = spark.createDataFrame(rows, "id long, image string, tags_data string")
    return workflow.run_all(items, media, out, "tags", min_tags=3, size=(8, 6), max_samples=20), out


def test_chain_writes_dataset_metadata_and_export(spark, chain):
    prepared, out = chain
    dataset = tables.read_dataset(spark, f"{out}/dataset")
    assert dataset.count() == 40
    assert {len(r.tags) for r in dataset.collect()} == {3}
    assert {len(r.image_data) for r in dataset.collect()} == {8 * 6 * 3 * 4}
    meta = spark.read.json(f"{out}/metadata").first()
    assert (meta.total_items, meta.items_failed_images, meta.min_tags, meta.width, meta.height) == (40, 1, 3, 8, 6)
    assert [(e.reason, e.n) for e in meta.image_errors] == [("file_not_found", 1)]
    assert tables.image_size(spark, f"{out}/metadata") == (8, 6) and tables.image_size(spark, None) == (224, 224)
    public = spark.read.parquet(f"{out}/export/data")
    assert public.count() == 20 and set(public.columns) == {"id", "image", "tags", "confidences", "image_bytes_b64", "split"}
    unsafe = {r.id for r in dataset.where("is_nsfw").collect()}
    assert unsafe and not unsafe & {r.id for r in public.collect()}
    card = "\n".join(r.value for r in spark.read.text(f"{out}/export/card").collect())
    assert card.startswith("# tags") and "samples: 20" in card
    assert os.path.isdir(f"{out}/export/manifest")


def test_chain_trains_and_evaluates(spark, chain):
    prepared, out = chain
    dataset = tables.read_dataset(spark, f"{out}/dataset")
    features = dataset.select(F.col("id").alias("sample_id"), F.array((F.col("id") % 3).cast("double"), F.size("tags").cast("double")).alias("features"))
    train = export.with_split(dataset, 0.3).where("split = 'train'")
    n_tags = train.select(F.explode("tags").alias("t")).distinct().count()
    done = workflow.train_and_evaluate(dataset, features, test_share=0.3, k=2)
    assert done.vocabulary.count() == done.weights.count() == n_tags
    row = done.metrics.first()
    assert all(0 <= v <= 1 for v in row)
    n_test = export.with_split(dataset, 0.3).where("split = 'test'").count()
    assert done.predictions.count() == n_test
    sinks.write_predictions(done.predictions, f"{out}/predictions")
    assert spark.read.json(f"{out}/predictions").count() == n_test


def test_card_of_a_capped_export_counts_what_was_left_out(spark, tmp_path):
    from tagmill.sources.sinks import export_dataset

    rows = [(i, f"{i}.jpg", ["a"], [0.5], i == 0, False, False) for i in range(5)]
    dataset = spark.createDataFrame(rows, "id long, image string, tags array<string>, confidences array<double>, is_nsfw boolean, is_nsfl boolean, is_nsfp boolean")
    card = export_dataset(dataset, str(tmp_path / "out"), "x", max_samples=2).first()
    assert (card.total_items, card.excluded_items, card.safe_percent, card.safe_items) == (5, 1, 80.0, 2)
