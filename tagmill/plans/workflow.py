"""The whole chain: curated dataset with tensors, export, fitted model, predictions, metrics."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagmill.operators import curate, evaluate, export, images, labels, model, requests, tags
from tagmill.plans import prepare
from tagmill.session import cut
from tagmill.sources import sinks
from tagmill.sources.tables import list_media


@dataclass(frozen=True)
class Prepared:
    dataset: DataFrame
    metadata: DataFrame
    errors: DataFrame


def prepare_dataset(items: DataFrame, media_root: str, min_tags: int = 5, size: tuple[int, int] = (224, 224), limit: int | None = None) -> Prepared:
    """Curate, then embed the images of what is left. Fails if no image at all could be embedded."""
    spark = items.sparkSession
    found = prepare.analyze(items, min_tags, limit=limit)
    curated = cut(curate.curate_items(found.items, found.classified, found.limits, min_tags))
    embedded = cut(images.embed(curated, list_media(spark, media_root), images.read_images(spark, media_root), size))
    dataset = images.successful(embedded)
    if dataset.isEmpty():
        raise ValueError("no valid images")
    failed = embedded.where(F.col("error").isNotNull())
    errors = requests.error_histogram(failed, embedded.agg(F.count("*")).scalar())
    kept = dataset.agg(F.count("*")).scalar()
    # The run reports embedded items; what failed is told apart from what was skipped.
    row = prepare.metadata(found, curated, min_tags).withColumn("items_failed_images", F.col("total_items") - kept).withColumn("total_items", kept)
    return Prepared(dataset.drop("trash_used"), sinks.describe_run(row, size, errors, tags.trash_sample(found.classified)), errors)


@dataclass(frozen=True)
class Evaluated:
    vocabulary: DataFrame
    weights: DataFrame
    predictions: DataFrame
    metrics: DataFrame


def train_and_evaluate(dataset: DataFrame, features: DataFrame, classes: int | None = None, test_share: float = 0.2, k: int = 5) -> Evaluated:
    """Split by id, fit all tags of the training part, score the test part, measure it on the model's vocabulary.

    ``features``: ``sample_id, features`` for every dataset id. ``classes`` asks for a smaller model of the most frequent
    tags only. All classes are fitted in one job per iteration.
    """
    if dataset.select("id").limit(2).count() < 2:
        raise ValueError("too few items to split")
    split = export.with_split(dataset, test_share)
    train, test = split.where("split = 'train'"), split.where("split = 'test'")
    known = labels.long_tags(train).select("tag")
    if classes is not None:
        known = known.groupBy("tag").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "tag").limit(classes).select("tag")
    vocab = cut(labels.vocabulary(known))

    def encoded(part: DataFrame) -> DataFrame:
        return labels.encode_labels(labels.long_tags(part), vocab).withColumnRenamed("id", "sample_id")

    ids = lambda part: part.select(F.col("id").alias("sample_id"))
    weights = model.fit(features.join(ids(train), "sample_id"), encoded(train), vocab.select(F.col("idx").alias("class_idx")))
    scored = cut(model.predict_top_k(features.join(ids(test), "sample_id"), weights, vocab.count()))
    cells = scored.select("sample_id", F.explode("top").alias("t")).select("sample_id", "t.class_idx", "t.score")
    names = model.name_predictions(scored.withColumn("top", F.slice("top", 1, k)), vocab)
    records = model.prediction_records(names, test.select(F.col("id").alias("sample_id"), "image"), k)
    return Evaluated(vocab, weights, records, evaluate.metrics(cells, encoded(test), k))


def run_all(items: DataFrame, media_root: str, out: str, name: str, *, min_tags: int = 5, size: tuple[int, int] = (224, 224), skip_export: bool = False, max_samples: int | None = None) -> Prepared:
    """Prepare, write the dataset and its metadata, and export the safe part unless skipped."""
    prepared = prepare_dataset(items, media_root, min_tags, size)
    sinks.write_dataset(prepared.dataset, f"{out}/dataset")
    sinks.write_metadata(prepared.metadata, f"{out}/metadata")
    if not skip_export:
        sinks.export_dataset(prepared.dataset, f"{out}/export", name, max_samples)
    return prepared
