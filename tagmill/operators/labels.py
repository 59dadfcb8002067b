"""Tag vocabulary, label encoding and decoding, wide tag columns."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagmill import session
from tagmill.operators.ordered import positions
from tagmill.session import cut, tasks_for

WIDE_TAGS = 5
#: A vocabulary of so many tags is broadcast.
BROADCAST_TAGS = 1 << 16


def long_tags(dataset: DataFrame) -> DataFrame:
    """One row per (item, tag): ``id, tag``."""
    return dataset.select("id", F.explode("tags").alias("tag")).where("tag IS NOT NULL")


def vocabulary(tags: DataFrame) -> DataFrame:
    """``idx, tag``: sorted distinct tags, numbered from 0 without a single-task sort."""
    distinct = tags.select("tag").where("tag IS NOT NULL").distinct()
    return positions(distinct, ["tag"], name="idx").select("idx", "tag")


def frequencies(tags: DataFrame) -> DataFrame:
    """``tag, n``: rows of each tag, as a written table."""
    return cut(tags.where("tag IS NOT NULL").groupBy("tag").agg(F.count("*").alias("n")))


def _join_even(rows: DataFrame, names: DataFrame, key: str, sizes: DataFrame) -> DataFrame:
    """Inner join of ``rows`` and ``names`` by ``key``, in tasks of about TASK_ROWS rows however often a key occurs.

    ``sizes`` has ``key``, once each, and ``n``, how many rows it has about: rows of a frequent key are dealt to several tasks, its names go to each.
    """
    if names.count() <= BROADCAST_TAGS:
        return rows.join(F.broadcast(names), key)
    total = sizes.agg(F.sum("n")).first()[0] or 0
    tasks = tasks_for(rows.sparkSession, total)
    # There are no more frequent keys than total / TASK_ROWS.
    frequent = sizes.where(F.col("n") > session.TASK_ROWS).select(F.col(key).alias("_key"), F.ceil(F.col("n") / session.TASK_ROWS).cast("int").alias("_deals"))
    marked = lambda df: df.join(F.broadcast(frequent), F.col(key) == F.col("_key"), "left").drop("_key")
    deals = F.coalesce("_deals", F.lit(1))
    dealt = marked(rows.where(F.col(key).isNotNull())).withColumn("_deal", F.pmod(F.hash(*rows.columns), deals)).drop("_deals").repartition(tasks, key, "_deal")
    copies = marked(names).withColumn("_deal", F.explode(F.sequence(F.lit(0), deals - 1))).drop("_deals").repartition(tasks, key, "_deal")
    return dealt.join(copies, [key, "_deal"]).drop("_deal")


def encode_labels(tags: DataFrame, vocab: DataFrame, counts: DataFrame | None = None) -> DataFrame:
    """``id, class_idx``; tags outside the vocabulary are dropped, repeats count once.

    ``counts``: the ``frequencies`` of ``tags``, where they are known already; they decide about the size of tasks only.
    """
    counts = frequencies(tags) if counts is None else counts
    found = _join_even(tags, vocab, "tag", counts).select("id", F.col("idx").alias("class_idx"))
    tasks = tasks_for(tags.sparkSession, counts.agg(F.sum("n")).first()[0] or 0)
    return found.repartition(tasks, "id", "class_idx").distinct()


def decode_labels(encoded: DataFrame, vocab: DataFrame, counts: DataFrame | None = None) -> DataFrame:
    """Add ``tag`` for ``class_idx``; unknown indexes are dropped. ``counts``: about how many rows each tag has, if known (see ``encode_labels``)."""
    names = vocab.select(F.col("idx").alias("class_idx"), "tag")
    if counts is None:
        sizes = cut(encoded.groupBy("class_idx").agg(F.count("*").alias("n")))
    else:
        sizes = names.join(counts, "tag").groupBy("class_idx").agg(F.sum("n").alias("n"))
    return _join_even(encoded, names, "class_idx", sizes)


def multi_hot(encoded: DataFrame, num_classes: int) -> DataFrame:
    """``id, label`` with a dense 0/1 vector per item, for estimators that need one; an item holds few classes."""
    sets = encoded.groupBy("id").agg(F.collect_set("class_idx").alias("classes"))
    bits = F.transform(
        F.sequence(F.lit(0), F.lit(num_classes - 1)), lambda i: F.array_contains("classes", i.cast("long")).cast("double")
    )
    return sets.select("id", array_to_vector(bits).alias("label"))


def to_wide(dataset: DataFrame, width: int = WIDE_TAGS) -> DataFrame:
    """``image, tag1..tagN`` for exchange files."""
    return dataset.select("image", *[F.get("tags", F.lit(i)).alias(f"tag{i + 1}") for i in range(width)])


def from_wide(wide: DataFrame) -> DataFrame:
    """``image, slot, tag`` from wide columns; rows without a path and empty cells are dropped."""
    columns = [c for c in wide.columns if c.startswith("tag")]
    long = wide.where("image IS NOT NULL").unpivot("image", columns, "column", "tag")
    return long.where("tag IS NOT NULL").select("image", F.substring("column", 4, 9).cast("int").alias("slot"), "tag")
