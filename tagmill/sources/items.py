"""Reading and paging the item store, landed pages and details."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagmill.functions.text import is_image
from tagmill.operators.once import compute_once
from tagmill.schemas import COMMENTS, DETAIL, ITEM, PAGE, STORED_ITEM, TAGS


def read_store(spark: SparkSession, path: str) -> DataFrame:
    """Stored items (JSON text columns) from Parquet."""
    return spark.read.schema(STORED_ITEM).parquet(path)


def read_jdbc(spark: SparkSession, url: str, table: str, lower: int, upper: int, partitions: int, **options: str) -> DataFrame:
    """Stored items from a database, read in parallel id ranges (needs the driver jar on the class path)."""
    return (
        spark.read.format("jdbc")
        .options(url=url, dbtable=table, partitionColumn="id", lowerBound=lower, upperBound=upper, numPartitions=partitions, **options)
        .load()
    )


def scan_tagged(items: DataFrame) -> DataFrame:
    """The minimal scan: three columns of the rows that have tags."""
    return items.where(F.col("tags_data").isNotNull()).select("id", "image", "tags_data")


def local_ids(items: DataFrame) -> DataFrame:
    return items.select("id").distinct()


def _default(field: T.StructField, value: Column) -> Column:
    if isinstance(field.dataType, T.StringType):
        return F.coalesce(value, F.lit(""))
    return F.coalesce(value, F.lit(0)).cast(field.dataType)


def _with_element_defaults(items: Column, schema: T.ArrayType) -> Column:
    """Fill missing element fields with 0 or an empty text."""
    fields = schema.elementType.fields
    return F.transform(
        items,
        lambda e: F.struct(
            *[
                (F.coalesce(e[f.name], F.lit(0.0)) if isinstance(f.dataType, T.DoubleType) else _default(f, e[f.name])).alias(f.name)
                for f in fields
            ]
        ),
    )


def decode_items(stored: DataFrame) -> DataFrame:
    """JSON text to arrays, nulls to typed defaults; the result has the ``ITEM`` schema."""

    def decoded(name: str, schema: T.ArrayType) -> Column:
        text = F.when(F.col(name) != "", F.col(name))
        return _with_element_defaults(F.coalesce(F.from_json(text, schema), F.array().cast(schema)), schema)

    stored = compute_once(stored, tags=decoded("tags_data", TAGS), comments=decoded("comments_data", COMMENTS))
    nested = {"tags": F.col("tags"), "comments": F.col("comments")}
    columns = []
    for field in ITEM.fields:
        if field.name in nested:
            columns.append(nested[field.name].alias(field.name))
        elif field.name in ("id", "updated_at"):
            columns.append(F.col(field.name))
        else:
            columns.append(_default(field, F.col(field.name)).alias(field.name))
    return stored.select(*columns)


def encode_items(items: DataFrame) -> DataFrame:
    """Arrays back to JSON text: the stored form."""
    return items.withColumns({"tags_data": F.to_json("tags"), "comments_data": F.to_json("comments")}).select(
        *[f.name for f in STORED_ITEM.fields if f.name in items.columns or f.name.endswith("_data")]
    )


def item_lookup(items: DataFrame, item_id: int) -> DataFrame:
    """One item; row groups are skipped by their id statistics when the store is clustered by id."""
    return items.where(F.col("id") == item_id)


def page_items(items: DataFrame, after: int | None = None, limit: int = 1000) -> DataFrame:
    """The next page in id order by key; unlike an offset it costs the same on every page."""
    rest = items if after is None else items.where(F.col("id") > after)
    return rest.orderBy("id").limit(limit)


def page_items_by_offset(items: DataFrame, page: int, size: int = 1000) -> DataFrame:
    return items.orderBy("id").offset(page * size).limit(size)


def items_min_tags(items: DataFrame, min_tags: int = 5, image_only: bool = True) -> DataFrame:
    """Items with at least ``min_tags`` raw tags, optionally still images only. Takes ``tags``; callers order by id."""
    enough = items.where(F.size("tags") >= min_tags)
    return enough.where(is_image(F.col("image"))) if image_only else enough


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Items of landed listing documents (one JSON document per line)."""
    return page_rows(spark.read.schema(PAGE).json(path))


def page_rows(pages: DataFrame) -> DataFrame:
    items = pages.select(F.explode("items").alias("i"), "atEnd", "atStart").select("i.*", "atEnd", "atStart")
    return items.withColumnRenamed("user", "user_name")


def read_details(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(DETAIL).json(path)


def ingest_pages(pages: DataFrame, details: DataFrame) -> DataFrame:
    """Page items with tags and comments where a detail document has landed (empty lists otherwise)."""
    joined = pages.join(details.withColumnRenamed("item_id", "id"), "id", "left")
    return joined.withColumns(
        {"tags": F.coalesce("tags", F.array().cast(TAGS)), "comments": F.coalesce("comments", F.array().cast(COMMENTS))}
    )
