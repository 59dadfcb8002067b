"""Explicit schemas; nothing is inferred except where a CSV header is checked."""

from pyspark.sql import types as T

TAG = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("confidence", T.DoubleType()),
        T.StructField("tag", T.StringType()),
    ]
)
TAGS = T.ArrayType(TAG)

# What statistics and curation read of a tag.
NAMED_TAGS = T.ArrayType(T.StructType([f for f in TAG.fields if f.name != "id"]))

COMMENT = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("parent", T.LongType()),
        T.StructField("content", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("mark", T.LongType()),
        T.StructField("created", T.LongType()),
        T.StructField("up", T.LongType()),
        T.StructField("down", T.LongType()),
    ]
)
COMMENTS = T.ArrayType(COMMENT)

_ITEM_SCALARS = [
    T.StructField("id", T.LongType(), False),
    T.StructField("image", T.StringType()),
    T.StructField("promoted", T.LongType()),
    T.StructField("up", T.LongType()),
    T.StructField("down", T.LongType()),
    T.StructField("created", T.LongType()),
    T.StructField("width", T.LongType()),
    T.StructField("height", T.LongType()),
    T.StructField("audio", T.LongType()),
    T.StructField("source", T.StringType()),
    T.StructField("flags", T.IntegerType()),
    T.StructField("user_name", T.StringType()),
    T.StructField("mark", T.LongType()),
    T.StructField("gift", T.LongType()),
]

# The stored form keeps the nested lists as JSON text.
STORED_ITEM = T.StructType(
    _ITEM_SCALARS
    + [
        T.StructField("tags_data", T.StringType()),
        T.StructField("comments_data", T.StringType()),
        T.StructField("updated_at", T.LongType()),
    ]
)

# The decoded form holds them as arrays.
ITEM = T.StructType(
    _ITEM_SCALARS
    + [
        T.StructField("tags", TAGS),
        T.StructField("comments", COMMENTS),
        T.StructField("updated_at", T.LongType()),
    ]
)

# One landed listing document: field `user` is the wire name of `user_name`.
_PAGE_ITEM = T.StructType(
    [T.StructField("user" if f.name == "user_name" else f.name, f.dataType, True) for f in _ITEM_SCALARS]
)
PAGE = T.StructType(
    [
        T.StructField("items", T.ArrayType(_PAGE_ITEM)),
        T.StructField("atEnd", T.BooleanType()),
        T.StructField("atStart", T.BooleanType()),
    ]
)

# One landed detail document, keyed by the item it describes.
DETAIL = T.StructType(
    [
        T.StructField("item_id", T.LongType()),
        T.StructField("tags", TAGS),
        T.StructField("comments", COMMENTS),
    ]
)

DATASET = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("image", T.StringType()),
        T.StructField("is_nsfw", T.BooleanType()),
        T.StructField("is_nsfl", T.BooleanType()),
        T.StructField("is_nsfp", T.BooleanType()),
        T.StructField("tags", T.ArrayType(T.StringType())),
        T.StructField("confidences", T.ArrayType(T.DoubleType())),
        T.StructField("image_data", T.BinaryType()),
    ]
)

REQUEST = T.StructType(
    [
        T.StructField("request_id", T.LongType()),
        T.StructField("ts", T.TimestampType()),
        T.StructField("test_name", T.StringType()),
        T.StructField("status_code", T.IntegerType()),
        T.StructField("latency_ms", T.DoubleType()),
        T.StructField("size_bytes", T.LongType()),
    ]
)

WIDE_TAGS = T.StructType(
    [T.StructField("image", T.StringType())] + [T.StructField(f"tag{i}", T.StringType()) for i in range(1, 6)]
)

VOCABULARY = T.StructType([T.StructField("idx", T.LongType()), T.StructField("tag", T.StringType())])
