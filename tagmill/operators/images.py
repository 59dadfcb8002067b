"""Stored images to normalised tensors, as a map-only job.

Decoding is Spark's own ``image`` source (rows of BGR bytes). What remains per row is a resize and a shift.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Channel means in blue, green, red order; smallest plausible file; resampling support.
CHANNEL_MEANS = (103.939, 116.779, 123.68)
MIN_FILE_BYTES = 100
LANCZOS_SUPPORT = 3.0

TENSOR_BATCH = 64
IMAGE_COLUMNS = "path string, height int, width int, nChannels int, data binary"


def read_images(spark: SparkSession, root: str) -> DataFrame:
    """``path`` (below ``root``) and the decoded pixels; undecodable files keep a row with ``nChannels`` -1."""
    loaded = spark.read.format("image").option("dropInvalid", False).option("recursiveFileLookup", True).load(root)
    return loaded.select(
        relative_path(F.col("image.origin"), root).alias("path"), "image.height", "image.width", "image.nChannels", "image.data"
    )


def relative_path(origin, root: str):
    """Path below ``root``, whatever scheme prefix the listing adds."""
    bare = root.rstrip("/").split("://")[-1].removeprefix("file:")
    return F.regexp_replace(F.regexp_replace(origin, r"^[a-z0-9]+:/*(?=/)", ""), "^" + _quoted("/" + bare.lstrip("/")) + "/", "")


def _quoted(text: str) -> str:
    return r"\Q" + text + r"\E"


def axis_weights(source: int, target: int) -> np.ndarray:
    """Resampling matrix (target x source) of the three-lobe windowed sinc, widened when shrinking."""
    scale = source / target
    stretch = max(scale, 1.0)
    centers = (np.arange(target) + 0.5) * scale
    offsets = (np.arange(source)[None, :] + 0.5 - centers[:, None]) / stretch
    weights = np.where(np.abs(offsets) < LANCZOS_SUPPORT, np.sinc(offsets) * np.sinc(offsets / LANCZOS_SUPPORT), 0.0)
    return weights / weights.sum(axis=1, keepdims=True)


def resize(pixels: np.ndarray, height: int, width: int) -> np.ndarray:
    """Columns first, then rows, rounding to bytes after each step."""
    if pixels.shape[1] != width:
        pixels = np.clip(np.rint(np.einsum("ts,hsc->htc", axis_weights(pixels.shape[1], width), pixels)), 0, 255)
    if pixels.shape[0] != height:
        pixels = np.clip(np.rint(np.einsum("ts,swc->twc", axis_weights(pixels.shape[0], height), pixels)), 0, 255)
    return pixels


def _tensor(height: int, width: int, channels: int, data: bytes, size: tuple[int, int]) -> bytes:
    pixels = np.frombuffer(data, dtype=np.uint8).reshape(height, width, channels).astype(np.float64)
    bgr = np.repeat(pixels, 3, axis=2) if channels == 1 else pixels[:, :, :3]
    shifted = resize(bgr, size[1], size[0]).astype(np.float32) - np.array(CHANNEL_MEANS, dtype=np.float32)
    return np.ascontiguousarray(shifted).tobytes()


def preprocess(images: DataFrame, size: tuple[int, int] = (224, 224)) -> DataFrame:
    """``path, image_data, error``: float32 (height, width, 3) row-major, blue-green-red, mean-shifted.

    ``size`` is (width, height). One bad image yields an error code, never a failed task.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            # A row grows to 4 * 3 * width * height bytes, so output leaves in small pieces.
            for start in range(0, len(batch), TENSOR_BATCH):
                out = []
                for row in batch.iloc[start : start + TENSOR_BATCH].itertuples(index=False):
                    data, error = None, None
                    if row.nChannels is None or row.nChannels <= 0 or not row.data:
                        error = "image_load_failed"
                    elif row.height < 1 or row.width < 1:
                        error = "invalid_dimensions"
                    else:
                        try:
                            data = _tensor(int(row.height), int(row.width), int(row.nChannels), row.data, size)
                        except Exception as failure:  # noqa: BLE001 - the code of the row, not the job's end
                            error = f"unexpected:{type(failure).__name__}"
                    out.append((row.path, data, error))
                yield pd.DataFrame(out, columns=["path", "image_data", "error"])

    return images.select("path", "height", "width", "nChannels", "data").mapInPandas(run, "path string, image_data binary, error string")


def embed(dataset: DataFrame, listing: DataFrame, images: DataFrame, size: tuple[int, int] = (224, 224)) -> DataFrame:
    """Every dataset row with ``image_data`` or an ``error`` code.

    ``listing``: ``image, length``; ``images``: as from ``read_images``. Missing, empty and tiny files are told from the
    listing alone. Pixels are filtered to wanted paths before the resize and joined back once, as tensors.
    """
    sized = dataset.join(listing.select("image", "length"), "image", "left").withColumn(
        "_file_error",
        F.when(F.col("length").isNull(), "file_not_found")
        .when(F.col("length") == 0, "file_empty")
        .when(F.col("length") < MIN_FILE_BYTES, "file_too_small"),
    )
    wanted = sized.where(F.col("_file_error").isNull()).select(F.col("image").alias("path")).distinct()
    tensors = preprocess(images.join(wanted, "path", "left_semi"), size).withColumnRenamed("path", "image")
    joined = sized.join(tensors, "image", "left")
    error = F.coalesce("_file_error", "error", F.when(F.col("image_data").isNull(), "unidentified_image"))
    return joined.withColumn("error", error).drop("_file_error", "length")


def successful(embedded: DataFrame) -> DataFrame:
    return embedded.where(F.col("error").isNull()).drop("error")


def embedded_volume(embedded: DataFrame) -> DataFrame:
    total = F.coalesce(F.sum(F.length("image_data")), F.lit(0))
    return embedded.agg(F.count("image_data").alias("images"), total.alias("bytes"), (total / (1024 * 1024)).alias("megabytes"))


def tensor_stats(embedded: DataFrame) -> DataFrame:
    """Mean, minimum and maximum per channel of every tensor, decoded in Arrow batches."""

    @F.pandas_udf("array<struct<channel:int,mean:double,min:double,max:double>>")
    def stats(data: pd.Series) -> pd.Series:
        def one(raw):
            if raw is None:
                return []
            t = np.frombuffer(raw, dtype=np.float32).reshape(-1, 3).astype(np.float64)
            return [(c, float(t[:, c].mean()), float(t[:, c].min()), float(t[:, c].max())) for c in range(3)]

        return data.map(one)

    rows = embedded.select("path", F.explode(stats("image_data")).alias("s"))
    return rows.select("path", "s.channel", "s.mean", "s.min", "s.max")
