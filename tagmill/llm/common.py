"""Small helpers shared by the corpus operators."""

from __future__ import annotations

import os
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side is broadcast only when its counted rows, times its row width, stay below this.
BROADCAST_BYTES = 64 << 20
#: Bytes of rows that a task hands to its Python worker at a time, about; a batch has one row at least.
BATCH_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def narrow(df: DataFrame, *columns: str) -> DataFrame:
    """Only the named columns, so that extra columns of any name cannot clash with an operator's own."""
    return df.select(*[F.col(f"`{c}`") for c in columns])


def broadcast_if_bounded(df: DataFrame, row_bytes: int | Column) -> DataFrame:
    """``df`` with a broadcast hint if its counted size is bounded; else it is joined by shuffling, whatever size the planner takes it for.

    ``row_bytes`` is what a row takes, or an expression for rows whose sizes differ.
    """
    size = df.count() * row_bytes if isinstance(row_bytes, int) else df.agg(F.sum(row_bytes)).first()[0] or 0
    return F.broadcast(df) if size <= BROADCAST_BYTES else df.hint("merge")


def bounded_batches(spark: SparkSession) -> None:
    """Let the session's Python workers take texts by bytes, unless the session sets a bound of its own.

    Batches are dealt by rows else (10,000), so that their memory, held in the executor and in each worker, grows with the texts.
    """
    bound = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(bound, None) is None:
        spark.conf.set(bound, str(BATCH_BYTES))


def text_or_empty(text: str = "text") -> Column:
    return F.coalesce(F.col(f"`{text}`"), F.lit(""))


def tokenizer_path(name: str) -> str:
    """Where a public vocabulary file lies: below TOKENIZER_DIR if that is set, else in the installed package."""
    folder = os.environ.get("TOKENIZER_DIR")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


def literals(values: Iterable) -> Column:
    """An array literal of a bounded, constant list."""
    return F.array(*[F.lit(v) for v in values])


def discard(df: DataFrame) -> None:
    """Delete the files behind a table that ``session.cut`` wrote, once nothing reads it any more.

    Spark drops the shuffle files of finished jobs when the driver collects its garbage, so that is asked for too.
    """
    jvm = df.sparkSession.sparkContext._jvm
    for file in {name.rpartition("/")[0] for name in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(file)
        path.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    jvm.System.gc()
