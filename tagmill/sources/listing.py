"""Distributed directory listing.

The file sources of Spark list on the driver and leave out empty files. Here every directory is one row, listed by the
task that gets it; its subdirectories are the rows of the next round, so there is one small job per directory level.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagmill.session import cut

ENTRY = "path string, is_dir boolean, length long, modified double"
BATCH = 10_000


def _scan(root: str, folder: str) -> Iterator[tuple]:
    """Entries of one directory as (relative path, is_dir, length, mtime); symbolic links are left out."""
    if "://" not in root:
        base = os.path.join(root, folder)
        try:
            with os.scandir(base) as entries:
                for e in entries:
                    if e.is_dir(follow_symlinks=False) or e.is_file(follow_symlinks=False):
                        info = e.stat(follow_symlinks=False)
                        yield os.path.join(folder, e.name), e.is_dir(follow_symlinks=False), info.st_size, info.st_mtime
        except (PermissionError, FileNotFoundError):
            return
    else:
        from pyarrow import fs

        system, base = fs.FileSystem.from_uri(root)
        selector = fs.FileSelector(f"{base}/{folder}".rstrip("/"), allow_not_found=True)
        for e in system.get_file_info(selector):
            name = f"{folder}/{e.base_name}" if folder else e.base_name
            yield name, e.type == fs.FileType.Directory, e.size or 0, e.mtime_ns / 1e9 if e.mtime_ns else 0.0


def _list(folders: DataFrame, root: str) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def frame(rows):
            return pd.DataFrame(rows, columns=["path", "is_dir", "length", "modified"])

        for batch in batches:
            for folder in batch["path"]:
                rows = []
                for entry in _scan(root, folder):
                    rows.append(entry)
                    if len(rows) == BATCH:
                        yield frame(rows)
                        rows = []
                if rows:
                    yield frame(rows)

    return folders.select("path").mapInPandas(run, ENTRY)


def list_tree(spark: SparkSession, root: str) -> DataFrame:
    """``path, length, modified`` of every file below ``root``; a missing root lists nothing."""
    root = root.removeprefix("file://").rstrip("/")
    level = cut(_list(spark.createDataFrame([("",)], "path string"), root))
    levels = [level]
    while not level.where("is_dir").isEmpty():
        level = cut(_list(level.where("is_dir").repartition("path"), root))
        levels.append(level)
    files = reduce(DataFrame.unionByName, levels).where(~F.col("is_dir"))
    return files.select("path", "length", F.timestamp_seconds("modified").alias("modified"))
