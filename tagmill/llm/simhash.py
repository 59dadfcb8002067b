"""Near-duplicate documents by 64-bit SimHash, searched through tables of distances to reference fingerprints.

Every distinct fingerprint gets a row of Hamming distances to fixed reference fingerprints (the pivot table). By the
triangle inequality two fingerprints within r bits differ by at most r in every coordinate, so a pair whose largest
coordinate difference exceeds r is discarded, and the survivors are verified by counting differing bits.

Coordinates of near-random fingerprints crowd around 32, so a pivot table alone would have to look at almost all pairs.
Rows therefore meet only where the six blocks of their bits agree in at least three: with at most three differing bits no
pair can miss that (each bit spoils one block). Meeting places are 32-bit keys, so the pairs met stay few at any size.
The rows that meet are shuffled at any size: Spark sizes them by the narrow fingerprints, some hundred times too low, and would broadcast them.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from tagmill.llm.common import narrow, text_or_empty
from tagmill.llm.components import components
from tagmill.session import cut

SEED = 42
RADIUS = 3
SHINGLE = 3
PIVOTS = 16
#: Shingles whose bits are unpacked at a time, which bounds memory for very long texts.
CHUNK = 1 << 15


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def reference_points(n: int = PIVOTS) -> list[int]:
    """``n`` fixed fingerprints, spread by hashing their number."""
    return [xxhash.xxh64_intdigest(f"pivot {i}", 0) for i in range(n)]


def _key_masks(radius: int) -> list[int]:
    """Masks of every choice of ``radius`` out of 2 * radius blocks of the 64 bits."""
    blocks = 2 * radius
    edges = [round(i * 64 / blocks) for i in range(blocks + 1)]
    masks = [((1 << hi) - 1) ^ ((1 << lo) - 1) for lo, hi in zip(edges, edges[1:])]
    return [sum(chosen) for chosen in combinations(masks, blocks - radius)]


def simhash(text: str | None, shingle: int = SHINGLE) -> int:
    """The fingerprint of one text as a signed 64-bit integer; 0 for a text without words."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    count = max(1, len(words) - shingle + 1)
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    first = [0, *(ends[: count - 1] + 1).tolist()]
    last = ends[min(shingle, len(words)) - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(first, last)), np.uint64, count)
    ones = np.zeros(64, np.int64)
    for at in range(0, count, CHUNK):
        part = hashes[at : at + CHUNK]
        ones += np.unpackbits(part.view(np.uint8), bitorder="little").reshape(-1, 64).sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > count, bitorder="little").view(np.int64)[0])


def fingerprint(text: Column, shingle: int = SHINGLE) -> Column:
    """Fingerprint of a text column."""

    @pandas_udf("long")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([simhash(t, shingle) for t in texts], dtype="int64")

    return run(text)


def hex_fingerprint(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def links(fingerprints: DataFrame, radius: int = RADIUS, pivots: int = PIVOTS) -> DataFrame:
    """(a, b) with a < b: every pair of distinct values of ``fp`` within ``radius`` bits, once."""
    masks = _key_masks(radius)
    distances = [F.bit_count(F.col("fp").bitwiseXOR(F.lit(_signed(p)))).cast("byte").alias(f"d{i}") for i, p in enumerate(reference_points(pivots))]
    table = fingerprints.select("fp").where("fp is not null").distinct().select("fp", *distances)
    keys = F.array(*[F.struct(F.lit(i).cast("byte").alias("c"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("k")) for i, m in enumerate(masks)])
    keyed = table.select("*", F.explode(keys).alias("key")).select("fp", *[f"d{i}" for i in range(pivots)], "key.c", "key.k")
    x, y = keyed.alias("x"), keyed.alias("y")
    near = F.col("x.fp") < F.col("y.fp")
    for i in range(pivots):
        near = near & (F.abs(F.col(f"x.d{i}").cast("int") - F.col(f"y.d{i}")) <= radius)
    apart = F.col("x.fp").bitwiseXOR(F.col("y.fp"))
    meeting = F.lit(None).cast("int")
    for i, m in reversed(list(enumerate(masks))):
        meeting = F.when(apart.bitwiseAND(F.lit(_signed(m))) == 0, F.lit(i)).otherwise(meeting)
    verified = (F.bit_count(apart) <= radius) & (meeting == F.col("x.c"))  # a pair counts at its first meeting place only
    return x.join(y.hint("merge"), (F.col("x.c") == F.col("y.c")) & (F.col("x.k") == F.col("y.k")) & near & verified).select(
        F.col("x.fp").alias("a"), F.col("y.fp").alias("b")
    )


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS, shingle: int = SHINGLE) -> DataFrame:
    """One row per input row: id, fp (long) and component_id, the smallest id that links of ``radius`` bits reach.

    Null and empty texts and texts without words have fingerprint 0 and are linked like any other. Fewer than ``shingle``
    words make one shingle of all of them. Repeated rows each get their row. A null id never names a component unless all
    its ids are null. An empty table gives an empty result. Other columns are ignored. Copies share one fingerprint and are
    never paired with each other.
    """
    base = narrow(docs, id_col, text_col).select(F.col(id_col).alias("doc_id"), fingerprint(text_or_empty(text_col), shingle).alias("fp"))
    prints = cut(base)
    classes = cut(prints.groupBy("fp").agg(F.min("doc_id").alias("least")))
    label = components(links(classes, radius))
    named = classes.join(label, F.col("fp") == F.col("node"), "left").select("fp", F.coalesce("component", "fp").alias("root"), "least")
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    member = named.join(least, "root").select(F.col("fp").alias("member"), "component_id")
    return prints.join(member, F.col("fp") == F.col("member")).select(F.col("doc_id").alias(id_col), "fp", "component_id")


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """``docs`` without near duplicates: of each component the row with the smallest id stays (one of them, if the id repeats).

    Rows with a null id are kept, since no id can stand for them.
    """
    found = near_duplicates(docs, **options)
    keep = found.where("doc_id = component_id").select(F.col("doc_id").alias("_keep")).distinct()
    kept = docs.join(keep, F.col("doc_id") == F.col("_keep")).dropDuplicates(["doc_id"]).select(*docs.columns)
    return kept.unionByName(docs.where("doc_id is null"))
