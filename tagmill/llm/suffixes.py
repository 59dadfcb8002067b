"""Removal of repeated byte strings with range-partitioned, locally sorted suffixes.

Of all strings of ``LENGTH`` bytes that occur more than once, every byte of every occurrence but the first goes. Sorting all
suffixes would move the text many times over, so suffixes are thinned twice without losing a repeat:

1. A string of LENGTH bytes contains an anchor: the place whose k-gram hashes lowest within the string. Equal strings have equal
   anchors at equal offsets, so strings are grouped by anchor. One record stands for a run of neighbouring strings that share an
   anchor; its leading tokens are the anchor's hash and the hashes of the bytes that the run covers.
2. Records are range-partitioned by sampled splitters on these tokens, each bucket is sorted by a multikey quicksort, and
   neighbours are compared, across bucket boundaries too. A record equal to an earlier one is a repeat as a whole. Where an
   anchor has several contexts, these are range-partitioned by the anchor once more, with their bytes, and each bucket sorts
   and compares their strings singly, as suffixes cut at LENGTH bytes. An anchor stays in one bucket, unless it has more than
   PART contexts: then it is split, and what its buckets hold first is compared across their boundaries.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagmill.llm.common import broadcast_if_bounded, discard, narrow, text_or_empty
from tagmill.session import cut

LENGTH = 100
GRAM = 32
WIDTH = LENGTH - GRAM + 1
#: Strings of a text that are looked at together; pieces overlap by LENGTH - 1 bytes. Their places must fit 20 bits.
PIECE = 1 << 19
#: Records, and contexts of some thirty strings each, that a bucket of the sorts should hold.
BUCKET, CONTEXTS = 400_000, 20_000
#: Contexts of an anchor that are kept together; an anchor with more is dealt in parts of about this size.
PART = 512

_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)


def _mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A 64-bit hash of two hashed neighbours."""
    x = a * _ODD[0] + (b ^ (b >> np.uint64(29))) * _ODD[1]
    return x ^ (x >> np.uint64(32))


def _scatter(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _ODD[3]
    return x ^ (x >> np.uint64(29))


def _window_hashes(raw: np.ndarray, sizes: tuple[int, ...]) -> list[np.ndarray]:
    """For each size, a hash of the bytes of that many places from every place on, built from doubled windows."""
    doubled = [_scatter((raw.astype(np.uint64) + np.uint64(1)) * _ODD[2])]
    while 2 << (len(doubled) - 1) <= max(sizes):
        h, n = doubled[-1], 1 << (len(doubled) - 1)
        doubled.append(_mix(h[:-n], h[n:]))
    out = []
    for size in sizes:
        found, done = None, 0
        for bit in range(len(doubled) - 1, -1, -1):
            if size >> bit & 1:
                part = doubled[bit][done:]
                found = part if found is None else _mix(found[: len(part)], part[: len(found)])
                done += 1 << bit
        out.append(_scatter(found[: len(raw) - size + 1]))
    return out


def _window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values."""
    n = 1
    while 2 * n <= width:
        values = np.minimum(values[:-n], values[n:])
        n *= 2
    rest = width - n
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def runs(raw: bytes) -> Iterator[tuple[np.ndarray, ...]]:
    """(anchor hash, context hash, first string's start, number of strings) of every run, piece by piece."""
    for at in range(0, max(0, len(raw) - LENGTH + 1), PIECE):
        piece = np.frombuffer(raw, np.uint8, min(PIECE + LENGTH - 1, len(raw) - at), at)
        grams, strings = _window_hashes(piece, (GRAM, LENGTH))
        place = np.arange(len(grams), dtype=np.uint64)
        low = np.uint64((1 << 20) - 1)
        anchors = (_window_minima((grams & ~low) | place, WIDTH) & low).astype(np.int64)  # ties go to the leftmost place
        first = np.flatnonzero(np.r_[True, anchors[1:] != anchors[:-1]])
        size = np.diff(np.r_[first, len(anchors)])
        anchor = anchors[first]
        # A run's bytes are those of its first and its last string, since these overlap.
        context = _mix(_mix(strings[first], strings[first + size - 1]), _scatter(((anchor - first) * 128 + size).astype(np.uint64)))
        yield grams[anchor].view(np.int64), context.view(np.int64), first + at, size


def multikey_order(words: np.ndarray) -> np.ndarray:
    """Order of the rows of an (n, k) array of unsigned words: three-way quicksort on one word at a time.

    Rows equal in a word are sorted by the next; small or last-word groups are finished directly.
    """
    order = np.arange(len(words))
    todo = [(0, len(words), 0)]
    while todo:
        lo, hi, depth = todo.pop()
        if hi - lo < 2 or depth >= words.shape[1]:
            continue
        part = order[lo:hi]
        key = words[part, depth]
        if hi - lo <= 4096 or depth == words.shape[1] - 1:
            order[lo:hi] = part[np.lexsort(words[part, depth:].T[::-1])]
            continue
        pivot = np.partition(key, len(key) // 2)[len(key) // 2]
        less, same, more = part[key < pivot], part[key == pivot], part[key > pivot]
        order[lo:hi] = np.concatenate([less, same, more])
        a, b = lo + len(less), lo + len(less) + len(same)
        todo += [(lo, a, depth), (a, b, depth + 1), (b, hi, depth)]
    return order


def _unsigned(column: pd.Series) -> np.ndarray:
    """Signed longs as unsigned words of the same order."""
    return column.to_numpy(np.int64).view(np.uint64) ^ np.uint64(1 << 63)


RECORD = "doc long, twin long, start long, n int"


def _buckets(df: DataFrame, size: int) -> int:
    return max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // size))


def _late(ends: DataFrame, tokens: list[str]) -> tuple[DataFrame, DataFrame]:
    """(first place and count of each value of ``tokens``, the rows that have an earlier place), by partial aggregation."""
    first = ends.groupBy(*tokens).agg(F.min(F.struct("doc", "twin", "start", "n")).alias("first"), F.count("*").alias("times"))
    named = first.where("times > 1").select(*[F.col(t).alias(f"_{t}") for t in tokens], "first")
    same = (F.col("doc") == F.col("first.doc")) & (F.col("twin") == F.col("first.twin")) & (F.col("start") == F.col("first.start"))
    return first, ends.join(named, [F.col(t) == F.col(f"_{t}") for t in tokens]).where(~same)


def _compared(records: DataFrame) -> DataFrame:
    """The records that matter, with ``kind``: 'repeat' if an earlier record has equal tokens h and c; 'split' if it is the first
    with its tokens and others share only its anchor h.

    Sampled splitters range-partition the records by tokens and place in the corpus, so that a frequent token spreads over many
    buckets. A bucket settles the anchors that lie wholly within it. Those at its two ends may go on in the next buckets; the
    first record of each of their contexts is compared across the boundaries by partial aggregation.
    """
    order = ["h", "c", "doc", "twin", "start"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = [b for b in batches if len(b)]
        if not parts:
            return
        df = pd.concat(parts, ignore_index=True)
        words = np.c_[tuple(_unsigned(df[k]) for k in order)]
        at = multikey_order(words)
        words = words[at]
        differs = words[1:] != words[:-1]
        again = np.r_[False, ~differs.any(1)]  # the same place twice: a row that repeats in the input
        new_group = np.r_[True, differs[:, 0]]
        new = np.r_[True, differs[:, :2].any(1)]
        number = np.cumsum(new_group) - 1
        kind = np.where(~new, "repeat", np.where(np.bincount(number, weights=new)[number] > 1, "split", ""))
        # At the ends only the first record of its tokens is open: what follows it in the bucket is a repeat anyway.
        kind = np.where(new & ((number == 0) | (number == number[-1])), "open", kind)
        kind[again] = ""
        found = np.flatnonzero(kind != "")
        out = df.iloc[at[found]].copy()
        out["kind"] = kind[found]
        yield out

    spread = records.repartitionByRange(_buckets(records, BUCKET), *order)
    found = cut(spread.mapInPandas(run, f"{RECORD}, h long, c long, kind string"))
    first, late = _late(found.where("kind = 'open'"), ["h", "c"])
    several = first.groupBy("h").agg(F.count("*").alias("contexts")).where("contexts > 1").select(F.col("h").alias("_h"))
    across = first.join(several, F.col("h") == F.col("_h")).select("first.*", "h", F.lit("split").alias("kind"))
    keep = ["doc", "twin", "start", "n", "h"]
    return found.where("kind <> 'open'").select(*keep, "kind").unionByName(late.select(*keep, F.lit("repeat").alias("kind"))).unionByName(across)


WORDS = -(-LENGTH // 8)


def _strings(df: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, start, bytes as big-endian words) of every string of every context."""
    sizes = df["n"].to_numpy()
    rows = np.repeat(np.arange(len(df)), sizes)
    within = np.arange(len(rows)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    raw = np.frombuffer(b"".join(df["bytes"]), np.uint8)
    lengths = sizes + LENGTH - 1
    begin = np.repeat(np.cumsum(lengths) - lengths, sizes) + within
    block = np.zeros((len(rows), 8 * WORDS), np.uint8)
    block[:, :LENGTH] = np.lib.stride_tricks.sliding_window_view(raw, LENGTH)[begin]
    return rows, df["start"].to_numpy()[rows] + within, block.view(">u8").astype(np.uint64)


def _single(contexts: DataFrame) -> DataFrame:
    """(doc, twin, start, n): runs of strings of the contexts that also start earlier, anchors being compared one by one.

    An anchor and its part lie in one bucket, which settles the anchors that have one part (0). Of the others a bucket leaves
    the first place of each string to partial aggregation.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = [b for b in batches if len(b)]
        if not parts:
            return
        df = pd.concat(parts, ignore_index=True)
        rows, starts, suffix = _strings(df)
        place = [_unsigned(df["doc"])[rows], _unsigned(df["twin"])[rows], starts.astype(np.uint64)]
        at = multikey_order(np.c_[tuple([suffix, *place])])
        same = np.r_[False, (suffix[at][1:] == suffix[at][:-1]).all(1)]
        lead = at[np.maximum.accumulate(np.where(same, 0, np.arange(len(at))))]
        itself = np.all([p[at] == p[lead] for p in place], axis=0)
        open_row = (df["part"] > 0).to_numpy()
        late = at[same & ~itself]
        late = late[np.lexsort((starts[late], rows[late]))]
        if len(late):  # neighbouring strings of one context make a run
            begins = np.flatnonzero(np.r_[True, (rows[late][1:] != rows[late][:-1]) | (starts[late][1:] != starts[late][:-1] + 1)])
            own = df.iloc[rows[late[begins]]]
            yield pd.DataFrame({"doc": own["doc"].to_numpy(), "twin": own["twin"].to_numpy(), "start": starts[late[begins]], "n": np.diff(np.r_[begins, len(late)]).astype(np.int32), "bytes": None})
        ends = at[~same & open_row[rows[at]]]
        for i in range(0, len(ends), 1 << 14):
            part = ends[i : i + (1 << 14)]
            own = df.iloc[rows[part]]
            text = [r[:LENGTH].tobytes() for r in suffix[part].astype(">u8").view(np.uint8)]
            yield pd.DataFrame({"doc": own["doc"].to_numpy(), "twin": own["twin"].to_numpy(), "start": starts[part], "n": np.int32(1), "bytes": text})

    spread = contexts.repartitionByRange(_buckets(contexts, CONTEXTS), "h", "part")
    found = cut(spread.mapInPandas(run, f"{RECORD}, bytes binary"))
    late = _late(found.where("bytes is not null").withColumnRenamed("bytes", "k"), ["k"])[1]
    return found.where("bytes is null").select("doc", "twin", "start", "n").unionByName(late.select("doc", "twin", "start", "n"))


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    base = narrow(docs, id_col, text_col).select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))
    return base.select("doc_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("doc"), F.pmod(F.xxhash64("text"), F.lit(1 << 20)).alias("twin"), "text")


def _run_records(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for at in range(0, len(batch), 256):
            out = []
            for doc, twin, text in batch[["doc", "twin", "text"]].iloc[at : at + 256].itertuples(index=False):
                for h, c, start, n in runs(text.encode()):
                    out.append((np.full(len(h), doc), np.full(len(h), twin), start, n, h, c))
            if out:
                yield pd.DataFrame(dict(zip(("doc", "twin", "start", "n", "h", "c"), map(np.concatenate, zip(*out)))))


def _contexts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The bytes of each listed run."""
    for batch in batches:
        out = []
        for doc, twin, text, listed in batch[["doc", "twin", "text", "runs"]].itertuples(index=False):
            raw = text.encode()
            out += [(doc, twin, r["start"], r["n"], r["h"], r["part"], raw[r["start"] : r["start"] + r["n"] + LENGTH - 1]) for r in listed]
        yield pd.DataFrame(out, columns=["doc", "twin", "start", "n", "h", "part", "bytes"])


def _in_parts(split: DataFrame) -> DataFrame:
    """``split`` with ``part``: 0, or for an anchor of more than PART contexts a number from 1 on, by the context's place."""
    busy = split.groupBy("h").agg(F.count("*").alias("times")).where(F.col("times") > PART)
    busy = cut(busy.select(F.col("h").alias("_h"), F.ceil(F.col("times") / PART).alias("parts")))
    dealt = split.join(broadcast_if_bounded(busy, 64), F.col("h") == F.col("_h"), "left")
    number = F.pmod(F.xxhash64("doc", "twin", "start"), F.col("parts")) + 1
    return dealt.select(*split.columns, F.coalesce(number, F.lit(0)).cast("int").alias("part"))


def repeated_spans(texts: DataFrame) -> DataFrame:
    """(doc, twin, spans): for each document with repeats the runs (start, n) of strings that also start earlier."""
    records = cut(texts.select("doc", "twin", "text").mapInPandas(_run_records, f"{RECORD}, h long, c long"))
    runs_found = cut(_compared(records))
    discard(records)
    split = _in_parts(runs_found.where("kind = 'split'").select("doc", "twin", "start", "n", "h"))
    listed = split.groupBy("doc", "twin").agg(F.collect_set(F.struct("start", "n", "h", "part")).alias("runs"))
    listed = cut(listed.select(F.col("doc").alias("_doc"), F.col("twin").alias("_twin"), "runs"))
    sources = texts.join(listed, (F.col("doc") == F.col("_doc")) & (F.col("twin") == F.col("_twin")))
    contexts = cut(sources.select("doc", "twin", "text", "runs").mapInPandas(_contexts, f"{RECORD}, h long, part int, bytes binary"))
    repeats = runs_found.where("kind = 'repeat'").select("doc", "twin", "start", "n").unionByName(_single(contexts))
    return repeats.groupBy("doc", "twin").agg(F.collect_list(F.struct("start", "n")).alias("spans"))


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, n_bytes, n_removed, n_spans (maximal removed runs), kept_sha256, and spans as [start, end) pairs.

    Documents are ordered by id; a null id comes first. Rows with one id and different texts are different documents, ordered by
    a 20-bit hash of the text; rows that repeat id and text are one document and get the same result. Null and empty texts and texts
    shorter than LENGTH bytes lose nothing. Texts of any length are read whole, in overlapping pieces. Strings never cross
    documents; whether one is a repeat is judged on the input. Other columns are ignored.
    """
    texts = _texts(docs, id_col, text_col)
    spans = repeated_spans(texts).select(F.col("doc").alias("_doc"), F.col("twin").alias("_twin"), "spans")
    joined = texts.join(spans, (F.col("doc") == F.col("_doc")) & (F.col("twin") == F.col("_twin")), "left").select("doc_id", "text", "spans")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for doc_id, text, found in batch.itertuples(index=False):
                raw = text.encode()
                merged: list[list[int]] = []
                for start, end in sorted((r["start"], r["start"] + r["n"] + LENGTH - 1) for r in (found if found is not None else ())):
                    if merged and start <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], end)
                    else:
                        merged.append([start, end])
                kept, last = sha256(), 0
                for start, end in merged:
                    kept.update(raw[last:start])
                    last = end
                kept.update(raw[last:])
                out.append((doc_id, len(raw), sum(e - s for s, e in merged), len(merged), kept.hexdigest(), merged))
            table = pd.DataFrame(out, columns=["id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"])
            yield table

    kind = dict(texts.dtypes)["doc_id"]
    carried = joined.withColumn("doc_id", F.col("doc_id").cast("string"))  # pandas would round long ids beside a null
    found = carried.mapInPandas(run, "id string, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<array<long>>")
    return found.select(F.col("id").cast(kind).alias(id_col), *found.columns[1:])
