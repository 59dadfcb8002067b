"""Ranked lexical search by scanning documents with one automaton of all item terms.

There is no document index: an Aho-Corasick automaton of the items' terms, each between two guards that stand for its boundaries,
reads every text and counts the terms directly. The first scan yields the corpus statistics, which are summed inside each task; the
second one scores each document for all items that the automaton's outputs map to, and keeps the best of each item in its task.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tagmill.llm.common import narrow, text_or_empty
from tagmill.session import cut

#: Each item's best documents.
TOP = 50
#: Characters that no term holds; all others, the letters A-Z in lower case, are a term's.
BETWEEN = r"\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F"
#: Items whose terms one automaton holds, and bytes of their texts: a larger benchmark is scanned for block by block.
BLOCK_ITEMS, BLOCK_BYTES = 4_096, 32 << 20
#: Cells (documents times items) scored at a time.
CELLS = 1 << 20
GUARD = " "

_FOLD = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20 for b in range(256)
)


def folded(text: str | None) -> str:
    """The text's UTF-8 bytes as characters, A-Z in lower case, a blank for each byte between terms."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).decode("latin-1")


def terms_of(text: str | None) -> list[str]:
    """The terms of a text in order, as ``folded`` spells them. Only blanks part them: other white space is folded or a byte of a letter."""
    return [t for t in folded(text).split(GUARD) if t]


@dataclass
class Block:
    """Some items' terms, and the items (by place) that hold each of them."""

    items: list
    terms: list[str]
    starts: np.ndarray
    places: np.ndarray

    @classmethod
    def of(cls, rows: list[tuple]) -> Block:
        """From (item_id, text) rows; texts of one id are joined."""
        items = sorted({r[0] for r in rows})
        at = {item: i for i, item in enumerate(items)}
        holders: dict[str, set[int]] = {}
        for item, text in rows:
            for t in terms_of(text):
                holders.setdefault(t, set()).add(at[item])
        terms = sorted(holders)
        lists = [sorted(holders[t]) for t in terms]
        starts = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int64)
        return cls(items, terms, starts, np.array([p for x in lists for p in x], np.int64))

    def automaton(self) -> ahocorasick.Automaton:
        found = ahocorasick.Automaton()
        for i, t in enumerate(self.terms):
            found.add_word(f"{GUARD}{t}{GUARD}", i)
        if self.terms:
            found.make_automaton()
        return found


class Counter:
    """Counts a block's terms in texts; one per task."""

    def __init__(self, block: Block) -> None:
        self.size, self.machine = len(block.terms), block.automaton()

    def count(self, text: str | None) -> tuple[int, np.ndarray, np.ndarray]:
        """(number of all terms, places of the block's terms found, their counts)."""
        line = folded(text)
        raw = np.frombuffer(line.encode("latin-1"), np.uint8) != 0x20
        n = int(raw[:1].sum() + (raw[1:] & ~raw[:-1]).sum())
        if not n or not self.size:
            return n, np.empty(0, np.int64), np.empty(0, np.int64)
        hits = np.fromiter((i for _, i in self.machine.iter(f"{GUARD}{line}{GUARD}")), np.int64)
        return n, *np.unique(hits, return_counts=True)


class Best:
    """The best rows of each item so far, by score and then the smaller id."""

    def __init__(self, items: int, top: int) -> None:
        self.items, self.top, self.bar = items, top, np.zeros(items, np.int64)
        self.held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.rows = 0

    def add(self, ids: np.ndarray, scores: np.ndarray) -> None:
        """``scores``: a row for each id, a column for each item. Rows at the bar stay in play, since a smaller id may come."""
        doc, item = np.nonzero((scores >= self.bar) & (scores > 0))
        if len(doc):
            self.held.append((item, scores[doc, item], ids[doc]))
            self.rows += len(doc)
        if self.rows > 4 * self.top * self.items + (1 << 16):
            self.result()

    def result(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(item, score, id) of the best rows."""
        if not self.held:
            return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
        item, score, ids = (np.concatenate(c) for c in zip(*self.held))
        order = np.lexsort((ids, -score, item))
        item, score, ids = item[order], score[order], ids[order]
        first = np.searchsorted(item, np.arange(self.items))
        rank = np.arange(len(item)) - first[item]
        last = rank == self.top - 1
        self.bar[item[last]] = score[last]
        kept = rank < self.top
        self.held, self.rows = [(item[kept], score[kept], ids[kept])], int(kept.sum())
        return self.held[0]


def _blocks(items: DataFrame, item_col: str, text_col: str) -> Iterator[Block]:
    """Blocks of the items in order of their ids, read one at a time, each bounded by its texts' bytes and its number of items."""
    rows = narrow(items, item_col, text_col).select(F.col(f"`{item_col}`").alias("item"), text_or_empty(text_col).alias("text")).where("item is not null").distinct()
    held, size = [], 0
    for row in rows.orderBy("item", "text").toLocalIterator():
        new = not held or row["item"] != held[-1][0]
        if new and held and (size + len(row["text"]) > BLOCK_BYTES or len({r[0] for r in held}) >= BLOCK_ITEMS):
            yield Block.of(held)
            held, size = [], 0
        held.append((row["item"], row["text"]))
        size += len(row["text"])
    if held:
        yield Block.of(held)


def statistics(docs: DataFrame, block: Block) -> tuple[int, int, np.ndarray]:
    """(documents with a term, all their terms, and the documents that hold each of the block's terms) of ``docs`` (doc_id, text)."""
    shared = docs.sparkSession.sparkContext.broadcast(block)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counter = Counter(shared.value)
        df, filled, total = np.zeros(counter.size, np.int64), 0, 0
        for batch in batches:
            for text in batch["text"]:
                n, found, _ = counter.count(text)
                filled, total = filled + (n > 0), total + n
                df[found] += 1
        seen = np.flatnonzero(df)
        yield pd.DataFrame({"term": np.r_[-2, -1, seen], "n": np.r_[filled, total, df[seen]]})

    sums = docs.select("text").mapInPandas(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    got = {r["term"]: r["n"] for r in sums.collect()}  # a row for each of the block's terms at most
    return got.get(-2, 0), got.get(-1, 0), np.array([got.get(i, 0) for i in range(len(block.terms))], np.int64)


def weights(documents: int, df: np.ndarray) -> np.ndarray:
    return np.floor(1000 * np.log((2.0 * documents + 2) / (2.0 * df + 1))).astype(np.int64)


def contributions(w: np.ndarray, tf: np.ndarray, n: int, documents: int, total: int) -> np.ndarray:
    """What each of a document's terms adds to the score: its weight times its saturated count, in integers."""
    m = 100 - 50 + (50 * n * documents) // total
    return w * ((1_000_000_000 * tf) // (1000 * tf + 20 * m))


def _ranked_block(docs: DataFrame, block: Block, top: int) -> DataFrame:
    """(place, doc_id, score): of each task the best rows of each of the block's items."""
    documents, total, df = statistics(docs, block)
    shared = docs.sparkSession.sparkContext.broadcast((block, weights(documents, df)))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        block, w = shared.value
        counter, best = Counter(block), Best(len(block.items), top)
        step = max(1, CELLS // max(1, len(block.items)))
        for batch in batches:
            ids, texts = batch["doc_id"].to_numpy(np.int64), batch["text"]
            for at in range(0, len(ids), step):
                scores = np.zeros((min(step, len(ids) - at), len(block.items)), np.int64)
                for line, text in zip(scores, texts.iloc[at : at + step]):
                    n, found, tf = counter.count(text)
                    if not len(found):
                        continue
                    each = contributions(w[found], tf, n, documents, total)
                    width = block.starts[found + 1] - block.starts[found]
                    ends = np.cumsum(width)
                    where = np.arange(ends[-1]) + np.repeat(block.starts[found] - (ends - width), width)
                    np.add.at(line, block.places[where], np.repeat(each, width))
                best.add(ids[at : at + step], scores)
        item, score, ids = best.result()
        yield pd.DataFrame({"place": item, "doc_id": ids, "score": score})

    return docs.mapInPandas(run, "place long, doc_id long, score long")


def rank(
    docs: DataFrame,
    items: DataFrame,
    top: int = TOP,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """(item_id, rank, doc_id, score): each item's ``top`` documents of largest score above 0, ties by the smaller id.

    Whole texts are scanned twice, once for the statistics and once for the scores; each task hands on its best rows only. Every row
    with an id is a document of its own, repeated ids included; null texts are empty. Rows with a null id take no part, nor do items with
    a null id; texts of one item id are taken together. An item without terms, or whose terms stand nowhere, has no rows. Other columns
    are ignored. A benchmark beyond ``BLOCK_BYTES`` or ``BLOCK_ITEMS`` is scanned for in blocks, which bounds what is broadcast.
    """
    spark = docs.sparkSession
    schema = f"{item_col} {items.schema[item_col].dataType.simpleString()}, place long"
    texts = narrow(docs, id_col, text_col).select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text_or_empty(text_col).alias("text")).where("doc_id is not null")
    best = Window.partitionBy("place").orderBy(F.desc("score"), "doc_id")
    parts = []
    for block in _blocks(items, item_col, item_text_col):
        found = _ranked_block(texts, block, top).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
        names = F.broadcast(spark.createDataFrame([(item, i) for i, item in enumerate(block.items)], schema))
        parts.append(cut(found.join(names, "place").select(item_col, "rank", "doc_id", "score")))
    if not parts:
        return spark.createDataFrame([], f"{item_col} {items.schema[item_col].dataType.simpleString()}, rank int, doc_id long, score long")
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def oracle_sql(top: int = TOP) -> str:
    """The same ranking in DuckDB, over the table of all (document, term) pairs."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    words = f"regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'), '[^{BETWEEN}]+')"
    return f"""
WITH words AS (SELECT doc_id, unnest({words}) AS term FROM documents WHERE doc_id IS NOT NULL),
tf AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY ALL),
size AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM tf GROUP BY doc_id),
corpus AS (SELECT count(*) AS docs, sum(n)::BIGINT AS total FROM size),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
wanted AS (SELECT DISTINCT item_id, unnest({words}) AS term FROM benchmark WHERE item_id IS NOT NULL),
weight AS (SELECT term, floor(1000 * ln((2.0::DOUBLE * docs + 2) / (2.0::DOUBLE * df + 1)))::BIGINT AS w FROM df, corpus),
length AS (SELECT doc_id, 100 - 50 + ((50 * n * docs) // total) AS m FROM size, corpus),
scored AS (
  SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m)))::BIGINT AS score
  FROM wanted JOIN tf USING (term) JOIN weight USING (term) JOIN length USING (doc_id) GROUP BY ALL),
ranked AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= {top}"""
