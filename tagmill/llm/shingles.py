"""Near-duplicate documents by the Jaccard similarity of their five-word shingles, complete for the given similarity.

Documents meet by their SimHash fingerprints over the same shingles, through the pivot tables of ``simhash``; whole sets verify the pairs
found. Three differing bits are far fewer than such similarity may leave, so that search is completed exactly. Two sets of similarity s
share a shingle among the first n - ceil(s n) + 1 of each, whatever common order the shingles are put in. So
documents also meet by these prefixes; parities of the sets discard most pairs, losing none; and the whole sets, cut anew from the texts
of the pairs left, verify the others. Shingles that a sample of the texts shows
to be common come last in the order, which keeps stock passages out of the prefixes; the sample decides about speed only.

``keep_one`` links by the operator ``simhash`` too, as it stands: documents whose fingerprints over three-word shingles differ in three bits at
most are near duplicates whatever the similarity of their five-word shingles.

The first shingle that two sets share, at positions i and j of them, has i + j shingles before it that only one of them holds, and sets of
n and m shingles with similarity s differ in (n + m) (1 - s) / (1 + s) at most and share the rest, of which neither has more left than
n - i or m - j. A meeting further back is none, and similar sets lose only meetings that are not their first.

A large group of near copies would meet in the square of its size. Each member is therefore compared with one that it meets, and each
meeting place compares its members with the one that has the fewest shingles before it; all pairs are compared only where members then lie
in different components. Tables are deleted once the next one is written, so that the scratch folder stays small.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from tagmill.llm import simhash
from tagmill.llm.common import BROADCAST_BYTES, bounded_batches, discard, narrow, text_or_empty
from tagmill.llm.components import components
from tagmill.session import cut

SHINGLE = 5
#: Similarity in tenths, so that no rounding decides about a pair.
TENTHS = 8
SEED = 42
#: Texts whose sets leave a task together, so that a batch of long texts takes little memory.
PIECE = 256
#: One of so many texts shows which shingles are common; COMMON of them at most are put last.
SAMPLE, SEEN, COMMON = 16, 3, 1 << 16


def shingles(text: str | None, shingle: int = SHINGLE) -> np.ndarray:
    """Distinct hashes of the runs of ``shingle`` words in ascending order; of all words, if they are fewer."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.empty(0, np.int64)
    count = max(1, len(words) - shingle + 1)
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    first = [0, *(ends[: count - 1] + 1).tolist()]
    last = ends[min(shingle, len(words)) - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    return np.unique(np.fromiter((digest(joined[a:b], SEED) for a, b in zip(first, last)), np.uint64, count).view(np.int64))


def parities(s: np.ndarray) -> np.ndarray:
    """Parities of the shingles by their low bits: two sets differ in as many shingles at least as their parities differ.

    There are 256 of them or, for a larger set, the next power of two above its size, so that they tell large sets apart too.
    """
    wide = max(256, 1 << (len(s) - 1).bit_length())
    ones = np.bincount((s & (wide - 1)).astype(np.int64), minlength=wide) & 1
    return np.packbits(ones.astype(np.uint8), bitorder="little").view(np.int64)


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, h, text) of each row with an id; h is a hash of its text."""
    text = text_or_empty(text_col)
    rows = narrow(docs, id_col, text_col).where(F.col(f"`{id_col}`").isNotNull())
    return rows.select(F.col(f"`{id_col}`").alias("doc_id"), F.xxhash64(text).alias("h"), text.alias("text"))


def _name(s: np.ndarray) -> int:
    """A hash that names a set."""
    return xxhash.xxh64_intdigest(s.tobytes(), SEED) - (1 << 63)


def _pieces(batches):
    for batch in batches:
        for at in range(0, len(batch), PIECE):
            yield batch.iloc[at : at + PIECE]


def _common(texts: DataFrame, shingle: int) -> np.ndarray:
    """Shingles that a sample of the texts holds often, in ascending order, each with the number of its texts; COMMON of them at most."""

    def run(batches):
        for part in _pieces(batches):
            yield pd.DataFrame({"h": part["h"].values, "s": [shingles(t, shingle) for t in part["text"]]})

    sample = texts.where(F.pmod("h", F.lit(SAMPLE)) == 0).select("h", "text").mapInPandas(run, "h long, s array<long>")
    counts = sample.select("h", F.explode("s").alias("token")).distinct().groupBy("token").agg(F.count("*").alias("n"))
    # As columns: collected rows are merged in the driver, a list from each task, and made Python objects one by one.
    seen = counts.where(F.col("n") >= SEEN).orderBy(F.desc("n"), "token").limit(COMMON).toArrow()
    found = np.column_stack([seen[c].to_numpy() for c in ("token", "n")]).astype(np.int64)
    return found[np.argsort(found[:, 0])]


def prefix(s: np.ndarray, common: np.ndarray, tenths: int = TENTHS) -> np.ndarray:
    """The first n - ceil(tenths n / 10) + 1 shingles of a set, those that ``common`` names last, by their number."""
    often = np.zeros(len(s), np.int64)
    if len(common):
        at = np.minimum(np.searchsorted(common[:, 0], s), len(common) - 1)
        often = np.where(common[at, 0] == s, common[at, 1], 0)
    return s[np.lexsort((s, often))[: len(s) - -(-tenths * len(s) // 10) + 1]]


def _sets(texts: DataFrame, common: np.ndarray, tenths: int, shingle: int) -> DataFrame:
    """(doc_id, h, node, fp, mark, n, q, p): a hash that names each row's set of shingles, its text's fingerprint and the one of ``simhash``, the set's size, parities and prefix.

    The set itself is not kept: only the texts of pairs that the parities leave are cut into shingles again.
    """

    def run(batches):
        for part in _pieces(batches):
            out = {"doc_id": part["doc_id"].values, "h": part["h"].values, "node": [], "fp": [], "mark": [], "n": [], "q": [], "p": []}
            for text in part["text"]:
                s = shingles(text, shingle)
                for column, value in (("node", _name(s)), ("fp", simhash.simhash(text, shingle)), ("mark", simhash.simhash(text)), ("n", len(s)), ("q", parities(s)), ("p", prefix(s, common, tenths))):
                    out[column].append(value)
            yield pd.DataFrame(out)

    longs = ArrayType(LongType())
    made = StructType([*texts.schema.fields[:2], *[StructField(c, LongType()) for c in ("node", "fp", "mark", "n")], StructField("q", longs), StructField("p", longs)])
    return texts.mapInPandas(run, made)


def _postings(sets: DataFrame) -> DataFrame:
    """(token, i, node, n) of each set's prefix, of tokens that two sets have, as a written table; i is the token's position, from 0."""
    # Written once for each set, as two passes follow.
    written = cut(sets.select("node", "n", "p").dropDuplicates(["node"]))
    rows = written.select(F.posexplode("p").alias("i", "token"), "node", "n")
    places = rows.groupBy("token").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).where("lo < hi").select(F.col("token").alias("place"))
    # Joined by shuffling, here and below: Spark sizes what grows with the documents by compressed files and as if an array had one element.
    postings = cut(rows.join(places.hint("merge"), F.col("token") == F.col("place"), "left_semi"))
    discard(written)
    return postings


def _sketches(sets: DataFrame) -> DataFrame:
    """(node, t, n, q) of each set: the hash of one of its texts, its size and parities."""
    return cut(sets.groupBy("node").agg(F.min("h").alias("t"), F.first("n").alias("n"), F.first("q").alias("q")))


def _whole(chosen: DataFrame, texts: DataFrame, shingle: int) -> DataFrame:
    """(node, s) of the sets of the texts whose hashes are ``chosen``, cut anew."""

    def run(batches):
        for part in _pieces(batches):
            sets = [shingles(t, shingle) for t in part["text"]]
            yield pd.DataFrame({"node": [_name(s) for s in sets], "s": sets})

    named = texts.join(chosen, F.col("h") == F.col("chosen"), "left_semi").select("text")
    return named.mapInPandas(run, "node long, s array<long>").dropDuplicates(["node"])


def _verified(pairs: DataFrame, sketches: DataFrame, texts: DataFrame, tenths: int, shingle: int) -> DataFrame:
    """Those pairs (a, b) of nodes whose sets are similar, as a written table.

    Sketches are joined by shuffling, since a broadcast of all of them passes the driver in each pass and grows with the documents.
    """
    side = lambda at: sketches.select(F.col("node").alias(at), *[F.col(c).alias(f"{at}_{c}") for c in ("t", "n", "q")]).hint("merge")
    # Of two widths the larger is folded to the smaller; sets whose widths lie further apart are left to the exact comparison.
    half = lambda q: F.shiftright(F.size(q), 1)
    halved = lambda q: F.zip_with(F.slice(q, 1, half(q)), F.slice(q, half(q) + 1, half(q)), lambda u, v: u.bitwiseXOR(v))
    a, b = F.col("a_q"), F.col("b_q")
    ones = lambda x, y: F.aggregate(F.zip_with(x, y, lambda u, v: F.bit_count(u.bitwiseXOR(v))), F.lit(0), lambda n, m: n + m)
    differ = (
        F.when(F.size(a) == F.size(b), ones(a, b))
        .when(F.size(a) == 2 * F.size(b), ones(halved(a), b))
        .when(F.size(b) == 2 * F.size(a), ones(a, halved(b)))
        .otherwise(0)
    )
    # Sets of n and m shingles with similarity s differ in (n + m) (1 - s) / (1 + s) at most.
    possible = (10 + tenths) * differ <= (10 - tenths) * (F.col("a_n") + F.col("b_n"))
    pairs = cut(pairs.join(side("a"), "a").join(side("b"), "b").where(possible).select("a", "b", "a_t", "b_t"))
    chosen = pairs.select(F.explode(F.array("a_t", "b_t")).alias("chosen")).distinct()
    n = chosen.count()
    if not n:
        return pairs.select("a", "b")
    known = _whole(F.broadcast(chosen) if n * 64 <= BROADCAST_BYTES else chosen.hint("merge"), texts, shingle)
    x, y = known.select(F.col("node").alias("a"), F.col("s").alias("sa")), known.select(F.col("node").alias("b"), F.col("s").alias("sb"))
    both = pairs.join(x, "a").join(y, "b").select("a", "b", F.size(F.array_intersect("sa", "sb")).alias("i"), (F.size("sa") + F.size("sb")).alias("n"))
    links = cut(both.where(10 * F.col("i") >= tenths * (F.col("n") - F.col("i"))).select("a", "b"))
    discard(pairs)
    return links


def _joined(label: DataFrame, links: DataFrame) -> DataFrame:
    """``label`` as ``components`` gives it, with the components that ``links`` connect made one."""
    if links.isEmpty():
        return label
    return components(label.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(links))


def _by_fingerprint(sets: DataFrame, fp: str = "fp") -> DataFrame:
    """(a, b) with a < b: nodes whose fingerprints in column ``fp`` are equal or, by the pivot tables, within ``simhash.RADIUS`` bits.

    Nodes of one fingerprint are compared with the least of them, and that one stands for them elsewhere.
    """
    prints = cut(sets.select(F.col(fp).alias("fp"), "node").distinct())
    least = cut(prints.groupBy("fp").agg(F.min("node").alias("one")))
    one = lambda at: least.select(F.col("fp").alias(f"fp_{at}"), F.col("one").alias(at)).hint("merge")
    same = prints.join(one("other"), F.col("fp") == F.col("fp_other")).select("node", "other")
    close = simhash.links(least).withColumnsRenamed({"a": "x", "b": "y"}).join(one("node"), F.col("x") == F.col("fp_node")).join(one("other"), F.col("y") == F.col("fp_other"))
    pairs = same.unionByName(close.select("node", "other")).where("node <> other")
    found = cut(pairs.select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")).distinct())
    discard(prints)
    discard(least)
    return found


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tenths: int = TENTHS, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, node, component_id) of each row with an id: component_id is the smallest id that links of similar sets reach.

    Null texts, empty ones and those without words have the empty set and are copies of each other. Other columns are ignored.
    """
    found = _labelled(docs, id_col, text_col, tenths, shingle, False)
    return found.select("doc_id", "node", "component_id")


def _labelled(docs: DataFrame, id_col: str, text_col: str, tenths: int, shingle: int, marks: bool) -> DataFrame:
    """(doc_id, h, node, component_id, one) of each row with an id; ``one`` is the component's least (doc_id, h).

    With ``marks``, what ``simhash`` links is linked as well, with nothing to verify.

    Pairs are verified in three passes, each of which leaves out what the passes before have joined: nodes of close fingerprints and every
    node against one node that it meets, then against the one node of each of its places, then the nodes of a place that still lie apart.
    """
    bounded_batches(docs.sparkSession)
    texts = _texts(docs, id_col, text_col)
    sets = cut(_sets(texts, _common(texts, shingle), tenths, shingle))
    sketches = _sketches(sets)
    postings = _postings(sets)
    order = F.struct("i", F.xxhash64("token", "node").alias("h"), "node", "n")
    places = postings.groupBy("token").agg(F.min(order).alias("one")).select(F.col("token").alias("place"), "one")
    met = cut(postings.join(places.hint("merge"), F.col("token") == F.col("place")).select("token", "i", "node", "n", F.col("one.node").alias("other"), F.col("one.n").alias("m"), F.col("one.i").alias("j")))
    discard(postings)
    alike = lambda n, m: 10 * F.least(n, m) >= tenths * F.greatest(n, m)
    differ = lambda i, j, n, m: (10 + tenths) * (F.col(i) + F.col(j)) <= (10 - tenths) * (F.col(n) + F.col(m))
    left = lambda i, j, n, m: (10 + tenths) * F.least(F.col(n) - F.col(i), F.col(m) - F.col(j)) >= tenths * (F.col(n) + F.col(m))
    first = lambda *at: differ(*at) & left(*at)
    ordered = [F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")]
    stars = met.where((F.col("node") != F.col("other")) & alike("n", "m") & first("i", "j", "n", "m"))
    nearest = stars.groupBy("node").agg(F.min_by("other", F.struct(F.col("i") + F.col("j"), "other")).alias("other")).select(*ordered)
    links = _verified(nearest.unionByName(_by_fingerprint(sets)).distinct(), sketches, texts, tenths, shingle)
    if marks:
        links = links.unionByName(_by_fingerprint(sets, "mark"))

    label = cut(components(links))
    named = lambda at: label.select(F.col("node").alias(f"_{at}"), F.col("component").alias(f"c_{at}")).hint("merge")
    pairs = stars.select(*ordered).distinct()
    pairs = pairs.join(named("a"), F.col("a") == F.col("_a"), "left").join(named("b"), F.col("b") == F.col("_b"), "left")
    pairs = pairs.where(F.coalesce("c_a", "a") != F.coalesce("c_b", "b")).select("a", "b")
    label = _joined(label, _verified(pairs, sketches, texts, tenths, shingle))
    # No node of a place has fewer shingles before it than the place's one, and none similar is larger than 10 n / tenths.
    open_ = met.where(tenths * (F.col("i") + F.col("j")) <= (10 - tenths) * F.col("n")).select("token", "i", "node", "n")
    labelled = cut(open_.join(label.withColumnRenamed("node", "_node").hint("merge"), F.col("node") == F.col("_node"), "left").select("token", "i", "node", "n", F.coalesce("component", "node").alias("c")))
    discard(met)
    mixed = labelled.groupBy("token").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo < hi").select(F.col("token").alias("place"))
    rest = labelled.join(mixed, F.col("token") == F.col("place"), "left_semi")
    x, y = rest.alias("x"), rest.alias("y")
    apart = (F.col("x.token") == F.col("y.token")) & (F.col("x.node") < F.col("y.node")) & (F.col("x.c") != F.col("y.c")) & alike(F.col("x.n"), F.col("y.n")) & first("x.i", "y.i", "x.n", "y.n")
    pairs = x.join(y.hint("merge"), apart).select(F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct()
    label = _joined(label, _verified(pairs, sketches, texts, tenths, shingle))
    discard(labelled)
    rows = cut(sets.select("doc_id", "h", "node"))
    discard(sets)
    discard(sketches)

    classes = rows.groupBy("node").agg(F.min(F.struct("doc_id", "h")).alias("one"))
    roots = classes.join(label.withColumnRenamed("node", "_node"), F.col("node") == F.col("_node"), "left").select("node", "one", F.coalesce("component", "node").alias("root"))
    roots = cut(roots)
    least = roots.groupBy("root").agg(F.min("one").alias("one"))
    member = roots.drop("one").join(least, "root").select(F.col("node").alias("member"), "one")
    return rows.join(member, F.col("node") == F.col("member")).select("doc_id", "h", "node", F.col("one.doc_id").alias("component_id"), "one")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tenths: int = TENTHS, shingle: int = SHINGLE) -> DataFrame:
    """``docs`` without near duplicates: of each component the row with the smallest id stays.

    Components are those of both kinds of links: sets of shingles of the given similarity, and fingerprints that ``simhash`` links. Rows that share an id are told apart by their texts: of equal ids the one with the smallest hash of its text stays, and different
    texts of one id that are no near duplicates all stay. Rows with a null id are kept, since no id can stand for them.
    """
    keep = _labelled(docs, id_col, text_col, tenths, shingle, True).select("one").distinct()
    # Names that no column of the input can have, whatever it is called.
    free = lambda name: name + "_" * (1 + max(map(len, docs.columns)))
    keep = keep.select(F.col("one.doc_id").alias(free("id")), F.col("one.h").alias(free("h")))
    rows = docs.withColumn(free("own"), F.xxhash64(text_or_empty(text_col)))
    kept = rows.join(keep, (F.col(f"`{id_col}`") == F.col(free("id"))) & (F.col(free("own")) == F.col(free("h")))).dropDuplicates([id_col, free("own")])
    own = [F.col(f"`{c}`") for c in docs.columns]
    return kept.select(*own).unionByName(docs.where(F.col(f"`{id_col}`").isNull()))
