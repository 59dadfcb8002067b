"""Benchmark decontamination by template canonicalisation, with DataFrame and SQL functions only.

Numbers, names and units become typed placeholders; windows of five template words, and of five words as they stand, are hash-joined
with those of the benchmark; and what fills the slots must map one to one between an item and its occurrence, which tells a question
with new parameters from a chance likeness. A text has as many windows as words, so windows go about as hashes; the words of the few texts
that share one with an item are looked at in a second reading. Letter case decides about names only: words as they stand are compared in lower case, so
a copy in other case or layout is found by them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagmill.llm.common import broadcast_if_bounded, narrow
from tagmill.operators.once import compute_once
from tagmill.session import cut

WINDOW = 5
SIMILARITY = 0.8
#: Words that a window must have besides placeholders to be looked up.
PLAIN_WORDS = 3
NUMBER, NAME, UNIT = "\x01", "\x02", "\x03"

_NUMBER = r"[0-9]+(?:[.,][0-9]+)*"
#: White space that counts as one blank before names and units are marked.
_SPACE = r"\s\u00A0\u2028\u2029"
#: Where that is not one blank already.
_SPACES = rf"[{_SPACE}]{{2,}}|[{_SPACE}&&[^ ]]"
_LETTERS = r"[\p{L}\p{M}]"
#: A capitalised word inside a sentence: it follows a small letter, comma or similar, and one blank.
_NAME = rf"(?<=[\p{{Ll}},;:] )\p{{Lu}}{_LETTERS}+"
_UNITS = "mm cm m km in ft yd mi mg g kg t lb oz ml cl l s ms min h hr hrs seconds minutes hours days weeks years meters metres kilometers miles grams pounds liters litres degrees percent dollars euros".split()
_UNIT = rf"(?<={NUMBER} ?)(?:{'|'.join(sorted(_UNITS, key=lambda u: (-len(u), u)))})(?!{_LETTERS})"


def _marked(text: Column) -> Column:
    """The text with a placeholder for each number and name."""
    spaced = F.regexp_replace(F.regexp_replace(text, _SPACES, " "), _NUMBER, NUMBER)
    return F.regexp_replace(spaced, _NAME, NAME)


def _templates(marked: Column) -> Column:
    """Template words of a marked text: lower-case words, with one placeholder for each number, name and unit."""
    units = F.when(F.contains(marked, F.lit(NUMBER)), F.regexp_replace(marked, _UNIT, UNIT)).otherwise(marked)
    return F.regexp_extract_all(F.lower(units), F.lit(f"([{NUMBER}{NAME}{UNIT}]|{_LETTERS}+)"), F.lit(1))


def _raw_words(text: Column) -> Column:
    """The same words as they stand, in the same places."""
    return F.regexp_extract_all(F.lower(text), F.lit(f"({_NUMBER}|{_LETTERS}+)"), F.lit(1))


def _each(words: str) -> Column:
    return F.expr(f"transform({words}, w -> xxhash64(w))")


def _hashes(each: str) -> Column:
    """xxhash64 of every window's word hashes, in order; empty for fewer words than a window has."""
    parts = ", ".join(f"{each}[i + {j}]" for j in range(WINDOW))
    return F.expr(f"if(size({each}) < {WINDOW}, array(), transform(sequence(0, size({each}) - {WINDOW}), i -> xxhash64({parts})))")


def _bodies(rows: DataFrame, key: str, text_col: str, name: str) -> DataFrame:
    """(name, body): the text of each row."""
    return narrow(rows, key, text_col).select(F.col(key).alias(name), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("body"))


def _words(bodies: DataFrame) -> DataFrame:
    """``bodies`` with tpl and raw in place of the text. Each step stands for itself, since a column that an expression names twice is computed twice."""
    marked = compute_once(bodies, marked=_marked(F.col("body")))
    return compute_once(marked, tpl=_templates(F.col("marked")), raw=_raw_words(F.col("body"))).drop("body", "marked")


def _hashed(words: DataFrame) -> DataFrame:
    """``words`` with the hashes and raw_hashes of its windows."""
    each = compute_once(words, tpl_each=_each("tpl"), raw_each=_each("raw"))
    return compute_once(each, hashes=_hashes("tpl_each"), raw_hashes=_hashes("raw_each")).drop("tpl_each", "raw_each")


def _items(items: DataFrame, key: str, text_col: str) -> DataFrame:
    """(item_id, variant, itpl, iraw, hashes, raw_hashes) of each item that has a window; different texts of an id are variants."""
    rows = _hashed(_words(_bodies(items.where(F.col(key).isNotNull()).dropDuplicates([key, text_col]), key, text_col, "item_id")))
    return rows.where(F.size("hashes") > 0).select("item_id", F.xxhash64("raw").alias("variant"), F.col("tpl").alias("itpl"), F.col("raw").alias("iraw"), "hashes", "raw_hashes").dropDuplicates(["item_id", "variant"])


def _anchors(items: DataFrame) -> DataFrame:
    """(item_id, variant, n_words, ipos, h): what is looked up of an item.

    All its raw windows; its template windows of enough plain words, or those of the most plain words if none has enough; and its
    first window also with a name in the first place: mid-sentence, the first word of a passage looks like one.
    """
    windows = items.select("item_id", "variant", F.size("itpl").alias("n_words"), "itpl", F.posexplode(F.arrays_zip("hashes", "raw_hashes")).alias("ipos", "z"))
    windows = windows.select("item_id", "variant", "n_words", "ipos", F.slice("itpl", F.col("ipos") + 1, WINDOW).alias("w"), F.col("z.hashes").alias("h"), F.col("z.raw_hashes").alias("raw_h"))
    raw = windows.select("item_id", "variant", "n_words", "ipos", F.col("raw_h").alias("h"))
    named = F.concat(F.array(F.lit(NAME)), F.slice("w", 2, WINDOW - 1))
    first = windows.where("ipos = 0").select("item_id", "variant", "n_words", "ipos", named.alias("w"))
    first = first.select("item_id", "variant", "n_words", "ipos", "w", F.xxhash64(*[F.xxhash64(F.col("w")[j]) for j in range(WINDOW)]).alias("h"))
    tpl = windows.drop("raw_h").unionByName(first)
    tpl = tpl.withColumn("plain", F.lit(WINDOW) - F.size(F.filter("w", lambda x: x.isin(NUMBER, NAME, UNIT))))
    most = tpl.groupBy("item_id", "variant").agg(F.least(F.max("plain"), F.lit(PLAIN_WORDS)).alias("least"))
    tpl = tpl.join(most, ["item_id", "variant"]).where("plain >= least").select("item_id", "variant", "n_words", "ipos", "h")
    return raw.unionByName(tpl).dropDuplicates(["item_id", "variant", "ipos", "h"])


def find(docs: DataFrame, items: DataFrame, similarity: float = SIMILARITY, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """One row for each document and benchmark item that it holds: ids, n_windows of the item, n_matched, similarity, n_slots
    and n_changed of them, and kind ('verbatim', or 'reparameterised' where a slot is filled anew).

    Windows that are looked up give the alignments; in each, every window of the item counts whose words agree as templates or as they
    stand. Slots whose filling disagrees with the fillings of most other slots (equal ones must correspond to equal ones, both ways)
    take their windows out, verbatim windows excepted. An item is held where at least ``similarity`` of its windows remain. Null texts
    are empty, null ids are ignored; items with fewer than five words are never found. Repeated rows change nothing. Extra columns
    are ignored. The benchmark, and the alignments found, are broadcast if their counted size is bounded, else both sides are shuffled.
    """
    known = cut(_items(items, item_col, item_text_col))
    wanted = broadcast_if_bounded(cut(_anchors(known)), 128)
    # Rows that share an id are aligned by themselves.
    pages = _bodies(docs.where(F.col(id_col).isNotNull()), id_col, text_col, "doc_id").withColumn("copy", F.xxhash64("body"))
    # Each place's template window, and its raw window where that is another one.
    places = F.expr("filter(concat(transform(hashes, (h, i) -> struct(i as pos, h as h)), transform(raw_hashes, (h, i) -> if(h = hashes[i], null, struct(i as pos, h as h)))), x -> x is not null)")
    windows = compute_once(_hashed(_words(pages)).select("doc_id", "copy", "hashes", "raw_hashes"), places=places).select("doc_id", "copy", F.inline("places").alias("pos", "h"))
    shifts = windows.join(wanted, "h").select("doc_id", "copy", "item_id", "variant", "n_words", (F.col("pos") - F.col("ipos")).alias("shift"))
    shifts = cut(shifts.groupBy(*shifts.columns).agg(F.lit(1).alias("_")).drop("_"))
    found = shifts.select(F.col("doc_id").alias("_doc"), F.col("copy").alias("_copy"), "item_id", "variant", "n_words", "shift")
    here = (F.col("doc_id") == F.col("_doc")) & (F.col("copy") == F.col("_copy"))
    held_by = broadcast_if_bounded(found.select("_doc", "_copy").distinct(), 128)
    hits = _words(pages.join(held_by, here, "left_semi")).join(broadcast_if_bounded(found, 192), here)
    # The document's words beside the item's, from its first to its last; null where the document has not begun yet or is over.
    beside = lambda c: F.expr(f"transform(sequence(0, n_words - 1), j -> if(shift + j < 0, null, get({c}, shift + j)))")
    hits = hits.select("doc_id", "copy", "item_id", "variant", "shift", beside("tpl").alias("dtpl"), beside("raw").alias("draw"))
    aligned = hits.groupBy("doc_id", "copy", "item_id", "variant", "shift").agg(F.first("dtpl").alias("dtpl"), F.first("draw").alias("draw"))
    passages = known.select("item_id", "variant", "itpl", "iraw")
    aligned = aligned.join(broadcast_if_bounded(passages, 128 + 64 * F.size("itpl")), ["item_id", "variant"])

    typed = f"dtpl[j] in ('{NUMBER}', '{NAME}', '{UNIT}')"
    within = lambda rule: F.expr(f"filter(sequence(0, size(itpl) - {WINDOW}), p -> {' and '.join(f'{rule}[p + {k}]' for k in range(WINDOW))})")
    each = "transform(sequence(0, size(itpl) - 1), j -> "
    aligned = compute_once(
        aligned,
        same=F.expr(f"{each} coalesce(iraw[j] = draw[j], false))"),
        fits=F.expr(f"{each} coalesce(iraw[j] = draw[j] or itpl[j] = dtpl[j] or (j = 0 and dtpl[j] = '{NAME}'), false))"),
        slot=F.expr(f"{each} coalesce({typed} and (itpl[j] = dtpl[j] or (j = 0 and dtpl[j] = '{NAME}')), false))"),
    )
    aligned = compute_once(aligned, verbatim=within("same"), matching=within("fits"))
    # Slots are counted once a place, in windows that match.
    slots = F.expr(f"filter({each} if(slot[j] and exists(matching, p -> j between p and p + {WINDOW - 1}), named_struct('at', j, 'i', iraw[j], 'd', draw[j]), null)), s -> s is not null)")
    aligned = compute_once(aligned, slots=slots)
    aligned = compute_once(aligned, fillings=F.expr("transform(slots, s -> named_struct('i', s.i, 'd', s.d))"))
    ranked = "reverse(array_sort(transform(array_distinct(fillings), (f, k) -> named_struct('n', size(filter(fillings, g -> g = f)), 'same', f.i = f.d, 'k', -k, 'i', f.i, 'd', f.d))))"
    aligned = compute_once(aligned, ranked=F.expr(ranked))
    agreed = F.expr("aggregate(ranked, filter(ranked, r -> false), (acc, r) -> if(exists(acc, a -> a.i = r.i or a.d = r.d), acc, array_append(acc, r)))")
    aligned = compute_once(aligned, agreed=agreed)
    aligned = compute_once(aligned, minority=F.expr("transform(filter(slots, s -> not exists(agreed, a -> a.i = s.i and a.d = s.d)), s -> s.at)"))
    left = F.expr(f"filter(matching, p -> array_contains(verbatim, p) or not exists(minority, m -> m between p and p + {WINDOW - 1}))")
    aligned = compute_once(aligned, left=left)
    aligned = aligned.withColumn("slots", F.expr(f"filter(slots, s -> exists(left, p -> s.at between p and p + {WINDOW - 1}))"))

    held = aligned.groupBy("doc_id", "item_id", "variant").agg(
        F.max(F.size("itpl") - WINDOW + 1).cast("long").alias("n_windows"),
        F.size(F.array_distinct(F.flatten(F.collect_list("left")))).cast("long").alias("n_matched"),
        F.array_distinct(F.flatten(F.collect_list("slots"))).alias("slots"),
    )
    held = held.withColumn("similarity", F.col("n_matched") / F.col("n_windows")).where(F.col("similarity") >= similarity)
    changed = F.size(F.filter("slots", lambda s: s["i"] != s["d"])).cast("long")
    held = held.withColumn("n_changed", changed).withColumn("best", F.row_number().over(Window.partitionBy("doc_id", "item_id").orderBy(F.desc("similarity"), F.desc("n_matched"), "n_changed", "variant")))
    return held.where("best = 1").select(
        F.col("doc_id").alias(id_col),
        F.col("item_id").alias(item_col),
        "n_windows",
        "n_matched",
        "similarity",
        F.size("slots").cast("long").alias("n_slots"),
        "n_changed",
        F.when(F.col("n_changed") > 0, "reparameterised").otherwise("verbatim").alias("kind"),
    )


def without_leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """``docs`` without the documents that hold a benchmark item; rows with a null id are kept."""
    leaked = cut(find(docs, items, id_col=id_col, **options).select(F.col(id_col).alias("_leaked")).distinct())
    return docs.join(broadcast_if_bounded(leaked, 96), F.col(id_col) == F.col("_leaked"), "left_anti")
