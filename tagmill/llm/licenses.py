"""Licence scan by a positional index of rare template words, with DataFrame and SQL functions only.

Each template is indexed by its rarest words (inverse document frequency over all documents). All indexed words
of a file are looked up; a template and an offset stay where the postings of these words agree on the offset; and a hit counts once
the template's mandatory phrase stands at its place.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagmill.llm.common import literals, narrow
from tagmill.operators.once import compute_once

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: Phrases of the base scan and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

#: Index words of a template.
INDEXED = 4
#: Offsets that one template's votes have room for; an array of words has fewer places.
_SPAN = 1 << 32


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    phrase: str

    @property
    def words(self) -> list[str]:
        return self.text.split()

    @property
    def key(self) -> list[str]:
        return self.phrase.split()

    @property
    def key_at(self) -> int:
        n = len(self.key)
        return next(i for i in range(len(self.words)) if self.words[i : i + n] == self.key)


#: Opening words of well-known licences and notices; the phrase must stand in a hit word for word.
TEMPLATES = (
    Template("gpl", "licensed under the gnu general public license version", "gnu general public license"),
    Template("gpl", "you can redistribute it and or modify it under the terms of the gnu general public license", "redistribute it and or modify it"),
    Template("lgpl", "under the terms of the gnu lesser general public license as published by the free software foundation", "gnu lesser general public license"),
    Template("agpl", "under the terms of the gnu affero general public license as published by the free software foundation", "gnu affero general public license"),
    Template("apache", "licensed under the apache license version", "apache license version"),
    Template("apache", "you may not use this file except in compliance with the license", "except in compliance with the license"),
    Template("cc-by", "licensed under cc by", "cc by"),
    Template("cc-by", "licensed under a creative commons attribution", "creative commons attribution"),
    Template("cc-by-nc", "licensed under cc by nc", "cc by nc"),
    Template("cc0", "dedicated to the public domain under the creative commons zero", "creative commons zero"),
    Template("mit", "released under the mit license", "under the mit license"),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", "granted free of charge to any person obtaining"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "in source and binary forms"),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee", "for any purpose with or without fee"),
    Template("mpl", "subject to the terms of the mozilla public license", "mozilla public license"),
    Template("unlicense", "this is free and unencumbered software released into the public domain", "free and unencumbered software"),
)


def _words(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    # lower() differs from lower-casing A-Z only outside ASCII, where no phrase or template has a letter.
    text = F.lower(F.coalesce(F.col(f"`{text_col}`"), F.lit("")))
    base = narrow(docs, id_col, text_col).select(F.col(id_col).alias("id"), text.alias("body"))
    return compute_once(base, words=F.regexp_extract_all(F.col("body"), F.lit(f"({WORD})"), F.lit(1))).drop("body")


def document_frequencies(words: DataFrame, vocabulary: list[str]) -> tuple[dict[str, int], int]:
    """Number of documents that hold each word of the (constant, small) vocabulary, and the number of documents."""
    present = words.select(F.explode(F.concat(F.array_intersect("words", literals(vocabulary)), F.array(F.lit("")))).alias("word"))
    counts = {r["word"]: r["n"] for r in present.groupBy("word").agg(F.count("*").alias("n")).collect()}
    return counts, counts.pop("", 0)


def index_words(counts: dict[str, int]) -> list[list[tuple[str, int]]]:
    """For each template its rarest words with their positions there, rarest first, ties in alphabetical order."""
    found = []
    for t in TEMPLATES:
        rare = sorted(set(t.words), key=lambda w: (counts.get(w, 0), w))[:INDEXED]
        found.append([(w, i) for w in rare for i, x in enumerate(t.words) if x == w])
    return found


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    Null and empty texts have no words, no places (null first and last word), empty labels and score 0. ``score`` is the largest
    share of a verified template's words that stand in their places, and 1 for a base place. Whole texts are scanned, nothing is
    shuffled but the vocabulary's counts; repeated rows repeat; other columns are ignored.
    """
    words = _words(docs, id_col, text_col)
    vocabulary = sorted({w for t in TEMPLATES for w in t.words})
    counts, _ = document_frequencies(words, vocabulary)
    index = index_words(counts)
    indexed = sorted({w for entries in index for w, _ in entries}, key=lambda w: (counts.get(w, 0), w))
    starts = sorted({p.split()[0] for p in PHRASES})

    postings = {w: [(t, i) for t, entries in enumerate(index) for x, i in entries if x == w] for w in indexed}
    quoted = lambda xs: "array(" + ", ".join(f"'{x}'" for x in xs) + ")"  # noqa: E731  words are letters and digits only
    listed = ", ".join(f"'{w}', array({', '.join(f'named_struct("t", {t}, "p", {p})' for t, p in ps)})" for w, ps in postings.items())
    templates = ", ".join(f'named_struct("label", \'{t.label}\', "words", {quoted(t.words)}, "at", {t.key_at}, "phrase", {quoted(t.key)})' for t in TEMPLATES)
    phrase_at = " ".join(
        "when " + " and ".join(f"get(words, i + {j}) = '{w}'" if j else f"words[i] = '{w}'" for j, w in enumerate(p.split())) + f" then '{label}'" for p, label in PHRASES.items()
    )

    found = words.select("id", "words", F.arrays_overlap("words", literals(indexed)).alias("may_have_more"), F.arrays_overlap("words", literals(starts)).alias("may_have_base"))
    found = found.select(
        "id",
        "words",
        F.expr(f"if(may_have_base, filter(transform(sequence(0, size(words) - 1), i -> named_struct('at', i, 'label', case {phrase_at} end)), x -> x.label is not null), null)").alias("base"),
        "may_have_more",
    )
    # Where each indexed word stands, as votes for (template, offset); a pair is a candidate when two places agree on it. A vote is one
    # number, template first, and votes for one pair lie side by side once sorted, so that the work grows with the words and not with
    # their square, as comparing structs with each other would.
    found = compute_once(
        found,
        votes=F.expr(f"""if(may_have_more, sort_array(flatten(transform(filter(transform(sequence(0, size(words) - 1), i -> named_struct('w', words[i], 'i', i)), x -> x.w in ({', '.join(f"'{w}'" for w in indexed)})),
                   x -> transform(element_at(map({listed}), x.w), y -> y.t * {_SPAN}L + (x.i - y.p + {_SPAN // 2}L))))), null)"""),
    )
    found = compute_once(
        found,
        aligned=F.expr(f"""transform(filter(votes, (v, k) -> k > 0 and v = votes[k - 1] and (k = 1 or v <> votes[k - 2])),
                   v -> named_struct('t', cast(v div {_SPAN}L as int), 'o', cast(v % {_SPAN}L - {_SPAN // 2}L as int)))"""),
    )
    verified = f"""transform(filter(transform(aligned, c -> named_struct('o', c.o, 'm', element_at(array({templates}), c.t + 1))),
                   c -> c.o + c.m.at >= 0 and slice(words, c.o + c.m.at + 1, size(c.m.phrase)) = c.m.phrase),
                   c -> named_struct('label', c.m.label, 'share', size(filter(sequence(0, size(c.m.words) - 1), j -> c.o + j >= 0 and get(words, c.o + j) = c.m.words[j])) / size(c.m.words)))"""
    found = found.withColumn("hits", F.expr(f"if(coalesce(size(aligned), 0) > 0, {verified}, null)"))
    n_base = F.expr("coalesce(if(base is null, 0, size(base)), 0)").cast("long")
    labels = "array_sort(array_distinct(concat(coalesce(transform(base, x -> x.label), array()), coalesce(transform(hits, x -> x.label), array()))))"
    return found.select(
        F.col("id").alias(id_col),
        F.size("words").cast("long").alias("n_words"),
        n_base.alias("n_base"),
        F.expr("array_min(transform(base, x -> x.at))").cast("long").alias("first_word"),
        F.expr("array_max(transform(base, x -> x.at))").cast("long").alias("last_word"),
        F.expr("array_join(array_sort(array_distinct(coalesce(transform(base, x -> x.label), array()))), ',')").alias("base_labels"),
        F.expr(f"array_join({labels}, ',')").alias("labels"),
        F.greatest(F.when(n_base > 0, F.lit(1.0)).otherwise(F.lit(0.0)), F.expr("coalesce(array_max(transform(hits, x -> x.share)), 0D)")).alias("score"),
    )
