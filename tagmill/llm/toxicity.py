"""Toxicity scores from misspelling-tolerant lexicon hits in their contexts.

The lexicon holds insults, given ones and ones that the training labels show, as whole words or as stems, in a trie. Levenshtein
automata of its entries are intersected with the trie: a state is the set of trie nodes that a word read so far can have reached, with
the edits spent, and is made deterministic as words need it. Each hit is judged in a window of words around it, which separates quoting
from abuse; a logistic curve over the hits' weights by context gives the score.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import cached_property
from math import log, log1p

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagmill.llm.common import broadcast_if_bounded, narrow, text_or_empty
from tagmill.llm.quality import held_out

#: Bound of the labelled rows of each class that the lexicon and the curve are learned from (about; rows are chosen by a hash of their id).
FIT_ROWS = 8_000
#: Entries of the learned lexicon, and candidates it is chosen from.
LEXICON, CANDIDATES = 2_048, 1 << 16
#: A learned entry stands in so many toxic training texts at least (and in this share of them), this far beyond chance.
LEAST, SHARE, BEYOND, ODDS = 5, 0.002, 5.0, log(3)
#: Letters of stems that are counted.
STEM, LONGEST = 3, 10
#: Weight of a given entry that the labels say nothing about.
GIVEN = 2.0
WINDOW = 5
#: Characters of a text that are read at a time, which bounds memory for very long texts.
CHUNK = 1 << 20

# The given lexicon, words that report speech, words that address somebody, and look-alike characters.
INSULTS = """
asshole bastard bitch clown coward cretin cunt degenerate disgusting dickhead dumbass fool freak garbage halfwit idiot imbecile jackass
jerk loser lowlife maggot moron parasite pathetic pig retard scum scumbag sleazy slut stupid trash twat vermin whore wimp worthless
abschaum arschloch dummkopf hurensohn idiotisch missgeburt schlampe schwachkopf trottel versager wichser widerlich wertlos
abruti bouffon connard connasse cretine debile degoutant imbecile minable ordure pourriture salaud salope
asqueroso basura cabron canalla estupido gilipollas imbecil inutil malnacido pendejo puta repugnante
""".split()
REPORTING = frozenset("said says say called calls wrote writes quote quoted quotes word words term sagte sagt nannte schrieb wort dit disait appelle mot dijo dice llamó escribió palabra".split())
ADDRESSING = frozenset("you your youre you're ur u du dich dir dein deine bist ihr euch tu te toi ton ta vous votre tú ti eres vosotros usted".split())
LOOKALIKES = {"0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s"}

_TOKENS = re.compile(r"[^\W_]+(?:[@$'’]+[^\W_]+)*|[\"“”„«»]")
_QUOTES = frozenset('"“”„«»')

PLAIN, DIRECTED, QUOTED = 0, 1, 2
#: Features: exact hits plain, directed and quoted, misspelled ones likewise, and the heaviest unquoted one. The curve is drawn towards these slopes.
TOWARDS = np.array([1.5, 2.0, 0.2, 0.8, 1.2, 0.1, 0.5])


def allowance(letters: int, stem: bool) -> int:
    """Edits that an entry of so many letters tolerates."""
    if stem:
        return int(letters >= 7)
    return 0 if letters < 5 else 1 if letters < 9 else 2


class Trie:
    """The lexicon: children by letter, and the entry that ends at a node as a word or as a stem."""

    def __init__(self, entries: Iterable[tuple[str, bool, float]]) -> None:
        """``entries``: (text, whether it is a stem, weight)."""
        self.children: list[dict[str, int]] = [{}]
        self.words: list[tuple[int, float] | None] = [None]
        self.stems: list[tuple[int, float] | None] = [None]
        self.room = [0]
        for text, stem, weight in entries:
            room, node, path = allowance(len(text), stem), 0, [0]
            for letter in text:
                if letter not in self.children[node]:
                    self.children[node][letter] = len(self.children)
                    self.children.append({})
                    self.words.append(None)
                    self.stems.append(None)
                    self.room.append(0)
                node = self.children[node][letter]
                path.append(node)
            ends = self.stems if stem else self.words
            if ends[node] is None or ends[node][1] < weight:
                ends[node] = (room, weight)
            for n in path:
                self.room[n] = max(self.room[n], room)


class Automaton:
    """Levenshtein automata of all entries at once, intersected with their trie; deterministic states are made as words need them.

    An edit is a letter too many, a letter missing, another letter, or two neighbours swapped; the first letter has to be right.
    A look-alike character stands for its letter at no cost. ``find`` gives (edits, weight) of the entry that explains a word best.
    """

    STATES = 1 << 17

    def __init__(self, trie: Trie) -> None:
        self.trie = trie
        self._reset()

    def _reset(self) -> None:
        self.names: dict = {}
        self.steps: list[dict[str, int]] = []
        self.items: list[tuple] = []
        self.ends: list[tuple[int, float] | None] = []
        self.start = self._state({(0, 0, ""): None}.keys(), None)

    @staticmethod
    def _better(a: tuple[int, float] | None, b: tuple[int, float] | None) -> tuple[int, float] | None:
        if a is None or b is None:
            return a or b
        return max(a, b, key=lambda hit: (hit[1] * 0.5 ** hit[0], -hit[0]))

    def _state(self, reached: Iterable[tuple[int, int, str]], best: tuple[int, float] | None) -> int:
        """The state of these (node, edits, letter that a swap put off), missing letters added."""
        trie, todo, closed = self.trie, list(reached), set()
        while todo:
            item = todo.pop()
            if item in closed:
                continue
            closed.add(item)
            node, edits, late = item
            if not late and node and edits < trie.room[node]:
                todo += [(child, edits + 1, "") for child in trie.children[node].values() if edits + 1 <= trie.room[child]]
        for node, edits, late in closed:
            if not late and trie.stems[node] is not None and edits <= trie.stems[node][0]:
                best = self._better(best, (edits, trie.stems[node][1]))
        key = (frozenset(closed), best)
        if key not in self.names:
            end = best
            for node, edits, late in closed:
                if not late and trie.words[node] is not None and edits <= trie.words[node][0]:
                    end = self._better(end, (edits, trie.words[node][1]))
            self.names[key] = len(self.steps)
            self.steps.append({})
            self.items.append((tuple(closed), best))
            self.ends.append(end)
        return self.names[key]

    def _step(self, state: int, letter: str) -> int:
        trie, reached = self.trie, set()
        closed, best = self.items[state]
        for node, edits, late in closed:
            children = trie.children[node]
            if late:
                if letter in children and late in trie.children[children[letter]]:
                    reached.add((trie.children[children[letter]][late], edits, ""))
                continue
            for read in letter + LOOKALIKES.get(letter, ""):
                if read in children:
                    reached.add((children[read], edits, ""))
            if node and edits < trie.room[node]:
                reached.add((node, edits + 1, ""))
                reached.update((child, edits + 1, "") for child in children.values())
                if any(letter in trie.children[child] for child in children.values()):
                    reached.add((node, edits + 1, letter))
        # What no entry below tolerates is dropped, so most words end after a few letters.
        return self._state([i for i in reached if i[1] <= trie.room[i[0]]], best)

    def find(self, word: str) -> tuple[int, float] | None:
        if len(self.steps) > self.STATES:
            self._reset()
        state = self.start
        for letter in word:
            step = self.steps[state].get(letter)
            if step is None:
                step = self.steps[state][letter] = self._step(state, letter)
            state = step
            if not self.items[state][0]:
                break
        return self.ends[state]


def tokens(text: str) -> Iterator[list[str]]:
    """Words in small letters and quotation marks of a text, some at a time; a text is only parted at white space if it has any nearby."""
    at = 0
    while at < len(text):
        end = min(len(text), at + CHUNK)
        if end < len(text):
            gap = max(text.rfind(" ", at, end), text.rfind("\n", at, end))
            end = gap + 1 if gap > at else end
        yield _TOKENS.findall(text[at:end].lower())
        at = end


@dataclass
class Model:
    entries: list[tuple[str, bool, float]]
    slopes: np.ndarray = field(default_factory=lambda: TOWARDS.copy())
    intercept: float = -4.0

    @cached_property
    def automaton(self) -> Automaton:
        return Automaton(Trie(self.entries))

    def score(self, features: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(features @ self.slopes + self.intercept, -30, 30))))


class Reader:
    """Hits of texts; one per task, since it remembers words."""

    WORDS = 1 << 19

    def __init__(self, model: Model) -> None:
        self.machine, self.known = model.automaton, {}

    def hit(self, word: str) -> tuple[int, float] | None:
        got = self.known.get(word, 0)
        if got == 0:
            if len(self.known) > self.WORDS:
                self.known.clear()
            got = self.known[word] = self.machine.find(word)
        return got

    def hits(self, text: str | None) -> list[tuple[str, int, float, int]]:
        """(word, edits, weight, context) of each hit in order."""
        out, held = [], []
        chunks = list(tokens(text or "")) if len(text or "") <= CHUNK else tokens(text)
        first = 0
        for chunk in chunks:
            held += chunk
            out += self._judged(held, first, len(held) - WINDOW)
            first = max(first, len(held) - WINDOW)
            drop = max(0, first - WINDOW)
            held, first = held[drop:], first - drop
        return out + self._judged(held, first, len(held))

    def _judged(self, words: list[str], first: int, last: int) -> list[tuple[str, int, float, int]]:
        part = words[first:last] if last > first else []
        found = {w: h for w in set(part) if (h := self.hit(w)) is not None}
        if not found:
            return []
        return [(w, *found[w], context(words, first + i)) for i, w in enumerate(part) if w in found]


def features(hits: list[tuple[str, int, float, int]]) -> np.ndarray:
    """Logarithms of the summed weights by exactness and context, and the largest weight that is not quoted; an edit halves a weight."""
    sums, most = np.zeros(6), 0.0
    for _, edits, weight, where in hits:
        weight *= 0.5**edits
        sums[where + 3 * (edits > 0)] += weight
        most = most if where == QUOTED else max(most, weight)
    return np.r_[np.log1p(sums), most]


def context(words: list[str], at: int) -> int:
    """Whether the hit at a place is quoted, directed at somebody, or neither.

    Quoted: a quotation mark stands within the window on both sides, an odd number of them before, or a word that reports speech stands
    within the window before and no word that addresses somebody lies between.
    """
    before, after = words[max(0, at - WINDOW) : at], words[at + 1 : at + 1 + WINDOW]
    marks = sum(w in _QUOTES for w in before)
    if marks % 2 and any(w in _QUOTES for w in after):
        return QUOTED
    for w in reversed(before):
        if w in ADDRESSING:
            return DIRECTED
        if w in REPORTING:
            return QUOTED
    return DIRECTED if any(w in ADDRESSING for w in after) else PLAIN


def forms(text: str | None) -> set[str]:
    """The words of a text, each closed by a blank, and their stems."""
    words = {w for chunk in tokens(text or "") for w in chunk if STEM <= len(w) <= 40}
    return {w[:n] for w in words for n in range(STEM, min(len(w), LONGEST) + 1)} | {w + " " for w in words}


def _counted(rows: DataFrame, wanted: set[str] | None) -> DataFrame:
    """(form, n): texts that hold each form, or each of the wanted ones; summed inside each task first."""
    shared = rows.sparkSession.sparkContext.broadcast(wanted)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: Counter = Counter()
        for batch in batches:
            for text in batch["text"]:
                counts.update(forms(text) if shared.value is None else forms(text) & shared.value)
                if len(counts) > 1 << 20:
                    yield pd.DataFrame({"form": list(counts), "n": list(counts.values())})
                    counts.clear()
        yield pd.DataFrame({"form": list(counts), "n": list(counts.values())}).astype({"form": "str", "n": "int64"})

    return rows.select("text").mapInPandas(run, "form string, n long").groupBy("form").agg(F.sum("n").alias("n"))


def lexicon(toxic: dict[str, int], clean: dict[str, int], n1: int, n0: int) -> list[tuple[str, bool, float]]:
    """Entries from counts of forms in ``n1`` toxic and ``n0`` clean texts, together with the given ones.

    A form has to stand in toxic texts far beyond chance. Of forms that continue each other in nearly the same texts the longest is
    taken, so that a whole word is preferred to its stem; a longer form beside a taken stem must be clearly the more telling.
    """
    odds = lambda a, b: log((a + 0.5) / (n1 + 1)) - log((b + 0.5) / (n0 + 1))
    share = n1 / max(1, n1 + n0)
    passing = {}
    for form, a in toxic.items():
        b = clean.get(form, 0)
        chance = max(1e-9, (a + b) * share)
        if a >= max(LEAST, SHARE * n1) and (a - chance) / chance**0.5 >= BEYOND and odds(a, b) >= ODDS:
            passing[form] = odds(a, b)
    longer: dict[str, int] = {}
    for form, a in toxic.items():
        longer[form[:-1]] = max(longer.get(form[:-1], 0), a)
    kept = {f: w for f, w in passing.items() if f.endswith(" ") or longer.get(f, 0) < 0.95 * toxic[f]}
    out: dict[str, float] = {}
    for form in sorted(kept, key=lambda f: (len(f.strip()), f)):
        shorter = [out[form[:n]] for n in range(STEM, len(form.strip()) + (form[-1] == " ")) if form[:n] in out]
        if not shorter or kept[form] > max(shorter) + 0.5:
            out[form] = kept[form]
    best = sorted(out, key=lambda f: (-out[f] * log1p(toxic[f]), f))[:LEXICON]
    entries = {f: out[f] for f in best}
    for word in INSULTS:
        a, b = toxic.get(word + " ", 0), clean.get(word + " ", 0)
        weight = (2 * GIVEN + (a + b) * odds(a, b)) / (2 + a + b)
        if weight > 0.3:
            entries.setdefault(word + " ", weight)
    return [(f.strip(), not f.endswith(" "), float(w)) for f, w in sorted(entries.items())]


def fit_curve(x: np.ndarray, y: np.ndarray, rounds: int = 50, pull: float = 1.0) -> tuple[np.ndarray, float]:
    """Logistic slopes, drawn towards TOWARDS and never negative, and the intercept, by Newton steps."""
    a = np.c_[x, np.ones(len(x))]
    towards, strength = np.r_[TOWARDS, -4.0], np.r_[np.full(len(TOWARDS), pull), 0.05]
    beta = towards.copy()
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a @ beta, -30, 30)))
        hessian = a.T @ (a * (p * (1 - p))[:, None]) + np.diag(strength)
        step = np.clip(np.linalg.solve(hessian, a.T @ (y - p) - strength * (beta - towards)), -2, 2)
        beta = beta + step
        beta[:-1] = np.maximum(beta[:-1], 0)
        if np.abs(step).max() < 1e-8:
            break
    return beta[:-1], float(beta[-1])


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", fit_rows: int = FIT_ROWS) -> Model:
    """A model of ``label_col`` (1 toxic, 0 not) from rows whose id is labelled and not held out, ``fit_rows`` a class at most (about).

    Three quarters of them show the lexicon, the others draw the curve. Null ids, null labels and labels other than 0 and 1 are ignored;
    an id labelled twice takes the higher label; null texts are empty. Without rows of both classes the given lexicon scores alone.
    """
    marks = narrow(labels, id_col, label_col).select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").cast("int").alias("label"))
    marks = marks.where("id is not null and label in (0, 1)").where(~held_out(F.col("id"))).groupBy("id").agg(F.max("label").alias("label"))
    sizes = {r["label"]: r["n"] for r in marks.groupBy("label").agg(F.count("*").alias("n")).collect()}
    n1, n0 = sizes.get(1, 0), sizes.get(0, 0)
    if not n1 or not n0:
        return Model(lexicon({}, {}, 0, 0))
    draw = F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < F.when(F.col("label") == 1, F.lit(fit_rows / n1)).otherwise(fit_rows / n0) * (1 << 20)
    texts = narrow(docs, id_col, text_col).select(F.col(f"`{id_col}`").alias("id"), text_or_empty(text_col).alias("text"))
    rows = texts.join(broadcast_if_bounded(marks.where(draw), 32), "id").withColumn("fold", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(4)))
    shown, drawn = rows.where("fold > 0"), rows.where("fold = 0")
    held = {r["label"]: r["n"] for r in shown.groupBy("label").agg(F.count("*").alias("n")).collect()}
    least = max(LEAST, SHARE * held.get(1, 0))
    often = _counted(shown.where("label = 1"), None).where(F.col("n") >= least).orderBy(F.desc("n"), "form").limit(CANDIDATES)
    toxic = {r["form"]: r["n"] for r in often.collect()}
    clean = {r["form"]: r["n"] for r in _counted(shown.where("label = 0"), set(toxic) | {w + " " for w in INSULTS}).collect()}
    model = Model(lexicon(toxic, clean, held.get(1, 0), held.get(0, 0)))
    found = _features(drawn, model, "id", "label").toPandas()  # a few numbers of each of the bounded sample's rows
    if not len(found):
        return model
    x, y = np.stack(found["features"].to_list()), found["label"].to_numpy(float)
    order = np.lexsort((*x.T, y, found["id"].to_numpy()))  # whatever order the rows came in
    slopes, intercept = fit_curve(x[order], y[order])
    if 0 < y.sum() < len(y):  # the sample's classes are not as frequent as all labelled rows'
        intercept += log(n1 / n0) - log(y.sum() / (len(y) - y.sum()))
    return Model(model.entries, slopes, intercept)


def _features(rows: DataFrame, model: Model, *columns: str) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast((model.entries,))

    @F.pandas_udf("array<double>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        reader = Reader(Model(shared.value[0]))
        for batch in batches:
            yield pd.Series([features(reader.hits(t)) for t in batch])

    return rows.select(*columns, run("text").alias("features"))


def score(docs: DataFrame, model: Model, threshold: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, toxicity in [0, 1], n_hits, n_misspelled, n_quoted, toxic) of every row, whole texts read.

    Null texts are empty; an empty text has the score of one without hits; rows with null or repeated ids are scored each by itself;
    an empty table stays empty; other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model.entries, model.slopes, model.intercept))

    @F.pandas_udf("score double, hits long, misspelled long, quoted long")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        found = Model(*shared.value)
        reader = Reader(found)
        for batch in batches:
            rows = []
            for text in batch:
                hits = reader.hits(text)
                rows.append((found.score(features(hits)), len(hits), sum(h[1] > 0 for h in hits), sum(h[3] == QUOTED for h in hits)))
            yield pd.DataFrame(rows, columns=["score", "hits", "misspelled", "quoted"]).astype({"score": "float64", "hits": "int64", "misspelled": "int64", "quoted": "int64"})

    read = narrow(docs, id_col, text_col).select(F.col(f"`{id_col}`"), run(text_or_empty(text_col)).alias("r"))
    return read.select(
        F.col(f"`{id_col}`"),
        F.col("r.score").alias("toxicity"),
        F.col("r.hits").alias("n_hits"),
        F.col("r.misspelled").alias("n_misspelled"),
        F.col("r.quoted").alias("n_quoted"),
        (F.col("r.score") >= threshold).cast("int").alias("toxic"),
    )


def levenshtein(a: str, b: str) -> int:
    """Edits between two words, swaps of neighbours counted as one (each letter edited once)."""
    rows = [list(range(len(b) + 1))]
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            least = min(rows[-1][j] + 1, row[-1] + 1, rows[-1][j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                least = min(least, rows[-2][j - 2] + 1)
            row.append(least)
        rows.append(row)
    return rows[-1][-1]
