"""Personal data by weak supervision.

Wide patterns propose spans. Labelers of three sorts vote on each (1 for, -1 against, 0 abstains): regular expressions that
check form, gazetteers of known parts, and words of the context. Expectation-maximisation over the counted vote patterns
estimates how reliable each labeler is and gives every pattern a probability; a logistic span classifier is trained on these
probabilities and decides. Spans that match a kind's base pattern and its checks are always kept.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagmill.llm.common import bounded_batches, narrow, text_or_empty

KINDS = ("email", "ip", "card", "phone")

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_CHAIN = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")

# Wider forms that only candidates use: spelled-out addresses, numbers in other groupings.
_SPELLED = re.compile(r"(?<![\w.])([A-Za-z0-9._%+-]{1,64}) ?(?:\(at\)|\[at\]|\{at\}| at ) ?([A-Za-z0-9-]{1,63}(?: ?(?:\(dot\)|\[dot\]|\{dot\}| dot ) ?[A-Za-z0-9-]{1,63}){1,4})(?!\w)", re.I)
_NATIONAL = re.compile(r"(?<![\w+])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![\w-])")
_SPACED_IP = re.compile(r"(?<![\w.])[0-9]{1,3}(?: ?\. ?[0-9]{1,3}){3}(?![\w.])")
_GROUPED = re.compile(r"(?<![\w.-])[0-9]{4}(?:[ ./_-]{1,2}[0-9]{4}){3}(?![\w.-])")

# Gazetteers.
_DOMAINS = {"com", "org", "net", "edu", "gov", "info", "de", "fr", "es", "uk", "eu", "io", "it", "nl", "ch", "at", "be", "us"}
_ISSUERS = ("34", "35", "36", "37", "4", "51", "52", "53", "54", "55", "2", "60", "62", "64", "65")
_DIALLING = ("1", "2", "30", "31", "32", "33", "34", "35", "36", "39", "40", "41", "42", "43", "44", "45", "46", "47", "48", "49", "5", "6", "7", "81", "82", "84", "86", "9")

_CUES = {
    "email": ("mail", "contact", "write", "correo", "courriel"),
    "ip": ("ip", "host", "server", "address", "login", "adresse"),
    "card": ("card", "visa", "credit", "karte", "carte", "tarjeta", "pay"),
    "phone": ("phone", "tel", "call", "fax", "mobile", "telefon", "cell"),
}
_AGAINST = ("version", "isbn", "order", "total", "item", "section", "figure", "serial", "invoice")
CONTEXT = 40
CUT_OFF = 0.5
Span = tuple[str, int, int, bool]


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(_DIGIT.findall(text))


def base_spans(text: str) -> list[Span]:
    """Spans of the base patterns that pass their checks, by kind as listed, then start. Linear in the text's length."""
    found: list[Span] = []
    last = 0
    at = text.find("@")
    while at >= 0:  # the match begins where the run of local characters before the sign does, but not inside the last match
        start = at
        while start > last and _LOCAL.match(text, start - 1):
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            found.append(("email", start, domain.end(), True))
            last = domain.end()
            at = text.find("@", last)
        else:
            last = at + 1
            at = text.find("@", at + 1)
    if not _DIGIT.search(text):
        return found
    for m in _CHAIN.finditer(text):
        if m.group().count(".") >= 3:
            parts, place = m.group().split("."), m.start()
            for i in range(0, len(parts) - 3, 4):
                size = sum(map(len, parts[i : i + 4])) + 3
                if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in parts[i : i + 4]):
                    found.append(("ip", place, place + size, True))
                place += size + 1
    for m in _CARD.finditer(text):
        digits = _digits(m.group())
        if 13 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", *m.span(), True))
    if "+" in text:
        found += [("phone", *m.span(), True) for m in _PHONE.finditer(text) if 9 <= len(_digits(m.group())) <= 15]
    return found


def candidates(text: str) -> list[Span]:
    """Base spans, and spans of the wider forms that overlap no base span and no earlier candidate."""
    spans = base_spans(text)
    wide: list[Span] = []
    lowered = text.lower() if "at" in text or "AT" in text else ""
    if "dot" in lowered:
        wide += [("email", *m.span(), False) for m in _SPELLED.finditer(text)]
    if _DIGIT.search(text):
        for kind, pattern in (("ip", _SPACED_IP), ("card", _GROUPED), ("phone", _NATIONAL)):
            wide += [(kind, *m.span(), False) for m in pattern.finditer(text)]
    if not wide:
        return spans
    marked, kept = sorted((s, e) for _, s, e, _ in spans), []
    starts = np.array([s for s, _ in marked], np.int64)
    reach = np.maximum.accumulate([e for _, e in marked]) if marked else np.array([], np.int64)
    end = 0
    for kind, s, e, _ in sorted(wide, key=lambda x: (x[1], -x[2], KINDS.index(x[0]))):
        before = np.searchsorted(starts, e)
        if s >= end and not (before and reach[before - 1] > s):
            kept.append((kind, s, e, False))
            end = e
    return sorted(spans + kept, key=lambda x: (KINDS.index(x[0]), x[1]))


def votes(text: str, span: Span) -> tuple[int, ...]:
    """Votes on a span: base pattern, form, gazetteer, words before, words against."""
    kind, start, end, base = span
    inside, digits = text[start:end], _digits(text[start:end])
    if kind == "email":
        tail = re.split(r"[^A-Za-z0-9]+", inside.rstrip(")]} "))[-1].lower()
        form, known = (1 if len(inside) <= 254 else -1), (1 if tail in _DOMAINS else -1)
    elif kind == "ip":
        parts = [int(p[-9:]) for p in re.findall(r"[0-9]+", inside)]
        form, known = (1 if all(p <= 255 for p in parts) else -1), (1 if parts and 0 < parts[0] < 240 else -1)
    elif kind == "card":
        form, known = (1 if luhn(digits) else -1), (1 if digits.startswith(_ISSUERS) else -1)
    else:
        form = 1 if 9 <= len(digits) <= 15 else -1
        known = 1 if (digits.startswith(_DIALLING) if base else digits[0] > "1" and digits[3] > "1") else -1
    near = set(re.findall(r"[^\W\d_]+", text[max(0, start - CONTEXT) : start].lower()))
    cue = 1 if near & set(_CUES[kind]) else 0
    return (1 if base else 0, form, known, cue, -1 if near & set(_AGAINST) else 0)


def features(text: str, span: Span) -> tuple[int, ...]:
    """What the final classifier sees besides the votes: neighbours and separators of the span, none of them the labelers'."""
    kind, start, end, _ = span
    before, after, inside = text[start - 1 : start], text[end : end + 1], text[start:end]
    return (int(before.isalnum()), int(after.isalnum()), int(" " in inside), int(len({c for c in inside if not c.isalnum()}) > 1))


Pattern = tuple[str, tuple[int, ...], tuple[int, ...]]


def estimate(counts: dict[tuple[int, ...], int], rounds: int = 100, smoothing: float = 1.0) -> dict[tuple[int, ...], float]:
    """Probability that a vote pattern of one kind marks personal data, by expectation-maximisation.

    Each labeler has a table of vote probabilities for either class, independent given the class. The first guess follows the
    majority of votes, which also settles which class is which.
    """
    patterns = list(counts)
    v = np.array(patterns) + 1
    n = np.array([counts[p] for p in patterns], float)
    q = 1 / (1 + np.exp(-1.5 * (v - 1).sum(1)))
    for _ in range(rounds):
        log = np.zeros((2, len(patterns)))
        for c, weight in enumerate((n * (1 - q), n * q)):
            log[c] = np.log((weight.sum() + smoothing) / (n.sum() + 2 * smoothing))
            for j in range(v.shape[1]):
                table = np.bincount(v[:, j], weights=weight, minlength=3) + smoothing
                log[c] += np.log(table / table.sum())[v[:, j]]
        new = 1 / (1 + np.exp(np.clip(log[0] - log[1], -50, 50)))
        if np.abs(new - q).max() < 1e-6:
            break
        q = new
    return dict(zip(patterns, new.tolist()))


def _vector(pattern: Pattern) -> list[float]:
    kind, vote, feature = pattern
    return [1.0, *[float(kind == k) for k in KINDS[1:]], *map(float, vote), *map(float, feature)]


def train(counts: dict[Pattern, int], rounds: int = 50, ridge: float = 1.0) -> dict[Pattern, float]:
    """The classifier's probability for every counted pattern: logistic regression on the estimated soft labels."""
    if not counts:
        return {}
    by_kind: dict[str, Counter] = defaultdict(Counter)
    for (kind, vote, _), n in counts.items():
        by_kind[kind][vote] += n
    soft = {kind: estimate(c) for kind, c in by_kind.items()}
    patterns = sorted(counts)
    x = np.array([_vector(p) for p in patterns])
    y = np.array([soft[p[0]][p[1]] for p in patterns])
    n = np.sqrt([counts[p] for p in patterns])  # tempered, so that a few frequent patterns do not decide alone
    beta = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        hessian = x.T @ (x * (n * p * (1 - p))[:, None]) + ridge * np.eye(x.shape[1])
        step = np.linalg.solve(hessian, x.T @ (n * (y - p)) - ridge * beta)
        beta += np.clip(step, -3, 3)
        if np.abs(step).max() < 1e-8:
            break
    return dict(zip(patterns, (1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))).tolist()))


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return narrow(docs, id_col, text_col).select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))


def learn(docs: DataFrame, text_col: str = "text") -> dict[Pattern, float]:
    """Train on all documents. Only counts of patterns reach the driver; there are at most a few thousand patterns."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: Counter = Counter()
        for batch in batches:
            for text in batch["text"]:
                seen.update((s[0], votes(text, s), features(text, s)) for s in candidates(text))
        if seen:
            yield pd.DataFrame({"kind": [p[0] for p in seen], "vote": [list(p[1]) for p in seen], "feature": [list(p[2]) for p in seen], "n": list(seen.values())})

    bounded_batches(docs.sparkSession)
    parts = docs.select(text_or_empty(text_col).alias("text")).mapInPandas(run, "kind string, vote array<int>, feature array<int>, n long")
    rows = parts.groupBy("kind", "vote", "feature").agg(F.sum("n").alias("n")).collect()
    return train({(r["kind"], tuple(r["vote"]), tuple(r["feature"])): r["n"] for r in rows})


def decide(text: str, model: dict[Pattern, float]) -> list[Span]:
    """The spans of a text that are kept."""
    return [s for s in candidates(text) if s[3] or model.get((s[0], votes(text, s), features(text, s)), 0.0) >= CUT_OFF]


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e, _ in spans)


def find(docs: DataFrame, model: dict[Pattern, float], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, base counts n_<kind>, base_sha256 over the base spans, and all spans.

    Positions are code points, ends exclusive. Null and empty texts have no spans (and the hash of an empty string). Texts are
    scanned whole. Repeated rows repeat; other columns are ignored; an empty table gives an empty result.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = {"id": batch["id"], **{f"n_{k}": [] for k in KINDS}, "base_sha256": [], "spans": []}
            for text in batch["text"]:
                spans = decide(text, model)
                base = [s for s in spans if s[3]]
                count = Counter(s[0] for s in base)
                for k in KINDS:
                    out[f"n_{k}"].append(count[k])
                out["base_sha256"].append(sha256(joined(base).encode()).hexdigest())
                out["spans"].append(joined(spans))
            yield pd.DataFrame(out)

    bounded_batches(docs.sparkSession)
    base = _texts(docs, id_col, text_col)
    kind = dict(base.dtypes)["id"]
    carried = base.withColumn("id", F.col("id").cast("string"))  # pandas would round long ids beside a null
    found = carried.mapInPandas(run, f"id string, {', '.join(f'n_{k} long' for k in KINDS)}, base_sha256 string, spans string")
    return found.select(F.col("id").cast(kind).alias(id_col), *found.columns[1:])


def mask(text: str, spans: list[Span]) -> str:
    """The text with every span replaced by its kind in angle brackets; overlapping spans become one, named by the first."""
    out, end = [], 0
    for kind, s, e, _ in sorted(spans, key=lambda x: (x[1], -x[2])):
        if s >= end:
            out += [text[end:s], f"<{kind}>"]
        end = max(end, e)
    return "".join([*out, text[end:]])


def masked(docs: DataFrame, model: dict[Pattern, float], text_col: str = "text") -> DataFrame:
    """``docs`` with the spans of its texts masked; nulls stay null, other columns are kept as they are."""

    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([t if t is None else mask(t, decide(t, model)) for t in texts], dtype=object)

    bounded_batches(docs.sparkSession)
    return docs.withColumn(text_col, run(F.col(f"`{text_col}`")))
