"""Token counts of a byte-level pair vocabulary by rank-synchronous merging over ragged arrays.

All pre-tokens of a batch that were not seen before lie end to end in one array of symbols. Each round looks up the rank of
every adjacent pair at once, takes each sequence's lowest rank, and merges all of its occurrences in all sequences
simultaneously; sequences without a mergeable pair leave with their number of symbols.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator
from functools import lru_cache
from heapq import heappop, heappush
from itertools import islice

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagmill.llm.common import narrow, text_or_empty, tokenizer_path

#: Fixed value: how the vocabulary's library cuts a text before merging (\\s there means Unicode white space).
PRE_TOKEN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)
#: Counts kept per worker before it starts afresh, and pre-tokens handled together: both bound memory, not results.
CACHE = 400_000
BLOCK = 200_000
#: Sequences beyond this many symbols are merged one at a time with a queue of ranks.
LONG = 4_096
SLOT_BITS = 20
NO_RANK = np.iinfo(np.int32).max


def byte_symbols() -> list[str]:
    """The printable stand-in of each byte: itself where it prints, else the next character from 256 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(spare)) for b in range(256)]


class Merger:
    """Counts the symbols that remain of pre-tokens after all merges."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocab = spec["model"]["vocab"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        left, right, made = (np.array(x, np.int64) for x in zip(*[(vocab[a], vocab[b], vocab[a + b]) for a, b in pairs]))
        keys = left << 32 | right
        self.table = dict(zip(keys.tolist(), zip(range(len(keys)), made.tolist())))
        # Two hashed tables of pairs: the second holds what found its slot in the first taken. Their factors are the first tried
        # that leave no pair over, so a lookup reads two slots at most.
        self.keys, self.ranks, self.made = np.r_[keys, -1], np.r_[np.arange(len(keys)), NO_RANK].astype(np.int32), np.r_[made, -1]
        for trial in range(1, 100):
            self.factors = [np.uint64(0x9E3779B97F4A7C15 + 2 * trial), np.uint64(0xC2B2AE3D27D4EB4F + 2 * trial)]
            self.slots, rest = [], np.arange(len(keys))
            for factor in self.factors:
                slots = np.full(1 << SLOT_BITS, len(keys), np.int32)
                place = self._slot(keys[rest], factor)
                slots[place] = rest
                rest = rest[slots[place] != rest]
                self.slots.append(slots)
            if not len(rest):
                break
        else:
            raise ValueError("no pair of factors places every merge")
        self.first = np.array([vocab[c] for c in byte_symbols()], np.int64)
        special = [regex.escape(t["content"]) for t in spec["added_tokens"]]
        self.special = regex.compile("|".join(special)) if special else None
        self.pieces = regex.compile(PRE_TOKEN)
        self.counts: dict[str, int] = {}

    @staticmethod
    def _slot(key: np.ndarray, factor: np.uint64) -> np.ndarray:
        return ((key.view(np.uint64) * factor) >> np.uint64(64 - SLOT_BITS)).view(np.int64)

    def lookup(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged symbol of each pair (NO_RANK where the pair never merges)."""
        key = left << 32 | right
        at = self.slots[0][self._slot(key, self.factors[0])]
        miss = np.flatnonzero(self.keys[at] != key)
        other = self.slots[1][self._slot(key[miss], self.factors[1])]
        at[miss] = np.where(self.keys[other] == key[miss], other, len(self.keys) - 1)
        return self.ranks[at], self.made[at]

    def merge_block(self, tokens: list[bytes]) -> np.ndarray:
        """Number of symbols left of each non-empty sequence."""
        sizes = np.array([len(t) for t in tokens], np.int64)
        symbols = self.first[np.frombuffer(b"".join(tokens), np.uint8)]
        owner = np.repeat(np.arange(len(tokens), dtype=np.int32), sizes)
        left = sizes.copy()
        rank, made = self.pair_ranks(symbols, owner, np.arange(len(symbols)))
        while True:
            start = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            least = np.repeat(np.minimum.reduceat(rank, start), np.diff(np.r_[start, len(rank)]))
            hit = (rank == least) & (rank < NO_RANK)
            # Occurrences overlap only in runs of one symbol; of such a run every other one merges, from its left end.
            at = np.flatnonzero(hit)
            if not len(at):
                return left
            order = np.arange(len(at))
            begins = np.r_[True, np.diff(at) > 1]
            at = at[(order - np.maximum.accumulate(np.where(begins, order, 0))) % 2 == 0]
            symbols[at] = made[at]
            left -= np.bincount(owner[at], minlength=len(left))
            stay = least < NO_RANK
            stay[at + 1] = False
            place = (np.cumsum(stay) - 1)[at]
            symbols, owner, rank, made = symbols[stay], owner[stay], rank[stay], made[stay]
            fresh = np.zeros(len(symbols), bool)
            fresh[place] = fresh[place - 1] = True
            changed = np.flatnonzero(fresh)
            rank[changed], made[changed] = self.pair_ranks(symbols, owner, changed)

    def pair_ranks(self, symbols: np.ndarray, owner: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranks and merged symbols of the pairs that begin at the given places; a sequence's last symbol begins none."""
        follow = np.minimum(at + 1, len(symbols) - 1)
        rank, made = self.lookup(symbols[at], symbols[follow])
        rank[(owner[at] != owner[follow]) | (follow == at)] = NO_RANK
        return rank, made

    def merge_long(self, token: bytes) -> int:
        """The same for one long sequence: ranks wait in a queue, all places of the lowest merge from left to right."""
        sym = self.first[np.frombuffer(token, np.uint8)]
        rank, _ = self.lookup(sym[:-1], sym[1:])
        queue = [(r, i) for i, r in enumerate(rank.tolist()) if r < NO_RANK]
        queue.sort()
        sym = sym.tolist()
        n, count = len(sym), len(sym)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while queue:
            r, i = heappop(queue)
            j = after[i] if sym[i] >= 0 else n
            if j >= n or (known := self.table.get(sym[i] << 32 | sym[j])) is None or known[0] != r:
                continue
            sym[i], sym[j] = known[1], -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            count -= 1
            for k in (before[i], i):
                if k >= 0 and after[k] < n and (found := self.table.get(sym[k] << 32 | sym[after[k]])):
                    heappush(queue, (found[0], k))
        return count

    def learn(self, fresh: list[str]) -> None:
        coded = [t.encode() for t in fresh]
        short = [i for i, t in enumerate(coded) if len(t) <= LONG]
        for at in range(0, len(short), BLOCK):
            part = short[at : at + BLOCK]
            for i, n in zip(part, self.merge_block([coded[i] for i in part]).tolist()):
                self.counts[fresh[i]] = n
        for t, c in zip(fresh, coded):
            if len(c) > LONG:
                self.counts[t] = self.merge_long(c)

    def _blocks(self, texts: Iterable[str]) -> Iterator[tuple[list[tuple[int, int]], list[str]]]:
        """Pre-tokens of consecutive texts, BLOCK or so at a time, with (text number, pre-tokens of it) in order."""
        owners: list[tuple[int, int]] = []
        block: list[str] = []
        for i, text in enumerate(texts):
            for part in self.special.split(text) if self.special is not None else [text]:
                found = iter(self.pieces.findall(part)) if len(part) < BLOCK else (m.group() for m in self.pieces.finditer(part))
                while True:
                    before = len(block)
                    block.extend(islice(found, BLOCK - before))
                    owners.append((i, len(block) - before))
                    if len(block) < BLOCK:
                        break
                    yield owners, block
                    owners, block = [], []
        yield owners, block

    def count(self, texts: list[str]) -> list[int]:
        """Number of tokens of each text."""
        totals = [len(self.special.findall(t)) if self.special is not None else 0 for t in texts]
        for owners, block in self._blocks(texts):
            fresh = {*block} - self.counts.keys()
            if len(self.counts) + len(fresh) > CACHE:
                self.counts.clear()
                fresh = {*block}
            self.learn(list(fresh))
            sizes = list(map(self.counts.__getitem__, block))
            at = 0
            for i, n in owners:
                totals[i] += sum(sizes[at : at + n])
                at += n
        return totals


@lru_cache(maxsize=2)
def merger(path: str) -> Merger:
    return Merger(path)


def token_counts(docs: DataFrame, vocabulary: str, limit: int = 512, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, n_bytes (UTF-8), n_tokens and over_limit.

    ``vocabulary`` is the path of a byte-level pair vocabulary that every executor can open. A special token's text counts
    as that one token. Null and empty texts have 0 tokens. Nothing is truncated: long texts are read in blocks of
    pre-tokens, and long pre-tokens are merged one by one. Repeated rows repeat in the result; other columns are ignored.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = merger(vocabulary)
        for batch in batches:
            yield pd.DataFrame({"id": batch["id"], "n_bytes": batch["n_bytes"], "n_tokens": model.count(batch["text"].tolist())})

    base = narrow(docs, id_col, text_col).select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    base = base.select("id", F.octet_length("text").cast("long").alias("n_bytes"), "text")
    kind = dict(base.dtypes)["id"]
    carried = base.withColumn("id", F.col("id").cast("string"))  # pandas would round long ids beside a null
    counted = carried.mapInPandas(run, "id string, n_bytes long, n_tokens long")
    return counted.select(F.col("id").cast(kind).alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


def default_vocabulary() -> str:
    return tokenizer_path("byte_bpe_50k.json")
