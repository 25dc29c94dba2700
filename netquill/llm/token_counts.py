"""Operator 4, token counts by rank-synchronous array merging.

A text is split at the vocabulary's special strings (one token each) and then into pre-tokens by the
vocabulary's pattern. Pre-tokens not met before are merged together: their symbols are one ragged
numpy array, and each step takes, in every sequence, the adjacent pair of lowest rank and merges all
its occurrences at once, until no sequence has a pair left; the surviving symbols are the tokens.
A pair made of a merged symbol always ranks after the pair that made the symbol, so merging all
occurrences of the lowest pair at once gives what merging them one by one gives.

Defined results for odd input: a null or empty text has no bytes and no tokens; texts are read whole;
columns named like an output are replaced; an empty table gives an empty table. There is no shuffle.
"""

from __future__ import annotations

import json
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from netquill.llm.common import append_columns, binaries, table

VOCABULARY = "byte_bpe_50k.json"
LIMIT = 1024
#: counts kept for pre-tokens met before, in each worker; beyond it the cache starts anew
CACHE_ENTRIES, CACHE_TOKEN_BYTES = 400_000, 64
#: white space as the pattern's engine has it (Unicode White_Space)
SPACE = r"\t-\r \x85\xa0  -     　"
PATTERN = (
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
)


def byte_symbols() -> dict[str, int]:
    """The printable stand-in of each byte in a byte-level vocabulary."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + k): b for k, b in enumerate(rest)}


class MergeCounter:
    """Counts the tokens of texts under a byte-level BPE vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        special = [t["content"] for t in spec["added_tokens"]]
        self.special = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True)))) if special else None
        self.pattern = regex.compile(PATTERN)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        merges = [m if isinstance(m, list) else m.split(" ") for m in merges]
        self.first = np.zeros(256, np.int64)
        for symbol, byte in byte_symbols().items():
            self.first[byte] = vocab[symbol]
        left = np.array([vocab[a] for a, _ in merges], np.int64)
        right = np.array([vocab[b] for _, b in merges], np.int64)
        made = np.array([vocab[a + b] for a, b in merges], np.int64)
        order = np.argsort(left << 32 | right, kind="stable")
        self.keys, self.rank, self.made = (left << 32 | right)[order], order, made[order]
        self.none = len(merges)
        self.cache: dict[str, int] = {}

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of each pair (``none`` if it does not merge) and its place in the merge table."""
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.rank[at], self.none), at

    def merge(self, tokens: list[bytes]) -> np.ndarray:
        """Number of symbols that survive in each pre-token."""
        sizes = np.array([len(t) for t in tokens], np.int64)
        out = sizes.copy()
        symbols = self.first[np.frombuffer(b"".join(tokens), np.uint8)]
        seq = np.repeat(np.arange(len(tokens)), sizes)
        while len(symbols) > 1:
            rank, at = self._ranks(symbols[:-1], symbols[1:])
            rank = np.where(seq[:-1] == seq[1:], rank, self.none)
            starts = np.flatnonzero(np.concatenate(([True], seq[1:] != seq[:-1])))
            low = np.minimum.reduceat(np.append(rank, self.none), starts)
            index = np.cumsum(np.concatenate(([0], seq[1:] != seq[:-1])))
            live = low < self.none
            if not live.any():
                break
            hit = (rank == low[index[:-1]]) & (rank < self.none)
            # of overlapping occurrences (a run of one symbol) every second merges
            where = np.flatnonzero(hit)
            run = np.concatenate(([True], np.diff(where) != 1))
            head = np.maximum.accumulate(np.where(run, np.arange(len(where)), 0))
            where = where[(np.arange(len(where)) - head) % 2 == 0]
            symbols = symbols.copy()
            symbols[where] = self.made[at[where]]
            keep = np.ones(len(symbols), bool)
            keep[where + 1] = False
            np.subtract.at(out, seq[where], 1)
            keep &= live[index]  # finished sequences leave
            symbols, seq = symbols[keep], seq[keep]
        return out

    def _learn(self, tokens: set[str]) -> dict[str, int]:
        new = list(tokens)
        counts = self.merge([t.encode() for t in new]).tolist() if new else []
        return dict(zip(new, counts))

    def count(self, texts: list[str], chars: int = 1 << 18) -> list[int]:
        """Number of tokens of each text; the unseen pre-tokens of many texts are merged at once."""
        out: list[int] = []
        at = 0
        while at < len(texts):
            end, size = at, 0
            while end < len(texts) and (end == at or size + len(texts[end]) <= chars):
                size += len(texts[end])
                end += 1
            counters, specials = [], []
            for text in texts[at:end]:
                parts = self.special.split(text) if self.special else [text]
                found: Counter = Counter()
                for part in parts:
                    found.update(self.pattern.findall(part))
                counters.append(found)
                specials.append(len(parts) - 1)
            if len(self.cache) > CACHE_ENTRIES:
                self.cache.clear()
            learnt = self._learn({t for c in counters for t in c if t not in self.cache})
            known = self.cache
            for c, s in zip(counters, specials):
                out.append(s + sum(n * (known[t] if t in known else learnt[t]) for t, n in c.items()))
            known.update((t, n) for t, n in learnt.items() if len(t) <= CACHE_TOKEN_BYTES)
            at = end
        return out


_counters: dict[str, MergeCounter] = {}


def counter(path: str) -> MergeCounter:
    """One for each worker and file."""
    if path not in _counters:
        _counters[path] = MergeCounter(path)
    return _counters[path]


def count_tokens(docs: DataFrame, vocabulary: str = VOCABULARY, limit: int = LIMIT) -> DataFrame:
    """``docs`` with n_bytes, n_tokens and over_limit."""

    def make(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        texts = binaries(batch, "text")
        tokens = counter(public_tokenizers.path(vocabulary)).count([t.decode("utf-8", "replace") for t in texts])
        return {
            "n_bytes": pa.array([len(t) for t in texts], pa.int64()),
            "n_tokens": pa.array(tokens, pa.int64()),
            "over_limit": pa.array([n > limit for n in tokens], pa.bool_()),
        }

    fields = [
        T.StructField("n_bytes", T.LongType()),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("over_limit", T.BooleanType()),
    ]
    return append_columns(docs, make, fields)


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return count_tokens(docs).select("doc_id", "n_bytes", "n_tokens", "over_limit")
