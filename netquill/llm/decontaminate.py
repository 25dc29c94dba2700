"""Operator 10, benchmark decontamination: one Aho-Corasick automaton over the normalised benchmark
items, run once over each text, with hits mapped back to the original bytes.

Words are runs of digits, letters a-z (A-Z in lower case) and non-ASCII bytes. A pattern is a window
of ``width`` consecutive item words, or a whole shorter item, between single spaces; a text is
normalised the same way, so a hit of the automaton is a hit on whole words.

The automaton holds the benchmark, never the corpus. Its patterns are measured first; if they exceed
``max_pattern_bytes``, they are split into blocks of about that size by a hash of the item, and the
texts are scanned once for each block. The result of a block is written before the next one starts, so
the driver and a worker hold one block's patterns at a time, whatever the size of the benchmark.

Defined results for odd input: a null or wordless text has no words and no hits; benchmark rows with a
null item_id or without words are ignored; repeated items count once, equal items under two ids count as two; columns named like an output are
replaced; an empty benchmark marks nothing; an empty table gives an empty table. No shuffle is needed.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from netquill.llm.common import append_columns, binaries, discard, table, without, written

WIDTH = 10
MAX_PATTERN_BYTES = 4 << 20

#: A-Z in lower case; every other ASCII byte that is no word byte becomes a space
NORMAL = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20
    for b in range(256)
)
_automata: dict[str, ahocorasick.Automaton] = {}


def item_words(text: bytes) -> list[bytes]:
    return text.translate(NORMAL).split()


def patterns(benchmark: DataFrame, width: int) -> DataFrame:
    """(item_id, pattern): the distinct windows of each item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, out = [], []
            for item, text in zip(batch.column("item_id").to_pylist(), binaries(batch, "text")):
                words = item_words(text)
                n = len(words) - width + 1 if len(words) >= width else min(len(words), 1)
                for w in {b" ".join(words[i : i + width]) for i in range(n)}:
                    ids.append(item)
                    out.append(w)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.string()), pa.array(out, pa.binary())], ["item_id", "pattern"]
            )

    part = benchmark.filter("item_id is not null and text is not null").select(
        F.col("item_id").cast("string").alias("item_id"), "text"
    )
    return part.mapInArrow(run, "item_id string, pattern binary")


def _automaton(name: str, found: list[tuple[str, bytes]]) -> ahocorasick.Automaton:
    """Built once in each Python worker; ``name`` tells one list of patterns from another."""
    if name not in _automata:
        _automata.clear()
        items: dict[bytes, list[str]] = {}
        for item, pattern in found:
            items.setdefault(pattern, []).append(item)
        made = ahocorasick.Automaton()
        for pattern, own in items.items():
            made.add_word(f" {pattern.decode('latin-1')} ", (pattern.count(b" ") + 1, tuple(own)))
        made.make_automaton()
        _automata[name] = made
    return _automata[name]


def _scan(text: bytes, automaton: ahocorasick.Automaton) -> tuple[int, list[int], set[str]]:
    """Number of words, the hit words (flat word indices: start, end) and the items met."""
    words = item_words(text)
    if not words:
        return 0, [], set()
    line = b" " + b" ".join(words) + b" "
    ends, sizes, items = [], [], set()
    for end, (size, own) in automaton.iter(line.decode("latin-1")):
        ends.append(end)
        sizes.append(size)
        items.update(own)
    if not ends:
        return len(words), [], items
    # the space at a hit's end closes its last word: spaces before it count the words
    spaces = np.flatnonzero(np.frombuffer(line, np.uint8) == 0x20)
    stop = np.searchsorted(spaces, ends)
    edges = np.zeros(len(words) + 1, np.int64)
    np.add.at(edges, stop - np.array(sizes), 1)
    np.add.at(edges, stop, -1)
    hit = np.concatenate(([False], np.cumsum(edges[:-1]) > 0, [False]))
    turns = np.flatnonzero(hit[1:] != hit[:-1])
    return len(words), turns.tolist(), items


def _merged(spans: list[int]) -> list[int]:
    out: list[int] = []
    for a, b in sorted(zip(spans[::2], spans[1::2])):
        if out and a <= out[-1]:
            out[-1] = max(out[-1], b)
        else:
            out += [a, b]
    return out


def byte_spans(text: bytes, words: list[int]) -> list[int]:
    """Byte offsets in the original text of flat word ranges."""
    if not words:
        return []
    plain = np.frombuffer(text.translate(NORMAL), np.uint8) != 0x20
    edge = np.diff(np.concatenate(([0], plain.astype(np.int8), [0])))
    begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    return [int(begin[w] if k % 2 == 0 else end[w - 1]) for k, w in enumerate(words)]


def find_contamination(
    docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, max_pattern_bytes: int = MAX_PATTERN_BYTES
) -> DataFrame:
    """``docs`` with n_words, n_hit, hit_items (sorted item ids) and hit_spans (flat byte starts and
    ends in the original text)."""
    docs = without(docs, {"n_words", "n_hit", "hit_items", "hit_spans", "__words"})
    known = patterns(benchmark, width)
    total = known.agg(F.sum(F.length("pattern") + F.length("item_id"))).first()[0] or 0
    blocks = max(1, -(-total // max_pattern_bytes))
    fields = [
        T.StructField("n_words", T.LongType()),
        T.StructField("hit_items", T.ArrayType(T.StringType())),
        T.StructField("__words", T.ArrayType(T.LongType())),
    ]
    out, last = docs, None
    for block in range(blocks):
        own = known if blocks == 1 else known.filter(F.pmod(F.xxhash64("item_id", "pattern"), F.lit(blocks)) == block)
        found = sorted((r.item_id, bytes(r.pattern)) for r in own.collect())

        name = sha256(repr(found).encode()).hexdigest()

        def make(batch: pa.RecordBatch, found: list = found, name: str = name, first: bool = block == 0) -> dict[str, pa.Array]:
            automaton = _automaton(name, found) if found else None
            n, items, words = [], [], []
            before = [None] * batch.num_rows if first else list(
                zip(batch.column("hit_items").to_pylist(), batch.column("__words").to_pylist())
            )
            for text, old in zip(binaries(batch, "text"), before):
                count, hit, own_ = _scan(text, automaton) if automaton else (len(item_words(text)), [], set())
                if old:
                    hit, own_ = _merged(hit + old[1]), own_ | set(old[0])
                n.append(count)
                items.append(sorted(own_))
                words.append(hit)
            return {
                "n_words": pa.array(n, pa.int64()),
                "hit_items": pa.array(items, pa.list_(pa.string())),
                "__words": pa.array(words, pa.list_(pa.int64())),
            }

        out = append_columns(out, make, fields)
        if block < blocks - 1:
            out = written(out, "contamination_hits")
            if last is not None:
                discard(last)
            last = out

    def finish(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        words = batch.column("__words").to_pylist()
        return {
            "n_hit": pa.array([sum(w[1::2]) - sum(w[::2]) for w in words], pa.int64()),
            "hit_spans": pa.array(
                [byte_spans(t, w) if w else [] for t, w in zip(binaries(batch, "text"), words)], pa.list_(pa.int64())
            ),
        }

    more = [T.StructField("n_hit", T.LongType()), T.StructField("hit_spans", T.ArrayType(T.LongType()))]
    return append_columns(out, finish, more, drop={"__words"})


def op10_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = find_contamination(docs, table(spark, sf_dir, "benchmark"))
    return out.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(F.array_join("hit_items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


ORACLE_SQL = r"""
WITH norm AS (
  SELECT 'd' AS kind, doc_id AS id, text FROM documents
  UNION ALL SELECT 'b', item_id, text FROM benchmark WHERE item_id IS NOT NULL
), w AS (
  SELECT kind, id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM norm
), win AS (
  SELECT DISTINCT w.id AS item, len(ws) AS total, CASE WHEN len(ws) >= 10 THEN 10 ELSE len(ws) END AS size,
         array_to_string(ws[u.i : u.i + 9], ' ') AS p
  FROM w, unnest(range(1, greatest(len(ws) - 9, least(len(ws), 1)) + 1)) AS u(i) WHERE kind = 'b'
), sizes AS (SELECT DISTINCT size FROM win),
docwin AS (
  SELECT w.id, u.i, s.size, array_to_string(ws[u.i : u.i + s.size - 1], ' ') AS p
  FROM w, sizes s, unnest(range(1, len(ws) - s.size + 2)) AS u(i) WHERE kind = 'd'
), hits AS (
  SELECT d.id, d.i, d.size, win.item FROM docwin d JOIN win ON d.p = win.p AND d.size = win.size
), words AS (
  SELECT id, count(DISTINCT i + k.k) AS n_hit
  FROM (SELECT DISTINCT id, i, size FROM hits) h, unnest(range(0, h.size)) AS k(k) GROUP BY id
), items AS (
  SELECT id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS list
  FROM (SELECT DISTINCT id, CAST(item AS VARCHAR) AS item FROM hits) GROUP BY id
)
SELECT w.id AS doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(list, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN words ON words.id = w.id LEFT JOIN items ON items.id = w.id WHERE kind = 'd'
"""
