"""Operator 8, line dedup: explode normalised lines, hash them, find hashes that several documents
hold (``min_docs``), drop those lines everywhere but in the first document, and reassemble what is left
in order.

A line's key is the line without white space (space, tab to carriage return) at both ends and with
A-Z in lower case. Keys are compared by a 128-bit hash.

Defined results for odd input: a null or empty text is one empty line; a key shorter than
``min_chars`` code points never counts; rows that repeat a doc_id are one document; a row with a null
doc_id keeps its text and counts for nobody; columns of the input named like an output are replaced;
an empty table gives an empty table.

Scale: the table of (document, key) is aggregated with map-side combine to the few keys that two
documents hold, written, and joined back by sort-merge join, where the engine splits a key that a
third of all lines share. Texts move once, by document; rows without an id are spread by their text.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from netquill.llm.common import append_columns, binaries, pieces, table, without, written

MIN_CHARS, MIN_DOCS = 10, 2


def line_key(line: bytes, min_chars: int = MIN_CHARS) -> bytes | None:
    """The 16-byte hash of a line's key, None if the key is too short."""
    key = line.strip(b" \t\n\x0b\x0c\r").lower()
    if len(key) < min_chars or len(key) < 4 * min_chars and len(key.decode("utf-8", "replace")) < min_chars:
        return None
    return blake2b(key, digest_size=16).digest()


def _longs(keys: list[bytes]) -> tuple[pa.Array, pa.Array]:
    both = np.frombuffer(b"".join(keys), np.int64).reshape(-1, 2)
    return pa.array(both[:, 0]), pa.array(both[:, 1])


def line_keys(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc_id, h1, h2): the distinct keys of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            ids, keys = [], []
            for doc, text in zip(batch.column(0).to_pylist(), binaries(batch, "text")):
                own = {line_key(x, min_chars) for x in text.split(b"\n")} - {None}
                keys += own
                ids += [doc] * len(own)
            h1, h2 = _longs(keys)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), h1, h2], ["doc_id", "h1", "h2"])

    part = docs.filter("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return part.mapInArrow(run, "doc_id long, h1 long, h2 long")


def drop_repeated_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """``docs`` with the repeated lines gone from ``text``, and n_lines (before) and n_dropped."""
    docs = without(docs, {"n_lines", "n_dropped", "__drop_id", "__drop"})
    lines = written(line_keys(docs, min_chars), "line_keys")
    # two documents hold a key if its ids differ; for more, ids are counted once each
    counted = lines if min_docs <= 2 else lines.distinct()
    enough = F.min("doc_id") < F.max("doc_id") if min_docs == 2 else F.count("*") >= min_docs
    repeated = written(
        counted.groupBy("h1", "h2").agg(F.min("doc_id").alias("first"), enough.alias("enough")).filter("enough").drop("enough"),
        "repeated_lines",
    )
    drops = (
        lines.join(repeated, ["h1", "h2"])
        .filter("doc_id > first")
        .groupBy(F.col("doc_id").alias("__drop_id"))
        .agg(F.collect_list(F.struct("h1", "h2")).alias("__drop"))
    )
    spread = F.coalesce(F.col("doc_id").cast("long"), F.xxhash64("text"))
    joined = docs.join(drops, (spread == F.col("__drop_id")) & F.col("doc_id").isNotNull(), "left").drop("__drop_id")

    def make(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        out, total, dropped = [], [], []
        pairs = batch.column("__drop").to_pylist()
        for text, drop in zip(binaries(batch, "text"), pairs):
            lines_ = text.split(b"\n")
            total.append(len(lines_))
            if not drop:
                out.append(text)
                dropped.append(0)
                continue
            gone = {np.array([d["h1"], d["h2"]], np.int64).tobytes() for d in drop}
            kept = [x for x in lines_ if line_key(x, min_chars) not in gone]
            dropped.append(len(lines_) - len(kept))
            out.append(b"\n".join(kept))
        return {
            "text": pa.array(out, pa.binary()).cast(pa.string()),
            "n_lines": pa.array(total, pa.int64()),
            "n_dropped": pa.array(dropped, pa.int64()),
        }

    fields = [
        T.StructField("text", T.StringType()),
        T.StructField("n_lines", T.LongType()),
        T.StructField("n_dropped", T.LongType()),
    ]
    return append_columns(joined, make, fields, drop={"__drop"})


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_sha256 of every document."""
    out = drop_repeated_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.encode("text", "UTF-8"), 256).alias("kept_sha256"))


ORACLE_SQL = r"""
WITH l AS (
  SELECT d.doc_id, u.i, d.lines[u.i] AS line,
         translate(trim(d.lines[u.i], ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents) d,
       unnest(range(1, len(d.lines) + 1)) AS u(i)
), rep AS (
  SELECT k, min(doc_id) AS first FROM l WHERE length(k) >= 10
  GROUP BY k HAVING count(DISTINCT doc_id) >= 2
)
SELECT l.doc_id, count(*) AS n_lines,
       count(*) FILTER (WHERE rep.k IS NOT NULL AND l.doc_id > rep.first) AS n_dropped,
       sha256(coalesce(string_agg(l.line, chr(10) ORDER BY l.i)
              FILTER (WHERE rep.k IS NULL OR l.doc_id = rep.first), '')) AS kept_sha256
FROM l LEFT JOIN rep ON l.k = rep.k GROUP BY l.doc_id
"""
