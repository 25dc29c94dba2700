"""Operator 11, SimHash near-dedup by pivot distance tables.

A document's fingerprint has 64 bits: bit i is 1 if it is set in over half of the XXH64 values (seed 42) of
its three-word shingles, repeats included (A-Z in lower case, words split at ASCII white space).
Documents whose fingerprints differ in at most two bits are linked; each gets the smallest doc_id
that its links reach.

1. Documents of one fingerprint are a class, named by its smallest doc_id.
2. The pivot table holds the Hamming distances of every class to fixed reference fingerprints: the empty
   one and, for each of five blocks of bits, twelve that lie inside the block. How much farther a reference
   of a block is than the empty one depends on the block's bits alone. Fingerprints that differ in at most
   two bits differ in at most two blocks, so they agree on the distances of three blocks at least: classes
   meet in the buckets of the ten triples of blocks.
3. A pair of a bucket is discarded if some distance of the table differs by more than two, which no
   link can be, by the triangle inequality; what survives is verified on the fingerprints.
4. Members of a bucket of more than ``CROWD`` classes are not paired. Two fingerprints differ in at most two
   bits just if some fingerprint is at most one bit from both, so each such member is put under the 65
   fingerprints around it, and linked to the smallest one that it meets there. This is exact for all pairs of
   crowded buckets and takes 65 rows a member, whatever the bucket's size.
5. Connected components of the links.

Defined results for odd input: a text that is null or holds no words has fingerprint zero, which is linked
like any other; fewer than three words are one shingle; repeated doc_ids are one document that belongs to
the class of each of its texts; a row with a null doc_id gets its fingerprint, links nothing and has a
null component; an empty table gives no rows; other columns are not read.

Scale: ten rows a class meet by equality, classes that meet nobody leave before their table is joined; no
bucket is gathered, paired members are at most ``CROWD`` to a bucket, and nothing is broadcast. A text is
read in parts of a megabyte, so its words are never all Python objects.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from netquill.llm.common import binaries, discard, pieces, table, written
from netquill.llm.components import connected_components
from netquill.llm.hashing import U, mix

WIDTH, SEED, RADIUS = 3, 42, 2
BLOCKS, SHARED, PER_BLOCK = 5, 3, 12
#: classes of a bucket that are still paired with each other
CROWD = 256
PART = 1 << 20
_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def _parts(text: bytes, size: int) -> Iterator[list[bytes]]:
    """The words of a lower-cased text, about ``size`` bytes at a time."""
    at = 0
    while at < len(text):
        cut = _SPACE.search(text, at + size)
        end = cut.start() if cut else len(text)
        yield text[at:end].split()
        at = end


def fingerprint(text: bytes, width: int = WIDTH, seed: int = SEED, size: int = PART) -> int:
    """The 64-bit fingerprint of a text."""
    votes, total, last = np.zeros(64, np.int64), 0, []

    def count(shingles: Iterator[bytes]) -> int:
        hashes = np.fromiter((xxh64_intdigest(s, seed) for s in shingles), U)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        votes[:] += bits.sum(axis=0, dtype=np.int64)
        return len(hashes)

    for words in _parts(text.lower(), size):
        words = last + words
        total += count(map(b" ".join, zip(*(words[k:] for k in range(width)))))
        last = words[-(width - 1) :] if total else words
    if not total and last:
        total = count(iter([b" ".join(last)]))
    return int(np.packbits(2 * votes > total, bitorder="little").view(U)[0])


def fingerprints(docs: DataFrame, width: int = WIDTH, seed: int = SEED) -> DataFrame:
    """(doc_id, fp) of every row, the fingerprint as a long of the same bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            found = np.array([fingerprint(t, width, seed) for t in binaries(batch, "text")], U)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found.view(np.int64))], ["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, fp long")


def references() -> np.ndarray:
    """The reference fingerprints: the empty one, then ``PER_BLOCK`` inside each block of bits."""
    edges = [64 * b // BLOCKS for b in range(BLOCKS + 1)]
    masks = [(1 << hi) - (1 << lo) for lo, hi in zip(edges, edges[1:])]
    noise = mix(np.arange(1, BLOCKS * PER_BLOCK + 1, dtype=U) * U(0x9E3779B97F4A7C15))
    return np.concatenate([np.zeros(1, U), noise & np.repeat(np.array(masks, U), PER_BLOCK)])


def pivot_table(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distances to the references (fingerprints x 61) and the buckets (fingerprints x 10)."""
    far = np.bitwise_count(fps[:, None] ^ references()[None, :])
    # distance beyond that of the empty reference, a number for each block
    more = (far[:, 1:].astype(np.int64) - far[:, :1] + 64).astype(U).reshape(len(fps), BLOCKS, PER_BLOCK)
    code = np.zeros((len(fps), BLOCKS), U)
    for k in range(PER_BLOCK):
        code = code * U(0xD6E8FEB86659FD93) + more[:, :, k]
    keys = []
    for t, blocks in enumerate(combinations(range(BLOCKS), SHARED)):
        key = np.full(len(fps), t + 1, U)
        for b in blocks:
            key = mix(key ^ code[:, b])
        keys.append(key)
    return far, np.stack(keys, axis=1)


def _tabled(classes: DataFrame) -> DataFrame:
    """(node, fp, far, keys): the row of the pivot table and the buckets of each class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            far, keys = pivot_table(batch.column("fp").to_numpy().view(U))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("node"),
                    batch.column("fp"),
                    pa.array([r.tobytes() for r in far], pa.binary()),
                    pa.array(keys.view(np.int64).tolist(), pa.list_(pa.int64())),
                ],
                ["node", "fp", "far", "keys"],
            )

    return classes.mapInArrow(run, "node long, fp long, far binary, keys array<long>")


def _paired(rows: DataFrame) -> DataFrame:
    """(a, b): the linked pairs among the members (bucket, fp, node, far) of each bucket."""
    other = rows.select("bucket", *[F.col(c).alias(f"{c}_") for c in ("fp", "node", "far")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            far, far_ = (
                np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(batch.num_rows, -1).astype(np.int8)
                for c in ("far", "far_")
            )
            near = np.flatnonzero(np.abs(far - far_).max(axis=1) <= RADIUS)
            fp, fp_ = (batch.column(c).to_numpy()[near].view(U) for c in ("fp", "fp_"))
            near = pa.array(near[np.bitwise_count(fp ^ fp_) <= RADIUS])
            yield pa.RecordBatch.from_arrays([batch.column(c).take(near) for c in ("node", "node_")], ["a", "b"])

    return rows.join(other, "bucket").filter("fp < fp_").mapInArrow(run, "a long, b long")


def _met(rows: DataFrame) -> DataFrame:
    """(a, b): links that connect just those of ``rows`` (fp, node) that differ in two bits at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flips = np.concatenate([np.zeros(1, U), U(1) << np.arange(64, dtype=U)])
        for batch in pieces(batches, 4096):
            around = batch.column("fp").to_numpy().view(U)[:, None] ^ flips[None, :]
            node = np.repeat(batch.column("node").to_numpy(), len(flips))
            yield pa.RecordBatch.from_arrays([pa.array(around.ravel().view(np.int64)), pa.array(node)], ["mid", "node"])

    around = written(rows.mapInArrow(run, "mid long, node long"), "simhash_around")
    least = around.groupBy("mid").agg(F.min("node").alias("b"), F.max("node").alias("high")).filter("b < high")
    met = around.join(least, "mid").filter("node > b").select(F.col("node").alias("a"), "b").distinct()
    found = written(met, "simhash_met")
    discard(around)
    return found


def near_by_fingerprint(docs: DataFrame, crowd: int = CROWD) -> DataFrame:
    """(doc_id, fp, component_id) of every row of ``docs`` (doc_id, text). Buckets of more than ``crowd``
    classes are linked through the fingerprints around their members."""
    fps = written(fingerprints(docs), "simhash_fingerprints")
    live = fps.filter("doc_id is not null")
    classes = written(live.groupBy("fp").agg(F.min("doc_id").alias("node")), "simhash_classes")
    tabled = written(_tabled(classes), "simhash_table")
    members = tabled.select("fp", F.explode("keys").alias("bucket"))
    shared = members.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1")
    met = written(members.join(shared, "bucket"), "simhash_members")
    few = written(met.filter(F.col("n") <= crowd).join(tabled.drop("keys"), "fp"), "simhash_few")
    many = written(met.filter(F.col("n") > crowd).select("fp").distinct().join(classes, "fp"), "simhash_many")
    # a doc_id with several texts belongs to the class of each
    several = live.groupBy("doc_id").agg(F.min("fp").alias("low"), F.max("fp").alias("high")).filter("low < high").select("doc_id")
    links = _paired(few).unionByName(
        live.join(several, "doc_id", "left_semi").join(classes, "fp").select(F.col("doc_id").alias("a"), F.col("node").alias("b"))
    )
    if not many.isEmpty():
        links = links.unionByName(_met(many))
    edges = written(links.filter("a != b").distinct(), "simhash_links")
    comps = connected_components(edges)
    discard(tabled, met, few, many)
    named = written(
        classes.join(comps, classes.node == comps.node, "left").select("fp", F.coalesce("root", classes.node).alias("component_id")),
        "simhash_named",
    )
    discard(classes, edges)
    found = fps.join(named, "fp", "left")
    return found.select("doc_id", "fp", F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"))


def op11_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, fingerprint, component_id of every document."""
    found = near_by_fingerprint(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
