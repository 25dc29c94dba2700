"""Operator 5, MinHash near-dedup with HyperMinHash registers.

A document's set holds its distinct five-word shingles (A-Z in lower case, words split at ASCII white
space); documents are linked at a Jaccard similarity of 0.75 or more, and each group keeps its
smallest doc_id.

1. One pass over the texts gives each document the size of its set, a 128-bit blake2b of its words and
   128 HyperMinHash registers: the shingle hash picks a bucket, and the bucket's smallest value is
   stored as its leading-zero count (6 bits) and the 10 bits after the leading one. Empty buckets
   borrow from another bucket by a fixed order, so short texts are comparable too.
2. Documents of the same words form a class, named by its smallest doc_id; one text of each goes on.
3. Four registers form a band, 32 bands. At a similarity of 0.75 a pair shares no band with
   probability (1 - 0.75**4)**32 = 5e-6.
4. Candidate pairs come from the buckets of a band. First each member is paired with a few random
   centres of its bucket. Members that are then connected count as one, and the second round pairs
   members of a bucket only if they are still apart and their registers, compared inside the join, allow
   the threshold. So nothing is dropped, and a group of near copies is not expanded into
   its pairs.
5. A pair goes on if the sizes allow it, the collision-corrected estimate from the registers is not
   4.5 deviations below the threshold, and its parity maps allow it: a set's map of 1024 bits flips one
   for each shingle, so two maps differ in at most as many bits as the sets in shingles, and more than
   (n_a + n_b) * 25 / 175 of them rule a pair out for certain. Then the full sets decide, compared as
   bytes and not as hashes.

Defined results for odd input: a null or empty text has no shingles and is linked with nothing; rows
with a null doc_id link nothing, get a null component and are kept; rows that repeat a doc_id are one
document, which is linked by each of its texts; an empty table gives an empty result; other columns are
not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from netquill.llm.common import binaries, chunked, discard, pieces, table, written
from netquill.llm.components import connected_components
from netquill.llm.hashing import U, mix, shingle_hashes

REGISTERS, BANDS, BITS, CENTRES = 128, 32, 10, 3
#: members from which a component in a bucket is joined apart from the rest of it
LARGE = 64
#: bytes of shingle sets kept while pairs are verified; texts beyond it are compared in parts
CACHE_BYTES = 32 << 20
#: longs of a set's parity map
PARITY = 16
ORDER = np.argsort(
    mix(np.arange(REGISTERS * REGISTERS, dtype=U) + U(77)).reshape(REGISTERS, REGISTERS), axis=1
)


def _compress(least: np.ndarray) -> np.ndarray:
    """Leading-zero count and mantissa of 57-bit values kept in the high bits."""
    x, zeros = least.copy(), np.zeros(least.shape, np.int64)
    for step in (32, 16, 8, 4, 2, 1):
        low = x < (U(1) << U(64 - step))
        zeros += low * step
        x = np.where(low, x << U(step), x)
    mantissa = (x >> U(63 - BITS)) & U((1 << BITS) - 1)
    return (zeros.astype(U) << U(BITS) | mantissa).astype(np.uint16)


def sketch(texts: list[bytes], width: int = 5) -> tuple[np.ndarray, ...]:
    """Set sizes, the registers (texts x 128) and the parity maps of lower-cased texts."""
    hashes, counts = shingle_hashes(texts, width)
    text = np.repeat(np.arange(len(texts)), counts)
    order = np.lexsort((hashes, text))
    hashes, text = hashes[order], text[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])
    hashes, text = hashes[new], text[new]
    size = np.bincount(text, minlength=len(texts))
    some = size > 0
    parity = np.zeros(len(texts) * PARITY, U)
    bit = mix(hashes ^ U(0x5BD1E995)) & U(64 * PARITY - 1)
    np.bitwise_xor.at(parity, text * PARITY + (bit >> U(6)).astype(np.int64), U(1) << (bit & U(63)))
    full = np.iinfo(U).max
    least = np.full(len(texts) * REGISTERS, full, U)
    np.minimum.at(least, text * REGISTERS + (hashes >> U(57)).astype(np.int64), hashes << U(7))
    least = least.reshape(-1, REGISTERS)
    empty = least == full
    registers = _compress(least)
    rows, slots = np.nonzero(empty & some[:, None])
    for k in range(REGISTERS):
        if not len(rows):
            break
        source = ORDER[slots, k]
        found = ~empty[rows, source]
        registers[rows[found], slots[found]] = registers[rows[found], source[found]]
        rows, slots = rows[~found], slots[~found]
    return size, registers, parity.view(np.int64).reshape(-1, PARITY)


def signatures(docs: DataFrame, width: int = 5) -> DataFrame:
    """(doc_id, th, n_shingles, k1, k2, registers, parity) of every row: th is a hash of the text as it
    stands, k1 and k2 are that of its words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 1024):
            texts = [b" ".join(t.lower().split()) for t in binaries(batch, "text")]
            for part in chunked(texts, 1 << 20):
                own = [texts[i] for i in part]
                size, reg, parity = sketch(own, width)
                keys = np.frombuffer(b"".join(blake2b(t, digest_size=16).digest() for t in own), np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [
                        *[batch.column(c).slice(part.start, len(part)) for c in ("doc_id", "th")],
                        pa.array(size.astype(np.int64)),
                        pa.array(keys[:, 0]),
                        pa.array(keys[:, 1]),
                        pa.array([r.tobytes() for r in reg], pa.binary()),
                        pa.array([r.tobytes() for r in parity], pa.binary()),
                    ],
                    ["doc_id", "th", "n_shingles", "k1", "k2", "registers", "parity"],
                )

    return docs.select("doc_id", F.xxhash64("text").alias("th"), "text").mapInArrow(
        run, "doc_id long, th long, n_shingles long, k1 long, k2 long, registers binary, parity binary"
    )


def estimate(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Similarity from register matches, less the matches expected of unrelated sets."""
    same = (a == b).sum(axis=1)
    big, small = np.maximum(n_a, n_b).astype(float), np.minimum(n_a, n_b).astype(float)
    phi = 4 * (small / big) / ((1 + small) / np.maximum(big, 1)) ** 2
    chance = np.minimum(0.1699194 * 2.0 ** (7 - BITS) * np.minimum(phi, 1), 1.0)
    return np.clip((same - chance) / (REGISTERS - chance), 0, 1)


def _sizes_allow(a: str, b: str, percent: int) -> Column:
    return F.expr(f"100 * least({a}, {b}) >= {percent} * greatest({a}, {b})")


def _estimated(pairs: DataFrame, sigs: DataFrame, percent: int) -> DataFrame:
    """The distinct pairs (a, b) whose sizes and estimate allow the threshold."""
    side = lambda s: sigs.select(
        F.col("rid").alias(s), F.col("n_shingles").alias(f"n_{s}"), F.col("registers").alias(f"r_{s}"), F.col("parity").alias(f"p_{s}")
    )
    both = (
        pairs.distinct().join(side("a"), "a").join(side("b"), "b").filter(_sizes_allow("n_a", "n_b", percent))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            view = lambda c, width=REGISTERS: np.frombuffer(
                b"".join(batch.column(c).to_pylist()), np.uint16
            ).reshape(-1, width)
            n_a, n_b = (batch.column(c).to_numpy() for c in ("n_a", "n_b"))
            j = percent / 100
            floor = j - 4.5 * np.sqrt(j * (1 - j) / REGISTERS + (1 - j) / np.minimum(n_a, n_b))
            keep = estimate(view("r_a"), view("r_b"), n_a, n_b) >= floor
            maps = view("p_a", 4 * PARITY) ^ view("p_b", 4 * PARITY)
            apart = np.bitwise_count(maps).sum(axis=1).astype(np.int64)
            keep &= apart * (100 + percent) <= (n_a + n_b) * (100 - percent)
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    return both.mapInArrow(run, "a long, b long")


def shingles(text: bytes, width: int, part: int = 0, parts: int = 1) -> set[bytes]:
    """The distinct shingles of a text as bytes; of several ``parts``, those that fall into one."""
    w = text.lower().split()
    if len(w) < width:
        found = iter([b" ".join(w)] if w else [])
    else:
        found = map(b" ".join, zip(*(w[k:] for k in range(width))))
    return set(found) if parts == 1 else {x for x in found if hash(x) % parts == part}


def _verified(pairs: DataFrame, docs: DataFrame, reps: DataFrame, percent: int, width: int) -> DataFrame:
    """(a, b): the classes of the pairs whose full sets reach the threshold."""
    ids = pairs.select(F.explode(F.array("a", "b")).alias("rid")).distinct()
    wanted = reps.select("rid", F.col("class_id").alias("doc_id"), "th").join(ids, "rid", "left_semi")
    own = docs.select("doc_id", F.xxhash64("text").alias("th"), "text")
    texts = written(own.join(wanted, ["doc_id", "th"]).dropDuplicates(["rid", "doc_id", "th"]), "near_texts")
    side = lambda s: texts.select(F.col("rid").alias(s), F.col("doc_id").alias(f"d_{s}"), F.col("text").alias(f"t_{s}"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets: dict[bytes, set[bytes]] = {}
        held = 0

        def known(text: bytes) -> set[bytes]:
            nonlocal held
            got = sets.get(text)
            if got is None:
                got = shingles(text, width)
                size = 2 * len(text) + 120 * len(got)
                if held + size > CACHE_BYTES:
                    sets.clear()
                    held = 0
                sets[text] = got
                held += size
            return got

        def linked(x: bytes, y: bytes) -> bool:
            parts = 1 + 20 * (len(x) + len(y)) // CACHE_BYTES
            both = union = 0
            for k in range(parts):
                one, two = (known(x), known(y)) if parts == 1 else (shingles(x, width, k, parts), shingles(y, width, k, parts))
                common = len(one & two)
                both += common
                union += len(one) + len(two) - common
            return union > 0 and 100 * both >= percent * union

        for batch in pieces(batches):
            keep = [linked(x, y) for x, y in zip(binaries(batch, "t_a"), binaries(batch, "t_b"))]
            found = batch.select(["d_a", "d_b"]).filter(pa.array(keep, pa.bool_()))
            yield pa.RecordBatch.from_arrays(found.columns, ["a", "b"])

    joined = pairs.join(side("a"), "a").join(side("b"), "b")
    found = written(joined.mapInArrow(run, "a long, b long"), "near_edges")
    discard(texts)
    return found


def _pairs_with_centres(rows: DataFrame, centres: int) -> DataFrame:
    """Pairs of each member of a bucket with its centres: the members that come first in ``centres``
    random orders. The orders are the same in all bands, so that members which share many buckets meet the
    same few centres again, and not others in each band."""
    order = lambda k: F.xxhash64(F.lit(k), "rid")
    chosen = written(
        rows.groupBy("band", "key")
        .agg(*[F.min_by("rid", order(k)).alias(f"c{k}") for k in range(centres)])
        .select("band", "key", F.array_distinct(F.array(*[f"c{k}" for k in range(centres)])).alias("c")),
        "near_centres",
    )
    return (
        rows.join(chosen, ["band", "key"])
        .select("rid", F.explode("c").alias("centre"))
        .filter("rid != centre")
        .select(F.least("rid", "centre").alias("a"), F.greatest("rid", "centre").alias("b"))
    )


def _pairs_apart(rows: DataFrame, reps: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """The pairs of a bucket's members (band, key, rid, comp) in different components whose sizes and
    registers allow the threshold, tested inside the join, and the table they come from. A pair that shares
    several bands comes from the first of them only.

    Members of one component must not meet: a component with ``LARGE`` members or more in a bucket is a key of
    its own, joined with the members of the others. Those of smaller ones meet in the bucket, so that each
    passes over fewer than ``LARGE`` of its own component."""
    large = (
        rows.groupBy("band", "key", "comp")
        .agg(F.count("*").alias("members"))
        .filter(F.col("members") >= LARGE)
        .select("band", "key", "comp", F.lit(True).alias("large"))
    )

    def bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                longs = lambda c, n: pa.array(
                    np.frombuffer(b"".join(batch.column(c).to_pylist()), np.int64).reshape(-1, n).tolist(), pa.list_(pa.int64())
                )
                yield pa.RecordBatch.from_arrays(
                    [batch.column("rid"), batch.column("n_shingles"), longs("registers", BANDS), longs("parity", PARITY)],
                    ["rid", "n", "keys", "parity"],
                )

    wide = reps.mapInArrow(bands, "rid long, n long, keys array<long>, parity array<long>")
    rows = written(rows.join(large, ["band", "key", "comp"], "left").join(wide, "rid"), "near_apart")
    other = lambda some: some.select("band", "key", *[F.col(c).alias(f"{c}_") for c in ("rid", "comp", "n", "keys", "parity")])
    first = F.expr("array_position(zip_with(keys, keys_, (x, y) -> x = y), true) = band + 1")
    # of the four 16-bit registers in a long, how many differ: a lane's bits are folded into its lowest
    fold_ = "x"
    for k in (8, 4, 2, 1):
        fold_ = f"transform(array({fold_}), y -> y | shiftrightunsigned(y, {k}))[0]"
    differ = f"aggregate(zip_with(keys, keys_, (x, y) -> x ^ y), 0, (a, x) -> a + bit_count({fold_} & 281479271743489L))"
    flipped = "aggregate(zip_with(parity, parity_, (x, y) -> bit_count(x ^ y)), 0, (a, x) -> a + x)"
    allowed = F.expr(f"{flipped} * {100 + percent} <= (n + n_) * {100 - percent}")
    j = percent / 100
    most = f"{REGISTERS} * ({1 - j} + 4.5 * sqrt({j * (1 - j) / REGISTERS} + {1 - j} / least(n, n_)))"
    possible = _sizes_allow("n", "n_", percent) & allowed & first & F.expr(f"{differ} <= {most}")
    pair = [F.least("rid", "rid_").alias("a"), F.greatest("rid", "rid_").alias("b")]
    few, many = rows.filter("large is null"), rows.filter("large")
    among_few = few.join(other(few), ["band", "key"]).filter((F.col("comp") < F.col("comp_")) & possible)
    # each member beside the large components of its bucket, two large ones once
    hosts = many.select("band", "key", F.col("comp").alias("comp_")).distinct()
    beside = rows.join(hosts, ["band", "key"]).filter("comp != comp_ and (large is null or comp < comp_)")
    with_many = beside.join(other(many), ["band", "key", "comp_"]).filter(possible)
    return among_few.select(*pair).unionByName(with_many.select(*pair)), rows


def near_duplicates(docs: DataFrame, percent: int = 75, width: int = 5) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text): doc_id, n_shingles, class_id (smallest doc_id
    with the same words), component_id, kept."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sigs = written(signatures(docs, width), "near_signatures")
    live = sigs.filter("n_shingles > 0 and doc_id is not null")
    # one row a class; what its members share is the same in each
    reps = written(
        live.groupBy("k1", "k2")
        .agg(F.min(F.struct("doc_id", "th")).alias("one"), F.max("doc_id").alias("last"), *[F.first(c).alias(c) for c in ("n_shingles", "registers", "parity")])
        .select(
            F.col("k1").alias("rid"), "k2", F.col("one.doc_id").alias("class_id"), F.col("one.th").alias("th"),
            (F.col("last") > F.col("one.doc_id")).alias("several"), "n_shingles", "registers", "parity",
        ),
        "near_reps",
    )

    def bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.frombuffer(b"".join(batch.column("registers").to_pylist()), np.int64)
            pick = pa.array(np.repeat(np.arange(batch.num_rows), BANDS))
            band = pa.array(np.tile(np.arange(BANDS, dtype=np.int32), batch.num_rows))
            yield pa.RecordBatch.from_arrays(
                [band, pa.array(keys), batch.column("rid").take(pick), batch.column("class_id").take(pick)],
                ["band", "key", "rid", "class_id"],
            )

    everything = reps.select("rid", "class_id", "registers").mapInArrow(bands, "band int, key long, rid long, class_id long")
    shared = written(
        everything.groupBy("band", "key")
        .agg(F.min("rid").alias("low"), F.max("rid").alias("high"))
        .filter("low < high")
        .select("band", "key"),
        "near_shared",
    )
    rows = written(everything.join(shared, ["band", "key"]), "near_rows")
    first = written(_estimated(_pairs_with_centres(rows, CENTRES), reps, percent), "near_pairs")
    edges = _verified(first, docs, reps, percent, width)

    # a doc_id with several texts belongs to the class of each
    several = live.groupBy("doc_id").agg(F.min("k1").alias("low"), F.max("k1").alias("high")).filter("low < high").select("doc_id")
    own = (
        live.join(several, "doc_id", "left_semi")
        .select("doc_id", F.col("k1").alias("rid"), "k2")
        .join(reps, ["rid", "k2"])
        .select(F.col("doc_id").alias("a"), F.col("class_id").alias("b"))
    )
    links = written(edges.unionByName(own).filter("a != b").distinct(), "near_links")
    comps = written(connected_components(links), "near_components")
    placed = written(
        rows.join(comps, rows.class_id == comps.node, "left").select("band", "key", "rid", F.coalesce("root", "class_id").alias("comp")),
        "near_placed",
    )
    mixed = written(
        placed.groupBy("band", "key")
        .agg(F.min("comp").alias("low"), F.max("comp").alias("high"))
        .filter("low < high")
        .select("band", "key"),
        "near_mixed",
    )
    apart, tested = _pairs_apart(placed.join(mixed, ["band", "key"]), reps, percent)
    second = written(_estimated(apart, reps, percent).join(first, ["a", "b"], "left_anti"), "near_pairs")
    if not second.isEmpty():
        more = _verified(second, docs, reps, percent, width)
        if not more.isEmpty():
            # the links found now, and one from each node to the root it had
            stars = comps.filter("node != root").select(F.col("node").alias("a"), F.col("root").alias("b"))
            comps = written(connected_components(more.unionByName(stars)), "near_components")
        discard(more)
    discard(shared, rows, first, edges, links, placed, mixed, tested, second)

    # only classes of several documents, or with links, differ from their documents
    moved = (
        reps.select("rid", "k2", "class_id", "several")
        .join(comps, F.col("class_id") == F.col("node"), "left")
        .filter("several or root is not null")
        .select(F.col("rid").alias("k1"), "k2", "class_id", F.coalesce("root", "class_id").alias("root"))
    )
    some = F.col("n_shingles").cast("boolean") & F.col("doc_id").isNotNull()
    found = sigs.select("doc_id", "n_shingles", "k1", "k2").join(moved, ["k1", "k2"], "left")
    component = F.when(some, F.coalesce("root", "doc_id")).otherwise(F.col("doc_id"))
    return found.select(
        "doc_id",
        "n_shingles",
        F.when(some, F.coalesce("class_id", "doc_id")).otherwise(F.col("doc_id")).alias("class_id"),
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def op5_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every document."""
    return near_duplicates(table(spark, sf_dir, "documents")).drop("class_id")
