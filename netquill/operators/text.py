"""SimHash of texts, and near copies by it."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from functools import lru_cache
from hashlib import md5

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BITS = 64


def shingle_votes(text: str, width: int, bits: Callable[[str], int]) -> np.ndarray | None:
    """For each of the 64 bits, the highest first, how many of the text's shingles set it less those that do not; None
    for a text without shingles."""
    counts = Counter(text[i : i + width] for i in range(len(text) - width + 1))
    if not counts:
        return None
    hashes = np.fromiter(map(bits, counts), ">u8", len(counts))
    n = np.fromiter(counts.values(), np.int64, len(counts))
    return 2 * (n @ np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1)) - n.sum()


def simhash(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 4) -> DataFrame:
    """64-bit SimHash of each text over its ``width``-character shingles with counts: a bit is set where
    the shingles that set it outweigh the others. A shingle's bits are the last 64 of its MD5. Shingles stay inside
    their text: what is dealt is 64 sums a text, for texts that share a key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = lru_cache(1 << 18)(lambda s: int.from_bytes(md5(s.encode()).digest()[8:], "big"))
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                votes = [shingle_votes(t.as_py() or "", width, bits) for t in part.column(1)]
                some = pa.array([v is not None for v in votes])
                sums = [pa.array([v[i] for v in votes if v is not None], pa.int64()) for i in range(BITS)]
                yield pa.RecordBatch.from_arrays([part.column(0).filter(some), *sums], [key, *names])

    names = [f"v{i}" for i in range(BITS)]
    kind = T.StructType([docs.schema[key], *[T.StructField(n, T.LongType()) for n in names]])
    votes = docs.select(key, text).mapInArrow(run, kind).groupBy(key).agg(*[F.sum(n).alias(n) for n in names])
    pack = lambda part: sum((F.when(F.col(n) > 0, F.lit(1 << 31 - i)).otherwise(F.lit(0)).cast("bigint") for i, n in enumerate(part)), F.lit(0).cast("bigint"))
    return votes.select(key, pack(names[:32]).alias("simhash_high"), pack(names[32:]).alias("simhash_low"))


def near_by_simhash(hashes: DataFrame, key: str = "doc_id", distance: int = 3) -> DataFrame:
    """(a, b, distance) for SimHashes at most ``distance`` (3 or less) bits apart, equal ones left to a
    group-by: one of four 16-bit bands must agree, and a pair comes from its first such band."""
    if distance > 3:
        raise ValueError("four bands find distances of 3 or less")
    distinct = hashes.groupBy("simhash_high", "simhash_low").agg(F.min(key).alias("k"))
    bands = F.array(*[F.shiftright(c, s).bitwiseAND(F.lit(0xFFFF)) for c in ("simhash_high", "simhash_low") for s in (16, 0)])
    long = distinct.withColumn("bands", bands).select("*", F.posexplode("bands").alias("band", "v"))
    other = long.select("band", "v", *[F.col(c).alias(f"{c}_") for c in ("k", "simhash_high", "simhash_low", "bands")])
    apart = F.bit_count(F.col("simhash_high").bitwiseXOR(F.col("simhash_high_"))) + F.bit_count(F.col("simhash_low").bitwiseXOR(F.col("simhash_low_")))
    first = F.expr("array_position(zip_with(bands, bands_, (x, y) -> x = y), true) = band + 1")
    met = long.join(other, ["band", "v"]).filter((F.col("k") < F.col("k_")) & first & (apart <= distance))
    return met.select(F.col("k").alias("a"), F.col("k_").alias("b"), apart.alias("distance"))
