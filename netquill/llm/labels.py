"""Bounded training samples from a table of labels."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netquill.llm.common import binaries


def fold(modulus: int) -> Column:
    """crc32 of the doc_id as text, modulo ``modulus``."""
    return F.crc32(F.col("doc_id").cast("string")) % modulus


def training_rows(docs: DataFrame, labels: DataFrame, label: str, allowed: Column, per_class: int) -> DataFrame:
    """(doc_id, text, y): at most ``per_class`` documents of each label, those whose hashed id is
    smallest among the labelled rows that ``allowed`` admits. A document labelled twice takes the
    higher label, one with several texts the smallest; null labels and ids count for nothing."""
    known = (
        labels.filter(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & allowed)
        .groupBy("doc_id")
        .agg(F.max(label).cast("int").alias("y"))
        .join(docs.select("doc_id"), "doc_id", "left_semi")
    )
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    picked = known.filter("y = 0").orderBy(*order).limit(per_class).unionByName(
        known.filter("y = 1").orderBy(*order).limit(per_class)
    )
    # the sample is bounded by per_class, so it may be broadcast and the texts stay where they are
    return docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id").groupBy("doc_id").agg(
        F.min("text").alias("text"), F.first("y").alias("y")
    )


def fitted(rows: DataFrame, fit: Callable[[list[bytes], list[int]], bytes]) -> bytes:
    """Fit a model in one task on a bounded sample (doc_id, text, y); empty without rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = []
        for batch in batches:
            found += zip(batch.column("doc_id").to_pylist(), binaries(batch, "text"), batch.column("y").to_pylist())
        if found:
            found.sort(key=lambda f: f[0])
            model = fit([f[1] for f in found], [f[2] for f in found])
            yield pa.RecordBatch.from_arrays([pa.array([model], pa.binary())], ["model"])

    got = rows.repartition(1).mapInArrow(run, "model binary").collect()
    return bytes(got[0].model) if got else b""
