"""Operator 1, exact top-k search by distributed histogram selection.

Each component x becomes floor(256 * x); a score is the integer inner product. Queries are taken in
blocks of a fixed number, and for each block every row is scored by matrix products in passes:

1. every partition counts all its scores, for each query, in equal ranges of scores; the summed
   histogram tells the range that holds the kth best score and how many scores lie above it;
2. the same over the scores in that range alone, until a range is one score: the kth value;
3. each partition returns the rows above the kth value, and of those equal to it the k smallest ids;
   a last ranking of these few rows breaks ties by the smaller id.

A partition that counts k scores at or above some range does not send its counts below it: the kth best
of all is no lower. Ranges are powers of two wide, so a score's range is a shift of it, and a pass settles
nine bits.

Defined results for odd input: vectors that are null, empty, or hold a null or non-finite component take
no part; a query meets only vectors of its own length; a null vec_id takes no part; a row never answers
a query of its own vec_id; repeated rows are each an answer, and a repeated query is asked once (its
smallest vector); a query with fewer than k candidates returns all; an empty table gives no rows; other
columns are not read. Scores up to 2**53 in size are summed in doubles, larger ones in longs; vectors
whose scores could leave the range of a long raise an error.

Scale: blocks of queries are of bounded size and sent to all tasks; a task holds scores of ``ROWS``
vectors and one histogram; histograms are summed with map-side combine; no row set is compared pair by
pair in one task. A block's answers are written before the next block, so the driver holds one block's
queries and bounds.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from netquill.llm.common import discard, scratch_path, table, written

K, EVERY, BLOCK, BITS = 5, 50, 1024, 9
RANGES = 1 << BITS
ROWS = 1024  # vectors scored at once
NONE = np.iinfo(np.int64).min


def quantised(vectors: DataFrame) -> DataFrame:
    """(vec_id, v): the usable vectors as integers in doubles."""
    x = F.col("embedding").cast("array<double>")
    bad = F.exists(x, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    return (
        vectors.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & (F.size("embedding") > 0))
        .filter(~bad)
        .select(F.col("vec_id").cast("long").alias("vec_id"), F.transform(x, lambda e: F.floor(e * 256).cast("double")).alias("v"))
    )


def _scored(batch: pa.RecordBatch, ids: np.ndarray, queries: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ids and scores (queries x rows, longs) of a batch in parts; a query's own id scores NONE."""
    own = batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, queries.shape[1]).astype(queries.dtype)
    all_ids = batch.column("vec_id").to_numpy()
    for at in range(0, len(own), ROWS):
        part = all_ids[at : at + ROWS]
        scores = (queries @ own[at : at + ROWS].T).astype(np.int64)
        place = np.searchsorted(ids, part)
        found = (place < len(ids)) & (ids[np.minimum(place, len(ids) - 1)] == part)
        scores[place[found], np.flatnonzero(found)] = NONE
        yield part, scores


def _histograms(rows: DataFrame, ids: np.ndarray, queries: np.ndarray, low: np.ndarray, width: int, shift: int, k: int) -> DataFrame:
    """(q, bin, n): how many scores lie in each of ``width`` ranges of ``2**shift`` scores from range ``low`` on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((len(ids), RANGES), np.int64)
        first = np.arange(len(ids))[:, None] * RANGES - low[:, None]
        for batch in batches:
            for _, scores in _scored(batch, ids, queries):
                bins = scores >> shift
                inside = (bins >= low[:, None]) & (bins < low[:, None] + width) & (scores != NONE)
                counts += np.bincount((bins + first)[inside], minlength=counts.size).reshape(counts.shape)
        above = np.cumsum(counts[:, ::-1], axis=1)[:, ::-1] - counts
        q, c = np.nonzero((counts > 0) & (above < k))
        yield pa.RecordBatch.from_arrays([pa.array(q), pa.array(c), pa.array(counts[q, c])], ["q", "bin", "n"])

    return rows.mapInArrow(run, "q long, bin long, n long").groupBy("q", "bin").agg(F.sum("n").alias("n"))


def _answers(rows: DataFrame, ids: np.ndarray, queries: np.ndarray, least: np.ndarray, k: int) -> DataFrame:
    """(query_id, vec_id, score): the rows above each query's kth value and, of each partition, the k
    smallest ids that equal it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[np.ndarray] = []
        ties = np.zeros((0, 3), np.int64)
        for batch in batches:
            for part, scores in _scored(batch, ids, queries):
                q, c = np.nonzero((scores >= least[:, None]) & (scores != NONE))
                found = np.column_stack([q, part[c], scores[q, c]])
                equal = found[:, 2] == least[found[:, 0]]
                out.append(found[~equal])
                ties = np.concatenate([ties, found[equal]])
                ties = ties[np.lexsort((ties[:, 1], ties[:, 0]))]
                ties = ties[np.arange(len(ties)) - np.searchsorted(ties[:, 0], ties[:, 0]) < k]
        rows_ = np.concatenate([*out, ties])
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids[rows_[:, 0]]), pa.array(rows_[:, 1].copy()), pa.array(rows_[:, 2].copy())],
            ["query_id", "vec_id", "score"],
        )

    return rows.mapInArrow(run, "query_id long, vec_id long, score long")


def _kth(rows: DataFrame, ids: np.ndarray, queries: np.ndarray, bound: int, k: int) -> np.ndarray:
    """The kth best score of each query; the lowest possible one where there are fewer."""
    # one bit more than the scores take, since the first range need not begin at the lowest
    shift, width = max((2 * bound + 1).bit_length() + 1 - BITS, 0), RANGES
    low = np.full(len(ids), -bound >> shift)
    wanted, few = np.full(len(ids), k), np.zeros(len(ids), bool)
    while True:
        counts = _histograms(rows, ids, queries, low, width, shift, k)
        # the range in which the wanted rank is reached, counted from the top
        ranked = counts.withColumn("m", F.sum("n").over(Window.partitionBy("q").orderBy(F.desc("bin"))))
        need = np.zeros(len(ids), np.int64)
        found = np.full(len(ids), -1)
        asked = rows.sparkSession.createDataFrame(list(enumerate(wanted.tolist())), "q long, k long")
        hit = ranked.join(F.broadcast(asked), "q").filter("m >= k").groupBy("q").agg(F.max_by(F.struct("bin", "m", "n"), "bin").alias("b"))
        for r in hit.collect():
            found[r.q], need[r.q] = r.b.bin, r.b.m - r.b.n
        few |= found < 0
        low = low + np.maximum(found, 0)
        wanted = wanted - need
        if shift == 0:
            return np.where(few, -bound - 1, low)
        step = min(BITS, shift)
        shift, width, low = shift - step, 1 << step, low << step


def top_k(vectors: DataFrame, is_query: Column, k: int = K, block: int = BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best other rows for each row that ``is_query`` picks."""
    rows = written(quantised(vectors), "topk_vectors")
    asked = written(
        rows.filter(is_query)
        .groupBy("vec_id", F.size("v").alias("dim"))
        .agg(F.min("v").alias("v"))
        .withColumn("part", F.pmod(F.xxhash64("vec_id"), F.lit(1 << 20))),
        "topk_queries",
    )
    found, path = None, scratch_path(vectors.sparkSession, "topk_answers")
    for dim, total in sorted((r.dim, r["count"]) for r in asked.groupBy("dim").count().collect()):
        candidates = rows.filter(F.size("v") == dim)
        reach = candidates.agg(F.max(F.aggregate("v", F.lit(0.0), lambda a, e: F.greatest(a, F.abs(e))))).first()[0]
        bound = dim * int(reach) ** 2 + 1
        if bound >= 1 << 62:
            raise ValueError(f"scores of vectors with components up to {reach / 256} do not fit a long")
        kind = np.float64 if bound < 1 << 53 else np.int64
        # blocks by hashed id: about ``block`` queries each
        parts = -(-total // block)
        for p in range(parts):
            own = (F.col("dim") == dim) & (F.col("part") * parts >= p << 20) & (F.col("part") * parts < (p + 1) << 20)
            mine = sorted((r.vec_id, r.v) for r in asked.filter(own).collect())
            if not mine:
                continue
            ids = np.array([m[0] for m in mine], np.int64)
            queries = np.array([m[1] for m in mine]).astype(kind)
            answers = _answers(candidates, ids, queries, _kth(candidates, ids, queries, bound, k), k)
            # one table for all blocks, so that the plan does not grow with them
            answers.write.mode("append").parquet(path)
            found = answers.schema
    discard(rows, asked)
    if found is None:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        vectors.sparkSession.read.schema(found)
        .parquet(path)
        .withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def op1_exact_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """query_id, rank, vec_id, score: the 5 best rows for each row whose vec_id is divisible by 50."""
    return top_k(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), F.col("vec_id") % EVERY == 0)


ORACLE_SQL = """
WITH v AS (
  SELECT vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND vec_id IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 50 = 0
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
"""
