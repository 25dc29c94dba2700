"""Operator 13, centroid clustering by scalar lookup tables.

Vectors become integers, floor(``scale`` * x) of each component, and ``k`` integer centroids are moved for a fixed
number of rounds: every vector goes to the nearest one (squared Euclidean distance, ties to the smaller
number), every centroid to the floor of its vectors' mean.

A distance is a sum of squared differences of single numbers, and few numbers occur. So each round tabulates
(v - c)**2 for each dimension, occurring integer value v and centroid c, and distances are NumPy gathers
from the table and sums of them. Where the values of all dimensions span at most ``SPAN`` integers
together, a task makes one table a round over the span; else each batch makes one over the values that
occur in it.

The first centroids are the vectors with the smallest lowercase-hex sha256 of ``seed:vec_id``. All sums are
exact: distances and sums of a task in longs, sums of tasks as decimals, means by integer division.

Defined results for odd input: vectors that are null, of another length, or hold a null or non-finite
component take no part; a row with a null vec_id is clustered but starts no centroid; rows that repeat a vec_id are
each a vector, and a smaller vector comes first where hashes tie; fewer vectors than ``k`` start that
many centroids, all are kept when they are equal, and an empty one stays where it is; an empty table gives no
rows; other columns are not read. Components whose distances could leave a long are an error.

Scale: a round reads the vectors once, sends ``k`` rows of sums a task and returns ``k`` centroids to the driver, so
what is sent does not grow with the table; nothing else moves between tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netquill.llm.common import discard, pieces, table, written

K, DIM, SCALE, ROUNDS, SEED = 8, 64, 1024, 10, 3
#: integers that the tables of all dimensions may span together
SPAN = 1 << 20
ROWS = 4096  # vectors measured at once


def quantised(vectors: DataFrame, dim: int = DIM, scale: int = SCALE) -> DataFrame:
    """(vec_id, v): the usable vectors as arrays of longs."""
    x = F.col("embedding").cast("array<double>")
    bad = F.exists(x, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    return (
        vectors.filter(F.col("embedding").isNotNull() & (F.size("embedding") == dim))
        .filter(~bad)
        .select(F.col("vec_id").cast("long").alias("vec_id"), F.transform(x, lambda e: F.floor(e * scale)).alias("v"))
    )


class Tables:
    """Squared differences of single values to the centroids (k x dim), and distances read from them."""

    def __init__(self, centroids: np.ndarray, low: np.ndarray, high: np.ndarray):
        self.centroids = centroids
        self.low = low
        spans = high - low + 1
        self.dense = int(spans.sum()) <= SPAN
        if self.dense:
            self.starts = np.concatenate(([0], np.cumsum(spans)))[:-1]
            dims = np.repeat(np.arange(len(spans)), spans)
            values = np.arange(len(dims)) - self.starts[dims] + low[dims]
            self.squares = (values[:, None] - centroids.T[dims]) ** 2

    def distances(self, v: np.ndarray) -> np.ndarray:
        """Squared distances (vectors x k) of ``v`` (vectors x dim)."""
        out = np.zeros((len(v), len(self.centroids)), np.int64)
        for d in range(v.shape[1]):
            if self.dense:
                out += self.squares[v[:, d] - self.low[d] + self.starts[d]]
            else:
                values, place = np.unique(v[:, d], return_inverse=True)
                out += ((values[:, None] - self.centroids[None, :, d]) ** 2)[place]
        return out


def _matrices(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in pieces(batches, ROWS):
        if batch.num_rows:
            yield batch, batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _moved(rows: DataFrame, centroids: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The centroids after one round."""
    k, dim = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = Tables(centroids, low, high)
        n, sums = np.zeros(k, np.int64), np.zeros((k, dim), np.int64)
        for _, v in _matrices(batches, dim):
            near = tables.distances(v).argmin(axis=1)
            n += np.bincount(near, minlength=k)
            for c in range(k):
                sums[c] += v[near == c].sum(axis=0)
        c = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(c, dim)), pa.array(np.tile(np.arange(dim), len(c))), pa.array(np.repeat(n[c], dim)), pa.array(sums[c].ravel())],
            ["c", "d", "n", "s"],
        )

    parts = rows.mapInArrow(run, "c long, d long, n long, s long").groupBy("c", "d")
    out = centroids.copy()
    for r in parts.agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(20,0)")).alias("s")).collect():
        out[r.c, r.d] = int(r.s) // r.n
    return out


def cluster(vectors: DataFrame, k: int = K, dim: int = DIM, scale: int = SCALE, rounds: int = ROUNDS, seed: int = SEED) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every usable vector of
    ``vectors`` (vec_id, embedding)."""
    rows = written(quantised(vectors, dim, scale), "cluster_vectors")
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    chosen = rows.filter("vec_id is not null").orderBy(order, "v").limit(k).collect()
    shape = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    if not chosen:
        discard(rows)
        return vectors.sparkSession.createDataFrame([], shape)
    reach = rows.select(F.posexplode("v").alias("d", "x")).groupBy("d").agg(F.min("x").alias("low"), F.max("x").alias("high"))
    bounds = sorted((r.d, r.low, r.high) for r in reach.collect())
    low, high = (np.array([b[i] for b in bounds], np.int64) for i in (1, 2))
    if sum((int(h) - int(lo)) ** 2 for lo, h in zip(low, high)) >= 1 << 63:
        raise ValueError(f"distances of vectors with components from {low.min()} to {high.max()} do not fit a long")
    centroids = np.array([r.v for r in chosen], np.int64)
    for _ in range(rounds):
        centroids = _moved(rows, centroids, low, high)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = Tables(centroids, low, high)
        for batch, v in _matrices(batches, dim):
            far = tables.distances(v)
            near = far.argmin(axis=1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(near.astype(np.int32)), pa.array(far[np.arange(len(v)), near])],
                ["vec_id", "cluster", "distance"],
            )

    found = written(rows.mapInArrow(run, "vec_id long, cluster int, distance long"), "cluster_found")
    discard(rows)
    sums = {r.cluster: r.s for r in found.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    digest = [sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    # k rows, whatever the table's size
    named = vectors.sparkSession.createDataFrame(
        [(c, s, sum(sums.values()), digest[c]) for c, s in sums.items()],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string",
    )
    return found.join(F.broadcast(named), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def op13_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of every usable vector."""
    return cluster(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


def _oracle() -> str:
    """The rounds one after another, since SQL has no loop here."""
    near = """
  SELECT vec_id, row, v, c, dist FROM (
    SELECT v.vec_id, v.row, v.v, t.c, list_sum([(v.v[i] - t.m[i]) * (v.v[i] - t.m[i]) FOR i IN range(1, 65)]) AS dist,
      row_number() OVER (PARTITION BY v.row ORDER BY list_sum([(v.v[i] - t.m[i]) * (v.v[i] - t.m[i]) FOR i IN range(1, 65)]), t.c) AS o
    FROM v, {t} t) WHERE o = 1"""
    parts = [
        """
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS row, vec_id, [CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
  FROM embeddings
  WHERE len(embedding) = 64 AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), t0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('3:' || CAST(vec_id AS VARCHAR)), v) - 1 AS c, v AS m FROM v
  WHERE vec_id IS NOT NULL QUALIFY c < 8
)"""
    ]
    for i in range(ROUNDS):
        parts.append(
            f"""n{i} AS MATERIALIZED ({near.format(t=f"t{i}")}
), s{i} AS (SELECT c, d.i, CAST(sum(v[d.i]) AS BIGINT) AS s, count(*) AS n FROM n{i}, (SELECT unnest(range(1, 65)) AS i) d GROUP BY c, d.i
), g{i} AS (SELECT c, list((s - ((s % n) + n) % n) // n ORDER BY i) AS m FROM s{i} GROUP BY c
), t{i + 1} AS MATERIALIZED (SELECT t.c, coalesce(g.m, t.m) AS m FROM t{i} t LEFT JOIN g{i} g ON g.c = t.c
)"""
        )
    last = f"""n AS MATERIALIZED ({near.format(t=f"t{ROUNDS}")}
)
SELECT n.vec_id, CAST(n.c AS INTEGER) AS cluster, CAST(n.dist AS BIGINT) AS distance,
  CAST(sum(n.dist) OVER (PARTITION BY n.c) AS BIGINT) AS cluster_inertia, CAST(sum(n.dist) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(t.m, ',')) AS centroid_sha256
FROM n JOIN t{ROUNDS} t ON t.c = n.c
"""
    return ", ".join([*parts, last])


ORACLE_SQL = _oracle()
