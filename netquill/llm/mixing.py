"""Operator 9, mixing sources to target weights along a time-varying curriculum, in DataFrame functions
only.

Sizes are words (runs of anything but space and tab to carriage return). Sources in code point order,
null last, get the weights 5, 2, 1 in turn and share 100 % of all sizes by weight; a target stops at
``MOST`` times its source's size, and what it leaves is shared again by weight. The targets are found in
closed form: with sources sorted by how soon they stop, the level at which the shares add up is a
quotient of running sums over one row per source.

Each source has a schedule: its demand for words at time t in [0, 1] falls or rises linearly (heavy
sources start strong, light ones end strong), and integrates to its target. Documents of a source stand
in the order of a hash of their id; the words taken before a document are its cumulative demand, and
inverting the integral gives its training position. Cumulative counts are rounded down, so every source
takes its target to the word, and no document more than ``MOST`` times its size, rounded up. Positions
sort the documents across sources with a range partitioning.

Running sums within a source go in three levels: documents fall into buckets by the hash's leading bits, and
buckets into top buckets by half of these. Sums run over the top buckets of a source, over the buckets of a
top bucket, and over the documents of a bucket, so no task holds a source. The number of buckets grows with
the table. Rows that repeat each other are numbered in the parts of the table that hold them, and then spread.

Defined results for odd input: a null or blank text has size 0 and takes nothing; a null source is a
source of its own; null and repeated ids are ordered by a hash of id and text, and rows that
share both are numbered and ordered by a hash of that and their number, so each takes a part of its own; a corpus without words takes nothing; an empty table
gives an empty table; columns of the input named like an output are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from netquill.llm.common import discard, table, without, written

WEIGHTS, MOST = (5, 2, 1), 3
BUCKET_ROWS = 256
#: slope of a schedule by place of its weight: demand at time t is 1 + slope * (2 t - 1)
SLOPES = (-0.5, 0.0, 0.5)


def words(text: Column) -> Column:
    """Number of words; null counts as none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]++")), F.lit(0)).cast("long")


def _pick(place: Column, values: tuple) -> Column:
    return F.element_at(F.array(*[F.lit(float(v)) for v in values]), place.cast("int") + 1)


def targets(sources: DataFrame, weights: tuple = WEIGHTS, slopes: tuple = SLOPES, most: int = MOST) -> DataFrame:
    """(source, source_size, target, slope) from (source, source_size), one row a source."""
    every = Window.partitionBy(F.lit(1))
    turn = F.row_number().over(every.orderBy(F.col("source").asc_nulls_last())) - 1
    stops = most * F.col("source_size") / F.col("weight")
    order = every.orderBy("stops", F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    rest = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    weighed = sources.withColumn("turn", turn).withColumn("weight", _pick(F.col("turn") % len(weights), weights))
    level = (F.sum("source_size").over(every) - most * F.coalesce(F.sum("source_size").over(before), F.lit(0))) / F.sum("weight").over(rest)
    # the first source, in this order, that does not stop below the level sets it
    levelled = weighed.withColumn("stops", stops).withColumn("level", level)
    final = F.min(F.when(F.col("level") <= F.col("stops"), F.struct("stops", F.col("level").alias("at")))).over(every)["at"]
    capped = (most * F.col("source_size")).cast("double")
    return levelled.withColumn("at", final).select(
        "source",
        "source_size",
        F.when(F.col("at").isNull(), capped).otherwise(F.least(capped, F.col("at") * F.col("weight"))).alias("target"),
        _pick(F.col("turn") % len(slopes), slopes).alias("slope"),
    )


def mix(docs: DataFrame, weights: tuple = WEIGHTS, slopes: tuple = SLOPES, most: int = MOST) -> DataFrame:
    """``docs`` (doc_id, text, source), less the text, with size, source_size, target, taken and
    position (null where nothing is taken), in order of position. ``weights`` and ``slopes`` go to the
    sources in turn; a slope between -1 and 1 is how a source's demand changes over training."""
    own = {"size", "source_size", "target", "taken", "position"}
    docs = without(docs, own | {"__key", "__tie", "__pid", "__copy", "__source", "__bucket", "__top", "__end", "__before"})
    names = [f"`{x}`" for x in docs.columns if x.lower() != "text"]
    key = F.md5(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.md5(F.coalesce("text", F.lit("")))))
    sized = written(
        docs.select(*names, words(F.col("text")).alias("size"), key.alias("__key"), F.md5(F.to_json(F.struct(*names))).alias("__tie"), F.spark_partition_id().alias("__pid")),
        "mix_sizes",
    )
    # rows of the same id and text are numbered, part by part of the table, and each gets a place of its own
    parts = sized.groupBy("__key", "__pid").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("__key").orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.withColumn("__before", F.sum("n").over(earlier)).filter("__before > 0").drop("n")
    number = F.row_number().over(Window.partitionBy("__key", "__pid").orderBy("__tie")) - 1
    copies = sized.withColumn("__copy", number).join(offsets, ["__key", "__pid"], "left")
    copy = F.col("__copy") + F.coalesce("__before", F.lit(0))
    place = F.when(copy == 0, F.col("__key")).otherwise(F.md5(F.concat("__key", copy.cast("string"))))

    bits = min(32, max(1, (sized.count() // BUCKET_ROWS).bit_length()))
    top = bits // 2
    bucket = F.shiftright(F.conv(F.substring("__key", 1, 8), 16, 10).cast("long"), 32 - bits)
    source = F.coalesce(F.concat(F.lit("s"), "source"), F.lit(""))
    placed = written(
        copies.withColumn("__key", place)
        .withColumns({"__bucket": bucket, "__source": source})
        .withColumn("__top", F.shiftright("__bucket", bits - top))
        .drop("__copy", "__before", "__tie", "__pid"),
        "mix_places",
    )
    plan = written(
        targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, slopes, most).select(
            source.alias("__source"), "source_size", "target", "slope"
        ),
        "mix_targets",
    )
    # sums of buckets run inside a top bucket, sums of top buckets inside a source: some 2**16 rows each at most
    below = placed.groupBy("__source", "__top", "__bucket").agg(F.sum("size").alias("words"))
    above = below.groupBy("__source", "__top").agg(F.sum("words").alias("words"))
    until = lambda *keys: Window.partitionBy(*keys[:-1]).orderBy(keys[-1]).rowsBetween(Window.unboundedPreceding, -1)
    run = lambda w: F.coalesce(F.sum("words").over(w), F.lit(0))
    tops = above.select("__source", "__top", run(until("__source", "__top")).alias("before_top"))
    starts = written(
        below.withColumn("before", run(until("__source", "__top", "__bucket")))
        .join(tops, ["__source", "__top"])
        .join(plan, "__source")
        .select("__source", "__bucket", (F.col("before") + F.col("before_top")).alias("start"), "source_size", "target", "slope"),
        "mix_starts",
    )
    inside = Window.partitionBy("__source", "__bucket").orderBy("__key").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    joined = placed.withColumn("__end", F.sum("size").over(inside)).join(starts, ["__source", "__bucket"])
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    end = F.col("start") + F.col("__end")
    first = end - F.col("size")
    taken = (F.floor(end * ratio) - F.floor(first * ratio)).cast("long")
    # demand until t is target * (t + slope * (t * t - t)); its inverse at the middle of the range
    c = (first + end) / 2 / F.greatest(F.col("source_size"), F.lit(1))
    a, b = F.col("slope"), 1 - F.col("slope")
    position = F.when(a == 0, c).otherwise((F.sqrt(b * b + 4 * a * c) - b) / (2 * a))
    discard(sized)
    return (
        joined.withColumn("taken", taken)
        .withColumn("position", F.when(F.col("taken") > 0, position))
        .select(*names, "size", "source_size", "target", "taken", "position")
        .orderBy(F.col("position").asc_nulls_last(), "doc_id")
    )


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, size, source_size, target, taken of every document, and its source and position."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mix(docs).select("doc_id", "source", "size", "source_size", "target", "taken", "position")


ORACLE_SQL = r"""
WITH d AS (
  SELECT doc_id, source, size, CASE WHEN copy = 0 THEN h ELSE md5(h || copy) END AS k
  FROM (SELECT *, row_number() OVER (PARTITION BY h) - 1 AS copy FROM (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, ''))) AS h
    FROM documents))
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS turn
  FROM d GROUP BY source
), w AS (
  SELECT *, [5.0, 2.0, 1.0][turn + 1]::DOUBLE AS weight, [-0.5, 0.0, 0.5][turn + 1]::DOUBLE AS slope FROM s
), l AS (
  SELECT *, 3 * source_size / weight AS stops,
    (sum(source_size) OVER () - 3 * coalesce(sum(source_size) OVER (ORDER BY 3 * source_size / weight, source NULLS LAST
       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
    / sum(weight) OVER (ORDER BY 3 * source_size / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM w
), f AS (SELECT arg_min(level, stops) AS lv FROM l WHERE level <= stops
), t AS (
  SELECT source, source_size, slope, CASE WHEN lv IS NULL THEN 3.0 * source_size ELSE least(3.0 * source_size, lv * weight) END AS target
  FROM l, f
), c AS (
  SELECT d.doc_id, d.source, d.size, t.source_size, CAST(t.target AS DOUBLE) AS target, t.slope,
    CASE WHEN t.source_size > 0 THEN CAST(t.target AS DOUBLE) / t.source_size ELSE 0.0 END AS ratio,
    CAST(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k) AS DOUBLE) AS e
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
), x AS (
  SELECT *, CAST(floor(e * ratio) - floor((e - size) * ratio) AS BIGINT) AS taken, (e - size + e) / 2 / greatest(source_size, 1) AS q FROM c
)
SELECT doc_id, source, CAST(size AS BIGINT) AS size, source_size, target, taken,
  CASE WHEN taken > 0 THEN CASE WHEN slope = 0 THEN q
       ELSE (sqrt((1 - slope) * (1 - slope) + 4 * slope * q) - (1 - slope)) / (2 * slope) END END AS position
FROM x
"""
