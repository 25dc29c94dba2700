"""Operator 12, source divergence audit.

How far apart the sources of a language are in their use of terms (runs of letters A-Z and of characters
beyond ASCII, with A-Z in lower case), and by which terms.

1. Arrow kernels count inside ``mapInArrow``: ``ascii_lower``, ``split_pattern_regex``,
   ``dictionary_encode`` and a hash ``group_by`` turn each batch into (lang, source, term, occurrences,
   documents). A task merges its batches before it sends them, the shuffle merges the tasks.
2. A language keeps the terms in at least ``min_docs`` of its documents. Occurrences are turned into shares
   p = 1 + floor(10**9 * (n + 5) / (N + 5 * V)), where N counts the kept terms of the group and V is the
   number of kept terms; also for the language as a whole (q).
3. Columnar shards of kept terms hold the shares of all terms of a shard for a tile of sources as a matrix and
   sum |p - p'| for each pair of its rows. Every source has a row in every shard, also where it holds none of its
   terms. What a term gives that neither source of a pair holds is the same for every such term, so it is added
   once a pair.
4. Part ``pair`` ranks the other sources of the language by that sum, part ``term`` the terms that a source holds
   more often than the language by p - q, to rank ``top``.

Arithmetic is exact: shares by long division in longs, sums in longs.

Defined results for odd input: null text, lang and source count as empty ones; a row is a document, repeated
ids or not; a group without kept terms has N = 0; a language without kept terms has the value 0 for every
pair and no terms; a lone source has no pairs; equal values are ranked by the item's UTF-8; an empty table
gives no rows; other columns are not read.

Scale: counting combines before the shuffle, so a frequent term or a large source is one row a task; tiles hold
at most some ``TILE`` sources twice and ``SHARD`` terms, whatever the number of either; ranks to ``top`` are cut before
the shuffle by the engine. The pairs of the sources of a language are the result itself.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from netquill.llm.common import discard, pieces, table, written

MIN_DOCS, TOP = 30, 50
SMOOTH, UNIT = 5, 1_000_000_000
#: sources of a tile's side and terms of a shard, about
TILE, SHARD = 128, 512
#: rows of partial counts that a task holds before it sends them
HELD = 1 << 18
BETWEEN = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
COUNTS = "lang string, source string, term string, n long, docs long"
_KEYS = ["lang", "source", "term"]


def batch_counts(batch: pa.RecordBatch) -> pa.Table:
    """(lang, source, term, n, docs) of the documents of a batch; the empty term stands for the group."""
    column = lambda c: pc.fill_null(batch.column(c), "")
    lang, source = column("lang").dictionary_encode(), column("source").dictionary_encode()
    split = pc.split_pattern_regex(pc.ascii_lower(column("text")), pattern=BETWEEN)
    terms = pc.list_flatten(split).dictionary_encode()
    some = pc.not_equal(terms, "")
    inside = pa.table({"row": pc.list_parent_indices(split), "term": terms.indices}).filter(some)
    each = inside.group_by(["row", "term"]).aggregate([([], "count_all")])
    coded = pa.table(
        {
            "lang": lang.indices.take(each["row"]),
            "source": source.indices.take(each["row"]),
            "term": each["term"],
            "n": each["count_all"],
        }
    )
    found = coded.group_by(_KEYS).aggregate([("n", "sum"), ("n", "count")])
    named = pa.table(
        {
            "lang": lang.dictionary.take(found["lang"]),
            "source": source.dictionary.take(found["source"]),
            "term": terms.dictionary.take(found["term"]),
            "n": found["n_sum"],
            "docs": found["n_count"],
        }
    )
    groups = pa.table({"lang": lang.indices, "source": source.indices}).group_by(["lang", "source"]).aggregate([])
    zero = pa.array(np.zeros(groups.num_rows, np.int64))
    group = pa.table(
        {
            "lang": lang.dictionary.take(groups["lang"]),
            "source": source.dictionary.take(groups["source"]),
            "term": pa.array([""] * groups.num_rows, pa.string()),
            "n": zero,
            "docs": zero,
        }
    )
    return pa.concat_tables([named, group])


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences of each term in each group and the documents that hold it."""

    def merged(parts: list[pa.Table]) -> pa.Table:
        both = pa.concat_tables(parts).group_by(_KEYS).aggregate([("n", "sum"), ("docs", "sum")])
        return both.rename_columns({"n_sum": "n", "docs_sum": "docs"}).select([*_KEYS, "n", "docs"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, rows = [], 0
        for batch in pieces(batches, 512):
            if not batch.num_rows:
                continue
            parts.append(batch_counts(batch))
            rows += parts[-1].num_rows
            if rows > 2 * HELD:
                parts = [merged(parts)]
                rows = parts[0].num_rows
                if rows > HELD:
                    yield from parts[0].to_batches(1 << 16)
                    parts, rows = [], 0
        if parts:
            yield from merged(parts).to_batches(1 << 16)

    text = docs.select(*[F.col(c).cast("string").alias(c) for c in ("lang", "source", "text")])
    return text.mapInArrow(run, COUNTS).groupBy(*_KEYS).agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def shares(n: np.ndarray, total: np.ndarray, kept: np.ndarray) -> np.ndarray:
    """1 + floor(UNIT * (n + SMOOTH) / (total + SMOOTH * kept)) by long division, three digits a step."""
    by = total + SMOOTH * kept
    out, rest = np.divmod(n + SMOOTH, by)
    for _ in range(3):
        digits, rest = np.divmod(rest * 1000, by)
        out = out * 1000 + digits
    return out + 1


def _share(n: Column, total: str, kept: str = "v") -> Column:
    """The same as a column."""
    return F.lit(1) + F.call_function(
        "div", (n + SMOOTH).cast("decimal(20,0)") * F.lit(UNIT).cast("decimal(10,0)"), (F.col(total) + SMOOTH * F.col(kept)).cast("decimal(20,0)")
    )


def _tile(rows: pa.Table) -> pa.Table:
    """(lang, a, b, value) for the pairs of sources of a tile, a before b: the sum of |p - p'| over the tile's terms
    less what it were if neither held any, where that is not 0. A row without a term says that a source is there."""
    sources, terms = rows["source"].combine_chunks().dictionary_encode(), rows["term"].combine_chunks().dictionary_encode()
    order = np.argsort(np.array(sources.dictionary.to_pylist(), object))
    at = np.argsort(order)[sources.indices.to_numpy()]
    size, width = len(order), len(terms.dictionary)
    column = lambda c: rows[c].to_numpy()
    n, total, kept = column("n"), column("total"), column("v")
    bare, block = np.zeros(size, np.int64), np.zeros(size, np.int64)
    bare[at] = shares(np.zeros(len(n), np.int64), total, kept)
    block[at] = column("block")
    matrix = np.repeat(bare[:, None], width, axis=1)
    holds = terms.indices.is_valid().to_numpy(zero_copy_only=False)
    matrix[at[holds], terms.indices.drop_null().to_numpy()] = shares(n, total, kept)[holds]
    one_block = (block == block[0]).all() and rows["first"][0].as_py() == rows["second"][0].as_py()
    a, b, value = [], [], []
    for i in range(size - 1):
        others = np.arange(i + 1, size)
        if not one_block:
            others = others[block[others] != block[i]]
        a.append(np.full(len(others), i))
        b.append(others)
        value.append(np.abs(matrix[others] - matrix[i]).sum(axis=1) - width * np.abs(bare[others] - bare[i]))
    names = pa.array(sources.dictionary.to_pylist(), pa.string()).take(pa.array(order))
    a, b, value = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (a, b, value))
    a, b, value = (x[value != 0] for x in (a, b, value))
    lang = pa.array([rows["lang"][0].as_py()] * len(a), pa.string())
    return pa.table({"lang": lang, "a": names.take(pa.array(a)), "b": names.take(pa.array(b)), "value": pa.array(value)})


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP, tile: int = TILE, shard: int = SHARD) -> DataFrame:
    """(lang, source, part, item, value, rank) of every group (lang, source) of ``docs`` (lang, source, text)."""
    counts = written(term_counts(docs), "audit_counts")
    kept = written(
        counts.filter("term != ''")
        .groupBy("lang", "term")
        .agg(F.sum("n").alias("in_lang"), F.sum("docs").alias("docs"))
        .filter(F.col("docs") >= min_docs)
        .select("lang", "term", "in_lang"),
        "audit_kept",
    )
    cells = counts.filter("term != ''").join(kept, ["lang", "term"])
    groups = counts.filter("term = ''").select("lang", "source")
    langs = groups.groupBy("lang").agg(F.count("*").alias("sources")).join(
        kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("in_lang").alias("lang_total")), "lang", "left"
    )
    sized = written(
        groups.join(cells.groupBy("lang", "source").agg(F.sum("n").alias("total")), ["lang", "source"], "left")
        .join(langs, "lang")
        .na.fill(0, ["total", "v", "lang_total"]),
        "audit_groups",
    )
    cells = written(cells.join(sized, ["lang", "source"]).select(*_KEYS, "n", "in_lang", "total", "v", "lang_total", "sources"), "audit_cells")

    blocks, shards = F.ceil(F.col("sources") / tile), F.ceil(F.col("v") / shard)
    named = cells.select(*_KEYS, "n", "total", "v", "sources", F.pmod(F.xxhash64("term"), shards).alias("shard"))
    there = sized.filter("v > 0").select(
        "lang", "source", F.lit(None).cast("string").alias("term"), F.lit(0).cast("long").alias("n"), "total", "v", "sources",
        F.explode(F.sequence(F.lit(0).cast("long"), shards - 1)).alias("shard"),
    )
    placed = named.unionByName(there).select(
        *_KEYS, "n", "total", "v", "shard",
        F.pmod(F.xxhash64("source"), blocks).alias("block"),
        F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)).alias("other"),
    )
    tiles = placed.withColumn("first", F.least("block", "other")).withColumn("second", F.greatest("block", "other"))
    apart = (
        tiles.groupBy("lang", "shard", "first", "second")
        .applyInArrow(_tile, "lang string, a string, b string, value long")
        .groupBy("lang", "a", "b")
        .agg(F.sum("value").alias("apart"))
    )
    either = written(apart.select("lang", F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("p"), "apart"), "audit_apart")
    bare = sized.select("lang", "source", "v", F.when(F.col("v") > 0, _share(F.lit(0).cast("long"), "total")).otherwise(F.lit(0)).alias("bare"))
    other = bare.select("lang", F.col("source").alias("item"), F.col("bare").alias("bare_"))
    met = bare.join(other, "lang").filter("source != item")
    pairs = met.join(
        either.select("lang", F.col("p.a").alias("source"), F.col("p.b").alias("item"), "apart"), ["lang", "source", "item"], "left"
    ).select(
        "lang", "source", F.lit("pair").alias("part"), "item",
        (F.col("v") * F.abs(F.col("bare") - F.col("bare_")) + F.coalesce("apart", F.lit(0))).alias("value"),
    )
    held = cells.withColumn("value", _share(F.col("n"), "total") - _share(F.col("in_lang"), "lang_total"))
    terms = held.filter("n > 0 and value > 0").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value")
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    discard(counts, kept)
    ranked = terms.withColumn("rank", rank).filter(F.col("rank") <= top)
    return pairs.withColumn("rank", rank).unionByName(ranked)


def op12_source_divergence_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lang, source, part, item, value, rank of every group of documents."""
    return audit(table(spark, sf_dir, "documents").select("lang", "source", "text"))


ORACLE_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS words
  FROM documents
), w AS (SELECT row, lang, source, unnest(words) AS term FROM d
), c AS (
  SELECT lang, source, term, count(*) AS n, count(DISTINCT row) AS docs FROM w GROUP BY ALL
), k AS (
  SELECT lang, term, CAST(sum(n) AS BIGINT) AS m FROM c GROUP BY lang, term HAVING sum(docs) >= 30
), l AS (
  SELECT g.lang, count(k.term) AS v, coalesce(sum(k.m), 0) AS total
  FROM (SELECT DISTINCT lang FROM d) g LEFT JOIN k ON k.lang = g.lang GROUP BY g.lang
), s AS (
  SELECT g.lang, g.source, any_value(l.v) AS v, any_value(l.total) AS lang_total, coalesce(sum(c.n) FILTER (WHERE k.term IS NOT NULL), 0) AS total
  FROM (SELECT DISTINCT lang, source FROM d) g JOIN l ON l.lang = g.lang
  LEFT JOIN c ON c.lang = g.lang AND c.source = g.source LEFT JOIN k ON k.lang = c.lang AND k.term = c.term
  GROUP BY g.lang, g.source
), p AS (
  SELECT s.lang, s.source, k.term, coalesce(c.n, 0) AS n,
    1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 5)) // (s.total + 5 * s.v) AS p,
    1 + (1000000000::HUGEINT * (k.m + 5)) // (s.lang_total + 5 * s.v) AS q
  FROM s JOIN k ON k.lang = s.lang LEFT JOIN c ON c.lang = s.lang AND c.source = s.source AND c.term = k.term
), f AS (
  SELECT s.lang, s.source, 'pair' AS part, o.source AS item, coalesce(sum(abs(a.p - b.p)), 0) AS value
  FROM s JOIN s o ON o.lang = s.lang AND o.source <> s.source
  LEFT JOIN p a ON a.lang = s.lang AND a.source = s.source
  LEFT JOIN p b ON b.lang = s.lang AND b.source = o.source AND b.term = a.term
  GROUP BY ALL
  UNION ALL SELECT lang, source, 'term', term, p - q FROM p WHERE n > 0 AND p > q
), r AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS rank FROM f
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM r WHERE part = 'pair' OR rank <= 50
"""
