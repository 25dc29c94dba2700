"""Operator 6, suffix-array dedup: remove every byte covered by a string of ``length`` bytes that also
starts anywhere else in the corpus.

1. Every window of ``length`` bytes has an anchor: of the ``gram``-byte strings inside it, the one of
   the smallest hash, the leftmost of equals. The anchor depends on the window's bytes alone, so equal
   windows have equal anchors at equal offsets. Consecutive windows that share an anchor are a run; a
   text has about 2 / (length - gram) runs a byte, each a row without text: the anchor's hash and a
   128-bit blake2b of the run's bytes.
2. Runs whose anchor string occurs once are unique. Runs of equal content are repeated as a whole, and
   settled without text.
3. What remains are anchors met in different contents, one of which is not yet known to repeat. Each
   distinct content is fetched once, and the windows of an anchor's contents are sorted as suffixes by
   hash comparisons (:mod:`netquill.llm.suffix_order`); neighbours with a common extension of
   ``length`` bytes repeat, confirmed byte by byte.
4. The contents of an anchor are dealt to sorts of about ``group`` contents each, so an anchor of any
   number of contents is sorted in bounded tasks. What only contents of different sorts share is found
   in two steps. The windows of a content fall into cells by the place of their anchor; all windows of a
   cell hold a core, and contents can only share one of them if their cores are equal (blake2b). A cell
   whose core is met in one content only is done, and so is one whose contents are equal all over. In the
   others, windows are matched one by one by their blake2b.
5. The spans go back to all runs of the same content and are merged for each document.

Defined results for odd input: a null text is empty; a text shorter than ``length`` keeps all; repeated
rows repeat each other's bytes; rows with a null doc_id take part, each distinct text as a document of
its own; columns named like an output are replaced; an empty table gives an empty table.

Scale: every join and aggregation is keyed by hashes; hot anchors or contents are either combined on
the map side or split by the engine's skew join; texts are shuffled by (doc_id, hash of the text) twice.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from netquill.llm.common import append_columns, binaries, chunked, discard, pieces, table, without, written
from netquill.llm.hashing import PrefixHash, U, mix
from netquill.llm.suffix_order import repeated_windows

LENGTH, GRAM, GROUP, CELLS = 400, 100, 64, 16
RUN = "doc long, th long, gh long, c1 long, c2 long, pos int, left int, len int"
PART = "gh long, part int, across boolean, c1 long, c2 long, single boolean, left int, bytes binary"
SPANS = "gh long, c1 long, c2 long, spans array<int>"
CELL = "gh long, c1 long, c2 long, single boolean, cell int, k1 long, k2 long, x1 long, x2 long, low int, high int"
WINDOW = "gh long, c1 long, c2 long, single boolean, w1 long, w2 long, at int"


def _sliding_argmin(x: np.ndarray, width: int) -> np.ndarray:
    """Where the smallest of each ``width`` consecutive elements stands, the first of equal ones."""
    n = len(x)
    padded = np.full(-(-n // width) * width, np.iinfo(U).max, U)
    padded[:n] = x
    blocks = padded.reshape(-1, width)
    base = np.arange(len(blocks))[:, None] * width
    place = np.arange(width)

    def running(values: np.ndarray, ties: bool) -> tuple[np.ndarray, np.ndarray]:
        """The minimum so far, and where it was met last (``ties``) or first."""
        low = np.minimum.accumulate(values, axis=1)
        new = np.ones(values.shape, bool)
        new[:, 1:] = values[:, 1:] <= low[:, :-1] if ties else values[:, 1:] < low[:, :-1]
        return low, np.maximum.accumulate(np.where(new, place, 0), axis=1)

    low, at = running(blocks, False)
    high, back = running(blocks[:, ::-1], True)
    prefix, prefix_at = low.ravel(), (base + at).ravel()
    suffix, suffix_at = high[:, ::-1].ravel(), (base + width - 1 - back[:, ::-1]).ravel()
    first, last = slice(0, n - width + 1), slice(width - 1, n)
    return np.where(suffix[first] <= prefix[last], suffix_at[first], prefix_at[last])


def _digests(data: memoryview, start: np.ndarray, end: np.ndarray, salt: np.ndarray) -> np.ndarray:
    """Two longs a slice: blake2b of its bytes and a small number."""
    parts = zip(start.tolist(), end.tolist(), salt.tolist())
    found = b"".join(blake2b(data[a:b], digest_size=16, salt=s.to_bytes(8, "little")).digest() for a, b, s in parts)
    return np.frombuffer(found, np.int64).reshape(-1, 2)


def window_runs(texts: list[bytes], length: int, gram: int) -> dict[str, np.ndarray]:
    """The runs of some texts: row (text), gh, c1, c2, pos, left, len; all texts have ``length`` bytes or
    more."""
    joined = b"".join(texts)
    data = np.frombuffer(joined, np.uint8)
    sizes = np.array([len(t) for t in texts])
    begin = np.concatenate(([0], np.cumsum(sizes)))[:-1]
    at = np.arange(len(data) - gram + 1)
    grams = mix(PrefixHash(data).slices(at, at + gram))
    anchors = _sliding_argmin(grams, length - gram + 1)
    windows = sizes - length + 1
    row = np.repeat(np.arange(len(texts)), windows)
    start = begin[row] + np.arange(len(row)) - np.repeat(np.cumsum(windows) - windows, windows)
    anchor = anchors[start]
    new = np.ones(len(start), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(start)) - 1
    s0, s1, row, anchor = start[first], start[last] + length, row[first], anchor[first]
    content = _digests(memoryview(joined), s0, s1, anchor - s0)
    return {
        "row": row,
        "gh": grams[anchor].view(np.int64),
        "c1": content[:, 0],
        "c2": content[:, 1],
        "pos": (s0 - begin[row]).astype(np.int32),
        "left": (anchor - s0).astype(np.int32),
        "len": (s1 - s0).astype(np.int32),
    }


def _runs(docs: DataFrame, length: int, gram: int) -> DataFrame:
    names = ["gh", "c1", "c2", "pos", "left", "len"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = binaries(batch, "text")
            long = [i for i, t in enumerate(texts) if len(t) >= length]
            texts, keys = [texts[i] for i in long], batch.select(["doc", "th"]).take(pa.array(long, pa.int64()))
            for part in chunked(texts, 1 << 19):
                found = window_runs([texts[i] for i in part], length, gram)
                own = keys.take(pa.array(found["row"] + part.start))
                yield pa.RecordBatch.from_arrays([*own.columns, *[pa.array(found[n]) for n in names]], ["doc", "th", *names])

    return docs.mapInArrow(run, RUN)


def _fetched(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The bytes of the wanted contents."""
    fields = ("gh", "part", "across", "c1", "c2", "single", "left")
    lists = wanted.groupBy("doc", "th").agg(F.collect_list(F.struct(*fields, "pos", "len")).alias("want"))
    # a repeated row holds the same bytes
    joined = docs.join(lists, ["doc", "th"]).dropDuplicates(["doc", "th"]).select("text", "want")
    kinds = [pa.int64(), pa.int32(), pa.bool_(), pa.int64(), pa.int64(), pa.bool_(), pa.int32(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], [*fields, "bytes"])

        rows: list[tuple] = []
        for batch in batches:
            for text, want in zip(binaries(batch, "text"), batch.column("want")):
                for w in want.as_py():
                    rows.append((*[w[f] for f in fields], text[w["pos"] : w["pos"] + w["len"]]))
                    if len(rows) == 4000:
                        yield made(rows)
                        rows = []
        if rows:
            yield made(rows)

    return joined.mapInArrow(run, PART)


def _solve(rows: list[tuple], length: int) -> Iterator[tuple]:
    """Sort the windows of whole groups of contents (gh, part, across, c1, c2, single, left, bytes): the
    spans of single contents that another one of the group holds."""
    data = np.frombuffer(b"".join(r[7] for r in rows), np.uint8)
    size = np.array([len(r[7]) for r in rows])
    base = np.cumsum(size) - size
    windows = size - length + 1
    row = np.repeat(np.arange(len(rows)), windows)
    at = np.arange(len(row)) - np.repeat(np.cumsum(windows) - windows, windows)
    group = np.cumsum([0] + [a[:2] != b[:2] for a, b in zip(rows, rows[1:])])
    left = np.array([r[6] for r in rows])
    # equal windows have the anchor at the same place
    place = group[row] * (length + 1) + left[row] - at
    hit = repeated_windows(data, base[row] + at, (base + size)[row], place, length)
    single = np.array([r[5] for r in rows])
    where = np.flatnonzero(hit & single[row])
    if not len(where):
        return
    cut = np.flatnonzero((np.diff(where) != 1) | (np.diff(row[where]) != 0))
    firsts, lasts = where[np.concatenate(([0], cut + 1))], where[np.append(cut, len(where) - 1)]
    spans: dict[int, list[int]] = {}
    for f, z in zip(firsts.tolist(), lasts.tolist()):
        spans.setdefault(int(row[f]), []).extend((int(at[f]), int(at[z]) + length))
    for k, s in spans.items():
        yield rows[k][0], rows[k][3], rows[k][4], s


def _sorted_groups(parts: DataFrame, length: int) -> DataFrame:
    """Sort each group; a task streams over its groups in order."""
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())]
    names = [f.split()[0] for f in SPANS.split(", ")]
    fields = [f.split()[0] for f in PART.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        size = 0

        def emit(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
            if found := list(_solve(rows, length)) if rows else []:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found), kinds)], names)

        for batch in batches:
            for r in zip(*(batch.column(c).to_pylist() for c in fields)):
                if size > 1 << 18 and rows[-1][:2] != r[:2]:
                    yield from emit(rows)
                    rows, size = [], 0
                rows.append(r)
                size += len(r[7])
        yield from emit(rows)

    return parts.repartition("gh", "part").sortWithinPartitions("gh", "part").mapInArrow(run, SPANS)


def _in_tasks(parts: DataFrame, make, schema: str) -> DataFrame:
    """Rows that ``make`` gives for each content of ``parts``."""
    kinds = [{"long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_()}[f.split()[1]] for f in schema.split(", ")]
    names = [f.split()[0] for f in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            rows = [r for content in batch.to_pylist() for r in make(content)]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], names)

    return parts.mapInArrow(run, schema)


def _between_sorts(parts: DataFrame, length: int, width: int) -> DataFrame:
    """Spans of single contents that a content of another sort of their anchor holds; a cell has
    ``width`` places of the anchor."""
    key = ["gh", "c1", "c2"]

    def cells(r: dict) -> Iterator[tuple]:
        # windows begin at 0 .. last, and have the anchor at left .. left - last
        data, left, last = r["bytes"], r["left"], len(r["bytes"]) - length
        for cell in range((left - last) // width, left // width + 1):
            low, high = max(left - (cell + 1) * width + 1, 0), min(left - cell * width, last)
            # what the windows of a whole cell have in common, and what those of this content cover
            core = data[left - cell * width : left - (cell + 1) * width + 1 + length]
            own = np.frombuffer(blake2b(core, digest_size=16).digest() + blake2b(data[low : high + length], digest_size=16, salt=(left - low).to_bytes(8, "little")).digest(), np.int64)
            yield (*[r[k] for k in key], r["single"], cell, *own.tolist(), low, high)

    def windows(r: dict) -> Iterator[tuple]:
        for cell in r["cells"]:
            for at in range(cell["low"], cell["high"] + 1):
                own = np.frombuffer(blake2b(r["bytes"][at : at + length], digest_size=16).digest(), np.int64)
                yield (*[r[k] for k in key], r["single"], *own.tolist(), at)

    parts = parts.filter("across")
    found = written(_in_tasks(parts, cells, CELL), "suffix_cells")
    same = ["gh", "cell", "k1", "k2"]
    extent = F.struct("x1", "x2")
    shared = written(
        found.groupBy(*same).agg(F.count("*").alias("n"), (F.min(extent) == F.max(extent)).alias("equal")).filter("n > 1").drop("n"),
        "suffix_cores",
    )
    met = found.join(shared, same)
    whole = met.filter("equal and single").select(*key, F.array("low", F.col("high") + length).alias("spans"))
    mixed = met.filter("not equal").groupBy(*key).agg(F.collect_list(F.struct("low", "high")).alias("cells"))
    each = written(_in_tasks(parts.join(mixed, key), windows, WINDOW), "suffix_windows")
    twice = each.groupBy("gh", "w1", "w2").agg(F.count("*").alias("n")).filter("n > 1").drop("n")
    one = each.filter("single").join(twice, ["gh", "w1", "w2"]).select(*key, F.array("at", F.col("at") + length).alias("spans"))
    return whole.unionByName(one).groupBy(*key).agg(F.flatten(F.collect_list("spans")).alias("spans"))


def repeated_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, group: int = GROUP) -> DataFrame:
    """(doc, th, spans) of the texts (doc, th, text) with repeated bytes: a flat list of starts and ends
    in bytes."""
    every = written(_runs(docs, length, gram), "suffix_runs")
    met = written(every.groupBy("gh").agg(F.count("*").alias("n")).filter("n > 1").select("gh"), "suffix_anchors")
    runs = written(every.join(met, "gh"), "suffix_met")
    discard(every, met)
    key = ["gh", "c1", "c2"]
    contents = written(
        runs.groupBy(*key)
        .agg(F.count("*").alias("n"), F.min(F.struct("doc", "th", "pos")).alias("one"), F.min("left").alias("left"), F.min("len").alias("len"))
        .select(*key, "n", "one.*", "left", "len"),
        "suffix_contents",
    )
    open_ = written(
        contents.groupBy("gh")
        .agg(F.count("*").alias("m"), F.min("n").alias("least"))
        .filter("m > 1 and least = 1")
        .select("gh", F.ceil(F.col("m") / group).alias("parts")),
        "suffix_open",
    )
    wanted = contents.join(open_, "gh").select(
        "*", (F.col("n") == 1).alias("single"), F.pmod("c1", "parts").cast("int").alias("part"), (F.col("parts") > 1).alias("across")
    )
    parts = written(_fetched(docs, wanted), "suffix_parts")
    inside = written(_sorted_groups(parts, length), "suffix_sorted")
    between = written(_between_sorts(parts, length, -(-(length - gram + 1) // CELLS)), "suffix_between")
    discard(open_, parts)
    whole = contents.filter("n > 1").select(*key, F.array(F.lit(0), "len").alias("spans"))
    repeated = written(whole.unionByName(between).unionByName(inside), "suffix_repeated")
    discard(contents, inside, between)
    moved = runs.join(repeated, key).select("doc", "th", F.transform("spans", lambda x: x + F.col("pos")).alias("spans"))
    # repeated rows have the same runs, which count once here
    return moved.groupBy("doc", "th").agg(F.flatten(F.collect_set("spans")).alias("spans"))


def merge_spans(spans: np.ndarray) -> np.ndarray:
    """Sorted disjoint rows (start, end) of overlapping or touching ones."""
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    reach = np.maximum.accumulate(spans[:, 1])
    new = np.concatenate(([True], spans[1:, 0] > reach[:-1]))
    ends = np.append(np.flatnonzero(new)[1:], len(spans)) - 1
    return np.stack([spans[new, 0], reach[ends]], axis=1)


def _key(text: Column) -> tuple[Column, Column]:
    """The document a row belongs to, its text's own hash where it has no id, and that hash."""
    own = F.xxhash64(text)
    return F.coalesce(F.col("doc_id").cast("long"), own), own


def remove_repeated(docs: DataFrame, length: int = LENGTH, **options: int) -> DataFrame:
    """``docs`` with n_bytes, n_removed, n_spans, spans (flat starts and ends) and kept (the remaining
    bytes, which may split a character)."""
    docs = without(docs, {"n_bytes", "n_removed", "n_spans", "spans", "kept", "__doc", "__th", "__found"})
    doc, th = _key(F.col("text"))
    found = repeated_spans(docs.select(doc.alias("doc"), th.alias("th"), "text"), length, **options)
    found = found.select(F.col("doc").alias("__doc"), F.col("th").alias("__th"), F.col("spans").alias("__found"))
    joined = docs.join(found, (doc == F.col("__doc")) & (th == F.col("__th")), "left").drop("__doc", "__th")

    def make(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        sizes, removed, spans, kept = [], [], [], []
        for text, flat in zip(binaries(batch, "text"), batch.column("__found")):
            flat = flat.values.to_numpy() if flat.is_valid else ()
            merged = merge_spans(flat.reshape(-1, 2)) if len(flat) else np.zeros((0, 2), np.int64)
            edges = [0, *merged.ravel().tolist(), len(text)]
            sizes.append(len(text))
            removed.append(int((merged[:, 1] - merged[:, 0]).sum()))
            spans.append(merged.ravel().tolist())
            kept.append(b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2])))
        return {
            "n_bytes": pa.array(sizes, pa.int64()),
            "n_removed": pa.array(removed, pa.int64()),
            "n_spans": pa.array([len(s) // 2 for s in spans], pa.int64()),
            "spans": pa.array(spans, pa.list_(pa.int64())),
            "kept": pa.array(kept, pa.binary()),
        }

    fields = [T.StructField(n, T.LongType()) for n in ("n_bytes", "n_removed", "n_spans")]
    fields += [T.StructField("spans", T.ArrayType(T.LongType())), T.StructField("kept", T.BinaryType())]
    return append_columns(joined, make, fields, drop={"__found"})


def op6_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every document."""
    out = remove_repeated(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
