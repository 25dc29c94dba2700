"""Operators 11 to 13 against brute force and SQL, and their defined results for odd input."""

import hashlib
import math
import random
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from netquill.llm import clustering, simhash_dedup, source_audit, suffix_dedup
from netquill.llm.mixing import mix

DIR = "/root/testdata/sf0.001"


# --- operator 11


def plain_fingerprint(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    hashes = [xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def plain_components(rows):
    """doc_id -> smallest doc_id reachable, by trying all pairs."""
    parent = {d: d for d, _ in rows if d is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    live = [r for r in rows if r[0] is not None]
    for i, (a, x) in enumerate(live):
        for b, y in live[:i]:
            if (x ^ y).bit_count() <= 2:
                ra, rb = find(a), find(b)
                parent[max(ra, rb)] = min(ra, rb)
    return {d: find(d) for d in parent}


def same_components(spark, docs, **kind):
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = sorted((repr(r.doc_id), r.fp & (1 << 64) - 1, repr(r.component_id)) for r in simhash_dedup.near_by_fingerprint(df, **kind).collect())
    rows = [(d, plain_fingerprint(t)) for d, t in docs]
    root = plain_components(rows)
    assert got == sorted((repr(d), f, repr(root.get(d))) for d, f in rows)
    return root


def test_simhash_of_given_documents(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{DIR}/documents.parquet").collect()]
    root = same_components(spark, docs)
    assert any(d != r for d, r in root.items())


def near_texts(n, seed):
    """Texts of few different words, whose fingerprints lie near each other."""
    rng = random.Random(seed)
    base = [f"w{rng.randrange(50)}" for _ in range(400)]
    out = []
    for i in range(n):
        words = list(base)
        for _ in range(rng.randrange(0, 8)):
            words[rng.randrange(len(words))] = f"x{rng.randrange(1000)}"
        out.append((i * 7 % 1009, " ".join(words)))
    return out


@pytest.mark.parametrize("crowd", [256, 2])
def test_simhash_of_a_large_family(spark, crowd):
    """The same links whether the members of a bucket are paired or linked through what lies between them."""
    root = same_components(spark, near_texts(300, 5), crowd=crowd)
    assert len(set(root.values())) < len(root)


def test_simhash_odd_input(spark):
    docs = [
        (1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "ONE"), (6, "one two"), (7, "one two three"), (None, "one two three"),
        (8, "Ünï cödé Wörds ünd mehr"), (9, "a\x00b c\x1fd e"), (10, "x " * 3000), (10, "other words of the same id"), (11, "OTHER words of the same id"),
        (11, "OTHER words of the same id"), (12, "no break space is a letter here"),
    ]
    same_components(spark, docs)
    assert simhash_dedup.near_by_fingerprint(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_simhash_links_at_two_bits_exactly(spark):
    rng = random.Random(8)
    fps = []
    for _ in range(40):
        x = rng.getrandbits(64)
        fps += [x, x ^ 1 << rng.randrange(64), x ^ 1 << rng.randrange(64) ^ 1 << rng.randrange(64), x ^ 7 << rng.randrange(60)]
    far, keys = simhash_dedup.pivot_table(np.array(fps, np.uint64))
    for i, x in enumerate(fps):
        for j, y in enumerate(fps):
            if (x ^ y).bit_count() <= 2:
                assert (keys[i] == keys[j]).any() and np.abs(far[i].astype(int) - far[j]).max() <= 2


@pytest.mark.parametrize("size", [1, 7, 1 << 20])
def test_fingerprint_in_parts(size):
    rng = random.Random(2)
    for n in (0, 1, 2, 3, 4, 50):
        text = " ".join("".join(rng.choice("abcÄ") for _ in range(rng.randrange(1, 12))) for _ in range(n))
        assert simhash_dedup.fingerprint(text.encode(), size=size) == plain_fingerprint(text)


# --- operator 12


def plain_audit(rows, min_docs, top):
    docs, counts, total = {}, {}, {}
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        counts.setdefault((lang, source), {})
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        words = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", low)
        for w in words:
            counts[lang, source][w] = counts[lang, source].get(w, 0) + 1
        for w in set(words):
            docs[lang, w] = docs.get((lang, w), 0) + 1
    out = []
    for lang in {g[0] for g in counts}:
        kept = sorted(w for (x, w), n in docs.items() if x == lang and n >= min_docs)
        groups = {s: {w: c.get(w, 0) for w in kept} for (x, s), c in counts.items() if x == lang}
        whole = {w: sum(g[w] for g in groups.values()) for w in kept}
        share = lambda g: {w: 1 + 10**9 * (g[w] + 5) // (sum(g.values()) + 5 * len(kept)) for w in kept}
        q, p = share(whole), {s: share(g) for s, g in groups.items()}
        for s in groups:
            pairs = [(sum(abs(p[s][w] - p[o][w]) for w in kept), o) for o in groups if o != s]
            terms = [(p[s][w] - q[w], w) for w in kept if groups[s][w] and p[s][w] > q[w]]
            for part, found, most in (("pair", pairs, len(pairs)), ("term", terms, top)):
                ranked = sorted(found, key=lambda f: (-f[0], f[1].encode()))
                out += [(lang, s, part, item, value, i + 1) for i, (value, item) in enumerate(ranked) if i < most]
    return sorted(out)


@pytest.mark.parametrize("tile, shard", [(128, 512), (2, 3)])
def test_audit_equals_a_plain_version(spark, tile, shard):
    rng = random.Random(4)
    words = ["the", "The", "größe", "ÄPFEL", "a", "B", "c9d", "under_score", "日本", "naïve", "zz"]
    rows = []
    for i in range(300):
        text = " ".join(rng.choice(words[: 3 + i % 9]) for _ in range(rng.randrange(0, 30)))
        rows.append((rng.choice(["en", "de", None, ""]), rng.choice([None, "", "a", "b", "c", "d", "e", "f"]), rng.choice([text, text, text, None, "", "1 2 3\n"])))
    rows += [("solo", "only", "word word"), ("bare", "x", "1"), ("bare", "y", None)] + rows[:20]
    docs = spark.createDataFrame(rows, "lang string, source string, text string").withColumn("value", F.lit("clash"))
    got = source_audit.audit(docs, min_docs=20, top=3, tile=tile, shard=shard)
    assert sorted(tuple(r) for r in got.collect()) == plain_audit(rows, 20, 3)


def test_audit_of_nothing(spark):
    empty = spark.createDataFrame([], "lang string, source string, text string")
    assert source_audit.audit(empty).collect() == []
    one = spark.createDataFrame([("en", "s", "word " * 20000), ("en", "t", "x")], "lang string, source string, text string")
    assert sorted(tuple(r) for r in source_audit.audit(one).collect()) == [("en", "s", "pair", "t", 0, 1), ("en", "t", "pair", "s", 0, 1)]


def test_shares_are_exact():
    for n, total, kept in ((0, 0, 1), (7, 9, 3), (10**12, 10**13 + 7, 10**8), (999_999_999_999, 10**12, 3)):
        got = source_audit.shares(np.array([n]), np.array([total]), np.array([kept]))
        assert got[0] == 1 + 10**9 * (n + 5) // (total + 5 * kept)


# --- operator 13


def plain_clusters(rows, k, dim, scale, rounds, seed):
    kept = [(i, [math.floor(scale * float(np.float32(x))) for x in v]) for i, v in rows if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted((hashlib.sha256(f"{seed}:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)
    centroids = [v for _, v in order[:k]]
    far = lambda v, c: sum((a - b) ** 2 for a, b in zip(v, c))
    near = lambda v: min(range(len(centroids)), key=lambda c: (far(v, centroids[c]), c))
    for _ in range(rounds):
        at = [near(v) for _, v in kept]
        for c in range(len(centroids)):
            own = [v for (_, v), x in zip(kept, at) if x == c]
            if own:
                centroids[c] = [sum(v[d] for v in own) // len(own) for d in range(dim)]
    at = [near(v) for _, v in kept]
    dist = [far(v, centroids[c]) for (_, v), c in zip(kept, at)]
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(
        (repr(i), c, d, sum(e for e, x in zip(dist, at) if x == c), sum(dist), digest[c]) for (i, _), c, d in zip(kept, at, dist)
    )


VECTORS = "vec_id long, embedding array<float>"


def same_clusters(spark, rows, **kind):
    kind = {"k": 3, "dim": 4, "scale": 1024, "rounds": 4, "seed": 3} | kind
    got = sorted((repr(r[0]), *r[1:]) for r in clustering.cluster(spark.createDataFrame(rows, VECTORS), **kind).collect())
    assert got == plain_clusters(rows, **kind)
    return got


def test_clusters_of_odd_input(spark):
    rng = random.Random(3)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(4)]) for i in range(60)]
    rows += [(None, [0.1] * 4), (5, [0.5] * 4), (5, [0.5] * 4), (60, None), (61, [0.1] * 3), (62, []), (63, [0.1, None, 0.2, 0.3])]
    rows += [(64, [float("nan")] * 4), (65, [float("inf"), 0.0, 0.0, 0.0])] + rows[:5]
    assert same_clusters(spark, rows)
    assert clustering.cluster(spark.createDataFrame([], VECTORS)).collect() == []
    assert clustering.cluster(spark.createDataFrame([(1, [1.0])], VECTORS)).collect() == []


def test_clusters_with_ties_and_empty_ones(spark):
    # equal vectors start several equal centroids, of which all but the first stay empty
    same_clusters(spark, [(i, [0.25, 0.25, 0.5, 0.5]) for i in range(9)])
    same_clusters(spark, [(1, [0.0] * 4), (2, [1.0] * 4)])
    same_clusters(spark, [(i, [float(i % 2)] * 4) for i in range(12)], k=2)


def test_clusters_of_wide_values(spark):
    """Values that span too many integers for one table."""
    rng = random.Random(9)
    rows = [(i, [rng.choice([-1, 1]) * rng.random() * 10 ** rng.randrange(6) for _ in range(4)]) for i in range(80)]
    same_clusters(spark, rows)
    with pytest.raises(ValueError):
        clustering.cluster(spark.createDataFrame([(1, [1e12] * 4), (2, [-1e12] * 4)], VECTORS), dim=4)


# --- operator 12


def test_audit_of_sources_that_hold_few_terms(spark):
    """Sources without terms, with terms in one shard alone and of several tiles, against the SQL."""
    rows = [("en", f"s{i % 3}", " ".join(chr(97 + (i + k) % 26) * 2 for k in range(9))) for i in range(200)]
    rows += [("en", "few", "aa aa"), ("en", "bare", "12 34"), ("en", None, None), ("fr", "x", "un"), ("fr", "y", None)]
    docs = spark.createDataFrame(rows, "lang string, source string, text string")
    con = duckdb.connect()
    con.register("documents", docs.toArrow())
    want = sorted(con.execute(source_audit.ORACLE_SQL).fetchall())
    assert {r[1] for r in want} == {"s0", "s1", "s2", "few", "bare", "", "x", "y"}
    for kind in ({}, {"shard": 3}, {"shard": 4, "tile": 2}):
        got = source_audit.audit(docs, **kind).select("lang", "source", "part", "item", "value", "rank")
        assert sorted(map(tuple, got.collect())) == want, kind


# --- whole queries


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {f} AS SELECT * FROM '{DIR}/{f}.parquet'")
    return con


@pytest.mark.parametrize("module, name", [(source_audit, "op12_source_divergence_audit"), (clustering, "op13_centroid_clustering")])
def test_query_equals_sql(spark, duck, module, name):
    got = getattr(module, name)(spark, DIR)
    cur = duck.execute(module.ORACLE_SQL)
    at = [got.columns.index(c[0]) for c in cur.description]
    assert sorted(tuple(r[i] for i in at) for r in got.collect()) == sorted(cur.fetchall())


def test_simhash_query(spark):
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash_dedup.op11_simhash_near_dedup(spark, DIR).collect()}
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{DIR}/documents.parquet").collect()]
    root = plain_components([(d, plain_fingerprint(t)) for d, t in docs])
    assert got == {d: (f"{plain_fingerprint(t):016x}", root[d]) for d, t in docs}


# --- operator 9


@pytest.mark.parametrize("parts", [1, 7])
def test_mix_of_repeated_rows_meets_every_target(spark, parts):
    """A source of one row over and over, with and without an id, takes its target like any other."""
    schema = "doc_id long, text string, source string"
    rows = [(i, "a b c d e", "a") for i in range(300)] + [(i, "one two", "b") for i in range(300, 500)]
    rows += [(None, "ok", "c")] * 1000 + [(7777, "same id", "d")] * 400 + [(None, None, "e")] * 5
    docs = spark.createDataFrame(rows, schema).repartition(parts)
    got = mix(docs).collect()
    assert len(got) == len(rows)
    for source in "abcde":
        own = [r for r in got if r.source == source]
        assert abs(sum(r.taken for r in own) - own[0].target) < 1 and all(r.taken <= 3 * r.size for r in own), source
    again = mix(spark.createDataFrame(rows, schema).repartition(parts)).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, again))
    two = mix(spark.createDataFrame([(i, "w w w", "a") for i in range(50)] + [(None, "ok", "b")] * 1000, schema)).filter("source = 'b'")
    found = two.agg(F.sum("taken").alias("t"), F.max("target").alias("g")).first()
    assert abs(found.t - found.g) < 1


# --- operator 6


def test_anchors_do_not_depend_on_the_batch():
    """Equal windows choose the same place, whatever else is in the batch, and the first of equal grams."""
    rng = np.random.default_rng(1)
    for n, width in ((50, 7), (200, 200), (1000, 33), (10, 1)):
        for most in (3, 1 << 62):
            x = rng.integers(0, most, n).astype(np.uint64)
            want = [i + int(np.argmin(x[i : i + width])) for i in range(n - width + 1)]
            assert suffix_dedup._sliding_argmin(x, width).tolist() == want
    text = bytes(rng.integers(97, 100, 3000).astype(np.uint8))
    alone = suffix_dedup.window_runs([text], 400, 16)
    beside = suffix_dedup.window_runs([bytes(rng.integers(97, 123, 300_000).astype(np.uint8)), text, text], 400, 16)
    for row in (1, 2):
        own = beside["row"] == row
        assert all((beside[c][own] == alone[c]).all() for c in ("gh", "c1", "c2", "pos", "left", "len"))


def test_planted_passages_are_read_by_what_is_removed(spark, tmp_path):
    """Passages of over 50 words in two documents each go from 400 bytes on; n_bytes is the size before removal."""
    rng = np.random.default_rng(6)
    prose = lambda n: " ".join(bytes(rng.integers(97, 123, 6, np.uint8)).decode() for _ in range(n))
    passages = [prose(120), prose(70), prose(60)[:400], prose(60)[:399], prose(52)]
    assert all(len(p.split()) > 50 for p in passages)
    rows = [(2 * i + k, prose(90) + edge[0] + p + edge[1] + prose(60)) for i, p in enumerate(passages) for k, edge in enumerate(("[]", "<>"))]
    rows += [(100 + i, prose(13 * i)) for i in range(30)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = suffix_dedup.op6_suffix_array_dedup(spark, str(tmp_path)).collect()
    assert {r.doc_id: r.n_bytes for r in got} == {i: len(t) for i, t in rows}
    assert {r.doc_id: r.n_removed for r in got if r.n_removed} == {2 * i + k: len(passages[i]) for i in range(3) for k in (0, 1)}


# --- operator 5


def test_centres_are_the_same_in_every_band(spark):
    """Members that share all 32 buckets meet three centres, not three in each band."""
    from netquill.llm.minhash_dedup import _pairs_with_centres

    rows = spark.range(400).selectExpr("id AS rid", "explode(sequence(0, 31)) AS band", "7L AS key")
    pairs = _pairs_with_centres(rows.withColumn("band", F.col("band").cast("int")), 3).distinct()
    assert pairs.count() <= 3 * 400
    met = {r.a for r in pairs.collect()} | {r.b for r in pairs.collect()}
    assert len(met) == 400
