"""The training-data operators against brute force, the tokenizer's library, held-out labels and DuckDB."""

import os
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from netquill.llm import minhash_dedup, registry
from netquill.llm.chat_format import dialogues, rotate
from netquill.llm.decontaminate import byte_spans, find_contamination
from netquill.llm.hashing import LaneHash, word_hashes
from netquill.llm.line_dedup import drop_repeated_lines
from netquill.llm.minhash_dedup import near_duplicates
from netquill.llm.mixing import mix
from netquill.llm.quality import isotonic, score_quality, train_quality
from netquill.llm.suffix_dedup import remove_repeated
from netquill.llm.suffix_order import Suffixes, repeated_windows
from netquill.llm.token_counts import MergeCounter, count_tokens
from netquill.llm.topk_search import top_k
from netquill.llm.toxicity import score_toxicity, train_toxicity

DIR = "/root/testdata/sf0.001"
LONG = "long " * 30_000 + "end"
ODD = [(1, None), (2, ""), (3, " \n\t "), (4, LONG), (4, LONG), (None, "some words of a text without an id"), (None, None), (5, "é" * 500), (6, "é" * 500)]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(DIR):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{DIR}/{f}'")
    return con


def plain(rows):
    return sorted(tuple(repr(round(x, 9)) if isinstance(x, float) else str(x) for x in r) for r in rows)


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_against_sql(spark, duck, name):
    df = registry.queries()[name](spark, DIR)
    cur = duck.execute(registry.oracle_sql()[name])
    names = [c[0] for c in cur.description]
    assert sorted(names) == sorted(df.columns)
    assert plain(df.select(*names).collect()) == plain(cur.fetchall())


def odd(spark, schema="doc_id long, text string"):
    """Nulls, empty and long texts, repeated rows, and columns named like outputs."""
    df = spark.createDataFrame(ODD, schema)
    for clash in ("n_lines", "N_Bytes", "size", "n_words", "toxic_score", "quality_score", "spans"):
        df = df.withColumn(clash, F.lit("x"))
    return df.withColumn("source", F.lit(None).cast("string"))


def none(spark):
    return spark.createDataFrame([], "doc_id long, text string, source string")


@pytest.mark.parametrize("make", ["odd", "none"])
def test_odd_input(spark, make):
    docs = odd(spark) if make == "odd" else none(spark)
    n = len(ODD) if make == "odd" else 0
    labels = spark.createDataFrame([(2, 1, 0), (4, 0, 1), (None, 1, 1), (5, None, None)], "doc_id long, quality int, toxic int")
    bench = spark.createDataFrame([(1, "some words of"), (2, None), (None, "a text"), (3, "")], "item_id long, text string")
    for out in (
        drop_repeated_lines(docs), count_tokens(docs), near_duplicates(docs), remove_repeated(docs), mix(docs), find_contamination(docs, bench),
        score_toxicity(docs, train_toxicity(docs, labels)), score_quality(docs, train_quality(docs, labels)), score_quality(docs, b""), score_toxicity(docs, b""),
    ):
        assert len(out.collect()) == n
        low = [c.lower() for c in out.columns]
        assert len(low) == len(set(low))


def test_line_dedup_keeps_first_document(spark):
    docs = spark.createDataFrame([(1, "Same line here\nown"), (2, " same LINE here\t\nx\nSAME line here"), (3, "short\nshort"), (4, "short")], "doc_id long, text string")
    got = {r.doc_id: (r.text, r.n_lines, r.n_dropped) for r in drop_repeated_lines(docs).collect()}
    assert got == {1: ("Same line here\nown", 2, 0), 2: ("x", 3, 2), 3: ("short\nshort", 2, 0), 4: ("short", 1, 0)}


def near_groups(texts):
    """Brute force: component of each document by all pairs that share a shingle."""
    sets = {}
    for i, t in texts.items():
        w = (t or "").encode().lower().split()
        sets[i] = frozenset(tuple(w[k : k + 5]) for k in range(max(len(w) - 4, 1))) if w else frozenset()
    root = {i: i for i in texts}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(texts)
    for a in ids:
        for b in ids:
            if a < b and sets[a] & sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: (len(sets[i]), find(i)) for i in ids}


def test_near_dedup_against_brute_force(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet").select("doc_id", "text")
    base = " ".join(f"w{i}" for i in range(120)).split()
    more, at = [], 10_000
    rng = np.random.default_rng(1)
    for k in range(60):  # chains of near copies, some just linked and some just not
        w = list(base)
        for p in rng.choice(120, k % 9, replace=False):
            w[p] = f"x{k}_{p}"
        more.append((at + k, " ".join(w)))
    more += [(20_000, "one two"), (20_001, "ONE  two"), (20_002, "one two three"), (20_003, "")]
    docs = docs.unionByName(spark.createDataFrame(more, "doc_id long, text string"))
    want = near_groups({r.doc_id: r.text for r in docs.collect()})
    got = near_duplicates(docs).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def family(size, own, of, rng):
    """Texts of ``of`` words that share a template but for ``own`` words in one place."""
    base = [f"t{i}" for i in range(of)]
    for k in range(size):
        w = list(base)
        at = int(rng.integers(0, of - own))
        w[at : at + own] = [f"u{k}_{i}" for i in range(own)]
        yield " ".join(w)


def test_near_dedup_of_a_family_below_the_threshold(spark):
    """Texts that share a template are linked as the full sets say, whatever the share."""
    rng = np.random.default_rng(5)
    rows = [(k, t) for k, t in enumerate([*family(150, 16, 90, rng), *family(40, 5, 90, rng), *family(60, 40, 90, rng)])]
    rows += [(1000 + k, t.replace(f"u{k}_3", "changed")) for k, t in rows[:150:10]]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = near_groups(dict(rows))
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(docs).collect()} == want


def test_large_components_meet_the_same_members(spark, monkeypatch):
    """Whether a component is joined apart from its bucket or inside it, the pairs of members in different
    components are the same ones, each once."""
    rng, texts = np.random.default_rng(3), []
    for g in range(4):  # two groups of near copies each, held together by one pair of texts
        for k in range(110):
            w = [f"g{g}_{i}" for i in range(90)]
            if k >= 80:
                w[38:44] = [f"g{g}_other{i}" for i in range(6)]
            if k != 80:
                w[40 if k == 0 else int(rng.choice([*range(34), *range(48, 90)]))] = f"g{g}_own{k}"
            texts.append(" ".join(w))
    rows = list(enumerate(texts))
    inner, seen = minhash_dedup._pairs_apart, []

    def both(members, reps, percent):
        for most in (3, 1 << 30):
            monkeypatch.setattr(minhash_dedup, "LARGE", most)
            pairs, tested = inner(members, reps, percent)
            seen.append((sorted(map(tuple, pairs.collect())), tested.filter("large").count()))
        return pairs, tested

    monkeypatch.setattr(minhash_dedup, "CENTRES", 1)
    monkeypatch.setattr(minhash_dedup, "_pairs_apart", both)
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    (apart, some), (inside, none) = seen
    assert apart == inside and len(set(apart)) == len(apart) > 0 and some > 0 == none
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == near_groups(dict(rows))


def uncovered(raw, length):
    """Brute force: the bytes that stay of each text (by key), and the number of removed runs."""
    seen = Counter(b[p : p + length] for _, b in raw for p in range(len(b) - length + 1))
    out = []
    for i, b in raw:
        gone = np.zeros(len(b) + 2, bool)
        for p in range(len(b) - length + 1):
            if seen[b[p : p + length]] > 1:
                gone[p + 1 : p + 1 + length] = True
        kept = np.frombuffer(b, np.uint8)[~gone[1:-1]].tobytes()
        out.append((str(i), len(b), kept, int((np.diff(gone.astype(int)) == 1).sum())))
    return sorted(out)


def left_over(spark, rows, length, **options):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = remove_repeated(docs, length, **options).collect()
    assert all(r.n_removed == r.n_bytes - len(r.kept) for r in got)
    return sorted((str(r.doc_id), r.n_bytes, bytes(r.kept), r.n_spans) for r in got)


@pytest.mark.parametrize("group", [64, 2])
def test_suffix_dedup_against_brute_force(spark, group):
    rng = np.random.default_rng(2)
    word = lambda n: bytes(rng.integers(97, 123, n)).decode()
    shared, other = word(90), word(70)
    texts = [word(40) + shared + word(30) for _ in range(6)] + [word(25) + shared[:55] + word(9) + other + word(5) for _ in range(3)]
    texts += ["ab" * 60, "é" * 80, other[:49], shared[:50], word(200), shared + other, "", None]
    rows = list(enumerate(texts)) + [(99, texts[0])]
    raw = [(i, (t or "").encode()) for i, t in rows]
    assert left_over(spark, rows, 50, gram=16, group=group) == uncovered(raw, 50)


@pytest.mark.parametrize("n", [1, 1000])
def test_suffix_dedup_at_full_length(spark, n):
    """One anchor with one and with a thousand contents, three rows in ten without an id."""
    rng = np.random.default_rng(4)
    word = lambda k: bytes(rng.integers(97, 123, k)).decode()
    core, pairs = word(390), [word(700) for _ in range(3)]
    texts = [word(12) + core + word(12) for _ in range(n)] + [word(50) + p[:k] + word(50) for p in pairs for k in (450, 700)]
    texts += [texts[0][:405] + word(30), texts[-1], texts[-1], "", None, core]
    rows = [(None if i % 10 < 3 else i, t) for i, t in enumerate(texts)]
    assert left_over(spark, rows, 400) == uncovered([(i, (t or "").encode()) for i, t in rows], 400)


def test_suffix_order():
    rng = np.random.default_rng(3)
    data = rng.integers(97, 99, 400).astype(np.uint8)
    data = np.concatenate([data, data[50:250]])
    start, raw = np.arange(len(data)), data.tobytes()
    order = Suffixes(data, start, np.full(len(data), len(data)), 1000).order(np.zeros(len(data), int))
    assert list(order) == sorted(range(len(raw)), key=lambda i: raw[i:])
    seen = Counter(raw[i : i + 15] for i in range(len(raw) - 14))
    got = repeated_windows(data, start, np.full(len(data), len(data)), np.zeros(len(data), int), 15)
    assert list(got) == [i + 15 <= len(raw) and seen[raw[i : i + 15]] > 1 for i in range(len(raw))]


def thue_morse(n, flip=0):
    return bytes(97 + (bin(i).count("1") + flip) % 2 for i in range(n))


def test_structured_bytes_do_not_collide(spark):
    """Strings on which polynomials modulo a power of two collide for every base."""
    a, b = thue_morse(4096), thue_morse(4096, 1)
    both = np.frombuffer(a + b, np.uint8)
    start = np.array([0, 4096])
    h = LaneHash(both).slices(start, start + 4096)
    assert h[0] != h[1]
    hashes, counts = word_hashes([a, b, a])
    assert list(counts) == [1, 1, 1] and hashes[0] == hashes[2] != hashes[1]
    rows = [(1, a.decode()), (2, b.decode()), (3, a.decode().upper()), (4, " ".join(["x", a.decode()])), (5, " ".join(["x", b.decode()]))]
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in got} == {1: 1, 2: 2, 3: 1, 4: 4, 5: 5}


def test_near_dedup_links_a_repeated_id_by_each_text(spark):
    one, two = " ".join(f"a{i}" for i in range(40)), " ".join(f"b{i}" for i in range(40))
    rows = [(3, one), (7, one), (7, two), (9, two), (7, ""), (None, one), (None, None), (11, two + " more")]
    for order in (rows, rows[::-1]):
        got = near_duplicates(spark.createDataFrame(order, "doc_id long, text string").repartition(4)).collect()
        assert {(r.doc_id, r.n_shingles): (r.component_id, r.kept) for r in got} == {
            (3, 36): (3, True), (7, 36): (3, False), (9, 36): (3, False), (7, 0): (7, True),
            (None, 36): (None, True), (None, 0): (None, True), (11, 37): (3, False),
        }


def test_tokens_equal_the_library(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    texts = [r.text or "" for r in spark.read.parquet(f"{DIR}/documents.parquet").collect()]
    texts += ["a<|endoftext|>b <|endoftext|>", "'s 'LL don't\r\n\x85 x\xa0\x1c1²", "aaaaaaa" * 300, "日本語 🙂 ñ  ", "\t\t \n"]
    want = [len(e.ids) for e in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]
    assert MergeCounter(path).count(texts) == want


def test_top_k_ties_and_bad_vectors(spark):
    rows = [(i, [1.0, 0.0]) for i in range(0, 30)] + [(50, [1.0, 0.5]), (100, None), (150, [float("nan"), 1.0]), (200, [1.0]), (201, [2.0]), (51, []), (None, [1.0, 1.0])]
    out = top_k(spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(5), F.col("vec_id") % 50 == 0)
    got = defaultdict(list)
    for r in out.orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    assert got[0] == [(1, 65536), (2, 65536), (3, 65536), (4, 65536), (5, 65536)]
    assert got[50] == [(k, 65536) for k in range(5)] and got[200] == [(201, 131072)] and set(got) == {0, 50, 200}


def test_spans_map_to_the_original(spark):
    text = "Xx, one TWO--three four!! five six seven eight nine ten; rest"
    bench = spark.createDataFrame([(7, "One two three four five six seven eight nine TEN eleven"), (8, "rest")], "item_id long, text string")
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    for limit in (1 << 20, 40):  # one automaton, and several
        r = find_contamination(docs, bench, max_pattern_bytes=limit).first()
        s = r.hit_spans
        assert (r.n_words, r.n_hit, r.hit_items, text[s[0] : s[1]]) == (12, 11, ["7", "8"], text[4:])
    assert byte_spans(b"a b", []) == []


def test_perspectives(spark):
    rows = [(1, 0, "system", "s"), (1, 1, " User\t", "hi"), (1, 2, "assistant", "yo"), (1, 3, "bob", None), (2, 0, "system", "x"), (None, 0, "user", "y"), (3, None, None, "z")]
    out = rotate(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    assert {(r.conv_id, r.perspective) for r in out.collect()} == {(1, "user"), (1, "assistant"), (1, "bob"), (3, "unknown")}
    d = {r.perspective: r for r in dialogues(out).filter("conv_id = 1").collect()}
    assert d["bob"].dialogue == "<|turn|>system\ns<|end|><|turn|>user name=user\nhi<|end|><|turn|>user name=assistant\nyo<|end|><|turn|>assistant\n<|end|>"
    assert [d["user"].dialogue[s.start : s.end] for s in d["user"].spans] == ["<|turn|>assistant\nhi<|end|>"]


def test_mix_meets_targets(spark):
    rows = [(i, "w " * (i % 50 + 1), "abcd"[min(i % 13, 3)]) for i in range(2000)] + [(5000, None, None), (5001, "v", None)]
    got = mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    by = defaultdict(lambda: [0, 0, 0.0])
    for r in got:
        assert 0 <= r.taken <= 3 * r.size and (r.position is None or 0 <= r.position <= 1)
        by[r.source][0] += r.size
        by[r.source][1] += r.taken
        by[r.source][2] = r.target
    for size, taken, target in by.values():
        assert abs(taken - target) <= 1 and target <= 3 * size + 1e-6
    assert abs(sum(v[2] for v in by.values()) - sum(v[0] for v in by.values())) < 1e-6 * sum(v[0] for v in by.values())


def test_isotonic():
    x, y = isotonic(np.array([1.0, 2, 3, 4]), np.array([0.0, 1, 0, 1]), np.ones(4))
    assert list(zip(x, y)) == [(1.0, 0.0), (2.0, 0.5), (3.0, 0.5), (4.0, 1.0)]


@pytest.mark.parametrize("name,label,least", [("op3_quality_classifier", "quality", 0.95), ("op7_toxicity", "toxic", 0.85)])
def test_held_out_accuracy(spark, name, label, least):
    d = "/root/testdata/sf0.1"
    rows = registry.queries()[name](spark, d).filter("held_out").join(spark.read.parquet(f"{d}/labels.parquet"), "doc_id")
    right = rows.agg(F.avg((F.col("predicted") == F.col(label)).cast("double"))).first()[0]
    assert right >= least


def test_pipeline_against_its_stages(spark):
    """Every stage keeps the columns; the rows that pass are those that brute force lets pass."""
    import corpus_pipeline
    from netquill.llm.common import written

    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id: r.text for r in docs.collect()}
        out = written(stage(spark, docs, DIR), "test")
        assert out.columns == docs.columns, name
        after = {r.doc_id: r.text for r in out.collect()}
        if name == "near_dedup":
            want = near_groups(before)
            assert set(after) == {i for i in before if want[i][1] == i}
        if name == "line_dedup":
            assert set(after) == set(before)
        docs = out
    assert corpus_pipeline.run(spark, DIR).count() == docs.count()
