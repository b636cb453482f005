import random
import re

import duckdb
import numpy as np
from pyspark.sql import functions as F

from gleanery.llm import common, near_join
from gleanery.llm.components import components

from .conftest import WORDS


def shingle_set(t):
    w = re.findall(r"[A-Za-z0-9\u0080-\U0010ffff]+", t or "")
    w = [re.sub("[A-Z]+", lambda m: m[0].lower(), x) for x in w]
    return frozenset(tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))) if w else frozenset()


def brute(texts):
    sets = [shingle_set(t) for t in texts]
    n = len(sets)
    label, links = list(range(n)), [0] * n

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for i in range(n):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 5 * common >= 4 * (len(sets[i]) + len(sets[j]) - common):
                links[i] += 1
                links[j] += 1
                a, b = find(i), find(j)
                label[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)], links


def family(rng, base, n, edits):
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(rng.randint(0, edits)):
            w[rng.randrange(len(w))] = f"edit{rng.randint(0, 9999)}"
        out.append(" ".join(w))
    return out


def corpus():
    rng = random.Random(6)
    texts = [None, "", "one two", "One, two!", "a b c d", "!!", "x" * 5000]
    for size, edits in ((60, 4), (30, 2), (12, 6), (5, 1)):
        base = [f"{rng.choice(WORDS)}{rng.randint(0, 400)}" for _ in range(rng.randint(60, 150))]
        texts += family(rng, base, size, edits)
    texts += [" ".join(f"{rng.choice(WORDS)}{rng.randint(0, 99)}" for _ in range(80)) for _ in range(60)]
    texts += rng.choices(texts, k=40)
    return texts


def by_rule(threshold):
    return [1 - (1 - threshold ** (d + 1)) ** near_join.TREES for d in range(near_join.DEPTH)]


def test_prefix_is_shortened_until_the_target():
    assert near_join.prefix_depth(by_rule(0.8)) == 6
    assert near_join.prefix_depth(by_rule(0.999)) == near_join.DEPTH
    assert near_join.prefix_depth(by_rule(0.01)) == 1
    assert near_join.prefix_depth(by_rule(0.8), 0.99) == near_join.DEPTH


def test_planted_pairs_show_the_recall(spark):
    rng = np.random.default_rng(2)
    own = [np.unique(rng.integers(0, 2**63, n).astype(np.uint64)) for n in (9, 40, 333, 1000)]
    for x in own:
        y = near_join.planted_partner(x, 4, 5, 1)
        common = len(np.intersect1d(x, y))
        assert 5 * common >= 4 * len(np.union1d(x, y)) and 5 * (common - 1) < 4 * (len(x) + len(y) - common + 1)
    assert near_join.planted_partner(own[0][:5], 4, 5, 1) is None
    docs = spark.createDataFrame([(i, " ".join(f"w{x}" for x in rng.integers(0, 10**6, 120))) for i in range(1500)], "k long, t string")
    rows = near_join.signature_rows(docs, "k", "t", 4, 5)
    recall = near_join.measured_recall(rows, 0.8)
    assert np.allclose(recall, by_rule(0.8), atol=0.004) and recall != by_rule(0.8)
    # with a hash family that never agrees, the measurement shortens the prefix where a formula would not
    bad = rows.withColumn("planted", F.transform(F.array_repeat(F.lit(0), near_join.DEPTH), lambda x: x))
    assert near_join.prefix_depth(near_join.measured_recall(bad, 0.8)) < 6


def test_runs_of_a_trie_share_a_prefix():
    rng = np.random.default_rng(5)
    sig, key = rng.integers(0, 2, (200, near_join.DEPTH)).astype(np.uint16), rng.permutation(200)
    for depth in (1, 3, near_join.DEPTH):
        order, start, least = near_join._trie_runs(sig, key, depth)
        want = {}
        for s, k in zip(sig.tolist(), key.tolist(), strict=True):
            want[tuple(s[:depth])] = min(want.get(tuple(s[:depth]), 999), k)
        assert [want[tuple(sig[o, :depth].tolist())] for o in order] == least.tolist() and len(start) == len(want)


def test_links_exact():
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 60, rng.integers(1, 50)).astype(np.uint64)) for _ in range(40)]
    want = np.array([[5 * len(set(a) & set(b)) >= 4 * len(set(a) | set(b)) for b in sets] for a in sets])
    assert np.array_equal(near_join._links(sets, None, 4, 5), want)
    assert np.array_equal(near_join._links(sets[:15], sets[15:], 4, 5), want[:15, 15:])


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(200)] + [(1000 + i, 1001 + i) for i in range(40)] + [(5000, 5000 + i) for i in range(200)]
    out = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    label = {}

    def find(x):
        label.setdefault(x, x)
        while label[x] != x:
            x = label[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        label[max(x, y)] = min(x, y)
    assert out == {x: find(x) for e in edges if e[0] != e[1] for x in e}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(near_join, "PART_WISH", 16)  # blocks in several parts
    monkeypatch.setattr(near_join, "_STRIP", 7)  # and tiles in several matrices
    monkeypatch.setattr(near_join, "_SMALL", 20)
    texts = corpus()
    root, links = brute(texts)
    docs = spark.createDataFrame([(i, t, "k", 1) for i, t in enumerate(texts)], "doc_id long, text string, key string, n_links int").repartition(5)
    out = near_join.join_near(docs, "doc_id", "text").collect()
    assert len(out) == len(texts)
    got = {r.doc_id: r for r in out}
    assert [got[i].class_id for i in range(len(texts))] == root
    assert [got[i].n_links for i in range(len(texts))] == links
    kept = near_join.keep_one(docs, "doc_id", "text")
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(root))


def test_beyond_the_broadcast(spark, monkeypatch):
    texts = corpus()
    root, links = brute(texts)
    monkeypatch.setattr(near_join, "BROADCAST_IDS", 4)
    monkeypatch.setattr(common, "BROADCAST_IDS", 4)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r.doc_id: r for r in near_join.join_near(docs, "doc_id", "text").collect()}
    assert [got[i].class_id for i in range(len(texts))] == root and [got[i].n_links for i in range(len(texts))] == links
    kept = near_join.keep_one(docs.withColumn("a.b", F.lit(1)), "doc_id", "text")
    assert kept.columns == ["doc_id", "text", "a.b"] and sorted(r.doc_id for r in kept.collect()) == sorted(set(root))
    ids = spark.range(0, 400, 3).withColumnRenamed("id", "doc_id")
    inside = sorted(r.doc_id for r in common.semi_by_key(docs, ids, "doc_id", 134).collect())
    assert inside == [i for i in range(0, len(texts), 3)]


def test_null_and_repeated_ids(spark):
    texts = corpus()[:80]
    _, links = brute(texts)
    docs = spark.createDataFrame([(None if i % 7 == 0 else i // 2, t) for i, t in enumerate(texts)], "doc_id long, text string")
    out = near_join.join_near(docs, "doc_id", "text").collect()
    assert sorted((str(r.doc_id), r.n_links) for r in out) == sorted((str(None if i % 7 == 0 else i // 2), n) for i, n in enumerate(links))
    assert near_join.join_near(docs.limit(0), "doc_id", "text").collect() == []


def test_ids_stay_ids(spark):
    docs = spark.createDataFrame([(70, "a b c d e f g"), (70, "q w e r t y u"), (50, "A b c d e f g"), (None, "a b c d e f g"), (60, "k k")], "doc_id long, text string")
    out = {(r.doc_id, r.class_id, r.rep_id, r.copies, r.n_links) for r in near_join.join_near(docs, "doc_id", "text").collect()}
    assert out == {(None, None, None, 3, 2), (50, None, None, 3, 2), (70, None, None, 3, 2), (70, 70, 70, 1, 0), (60, 60, 60, 1, 0)}
    named = spark.createDataFrame([("x", "a b"), ("b", "A b")], "__key string, text string")
    assert {(r["__key"], r.class_id) for r in near_join.join_near(named, "__key", "text").collect()} == {("x", "b"), ("b", "b")}
    kept = near_join.keep_one(docs.withColumn("__KEY", F.lit(1)), "doc_id", "text")
    assert kept.columns == ["doc_id", "text", "__KEY"] and kept.count() == 3


def test_sql(spark):
    d = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{d}/documents.parquet'")
    names = "doc_id, class_id, rep_id, copies, n_links"
    want = sorted(con.sql(f"SELECT {names} FROM ({near_join.OP3_SQL})").fetchall())
    assert sorted(tuple(r) for r in near_join.op3_ngram_jaccard(spark, d).selectExpr(*names.split(", ")).collect()) == want


def test_query(spark, sf):
    docs = sorted(spark.read.parquet(f"{sf}/documents.parquet").collect(), key=lambda r: r.doc_id)
    root, links = brute([d.text for d in docs])
    out = {r.doc_id: r for r in near_join.op3_ngram_jaccard(spark, sf).collect()}
    assert [out[d.doc_id].class_id for d in docs] == [docs[r].doc_id for r in root]
    assert [out[d.doc_id].n_links for d in docs] == links
