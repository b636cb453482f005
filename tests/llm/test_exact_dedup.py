import hashlib
import random

import duckdb
import numpy as np

from gleanery.llm import exact_dedup, golomb


def test_golomb_round_trip():
    rng = np.random.default_rng(1)
    for n, bits in ((0, 20), (1, 60), (1000, 55), (5000, 14), (3, 2)):
        v = np.unique(rng.integers(0, 1 << bits, n, dtype=np.uint64))
        data, width = golomb.encode(v, bits)
        assert np.array_equal(golomb.decode(data, len(v), width), v)
        if n == 1000:
            assert len(data) < len(v) * 8 * 0.8


def fold(t):
    return (t or "").encode().lower()


def test_odd_rows(spark, odd_texts):
    rng = random.Random(4)
    texts = [*odd_texts, *[t.upper() if t and rng.random() < 0.5 else t for t in rng.choices(odd_texts, k=400)]]
    rows = [(None if i % 50 == 7 else i, t, 1, "z") for i, t in enumerate(texts)] + [(3, "same", 1, "z")] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string, keep_id int, key string").repartition(7)
    out = exact_dedup.dedup(docs, "doc_id", "text").collect()
    assert len(out) == len(rows)
    by = {}
    for r in rows:
        by.setdefault(hashlib.sha256(fold(r[1])).hexdigest(), []).append(r[0])
    seen = {}
    for r in out:
        ids = by[r.text_sha256]
        assert r.group_size == len(ids)
        assert r.keep_id == max((i for i in ids if i is not None), default=None)
        seen.setdefault(r.text_sha256, []).append(r)
    for sha, rs in seen.items():
        assert sum(r.kept for r in rs) == 1
        assert all(r.doc_id == r.keep_id for r in rs if r.kept)
        assert sorted(str(r.doc_id) for r in rs) == sorted(map(str, by[sha]))
    kept = exact_dedup.keep_one(docs, "doc_id", "text")
    assert kept.columns == docs.columns
    assert sorted(fold(r.text) for r in kept.collect()) == sorted({fold(r[1]) for r in rows})


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert exact_dedup.dedup(docs, "doc_id", "text").collect() == []
    assert exact_dedup.keep_one(docs, "doc_id", "text").collect() == []


def test_query_against_sql(spark, sf):
    got = exact_dedup.op2_exact_dedup(spark, sf)
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    want = con.sql(exact_dedup.OP2_SQL)
    cols = sorted(got.columns)
    assert sorted(map(str, (tuple(r[c] for c in cols) for r in got.collect()))) == sorted(map(str, con.sql(f"SELECT {','.join(cols)} FROM ({exact_dedup.OP2_SQL})").fetchall()))
    assert sorted(want.columns) == cols


def test_clashing_names_and_few_rows_a_sender(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "HELD", 3)
    rows = [(i, f"Text {i % 5}", 7, i) for i in range(40)] + [(100, None, 7, 1), (101, "", 7, 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, __key int, sha int").repartition(9)
    kept = exact_dedup.keep_one(docs, "doc_id", "text")
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [35, 36, 37, 38, 39, 101]
    out = {r.doc_id: (r.keep_id, r.group_size) for r in exact_dedup.dedup(docs, "doc_id", "text").collect()}
    assert out == {**{i: (35 + i % 5, 8) for i in range(40)}, 100: (101, 2), 101: (101, 2)}
