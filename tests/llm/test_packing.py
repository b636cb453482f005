import random
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from gleanery.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


def brute(lengths, capacity):
    bins = []
    for n in sorted(lengths, reverse=True):
        fit = [b for b in bins if b >= n]
        if fit:
            best = min(fit)
            bins.remove(best)
            bins.append(best - n)
        else:
            bins.append(capacity - n)
    return len(bins)


def test_tightest_fit():
    tree, rng, have = packing.TightestFit(50), random.Random(1), set()
    for _ in range(2000):
        x = rng.randint(0, 50)
        have ^= {x}
        tree.mark(x, x in have)
        y = rng.randint(0, 50)
        assert tree.find(y) == min((h for h in have if h >= y), default=-1)


def test_plan_is_best_fit_decreasing():
    rng = random.Random(2)
    for _ in range(60):
        capacity = rng.choice([10, 37, 100])
        lengths = [rng.randint(1, capacity) for _ in range(rng.randint(0, 300))]
        histogram = {n: lengths.count(n) for n in set(lengths)}
        fill, seen = {}, {}
        for length, rank, n, first, each, used in packing.best_fit_plan(histogram, capacity):
            for j in range(n):
                fill.setdefault(first + j // each, []).append((used + j % each * length, length))
                assert seen.setdefault(length, set()).isdisjoint({rank + j})
                seen[length].add(rank + j)
        assert {k: len(v) for k, v in seen.items()} == histogram
        for parts in fill.values():
            at = 0
            for offset, length in sorted(parts):
                assert offset == at
                at += length
            assert at <= capacity
        assert len(fill) == brute(lengths, capacity)


def check(rows, texts, capacity=4096):
    library = Tokenizer.from_file(PATH)
    want = []
    for doc_id, t in texts:
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 1]
        for k, s in enumerate(range(0, len(ids), capacity)):
            own = np.array(ids[s : s + capacity], dtype="<u4")
            want.append((doc_id is not None, doc_id or 0, k, s, len(own), zlib.crc32(own.tobytes())))
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == sorted(want)
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    assert len(by) == brute([r.length for r in rows], capacity)


def test_odd_documents(spark, odd_texts):
    texts = [(i if i % 9 else None, t) for i, t in enumerate(odd_texts)] + [(3, "same"), (3, "same")]
    docs = spark.createDataFrame([(i, t, 1) for i, t in texts], "doc_id long, text string, length int").repartition(5)
    check(packing.pack(docs, "doc_id", "text", PATH).collect(), texts)
    assert packing.pack(docs.limit(0), "doc_id", "text", PATH).collect() == []


def test_query(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    check(packing.op7_packing(spark, sf).collect(), [(d.doc_id, d.text) for d in docs])
