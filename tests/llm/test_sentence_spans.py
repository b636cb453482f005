import random
import re

import numpy as np

from gleanery.llm import sentence_spans as S
from gleanery.llm import common, wordhash

from .conftest import WORDS


def units(text):
    """Sentences as lists of (word, start), brute force."""
    raw = text.encode()
    ws = [(m[0].lower() if m[0].isascii() else re.sub(rb"[A-Z]+", lambda k: k[0].lower(), m[0]), m.start(), m.end()) for m in re.finditer(rb"[A-Za-z0-9\x80-\xff]+", raw)]
    out = []
    for i, (w, a, b) in enumerate(ws):
        gap = raw[ws[i - 1][2] : a] if i else b""
        if not i or re.search(rb"\n|[.!?][ \t\n\v\f\r]", gap):
            out.append([])
        out[-1].append((w, a))
    return raw, [piece for unit in out for piece in pieces(unit)]


def pieces(unit):
    """A long sentence is cut after each word whose hash ends in two zero bits."""
    if len(unit) <= S.LONG:
        return [unit]
    out = [[]]
    for w, a in unit:
        out[-1].append((w, a))
        if int(wordhash.words(w, np.array([0, len(w)]))[3][0]) & 3 == 0:
            out.append([])
    return [p for p in out if p]


def brute(texts, W=S.WORDS, K=S.SENTENCES):
    """The texts with every covered byte of a repeat cut out, from all runs of all texts."""
    docs = [units(t or "") for t in texts]
    runs = []
    for d, (raw, us) in enumerate(docs):
        pairs = set()
        for i in range(len(us)):
            for j in range(i + K - 1, len(us)):
                if sum(map(len, us[i : j + 1])) >= W:
                    pairs.add((i, j))
                    break
            for h in range(i - K + 1, -1, -1):
                if sum(map(len, us[h : i + 1])) >= W:
                    pairs.add((h, i))
                    break
        for i, j in pairs:
            end = us[j + 1][0][1] if j + 1 < len(us) else len(raw)
            runs.append((tuple(w for u in us[i : j + 1] for w, _ in u), d, us[i][0][1], end))
    first = {}
    for h, d, a, _ in sorted(runs):
        first.setdefault(h, (d, a))
    gone = [set() for _ in docs]
    for h, d, a, b in runs:
        if first[h] != (d, a):
            gone[d].update(range(a, b))
    return [bytes(c for k, c in enumerate(raw) if k not in gone[d]).decode() for d, (raw, _) in enumerate(docs)]


def sentence(rng, n=None):
    return " ".join(f"{rng.choice(WORDS)}{rng.randint(0, 999)}é" for _ in range(n or rng.randint(1, 14))).capitalize() + rng.choice([". ", "! ", "?\n", ".\n", "\n"])


def corpus():
    rng = random.Random(8)
    passages = [[sentence(rng, rng.randint(3, 20)) for _ in range(rng.randint(5, 9))] for _ in range(4)]
    texts = [None, "", "...", "Short one. Two. Three.", "a\n" * 100, "one two three " * 60]
    for i in range(60):
        body = [sentence(rng) for _ in range(rng.randint(3, 25))]
        if i % 2:
            at = rng.randrange(len(body))
            body[at:at] = rng.choice(passages)
        texts.append("".join(body))
    return texts + [texts[9], texts[9], texts[11].upper().replace("É", "é")], passages


def test_against_brute_force(spark):
    texts, _ = corpus()
    docs = spark.createDataFrame([(i, t, 5, "k") for i, t in enumerate(texts)], "doc_id long, text string, n_removed int, key string").repartition(6)
    got = {r.doc_id: r for r in S.dedup_spans(docs, "doc_id", "text").collect()}
    want = brute(texts)
    assert len(got) == len(texts) and got[0].text is None
    for i, w in enumerate(want):
        assert (got[i].text or "") == w, i
        assert got[i].n_removed == len((texts[i] or "").encode()) - len(w.encode())
    assert got[len(texts) - 2].text == "" and got[0].key == "k"


def test_long_passages_go_and_clean_texts_stay(spark):
    """Passages of over 50 words are found wherever they stand, whatever their sentences are."""
    rng = random.Random(9)
    word = lambda: f"w{rng.randint(0, 10**9)}"
    for _ in range(5):
        sizes = rng.choice([[60], [30, 25], [5] * 11, [20, 20, 20], [1] * 55, [40, 3, 3, 9]])
        passage = " ".join(" ".join(word() for _ in range(n)) + "." for n in sizes)
        texts = [" ".join(word() for _ in range(30)) + ". " + passage + " " + " ".join(word() for _ in range(30)) + "." for _ in range(4)] + [" ".join(word() for _ in range(200))]
        docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
        got = {r.doc_id: r.text for r in S.dedup_spans(docs, "doc_id", "text").collect()}
        assert got[0] == texts[0] and got[4] == texts[4]
        for i in (1, 2, 3):
            left = set(got[i].replace(".", "").split()) & set(passage.replace(".", "").split())
            assert len(left) <= 8, (sizes, len(left))
            assert set(texts[i].replace(".", "").split()) - set(passage.replace(".", "").split()) == set(got[i].replace(".", "").split()) - left


def test_ids_and_empty(spark):
    texts, _ = corpus()
    docs = spark.createDataFrame([(None if i % 5 == 0 else i // 2, t) for i, t in enumerate(texts)], "doc_id long, text string")
    assert S.dedup_spans(docs, "doc_id", "text").count() == len(texts)
    assert S.dedup_spans(docs.limit(0), "doc_id", "text").collect() == []


def test_query(spark, sf):
    docs = sorted(spark.read.parquet(f"{sf}/documents.parquet").collect(), key=lambda r: r.doc_id)
    got = {r.doc_id: r.text for r in S.op5_sentence_spans(spark, sf).collect()}
    assert [got[d.doc_id] for d in docs] == brute([d.text for d in docs])


def test_passages_at_any_word_of_a_host():
    """Passages of over 50 words, put between any two words of other prose, lose most of their words in all documents but the first."""
    rng = random.Random(1)

    def prose(n):
        out = []
        while n > 0:
            m = min(rng.choice([1, 2, 3, 5, 8, 12, 20, 30]), n)
            out.append(" ".join(f"w{rng.randint(0, 10**9)}" for _ in range(m)).capitalize() + ".")
            n -= m
        return " ".join(out)

    shares = []
    for _ in range(100):
        passage = prose(rng.randint(51, 90)).split()
        texts = []
        for _ in range(3):
            host = prose(120).split()
            at = rng.randrange(len(host))
            texts.append(" ".join(host[:at] + passage + host[at:]).encode())
        raw, offsets = b"".join(texts), np.concatenate(([0], np.cumsum([len(t) for t in texts]))).astype(np.int64)
        h, _, row, start, end = S.span_runs(raw, offsets, S.WORDS, S.SENTENCES)
        order = np.lexsort((start, row, h))
        again = order[np.concatenate(([False], h[order][1:] == h[order][:-1]))]
        key, a, b = S._spans(row[again], start[again], end[again])
        assert 0 not in key
        for d in (1, 2):
            shares.append(sum(len(raw[offsets[d] + x : offsets[d] + y].split()) for k, x, y in zip(key, a, b, strict=True) if k == d) / len(passage))
    assert min(shares) > 0.6 and np.mean(shares) > 0.9


def test_long_values_hash_as_short_ones(monkeypatch):
    rng = np.random.default_rng(3)
    values = rng.integers(0, 256, 5000).astype(np.uint8)
    starts = rng.integers(0, 5000, 900)
    ends = np.minimum(starts + rng.integers(0, 3000, 900), 5000)
    want = wordhash.range_hash(values, starts, ends)
    monkeypatch.setattr(wordhash, "_tables", {})
    for block in (64, 1000, 4096, 5000):
        monkeypatch.setattr(wordhash, "BLOCK", block)
        assert np.array_equal(wordhash.range_hash(values, starts, ends), want)
        assert len(wordhash._tables[wordhash.BASE_A][0]) <= block + 1 or block > 4096
        wordhash._tables.clear()


def test_second_hash_tells_runs_apart(spark):
    entries = np.zeros(3, dtype=S._ENTRY)
    entries["hash"], entries["more"], entries["key"] = 5, [1, 1, 2], [3, 4, 9]
    got, first = S._firsts(entries)
    assert got["key"].tolist() == [3, 4, 9] and first.tolist() == [True, False, True]


def test_filter_keeps_all_that_have_spans(spark, monkeypatch):
    monkeypatch.setattr(common, "LEAST_BITS", 1 << 6)
    monkeypatch.setattr(common, "MOST_BITS", 1 << 8)  # nearly full: all but few pass
    docs = spark.createDataFrame([(i * 37 - 500, f"t{i}", i) for i in range(900)], "k long, t string, __bits int").drop("__bits")
    for step in (3, 50):
        spans = spark.createDataFrame([(i * 37 - 500, [0], [1]) for i in range(0, 900, step)], "key long, starts array<long>, ends array<long>")
        out = S.with_spans(docs, "k", spans).collect()
        assert len(out) == 900
        assert {r.k for r in out if r["__starts"]} == {r.key for r in spans.collect()}


def test_column_names(spark):
    text = " ".join(f"word{i} follows." for i in range(60))
    docs = spark.createDataFrame([(1, text, 5, 6), (2, text, 7, 8)], "doc_id long, text string, n_removed int, __key int")
    out = {r.doc_id: r for r in S.dedup_spans(docs, "doc_id", "text", "cut_bytes").collect()}
    assert out[2].n_removed == 7 and out[2]["__key"] == 8 and out[2].cut_bytes == len(text) and out[1].cut_bytes == 0 and out[2].text == ""
