import math
import re
import zlib

import numpy as np
from pyspark.sql import functions as F

from gleanery.llm import common, langid, toxicity


def test_language_held_out(spark):
    d = "/root/testdata/sf0.01"
    docs = {r.doc_id: r for r in spark.read.parquet(f"{d}/documents.parquet").collect()}
    out = langid.op8_langid(spark, d).collect()
    assert len(out) == len(docs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in out)
    judged = [r.lang_pred == docs[r.doc_id].lang for r in out if r.held_out and docs[r.doc_id].lang]
    assert np.mean(judged) > 0.97
    assert all(0 <= r.score <= 1 for r in out)


def test_language_brute_force():
    train = {"xx": ["aba aba", "cab"], "yy": ["zed ezd"]}
    langs, log_p = langid.fit({k: langid.count(v) for k, v in train.items()})
    texts = ["aba cab!", "zed", "", "12 ..", "ΑΒΓ", "a"]
    lang, p = langid.score(texts, langs, log_p)
    assert lang[:2] == ["xx", "yy"] and lang[2:4] == ["und", "und"] and lang[4] in langs
    flat, off = langid._points(["aba"])
    per = {i: [] for i in range(3)}
    for k, (bucket, valid) in enumerate(langid.features(flat, off)):
        per[k] = bucket[valid].tolist()
    assert [len(per[k]) for k in range(3)] == [3, 2, 1] and per[0][0] == per[0][2]
    alone = [langid.score([t], langs, log_p) for t in texts]
    assert [a[0][0] for a in alone] == lang and np.allclose([a[1][0] for a in alone], p)


def test_language_odd_rows(spark, odd_texts):
    from pyspark.sql import functions as F

    rows = [(i if i % 9 else None, t, "l") for i, t in enumerate(odd_texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    model = langid.fit({"xx": langid.count(["aba"])})
    out = langid.identify(docs, "text", model, {"doc_id": F.col("doc_id")}).collect()
    assert len(out) == len(rows)
    assert all(r.lang_pred in ("xx", "und") for r in out)
    assert langid.identify(docs.limit(0), "text", model, {"doc_id": F.col("doc_id")}).collect() == []
    nothing = langid.train(docs.withColumn("lang", F.lit(None).cast("string")), "text", "lang")
    assert {r.lang_pred for r in langid.identify(docs, "text", nothing, {}).collect()} == {"und"}


def test_every_language_is_learned(spark, monkeypatch):
    words = {"aa": "aba", "bb": "bcb", "cc": "cdc", "dd": "ded", "ee": "efe"}
    rows = [(k, f"{w} {w}{w}") for k, w in words.items() for _ in range(3)] + [("aa", "aba"), (None, "zzz"), ("bb", None)]
    docs = spark.createDataFrame(rows, "lang string, text string")

    def judged():
        return [(r.lang, r.lang_pred, r.score) for r in langid.identify(docs, "text", langid.train(docs, "text", "lang"), {"lang": F.col("lang")}).collect()]

    whole = judged()
    monkeypatch.setattr(langid, "MOST_LANGUAGES", 2)
    cut = judged()
    assert all(pred == lang for (lang, text), (_, pred, _) in zip(rows, cut, strict=True) if lang and text)
    assert [x[:2] for x in cut] == [x[:2] for x in whole] and np.allclose([x[2] for x in cut], [x[2] for x in whole])


def test_toxicity_held_out(spark):
    d = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{d}/labels.parquet").collect()}
    out = toxicity.op6_toxicity(spark, d).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == (r.score >= 0.5) for r in out)
    judged = [(r.predicted, labels[r.doc_id]) for r in out if r.held_out and r.doc_id in labels]
    hit = sum(p and t for p, t in judged)
    assert hit / sum(t for _, t in judged) > 0.85  # some labelled toxic texts here hold no toxic word at all
    assert hit / sum(p for p, _ in judged) > 0.9


def test_counterfactual_penalty_frees_neutral_mentions():
    toxic = [f"those muslims are vile scum number{i}" for i in range(60)] + [f"you vile scum item{i}" for i in range(60)]
    clean = [f"a pleasant walk by the river day{i}" for i in range(110)] + [f"christians met at the hall day{i}" for i in range(10)]
    label = np.array([1] * len(toxic) + [0] * len(clean))
    neutral = ["muslims bought some bread"]
    free = toxicity.fit(toxic + clean, label, penalty=0.0).score(neutral)[0]
    fair = toxicity.fit(toxic + clean, label, penalty=20.0)
    assert fair.score(neutral)[0] < free
    assert fair.score(neutral)[0] < 0.5 <= fair.score(["those muslims are vile scum"])[0]
    assert abs(fair.score(neutral)[0] - fair.score([toxicity.swap_terms(neutral[0])])[0]) < abs(free - toxicity.fit(toxic + clean, label, penalty=0.0).score([toxicity.swap_terms(neutral[0])])[0])
    assert toxicity.swap_terms("Women and muslims.") == "men and christians."


def test_toxicity_odd_rows(spark, odd_texts):
    from pyspark.sql import functions as F

    rows = [(i if i % 9 else None, t, "l") for i, t in enumerate(odd_texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    labels = spark.createDataFrame([(None, 1), (1, None)], "doc_id long, toxic int")
    model = toxicity.learn(spark, docs, labels)
    out = toxicity.score(docs, "text", model, {"doc_id": F.col("doc_id")}).collect()
    assert len(out) == len(rows) and all(0 <= r.score <= 1 for r in out)
    assert toxicity.score(docs.limit(0), "text", model, {}).collect() == []


def plain_features(text):
    """The n-gram buckets of a text, character by character."""
    out = {}
    code = [ord(c) if "a" <= c <= "z" or ord(c) >= 0xAA else None for c in text.lower()]
    for order in langid.ORDERS:
        for end in range(order, len(code) + 1):
            gram = code[end - order : end]
            if any(c is not None for c in gram):
                total = 0
                for lag, c in enumerate(reversed(gram)):
                    total += ((32 if c is None else c) + 1) * pow(0x9E3779B1, lag + 1, 1 << 32)
                h = ((total & 0xFFFFFFFF) ^ (order * 0x85EBCA6B & 0xFFFFFFFF)) * 0xC2B2AE35 & 0xFFFFFFFF
                bucket = (h ^ (h >> 15)) & (langid.BUCKETS - 1)
                out[bucket] = out.get(bucket, 0) + 1
    return out


def test_language_against_plain_bayes(odd_texts):
    train = {"xx": ["aba aba", "Cab ñ"], "yy": ["zed ezd", "dez."], "zz": ["日本 go", "üb"]}
    counts = {}
    for lang, texts in train.items():
        counts[lang] = {}
        for t in texts:
            for b, n in plain_features(t).items():
                counts[lang][b] = counts[lang].get(b, 0) + n
    for lang, texts in train.items():
        assert {b: n for b, n in enumerate(langid.count(texts).tolist()) if n} == counts[lang]
    texts = [t or "" for t in odd_texts if len(t or "") < 2_000]
    lang, p = langid.score(texts, *langid.fit({k: langid.count(v) for k, v in train.items()}))
    for t, got, score in zip(texts, lang, p, strict=True):
        own = plain_features(t)
        if not any(c.isalpha() for c in t):
            assert (got, score) == ("und", 0)
            continue
        total = {k: sum(n * math.log((counts[k].get(b, 0) + 0.5) / (sum(counts[k].values()) + 0.5 * langid.BUCKETS)) for b, n in own.items()) for k in train}
        grams = sum(own.values())
        assert total[got] >= max(total.values()) - 1e-3 * max(1, grams)
        mean = {k: v / max(grams, 1) * min(grams, langid.EVIDENCE) for k, v in total.items()}
        top = max(mean.values())
        assert abs(score - 1 / sum(math.exp(v - top) for v in mean.values())) < 1e-3


def test_copies_do_not_swell_the_samples(spark, monkeypatch):
    same = [(7, "those vile people")] * 5_000
    other = [(100 + i, f"a quiet walk {i}" if i % 2 else f"vile scum {i}") for i in range(400)]
    docs = spark.createDataFrame(same + other, "doc_id long, text string").repartition(6)
    labels = spark.createDataFrame([(7, 1), (7, 0)] + [(i, 1 - i % 2) for i, _ in other], "doc_id long, toxic int")
    seen = []
    monkeypatch.setattr(toxicity, "fit_sample", lambda sample, *a: seen.append(sample))
    toxicity.learn(spark, docs, labels, most=200)
    assert len(seen[0].label) <= 200 and seen[0].label.sum() <= 100
    texts = docs.withColumn("lang", F.lit("xx"))
    monkeypatch.setattr(langid, "count", lambda t: seen.append(len(t)) or np.ones(langid.BUCKETS, dtype=np.int64))
    model = langid.train(texts.where("doc_id = 7"), "text", "lang", "doc_id")
    assert model[0][0] == ["xx"]
    kept = texts.select(F.xxhash64("doc_id", "text").alias("h")).distinct().count()
    assert kept == 401


def plain_toxic_features(text):
    out = set()
    for w in re.findall(r"[A-Za-z0-9\u0080-\U0010ffff]+", text):
        raw = re.sub("[A-Z]+", lambda m: m[0].lower(), w).encode()
        out.add(raw)
        out |= {("prefix", n, raw[:n]) for n in toxicity.PREFIXES if len(raw) > n}
    return out


def test_toxicity_against_plain_sums():
    rng = np.random.default_rng(8)
    words = [f"word{i}" for i in range(40)] + ["vile", "scum", "women", "Muslims"]
    texts = [" ".join(rng.choice(words, 12)) for _ in range(400)]
    label = np.array([("vile" in t) + 0 for t in texts])
    model = toxicity.fit(texts, label, penalty=2.0)
    weight = {}
    for w in words:  # a weight for each plain feature, read from a text of one word
        for f in plain_toxic_features(w):
            value = f if isinstance(f, bytes) else f[2]
            raw = np.frombuffer(value, dtype=np.uint8)
            h = toxicity.range_hash(raw, np.array([0]), np.array([len(raw)]))
            h = h if isinstance(f, bytes) else toxicity.mix(h + np.uint64(f[1]))
            weight[f] = model.weights[int(h[0]) % toxicity.BUCKETS]
    for t, got in zip(texts, model.score(texts), strict=True):
        total = model.bias + sum(float(weight[f]) for f in plain_toxic_features(t))
        assert abs(got - 1 / (1 + math.exp(-total))) < 1e-6

    def loss(weights, bias):
        m = toxicity.Model(weights, bias)
        p = np.clip(m.score(texts), 1e-12, 1 - 1e-12)
        named = [t for t in texts if toxicity._TERM.search(t)]
        gap = m.score(named) - m.score([toxicity.swap_terms(t) for t in named])
        return -np.mean(label * np.log(p) + (1 - label) * np.log(1 - p)) + 2.0 * np.mean(gap**2)

    best = loss(model.weights, model.bias)
    used = np.flatnonzero(model.weights)
    for _ in range(20):  # no small step away lowers the loss by much
        moved = model.weights.copy()
        moved[used] += rng.normal(0, 0.05, len(used)).astype(np.float32)
        assert loss(moved, model.bias) > best - 1e-3


def test_long_texts_in_windows(odd_texts, monkeypatch):
    texts = [t or "" for t in odd_texts]
    whole = langid.gram_counts(texts), toxicity.text_features(texts)
    monkeypatch.setattr(langid, "SLICE_CHARS", 11)
    monkeypatch.setattr(toxicity, "pieces", lambda t: common.pieces(t, 23))
    cut = langid.gram_counts(texts), toxicity.text_features(texts)
    for a, b in zip(whole[0] + whole[1], cut[0] + cut[1], strict=True):
        assert np.array_equal(a, b)
