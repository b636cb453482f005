"""One text of several megabytes, its near copy and short neighbours, through every operator that takes texts."""

import hashlib
import re

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from gleanery.llm import bpe, exact_dedup, langid, near_join, packing, quality, sentence_spans, toxicity, warc


@pytest.fixture(scope="module")
def long_docs(spark):
    rng = np.random.default_rng(1)
    words = np.array([f"word{i}" if i % 5 else f"Größe{i}." for i in range(40_000)])
    long = " ".join(words[rng.integers(0, len(words), 400_000)])
    texts = [long, long + " and a few words more.", "short one", "", None, "unbroken" * 200_000]
    return texts, spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2).cache()


def test_tokens(long_docs):
    texts, docs = long_docs
    assert len(texts[0]) > 3_000_000
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    library.no_truncation()
    got = {r.doc_id: r for r in bpe.encode(docs, "text", public_tokenizers.path("byte_bpe_50k.json")).select("doc_id", F.size("ids").alias("n"), F.sha2(F.array_join("ids", ","), 256).alias("sha")).collect()}
    for i in (0, 2, 4):
        ids = library.encode(texts[i] or "", add_special_tokens=False).ids
        assert (got[i].n, got[i].sha) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
    pieces = packing.pack(docs, "doc_id", "text", public_tokenizers.path("word_bpe_49k.json")).where("doc_id = 0").collect()
    assert sum(p.length for p in pieces) > 400_000 and max(p.length for p in pieces) == packing.CAPACITY


def test_copies(long_docs):
    texts, docs = long_docs
    near = {r.doc_id: r for r in near_join.join_near(docs, "doc_id", "text").collect()}
    assert near[1].class_id == near[0].class_id == 0 and near[0].n_links == 1 and near[5].n_links == 0
    assert {r.doc_id: r.group_size for r in exact_dedup.dedup(docs, "doc_id", "text").collect()} == {0: 1, 1: 1, 2: 1, 3: 2, 4: 2, 5: 1}
    cut = {r.doc_id: r for r in sentence_spans.dedup_spans(docs, "doc_id", "text").collect()}
    assert cut[0].text == texts[0] and cut[0].n_removed == 0 and len(cut[1].text) < 200 and cut[5].text == texts[5]


def test_scores(long_docs):
    texts, docs = long_docs
    quality_of = {r.doc_id: r for r in quality.judge(docs, "doc_id", "text").collect()}
    assert quality_of[0].n_words == 400_000 and quality_of[0].word_chars == len(re.sub(r"\s", "", texts[0])) and quality_of[5].n_words == 1
    model = langid.fit({"xx": langid.count(["word"]), "yy": langid.count(["zzz"])})
    assert {r.doc_id: r.lang_pred for r in langid.identify(docs, "text", model, {"doc_id": F.col("doc_id")}).collect()} == {0: "xx", 1: "xx", 2: "xx", 3: "und", 4: "und", 5: "xx"}
    toxic = toxicity.Model(np.zeros(toxicity.BUCKETS, dtype=np.float32), 0.0)
    assert [r.score for r in toxicity.score(docs, "text", toxic, {}).collect()] == [0.5] * 6


def test_archive(long_docs):
    texts, docs = long_docs
    back = {r.doc_id: r for r in warc.archive(docs.withColumn("url", F.lit("u")), "doc_id", "url", "text").collect()}
    assert back[0].payload_bytes == len(texts[0].encode()) and (back[3].record_type, back[3].refers_to) == ("revisit", 4)
