"""The pipeline against a brute-force version, stage by stage, and its contract."""

import numpy as np
import public_tokenizers

import corpus_pipeline as P
from gleanery.llm import toxicity

from .test_near_join import brute as near_brute
from .test_packing import check
from .test_sentence_spans import brute as span_brute


def expected(spark, sf):
    docs = sorted(spark.read.parquet(f"{sf}/documents.parquet").collect(), key=lambda r: r.doc_id)
    model = toxicity.learn(spark, spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet"))
    p = np.concatenate([model.score([d.text or ""]) for d in docs])
    rows = [(d.doc_id, d.text) for d, x in zip(docs, p, strict=True) if x < 0.5]
    by = {}
    for i, t in rows:
        by[(t or "").encode().lower()] = i
    kept = set(by.values())
    rows = [r for r in rows if r[0] in kept]
    root, _ = near_brute([t for _, t in rows])
    rows = [r for i, r in enumerate(rows) if root[i] == i]
    return rows, list(zip([i for i, _ in rows], span_brute([t for _, t in rows]), strict=True))


def test_run_and_stages(spark, sf):
    near, cut = expected(spark, sf)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    for name, stage in P.STAGES[:-1]:
        docs = stage(spark, docs, sf)
        assert docs.columns == columns, name
        if name == "n-gram Jaccard join":
            assert sorted((r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()) == near
    assert sorted((r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()) == cut
    assert 0 < len(cut) < spark.read.parquet(f"{sf}/documents.parquet").count()
    check(P.run(spark, sf).collect(), cut)


def test_names_and_sizes():
    assert 4 <= len(P.STAGES) <= 5 and all(callable(f) for _, f in P.STAGES)
    assert public_tokenizers.path("word_bpe_49k.json")


def test_stages_on_empty_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(0)
    for _, stage in P.STAGES:
        assert stage(spark, docs, sf).count() == 0


def test_stages_on_odd_rows(spark, sf, odd_texts):
    """Null and repeated ids, repeated rows, a very long text and columns that carry the operators' own names."""
    base = [(None if i % 6 == 0 else i // 2, t, "en", "s", len(t or "")) for i, t in enumerate(odd_texts[:120])]
    long = " ".join(f"word{i % 9973} goes on." if i % 7 else f"word{i}" for i in range(150_000))
    rows = [*base, *base[:10], (7, long, "en", "s", len(long)), (8, long + " and more", "en", "s", len(long) + 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int").selectExpr(
        "*", "1 AS __key", "2 AS key", "3 AS n_removed", "4 AS score", "'x' AS __row__", "5 AS label", "6 AS __starts2", "7 AS suspect", "8 AS `dotted.name`"
    ).repartition(5)
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.schema == docs.schema or [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in docs.schema], name
        got = out.collect()
        assert {tuple(r)[5:] for r in got} == {(1, 2, 3, 4, "x", 5, 6, 7, 8)}
        if name == "toxicity":
            assert sum(r.text is None for r in got) == sum(t[1] is None for t in rows)
        elif name == "exact dedup":
            assert len(got) == len({(r[1] or "").encode().lower() for r in rows})
        elif name == "n-gram Jaccard join":
            texts = [r[1] for r in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))]
            assert len(got) == len(set(near_brute([t if len(t or "") < 10**6 else t[:2000] for t in texts])[0]))
        else:
            assert len(got) == len(rows)
    pieces = P.pack_sequences(spark, docs, sf).collect()
    assert sum(p.piece == 0 for p in pieces) == len(rows)
