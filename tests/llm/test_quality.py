import duckdb
import numpy as np

from gleanery.llm import quality


def rows_of(df):
    cols = sorted(df.columns)
    return sorted(map(str, (tuple(r[c] for c in cols) for r in df.collect())))


def sql(con):
    names = sorted(con.sql(quality.OP9_SQL).columns)
    return sorted(map(str, con.sql(f"SELECT {','.join(names)} FROM ({quality.OP9_SQL})").fetchall()))


def test_odd_texts_against_sql(spark, odd_texts, tmp_path):
    texts = [*odd_texts, "a b c a b c d", "x\n\nx\n x\nx\ny", " \n \n", "# a % b" * 30, "LOUD WORDS " * 3 + "quiet " * 60]
    rows = [(None if i % 40 == 3 else i, t, "q") for i, t in enumerate(texts)] + [(1, "same", "q")] * 2
    spark.createDataFrame(rows, "doc_id long, text string, kept string").write.parquet(str(tmp_path / "d"))
    got = quality.judge(spark.read.parquet(str(tmp_path / "d")), "doc_id", "text")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/d/*.parquet'")
    assert rows_of(got) == sql(con)


def test_empty(spark):
    assert quality.judge(spark.createDataFrame([], "doc_id long, text string"), "doc_id", "text").collect() == []


def batch_of(texts):
    raws = [t.encode() for t in texts]
    return quality.Batch(b"".join(raws), np.concatenate(([0], np.cumsum([len(r) for r in raws]))).astype(np.int64))


def test_order_and_short_circuit():
    texts = ["# " * 60, "plain words of some kind " * 20, "LOUD WORDS HERE " * 30]
    measured = quality.Cascade()
    measured.run(batch_of(texts), np.ones(3, dtype=bool))
    order = measured.order()
    assert sorted(order) == sorted(quality.RULES) and measured.seen == 3
    verdicts = {tuple(quality.Cascade(order=o).run(batch_of(texts), np.ones(3, dtype=bool)).tolist()) for o in (order, order[::-1])}
    assert verdicts == {(False, True, False)}
    seen = []
    rules = {"all": lambda b: seen.append(b.n) or np.arange(b.n) > 0, "next": lambda b: seen.append(b.n) or np.ones(b.n, dtype=bool)}
    alive = np.array([True, True, False, True])
    assert quality.Cascade(rules, ["all", "next"]).run(batch_of(list("abcd")), alive).tolist() == [False, True, False, True]
    assert seen == [3, 2]  # a rejected text is never seen again, however many are alive


def test_neighbours_do_not_matter(spark, odd_texts):
    words = "a b c d e f g h a b".split()
    texts = [" ".join(words), "c d e f", "b c d", "a b", "c", "a b c a b", "c a b", None, "", "a b c"] + odd_texts[:60]
    alone = []
    for t in texts:
        b = batch_of([t or ""])
        alone.append((int(b.n_repeat_words()[0]), int(b.n_dup_lines()[0])))
    assert alone[0] == (0, 0)
    rng = np.random.default_rng(4)
    for _ in range(20):
        order = rng.permutation(len(texts))
        b = batch_of([texts[i] or "" for i in order])
        assert list(zip(b.n_repeat_words().tolist(), b.n_dup_lines().tolist(), strict=True)) == [alone[i] for i in order]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert len({str(rows_of(quality.judge(docs.repartition(n), "doc_id", "text"))) for n in (1, 2, 211)}) == 1


def test_query(spark, sf):
    for folder in (sf, sf.replace("sf0.001", "sf0.01")):
        con = duckdb.connect()
        con.sql(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet'")
        assert rows_of(quality.op9_quality_rules(spark, folder)) == sql(con)
