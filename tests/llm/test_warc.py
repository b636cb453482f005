import base64
import hashlib
import io
import os

import duckdb
import pytest

from gleanery.llm import warc


def expect(rows):
    """rows: (id, html) with unique ids."""
    top = {}
    for i, h in rows:
        top[h or ""] = max(top.get(h or "", i), i)
    out = []
    for i, h in rows:
        raw = (h or "").encode()
        to = top[h or ""]
        out.append((i, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "response" if to == i else "revisit", None if to == i else to))
    return sorted(out)


def flat(df, key="page_id"):
    return sorted((r[key], r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in df.collect())


def test_round_trip_rolls_and_repeats(spark, tmp_path, odd_texts):
    rows = [(i * 3, "http://a.example/\r\nx" if i % 2 else None, t, "y") for i, t in enumerate([*odd_texts, *odd_texts[:50]])]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, payload_bytes string").repartition(4)
    names = {}
    for run in ("a", "b"):
        folder = f"file://{tmp_path}/{run}"
        warc.write(pages.withColumn("k", pages.page_id), "k", "url", "html", folder, roll_bytes=5_000)
        names[run] = {f: open(f"{tmp_path}/{run}/{f}", "rb").read() for f in sorted(os.listdir(f"{tmp_path}/{run}")) if not f.endswith(".crc")}
        assert flat(warc.read(spark, folder), "page") == expect([(r[0], r[2]) for r in rows])
    assert names["a"] == names["b"]
    assert len(names["a"]) > 4 and not any("tmp" in f for f in names["a"])
    assert flat(warc.archive(pages, "page_id", "url", "html")) == expect([(r[0], r[2]) for r in rows])


def test_null_and_repeated_ids(spark):
    pages = spark.createDataFrame([(None, "u", "p"), (None, "u", "p"), (1, "u", "p"), (1, "u", "p"), (2, None, None), (0, "v", "")], "page_id long, url string, html string")
    out = warc.archive(pages, "page_id", "url", "html").collect()
    assert len(out) == 6
    assert sum(r.record_type == "response" for r in out) == 2
    assert [r.refers_to for r in out if r.page_id is None] == [1, 1]
    assert warc.archive(pages.limit(0), "page_id", "url", "html").collect() == []


def test_same_bytes_under_other_settings(spark, tmp_path, odd_texts, monkeypatch):
    monkeypatch.setattr(warc, "LEAST_SHARD", 20_000)
    rows = [(i * 7 - 300, f"http://ü.example/{i} x", t) for i, t in enumerate([*odd_texts, *odd_texts[:9]])]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    names = []
    for parts in (3, 11):
        spark.conf.set("spark.sql.shuffle.partitions", str(parts))
        folder = f"file://{tmp_path}/{parts}"
        manifest = warc.write(pages.repartition(parts), "page_id", "url", "html", folder).collect()
        names.append({f: open(f"{tmp_path}/{parts}/{f}", "rb").read() for f in sorted(os.listdir(f"{tmp_path}/{parts}")) if not f.endswith(".crc")})
        assert len({r.name[:12] for r in manifest}) > 5 and sum(r.records for r in manifest) == len(rows)
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert names[0] == names[1]
    first = next(warc.members(io.BytesIO(names[0]["shard-000000-00000.warc.gz"])))
    assert b"WARC-Type: warcinfo" in first


def test_records():
    assert warc.target_uri(3, "http://ü.example/a b\r\n%20") == "http://%C3%BC.example/a%20b%0D%0A%20"
    assert warc.target_uri(3, None) == warc.target_uri(3, "") == "urn:page:3"
    data = warc.member(warc.info_record("x")) + warc.member(warc.record(1, "u", b"p" * 3_000_000, None)) + warc.member(warc.record(2, "u", b"p" * 3_000_000, 1))
    got = list(warc.records(io.BytesIO(data)))
    assert [(f["x-page"], len(p)) for f, p in got] == [("1", 3_000_000), ("2", 0)]
    assert got[1][0]["warc-refers-to"] == got[0][0]["warc-record-id"]
    with pytest.raises(ValueError):
        list(warc.records(io.BytesIO(data[:-9])))


def test_a_revisit_of_nothing_fails(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "p"), (2, "u", "p"), (3, "u", "q")], "page_id long, url string, html string")
    folder = f"file://{tmp_path}/w"
    warc.write(pages, "page_id", "url", "html", folder)
    assert flat(warc.read(spark, folder), "page") == expect([(1, "p"), (2, "p"), (3, "q")])
    name = next(f for f in os.listdir(f"{tmp_path}/w") if f.endswith(".gz"))
    with open(f"{tmp_path}/w/{name}", "wb") as out:
        out.write(warc.member(warc.record(1, "u", b"p", 2)))
    with pytest.raises(Exception, match="nothing"):
        warc.read(spark, folder).collect()


def test_sql(spark):
    d = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.sql(f"CREATE VIEW pages AS SELECT * FROM '{d}/pages.parquet'")
    names = "page_id, payload_bytes, payload_digest, record_type, refers_to"
    assert flat(warc.op10_warc(spark, d)) == sorted(con.sql(f"SELECT {names} FROM ({warc.OP10_SQL})").fetchall())


def test_query(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet").collect()
    assert flat(warc.op10_warc(spark, sf)) == expect([(p.page_id, p.html) for p in pages])
