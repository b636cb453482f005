"""Operators whose order matters, stores and the incremental job."""

import json

import pytest
from pyspark.sql import functions as F

from gleanery.functions import dates, text
from gleanery.operators import relations as R
from gleanery.plans.base import normalized
from gleanery.sources import store as S
from gleanery.streaming import incremental


def indel(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        now = [0]
        for j, y in enumerate(b):
            now.append(row[j] + 1 if x == y else max(row[j + 1], now[j]))
        row = now
    return 2 * row[-1] / (len(a) + len(b)) if a or b else 1.0


def test_greedy_fold_against_one_ordered_pass(spark, sf):
    rows = sorted(normalized(spark, sf).select("row_ord", "slot_hash", "name_norm", "loc_norm", "stamp", "day").collect(), key=lambda r: r.row_ord)
    kept, want = [], {}
    minutes = lambda s: int(s[11:13]) * 60 + int(s[14:16])
    clock = lambda s: s[11:16] or "00:00"
    for r in rows:
        found = next((k for k in kept if k.slot_hash == r.slot_hash), None)
        if not found and r.day and r.loc_norm:
            found = next((k for k in kept if (k.name_norm, k.loc_norm, k.day) == (r.name_norm, r.loc_norm, r.day) and clock(k.stamp) == clock(r.stamp)), None)
            found = found or next((k for k in kept if k.day == r.day and k.loc_norm == r.loc_norm and abs(minutes(k.stamp) - minutes(r.stamp)) <= 30 and indel(k.name_norm, r.name_norm) >= 0.75), None)
        if not found:
            kept.append(r)
        want[r.row_ord] = found.row_ord if found else r.row_ord
    assert {r.row_ord: r.into for r in R.greedy_fold(normalized(spark, sf)).collect()} == want


def test_programme_fold_against_one_ordered_pass(spark, sf):
    rows = normalized(spark, sf).select("row_ord", "name", "name_norm", "url", "stamp", "loc_norm", F.col("name_norm").alias("head"))
    extra = [(10_000 + i, "Tai Chi", "tai chi", u, "2026-10-01T09:00", p, "tai chi") for i, (u, p) in enumerate([("u", ""), ("u", "hall"), ("v", "hall, 3 road"), ("u", "hall"), ("w", "park"), ("w", "park (rear)"), ("v", "other"), ("v", "hall")])]
    rows = rows.unionByName(spark.createDataFrame(extra, rows.schema))

    def compatible(a, b):
        if not a or not b:
            return False
        short, long = sorted((a, b), key=len)
        return a.split(",")[0].strip() == b.split(",")[0].strip() or (long.startswith(short) and long[len(short) : len(short) + 1] in tuple(" ,-/("))

    by_url, by_head, want = {}, {}, {}
    for r in sorted(rows.collect(), key=lambda r: r.row_ord):
        want[r.row_ord] = r.row_ord
        if not r.stamp or not r.name_norm:
            continue
        hit = by_url.get((r.url, r.name_norm, r.stamp))
        if hit is None or not compatible(hit.loc_norm, r.loc_norm):
            hit = next((k for k in by_head.get((r.head, r.stamp), []) if compatible(k.loc_norm, r.loc_norm)), None)
        if hit is not None:
            want[r.row_ord] = hit.row_ord
            continue
        by_url.setdefault((r.url, r.name_norm, r.stamp), r)
        by_head.setdefault((r.head, r.stamp), []).append(r)
    got = {r.row_ord: r.into for r in R.programme_fold(rows).collect()}
    assert got == want and sum(k != v for k, v in want.items()) > 3


def test_merge_aggregate(spark):
    rows = spark.createDataFrame(
        [
            ("a", 1, "u1", "Frankston, VIC", "", None, "", ""), ("a", 2, "", " ", "1 Road", None, "said", ""), ("a", 3, "u2", "Frankston Brewhouse", "2 Road", "2026-10-01 09:00:00", "more", "one day"),
            ("a", 4, "u1", "Chelsea", "", "2026-11-01 09:00:00", "", "other day"), ("a", 5, "u2", "Frankston, VIC", "", None, "", ""), ("b", 6, None, None, None, "2026-12-01 09:00:00", None, "own"), ("b", 7, "u3", "Hall", "x", "2026-12-02 09:00:00", "d", "not"),
        ],
        "k string, row_ord long, source string, location string, address string, ts string, description string, datetime_text string",
    ).withColumn("ts_local", F.col("ts").cast("timestamp_ntz")).drop("ts").repartition(3)
    out = {r.k: r for r in R.merge_groups(rows, ["k"]).collect()}
    a, b = out["a"], out["b"]
    assert (a.row_ord, a.location, a.address, a.description, a.source, a.sources, a.n) == (1, "Frankston Brewhouse", "1 Road", "said", "u2", ["u1", "u2"], 5)
    assert (str(a.ts_local), a.datetime_text) == ("2026-10-01 09:00:00", "one day")
    assert (b.row_ord, b.location, b.source, b.sources, str(b.ts_local), b.datetime_text) == (6, "Hall", "u3", ["", "u3"], "2026-12-01 09:00:00", "own")


def test_folds_agree(spark):
    chars = [chr(c) for c in [*range(1, 0xD800), *range(0xE000, 0x10000)]]
    one = [c for c in chars if len(text._fold_char(c)) <= 1]
    assert len(chars) - len(one) < 2_000
    words = ["Pošta Łódź café ñandú Ω", "ＡＢＣ１２", "e\u0301té", "Ž®©", "plain", "", None, *("".join(one[i : i + 500]) for i in range(0, len(one), 500))]
    rows = spark.createDataFrame([(w,) for w in words], "w string").select("w", text.fold_native(F.col("w")).alias("n"), text.fold_accents("w").alias("g")).collect()
    import unicodedata

    assert all((r.n is None and r.g is None) or unicodedata.normalize("NFC", r.n) == unicodedata.normalize("NFC", r.g) or len(r.w) == 500 for r in rows)
    assert rows[0].n == "Posta Łodz cafe nandu Ω"


@pytest.mark.parametrize(
    "name, want",
    [("Pošta (Mondays)", "posta"), ("Line Dancing (Tuesdays & Thursdays)", "line dancing"), ("Yoga (Gentle)", "yoga (gentle)"), ("Chatty Café - at noon", "chatty cafe"), ("Zumba® Gold (Mondays)", "zumba gold"), ("a-b: c", "a-b: c"), (None, "")],
)
def test_names(spark, name, want):
    row = spark.createDataFrame([(name,)], "n string").select(text.normalize_name(F.col("n")).alias("x"), text.fold_accents("n").alias("y")).first()
    assert row.x == want


def test_more_noise(spark):
    row = spark.createDataFrame([("Yoga (Term 4)",)], "n string").select(text.normalize_name(F.col("n")).alias("x"), text.normalize_name(F.col("n"), more_noise=True).alias("y")).first()
    assert (row.x, row.y) == ("yoga (term 4)", "yoga")


def test_scalars(spark):
    one = spark.createDataFrame([("84 Reserve Road", "2026-10-02T09:00:00Z")], "a string, t string")
    row = one.select(
        text.join_address(F.array("a", F.lit("Beaumaris"), F.lit("Beaumaris"), F.lit("Victoria 3193"), F.lit("Australia"))).alias("address"),
        dates.slot_stamp_raw(F.col("t")).alias("stamp"),
        dates.slot_stamp_raw(F.lit("2026-10-02")).alias("none"),
        dates.slot_stamp_raw(F.lit("badTstampvalue")).alias("odd"),
        dates.parse_time(F.lit("9.30am")).alias("t1"),
        dates.parse_time(F.lit("9 - 11am")).alias("t2"),
        dates.parse_time(F.lit("9 - 8pm")).alias("t3"),
        dates.parse_time(F.lit("12am")).alias("t4"),
        dates.parse_time(F.lit("2026")).alias("t5"),
        text.indel_similarity(F.lit("kitten"), F.lit("sitting")).alias("s"),
    ).first()
    assert row.address == "84 Reserve Road, Beaumaris, Victoria 3193"
    assert (row.stamp, row.none, row.odd) == ("2026-10-02T19:00", "", "badTstampvalue")
    assert (row.t1, row.t2, row.t3, row.t4, row.t5) == ("09:30", "09:00", None, "00:00", None)
    assert abs(row.s - indel("kitten", "sitting")) < 1e-12


def test_json_store(spark, tmp_path):
    at = str(tmp_path / "rows.json")
    assert S.read_json(spark, at).count() == 0
    (tmp_path / "rows.json").write_text(json.dumps([{"name": "A", "price_sort": 0.0}, {"name": "B"}]))
    rows = S.dispatch(spark, {"id": "x", "type": "listing", "snapshot": at})
    assert sorted((r.name, r.price_sort, r.source_id) for r in rows.collect()) == [("A", 0.0, "x"), ("B", None, "x")]
    (tmp_path / "bad.json").write_text('[{"name": "A"')
    with pytest.raises(Exception):  # noqa: B017
        S.read_json(spark, str(tmp_path / "bad.json")).collect()
    out = str(tmp_path / "store")
    for n in (3, 5):
        S.write_atomic(spark.range(n), out)
        assert S.read_store(spark, out).count() == n
    for n in (7, 8):
        S.write_atomic(spark.range(n), out)
    assert len([f for f in (tmp_path / "store").iterdir() if f.name.startswith("v-")]) == 2  # the rows and those before them
    spark.range(99).write.parquet(f"{out}/v-lost")  # what a crash before the pointer's rename leaves
    assert S.read_store(spark, out).count() == 8
    assert S.read_store(spark, str(tmp_path / "none")) is None and S.read_store(spark, str(tmp_path / "none"), "a int").count() == 0
    (tmp_path / "c.yaml").write_text("webfetch:\n- id: x\nsources:\n- {id: y}\n- {name: z}\n")
    (tmp_path / "c.json").write_text('{"sources": [{"id": "y"}]}')
    (tmp_path / "empty.yaml").write_text("\n")
    (tmp_path / "bad.yaml").write_text("a: [b")
    assert [e["group"] for e in S.read_config(spark, str(tmp_path / "c.yaml"))] == ["snapshot", "shared", "shared"]
    assert S.source_ids(spark, str(tmp_path / "c.yaml")) == {"x", "y"} and S.source_ids(spark, str(tmp_path / "c.json")) == {"y"}
    assert S.source_ids(spark, str(tmp_path / "empty.yaml")) == set()
    assert S.source_ids(spark, str(tmp_path / "bad.yaml")) is None and S.source_ids(spark, str(tmp_path / "no.yaml")) is None
    assert S.missing_sources(("a", "b"), ("b", "c")) == ["a"]


def test_stream_merge_is_idempotent(spark, tmp_path):
    schema = "slot_hash string, row_ord long, name string, ts_local timestamp_ntz"
    rows = spark.createDataFrame([(f"h{i % 4}", i, f"n{i}") for i in range(8)], "slot_hash string, row_ord long, name string").withColumn("ts_local", F.lit("2024-01-14 09:00:00").cast("timestamp_ntz"))
    rows.where("row_ord < 4").coalesce(1).write.parquet(str(tmp_path / "in"))
    go = lambda: incremental.run_merge(spark, str(tmp_path / "in"), schema, str(tmp_path / "store"), str(tmp_path / "cp"), "2024-01-15").awaitTermination(120)
    go()
    store = lambda: S.read_store(spark, str(tmp_path / "store"))
    first = sorted(store().collect())
    assert [r.row_ord for r in first] == [0, 1, 2, 3]
    go()
    assert sorted(store().collect()) == first
    before = S.state_of(spark, str(tmp_path / "store"))["folders"]
    rows.where("row_ord in (5, 6)").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    go()
    assert sorted(r.row_ord for r in store().collect()) == [0, 3, 5, 6]
    after = S.state_of(spark, str(tmp_path / "store"))["folders"]
    assert 0 < sum(before[b] == after[b] for b in before) < len(before)  # buckets without a new slot keep their files


def test_reconcile_does_not_drift(spark, sf):
    """The same live rows judged later drop nothing; a withdrawn series drops exactly its rows; an absent source drops none."""
    rows = normalized(spark, sf)
    assert R.reconcile(rows, rows).where("verdict = 'drop'").count() == 0
    gone = rows.where("source_id = 'click'").select("name_norm", "venue").first()
    live = rows.where(~((F.col("source_id") == "click") & (F.col("name_norm") == gone.name_norm) & (F.col("venue") == gone.venue)))
    stated = live.select("name_norm", "url", "stamp").where("stamp <> ''").distinct()
    want = rows.where((F.col("source_id") == "click") & (F.col("name_norm") == gone.name_norm) & (F.col("venue") == gone.venue)).join(stated, ["name_norm", "url", "stamp"], "left_anti").count()
    assert R.reconcile(rows, live).where("verdict = 'drop'").count() == want
    assert R.reconcile(rows, rows.where("source_id <> 'view'")).where("verdict = 'drop' AND why = 'unjudgeable'").count() == 0
