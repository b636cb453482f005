"""Joins, de-duplication, aggregation, windows, sorting and set operations over the listings."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from gleanery.functions import text
from gleanery.operators import guides
from gleanery.operators import relations as R

from .base import TODAY, normalized, query

_COMPAT = """({a} <> '' AND {b} <> '' AND (trim(split_part({a}, ',', 1)) = trim(split_part({b}, ',', 1)) OR
 (starts_with(CASE WHEN length({a}) <= length({b}) THEN {b} ELSE {a} END, CASE WHEN length({a}) <= length({b}) THEN {a} ELSE {b} END)
  AND substring(CASE WHEN length({a}) <= length({b}) THEN {b} ELSE {a} END, least(length({a}), length({b})) + 1, 1) IN (' ', ',', '-', '/', '('))))"""


def compat(a: str, b: str) -> str:
    return _COMPAT.replace("{a}", a).replace("{b}", b)


def halves(spark, sf):
    """Store: the even rows. Live: the odd rows and every fourth even one."""
    rows = normalized(spark, sf)
    return rows.where("row_ord % 2 = 0"), rows.where("row_ord % 2 = 1 OR row_ord % 8 = 0")


_HALVES = ", st AS (SELECT * FROM l WHERE row_ord % 2 = 0), lv AS (SELECT * FROM l WHERE row_ord % 2 = 1 OR row_ord % 8 = 0)\n"


@query("agg_exact_dedupe__D02", "SELECT slot_hash, min(row_ord) AS kept, count(*) AS n FROM l GROUP BY slot_hash", listing=True)
def exact_dedupe(spark, sf):
    return R.exact_dedupe(normalized(spark, sf))


@query("join_exact_merge__J01_W01", _HALVES + "SELECT lv.row_ord AS r, min(st.row_ord) AS into_row FROM lv JOIN st USING (slot_hash) GROUP BY 1", listing=True)
def exact_merge(spark, sf):
    st, lv = halves(spark, sf)
    first = st.groupBy("slot_hash").agg(F.min("row_ord").alias("into_row"))
    return lv.join(first, "slot_hash").select(F.col("row_ord").alias("r"), "into_row")


@query("join_name_location__J02_P20_P21", _HALVES + """SELECT st.row_ord AS l, lv.row_ord AS r FROM st JOIN lv USING (name_norm, loc_norm, day) WHERE day <> '' AND loc_norm <> ''
 AND coalesce(nullif(substring(st.stamp, 12, 5), ''), '00:00') = coalesce(nullif(substring(lv.stamp, 12, 5), ''), '00:00')""", listing=True)  # fmt: skip
def name_location(spark, sf):
    return R.name_location_pairs(*halves(spark, sf))


_LCS = """list_last(list_reduce(list_transform(string_split(a,''), lambda ch: [ch]), lambda prev,ch: list_reduce(list_transform(range(1,length(b)+1), lambda j: [j::VARCHAR]), lambda cur,j: list_append(cur,
 (CASE WHEN b[j[1]::INT]=ch[1] THEN prev[j[1]::INT]::INT+1 ELSE greatest(prev[j[1]::INT+1]::INT, cur[-1]::INT) END)::VARCHAR), ['0']), list_transform(range(0,length(b)+1), lambda _: '0')))"""


@query("join_fuzzy__J03_P22", _HALVES + f""", p AS (SELECT st.row_ord AS l, lv.row_ord AS r, st.name_norm AS a, lv.name_norm AS b FROM st JOIN lv USING (day, loc_norm)
  WHERE day <> '' AND loc_norm <> '' AND st.name_norm <> lv.name_norm AND abs(epoch(st.ts_local) - epoch(lv.ts_local)) <= 1800),
 d AS (SELECT DISTINCT a, b FROM p WHERE 2 * least(length(a), length(b)) >= 0.75 * (length(a) + length(b))), s AS (SELECT a, b, round(2.0 * ({_LCS})::INT / (length(a) + length(b)), 6)::DOUBLE AS similarity FROM d)
 SELECT l, r, similarity FROM p JOIN s USING (a, b) WHERE similarity >= 0.75""", listing=True)  # fmt: skip
def fuzzy(spark, sf):
    return R.fuzzy_pairs(*halves(spark, sf))


@query("join_programme__P19", ", b AS (SELECT * FROM l WHERE stamp <> '' AND name_norm <> '')," + f"""
 p AS (SELECT x.row_ord, y.row_ord AS into_row, x.url <> y.url AS other FROM b x JOIN b y ON x.name_norm = y.name_norm AND x.stamp = y.stamp AND y.row_ord < x.row_ord AND {compat('x.loc_norm', 'y.loc_norm')}),
 q AS (SELECT row_ord, min({{'other': other, 'i': into_row}}) AS m FROM p GROUP BY row_ord) SELECT row_ord, m.i AS into_row, NOT m.other AS same_url FROM q""", listing=True)  # fmt: skip
def programme(spark, sf):
    return R.programme_pairs(normalized(spark, sf)).withColumnRenamed("into", "into_row")


@query("join_untimed_twins__J05", """SELECT row_ord FROM l WHERE NOT ends_with(stamp, 'T00:00') OR NOT EXISTS (SELECT 1 FROM l t WHERE t.stamp <> '' AND NOT ends_with(t.stamp, 'T00:00') AND t.name_norm = l.name_norm AND t.venue = l.venue)""", listing=True)
def untimed(spark, sf):
    return R.drop_untimed_twins(normalized(spark, sf)).select("row_ord")


@query("join_superseded__J06_W02", _HALVES + f""", many AS (SELECT name_norm, url FROM l GROUP BY 1, 2 HAVING count(*) > 1),
 c AS (SELECT * FROM l WHERE regexp_matches(description, '(?i)\\bnext date:') AND (name_norm, url) IN (SELECT name_norm, url FROM many) AND source_id IN (SELECT source_id FROM lv)),
 g AS (SELECT row_ord FROM c WHERE NOT EXISTS (SELECT 1 FROM lv WHERE lv.name_norm = c.name_norm AND lv.url = c.url AND lv.stamp = c.stamp AND (c.loc_norm = '' OR c.loc_norm = lv.loc_norm OR {compat('c.loc_norm', 'lv.loc_norm')})))
 SELECT row_ord FROM l WHERE row_ord NOT IN (SELECT row_ord FROM g)""", listing=True)  # fmt: skip
def superseded(spark, sf):
    _, lv = halves(spark, sf)
    return R.drop_superseded(normalized(spark, sf), lv, lv.select("source_id").distinct()).select("row_ord")


@query("join_slot_stated__J07", _HALVES + f"""SELECT row_ord FROM st WHERE EXISTS (SELECT 1 FROM lv WHERE lv.name_norm = st.name_norm AND lv.url = st.url AND lv.stamp = st.stamp
 AND (st.loc_norm = '' OR st.loc_norm = lv.loc_norm OR {compat('st.loc_norm', 'lv.loc_norm')}))""", listing=True)  # fmt: skip
def stated(spark, sf):
    return R.slot_is_stated(*halves(spark, sf))


@query("join_reconcile__J08_T03", _HALVES + """, k AS (SELECT *, substring(sha1(concat_ws('|', source_id, name_norm, venue)), 1, 12) AS series FROM st),
 w AS (SELECT row_ord, CASE WHEN source_id = 'purchase' THEN 'mid-crawl' WHEN source_id NOT IN (SELECT source_id FROM lv2) THEN 'unjudgeable'
  WHEN series IN (SELECT substring(sha1(concat_ws('|', source_id, name_norm, venue)), 1, 12) FROM lv2) THEN 'series' WHEN (name_norm, url, stamp) IN (SELECT name_norm, url, stamp FROM lv2 WHERE stamp <> '') THEN 'slot' ELSE 'withdrawn' END AS why FROM k)
 SELECT row_ord, CASE WHEN why = 'withdrawn' THEN 'drop' ELSE 'keep' END AS verdict, why FROM w""".replace("lv2", "(SELECT * FROM lv WHERE source_id <> 'click')"), listing=True)  # fmt: skip
def reconcile(spark, sf):
    st, lv = halves(spark, sf)
    return R.reconcile(st, lv.where("source_id <> 'click'"), mid_crawl=("purchase",))


_BAD = """(contains(trim({0}), ',,') OR starts_with(trim({0}), ',') OR ends_with(trim({0}), ',') OR len(list_filter(range(1, len(list_filter(list_transform(string_split({0}, ','), lambda x: trim(x)), lambda x: x <> ''))),
 lambda i: lower(list_filter(list_transform(string_split({0}, ','), lambda x: trim(x)), lambda x: x <> '')[i]) = lower(list_filter(list_transform(string_split({0}, ','), lambda x: trim(x)), lambda x: x <> '')[i + 1]))) > 0)"""


@query("join_repair__J09_J18", _HALVES + f""", e AS (SELECT name_norm, url, stamp, min({{'o': row_ord, 'p': price_text, 'd': description, 'a': address}}) AS x FROM lv GROUP BY 1, 2, 3),
 f AS (SELECT name_norm, url, min({{'o': row_ord, 'p': price_text, 'd': description, 'a': address}}) AS y FROM lv GROUP BY 1, 2),
 j AS (SELECT st.*, coalesce(x, y) AS c FROM st LEFT JOIN e USING (name_norm, url, stamp) LEFT JOIN f USING (name_norm, url)),
 k AS (SELECT *, c.a AS ca, c.p AS cp, c.d AS cd FROM j)
 SELECT row_ord, coalesce(nullif(price_text, ''), cp, '') AS price_text, coalesce(nullif(description, ''), cd, '') AS description,
 CASE WHEN {_BAD.replace('{0}', 'address')} AND c IS NOT NULL AND NOT {_BAD.replace('{0}', 'ca')} THEN ca ELSE address END AS address FROM k""", listing=True)  # fmt: skip
def repair(spark, sf):
    return R.repair(*halves(spark, sf))


@query("join_dateless_anti__J10", "SELECT row_ord FROM l WHERE stamp = '' AND NOT EXISTS (SELECT 1 FROM l d WHERE d.stamp <> '' AND d.name_norm = l.name_norm AND d.loc_norm = l.loc_norm)", listing=True)
def dateless(spark, sf):
    rows = normalized(spark, sf)
    dated = rows.where("stamp <> ''").select("name_norm", "loc_norm").distinct()
    return rows.where("stamp = ''").join(dated, ["name_norm", "loc_norm"], "left_anti").select("row_ord")


@query("join_archive_flags__J11_L08", """, a AS (SELECT source_id, name_norm, venue, source_id IN ('click', 'view') OR row_ord % 2 = 0 AS archived, CASE row_ord % 3 WHEN 0 THEN 'live' WHEN 1 THEN 'unverified' ELSE '' END AS status FROM l WHERE source_id <> 'purchase' AND stamp = ''),
 h AS (SELECT source_id, bool_and(archived) AS hidden FROM a GROUP BY 1), t AS (SELECT substring(sha1(concat_ws('|', source_id, name_norm, venue)), 1, 12) AS series, max(status) AS status FROM a WHERE archived AND status <> '' GROUP BY 1),
 r AS (SELECT row_ord, source_id, substring(sha1(concat_ws('|', source_id, name_norm, venue)), 1, 12) AS own, CASE WHEN row_ord % 4 = 0 THEN substring(sha1(concat_ws('|', source_id, name_norm, 'zz')), 1, 12) ELSE '' END AS stamped FROM l),
 j AS (SELECT r.row_ord, coalesce(hidden, false) AS hidden, coalesce(x.status, y.status, '') = 'live' AS running FROM r LEFT JOIN h USING (source_id) LEFT JOIN t x ON x.series = stamped LEFT JOIN t y ON y.series = own) SELECT row_ord, hidden AND NOT running AS archived, hidden AND running AS live_confirmed FROM j""", listing=True)  # fmt: skip
def archive_flags(spark, sf):
    rows, k = normalized(spark, sf), F.col("row_ord")
    archive = rows.where("source_id <> 'purchase' AND stamp = ''").select("source_id", "name_norm", "venue", (F.col("source_id").isin("click", "view") | (k % 2 == 0)).alias("archived"), F.when(k % 3 == 0, "live").when(k % 3 == 1, "unverified").otherwise("").alias("status"))
    stamped = F.when(k % 4 == 0, text.series_id(F.col("source_id"), F.col("name_norm"), F.lit("zz")))
    return R.archive_flags(rows.withColumn("series_id", stamped), archive)


@query("project_normalize_store__P04", """, x AS (SELECT row_ord, CASE WHEN row_ord % 3 = 0 THEN ' ' ELSE source_id END AS sid, stamp, price_sort, name_norm, venue, source, row_ord % 2 = 0 AS inferred FROM l)
 SELECT row_ord, CASE WHEN trim(sid) = '' THEN 'unknown' ELSE sid END AS source_id, nullif(stamp, '') AS datetime_iso, price_sort, CASE WHEN inferred THEN substring(sha1(concat_ws('|', CASE WHEN trim(sid) = '' THEN 'unknown' ELSE sid END, name_norm, venue)), 1, 12) END AS series_id, CASE WHEN row_ord % 5 = 0 THEN 'a b' ELSE source END AS sources FROM x""", listing=True)  # fmt: skip
def normalize_store(spark, sf):
    k = F.col("row_ord")
    rows = normalized(spark, sf).select(
        "row_ord", "name", "location", "price_text", "source", F.when(k % 3 == 0, " ").otherwise(F.col("source_id")).alias("source_id"), F.concat(F.lit(" "), "stamp").alias("datetime_iso"), F.when(k % 2 == 0, F.col("price_sort")).alias("price_sort"),
        (k % 2 == 0).alias("date_inferred"), F.lit(None).cast("string").alias("series_id"), F.when(k % 5 == 0, F.array(F.lit("a"), F.lit("b"), F.lit("a"))).alias("sources"), F.lit(1).alias("source_label"), F.lit(2).alias("has_real_date"),
    )
    out = R.normalize_store(rows)
    return out.select("row_ord", "source_id", "datetime_iso", "price_sort", "series_id", F.array_join("sources", " ").alias("sources")) if "source_label" not in out.columns else rows


@query("join_nearest__J12_X21_W09", """WITH a AS (SELECT l_suppkey AS k, l_orderkey * 10 + l_linenumber AS id, l_orderkey AS pos FROM lineitem WHERE l_returnflag = 'N'), b AS (SELECT l_suppkey AS k, l_orderkey * 10 + l_linenumber AS id, l_orderkey AS pos FROM lineitem WHERE l_returnflag <> 'N'),
 p AS (SELECT a.id, min({'d': abs(a.pos - b.pos), 'after': b.pos > a.pos, 'm': b.id}) AS m FROM a JOIN b ON a.k = b.k AND abs(a.pos - b.pos) <= 60 GROUP BY a.id) SELECT id, m.m AS match, m.d AS distance FROM p""")  # fmt: skip
def nearest(spark, sf):
    items = spark.read.parquet(f"{sf}/lineitem.parquet").select(F.col("l_suppkey").alias("k"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"), F.col("l_orderkey").alias("pos"), "l_returnflag")
    return R.nearest(items.where("l_returnflag = 'N'"), items.where("l_returnflag <> 'N'"), "k", 60)


@query("join_archive_coverage__J13_A12", _HALVES + """, a AS (SELECT row_ord, name_norm, day FROM lv) SELECT CASE WHEN day = '' AND EXISTS (SELECT 1 FROM st WHERE st.name_norm = a.name_norm) THEN 'undated_covered' WHEN day = '' THEN 'undated'
 WHEN EXISTS (SELECT 1 FROM st WHERE st.name_norm = a.name_norm AND st.day = a.day) THEN 'covered' ELSE 'missing' END AS bucket, count(*) AS n FROM a GROUP BY 1""", listing=True)  # fmt: skip
def coverage(spark, sf):
    st, lv = halves(spark, sf)
    days = st.select("name_norm", "day").distinct().withColumn("on_day", F.lit(True))
    names = st.select("name_norm").distinct().withColumn("named", F.lit(True))
    joined = lv.join(days, ["name_norm", "day"], "left").join(names, "name_norm", "left")
    bucket = F.when((F.col("day") == "") & F.col("named"), "undated_covered").when(F.col("day") == "", "undated").when(F.col("on_day"), "covered").otherwise("missing")
    return joined.groupBy(bucket.alias("bucket")).agg(F.count("*").alias("n"))


@query("join_override_match__J14", _HALVES + """, o AS (SELECT DISTINCT name_norm AS oname, venue AS ovenue FROM lv WHERE venue <> ''), m AS (SELECT DISTINCT st.row_ord FROM st JOIN o ON (concat(CASE st.row_ord % 4 WHEN 0 THEN 'super' ELSE '' END, st.name_norm) = oname
  OR (length(oname) > 8 AND ends_with(st.name_norm, oname))) AND contains(st.loc_norm, ovenue))
 SELECT row_ord, row_ord IN (SELECT row_ord FROM m) AS replaced FROM st""", listing=True)  # fmt: skip
def override(spark, sf):
    st, lv = halves(spark, sf)
    o = lv.where("venue <> ''").select("name_norm", "venue").distinct().select(F.xxhash64("name_norm", "venue").alias("o"), F.col("name_norm").alias("name"), "venue")
    name = F.concat(F.when(F.col("row_ord") % 4 == 0, "super").otherwise(""), "name_norm")
    found = guides.override_hits(st.select("row_ord", name.alias("name"), F.col("loc_norm").alias("place")), o).select("row_ord").distinct().withColumn("replaced", F.lit(True))
    return st.select("row_ord").join(found, "row_ord", "left").select("row_ord", F.coalesce("replaced", F.lit(False)).alias("replaced"))


@query("join_near_duplicate_audit__J15", f""", d AS (SELECT DISTINCT day, stamp, venue, name_norm, source_id FROM l WHERE day <> '' AND venue <> ''), p AS (SELECT DISTINCT x.name_norm AS a, y.name_norm AS b, x.stamp, x.venue FROM d x JOIN d y ON x.stamp = y.stamp AND x.venue = y.venue AND x.name_norm < y.name_norm AND x.source_id <> y.source_id)
 , q AS (SELECT DISTINCT a, b FROM p), s AS (SELECT a, b, round(2.0 * ({_LCS})::INT / (length(a) + length(b)), 6)::DOUBLE AS similarity FROM q) SELECT stamp, venue, a, b, similarity FROM p JOIN s USING (a, b) WHERE similarity >= 0.8""", listing=True)  # fmt: skip
def audit(spark, sf):
    d = normalized(spark, sf).where("day <> '' AND venue <> ''").select("stamp", "venue", "name_norm", "source_id").distinct()
    x = d.select("stamp", "venue", F.col("name_norm").alias("a"), F.col("source_id").alias("sa"))
    y = d.select("stamp", "venue", F.col("name_norm").alias("b"), F.col("source_id").alias("sb"))
    p = x.join(y, ["stamp", "venue"]).where("a < b AND sa <> sb").select("stamp", "venue", "a", "b").distinct()
    scored = p.select("a", "b").distinct().where(text.length_bound(F.col("a"), F.col("b"), 0.8)).withColumn("similarity", F.round(text.indel_similarity(F.col("a"), F.col("b")), 6)).where("similarity >= 0.8")
    return p.join(scored, ["a", "b"]).select("stamp", "venue", "a", "b", "similarity")


@query("join_positional_zip__J17", """WITH a AS (SELECT l_orderkey AS k, l_partkey AS x, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS i FROM lineitem WHERE l_returnflag = 'N'),
 b AS (SELECT l_orderkey AS k, l_suppkey AS y, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber DESC, l_suppkey, l_partkey) AS i FROM lineitem WHERE l_returnflag = 'N') SELECT k, i, x, y FROM a JOIN b USING (k, i)""")  # fmt: skip
def zipped(spark, sf):
    items = spark.read.parquet(f"{sf}/lineitem.parquet").where("l_returnflag = 'N'")
    asc, desc = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey"), Window.partitionBy("l_orderkey").orderBy(F.desc("l_linenumber"), "l_suppkey", "l_partkey")
    a = items.select(F.col("l_orderkey").alias("k"), F.col("l_partkey").alias("x"), F.row_number().over(asc).cast("long").alias("i"))
    b = items.select(F.col("l_orderkey").alias("k"), F.col("l_suppkey").alias("y"), F.row_number().over(desc).cast("long").alias("i"))
    return a.join(b, ["k", "i"])


@query("join_unknown_sources__J19_U02_U03", _HALVES + "SELECT DISTINCT source_id, source_id IN (SELECT source_id FROM lv WHERE source_id <> 'click') AS known FROM st", listing=True)
def unknown(spark, sf):
    st, lv = halves(spark, sf)
    known = lv.where("source_id <> 'click'").select("source_id").distinct().withColumn("known", F.lit(True))
    return st.select("source_id").distinct().join(known, "source_id", "left").select("source_id", F.coalesce("known", F.lit(False)).alias("known"))


@query("agg_greedy_fold__D01_T01")
def fold(spark, sf):
    return R.greedy_fold(normalized(spark, sf))


@query("agg_programme_fold__D03_J04")
def programme_fold(spark, sf):
    return R.programme_fold(normalized(spark, sf)).withColumnRenamed("into", "into_row")


@query("agg_occurrences__D04", "SELECT row_ord FROM l QUALIFY row_number() OVER (PARTITION BY name_norm, stamp, loc_norm ORDER BY row_ord) = 1", listing=True)
def occurrences(spark, sf):
    return R.first_per_key(normalized(spark, sf).select("name_norm", "stamp", "loc_norm", "row_ord"), ["name_norm", "stamp", "loc_norm"]).select("row_ord")


@query("agg_two_stage_distinct__D05", _HALVES + """, a AS (SELECT false AS late, row_ord, name, stamp, location FROM st QUALIFY row_number() OVER (PARTITION BY lower(name), stamp ORDER BY row_ord) = 1),
 b AS (SELECT * FROM a UNION ALL SELECT true, row_ord, name, stamp, location FROM lv) SELECT row_ord, stamp, name FROM b QUALIFY row_number() OVER (PARTITION BY lower(name), stamp, lower(location) ORDER BY late, row_ord) = 1""", listing=True)  # fmt: skip
def two_stage(spark, sf):
    st, lv = halves(spark, sf)
    return R.distinct_sessions(st, lv).select("row_ord", "stamp", "name")


@query("agg_last_wins__D06", "SELECT url, max_by(name, row_ord) AS name, min(row_ord) AS first_seen FROM l GROUP BY url", listing=True)
def last_wins(spark, sf):
    return normalized(spark, sf).groupBy("url").agg(F.max_by("name", "row_ord").alias("name"), F.min("row_ord").alias("first_seen"))


@query("agg_merge_sources__A01", """, u AS (SELECT name_norm, row_ord, source, row_number() OVER (PARTITION BY name_norm, source ORDER BY row_ord) AS rn FROM l)
 SELECT name_norm, min(row_ord) AS row_ord, coalesce(min_by(location, CASE WHEN trim(location) <> '' THEN row_ord END), '') AS location, coalesce(min_by(address, CASE WHEN trim(address) <> '' THEN row_ord END), '') AS address,
 coalesce(min_by(description, CASE WHEN trim(description) <> '' THEN row_ord END), '') AS description, coalesce(min_by(price_text, CASE WHEN trim(price_text) <> '' THEN row_ord END), '') AS price_text,
 min_by(ts_local, CASE WHEN ts_local IS NOT NULL THEN row_ord END) AS ts_local, max_by(source, row_ord) AS source, (SELECT string_agg(source, ' ' ORDER BY u.row_ord) FROM u WHERE u.name_norm = l.name_norm AND rn = 1) AS sources, count(*) AS n FROM l GROUP BY name_norm""", listing=True)  # fmt: skip
def merge(spark, sf):
    return R.merge_groups(normalized(spark, sf), ["name_norm"], date=("ts_local",)).withColumn("sources", F.array_join("sources", " "))


@query("agg_source_floors__A02_S20_M05_T06", """, f AS (SELECT * FROM (VALUES ('click', 100), ('view', 100000), ('absent', 3)) t(source_id, least)), c AS (SELECT source_id, count(*) AS n FROM l GROUP BY 1)
 SELECT source_id, least::INT AS least, coalesce(n, 0)::BIGINT AS n, floor(100.0 * greatest(least - coalesce(n, 0), 0) / least)::BIGINT AS short_percent FROM f LEFT JOIN c USING (source_id)""", listing=True)  # fmt: skip
def floors(spark, sf):
    floor = spark.createDataFrame([("click", 100), ("view", 100000), ("absent", 3)], "source_id string, least int")
    counts = normalized(spark, sf).groupBy("source_id").agg(F.count("*").alias("n"))
    n = F.coalesce("n", F.lit(0))
    return floor.join(counts, "source_id", "left").select("source_id", "least", n.cast("long").alias("n"), F.floor(100 * F.greatest(F.col("least") - n, F.lit(0)) / F.col("least")).alias("short_percent"))


@query("agg_duplicate_counts__A03_Q03_Q08", """, a AS (SELECT count(*) AS c FROM l GROUP BY slot_hash HAVING count(*) > 1), f AS (SELECT name_norm, url, stamp, min_by(description, row_ord) AS d FROM l GROUP BY ALL),
 b AS (SELECT count(*) AS c FROM l JOIN f USING (name_norm, url, stamp) WHERE description = d GROUP BY name_norm, url, stamp HAVING count(*) > 1), p AS (SELECT count(*) AS c FROM l GROUP BY name_norm, venue, stamp HAVING count(*) > 1)
 SELECT 'slot' AS kind, count(*) AS groups, sum(c)::BIGINT AS rows FROM a UNION ALL SELECT 'listing', count(*), sum(c)::BIGINT FROM b UNION ALL SELECT 'programme', count(*), sum(c)::BIGINT FROM p""", listing=True)  # fmt: skip
def duplicates(spark, sf):
    rows = normalized(spark, sf)

    def summed(kind, counts):
        return counts.where("c > 1").agg(F.lit(kind).alias("kind"), F.count("*").alias("groups"), F.sum("c").alias("rows"))

    count = lambda *keys: rows.groupBy(*keys).agg(F.count("*").alias("c"))
    # the first row's description among equal ones: counted by description, of which the one that comes first is kept
    told = rows.groupBy("name_norm", "url", "stamp", "description").agg(F.count("*").alias("c"), F.min("row_ord").alias("first"))
    listing = told.groupBy("name_norm", "url", "stamp").agg(F.min_by("c", "first").alias("c"))
    return summed("slot", count("slot_hash")).unionByName(summed("listing", listing)).unionByName(summed("programme", count("name_norm", "venue", "stamp")))


_AUDITED = ("name", "location", "address", "source", "source_id", "price_text", "description", "datetime_text")


@query("agg_key_presence__A05_Q18", "SELECT k AS key, v::BIGINT AS n FROM (SELECT " + ", ".join(f"count(nullif({c}, '')) AS {c}" for c in _AUDITED) + ", count(ts_local) AS ts_local, count(price_sort) AS price_sort FROM l) UNPIVOT (v FOR k IN (" + ", ".join(_AUDITED) + ", ts_local, price_sort))", listing=True)
def presence(spark, sf):
    one = normalized(spark, sf).agg(*[F.count(F.nullif(F.col(c), F.lit(""))).alias(c) for c in _AUDITED], F.count("ts_local").alias("ts_local"), F.count("price_sort").alias("price_sort"))
    return one.unpivot([], one.columns, "key", "n")


@query("agg_series_spread__A06", ", s AS (SELECT substring(sha1(concat_ws('|', source_id, name_norm, venue)), 1, 12) AS series, count(*) AS size, count(DISTINCT description) AS labels FROM l GROUP BY 1) SELECT size, count(*) AS series_n, count(*) FILTER (WHERE labels > 1) AS disagree FROM s GROUP BY 1", listing=True)
def spread(spark, sf):
    series = text.series_id(F.col("source_id"), F.col("name_norm"), F.col("venue")).alias("series")
    s = normalized(spark, sf).groupBy(series).agg(F.count("*").alias("size"), F.countDistinct("description").alias("labels"))
    return s.groupBy("size").agg(F.count("*").alias("series_n"), F.count_if(F.col("labels") > 1).alias("disagree"))


@query("agg_names_per_url__A07_K05", "SELECT url, count(DISTINCT name) AS names FROM l GROUP BY url HAVING count(DISTINCT name) > 1 ORDER BY names DESC, url LIMIT 5", listing=True)
def names_per_url(spark, sf):
    return normalized(spark, sf).groupBy("url").agg(F.countDistinct("name").alias("names")).where("names > 1").orderBy(F.desc("names"), "url").limit(5)


@query("agg_share_by_venue__A08", "SELECT venue, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (), 4)::DOUBLE AS percent FROM l GROUP BY venue", listing=True)
def share(spark, sf):
    rows = normalized(spark, sf).groupBy("venue").agg(F.count("*").alias("n"))
    total = rows.agg(F.sum("n").alias("total"))  # one row
    return rows.crossJoin(F.broadcast(total)).select("venue", "n", F.round(100.0 * F.col("n") / F.col("total"), 4).alias("percent"))


@query("agg_conditional_counts__A09_A11", f"""SELECT count(*) FILTER (WHERE ts_local < TIMESTAMP '{TODAY} 00:00:00') AS past, count(*) FILTER (WHERE ends_with(stamp, 'T00:00')) AS midnight, count(*) FILTER (WHERE price_sort IS NULL AND price_text <> '') AS unpriced,
 count(*) FILTER (WHERE length(description) > 40) AS long_text, round(avg((address <> '')::INT), 6)::DOUBLE AS address_ratio FROM l""", listing=True)  # fmt: skip
def conditional(spark, sf):
    return normalized(spark, sf).agg(
        F.count_if(F.col("ts_local") < F.lit(f"{TODAY} 00:00:00").cast("timestamp_ntz")).alias("past"),
        F.count_if(F.endswith(F.col("stamp"), F.lit("T00:00"))).alias("midnight"),
        F.count_if(F.col("price_sort").isNull() & (F.col("price_text") != "")).alias("unpriced"),
        F.count_if(F.length("description") > 40).alias("long_text"),
        F.round(F.avg((F.col("address") != "").cast("int")), 6).alias("address_ratio"),
    )


@query("agg_hours_window__A10_X14", "SELECT (isodow(ts) - 1)::INT AS dow, min(strftime(ts, '%H:%M')) AS opens, max(strftime(ts, '%H:%M')) AS closes, count(*) AS n FROM events WHERE hour(ts) BETWEEN 8 AND 18 GROUP BY 1 HAVING count(*) > 1")
def hours(spark, sf):
    e = spark.read.parquet(f"{sf}/events.parquet").where("hour(ts) BETWEEN 8 AND 18")
    clock = F.date_format("ts", "HH:mm")
    return e.groupBy(F.weekday("ts").alias("dow")).agg(F.min(clock).alias("opens"), F.max(clock).alias("closes"), F.count("*").alias("n")).where("n > 1")


@query("agg_status_counts__A13", "SELECT CASE event_id % 3 WHEN 0 THEN 'live' WHEN 1 THEN 'unverified' ELSE 'finished' END AS status, count(*) AS n FROM events GROUP BY 1")
def status_counts(spark, sf):
    status = F.when(F.col("event_id") % 3 == 0, "live").when(F.col("event_id") % 3 == 1, "unverified").otherwise("finished")
    return spark.read.parquet(f"{sf}/events.parquet").groupBy(status.alias("status")).agg(F.count("*").alias("n"))


@query("window_carry_forward__W04_W07", "SELECT conv_id, turn, last_value(CASE WHEN role = 'user' THEN turn END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS heading FROM (SELECT DISTINCT conv_id, turn, max(role) AS role FROM conversations GROUP BY 1, 2)")
def carry(spark, sf):
    c = spark.read.parquet(f"{sf}/conversations.parquet").groupBy("conv_id", "turn").agg(F.max("role").alias("role"))
    w = Window.partitionBy("conv_id").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    return c.select("conv_id", "turn", F.last(F.when(F.col("role") == "user", F.col("turn")), ignorenulls=True).over(w).alias("heading"))


@query("window_section_end__W05", "SELECT o_custkey, o_orderkey, lead(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS section_end FROM orders")
def section_end(spark, sf):
    return spark.read.parquet(f"{sf}/orders.parquet").select("o_custkey", "o_orderkey", F.lead("o_orderkey").over(Window.partitionBy("o_custkey").orderBy("o_orderkey")).alias("section_end"))


@query("window_failure_streak__W08", """WITH m AS (SELECT user_id, event_id, (value < 50)::INT AS f, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rn FROM events), g AS (SELECT *, rn - sum(f) OVER (PARTITION BY user_id ORDER BY event_id) AS grp FROM m)
 SELECT user_id, min(event_id) AS start, count(*) AS length FROM g WHERE f = 1 GROUP BY user_id, grp HAVING count(*) >= 5""")  # fmt: skip
def streak(spark, sf):
    return R.gaps_and_islands(spark.read.parquet(f"{sf}/events.parquet"), "user_id", "event_id", F.col("value") < 50).where("length >= 5")


@query("sort_cap__K01_K02_W10_D07", "SELECT name_norm, array_to_string(list_sort(list_distinct(list(stamp)))[1:12], ' ') AS stamps FROM l GROUP BY name_norm", listing=True)
def cap(spark, sf):
    # distinct before the cut, and the cut by rank, so no group is gathered whole
    each = normalized(spark, sf).select("name_norm", "stamp").distinct()
    first = each.withColumn("rank", F.row_number().over(Window.partitionBy("name_norm").orderBy("stamp"))).where("rank <= 12")
    return first.groupBy("name_norm").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "stamp"))), lambda x: x["stamp"]), " ").alias("stamps"))


@query("limit_detail_budget__K03_K06", "SELECT DISTINCT url FROM l ORDER BY url LIMIT 7", listing=True)
def budget(spark, sf):
    return normalized(spark, sf).select("url").distinct().orderBy("url").limit(min(7, 45, 60))


@query("set_union_all__U01_S06", _HALVES + "SELECT source_id, count(*) AS n FROM (SELECT source_id FROM st UNION ALL SELECT source_id FROM lv) GROUP BY 1", listing=True)
def union(spark, sf):
    st, lv = halves(spark, sf)
    return st.unionByName(lv.drop("price_text"), allowMissingColumns=True).groupBy("source_id").agg(F.count("*").alias("n"))


@query("set_tag_union__U04", "SELECT row_ord, array_to_string(list_sort(list_distinct([source_id, venue, name_norm])), '|') AS tags FROM l", listing=True)
def tag_union(spark, sf):
    return normalized(spark, sf).select("row_ord", F.array_join(F.array_sort(F.array_union(F.array("source_id", "venue"), F.array("name_norm"))), "|").alias("tags"))
