"""Queries over guides, overrides and paged listings."""

from __future__ import annotations

from pyspark.sql import functions as F

from gleanery.operators import guides as G

from .base import listings, query

_GUIDE = """SELECT s_suppkey AS id, concat('intro', chr(10), 'Hosted by ', s_name, chr(10), 'Line Dancing', chr(10), '3, 10, 31 November', chr(10), '9am', chr(10), 'Hosted by Hub', chr(10), 'Tai Chi', chr(10), '5 October') AS t FROM supplier"""


@query("guide_sections__S18_S14_X12", f"WITH g AS ({_GUIDE}), p AS (SELECT id, unnest(string_split(t, chr(10) || 'Hosted by ')[2:]) AS part FROM g) SELECT id, string_split(part, chr(10))[1] AS host, len(string_split(part, chr(10)))::INT AS n_lines FROM p")
def sections(spark, sf):
    docs = spark.read.parquet(f"{sf}/supplier.parquet").select(F.col("s_suppkey").alias("id"), F.concat(F.lit("intro\nHosted by "), "s_name", F.lit("\nLine Dancing\n3, 10, 31 November\n9am\nHosted by Hub\nTai Chi\n5 October")).alias("t"))
    parts = G.sections(docs, "id", "t", "Hosted by ")
    return parts.select("id", F.regexp_replace(F.col("lines")[0], "^Hosted by ", "").alias("host"), F.size("lines").alias("n_lines"))


@query("guide_title_host_venue__X17_X19_X20", """SELECT s_suppkey, CASE s_suppkey % 3 WHEN 0 THEN 'Morning Tea and Dance' WHEN 1 THEN 'Walks - by the bay' ELSE 'Café' END AS title,
 CASE s_suppkey % 3 WHEN 0 THEN s_name || ' Community Club' WHEN 1 THEN 'Kingston' ELSE s_name || ' Library' END AS host, CASE s_suppkey % 2 WHEN 0 THEN 'Aspendale Gardens Community Service' ELSE 'Chelsea Library' END AS venue,
 CASE s_suppkey % 2 WHEN 0 THEN concat('Aspendale Gardens Community Service, 103 Kearney Drive, Unit ', s_suppkey) ELSE concat('Chelsea Library, ', s_suppkey, ' Stanley Avenue') END AS address FROM supplier""")
def title_host(spark, sf):
    k = F.col("s_suppkey")
    lines = (
        F.when(k % 3 == 0, F.array(F.concat("s_name", F.lit(" Community Club")), F.lit("Morning Tea"), F.lit("and Dance")))
        .when(k % 3 == 1, F.array(F.lit("Kingston"), F.lit("Walks –"), F.lit("by the bay")))
        .otherwise(F.array(F.concat("s_name", F.lit(" Library")), F.lit("CafAc")))
    )
    places = F.when(k % 2 == 0, F.array(F.lit("Aspendale Gardens"), F.lit("Community Service"), F.lit("103 Kearney Drive,"), F.concat(F.lit("Unit "), k.cast("string")))).otherwise(
        F.array(F.lit("Chelsea Library,"), F.concat(k.cast("string"), F.lit(" Stanley Avenue")))
    )
    rows = spark.read.parquet(f"{sf}/supplier.parquet").select("s_suppkey", G.title_and_host(lines).alias("t"), G.venue_and_address(places).alias("v"))
    return rows.select("s_suppkey", "t.title", "t.host", "v.venue", "v.address")


@query("guide_day_lists__R19", """WITH d AS (SELECT s_suppkey, unnest([3, (s_suppkey % 31 + 1)::INT, 31]) AS d FROM supplier) SELECT s_suppkey, array_to_string(list_sort(list(concat('2026-11-', lpad(d::VARCHAR, 2, '0')) ORDER BY d)), ' ') AS days FROM d WHERE d <= 30 GROUP BY 1""")
def day_lists(spark, sf):
    line = F.concat(F.lit("on 3, "), (F.col("s_suppkey") % 31 + 1).cast("string"), F.lit(", 31 November at noon"))
    return spark.read.parquet(f"{sf}/supplier.parquet").select("s_suppkey", F.array_join(F.array_sort(F.transform(G.day_list(line, 2026), lambda d: d.cast("string"))), " ").alias("days"))


@query("guide_dates_with_times__X21_J12_J17", """WITH i AS (SELECT l_orderkey AS k, l_linenumber AS line, l_partkey AS day, l_returnflag FROM lineitem), d AS (SELECT DISTINCT k, line * 5 AS line, day FROM i WHERE l_returnflag = 'N'), t AS (SELECT DISTINCT k, line * 4 AS line, day AS at_n FROM i WHERE l_returnflag <> 'N'),
 s AS (SELECT k, nd, coalesce(nt, 0) AS nt FROM (SELECT k, count(*) AS nd FROM d GROUP BY 1) LEFT JOIN (SELECT k, count(*) AS nt FROM t GROUP BY 1) USING (k)),
 z AS (SELECT a.k, a.day, b.at_n FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY line, day) AS i FROM d) a JOIN (SELECT *, row_number() OVER (PARTITION BY k ORDER BY line, at_n) AS i FROM t) b USING (k, i) WHERE a.k IN (SELECT k FROM s WHERE nd = nt)),
 c AS (SELECT d.k, d.line, d.day, min({'d': abs(t.line - d.line), 'a': t.line > d.line, 'x': t.at_n}) AS m FROM d LEFT JOIN t ON t.k = d.k AND abs(t.line - d.line) <= 6 GROUP BY 1, 2, 3),
 n AS (SELECT k, day, CASE WHEN m.d IS NOT NULL THEN m.x END AS at_n FROM c WHERE k NOT IN (SELECT k FROM s WHERE nd = nt))
 SELECT k, day, at_n FROM z UNION ALL SELECT k, day, at_n FROM n""")  # fmt: skip
def dates_with_times(spark, sf):
    items = spark.read.parquet(f"{sf}/lineitem.parquet")
    pick = lambda cond, factor, name: items.where(cond).select(F.col("l_orderkey").alias("k"), (F.col("l_linenumber") * factor).alias("line"), F.col("l_partkey").alias(name)).distinct()
    return G.pair_dates_with_times(pick("l_returnflag = 'N'", 5, "day"), pick("l_returnflag <> 'N'", 4, "at"), "k").withColumnRenamed("at", "at_n")


@query("guide_pool_groups__X21", """WITH i AS (SELECT l_orderkey AS k, l_linenumber * 5 + l_partkey % 5 AS line, l_partkey AS v, l_linenumber % 3 AS kind FROM lineitem), d AS (SELECT k, line FROM i WHERE kind = 1 GROUP BY ALL), t AS (SELECT k, line, min(v) AS v FROM i WHERE kind = 2 GROUP BY ALL), c AS (SELECT k, line, min(v) AS v FROM i WHERE kind = 0 GROUP BY ALL),
 z AS (SELECT k FROM (SELECT k, count(*) AS a FROM d GROUP BY 1) JOIN (SELECT k, count(*) AS b FROM t GROUP BY 1) USING (k) JOIN (SELECT k, count(*) AS e FROM c GROUP BY 1) USING (k) WHERE a = b AND b = e AND a > 1),
 n AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY line) AS i FROM d WHERE k IN (FROM z)), m AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY line) AS i FROM t), o AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY line) AS i FROM c),
 x AS (SELECT d.k, d.line, min({'g': abs(t.line - d.line), 'a': t.line > d.line, 'v': t.v}) AS w FROM d LEFT JOIN t ON t.k = d.k AND abs(t.line - d.line) <= 6 WHERE d.k NOT IN (FROM z) GROUP BY 1, 2),
 y AS (SELECT d.k, d.line, min({'a': c.line > d.line, 'g': abs(c.line - d.line), 'v': c.v}) AS w FROM d LEFT JOIN c ON c.k = d.k AND c.line BETWEEN d.line - 30 AND d.line + 12 WHERE d.k NOT IN (FROM z) GROUP BY 1, 2)
 SELECT n.k, n.line, m.v AS at_n, o.v::VARCHAR AS cost FROM n JOIN m USING (k, i) JOIN o USING (k, i) UNION ALL SELECT k, line, CASE WHEN x.w.g IS NOT NULL THEN x.w.v END, CASE WHEN y.w.g IS NOT NULL THEN y.w.v::VARCHAR ELSE '' END FROM x JOIN y USING (k, line)""")  # fmt: skip
def pool_groups(spark, sf):
    i = spark.read.parquet(f"{sf}/lineitem.parquet").select(F.col("l_orderkey").alias("k"), (F.col("l_linenumber") * 5 + F.col("l_partkey") % 5).alias("line"), F.col("l_partkey").alias("v"), (F.col("l_linenumber") % 3).alias("kind"))
    of = lambda kind: i.where(F.col("kind") == kind).groupBy("k", "line").agg(F.min("v").alias("v"))
    return G.pool_groups(of(1).select("k", "line"), of(2).withColumnRenamed("v", "at"), of(0).select("k", "line", F.col("v").cast("string").alias("cost")), "k").withColumnRenamed("at", "at_n")


@query("guide_overrides__S19_J14", """, x AS (SELECT row_ord, CASE WHEN row_ord % 4 = 0 THEN NULL ELSE source_id END AS source_id, concat(CASE row_ord % 2 WHEN 0 THEN 'Super' ELSE '' END, name) AS name, location, address, description, source, ts_local FROM listings),
 y AS (SELECT *, trim(regexp_replace(lower(name), '\\s+', ' ', 'g')) AS low, contains(lower(concat_ws(' ', location, address)), 'supplier') AS here FROM x WHERE source_id = 'click'),
 m AS (SELECT row_ord, 1 AS o FROM y WHERE here AND (low = 'old anvil (mondays)' OR ends_with(low, 'old anvil (mondays)')) UNION ALL SELECT row_ord, 2 FROM y WHERE here AND low = 'bolt'),
 b AS (SELECT o, min({'r': row_ord, 'l': location, 'd': description}) AS b FROM m JOIN x USING (row_ord) GROUP BY o),
 nw AS (SELECT 1 AS o, 'Old Anvil (Mondays)' AS name, '' AS location, 'Free' AS price_text, TIMESTAMP '2026-10-03 09:30:00' AS ts_local UNION ALL SELECT 1, 'Old Anvil (Mondays)', '', 'Free', TIMESTAMP '2026-10-10 09:30:00' UNION ALL SELECT 2, 'bolt', 'Hall', '$5', TIMESTAMP '2026-10-04 00:00:00'),
 z AS (SELECT source_id, name, location, description, ts_local FROM x WHERE row_ord NOT IN (SELECT row_ord FROM m) UNION ALL SELECT 'click', name, coalesce(nullif(location, ''), b.l, ''), coalesce(b.d, ''), ts_local FROM nw LEFT JOIN b USING (o))
 SELECT source_id, name, location, description, ts_local, count(*) AS n FROM z GROUP BY ALL""", listing=True)  # fmt: skip
def overrides(spark, sf):
    schema = "o int, name string, venue string, location string, address string, cost string, sessions array<struct<dates: array<string>, time: string, cost: string>>"
    o = spark.createDataFrame([(1, "Old Anvil (Mondays)", "Supplier", "", "", "Free", [(["2026-10-03", "2026-10-10"], "9:30", None)]), (2, "bolt", "supplier", "Hall", "", "", [(["2026-10-04", "2026-13-01"], "24:00", "$5")])], schema)
    k = F.col("row_ord")
    rows = listings(spark, sf).withColumn("source_id", F.when(k % 4 != 0, F.col("source_id"))).withColumn("name", F.concat(F.when(k % 2 == 0, "Super").otherwise(""), "name"))
    return G.apply_overrides(rows, o, "click").groupBy("source_id", "name", "location", "description", "ts_local").agg(F.count("*").alias("n"))


@query("guide_listing_walk__S09_S10_D06_K03", """WITH c AS (SELECT (o_orderkey % 40)::INT AS page, o_orderkey AS pos, CASE WHEN o_orderkey % 40 = 25 THEN 'x1' ELSE concat('x', CAST(o_custkey % 97 AS VARCHAR)) END AS link FROM orders),
 f AS (SELECT link, min({'page': page, 'pos': pos}) AS f FROM c GROUP BY 1), g AS (SELECT DISTINCT page FROM c WHERE page NOT IN (SELECT f.page FROM f)), s AS (SELECT min(page) AS stop FROM g)
 SELECT link, f.page AS page, f.pos AS pos FROM f, s WHERE stop IS NULL OR f.page < stop""")  # fmt: skip
def listing_walk(spark, sf):
    o = spark.read.parquet(f"{sf}/orders.parquet")
    link = F.when(F.col("o_orderkey") % 40 == 25, "x1").otherwise(F.concat(F.lit("x"), (F.col("o_custkey") % 97).cast("string")))
    return G.walk_listing(o.select((F.col("o_orderkey") % 40).cast("int").alias("page"), F.col("o_orderkey").alias("pos"), link.alias("link"))).select("link", "page", "pos")


@query("guide_bounded_cards__S12_S13", """SELECT o_orderkey AS pos, (o_orderkey % 40)::INT AS page, CASE o_orderkey % 3 WHEN 0 THEN DATE '2026-10-06' WHEN 1 THEN DATE '2027-01-02' END AS day FROM orders WHERE o_orderkey % 40 <= 25""")
def bounded(spark, sf):
    k = F.col("o_orderkey")
    cards = spark.read.parquet(f"{sf}/orders.parquet").select(k.alias("pos"), (k % 40).cast("int").alias("page"), F.concat(F.lit("x"), k.cast("string")).alias("link"), F.when(k % 3 == 0, "Tue 6 Oct, 10am").when(k % 3 == 1, "Saturday 2 January 2027").otherwise("soon").alias("when"))
    pagers = cards.select("page", F.when(F.col("page") < 20, F.col("page") + 6).alias("last"))
    return G.bounded_cards(cards, pagers, "2026-09-30").select("pos", "page", "day")


@query("guide_enrich_details__A11", """WITH r AS (SELECT s_suppkey, concat('x', CAST(s_suppkey AS VARCHAR)) AS link FROM supplier), a AS (SELECT link, s_suppkey FROM r ORDER BY s_suppkey LIMIT 8), d AS (SELECT link FROM a WHERE s_suppkey % 3 <> 0)
 SELECT r.link, CASE WHEN r.link IN (SELECT link FROM d) THEN 'detail' ELSE '' END AS description, (SELECT 2 * (SELECT count(*) FROM d) >= (SELECT count(*) FROM a)) AS passed FROM r""")  # fmt: skip
def enrich(spark, sf):
    s = spark.read.parquet(f"{sf}/supplier.parquet").select("s_suppkey", F.concat(F.lit("x"), F.col("s_suppkey").cast("string")).alias("link"))
    rows = s.select("link", F.lit(0).alias("page"), F.col("s_suppkey").alias("pos"), F.lit("").alias("description"))
    out, gate = G.enrich_details(rows, s.where("s_suppkey % 3 <> 0").select("link", F.lit("detail").alias("description")), ["description"], cap=8)
    return out.select("link", "description").crossJoin(F.broadcast(gate.select("passed")))


@query("scalar_parse_date__C11_C15_C05", """SELECT row_ord, CASE row_ord % 12 WHEN 0 THEN TIMESTAMP '2026-10-06 00:00:00' WHEN 1 THEN TIMESTAMP '2026-10-06 10:00:00' WHEN 2 THEN TIMESTAMP '2026-10-06 22:05:00' WHEN 3 THEN TIMESTAMP '2027-09-29 08:00:00' WHEN 4 THEN TIMESTAMP '2026-12-28 20:15:00'
 WHEN 6 THEN TIMESTAMP '2026-10-06 10:00:00' WHEN 7 THEN TIMESTAMP '2026-10-06 00:00:00' WHEN 8 THEN TIMESTAMP '2026-10-06 00:00:00' WHEN 9 THEN TIMESTAMP '2026-10-06 22:05:00' WHEN 10 THEN TIMESTAMP '2026-10-06 14:30:00' WHEN 11 THEN TIMESTAMP '2026-10-06 00:00:00' END AS ts FROM listings""", listing=True)
def parse_date(spark, sf):
    said = ("Tuesday 6 October 2026", "2026-10-06T10:00:00", "6/10/2026 10:05:00 PM", "Tuesday 29 September, 8:00am", "Mon 28 December, 8:15 pm", "soon", "2026-10-06 10:00:00", "6 october 2026", "6 Oct 2026", "6/10/2026 22:05:00", "6 October 2026 2:30 pm", "on 6 Oct. 2026 at noon")
    return listings(spark, sf).select("row_ord", G.parse_date(F.array(*map(F.lit, said))[(F.col("row_ord") % 12).cast("int")], "2026-09-30 00:00:00").alias("ts"))
