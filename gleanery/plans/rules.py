"""Classification, data-quality and presentation queries."""

from __future__ import annotations


from pyspark.sql import functions as F

from gleanery.functions import text
from gleanery.operators import checks as K
from gleanery.operators import classify as C
from gleanery.operators import present as P

from .base import SUBURBS, TODAY, normalized, query
from .scalars import _SUBURB_SQL

_TYPES_SQL = ", ty AS (SELECT row_ord, list_filter([" + ", ".join(
    f"CASE WHEN regexp_matches(name, '(?i){C.RULES[t]}') OR regexp_matches(description, '(?i){C.RULES[t]}')" + (" OR source_id = 'click'" if t == "Social & Community" else "") + f" THEN '{t}' END" for t in C.TYPES if t in C.RULES
) + "], lambda x: x IS NOT NULL) AS ts FROM l), tt AS (SELECT row_ord, CASE WHEN len(ts) > 0 THEN ts ELSE ['Other'] END AS types FROM ty)\n"


def typed(spark, sf):
    terms = F.when(F.col("source_id") == "click", F.array(F.lit("Faith"))).otherwise(F.array(F.lit("Other")))
    return normalized(spark, sf).withColumn("types", C.classify_types(F.col("name"), F.col("description"), terms))


@query("class_types__L01_L02_K04", _TYPES_SQL + "SELECT row_ord, array_to_string(types, '|') AS types FROM tt", listing=True)
def types(spark, sf):
    return typed(spark, sf).select("row_ord", F.array_join("types", "|").alias("types"))


@query("class_unmapped_terms__L02", "SELECT DISTINCT source_id, source_id <> 'click' AS unmapped FROM l", listing=True)
def unmapped(spark, sf):
    terms = F.when(F.col("source_id") == "click", F.array(F.lit("Arts, and  culture"))).otherwise(F.array("source_id"))
    return normalized(spark, sf).select("source_id", (F.size(C.unmapped(terms)) > 0).alias("unmapped")).distinct()


def _sql_any(x: str, patterns) -> str:
    return "regexp_matches(" + x + ", '(?i)(?:" + "|".join(patterns) + ")')"


_COMMERCIAL = (
    ", cm AS (SELECT row_ord, concat_ws(chr(10), name, description) AS t, concat_ws(' ', location, address) AS v, coalesce(price_sort > 0, false) AS priced, coalesce(price_sort >= 5, false) AS solid FROM l), cn AS (SELECT *, "
    + _sql_any("regexp_replace(v, '(?i)publi[cs]\\w*|publish\\w*', ' ', 'g')", C.HARD_VENUE[:1]) + " OR " + _sql_any("v", C.HARD_VENUE[1:]) + " AS hard, " + _sql_any("v", C.SOFT_VENUE) + " AS soft, " + _sql_any("v", [C.ALLOWED_VENUE]) + " AS allowed, "
    + _sql_any("v", [r"\brsl\b"]) + " AS rslv, " + _sql_any("t", [r"\brsl\b"]) + " AS rslt FROM cm), co AS (SELECT row_ord, CASE "
    + " ".join(f"WHEN {_sql_any('t', [p])} OR {_sql_any('v', [p])} THEN 'strong:{p}'" for p in C.STRONG)
    + r" WHEN regexp_matches(t, '(?i)\btrivia\b') AND (hard OR (soft AND NOT (allowed AND NOT rslv))) THEN 'trivia+venue' WHEN regexp_matches(t, '(?i)\btrivia\b') AND solid THEN 'trivia+priced'"
    + r" WHEN (hard OR soft) AND (priced OR regexp_matches(t, '(?i)lunch|dinner|meal|bistro|trivia|raffle|happy|special|\$')) THEN 'venue+meal-context'"
    + " WHEN (rslt OR rslv) AND (priced OR regexp_matches(t, '(?i)meal|bistro|dinner|lunch|trivia|raffle|happy')) THEN 'rsl+meal-context' ELSE '' END AS reason FROM cn)\n"
)


def commercial(rows):
    return rows.withColumn("reason", C.commercial_reason(F.col("name"), F.col("description"), F.col("location"), F.col("address"), F.col("price_sort")))


@query("class_commercial__L03_L04", _COMMERCIAL + "SELECT row_ord, reason <> '' AS is_commercial, reason FROM co", listing=True)
def is_commercial(spark, sf):
    return commercial(normalized(spark, sf)).select("row_ord", (F.col("reason") != "").alias("is_commercial"), "reason")


def _found(p: str) -> str:
    return f"coalesce(nullif(regexp_extract(name, '(?i)({p})', 1), ''), regexp_extract(description, '(?i)({p})', 1))"


_STATUS = (
    f", sa AS (SELECT row_ord, name, description, regexp_extract(datetime_text, '(?i){C.LEADING}', 1) AS lead_t FROM l), sb AS (SELECT row_ord, lead_t, lower(lead_t) AS low, {_found(C.CANCELLED)} AS c, {_found(C.SOLD_OUT)} AS s, {_found(C.FULLY_BOOKED)} AS f, {_found(C.SERVICE)} AS svc FROM sa), sc AS (SELECT row_ord, "
    "CASE WHEN starts_with(low, 'cancel') OR starts_with(low, 'postponed') THEN 'cancelled' WHEN contains(low, 'booked') THEN 'fully_booked' WHEN low <> '' THEN 'sold_out' WHEN c <> '' THEN 'cancelled' WHEN s <> '' THEN 'sold_out' WHEN f <> '' THEN 'fully_booked' ELSE '' END AS status, "
    "CASE WHEN low <> '' THEN lead_t WHEN c <> '' THEN c WHEN s <> '' THEN s WHEN f <> '' THEN f ELSE '' END AS detail, CASE WHEN svc <> '' THEN concat('service:', lower(trim(regexp_replace(svc, '\\s+', ' ', 'g')))) ELSE '' END AS service FROM sb)\n"
)


def statuses(rows):
    status, detail = C.event_status(F.col("name"), F.col("datetime_text"), F.col("description"))
    return rows.withColumns({"status": status, "detail": detail, "service": C.service_reason(F.col("name"), F.col("description"))})


@query("class_status_service__L05_L06_Q15", _STATUS + "SELECT row_ord, status, detail, service FROM sc", listing=True)
def status(spark, sf):
    return statuses(normalized(spark, sf)).select("row_ord", "status", "detail", "service")


@query("class_annotation__L07_V04", _COMMERCIAL.rstrip() + _STATUS.rstrip() + _SUBURB_SQL + "SELECT l.row_ord, suburb, reason <> '' OR service <> '' OR status = 'cancelled' AS hidden_by_default FROM l JOIN s USING (row_ord) JOIN co USING (row_ord) JOIN sc USING (row_ord)", listing=True)
def annotate(spark, sf):
    rows = statuses(commercial(normalized(spark, sf)))
    return rows.select("row_ord", text.extract_suburb(F.col("address"), SUBURBS).alias("suburb"), ((F.col("reason") != "") | (F.col("service") != "") | (F.col("status") == "cancelled")).alias("hidden_by_default"))


_FLAGS = """, fl AS (SELECT row_ord, source_id, stamp, CASE row_ord % 7 WHEN 0 THEN true WHEN 1 THEN NULL ELSE false END AS archived, CASE row_ord % 3 WHEN 0 THEN true WHEN 1 THEN false END AS live_confirmed FROM l)
"""


def flagged(spark, sf):
    k = F.col("row_ord")
    return normalized(spark, sf).withColumns({"archived": F.when(k % 7 == 0, True).when(k % 7 != 1, False), "live_confirmed": F.when(k % 3 == 0, True).when(k % 3 == 1, False)})


@query("quality_archive_flags__Q04", _FLAGS + """SELECT * FROM (SELECT 'listed without confirmation' AS rule, 'error' AS severity, '' AS subject, count(*) FILTER (WHERE source_id IN ('click', 'view') AND archived = false AND NOT coalesce(live_confirmed, false)) AS n FROM fl
 UNION ALL SELECT 'confirmed but withheld', 'error', '', count(*) FILTER (WHERE live_confirmed AND archived IS DISTINCT FROM false) FROM fl UNION ALL SELECT 'withheld without a date', 'error', '', count(*) FILTER (WHERE archived IS DISTINCT FROM false AND stamp = '') FROM fl) WHERE n > 0""", listing=True)  # fmt: skip
def archive_check(spark, sf):
    return K.archive_flags(flagged(spark, sf), ("click", "view"))


@query("quality_source_floors__Q01_Q02", _FLAGS + """, f AS (SELECT * FROM (VALUES ('click', 10000000, false), ('view', 10000000, true), ('absent', 3, false), ('purchase', 1, false)) t(source_id, least, seasonal)), c AS (SELECT source_id, count(*) AS n, count(*) FILTER (WHERE archived) AS hidden FROM fl GROUP BY 1),
 k AS (SELECT source_id, least, seasonal, coalesce(n, 0) AS n FROM f LEFT JOIN c USING (source_id))
 SELECT 'floor' AS rule, CASE WHEN seasonal THEN 'warning' ELSE 'error' END AS severity, source_id AS subject, n::BIGINT AS n FROM k WHERE n < least UNION ALL SELECT 'undeclared source', 'error', source_id, n FROM c WHERE source_id NOT IN (SELECT source_id FROM f)
 UNION ALL SELECT 'archived rows', 'note', source_id, hidden FROM c WHERE hidden > 0 UNION ALL SELECT 'total floor', 'error', 'all', (SELECT sum(n) FROM c)::BIGINT""", listing=True)  # fmt: skip
def floors(spark, sf):
    floor = spark.createDataFrame([("click", 10_000_000, False), ("view", 10_000_000, True), ("absent", 3, False), ("purchase", 1, False)], "source_id string, least int, seasonal boolean")
    return K.source_floors(flagged(spark, sf), floor, 10**9)


@query("quality_same_listing__Q05", "SELECT row_ord FROM (SELECT row_ord, description, first_value(description) OVER w AS f, row_number() OVER w AS rn FROM l WHERE stamp <> '' WINDOW w AS (PARTITION BY name_norm, url, stamp ORDER BY row_ord)) WHERE rn > 1 AND description = f", listing=True)
def same_listing(spark, sf):
    rows = normalized(spark, sf).where("stamp <> ''")
    first = rows.groupBy("name_norm", "url", "stamp").agg(F.min(F.struct("row_ord", "description")).alias("f"))
    return rows.join(first, ["name_norm", "url", "stamp"]).where((F.col("row_ord") > F.col("f.row_ord")) & (F.col("description") == F.col("f.description"))).select("row_ord")


_CHECKS = r"""
SELECT 'dateless' AS check_name, count(*) AS n FROM l WHERE stamp = '' UNION ALL SELECT 'no address', count(*) FROM l WHERE address = '' AND NOT regexp_matches(lower(location), '\b(?:online|zoom)\b')
UNION ALL SELECT 'suburb unknown', count(*) FROM s WHERE suburb = '' UNION ALL SELECT 'no type', count(*) FROM tt WHERE len(types) = 0 UNION ALL SELECT 'slot duplicates', count(*) FROM (SELECT 1 FROM l GROUP BY slot_hash HAVING count(*) > 1)"""


@query("quality_report__Q09_Q10_Q11_Q13", _TYPES_SQL.rstrip() + _SUBURB_SQL + _CHECKS, listing=True)
def report(spark, sf):
    rows = typed(spark, sf).withColumn("suburb", text.extract_suburb(F.col("address"), SUBURBS))
    one = rows.agg(
        F.count_if(F.col("stamp") == "").alias("dateless"),
        F.count_if((F.col("address") == "") & ~text.is_online(F.col("location"))).alias("no address"),
        F.count_if(F.col("suburb") == "").alias("suburb unknown"),
        F.count_if(F.size("types") == 0).alias("no type"),
    )
    dup = rows.groupBy("slot_hash").agg(F.count("*").alias("c")).where("c > 1").agg(F.lit("slot duplicates").alias("check_name"), F.count("*").alias("n"))
    return one.unpivot([], one.columns, "check_name", "n").unionByName(dup)


@query("quality_catchment__Q12", _SUBURB_SQL + r""", x AS (SELECT l.*, suburb, lower(concat_ws(' ', name, location, address, description)) AS blob FROM l JOIN s USING (row_ord)), g AS (SELECT source_id, count(*) FILTER (WHERE lower(trim(location)) IN ('supplier#000000001', 'supplier#000000002', 'supplier#000000003', 'supplier#000000004', '')) AS generic, count(*) AS n FROM x GROUP BY 1),
 o AS (SELECT source_id, count(DISTINCT trim(location)) AS n FROM x WHERE NOT regexp_matches(lower(location), '\b(?:online|zoom|webinar|virtual|livestream|livestreamed|remote|teams)\b') AND NOT CASE WHEN suburb <> '' THEN suburb IN ('Chelsea', 'Mentone') ELSE contains(blob, 'chelsea') OR contains(blob, 'mentone') END GROUP BY 1)
 SELECT 'generic venues' AS rule, 'error' AS severity, source_id AS subject, generic AS n FROM g WHERE generic > n // 2 UNION ALL SELECT 'outside the catchment', 'error', source_id, n FROM o""", listing=True)  # fmt: skip
def catchment_check(spark, sf):
    return K.catchment(normalized(spark, sf), tuple(f"supplier#00000000{i}" for i in range(1, 5)), ("Chelsea", "Mentone"), SUBURBS)


@query("quality_justified_store__Q14", """, st AS (SELECT *, substring(sha1(concat_ws('|', source_id, name_norm, venue)), 1, 12) AS series FROM l WHERE row_ord % 2 = 0), lv AS (SELECT *, substring(sha1(concat_ws('|', source_id, name_norm, venue)), 1, 12) AS series FROM l WHERE row_ord % 2 = 1 AND source_id <> 'view')
 SELECT 'not justified' AS rule, 'error' AS severity, source_id AS subject, count(*) AS n FROM st WHERE source_id <> 'purchase' AND source_id IN (SELECT source_id FROM lv) AND series NOT IN (SELECT series FROM lv) AND (name_norm, url, stamp) NOT IN (SELECT name_norm, url, stamp FROM lv WHERE stamp <> '') GROUP BY 3""", listing=True)  # fmt: skip
def justified(spark, sf):
    rows = normalized(spark, sf)
    return K.justified(rows.where("row_ord % 2 = 0"), rows.where("row_ord % 2 = 1 AND source_id <> 'view'"), ("purchase",))


@query("quality_page_titles__Q16", r"SELECT page_id, (len(regexp_extract_all(html, '<a ')) - len(regexp_extract_all(html, '</a>')))::BIGINT AS unclosed_links, regexp_matches(html, '(?i)<title>[^<]+</title>') AS titled FROM pages")
def markup(spark, sf):
    return spark.read.parquet(f"{sf}/pages.parquet").select("page_id", (F.regexp_count("html", F.lit("<a ")) - F.regexp_count("html", F.lit("</a>"))).cast("long").alias("unclosed_links"), F.col("html").rlike("(?i)<title>[^<]+</title>").alias("titled"))


@query("quality_guide_years__Q17", """WITH g AS (SELECT s_suppkey AS id, CASE s_suppkey % 4 WHEN 0 THEN NULL WHEN 1 THEN 'MMXXIV' WHEN 2 THEN '2024' ELSE '2023' END AS y, CASE s_suppkey % 3 WHEN 0 THEN NULL WHEN 1 THEN 'x' ELSE '2024' END AS o FROM supplier)
 SELECT id, 'no year' AS fault FROM g WHERE y IS NULL UNION ALL SELECT id, 'year is no number' FROM g WHERE y = 'MMXXIV' UNION ALL SELECT id, CASE WHEN o IS NULL THEN 'overrides without a year' WHEN o = 'x' THEN 'overrides'' year is no number' ELSE 'overrides of another year' END FROM g WHERE y IN ('2023', '2024') AND o IS DISTINCT FROM y
 UNION ALL SELECT id, 'not this year''s in season' FROM g WHERE y = '2023'""")
def years(spark, sf):
    k = F.col("s_suppkey")
    year, other = F.when(k % 4 == 1, "MMXXIV").when(k % 4 == 2, "2024").when(k % 4 == 3, "2023"), F.when(k % 3 == 1, "x").when(k % 3 == 2, "2024")
    return K.guide_years(spark.read.parquet(f"{sf}/supplier.parquet").select(k.alias("id"), year.alias("year"), other.alias("override_year")), TODAY, (1, 2))


@query("quality_page_counts__Q19", _FLAGS + """, c AS (SELECT source_id, count(*) FILTER (WHERE archived IS DISTINCT FROM true) AS listed, count(*) AS n FROM fl GROUP BY 1) SELECT source_id, CASE WHEN source_id = 'click' THEN listed ELSE n END AS stated, listed FROM c WHERE source_id <> 'click' AND n <> listed""", listing=True)
def page_counts(spark, sf):
    rows = flagged(spark, sf)
    n = rows.groupBy("source_id").agg(F.count("*").alias("n"), F.count_if(~F.col("archived").eqNullSafe(F.lit(True))).alias("l"))
    header = F.concat(F.format_number(F.when(F.col("source_id") == "click", F.col("l")).otherwise(F.col("n")), 0), F.lit(" events"))
    return K.page_counts(n.select("source_id", header.alias("header")), rows, "source_id")


@query("quality_verdict__Q20", "SELECT (SELECT count(*) FROM l WHERE stamp = '')::BIGINT AS errors, (SELECT count(*) FROM l WHERE address = '')::BIGINT AS warnings, (SELECT count(*) FROM l WHERE stamp = '') = 0 AS passed", listing=True)
def verdict(spark, sf):
    rows = normalized(spark, sf)
    return K.passed(K.counted(rows, "dateless", K.ERROR, F.col("stamp") == "").unionByName(K.counted(rows, "no address", K.WARNING, F.col("address") == "")))


@query("join_geocoder_disagreement__J16_F17", r"""SELECT row_ord, CASE row_ord % 6 WHEN 0 THEN CASE WHEN regexp_matches(address, '\d{4}\s*$') AND NOT regexp_matches(address, '3999\s*$') THEN 'postcode' ELSE '' END
 WHEN 1 THEN CASE WHEN regexp_matches(address, '(?i)\b(VIC|NSW|QLD|SA|WA|TAS|NT|ACT)\b') THEN 'state' ELSE '' END WHEN 2 THEN 'suburb' WHEN 3 THEN 'street' WHEN 4 THEN '' END AS fault FROM listings""", listing=True)
def disagreement(spark, sf):
    k, none = F.col("row_ord"), F.lit(None).cast("string")
    rows = normalized(spark, sf).withColumn("suburb", F.lit("Chelsea"))
    said = rows.where(k % 6 != 5).select("row_ord", F.when(k % 6 == 0, "3999").otherwise(none).alias("postcode"), F.when(k % 6 == 1, "XX").otherwise(none).alias("state"), F.when(k % 6 == 2, "Mentone").otherwise("CHELSEA").alias("suburb"), F.when(k % 6 == 3, "No Such Road").otherwise(none).alias("street"))
    return K.disagreement(rows, said)


@query("filter_suspicious__P26", r""", bad AS (SELECT row_ord, trim(regexp_replace(lower(description), '\s+', ' ', 'g')) = trim(regexp_replace(lower(name), '\s+', ' ', 'g')) AND length(trim(name)) >= 3 AS restates, list_filter(list_transform(string_split(address, ','), lambda x: lower(trim(x))), lambda x: x <> '') AS seg, trim(address) AS a FROM listings)
 SELECT row_ord FROM bad WHERE restates OR contains(a, ',,') OR starts_with(a, ',') OR ends_with(a, ',') OR len(list_filter(range(1, len(seg)), lambda i: seg[i] = seg[i + 1])) > 0 ORDER BY row_ord LIMIT 40""", listing=True)
def suspicious(spark, sf):
    return K.suspicious(normalized(spark, sf), 40).select("row_ord")


@query("present_facets__A04_V06", _TYPES_SQL + "SELECT t AS type_name, count(*) AS n, count(DISTINCT source_id) AS sources FROM (SELECT unnest(types) AS t, source_id FROM tt JOIN l USING (row_ord)) GROUP BY 1", listing=True)
def facets(spark, sf):
    return typed(spark, sf).select(F.explode("types").alias("type_name"), "source_id").groupBy("type_name").agg(F.count("*").alias("n"), F.countDistinct("source_id").alias("sources"))


@query("agg_type_share__A08", _TYPES_SQL + """, x AS (SELECT unnest(types) AS t FROM tt), z AS (SELECT count(*) AS n, sum(len(types)) AS tags FROM tt) SELECT t AS type_name, count(*) AS n_rows, round(100.0 * count(*) / any_value(z.n), 4)::DOUBLE AS percent, round(any_value(z.tags)::DOUBLE / any_value(z.n), 4)::DOUBLE AS tags_per_row FROM x, z GROUP BY t""", listing=True)
def type_share(spark, sf):
    rows = typed(spark, sf).select("types")
    total = rows.agg(F.count("*").alias("n"), F.sum(F.size("types")).alias("tags"))  # one row
    each = rows.select(F.explode("types").alias("type_name")).groupBy("type_name").agg(F.count("*").alias("n_rows"))
    return each.crossJoin(F.broadcast(total)).select("type_name", "n_rows", F.round(100.0 * F.col("n_rows") / F.col("n"), 4).alias("percent"), F.round(F.col("tags") / F.col("n"), 4).alias("tags_per_row"))


@query("present_search__V01_V02_V03_V05", _TYPES_SQL.rstrip() + _SUBURB_SQL + "SELECT l.row_ord FROM l JOIN tt USING (row_ord) JOIN s USING (row_ord) WHERE contains(lower(concat_ws(' ', name, description, location)), 'lunch') AND list_has_any(types, ['Food & Drink', 'Dance']) AND suburb IN ('Chelsea', 'Mentone', '') AND (price_sort = 0 OR price_sort IS NULL)", listing=True)
def search(spark, sf):
    rows = typed(spark, sf).withColumn("suburb", text.extract_suburb(F.col("address"), SUBURBS))
    return rows.where(
        F.contains(F.lower(F.concat_ws(" ", "name", "description", "location")), F.lit("lunch")) & F.arrays_overlap("types", F.array(F.lit("Food & Drink"), F.lit("Dance"))) & F.col("suburb").isin("Chelsea", "Mentone", "") & (F.col("price_sort").isNull() | (F.col("price_sort") == 0))
    ).select("row_ord")


@query("present_page__V07_K07", "SELECT row_ord, stamp, name_norm FROM l WHERE stamp <> '' ORDER BY stamp, row_ord LIMIT 50 OFFSET 100", listing=True)
def page(spark, sf):
    return normalized(spark, sf).where("stamp <> ''").select("row_ord", "stamp", "name_norm").orderBy("stamp", "row_ord").offset(100).limit(50)


@query("present_export__V08_V09_S23", """, w AS (SELECT *, row_ord % 4 = 0 AS inferred FROM l WHERE stamp <> '')
 SELECT row_ord, CASE WHEN ends_with(stamp, 'T00:00') THEN 'all day' ELSE substring(stamp, 12, 5) END AS "Time", substring(stamp, 1, 10) AS "Date", name AS "Name", location AS "Location", address AS "Address", price_text AS "Price", source AS "Source", CASE WHEN inferred THEN 'yes' ELSE '' END AS "DateInferred", CASE WHEN inferred THEN 'Every week' ELSE '' END AS "Recurrence",
 concat('BEGIN:VEVENT', chr(10), 'DTSTART:', strftime(ts_local, '%Y%m%dT%H%M00'), chr(10), 'DTEND:', strftime(ts_local + INTERVAL 60 MINUTE, '%Y%m%dT%H%M00'), chr(10), 'SUMMARY:', replace(replace(name, ';', '\\;'), ',', '\\,'), CASE WHEN inferred THEN concat(chr(10), 'X-COMMENTS-DERIVED-DATE:TRUE') ELSE '' END, chr(10), 'END:VEVENT') AS vevent FROM w""", listing=True)  # fmt: skip
def export(spark, sf):
    rows = normalized(spark, sf).withColumn("recurrence", F.when(F.col("row_ord") % 4 == 0, "Every week"))
    return P.export_rows(rows.withColumn("date_inferred", F.col("row_ord") % 4 == 0))


@query("present_upcoming__V04_past", f"SELECT row_ord FROM l WHERE ts_local IS NULL OR ts_local >= TIMESTAMP '{TODAY} 00:00:00'", listing=True)
def upcoming(spark, sf):
    return normalized(spark, sf).where(F.col("ts_local").isNull() | (F.col("ts_local") >= F.lit(f"{TODAY} 00:00:00").cast("timestamp_ntz"))).select("row_ord")
