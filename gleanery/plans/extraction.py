"""Extraction, source and incremental queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from gleanery.functions import text
from gleanery.operators import extract as X
from gleanery.sources import store as S
from gleanery.streaming import incremental

from .base import TODAY, listings, normalized, query


def pages(spark, sf):
    return spark.read.parquet(f"{sf}/pages.parquet")


@query("extract_title__X07", "SELECT page_id, replace(replace(replace(trim(regexp_replace(regexp_extract(html, '<title>([^<]*)</title>', 1), '\\s+', ' ', 'g')), '&lt;', '<'), '&gt;', '>'), '&amp;', '&') AS title FROM pages")
def title(spark, sf):
    return pages(spark, sf).select("page_id", X.plain_title(F.col("html")).alias("title"))


@query("extract_page_tree__X02_X03_X06_X12")
def tree(spark, sf):
    form = F.concat("html", F.lit('<form><input type="hidden" name="token" value="t1"><select><option value="1"><option value="2"></select></form><dl><dt>Cost:</dt><dd>Free</dd></dl>'))
    p = X.parse_pages(pages(spark, sf).withColumn("h", form), "h")
    return p.select("page_id", F.col("page.prose").alias("prose"), F.element_at("page.hidden", "token").alias("token"), F.element_at("page.fields", "cost").alias("cost"), F.size("page.sections").alias("n_sections"), F.array_join("page.selects", ",").alias("pager"))


@query("extract_decode__X01", "SELECT page_id, length(html)::BIGINT AS n FROM pages")
def decode(spark, sf):
    return pages(spark, sf).select("page_id", F.length(X.decode_body(F.encode("html", "UTF-8"))).cast("long").alias("n"))


@query("extract_pager__X04_X05", "SELECT page_id, list_max(list_transform(regexp_extract_all(concat(url, '&page=', page_id % 7, '&page=3'), '[?&]page=(\\d+)', 1), lambda x: x::INT)) AS last_page, (page_id % 7)::INT AS of_pages FROM pages")
def pager(spark, sf):
    n = (F.col("page_id") % 7).cast("string")
    return pages(spark, sf).select("page_id", X.last_page(F.concat("url", F.lit("&page="), n, F.lit("&page=3"))).alias("last_page"), X.page_of(F.concat(F.lit("Page 1 of "), n)).alias("of_pages"))


@query("extract_links__X01", "SELECT page_id, len(regexp_extract_all(html, '<a href=\"([^\"]*)\"', 1))::INT AS n_links, len(list_distinct(regexp_extract_all(html, '<a href=\"([^\"]*)\"', 1)))::INT AS n_distinct FROM pages")
def links(spark, sf):
    found = F.regexp_extract_all("html", F.lit('<a href="([^"]*)"'), 1)
    return pages(spark, sf).select("page_id", F.size(found).alias("n_links"), F.size(F.array_distinct(found)).alias("n_distinct"))


@query("extract_json_ld__X10", "SELECT s_suppkey, s_name AS name, concat('2026-10-', lpad(CAST(s_suppkey % 28 + 1 AS VARCHAR), 2, '0')) AS start, CASE s_suppkey % 4 WHEN 0 THEN 'Hall' WHEN 1 THEN 'Room' WHEN 2 THEN 'Park' END AS place FROM supplier WHERE s_suppkey % 5 <> 0")
def json_ld(spark, sf):
    k = F.col("s_suppkey")
    place = F.when(k % 4 == 0, '{"name":"Hall"}').when(k % 4 == 1, '["x",{"a":1},{"name":"Room"}]').when(k % 4 == 2, '"Park"').otherwise("[]")
    body = F.concat(F.lit('{"@type":"'), F.when(k % 5 == 0, "Place").otherwise("Event"), F.lit('","name":"'), "s_name", F.lit('","startDate":"2026-10-'), F.lpad((k % 28 + 1).cast("string"), 2, "0"), F.lit('","location":'), place, F.lit("}"))
    doc = F.when(k % 3 == 0, body).when(k % 3 == 1, F.concat(F.lit('[{"@type":"Place"},7,'), body, F.lit(',{"@type":"Event","name":"later"}]'))).otherwise(F.concat(F.lit("["), body, F.lit("]")))
    doc = F.when((k % 3 == 1) & (k % 5 == 0), F.lit('[{"@type":"Place"}]')).otherwise(doc)
    out = spark.read.parquet(f"{sf}/supplier.parquet").select("s_suppkey", X.json_ld_event(doc).alias("e")).where("e is not null")
    return out.select("s_suppkey", F.col("e.name").alias("name"), F.col("e.start").alias("start"), F.col("e.place").alias("place"))


def detail(spark, sf):
    """A made-up detail page for each supplier: facts in marked elements, dates in prose, a list of other dates."""
    k = F.col("s_suppkey")
    day = (k % 27 + 1).cast("string")
    own = F.when(k % 3 == 0, F.lit("")).otherwise(F.concat(F.lit('<div class="event-date">Next: '), day, F.lit(' October 2026</div><span class="event-time">6:30 PM - 8:30 PM</span>')))
    ld = F.concat(F.lit('<script type="application/ld+json">[{"@type":"Event","startDate":"2026-11-'), F.lpad(day, 2, "0"), F.lit('T09:15:00"}]</script>'))
    described = F.when(k % 2 == 0, F.concat(F.lit('<p class="event-description big">About '), "s_name", F.lit("</p>"))).otherwise("")
    price = F.when(k % 4 == 0, '<b class="cost-label">Cost</b><b class="x-cost">$5</b>').otherwise("")
    html = F.concat(F.lit("<body><main><article><p class='meta'>no</p><p>Card of "), "s_name", F.lit("</article>"), own, described, F.lit('<div class="event-location">1&nbsp;High St</div>'), price, F.lit('<ul id="otherDates"><li><a>Friday 30 October 2026, 10 am</a><li><a>31 February 2026</a></ul><h2 id="a">Location</h2>Hall</main><style>/* x */ p { a: b } p { c: d } q{}</style><i id="a"></i>'), ld)
    return spark.read.parquet(f"{sf}/supplier.parquet").select("s_suppkey", "s_name", html.alias("html"))


@query("extract_page_facts__X22", """SELECT s_suppkey, CASE WHEN s_suppkey % 2 = 0 THEN 'About ' || s_name ELSE concat('no Card of ', s_name, CASE WHEN s_suppkey % 3 = 0 THEN '' ELSE concat(' Next: ', s_suppkey % 27 + 1, ' October 2026 6:30 PM - 8:30 PM') END, ' 1 High St',
 CASE WHEN s_suppkey % 4 = 0 THEN ' Cost $5' ELSE '' END, ' Friday 30 October 2026, 10 am 31 February 2026 Location Hall') END AS description, '1 High St' AS address, CASE WHEN s_suppkey % 4 = 0 THEN '$5' ELSE '' END AS price FROM supplier""")
def page_facts(spark, sf):
    return X.page_facts(detail(spark, sf), "html").select("s_suppkey", "description", "address", "price")


@query("extract_occurrence_dates__X09", """SELECT s_suppkey, CASE WHEN s_suppkey % 3 = 0 THEN DATE '2026-11-01' ELSE DATE '2026-10-01' END + (s_suppkey % 27)::INT AS day, CASE WHEN s_suppkey % 3 = 0 THEN '09:15' ELSE '18:30' END AS at_time FROM supplier
 UNION ALL SELECT s_suppkey, DATE '2026-10-30', '10:00' FROM supplier""")
def occurrence_dates(spark, sf):
    return X.occurrence_dates(detail(spark, sf), "s_suppkey", "html").withColumnRenamed("at", "at_time")


@query("extract_run_dates__X16_S17", """SELECT s_suppkey, DATE '2026-10-01' + (s_suppkey % 27)::INT AS day, '' AS at_time FROM supplier WHERE s_suppkey % 3 <> 0 UNION ALL SELECT s_suppkey, DATE '2026-10-30', '' FROM supplier""")
def run_dates(spark, sf):
    return X.run_dates(detail(spark, sf), "s_suppkey", "html").withColumnRenamed("at", "at_time")


@query("extract_card_summary__X24", "SELECT s_suppkey, 'Card of ' || s_name AS summary, NOT contains('x', 'Hall') AS cut FROM supplier")
def card_summary(spark, sf):
    out = X.card_summaries(detail(spark, sf), "html")
    return out.select("s_suppkey", "summary", (~F.contains("prose", F.lit("Hall"))).alias("cut"))


@query("extract_markup_lint__X25", "SELECT s_suppkey, 'id a' AS what, 2::BIGINT AS n FROM supplier UNION ALL SELECT s_suppkey, 'rule p', 2 FROM supplier UNION ALL SELECT s_suppkey, 'rule q', 1 FROM supplier")
def markup_lint(spark, sf):
    d = detail(spark, sf)
    ids = X.duplicate_ids(d, "s_suppkey", "html").select("s_suppkey", F.concat(F.lit("id "), "id").alias("what"), "n")
    return ids.unionByName(X.css_rules(d, "s_suppkey", "html").select("s_suppkey", F.concat(F.lit("rule "), "selector").alias("what"), "n"))


@query("extract_calendar_json__S08", "SELECT o_orderkey, concat('Event ', CAST(o_orderkey AS VARCHAR)) AS name, CASE o_orderkey % 4 WHEN 3 THEN NULL ELSE concat('venue', CAST(o_orderkey % 4 AS VARCHAR)) END AS venue, o_orderkey % 4 <> 3 AS complete FROM orders")
def calendar(spark, sf):
    item = F.concat(F.lit('{"data":[{"Items":[{"Name":"Event '), F.col("o_orderkey").cast("string"), F.lit('","DateTime":"2026-10-01T00:00","CalendarId":"'), (F.col("o_orderkey") % 4).cast("string"), F.lit('"}]}]}'))
    venues = spark.createDataFrame([(str(i), f"venue{i}") for i in range(3)], "CalendarId string, venue string")
    out = S.calendar_rows(spark.read.parquet(f"{sf}/orders.parquet").select(item.alias("body")), "body", venues)
    return out.select(F.regexp_extract("Name", r"(\d+)", 1).cast("long").alias("o_orderkey"), F.col("Name").alias("name"), "venue", "complete")


@query("extract_labelled_signals__X11_X13", r"""SELECT row_ord, trim(regexp_extract(concat('When: ', description, ' Cost: ', price_text), '(?is)\bcost\s*:\s*(.*?)(?:\b(?:when)\s*:|$)', 1)) AS cost_field, regexp_extract(lower(description), '\b((?:mon|tues|wednes|thurs|fri|satur|sun)day)s?\b', 1) AS weekday,
 array_to_string(regexp_extract_all(lower(description), '\b(\d{1,2}(?:[:.]\d{2})?\s*[ap]m)\b', 1)[1:3], '|') AS times FROM listings""", listing=True)  # fmt: skip
def labelled(spark, sf):
    s = X.signals(F.col("description"))
    return listings(spark, sf).select("row_ord", X.labelled(F.concat(F.lit("When: "), "description", F.lit(" Cost: "), "price_text"), "cost", ("when", "cost")).alias("cost_field"), s["weekday"].alias("weekday"), s["times"].alias("times"))


@query("extract_split_address__X15", r"""SELECT row_ord, CASE row_ord % 3 WHEN 0 THEN '1 High Street' WHEN 1 THEN 'Hall, 2 Low Road' END AS street, CASE WHEN row_ord % 3 < 2 THEN 'Mentone' END AS suburb FROM listings""", listing=True)
def split_address(spark, sf):
    text = F.when(F.col("row_ord") % 3 == 0, "Where\n1 High Street, Mentone (rear) VIC 3194").when(F.col("row_ord") % 3 == 1, "Hall, 2 Low Road, Mentone 3194").otherwise("no place")
    a = X.split_address(text)
    return listings(spark, sf).select("row_ord", a["street"].alias("street"), a["suburb"].alias("suburb"))


@query("extract_detail_address__X08", """SELECT s_suppkey, CASE s_suppkey % 5 WHEN 0 THEN '979 Nepean Highway|Moorabbin|3189' WHEN 1 THEN '2/5 Low Road|Mentone|3194' WHEN 2 THEN 'Bay Street|Chelsea|3196' WHEN 3 THEN '1 Old Lane|Carrum|3197' ELSE '' END AS address FROM supplier""")
def detail_address(spark, sf):
    said = ("Stitch, workshops during 2026\nHall\n979 Nepean Highway\nMoorabbin 3189", "Hall, 2/5 Low Road, Mentone, VIC 3194", "The Hall\nBay Street\nChelsea VIC\n3196", "Refugia 2026\nJane Doe, Contact 1300\nThe Rooms, 1 Old Lane,  Carrum 3197", "Kerri McConchie, Refugia 2026")
    a = X.detail_address(F.array(*map(F.lit, said))[(F.col("s_suppkey") % 5).cast("int")])
    return spark.read.parquet(f"{sf}/supplier.parquet").select("s_suppkey", F.concat_ws("|", a["street"], a["suburb"], a["postcode"]).alias("address"))


@query("extract_joined_url__X18", """SELECT s_suppkey, CASE s_suppkey % 7 WHEN 0 THEN 'https://www.socialplanet.com.au/activity/' || s_suppkey WHEN 1 THEN 'https://www.chelseaheightscommunitycentre.com.au' WHEN 2 THEN 'https://x.au/comedy-at-the-shirley' WHEN 3 THEN 'https://www.chelt.com.au/' WHEN 4 THEN 'https://b.org/view?id=' || s_suppkey ELSE 'info' END AS url FROM supplier""")
def joined_url(spark, sf):
    k = F.col("s_suppkey").cast("string")
    said = F.array(
        F.concat(F.lit("book at www.socialplanet. com.au/activity/"), k, F.lit(" today")), F.lit("www.chelseaheights communitycentre .com.au"), F.lit("see https://x.au/comedy-at- the-shirley now"),
        F.lit("www.chelt.com.au/ Join us soon"), F.concat(F.lit("https://b.org/view?id="), k, F.lit(" 1.00pm-2.00pm")), F.lit("http://a.b"), F.lit("no link"),
    )
    return spark.read.parquet(f"{sf}/supplier.parquet").select("s_suppkey", text.joined_url(said[(F.col("s_suppkey") % 7).cast("int")], F.lit("info")).alias("url"))


@query("extract_second_site__S14", """WITH e AS (SELECT s_suppkey, s_suppkey % 3 AS k FROM supplier), d AS (SELECT s_suppkey, DATE '2026-10-05' + (7 * i)::INT AS day FROM e, range(0, 12) t(i) WHERE (k = 1 AND i = 0) OR (k = 2 AND 7 * i <= s_suppkey % 90))
 SELECT s_suppkey, day, '09:30' AS at_time, 'Hall' AS location FROM d UNION ALL SELECT s_suppkey, NULL, NULL, 'own' FROM e WHERE k = 0""")
def second_site(spark, sf):
    k = F.col("s_suppkey")
    rows = spark.read.parquet(f"{sf}/supplier.parquet").select("s_suppkey", F.concat(F.lit("u"), k.cast("string")).alias("link"), F.lit("own").alias("location"))
    end = F.when(k % 3 == 1, F.lit("2026-10-04")).otherwise(F.date_add(F.lit("2026-10-05").cast("date"), (k % 90).cast("int")).cast("string"))
    html = F.concat(F.lit('<script type="application/ld+json">{"@type":"Event","location":{"name":"Hall"},"startDate":"2026-10-05T09:30:00","endDate":"'), end, F.lit('T11:00:00"}</script>'))
    return X.enrich_from_events(rows, rows.where(k % 3 != 0).select("link", html.alias("html")), "link", "html").select("s_suppkey", "day", F.col("at").alias("at_time"), "location")


@query("extract_guide_cleanup__X20_S18", r"""SELECT row_ord, concat('see https://x.invalid/a-', 'b', CAST(row_ord AS VARCHAR)) AS url_text, coalesce(regexp_extract(price_text, '(?i)^\s*((?:free|gold coin(?: donation)?|\$\s*\d+(?:\.\d{2})?)(?:\s*(?:per|a)\s+\w+)?)', 1), '') AS cost FROM listings""", listing=True)
def guide(spark, sf):
    return listings(spark, sf).select("row_ord", X.rejoin_urls(F.concat(F.lit("see https://x.invalid/a-\n b"), F.col("row_ord").cast("string"))).alias("url_text"), X.leading_price(F.col("price_text")).alias("cost"))


@query("extract_hours_schedule__X14_A10", """WITH s AS (SELECT user_id, (isodow(ts) - 1)::INT AS dow, (hour(ts) * 60)::INT AS a, (hour(ts) * 60 + 90)::INT AS b FROM events WHERE hour(ts) BETWEEN 8 AND 18),
 w AS (SELECT user_id, dow, min(a) AS a, max(b) AS b FROM s GROUP BY 1, 2 HAVING max(b) - min(a) <= 360),
 d AS (SELECT user_id, list({'dow': dow, 't': printf('%s %02d:%02d - %02d:%02d', ['Monday','Tuesday','Wednesday','Thursday','Friday','Saturday','Sunday'][dow + 1], a // 60, a % 60, b // 60, b % 60)} ORDER BY dow) AS days FROM w GROUP BY 1)
 SELECT user_id, array_to_string(list_transform(days, lambda x: x.t), ', ') AS schedule FROM d WHERE len(days) <= 4""")  # fmt: skip
def hours_schedule(spark, sf):
    e = spark.read.parquet(f"{sf}/events.parquet").where("hour(ts) BETWEEN 8 AND 18")
    sessions = e.select("user_id", F.weekday("ts").alias("dow"), F.date_format(F.date_trunc("hour", "ts"), "HH:mm").alias("open"), F.date_format(F.date_trunc("hour", "ts") + F.expr("interval 90 minutes"), "HH:mm").alias("close"))
    return X.hours_schedule(sessions, "user_id")


CONFIG = """
webfetch:
  - {id: a, name: A, type: listing, url: u, snapshot: a.json}
  - {id: a, name: "", type: sitemap, url: u, snapshot: a.json}
sources:
  - {name: C, type: other}
"""


@query("source_config_faults__S02_S03", "SELECT * FROM (VALUES (0, 'id used twice: a'), (0, 'snapshot used twice: a.json'), (1, 'id used twice: a'), (1, 'missing max_pages'), (1, 'missing name'), (1, 'snapshot used twice: a.json'), (2, 'missing id'), (2, 'unknown type other')) t(ord, fault)")
def config(spark, sf):
    return S.validate_config(spark, S.parse_config(CONFIG, yaml_text=True))


@query("source_archive_faults__S07", "SELECT row_ord, 'unknown source' AS fault FROM listings WHERE source_id <> 'click' UNION ALL SELECT row_ord, 'unknown status' FROM listings WHERE row_ord % 4 = 0 UNION ALL SELECT row_ord, 'missing status' FROM listings WHERE row_ord % 4 = 1", listing=True)
def archive_faults(spark, sf):
    status = F.when(F.col("row_ord") % 4 == 0, "odd").when(F.col("row_ord") % 4 == 1, "").otherwise("live")
    return S.archive_faults(listings(spark, sf).withColumn("status", status), ("click",))


@query("source_union_inputs__S06_U01", """, r AS (SELECT row_ord, source_id, CASE WHEN row_ord % 100 = 1 THEN 'x.progress.json' ELSE concat(source_id, CAST(row_ord % 10 AS VARCHAR), '.json') END AS file FROM listings)
 SELECT row_ord, NULL::BOOLEAN AS archived FROM listings WHERE row_ord % 5 = 0 UNION ALL SELECT row_ord, true FROM listings WHERE row_ord % 50 = 7
 UNION ALL SELECT row_ord, NULL FROM r WHERE file NOT LIKE '%.progress.json' AND file NOT IN (SELECT file FROM r WHERE source_id NOT IN ('click', 'view') OR source_id = 'view')""", listing=True)  # fmt: skip
def union_inputs(spark, sf):
    rows = listings(spark, sf).select("row_ord", "source_id")
    file = F.when(F.col("row_ord") % 100 == 1, "x.progress.json").otherwise(F.concat("source_id", (F.col("row_ord") % 10).cast("string"), F.lit(".json")))
    out = S.union_inputs(rows.where("row_ord % 5 = 0"), rows.where("row_ord % 50 = 7"), rows.withColumn("file", file), ("click", "view"), ("view",))
    return out.select("row_ord", "archived")


@query("source_count_change__S05_S20_S21_T06", """, a AS (SELECT source_id, count(*) AS before FROM listings GROUP BY 1), b AS (SELECT source_id, count(*) AS now FROM listings WHERE row_ord % 3 = 0 AND source_id <> 'view' GROUP BY 1)
 SELECT source_id, before, coalesce(now, 0)::BIGINT AS now, CASE WHEN before > coalesce(now, 0) THEN floor(100 * (before - coalesce(now, 0)) / before)::BIGINT ELSE 0 END AS lost_percent FROM a LEFT JOIN b USING (source_id)""", listing=True)  # fmt: skip
def count_change(spark, sf):
    rows = listings(spark, sf)
    return S.count_change(rows, rows.where("row_ord % 3 = 0 AND source_id <> 'view'"), "source_id")


@query("source_term_rows__S14_R16", f"SELECT event_id, CAST(DATE '{TODAY}' + (k * 7)::INT AS DATE) AS day FROM events, range(0, 12) t(k) WHERE k * 7 <= event_id % 80 AND (k = 0 OR event_id % 80 >= 7)")
def term_rows(spark, sf):
    from gleanery.functions import dates

    start = F.lit(TODAY).cast("date")
    e = spark.read.parquet(f"{sf}/events.parquet")
    return e.select("event_id", F.explode(dates.weekly_term(start, F.date_add(start, (F.col("event_id") % 80).cast("int")))).alias("day"))


@query("incremental_sitemap__S16_T02", """WITH i AS (SELECT DISTINCT n_regionkey % 3 AS sitemap FROM nation), c AS (SELECT page_id % 5 AS sitemap, url FROM pages), d AS (SELECT url FROM pages WHERE page_id % 4 = 0), u AS (SELECT DISTINCT url FROM c WHERE sitemap IN (SELECT sitemap FROM i) AND url NOT IN (SELECT url FROM d))
 SELECT url, 'left' AS state FROM u UNION ALL SELECT DISTINCT url, 'done' FROM (SELECT url FROM d UNION ALL SELECT url FROM u)""")
def sitemap(spark, sf):
    p = pages(spark, sf)
    index = spark.read.parquet(f"{sf}/nation.parquet").select((F.col("n_regionkey") % 3).cast("long").alias("sitemap"))
    done = p.where("page_id % 4 = 0").select("url")
    left = S.sitemap_urls(index, p.select((F.col("page_id") % 5).alias("sitemap"), "url"), done)
    state, _ = S.resume(done, done.withColumn("row", F.lit("old")), left.withColumn("row", F.lit("new")))
    return left.withColumn("state", F.lit("left")).unionByName(state.withColumn("state", F.lit("done")))


@query("incremental_next_slice__S16_T02_K03", "SELECT DISTINCT url FROM pages WHERE page_id % 3 <> 0 AND url NOT IN (SELECT url FROM pages WHERE page_id % 3 = 0) ORDER BY url LIMIT 45")
def next_slice(spark, sf):
    p = pages(spark, sf)
    return S.next_slice(p.select("url"), p.where("page_id % 3 = 0"), 45, 60, 1000)


@query("incremental_merge_store__T01_T03_T04", """, st AS (SELECT slot_hash, min(row_ord) AS row_ord FROM l WHERE row_ord % 2 = 0 GROUP BY 1), ba AS (SELECT slot_hash, min(row_ord) AS row_ord FROM l WHERE row_ord % 3 = 0 GROUP BY 1),
 m AS (SELECT * FROM ba UNION ALL SELECT * FROM st WHERE slot_hash NOT IN (SELECT slot_hash FROM ba)) SELECT m.slot_hash, m.row_ord FROM m JOIN l ON l.row_ord = m.row_ord WHERE ts_local IS NULL OR ts_local >= TIMESTAMP '2024-01-10 00:00:00'""", listing=True)  # fmt: skip
def merge_store(spark, sf):
    rows = normalized(spark, sf).select("slot_hash", "row_ord", "ts_local")
    store = rows.where("row_ord % 2 = 0").groupBy("slot_hash").agg(F.min_by("ts_local", "row_ord").alias("ts_local"), F.min("row_ord").alias("row_ord"))
    batch = rows.where("row_ord % 3 = 0")
    once = incremental.merge_store(store, batch, "2024-01-15", days=5)
    return incremental.merge_store(once, batch, "2024-01-15", days=5).select("slot_hash", "row_ord")
