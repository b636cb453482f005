"""Scalar functions, predicates and projections over the listings."""

from __future__ import annotations

from pyspark.sql import functions as F

from gleanery.functions import dates, text

from .base import SUBURBS, TODAY, listings, normalized, query

_ROADS = "|".join(text.ROAD_TYPES)
_ONLINE = "|".join(text.ONLINE_WORDS)


@query("scalar_names__F01_F03_F04_F05_F06_H01_H03", "SELECT row_ord, name_norm, loc_norm, venue, stamp, slot_hash FROM l", listing=True)
def names(spark, sf):
    return normalized(spark, sf).select("row_ord", "name_norm", "loc_norm", "venue", "stamp", "slot_hash")


@query("scalar_fold_accents__F02", "SELECT row_ord, replace(strip_accents(name), '®', '') AS folded FROM listings", listing=True)
def fold(spark, sf):
    return listings(spark, sf).select("row_ord", text.fold_accents("name").alias("folded"))


@query("scalar_series_id__H02", "SELECT row_ord, substring(sha1(concat_ws('|', source_id, name_norm, venue)), 1, 12) AS series_id FROM l", listing=True)
def series(spark, sf):
    return normalized(spark, sf).select("row_ord", text.series_id(F.col("source_id"), F.col("name_norm"), F.col("venue")).alias("series_id"))


@query("scalar_occurrence_key__H04", "SELECT row_ord, concat_ws('|', name_norm, stamp, loc_norm) AS occurrence FROM l", listing=True)
def occurrence(spark, sf):
    return normalized(spark, sf).select("row_ord", F.concat_ws("|", "name_norm", "stamp", "loc_norm").alias("occurrence"))


@query("scalar_price__M01_M02", r"""SELECT row_ord, price_sort, price_sort > 0 OR coalesce(TRY_CAST(nullif(regexp_extract(price_text, '\$\s*(\d+)', 1), '') AS DOUBLE), 0) > 0 AS priced,
 coalesce(price_sort >= 5, false) AS solid FROM l""", listing=True)  # fmt: skip
def price(spark, sf):
    amount = F.regexp_extract("price_text", r"\$\s*(\d+)", 1)
    return normalized(spark, sf).select(
        "row_ord", "price_sort", ((F.col("price_sort") > 0) | (F.coalesce(F.nullif(amount, F.lit("")).cast("double"), F.lit(0.0)) > 0)).alias("priced"), F.coalesce(F.col("price_sort") >= 5, F.lit(False)).alias("solid")
    )


_ADDRESS_SQL = r"""
, parts AS (SELECT row_ord, list_filter(list_transform(string_split(address, ','), lambda x: trim(x)), lambda x: x <> '') AS seg, address FROM listings)
SELECT row_ord, contains(trim(address), ',,') OR starts_with(trim(address), ',') OR ends_with(trim(address), ',')
  OR len(list_filter(range(1, len(seg)), lambda i: lower(seg[i]) = lower(seg[i + 1]))) > 0 AS malformed,
  contains(trim(address), ',,') OR starts_with(trim(address), ',') OR ends_with(trim(address), ',') AS comma_fault FROM parts"""


@query("filter_malformed_address__P10_P11", _ADDRESS_SQL, listing=True)
def malformed(spark, sf):
    return listings(spark, sf).select("row_ord", text.malformed_address(F.col("address")).alias("malformed"), text.malformed_commas(F.col("address")).alias("comma_fault"))


@query("filter_online_needs_address__P05_P06_P09", rf"""SELECT row_ord, regexp_matches(lower(location), '\b(?:{_ONLINE})\b') AS online, NOT regexp_matches(lower(location), '\b(?:{_ONLINE})\b') AS needs_address,
 regexp_matches(lower(location), '\b(?:{_ONLINE})\b') OR regexp_matches(address, '\b3\d{{3}}\b|(?i)\b(?:{_ROADS})\b') AS kept FROM listings""", listing=True)  # fmt: skip
def online(spark, sf):
    on = text.is_online(F.col("location"))
    return listings(spark, sf).select("row_ord", on.alias("online"), (~on).alias("needs_address"), (on | text.states_a_place(F.col("address"))).alias("kept"))


@query("filter_states_a_place__P08_P25", rf"SELECT row_ord, regexp_matches(address, '\b3\d{{3}}\b|(?i)\b(?:{_ROADS})\b') AS place, regexp_matches(trim(address), '(?i)\b(?:{_ROADS})\b\.?$') AS street_tail FROM listings", listing=True)
def place(spark, sf):
    return listings(spark, sf).select("row_ord", text.states_a_place(F.col("address")).alias("place"), text.is_street(F.col("address")).alias("street_tail"))


@query("filter_furniture_next_date__P12_P13", r"SELECT row_ord, regexp_matches(address, '(?i)\bview map\b|\n\s*\S+,\s*\n') AS furniture, regexp_matches(description, '(?i)\bnext date:') AS next_date FROM listings", listing=True)
def furniture(spark, sf):
    return listings(spark, sf).select("row_ord", text.page_furniture(F.col("address")).alias("furniture"), text.names_next_occurrence(F.col("description")).alias("next_date"))


@query("project_make_row__P01_P02", r"""SELECT row_ord, coalesce(name, '') AS name,
 CASE WHEN trim(regexp_replace(lower(description), '\s+', ' ', 'g')) = trim(regexp_replace(lower(name), '\s+', ' ', 'g')) AND length(trim(regexp_replace(lower(name), '\s+', ' ', 'g'))) >= 3 THEN '' ELSE description END AS description
 FROM listings""", listing=True)  # fmt: skip
def make_row(spark, sf):
    return listings(spark, sf).select("row_ord", F.coalesce("name", F.lit("")).alias("name"), F.when(text.restates_name(F.col("description"), F.col("name")), "").otherwise(F.col("description")).alias("description"))


_DMY = r"(?i)\b(\d{1,2})(?:st|nd|rd|th)?\s+(january|february|march|april|may|june|july|august|september|october|november|december)\.?,?\s+(\d{4})\b"
_DMY_SQL = f"""CASE WHEN regexp_matches({{0}}, '{_DMY}') THEN TRY_CAST(concat(regexp_extract({{0}}, '{_DMY}', 3), '-',
 lpad(CAST(list_position(['january','february','march','april','may','june','july','august','september','october','november','december'], lower(regexp_extract({{0}}, '{_DMY}', 2))) AS VARCHAR), 2, '0'), '-',
 lpad(regexp_extract({{0}}, '{_DMY}', 1), 2, '0')) AS DATE) END"""


@query("project_normalize__P03_P04_C05_U05", f"""SELECT row_ord, coalesce(CAST(ts_local AS TIMESTAMP), CAST({_DMY_SQL.replace('{0}', 'datetime_text')} AS TIMESTAMP)) AS ts, price_sort,
 array_to_string(list_distinct([source, url]), ' ') IS NOT NULL AS has_sources, {_DMY_SQL.replace('{0}', 'datetime_text')} AS stated FROM l""", listing=True)  # fmt: skip
def normalize(spark, sf):
    stated = dates.day_month_year(F.col("datetime_text"))
    return normalized(spark, sf).select(
        "row_ord", F.coalesce("ts_local", stated.cast("timestamp_ntz")).alias("ts"), "price_sort", F.array_join(F.array_distinct(F.array("source", "url")), " ").isNotNull().alias("has_sources"), stated.alias("stated")
    )


_TIME_SQL = r"""
, t AS (SELECT row_ord, lower(concat(datetime_text, ' ', description)) AS x FROM listings),
g AS (SELECT *, regexp_extract(x, '\b(\d{1,2})(?:[:.](\d{2}))?\s*(?:([ap])\.?m\.?)?\s*(?:-|–|to)\s*(\d{1,2})(?:[:.](\d{2}))?\s*([ap])\.?m\b', ['h1','m1','a1','h2','m2','a2']) AS r,
  regexp_extract(x, '\b(\d{1,2})(?:[:.](\d{2}))?\s*([ap])\.?m\b', ['h','m','a']) AS s, regexp_extract(x, '\b(\d{1,2}):(\d{2})\b', ['h','m']) AS k FROM t),
c AS (SELECT row_ord, r, s, k, CASE WHEN coalesce(nullif(r.a1, ''), r.a2) = 'p' AND TRY_CAST(r.h1 AS INT) < 12 THEN TRY_CAST(r.h1 AS INT) + 12 WHEN coalesce(nullif(r.a1, ''), r.a2) = 'a' AND TRY_CAST(r.h1 AS INT) = 12 THEN 0 ELSE TRY_CAST(r.h1 AS INT) END AS b1,
  TRY_CAST(coalesce(nullif(r.m1, ''), '0') AS INT) AS n1, CASE WHEN r.a2 = 'p' AND TRY_CAST(r.h2 AS INT) < 12 THEN TRY_CAST(r.h2 AS INT) + 12 WHEN r.a2 = 'a' AND TRY_CAST(r.h2 AS INT) = 12 THEN 0 ELSE TRY_CAST(r.h2 AS INT) END AS b2, TRY_CAST(coalesce(nullif(r.m2, ''), '0') AS INT) AS n2
  FROM (SELECT row_ord, CASE WHEN r.h1 = '' THEN NULL ELSE r END AS r, s, k FROM g)),
d AS (SELECT row_ord, r, s, k, CASE WHEN b1 <= 23 AND n1 <= 59 THEN printf('%02d:%02d', b1, n1) END AS t1, CASE WHEN b2 <= 23 AND n2 <= 59 THEN printf('%02d:%02d', b2, n2) END AS t2 FROM c),
e AS (SELECT row_ord, r, s, k, t1, t2, CASE WHEN s.h <> '' THEN CASE WHEN s.a = 'p' AND TRY_CAST(s.h AS INT) < 12 THEN TRY_CAST(s.h AS INT) + 12 WHEN s.a = 'a' AND TRY_CAST(s.h AS INT) = 12 THEN 0 ELSE TRY_CAST(s.h AS INT) END END AS sh FROM d)
SELECT row_ord, CASE WHEN r IS NOT NULL THEN CASE WHEN t2 >= t1 THEN t1 END WHEN s.h <> '' THEN CASE WHEN sh <= 23 AND TRY_CAST(coalesce(nullif(s.m, ''), '0') AS INT) <= 59 THEN printf('%02d:%02d', sh, TRY_CAST(coalesce(nullif(s.m, ''), '0') AS INT)) END
  WHEN k.h <> '' THEN CASE WHEN TRY_CAST(k.h AS INT) <= 23 AND TRY_CAST(k.m AS INT) <= 59 THEN printf('%02d:%02d', TRY_CAST(k.h AS INT), TRY_CAST(k.m AS INT)) END END AS start FROM e"""


@query("scalar_parse_time__C06_C07", _TIME_SQL, listing=True)
def parse_time(spark, sf):
    return listings(spark, sf).select("row_ord", dates.parse_time(F.concat_ws(" ", "datetime_text", "description")).alias("start"))


@query("scalar_first_time__C17", """SELECT row_ord, CASE row_ord % 6 WHEN 0 THEN '12:00' WHEN 1 THEN '12:00' WHEN 2 THEN '21:05' WHEN 3 THEN '00:15' WHEN 4 THEN '07:00' ELSE '' END AS start FROM listings""", listing=True)
def first_time(spark, sf):
    said = ("from 12noon to 1.30pm", "11 midday, then 3pm", "at 9.05 p.m. or noon", "12:15am", "7am - 8:30am", "this afternoon")
    return listings(spark, sf).select("row_ord", dates.first_time(F.array(*map(F.lit, said))[(F.col("row_ord") % 6).cast("int")]).alias("start"))


@query("scalar_range_starts__C08", """SELECT s_suppkey, '0 09:30,2 ' || lpad(CAST(s_suppkey % 9 + 13 AS VARCHAR), 2, '0') || ':00,2 20:00' AS starts FROM supplier""")
def range_starts(spark, sf):
    lines = F.array(F.lit("Mon 9.30-11am"), F.lit("1-31 October, noon"), F.concat((F.col("s_suppkey") % 9 + 1).cast("string"), F.lit(" to 10pm; 8pm – 9.15pm")))
    starts = F.transform(dates.range_starts(lines), lambda x: F.concat(x["line"].cast("string"), F.lit(" "), x["at"]))
    return spark.read.parquet(f"{sf}/supplier.parquet").select("s_suppkey", F.array_join(starts, ",").alias("starts"))


@query("scalar_cleaners__F09_F15", """SELECT s_suppkey, concat('$', s_suppkey, ' a class') AS cost, concat('Zumba ', s_suppkey) AS title, concat(s_name, ', 1 High Street...') AS start, concat('a', chr(10), 'x = "http://y"; ', s_suppkey) AS code FROM supplier""")
def cleaners(spark, sf):
    k, line = F.col("s_suppkey").cast("string"), F.lit("\n")
    return spark.read.parquet(f"{sf}/supplier.parquet").select(
        "s_suppkey",
        text.clean_cost(F.concat(F.lit(" $"), k, F.lit(" a class ==; Find out more BUTTON Book here"))).alias("cost"),
        text.clean_title(F.concat(F.lit("\u200bZumba\xa0\ufffd"), k)).alias("title"),
        text.keep_start(F.concat("s_name", F.lit(", 1 High Street, "), F.repeat(F.lit("x"), 200)), 34).alias("start"),
        text.strip_comments(F.concat(F.lit("a<!-- b\n -->"), line, F.lit("  // gone"), line, F.lit('x = "http://y"; /* c */'), k)).alias("code"),
    )


@query("scalar_combine__C09_C14", "SELECT row_ord, CASE WHEN ts_local IS NOT NULL THEN date_trunc('day', ts_local) + INTERVAL 9 HOUR + INTERVAL 30 MINUTE END AS at_ts FROM listings", listing=True)
def combine(spark, sf):
    return listings(spark, sf).select("row_ord", (F.date_trunc("day", "ts_local").cast("timestamp_ntz") + F.expr("interval '9:30' hour to minute")).alias("at_ts"))


@query("scalar_local_stamp__C01_C02_C03", "SELECT row_ord, CASE WHEN ts_local IS NULL THEN '' ELSE strftime(timezone('Australia/Melbourne', ts_local AT TIME ZONE 'UTC'), '%Y-%m-%dT%H:%M') END AS stamp FROM listings", listing=True)
def local_stamp(spark, sf):
    return listings(spark, sf).select("row_ord", dates.slot_stamp_raw(F.concat(F.date_format("ts_local", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z"))).alias("stamp"))


@query("scalar_months__C04_C12", """SELECT i::INT AS i, CAST(DATE '2024-01-01' + to_months(i::INT) AS DATE) AS month_start, lower(strftime(DATE '2024-01-01' + to_months(i::INT), '%b')) AS abbr, (i % 12 + 1)::INT AS number FROM range(12) t(i)""")
def months(spark, sf):
    start = F.add_months(F.lit("2024-01-01").cast("date"), F.col("i"))
    abbr = F.lower(F.date_format(start, "MMM"))
    return spark.range(12).select(F.col("id").cast("int").alias("i")).select("i", start.alias("month_start"), abbr.alias("abbr"), dates.month_number(abbr).alias("number"))


@query("scalar_nth_weekday__C13_C16", """WITH m AS (SELECT CAST(DATE '2024-01-01' + to_months(i::INT) AS DATE) AS month_start, n::INT AS nth, d::INT AS dow FROM range(20) a(i), range(1, 6) b(n), range(7) c(d)),
 x AS (SELECT *, CAST(month_start + ((dow - (isodow(month_start) - 1) + 7) % 7 + (nth - 1) * 7)::INT AS DATE) AS day FROM m)
 SELECT month_start, nth, dow, CASE WHEN month(day) = month(month_start) THEN day END AS day FROM x""")  # fmt: skip
def nth_weekday(spark, sf):
    start = F.add_months(F.lit("2024-01-01").cast("date"), F.floor(F.col("id") / 35).cast("int"))
    rows = spark.range(700).select(start.alias("month_start"), (F.floor(F.col("id") / 7) % 5 + 1).cast("int").alias("nth"), (F.col("id") % 7).cast("int").alias("dow"))
    return rows.withColumn("day", dates.nth_weekday(F.col("month_start"), F.col("nth"), F.col("dow")))


@query("scalar_weekly_term__R16", f"""SELECT o_orderkey, array_to_string(list_transform(CASE WHEN (o_orderkey % 120) < 7 THEN [DATE '{TODAY}'] ELSE
 list_transform(range(0, least(12, (o_orderkey % 120) // 7 + 1)), lambda k: CAST(DATE '{TODAY}' + (k * 7)::INT AS DATE)) END, lambda d: strftime(d, '%Y-%m-%d')), ' ') AS days FROM orders""")  # fmt: skip
def weekly_term(spark, sf):
    start = F.lit(TODAY).cast("date")
    end = F.date_add(start, (F.col("o_orderkey") % 120).cast("int"))
    return spark.read.parquet(f"{sf}/orders.parquet").select("o_orderkey", F.array_join(F.transform(dates.weekly_term(start, end), lambda d: d.cast("string")), " ").alias("days"))


_SUB = "[" + ", ".join(f"'{s}'" for s in SUBURBS) + "]"
_LOOK = f"list_filter({_SUB}, lambda s: lower(s) = trim(regexp_replace(lower({{0}}), '\\s+', ' ', 'g')))[1]"
_NAME = r"([A-Za-z][A-Za-z'' ]*?)"
_SUBURB_SQL = rf"""
, a AS (SELECT row_ord, regexp_replace(address, '\s*\n\s*', ' ', 'g') AS a FROM listings),
p AS (SELECT row_ord, regexp_extract(a, '(?:^|,)\s*{_NAME},?\s+(?:VIC|Vic|Victoria|VICTORIA)\.?,?\s+3\d{{3}}\b', 1) AS x1, regexp_extract(a, '(?:^|,)\s*{_NAME},?\s+(?:VIC|Vic|Victoria|VICTORIA)\.?\s*$', 1) AS x2,
  regexp_extract(a, '(?:^|,)\s*{_NAME},?\s+3\d{{3}}\s*$', 1) AS x3, list_filter(list_transform(string_split(a, ','), lambda x: trim(x)), lambda x: x <> '') AS seg FROM a),
q AS (SELECT *, CASE WHEN len(seg) > 1 AND regexp_matches(seg[-2], '(?i)\b(?:{_ROADS})\b\.?$') THEN seg[-1] ELSE '' END AS x4 FROM p),
s AS (SELECT row_ord, coalesce({_LOOK.replace('{0}', 'x1')}, {_LOOK.replace('{0}', 'x2')}, {_LOOK.replace('{0}', 'x3')}, {_LOOK.replace('{0}', 'x4')}, '') AS suburb FROM q)
"""


@query("scalar_suburb__F10_F11", _SUBURB_SQL + "SELECT row_ord, suburb FROM s", listing=True)
def suburb(spark, sf):
    return listings(spark, sf).select("row_ord", text.extract_suburb(F.col("address"), SUBURBS).alias("suburb"))


@query("filter_suburb_catchment__P07", _SUBURB_SQL + rf"""SELECT l.row_ord FROM l JOIN s USING (row_ord) WHERE regexp_matches(lower(location), '\b(?:{_ONLINE})\b')
 OR CASE WHEN suburb <> '' THEN suburb IN ('Chelsea', 'Mentone') ELSE contains(lower(concat_ws(' ', name, location, address, description)), 'chelsea') OR contains(lower(concat_ws(' ', name, location, address, description)), 'mentone') END""", listing=True)  # fmt: skip
def catchment(spark, sf):
    from gleanery.operators.filters import in_catchment

    return listings(spark, sf).where(in_catchment(("Chelsea", "Mentone"), SUBURBS)).select("row_ord")


@query("filter_prune_old__P14_T04", f"SELECT row_ord FROM listings WHERE ts_local IS NULL OR ts_local >= TIMESTAMP '{TODAY} 00:00:00'", listing=True)
def prune(spark, sf):
    from gleanery.operators.filters import prune_old

    return prune_old(listings(spark, sf), "ts_local", today=TODAY, days=0).select("row_ord")


@query("filter_on_page__P15", "SELECT row_ord FROM listings WHERE NOT coalesce(CASE row_ord % 3 WHEN 0 THEN true WHEN 1 THEN false END, false)", listing=True)
def on_page(spark, sf):
    archived = F.when(F.col("row_ord") % 3 == 0, True).when(F.col("row_ord") % 3 == 1, False)
    return listings(spark, sf).where(~archived.eqNullSafe(F.lit(True))).select("row_ord")


@query("scalar_safe_url__P16_F14", "SELECT page_id, CASE WHEN page_id % 4 = 0 THEN '' WHEN page_id % 4 = 1 THEN rtrim(url, '/') WHEN page_id % 4 = 2 THEN '/local' ELSE '' END AS href FROM pages")
def safe_url(spark, sf):
    url = F.when(F.col("page_id") % 4 == 0, F.concat(F.lit("javascript:"), "url")).when(F.col("page_id") % 4 == 1, F.regexp_replace("url", "/+$", "")).when(F.col("page_id") % 4 == 2, F.lit("/local")).otherwise(F.lit("//evil"))
    return spark.read.parquet(f"{sf}/pages.parquet").select("page_id", text.safe_url(url).alias("href"))


@query("scalar_join_address__F08_W06", r"""
SELECT s_suppkey, concat(s_name, ', Beaumaris, Victoria 3193') AS joined FROM supplier""")
def join_address(spark, sf):
    parts = F.array("s_name", F.lit("Beaumaris, beaumaris"), F.lit(" Victoria 3193 "), F.lit("Australia"), F.lit(""))
    return spark.read.parquet(f"{sf}/supplier.parquet").select("s_suppkey", text.join_address(parts).alias("joined"))


_LCS = """list_last(list_reduce(list_transform(string_split(a,''), lambda ch: [ch]), lambda prev,ch: list_reduce(list_transform(range(1,length(b)+1), lambda j: [j::VARCHAR]), lambda cur,j: list_append(cur,
 (CASE WHEN b[j[1]::INT]=ch[1] THEN prev[j[1]::INT]::INT+1 ELSE greatest(prev[j[1]::INT+1]::INT, cur[-1]::INT) END)::VARCHAR), ['0']), list_transform(range(0,length(b)+1), lambda _: '0')))"""


@query("scalar_similarity__F07", f"""WITH p AS (SELECT s.s_suppkey AS i, n.n_nationkey AS j, lower(s.s_name) AS a, lower(n.n_name) AS b FROM supplier s JOIN nation n ON n.n_nationkey = s.s_nationkey)
 SELECT i, j, round(2.0 * ({_LCS})::INT / (length(a) + length(b)), 6)::DOUBLE AS similarity FROM p""")  # fmt: skip
def similarity(spark, sf):
    s, n = spark.read.parquet(f"{sf}/supplier.parquet"), spark.read.parquet(f"{sf}/nation.parquet")
    rows = s.join(n, s.s_nationkey == n.n_nationkey)
    return rows.select(F.col("s_suppkey").alias("i"), F.col("n_nationkey").alias("j"), F.round(text.indel_similarity(F.lower("s_name"), F.lower("n_name")), 6).alias("similarity"))


@query("scalar_text_caps__F12_F13_F16_F17_F18", r"""SELECT row_ord, substring(description, 1, 20) AS cap, trim(regexp_replace(replace(lower(address), ',', ' '), '\s+', ' ', 'g')) AS taxonomy_key,
 lower(regexp_replace(description, '\s*\([^()]*\)\s*$', '')) AS cadence, trim(regexp_replace(location, '^[^,]*,', '')) AS searchable, regexp_extract(address, '\b(3\d{3})\b', 1) AS postcode FROM listings""", listing=True)  # fmt: skip
def caps(spark, sf):
    return listings(spark, sf).select(
        "row_ord",
        F.substring("description", 1, 20).alias("cap"),
        text.squeeze(F.replace(F.lower("address"), F.lit(","), F.lit(" "))).alias("taxonomy_key"),
        text.cadence_label(F.col("description")).alias("cadence"),
        F.trim(F.regexp_replace("location", "^[^,]*,", "")).alias("searchable"),
        F.regexp_extract("address", r"\b(3\d{3})\b", 1).alias("postcode"),
    )


@query("scalar_contrast__M03", """WITH c AS (SELECT p_partkey, p_size * 5 % 256 AS a, p_partkey * 7 % 256 AS b FROM part),
 l AS (SELECT p_partkey, CASE WHEN a / 255.0 <= 0.03928 THEN a / 255.0 / 12.92 ELSE pow((a / 255.0 + 0.055) / 1.055, 2.4) END AS x, CASE WHEN b / 255.0 <= 0.03928 THEN b / 255.0 / 12.92 ELSE pow((b / 255.0 + 0.055) / 1.055, 2.4) END AS y FROM c)
 SELECT p_partkey, round((greatest(x, y) + 0.05) / (least(x, y) + 0.05), 6)::DOUBLE AS contrast FROM l""")  # fmt: skip
def contrast(spark, sf):
    def lum(c):
        v = c / 255.0
        return F.when(v <= 0.03928, v / 12.92).otherwise(F.pow((v + 0.055) / 1.055, F.lit(2.4)))

    x, y = lum(F.col("p_size") * 5 % 256), lum(F.col("p_partkey") * 7 % 256)
    return spark.read.parquet(f"{sf}/part.parquet").select("p_partkey", F.round((F.greatest(x, y) + 0.05) / (F.least(x, y) + 0.05), 6).alias("contrast"))


@query("scalar_fortnight_parity__M04", "SELECT row_ord, ((date_diff('day', DATE '2024-01-01', CAST(ts_local AS DATE)) // 7) % 2)::INT AS parity FROM listings", listing=True)
def parity(spark, sf):
    return listings(spark, sf).select("row_ord", F.pmod(F.floor(F.datediff("ts_local", F.lit("2024-01-01")) / 7), F.lit(2)).cast("int").alias("parity"))


@query("scalar_stated_dates__C18_R19", r"SELECT row_ord, array_to_string(list_distinct(list_concat(CASE WHEN day = '' THEN [] ELSE [day] END, regexp_extract_all(datetime_text, '\d{4}-\d{2}-\d{2}'))), ' ') AS days FROM l", listing=True)
def stated_dates(spark, sf):
    own = F.when(F.col("day") == "", F.array().cast("array<string>")).otherwise(F.array("day"))
    return normalized(spark, sf).select("row_ord", F.array_join(F.array_distinct(F.concat(own, F.regexp_extract_all("datetime_text", F.lit(r"(\d{4}-\d{2}-\d{2})")))), " ").alias("days"))


@query("project_payload__P24_S22", r"""SELECT row_ord, replace(to_json({'n': name_norm, 'v': venue}), '</', '<\/') AS payload, price_sort FROM l WHERE name_norm <> ''""", listing=True)
def payload(spark, sf):
    return normalized(spark, sf).where("name_norm <> ''").select("row_ord", F.replace(F.to_json(F.struct(F.col("name_norm").alias("n"), F.col("venue").alias("v"))), F.lit("</"), F.lit("<\\/")).alias("payload"), "price_sort")


@query("scalar_strip_html_comments__F15", r"""SELECT page_id, length(regexp_replace(html, '(?s)<!--.*?-->', '', 'g'))::BIGINT AS stripped, len(regexp_extract_all(html, '<p>'))::BIGINT AS p_open, len(regexp_extract_all(html, '</p>'))::BIGINT AS p_close FROM pages""")
def strip_comments(spark, sf):
    return spark.read.parquet(f"{sf}/pages.parquet").select(
        "page_id", F.length(F.regexp_replace("html", r"(?s)<!--.*?-->", "")).cast("long").alias("stripped"), F.regexp_count("html", F.lit("<p>")).cast("long").alias("p_open"), F.regexp_count("html", F.lit("</p>")).cast("long").alias("p_close")
    )
