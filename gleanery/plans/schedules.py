"""Recurrence queries: literal Specs and schedule texts to dates."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from gleanery.functions import schedule
from gleanery.operators import recurrence as RC

from gleanery.sources.listings import PHRASES

from .base import listings, normalized, query

DAY = "2026-09-30"
#: (id, kind, weekday, begin, nth, start, end, m1, m2, year, periods)
SPECS = (
    (1, "weekly", 1, "19:00", 0, None, None, None, None, None, None),
    (2, "weekly", 0, "15:00", 0, "2026-10-05", "2026-12-14", None, None, None, 10),
    (3, "fortnightly", 4, "10:30", 0, None, None, None, None, None, None),
    (4, "fortnightly", 5, "10:30", 0, "2026-10-17", "2026-12-05", None, None, None, None),
    (5, "monthly", 6, "14:30", 3, None, None, 2, 11, 2026, None),
    (6, "monthly", 2, None, 5, None, None, None, None, None, None),
    (7, "weekly", 3, None, 0, None, None, None, None, None, 6),
    (8, "fortnightly", 4, "09:00", 0, "2026-01-02", None, None, None, None, None),
)
TEXTS = (
    "third Sunday of the month, 2.30pm to 4pm, from February to November", "Monday. 3pm - 5pm. Term 4 : 5th October - 14th December Weeks : 10", "Tuesdays and Thursdays 9am for 6 weeks",
    "Every second Saturday 10:30am - 12:30pm Term 4 (17th October - 5th December)", "Every second Friday", "Drop-In Casual Basketball Monday 12 October, 5:30pm", "Storytime on Tuesday 6 October 2026, 10:00am",
    "Drop-In Monday 28 September, 5:30pm", "Every Tuesday 7pm - 8pm", "Tuesday 9am - 12pm", "First Tuesday each week, 7pm", "First Tuesday of every month, 7pm", "Mondays 9 - 8pm",
    "Mondays and Wednesdays 9am - 12pm. Bookings close 4pm.", "Friday (fortnightly) 10.30am-11.30am", "",
)


def specs(spark):
    rows = [(i, (k, [{"dow": d, "begin": b, "finish": None}], n, date.fromisoformat(s) if s else None, date.fromisoformat(e) if e else None, m1, m2, y, p, "", "")) for i, k, d, b, n, s, e, m1, m2, y, p in SPECS]
    from pyspark.sql.types import IntegerType, StructField, StructType

    return spark.createDataFrame(rows, StructType([StructField("id", IntegerType()), StructField("spec", RC.SPEC)]))


def _lit(v) -> str:
    return "NULL" if v is None else f"'{v}'" if isinstance(v, str) else str(v)


def expand_sql(rows: tuple) -> str:
    """Common table expressions that end in o(id, day, begin_t): the dates of specs given as (id, kind, weekday, begin, nth, start, end, m1, m2, year, periods), a row for each slot."""
    values = ", ".join("(" + ", ".join(map(_lit, r)) + ")" for r in rows)
    return f"""s AS (SELECT id::INT AS id, kind, dow::INT AS dow, begin_t::VARCHAR AS begin_t, nth::INT AS nth, start_d::DATE AS start_d, end_d::DATE AS end_d, m1::INT AS m1, m2::INT AS m2, y::INT AS y, p::INT AS p, count(*) OVER (PARTITION BY id) AS slots
   FROM (VALUES {values}) t(id, kind, dow, begin_t, nth, start_d, end_d, m1, m2, y, p)),
 d AS (SELECT CAST(DATE '{DAY}' + i::INT AS DATE) AS day FROM range(0, 620) t(i)),
 c AS (SELECT s.*, day, (CASE WHEN start_d IS NOT NULL THEN CAST(start_d + ((dow - (isodow(start_d) - 1) + 7) % 7)::INT AS DATE) END) AS anchor FROM s JOIN d ON CASE WHEN kind = 'once' THEN day = start_d ELSE isodow(day) - 1 = dow END),
 k AS (SELECT * FROM c WHERE CASE kind WHEN 'once' THEN true WHEN 'weekly' THEN day <= DATE '{DAY}' + {schedule.WEEKLY_DAYS} WHEN 'fortnightly' THEN CASE WHEN start_d IS NOT NULL THEN (day - anchor) % 14 = 0 AND day >= anchor AND day <= anchor + 168
   ELSE ((day - DATE '2024-01-01') // 7) % 2 = 0 AND day <= DATE '{DAY}' + {schedule.FORTNIGHT_DAYS} END ELSE (day(day) - 1) // 7 + 1 = nth AND day < DATE '2026-09-01' + INTERVAL {schedule.MONTHLY_MONTHS} MONTH END
   AND (start_d IS NULL OR day >= start_d) AND (end_d IS NULL OR day <= end_d) AND (m1 IS NULL OR month(day) BETWEEN m1 AND m2) AND (y IS NULL OR year(day) = y)),
 o AS (SELECT id, day, begin_t FROM k QUALIFY row_number() OVER (PARTITION BY id ORDER BY day, coalesce(begin_t, '')) <= CASE WHEN p IS NOT NULL AND end_d IS NULL THEN least({schedule.MOST}, p * slots) ELSE {schedule.MOST} END)"""


@query("recur_expand__R13_R16_K01_K02_C13_P23", f'WITH {expand_sql(SPECS)} SELECT id, day, begin_t AS "begin_at" FROM o')
def expand(spark, sf):
    return RC.expand(specs(spark), ["id"], DAY).withColumnRenamed("begin", "begin_at")


#: What each of TEXTS says, by hand: a row for each slot.
TEXT_SPECS = (
    (0, "monthly", 6, "14:30", 3, None, None, 2, 11, 2026, None),
    (1, "weekly", 0, "15:00", 0, "2026-10-05", "2026-12-14", None, None, None, 10),
    (2, "weekly", 1, "09:00", 0, None, None, None, None, None, 6), (2, "weekly", 3, "09:00", 0, None, None, None, None, None, 6),
    (3, "fortnightly", 5, "10:30", 0, "2026-10-17", "2026-12-05", None, None, None, None),
    (4, "fortnightly", 4, None, 0, None, None, None, None, None, None),
    (5, "once", 0, "17:30", 0, "2026-10-12", "2026-10-12", None, None, None, None),
    (6, "once", 1, "10:00", 0, "2026-10-06", "2026-10-06", None, None, None, None),
    (8, "weekly", 1, "19:00", 0, None, None, None, None, None, None),
    (9, "weekly", 1, "09:00", 0, None, None, None, None, None, None),
    (10, "weekly", 1, "19:00", 0, None, None, None, None, None, None),
    (11, "monthly", 1, "19:00", 1, None, None, None, None, None, None),
    (13, "weekly", 0, "09:00", 0, None, None, None, None, None, None), (13, "weekly", 2, "09:00", 0, None, None, None, None, None, None),
    (14, "fortnightly", 4, "10:30", 0, None, None, None, None, None, None),
)


@query("recur_parse__R01_R02_R03_R04_R05_R06_R07_R08_R09_R10_C10_W03_X13", f'WITH {expand_sql(TEXT_SPECS)} SELECT id, CAST(day AS VARCHAR) AS day, begin_t AS "begin_at" FROM o')
def parse(spark, sf):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "id int, text string")
    return RC.expand(RC.spec_of(rows, "text", DAY), ["id"], DAY).select("id", F.col("day").cast("string").alias("day"), F.col("begin").alias("begin_at"))


#: What the phrases of the listings say: 4 and 8 without, 14 with a text after them; 20 and 21 are date texts, 30 a title.
SAID = (
    (0, "weekly", 1, "19:00", 0, None, None, None, None, None, None),
    (1, "weekly", 1, "09:00", 0, None, None, None, None, None, 6), (1, "weekly", 3, "09:00", 0, None, None, None, None, None, 6),
    (2, "fortnightly", 4, "10:30", 0, None, None, None, None, None, None),
    (3, "monthly", 6, "14:30", 3, None, None, 2, 11, 2026, None),
    (4, "once", 0, "17:30", 0, "2026-10-12", "2026-10-12", None, None, None, None),
    (5, "once", 1, "10:00", 0, "2026-10-06", "2026-10-06", None, None, None, None),
    (8, "once", 2, None, 0, "2026-10-14", "2026-10-14", None, None, None, None),
    (14, "weekly", 0, "17:30", 0, None, None, None, None, None, None),
    (20, "once", 2, None, 0, "2026-09-30", "2026-09-30", None, None, None, None),
    (21, "once", 1, "10:00", 0, "2026-10-06", "2026-10-06", None, None, None, None),
    (30, "weekly", 0, None, 0, None, None, None, None, None, None),
)
_LABELS = {0: "Every Tuesday", 1: "Every Tuesday and Thursday (6 weeks)", 2: "Every second Friday", 3: "Third Sunday of every month", 4: "12 Oct 2026", 5: "06 Oct 2026", 8: "2026-10-14", 14: "Every Monday", 20: "2026-09-30", 21: "06 Oct 2026", 30: "Every Monday"}
_LABEL = "CASE id " + " ".join(f"WHEN {i} THEN '{t}'" for i, t in _LABELS.items()) + " END"
_BY_TEXT = "CASE description " + " ".join(f"WHEN '{p}' THEN {i}" for i, p in enumerate(PHRASES) if i in (0, 1, 2, 3, 4, 5, 8)) + " END"
_BY_ROW = f"""coalesce(CASE WHEN datetime_text <> '' AND ({_BY_TEXT}) = 4 THEN 14 WHEN datetime_text <> '' AND ({_BY_TEXT}) = 8 THEN NULL ELSE {_BY_TEXT} END,
  CASE datetime_text WHEN 'Sold out: Wednesday, 30 September 2026' THEN 20 WHEN 'Tuesday 6 October 2026, 10:00am' THEN 21 END)"""
_SAID_SQL = expand_sql(SAID)
_TS = "CAST(concat(CAST(day AS VARCHAR), ' ', coalesce(begin_t, '00:00'), ':00') AS TIMESTAMP)"


@query("recur_infer__R12_R14_T05", f", {_SAID_SQL}, w AS (SELECT row_ord, {_BY_ROW} AS id FROM listings) SELECT row_ord, {_TS} AS ts, {_LABEL} AS recurrence FROM w JOIN o USING (id)", listing=True)
def infer(spark, sf):
    return RC.infer(listings(spark, sf).select("row_ord", "name", "description", "datetime_text"), "row_ord", ["description", "datetime_text"], DAY, "name")


@query("recur_name_hint__R11", f", {_SAID_SQL}, w AS (SELECT row_ord, 30 AS id FROM listings WHERE row_ord % 2 = 0 AND contains(name, '(Mondays)')) SELECT row_ord, day, {_LABEL} AS recurrence FROM w JOIN o USING (id)", listing=True)
def hint(spark, sf):
    rows = listings(spark, sf).withColumn("description", F.when(F.col("row_ord") % 2 == 0, "Runs all term, ask at the desk").otherwise("Ask at the desk"))
    return RC.infer(rows, "row_ord", ["description"], DAY, "name").select("row_ord", F.to_date("ts").alias("day"), "recurrence")


@query("recur_materialise__R15", f", {_SAID_SQL}, w AS (SELECT row_ord, {_BY_TEXT} AS id FROM listings) SELECT row_ord, day, begin_t AS begin_at FROM w JOIN o USING (id) WHERE begin_t IS NOT NULL", listing=True)
def materialise(spark, sf):
    return RC.materialise(listings(spark, sf), "row_ord", "description", DAY).withColumnRenamed("begin", "begin_at")


@query("recur_resolve_dateless__R17", f""", {_SAID_SQL}, w AS (SELECT row_ord, {_BY_ROW} AS id, EXISTS (SELECT 1 FROM l d WHERE d.stamp <> '' AND d.name_norm = l.name_norm AND d.loc_norm = l.loc_norm) AS dated FROM l WHERE stamp = '')
 SELECT row_ord, strftime({_TS}, '%Y-%m-%d %H:%M') AS outcome FROM w JOIN o USING (id) WHERE NOT dated UNION ALL SELECT row_ord, CASE WHEN dated THEN 'dated elsewhere' ELSE 'no schedule' END FROM w WHERE dated OR id IS NULL""", listing=True)  # fmt: skip
def resolve(spark, sf):
    found, dropped = RC.resolve_dateless(normalized(spark, sf), DAY)
    return found.select("row_ord", F.date_format("ts", "yyyy-MM-dd HH:mm").alias("outcome")).unionByName(dropped.select("row_ord", F.col("reason").alias("outcome")))


@query("recur_refresh_inferred__R18_Q06_Q07", f""", {_SAID_SQL}, w AS (SELECT row_ord, {_BY_TEXT} AS id, CAST(DATE '2026-10-01' + (row_ord % 28)::INT AS DATE) AS day FROM listings), t AS (SELECT id, CASE WHEN count(DISTINCT begin_t) = 1 THEN min(begin_t) END AS one FROM s GROUP BY 1),
 x AS (SELECT row_ord, CASE WHEN NOT EXISTS (SELECT 1 FROM o WHERE o.id = w.id AND o.day = w.day) THEN 'withdraw' WHEN one <> '00:00' THEN 'replace' ELSE 'keep' END AS action, one FROM w LEFT JOIN t USING (id))
 SELECT row_ord, action, CASE WHEN action = 'replace' THEN one END AS "begin" FROM x""", listing=True)  # fmt: skip
def refresh(spark, sf):
    rows = listings(spark, sf).select("row_ord", "description", F.to_timestamp_ntz(F.concat(F.lit("2026-10-"), F.lpad((F.col("row_ord") % 28 + 1).cast("string"), 2, "0"), F.lit(" 00:00:00"))).alias("ts"))
    return RC.refresh_inferred(rows, DAY)


@query("filter_cadence_kept__P17", r""", m AS (SELECT row_ord, list_sort(list_distinct(regexp_extract_all(lower(description), '\b(1st|2nd|3rd|4th|5th|first|second|third|fourth|fifth|fortnight|every second|month)\b', 1))) AS a, list_sort(list_distinct(regexp_extract_all(lower(name), '\b(1st|2nd|3rd|4th|5th|first|second|third|fourth|fifth|fortnight|every second|month)\b', 1))) AS b FROM listings)
 SELECT row_ord, a = b AS kept FROM m""", listing=True)  # fmt: skip
def cadence(spark, sf):
    return listings(spark, sf).select("row_ord", RC.keeps_cadence(F.col("description"), F.col("name")).alias("kept"))


#: Configured schedules, what a page states, and whether the page's is taken.
CHOICES = (
    ("Tuesday 10.00am - 11.30am (1st & 3rd Tuesdays)", "Tuesday 10.00am - 11.30am", False), ("Tuesday 10am - 11am", "Tuesday 11am - 1pm", True), ("Monday 9am", "Mondays", False),
    ("", "Friday 1pm - 2pm", True), ("Friday (fortnightly) 10am", "see the notice board", False), ("Every second Friday 10am", "Every second Friday 11am", True), ("Sunday 2pm", None, False),
)


@query("recur_choose_schedule__S11_P18", "WITH c AS (SELECT * FROM (VALUES " + ", ".join(f"({i}, '{a}', {_lit(b)}, {t})" for i, (a, b, t) in enumerate(CHOICES)) + ") t(i, a, b, taken)) SELECT s_suppkey, CASE WHEN taken THEN b ELSE a END AS schedule, taken AS from_page FROM supplier JOIN c ON i = s_suppkey % 7")
def choose(spark, sf):
    k = (F.col("s_suppkey") % 7).cast("int")
    pick = lambda j: F.array(*[F.lit(c[j]).cast("string") for c in CHOICES])[k]
    s = spark.read.parquet(f"{sf}/supplier.parquet")
    return RC.choose_schedule(s.select("s_suppkey", pick(0).alias("schedule")), s.select("s_suppkey", pick(1).alias("live")).where("live is not null"), "s_suppkey", DAY)


@query("recur_publishable__S15_P18", f", {_SAID_SQL}, w AS (SELECT row_ord, address, {_BY_TEXT} AS id FROM listings), u AS (SELECT DISTINCT id FROM o WHERE begin_t IS NOT NULL) SELECT row_ord, id IS NULL OR id NOT IN (SELECT id FROM u) AS from_hours FROM w WHERE trim(address) <> '' AND (id IN (SELECT id FROM u) OR row_ord % 2 = 0)", listing=True)
def publishable(spark, sf):
    rows = listings(spark, sf).withColumn("hours", F.when(F.col("row_ord") % 2 == 0, "Mondays 09:00 - 12:00").otherwise("by appointment"))
    return RC.publishable(rows, "description", "hours", DAY).select("row_ord", "from_hours")


@query("extract_live_phrase__X23", """SELECT row_ord, CASE row_ord % 10 WHEN 0 THEN 'Tuesday 7pm - 8pm' WHEN 1 THEN 'Tuesdays and Thursdays 9am' WHEN 2 THEN 'Friday 10.30am - 11.30am' WHEN 4 THEN 'Monday 12 October, 5:30pm' WHEN 5 THEN 'Tuesday 6 October 2026, 10:00am' ELSE '' END || CASE WHEN row_ord % 10 = 0 THEN ' (weekly)' ELSE '' END AS live FROM listings""", listing=True)
def phrase(spark, sf):
    rows = listings(spark, sf).withColumn("t", F.concat("description", F.when(F.col("row_ord") % 10 == 0, " (weekly) at the hall").otherwise("")))
    return RC.live_phrase(rows, "t").select("row_ord", "live")
