"""The derived `listings` view: one deterministic SQL text for both engines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: Schedule phrases that descriptions take in turn.
PHRASES = (
    "Every Tuesday 7pm - 8pm",
    "Tuesdays and Thursdays 9am for 6 weeks",
    "Every second Friday 10.30am - 11.30am",
    "third Sunday of the month, 2.30pm to 4pm, from February to November",
    "Drop-In Casual Basketball Monday 12 October, 5:30pm",
    "Storytime on Tuesday 6 October 2026, 10:00am",
    "A free trivia lunch for seniors at the community hall",
    "Sold out: cooking class with dinner special",
    "Next date: 14 October. Takeaway meals available",
    "",
)

_SQL = """
SELECT e.event_id AS row_ord,
 CASE e.event_id % 7 WHEN 0 THEN p.p_name WHEN 1 THEN upper(p.p_name) WHEN 2 THEN concat(p.p_name,' - Open Day')
   WHEN 3 THEN concat(p.p_name,' (Mondays)') WHEN 4 THEN replace(p.p_name,'e','é') WHEN 5 THEN concat(p.p_name,'® ')
   ELSE concat('  ',replace(p.p_name,' ','  ')) END AS name,
 CASE WHEN e.event_id % 13 = 0 THEN '' WHEN e.event_id % 17 = 0 THEN 'Online via Zoom'
   WHEN e.event_id % 3 = 0 THEN concat(s.s_name,', 12 Station Street, Chelsea VIC 3196') ELSE s.s_name END AS location,
 CASE e.event_id % 9 WHEN 0 THEN '' WHEN 1 THEN '84 Reserve Road, Beaumaris, Victoria 3193' WHEN 2 THEN '1 Main Street,, Mordialloc VIC 3195'
   WHEN 3 THEN 'Hall, Hall, 5 High Street, Cheltenham 3192' WHEN 4 THEN ', 7 Beach Road, Mentone VIC 3194' WHEN 5 THEN '1 Example St, Sydney NSW 2000'
   WHEN 6 THEN concat('12 Station Street, Chelsea', chr(10), 'VIC 3196') WHEN 7 THEN 'The Parkview Tavern, 9 Bay Street' ELSE '3 Park Lane, Aspendale' END AS address,
 CASE WHEN e.event_id % 5 = 0 THEN CAST(NULL AS {ntz}) WHEN e.event_id % 11 = 0 THEN CAST(date_trunc('day', e.ts) AS {ntz})
   ELSE CAST(date_trunc('hour', e.ts) AS {ntz}) END AS ts_local,
 e.event_type AS source_id,
 concat('https://x.invalid/', CAST(p.p_partkey AS {string}), CASE WHEN e.event_id % 2 = 0 THEN '/' ELSE '' END) AS source,
 CASE WHEN e.value < 2 THEN 'Free' WHEN e.value < 4 THEN 'Gold coin donation'
   WHEN e.value < 60 THEN concat('$', CAST(CAST(floor(e.value) AS INT) AS {string}), ' per session') ELSE '' END AS price_text,
 CASE WHEN e.event_id % 10 = 9 AND e.event_id % 4 = 1 THEN p.p_name ELSE CASE e.event_id % 10 {phrases} END END AS description,
 CASE e.event_id % 6 WHEN 0 THEN 'Sold out: Wednesday, 30 September 2026' WHEN 1 THEN 'Cancelled - Monday' WHEN 2 THEN 'Fully booked'
   WHEN 3 THEN '9.30am to 11am' WHEN 4 THEN 'Tuesday 6 October 2026, 10:00am' ELSE '' END AS datetime_text
FROM events e JOIN part p ON p.p_partkey = e.user_id % 40 JOIN supplier s ON s.s_suppkey = e.event_id % 5
"""


def listings_sql(spark_engine: bool) -> str:
    phrases = " ".join(f"WHEN {i} THEN '{p}'" for i, p in enumerate(PHRASES))
    return _SQL.format(ntz="TIMESTAMP_NTZ" if spark_engine else "TIMESTAMP", string="STRING" if spark_engine else "VARCHAR", phrases=phrases)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The view over the driver's tables; the two small dimensions join by size.

    A table that comes as fewer pieces than there are cores is dealt out first; a large one never is.
    """
    names = {n: table(spark, sf_dir, n) for n in ("events", "part", "supplier")}
    cores = spark.sparkContext.defaultParallelism
    if names["events"].rdd.getNumPartitions() * 2 <= cores:
        names["events"] = names["events"].repartition(cores)
    text = listings_sql(True)
    for n in names:
        text = text.replace(f" {n} ", " {" + n + "} ")
    return spark.sql(text, **names)
