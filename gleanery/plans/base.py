"""What queries share: the normalised listings in Spark and the same as DuckDB common table expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.functions import dates, text
from gleanery.sources.listings import listings, listings_sql

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

#: A small gazetteer for the derived listings; operators take theirs as a parameter.
SUBURBS = ("Chelsea", "Beaumaris", "Mordialloc", "Cheltenham", "Mentone", "Aspendale")
#: The queries' fixed day.
TODAY = "2024-01-15"


def query(name: str, sql: str | None = None, listing: bool = False) -> Callable[[Query], Query]:
    """Register a query; listing puts the common table expressions of the listings before its SQL."""

    def add(f: Query) -> Query:
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = f"WITH {LISTINGS_CTE} {sql}" if listing else sql
        return f

    return add


def normalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    """listings with name_norm, loc_norm, venue, stamp, day, price_sort, url and slot_hash."""
    rows = listings(spark, sf_dir)
    return rows.withColumns(
        {
            "name_norm": text.normalize_name(F.col("name")),
            "loc_norm": text.normalize_location(F.col("location")),
            "venue": text.venue_head(F.col("location")),
            "stamp": dates.slot_stamp(F.col("ts_local")),
            "day": F.coalesce(F.date_format("ts_local", "yyyy-MM-dd"), F.lit("")),
            "price_sort": text.price_sort(F.col("price_text")),
            "url": F.regexp_replace("source", "/+$", ""),
        }
    ).withColumn("slot_hash", text.slot_hash(F.col("name_norm"), F.col("stamp"), F.col("loc_norm")))


_DAYS = "(?:" + "|".join(text.WEEKDAYS) + ")"
_LIST = rf"{_DAYS}s?(?:\s*(?:,|&|and)\s*{_DAYS}s?)*"
LISTINGS_CTE = f"""listings AS ({listings_sql(False)}),
n0 AS (SELECT *, trim(regexp_replace(lower(name), '\\s+', ' ', 'g')) AS low FROM listings),
n AS (SELECT *,
  regexp_replace(trim(replace(strip_accents(regexp_replace(low, ' [-|:–—] .*$', '')), '®', '')), '\\s*\\({_LIST}\\)\\s*$', '') AS name_norm,
  trim(regexp_replace(lower(location), '\\s+', ' ', 'g')) AS loc_norm,
  trim(regexp_replace(lower(split_part(location, ',', 1)), '\\s+', ' ', 'g')) AS venue,
  coalesce(strftime(ts_local, '%Y-%m-%dT%H:%M'), '') AS stamp, coalesce(strftime(ts_local, '%Y-%m-%d'), '') AS day,
  CASE WHEN regexp_matches(lower(price_text), '\\bfree\\b') THEN 0.0 WHEN regexp_matches(lower(price_text), 'gold\\s+coin') THEN 1.0
    ELSE TRY_CAST(nullif(regexp_extract(price_text, '\\$\\s*(\\d+(?:\\.\\d+)?)', 1), '') AS DOUBLE) END::DOUBLE AS price_sort,
  rtrim(source, '/') AS url FROM n0),
l AS (SELECT *, md5(concat_ws('|', name_norm, stamp, loc_norm)) AS slot_hash FROM n)
"""
