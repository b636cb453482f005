"""Checks of a store before it is published: each gives findings (rule, severity, subject, n); errors fail a report, warnings don't."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.functions import text
from gleanery.operators import filters, relations

ERROR, WARNING, NOTE = "error", "warning", "note"


def findings(rows: DataFrame, rule: str, severity: str | Column, subject: Column, n: Column) -> DataFrame:
    """Rows as findings."""
    level = F.lit(severity) if isinstance(severity, str) else severity
    return rows.select(F.lit(rule).alias("rule"), level.alias("severity"), subject.cast("string").alias("subject"), n.cast("long").alias("n"))


def counted(rows: DataFrame, rule: str, severity: str, fault: Column, subject: str = "") -> DataFrame:
    """One finding with the number of rows that have the fault; none without any."""
    return findings(rows.agg(F.count_if(fault).alias("n")).where("n > 0"), rule, severity, F.lit(subject), F.col("n"))


def source_floors(rows: DataFrame, floors: DataFrame, total: int) -> DataFrame:
    """Sources below their floor (a warning where the source may be empty for a season), sources that aren't declared, a total below its floor, and archived rows by source as a note.

    rows: (source_id, archived), floors: (source_id, least, seasonal).
    """
    counts = rows.groupBy("source_id").agg(F.count("*").alias("n"), F.count_if(F.col("archived")).alias("hidden"))
    known = floors.join(counts, "source_id", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    short = findings(known.where("n < least"), "floor", F.when(F.col("seasonal"), WARNING).otherwise(ERROR), F.col("source_id"), F.col("n"))
    strange = findings(counts.join(floors, "source_id", "left_anti"), "undeclared source", ERROR, F.col("source_id"), F.col("n"))
    hidden = findings(counts.where("hidden > 0"), "archived rows", NOTE, F.col("source_id"), F.col("hidden"))
    every = findings(counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).where(F.col("n") < total), "total floor", ERROR, F.lit("all"), F.col("n"))
    return short.unionByName(strange).unionByName(hidden).unionByName(every)


def archive_flags(rows: DataFrame, archived_sources: tuple[str, ...]) -> DataFrame:
    """Rows of an archived source on the page without a live confirmation; confirmed rows that are withheld; withheld rows without a date; a warning where no series is confirmed.

    rows: (source_id, archived, live_confirmed, stamp). Only archived = false is on the page.
    """
    listed = F.col("archived").eqNullSafe(F.lit(False))
    confirmed = F.coalesce("live_confirmed", F.lit(False))
    of_archive = F.col("source_id").isin(*archived_sources)
    one = rows.agg(
        F.count_if(of_archive & listed & ~confirmed).alias("listed without confirmation"),
        F.count_if(confirmed & ~listed).alias("confirmed but withheld"),
        F.count_if(~listed & (F.col("stamp") == "")).alias("withheld without a date"),
        F.when(F.count_if(confirmed | (of_archive & listed)) == 0, 1).otherwise(0).cast("long").alias("nothing confirmed"),
    )
    long = one.unpivot([], one.columns, "rule", "n").where("n > 0")
    return long.select("rule", F.when(F.col("rule") == "nothing confirmed", WARNING).otherwise(ERROR).alias("severity"), F.lit("").alias("subject"), "n")


def catchment(rows: DataFrame, generic: tuple[str, ...], allowed: tuple[str, ...], gazetteer: tuple[str, ...]) -> DataFrame:
    """A source whose venues are generic or blank in more than half of its rows, and its places outside the catchment (online rows have none)."""
    place = F.lower(F.trim(F.coalesce("location", F.lit(""))))
    share = rows.groupBy("source_id").agg(F.count_if(place.isin(*generic, "")).alias("generic"), F.count("*").alias("n")).where(F.col("generic") > F.floor(F.col("n") / 2))
    outside = rows.where(~text.is_online(F.col("location")) & ~filters.in_catchment(allowed, gazetteer)).groupBy("source_id").agg(F.countDistinct(F.trim("location")).alias("n"))
    return findings(share, "generic venues", ERROR, F.col("source_id"), F.col("generic")).unionByName(findings(outside, "outside the catchment", ERROR, F.col("source_id"), F.col("n")))


def justified(store: DataFrame, live: DataFrame, mid_crawl: tuple[str, ...] = ()) -> DataFrame:
    """Store rows that a reconciliation run again would drop, by source."""
    dropped = relations.reconcile(store, live, mid_crawl).where("verdict = 'drop'").join(store.select("row_ord", "source_id"), "row_ord")
    return findings(dropped.groupBy("source_id").agg(F.count("*").alias("n")), "not justified", ERROR, F.col("source_id"), F.col("n"))


def guide_years(guides: DataFrame, today: str, season: tuple[int, ...]) -> DataFrame:
    """Faults of a yearly guide's configured year against its overrides' year and today: (id, fault). guides: (id, year, override_year), both as written.

    A guide without a year has that one fault, a year that is no number likewise; one that isn't this year's is a fault in season only.
    """
    now = F.lit(today).cast("date")
    year, other = F.col("year").try_cast("int"), F.col("override_year").try_cast("int")
    faults = F.when(F.col("year").isNull(), F.array(F.lit("no year"))).when(year.isNull(), F.array(F.lit("year is no number"))).otherwise(
        F.array_compact(
            F.array(
                F.when(F.col("override_year").isNull(), "overrides without a year").when(other.isNull(), "overrides' year is no number").when(other != year, "overrides of another year"),
                F.when((year != F.year(now)) & F.month(now).isin(*season), "not this year's in season"),
            )
        )
    )
    return guides.select("id", F.explode(faults).alias("fault"))


def page_counts(pages: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """Pages whose header states another number of rows than are listed. pages: (key, header), rows: (key, archived)."""
    listed = rows.where(~F.col("archived").eqNullSafe(F.lit(True))).groupBy(key).agg(F.count("*").alias("listed"))
    stated = F.nullif(F.regexp_extract(F.replace(F.col("header"), F.lit(",")), r"(\d+)", 1), F.lit("")).try_cast("long")
    both = pages.select(key, stated.alias("stated")).join(listed, key, "left").withColumn("listed", F.coalesce("listed", F.lit(0)))
    return both.where(~F.col("stated").eqNullSafe(F.col("listed")))


def disagreement(rows: DataFrame, external: DataFrame) -> DataFrame:
    """(row_ord, fault): the first thing in which an address and what a geocoder says of it contradict: postcode, state, suburb, street; empty where none does, null without an answer.

    rows: (row_ord, address, suburb), external: (row_ord, postcode, state, suburb, street).
    """
    e = external.select("row_ord", *[F.col(c).alias(f"e_{c}") for c in ("postcode", "state", "suburb", "street")], F.lit(True).alias("answered"))
    j = rows.select("row_ord", "address", "suburb").join(e, "row_ord", "left")
    own_code, own_state = F.regexp_extract("address", r"\b(\d{4})\b\s*$", 1), F.upper(F.regexp_extract("address", r"(?i)\b(VIC|NSW|QLD|SA|WA|TAS|NT|ACT)\b", 1))
    said = lambda c: F.coalesce(F.col(c), F.lit(""))
    unlike = lambda a, b: (a != "") & (b != "") & (F.lower(a) != F.lower(b))
    fault = (
        F.when(unlike(own_code, said("e_postcode")), "postcode").when(unlike(own_state, said("e_state")), "state").when(unlike(said("suburb"), said("e_suburb")), "suburb")
        .when((said("e_street") != "") & ~F.contains(F.lower("address"), F.lower(said("e_street"))), "street").otherwise("")
    )
    return j.select("row_ord", F.when(F.col("answered"), fault).alias("fault"))


def suspicious(rows: DataFrame, limit: int | None = None) -> DataFrame:
    """Rows worth asking a geocoder about: a malformed address, or a description that restates the name; the first `limit` by row_ord if one is given."""
    found = rows.where(text.malformed_address(F.col("address")) | text.restates_name(F.col("description"), F.col("name")))
    return found if limit is None else found.orderBy("row_ord").limit(limit)


def passed(report: DataFrame) -> DataFrame:
    """One row: errors, warnings, and whether the report passes."""
    n = lambda s: F.coalesce(F.sum(F.when(F.col("severity") == s, F.col("n"))), F.lit(0)).cast("long")
    return report.agg(n(ERROR).alias("errors"), n(WARNING).alias("warnings"), (F.count_if(F.col("severity") == ERROR) == 0).alias("passed"))
