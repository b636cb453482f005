"""What readers of a store take away: calendar and table exports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def calendar_text(c: Column) -> Column:
    """Text as a calendar's value: separators and line ends escaped."""
    out = F.replace(F.coalesce(c, F.lit("")), F.lit("\\"), F.lit("\\\\"))
    for sign in (";", ","):
        out = F.replace(out, F.lit(sign), F.lit("\\" + sign))
    return F.replace(out, F.lit("\n"), F.lit("\\n"))


def export_rows(rows: DataFrame, minutes: int = 60) -> DataFrame:
    """Dated rows as a table's columns (Date, Time, Name, Location, Address, Price, Source, DateInferred, Recurrence) and as a calendar entry of `minutes`; a row at midnight is
    all day, an inferred date is marked. rows: a store's, with stamp, date_inferred and recurrence."""
    form = "yyyyMMdd'T'HHmm00"
    inferred = F.coalesce("date_inferred", F.lit(False))
    lines = F.array_compact(
        F.array(
            F.lit("BEGIN:VEVENT"),
            F.concat(F.lit("DTSTART:"), F.date_format("ts_local", form)),
            F.concat(F.lit("DTEND:"), F.date_format(F.col("ts_local") + F.expr(f"interval {minutes} minutes"), form)),
            F.concat(F.lit("SUMMARY:"), calendar_text(F.col("name"))),
            F.when(inferred, F.lit("X-COMMENTS-DERIVED-DATE:TRUE")),
            F.lit("END:VEVENT"),
        )
    )
    blank = lambda c: F.coalesce(F.col(c), F.lit(""))
    return rows.where("stamp <> ''").select(
        "row_ord",
        F.when(F.endswith("stamp", F.lit("T00:00")), "all day").otherwise(F.substring("stamp", 12, 5)).alias("Time"),
        F.substring("stamp", 1, 10).alias("Date"),
        *[blank(c).alias(name) for c, name in (("name", "Name"), ("location", "Location"), ("address", "Address"), ("price_text", "Price"), ("source", "Source"))],
        F.when(inferred, "yes").otherwise("").alias("DateInferred"),
        F.when(inferred, blank("recurrence")).otherwise("").alias("Recurrence"),
        F.array_join(lines, "\n").alias("vevent"),
    )


def write_csv(rows: DataFrame, path: str) -> None:
    """The table columns as CSV with a header."""
    rows.select("Date", "Time", "Name", "Location", "Address", "Price", "Source", "DateInferred", "Recurrence").write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
