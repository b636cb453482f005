"""Recurrence: schedule texts to Specs in one vectorised UDF that parses each distinct text once, Specs to dates natively."""

from __future__ import annotations

import functools
from collections.abc import Iterator
from datetime import date

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DateType, IntegerType, StringType, StructField, StructType

from gleanery.functions import schedule

SPEC = StructType(
    [
        StructField("kind", StringType()),
        StructField("slots", ArrayType(StructType([StructField("dow", IntegerType()), StructField("begin", StringType()), StructField("finish", StringType())]))),
        StructField("nth", IntegerType()),
        StructField("start", DateType()),
        StructField("end", DateType()),
        StructField("m1", IntegerType()),
        StructField("m2", IntegerType()),
        StructField("year", IntegerType()),
        StructField("periods", IntegerType()),
        StructField("label", StringType()),
        StructField("reason", StringType()),
    ]
)


#: Distinct texts whose specs a worker remembers.
_REMEMBERED = 100_000


def _spec_row(spec: schedule.Spec | None, reason: str) -> tuple:
    if spec is None:
        return (None,) * 10 + (reason,)
    m1, m2 = spec.months or (None, None)
    return spec.kind, [{"dow": d, "begin": a, "finish": b} for d, a, b in spec.slots], spec.nth, spec.start, spec.end, m1, m2, spec.year, spec.periods, spec.label, ""


def _frame(rows: list[tuple]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=SPEC.fieldNames())
    for c in ("nth", "m1", "m2", "year", "periods"):
        out[c] = out[c].astype("Int32")
    return out


def spec_of(texts: DataFrame, text_col: str, today: str, loose: bool = True) -> DataFrame:
    """texts with a spec column. A worker parses each distinct text once, so nothing is shuffled and no text is hot."""
    day = date.fromisoformat(today)

    @F.pandas_udf(SPEC)
    def parse(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        one = functools.lru_cache(_REMEMBERED)(lambda t: _spec_row(*schedule.parse(t, day, loose)))
        for values in batches:
            yield _frame([one(v or "") for v in values])

    return texts.withColumn("spec", parse(text_col))


def spec_of_row(rows: DataFrame, texts: list[str], name: str | None, today: str) -> DataFrame:
    """rows with a spec column: that of the first of the texts that yields one, the last read loosely, else the hint of the name."""
    day = date.fromisoformat(today)

    @F.pandas_udf(SPEC)
    def build(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        one = functools.lru_cache(_REMEMBERED)(lambda title, *said: _spec_row(*schedule.build(list(said), title, day)))
        for columns in batches:
            yield _frame([one(*values) for values in zip(*columns, strict=True)])

    title = F.coalesce(F.col(name), F.lit("")) if name else F.lit("")
    return rows.withColumn("spec", build(title, *[F.coalesce(F.col(t), F.lit("")) for t in texts]))


def _days(today: Column, s: Column, dow: Column) -> Column:
    """Days on which a slot of the spec may fall, before its bounds are applied."""
    next_day = lambda d: F.date_add(d, F.pmod(dow - F.weekday(d), F.lit(7)).cast("int"))
    weekly = F.sequence(next_day(today), F.date_add(today, schedule.WEEKLY_DAYS), F.expr("interval 7 days"))
    anchored = F.transform(F.sequence(F.lit(0), F.lit(12)), lambda k: F.date_add(next_day(s["start"]), k * 14))
    odd = F.pmod(F.floor(F.datediff(next_day(today), F.lit(schedule.EPOCH)) / 7), F.lit(2))
    parity = F.sequence(F.date_add(next_day(today), (odd * 7).cast("int")), F.date_add(today, schedule.FORTNIGHT_DAYS + 7), F.expr("interval 14 days"))
    horizon = F.date_add(today, schedule.FORTNIGHT_DAYS)
    months = F.transform(F.sequence(F.lit(0), F.lit(schedule.MONTHLY_MONTHS - 1)), lambda k: F.add_months(F.trunc(today, "month"), k))
    nth = F.filter(
        F.transform(months, lambda m: F.date_add(F.date_add(m, F.pmod(dow - F.weekday(m), F.lit(7)).cast("int")), ((s["nth"] - 1) * 7).cast("int"))),
        lambda d: (s["nth"] < 5) | (F.day(d) > 28),
    )
    return (
        F.when(s["kind"] == "once", F.array(s["start"]))
        .when(s["kind"] == "weekly", weekly)
        .when((s["kind"] == "fortnightly") & s["start"].isNotNull(), anchored)
        .when(s["kind"] == "fortnightly", F.filter(parity, lambda d: d <= horizon))
        .when(s["kind"] == "monthly", nth)
        .otherwise(F.array().cast("array<date>"))
    )


def occurrences(s: Column, today: str) -> Column:
    """Array of (day, begin) of a spec: its dates from today on, within its bounds, in order, MOST at most; begin is empty where no time is stated."""
    now = F.lit(today).cast("date")

    def fits(day: Column) -> Column:
        yes = lambda c: F.coalesce(c, F.lit(True))
        return (day >= now) & yes(day >= s["start"]) & yes(day <= s["end"]) & yes(F.month(day).between(s["m1"], s["m2"])) & yes(F.year(day) == s["year"])

    def of_slot(slot: Column) -> Column:
        begin = F.coalesce(slot["begin"], F.lit(""))
        return F.transform(F.filter(_days(now, s, slot["dow"]), fits), lambda d: F.struct(d.alias("day"), begin.alias("begin")))

    every = F.array_sort(F.array_distinct(F.flatten(F.transform(s["slots"], of_slot))))
    limit = F.when(s["periods"].isNotNull() & s["end"].isNull(), F.least(F.lit(schedule.MOST), s["periods"] * F.greatest(F.size(s["slots"]), F.lit(1)))).otherwise(F.lit(schedule.MOST))
    return F.slice(every, F.lit(1), limit)


def usable(s: Column, today: str) -> Column:
    """Whether a spec yields an occurrence from today on that has a time."""
    return F.coalesce(F.exists(occurrences(s, today), lambda o: o["begin"] != ""), F.lit(False))


# Words of a schedule that state another cadence than weekly.
CADENCE = ("1st", "2nd", "3rd", "4th", "5th", "first", "second", "third", "fourth", "fifth", "fortnight", "every second", "month")


def keeps_cadence(a: Column, b: Column) -> Column:
    """Whether two schedules use the same words of cadence."""
    words = lambda c: F.array_distinct(F.regexp_extract_all(F.lower(F.coalesce(c, F.lit(""))), F.lit(r"\b(" + "|".join(CADENCE) + r")\b"), 1))
    x, y = words(a), words(b)
    return (F.size(F.array_except(x, y)) == 0) & (F.size(F.array_except(y, x)) == 0)


def choose_schedule(venues: DataFrame, live: DataFrame, key: str, today: str) -> DataFrame:
    """venues (key, schedule) with schedule and from_page: a page's schedule takes the configured one's place where it can be read and keeps its cadence, or where none is configured.

    live: (key, live), a row for each venue whose page states a schedule.
    """
    joined = spec_of(venues.join(live.select(key, "live"), key, "left"), "live", today)
    blank = F.trim(F.coalesce("schedule", F.lit(""))) == ""
    take = F.col("spec.kind").isNotNull() & (F.size("spec.slots") > 0) & (blank | keeps_cadence(F.col("live"), F.col("schedule")))
    return joined.select(*[c for c in venues.columns if c != "schedule"], F.when(take, F.col("live")).otherwise(F.col("schedule")).alias("schedule"), F.coalesce(take, F.lit(False)).alias("from_page"))


def publishable(rows: DataFrame, prose: str, hours: str, today: str) -> DataFrame:
    """Rows that state a place and a usable schedule, with schedule and from_hours: the prose's if it yields a timed occurrence, else the opening hours'."""
    placed = rows.where(F.trim(F.coalesce("address", F.lit(""))) != "")
    said = spec_of(placed, prose, today).withColumn("__prose", usable(F.col("spec"), today)).drop("spec")
    both = spec_of(said, hours, today).withColumn("__hours", usable(F.col("spec"), today)).drop("spec")
    return both.where("__prose OR __hours").withColumn("schedule", F.when(F.col("__prose"), F.col(prose)).otherwise(F.col(hours))).withColumn("from_hours", ~F.col("__prose")).drop("__prose", "__hours")


def live_phrase(rows: DataFrame, text_col: str) -> DataFrame:
    """rows with live, the phrase of the text that states a weekday with its times, and a cadence in brackets after it; empty without one, or where the weekday is one of the month's."""

    @F.pandas_udf("string")
    def run(values: pd.Series) -> pd.Series:
        return values.map(lambda v: schedule.live_phrase(v or ""))

    return rows.withColumn("live", run(text_col))


def expand(rows: DataFrame, keys: list[str], today: str, spec: str = "spec") -> DataFrame:
    """(keys, day, begin): the dates of each row's spec from today on, within its bounds, MOST at most. Rows without a spec give none. All of it
    happens in arrays of the row, without a shuffle."""
    s = F.col(spec)
    some = rows.where(s["kind"].isNotNull()).select(*keys, F.explode(occurrences(s, today)).alias("o"))
    return some.select(*keys, F.col("o.day").alias("day"), F.nullif(F.col("o.begin"), F.lit("")).alias("begin"))


def infer(rows: DataFrame, key: str, texts: list[str], today: str, name: str | None = None) -> DataFrame:
    """(key, ts, recurrence): occurrences of each row by the first of its texts that yields a spec, else by its name; the label says the end or the number of weeks."""
    chosen = spec_of_row(rows.select(key, *texts, *([name] if name else [])), texts, name, today)
    s = F.col("spec")
    label = F.when(s["end"].isNotNull() & (s["kind"] != "once"), F.concat(s["label"], F.lit(" (to "), F.date_format(s["end"], "dd MMM yyyy"), F.lit(")"))).when(
        s["periods"].isNotNull(), F.concat(s["label"], F.lit(" ("), s["periods"].cast("string"), F.lit(" weeks)"))
    ).otherwise(s["label"])
    days = expand(chosen.select(key, "spec", label.alias("recurrence")), [key, "recurrence"], today)
    return days.select(key, F.to_timestamp_ntz(F.concat_ws(" ", F.col("day").cast("string"), F.coalesce("begin", F.lit("00:00")))).alias("ts"), "recurrence")


def resolve_dateless(rows: DataFrame, today: str) -> tuple[DataFrame, DataFrame]:
    """Occurrences of dateless rows that no dated row of the same name and place stands for, and the rest with the reason it was dropped."""
    dateless, dated = rows.where("stamp = ''"), rows.where("stamp <> ''").select("name_norm", "loc_norm").distinct()
    alone = dateless.join(dated, ["name_norm", "loc_norm"], "left_anti")
    found = infer(alone, "row_ord", ["description", "datetime_text"], today, "name" if "name" in rows.columns else None)
    done = found.select("row_ord").distinct()
    covered = dateless.join(alone.select("row_ord"), "row_ord", "left_anti").select("row_ord", F.lit("dated elsewhere").alias("reason"))
    silent = alone.join(done, "row_ord", "left_anti").select("row_ord", F.lit("no schedule").alias("reason"))
    return found, covered.unionByName(silent)


def materialise(rows: DataFrame, key: str, schedule_col: str, today: str) -> DataFrame:
    """(key, day, begin) of a stated schedule; occurrences without a time are refused."""
    spec = spec_of(rows.select(key, schedule_col), schedule_col, today)
    return expand(spec, [key], today).where("begin is not null")


def refresh_inferred(rows: DataFrame, today: str) -> DataFrame:
    """(row_ord, action, begin) for inferred rows (row_ord, ts, description): withdraw a future row that its text no longer yields, replace the time
    where exactly one is stated and differs, else keep."""
    spec = spec_of(rows.select("row_ord", "ts", "description"), "description", today)
    times = F.array_distinct(F.filter(F.transform("spec.slots", lambda s: s["begin"]), lambda b: b.isNotNull()))
    days = expand(spec, ["row_ord"], today).select("row_ord", "day").distinct().withColumn("made", F.lit(True))
    joined = spec.withColumn("day", F.to_date("ts")).join(days, ["row_ord", "day"], "left")
    past = F.col("day") < F.lit(today).cast("date")
    one = F.when(F.size(times) == 1, times[0])
    action = F.when(past, "keep").when(F.col("made").isNull(), "withdraw").when(one.isNotNull() & (one != F.date_format("ts", "HH:mm")), "replace").otherwise("keep")
    return joined.select("row_ord", action.alias("action"), F.when(action == "replace", one).alias("begin"))
