"""Times and dates as Column functions; today is always a parameter."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Month names.
MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december")


def local_time(iso: Column, zone: str = "Australia/Melbourne") -> Column:
    """A zone-less local timestamp: with an offset or Z the instant in `zone`, else as written; null where unreadable."""
    aware = iso.rlike(r"(?:Z|[+-]\d{2}:?\d{2})$") & F.contains(iso, F.lit("T"))
    instant = F.try_to_timestamp(F.when(aware, F.regexp_replace(iso, "Z$", "+00:00")))
    shifted = F.convert_timezone(F.lit("UTC"), F.lit(zone), F.to_timestamp_ntz(F.date_format(instant, "yyyy-MM-dd HH:mm:ss")))
    return F.when(aware, shifted).otherwise(F.when(~aware, iso).try_cast("timestamp_ntz"))


def slot_stamp(ts: Column) -> Column:
    return F.coalesce(F.date_format(ts, "yyyy-MM-dd'T'HH:mm"), F.lit(""))


def slot_stamp_raw(iso: Column) -> Column:
    """Minute stamp of an ISO string; empty without a T; the first 16 characters where it can't be read."""
    text = F.coalesce(iso, F.lit(""))
    return F.when(~F.contains(text, F.lit("T")), F.lit("")).otherwise(
        F.coalesce(F.date_format(local_time(text), "yyyy-MM-dd'T'HH:mm"), F.substring(F.replace(text, F.lit("Z"), F.lit("")), 1, 16))
    )


def month_number(c: Column) -> Column:
    """1 to 12 from a full, four-letter or three-letter month name; null otherwise."""
    names = {m: i + 1 for i, m in enumerate(MONTHS)}
    names |= {m[:n]: i for m, i in list(names.items()) for n in (3, 4)}
    table = F.create_map(*[F.lit(x) for k, v in sorted(names.items()) for x in (k, v)])
    return table[F.regexp_replace(F.lower(F.trim(c)), r"\.$", "")]


_MONTH_ALT = "|".join(dict.fromkeys(x for m in MONTHS for x in (m, m[:4], m[:3])))


def day_month_year(c: Column) -> Column:
    """The first `d Month yyyy` as a date; null where there is none or it doesn't exist."""
    pattern = rf"(?i)\b(\d{{1,2}})(?:st|nd|rd|th)?\s+({_MONTH_ALT})\.?,?\s+(\d{{4}})\b"
    part = [F.regexp_extract(F.coalesce(c, F.lit("")), pattern, i) for i in (1, 2, 3)]
    iso = F.concat_ws("-", part[2], F.lpad(month_number(part[1]).cast("string"), 2, "0"), F.lpad(part[0], 2, "0"))
    return F.when(part[0] != "", iso).try_cast("date")


def _clock(hour: Column, minute: Column, ap: Column) -> Column:
    h, m = hour.cast("int"), F.coalesce(F.nullif(minute, F.lit("")), F.lit("0")).cast("int")
    h24 = F.when((ap == "p") & (h < 12), h + 12).when((ap == "a") & (h == 12), F.lit(0)).otherwise(h)
    return F.when((h24 <= 23) & (m <= 59), F.format_string("%02d:%02d", h24, m))


def parse_time(c: Column) -> Column:
    """HH:mm of a stated time: of a range its start, which takes the end's am or pm; a range that runs backwards is null."""
    text = F.lower(F.coalesce(c, F.lit("")))
    rng = r"\b(\d{1,2})(?:[:.](\d{2}))?\s*(?:([ap])\.?m\.?)?\s*(?:-|–|to)\s*(\d{1,2})(?:[:.](\d{2}))?\s*([ap])\.?m\b"
    g = [F.regexp_extract(text, rng, i) for i in range(7)]
    start = _clock(F.nullif(g[1], F.lit("")), g[2], F.when(g[3] != "", g[3]).otherwise(g[6]))
    end = _clock(F.nullif(g[4], F.lit("")), g[5], g[6])
    single = r"\b(\d{1,2})(?:[:.](\d{2}))?\s*([ap])\.?m\b"
    s = [F.regexp_extract(text, single, i) for i in range(4)]
    lone = _clock(F.nullif(s[1], F.lit("")), s[2], s[3])
    clock24 = r"\b(\d{1,2}):(\d{2})\b"
    k = [F.regexp_extract(text, clock24, i) for i in range(3)]
    plain = _clock(F.nullif(k[1], F.lit("")), k[2], F.lit(""))
    return F.when(g[0] != "", F.when(end >= start, start)).when(s[0] != "", lone).otherwise(plain)


def first_time(c: Column) -> Column:
    """HH:mm of the first time that a text states, noon and midday included ("12noon", "at midday"); empty without one."""
    said = F.lower(F.coalesce(c, F.lit("")))
    stated = r"(\d{1,2})[:.](\d{2})\s*([ap])\.?m?\b|\b(\d{1,2})\s*([ap])\.?m\b|\b(?:\d{1,2}\s*)?(noon|midday)\b"
    g = [F.regexp_extract(said, stated, i) for i in range(7)]
    clock = F.when(g[1] != "", _clock(F.nullif(g[1], F.lit("")), g[2], g[3])).when(g[4] != "", _clock(F.nullif(g[4], F.lit("")), F.lit(""), g[5])).when(g[6] != "", F.lit("12:00"))
    return F.coalesce(clock, F.lit(""))


def range_starts(lines: Column) -> Column:
    """(line, at) of every time range of an array of lines, from 0: its start, which takes the end's am or pm where it has none."""
    span = r"\d{1,2}(?:[.:]\d{2})?\s*(?:am|pm)?\s*(?:-|–|to)\s*\d{1,2}(?:[.:]\d{2})?\s*(?:am|pm)"

    def start(m: Column) -> Column:
        one = r"^(\d{1,2})(?:[.:](\d{2}))?\s*([ap]?)"
        own = F.regexp_extract(m, one, 3)
        return _clock(F.regexp_extract(m, one, 1), F.regexp_extract(m, one, 2), F.when(own != "", own).otherwise(F.regexp_extract(m, r"([ap])m$", 1)))

    def of_line(line: Column, i: Column) -> Column:
        return F.transform(F.regexp_extract_all(F.lower(F.coalesce(line, F.lit(""))), F.lit(f"({span})"), 1), lambda m: F.struct(i.alias("line"), start(m).alias("at")))

    return F.filter(F.flatten(F.transform(lines, of_line)), lambda x: x["at"].isNotNull())


def nth_weekday(month_start: Column, nth: Column, weekday: Column) -> Column:
    """The nth weekday (0 is Monday) of a month; null where there is no fifth."""
    first = F.date_add(month_start, F.pmod(weekday - F.weekday(month_start), F.lit(7)).cast("int"))
    day = F.date_add(first, ((nth - 1) * 7).cast("int"))
    return F.when(F.month(day) == F.month(month_start), day)


def weekly_term(start: Column, end: Column, cap: int = 12) -> Column:
    """Start alone for a term of less than a week, else each week from start to end, `cap` at most."""
    return F.when(F.datediff(end, start) < 7, F.array(start)).otherwise(F.slice(F.sequence(start, F.greatest(start, end), F.expr("interval 7 days")), 1, cap))
