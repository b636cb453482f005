"""Joins, de-duplication and aggregation over normalised listings."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleanery.functions import text

MIDNIGHT = "T00:00"


def first_per_key(rows: DataFrame, keys: list[str], order: str = "row_ord") -> DataFrame:
    """The first row of each key. One aggregate, which combines before its shuffle, instead of a window over a whole key."""
    rest = [c for c in rows.columns if c not in keys]
    packed = F.struct(F.col(order), *[F.col(c) for c in rest if c != order])
    best = rows.groupBy(*keys).agg(F.min(F.struct(F.col(order), packed.alias("r"))).alias("b"))
    return best.select(*keys, *[F.col(f"b.r.{c}").alias(c) for c in rest])


#: Fields whose blanks a merge fills.
FILLED = ("location", "address", "suburb", "description", "price_text")


def merge_groups(rows: DataFrame, keys: list[str], order: str = "row_ord", date: tuple[str, ...] = ("ts_local", "datetime_text")) -> DataFrame:
    """The merge aggregate: rows of a group folded into its first in order.

    The kept row is the first one. Its blanks of FILLED take the first value there is; a dateless one takes the `date` columns (the first says whether there is a date) of
    the first row that has one; source is the last that isn't blank, sources all of them in order of appearance, the first row's own first.
    A location gives way to a later one whose venue head goes on where its own ends. Columns that rows lack are left out.

    Rows that agree in key, source and location are added up before the shuffle and meet as one, so a hot group costs a row for each different pair, not for each row.
    """
    fields = [c for c in FILLED if c in rows.columns and c != "location"]
    when = [c for c in date if c in rows.columns]
    blank = lambda c: F.trim(F.coalesce(F.col(c), F.lit(""))) == ""
    first_with = lambda c: F.min(F.when(~blank(c), F.struct(order, F.col(c).alias("v")))).alias(c)
    dated = [F.min(F.when(F.col(when[0]).isNotNull(), F.struct(order, *when))).alias("__date"), F.min(F.struct(order, *[F.col(c).alias(f"own_{c}") for c in when])).alias("__own")] if when else []
    some = rows.groupBy(*keys, "source", "location").agg(F.min(order).alias("__from"), F.max(order).alias("__to"), F.count("*").alias("__n"), *[first_with(c) for c in fields], *dated)
    pair = lambda c: F.array_sort(F.collect_list(F.struct("__from", F.coalesce(F.col(c), F.lit("")).alias("v"))))
    merged = some.groupBy(*keys).agg(
        F.min("__from").alias(order),
        *[F.min(c).alias(c) for c in fields],
        *([F.min("__date").alias("__date"), F.min("__own").alias("__own")] if when else []),
        F.max_by("source", F.when(~blank("source"), F.col("__to"))).alias("source"),
        pair("source").alias("__sources"),
        pair("location").alias("__locations"),
        F.sum("__n").alias("n"),
    )
    names = F.transform("__sources", lambda x: x["v"])
    sources = F.array_distinct(F.concat(F.slice(names, 1, 1), F.filter(names, lambda x: x != "")))

    def better(now: Column, x: Column) -> Column:
        old, new = text.venue_head(now), text.venue_head(x["v"])
        return F.when(F.trim(now) == "", F.when(F.trim(x["v"]) == "", now).otherwise(x["v"])).when((old != "") & (new != old) & F.startswith(new, old), F.trim(x["v"])).otherwise(now)

    location = F.aggregate("__locations", F.lit(""), better)
    if when:
        own_dated = F.col(f"__own.own_{when[0]}").isNotNull()
        dates = [F.when(own_dated, F.col(f"__own.own_{c}")).otherwise(F.coalesce(F.nullif(F.col(f"__date.{c}").cast("string"), F.lit("")).cast(rows.schema[c].dataType), F.col(f"__own.own_{c}"))).alias(c) for c in when]
    else:
        dates = []
    return merged.select(*keys, order, location.alias("location"), *[F.coalesce(F.col(f"{c}.v"), F.lit("")).alias(c) for c in fields], *dates, F.coalesce("source", F.lit("")).alias("source"), sources.alias("sources"), "n")


def exact_dedupe(rows: DataFrame) -> DataFrame:
    """One row for each slot hash: the kept row's order and how many fell together."""
    return rows.groupBy("slot_hash").agg(F.min("row_ord").alias("kept"), F.count("*").alias("n"))


def same_time_of_day(a: Column, b: Column) -> Column:
    """Untimed stamps (none or midnight) match only each other."""
    ta, tb = F.coalesce(F.nullif(F.substring(a, 12, 5), F.lit("")), F.lit("00:00")), F.coalesce(F.nullif(F.substring(b, 12, 5), F.lit("")), F.lit("00:00"))
    return ta == tb


def name_location_pairs(left: DataFrame, right: DataFrame) -> DataFrame:
    """Dated rows of equal name, location, day and time of day: (l, r)."""
    a = left.where("day <> '' and loc_norm <> ''").select(F.col("row_ord").alias("l"), "name_norm", "loc_norm", "day", F.col("stamp").alias("sa"))
    b = right.where("day <> '' and loc_norm <> ''").select(F.col("row_ord").alias("r"), "name_norm", "loc_norm", "day", F.col("stamp").alias("sb"))
    return a.join(b, ["name_norm", "loc_norm", "day"]).where(same_time_of_day(F.col("sa"), F.col("sb"))).select("l", "r")


def fuzzy_pairs(left: DataFrame, right: DataFrame, threshold: float = 0.75, minutes: int = 30) -> DataFrame:
    """Pairs of different names in one block (day, location) within `minutes`, of similarity at least threshold: (l, r, similarity).

    Distinct (name, minute) values are compared, not rows, and lengths that can't reach the threshold go first.
    """
    a = left.where("day <> '' and loc_norm <> ''").select(F.col("row_ord").alias("l"), F.col("name_norm").alias("a"), "loc_norm", "day", F.unix_seconds(F.col("ts_local").cast("timestamp")).alias("ta"))
    b = right.where("day <> '' and loc_norm <> ''").select(F.col("row_ord").alias("r"), F.col("name_norm").alias("b"), "loc_norm", "day", F.unix_seconds(F.col("ts_local").cast("timestamp")).alias("tb"))
    names = a.select("a", "loc_norm", "day").distinct().join(b.select("b", "loc_norm", "day").distinct(), ["loc_norm", "day"])
    scored = names.select("a", "b").distinct().where((F.col("a") != F.col("b")) & text.length_bound(F.col("a"), F.col("b"), threshold))
    scored = scored.withColumn("similarity", F.round(text.indel_similarity(F.col("a"), F.col("b")), 6)).where(F.col("similarity") >= threshold)
    near = a.join(scored, "a").join(b, ["b", "loc_norm", "day"]).where(F.abs(F.col("ta") - F.col("tb")) <= 60 * minutes)
    return near.select("l", "r", "similarity")


def programme_pairs(rows: DataFrame) -> DataFrame:
    """For each row the earliest row it would merge into: (url, name, stamp) first, else (name, stamp), venues compatible."""
    base = rows.where("stamp <> '' and name_norm <> ''").select("row_ord", "url", "name_norm", "stamp", "loc_norm")
    other = base.select(F.col("row_ord").alias("into"), F.col("url").alias("into_url"), "name_norm", "stamp", F.col("loc_norm").alias("into_loc"))
    pairs = base.join(other, ["name_norm", "stamp"]).where((F.col("into") < F.col("row_ord")) & text.venue_compatible(F.col("loc_norm"), F.col("into_loc")))
    return pairs.groupBy("row_ord").agg(F.min(F.struct((F.col("url") != F.col("into_url")).alias("other"), "into")).alias("m")).select("row_ord", F.col("m.into").alias("into"), (~F.col("m.other")).alias("same_url"))


def fold_blocks(rows: DataFrame, start: Callable[[], Callable[[tuple], int]]) -> DataFrame:
    """(row_ord, into): an ordered fold of each block. rows: (block, row_ord, ...); start() begins a block and gives the step that takes its rows one by one, in
    order and without the block's name, and says what each goes into.

    Blocks stream through their task in sorted order, so a task holds what the fold has kept of one block, and no block is gathered.
    """
    dealt = rows.repartition("block").sortWithinPartitions("block", "row_ord")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, step = object(), None
        for batch in batches:
            into = []
            for block, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if block != now:
                    now, step = block, start()
                into.append(step(tuple(row)))
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(into, pa.int64())], ["row_ord", "into"])

    return dealt.mapInArrow(run, "row_ord long, into long")


def programme_fold(rows: DataFrame) -> DataFrame:
    """(row_ord, into): each row in order goes into the kept row of its (url, name, stamp) if venues are compatible, else into the first kept row of its (name, stamp) with a
    compatible venue; else it is kept, into = row_ord. Rows without a stamp or a name are kept.

    Only rows of one name and stamp can merge, so each such block is folded on its own; rows without a place are compatible with none and need no block.
    """
    usable = (F.col("stamp") != "") & (F.col("name_norm") != "") & (F.col("loc_norm") != "")
    used = rows.where(usable).select("stamp", "row_ord", "url", "name_norm", "loc_norm")
    homeless = rows.where((F.col("stamp") != "") & (F.col("name_norm") != "") & (F.col("loc_norm") == "")).groupBy("url", "name_norm", "stamp").agg(F.min("row_ord").alias("unplaced"))
    used = used.join(homeless, ["url", "name_norm", "stamp"], "left")

    def compatible(a: str, b: str) -> bool:
        short, long = sorted((a, b), key=len)
        return a.split(",")[0].strip() == b.split(",")[0].strip() or (long.startswith(short) and long[len(short) : len(short) + 1] in tuple(" ,-/("))

    def start() -> Callable[[tuple], int]:
        by_url: dict = {}
        kept: list[tuple[str, int]] = []

        def step(row: tuple) -> int:
            ord_, url, name, place, unplaced = row
            own = by_url.get((url, name))
            # a row without a place that came first holds the url's slot, and nothing goes into it
            blocked = unplaced is not None and (own is None or unplaced < own[1])
            found = own[1] if own and not blocked and compatible(own[0], place) else next((k for p, k in kept if compatible(p, place)), None)
            if found is None:
                by_url.setdefault((url, name), (place, ord_))
                kept.append((place, ord_))
                return ord_
            return found

        return step

    block = F.concat_ws("|", "stamp", "name_norm")
    folded = fold_blocks(used.select(block.alias("block"), "row_ord", "url", "name_norm", "loc_norm", "unplaced"), start)
    return folded.unionByName(rows.where(~usable).select("row_ord", F.col("row_ord").alias("into")))


def distinct_sessions(rows: DataFrame, more: DataFrame) -> DataFrame:
    """The two-stage distinct: the first row of each (name, stamp), then, with what `more` brings back after it, the first of each (name, stamp, place). Case doesn't
    count; a row of `more` comes after all of rows. (row_ord, name, stamp, location)."""
    low = lambda c: F.lower(F.coalesce(F.col(c), F.lit("")))
    pick = lambda d, late: d.select(F.struct(F.lit(late).alias("late"), "row_ord", "name", "location").alias("r"), low("name").alias("n"), F.coalesce("stamp", F.lit("")).alias("stamp"), low("location").alias("p"))
    once = pick(rows, False).groupBy("n", "stamp").agg(F.min("r").alias("r"))
    both = once.select("r", "n", "stamp", F.lower(F.coalesce("r.location", F.lit(""))).alias("p")).unionByName(pick(more, True))
    return both.groupBy("n", "stamp", "p").agg(F.min("r").alias("r")).select("r.row_ord", "r.name", "stamp", "r.location")


def drop_untimed_twins(rows: DataFrame) -> DataFrame:
    """Midnight rows go where a timed row has the same name and venue head, on any date."""
    untimed = F.endswith(F.col("stamp"), F.lit(MIDNIGHT))
    timed = rows.where((F.col("stamp") != "") & ~untimed).select("name_norm", "venue").distinct()
    return rows.where(~untimed).unionByName(rows.where(untimed).join(timed, ["name_norm", "venue"], "left_anti"))


def slot_is_stated(rows: DataFrame, live: DataFrame) -> DataFrame:
    """Rows whose (name, url, stamp) a live row states at a compatible or unstated venue."""
    live = live.select("name_norm", "url", "stamp", F.col("loc_norm").alias("live_loc")).distinct()
    joined = rows.join(live, ["name_norm", "url", "stamp"]).where((F.col("loc_norm") == "") | (F.col("loc_norm") == F.col("live_loc")) | text.venue_compatible(F.col("loc_norm"), F.col("live_loc")))
    return joined.select("row_ord").distinct()


def drop_superseded(rows: DataFrame, live: DataFrame, live_sources: DataFrame) -> DataFrame:
    """Rows that name only their next occurrence go when their (name, url) has several rows, their source is live and no live row states their slot."""
    cursor = rows.where(text.names_next_occurrence(F.col("description")))
    many = rows.groupBy("name_norm", "url").agg(F.count("*").alias("group_n")).where("group_n > 1")
    doubtful = cursor.join(many.select("name_norm", "url"), ["name_norm", "url"], "left_semi").join(live_sources, "source_id", "left_semi")
    gone = doubtful.join(slot_is_stated(doubtful, live), "row_ord", "left_anti").select("row_ord")
    return rows.join(gone, "row_ord", "left_anti")


def reconcile(store: DataFrame, live: DataFrame, mid_crawl: tuple[str, ...] = ()) -> DataFrame:
    """A verdict for each store row: (row_ord, verdict, why). Absent or unfinished sources withdraw nothing."""
    sources = live.select("source_id").distinct().withColumn("has_source", F.lit(True))
    series = live.select(text.series_id(F.col("source_id"), F.col("name_norm"), F.col("venue")).alias("series")).distinct().withColumn("has_series", F.lit(True))
    slots = live.where("stamp <> ''").select("name_norm", "url", "stamp").distinct().withColumn("has_slot", F.lit(True))
    rows = store.withColumn("series", text.series_id(F.col("source_id"), F.col("name_norm"), F.col("venue")))
    joined = rows.join(sources, "source_id", "left").join(series, "series", "left").join(slots, ["name_norm", "url", "stamp"], "left")
    busy = F.col("source_id").isin(*mid_crawl) if mid_crawl else F.lit(False)
    why = F.when(busy, "mid-crawl").when(F.col("has_source").isNull(), "unjudgeable").when(F.col("has_series"), "series").when(F.col("has_slot"), "slot").otherwise("withdrawn")
    return joined.select("row_ord", F.when(why == "withdrawn", "drop").otherwise("keep").alias("verdict"), why.alias("why"))


def archive_flags(rows: DataFrame, live: DataFrame) -> DataFrame:
    """(row_ord, archived, live_confirmed) of each row. A source is hidden that the archive names and nothing else publishes; of its rows those stay on the page whose series the archive says is live,
    looked up by the row's stamped series id or by the one derived from it.

    rows: (row_ord, source_id, series_id, name_norm, venue), live: (source_id, archived, status, name_norm, venue).
    """
    yes = F.coalesce("archived", F.lit(False))
    sources = live.where(F.coalesce("source_id", F.lit("")) != "").groupBy("source_id").agg(F.bool_and(yes).alias("hidden"))
    derived = text.series_id(F.col("source_id"), F.col("name_norm"), F.col("venue"))
    status = live.where(yes & (F.coalesce("status", F.lit("")) != "")).groupBy(derived.alias("series")).agg(F.max("status").alias("status"))
    by = lambda name: status.select(F.col("series").alias(name), F.col("status").alias(f"{name}_status"))
    joined = rows.withColumn("own", derived).withColumn("stamped", F.coalesce("series_id", F.lit(""))).join(sources, "source_id", "left").join(by("own"), "own", "left").join(by("stamped"), "stamped", "left")
    hidden, running = F.coalesce("hidden", F.lit(False)), F.coalesce("stamped_status", "own_status", F.lit("")) == "live"
    return joined.select("row_ord", (hidden & ~running).alias("archived"), (hidden & running).alias("live_confirmed"))


#: Columns that a store no longer has.
RETIRED = ("source_label", "has_real_date", "datetime_display", "date_text", "_hours_schedule")


def normalize_store(rows: DataFrame, retired: tuple[str, ...] = RETIRED) -> DataFrame:
    """A store's rows as its schema has them: an unknown source named so, a blank date null, a missing price order worked out from the price text, a missing series id of an inferred
    date derived, each source named once, and retired columns gone."""
    blank = lambda c: F.trim(F.coalesce(F.col(c), F.lit(""))) == ""
    out = rows.withColumns(
        {
            "source_id": F.when(blank("source_id"), "unknown").otherwise(F.col("source_id")),
            "datetime_iso": F.when(~blank("datetime_iso"), F.trim("datetime_iso")),
            "price_sort": F.coalesce("price_sort", text.price_sort(F.col("price_text"))),
            "sources": F.array_distinct(F.coalesce("sources", F.array(F.coalesce("source", F.lit(""))))),
        }
    )
    derived = text.series_id(F.col("source_id"), text.normalize_name(F.col("name")), text.venue_head(F.col("location")))
    return out.withColumn("series_id", F.when(F.coalesce("date_inferred", F.lit(False)) & blank("series_id"), derived).otherwise(F.col("series_id"))).drop(*retired)


def repair(kept: DataFrame, live: DataFrame) -> DataFrame:
    """Blank price and description, and a malformed address, take the first live candidate's by (name, url, stamp), else by (name, url)."""
    fields = F.struct("row_ord", "price_text", "description", "address")
    exact = live.groupBy("name_norm", "url", "stamp").agg(F.min(fields).alias("x"))
    loose = live.groupBy("name_norm", "url").agg(F.min(fields).alias("y"))
    joined = kept.join(exact, ["name_norm", "url", "stamp"], "left").join(loose, ["name_norm", "url"], "left").withColumn("c", F.coalesce("x", "y"))
    fill = lambda c: F.coalesce(F.nullif(F.col(c), F.lit("")), F.col(f"c.{c}"), F.lit("")).alias(c)
    good = text.malformed_address(F.col("address")) & F.col("c").isNotNull() & ~text.malformed_address(F.col("c.address"))
    return joined.select("row_ord", fill("price_text"), fill("description"), F.when(good, F.col("c.address")).otherwise(F.col("address")).alias("address"))


def nearest(left: DataFrame, right: DataFrame, key: str, bound: int) -> DataFrame:
    """For each left row (key, pos, id) the right row at the least distance within bound; ties go to the one not after: (id, match, distance).

    Positions are put into bands of `bound`, so the range join is an equi-join on neighbouring bands.
    """
    band = lambda c: F.floor(F.col(c) / bound).cast("long")
    a = left.select(key, F.col("id"), F.col("pos").alias("lp"), F.explode(F.array(band("pos") - 1, band("pos"), band("pos") + 1)).alias("band"))
    b = right.select(key, F.col("id").alias("match"), F.col("pos").alias("rp"), band("pos").alias("band"))
    near = a.join(b, [key, "band"]).where(F.abs(F.col("lp") - F.col("rp")) <= bound)
    best = near.groupBy("id").agg(F.min(F.struct(F.abs(F.col("lp") - F.col("rp")).alias("distance"), (F.col("rp") > F.col("lp")).alias("after"), "match")).alias("m"))
    return best.select("id", F.col("m.match").alias("match"), F.col("m.distance").alias("distance"))


def greedy_fold(rows: DataFrame, threshold: float = 0.75) -> DataFrame:
    """The ordered three-pass merge: each row in order goes into the first kept row of equal slot hash, else of equal name, place and time of
    day, else of similar name at the same place within half an hour; else it is kept. (row_ord, into), into = row_ord for kept rows.

    Only rows of one day and place can merge, so each such block is folded on its own; rows without a day or a place merge by hash alone
    and are split by it.
    """
    block = F.when((F.col("day") == "") | (F.col("loc_norm") == ""), F.concat(F.lit("#"), "slot_hash")).otherwise(F.concat_ws("|", "day", "loc_norm"))
    used = rows.select(block.alias("block"), "row_ord", "slot_hash", "name_norm", "loc_norm", "stamp", "day")

    def minutes(stamp: str) -> int:
        return int(stamp[11:13]) * 60 + int(stamp[14:16])

    def start() -> Callable[[tuple], int]:
        by_hash: dict = {}
        by_place: dict = {}
        at_place: dict = {}
        scores: dict = {}

        def similar(name: str, other: str) -> bool:
            pair, total = (name, other), len(name) + len(other)
            if pair not in scores:
                scores[pair] = 2 * min(map(len, pair)) >= threshold * total and 2 * text.common_length(*pair) >= threshold * total
            return scores[pair]

        def step(row: tuple) -> int:
            ord_, hash_, name, place, stamp, day = row
            found = by_hash.get(hash_)
            placed = bool(day and place)
            key = (name, place, stamp[11:16] or "00:00")
            if found is None and placed:
                found = by_place.get(key)
                if found is None:
                    found = next((o for n, s, o in at_place.get(place, ()) if abs(minutes(s) - minutes(stamp)) <= 30 and similar(n, name)), None)
            if found is None:
                found = ord_
                if placed:
                    by_place.setdefault(key, found)
                    at_place.setdefault(place, []).append((name, stamp, found))
                by_hash.setdefault(hash_, found)
            return found

        return step

    return fold_blocks(used, start)


def gaps_and_islands(rows: DataFrame, key: str, order: str, flag: Column) -> DataFrame:
    """Runs of consecutive rows with the flag: (key, start, length)."""
    w = Window.partitionBy(key).orderBy(order)
    marked = rows.withColumn("f", flag.cast("int")).withColumn("rn", F.row_number().over(w)).withColumn("grp", F.col("rn") - F.sum("f").over(w))
    return marked.where("f = 1").groupBy(key, "grp").agg(F.min(order).alias("start"), F.count("*").alias("length")).drop("grp")
