"""Names, venues, addresses and prices as Column functions."""

from __future__ import annotations

import functools
import unicodedata
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType

WS = r"(?U)\s+"

# Weekday names, words for online venues, road types, state tokens.
WEEKDAYS = ("monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday")
ONLINE_WORDS = ("online", "zoom", "webinar", "virtual", "livestream", "livestreamed", "remote", "teams")
ROAD_TYPES = (
    "Road", "Rd", "Street", "St", "Avenue", "Ave", "Highway", "Hwy", "Parade", "Pde", "Drive", "Dr", "Lane", "Ln", "Place", "Pl", "Square", "Sq",
    "Terrace", "Court", "Ct", "Boulevard", "Blvd", "Walk", "Crescent", "Cres", "Close", "Way", "Trail", "Parkway", "Circuit", "Cct", "Promenade", "Prom", "Esplanade",
)

_DAYLIST = "(?:" + "|".join(WEEKDAYS) + r")s?(?:\s*(?:,|&|and)\s*(?:" + "|".join(WEEKDAYS) + ")s?)*"


def _fold_char(ch: str) -> str:
    """What a character becomes: decomposed, without combining marks and the signs ® and ©, composed again."""
    kept = "".join(x for x in unicodedata.normalize("NFKD", ch) if not unicodedata.combining(x) and x not in "®™©")
    return unicodedata.normalize("NFKC", kept)


@functools.cache
def _fold_table() -> tuple[str, str]:
    """The characters of the basic plane that fold to another one, and after these those that vanish; and what the former become."""
    changed = {c: _fold_char(c) for c in map(chr, [*range(0x80, 0xD800), *range(0xE000, 0x10000)]) if _fold_char(c) != c}
    one = [c for c in changed if len(changed[c]) == 1]
    return "".join(one) + "".join(c for c in changed if not changed[c]), "".join(changed[c] for c in one)


def let(value: Column, f: Callable[[Column], Column]) -> Column:
    """f(value) with value worked out once for each row, however often f uses it."""
    return F.transform(F.array(value), f)[0]


def squeeze(c: Column) -> Column:
    """White space runs to one blank, none at the ends; null is empty."""
    return F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), WS, " "))


def fold_native(c: Column) -> Column:
    """fold_accents in the expression engine, for all characters that fold to one or none (not ligatures, fractions and the like, which stay)."""
    return F.translate(c, *_fold_table())


@F.pandas_udf(StringType())
def fold_accents(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """General fold: decompose, drop combining marks and ® ™ ©, compose again."""
    def fold(t: str | None) -> str | None:
        return t if t is None or t.isascii() else _fold_char(t)

    for s in batches:
        yield s.map(fold)


def normalize_name(c: Column, more_noise: bool = False) -> Column:
    """Lower case, single blanks, cut at the first separator between blanks, accents folded, a closing list of weekdays dropped;
    more_noise drops a closing (new), (series) or (term n) too."""
    cut = F.regexp_replace(squeeze(F.lower(c)), r" [-|:–—] .*$", "")
    noise = _DAYLIST + (r"|new|series|term \d+" if more_noise else "")
    return F.regexp_replace(F.trim(fold_native(cut)), r"\s*\((?:" + noise + r")\)\s*$", "")


def normalize_location(c: Column) -> Column:
    return squeeze(F.lower(c))


def venue_head(c: Column) -> Column:
    return normalize_location(F.substring_index(F.coalesce(c, F.lit("")), ",", 1))


def restates_name(description: Column, name: Column) -> Column:
    a, b = squeeze(F.lower(description)), squeeze(F.lower(name))
    return (a == b) & (F.length(b) >= 3)


def is_online(location: Column) -> Column:
    return F.lower(F.coalesce(location, F.lit(""))).rlike(r"\b(?:" + "|".join(ONLINE_WORDS) + r")\b")


def malformed_commas(c: Column) -> Column:
    text = F.trim(F.coalesce(c, F.lit("")))
    return F.contains(text, F.lit(",,")) | F.startswith(text, F.lit(",")) | F.endswith(text, F.lit(","))


def segments(c: Column) -> Column:
    return F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), ","), lambda x: F.trim(x)), lambda x: x != "")


def malformed_address(c: Column) -> Column:
    """Comma faults, or a segment that the next repeats."""

    def repeats(low: Column) -> Column:
        n = F.size(low)
        return F.exists(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))), lambda i: (i < n) & (F.get(low, i - 1) == F.get(low, i)))

    return malformed_commas(c) | let(F.transform(segments(c), lambda x: F.lower(x)), repeats)


def page_furniture(c: Column) -> Column:
    return F.coalesce(c, F.lit("")).rlike(r"(?i)\bview map\b|\n\s*\S+,\s*\n")


def names_next_occurrence(c: Column) -> Column:
    return F.coalesce(c, F.lit("")).rlike(r"(?i)\bnext date:")


def states_a_place(c: Column) -> Column:
    return F.coalesce(c, F.lit("")).rlike(r"\b3\d{3}\b|(?i)\b(?:" + "|".join(ROAD_TYPES) + r")\b")


def is_street(c: Column) -> Column:
    return F.trim(F.coalesce(c, F.lit(""))).rlike(r"(?i)\b(?:" + "|".join(ROAD_TYPES) + r")\b\.?$")


def street_line(c: Column) -> Column:
    """Whether a line states a street: a house number first, or a road type anywhere."""
    line = F.coalesce(c, F.lit(""))
    return line.rlike(r"^\s*\d+[A-Za-z]?([-/][A-Za-z0-9]+)*\s") | line.rlike(r"(?i)\b(?:" + "|".join(ROAD_TYPES) + r")\b")


# Words that can only go on with a URL.
URL_ENDINGS = ("au", "com", "org", "net", "edu", "gov", "co", "io", "com.au", "org.au", "net.au", "edu.au", "gov.au", "vic.gov.au")
#: Words that a URL may be put together from beyond its first, and characters below which there is no URL.
URL_WORDS, URL_LEAST = 4, 13


def joined_url(raw: Column, fallback: Column) -> Column:
    """The first URL of a text whose line breaks became blanks, put together again; fallback without one.

    A word goes on with the URL if it looks like part of one, if the URL ends in a hyphen, or if the word after it looks like part; a time of day never does.
    """
    text = F.coalesce(raw, F.lit(""))
    first = F.regexp_extract(text, r"((?:https?://|www\.)\S+)", 1)
    rest = F.split(F.trim(F.substr(text, F.instr(text, first) + F.length(first))), r"\s+")
    looks = lambda w: F.coalesce(w, F.lit("")).rlike("[./?&=]")

    def step(state: Column, i: Column) -> Column:
        word, after = F.coalesce(F.get(rest, i), F.lit("")), F.coalesce(F.get(rest, i + 1), F.lit(""))
        bare = F.regexp_replace(F.lower(word), r"[.,)]+$", "")
        part = looks(word) | bare.isin(*URL_ENDINGS) | F.endswith(state["url"], F.lit("-")) | after.rlike("[./]")
        goes = state["going"] & (word != "") & ~word.rlike(r"^\d{1,2}[:.]\d{2}") & part
        return F.struct(F.when(goes, F.concat(state["url"], word)).otherwise(state["url"]).alias("url"), goes.alias("going"))

    whole = F.aggregate(F.sequence(F.lit(0), F.lit(URL_WORDS - 1)), F.struct(first.alias("url"), F.lit(True).alias("going")), step)["url"]
    url = F.regexp_replace(whole, r"[.,)]+$", "")
    url = F.when(F.startswith(url, F.lit("http")), url).otherwise(F.concat(F.lit("https://"), url))
    return F.when((first != "") & (F.length(url) >= URL_LEAST), url).otherwise(fallback)


def price_sort(c: Column) -> Column:
    """0.0 free, 1.0 gold coin, else the first dollar amount, else null."""
    text = F.coalesce(c, F.lit(""))
    amount = F.regexp_extract(text, r"\$\s*(\d+(?:\.\d+)?)", 1)
    return F.when(F.lower(text).rlike(r"\bfree\b"), F.lit(0.0)).when(F.lower(text).rlike(r"gold\s+coin"), F.lit(1.0)).otherwise(F.nullif(amount, F.lit("")).cast("double"))


# Calls to action that follow a cost on a page.
CALLS_TO_ACTION = ("Book here", "FIND OUT MORE BUTTON", "View & Book", "Read more", "More info", "Enrol now", "Book now")


def cut_at_word(c: Column, most: int) -> Column:
    """At most `most` characters, cut before the last blank within them where the text is longer."""
    head = F.substring(c, 1, most)
    return F.when(F.length(c) <= most, c).otherwise(F.regexp_replace(head, r" [^ ]*$", ""))


def clean_cost(c: Column, calls: tuple[str, ...] = CALLS_TO_ACTION, most: int = 60) -> Column:
    """A cost without what the page put after it: cut at the first call to action, rules of = gone, 60 characters at most."""
    said = F.coalesce(c, F.lit(""))
    low = F.lower(said)
    found = F.array_min(F.filter(F.array(*[F.instr(low, x.lower()) for x in calls]), lambda i: i > 0))
    cut = F.when(found.isNull(), said).otherwise(F.substring(said, F.lit(1), found - 1))
    return cut_at_word(F.regexp_replace(squeeze(F.translate(cut, "=", "")), r"^[ \-|;,.]+|[ \-|;,.]+$", ""), most)


def clean_title(c: Column, most: int = 80) -> Column:
    """A title without zero-width and unreadable characters, 80 characters at most."""
    return F.substring(squeeze(F.translate(F.translate(F.coalesce(c, F.lit("")), "\u200b\xa0", "  "), "\ufffd", "")), 1, most)


def keep_start(c: Column, most: int = 120) -> Column:
    """The beginning of a long text, with three dots for what is gone."""
    clean = squeeze(c)
    return F.when(F.length(clean) <= most, clean).otherwise(F.concat(F.regexp_replace(F.substring(clean, 1, most), r"[ ,]+$", ""), F.lit("...")))


def strip_comments(c: Column) -> Column:
    """Source text without comments of HTML and CSS, and without the lines that are a comment of JavaScript as a whole."""
    blocks = F.regexp_replace(F.regexp_replace(F.coalesce(c, F.lit("")), r"(?s)<!--.*?-->", ""), r"(?s)/\*.*?\*/", "")
    return F.array_join(F.filter(F.split(blocks, "\n"), lambda line: ~F.startswith(F.ltrim(line), F.lit("//"))), "\n")


def safe_url(c: Column) -> Column:
    """The url if it is http, https, mailto or local; else empty."""
    u = F.trim(F.coalesce(c, F.lit("")))
    low = F.lower(u)
    ok = F.startswith(low, F.lit("http://")) | F.startswith(low, F.lit("https://")) | F.startswith(low, F.lit("mailto:")) | ((F.startswith(u, F.lit("/")) | F.startswith(u, F.lit("#"))) & ~F.startswith(u, F.lit("//")))
    return F.when(ok, u).otherwise(F.lit(""))


def join_address(parts: Column) -> Column:
    """Flatten an array of address parts: split at commas, drop blanks and the country, collapse neighbours that repeat."""
    flat = F.filter(F.transform(F.split(F.array_join(parts, ","), ","), lambda x: F.trim(x)), lambda x: (x != "") & (F.lower(x) != "australia"))
    kept = F.aggregate(flat, F.array().cast("array<string>"), lambda acc, x: F.when(F.lower(F.coalesce(F.element_at(F.concat(F.array(F.lit("")), acc), -1), F.lit(""))) == F.lower(x), acc).otherwise(F.concat(acc, F.array(x))))
    return F.array_join(kept, ", ")


def canonical_suburb(c: Column, gazetteer: tuple[str, ...]) -> Column:
    """The gazetted spelling of a suburb, or empty; gazetteer is a parameter."""
    out = F.lit("")
    known = F.create_map(*[F.lit(x) for s in gazetteer for x in (s.lower(), s)]) if gazetteer else None
    return out if known is None else F.coalesce(known[squeeze(F.lower(c))], out)


def extract_suburb(address: Column, gazetteer: tuple[str, ...]) -> Column:
    """The gazetted suburb that an address states: before a state and postcode, before a state at the end, before a bare 3xxx
    postcode at the end, or the last segment after a street; else empty."""
    name = r"([A-Za-z][A-Za-z' ]*?)"
    state = r"(?:VIC|Vic|Victoria|VICTORIA)"
    known = lambda x: F.nullif(canonical_suburb(x, gazetteer), F.lit(""))

    def read(a: Column) -> Column:
        first = F.regexp_extract(a, rf"(?:^|,)\s*{name},?\s+{state}\.?,?\s+3\d{{3}}\b", 1)
        second = F.regexp_extract(a, rf"(?:^|,)\s*{name},?\s+{state}\.?\s*$", 1)
        third = F.regexp_extract(a, rf"(?:^|,)\s*{name},?\s+3\d{{3}}\s*$", 1)
        last = let(segments(a), lambda seg: F.when((F.size(seg) > 1) & is_street(F.get(seg, F.size(seg) - 2)), F.get(seg, F.size(seg) - 1)).otherwise(F.lit("")))
        return F.coalesce(known(first), known(second), known(third), known(last), F.lit(""))

    return let(F.regexp_replace(F.coalesce(address, F.lit("")), r"\s*\n\s*", " "), read)


def venue_compatible(a: Column, b: Column) -> Column:
    """Equal heads, or one normalised venue is the other's beginning up to a separator."""
    short, long = F.when(F.length(a) <= F.length(b), a).otherwise(b), F.when(F.length(a) <= F.length(b), b).otherwise(a)
    head = F.trim(F.substring_index(a, ",", 1)) == F.trim(F.substring_index(b, ",", 1))
    nxt = F.substr(long, F.length(short) + 1, F.lit(1))
    return (a != "") & (b != "") & (head | (F.startswith(long, short) & nxt.isin(" ", ",", "-", "/", "(")))


def common_length(a: str, b: str) -> int:
    """Length of the longest common subsequence, by whole-word bit operations: one addition for each character of b."""
    places: dict[str, int] = {}
    for i, ch in enumerate(a):
        places[ch] = places.get(ch, 0) | 1 << i
    full = (1 << len(a)) - 1
    open_ = full
    for ch in b:
        met = open_ & places.get(ch, 0)
        open_ = ((open_ + met) | (open_ - met)) & full
    return len(a) - open_.bit_count()


@F.pandas_udf(DoubleType())
def indel_similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    """2 * LCS / (length a + length b); two empty strings are 1.0, null gives null."""

    def one(x: str | None, y: str | None) -> float | None:
        if x is None or y is None:
            return None
        return 2.0 * common_length(x, y) / (len(x) + len(y)) if x or y else 1.0

    return pd.Series([one(x, y) for x, y in zip(a, b, strict=True)], dtype="float64")


def length_bound(a: Column, b: Column, threshold: float) -> Column:
    """A sound filter before indel_similarity: lengths that can't reach the threshold go."""
    return 2 * F.least(F.length(a), F.length(b)) >= F.lit(threshold) * (F.length(a) + F.length(b))


def cadence_label(c: Column) -> Column:
    return F.lower(F.regexp_replace(F.coalesce(c, F.lit("")), r"\s*\([^()]*\)\s*$", ""))


def series_id(source_id: Column, name: Column, venue: Column) -> Column:
    return F.substring(F.sha1(F.concat_ws("|", source_id, name, venue).cast("binary")), 1, 12)


def slot_hash(name: Column, stamp: Column, location: Column) -> Column:
    return F.md5(F.concat_ws("|", name, stamp, location).cast("binary"))
