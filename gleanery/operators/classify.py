"""Rule tables over text: types, commercial events, status, services."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gleanery.functions.text import let

# The display order of types.
TYPES = (
    "Art & Craft", "Books & Reading", "Children & Families", "Community Group", "Dance", "Exercise & Fitness", "Food & Drink", "Games & Cards", "Health & Wellbeing",
    "Info Session", "Market & Exhibition", "Movies & Cinema", "Music & Performance", "Nature & Environment", "Seniors Festival", "Social & Community", "Sport & Outdoors", "Technology", "Other",
)

#: A short default rule table (type -> pattern). classify_types() takes any table of this shape; sites pass their own full one.
RULES = {
    "Art & Craft": r"\bpaint|\bcraft|\bsew|\bknit|pottery|printmaking|\barts?\b",
    "Books & Reading": r"book club|storytime|\breading\b|poetry|\blibrary\b",
    "Children & Families": r"\bkids?\b|\bchild(ren)?\b|school holiday|\bjuniors?\b",
    "Dance": r"\bdanc(e|ing|ers)\b|ballet",
    "Exercise & Fitness": r"\byoga\b|pilates|zumba|tai chi|\bgym\b",
    "Food & Drink": r"\bcook|lunch|dinner|breakfast|\bmeals?\b|coffee",
    "Games & Cards": r"\bcards?\b|chess|bingo|\btrivia\b",
    "Market & Exhibition": r"\bmarket|exhibition|\bfair\b",
    "Movies & Cinema": r"movie|film|cinema",
    "Music & Performance": r"concert|choir|karaoke|piano",
    "Seniors Festival": r"seniors? festival",
    "Social & Community": r"cuppa|friendship|u3a",
    "Sport & Outdoors": r"basketball|soccer|tennis|\bwalk\b|\bgolf\b",
    "Technology": r"computer|digital|\bai\b|robot",
}

#: A source's own terms -> types; a parameter like RULES.
TAXONOMY = {"faith": ("Social & Community",), "sports and recreation": ("Sport & Outdoors",), "arts and culture": ("Art & Craft", "Music & Performance"), "other": ()}

# Phrases of commercial offers, in the order in which they are tried; their text is part of the reason.
STRONG = (
    r"\bparmas?\b", r"\bparmi\b", r"\bschnitzel\b", r"\bsteak\b", r"\bwagyu\b", r"\bcounter\s*meal\b", r"\bmeat\s*raffle\b", r"\bmembers?\s*draw\b",
    r"\bhappy\s*hour\b", r"\blunch\s*special\b", r"\bdinner\s*special\b", r"\bseniors?\s*meal\s*deal\b", r"\broast\s*special\b", r"\bfish\s*n\s*chips\s*special\b",
)
# Words of venues that are commercial, that may be, and that are not.
HARD_VENUE = (r"\bpub\b", r"\btavern\b", r"\bbistro\b", r"\bbrewery\b", r"\bpokie\b", r"\bhotel\b", r"\bgaming\s*lounge\b")
SOFT_VENUE = (r"\binn\b", r"\bsports?\s*bar\b", r"\btab\b.*\bbet\b")
ALLOWED_VENUE = r"\blibrar\w*|\bcommunity\s*cent\w*|\bneighbou?rhood\s*house\b|\bactivity\s*hub\b|\bchurch\w*|\bhall\b|\breserve\b|\bbeach\b|\bpark\b|\btheat(re|er)\b|\bgallery\b|\bschool\b"
# Phrases of an event's status, at any place and at the beginning, and of meals as a service.
CANCELLED = r"\bcancell?ed\b|\bcancellation\b|\bcancel\b|\bpostponed\b"
SOLD_OUT = r"\bsold\s*out\b|\bselling\s*(?:fast|out)\b"
FULLY_BOOKED = r"\bfull(?:y)?\s*booked\b|\bno\s*(?:places|spots)\b"
LEADING = r"^\s*(sold\s*out|fully\s*booked|booked\s*out|booked\s*full|cancell?ed|cancellation|cancel|postponed|selling\s*(?:fast|out)|no\s*(?:places|spots))\b"
SERVICE = r"\btake\s*away\s*meals?\b|\btakeaway\s*meals?\b|\bmeals?\s*(?:provided|available|supplied)\b|\bmeals?\s*on\s*wheels\b"


def has(c: Column, pattern: str) -> Column:
    return c.rlike("(?i)" + pattern)


def phrase(c: Column, pattern: str) -> Column:
    return F.regexp_extract(c, f"(?i)({pattern})", 1)


def classify_types(title: Column, description: Column, terms: Column | None = None, rules: dict[str, str] = RULES, taxonomy: dict[str, tuple[str, ...]] = TAXONOMY) -> Column:
    """All types whose pattern is in title or description or that the source's terms name, in display order; ["Other"] if none."""
    key = lambda t: F.trim(F.regexp_replace(F.replace(F.lower(t), F.lit(","), F.lit(" ")), r"\s+", " "))
    both = F.concat_ws("\u0001", title, description)  # no pattern's white space spans the separator
    tags = []
    for t in TYPES:
        hit = has(both, rules[t]) if t in rules else F.lit(False)
        own = [k for k, v in taxonomy.items() if t in v]
        if terms is not None and own:
            hit = hit | F.coalesce(F.exists(terms, lambda x: key(x).isin(*own)), F.lit(False))  # noqa: B023
        tags.append(F.when(hit, F.lit(t)))
    return let(F.array_compact(F.array(*tags)), lambda found: F.when(F.size(found) > 0, found).otherwise(F.array(F.lit("Other"))))


def unmapped(terms: Column, taxonomy: dict[str, tuple[str, ...]] = TAXONOMY) -> Column:
    key = lambda t: F.trim(F.regexp_replace(F.replace(F.lower(t), F.lit(","), F.lit(" ")), r"\s+", " "))
    return F.array_sort(F.array_distinct(F.filter(terms, lambda t: ~key(t).isin(*taxonomy))))


def _any(c: Column, patterns: tuple[str, ...]) -> Column:
    return has(c, "(?:" + "|".join(patterns) + ")")


def commercial_reason(name: Column, description: Column, location: Column, address: Column, price_sort: Column) -> Column:
    """Why a row is a commercial offer, or empty: a strong phrase, priced or pub trivia, a venue or RSL with a price or meal."""
    text, place = F.concat_ws("\n", name, description), F.concat_ws(" ", location, address)
    scrubbed = F.regexp_replace(place, r"(?i)publi[cs]\w*|publish\w*", " ")
    hard = _any(scrubbed, HARD_VENUE[:1]) | _any(place, HARD_VENUE[1:])
    soft = _any(place, SOFT_VENUE)
    venue = hard | soft
    trivia_venue = hard | (soft & ~(has(place, ALLOWED_VENUE) & ~has(place, r"\brsl\b")))
    priced, solid = F.coalesce(price_sort > 0, F.lit(False)), F.coalesce(price_sort >= 5, F.lit(False))
    out = F.when(has(text, STRONG[0]) | has(place, STRONG[0]), F.lit("strong:" + STRONG[0]))
    for p in STRONG[1:]:
        out = out.when(has(text, p) | has(place, p), F.lit("strong:" + p))
    trivia = has(text, r"\btrivia\b")
    out = out.when(trivia & trivia_venue, "trivia+venue").when(trivia & solid, "trivia+priced")
    out = out.when(venue & (priced | has(text, r"lunch|dinner|meal|bistro|trivia|raffle|happy|special|\$")), "venue+meal-context")
    rsl = has(text, r"\brsl\b") | has(place, r"\brsl\b")
    return out.when(rsl & (priced | has(text, r"meal|bistro|dinner|lunch|trivia|raffle|happy")), "rsl+meal-context").otherwise("")


def event_status(name: Column, datetime_text: Column, description: Column) -> tuple[Column, Column]:
    """(status, phrase): a phrase that leads the date text, else cancelled, sold out or fully booked in name or description; empty when open."""
    lead = F.regexp_extract(datetime_text, "(?i)" + LEADING, 1)
    low = F.lower(lead)
    status = F.when(F.startswith(low, F.lit("cancel")) | F.startswith(low, F.lit("postponed")), "cancelled").when(F.contains(low, F.lit("booked")), "fully_booked").when(low != "", "sold_out")
    detail = F.when(low != "", lead)
    for pattern, label in ((CANCELLED, "cancelled"), (SOLD_OUT, "sold_out"), (FULLY_BOOKED, "fully_booked")):
        found = F.coalesce(F.nullif(phrase(name, pattern), F.lit("")), phrase(description, pattern))
        status = status.when(found != "", label)
        detail = detail.when(found != "", found)
    return status.otherwise(""), detail.otherwise("")


def service_reason(name: Column, description: Column) -> Column:
    found = F.coalesce(F.nullif(phrase(name, SERVICE), F.lit("")), phrase(description, SERVICE))
    return F.when(found != "", F.concat(F.lit("service:"), F.lower(F.trim(F.regexp_replace(found, r"\s+", " "))))).otherwise("")
