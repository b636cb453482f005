"""URL filter by a ratio of character language models (operator 4), in DataFrame functions only.

Two smoothed Markov models of variable order are learned from URLs that host rules accept and reject. A context of
n characters is kept where it was seen LEAST times or more; a character is scored in the longest kept context, each order
smoothed by the one below it. The score is the mean, over the characters of a URL, of the log of the
accepted model's probability over the rejected one's; the threshold is calibrated on labelled URLs that the models
didn't see. URLs that a rule covers get the rule's verdict.
"""

from __future__ import annotations


from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize

#: verdict, host suffix, path prefix. Fixed values of the contract.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
#: Longest context, in characters.
ORDER = 3
#: Times a gram must have been seen to be kept, and grams of each length that are broadcast at most (characters under other grams are looked up by a shuffle).
LEAST, MOST_GRAMS = 3, 50_000
#: Weight of the lower order's probability in each context.
SMOOTHING = 4.0
#: Size of the alphabet that the lowest order is uniform over.
ALPHABET = 256.0
#: Steps of the score at which a threshold is tried.
STEPS = 400


def _after_scheme(url: Column) -> Column:
    return F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + F.lit(3))).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    """After the first :// up to / ? # or the end, A-Z lower-cased; empty without ://."""
    return F.translate(F.regexp_extract(_after_scheme(url), r"^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """After the host up to ? # or the end."""
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def with_rule(rows: DataFrame, rules=RULES) -> DataFrame:
    """rows with rule (its text, null if none covers the URL) and ruled (allow or block); the longest rule wins, of equally long ones the first by
    (verdict, host, path), so allow before block."""
    chosen = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r))
    rule = verdict = None
    for kind, host, path in chosen:
        fits = ((F.col("host") == host) | F.endswith(F.col("host"), F.lit("." + host))) & F.startswith(F.col("path"), F.lit(path))
        rule = F.when(fits, F.lit(host + path)) if rule is None else rule.when(fits, F.lit(host + path))
        verdict = F.when(fits, F.lit(kind)) if verdict is None else verdict.when(fits, F.lit(kind))
    none = F.lit(None).cast("string")
    return rows.withColumn("rule", none if rule is None else rule).withColumn("ruled", none if verdict is None else verdict)


def _grams(rows: DataFrame, keep: list[str]) -> DataFrame:
    """A row for each character of text: `keep`, and g0 to gORDER, the grams that end at it (null where the text is too short)."""
    at = rows.select(*keep, "text", F.explode(F.sequence(F.lit(1), F.length("text"))).alias("i")).where(F.length("text") > 0)
    grams = [F.when(F.col("i") > n, F.expr(f"substring(text, i - {n}, {n + 1})")).alias(f"g{n}") for n in range(ORDER + 1)]
    return at.select(*keep, *grams)


def learn(labelled: DataFrame) -> list[DataFrame]:
    """For each order a table (g, ratio): log of accepted over rejected probability of a gram's last character after the rest.

    labelled: (text, good). Every gram seen LEAST times or more is in its table, however many there are; what follows a context is counted over all grams, rare ones too.
    """
    rows = _grams(labelled.where(F.length("text") > 0), ["good"])
    long = rows.select("good", F.explode(F.array(*[F.col(f"g{n}") for n in range(ORDER + 1)])).alias("g")).where(F.col("g").isNotNull())
    yes, no = F.sum(F.when(F.col("good"), 1).otherwise(0)), F.sum(F.when(F.col("good"), 0).otherwise(1))
    counts = materialize(long.groupBy("g").agg(yes.alias("a"), no.alias("r")))
    models: list[DataFrame] = []
    for n in range(ORDER + 1):
        own = counts.where(F.length("g") == n + 1).withColumn("ctx", F.substring("g", 1, n))
        totals = own.groupBy("ctx").agg(F.sum("a").alias("ta"), F.sum("r").alias("tr"))
        joined = own.where(F.col("a") + F.col("r") >= LEAST).join(totals, "ctx")
        if n:
            lower = models[-1].select(F.col("g").alias("low"), F.col("pa").alias("la"), F.col("pr").alias("lr"))
            joined = joined.withColumn("low", F.expr("substring(g, 2)")).join(lower, "low", "left")
        else:
            joined = joined.withColumn("la", F.lit(None).cast("double")).withColumn("lr", F.lit(None).cast("double"))
        smooth = lambda c, t, p: (F.col(c) + SMOOTHING * F.coalesce(F.col(p), F.lit(1 / ALPHABET))) / (F.col(t) + SMOOTHING)
        models.append(materialize(joined.select("g", smooth("a", "ta", "la").alias("pa"), smooth("r", "tr", "lr").alias("pr"))))
    return [m.select("g", F.log(F.col("pa") / F.col("pr")).alias("ratio")) for m in models]


def _least_counts(counts: DataFrame) -> dict[int, int]:
    """For each length the count from which on there are at most MOST_GRAMS grams, by a histogram of a few hundred rows."""
    every = F.col("a") + F.col("r")
    bins = counts.groupBy(F.length("g").alias("length"), F.floor(F.log2(every) * 16).alias("bin")).agg(F.count("*").alias("grams"), F.min(every).alias("least"), F.max(every).alias("most")).collect()
    out: dict[int, int] = {}
    for length in {b.length for b in bins}:
        total = 0
        for b in sorted((b for b in bins if b.length == length), key=lambda b: -b.bin):
            total += b.grams
            out[length] = b.least if total <= MOST_GRAMS else out.get(length, b.most + 1)
            if total > MOST_GRAMS:
                break
    return out


def lookup(rows: DataFrame, models: list[DataFrame]) -> DataFrame:
    """(g, seen, ratio) for each distinct longest gram of rows' characters: how often it is there, and the ratio of its longest kept end (0 without one)."""
    table = _longest(rows, []).groupBy("g").agg(F.count("*").alias("seen"))
    for n, model in enumerate(models):
        own = model.select(F.col("g").alias(f"g{n}"), F.col("ratio").alias(f"r{n}"))
        end = F.when(F.length("g") > n, F.expr(f"right(g, {n + 1})"))
        table = table.withColumn(f"g{n}", end).join(F.broadcast(own) if model.count() <= MOST_GRAMS else own, f"g{n}", "left")
    best = F.coalesce(*[F.col(f"r{n}") for n in reversed(range(len(models)))], F.lit(0.0))
    return materialize(table.select("g", "seen", best.alias("ratio")))


def _longest(rows: DataFrame, keep: list[str]) -> DataFrame:
    """A row for each character of text: `keep`, and g, the longest gram that ends at it."""
    return _grams(rows, keep).select(*keep, F.coalesce(*[F.col(f"g{n}") for n in reversed(range(ORDER + 1))]).alias("g"))


def score(rows: DataFrame, keep: list[str], table: DataFrame) -> DataFrame:
    """keep columns and score, the mean ratio over the characters of text, which isn't empty. `row`, among keep, is unique.

    table is the lookup of these rows or of more. It is broadcast where it has at most MOST_GRAMS rows. Beyond that its most seen grams are, and a row's
    characters under these stay in its task, which sends on one sum for each row; the others are joined by a shuffle, where no gram has many rows, as
    MOST_GRAMS are seen as often or more.
    """
    if table.count() <= MOST_GRAMS:
        at = _longest(rows, keep).join(F.broadcast(table.select("g", "ratio")), "g", "left")
        return at.groupBy(*keep).agg(F.avg("ratio").alias("score"))
    least = _least_counts(table.select("g", F.col("seen").alias("a"), F.lit(0).alias("r")))
    frequent = F.col("seen") >= F.create_map(*[F.lit(x) for pair in least.items() for x in pair])[F.length("g")]
    at = _longest(materialize(rows.select(*keep, "text")), keep).join(F.broadcast(table.where(frequent).select("g", "ratio")), "g", "left")
    sums = at.groupBy(*keep).agg(F.coalesce(F.sum("ratio"), F.lit(0.0)).alias("near"), F.count("*").alias("n"))
    rare = at.where(F.col("ratio").isNull()).select("row", "g").join(table.where(~frequent).select("g", "ratio"), "g")
    joined = sums.join(rare.groupBy("row").agg(F.sum("ratio").alias("far")), "row", "left")
    return joined.select(*keep, ((F.col("near") + F.coalesce("far", F.lit(0.0))) / F.col("n")).alias("score"))


def calibrate(scored: DataFrame) -> float:
    """The threshold between scores of accepted and rejected URLs (good, score) with the best balanced accuracy; 0 without both kinds."""
    steps = scored.select("good", F.floor(F.least(F.greatest(F.col("score"), F.lit(-2.0)), F.lit(2.0)) * (STEPS / 4)).alias("step"))
    rows = steps.groupBy("step").agg(F.sum(F.col("good").cast("int")).alias("a"), F.sum((~F.col("good")).cast("int")).alias("r")).collect()  # at most STEPS + 1 rows
    good, bad = sum(r.a for r in rows), sum(r.r for r in rows)
    if not good or not bad:
        return 0.0
    best, chosen, below_good, below_bad = -1.0, [], 0, 0
    table = {r.step: r for r in rows}
    for step in range(-STEPS // 2, STEPS // 2 + 2):
        balanced = round((good - below_good) / good + below_bad / bad, 12)
        if balanced > best:
            best, chosen = balanced, []
        if balanced == best:
            chosen.append(step)
        if step in table:
            below_good, below_bad = below_good + table[step].a, below_bad + table[step].r
    return chosen[len(chosen) // 2] * 4 / STEPS


def judge(pages: DataFrame, id_col: str, url_col: str, rules=RULES) -> DataFrame:
    """One row for each row of pages: id_col, host, path, rule, verdict, score.

    A null url, or one without ://, has an empty host and path. URLs without a rule are allowed if their score reaches the calibrated threshold; an empty url scores 0.
    Where the rules leave no example of either kind, every URL without a rule is allowed. Repeated rows and null ids are judged each on its
    own (equal URLs alike); other columns are not read; an empty table gives no rows.
    """
    base = pages.select(F.col(id_col).alias("id"), F.coalesce(F.col(url_col).cast("string"), F.lit("")).alias("text"))
    rows = with_rule(base.select("id", "text", host_of(F.col("text")).alias("host"), path_of(F.col("text")).alias("path")), rules)
    ruled = rows.where("ruled is not null").select("text", (F.col("ruled") == "allow").alias("good"))
    unseen = F.conv(F.substring(F.md5(F.col("text").cast("binary")), 1, 8), 16, 10).cast("long") % 5 == 0  # these calibrate, the rest train
    kinds = {r.good for r in ruled.select("good").distinct().collect()}
    keep = ["row", "id", "host", "path", "rule", "ruled"]
    numbered = rows.withColumn("row", F.monotonically_increasing_id())
    if len(kinds) < 2:
        out = numbered.withColumn("score", F.lit(0.0))
        threshold = 0.0
    else:
        table = lookup(rows.select("text"), learn(ruled.where(~unseen)))
        check = ruled.where(unseen).withColumn("row", F.monotonically_increasing_id())
        threshold = calibrate(score(check.where(F.length("text") > 0), ["row", "good"], table))
        full = score(numbered.where(F.length("text") > 0), keep, table)
        out = full.select(*keep, "score").unionByName(numbered.where(F.length("text") == 0).select(*keep, F.lit(0.0).alias("score")))
    verdict = F.coalesce("ruled", F.when(F.col("score") >= threshold, "allow").otherwise("block"))
    return out.select(F.col("id").alias(id_col), "host", "path", "rule", verdict.alias("verdict"), "score")


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query over all pages."""
    return judge(spark.read.parquet(f"{sf_dir}/pages.parquet"), "page_id", "url").drop("score")


def _op4_sql() -> str:
    """The query's SQL; its tables m0 to mORDER are the models, lowest order first."""
    after = "CASE WHEN position('://' IN text) > 0 THEN substring(text, position('://' IN text) + 3) ELSE '' END"
    fits = lambda h, p: f"((host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}'))"
    ordered = sorted(RULES, key=lambda r: (-len(r[1] + r[2]), r))
    rule = " ".join(f"WHEN {fits(h, p)} THEN '{h}{p}'" for _, h, p in ordered)
    ruled = " ".join(f"WHEN {fits(h, p)} THEN '{k}'" for k, h, p in ordered)
    grams = ", ".join(f"CASE WHEN i > {n} THEN substring(text, (i - {n})::BIGINT, {n + 1}) END AS g{n}" for n in range(ORDER + 1))
    models = []
    for n in range(ORDER + 1):
        low, la, lr = (f"LEFT JOIN m{n - 1} low ON low.g = substring(c.g, 2)", "low.pa", "low.pr") if n else ("", "NULL::DOUBLE", "NULL::DOUBLE")
        smooth = lambda c, t, x: f"(c.{c} + {SMOOTHING} * coalesce({x}, {1 / ALPHABET!r})) / ({t} + {SMOOTHING})"
        models.append(
            f"t{n} AS (SELECT substring(g, 1, {n}) AS ctx, sum(a) AS ta, sum(r) AS tr FROM counts WHERE length(g) = {n + 1} GROUP BY 1),\n"
            f"m{n} AS (SELECT c.g, ({smooth('a', 'ta', la)})::DOUBLE AS pa, ({smooth('r', 'tr', lr)})::DOUBLE AS pr FROM counts c JOIN t{n} ON ctx = substring(c.g, 1, {n}) {low} WHERE length(c.g) = {n + 1} AND c.a + c.r >= {LEAST}),"
        )
    found = " ".join(f"LEFT JOIN m{n} ON m{n}.g = g{n}" for n in range(ORDER + 1))
    ratio = ", ".join(f"ln(m{n}.pa / m{n}.pr)" for n in reversed(range(ORDER + 1)))
    half = STEPS // 2
    return f"""WITH b AS (SELECT row_number() OVER () AS row, page_id, coalesce(url, '') AS text FROM pages),
h AS (SELECT *, translate(regexp_extract({after}, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract({after}, '^[^/?#]*([^?#]*)', 1) AS path FROM b),
u AS (SELECT *, CASE {rule} END AS rule, CASE {ruled} END AS ruled, ('0x' || substring(md5(text), 1, 8))::BIGINT % 5 = 0 AS unseen FROM h),
e AS (SELECT * EXCLUDE (i), {grams} FROM (SELECT *, unnest(range(1, length(text) + 1)) AS i FROM u)),
l AS (SELECT ruled = 'allow' AS good, unnest([{', '.join(f'g{n}' for n in range(ORDER + 1))}]) AS g FROM e WHERE ruled IS NOT NULL AND NOT unseen),
counts AS (SELECT g, count(*) FILTER (WHERE good) AS a, count(*) FILTER (WHERE NOT good) AS r FROM l WHERE g IS NOT NULL GROUP BY g),
{chr(10).join(models)}
s AS (SELECT row, avg(coalesce({ratio}, 0.0)) AS score FROM e {found} GROUP BY row),
x AS (SELECT ruled = 'allow' AS good, floor(least(greatest(score, -2.0), 2.0) * {STEPS / 4})::INT AS step FROM u JOIN s USING (row) WHERE ruled IS NOT NULL AND unseen),
z AS (SELECT count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE NOT good) AS bad FROM x),
y AS (SELECT k.step, round((z.good - (SELECT count(*) FROM x WHERE x.good AND x.step < k.step)) / z.good + (SELECT count(*) FROM x WHERE NOT x.good AND x.step < k.step) / z.bad, 12) AS balanced FROM (SELECT unnest(range({-half}, {half + 2})) AS step) k, z WHERE z.good > 0 AND z.bad > 0),
v AS (SELECT list(step ORDER BY step) AS best FROM y WHERE balanced = (SELECT max(balanced) FROM y)),
d AS (SELECT coalesce(best[len(best) // 2 + 1] * 4 / {STEPS}, 0.0) AS threshold, (SELECT count(DISTINCT ruled) FROM u) = 2 AS fitted FROM v)
SELECT page_id, host, path, rule, coalesce(ruled, CASE WHEN (CASE WHEN fitted THEN coalesce(score, 0.0) ELSE 0.0 END) >= (CASE WHEN fitted THEN threshold ELSE 0.0 END) THEN 'allow' ELSE 'block' END) AS verdict
FROM u LEFT JOIN s USING (row), d"""


OP4_SQL = _op4_sql()
