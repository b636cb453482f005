"""File sources and sinks of the pipeline: snapshots, raw batch, archive, configuration and their gates."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ROW = "name string, datetime_text string, datetime_iso string, location string, address string, price_text string, price_sort double, description string, source string, source_id string"
#: Keys that every source entry has to have, and those of each kind; kinds are open, callers add theirs.
REQUIRED = ("id", "name", "type")
KINDS: dict[str, tuple[str, ...]] = {"listing": ("url", "snapshot"), "calendar": ("url", "calendar_venues"), "venues": ("venues",), "sitemap": ("url", "snapshot", "max_pages"), "guide": ("snapshot",)}
STATUSES = ("live", "unverified", "finished")

Reader = Callable[[SparkSession, dict], DataFrame]
#: The dispatch table: a source's type is its only key.
READERS: dict[str, Reader] = {}


def reader(kind: str) -> Callable[[Reader], Reader]:
    def add(f: Reader) -> Reader:
        READERS[kind] = f
        return f

    return add


@reader("listing")
def read_listing(spark: SparkSession, cfg: dict) -> DataFrame:
    return read_json(spark, cfg["snapshot"]).withColumn("source_id", F.lit(cfg["id"]))


def dispatch(spark: SparkSession, cfg: dict) -> DataFrame:
    if cfg.get("type") not in READERS:
        raise ValueError(f"no reader for type {cfg.get('type')!r} of source {cfg.get('id')!r}")
    return READERS[cfg["type"]](spark, cfg)


def read_json(spark: SparkSession, path: str, schema: str = ROW) -> DataFrame:
    """Rows of a JSON array file; an absent path gives no rows, a corrupt file fails."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    if not at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(path)


#: The file of a store that names the folders which are its rows now.
POINTER = "current.json"


def _fs(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def state_of(spark: SparkSession, path: str) -> dict | None:
    """{"folders": {bucket: folder}, "previous": [folder]} of a store; none where there is no store."""
    at, fs = _fs(spark, f"{path}/{POINTER}")
    if not fs.exists(at):
        return None
    stream = fs.open(at)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def point_to(spark: SparkSession, path: str, folders: dict[str, str]) -> None:
    """Make these folders the store's rows, by one rename that replaces the pointer. A crash before it leaves the old rows, after it the new ones. Folders that
    neither the new pointer nor the one before it names are deleted."""
    before = state_of(spark, path) or {"folders": {}, "previous": []}
    draft, fs = _fs(spark, f"{path}/.{POINTER}.{uuid.uuid4().hex}")
    out = fs.create(draft, True)
    out.write(json.dumps({"folders": folders, "previous": sorted(set(before["folders"].values()))}).encode())
    out.close()
    rename = spark._jvm.org.apache.hadoop.fs.Options.Rename
    flags = spark.sparkContext._gateway.new_array(rename, 1)
    flags[0] = rename.OVERWRITE
    spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(draft.toUri(), spark._jsc.hadoopConfiguration()).rename(draft, _fs(spark, f"{path}/{POINTER}")[0], flags)
    named = {*folders.values(), *before["folders"].values()}
    for old in set(before["previous"]) - named:
        fs.delete(_fs(spark, f"{path}/{old}")[0], True)


def write_atomic(rows: DataFrame, path: str) -> None:
    """Replace a store's rows by new ones in a folder of their own."""
    folder = f"v-{uuid.uuid4().hex}"
    rows.write.parquet(f"{path}/{folder}")
    point_to(rows.sparkSession, path, {"all": folder})


def read_store(spark: SparkSession, path: str, schema: str | None = None, only: list[int] | None = None) -> DataFrame | None:
    """A store's rows, or those of some buckets; none (or an empty table of the schema) where there are none."""
    state = state_of(spark, path) or {"folders": {}}
    folders = [f for b, f in sorted(state["folders"].items()) if only is None or int(b) in only]
    if not folders:
        return None if schema is None else spark.createDataFrame([], schema)
    return spark.read.parquet(*[f"{path}/{f}" for f in folders])


def replace_buckets(rows: DataFrame, path: str, touched: list[int], bucket: str = "bucket") -> None:
    """Replace the rows of the touched buckets of a store by rows, whose column `bucket` says where each belongs. Other buckets' files stay as they are."""
    spark = rows.sparkSession
    version = f"v-{uuid.uuid4().hex}"
    rows.repartition(bucket).write.partitionBy(bucket).parquet(f"{path}/{version}")
    folders = dict((state_of(spark, path) or {"folders": {}})["folders"])
    for b in touched:
        folder = f"{version}/{bucket}={b}"
        at, fs = _fs(spark, f"{path}/{folder}")
        folders.pop(str(b), None)
        if fs.exists(at):
            folders[str(b)] = folder
    point_to(spark, path, folders)


#: Lists of a configuration document, and the group that entries of each belong to.
GROUPS = {"webfetch": "snapshot", "sources": "shared"}


def parse_config(text: str | None, yaml_text: bool = False, groups: dict[str, str] = GROUPS) -> list[dict]:
    """Every source entry of a document, JSON or YAML, tagged with the group of its list; an empty document has none, a malformed one fails."""
    if yaml_text:
        try:
            import yaml
        except ImportError as missing:
            raise ValueError("YAML configuration needs a YAML library") from missing
        try:
            document = yaml.safe_load(text or "") or {}
        except yaml.YAMLError as bad:
            raise ValueError("malformed configuration") from bad
    else:
        document = json.loads(text) if (text or "").strip() else {}
    if not isinstance(document, dict):
        raise ValueError("a configuration is a mapping of lists")
    return [{**entry, "group": group} for name, group in groups.items() for entry in document.get(name) or []]


def read_config(spark: SparkSession, path: str) -> list[dict]:
    """The entries of a configuration file on any file system; .json is JSON, all else YAML."""
    text = "\n".join(r.value for r in spark.read.text(path, wholetext=True).collect())
    return parse_config(text, not path.endswith(".json"))


def source_ids(spark: SparkSession, path: str) -> set[str] | None:
    """Ids that the configuration declares; none, not an empty set, where it can't be read, as an empty set would mean that no source exists any more."""
    try:
        return {e["id"] for e in read_config(spark, path) if e.get("id")}
    except Exception:  # noqa: BLE001  whatever is wrong with the file, its sources are unknown
        return None


def config_frame(spark: SparkSession, entries: list[dict]) -> DataFrame:
    """Entries as (ord, id, name, type, keys): what the rules of validate_config look at."""
    rows = [(i, str(e["id"]) if e.get("id") else None, e.get("name"), e.get("type"), sorted(k for k, v in e.items() if v not in (None, "")), e.get("snapshot")) for i, e in enumerate(entries)]
    return spark.createDataFrame(rows, "ord int, id string, name string, type string, keys array<string>, snapshot string")


def validate_config(spark: SparkSession, entries: list[dict], kinds: dict[str, tuple[str, ...]] = KINDS) -> DataFrame:
    """All faults at once: (ord, fault)."""
    cfg = config_frame(spark, entries)
    missing = cfg.select("ord", F.explode(F.array_except(F.array(*map(F.lit, REQUIRED)), "keys")).alias("k")).select("ord", F.concat(F.lit("missing "), "k").alias("fault"))
    unknown = cfg.where(F.col("type").isNotNull() & ~F.col("type").isin(*kinds)).select("ord", F.concat(F.lit("unknown type "), "type").alias("fault"))
    need = cfg
    owed = F.lit(None).cast("array<string>")
    for kind, keys in kinds.items():
        owed = F.when(F.col("type") == kind, F.array(*map(F.lit, keys))).otherwise(owed)
    lacking = need.withColumn("owed", owed).where("owed is not null").select("ord", F.explode(F.array_except("owed", "keys")).alias("k")).select("ord", F.concat(F.lit("missing "), "k").alias("fault"))
    twice = cfg.where("snapshot is not null").groupBy("snapshot").agg(F.collect_list("ord").alias("o")).where(F.size("o") > 1).select(F.explode("o").alias("ord"), F.concat(F.lit("snapshot used twice: "), "snapshot").alias("fault"))
    same_id = cfg.where("id is not null").groupBy("id").agg(F.collect_list("ord").alias("o")).where(F.size("o") > 1).select(F.explode("o").alias("ord"), F.concat(F.lit("id used twice: "), "id").alias("fault"))
    return missing.unionByName(unknown).unionByName(lacking).unionByName(twice).unionByName(same_id)


def archive_faults(rows: DataFrame, known: tuple[str, ...]) -> DataFrame:
    """(row_ord, fault) of an archive fixture: required keys, known source, status of the list."""
    empty = lambda c: F.coalesce(F.trim(F.col(c)), F.lit("")) == ""
    faults = F.array_compact(
        F.array(
            *[F.when(empty(c), F.lit(f"missing {c}")) for c in ("name", "source_id", "status")],
            F.when(~empty("source_id") & ~F.col("source_id").isin(*known), F.lit("unknown source")),
            F.when(~empty("status") & ~F.col("status").isin(*STATUSES), F.lit("unknown status")),
        )
    )
    return rows.select("row_ord", F.explode(faults).alias("fault"))


def union_inputs(raw: DataFrame, archive: DataFrame, snapshots: DataFrame, known: tuple[str, ...], mid_crawl: tuple[str, ...] = ()) -> DataFrame:
    """Raw rows, archive rows (flagged), and the snapshot files of which every row has a known, finished source; snapshots have a `file`."""
    bad = snapshots.where(~F.col("source_id").isin(*known) | (F.col("source_id").isin(*mid_crawl) if mid_crawl else F.lit(False))).select("file").distinct()
    good = snapshots.where(~F.endswith("file", F.lit(".progress.json"))).join(bad, "file", "left_anti").drop("file")
    return raw.unionByName(archive.withColumn("archived", F.lit(True)), allowMissingColumns=True).unionByName(good, allowMissingColumns=True)


def count_change(previous: DataFrame, current: DataFrame, key: str) -> DataFrame:
    """(key, before, now, lost_percent): how each source's count changed; lost_percent is floored, 0 when none were lost."""
    a, b = previous.groupBy(key).agg(F.count("*").alias("before")), current.groupBy(key).agg(F.count("*").alias("now"))
    x = a.join(b, key, "full").select(key, F.coalesce("before", F.lit(0)).alias("before"), F.coalesce("now", F.lit(0)).alias("now"))
    return x.withColumn("lost_percent", F.when(F.col("before") > F.col("now"), F.floor(100 * (F.col("before") - F.col("now")) / F.col("before"))).otherwise(F.lit(0)).cast("long"))


def missing_sources(required: tuple[str, ...], done: tuple[str, ...]) -> list[str]:
    """The all-or-nothing gate of the raw batch: sources that still owe rows."""
    return sorted(set(required) - set(done))


def calendar_rows(responses: DataFrame, body: str, venues: DataFrame) -> DataFrame:
    """Rows of nested calendar responses ({"data": [{"Items": [{Name, DateTime, CalendarId}]}]}) with the venue of each calendar; every calendar must have one."""
    schema = "data array<struct<Items: array<struct<Name: string, DateTime: string, CalendarId: string>>>>"
    items = responses.select(F.explode(F.from_json(body, schema)["data"]).alias("d")).select(F.explode("d.Items").alias("i")).select("i.Name", "i.DateTime", "i.CalendarId")
    joined = items.join(venues, "CalendarId", "left")
    return joined.withColumn("complete", F.col("venue").isNotNull())


def sitemap_urls(index: DataFrame, children: DataFrame, done: DataFrame) -> DataFrame:
    """Distinct urls of the child sitemaps that an index names, but for those done. index: (sitemap), children: (sitemap, url), done: (url)."""
    named = children.join(index.select("sitemap").distinct(), "sitemap", "left_semi")
    return named.select("url").distinct().join(done.select("url").distinct(), "url", "left_anti")


def resume(done: DataFrame, rows: DataFrame, fetched: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Crawl state after a slice: done (url) with the fetched urls, and rows with the fetched rows in place of older ones of their url. Repeating a slice changes nothing.

    fetched: (url, row), row null for a page without any.
    """
    return (
        done.select("url").unionByName(fetched.select("url")).distinct(),
        rows.join(fetched.select("url").distinct(), "url", "left_anti").unionByName(fetched.where("row is not null").select(*rows.columns)),
    )


def within_horizon(rows: DataFrame, day: str, today: str, days: int) -> DataFrame:
    """Rows whose day is from today on and at most `days` ahead; rows without a day stay."""
    now = F.lit(today).cast("date")
    return rows.where(F.col(day).isNull() | F.col(day).between(now, F.date_add(now, days)))


def next_slice(urls: DataFrame, done: DataFrame, size: int, budget: int, cap: int) -> DataFrame:
    """The next urls in order: those not done, the least of slice, budget and cap of them."""
    return urls.distinct().join(done.select("url"), "url", "left_anti").orderBy("url").limit(min(size, budget, cap))
