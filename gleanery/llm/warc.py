"""Deterministic sharded WARC writer and reader (operator 10).

Records are range-sorted by page id into shards of equal bytes: the bounds are quantiles, by payload bytes, of a sample that the
keys' hashes choose, and their number follows from the total, so shards depend on the pages alone and not on partitions or settings. A
shard is a task's partition; its records go one by one into gzip files (a member for each record) that are closed as soon as
their compressed size reaches the limit. Headers and digests are made anew from the payload, dates and ids are functions of the
record, and gzip members carry no time, so the same pages give the same bytes.

Files are written under temporary names that hold the attempt's id. Each task returns its files as manifest rows; the rows of the
successful attempts are written as a table, a second job gives those files their final names (which it may repeat), and the manifest
comes last, under a temporary name first. Leftovers of other attempts are removed. Readers go by the manifest alone.

On reading, files are streamed member by member. A revisit says only which record it refers to; the page and the payload's length are
looked up in that record, whose digest must be the same.
"""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BROADCAST_IDS, checkpoint_dir, fresh, keyed, materialize, remove, slices, text_or_empty

#: Compressed bytes at which a file is closed.
ROLL_BYTES = 1 << 30
#: Payload bytes of a shard: the total over SHARDS, within these bounds. Every record counts HEAD bytes more.
LEAST_SHARD, MOST_SHARD, SHARDS, HEAD = 4 << 20, 4 << 30, 256, 600
#: Keys that the driver holds for the bounds, about, however many shards there are (16 for each shard at least).
SAMPLE_KEYS = 20_000
#: Bytes of an archive file that a reader holds beside the record at hand.
CHUNK = 1 << 20
#: The capture date of every record; pages carry none.
DATE = "2000-01-01T00:00:00Z"
_NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # the URL namespace of RFC 4122
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMESPACE, f'page:{page}')}>"


def target_uri(page: int, url: str | None) -> str:
    """The URL with everything but visible ASCII percent-encoded (as UTF-8); urn:page:<number> without one."""
    return quote(url or "", safe="".join(map(chr, range(0x21, 0x7F)))) or f"urn:page:{page}"


def _framed(fields: list[tuple[str, str]], block: bytes) -> bytes:
    fields = [*fields, ("WARC-Block-Digest", f"sha1:{digest(block)}"), ("Content-Length", str(len(block)))]
    return ("WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n").encode() + block + b"\r\n\r\n"


def info_record(name: str) -> bytes:
    """The record that opens each file."""
    block = b"software: gleanery\r\nformat: WARC File Format 1.1\r\n"
    fields = [("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(_NAMESPACE, f'file:{name}')}>"), ("WARC-Date", DATE), ("WARC-Filename", name), ("Content-Type", "application/warc-fields")]
    return _framed(fields, block)


def record(page: int, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One WARC/1.1 record: a response with its payload, or a revisit that names the record whose payload it shares."""
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", record_id(page)),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", target_uri(page, url)),
        ("WARC-Payload-Digest", f"sha1:{digest(payload)}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("X-Page", str(page)),
    ]
    if refers_to is not None:
        fields += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("WARC-Refers-To", record_id(refers_to))]
    return _framed(fields, _HTTP + (payload if refers_to is None else b""))


def member(data: bytes) -> bytes:
    """One gzip member without a time."""
    z = zlib.compressobj(1, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def members(stream) -> Iterator[bytes]:
    """The contents of each gzip member of a binary stream, which is read in pieces."""
    z, parts, data = None, [], stream.read(CHUNK)
    while data:
        if z is None:
            z, parts = zlib.decompressobj(31), []
        parts.append(z.decompress(data))
        data = z.unused_data if z.eof else b""
        if z.eof:
            yield b"".join(parts)
            z = None
        if not data:
            data = stream.read(CHUNK)
    if z is not None:
        raise ValueError("a gzip member is cut short")


def records(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names in lower case) and payload of each record of an archive file but its first, warcinfo; digests are checked."""
    for raw in members(stream):
        head, _, rest = raw.partition(b"\r\n\r\n")
        lines = head.decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError("no WARC record")
        fields = {k.lower(): v for k, _, v in (x.partition(": ") for x in lines[1:])}
        block = rest[: int(fields["content-length"])]
        if fields["warc-block-digest"] != f"sha1:{digest(block)}":
            raise ValueError(f"block digest of {fields['warc-record-id']}")
        payload = block.partition(b"\r\n\r\n")[2]
        if fields["warc-type"] == "response" and fields["warc-payload-digest"] != f"sha1:{digest(payload)}":
            raise ValueError(f"payload digest of {fields['warc-record-id']}")
        if fields["warc-type"] != "warcinfo":
            yield fields, payload


def _filesystem(uri: str):
    """pyarrow's file system for a folder that all executors share, and the path in it."""
    from pyarrow import fs

    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    if "://" not in uri:
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri)


def resolve(pages: DataFrame, key: str, html_col: str, least_bytes: int) -> DataFrame:
    """(key, bytes, refers_to): the payload's size, and the page whose record a page revisits, null for responses. Digests alone are shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "html"):
            raw = [t.encode() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([hashlib.sha1(x).digest() + hashlib.md5(x).digest() for x in raw], pa.binary()), pa.array([len(x) for x in raw], pa.int64())],
                ["key", "digest", "bytes"],
            )

    rows = pages.select(F.col(key).alias("key"), text_or_empty(html_col).alias("html")).mapInArrow(run, "key long, digest binary, bytes long")
    rows = materialize(rows)
    groups = rows.where(F.col("bytes") >= least_bytes).groupBy("digest").agg(F.max("key").alias("first"), F.count("*").alias("n")).where("n > 1")
    joined = rows.join(groups.select("digest", "first"), "digest", "left")
    return materialize(joined.select("key", "bytes", F.when(F.col("first") != F.col("key"), F.col("first")).alias("refers_to")))


def shard_bounds(decisions: DataFrame) -> list[float]:
    """Least keys of all shards but the first. They depend on the keys and bytes alone, not on how the rows lie in partitions or on settings."""
    written = F.lit(HEAD) + F.when(F.col("refers_to").isNull(), F.col("bytes")).otherwise(0)
    total = decisions.agg(F.sum(written).alias("bytes"), F.count("*").alias("n")).first()
    if not total.n:
        return []
    shards = -(-total.bytes // min(max(total.bytes // SHARDS, LEAST_SHARD), MOST_SHARD))
    every = max(1, total.n // max(SAMPLE_KEYS, 16 * shards))
    table = decisions.where(F.pmod(F.xxhash64("key"), F.lit(every)) == 0).select("key", written.alias("w")).toArrow()
    key, w = np.asarray(table["key"]).astype(np.float64), np.asarray(table["w"]).astype(np.int64)
    order = np.argsort(key, kind="stable")
    before = np.cumsum(w[order]) - w[order]
    at = np.searchsorted(before, np.arange(1, shards) * (int(w.sum()) / shards))
    return np.unique(key[order][at[at < len(key)]]).tolist()


def write(pages: DataFrame, key: str, url_col: str, html_col: str, folder: str, least_bytes: int = 0, roll_bytes: int = ROLL_BYTES) -> DataFrame:
    """Write all pages as WARC files under `folder` (a shared folder's URI); returns the manifest (name, bytes, records, sha256)."""
    from pyspark.ml.feature import Bucketizer

    decisions = resolve(pages, key, html_col, least_bytes)
    # decisions and pages meet in the range sort itself: the decision comes just before its page
    empty = F.lit(None).cast("string")
    both = decisions.select("key", F.lit(0).alias("kind"), "refers_to", empty.alias("url"), empty.alias("html")).unionByName(
        pages.select(F.col(key).alias("key"), F.lit(1).alias("kind"), F.lit(None).cast("long").alias("refers_to"), F.col(url_col).cast("string").alias("url"), text_or_empty(html_col).alias("html"))
    )
    bounds = shard_bounds(decisions)
    if bounds:
        splits = [float("-inf"), *bounds, float("inf")]
        both = Bucketizer(splits=splits, inputCol="place", outputCol="shard").transform(both.withColumn("place", F.col("key").cast("double"))).drop("place").withColumn("shard", F.col("shard").cast("int"))
    else:
        both = both.withColumn("shard", F.lit(0))
    ranged = both.repartitionById(len(bounds) + 1, F.col("shard")).sortWithinPartitions("shard", "key", "kind")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target, base = _filesystem(folder)
        target.create_dir(base, recursive=True)
        attempt = uuid.uuid4().hex
        out, name, sha = None, "", hashlib.sha256()
        shard = size = count = number = 0
        done: list[tuple] = []

        def put(data: bytes) -> None:
            nonlocal size
            out.write(data)
            sha.update(data)
            size += len(data)

        def close() -> None:
            nonlocal out, number
            out.close()
            done.append((name, f".{name}.{attempt}.tmp", size, count, sha.hexdigest()))
            out, number = None, number + 1

        refers: int | None = None
        for batch in slices(batches, "html"):
            for k, kind, to, url, html, own in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if own != shard:
                    if out is not None:
                        close()
                    shard, number = own, 0
                if kind == 0:
                    refers = to
                    continue
                if out is None:
                    name, sha, size, count = f"shard-{shard:06d}-{number:05d}.warc.gz", hashlib.sha256(), 0, 0
                    out = target.open_output_stream(f"{base}/.{name}.{attempt}.tmp")
                    put(member(info_record(name)))
                put(member(record(k, url, html.encode(), refers)))
                count += 1
                if size >= roll_bytes:
                    close()
        if out is not None:
            close()
        yield pa.RecordBatch.from_arrays([pa.array([d[i] for d in done], t) for i, t in enumerate((pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string()))], ["name", "draft", "bytes", "records", "sha256"])

    manifest = materialize(ranged.mapInArrow(run, "name string, draft string, bytes long, records long, sha256 string"))
    commit(manifest, folder)
    return manifest.drop("draft")


def commit(manifest: DataFrame, folder: str) -> None:
    """Give the drafts that the manifest names their final names, write the manifest, and remove what other attempts left. All of it may be repeated."""

    def rename(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target, base = _filesystem(folder)
        for batch in batches:
            for name, draft in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                info = target.get_file_info(f"{base}/{draft}")
                if info.is_file:  # else an earlier attempt of this task has moved it
                    target.move(f"{base}/{draft}", f"{base}/{name}")
                elif not target.get_file_info(f"{base}/{name}").is_file:
                    raise FileNotFoundError(f"{base}/{draft}")
            yield pa.RecordBatch.from_arrays([batch.column(0)], ["name"])

    manifest.select("name", "draft").mapInArrow(rename, "name string").count()
    target, base = _filesystem(folder)
    target.create_dir(base, recursive=True)
    from pyarrow.fs import FileSelector

    for info in target.get_file_info(FileSelector(base)):
        if info.base_name.endswith(".tmp"):
            target.delete_file(info.path)
    with target.open_output_stream(f"{base}/.manifest.tmp") as out:
        for r in manifest.orderBy("name").toLocalIterator():
            out.write((json.dumps({"name": r.name, "bytes": r.bytes, "records": r.records, "sha256": r.sha256}) + "\n").encode())
    target.move(f"{base}/.manifest.tmp", f"{base}/manifest.jsonl")


def read(spark: SparkSession, folder: str) -> DataFrame:
    """(page, payload_bytes, payload_digest, record_type, refers_to) of every record of the files that the manifest lists."""
    manifest = spark.read.schema("name string, bytes long, records long, sha256 string").json(f"{folder}/manifest.jsonl")
    names = ["page", "record", "payload_bytes", "payload_digest", "record_type", "refers_record"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target, base = _filesystem(folder)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                rows: list[tuple] = []

                def made() -> pa.RecordBatch:
                    kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string())
                    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names)

                with target.open_input_stream(f"{base}/{name}", compression=None) as stream:
                    for fields, payload in records(stream):
                        revisit = fields["warc-type"] == "revisit"
                        rows.append((int(fields["x-page"]), fields["warc-record-id"], None if revisit else len(payload), fields["warc-payload-digest"].removeprefix("sha1:"), fields["warc-type"], fields.get("warc-refers-to")))
                        if len(rows) >= 10_000:
                            yield made()
                            rows = []
                yield made()

    files = manifest.select("name").repartition(manifest.count() or 1, "name")
    found = materialize(files.mapInArrow(run, "page long, record string, payload_bytes long, payload_digest string, record_type string, refers_record string"))
    revisits = found.where("refers_record is not null")
    asked = revisits.select(F.col("refers_record").alias("to_record")).distinct()
    responses = found.where("refers_record is null").select(F.col("record").alias("to_record"), F.col("page").alias("to"), F.col("payload_bytes").alias("to_bytes"), F.col("payload_digest").alias("to_digest"))
    referred = materialize(responses.join(asked, "to_record", "left_semi"))
    joined = revisits.join(F.broadcast(referred) if referred.count() <= BROADCAST_IDS // 4 else referred, F.col("refers_record") == F.col("to_record"), "left")
    checked = F.when(F.col("to_digest") == F.col("payload_digest"), F.col("to_bytes")).otherwise(F.raise_error(F.concat(F.lit("nothing, or another payload, at "), "refers_record")).cast("long"))
    return found.where("refers_record is null").select("page", "payload_bytes", "payload_digest", "record_type", F.lit(None).cast("long").alias("refers_to")).unionByName(
        joined.select("page", checked.alias("payload_bytes"), "payload_digest", "record_type", F.col("to").alias("refers_to"))
    )


def archive(pages: DataFrame, id_col: str, url_col: str, html_col: str, folder: str | None = None) -> DataFrame:
    """Write pages and read the archives back: id_col, payload_bytes, payload_digest, record_type, refers_to, one row for each page.

    A null html is the empty payload; a null url becomes urn:page:<number>. Of equal payloads, the page of the largest id is the response. Null or
    repeated ids: records go by a row number in the order of ids (nulls first), and the ids are put back; one row of equal
    ids and payloads is the response. An empty table gives no rows; other columns are not read. Without a folder the archives go to one of their own
    in the shared folder, which is deleted once they are read back.
    """
    spark = pages.sparkSession
    key = fresh([id_col, url_col, html_col], "__key")
    numbered, same = keyed(pages.select(id_col, url_col, html_col), id_col, key, [url_col, html_col])
    own = folder or f"{checkpoint_dir(spark)}/warc-{uuid.uuid4().hex}"
    write(numbered, key, url_col, html_col, own)
    back = read(spark, own)
    if folder is None:
        back = materialize(back)
        remove(spark, own)
    if same:
        return back.withColumnRenamed("page", id_col)
    names = numbered.select(F.col(key).alias("page"), F.col(id_col).alias("__id"))
    return (
        back.join(names, "page")
        .join(names.select(F.col("page").alias("refers_to"), F.col("__id").alias("__to")), "refers_to", "left")
        .select(F.col("__id").alias(id_col), "payload_bytes", "payload_digest", "record_type", F.col("__to").alias("refers_to"))
    )


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query over all pages."""
    return archive(spark.read.parquet(f"{sf_dir}/pages.parquet"), "page_id", "url", "html")


OP10_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
h AS (SELECT *, sha1(html) AS hex, max(page_id) OVER (PARTITION BY html) AS first FROM p),
q AS (SELECT *, list_transform(range(0, 8), lambda i: ('0x' || substring(hex, (5 * i + 1)::INT, 5))::INT) AS v FROM h)
SELECT page_id, strlen(html)::BIGINT AS payload_bytes,
  array_to_string(list_transform(v, lambda x: array_to_string(list_transform([15, 10, 5, 0], lambda s: substring('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((x >> s) & 31) + 1, 1)), '')), '') AS payload_digest,
  CASE WHEN first = page_id THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN first <> page_id THEN first END AS refers_to
FROM q
"""
