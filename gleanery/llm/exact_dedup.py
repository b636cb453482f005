"""Exact de-duplication by a Golomb-coded fingerprint exchange (operator 2).

1. One pass over the texts makes a 64-bit fingerprint and a SHA-256 of each normalised text (A-Z lower-cased). The
   small rows (key, fingerprint, digest) are written to the shared folder. Their count says how many senders the tasks' rows are
   dealt to, and how many owners there are: about HELD rows each.
2. A sender sorts its distinct fingerprints by owner (the top bits) and sends each owner one Golomb-coded list; a text
   that it holds twice it knows itself. Owners decode, find the fingerprints that came from two senders or more, and
   return one bitmap to each sender, in the order of its list.
3. Rows with a set bit are suspects. Only their texts are read again and shuffled; grouping by the whole normalised
   text compares bytes. A group of copies is added up before the shuffle, so it costs a row for each task, not a row for each copy.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import golomb
from .common import buffer_of, fresh, groups_for, keyed, materialize, semi_by_key, slices, text_or_empty

_BITS = 63  # fingerprints are non-negative longs
#: Rows of a sender and fingerprints of an owner, about; a row takes some 60 bytes.
HELD = 2_000_000


def fingerprints(docs: DataFrame, key: str, text_col: str) -> DataFrame:
    """(part, key, fp, sha) of each row; part is the task that made it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        for batch in slices(batches, "text", 4_000_000):
            raw, offsets = buffer_of(batch.column(1))
            raw = raw.lower()  # bytes.lower() changes A-Z only
            cut = [raw[a:b] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([part] * len(cut), pa.int32()), batch.column(0), pa.array([xxhash.xxh3_64_intdigest(x) >> 1 for x in cut], pa.int64()), pa.array([hashlib.sha256(x).digest() for x in cut], pa.binary())],
                ["part", "key", "fp", "sha"],
            )

    rows = docs.select(F.col(key).alias("key"), text_or_empty(text_col).alias("text"))
    return rows.mapInArrow(run, "part int, key long, fp long, sha binary")


def _values(table: pa.Table, name: str) -> np.ndarray:
    return table[name].combine_chunks().to_numpy(zero_copy_only=False)


def exchange(rows: DataFrame, owners: int) -> DataFrame:
    """rows with a boolean `suspect`: their fingerprint occurs more than once in the table. part is the sender."""
    bits = max(1, (owners - 1).bit_length())
    shift = _BITS - bits

    def send(key: tuple, table: pa.Table) -> pa.Table:
        fp, n = np.unique(_values(table, "fp").astype(np.uint64), return_counts=True)
        owner = (fp >> np.uint64(shift)).astype(np.int64)
        cuts = np.concatenate(([0], np.flatnonzero(np.diff(owner)) + 1, [len(fp)]))
        out = []
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            data, width = golomb.encode(fp[a:b] & np.uint64((1 << shift) - 1), shift)
            out.append((int(owner[a]), key[0].as_py(), b - a, width, data, np.packbits(n[a:b] > 1).tobytes()))
        kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary())
        return pa.table([pa.array([o[i] for o in out], t) for i, t in enumerate(kinds)], names=["owner", "part", "n", "width", "data", "twice"])

    def own(_: tuple, table: pa.Table) -> pa.Table:
        lists = [golomb.decode(d, n, w) for d, n, w in zip(table["data"].to_pylist(), table["n"].to_pylist(), table["width"].to_pylist(), strict=True)]
        every = np.concatenate(lists)
        _, back, n = np.unique(every, return_inverse=True, return_counts=True)
        shared = (n > 1)[back]
        ends = np.cumsum([len(x) for x in lists])
        maps = []
        for twice, a, b in zip(table["twice"].to_pylist(), [0, *ends[:-1]], ends, strict=True):
            maps.append(np.packbits(shared[a:b] | np.unpackbits(np.frombuffer(twice, dtype=np.uint8), count=int(b - a)).astype(bool)).tobytes())
        return pa.table({"part": table["part"], "owner": table["owner"], "n": table["n"], "bitmap": pa.array(maps, pa.binary())})

    def mark(own_rows: pa.Table, maps: pa.Table) -> pa.Table:
        maps = maps.sort_by("owner")
        _, back = np.unique(_values(own_rows, "fp").astype(np.uint64), return_inverse=True)
        bit = np.concatenate([np.unpackbits(np.frombuffer(m, dtype=np.uint8), count=n) for m, n in zip(maps["bitmap"].to_pylist(), maps["n"].to_pylist(), strict=True)]).astype(bool)
        return own_rows.select(["key", "sha"]).append_column("suspect", pa.array(bit[back]))

    lists = rows.select("part", "fp").groupBy("part").applyInArrow(send, "owner int, part int, n long, width int, data binary, twice binary")
    maps = lists.groupBy("owner").applyInArrow(own, "part int, owner int, n long, bitmap binary")
    return rows.groupBy("part").cogroup(maps.groupBy("part")).applyInArrow(mark, "key long, sha binary, suspect boolean")


def groups(docs: DataFrame, key: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """(rows, copies): rows (key, sha, suspect) of every document; copies (sha, keep, n) of the texts that occur twice or more."""
    rows = materialize(fingerprints(docs, key, text_col))
    held = groups_for(docs, rows.count(), HELD)
    marked = materialize(exchange(rows.withColumn("part", F.pmod("part", F.lit(held))), owners=held))
    suspects = marked.where("suspect")
    n = suspects.count()
    # A-Z alone are folded: lower() where the text is ASCII, else letter by letter
    text = text_or_empty(text_col)
    folded = F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    )
    again = semi_by_key(docs.select(F.col(key).alias("key"), text.alias("text")), suspects, "key", n)
    verified = again.select("key", folded.alias("folded")).groupBy("folded").agg(F.max("key").alias("keep"), F.count("*").alias("n"))
    copies = verified.where("n > 1").select(F.unhex(F.sha2("folded", 256)).alias("sha"), "keep", "n")
    return marked, copies


def dedup(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row for each document: id_col, keep_id, group_size, kept, text_sha256.

    A null text is the empty text. Texts are equal when their bytes are after lower-casing A-Z; the row with the largest id stays. Null ids
    come before all others, and of rows that share id and text exactly one stays. An empty table gives no rows; other columns of docs
    are not read.
    """
    key = fresh([id_col, text_col], "__key")
    numbered, same = keyed(docs.select(id_col, text_col), id_col, key, [text_col])
    rows, copies = groups(numbered, key, text_col)
    # only suspects can have copies; the others need no shuffle
    paired = rows.where("suspect").join(copies, "sha", "left").select("key", "sha", "keep", "n")
    alone = rows.where("not suspect").select("key", "sha", F.lit(None).cast("long").alias("keep"), F.lit(None).cast("long").alias("n"))
    joined = paired.unionByName(alone).select(
        "key", F.coalesce("keep", "key").alias("keep"), F.coalesce("n", F.lit(1)).cast("long").alias("group_size"), F.lower(F.hex("sha")).alias("text_sha256")
    )
    if same:
        return joined.select(F.col("key").alias(id_col), F.col("keep").alias("keep_id"), "group_size", (F.col("key") == F.col("keep")).alias("kept"), "text_sha256")
    names = numbered.select(F.col(key).alias("key"), F.col(id_col).alias("id"))
    return (
        joined.join(names, "key")
        .join(names.select(F.col("key").alias("keep"), F.col("id").alias("keep_id")), "keep")
        .select(F.col("id").alias(id_col), "keep_id", "group_size", (F.col("key") == F.col("keep")).alias("kept"), "text_sha256")
    )


def keep_one(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The rows of docs that stay, with all their columns: of equal texts the one of the largest id."""
    key = fresh(docs.columns, "__key")
    numbered, _ = keyed(docs, id_col, key, [text_col])
    rows, copies = groups(numbered, key, text_col)
    dropped = materialize(rows.where("suspect").join(copies, "sha").where("key <> keep").select(F.col("key").alias(key)))
    return semi_by_key(numbered, dropped, key, dropped.count(), "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query over all documents."""
    return dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"), "doc_id", "text")


OP2_SQL = """
WITH t AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS folded FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept, sha256(folded) AS text_sha256
FROM t WINDOW w AS (PARTITION BY folded)
"""
