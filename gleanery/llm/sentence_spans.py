"""Substring de-duplication by sliding sentence spans (operator 5).

A text is a list of sentences (a sentence over LONG words is cut at words whose hash ends in two zero bits, so that
two places with the same words are cut alike). From every sentence the shortest run of SENTENCES sentences or more with
WORDS words or more is hashed, forwards and backwards, so each sentence of a longer repeated passage lies in a run.

A run's first occurrence is the one of the least (document, place). Each task finds the first of each hash among its own rows;
the others it knows to be repeats. It sends one entry for each hash to the hash's owner, who finds the first of all tasks:
the rest are repeats too. So a passage that very many documents share costs its owner an entry for each task. Repeats are
brought together for each document, and the sentences that they cover are cut out of its text.

Runs are told apart by 96 bits, two hashes of independent bases: among n runs some two different ones agree with a chance of about n * n / 2 ** 97.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from .common import buffer_of, fresh, keyed, materialize, may_have, partitions, size_of, slices, text_or_empty
from .wordhash import BASE_B, U, per_row, range_hash, words

SENTENCES, WORDS, LONG = 3, 20, 10

_END = np.zeros(256, dtype=bool)
_END[list(b".!?")] = True
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, *range(9, 14)]] = True
#: An entry of a message: hash (8 and 4 bytes), document, first byte, bytes.
_ENTRY = np.dtype([("hash", "<u8"), ("more", "<u4"), ("key", "<i8"), ("start", "<u4"), ("size", "<u4")])
#: Bytes of text whose runs one owner gets, about, and owners at most.
_OWNED, _MOST_OWNERS = 32 << 20, 1 << 16
#: Runs that a task holds before it sends them on.
_HELD = 750_000


def sentences(raw: bytes, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First word of each sentence (with the number of words at the end), row of each, word starts, word hashes."""
    starts, ends, row, hashes = words(raw, offsets)
    if not len(starts):
        z = np.zeros(0, dtype=np.int64)
        return np.zeros(1, dtype=np.int64), z, z, hashes
    data = np.frombuffer(raw, dtype=np.uint8)
    stop = data == 10
    stop[:-1] |= _END[data[:-1]] & _SPACE[data[1:]]
    total = np.concatenate(([0], np.cumsum(stop)))
    first = np.ones(len(starts), dtype=bool)
    first[1:] = (total[starts[1:]] > total[ends[:-1]]) | (row[1:] != row[:-1])
    size = np.diff(np.append(np.flatnonzero(first), len(first)))
    long = np.repeat(size > LONG, size)
    first[1:] |= long[1:] & long[:-1] & ((hashes[:-1] & U(3)) == 0)
    begin = np.flatnonzero(first)
    return np.append(begin, len(starts)), row[begin], starts, hashes


def span_runs(raw: bytes, offsets: np.ndarray, least_words: int, least_sentences: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, second hash, row, first byte and end byte (within the row) of each run."""
    begin, row, word_start, hashes = sentences(raw, offsets)
    n, rows = len(row), len(offsets) - 1
    at = per_row(row, rows)
    if not n:
        z = np.zeros(0, dtype=np.int64)
        return np.zeros(0, dtype=U), np.zeros(0, dtype=np.uint32), z, z, z
    low, high = at[row], at[row + 1]  # sentences of each one's row
    i = np.arange(n)
    last = np.maximum(i + least_sentences - 1, np.searchsorted(begin, begin[:-1] + least_words, side="left") - 1)
    ahead = last < high
    opening = np.minimum(i - least_sentences + 1, np.searchsorted(begin, begin[1:] - least_words, side="right") - 1)
    behind = opening >= low
    pair = np.unique(np.concatenate((i[ahead] * (n + 1) + last[ahead], opening[behind] * (n + 1) + i[behind])))
    a, b = pair // (n + 1), pair % (n + 1)
    r = row[a]
    finish = np.append(word_start, offsets[-1])[begin[b + 1]]
    finish = np.where(b + 1 == at[r + 1], offsets[r + 1], finish)
    more = (range_hash(hashes, begin[a], begin[b + 1], BASE_B) >> U(32)).astype(np.uint32)
    return range_hash(hashes, begin[a], begin[b + 1]), more, r, word_start[begin[a]] - offsets[r], finish - offsets[r]


def _firsts(entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entries in order of (hash, key, start), and which of them come first of their hash."""
    order = np.argsort(entries["hash"])
    same = entries["hash"][order][1:] == entries["hash"][order][:-1]
    again = np.flatnonzero(np.concatenate((same, [False])) | np.concatenate(([False], same)))  # only these need the other fields
    few = entries[order[again]]
    order[again] = order[again][np.lexsort((few["start"], few["key"], few["more"], few["hash"]))]
    entries = entries[order]
    first = np.ones(len(entries), dtype=bool)
    first[1:] = (entries["hash"][1:] != entries["hash"][:-1]) | (entries["more"][1:] != entries["more"][:-1])
    return entries, first


def _known(entries: np.ndarray) -> np.ndarray:
    """The spans of entries, joined, as entries without a hash."""
    k, s, e = _spans(entries["key"], entries["start"], entries["start"].astype(np.int64) + entries["size"])
    known = np.zeros(len(k), dtype=_ENTRY)
    known["key"], known["start"], known["size"] = k, s, e - s
    return known


def _by(entries: np.ndarray, group: np.ndarray) -> Iterator[tuple[int, bytes]]:
    order = np.argsort(group, kind="stable")
    cuts = np.concatenate(([0], np.flatnonzero(np.diff(group[order])) + 1, [len(order)]))
    for x, y in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        if y > x:
            yield int(group[order[x]]), _pack(entries[order[x:y]])


def _pack(entries: np.ndarray) -> bytes:
    """Entries byte plane by byte plane, so that the shuffle's compression finds the planes of zeros."""
    return np.ascontiguousarray(entries.view(np.uint8).reshape(-1, _ENTRY.itemsize).T).tobytes()


def _unpack(blobs: pd.Series) -> np.ndarray:
    parts = [np.frombuffer(b, dtype=np.uint8).reshape(_ENTRY.itemsize, -1).T for b in blobs]
    return np.ascontiguousarray(np.concatenate(parts)).view(_ENTRY).ravel()


def _spans(key: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Overlapping or touching spans of the same key joined."""
    order = np.lexsort((start, key))
    key, start, end = key[order], start[order].astype(np.int64), end[order].astype(np.int64)
    if not len(key):
        return key, start, end
    fresh = np.ones(len(key), dtype=bool)
    fresh[1:] = key[1:] != key[:-1]
    group = np.cumsum(fresh) - 1
    reach = np.maximum.accumulate(end + group * (1 << 33)) - group * (1 << 33)
    new = fresh.copy()
    new[1:] |= start[1:] > reach[:-1]
    at = np.flatnonzero(new)
    return key[at], start[at], np.maximum.reduceat(end, at)


def repeated_spans(docs: DataFrame, key: str, text_col: str, least_words: int = WORDS, least_sentences: int = SENTENCES) -> DataFrame:
    """(key, starts, ends): byte spans of each document that repeats cover, joined; documents without any have no row."""
    owners = max(4 * partitions(docs), min(size_of(docs) // _OWNED, _MOST_OWNERS))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def flush() -> pa.RecordBatch:
            entries, first = _firsts(np.concatenate(held))
            known, mine = _known(entries[~first]), entries[first]
            out = [*_by(mine, (mine["hash"] % U(owners)).astype(np.int64)), *((-1 - g, d) for g, d in _by(known, known["key"] % owners))]
            return pa.RecordBatch.from_arrays([pa.array([g for g, _ in out], pa.int64()), pa.array([d for _, d in out], pa.binary())], ["owner", "data"])

        n = 0
        for batch in slices(batches, "text"):
            raw, offsets = buffer_of(batch.column(1))
            h, more, r, s, e = span_runs(raw, offsets, least_words, least_sentences)
            entries = np.zeros(len(h), dtype=_ENTRY)
            entries["hash"], entries["more"], entries["key"], entries["start"], entries["size"] = h, more, np.asarray(batch.column(0))[r], s, e - s
            held.append(entries)
            n += len(h)
            if n >= _HELD:
                yield flush()
                held, n = [], 0
        if n:
            yield flush()

    def own(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        entries = _unpack(pdf["data"])
        if key[0] >= 0:
            entries, first = _firsts(entries)
            entries = entries[~first]
        known = _known(entries)
        out = list(_by(known, known["key"] % owners))
        return pd.DataFrame({"place": [g for g, _ in out], "data": [d for _, d in out]}).astype({"place": "int64"})

    def bring(_: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        known = _known(_unpack(pdf["data"]))
        k, s, e = known["key"], known["start"].astype(np.int64), known["start"].astype(np.int64) + known["size"]
        cuts = np.concatenate(([0], np.flatnonzero(np.diff(k)) + 1, [len(k)]))
        pairs = list(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)) if len(k) else []
        return pd.DataFrame({"key": k[cuts[:-1]] if len(k) else k, "starts": [s[x:y] for x, y in pairs], "ends": [e[x:y] for x, y in pairs]})

    rows = docs.select(F.col(key).alias("key"), text_or_empty(text_col).alias("text"))
    sent = rows.mapInArrow(send, "owner long, data binary")
    repeats = sent.groupBy("owner").applyInPandas(own, "place long, data binary")
    return repeats.groupBy("place").applyInPandas(bring, "key long, starts array<long>, ends array<long>")


def with_spans(docs: DataFrame, key: str, spans: DataFrame) -> DataFrame:
    """docs with starts and ends of their spans (null without any). Documents that surely have none, by a filter of bounded size, aren't shuffled."""
    marked = may_have(docs, key, spans, "key", spans.count())
    own = spans.select(F.col("key").alias("__span_key"), F.col("starts").alias("__starts"), F.col("ends").alias("__ends"))
    joined = marked.where("__may").drop("__may").join(own, F.col(key) == F.col("__span_key"), "left").drop("__span_key")
    none = F.lit(None).cast("array<long>")
    return joined.union(marked.where("not __may").drop("__may").withColumn("__starts", none).withColumn("__ends", none))


def cut(docs: DataFrame, key: str, text_col: str, spans: DataFrame, removed: str = "n_removed") -> DataFrame:
    """docs with the spans cut out of text_col, and the bytes cut in the column `removed` (0 for documents without spans)."""
    rest = [c for c in docs.columns if c != text_col]
    joined = with_spans(docs, key, spans).select(F.struct(*[F.col(f"`{c}`") for c in rest]).alias("__rest"), F.col(f"`{text_col}`").cast("string").alias("__text"), "__starts", "__ends")
    names = ["__rest", "__text", "__removed"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "__text"):
            column, starts, ends = batch.column(1), batch.column(2), batch.column(3)
            n_cut = np.zeros(batch.num_rows, dtype=np.int64)
            if starts.null_count < batch.num_rows:
                texts = column.to_pylist()
                for i, (s, e) in enumerate(zip(starts.to_pylist(), ends.to_pylist(), strict=True)):
                    if s:
                        raw = texts[i].encode()
                        texts[i] = b"".join(raw[x:y] for x, y in zip([0, *e], [*s, len(raw)], strict=True)).decode()
                        n_cut[i] = sum(e) - sum(s)
                column = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), column.cast(pa.string()), pa.array(n_cut)], names)

    out = joined.mapInArrow(run, StructType([joined.schema["__rest"], StructField("__text", StringType()), StructField("__removed", LongType())]))
    columns = [F.col("__text").alias(c) if c == text_col else F.col("__rest").getField(c).alias(c) for c in docs.columns]
    return out.select(*columns, F.col("__removed").alias(removed))


def dedup_spans(docs: DataFrame, id_col: str, text_col: str, removed: str = "n_removed") -> DataFrame:
    """docs, all rows and columns, with repeated spans cut out of text_col, and the bytes cut in the column `removed`.

    The first occurrence, by (id, place), stays. A null text stays null, a text without words as it is; a text that is all repeats becomes empty
    (exact copies but the first). Where ids are null or repeated, rows are told apart by a number in the order of ids (nulls first). An empty
    table gives no rows. A column of docs that is called as `removed` is replaced.
    """
    docs = docs.drop(removed)
    key = fresh(docs.columns, "__key")
    numbered, _ = keyed(docs, id_col, key, [text_col])
    spans = materialize(repeated_spans(numbered, key, text_col))
    return cut(numbered, key, text_col, spans, removed).drop(key)


def op5_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with their repeated spans cut out: doc_id, n_removed (bytes), text."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return dedup_spans(docs, "doc_id", "text").select("doc_id", "n_removed", "text")
