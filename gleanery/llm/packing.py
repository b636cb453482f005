"""Best-fit-decreasing packing of tokenized documents into fixed-length sequences (operator 7).

Documents are cut into pieces of at most `capacity` tokens. Only the number of pieces of each length matters for
best-fit decreasing, and there are at most `capacity` lengths, so the driver packs the histogram: bins of equal
remaining capacity are kept as counted classes under a segment tree over capacities, which finds the tightest class
with room in logarithmic time. The plan is a small table of segments ("the pieces of length L with ranks a to b go into
bins from c on, k to a bin"). Pieces then get their rank within their length by prefix sums over partitions and
look their place up; no group of pieces ever meets in one task.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .bpe import vocabulary
from .common import materialize, slices, text_or_empty
from .pretokens import Encoder

CAPACITY = 4096

_encoders: dict[str, Encoder] = {}


class TightestFit:
    """A segment tree over remaining capacities 0..capacity; each leaf says whether an open class has it."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.tree = bytearray(2 * self.size)

    def mark(self, remaining: int, open_: bool) -> None:
        i = self.size + remaining
        self.tree[i] = open_
        i >>= 1
        while i:
            self.tree[i] = self.tree[2 * i] | self.tree[2 * i + 1]
            i >>= 1

    def find(self, least: int) -> int:
        """The smallest remaining capacity of at least `least` that is open, or -1."""
        i = self.size + least
        if self.tree[i]:
            return least
        while i > 1:
            if not i & 1 and self.tree[i + 1]:
                i += 1
                while i < self.size:
                    i = 2 * i if self.tree[2 * i] else 2 * i + 1
                return i - self.size
            i >>= 1
        return -1


def best_fit_plan(histogram: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Segments (length, first rank, pieces, first bin, pieces a bin, offset in the bin) of best-fit decreasing.

    Bins are numbered so that a class of bins in equal state is a list of ranges; a class that takes only part of
    its pieces splits in two. A length adds two ranges at most, and a segment for each range that it uses up, however many pieces it has: the plan's
    size follows from `capacity`, not from the corpus.
    """
    tree = TightestFit(capacity)
    open_: dict[int, list[tuple[int, int]]] = {}  # remaining capacity -> ranges (first bin, bins)
    out, bins = [], 0

    def put(remaining: int, first: int, n: int) -> None:
        if remaining and n:
            if remaining not in open_:
                open_[remaining] = []
                tree.mark(remaining, True)
            open_[remaining].append((first, n))

    def take(remaining: int) -> tuple[int, int]:
        ranges = open_[remaining]
        got = ranges.pop()
        if not ranges:
            del open_[remaining]
            tree.mark(remaining, False)
        return got

    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        while left:
            room = tree.find(length)
            if room < 0:
                each = capacity // length
                first, n, used = bins, -(-left // each), 0
                bins += n
                room = capacity
            else:
                each = room // length
                first, n = take(room)
                used = capacity - room
            full = min(n, left // each)
            if full:
                out.append((length, rank, full * each, first, each, used))
                put(room - each * length, first, full)
                rank, left = rank + full * each, left - full * each
            if left and full < n:  # one bin takes fewer
                out.append((length, rank, left, first + full, left, used))
                put(room - left * length, first + full, 1)
                rank, left, full = rank + left, 0, full + 1
            put(room if used else 0, first + full, n - full)
    return out


def tokenize_pieces(docs: DataFrame, id_col: str, text_col: str, path: str, end_id: int, capacity: int) -> DataFrame:
    """Pieces (id, piece, start, length, ids_crc32, part, nth): nth counts the pieces of a length within a task's part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoders.setdefault(path, Encoder(vocabulary(path, words=True)))
        part, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, dtype=np.int64)
        for batch in slices(batches, "text"):
            ids, offsets = encoder.encode(batch.column(1).to_pylist())
            row, piece, start, length, crc = [], [], [], [], []
            for r, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
                whole = np.append(ids[a:b], np.uint32(end_id)).astype("<u4")
                for k, s in enumerate(range(0, len(whole), capacity)):
                    own = whole[s : s + capacity]
                    row.append(r)
                    piece.append(k)
                    start.append(s)
                    length.append(len(own))
                    crc.append(zlib.crc32(own.tobytes()))
            size = np.array(length, dtype=np.int64)
            nth = np.empty(len(size), dtype=np.int64)
            order = np.argsort(size, kind="stable")
            first = np.concatenate(([0], np.flatnonzero(np.diff(size[order])) + 1))
            n = np.diff(np.append(first, len(size)))
            nth[order] = np.arange(len(size)) - np.repeat(first, n) + seen[size[order]]
            seen[size[order][first]] += n
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(size), pa.array(crc, pa.int64()), pa.array([part] * len(row), pa.int32()), pa.array(nth)],
                ["doc_id", "piece", "start", "length", "ids_crc32", "part", "nth"],
            )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long, part int, nth long")


def pack(docs: DataFrame, id_col: str, text_col: str, path: str, end_id: int = 1, capacity: int = CAPACITY) -> DataFrame:
    """One row for each piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A null text is empty and makes one piece of the end id alone; a null or repeated id packs like any other row (its
    pieces are told apart by their place only); an empty table gives no rows; other columns of docs are not read.
    """
    pieces = materialize(tokenize_pieces(docs, id_col, text_col, path, end_id, capacity))
    counts = pieces.groupBy("length", "part").agg(F.count("*").alias("n"))
    histogram = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most `capacity` rows
    plan = best_fit_plan(histogram, capacity)
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    ranked = pieces.join(bases, ["length", "part"]).withColumn("rank", F.col("base") + F.col("nth"))
    # plan sorted by (length, rank); both fit in one 64-bit key while ranks stay below 2**48
    ordered = sorted(plan)
    table = {k: np.array([s[i] for s in ordered], dtype=np.int64) for i, k in enumerate(("length", "rank", "n", "bin", "each", "used"))}
    shared = docs.sparkSession.sparkContext.broadcast(table)  # at most a few rows for each of `capacity` lengths and open classes

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = shared.value
        key = t["length"] << 48 | t["rank"]
        for batch in batches:
            col = {k: batch.column(i) for i, k in enumerate(batch.schema.names)}
            length, rank = np.asarray(col["length"]), np.asarray(col["rank"])
            at = np.searchsorted(key, length << 48 | rank, side="right") - 1
            nth = rank - t["rank"][at]
            sequence = t["bin"][at] + nth // t["each"][at]
            offset = t["used"][at] + nth % t["each"][at] * length
            yield pa.RecordBatch.from_arrays(
                [*(col[k] for k in ("doc_id", "piece", "start", "length", "ids_crc32")), pa.array(sequence), pa.array(offset)],
                ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    return ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "rank").mapInArrow(
        place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    )


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: all documents in sequences of at most 4096 tokens."""
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return pack(docs, "doc_id", "text", public_tokenizers.path("word_bpe_49k.json"))
