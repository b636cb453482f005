"""Helpers shared by the operators: row keys, checked broadcasts and Arrow batches."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of at most this many ids are broadcast (about 16 MB as a hashed relation); beyond it the join shuffles.
BROADCAST_IDS = 200_000

#: Text characters that a worker turns into numpy arrays at one time.
SLICE_CHARS = 500_000


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder that the cluster names; a folder of our own only where none is set (local tests)."""
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named is None and sc._jsc.sc().getCheckpointDir().isEmpty():
        import tempfile

        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="gleanery-checkpoint-"))
    elif sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(named)
    return sc._jsc.sc().getCheckpointDir().get()


def materialize(df: DataFrame) -> DataFrame:
    """Write df to the shared checkpoint folder and cut its lineage, so a lost executor costs no recomputation."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def fresh(columns: list[str], name: str) -> str:
    """name, with as many underscores before it as make it no column's name (case aside)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def keyed(docs: DataFrame, id_col: str, key: str, extra: list[str] | None = None) -> tuple[DataFrame, bool]:
    """docs with a unique non-null long column `key` that sorts as id_col does (nulls first), and whether it is the id.

    Unique ids of a whole-number type are the key themselves. Where an id is null or repeated, or of another type, the rows are range-sorted by id
    (ties by the hash of `extra` columns), numbered, and written to the shared folder, so that every later
    pass sees the same numbers. The check shuffles ids alone, added up in their tasks first.
    """
    if docs.schema[id_col].dataType.typeName() in ("byte", "short", "integer", "long"):
        ids = docs.select(F.col(id_col).cast("long").alias("i")).groupBy("i").agg(F.count("*").alias("n"))
        if not ids.where(F.col("i").isNull() | (F.col("n") > 1)).limit(1).collect():
            return docs.withColumn(key, F.col(id_col).cast("long")), True
    order = [F.col(id_col).asc_nulls_first(), F.xxhash64(*[F.col(c) for c in extra or [id_col]])]
    ranged = docs.repartitionByRange(partitions(docs), *order).sortWithinPartitions(*order)
    return materialize(ranged.withColumn(key, F.monotonically_increasing_id())), False


def groups_for(df: DataFrame, n: int, most: int) -> int:
    """How many groups n items are dealt into: as many as there are shuffle partitions, and no more than about `most` items in one."""
    return max(partitions(df), -(-n // most))


def size_of(df: DataFrame) -> int:
    """The optimizer's estimate of the bytes of df, from file sizes where it reads files."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def remove(spark: SparkSession, folder: str) -> None:
    """Delete a folder of the shared file system."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


#: Bits of the filter that keeps rows which surely lack a key from being shuffled: 16 for each key, within these bounds (16 MB).
LEAST_BITS, MOST_BITS = 1 << 15, 1 << 27


def may_have(rows: DataFrame, key: str, ids: DataFrame, id_key: str, n_ids: int, flag: str = "__may") -> DataFrame:
    """rows with a boolean `flag`: false only where the key is surely not among ids.

    Bits at the hashes of the ids are broadcast, MOST_BITS of them at most, however many ids there are; the more there are beyond that, the more rows pass.
    """
    bits = min(max(LEAST_BITS, 1 << (16 * n_ids).bit_length()), MOST_BITS)
    place = lambda c: F.pmod(F.xxhash64(c), F.lit(bits)) + 1
    at = ids.select(place(id_key).alias("p"))
    maps = at.groupBy(F.bitmap_bucket_number("p").alias("__bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("__bits"))  # 4 kB for each 2 ** 15 bits
    p = F.bitmap_bit_position(place(key))
    octet = F.conv(F.hex(F.substring("__bits", (p / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    near = rows.withColumn("__bucket", F.bitmap_bucket_number(place(key))).join(F.broadcast(maps), "__bucket", "left")
    return near.withColumn(flag, F.coalesce(F.getbit(octet.cast("long"), F.pmod(p, F.lit(8)).cast("int")) == 1, F.lit(False))).drop("__bucket", "__bits")


def semi_by_key(rows: DataFrame, ids: DataFrame, key: str, n_ids: int, how: str = "left_semi") -> DataFrame:
    """rows whose key is (left_semi) or is not (left_anti) among ids. Ids are broadcast only if their counted size is small; beyond that, rows that surely aren't
    among them are told apart by a filter, and only the others are shuffled."""
    ids = ids.select(key)
    if n_ids <= BROADCAST_IDS:
        return rows.join(F.broadcast(ids), key, how)
    marked = may_have(rows, key, ids, key, n_ids)
    near = marked.where("__may").drop("__may").join(ids, key, how)
    return near if how == "left_semi" else near.select(*[F.col(f"`{c}`") for c in rows.columns]).union(marked.where("not __may").drop("__may").select(*[F.col(f"`{c}`") for c in rows.columns]))


def text_or_empty(col: str) -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


_BETWEEN_WORDS = re.compile(r"(?<=[A-Za-z0-9]) (?=[A-Za-z0-9])")


def windows(text: str, most: int = SLICE_CHARS) -> list[str]:
    """The text in pieces of about `most` characters, cut before a blank between two ASCII letters or digits, where no word or pre-token goes on. A stretch
    without such a blank stays whole."""
    out, start = [], 0
    while len(text) - start > most:
        found = _BETWEEN_WORDS.search(text, start + most)
        if not found:
            break
        out.append(text[start : found.start()])
        start = found.start()
    return [*out, text[start:]]


def pieces(texts: list[str], most: int = SLICE_CHARS) -> Iterator[tuple[list[int], list[str]]]:
    """The windows of all texts in groups of about `most` characters, with the place of each one's text."""
    rows: list[int] = []
    group: list[str] = []
    size = 0
    for i, text in enumerate(texts):
        for piece in windows(text, most) if len(text) > most else [text]:
            if size and size + len(piece) > most:
                yield rows, group
                rows, group, size = [], [], 0
            rows.append(i)
            group.append(piece)
            size += len(piece)
    if group:
        yield rows, group


def slices(batches: Iterator[pa.RecordBatch], column: str, chars: int = SLICE_CHARS) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches into pieces of about `chars` bytes of text (one long text stays whole)."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        at = batch.schema.get_field_index(column)
        array = batch.column(at)
        if pa.types.is_string(array.type) or pa.types.is_binary(array.type):
            array = array.cast(pa.large_string() if pa.types.is_string(array.type) else pa.large_binary())
        import numpy as np

        offsets = np.frombuffer(array.buffers()[1], dtype=np.int64)[array.offset : array.offset + n + 1]
        start = 0
        while start < n:
            end = int(np.searchsorted(offsets, offsets[start] + chars, side="right")) - 1
            end = min(n, max(end, start + 1))
            yield batch.slice(start, end - start)
            start = end
        pa.default_memory_pool().release_unused()  # else a worker keeps the largest batch's memory for the tasks to come


def buffer_of(array: pa.Array) -> tuple[bytes, "np.ndarray"]:  # noqa: F821
    """The UTF-8 bytes of a string array (nulls empty) and its row offsets from 0."""
    import numpy as np

    large = array.cast(pa.large_string()) if not pa.types.is_large_string(array.type) else array
    if large.null_count:
        large = large.fill_null("")
    offsets = np.frombuffer(large.buffers()[1], dtype=np.int64)[large.offset : large.offset + len(large) + 1]
    data = large.buffers()[2]
    raw = data.slice(int(offsets[0]), int(offsets[-1] - offsets[0])).to_pybytes() if data is not None else b""
    return raw, (offsets - offsets[0]).astype(np.int64)
