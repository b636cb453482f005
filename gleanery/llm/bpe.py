"""BPE encoding and decoding through a lexicon of the corpus's frequent words (operator 1).

Two passes. The first counts the pre-tokens of every text; the most frequent become a minimal acyclic transducer
whose outputs are their token ids (see lexicon.py). The file goes to the shared folder and from there, by
SparkContext.addFile, to each executor, whose workers map it into memory. The second pass cuts texts into pre-tokens,
looks each distinct one up in the automaton and merges those it doesn't hold exactly by the tokenizer's merge table.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from .common import checkpoint_dir, materialize, pieces, slices, text_or_empty
from .lexicon import Lexicon, compile_lexicon
from .pretokens import Encoder, Vocabulary, gather
from .wordhash import range_hash

#: Words of the lexicon at most (about 5 MB of file); the rest is merged, with the same ids.
LEXICON_WORDS = 65_536

_vocabularies: dict[str, Vocabulary] = {}
_encoders: dict[tuple, Encoder] = {}


def vocabulary(path: str, words: bool = False) -> Vocabulary:
    if path not in _vocabularies:
        _vocabularies[path] = Vocabulary(path, words)
    return _vocabularies[path]


def write_shared(spark: SparkSession, name: str, data: bytes) -> str:
    """Write a file to the shared folder by Hadoop's file system, whatever its scheme; temporary name, then rename."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    final = jvm.org.apache.hadoop.fs.Path(f"{checkpoint_dir(spark)}/{name}")
    fs = final.getFileSystem(conf)
    if not fs.exists(final):
        draft = jvm.org.apache.hadoop.fs.Path(f"{final.toString()}.{jvm.java.util.UUID.randomUUID().toString()}.tmp")
        out = fs.create(draft, True)
        out.write(data)
        out.close()
        if not fs.rename(draft, final) and not fs.exists(final):
            raise OSError(f"can't write {final.toString()}")
    return final.toString()


def count_words(docs: DataFrame, text_col: str, path: str) -> DataFrame:
    """(word, n) over all whole texts; each task adds its words up before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoders.setdefault(("count", path), Encoder(vocabulary(path)))
        seen: Counter[bytes] = Counter()
        held = 0  # characters in seen: words without blanks between them can be long

        for batch in slices(batches, "text"):
            for _, group in pieces(batch.column(0).to_pylist()):
                _, points, starts, ends, _ = encoder.segmented(group)
                if not len(starts):
                    continue
                _, first, n = np.unique(range_hash(points, starts, ends), return_index=True, return_counts=True)
                chars = points.astype("<u4").tobytes()
                for a, b, k in zip(starts[first].tolist(), ends[first].tolist(), n.tolist(), strict=True):
                    word = chars[4 * a : 4 * b]  # UTF-32
                    held += 0 if word in seen else b - a
                    seen[word] += k
                if len(seen) > 1_000_000 or held > 20_000_000:
                    yield _word_rows(seen)
                    seen.clear()
                    held = 0
        yield _word_rows(seen)

    return docs.select(text_or_empty(text_col).alias("text")).mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _word_rows(seen: Counter) -> pa.RecordBatch:
    words = [w.decode("utf-32-le", "surrogatepass") for w in seen]
    return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(list(seen.values()), pa.int64())], ["word", "n"])


def build_lexicon(docs: DataFrame, text_col: str, path: str, most: int = LEXICON_WORDS, least: int = 4) -> str:
    """Name under which executors find the compiled file: the most frequent words, `most` of them at most, that occur `least` times or more.

    A histogram of the counts (a few hundred rows) gives the count from which on at most `most` words qualify; only those
    words reach the driver.
    """
    spark = docs.sparkSession
    counts = materialize(count_words(docs, text_col, path).where(F.col("n") >= least))
    size = F.floor(F.log2("n") * 16)
    total, from_ = 0, None
    for r in counts.groupBy(size.alias("size")).agg(F.count("*").alias("words"), F.min("n").alias("n")).orderBy(F.desc("size")).collect():
        total += r.words
        if total > most:
            break
        from_ = r.n
    found = counts.where(F.col("n") >= from_).select("word").toArrow()["word"].to_pylist() if from_ else []
    v = vocabulary(path)
    data = compile_lexicon({w.encode(): v.merge(w) for w in found})
    name = f"lexicon-{hashlib.sha256(data).hexdigest()[:24]}.bin"
    spark.sparkContext.addFile(write_shared(spark, name, data))
    return name


def _encoder(path: str, name: str) -> Encoder:
    if (path, name) not in _encoders:
        lexicon, v = Lexicon(SparkFiles.get(name)), vocabulary(path)

        def resolve(words: list[str]) -> list[list[int]]:
            at = lexicon.numbers([w.encode() for w in words]).tolist()
            return [lexicon.ids_of(i) if i >= 0 else v.merge(w) for i, w in zip(at, words, strict=True)]

        _encoders[path, name] = Encoder(v, resolve)
    return _encoders[path, name]


def encode(docs: DataFrame, text_col: str, path: str, ids_col: str = "ids", lexicon: str | None = None) -> DataFrame:
    """docs with ids_col, an array of token ids of the whole text (null text: empty), exactly as the tokenizers library encodes it.

    The other columns pass through untouched, whatever their names; texts that hold a special token's string get its id,
    as in the library. An empty text gives an empty array.
    """
    name = lexicon or build_lexicon(docs, text_col, path)
    rest = [c for c in docs.columns if c != ids_col]
    n = len(rest)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path, name)
        for batch in slices(batches, "__text__"):
            ids, offsets = encoder.encode(batch.column(n).to_pylist())
            made = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids.astype(np.int32), pa.int32()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:n], made], names=out.names)

    kept = docs.select(*[F.col(f"`{c}`") for c in rest], text_or_empty(text_col).alias("__text__"))
    fields = [f for f in kept.schema.fields[:n]]
    out = StructType([*fields, StructField(ids_col, ArrayType(IntegerType()))])
    return kept.mapInArrow(run, out)


def decode(encoded: DataFrame, ids_col: str, path: str, text_col: str = "decoded") -> DataFrame:
    """encoded with text_col, the text of its ids (null ids: empty); bytes that are no UTF-8 become U+FFFD, special tokens stay."""
    rest = [c for c in encoded.columns if c not in (text_col, ids_col)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = vocabulary(path).id_bytes
        flat = np.frombuffer(b"".join(pieces), dtype=np.uint8)
        size = np.array([len(p) for p in pieces], dtype=np.int64)
        begin = np.concatenate(([0], np.cumsum(size)[:-1]))
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                column = part.column(len(rest))
                lists = column if not column.null_count else pa.array([x or [] for x in column.to_pylist()], column.type)
                offsets = np.asarray(lists.offsets, dtype=np.int64)
                ids = np.asarray(lists.values)[offsets[0] : offsets[-1]]
                raw = gather(flat, begin[ids], size[ids]).tobytes()
                ends = np.concatenate(([0], np.cumsum(size[ids])))[offsets - offsets[0]].tolist()
                texts = [raw[a:b].decode("utf-8", "replace") for a, b in zip(ends, ends[1:], strict=False)]
                yield pa.RecordBatch.from_arrays([*part.columns[: len(rest)], column, pa.array(texts, pa.string())], names=out.names)

    kept = encoded.select(*[F.col(f"`{c}`") for c in rest], F.col(f"`{ids_col}`"))
    out = StructType([*kept.schema.fields, StructField(text_col, StringType())])
    return kept.mapInArrow(run, out)


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: digests of the ids and of the decoded text of every document."""
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    coded = encode(docs, "text", path).drop("text")
    return decode(coded, "ids", path).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )
