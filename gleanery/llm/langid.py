"""Language identification by multinomial naive Bayes over hashed character n-grams (operator 8)."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SLICE_CHARS, materialize, slices

#: Languages in order and log probabilities (buckets x languages).
Model = tuple[list[str], np.ndarray]

#: Hashed features; with a few dozen languages the broadcast matrix stays below 20 MB.
BUCKETS = 1 << 15
ORDERS = (1, 2, 3)
#: Texts that the model is fitted on, at most, for each language; the rest of the labelled rows isn't needed.
TRAIN_TEXTS = 4_000
#: Languages of a block of the matrix at most (20 MB); more languages make more blocks, each broadcast and scored on its own.
MOST_LANGUAGES = 150
#: Languages whose log probabilities are multiplied at one time.
_COLUMNS = 8
#: Texts of a group at most, so that place and bucket fit in 4 bytes.
_GROUP = 1 << 16
#: n-grams beyond which more text doesn't sharpen the score.
EVIDENCE = 50.0


def _points(lower: list[str]) -> tuple[np.ndarray, np.ndarray]:
    flat = np.frombuffer("".join(lower).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    return flat, np.concatenate(([0], np.cumsum([len(t) for t in lower]))).astype(np.int64)


def _letters(flat: np.ndarray) -> np.ndarray:
    """A to z and characters beyond ASCII count as letters here; all others become blanks."""
    return (flat - np.uint32(97) < 26) | (flat >= 0xAA)


def has_letter(text: str | None) -> bool:
    if not text:
        return False
    return any(c.isalpha() for c in text[:200]) or any(map(str.isalpha, text))


def features(flat: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each order: the bucket of the n-gram that ends at each character, and whether it counts (inside a row, with a letter)."""
    letter = _letters(flat)
    code = np.where(letter, flat, 32).astype(np.uint32)
    first = np.zeros(len(flat), dtype=np.int64)
    starts = offsets[:-1][np.diff(offsets) > 0]
    first[starts] = starts
    np.maximum.accumulate(first, out=first)
    position = np.arange(len(flat)) - first
    gram, some = np.zeros(len(flat), dtype=np.uint32), np.zeros(len(flat), dtype=bool)
    for order in range(1, max(ORDERS) + 1):
        lag = order - 1
        gram[lag:] += (code[: len(code) - lag] + np.uint32(1)) * np.uint32(pow(0x9E3779B1, order, 1 << 32))
        some[lag:] |= letter[: len(code) - lag]
        if order in ORDERS:
            h = (gram ^ np.uint32(order * 0x85EBCA6B & 0xFFFFFFFF)) * np.uint32(0xC2B2AE35)
            yield ((h ^ (h >> np.uint32(15))) & np.uint32(BUCKETS - 1)), some & (position >= lag)


def count(texts: list[str]) -> np.ndarray:
    """Counts of all buckets over these texts."""
    _, bucket, n = gram_counts(texts)
    return np.bincount(bucket, weights=n, minlength=BUCKETS).astype(np.int64)


def fit(counts: dict[str, np.ndarray], alpha: float = 0.5) -> tuple[list[str], np.ndarray]:
    """Languages in order and log probabilities (buckets x languages)."""
    langs = sorted(counts)
    if not langs:
        return [], np.zeros((BUCKETS, 0), dtype=np.float32)
    table = np.stack([counts[k] for k in langs], axis=1).astype(np.float64) + alpha
    return langs, np.log(table / table.sum(axis=0)).astype(np.float32)


def score(texts: list[str], langs: list[str], log_p: np.ndarray) -> tuple[list[str], np.ndarray]:
    """Most likely language of each text and its posterior probability (uniform prior, evidence of EVIDENCE n-grams at most)."""
    return score_blocks(texts, [(langs, log_p)])


def _stretches(texts: list[str]) -> Iterator[tuple[list[int], list[int], list[str]]]:
    """Lower-case texts in stretches of about SLICE_CHARS characters, in groups as long: the place of each one's text, and how many characters it repeats
    of the stretch before, so that n-grams across the cut are there once."""
    rows: list[int] = []
    skips: list[int] = []
    group: list[str] = []
    size = 0
    for i, text in enumerate(texts):
        low = text.lower()
        for start in range(0, len(low), SLICE_CHARS):
            skip = min(start, max(ORDERS) - 1)
            if size >= SLICE_CHARS or len(rows) >= _GROUP:
                yield rows, skips, group
                rows, skips, group, size = [], [], [], 0
            rows.append(i)
            skips.append(skip)
            group.append(low[start - skip : start + SLICE_CHARS])
            size += len(group[-1])
    if group:
        yield rows, skips, group


def gram_counts(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sparse counts of texts: row, bucket and count of each distinct (row, bucket), sorted."""
    keys, counts = [np.zeros(0, dtype=np.uint64)], [np.zeros(0, dtype=np.int64)]
    for rows, skips, group in _stretches(texts):
        flat, offsets = _points(group)
        # places within the group take part in the sort, whose keys have 4 bytes so
        place = np.repeat(np.arange(len(group), dtype=np.uint32) * np.uint32(BUCKETS), np.diff(offsets))
        fresh = np.ones(len(flat), dtype=bool)
        for at, skip in zip(offsets.tolist(), skips, strict=False):
            fresh[at : at + skip] = False
        found = np.concatenate([place[own] + bucket[own] for bucket, valid in features(flat, offsets) for own in [valid & fresh]])
        found.sort()
        first = np.flatnonzero(np.concatenate(([True], found[1:] != found[:-1]))) if len(found) else np.zeros(0, dtype=np.int64)
        key = found[first]
        keys.append(np.array(rows, dtype=np.uint64)[key // np.uint32(BUCKETS)] * np.uint64(BUCKETS) + key % np.uint32(BUCKETS))
        counts.append(np.diff(np.append(first, len(found))))
    if len(keys) == 2:
        key, n = keys[1], counts[1]
    else:
        key, back = np.unique(np.concatenate(keys), return_inverse=True)
        n = np.bincount(back, weights=np.concatenate(counts), minlength=len(key)).astype(np.int64)
    return (key // np.uint64(BUCKETS)).astype(np.int64), (key % np.uint64(BUCKETS)).astype(np.int64), n


def score_blocks(texts: list[str], blocks: Iterable[Model]) -> tuple[list[str], np.ndarray]:
    """score over the languages of all blocks: the best total, and the posterior among all of them. Of languages with equal totals the first by name wins."""
    n = len(texts)
    row, bucket, times = gram_counts(texts)
    full, starts = np.unique(row, return_index=True)
    grams = np.bincount(row, weights=times, minlength=n)
    best, mass, lang = np.full(n, -np.inf), np.zeros(n), np.full(n, "und", dtype=object)
    top = np.full(n, -np.inf)  # mass is the sum of exp(mean - top)
    for langs, log_p in blocks:
        if not langs:
            continue
        total = np.zeros((n, len(langs)))
        for k in range(0, len(langs), _COLUMNS):  # some columns at a time, so that the products of a long text stay small
            if len(full):
                total[full, k : k + _COLUMNS] = np.add.reduceat(log_p[bucket, k : k + _COLUMNS] * times[:, None].astype(np.float64), starts, axis=0)
        mean = total / np.maximum(grams, 1)[:, None] * np.minimum(grams, EVIDENCE)[:, None]
        at = total.argmax(axis=1)
        own, high = total[np.arange(n), at], np.maximum(top, mean.max(axis=1))
        mass = mass * np.exp(top - high) + np.exp(mean - high[:, None]).sum(axis=1)
        better = own > best
        best[better], lang[better] = own[better], np.array(langs, dtype=object)[at[better]]
        top = high
    known = [has_letter(t) and m > 0 for t, m in zip(texts, mass.tolist(), strict=True)]
    p = np.divide(1.0, mass, out=np.zeros(n), where=mass > 0)
    return [k if good else "und" for k, good in zip(lang.tolist(), known, strict=True)], np.where(known, p, 0.0)


def train(rows: DataFrame, text_col: str, lang_col: str, id_col: str | None = None, most: int = TRAIN_TEXTS) -> list[Model]:
    """Fit on about `most` texts of each language: all of a rare one, of a frequent one those whose hash of id and text is lowest.

    Rows that share id (if one is named) and text count once, so no number of copies swells the sample. Every language is learned, in blocks of
    MOST_LANGUAGES in order; none without labelled texts.
    """
    own = F.xxhash64(*[F.col(c) for c in (id_col, text_col) if c])
    labelled = rows.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), own.alias("own"))
    sizes = {r.lang: r.n for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return []
    names = sorted(sizes)
    share = rows.sparkSession.createDataFrame([(k, min(1.0, most / sizes[k]), i // MOST_LANGUAGES) for i, k in enumerate(names)], "lang string, share double, block int")
    chosen = labelled.join(F.broadcast(share), "lang").where(F.pmod("own", F.lit(1_000_000)) < F.col("share") * 1_000_000)
    chosen = chosen.groupBy("lang", "own").agg(F.min("text").alias("text")).select("lang", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}

        def sent() -> Iterator[pa.RecordBatch]:
            for lang, total in sums.items():
                at = np.flatnonzero(total)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(total[at])], ["lang", "bucket", "n"])
            sums.clear()

        for batch in slices(batches, "text"):
            by: dict[str, list[str]] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                by.setdefault(lang, []).append(text)
            for lang, texts in by.items():
                if lang not in sums and len(sums) >= MOST_LANGUAGES:
                    yield from sent()
                sums[lang] = sums.get(lang, 0) + count(texts)
        yield from sent()

    table = chosen.mapInArrow(run, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    starts = range(0, len(names), MOST_LANGUAGES)
    if len(starts) > 1:
        table = materialize(table.join(F.broadcast(share.select("lang", "block")), "lang"))
    models: list[Model] = []
    for block, start in enumerate(starts):
        part = (table.where(F.col("block") == block) if len(starts) > 1 else table).select("lang", "bucket", "n").toArrow()
        lang, bucket, n = np.array(part["lang"].to_pylist(), dtype=object), np.asarray(part["bucket"]), np.asarray(part["n"])
        counts: dict[str, np.ndarray] = {k: np.zeros(BUCKETS, dtype=np.int64) for k in names[start : start + MOST_LANGUAGES]}
        for k in counts:
            own = lang == k
            counts[k][bucket[own]] = n[own]
        models.append(fit(counts))
    return models


def identify(docs: DataFrame, text_col: str, model: Model | list[Model], extra: dict[str, Column]) -> DataFrame:
    """`extra` columns of each row of docs, then lang_pred and score.

    model is what fit or train returns.
    `und` with score 0 for a null text, one without a letter, or an empty model. Nothing but the text is looked at; an empty
    table gives no rows.
    """
    blocks = model if isinstance(model, list) else [model]
    shared = [docs.sparkSession.sparkContext.broadcast(b) for b in blocks]  # BUCKETS x languages floats: at most MOST_LANGUAGES * 128 kB each
    rows = docs.select(*[c.alias(k) for k, c in extra.items()], F.col(text_col).cast("string").alias("__text__"))
    n = len(extra)
    names = [*extra, "lang_pred", "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "__text__"):
            texts = [t or "" for t in batch.column(n).to_pylist()]
            lang, p = score_blocks(texts, (b.value for b in shared))
            yield pa.RecordBatch.from_arrays([*batch.columns[:n], pa.array(lang, pa.string()), pa.array(p)], names)

    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:n]]
    return rows.mapInArrow(run, ", ".join([*kinds, "lang_pred string", "score double"]))


def held_out(id_col: str, mod: int, rest: int) -> Column:
    """Whether crc32 of the id as text leaves `rest` (a null id is the empty text)."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % mod == rest


def op8_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: learned from rows that aren't held out, applied to all documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = held_out("doc_id", 4, 2)
    model = train(docs.where(~out), "text", "lang", "doc_id")
    return identify(docs, "text", model, {"doc_id": F.col("doc_id"), "held_out": out})
