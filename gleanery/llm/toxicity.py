"""Toxicity classifier with counterfactual regularisation (operator 6).

A logistic model over the presence of words and word prefixes. It is fitted on a bounded sample of labelled texts;
for each text that names a group, a copy with the identity terms swapped is made, and the fit penalises the squared
difference of the two scores, so that a neutral mention of a group can't carry weight.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StructField, StructType

from .common import pieces, slices, text_or_empty
from .langid import held_out
from .wordhash import FOLD, U, mix, per_row, range_hash, words

#: Labelled texts that the model is fitted on, at most.
TRAIN_TEXTS = 6_000
#: Hashed features (the broadcast weights take 4 MB).
BUCKETS = 1 << 20
#: Features kept by their association with the label.
FEATURES = 1_500
#: Lengths of the word prefixes (in bytes of the folded word) that are features beside the whole word.
PREFIXES = (4, 5, 6)
#: Weight of the counterfactual penalty.
PENALTY = 4.0

#: Identity terms by kind; a term is swapped for another of its kind.
IDENTITY_TERMS = (
    ("women", "men"),
    ("woman", "man"),
    ("girls", "boys"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("gay", "straight", "lesbian", "bisexual", "transgender"),
    ("black", "white", "asian", "latino", "african", "european"),
    ("immigrants", "natives", "refugees", "foreigners"),
    ("old", "young"),
    ("disabled", "blind", "deaf"),
)

_SWAP = {term: kind[(i + 1) % len(kind)] for kind in IDENTITY_TERMS for i, term in enumerate(kind)}
_TERM = re.compile(r"\b(" + "|".join(sorted(_SWAP, key=len, reverse=True)) + r")\b", re.IGNORECASE)


def swap_terms(text: str) -> str:
    """The text with each identity term replaced by the next of its kind."""
    return _TERM.sub(lambda m: _SWAP[m[0].lower()], text)


def _features(rows: list[int], texts: list[str]) -> np.ndarray:
    """Distinct (row, hashed feature) of the texts, as one number each."""
    raws = [t.encode("utf-8", "surrogatepass") for t in texts]
    offsets = np.concatenate(([0], np.cumsum([len(r) for r in raws]))).astype(np.int64)
    raw = b"".join(raws)
    starts, ends, row, whole = words(raw, offsets)
    flat, at = [whole], [row]
    folded = np.frombuffer(raw.translate(FOLD), dtype=np.uint8)
    for n in PREFIXES:
        long = np.flatnonzero(ends - starts > n)
        flat.append(mix(range_hash(folded, starts[long], starts[long] + n) + U(n)))
        at.append(row[long])
    return np.unique((np.array(rows, dtype=U)[np.concatenate(at)] << U(32)) | (np.concatenate(flat) & U(BUCKETS - 1)))


def text_features(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashed features of each text, sorted: flat values below BUCKETS and row offsets. Long texts go through in windows."""
    parts = [_features(rows, group) for rows, group in pieces(texts)] or [np.zeros(0, dtype=U)]
    both = parts[0] if len(parts) == 1 else np.unique(np.concatenate(parts))
    return (both & U(0xFFFFFFFF)).astype(np.int64), per_row((both >> U(32)).astype(np.int64), len(texts))


@dataclass
class Model:
    weights: np.ndarray  # of every bucket, nearly all zero
    bias: float

    def score(self, texts: list[str]) -> np.ndarray:
        values, offsets = text_features(texts)
        sums = np.concatenate(([0.0], np.cumsum(self.weights[values], dtype=np.float64)))
        return _sigmoid(self.bias + sums[offsets[1:]] - sums[offsets[:-1]])


@dataclass
class Sample:
    """Features of the labelled texts, and of the swapped copies of those that name a group (index says which)."""

    label: np.ndarray
    values: np.ndarray
    offsets: np.ndarray
    index: np.ndarray
    swapped: np.ndarray
    swapped_offsets: np.ndarray


def sample_of(texts: list[str], label: np.ndarray) -> Sample:
    """The sample of texts at hand."""
    index = np.array([i for i, t in enumerate(texts) if _TERM.search(t)], dtype=np.int64)
    return Sample(np.asarray(label, dtype=np.float64), *text_features(texts), index, *text_features([swap_terms(texts[i]) for i in index.tolist()]))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def choose_features(sample: Sample, most: int) -> np.ndarray:
    """The buckets whose share among the two classes differs most (a two-proportion z score of at least 4)."""
    label = sample.label
    every = np.bincount(sample.values, minlength=BUCKETS)
    positive = np.bincount(sample.values, weights=np.repeat(label, np.diff(sample.offsets)), minlength=BUCKETS)
    n1, n0 = max(label.sum(), 1), max((1 - label).sum(), 1)
    share = every / max(len(label), 1)
    z = np.abs(positive / n1 - (every - positive) / n0) / np.sqrt(np.maximum(share * (1 - share), 1e-12) * (1 / n1 + 1 / n0))
    z[every < 3] = 0
    best = np.argsort(-z, kind="stable")[:most]
    return np.sort(best[z[best] >= 4])


def _matrix(values: np.ndarray, offsets: np.ndarray, features: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and column (place in `features`) of each feature that a text has."""
    column = np.full(BUCKETS, -1, dtype=np.int64)
    column[features] = np.arange(len(features))
    col = column[values]
    return np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[col >= 0], col[col >= 0]


def fit(texts: list[str], label: np.ndarray, base_rate: float | None = None, penalty: float = PENALTY, most: int = FEATURES, rounds: int = 400) -> Model:
    """fit_sample of texts at hand."""
    return fit_sample(sample_of(texts, label), base_rate, penalty, most, rounds)


def fit_sample(sample: Sample, base_rate: float | None = None, penalty: float = PENALTY, most: int = FEATURES, rounds: int = 400) -> Model:
    """Fit by accelerated full-batch gradient steps; deterministic.

    The loss is the mean log loss, plus `penalty` times the mean squared difference between the score of a text that names a group
    and that of its swapped copy, plus a little L2. base_rate moves the bias from the sample's share of positives to the table's.
    """
    label, index = sample.label, sample.index
    weights = np.zeros(BUCKETS, dtype=np.float32)
    if not len(label):
        return Model(weights, -3.0)
    prior = np.clip(label.mean(), 1e-3, 1 - 1e-3)
    rate = np.clip(prior if base_rate is None else base_rate, 1e-3, 1 - 1e-3)
    shift = np.log(rate / (1 - rate)) - np.log(prior / (1 - prior))
    features = choose_features(sample, most)
    n, k = len(label), len(features)
    w, bias = np.zeros(k), float(np.log(prior / (1 - prior)))
    if not k:
        return Model(weights, float(bias + shift))
    rows, cols = _matrix(sample.values, sample.offsets, features)
    pair_rows, pair_cols = _matrix(sample.swapped, sample.swapped_offsets, features)
    step = 4.0 / (1 + np.bincount(rows, minlength=n).mean() + 2 * penalty * (len(index) > 0))
    seen_w, seen_b = w, bias
    for t in range(1, rounds + 1):
        pull = (t - 1) / (t + 2)
        at_w, at_b = w + pull * (w - seen_w), bias + pull * (bias - seen_b)
        p = _sigmoid(np.bincount(rows, weights=at_w[cols], minlength=n) + at_b)
        slope = (p - label) / n
        grad_w, grad_b = 1e-5 * at_w, 0.0
        if len(index):
            q = _sigmoid(np.bincount(pair_rows, weights=at_w[pair_cols], minlength=len(index)) + at_b)
            gap = 2 * penalty * (p[index] - q) / len(index)
            slope[index] += gap * p[index] * (1 - p[index])
            back = -gap * q * (1 - q)
            grad_w, grad_b = grad_w + np.bincount(pair_cols, weights=back[pair_rows], minlength=k), grad_b + back.sum()
        grad_w, grad_b = grad_w + np.bincount(cols, weights=slope[rows], minlength=k), grad_b + slope.sum()
        seen_w, seen_b = w, bias
        w, bias = at_w - step * grad_w, at_b - step * grad_b
    weights[features] = w
    return Model(weights, float(bias + shift))


SAMPLE = StructType([StructField("label", IntegerType()), StructField("features", ArrayType(IntegerType())), StructField("swapped", ArrayType(IntegerType()))])


def sample_rows(labelled: DataFrame) -> DataFrame:
    """(label, features, swapped) of (text, label): the buckets of each text, and of its swapped copy where it names a group. Texts stay in their task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            texts = batch.column(0).to_pylist()
            values, offsets = text_features(texts)
            own = [values[a:b].astype(np.int32) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
            swapped: list[np.ndarray | None] = [text_features([swap_terms(t)])[0].astype(np.int32) if _TERM.search(t) else None for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(own, pa.list_(pa.int32())), pa.array(swapped, pa.list_(pa.int32()))], SAMPLE.fieldNames())

    return labelled.select(text_or_empty("text").alias("text"), F.col("label").cast("int").alias("label")).mapInArrow(run, SAMPLE)


def gathered(rows: DataFrame) -> Sample:
    """The sample that sample_rows makes, on the driver: a few hundred numbers of 4 bytes for each text, in an order of their own."""
    table = rows.toArrow()
    made = sorted(
        ((y, f.values.to_numpy(), None if not s.is_valid else s.values.to_numpy()) for y, f, s in zip(table["label"].to_pylist(), table["features"], table["swapped"], strict=True)),
        key=lambda r: (r[0], r[1].tobytes()),
    )
    index = [i for i, r in enumerate(made) if r[2] is not None]

    def flat(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        return np.concatenate([np.zeros(0, dtype=np.int64), *parts]).astype(np.int64), np.concatenate(([0], np.cumsum([len(p) for p in parts]))).astype(np.int64)

    return Sample(np.array([r[0] for r in made], dtype=np.float64), *flat([r[1] for r in made]), np.array(index, dtype=np.int64), *flat([made[i][2] for i in index]))


def score(docs: DataFrame, text_col: str, model: Model, extra: dict[str, Column]) -> DataFrame:
    """`extra` columns of each row of docs, then score (0 to 1) and predicted (score >= 0.5).

    The score looks at the whole text alone; null and empty texts get the model's base rate; rows that are repeated, or have null ids, are scored each on
    its own; an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS weights: 4 MB
    rows = docs.select(*[c.alias(k) for k, c in extra.items()], text_or_empty(text_col).alias("__text__"))
    n = len(extra)
    names = [*extra, "score", "predicted"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "__text__"):
            p = shared.value.score(batch.column(n).to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns[:n], pa.array(p), pa.array((p >= 0.5).astype(np.int32))], names)

    return rows.mapInArrow(run, StructType([*rows.schema.fields[:n], StructField("score", DoubleType()), StructField("predicted", IntegerType())]))


def learn(spark: SparkSession, docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "toxic", text_col: str = "text", most: int = TRAIN_TEXTS) -> Model:
    """The model from labelled rows that aren't held out (crc32 of the id modulo 5 isn't 0).

    The sample is chosen by id, from the labels alone: of each label (0, 1) at most `most` / 2 ids, those of the lowest hash. An id with several labels counts as 1 if
    any of them is; of documents that share an id the least text counts. So at most `most` texts are fitted on, whatever is copied how
    often, and documents are read once. Null ids, labels other than 0 and 1, and ids without a document take no part.
    """
    label = F.max(F.col(label_col).cast("int")).alias("label")
    known = labels.select(id_col, label_col).where(F.col(id_col).isNotNull() & F.col(label_col).cast("int").isin(0, 1) & ~held_out(id_col, 5, 0)).groupBy(id_col).agg(label)
    sizes = {r.label: r.n for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    halves = [known.where(F.col("label") == k).orderBy(F.xxhash64(id_col), id_col).limit(most // 2) for k in (0, 1)]
    ids = halves[0].unionByName(halves[1]).select(F.col(id_col).alias("__id"), "label")
    found = docs.select(F.col(id_col).alias("__id"), text_or_empty(text_col).alias("text")).join(F.broadcast(ids), "__id")  # at most `most` ids
    one = found.groupBy("__id").agg(F.min("text").alias("text"), F.max("label").alias("label"))
    every = sum(sizes.values())
    return fit_sample(gathered(sample_rows(one)), sizes.get(1, 0) / every if every else None)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: learned from labelled rows that aren't held out, applied to all documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = learn(spark, docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score(docs, "text", model, {"doc_id": F.col("doc_id"), "held_out": held_out("doc_id", 5, 0)})
