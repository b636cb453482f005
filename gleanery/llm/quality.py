"""Quality rules as a short-circuit cascade (operator 9).

Every rule is a numpy function over a batch of texts that says which texts pass. The base counts of every text are worked out
first, as they are part of the result. Each task then estimates every rule's cost (seconds a text, beyond the base counts) and
selectivity (share rejected) on a sample, the first SAMPLE_TEXTS texts of its partition that the base passes; from then on its rules run
in the order of rejection per cost, each only over the texts that all rules before it passed. The order changes the time, never the verdict,
and no text leaves its task for it.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import buffer_of, slices, text_or_empty
from .wordhash import BASE_B, U, mix, per_row, range_hash, runs

#: Texts of a partition on which costs and selectivities are estimated.
SAMPLE_TEXTS = 200

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, *range(9, 14)]] = True
_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_UPPER = np.zeros(256, dtype=bool)
_UPPER[65:91] = True
_ALPHA = np.zeros(256, dtype=bool)
_ALPHA[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True


class Batch:
    """A batch of texts; what several rules need is worked out once, when first asked for."""

    def __init__(self, raw: bytes | np.ndarray, offsets: np.ndarray):
        self.bytes = np.frombuffer(raw, dtype=np.uint8)
        self.offsets = offsets
        self.n = len(offsets) - 1
        self._kept: dict[str, object] = {}

    def once(self, name: str, make: Callable[[], object]):
        if name not in self._kept:
            self._kept[name] = make()
        return self._kept[name]

    def subset(self, rows: np.ndarray) -> Batch:
        """A batch of these rows (in order); counts that are known already go with them."""
        if len(rows) == self.n:
            return self
        size = np.diff(self.offsets)
        inside = np.zeros(self.n, dtype=bool)
        inside[rows] = True
        out = Batch(self.bytes[np.repeat(inside, size)], np.concatenate(([0], np.cumsum(size[rows]))).astype(np.int64))
        out._kept = {k: self._kept[k][rows] for k in _COUNTS if k in self._kept}
        return out

    def sums(self, flags: np.ndarray) -> np.ndarray:
        """True bytes of each text."""
        total = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
        return total[self.offsets[1:]] - total[self.offsets[:-1]]

    def words(self):
        return self.once("words", lambda: runs(~_SPACE[self.bytes], self.offsets))

    def n_words(self) -> np.ndarray:
        return self.once("n_words", lambda: np.diff(per_row(self.words()[2], self.n)))

    def word_chars(self) -> np.ndarray:
        return self.once("word_chars", lambda: self.sums(~_SPACE[self.bytes] & ((self.bytes & 0xC0) != 0x80)))

    def n_symbols(self) -> np.ndarray:
        return self.once("n_symbols", lambda: self.sums(_SYMBOL[self.bytes]))

    def n_letters(self) -> np.ndarray:
        return self.once("n_letters", lambda: self.sums(_ALPHA[self.bytes] & ((self.bytes & 0xC0) != 0x80)))

    def lines(self):
        """Starts, ends and rows of the lines that have a word."""
        return self.once("lines", self._lines)

    def _lines(self):
        starts, ends, row = runs(self.bytes != 10, self.offsets)
        full = np.concatenate(([0], np.cumsum(~_SPACE[self.bytes])))
        some = full[ends] > full[starts]
        return starts[some], ends[some], row[some]

    def n_full_lines(self) -> np.ndarray:
        return self.once("n_full_lines", lambda: np.bincount(self.lines()[2], minlength=self.n).astype(np.int64))

    def n_dup_lines(self) -> np.ndarray:
        return self.once("n_dup_lines", self._dup_lines)

    def _dup_lines(self) -> np.ndarray:
        starts, ends, row = self.lines()
        key = mix(range_hash(self.bytes, starts, ends) + row.astype(U) * U(BASE_B))
        _, first = np.unique(key, return_index=True)
        again = np.ones(len(key), dtype=bool)
        again[first] = False
        return np.bincount(row[again], minlength=self.n).astype(np.int64)

    def n_repeat_words(self) -> np.ndarray:
        return self.once("n_repeat_words", self._repeat_words)

    def _repeat_words(self) -> np.ndarray:
        starts, ends, row = self.words()
        h = range_hash(self.bytes, starts, ends)
        at = np.flatnonzero(row[:-2] == row[2:])  # windows that end within their own text; the others are no windows
        if not len(at):
            return np.zeros(self.n, dtype=np.int64)
        key = mix(mix(h[at] * U(3) + h[at + 1]) * U(5) + h[at + 2] + row[at].astype(U) * U(BASE_B))
        order = np.argsort(key)
        same = key[order][1:] == key[order][:-1]
        twice = np.zeros(len(key), dtype=bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        covered = np.zeros(len(h), dtype=bool)
        for k in range(3):
            covered[at[twice] + k] = True
        return np.bincount(row[covered], minlength=self.n).astype(np.int64)


#: What subset takes over: counts with an entry for each text.
_COUNTS = ("n_words", "word_chars", "n_symbols", "n_letters", "n_full_lines", "n_dup_lines", "n_repeat_words")


def _at_most(part: np.ndarray, whole: np.ndarray, percent: int) -> np.ndarray:
    return 100 * part <= percent * whole


Rule = Callable[[Batch], np.ndarray]
#: Rules beyond the base. Each passes a text or rejects it; all must pass.
RULES: dict[str, Rule] = {
    "symbols_to_words": lambda b: _at_most(b.n_symbols(), b.n_words(), 10),
    "mean_word_length": lambda b: (b.word_chars() >= 2 * b.n_words()) & (b.word_chars() <= 14 * b.n_words()),
    "repeated_lines": lambda b: _at_most(b.n_dup_lines(), b.n_full_lines(), 50),
    "capitals": lambda b: _at_most(b.sums(_UPPER[b.bytes]), b.n_letters(), 30),
    "letters": lambda b: 100 * b.n_letters() >= 60 * b.word_chars(),
}


class Cascade:
    """The rules of one task: measured one by one until SAMPLE_TEXTS texts were seen, then in their order of rejection per cost."""

    def __init__(self, rules: dict[str, Rule] = RULES, order: list[str] | None = None, sample: int = SAMPLE_TEXTS):
        self.rules, self.fixed, self.sample, self.seen = rules, order, sample, 0
        self.rejected, self.seconds = dict.fromkeys(rules, 0), dict.fromkeys(rules, 0.0)

    def order(self) -> list[str]:
        """Rule names by rejected texts per second of the sample, best first; ties by name. Without a sample, by name."""
        if self.fixed is not None:
            return self.fixed
        return sorted(self.rules, key=lambda k: (-(self.rejected[k] + 0.01) / max(self.seconds[k], 1e-6) if self.seen else 0, k))

    def _measure(self, batch: Batch) -> None:
        """Every rule on the batch, each as if it came first: with the base counts alone at hand."""
        known = dict(batch._kept)
        for name, rule in self.rules.items():
            batch._kept = dict(known)
            began = time.thread_time()
            passed = rule(batch)
            self.seconds[name] += time.thread_time() - began
            self.rejected[name] += int((~passed).sum())
        batch._kept = known
        self.seen += batch.n

    def run(self, batch: Batch, alive: np.ndarray) -> np.ndarray:
        """alive, less the texts that a rule rejects; a rule sees only the texts still alive."""
        alive = alive.copy()
        rows = np.flatnonzero(alive)
        now = batch.subset(rows)
        if self.fixed is None and self.seen < self.sample and len(rows):
            self._measure(now.subset(np.arange(min(len(rows), self.sample - self.seen))))
        for name in self.order():
            if not len(rows):
                break
            passed = self.rules[name](now)
            alive[rows[~passed]] = False
            rows, now = rows[passed], now.subset(np.flatnonzero(passed))
        return alive


def judge(docs: DataFrame, id_col: str, text_col: str, order: list[str] | None = None) -> DataFrame:
    """One row for each row of docs: id_col, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept.

    A null text has no word and fails the base; null and repeated ids pass through; other columns aren't read; an empty table
    gives no rows. order: names of RULES, in place of the order that each task estimates.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cascade = Cascade(order=order)
        for part in slices(batches, "text"):
            batch = Batch(*buffer_of(part.column(1)))
            n_words, repeats = batch.n_words(), batch.n_repeat_words()
            columns = [n_words, batch.word_chars(), batch.n_symbols(), batch.n_dup_lines(), repeats]
            failed = (n_words < 50) | (100 * repeats > 50 * n_words)
            yield pa.RecordBatch.from_arrays([part.column(0), *map(pa.array, [*columns, failed, cascade.run(batch, ~failed)])], names)

    kind = rows.schema["doc_id"].dataType.simpleString()
    out = rows.mapInArrow(run, f"doc_id {kind}, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean")
    return out.withColumnRenamed("doc_id", id_col)


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query over all documents."""
    return judge(spark.read.parquet(f"{sf_dir}/documents.parquet"), "doc_id", "text")


OP9_SQL = r"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws, string_split(text, chr(10)) AS ls FROM t),
f AS (SELECT *, list_filter(ls, lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS fl FROM w),
g AS (SELECT r, unnest(range(1, greatest(len(ws) - 1, 1))) AS i, ws FROM w),
h AS (SELECT r, i, count(*) OVER (PARTITION BY r, ws[i], ws[i + 1], ws[i + 2]) AS n FROM g),
p AS (SELECT r, count(DISTINCT i + k) AS n_repeat_words FROM h, (SELECT unnest([0, 1, 2]) AS k) WHERE n > 1 GROUP BY r),
s AS (SELECT doc_id, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
  length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, (len(fl) - len(list_distinct(fl)))::BIGINT AS n_dup_lines,
  coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, len(fl)::BIGINT AS full_lines,
  length(regexp_replace(text, '[^A-Z]', '', 'g'))::BIGINT AS upper, length(regexp_replace(text, '[^A-Za-z\x{80}-\x{10FFFF}]', '', 'g'))::BIGINT AS alpha
  FROM f LEFT JOIN p USING (r)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM s)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND 100 * n_symbols <= 10 * n_words AND word_chars >= 2 * n_words AND word_chars <= 14 * n_words
  AND 100 * n_dup_lines <= 50 * full_lines AND 100 * upper <= 30 * alpha AND 100 * alpha >= 60 * word_chars AS kept
FROM b
"""
