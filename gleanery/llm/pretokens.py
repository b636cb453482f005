"""Pre-tokens of two public BPE tokenizers for whole batches, found by character classes in numpy.

The classes (letter, number, white space) come from the tokenizers library itself, so they are its own by
construction. Byte-level texts are cut at special tokens and take every character. Texts of the word tokenizer with
characters outside the tables' range, that need normalising or hold a special token go through the library.
"""

from __future__ import annotations

import functools
import re
import unicodedata

import numpy as np
from tokenizers import Regex, Tokenizer, normalizers, pre_tokenizers

from .common import pieces
from .wordhash import BASE_A, BASE_B, U, range_hash

OTHER, LETTER, NUMBER, SPACE = 0, 1, 2, 3
LIMIT = 0x2E80  # characters below it have table entries
WIDE = 0x40000  # so have those below it in a table that is built once such a character comes; Unicode has no letter, number or white space beyond
_SURE = 0x300  # below it no character combines or composes


@functools.cache
def classes(limit: int = LIMIT) -> np.ndarray:
    """The class of each character below the limit, as the library's own regular expressions see it."""
    table = np.zeros(limit, dtype=np.uint8)
    known = np.array([i for i in range(limit) if not 0xD800 <= i < 0xE000])
    every = "".join(map(chr, known.tolist()))
    for kind, pattern in ((LETTER, r"\p{L}"), (NUMBER, r"\p{N}"), (SPACE, r"\s")):
        for _, (a, b) in pre_tokenizers.Split(Regex(f"[^{pattern}]+" if kind != SPACE else r"\S+"), "removed").pre_tokenize_str(every):
            table[known[a:b]] = kind
    return table


def kinds(points: np.ndarray) -> np.ndarray:
    """The class of each of points."""
    if points.max() < LIMIT:
        return classes()[points]
    return classes(WIDE)[np.minimum(points, WIDE - 1)]


@functools.cache
def lowered() -> np.ndarray:
    """The library's lower case below LIMIT; 0xFFFFFFFF where it isn't one character below LIMIT."""
    lower = normalizers.Lowercase()
    out = np.zeros(LIMIT, dtype=np.uint32)
    for i in range(LIMIT):
        low = lower.normalize_str(chr(i))
        out[i] = ord(low) if len(low) == 1 and ord(low) < LIMIT else 0xFFFFFFFF
    return out


def codepoints(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    return points, np.concatenate(([0], np.cumsum([len(t) for t in texts]))).astype(np.int64)


def segment(points: np.ndarray, offsets: np.ndarray, blanks: bool, single_numbers: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and rows of the pre-tokens of rows points[offsets[r]:offsets[r + 1]].

    blanks: white space makes tokens and a blank joins the run after it (the byte-level pattern); else white space
    is dropped. single_numbers: each number character stands alone.
    """
    n = len(points)
    if not n:
        z = np.zeros(0, dtype=np.int64)
        return z, z, z
    kind = kinds(points)
    cuts = offsets[(offsets > 0) & (offsets < n)]
    edge = np.zeros(n, dtype=bool)
    edge[0] = True
    edge[cuts] = True
    first = edge.copy()
    first[1:] |= kind[1:] != kind[:-1]
    if single_numbers:
        first |= kind == NUMBER
    starts = np.flatnonzero(first)
    ends = np.append(starts[1:], n)
    what = kind[starts]
    fresh = edge[starts]  # the run opens its row
    after_space = np.zeros(len(starts), dtype=bool)
    after_space[1:] = (what[:-1] == SPACE) & ~fresh[1:]
    blank_before = np.zeros(len(starts), dtype=bool)
    if blanks:
        blank_before = after_space & (points[np.maximum(starts - 1, 0)] == 32)
    # contractions: a lone apostrophe at the scan position, then s t m d re ve ll
    quote = np.flatnonzero((ends - starts == 1) & (points[starts] == 39) & ~blank_before)
    quote = quote[quote + 1 < len(starts)]
    quote = quote[(what[quote + 1] == LETTER) & ~fresh[quote + 1]]
    a = points[starts[quote + 1]]
    room = ends[quote + 1] - starts[quote + 1] >= 2
    b = points[np.minimum(starts[quote + 1] + 1, n - 1)]
    one = np.isin(a, np.frombuffer("stmd".encode("utf-32-le"), dtype=np.uint32))
    two = room & (((a == 114) | (a == 118)) & (b == 101) | (a == 108) & (b == 108))
    taken = np.where(one, 1, np.where(two, 2, 0))
    quote, taken = quote[taken > 0], taken[taken > 0]
    starts, ends = starts.copy(), ends.copy()
    extra_starts = extra_ends = np.zeros(0, dtype=np.int64)
    if blanks:
        followed = np.zeros(len(starts), dtype=bool)  # white space before text of the same row
        followed[:-1] = (what[:-1] == SPACE) & ~fresh[1:]
        # a last character that isn't a blank stands alone
        single = np.flatnonzero(followed & (points[ends - 1] != 32) & (ends - starts > 1))
        joined = np.flatnonzero(blank_before)
        starts[joined] -= 1
        ends[joined - 1] -= 1
        ends[single] -= 1
        extra_starts, extra_ends = ends[single], ends[single] + 1
    if len(quote):
        ends[quote] += taken
        starts[quote + 1] += taken
    keep = ends > starts
    if not blanks:
        keep &= what != SPACE
    starts, ends = starts[keep], ends[keep]
    if len(extra_starts):
        starts, ends = np.concatenate((starts, extra_starts)), np.concatenate((ends, extra_ends))
        order = np.argsort(starts, kind="stable")
        starts, ends = starts[order], ends[order]
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


@functools.cache
def byte_alphabet() -> dict[int, str]:
    """Byte-level BPE's printable stand-in for each byte: printable Latin-1 stands for itself, the rest from U+0100 on."""
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(kept)]
    return {b: chr(b) for b in kept} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Vocabulary:
    """A tokenizer file: its BPE model for single words, and the bytes of each id."""

    def __init__(self, path: str, words: bool):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.words = words
        alphabet = byte_alphabet()
        self.to_symbols = {b: alphabet[b] for b in range(256)}
        added = self.tokenizer.get_added_tokens_decoder()
        self.specials = tuple(t.content for t in added.values())
        #: Ids of the added tokens at which a byte-level text is simply cut.
        self.cuts = {} if words else {t.content: i for i, t in added.items() if not (t.normalized or t.single_word or t.lstrip or t.rstrip)}
        self.cut_at = re.compile("|".join(map(re.escape, sorted(self.cuts, key=len, reverse=True)))) if self.cuts else None
        self._table = str.maketrans({chr(b): c for b, c in alphabet.items()})

    def merge(self, word: str) -> list[int]:
        """Ids of one pre-token by exact merging; the id of a special token that texts are cut at."""
        if word in self.cuts:
            return [self.cuts[word]]
        symbols = word.encode("utf-8", "surrogatepass").decode("latin-1").translate(self._table)
        return [t.id for t in self.tokenizer.model.tokenize(symbols)]

    def whole(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    @functools.cached_property
    def id_bytes(self) -> list[bytes]:
        """What decoding writes for each id."""
        back = {c: b for b, c in byte_alphabet().items()}
        out = []
        for i in range(self.tokenizer.get_vocab_size(with_added_tokens=True)):
            token = self.tokenizer.id_to_token(i) or ""
            out.append(token.encode() if token in self.specials or not all(c in back for c in token) else bytes(back[c] for c in token))
        return out


class Memo:
    """Ids of the words met so far by a worker, as flat arrays under two 64-bit hashes; emptied when full."""

    def __init__(self, resolve, most: int = 600_000):
        self.resolve, self.most = resolve, most
        self.clear()

    def clear(self) -> None:
        self.key, self.check = np.zeros(0, dtype=U), np.zeros(0, dtype=U)
        self.start, self.count = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        self.ids = np.zeros(0, dtype=np.uint32)

    def _find(self, key: np.ndarray, check: np.ndarray) -> np.ndarray:
        if not len(self.key):
            return np.full(len(key), -1)
        at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        return np.where((self.key[at] == key) & (self.check[at] == check), at, -1)

    def look_up(self, points: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and count in self.ids for each word points[start:end]."""
        key, check = range_hash(points, starts, ends, BASE_A), range_hash(points, starts, ends, BASE_B)
        some, first, back = np.unique(key, return_index=True, return_inverse=True)
        if not np.array_equal(check[first][back], check):  # two words under one hash: tell them apart by both
            both = np.stack((key, check), axis=1)
            _, first, back = np.unique(both, axis=0, return_index=True, return_inverse=True)
            back = back.ravel()
        if len(self.key) > self.most or len(self.ids) > 16 * self.most:
            self.clear()
        at = self._find(key[first], check[first])
        start, count = np.zeros(len(first), dtype=np.int64), np.zeros(len(first), dtype=np.int64)
        start[at >= 0], count[at >= 0] = self.start[at[at >= 0]], self.count[at[at >= 0]]
        missing = np.flatnonzero(at < 0)
        if len(missing):
            new = first[missing]
            chars = points.astype("<u4").tobytes()
            found = self.resolve([chars[4 * a : 4 * b].decode("utf-32-le", "surrogatepass") for a, b in zip(starts[new].tolist(), ends[new].tolist(), strict=True)])
            n = np.array([len(x) for x in found], dtype=np.int64)
            count[missing] = n
            start[missing] = len(self.ids) + np.concatenate(([0], np.cumsum(n)[:-1]))
            self.ids = np.concatenate((self.ids, np.fromiter((i for x in found for i in x), dtype=np.uint32, count=int(n.sum()))))
            # of words with equal first hashes the table keeps finding one; the other is resolved anew each time
            order = np.argsort(np.concatenate((self.key, key[new])), kind="stable")
            self.key = np.concatenate((self.key, key[new]))[order]
            self.check = np.concatenate((self.check, check[new]))[order]
            self.start = np.concatenate((self.start, start[missing]))[order]
            self.count = np.concatenate((self.count, count[missing]))[order]
        return start[back], count[back]


def gather(flat: np.ndarray, start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """flat[start:start + count] for each pair, one after another."""
    total = int(count.sum())
    if not total:
        return flat[:0]
    skip = np.concatenate(([0], np.cumsum(count)[:-1]))
    return flat[np.arange(total) - np.repeat(skip - start, count)]


class Encoder:
    """Encodes lists of texts exactly as the library does."""

    def __init__(self, vocabulary: Vocabulary, resolve=None):
        self.vocabulary = vocabulary
        self.memo = Memo(resolve or (lambda words: [vocabulary.merge(w) for w in words]))

    def _fit(self, texts: list[str], points: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Whether the tables are enough for each text."""
        others = [s for s in self.vocabulary.specials if s not in self.vocabulary.cuts]
        fit = np.array([not any(s in t for s in others) for t in texts], dtype=bool)
        full = np.flatnonzero(np.diff(offsets))
        if len(full) and self.vocabulary.words:
            top = np.zeros(len(texts), dtype=np.uint32)
            top[full] = np.maximum.reduceat(points, offsets[full])
            fit &= top < LIMIT
            for i in np.flatnonzero(fit & (top >= _SURE)).tolist():
                fit[i] = unicodedata.is_normalized("NFC", texts[i])
            odd = np.flatnonzero(lowered()[np.minimum(points, LIMIT - 1)] == 0xFFFFFFFF)
            fit[np.searchsorted(offsets, odd, side="right") - 1] = False
        return fit

    def segmented(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """fit of each text, characters, and starts, ends and rows of the pre-tokens of those that fit."""
        points, offsets = codepoints(texts)
        fit = self._fit(texts, points, offsets)
        if not fit.all():
            points, offsets = codepoints([t if f else "" for t, f in zip(texts, fit.tolist(), strict=True)])
        if self.vocabulary.words and len(points):
            points = lowered()[points]
        cut = self.vocabulary.cut_at
        found = [(at + m.start(), at + m.end()) for t, f, at in zip(texts, fit.tolist(), offsets.tolist(), strict=False) if f for m in cut.finditer(t)] if cut else []
        if not found:
            return fit, points, *segment(points, offsets, blanks=not self.vocabulary.words, single_numbers=self.vocabulary.words)
        opens, closes = np.array(found, dtype=np.int64).T
        starts, ends, _ = segment(points, np.unique(np.concatenate((offsets, opens, closes))), blanks=True, single_numbers=False)
        last = np.searchsorted(opens, starts, side="right") - 1
        outside = (last < 0) | (starts >= closes[last])
        starts, ends = np.concatenate((starts[outside], opens)), np.concatenate((ends[outside], closes))
        order = np.argsort(starts, kind="stable")
        return fit, points, starts[order], ends[order], np.searchsorted(offsets, starts[order], side="right") - 1

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids and row offsets. Long texts go through in windows, which are cut where every pre-token ends."""
        parts, per = [np.zeros(0, dtype=np.uint32)], np.zeros(len(texts), dtype=np.int64)
        for rows, group in pieces(texts):
            ids, offsets = self._encode(group)
            parts.append(ids)
            np.add.at(per, rows, np.diff(offsets))
        return np.concatenate(parts), np.concatenate(([0], np.cumsum(per))).astype(np.int64)

    def _encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        fit, points, starts, ends, row = self.segmented(texts)
        if len(starts):
            at, count = self.memo.look_up(points, starts, ends)
            ids = gather(self.memo.ids, at, count)
            per = np.bincount(row, weights=count, minlength=len(texts)).astype(np.int64)
        else:
            ids, per = np.zeros(0, dtype=np.uint32), np.zeros(len(texts), dtype=np.int64)
        out = np.concatenate(([0], np.cumsum(per))).astype(np.int64)
        if fit.all():
            return ids, out
        parts = [ids[out[i] : out[i + 1]] if f else np.array(self.vocabulary.whole(t), dtype=np.uint32) for i, (t, f) in enumerate(zip(texts, fit, strict=True))]
        return np.concatenate(parts), np.concatenate(([0], np.cumsum([len(p) for p in parts]))).astype(np.int64)
