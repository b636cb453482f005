"""A minimal acyclic transducer from words to token ids, in one memory-mapped file.

Sorted words are added one by one; the path of the last word is frozen from its end as soon as the next word leaves
it, and equal frozen states are shared, so the automaton is minimal for its words. Each arc carries the number of words that come before
those through it: the sum along a word's path is the word's number, under which its ids stand in the file.
"""

from __future__ import annotations

import json
import mmap

import numpy as np

_MAGIC = b"GLEANLEX"


def compile_lexicon(entries: dict[bytes, list[int]]) -> bytes:
    """The file for words (as UTF-8) and their ids."""
    words = sorted(w for w in entries if w)
    arcs: list[list[tuple[int, int]]] = []  # frozen states: (byte, target), ascending
    final: list[bool] = []
    below: list[int] = []  # words accepted from each state
    register: dict[tuple, int] = {}

    def freeze(node: list) -> int:
        sign = (node[0], tuple(node[1]))
        at = register.get(sign)
        if at is None:
            at = register[sign] = len(arcs)
            arcs.append(list(node[1]))
            final.append(node[0])
            below.append(int(node[0]) + sum(below[t] for _, t in node[1]))
        return at

    path: list[list] = [[False, []]]  # open states of the last word: final, arcs to frozen states
    last = b""
    for word in words:
        same = 0
        while same < len(last) and same < len(word) and last[same] == word[same]:
            same += 1
        for k in range(len(last), same, -1):
            target = freeze(path.pop())
            path[-1][1].append((last[k - 1], target))
        for _ in range(same, len(word)):
            path.append([False, []])
        path[-1][0] = True
        last = word
    for k in range(len(last), 0, -1):
        target = freeze(path.pop())
        path[-1][1].append((last[k - 1], target))
    root = freeze(path.pop())

    key, target, out = [], [], []
    for state, own in enumerate(arcs):
        before = int(final[state])
        for label, to in own:
            key.append(state << 8 | label)
            target.append(to)
            out.append(before)
            before += below[to]
    counts = np.array([len(entries[w]) for w in words], dtype=np.int64)
    parts = {
        "key": np.array(key, dtype=np.int64), "target": np.array(target, dtype=np.int32), "out": np.array(out, dtype=np.int32),
        "final": np.array(final, dtype=np.uint8), "start": np.concatenate(([0], np.cumsum(counts))).astype(np.int64),
        "ids": np.array([i for w in words for i in entries[w]], dtype=np.uint32),
    }
    head = json.dumps({"root": root, "parts": [[k, v.dtype.str, len(v)] for k, v in parts.items()]}).encode()
    head += b" " * (-len(head) % 8)
    body = b"".join(v.tobytes() + b"\0" * (-v.nbytes % 8) for v in parts.values())
    return _MAGIC + len(head).to_bytes(8, "little") + head + body


class Lexicon:
    """Looks words up in a compiled file; the arrays are views of the mapped pages."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self._map = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
        if self._map[:8] != _MAGIC:
            raise ValueError(f"{path} is no lexicon")
        size = int.from_bytes(self._map[8:16], "little")
        head = json.loads(self._map[16 : 16 + size])
        at = 16 + size
        self.root = head["root"]
        for name, kind, n in head["parts"]:
            setattr(self, name, np.frombuffer(self._map, dtype=kind, count=n, offset=at))
            at += (n * np.dtype(kind).itemsize + 7) // 8 * 8

    @property
    def n_words(self) -> int:
        return len(self.start) - 1

    def numbers(self, words: list[bytes]) -> np.ndarray:
        """The number of each word, -1 if it isn't there; all words walk the automaton together."""
        n = len(words)
        length = np.array([len(w) for w in words], dtype=np.int64)
        flat = np.frombuffer(b"".join(words), dtype=np.uint8)
        begin = np.concatenate(([0], np.cumsum(length)[:-1])) if n else length
        state, number = np.full(n, self.root, dtype=np.int64), np.zeros(n, dtype=np.int64)
        live = np.flatnonzero(length > 0)
        if not len(self.key):
            return np.full(n, -1, dtype=np.int64)
        step = 0
        while len(live):
            want = state[live] << 8 | flat[begin[live] + step]
            at = np.minimum(np.searchsorted(self.key, want), len(self.key) - 1)
            hit = self.key[at] == want
            number[live[~hit]] = -1
            live, at = live[hit], at[hit]
            state[live] = self.target[at]
            number[live] += self.out[at]
            step += 1
            live = live[length[live] > step]
        number[(number >= 0) & (self.final[state] == 0) | (length == 0)] = -1
        return number

    def ids_of(self, number: int) -> list[int]:
        return self.ids[self.start[number] : self.start[number + 1]].tolist()
