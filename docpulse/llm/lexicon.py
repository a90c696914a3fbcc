"""A minimal acyclic transducer from words to token ids, in one file that tasks map into memory.

Words are added in order of their bytes (Daciuk et al., Computational Linguistics 26:1, 2000): what can no longer change
is shared with an equal state, so that common suffixes are kept once. An arc adds the number of words that come before
those behind it, hence the sum along a word is its rank, which selects its ids.
"""

from __future__ import annotations

import mmap
from array import array
from collections.abc import Iterable, Sequence

import numpy as np

BYTES = [bytes([b]) for b in range(256)]


def build(entries: Iterable[tuple[bytes, Sequence[int]]]) -> bytes:
    """The file's bytes, for (word, ids) with different words."""
    entries = sorted(entries)
    shared: dict[tuple, int] = {}
    first, final, label, target, add = array("i"), array("i"), array("B"), array("i"), array("i")
    size: list[int] = []  # words behind a state

    def close(node: list) -> int:
        """Number of the state equal to ``node`` = [final, [(label, state)]]."""
        key = (node[0], tuple(node[1]))
        if key not in shared:
            shared[key] = len(size)
            first.append(len(label))
            final.append(node[0])
            words = node[0]
            for byte, to in node[1]:
                label.append(byte)
                target.append(to)
                add.append(words)
                words += size[to]
            size.append(words)
        return shared[key]

    path: list[list] = [[0, []]]
    before = b""
    for word, _ in entries:
        keep = next((i for i, (a, b) in enumerate(zip(before, word)) if a != b), min(len(before), len(word)))
        while len(path) > keep + 1:
            done = path.pop()
            path[-1][1].append((before[len(path) - 1], close(done)))
        path.extend([0, []] for _ in word[keep:])
        path[-1][0], before = 1, word
    while len(path) > 1:
        done = path.pop()
        path[-1][1].append((before[len(path) - 1], close(done)))
    root = close(path[0])
    first.append(len(label))
    starts = np.cumsum([0] + [len(ids) for _, ids in entries], dtype=np.int32)
    ids = [i for _, own in entries for i in own]
    parts = [first, final, target, add, starts, ids]
    head = np.array([root, *map(len, parts)], dtype=np.int32)
    return b"".join([head.tobytes(), *[np.asarray(p, dtype=np.int32).tobytes() for p in parts], bytes(label), bytes(-len(label) % 4)])


class Lexicon:
    """A file made by ``build``, mapped into memory: pages are shared by the tasks of a machine."""

    def __init__(self, path: str):
        with open(path, "rb") as file:
            self.file = mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ)
        view = memoryview(self.file).cast("i")
        self.root, ends = view[0], np.cumsum([7, *view[1:7].tolist()]).tolist()
        self.first, self.final, self.target, self.add, self.starts, self.ids = (
            view[a:b] for a, b in zip(ends, ends[1:]))
        self.labels = 4 * ends[-1]
        self.arcs = None

    def get(self, word: bytes) -> list[int] | None:
        """Ids of ``word``; None if it was not compiled in."""
        first, target, add, find, labels = self.first, self.target, self.add, self.file.find, self.labels
        state, rank = self.root, 0
        for byte in word:
            arc = find(BYTES[byte], labels + first[state], labels + first[state + 1]) - labels
            if arc < 0:
                return None
            rank += add[arc]
            state = target[arc]
        return self.ids[self.starts[rank]:self.starts[rank + 1]].tolist() if self.final[state] else None

    def get_many(self, words: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Which of ``words`` were compiled in, their ids one after the other, and how many each has.

        All words go along the automaton together, a byte at a time: the arcs are in order of (state, label).
        """
        if self.arcs is None:
            first = np.array(self.first, np.int64)
            labels = np.frombuffer(self.file, np.uint8, int(first[-1]), self.labels)
            self.arcs = np.repeat(np.arange(len(first) - 1), np.diff(first)) << 8 | labels
        target, add, starts = (np.frombuffer(v, np.int32) for v in (self.target, self.add, self.starts))
        sizes = np.array(list(map(len, words)), np.int64)
        data, begin = np.frombuffer(b"".join(words), np.uint8), np.cumsum(sizes) - sizes
        state, rank = np.full(len(words), self.root, np.int64), np.zeros(len(words), np.int64)
        alive, at = np.ones(len(words), bool), 0
        on = np.flatnonzero(sizes > 0)
        while len(on):
            wanted = state[on] << 8 | data[begin[on] + at]
            arc = np.minimum(np.searchsorted(self.arcs, wanted), max(0, len(self.arcs) - 1))
            found = self.arcs[arc] == wanted if len(self.arcs) else np.zeros(len(on), bool)
            alive[on[~found]] = False
            on, arc = on[found], arc[found]
            rank[on] += add[arc]
            state[on] = target[arc]
            at += 1
            on = on[sizes[on] > at]
        alive &= np.frombuffer(self.final, np.int32)[state] > 0
        rank = rank[alive]
        n = (starts[rank + 1] - starts[rank]).astype(np.int64)
        ends = np.cumsum(n)
        place = np.repeat(starts[rank] - ends + n, n) + np.arange(ends[-1] if len(ends) else 0)
        return alive, np.frombuffer(self.ids, np.int32)[place], n
