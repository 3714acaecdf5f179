"""A minimal acyclic transducer from words to token ids.

The automaton is built from sorted words, so equal suffixes are shared as soon
as they are complete. Its additive outputs number the words in byte order, and
the number points into a table of id lists. Everything is a flat array in one
file, which a task maps into memory and looks up for many words at once.
"""

from __future__ import annotations

import mmap
import struct

import numpy as np

_MAGIC = b"LEXICON1"
_FIELDS = (("keys", np.int64), ("targets", np.int32), ("skips", np.int32), ("final", np.uint8),
           ("offsets", np.int32), ("ids", np.uint32))


def compiled(entries: dict[bytes, list[int]]) -> bytes:
    """The file of a lexicon: ``keys`` are (state << 8 | byte) in order, ``skips``
    what a transition adds to a word's number; state 0 is the start."""
    register: dict[tuple, int] = {}
    states: list[tuple] = []
    below: list[int] = []  # words that a state still reaches

    def freeze(node):
        key = (node[0], tuple(node[1]))
        found = register.get(key)
        if found is None:
            found = register[key] = len(states)
            states.append(key)
            below.append(node[0] + sum(below[t] for _, t in node[1]))
        return found

    path, last = [[0, []]], b""

    def close(depth):
        while len(path) > depth + 1:
            target = freeze(path.pop())
            path[-1][1].append((last[len(path) - 1], target))

    words = sorted(entries)
    for word in words:
        same = 0
        while same < len(last) and same < len(word) and last[same] == word[same]:
            same += 1
        close(same)
        path.extend([0, []] for _ in range(len(word) - same))
        path[-1][0] = 1
        last = word
    close(0)
    root = freeze(path[0])
    number = {s: i for i, s in enumerate([root] + [s for s in range(len(states)) if s != root])}
    keys, targets, skips = [], [], []
    final = np.zeros(len(states), np.uint8)
    for state in sorted(number, key=number.get):
        end, out = states[state]
        final[number[state]] = end
        skip = end
        for label, target in out:
            keys.append(number[state] << 8 | label)
            targets.append(number[target])
            skips.append(skip)
            skip += below[target]
    lists = [entries[w] for w in words]
    values = {"keys": keys, "targets": targets, "skips": skips, "final": final,
              "offsets": np.concatenate([[0], np.cumsum([len(x) for x in lists])]),
              "ids": [i for x in lists for i in x]}
    out = [_MAGIC]
    for name, kind in _FIELDS:
        data = np.asarray(values[name], dtype=kind).tobytes()
        out.append(struct.pack("<q", len(data)) + data + b"\0" * (-len(data) % 8))
    return b"".join(out)


class Lexicon:
    def __init__(self, path: str):
        with open(path, "rb") as f:
            data = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
        if data[:8] != _MAGIC:
            raise ValueError(f"{path} is not a lexicon")
        at = 8
        for name, kind in _FIELDS:
            (size,) = struct.unpack_from("<q", data, at)
            setattr(self, name, np.frombuffer(data, kind, size // np.dtype(kind).itemsize, at + 8))
            at += 8 + size + -size % 8

    def find(self, words: list[bytes]) -> np.ndarray:
        """The number of each word, -1 where the lexicon does not have it."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        flat = np.frombuffer(b"".join(words), np.uint8)
        starts = np.cumsum(sizes) - sizes
        state = np.zeros(len(words), np.int64)
        number = np.zeros(len(words), np.int64)
        live = np.arange(len(words)) if len(self.keys) else np.zeros(0, np.int64)
        if not len(self.keys):
            state[:] = -1
        depth = 0
        while len(live):
            live = live[sizes[live] > depth]
            key = state[live] << 8 | flat[starts[live] + depth]
            at = np.searchsorted(self.keys, key)
            at[at == len(self.keys)] = 0
            hit = self.keys[at] == key
            state[live[~hit]] = -1
            live, at = live[hit], at[hit]
            state[live] = self.targets[at]
            number[live] += self.skips[at]
            depth += 1
        found = state >= 0
        found[found] = self.final[state[found]] == 1
        return np.where(found, number, -1)
