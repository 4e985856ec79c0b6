"""Mergeable radix tries over byte strings, with counters at their leaves.

A trie is packed in preorder: each leaf says how many bytes it shares with the
path to the leaf before it and which bytes it adds; the inner nodes are the
places where that shared length falls, and need no storage of their own.  Byte
order is the order of code points for UTF-8, so a walk gives the keys in it.
Every part below a prefix is a trie of its own: tries are cut by prefix, moved
as rows, and merged by a walk of their leaves side by side.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np

#: So many first bytes of neighbouring keys are compared at once; what they share beyond is looked at one by one.
_HEAD = 16


def _starts(sizes: np.ndarray) -> np.ndarray:
    """Where each of the stretches of these sizes begins, and where the last one ends."""
    return np.concatenate(([0], np.cumsum(sizes, dtype=np.int64)))


def shared_with_last(keys: Sequence[bytes]) -> np.ndarray:
    """How many bytes each of the sorted keys shares with the one before it; none for the first."""
    n = len(keys)
    out = np.zeros(n, np.int32)
    if n > 1:
        head = np.array([k[:_HEAD].ljust(_HEAD, b"\0") for k in keys], f"S{_HEAD}").view(np.uint8).reshape(n, _HEAD)
        sizes = np.fromiter(map(len, keys), np.int64, n)
        same = np.cumprod(head[1:] == head[:-1], axis=1, dtype=np.int8).sum(axis=1, dtype=np.int64)
        out[1:] = np.minimum(same, np.minimum(sizes[1:], sizes[:-1]))
        for i in (np.flatnonzero(out == _HEAD)).tolist():
            a, b = keys[i - 1], keys[i]
            low, high = _HEAD, min(len(a), len(b)) + 1  # the first `low` bytes agree, `high` of them don't or aren't there
            while high - low > 1:
                mid = (low + high) // 2
                low, high = (mid, high) if a[_HEAD:mid] == b[_HEAD:mid] else (low, mid)
            out[i] = low
    return out


@dataclass
class Trie:
    """Leaves in byte order: ``depth`` bytes shared, ``length`` bytes added, ``labels`` in a row; documents of each; counters as ``sizes`` per leaf of (``code``, ``count``)."""

    depth: np.ndarray
    length: np.ndarray
    labels: bytes
    docs: np.ndarray
    sizes: np.ndarray
    code: np.ndarray
    count: np.ndarray

    #: The columns that a packed trie takes up in a row.
    COLUMNS = "depth binary, length binary, labels binary, docs binary, sizes binary, code binary, count binary"
    NAMES = ("depth", "length", "labels", "docs", "sizes", "code", "count")
    _TYPES = {"depth": np.int32, "length": np.int32, "docs": np.int64, "sizes": np.int32, "code": np.int32, "count": np.int64}

    @classmethod
    def of(cls, keys: Sequence[bytes], docs: np.ndarray, sizes: np.ndarray, code: np.ndarray, count: np.ndarray, depth: np.ndarray | None = None) -> Trie:
        """From sorted different keys; ``depth``, if known, may count bytes shared with a key before the first."""
        depth = shared_with_last(keys) if depth is None else depth.copy()
        depth[:1] = 0
        labels = [k[d:] for k, d in zip(keys, depth.tolist(), strict=True)]
        return cls(depth, np.fromiter(map(len, labels), np.int32, len(labels)), b"".join(labels), docs, sizes, code, count)

    def __len__(self) -> int:
        return len(self.depth)

    def keys(self) -> list[bytes]:
        out, path, at = [], b"", 0
        for d, n in zip(self.depth.tolist(), self.length.tolist(), strict=True):
            path = path[:d] + self.labels[at : at + n]
            at += n
            out.append(path)
        return out

    def packed(self) -> tuple[bytes, ...]:
        return tuple(self.labels if n == "labels" else getattr(self, n).astype(t, copy=False).tobytes() for n, t in ((n, self._TYPES.get(n)) for n in self.NAMES))

    @classmethod
    def unpacked(cls, *columns: bytes) -> Trie:
        return cls(*(c if n == "labels" else np.frombuffer(c, cls._TYPES[n]) for n, c in zip(cls.NAMES, columns, strict=True)))

    def cut(self, depth: int, keys: list[bytes] | None = None) -> Iterator[tuple[bytes, Trie]]:
        """The tries below each prefix of ``depth`` bytes, in order; a shorter key is a prefix of its own."""
        keys = self.keys() if keys is None else keys
        first = np.flatnonzero(self.depth < depth).tolist()
        at = _starts(self.sizes)
        for a, b in zip(first, [*first[1:], len(keys)], strict=True):
            x, y = at[a], at[b]
            yield keys[a][:depth], Trie.of(keys[a:b], self.docs[a:b], self.sizes[a:b], self.code[x:y], self.count[x:y], self.depth[a:b])


def merged(tries: Sequence[Trie]) -> tuple[list[bytes], Trie]:
    """One trie of all leaves, and its keys: documents added up, counters of equal code too, codes in order at each leaf."""
    all_keys: list[bytes] = []
    for t in tries:
        all_keys += t.keys()
    order = np.array(sorted(range(len(all_keys)), key=all_keys.__getitem__), np.int64)
    keys: list[bytes] = []
    leaf = np.empty(len(all_keys), np.int64)
    for i in order.tolist():
        k = all_keys[i]
        if not keys or keys[-1] != k:
            keys.append(k)
        leaf[i] = len(keys) - 1
    docs = np.zeros(len(keys), np.int64)
    np.add.at(docs, leaf, np.concatenate([t.docs for t in tries]))
    of = np.repeat(leaf, np.concatenate([t.sizes for t in tries]))
    code, count = np.concatenate([t.code for t in tries]), np.concatenate([t.count for t in tries])
    return keys, _with_counters(keys, docs, of, code, count)


def _with_counters(keys: list[bytes], docs: np.ndarray, leaf: np.ndarray, code: np.ndarray, count: np.ndarray) -> Trie:
    """A trie whose counters come as (leaf, code, count) in any order, several of one leaf and code added up."""
    order = np.lexsort((code, leaf))
    leaf, code, count = leaf[order], code[order], count[order]
    if len(leaf):
        new = np.flatnonzero(np.concatenate(([True], (leaf[1:] != leaf[:-1]) | (code[1:] != code[:-1]))))
        leaf, code, count = leaf[new], code[new], np.add.reduceat(count, new)
    sizes = np.bincount(leaf, minlength=len(keys)).astype(np.int32)
    return Trie.of(keys, docs, sizes, code.astype(np.int32), count.astype(np.int64))


def of_counts(docs: dict[bytes, int], counts: Sequence[dict[bytes, int]]) -> tuple[list[bytes], Trie]:
    """The trie of terms with the documents that have each, and of a count for each of several counters; and its keys."""
    keys = sorted(docs)
    place = dict(zip(keys, range(len(keys)), strict=True))
    n = [len(c) for c in counts]
    leaf = np.concatenate([np.zeros(0, np.int64), *(np.fromiter(map(place.__getitem__, c), np.int64, len(c)) for c in counts)])
    count = np.concatenate([np.zeros(0, np.int64), *(np.fromiter(c.values(), np.int64, len(c)) for c in counts)])
    code = np.repeat(np.arange(len(counts), dtype=np.int32), n)
    return keys, _with_counters(keys, np.fromiter(map(docs.__getitem__, keys), np.int64, len(keys)), leaf, code, count)
