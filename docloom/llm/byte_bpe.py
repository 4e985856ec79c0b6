"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

Each match of the pattern is merged on its own.  Adjacent pairs of parts that
have a rank lie in buckets, one per rank, which hold positions in a linked list
of parts.  Which buckets are in use is kept in a bitmap of three levels of
64-bit words; find-first-set on each level gives the lowest rank in use.
Merging a pair leaves the entries of its old neighbours in their buckets; such
stale entries are recognised and skipped when they come up.

A very long match has a queue of its own (``Codec.merge``), in which a merge
costs the same however long the match is.  The short matches that a worker
hasn't met yet share one queue (``Codec.merge_all``): they lie one after the
other in one linked list, whose links end where a match ends, and a bucket is
taken once for all of them.  No merge crosses a match's end, so each match is
merged in its own order: lowest rank first, leftmost among equals.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from docloom.llm.common import id_and_text, proven_split, texts

#: Bytes that a worker's cache of encoded matches may take (estimated), and the longest match that it keeps, in characters.
CACHE_BYTES, CACHE_CHARS = 48 << 20, 32
#: Bytes of a cached match beside its characters and ids: string, bytes object and place in the dictionary.
ENTRY_BYTES = 180
#: Characters of a long text that are matched at once.
PIECE_CHARS = 1 << 20
#: Characters of texts whose new matches are merged in one queue, and ids put out in one batch.
GROUP_CHARS, OUT_IDS = 8 << 20, 1 << 19
#: Buckets of up to so many positions are merged one by one.
FEW = 6


def load_ranks(path: str) -> dict[bytes, int]:
    """The ranks of a .tiktoken file."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class RankQueue:
    """A queue of (rank, position) with the lowest rank first.

    ``low``, ``mid`` and ``top`` are the bitmap's levels: bit r of ``low`` says
    that bucket r has entries, each bit above says that the word below isn't 0.
    """

    __slots__ = ("buckets", "low", "mid", "top")

    def __init__(self, n_ranks: int):
        words = (n_ranks >> 6) + 1
        self.buckets: dict[int, list] = {}
        self.low = [0] * words
        self.mid = [0] * ((words >> 6) + 1)
        self.top = 0

    def push(self, rank: int, position) -> None:
        """Add an entry: a position or an array of positions."""
        bucket = self.buckets.get(rank)
        if bucket is None:
            self.buckets[rank] = [position]
            w, v = rank >> 6, rank >> 12
            self.low[w] |= 1 << (rank & 63)
            self.mid[v] |= 1 << (w & 63)
            self.top |= 1 << v
        else:
            bucket.append(position)

    def first(self) -> int:
        """The lowest rank in use, or -1."""
        if not self.top:
            return -1
        v = (self.top & -self.top).bit_length() - 1
        m = self.mid[v]
        w = (v << 6) + (m & -m).bit_length() - 1
        x = self.low[w]
        return (w << 6) + (x & -x).bit_length() - 1

    def take(self, rank: int) -> list:
        """Remove and return a bucket."""
        w, v = rank >> 6, rank >> 12
        self.low[w] ^= 1 << (rank & 63)
        if not self.low[w]:
            self.mid[v] ^= 1 << (w & 63)
            if not self.mid[v]:
                self.top ^= 1 << v
        return self.buckets.pop(rank)


class Codec:
    """Encodes and decodes by the ranks of one file; made once a worker process."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, cache_bytes: int = CACHE_BYTES):
        import regex

        self.pattern = regex.compile(pattern)
        self.ranks = ranks
        self.n_ranks = max(ranks.values(), default=0) + 1
        self.queue = RankQueue(self.n_ranks)
        self.vocabulary: list[bytes] = [b""] * self.n_ranks
        for token, rank in ranks.items():
            self.vocabulary[rank] = token
        self.cache: dict[str, bytes] = {}
        self.cache_bytes, self.cached = cache_bytes, 0
        self.pairs: dict[int, int] | None = None

    # one long match

    def merge(self, data: bytes) -> list[int]:
        """The ids of one match."""
        ranks = self.ranks
        if (whole := ranks.get(data)) is not None:
            return [whole]
        n = len(data)
        ends = list(range(1, n + 1))  # where the part that begins here ends; 0: none begins here
        before = list(range(-1, n))
        due = [-1] * n  # the rank of the pair that begins here: an entry of another rank is stale
        queue, get = self.queue, ranks.get
        push = queue.push
        for i in range(n - 1):
            if (r := get(data[i : i + 2])) is not None:
                due[i] = r
                push(r, i)
        while (rank := queue.first()) >= 0:
            bucket = queue.take(rank)
            if len(bucket) > 1:
                bucket.sort()
            for k, i in enumerate(bucket):
                if due[i] != rank:
                    continue  # stale
                j = ends[i]
                end = ends[j]
                ends[i] = end
                ends[j] = 0
                due[j] = -1
                again = False
                if end < n:
                    before[end] = i
                    r = get(data[i : ends[end]])
                    due[i] = -1 if r is None else r
                    if r is not None:
                        push(r, i)
                        again = r < rank
                else:
                    due[i] = -1
                if i > 0:
                    p = before[i]
                    r = get(data[p:end])
                    due[p] = -1 if r is None else r
                    if r is not None:
                        push(r, p)
                        again = again or r < rank
                if again and k + 1 < len(bucket):  # a lower rank has come up: it goes first
                    for x in bucket[k + 1 :]:
                        if due[x] == rank:
                            push(rank, x)
                    break
        out, i = [], 0
        while i < n:
            out.append(ranks[data[i : ends[i]]])
            i = ends[i]
        return out

    # many short matches

    def _pairs(self) -> None:
        """Ranks by pair of ids: each token by each of its splits into two tokens."""
        n = self.n_ranks
        self.pairs = {}
        for token, rank in self.ranks.items():
            for i in range(1, len(token)):
                a, b = self.ranks.get(token[:i]), self.ranks.get(token[i:])
                if a is not None and b is not None:
                    self.pairs[a * n + b] = rank
        self.pair_keys = np.array(sorted(self.pairs), np.int64)
        self.pair_ranks = np.array([self.pairs[int(k)] for k in self.pair_keys], np.int32)
        self.of_byte = np.array([self.ranks.get(bytes([x]), -1) for x in range(256)], np.int64)

    def _rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left * self.n_ranks + right
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == key, self.pair_ranks[at], -1)

    def _push_all(self, ranks: np.ndarray, positions: np.ndarray) -> None:
        order = np.argsort(ranks, kind="stable")
        ranks, positions = ranks[order], positions[order]
        edges = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
        for rank, part in zip(ranks[np.concatenate(([0], edges))].tolist(), np.split(positions, edges), strict=True):
            self.queue.push(rank, part)

    def merge_all(self, words: list[bytes]) -> list[bytes]:
        """The packed ids of each match, all merged in one queue."""
        if self.pairs is None:
            self._pairs()
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        raw = np.frombuffer(b"".join(words), np.uint8)
        n = len(raw)
        starts = np.cumsum(sizes) - sizes
        of = np.repeat(np.arange(len(words)), sizes)
        ids = self.of_byte[raw]
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        after[starts + sizes - 1] = -1
        before[starts] = -1
        here = np.ones(n, bool)
        due = np.full(n, -1, np.int64)  # the rank of the pair that begins here: an entry of another rank is stale
        if len(self.pair_keys) and n > 1:
            inner = np.flatnonzero(after >= 0)
            due[inner] = self._rank_of(ids[inner], ids[inner + 1])
            some = np.flatnonzero(due >= 0)
            if len(some):
                self._push_all(due[some], some)
        queue = self.queue
        one = ids.data, after.data, before.data, here.data, due.data
        while (rank := queue.first()) >= 0:
            entries = queue.take(rank)
            at = entries[0] if len(entries) == 1 and not isinstance(entries[0], int) else np.concatenate([np.atleast_1d(x) for x in entries])
            at = at[due[at] == rank]  # stale entries go
            if len(at) == 0:
                continue
            if len(at) > 1:
                at = np.unique(at)
                first = np.ones(len(at), bool)
                first[1:] = of[at[1:]] != of[at[:-1]]
                if not first.all():  # only the leftmost of each match: it may bring up a lower rank, which then goes first
                    queue.push(rank, at[~first])
                    at = at[first]
            if len(at) <= FEW:
                self._merge_few(rank, at.tolist(), *one)
            else:
                self._merge_bucket(rank, at, ids, after, before, here, due)
        ends = np.cumsum(np.add.reduceat(here, starts, dtype=np.int64)) * 4
        packed = ids[here].astype("<u4").tobytes()
        return [packed[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)]

    def _merge_few(self, rank, at, ids, after, before, here, due) -> None:
        get, push, n = self.pairs.get, self.queue.push, self.n_ranks
        for i in at:
            j = after[i]
            k = after[j]
            ids[i], after[i], here[j], due[j], due[i] = rank, k, False, -1, -1
            if k >= 0:
                before[k] = i
                if (r := get(rank * n + ids[k])) is not None:
                    due[i] = r
                    push(r, i)
            if (p := before[i]) >= 0:
                if (r := get(ids[p] * n + rank)) is not None:
                    due[p] = r
                    push(r, p)
                else:
                    due[p] = -1

    def _merge_bucket(self, rank, i, ids, after, before, here, due) -> None:
        j = after[i]
        k = after[j]
        ids[i], after[i], here[j], due[j], due[i] = rank, k, False, -1, -1
        right = k >= 0
        before[k[right]] = i[right]
        r_right = self._rank_of(ids[i[right]], ids[k[right]])
        due[i[right]] = r_right
        p = before[i]
        left = p >= 0
        r_left = self._rank_of(ids[p[left]], ids[i[left]])
        due[p[left]] = r_left
        ranks, at = np.concatenate((r_right, r_left)), np.concatenate((i[right], p[left]))
        some = ranks >= 0
        if some.any():
            self._push_all(ranks[some], at[some])

    # texts

    def _learn(self, matches: set[str]) -> dict[str, bytes]:
        """The packed ids of matches that aren't cached; what is short enough is cached."""
        got, short, rest = {}, [], []
        for m in matches:
            data = m.encode()
            if (whole := self.ranks.get(data)) is not None:
                got[m] = struct.pack("<I", whole)
            elif len(m) <= CACHE_CHARS:
                short.append(m)
                rest.append(data)
            else:
                got[m] = np.array(self.merge(data), "<u4").tobytes()
        if short:
            got.update(zip(short, self.merge_all(rest), strict=True))
        for m, ids in got.items():
            if len(m) <= CACHE_CHARS:
                self.cache[m] = ids
                self.cached += ENTRY_BYTES + len(m) + len(ids)
        while self.cached > self.cache_bytes:  # the older half goes
            for m in list(islice(self.cache, (len(self.cache) + 1) // 2)):
                self.cached -= ENTRY_BYTES + len(m) + len(self.cache.pop(m))
        return got

    def _parts(self, text: str, piece: int) -> Iterator[str]:
        """The text in parts that end where the pattern must split."""
        start, n = 0, len(text)
        while start < n:
            end, wide = n, piece
            while start + wide < n:
                end = proven_split(text, start, start + wide)
                if end > 0:
                    break
                end, wide = n, wide * 2
            yield text if end - start == n else text[start:end]
            start = end

    def encode_all(self, texts: list[str]) -> Iterator[bytes]:
        """The packed ids of each text; the new matches of all are merged in one queue."""
        found, missed = [], set()
        for text in texts:
            matches = self.pattern.findall(text)
            ids = list(map(self.cache.get, matches))
            if None in ids:
                gaps = [i for i, x in enumerate(ids) if x is None]
                names = [matches[i] for i in gaps]
                missed.update(names)
                found.append((ids, gaps, names))
            else:
                found.append((b"".join(ids), (), ()))
        new = self._learn(missed) if missed else {}
        for ids, gaps, names in found:
            for i, m in zip(gaps, names, strict=True):
                ids[i] = new[m]
            yield b"".join(ids) if gaps else ids

    def encode_blocks(self, text: str, piece: int = PIECE_CHARS) -> Iterator[bytes]:
        """Packed ids of a whole text, block by block."""
        for part in self._parts(text, piece):
            yield from self.encode_all([part])

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(b"".join(self.encode_blocks(text)), dtype="<u4").tolist()

    def decode(self, ids) -> bytes:
        return b"".join(map(self.vocabulary.__getitem__, ids))


_CODECS: dict[tuple[str, str], Codec] = {}


def codec_of(ranks_path: str, pattern: str) -> Codec:
    """This process's codec: a worker keeps it, and its cache, from task to task."""
    key = ranks_path, pattern
    if key not in _CODECS:
        _CODECS.clear()
        _CODECS[key] = Codec(load_ranks(ranks_path), pattern)
    return _CODECS[key]


def _grouped(ts: list[str], most: int) -> Iterator[list[str]]:
    """Runs of texts of up to ``most`` characters; a longer text is a run of its own."""
    held, chars = [], 0
    for t in ts:
        if held and chars + len(t) > most:
            yield held
            held, chars = [], 0
        held.append(t)
        chars += len(t)
    if held:
        yield held


class _Out:
    """Rows of the result, put into batches."""

    def __init__(self, ids: pa.Array, with_ids: bool):
        self.doc, self.with_ids, self.done = ids, with_ids, 0
        self.rows: list[tuple] = []
        self.held = 0

    def add(self, blocks: Iterator[bytes], codec: Codec) -> None:
        count, of_ids, of_bytes, kept, pieces = 0, hashlib.sha256(), hashlib.sha256(), [], []
        for block in blocks:
            of_ids.update(block)
            decoded = codec.decode(np.frombuffer(block, dtype="<u4").tolist())
            of_bytes.update(decoded)
            count += len(block) // 4
            if self.with_ids:
                kept.append(block)
                pieces.append(decoded)
        self.rows.append((count, of_ids.hexdigest(), of_bytes.hexdigest(), b"".join(kept), b"".join(pieces)))
        self.held += count

    def batch(self) -> pa.RecordBatch:
        n = len(self.rows)
        columns = [self.doc.slice(self.done, n), *(pa.array([r[i] for r in self.rows], t) for i, t in enumerate((pa.int64(), pa.string(), pa.string())))]
        names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
        if self.with_ids:
            ends = np.cumsum([0] + [r[0] for r in self.rows])
            flat = np.frombuffer(b"".join(r[3] for r in self.rows), "<i4")
            columns += [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32())), pa.array([r[4].decode("utf-8", "replace") for r in self.rows], pa.string())]
            names += ["ids", "decoded"]
        self.done += n
        self.rows, self.held = [], 0
        return pa.RecordBatch.from_arrays(columns, names)


def encode_decode(
    df: DataFrame,
    ranks_path: str,
    pattern: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """Rows (doc_id, n_tokens, ids_sha256, decoded_sha256), one per row of ``df``; no shuffle.

    ``with_ids`` adds the ids themselves, ``ids array<int>``, and the decoded
    text, ``decoded string``.  A null text is the empty text: no ids, the hash
    of no bytes.  A null id stays null; repeated rows are each encoded; an
    empty table gives an empty table; other columns are ignored.

    Memory of a worker: a batch of texts, its matches' places, a cache of
    ``CACHE_BYTES``, and the packed ids of up to ``OUT_IDS`` ids or one
    document.  Without ``with_ids`` a long text's ids are held block by block.
    """

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            codec, out = codec_of(ranks_path, pattern), _Out(batch.column("doc_id"), with_ids)
            for group in _grouped(texts(batch), GROUP_CHARS):
                if len(group) == 1:
                    encoded = [codec.encode_blocks(group[0])]
                else:
                    encoded = ([x] for x in codec.encode_all(group))
                for blocks in encoded:
                    out.add(blocks, codec)
                    if out.held >= OUT_IDS:
                        yield out.batch()
            if out.rows:
                yield out.batch()

    kind = df.schema[id_col].dataType.simpleString()
    schema = f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>, decoded string" * with_ids
    return id_and_text(df, id_col, text_col).mapInArrow(run, schema)
