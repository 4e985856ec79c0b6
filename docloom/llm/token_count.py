"""Token counts of whole documents by overlap resynchronisation.

A huge document isn't encoded in one piece.  It is cut into overlapping chunks;
each is encoded with offsets, and two neighbours are spliced at a boundary that
both have in their overlap and that is proven stable, so neither chunk's cut
can have shifted it.  Where the overlap holds no such boundary it is widened:
to the left up to the left chunk's last proven boundary, to the right by
doubling, until one is found or the document ends.

Proven boundaries, for a byte-level pre-tokeniser: no alternative of its
pattern holds a character that isn't white space before one that is, so a match
ends between the two whatever stands on either side; and a letter never shares
a match with a punctuation mark beside it, but for the apostrophe.  A chunk
thus falls into pieces that the library encodes alike alone and in place.  The
token offsets of short pieces are kept in a bounded cache; what a chunk has
besides goes to the library in one batch.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterator
from itertools import accumulate, islice

import pyarrow as pa
from pyspark.sql import DataFrame

from docloom.llm.common import id_and_text, texts

#: Longer documents are cut; the least overlap of two chunks, in characters.
CHUNK, OVERLAP = 4_096, 256
#: An overlap is never shorter: a special token's string always lies whole in one of two neighbours.
LEAST_OVERLAP = 64
#: Characters of texts whose new pieces are handed to the library at once.
BATCH_CHARS = 1 << 20
#: Bytes that a worker's cache of pieces may take (estimated), the longest piece that it keeps, and a piece's bytes beside its characters and tokens.
CACHE_BYTES, CACHE_CHARS, ENTRY_BYTES = 48 << 20, 64, 180
#: Pieces of more characters are cut between letters and punctuation too.
LONG_PIECE = 64

# Characters that some definition counts as white space, beside those that every definition does.
_ODD_SPACE = r"\x0b\x0c\x1c-\x1f\x85\xa0 ᠎ -​    　"
_ODD = re.compile(f"[{_ODD_SPACE}]")
_PIECE = re.compile(r"[ \n\r\t]*[^ \n\r\t]+|[ \n\r\t]+")
_SPACED = re.compile(f"[ \n\r\t{_ODD_SPACE}]*[^ \n\r\t{_ODD_SPACE}]+|[ \n\r\t{_ODD_SPACE}]+")
_LETTER, _MARK = r"A-Za-z\xe0-\xf6ぁ-ゖァ-ヺ一-龥가-힣", r"、。《-』！，：；？"
_BETWEEN = re.compile(f"(?<=[{_LETTER}])(?=[{_MARK}])|(?<=[{_MARK}])(?=[{_LETTER}])")


def pieces_of(text: str) -> list[str]:
    """The text cut at proven boundaries; joined, the pieces are the text."""
    out = _PIECE.findall(text) if not _ODD.search(text) else _with_odd_space(text)
    if any(len(x) > LONG_PIECE for x in out):
        return [part for x in out for part in (_BETWEEN.split(x) if len(x) > LONG_PIECE else (x,))]
    return out


def _with_odd_space(text: str) -> list[str]:
    """A piece begins only before plain white space that follows what no definition counts as white space."""
    out: list[list[str]] = []
    for x in _SPACED.findall(text):
        if out and x[0] not in " \n\r\t":
            out[-1].append(x)
        else:
            out.append([x])
    return ["".join(x) for x in out]


class Chunk:
    """text[start:end] in pieces; ``closed``: the last one ends with the text, not with the cut."""

    def __init__(self, text: str, start: int, end: int):
        self.start, self.end, self.closed = start, end, end == len(text)
        self.pieces = pieces_of(text[start:end])

    def starts(self) -> list[int]:
        return list(accumulate(map(len, self.pieces[:-1]), initial=self.start)) if self.pieces else []


def chunks_of(text: str, chunk: int, overlap: int, widened: list[int] | None = None) -> Iterator[list[str]]:
    """The pieces that count of each of a text's overlapping chunks, spliced at common boundaries.

    ``widened`` gets the start of each overlap that had to be widened.
    """
    overlap = max(overlap, LEAST_OVERLAP)
    chunk = max(chunk, 2 * overlap)
    n = len(text)
    left = Chunk(text, 0, min(n, chunk))
    while not left.closed:
        begins = left.starts()
        at = max(left.start, left.end - overlap)
        right = Chunk(text, at, min(n, at + chunk))
        p = _splice(begins, right.starts(), at)
        if p < 0:  # only the left chunk's last piece, or none, begins in the overlap: begin the right chunk with that piece
            if widened is not None:
                widened.append(at)
            p = begins[-1]
            size = chunk
            while True:
                right = Chunk(text, p, min(n, p + size))
                if len(right.pieces) > 1 or right.closed:
                    break
                size *= 2
            if p == left.start:  # nothing precedes it
                left = right
                continue
        elif p > right.start:
            k = right.starts().index(p)
            right.pieces, right.start = right.pieces[k:], p
        yield left.pieces[: begins.index(p)]
        left = right
    yield left.pieces


def _splice(left: list[int], right: list[int], at: int) -> int:
    """The last boundary after ``at``, where the right chunk was cut, that both have; -1 if there is none."""
    have = set(right)
    for p in reversed(left):
        if p <= at:
            return -1
        if p in have:
            return p
    return -1


class Counter:
    """Counts texts with a tokenizer file of the ``tokenizers`` library; made once a worker process."""

    def __init__(self, path: str, chunk: int = CHUNK, overlap: int = OVERLAP, cache_bytes: int = CACHE_BYTES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        self.tokenizer, self.chunk, self.overlap = Tokenizer.from_file(path), chunk, overlap
        self.cache: dict[str, bytes] = {}
        self.cache_bytes, self.cached = cache_bytes, 0
        special = self.tokenizer.get_added_tokens_decoder().values()
        #: Special strings that take up what stands beside them, or that a boundary may cut, leave no boundary proven.
        self.plain = all(not (t.lstrip or t.rstrip or t.single_word or t.normalized) and pieces_of(t.content) == [t.content] for t in special)

    def _encode(self, pieces: list[str]) -> list:
        """The offsets of each piece's tokens; their number is the piece's count."""
        out = []
        for e in self.tokenizer.encode_batch(pieces, add_special_tokens=False):
            begins = [a for a, _ in e.offsets]
            out.append(bytes(begins) if not begins or begins[-1] < 256 else array("I", begins))
        return out

    def _learn(self, missed: list[str]) -> dict:
        got = dict(zip(missed, self._encode(missed), strict=True))
        for x, tokens in got.items():
            if len(x) <= CACHE_CHARS:
                self.cache[x] = tokens
                self.cached += ENTRY_BYTES + len(x) + len(tokens)
        while self.cached > self.cache_bytes:  # the older half goes
            for x in list(islice(self.cache, (len(self.cache) + 1) // 2)):
                self.cached -= ENTRY_BYTES + len(x) + len(self.cache.pop(x))
        return got

    def _flush(self, held: list[tuple[int, list]], missed: list[str], out: list[int]) -> None:
        new = self._learn(missed) if missed else {}
        for i, found in held:
            out[i] += sum(len(new[x]) if isinstance(x, str) else len(x) for x in found)

    def counts(self, batch: list[str]) -> list[int]:
        out, held, missed, chars = [0] * len(batch), [], {}, 0
        get = self.cache.get
        for i, text in enumerate(batch):
            if not self.plain:
                out[i] = len(self.tokenizer.encode(text, add_special_tokens=False))
                continue
            for pieces in chunks_of(text, self.chunk, self.overlap):
                found = list(map(get, pieces))
                if None in found:
                    found = [x if y is None else y for x, y in zip(pieces, found, strict=True)]
                    missed.update((x, None) for x in found if isinstance(x, str))
                    held.append((i, found))
                else:
                    out[i] += sum(map(len, found))
                chars += sum(map(len, pieces))
                if chars >= BATCH_CHARS:
                    self._flush(held, list(missed), out)
                    held, missed, chars = [], {}, 0
        self._flush(held, list(missed), out)
        return out


def count_chunked(tokenizer: Counter, text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> int:
    """The tokens of one text, cut into chunks of the given size."""
    had = tokenizer.chunk, tokenizer.overlap
    tokenizer.chunk, tokenizer.overlap = chunk, overlap
    try:
        return tokenizer.counts([text])[0]
    finally:
        tokenizer.chunk, tokenizer.overlap = had


_COUNTERS: dict[tuple, Counter] = {}


def counter_of(path: str, chunk: int, overlap: int) -> Counter:
    """This process's counter: a worker keeps it, and its cache, from task to task."""
    key = path, chunk, overlap
    if key not in _COUNTERS:
        _COUNTERS.clear()
        _COUNTERS[key] = Counter(path, chunk, overlap)
    return _COUNTERS[key]


def token_counts(
    df: DataFrame,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    limit: int = 512,
    chunk: int = CHUNK,
    overlap: int = OVERLAP,
) -> DataFrame:
    """Rows (doc_id, n_bytes, n_tokens, over_limit), one per row of ``df``; no shuffle.

    A null or empty text has no bytes and no tokens; a null id stays null;
    repeated rows are each counted; an empty table gives an empty table; other
    columns are ignored.  ``tokenizer_path`` must be readable on every executor
    and name a byte-level tokenizer; where its special tokens take up white
    space beside them, no boundary is proven and texts are encoded whole.
    Memory: a batch of texts, the pieces of ``BATCH_CHARS`` characters, a cache
    of ``CACHE_BYTES``.
    """

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            ts = texts(batch)
            n = counter_of(tokenizer_path, chunk, overlap).counts(ts)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([len(t.encode()) for t in ts], pa.int64()),
                    pa.array(n, pa.int64()),
                    pa.array([x > limit for x in n], pa.bool_()),
                ],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    kind = df.schema[id_col].dataType.simpleString()
    return id_and_text(df, id_col, text_col).mapInArrow(run, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean")
