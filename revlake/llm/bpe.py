"""Byte-level BPE by merge ranks, encoding and decoding.

A text is cut into pre-tokens by a pattern; each is merged by itself. Merges wait in a rank queue: a bucket for each merge
rank holds the places of the pairs with that rank, and a bitmap of three levels (64 ranks to a word) says which buckets
hold any, so find-first-set gives the next rank in three steps. Tokens are a linked list over the pre-token's bytes; a
place whose pair has changed meanwhile is stale and skipped. A pre-token of n bytes takes about n queue operations, so
very long ones are no trouble. New pre-tokens share one queue, ``QUEUED`` bytes of them at a time; those seen before come from a cache
of bounded bytes. A text is cut and encoded part by part, so a long one holds no more pre-tokens in memory than a short one.

Python runs per Arrow batch of bounded bytes, rows stay in their partition, and nothing is shuffled. Nulls: a null text is encoded as an
empty one; it has no ids. Ids of a null array decode to no bytes. Only the columns in ``keep`` are passed on, so others can't clash; repeated rows
and ids are encoded each by themselves; an empty table gives an empty one.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator
from functools import cache
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revlake.llm.common import frugal, small_batches

#: Bytes of the pre-tokens that a Python worker keeps, about; half of them go when it is full.
CACHE = 128 << 20
#: What an entry of the cache takes besides its characters and ids.
ENTRY = 180
#: Bytes of new pre-tokens that are merged together, and pre-tokens taken from a text at a time.
QUEUED, TAKEN = 1 << 18, 1 << 15


@cache
def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a rank file: base64 and a number on each line."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class Encoder:
    """Encodes texts with one rank file and pattern."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, cached: int = CACHE):
        self.ranks, self.find, self.cached = ranks, regex.compile(pattern).finditer, cached
        # Ids of pre-tokens seen lately, and of those seen before them, as bytes; what the former take.
        self.known: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}
        self.held = 0
        words = max(ranks.values(), default=0) // 64 + 1
        self.low, self.mid = [0] * words, [0] * (words // 64 + 1)
        #: Ranks of all pairs of two bytes.
        self.two = np.array([ranks.get(bytes((x, y)), -1) for x in range(256) for y in range(256)], np.int64)

    def merge(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of each pre-token. One queue serves them all: their bytes lie side by side, and each has a linked list of its own."""
        get, low, mid, top = self.ranks.get, self.low, self.mid, 0
        data = b"".join(pieces)
        n = len(data)
        if not n:
            return [b""] * len(pieces)
        # Of each place: the next and the last token's start (n and -1 at the pre-token's ends), its token's end, its pair's rank.
        stops = np.cumsum([len(x) for x in pieces])
        places = np.arange(n)
        nexts, lasts, ranks = places + 1, places - 1, np.full(n, -1)
        raw = np.frombuffer(data, np.uint8).astype(np.int64)
        ranks[:-1] = self.two[raw[:-1] << 8 | raw[1:]]
        end = nexts.tolist()
        ends = stops[np.concatenate(([True], stops[1:] > stops[:-1]))] if len(stops) else stops
        ends = ends[ends > 0]
        nexts[ends - 1], ranks[ends - 1] = n, -1
        lasts[ends[ends < n]] = -1
        after, before, pair = nexts.tolist(), lasts.tolist(), ranks.tolist()
        order = np.argsort(ranks, kind="stable")
        order = order[np.searchsorted(ranks[order], 0) :]
        first = np.flatnonzero(np.diff(ranks[order], prepend=-1))
        buckets = {pair[own[0]]: own for own in (x.tolist() for x in np.split(order, first[1:])) if own}
        for r in buckets:
            low[r >> 6] |= 1 << (r & 63)
            mid[r >> 12] |= 1 << (r >> 6 & 63)
            top |= 1 << (r >> 12)
        while top:
            c = (top & -top).bit_length() - 1
            b = (c << 6) + (mid[c] & -mid[c]).bit_length() - 1
            r = (b << 6) + (low[b] & -low[b]).bit_length() - 1
            low[b] &= low[b] - 1
            if not low[b]:
                mid[c] &= mid[c] - 1
                if not mid[c]:
                    top &= top - 1
            own = buckets.pop(r)
            own.sort()
            for at, i in enumerate(own):
                if pair[i] != r:
                    continue  # stale
                j = after[i]
                k = after[i] = after[j]
                e = end[i] = end[j]
                pair[j] = -1
                h = before[i]
                right = left = -1
                if k < n:
                    before[k] = i
                    right = get(data[i : end[k]], -1)
                    if right >= 0:
                        if right in buckets:
                            buckets[right].append(i)
                        else:
                            buckets[right] = [i]
                            b = right >> 6
                            low[b] |= 1 << (right & 63)
                            mid[b >> 6] |= 1 << (b & 63)
                            top |= 1 << (b >> 6)
                pair[i] = right
                if h >= 0:
                    left = pair[h] = get(data[h:e], -1)
                    if left >= 0:
                        if left in buckets:
                            buckets[left].append(h)
                        else:
                            buckets[left] = [h]
                            b = left >> 6
                            low[b] |= 1 << (left & 63)
                            mid[b >> 6] |= 1 << (b & 63)
                            top |= 1 << (b >> 6)
                if (0 <= right < r or 0 <= left < r) and at + 1 < len(own):  # a lower rank goes before the rest of this bucket
                    buckets[r] = own[at + 1 :] + buckets.get(r, [])
                    b = r >> 6
                    low[b] |= 1 << (r & 63)
                    mid[b >> 6] |= 1 << (b & 63)
                    top |= 1 << (b >> 6)
                    break
        ids, i, out = self.ranks, 0, []
        for stop in stops.tolist():
            own = array("i")
            while i < stop:
                e = end[i]
                own.append(ids[data[i:e]])
                i = e
            out.append(own.tobytes())
        return out

    def keep(self, word: str, ids: bytes) -> None:
        self.known[word] = ids
        self.held += ENTRY + len(word) + len(ids)

    def learn(self, words: list[str]) -> None:
        """Put the ids of all ``words`` into the cache."""
        if 2 * self.held > self.cached:
            self.known, self.before, self.held = {}, self.known, 0
        queue: list[str] = []
        size = 0
        for x in set(words) - self.known.keys():
            if (ids := self.before.get(x)) is not None:
                self.keep(x, ids)
            elif (rank := self.ranks.get(raw := x.encode())) is not None:
                self.keep(x, array("i", [rank]).tobytes())
            else:
                queue.append(x)
                size += len(raw)
                if size >= QUEUED:
                    self.merged(queue)
                    queue, size = [], 0
        self.merged(queue)

    def merged(self, queue: list[str]) -> None:
        for x, ids in zip(queue, self.merge([x.encode() for x in queue]), strict=True):
            self.keep(x, ids)

    def parts(self, texts: list[str]) -> Iterator[tuple[int, list[str]]]:
        """(number of the text, some of its pre-tokens), in order."""
        for k, text in enumerate(texts):
            found = (m[0] for m in self.find(text))
            while some := list(islice(found, TAKEN)):
                yield k, some

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and where each text ends."""
        out, sizes = [], np.zeros(len(texts) + 1, np.int64)
        waiting: list[tuple[int, list[str]]] = []
        held = 0

        def flush() -> None:
            self.learn([x for _, some in waiting for x in some])
            for k, some in waiting:
                ids = b"".join(map(self.known.__getitem__, some))
                sizes[k + 1] += len(ids) // 4
                out.append(ids)

        for k, some in self.parts(texts):
            waiting.append((k, some))
            held += len(some)
            if held >= TAKEN:
                flush()
                waiting, held = [], 0
        flush()
        return np.frombuffer(b"".join(out), np.int32), np.cumsum(sizes).astype(np.int32)


class Decoder:
    """Bytes of ids, by array operations on one table of all tokens."""

    def __init__(self, ranks: dict[bytes, int]):
        tokens = [b""] * (max(ranks.values(), default=-1) + 1)
        for k, r in ranks.items():
            tokens[r] = k
        self.sizes = np.array([len(x) for x in tokens], np.int64)
        self.table, self.starts = np.frombuffer(b"".join(tokens), np.uint8), np.cumsum(self.sizes) - self.sizes

    def decode(self, ids: np.ndarray) -> bytes:
        out = []
        for at in range(0, len(ids), TAKEN):
            # Each byte's place in the table: its token's start, and how far the byte is from its token's first.
            own = ids[at : at + TAKEN]
            n = self.sizes[own]
            first = np.cumsum(n) - n
            out.append(self.table[np.repeat(self.starts[own] - first, n) + np.arange(int(n.sum()))].tobytes())
        return b"".join(out)


@cache
def encoder(path: str, pattern: str) -> Encoder:
    """One per Python worker."""
    return Encoder(read_ranks(path), pattern)


def encode(docs: DataFrame, path: str, pattern: str, *, text_col: str = "text", ids_col: str = "ids", bytes_col: str | None = None, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns in ``keep`` and ``ids_col``, the ids of the whole text. With ``bytes_col`` the ids are decoded again at once, by the same
    Python worker, and that column has the bytes."""
    small_batches(docs.sparkSession)
    n = len(keep)
    rows = docs.select(*keep, F.col(text_col).alias("_text"))
    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField(ids_col, T.ArrayType(T.IntegerType(), False), False)] + ([T.StructField(bytes_col, T.BinaryType(), False)] if bytes_col else []))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e, d = encoder(path, pattern), Decoder(read_ranks(path)) if bytes_col else None
        for batch in batches:
            found, ends = e.encode([x or "" for x in batch.column(n).to_pylist()])
            more = [pa.array([d.decode(found[a:b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)], pa.binary())] if d else []
            yield pa.RecordBatch.from_arrays([*batch.columns[:n], pa.ListArray.from_arrays(pa.array(ends), pa.array(found)), *more], schema.names)

    return rows.mapInArrow(frugal(run), schema)


def decode(coded: DataFrame, path: str, *, ids_col: str = "ids", bytes_col: str = "decoded") -> DataFrame:
    """``coded`` and ``bytes_col``, the bytes that its ids stand for."""
    small_batches(coded.sparkSession)
    schema = T.StructType([*coded.schema.fields, T.StructField(bytes_col, T.BinaryType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        d = Decoder(read_ranks(path))
        for batch in batches:
            out = [d.decode(x.values.to_numpy() if x.is_valid else np.zeros(0, np.int32)) for x in batch.column(ids_col)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.binary())], [*batch.schema.names, bytes_col])

    return coded.mapInArrow(frugal(run), schema)
