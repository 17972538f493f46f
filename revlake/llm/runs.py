"""Periodic runs of words: stretches that repeat themselves at a fixed distance, such as looped boilerplate, found exactly in linear time but for sorting.

Every run has a Lyndon root: a stretch of one period that is the longest Lyndon word from its start, under the order of words or under the reversed one. So the
Lyndon arrays under both orders name all candidates. Each is computed directly by the first phase of Baier's suffix sorter: suffixes lie in groups by the word
they begin with; groups are taken from the highest down, each member is appended to the nearest earlier suffix of a lower group, and those that
took in equally many members move into a new group right behind their old one. When a group's turn comes its prefix is the longest Lyndon word of its members.
A root is then extended to both sides by the longest common extension of its two ends, from ranks of blocks of 1, 2, 4, ... words, and kept if it is long enough.

Baier's grouping is sequential, so texts are first cut to where runs can be: in a run of ``least_length`` words and ``least_exponent`` periods each block of a few words
occurs twice (see ``block``), so a stretch without repeated blocks has none. The cut is made by hashes, of which a collision leaves more in, never less; it loses no run.

Words are what ``[^\\x20\\x09-\\x0D]+`` matches, compared by bytes. Nulls: a null text has no words and no runs. Rows that repeat an id are judged each by themselves. A run is the
same whatever root it comes from: ties don't arise. Texts may have any length; a worker holds one text's numbers, at most about 200 bytes a word.
Only the columns in ``keep`` are passed on, so others can't clash. An empty table gives an empty one.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revlake.llm.common import frugal, small_batches

RUN = T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")])


def lyndon(codes: np.ndarray) -> np.ndarray:
    """Length of the longest Lyndon word from each position, by Baier's grouping of suffixes."""
    n = len(codes)
    order = np.argsort(codes, kind="stable")
    new = np.concatenate(([True], np.diff(codes[order]) != 0))
    starts = np.flatnonzero(new)
    head = np.zeros(n, np.int32)
    head[order] = np.repeat(starts, np.diff(np.append(starts, n)))
    place = np.empty(n, np.int32)
    place[order] = np.arange(n)
    count, length = np.zeros(n, np.int32), np.zeros(n, np.int32)
    count[starts], length[starts] = np.diff(np.append(starts, n)), 1
    # A group is known by the place of its first member; members lie together, in the groups' order.
    members, place, head, count, length = (array("i", x.astype(np.int32).tobytes()) for x in (order, place, head, count, length))
    lower = array("i", bytes(4 * n))  # the nearest earlier suffix of a lower group, for suffixes whose group had its turn
    out = array("i", bytes(4 * n))
    end = n
    while end:
        g = head[members[end - 1]]
        size = length[g]
        group = members[g:end] if end - g == 1 else sorted(members[g:end])
        end = g
        taken: dict[int, int] = {}
        for i in group:
            out[i] = size
            j = i - 1
            while j >= 0 and head[j] >= g:
                j = lower[j]
            lower[i] = j
            if j >= 0:
                taken[j] = taken.get(j, 0) + 1
        if not taken:
            continue
        by_count: dict[int, list[int]] = {}
        for j, k in taken.items():
            by_count.setdefault(k, []).append(j)
        for k in sorted(by_count, reverse=True):
            moved: dict[int, int] = {}
            for j in by_count[k]:
                old = head[j]
                moved[old] = moved.get(old, 0) + 1
                count[old] -= 1
                last = old + count[old]
                at, other = place[j], members[last]
                members[at], members[last] = other, j
                place[other], place[j] = at, last
            for old, m in moved.items():
                fresh = old + count[old]
                length[fresh], count[fresh] = length[old] + k * size, m
                for at in range(fresh, fresh + m):
                    head[members[at]] = fresh
    return np.frombuffer(out, np.int32).astype(np.int64)


class Extensions:
    """How far the texts from two positions, or up to them, agree, for many pairs at once: ranks of blocks of 1, 2, 4, ... words, equal where the blocks are."""

    def __init__(self, codes: np.ndarray):
        self.n, self.ranks = len(codes), [np.unique(codes, return_inverse=True)[1].astype(np.int32)]

    def agree(self, level: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether the blocks of 2 ** level words from ``a`` and ``b`` lie inside the text and are equal."""
        ranks = self.ranks[level]
        inside = (np.minimum(a, b) >= 0) & (np.maximum(a, b) < len(ranks))
        return inside & (ranks[np.where(inside, a, 0)] == ranks[np.where(inside, b, 0)])

    def deepen(self) -> None:
        ranks, half = self.ranks[-1], 1 << (len(self.ranks) - 1)
        both = ranks[: len(ranks) - half].astype(np.int64) * (int(ranks.max()) + 1) + ranks[half:]
        self.ranks.append(np.unique(both, return_inverse=True)[1].astype(np.int32))

    def both(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Words that agree before the positions and from them on."""
        level = 0
        while self.n >= 2 << level:
            if len(self.ranks) == level + 1:
                self.deepen()
            if not (self.agree(level + 1, a, b) | self.agree(level + 1, a - (2 << level), b - (2 << level))).any():
                break
            level += 1
        before, behind = np.zeros(len(a), np.int64), np.zeros(len(a), np.int64)
        for k in range(level, -1, -1):
            before += self.agree(k, a - before - (1 << k), b - before - (1 << k)) << k
            behind += self.agree(k, a + behind, b + behind) << k
        return before, behind


def runs_of(codes: np.ndarray, least_length: int, least_exponent: int) -> np.ndarray:
    """(start, length, period) of the runs of a text, in order."""
    found, extensions = [], Extensions(codes)
    place = np.arange(len(codes))
    for signed in (codes, -codes):
        period = lyndon(signed)
        start, period = place[period * least_exponent <= len(codes)], period[period * least_exponent <= len(codes)]
        # Most roots agree with nothing beside them.
        near = extensions.agree(0, start, start + period) | extensions.agree(0, start - 1, start + period - 1)
        start, period = start[near], period[near]
        before, behind = extensions.both(start, start + period)
        length = before + period + behind
        long = length >= np.maximum(least_length, least_exponent * period)
        found.append(np.stack((start - before, length, period), 1)[long])
    found = np.unique(np.concatenate(found), axis=0)
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def block(least_length: int, least_exponent: int) -> int:
    """Words of a block, so that in each run all blocks occur twice: one period before or behind. A run of length l and period q lacks that only if
    l <= 2q + block - 2."""
    return max(1, least_length - 2 * (least_length // least_exponent))


def stretches(codes: np.ndarray, size: int, least_length: int) -> list[tuple[int, int]]:
    """(start, end) of the stretches of at least ``least_length`` words all of whose blocks of ``size`` words occur twice in the text."""
    n = len(codes) - size + 1
    if n < 1:
        return []
    codes, sums = codes.astype(np.uint64), np.zeros(n, np.uint64)
    for k in range(size):
        sums = sums * np.uint64(0x9E3779B97F4A7C15) + (codes[k : k + n] + np.uint64(1)) * np.uint64(0xC2B2AE3D27D4EB4F)
    order = np.argsort(sums)
    ranked = sums[order]
    same = ranked[1:] == ranked[:-1]
    twice = np.zeros(n + 2, bool)
    twice[1 + order[1:][same]] = twice[1 + order[:-1][same]] = True
    edge = np.flatnonzero(twice[1:] != twice[:-1])
    return [(int(a), int(b) + size - 1) for a, b in zip(edge[::2], edge[1::2], strict=True) if b + size - 1 - a >= least_length]


def find_runs(codes: np.ndarray, least_length: int, least_exponent: int) -> np.ndarray:
    found = [runs_of(codes[a:b], least_length, least_exponent) + [a, 0, 0] for a, b in stretches(codes, block(least_length, least_exponent), least_length)]
    return np.concatenate(found) if found else np.zeros((0, 3), np.int64)


def collapsed(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words joined by blanks, without those that a run holds after its first period."""
    if not len(runs):
        return b" ".join(words)
    cover = np.zeros(len(words) + 1, np.int64)
    np.add.at(cover, runs[:, 0] + runs[:, 2], 1)
    np.add.at(cover, runs[:, 0] + runs[:, 1], -1)
    return b" ".join([words[k] for k in np.flatnonzero(np.cumsum(cover)[:-1] == 0).tolist()])


def _judge(n: int, names: list[str], least_length: int, least_exponent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([(f.name, pa.int64()) for f in RUN]))
        for b in batches:
            runs, texts = [], []
            for text in b.column(n):
                words = (text.as_py() or b"").split()  # bytes: exactly these six white space characters
                known: dict[bytes, int] = {}
                codes = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))
                found = find_runs(codes, least_length, least_exponent)
                runs.append([dict(zip(RUN.names, r, strict=True)) for r in found.tolist()])
                texts.append(collapsed(words, found).decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays([*b.columns[:n], pa.array(runs, kind), pa.array(texts, pa.string())], names)

    return run


def periodic_runs(docs: DataFrame, *, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",), least_length: int = 24, least_exponent: int = 3) -> DataFrame:
    """The columns in ``keep``; ``runs``, the text's runs of at least ``least_length`` words and ``least_exponent`` (2 or more) periods, by start, then period,
    as (start, length, period) in words; ``collapsed``, the text's words joined by one blank, of each run the first period only."""
    if least_exponent < 2:
        raise ValueError("a run has two periods at least")
    small_batches(docs.sparkSession)
    rows = docs.select(*keep, F.col(text_col).cast("binary").alias("_text"))
    schema = T.StructType([*(docs.schema[c] for c in keep), T.StructField("runs", T.ArrayType(RUN)), T.StructField("collapsed", T.StringType())])
    return rows.mapInArrow(frugal(_judge(len(keep), [*keep, "runs", "collapsed"], least_length, least_exponent)), schema)
