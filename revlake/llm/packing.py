"""Packing of documents into sequences of a fixed number of tokens.

1. Each text is tokenised whole where it lies. Only documents over the capacity are cut, into full pieces and a first piece that has
   the rest. A piece is a row with its length and a checksum of its ids.
2. Spark counts the pieces of each length. These counts, one per possible length, are all that the driver gets.
3. Bin completion plans sequences from the counts: a branch-and-bound search goes through the undominated fillings around the longest piece
   left, prunes by the waste that a better solution may have, and starts from best fit decreasing as incumbent. A filling is used as often as
   the counts allow, or once, so plans stay small whatever the number of documents.
4. A piece's rank among those of its length gives its sequence and its offset by arithmetic. Ranks come from windows over
   (length, salt) and sums of a table with a row for each: a common length is spread over as many tasks as it needs.

Nulls: a null text is empty and has just the end mark. Rows with a null id, repeated ids and repeated rows (ties) are all packed, each by itself. Other columns
are not read, so none can clash. An empty table gives an empty result; a text may have any length, as its pieces are rows of their own.
"""

from __future__ import annotations

import json
import zlib
from bisect import bisect_left, bisect_right, insort
from collections import Counter
from collections.abc import Iterator
from functools import cache
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revlake.llm.common import frugal, run_dir, small_batches, stored

CAPACITY = 2048
#: Pieces that one window over a length and a salt should have; a length gets as many salts as its count asks for.
ROWS_PER_SALT = 1000
#: Fillings tried around a piece, steps of the search for them, and pieces of a filling up to which pairs of them are tested for dominance.
ALTERNATIVES, SEARCH_STEPS, PAIRED = 12, 1_000, 12
#: Nodes that the search for plans sees at most, besides two for each length; after them the best plan found is used.
BRANCHES = 1_000


class Tokenizer:
    """Gives the ids that the tokenizers library gives with a byte-level BPE vocabulary in its JSON form and ``add_special_tokens=False``, several times as fast: added
    tokens are found in the text as they are, the rest is encoded by the merge ranks. The tests compare them."""

    def __init__(self, path: str, pattern: str):
        import tiktoken

        with open(path, encoding="utf-8") as f:
            found = json.load(f)
        # The byte-level alphabet: printable bytes stand for themselves, the others for the characters from 256 on.
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        raw = {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(x for x in range(256) if x not in set(shown))}
        added = {x["content"]: x["id"] for x in found["added_tokens"]}
        odd = [x["content"] for x in found["added_tokens"] if x["single_word"] or x["lstrip"] or x["rstrip"]]
        if odd:
            raise ValueError(f"added tokens with conditions: {odd}")
        ranks = {bytes(map(raw.__getitem__, k)): v for k, v in found["model"]["vocab"].items() if k not in added}
        self.library = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens=added)

    def encode(self, text: str) -> list[int]:
        return self.library.encode(text, allowed_special="all")


@cache
def tokenizer(path: str, pattern: str) -> Tokenizer:
    return Tokenizer(path, pattern)


def pieces(docs: DataFrame, path: str, pattern: str, *, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end_id: int = 0) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): each document's ids and the end mark, cut where they are too long."""
    small_batches(docs.sparkSession)
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()), T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokenizer(path, pattern).encode
        for b in batches:
            at, out = [], []
            for k, text in enumerate(map(str, b.column(1).fill_null(""))):
                ids = np.array([*encode(text or ""), end_id], "<u4")
                first = len(ids) % capacity or capacity
                cuts = [0, *range(first, len(ids) + 1, capacity)]
                for p, (s, e) in enumerate(zip(cuts, cuts[1:], strict=False)):
                    at.append(k)
                    out.append((p, s, e - s, zlib.crc32(ids[s:e].tobytes())))
            cols = list(zip(*out, strict=True)) or [()] * 4
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at, pa.int32())), *(pa.array(c, t) for c, t in zip(cols, (pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True))], names=schema.names)

    return docs.select(id_col, text_col).mapInArrow(frugal(run), schema)


def dominated(chosen: list[int], left: list[int], sizes: list[int], room: int) -> bool:
    """Whether a filling of ``room`` can be replaced by one that leaves a better rest: a piece put in, one piece by a longer one, or two by one piece."""
    waste = room - sum(chosen)
    used = Counter(chosen)

    def between(low: int, high: int) -> bool:
        """Whether a piece with low < size <= high is left."""
        return any(left[s] > used[s] for s in sizes[bisect_right(sizes, low) : bisect_right(sizes, high)])

    if between(0, waste) or waste and any(between(s, s + waste) for s in used):
        return True
    return any(between(x + y - 1, x + y + waste) for x, y in combinations(chosen, 2)) if len(chosen) <= PAIRED else False


def fillings(left: list[int], sizes: list[int], room: int, most: int = ALTERNATIVES, steps: int = SEARCH_STEPS) -> list[list[int]]:
    """Undominated fillings of ``room``, those of least waste first; ``left`` has how many pieces of each size there are, ``sizes`` those with any, ascending."""
    if not sizes or sizes[0] > room:
        return [[]]
    found: list[tuple[int, list[int]]] = []
    supply = list(accumulate(s * left[s] for s in sizes))
    count = 0

    def search(rest: int, top: int, chosen: list[int]) -> None:
        nonlocal count
        k = bisect_right(sizes, min(rest, top)) - 1
        whole = True
        while k >= 0 and count <= steps:
            s = sizes[k]
            count += 1
            if supply[k] <= rest - (found[-1][0] if len(found) == most else room + 1):  # all pieces of this size or less together leave no less
                break
            if chosen.count(s) < left[s]:
                whole = False
                chosen.append(s)
                search(rest - s, s, chosen)
                chosen.pop()
            k -= 1
            if len(found) == most and not found[-1][0]:
                return
        if whole and (len(found) < most or rest < found[-1][0]) and not dominated(chosen, left, sizes, room):
            insort(found, (rest, chosen[:]), key=lambda x: x[0])
            del found[most:]

    search(room, room, [])
    if not found:  # the steps ran out before the first undominated one: best fit
        chosen, rest, used = [], room, Counter()
        for s in reversed(sizes):
            while s <= rest and used[s] < left[s]:
                chosen.append(s)
                used[s] += 1
                rest -= s
        found = [(rest, chosen)]
    return [x for _, x in found]


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[list[int], int]]:
    """Fillings, longest piece first, and how many sequences have each, by branch and bound.

    A node fills sequences around the longest piece left, in one of its undominated fillings, as often as the counts allow or once; the best solution so far is
    best fit decreasing's at first. A branch ends where its waste leaves no way to need one sequence less than that solution, and the search
    where that solution meets the lower bound or ``BRANCHES`` nodes and two for each length have been seen; then it has the best one found."""
    best = best_fit(counts, capacity)
    bins = sum(n for _, n in best)
    total = sum(s * n for s, n in counts.items())
    # Pieces over half of the capacity never share a sequence.
    bound = max(-(-total // capacity), sum(n for s, n in counts.items() if 2 * s > capacity))
    left = [0] * (capacity + 1)
    for s, n in counts.items():
        left[s] = n
    sizes = sorted(s for s, n in counts.items() if n)
    path: list[tuple[list[int], int]] = []
    seen = used = waste = 0

    def change(chosen: list[int], times: int) -> None:
        nonlocal used, waste
        used += times
        waste += times * (capacity - sum(chosen))
        for x, n in Counter(chosen).items():
            had = left[x]
            left[x] -= times * n
            if had and not left[x]:
                sizes.pop(bisect_left(sizes, x))
            elif not had and left[x]:
                insort(sizes, x)

    def alternatives() -> list[tuple[list[int], int]]:
        s = sizes[-1]
        left[s] -= 1
        some = sizes if left[s] else sizes[:-1]
        options = [[s, *x] for x in fillings(left, some, capacity - s)]
        left[s] += 1
        out = []
        for chosen in options:
            times = min(left[x] // n for x, n in Counter(chosen).items())
            out += [(chosen, t) for t in dict.fromkeys((times, 1))]
        return out

    # Of each node on the way down, the alternatives that are left; the path has one step less.
    untried = [iter(alternatives())] if bins > bound else []
    while untried and bins > bound and seen < BRANCHES + 2 * len(counts):
        step = next(untried[-1], None)
        if step is None:
            untried.pop()
            if path:
                chosen, times = path.pop()
                change(chosen, -times)
            continue
        chosen, times = step
        # What a solution of one sequence less may waste.
        if waste + times * (capacity - sum(chosen)) > (bins - 1) * capacity - total:
            continue
        path.append(step)
        change(chosen, times)
        if sizes:
            seen += 1
            untried.append(iter(alternatives()))
        else:
            best, bins = path[:], used
            change(chosen, -times)
            path.pop()
    return best


def best_fit(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[list[int], int]]:
    """Best fit decreasing over counts: sequences with one filling move together, from room to room."""
    rooms: dict[int, list[tuple[list[int], int]]] = {capacity: []}
    order = [capacity]
    for s in sorted((s for s, n in counts.items() if n), reverse=True):
        n = counts[s]
        while n:
            k = bisect_left(order, s)
            while k < len(order) - 1 and not rooms[order[k]]:
                del rooms[order[k]], order[k]
            room = order[k]
            each = room // s
            chosen, there = rooms[room].pop() if rooms[room] else ([], n // each + 1)
            use = min(there, n // each)
            moves = [(chosen + [s] * each, use, room - each * s)] if use else [(chosen + [s] * n, 1, room - n * s)]
            if chosen and there > moves[0][1]:
                rooms[room].append((chosen, there - moves[0][1]))
            n -= use * each if use else n
            for filled, times, left in moves:
                if left not in rooms:
                    insort(order, left)
                rooms.setdefault(left, []).append((filled, times))
    return [x for found in rooms.values() for x in found]


def pack(parts: DataFrame, *, id_col: str = "doc_id", capacity: int = CAPACITY) -> DataFrame:
    """``parts`` with ``sequence_id`` and ``offset``; it must be a table stored as Parquet, as it is read several times, and its rows are told apart by their file and number."""
    spark = parts.sparkSession
    counts = {r["length"]: r["n"] for r in parts.groupBy("length").agg(F.count("*").alias("n")).collect()}
    starts: dict[int, list[tuple[int, int, int, int]]] = {}
    used: dict[int, int] = {}
    base = 0
    for chosen, times in plan(counts, capacity):
        offset = 0
        for s in sorted(set(chosen), reverse=True):
            each = chosen.count(s)
            starts.setdefault(s, []).append((used.get(s, 0), base, each, offset))
            used[s] = used.get(s, 0) + each * times
            offset += s * each
        base += times
    tables = {s: np.array(x, np.int64).T for s, x in starts.items()}
    # A row for each possible length at most, so this may be broadcast.
    salts = F.broadcast(spark.createDataFrame([(s, n // ROWS_PER_SALT + 1) for s, n in counts.items()], "length long, salts long"))
    # By where a row is stored, not by its id, so that rows with no id or the same one are spread as well.
    rows = parts.withColumns({"_at": F.xxhash64("_metadata.file_name", "_metadata.row_index"), "_index": F.col("_metadata.row_index")})
    salted = rows.join(salts, "length").withColumn("salt", F.pmod("_at", "salts")).drop("salts")
    totals = salted.groupBy("length", "salt").agg(F.count("*").alias("n"))
    before = totals.withColumn("before", F.sum("n").over(Window.partitionBy("length").orderBy("salt")) - F.col("n")).drop("n")
    before = stored(before, f"{run_dir(spark, 'pack')}/before")
    within = F.row_number().over(Window.partitionBy("length", "salt").orderBy("_at", "_index")) - 1
    ranked = salted.withColumn("within", within).join(before, ["length", "salt"]).select(id_col, "piece", "start", "length", "ids_crc32", (F.col("within") + F.col("before")).alias("rank"))
    schema = T.StructType([*parts.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    names = parts.columns

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            length, rank = b.column("length").to_numpy(), b.column("rank").to_numpy()
            seq, off = np.zeros(len(b), np.int64), np.zeros(len(b), np.int64)
            for s in np.unique(length):
                own = length == s
                low, base, each, offset = tables[int(s)]
                k = np.searchsorted(low, rank[own], "right") - 1
                q = rank[own] - low[k]
                seq[own] = base[k] + q // each[k]
                off[own] = offset[k] + q % each[k] * s
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names), pa.array(seq), pa.array(off)], [*names, "sequence_id", "offset"])

    return ranked.mapInArrow(frugal(place), schema)
