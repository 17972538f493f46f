"""Near-duplicate documents by b-bit MinHash.

1. Each text gives its set of word shingles, as 64-bit hashes, and ``HASHES`` minima. Equal sets fall into one class, by a grouping that
   Spark combines before its shuffle; from here on only one row per class counts.
2. Bands of ``ROWS`` minima are the keys of candidate buckets. What stays of the minima is their lowest ``BITS`` bits, packed.
3. Buckets with more than one class give candidate pairs. A pair's equal lanes, counted by XOR and popcount and corrected for chance
   (2**-BITS), estimate its similarity; pairs that can't reach the threshold within ``MARGIN`` go. The others are confirmed on the full sets.
   Small buckets give all their pairs, which are joined with the sets. Large buckets are dealt out in blocks of ``BLOCK`` members with their
   sets, and each block gets the bucket's ``PIVOTS`` as well; a task confirms pairs from the most to the least similar and skips those that its
   confirmed links connect already, as they can't change a component. It sends a spanning forest, so rows grow with members, not with pairs.
   Members of a bucket that pivots and blocks have not connected with its largest component are then compared with all its members, block by block;
   so a large group of near copies costs its members once, and only members that stand apart cost more. Buckets of the same members count once.
4. Components of the confirmed links give each document its smallest reachable id.

Classes have numbers of their own, so rows that repeat an id go each by their own text; such rows share an id but not a class.
Nulls: a text that is null or has no word has an empty set and is linked with nothing. Rows with a null id are linked with nothing: their component
is null and they are kept. Ties: equal texts under one id are both kept or both dropped. Other columns are not read, so none can clash. An empty
table gives an empty result; texts may be of any length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revlake.llm.common import frugal, give_back, run_dir, small_batches, stored
from revlake.llm.components import components

SHINGLE = 5
SIMILARITY = 0.8
HASHES, ROWS, BITS = 256, 5, 4
#: 36 bands of 5: a pair at 0.8 has no band in common once in 1.6 million times, at 0.85 once in a thousand million.
BANDS = 36
#: An estimate may be so far under the threshold: more than 4.5 standard deviations of 256 lanes.
MARGIN = 0.12
#: Buckets up to this size give all pairs at once; larger ones are compared in blocks.
SMALL, BLOCK, PIVOTS = 6, 512, 4

_rng = np.random.default_rng(20_004)
BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64)
POWER = np.uint64(int(_rng.integers(1, 1 << 62)) * 2 + 1)
UNPOWER = np.uint64(pow(int(POWER), -1, 1 << 64))
MULTIPLY = _rng.integers(0, 1 << 32, HASHES, dtype=np.uint32) | np.uint32(1)
ADD = _rng.integers(0, 1 << 32, HASHES, dtype=np.uint32)
SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit numbers (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: Grown for the longest text of a task, and cut again at its end.
_powers: list[np.ndarray] = [powers(POWER, 1 << 12), powers(UNPOWER, 1 << 12)]


def shrink() -> None:
    _powers[:] = [x[: 1 << 12].copy() for x in _powers]


def shingles(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """Sorted hashes of the distinct runs of ``size`` words, A-Z in lower case; of the whole text if it has fewer words."""
    raw = LOWER[np.frombuffer((text or "").encode(), np.uint8)]
    space = np.concatenate(([True], SPACES[raw], [True]))
    starts, ends = np.flatnonzero(space[:-1] & ~space[1:]), np.flatnonzero(~space[:-1] & space[1:])
    if not len(starts):
        return np.zeros(0, np.uint64)
    if len(raw) >= len(_powers[0]):
        _powers[:] = [powers(b, len(raw) + len(raw) // 4) for b in (POWER, UNPOWER)]
    # Prefix sums of a polynomial in the bytes; the difference over a word, shifted to power 0, is the word's hash.
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(BYTE[raw] * _powers[0][: len(raw)], dtype=np.uint64)))
    words = mix((sums[ends] - sums[starts]) * _powers[1][starts] + (ends - starts).astype(np.uint64))
    k = min(size, len(words))
    n = len(words) - k + 1
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out = out * POWER + words[j : j + n]
    return np.unique(mix(out + np.uint64(k)))


def minima(found: np.ndarray) -> np.ndarray:
    out = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    low = (found >> np.uint64(32)).astype(np.uint32)
    for at in range(0, len(low), 64):
        np.minimum(out, (low[at : at + 64, None] * MULTIPLY + ADD).min(0), out=out)
    return out


def signatures(docs: DataFrame, *, id_col: str, text_col: str) -> DataFrame:
    """(id, text_key, n, set_hash, bands, sig): a hash of the text, size, identity, band keys and packed low bits of each document's set."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        band = np.arange(BANDS, dtype=np.uint64)
        for b in batches:
            sizes, names, keys, sigs = [], [], [], []
            for text in b.column(2):
                s = shingles(text.as_py())
                m = minima(s)
                sizes.append(len(s))
                names.append(xxhash.xxh3_128_digest(s.tobytes()))
                key = band
                for j in range(ROWS):
                    key = mix(key * POWER + m[j : BANDS * ROWS : ROWS])
                keys.append(key.view(np.int64))
                nibbles = (m & np.uint32(15)).astype(np.uint8)
                sigs.append((nibbles[::2] << 4 | nibbles[1::2]).tobytes())
            bands = pa.ListArray.from_arrays(pa.array(np.arange(len(keys) + 1, dtype=np.int32) * BANDS), pa.array(np.concatenate(keys) if keys else np.zeros(0, np.int64)))
            yield pa.RecordBatch.from_arrays([*b.columns[:2], pa.array(sizes, pa.int64()), pa.array(names, pa.binary()), bands, pa.array(sigs, pa.binary())], ["id", "text_key", "n", "set_hash", "bands", "sig"])
        shrink()

    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), T.StructField("text_key", T.LongType()), T.StructField("n", T.LongType()), T.StructField("set_hash", T.BinaryType()), T.StructField("bands", T.ArrayType(T.LongType())), T.StructField("sig", T.BinaryType())])
    return docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_key"), text_col).mapInArrow(frugal(run), schema)


def sets_of(docs: DataFrame, classes: DataFrame, *, id_col: str, text_col: str) -> DataFrame:
    """(no, shingles) of ``classes`` (no, id, text_key, set_hash): the set of one of each class's documents, hashes side by side in one binary value."""
    keyed = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_key"), F.col(text_col).alias("text"))
    rows = keyed.join(classes.hint("merge"), ["id", "text_key"]).select("no", "set_hash", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [shingles(x.as_py()).tobytes() for x in b.column(2)]
            # A text whose hash is another's by chance has another set.
            own = pa.array([xxhash.xxh3_128_digest(s) == h.as_py() for s, h in zip(found, b.column(1), strict=True)], pa.bool_())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, pa.binary())], ["no", "shingles"]).filter(own)
        shrink()

    return rows.mapInArrow(frugal(run), T.StructType([T.StructField("no", T.LongType()), T.StructField("shingles", T.BinaryType())])).dropDuplicates(["no"])


POPCOUNT = np.array([(x >> 4 != 0) + (x & 15 != 0) for x in range(256)], np.uint8)


def agreement(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Estimated similarity of packed signatures along the last axis: share of equal lanes, corrected for equality by chance."""
    differing = POPCOUNT[a ^ b].sum(-1, dtype=np.int32)
    chance = 2.0**-BITS
    return (1 - differing / HASHES - chance) / (1 - chance)


@F.pandas_udf(T.DoubleType())
def estimated(a: pd.Series, b: pd.Series) -> pd.Series:
    if not len(a):
        return pd.Series([], dtype=float)
    return pd.Series(agreement(np.frombuffer(b"".join(a), np.uint8).reshape(len(a), -1), np.frombuffer(b"".join(b), np.uint8).reshape(len(a), -1)))


@F.pandas_udf(T.StructType([T.StructField("shared", T.LongType()), T.StructField("total", T.LongType())]))
def overlap(a: pd.Series, b: pd.Series) -> pd.DataFrame:
    """Sizes of intersection and union of full sets."""
    out = [shared_and_total(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)) for x, y in zip(a, b, strict=True)]
    return pd.DataFrame(out, columns=["shared", "total"])


def shared_and_total(x: np.ndarray, y: np.ndarray) -> tuple[int, int]:
    """Sizes of intersection and union of two sorted arrays without repeats."""
    both = np.concatenate((x, y))
    both.sort()
    shared = int(np.count_nonzero(both[1:] == both[:-1]))
    return shared, len(both) - shared


def _forest(g: pd.DataFrame, floor: float, percent: int) -> pd.DataFrame:
    """Edges (a, b) that connect what the links between ``g``'s rows connect, beyond what their labels say is connected already.
    Rows of ``side`` 0 are compared with all others, where there is one of side 1; else all with all."""
    g = g.sort_values("side", kind="stable").drop_duplicates("id")
    ids, n = g["id"].tolist(), len(g)
    first = int((g["side"] == 0).sum())
    sigs = np.frombuffer(b"".join(g["sig"]), np.uint8).reshape(n, -1)
    label = g["label"].to_numpy()
    roots: dict[int, int] = {}

    def top(x: int) -> int:
        while (y := roots.get(x, x)) != x:
            roots[x] = x = roots.get(y, y)
        return x

    at, to, est = [], [], []
    for x in range(first):
        e = agreement(sigs[x], sigs[x + 1 :])
        near = np.flatnonzero((e >= floor) & (label[x + 1 :] != label[x]))
        at.append(np.full(len(near), x, np.int32)), to.append((near + x + 1).astype(np.int32)), est.append(e[near].astype(np.float32))
    found = []
    if at:
        at, to, est = np.concatenate(at), np.concatenate(to), np.concatenate(est)
        sets = [np.frombuffer(x, np.uint64) for x in g["shingles"]]
        for k in np.argsort(-est, kind="stable").tolist():
            x, y = top(int(label[at[k]])), top(int(label[to[k]]))
            if x != y:
                shared, total = shared_and_total(sets[at[k]], sets[to[k]])
                if 100 * shared >= percent * total:
                    roots[max(x, y)] = min(x, y)
                    found.append((ids[at[k]], ids[to[k]]))
    give_back()
    return pd.DataFrame(found, columns=["a", "b"])


def _blocks(size: Column, key: str = "key") -> tuple[Column, Column]:
    """How many blocks a bucket of ``size`` members has, and a member's own."""
    blocks = F.ceil(size / BLOCK).cast("int")
    return blocks, F.pmod(F.xxhash64("id", key), blocks).cast("int")


def _first_links(large: DataFrame, full: DataFrame, at: str, floor: float, percent: int) -> DataFrame:
    """Edges inside the blocks of large buckets and between their members and the pivots. ``large``: key, size, id; ``full``: id, sig, shingles."""
    blocks, own = _blocks(F.col("size"))
    dealt = large.select("key", own.alias("block"), "id")
    pivots = large.filter(F.col("size") > BLOCK).groupBy("key", "size").agg(F.array_distinct(F.array(*(F.min_by("id", F.xxhash64(F.lit(k), "id", "key")) for k in range(PIVOTS)))).alias("ids"))
    pivots = pivots.select("key", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("block"), "ids").select("key", "block", F.explode("ids").alias("id"))
    rows = stored(dealt.unionByName(pivots), f"{at}/dealt").join(full.hint("merge"), "id").select("key", "block", "id", "sig", "shingles", F.lit(0).alias("side"), F.col("id").alias("label"))
    return rows.groupBy("key", "block").applyInPandas(lambda g: _forest(g, floor, percent), "a long, b long")


def _last_links(large: DataFrame, full: DataFrame, labels: DataFrame, at: str, floor: float, percent: int) -> DataFrame | None:
    """Edges of members of buckets of several blocks that aren't in their bucket's largest component yet; None if all are."""
    some = large.filter(F.col("size") > BLOCK).join(labels.select(F.col("node").alias("id"), "label").hint("merge"), "id", "left").withColumn("label", F.coalesce("label", "id"))
    some = stored(some, f"{at}/labelled")
    groups = some.groupBy("key", "label").agg(F.count("*").alias("n")).groupBy("key").agg(F.max_by("label", "n").alias("main"), (F.sum("n") - F.max("n")).alias("apart")).filter("apart > 0")
    groups = stored(groups, f"{at}/apart")
    if not groups.limit(1).count():
        return None
    some = some.join(groups.hint("merge"), "key").withColumn("side", (F.col("label") == F.col("main")).cast("int"))
    blocks, own = _blocks(F.col("size"))
    parts, part = _blocks(F.col("apart"))
    # Each member that stands apart meets every block, as side 0; each member meets every part of those apart, as side 1.
    apart = some.filter("side = 0").select("key", part.alias("part"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("block"), "id", "label", F.lit(0).alias("side"))
    others = some.select("key", F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"), own.alias("block"), "id", "label", F.lit(1).alias("side"))
    rows = stored(apart.unionByName(others), f"{at}/again").join(full.hint("merge"), "id")
    return rows.groupBy("key", "part", "block").applyInPandas(lambda g: _forest(g, floor, percent), "a long, b long")


def near_dedup(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", percent: int = round(100 * SIMILARITY)) -> DataFrame:
    """Per row: id, ``n_shingles``, ``component_id``, ``kept``. Linked are sets with 100 * intersection >= percent * union."""
    spark = docs.sparkSession
    at = run_dir(spark, "minhash")
    floor = percent / 100 - MARGIN
    sigs = stored(signatures(docs, id_col=id_col, text_col=text_col), f"{at}/signatures")
    # Equal sets have equal minima, so any row's stand for its class.
    classes = sigs.filter("n > 0 and id is not null").groupBy("set_hash").agg(F.min("id").alias("class"), F.min_by("text_key", "id").alias("text_key"), F.any_value("bands").alias("bands"), F.any_value("sig").alias("sig"))
    classes = stored(classes.withColumn("no", F.monotonically_increasing_id()), f"{at}/classes")
    keyed = stored(classes.select(F.col("no").alias("id"), F.explode("bands").alias("key")), f"{at}/bands")
    buckets = stored(keyed.groupBy("key").agg(F.count("*").alias("size"), F.min("id").alias("low"), F.max("id").alias("high")).filter("size > 1 and low < high"), f"{at}/buckets")
    shared = stored(keyed.join(buckets.select("key", "size").hint("merge"), "key"), f"{at}/shared")
    active = stored(shared.select(F.col("id").alias("no")).distinct(), f"{at}/active")
    known = stored(classes.join(active.hint("merge"), "no", "left_semi").select("no", F.col("class").alias("id"), "text_key", "set_hash", "sig"), f"{at}/known")
    sets = sets_of(docs, known.drop("sig"), id_col=id_col, text_col=text_col)
    full = stored(known.select("no", "sig").join(sets.hint("merge"), "no").select(F.col("no").alias("id"), "sig", "shingles"), f"{at}/full")
    lanes_of = lambda c: full.select(F.col("id").alias(c), F.col("sig").alias(f"sig_{c}"))
    sets_by = lambda c: full.select(F.col("id").alias(c), F.col("shingles").alias(f"set_{c}"))

    # Small buckets: all pairs, at most SMALL * (SMALL - 1) / 2 of each.
    two = buckets.filter("size = 2").select(F.col("low").alias("a"), F.col("high").alias("b"))
    few = shared.filter(f"size > 2 and size <= {SMALL}").select("key", "id")
    more = few.alias("x").join(few.alias("y"), "key").filter("x.id < y.id").select(F.col("x.id").alias("a"), F.col("y.id").alias("b"))
    first = stored(two.unionByName(more).distinct(), f"{at}/pairs")
    first = first.join(lanes_of("a").hint("merge"), "a").join(lanes_of("b").hint("merge"), "b").withColumn("est", estimated("sig_a", "sig_b")).filter(F.col("est") >= floor).select("a", "b")
    both = first.join(sets_by("a").hint("merge"), "a").join(sets_by("b").hint("merge"), "b").select("a", "b", overlap("set_a", "set_b").alias("o"))
    links = both.filter((100 * F.col("o.shared") >= percent * F.col("o.total")) & (F.col("o.total") > 0)).select("a", "b")
    # Buckets of the same members say the same: one of them is enough.
    large = shared.filter(f"size > {SMALL}")
    alike = large.groupBy("key", "size").agg(*(F.sum(F.xxhash64(F.lit(k), "id").cast("decimal(38,0)")).alias(f"h{k}") for k in (1, 2)))
    once = stored(alike.groupBy("size", "h1", "h2").agg(F.min("key").alias("key")).select("key"), f"{at}/once")
    large = stored(large.join(once.hint("merge"), "key", "left_semi").select("key", "size", "id"), f"{at}/large")
    edges = stored(links.unionByName(_first_links(large, full, at, floor, percent)), f"{at}/edges")
    labels = components(edges)
    if large.filter(F.col("size") > BLOCK).limit(1).count() and (rest := _last_links(large, full, labels, at, floor, percent)) is not None:
        labels = components(edges.unionByName(stored(rest, f"{at}/rest")))
    # The smallest id of each component's classes.
    named = classes.select("set_hash", "class", F.col("no").alias("node")).join(labels.hint("merge"), "node", "left").withColumn("label", F.coalesce("label", "node"))
    named = stored(named, f"{at}/named")
    lowest = stored(named.groupBy("label").agg(F.min("class").alias("component_id")), f"{at}/lowest")
    per_class = stored(named.join(lowest.hint("merge"), "label").select("set_hash", "component_id"), f"{at}/components")
    out = sigs.join(per_class.hint("merge"), "set_hash", "left").withColumn("component_id", F.when(F.col("id").isNotNull(), F.when(F.col("n") > 0, F.coalesce("component_id", "id")).otherwise(F.col("id"))))
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))
