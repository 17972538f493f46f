"""Near-duplicate vectors by a forest of random-projection trees.

1. Equal vectors form one class, by a grouping that Spark combines before its shuffle; the forest sees one row per class.
2. Each tree splits space again and again by a random projection, near its median but where it parts few of the linked pairs of a sample; a node
   that any cut would part by more than the rate that the number of trees assumes, as a dense group is, stays a leaf. Vectors near a split go to both
   sides (spill). The cuts come from a sample of ``FIT_ROWS`` vectors; all vectors are indexed. A tree has at most FIT_ROWS / 32 leaves, so its splits are small.
3. Spark groups the vectors by tree and leaf; a leaf over ``BLOCK`` vectors is dealt out as pairs of blocks, so no task gets a whole one. Inside, cosines
   are computed exactly; of a dense group these are all of its pairs. A pair that meets in several leaves counts in the first tree, and there in the first leaf, where it does, as every
   vector brings the list of its leaves. So tasks send sums and a spanning forest instead of pairs.
4. Link counts are added up, components found from the spanning forests.

Nulls: vectors that are null, zero, or hold null or non-finite components link with nothing, nor do rows with a null id; they are components of
their own. Vectors of different dimensions never link; dimensions of few vectors are compared whole, all in one grouping. Classes have numbers of their own,
so rows that repeat an id are linked each by their own vector; rows that repeat both link with each other. Other columns are not read, so none can clash. Empty input gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revlake.llm.common import frugal, run_dir, small_batches, stored
from revlake.llm.components import components

COSINE = 0.95
#: Trees are as many as it takes to miss no more than this share of pairs at the threshold, were there no spill.
MISSED = 0.02
#: Classes in a leaf, about, and in a block of a larger leaf.
LEAF, BLOCK = 400, 1000
#: Half the width of the spill around a split, over all levels of a tree together, in units of how far two unit vectors at the threshold
#: lie apart along one random direction: sqrt(2 - 2 * cosine) / sqrt(dimension). As the levels share it, a vector is in about 1.4
#: leaves of a tree whatever its depth, and rows grow with the vectors.
SPILL = 1.25
#: Vectors that the top of the trees is fitted on at most, and their bytes.
FIT_ROWS, FIT_BYTES = 100_000, 128 << 20
#: Vectors of a node whose linked pairs are counted to place its cut, the shares of the node that may lie left of it, and what a cut at the
#: end of them costs, in shares of parted pairs.
PROBE, SHARES, UNEVEN = 128, np.linspace(0.05, 0.95, 37), 0.05
SEED = 20_010


class Forest:
    """Random splits of each tree, as arrays by node: direction seed is (tree, depth), threshold the sample's median."""

    def __init__(self, sample: np.ndarray, depth: int, trees: int, cosine: float):
        d = sample.shape[1]
        self.depth, self.trees = depth, trees
        rng = np.random.default_rng(SEED)
        self.directions = rng.normal(size=(trees, max(depth, 1), d))
        self.directions /= np.linalg.norm(self.directions, axis=2, keepdims=True)
        self.spill = SPILL / max(depth, 1) * math.sqrt(max(0.0, 2 - 2 * cosine)) / math.sqrt(d)
        # A node without a cut is a leaf.
        self.cuts = np.full((trees, 2**depth), np.nan)
        for t in range(trees):
            node = np.ones(len(sample), int)
            for k in range(depth):
                p = sample @ self.directions[t, k]
                order = np.argsort(node, kind="stable")
                for own in np.split(order, np.flatnonzero(np.diff(node[order])) + 1):
                    if (x := node[own[0]]) >= 2**k:
                        self.cuts[t, x] = self.cut(sample[probe := own if len(own) <= PROBE else rng.choice(own, PROBE, False)], p[probe], p[own], cosine)
                cuts = self.cuts[t, node]
                node = np.where(np.isnan(cuts), node, 2 * node + (p >= cuts))

    def cut(self, probe: np.ndarray, at: np.ndarray, p: np.ndarray, cosine: float) -> float:
        """Where to split a node with projections ``p``; NaN if every cut parts too many of the linked pairs of ``probe``."""
        x, y = np.nonzero(np.triu(probe @ probe.T >= cosine, 1))
        if not len(x):
            return float(np.median(p))
        low, high = np.minimum(at[x], at[y]), np.maximum(at[x], at[y])
        cuts = np.quantile(p, SHARES)
        parted = ((low[:, None] < cuts - self.spill) & (high[:, None] >= cuts + self.spill)).mean(0)
        best = int((parted + UNEVEN * np.abs(SHARES - 0.5) / 0.45).argmin())
        return float(cuts[best]) if parted[best] <= math.acos(cosine) / math.pi else math.nan

    def leaves(self, vectors: np.ndarray) -> list[list[int]]:
        """Numbers of the leaves of each vector; a leaf's tree is its number divided by 2 ** (depth + 1)."""
        n = len(vectors)
        out: list[list[int]] = [[] for _ in range(n)]
        for t in range(self.trees):
            rows, node = np.arange(n), np.ones(n, int)
            for k in range(self.depth):
                away = (vectors @ self.directions[t, k])[rows] - self.cuts[t, node]
                right = away >= 0
                both = np.abs(away) < self.spill
                rows = np.concatenate((rows, rows[both]))
                node = np.concatenate((np.where(np.isnan(away), node, 2 * node + right), (2 * node + ~right)[both]))
            for r, x in sorted(zip(rows.tolist(), node.tolist(), strict=True)):
                out[r].append((t << (self.depth + 1)) + x)
        return out


def unit(vectors: np.ndarray) -> np.ndarray:
    largest = np.abs(vectors).max(1, keepdims=True)
    scaled = vectors / largest
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def near_vectors(rows: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", cosine: float = COSINE, missed: float = MISSED, leaf: int = LEAF) -> DataFrame:
    """Per row: id, ``n_links``, ``component_id``, ``kept``."""
    spark = rows.sparkSession
    small_batches(spark)
    at = run_dir(spark, "vectors")
    v = F.col(vector_col).cast("array<double>")
    fine = F.coalesce(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0) & F.col(id_col).isNotNull(), F.lit(False))
    base = rows.select(F.col(id_col).alias("id"), F.when(fine, v).alias("v"))
    # -0.0 and 0.0 are one value for grouping.
    base = base.withColumn("v", F.transform("v", lambda x: x + F.lit(0.0)))
    classes = stored(base.filter("v is not null").groupBy("v").agg(F.min("id").alias("class"), F.count("*").alias("copies")).withColumns({"dim": F.size("v"), "id": F.monotonically_increasing_id()}), f"{at}/classes")
    # Each dimension of many vectors has a forest of its own; in the others, the dimension is the leaf.
    sizes = stored(classes.groupBy("dim").agg(F.count("*").alias("n")), f"{at}/dimensions")
    many = {r["dim"]: r["n"] for r in sizes.filter(F.col("n") > BLOCK).orderBy("dim").collect()}
    counts, forests = [], []
    for dim, n in [*many.items(), *([(None, 0)] if sizes.filter(F.col("n") <= BLOCK).limit(1).count() else [])]:
        same = classes.filter(F.col("dim") == dim if dim else ~F.col("dim").isin(list(many)))
        c, f = _linked(_indexed(same, dim, n, cosine, missed, leaf) if dim else _whole(same), cosine)
        counts.append(stored(c, f"{at}/counts-{dim}"))
        forests.append(stored(f, f"{at}/forest-{dim}"))
    by_class = classes.select("id", "class", "copies", "v")
    if counts:
        links, edges = counts[0], forests[0]
        for c, f in zip(counts[1:], forests[1:], strict=True):
            links, edges = links.unionByName(c), edges.unionByName(f)
        summed = links.groupBy("id").agg(F.sum("links").alias("links"))
        labels = components(edges).withColumnsRenamed({"node": "id"})
        by_class = by_class.join(summed.hint("merge"), "id", "left").join(labels.hint("merge"), "id", "left")
    else:
        by_class = by_class.withColumns({"links": F.lit(None).cast("long"), "label": F.col("id")})
    by_class = stored(by_class.select("v", "class", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("label", "id").alias("label")), f"{at}/by-class")
    lowest = stored(by_class.groupBy("label").agg(F.min("class").alias("component_id")), f"{at}/lowest")
    by_class = stored(by_class.join(lowest.hint("merge"), "label").select("v", "n_links", "component_id"), f"{at}/by-vector")
    out = base.join(by_class.hint("merge"), "v", "left")
    return out.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "id").alias("component_id"), F.coalesce("component_id", "id").eqNullSafe(F.col("id")).alias("kept"))


def _index_type(classes: DataFrame) -> T.StructType:
    return T.StructType([T.StructField("id", T.LongType()), T.StructField("copies", T.LongType()), T.StructField("u", T.BinaryType()), T.StructField("leaves", T.ArrayType(T.LongType()))])


def _whole(classes: DataFrame) -> DataFrame:
    """(id, copies, u, leaves) of classes of dimensions with few of them: the dimension is the leaf."""

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            u = [unit(np.array([x], float)).tobytes() for x in b.column("v").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("copies"), pa.array(u, pa.binary()), pa.array([[x] for x in b.column("dim").to_pylist()], pa.list_(pa.int64()))], ["id", "copies", "u", "leaves"])

    return stored(classes.select("id", "copies", "v", "dim").mapInArrow(frugal(index), _index_type(classes)), f"{run_dir(classes.sparkSession, 'forest')}/index")


def _indexed(classes: DataFrame, dim: int, n: int, cosine: float, missed: float, leaf: int) -> DataFrame:
    """(id, copies, u, leaves) of classes of one dimension, by a forest."""
    sample = classes.filter(F.pmod(F.xxhash64("id"), F.lit(1_000_000)) < 1_000_000 * min(1.0, min(FIT_ROWS, FIT_BYTES // (8 * dim)) / n)).select("v").toPandas()["v"]
    fitted = unit(np.array(sample.tolist(), float).reshape(-1, dim)) if len(sample) else np.zeros((1, dim))
    depth = max(0, min(round(math.log2(max(n, 1) / leaf)), int(math.log2(max(len(fitted), 32) / 32))))
    # A random split parts two vectors with probability angle / pi, so a pair stays together in a tree with this one.
    together = (1 - math.acos(cosine) / math.pi) ** depth
    trees = 1 if together == 1 else max(4, math.ceil(math.log(missed) / math.log(1 - together)))
    forest = Forest(fitted, depth, trees, cosine)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if len(b):
                u = unit(np.array(b.column("v").to_pylist(), float))
                yield pa.RecordBatch.from_arrays([b.column("id"), b.column("copies"), pa.array([x.tobytes() for x in u], pa.binary()), pa.array(forest.leaves(u), pa.list_(pa.int64()))], ["id", "copies", "u", "leaves"])

    return stored(classes.select("id", "copies", "v").mapInArrow(frugal(index), _index_type(classes)), f"{run_dir(classes.sparkSession, 'forest')}/index")


def groups(near: np.ndarray) -> np.ndarray:
    """For each node of a symmetric matrix of links, the first node of its component."""
    first = np.arange(len(near))
    fresh = near.any(0)
    for x in np.flatnonzero(fresh):
        if fresh[x]:
            front = np.array([x])
            while len(front):
                fresh[front] = False
                first[front] = x
                front = np.flatnonzero(near[front].any(0) & fresh)
    return first


def met_before(a: list[list[int]], b: list[list[int]], leaf: int) -> np.ndarray:
    """Which pairs of two lists of leaves have a smaller leaf than ``leaf`` in common."""
    own = [[y for y in x if y < leaf] for x in a], [[y for y in x if y < leaf] for x in b]
    column = {y: k for k, y in enumerate(sorted({y for x in own[0] for y in x} & {y for x in own[1] for y in x}))}
    sides = [np.zeros((len(xs), len(column)), np.float32) for xs in own]
    for side, xs in zip(sides, own, strict=True):
        at = [(r, column[y]) for r, x in enumerate(xs) for y in x if y in column]
        if at:
            side[tuple(np.array(at).T)] = 1
    return sides[0] @ sides[1].T > 0


def _linked(indexed: DataFrame, cosine: float) -> tuple[DataFrame, DataFrame]:
    """(id, links) and (a, b) of the indexed classes: linked rows of each class, and edges that span the components."""
    spark = indexed.sparkSession
    each = indexed.withColumn("leaf", F.explode("leaves"))
    sizes = each.groupBy("leaf").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    # One row per leaf, a bounded number: trees times FIT_ROWS / 32.
    own = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    dealt = each.join(F.broadcast(sizes), "leaf").withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("leaf", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "id", "copies", "u", "leaves")

    def compare(g: pd.DataFrame) -> pd.DataFrame:
        leaf, i, j = g["leaf"].iloc[0], g["i"].iloc[0], g["j"].iloc[0]
        a, b = g[g["own"] == i], g[g["own"] == j]
        links: list[tuple[int, int]] = []
        edges: list[tuple[int, int]] = []
        if len(a) and len(b):
            ua, ub = (np.frombuffer(b"".join(x["u"])).reshape(len(x), -1) for x in (a, b))
            near = (ua @ ub.T >= cosine) & ~met_before(a["leaves"].tolist(), b["leaves"].tolist(), leaf)
            ids = a["id"].tolist() + (b["id"].tolist() if i != j else [])
            if i == j:
                rank = np.unique(a["id"].to_numpy(), return_inverse=True)[1]
                near = (near | near.T) & (rank[:, None] != rank)
                whole, sums = near, near @ b["copies"].to_numpy().astype(float)
            else:
                whole = np.zeros((len(ids), len(ids)), bool)
                whole[: len(a), len(a) :], whole[len(a) :, : len(a)] = near, near.T
                sums = np.concatenate((near @ b["copies"].to_numpy().astype(float), near.T @ a["copies"].to_numpy().astype(float)))
            first = groups(whole)
            links = [(ids[k], int(sums[k])) for k in np.flatnonzero(sums)]
            edges = [(ids[k], ids[first[k]]) for k in np.flatnonzero(first != np.arange(len(first)))]
        return pd.DataFrame([(x, None, n) for x, n in links] + [(x, y, None) for x, y in edges], columns=["id", "other", "links"]).astype({"other": "Int64", "links": "Int64"})

    found = dealt.groupBy("leaf", "i", "j").applyInPandas(compare, "id long, other long, links long")
    found = stored(found, f"{run_dir(spark, 'found')}/found")
    return found.filter("links is not null").select("id", "links"), found.filter("other is not null").select(F.col("id").alias("a"), F.col("other").alias("b"))
