"""Relationship graph of records and the tokens they share (GRF)."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def scratch(spark: SparkSession, name: str = "graph") -> str:
    """A new folder that all executors see, under ``spark.checkpoint.dir``. Where that is unset a local master gets one of its own; a cluster an error."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _kept(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def links(table: DataFrame, node: Column, tokens: dict[str, Column]) -> DataFrame:
    """GRF-1: distinct (node, token) of a table; a token is "family:value", so values of different families never meet."""
    each = F.array(*(F.when(F.trim(c.cast("string")) != "", F.concat(F.lit(f"{family}:"), F.trim(c.cast("string")))) for family, c in tokens.items()))
    return table.select(node.alias("node"), F.explode(each).alias("token")).filter("node is not null and token is not null").distinct()


def components(found: DataFrame) -> DataFrame:
    """GRF-2: (node, component), component the smallest node reachable over shared tokens.

    Texts are numbered once. A token links its nodes to the smallest number among them, so one with many nodes is combined before each shuffle. A round points each node to its smallest
    neighbour, follows pointers to their ends, and goes on with the links between ends alone: at most half of the nodes are left, so all rounds together cost little more than the first.
    Each step is written, so lineage stays short and lost executors cost one step."""
    spark = found.sparkSession
    at = scratch(spark)
    pairs = _kept(found.select("node", "token").distinct(), f"{at}/pairs")
    nodes = _kept(pairs.select("node").distinct().withColumn("id", F.monotonically_increasing_id()), f"{at}/nodes")
    numbered = _kept(pairs.join(nodes, "node").select("token", "id"), f"{at}/numbered")
    least = numbered.groupBy("token").agg(F.min("id").alias("b"), F.count("*").alias("n")).filter("n > 1").drop("n")
    edges = _kept(numbered.join(least, "token").filter("id != b").select(F.col("id").alias("a"), "b").distinct(), f"{at}/edges-0")
    ends: list[DataFrame] = []
    while not edges.isEmpty():
        k = len(ends)
        near = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).groupBy("a").agg(F.min("b").alias("b"))
        to = _kept(near.select("a", F.least("a", "b").alias("b"), F.lit(True).alias("moved")), f"{at}/to-{k}-0")
        j = 0
        while not to.filter("moved").isEmpty():
            j += 1
            on = to.select(F.col("a").alias("b"), F.col("b").alias("c"))
            to = _kept(to.join(on, "b").select("a", F.col("c").alias("b"), (F.col("b") != F.col("c")).alias("moved")), f"{at}/to-{k}-{j}")
        ends.append(to.select("a", "b"))
        left, right = (ends[-1].select(F.col("a").alias(x), F.col("b").alias(y)) for x, y in (("a", "x"), ("b", "y")))
        edges = _kept(edges.join(left, "a").join(right, "b").filter("x != y").select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).distinct(), f"{at}/edges-{k + 1}")
    if not ends:
        return nodes.select("node", F.col("node").alias("component"))
    # From the last round back: where a round's ends went in the later ones.
    of = ends.pop()
    while ends:
        of = _kept(ends.pop().join(of.select(F.col("a").alias("b"), F.col("b").alias("c")), "b", "left").select("a", F.coalesce("c", "b").alias("b")), f"{at}/of-{len(ends)}")
    labelled = _kept(nodes.join(of.withColumnRenamed("a", "id"), "id", "left").select("node", F.coalesce("b", "id").alias("b")), f"{at}/labelled")
    return _kept(labelled.join(labelled.groupBy("b").agg(F.min("node").alias("component")), "b").select("node", "component"), f"{at}/components")


def impact(found: DataFrame, seeds: DataFrame) -> DataFrame:
    """GRF-3: nodes that the seeds reach. Each round joins only the nodes found last."""
    spark = found.sparkSession
    at = scratch(spark)
    edges = _kept(found.select("node", "token").distinct(), f"{at}/edges")
    seen = front = _kept(seeds.select("node").distinct(), f"{at}/0")
    k = 0
    while not front.isEmpty():
        k += 1
        tokens = edges.join(front, "node", "left_semi").select("token").distinct()
        front = _kept(edges.join(tokens, "token", "left_semi").select("node").distinct().join(seen, "node", "left_anti"), f"{at}/{k}")
        seen = seen.unionByName(front)
    return seen.distinct()


def component_sizes(labels: DataFrame, charges: DataFrame, limit: int) -> DataFrame:
    """GRF-4: rows charged to each component, and whether it is over the limit; ``charges`` has (node, rows)."""
    return labels.join(charges, "node", "left").groupBy("component").agg(F.count("*").alias("nodes"), F.sum(F.coalesce("rows", F.lit(0))).alias("rows")).withColumn("oversized", F.col("rows") > limit)


def linkage_index(entities: DataFrame, entity: str, revision: str, tokens: dict[str, Column]) -> DataFrame:
    """GRF-5: (component, entity, revision, keys) of a table of revisions."""
    found = links(entities, F.col(entity).cast("string"), tokens)
    keys = found.groupBy("node").agg(F.array_sort(F.collect_set("token")).alias("keys"))
    rows = entities.select(F.col(entity).cast("string").alias("node"), F.col(revision).alias("revision_id"))
    return rows.join(components(found), "node", "left").join(keys, "node", "left").select(F.coalesce("component", "node").alias("component"), F.col("node").alias("entity_id"), "revision_id", F.coalesce("keys", F.array().cast("array<string>")).alias("keys"))


def refresh_links(old: DataFrame, changed: DataFrame, new: DataFrame) -> DataFrame:
    """GRF-7: links of changed nodes replaced."""
    return old.join(changed.select("node"), "node", "left_anti").unionByName(new.select("node", "token")).distinct()


def refresh_components(labels: DataFrame, old: DataFrame, changed: DataFrame, new: DataFrame) -> DataFrame:
    """GRF-6: (node, component) after a change: only components with a changed node, or that the new links touch, are found again."""
    now = refresh_links(old, changed, new)
    by_token = now.join(new.select("token").distinct(), "token", "left_semi").select("node")
    hit = labels.join(changed.select("node").unionByName(new.select("node")).unionByName(by_token).distinct(), "node", "left_semi").select("component").distinct()
    again = labels.join(hit, "component", "left_semi").select("node").unionByName(new.select("node")).distinct()
    kept = labels.join(again, "node", "left_anti")
    return kept.unionByName(components(now.join(again, "node", "left_semi")))
