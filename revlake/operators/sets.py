"""Multisets: differences, replacement, equality (SET, SNK-12, SNK-14)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_distinct(*frames: DataFrame) -> DataFrame:
    """SET-1, SET-2: union by name without repeated rows."""
    out = frames[0]
    for x in frames[1:]:
        out = out.unionByName(x, allowMissingColumns=True)
    return out.distinct()


def symmetric_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """SET-3: rows that one side has more often, with ``side``. Counted in one grouping rather than two EXCEPT ALLs.

    Rows are spread first: a file of one row group is one task, which would hold all its different rows to combine them. Copies of a row from several tasks stay apart, so they are combined before they meet."""
    both = a.withColumn("_n", F.lit(1)).unionByName(b.withColumn("_n", F.lit(-1))).withColumn("_from", F.spark_partition_id())
    net = both.repartition(*a.columns, "_from").groupBy(*a.columns).agg(F.sum("_n").alias("_n")).filter("_n != 0")
    return net.withColumn("side", F.when(F.col("_n") > 0, "left").otherwise("right")).withColumn("copies", F.abs("_n")).drop("_n")


def multiset_equal(a: DataFrame, b: DataFrame, ignore: list[str] = ()) -> bool:
    """SNK-12: whether two tables hold the same rows as often, without the columns ignored."""
    a, b = a.drop(*ignore), b.drop(*ignore)
    return sorted(a.columns) == sorted(b.columns) and symmetric_difference(a, b.select(a.columns)).isEmpty()


def bucket_differences(a: DataFrame, b: DataFrame, key: list[str]) -> DataFrame:
    """SNK-14: for each of 16 buckets, the first hex digit of the MD5 of the key's text, how many rows each side has and how many differ, copies counted. A row that both sides have equally often
    differs in nothing. One grouping serves all buckets; a bucket that neither side has rows in has no row; nulls in the key are a text of their own."""
    marked = lambda df, side: df.select(*a.columns).withColumn("_side", F.lit(side))
    both = marked(a, 1).unionByName(marked(b, -1))
    net = both.groupBy(*a.columns).agg(F.sum("_side").alias("_net"), F.count_if(F.col("_side") == 1).alias("_left"), F.count_if(F.col("_side") == -1).alias("_right"))
    text = F.concat_ws("\x1f", *(F.coalesce(F.col(k).cast("string"), F.lit("\x00")) for k in key))
    return net.groupBy(F.substring(F.md5(text), 1, 1).alias("bucket")).agg(F.sum("_left").alias("left_rows"), F.sum("_right").alias("right_rows"), F.sum(F.abs("_net")).alias("differing"))


def replace_rows(base: DataFrame, old: DataFrame, new: DataFrame) -> DataFrame:
    """SET-4: ``base`` with the rows of ``old`` taken out once each and those of ``new`` put in. ``old`` has to be there: its rows
    that aren't end the job."""
    counted = base.withColumn("_n", F.lit(1)).unionByName(old.withColumn("_n", F.lit(-1))).groupBy(*base.columns).agg(F.sum("_n").alias("_n"))
    checked = counted.withColumn("_n", F.when(F.col("_n") < 0, F.raise_error(F.lit("before-image isn't in the base"))).otherwise(F.col("_n")).cast("int"))
    left = checked.filter("_n > 0").withColumn("_i", F.explode(F.sequence(F.lit(1), F.col("_n")))).drop("_n", "_i")
    return left.unionByName(new.select(base.columns))
