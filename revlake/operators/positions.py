"""Running sums, maxima and row numbers in an order, exact and without a task that sees all rows of a key (SRC-8, AGG-11, PRF-5, WIN-9).

Rows are dealt out by ranges of (key, order) and stored with the number of their part, so a key with many rows lies in several parts, one after another. A part's own
running values come from a window inside it; what a key carries over from earlier parts is a running value over one row for each part. So a hot key is
shared by as many tasks as it has parts. Only rows that are equal in key and order stay together.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revlake.operators.graph import scratch
from revlake.operators.references import bounded

SUM, MAX = "sum", "max"
OF: dict[str, Callable[[Column], Column]] = {SUM: F.sum, MAX: F.max}


def running(df: DataFrame, keys: list[str], by: list[str], columns: dict[str, tuple[str, str, bool]]) -> DataFrame:
    """``df`` with a running value for each (name: (``sum`` or ``max``, column, whether the row itself counts)) in ``columns``, over the rows of its keys in the order of ``by``, nulls first.

    ``by`` should end with a column that tells rows apart: the order of equal rows is any. Null keys are a key. A value that has no row before it is null."""
    spark, folder = df.sparkSession, scratch(df.sparkSession, "running")
    order = [F.col(c).asc_nulls_first() for c in (*keys, *by)]
    dealt = df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id())
    dealt.write.parquet(folder)
    rows = spark.read.schema(dealt.schema).parquet(folder)
    inside = Window.partitionBy("_part", *keys).orderBy(*(F.col(c).asc_nulls_first() for c in by))
    own = {f"_own_{n}": OF[how](c).over(inside.rowsBetween(Window.unboundedPreceding, 0 if itself else -1)) for n, (how, c, itself) in columns.items()}
    per_part = rows.groupBy("_part", *keys).agg(*(OF[how](c).alias(f"_all_{n}") for n, (how, c, _) in columns.items()))
    earlier = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carry = per_part.select(F.col("_part").alias("_p"), *(F.col(k).alias(f"_k_{k}") for k in keys), *(OF[how](f"_all_{n}").over(earlier).alias(f"_carry_{n}") for n, (how, _, _) in columns.items()))
    same = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys), F.col("_part") == F.col("_p"))
    joined = rows.withColumns(own).join(bounded(carry), same)
    both = {n: F.coalesce(F.col(f"_carry_{n}") + F.col(f"_own_{n}"), f"_own_{n}", f"_carry_{n}") if how == SUM else F.greatest(f"_carry_{n}", f"_own_{n}") for n, (how, _, _) in columns.items()}
    return joined.select(*df.columns, *(c.alias(n) for n, c in both.items()))


def numbered(df: DataFrame, by: list[str], keys: list[str] = (), name: str = "position") -> DataFrame:
    """``df`` with each row's number from 1, in the order of ``by``, among the rows of its keys."""
    return running(df.withColumn("_one", F.lit(1).cast("long")), list(keys), by, {name: (SUM, "_one", True)}).drop("_one")


def ranks(df: DataFrame, keys: list[str], value: str, wanted: dict[str, Callable[[Column], Column]]) -> DataFrame:
    """For each key the value at the places in ``wanted``, from 0 in sorted order, each a function of the key's number of values. Nulls have no place.

    Values are counted first, so the running sums go over distinct values."""
    counts = df.filter(F.col(value).isNotNull()).groupBy(*keys, F.col(value).alias("_x")).agg(F.count("*").alias("_c"))
    placed = running(counts, keys, ["_x"], {"_to": (SUM, "_c", True)})
    n = counts.groupBy(*keys).agg(F.sum("_c").alias("_n")).select(F.col("_n"), *(F.col(k).alias(f"_k_{k}") for k in keys))
    same = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys), F.lit(True))
    both = placed.join(n, same) if keys else placed.withColumn("_n", F.lit(n.first()["_n"]))
    at = lambda place: F.max(F.when((F.col("_to") > place) & (F.col("_to") - F.col("_c") <= place), F.col("_x")))
    return both.groupBy(*keys).agg(*(at(f(F.col("_n"))).alias(k) for k, f in wanted.items()))


def nearest(q: float) -> Callable[[Column], Column]:
    """AGG-11: the place of a percentile by nearest rank: the smallest value that at least a share ``q`` of all values doesn't exceed."""
    return lambda n: F.greatest(F.ceil(F.lit(q).cast("decimal(10,9)") * n).cast("long") - 1, F.lit(0))


def every_nth(df: DataFrame, by: list[str], step: int, at_most: int | None = None) -> DataFrame:
    """SRC-8: each row whose number in the order of ``by`` is a multiple of ``step``, the first ``at_most`` of them if that is given (the sample's size, a feature)."""
    position = F.col("_position")
    rows = numbered(df, by, name="_position").filter(position % step == 0)
    return (rows.filter(position <= step * at_most) if at_most is not None else rows).drop("_position")


def union_length(df: DataFrame, keys: list[str], start: str, end: str) -> DataFrame:
    """WIN-9: total length in seconds of the union of overlapping intervals, per key: each interval adds what lies behind all ends before it. Intervals without a start or an end add nothing."""
    rows = df.select(*keys, F.col(start).cast("timestamp").alias("_s"), F.col(end).cast("timestamp").alias("_e"))
    reached = running(rows, keys, ["_s", "_e"], {"_reach": (MAX, "_e", False)})
    begin = F.greatest(F.coalesce("_reach", "_s"), F.col("_s"))
    return reached.groupBy(*keys).agg(F.sum(F.greatest(F.lit(0), F.unix_seconds("_e") - F.unix_seconds(begin))).alias("seconds"))
