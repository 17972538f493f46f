"""Choosing rows: latest revisions, ties, first and last values (WIN, AGG-4..7, TOP)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revlake.operators.references import settled


def version_number(c: Column) -> Column:
    """WIN-2: the first digits of a version text, so that version 10 follows version 2."""
    return F.regexp_extract(c, r"([0-9]+)", 1).try_cast("bigint")


def order(*columns: Column) -> list[Column]:
    return [c.desc_nulls_last() for c in columns]


def latest(df: DataFrame, keys: list[str], by: list[Column]) -> DataFrame:
    """WIN-1, WIN-5, WIN-7: the row of each key that comes first in ``by``; end ``by`` with a unique column."""
    w = Window.partitionBy(*keys).orderBy(*by)
    return df.withColumn("_rank", F.row_number().over(w)).filter("_rank = 1").drop("_rank")


def tie_conflict(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """WIN-3: ``ties`` rows per key and whether they disagree on ``value``. A grouping, so a hot key is combined before the shuffle."""
    return df.groupBy(*keys).agg(F.count("*").alias("ties"), F.coalesce(F.min(value) != F.max(value), F.lit(False)).alias("tie_conflict"))


def overlap_count(df: DataFrame, keys: list[str], name: str = "decisions") -> DataFrame:
    """WIN-4: number of rows that share the keys, beside each row."""
    return df.join(df.groupBy(*keys).agg(F.count("*").alias(name)), keys)


def rare_overlap_count(df: DataFrame, keys: list[str], name: str = "decisions") -> DataFrame:
    """WIN-4 where few rows share their keys: hashes of keys are counted, and of rows whose hash occurs again the keys themselves, so neither rows nor long keys are shuffled."""
    known = df.dropna(subset=keys)
    hashed = known.select(*keys, F.xxhash64(*keys).alias("_h"))
    again = settled(hashed.groupBy("_h").agg(F.count("*").alias("_n")).filter("_n > 1").select("_h"), "again")
    shared = settled(hashed.join(again, "_h", "left_semi").groupBy(*keys).agg(F.count("*").alias(name)), "shared")
    return known.join(shared, keys, "left").withColumn(name, F.coalesce(name, F.lit(1).cast("long")))


def last_of_period(df: DataFrame, period: str, day: str = "report_date") -> DataFrame:
    """WIN-6: rows of the last observed day of each period. The maxima are a few rows per year."""
    at = F.date_trunc(period, F.col(day))
    ends = df.groupBy(at.alias("_period")).agg(F.max(day).alias(day))
    return df.join(ends.select(day), day, "left_semi")


def last_known(df: DataFrame, keys: list[str], by: list[Column], value: str, name: str) -> DataFrame:
    """WIN-8: the first non-null value of the whole partition in order, beside each row."""
    w = Window.partitionBy(*keys).orderBy(*by).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return df.withColumn(name, F.first(value, ignorenulls=True).over(w))


def spread_sample(df: DataFrame, keys: list[str], by: list[Column]) -> DataFrame:
    """WIN-10: the first, middle and last row of each group."""
    w = Window.partitionBy(*keys)
    rows = df.withColumns({"_at": F.row_number().over(w.orderBy(*by)), "_n": F.count("*").over(w)})
    return rows.filter((F.col("_at") == 1) | (F.col("_at") == F.col("_n")) | (F.col("_at") == F.floor((F.col("_n") + 1) / 2))).drop("_n").withColumnRenamed("_at", "position")


def only_value(c: str) -> Column:
    """AGG-4: the value if the group has just one, else null."""
    return F.when(F.min(c) == F.max(c), F.min(c))


def joined_set(c: str) -> Column:
    """AGG-6: distinct values, sorted, with commas."""
    return F.array_join(F.array_sort(F.collect_set(c)), ",")


def first_by(value: str, *by: str) -> Column:
    """AGG-7: the value of the first row in ``by`` order, nulls last, whatever the value is."""
    keys = [x for c in by for x in (F.col(c).isNull(), F.col(c))]
    return F.min_by(F.struct(F.col(value).alias("v")), F.struct(*keys))["v"]


def top(df: DataFrame, value: str, tie: str, n: int) -> DataFrame:
    """TOP-1: the ``n`` rows with the largest values, ties by ``tie``; ``n`` is what the report asks for."""
    return df.orderBy(F.col(value).desc_nulls_last(), F.col(tie).asc()).limit(n)


def ratio(numerator: Column, denominator: Column) -> Column:
    """AGG-9, AGG-10: a ratio of sums, null where there is nothing to divide by; as double, so that both engines round alike."""
    return numerator.cast("double") / F.nullif(denominator.cast("double"), F.lit(0.0))
