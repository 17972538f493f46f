"""Rerun-safe writes: windows, upserts, owner sets, cohorts, compaction (SNK)."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revlake.operators.sets import multiset_equal
from revlake.sources import versions


def overwrite_window(spark: SparkSession, new: DataFrame, path: str, day: str, start: str, end: str) -> versions.Commit:
    """SNK-1, SNK-7: days in [start, end) become what ``new`` has; days that it hasn't are emptied, others stay. Read with ``versions.read``.

    ``new`` is evaluated once, into a new folder; the window changes whole, when the commit that names each day's folder is put in place."""
    inside = (F.col(day) >= F.lit(start).cast("date")) & (F.col(day) < F.lit(end).cast("date"))
    before = versions.current(spark, path)
    after = versions.write(new.filter(inside), path, day)
    out = versions.commit(spark, path, {d: f for d, f in before.parts.items() if not start <= d < end} | after, before)
    versions.sweep(spark, path)
    return out


def accept_candidate(spark: SparkSession, root: str, tables: dict[str, DataFrame], on: versions.Commit, violations: Callable[[dict[str, DataFrame]], DataFrame]) -> versions.Commit:
    """INC-4: a candidate, all tables of a star together, becomes the accepted version, or nothing changes.

    The tables are written, read back and validated; ``violations`` gives a row for each fault, and one is enough to refuse. The candidate was made from the version ``on``: if another has been
    accepted since, it is stale and refused (``StaleCommit``). Readers see all of the old tables or all of the new ones."""
    parts = {name: versions.write(df, f"{root.rstrip('/')}")[""] for name, df in tables.items()}
    written = {name: spark.read.schema(tables[name].schema).parquet(f"{root.rstrip('/')}/{folder}") for name, folder in parts.items()}
    fault = violations(written).first()
    if fault is not None:
        raise ValueError(f"candidate refused: {fault.asDict()}")
    return versions.commit(spark, root, parts, on)


def accepted(spark: SparkSession, root: str, name: str, schema: T.StructType) -> DataFrame:
    """INC-4: a table of the accepted version."""
    return versions.read(spark, root, schema, [name])


def insert_absent(existing: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """SNK-2: what is to be appended: rows of ``new`` with keys not there yet, one a key."""
    return new.dropDuplicates(key).join(existing.select(*key), key, "left_anti")


def upsert(existing: DataFrame, new: DataFrame, key: list[str], within: list[str] = ()) -> DataFrame:
    """SNK-3: rows of ``new`` instead of those with their keys; with ``within``, only where these columns (a month) agree as well."""
    return existing.join(new.select(*key, *within).distinct(), [*key, *within], "left_anti").unionByName(new.select(existing.columns))


def replace_slice(existing: DataFrame, new: DataFrame, slices: DataFrame) -> DataFrame:
    """SNK-4, SNK-6: the slices (or cohorts) listed are replaced whole, also by nothing."""
    return existing.join(slices.distinct(), slices.columns, "left_anti").unionByName(new.select(existing.columns))


def replace_owners(existing: DataFrame, new: DataFrame, owner: str, owners: DataFrame) -> DataFrame:
    """SNK-5: children of the owners listed are replaced; an owner with no new child has none."""
    return existing.join(owners.select(owner).distinct(), owner, "left_anti").unionByName(new.select(existing.columns))


def merge(existing: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """SNK-8: upsert that keeps multiplicity: all of a key's new rows replace all its old rows. With unique keys that is a merge."""
    return upsert(existing, new, key)


def apply_delta(tables: dict[str, DataFrame], delta: dict[str, DataFrame], keys: dict[str, list[str]], owners: dict[str, tuple[str, DataFrame]]) -> dict[str, DataFrame]:
    """SNK-16: all tables after a prepared delta. A table in ``owners`` (its owner column, the owners concerned) loses the rows of these owners and gets the delta's, also none; one in ``keys``
    is merged by them; others, and those that the delta leaves out and no owner concerns, stay. A delta for a table that has neither, or rows of owners not named, end the job."""
    out = dict(tables)
    for name in delta.keys() | owners.keys():
        new = delta.get(name, tables[name].limit(0))
        if name in owners:
            column, concerned = owners[name]
            known = concerned.select(column).distinct().withColumn("_known", F.lit(True))
            stray = F.when(F.col("_known").isNull(), F.raise_error(F.lit(f"{name}: the delta has rows of owners that it does not name"))).otherwise(F.lit(True))
            new = new.join(known, column, "left").filter(stray).drop("_known")
            out[name] = replace_owners(tables[name], new, column, concerned)
        elif name in keys:
            out[name] = merge(tables[name], new, keys[name])
        else:
            raise ValueError(f"{name}: neither owners nor keys")
    return out


def last_cohort(df: DataFrame, key: list[str], cohort: str) -> DataFrame:
    """SNK-9: all rows of each key's latest cohort; rows with a null key stay. The maxima are grouped, not ranked, so repeated rows stay too."""
    known = df
    for k in key:
        known = known.filter(F.col(k).isNotNull())
    last = known.groupBy(*key).agg(F.max(cohort).alias(cohort))
    null = df.filter(" or ".join(f"{k} is null" for k in key))
    return known.join(last, [*key, cohort], "left_semi").unionByName(null)


def follow_owner(children: DataFrame, owners: DataFrame, owner: str, cohort: str) -> DataFrame:
    """SNK-9: children of each owner's latest cohort; children without an owner stay."""
    last = owners.groupBy(owner).agg(F.max(cohort).alias(cohort))
    return children.filter(F.col(owner).isNotNull()).join(last, [owner, cohort], "left_semi").unionByName(children.filter(F.col(owner).isNull()))


def compaction_candidates(df: DataFrame, day: str) -> DataFrame:
    """SNK-11: days of a table that are spread over several files."""
    return df.select(day, F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_size").alias("s")).distinct().groupBy(day).agg(F.count("*").alias("files"), F.sum("s").alias("bytes")).filter("files > 1")


def compact(spark: SparkSession, source: str, target: str, *, target_bytes: int = 256 << 20, run_id: str | None = None) -> int:
    """SNK-10: the rows of ``source`` in few files of about ``target_bytes``, zstd; ``run_id`` is rewritten, all else untouched, which is checked.

    Rows go to files by their places: dealing them out in turns would sort all rows of a task first."""
    df = spark.read.parquet(source)
    size = df.select(F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_size").alias("s")).distinct().agg(F.sum("s")).first()[0] or 0
    files = max(1, math.ceil(size / target_bytes))
    out = df.withColumn("run_id", F.lit(run_id)) if run_id and "run_id" in df.columns else df
    out.repartition(files, F.col("_metadata.file_path"), F.col("_metadata.row_index")).write.option("compression", "zstd").parquet(target)
    if not multiset_equal(df, spark.read.parquet(target), ["run_id"] if run_id else []):
        raise ValueError("compaction changed rows")
    return files


def check_schema(a, b, required: list[str] = ()) -> list[str]:
    """SNK-13: what keeps two schemas from being united."""
    of = {f.name: f for f in b}
    out = [f"{f.name}: {f.dataType.simpleString()} and {of[f.name].dataType.simpleString()}" for f in a if f.name in of and f.dataType != of[f.name].dataType]
    out += [f"{f.name}: nullable and not" for f in a if f.name in of and f.nullable != of[f.name].nullable]
    return out + [f"{c}: missing" for c in required if c not in of or c not in a.fieldNames()]


def promote(views: dict[str, DataFrame]) -> None:
    """SNK-15: reporting views over the active versions."""
    for name, df in views.items():
        df.createOrReplaceTempView(name)
