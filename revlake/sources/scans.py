"""Committed, verified, united, versioned and frozen reads of observations (SRC)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revlake.operators.references import bounded

BRONZE = T.StructType([T.StructField("source_id", T.StringType()), T.StructField("source_version", T.StringType()), T.StructField("run_id", T.StringType()), T.StructField("source_date", T.DateType()), T.StructField("ingested_at", T.TimestampType()), T.StructField("content_hash", T.StringType()), T.StructField("payload", T.StringType())])


def effective_attempts(attempts: DataFrame) -> DataFrame:
    """SRC-1: (resource, source_date, run_id) of the last successful run of each date; equal starts by run id."""
    good = attempts.filter("status = 'success'").groupBy("resource", "source_date")
    return good.agg(F.max_by("run_id", F.struct("started_at", "run_id")).alias("run_id"))


def read_committed(spark: SparkSession, root: str, attempts: DataFrame, resource: str) -> DataFrame:
    """SRC-2: rows of the effective run of each date. The join is on the partition columns, so Spark prunes partitions by it at run time."""
    runs = effective_attempts(attempts).filter(F.col("resource") == resource).select("source_date", "run_id")
    return read_union(spark, [f"{root}/{resource}"], BRONZE).join(bounded(runs), ["source_date", "run_id"])


def verify_scan(df: DataFrame, attempts: DataFrame) -> DataFrame:
    """SRC-3: violations: rows whose hash isn't that of their payload, dates whose count isn't the manifest's. Empty if all is well."""
    wrong = df.filter(~F.col("content_hash").eqNullSafe(F.sha2("payload", 256))).select("source_date", "run_id", F.lit("content_hash").alias("violation"), F.col("source_id").alias("detail"))
    return wrong.unionByName(count_against_commits(df, attempts).filter("observed != expected").select("source_date", "run_id", F.lit("row_count").alias("violation"), F.concat_ws("/", "observed", "expected").alias("detail")))


def count_against_commits(df: DataFrame, attempts: DataFrame) -> DataFrame:
    """SRC-12: rows read and rows committed, by date and run, with dates that only one side has."""
    seen = df.groupBy("source_date", "run_id").agg(F.count("*").alias("observed"))
    want = attempts.filter("status = 'success'").select("source_date", "run_id", F.col("bronze_records").alias("expected"))
    return want.join(seen, ["source_date", "run_id"], "full_outer").select("source_date", "run_id", F.coalesce("observed", F.lit(0)).alias("observed"), F.coalesce("expected", F.lit(0)).alias("expected"))


def read_union(spark: SparkSession, paths: list[str], schema: T.StructType | None = None) -> DataFrame:
    """SRC-4, SRC-5: Parquet under several paths united by name, with the file of each row; no path gives an empty table with the schema."""
    if not paths:
        return spark.createDataFrame([], schema or BRONZE).withColumn("file_path", F.lit(None).cast("string"))
    reader = spark.read.option("mergeSchema", "true")
    out = None
    for p in paths:
        one = (reader.schema(schema) if schema else reader).parquet(p).withColumn("file_path", F.col("_metadata.file_path"))
        out = one if out is None else out.unionByName(one, allowMissingColumns=True)
    return out


def family_union(tables: dict[str, DataFrame]) -> DataFrame:
    """SRC-6: tables of one family under each other, with the name of each row's table."""
    out = None
    for name, df in tables.items():
        one = df.withColumn("source_table", F.lit(name))
        out = one if out is None else out.unionByName(one, allowMissingColumns=True)
    return out


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """SRC-7: JSON lines under a declared schema; lines that don't parse are kept in ``_corrupt``."""
    return spark.read.schema(schema.add("_corrupt", T.StringType())).option("columnNameOfCorruptRecord", "_corrupt").json(path)


def write_version(df: DataFrame, root: str, version: str) -> None:
    df.write.mode("overwrite").parquet(f"{root}/v={version}")


def read_version(spark: SparkSession, root: str, version: str) -> DataFrame:
    """SRC-9: a table as of a version."""
    return spark.read.parquet(f"{root}/v={version}")


def freeze(tables: dict[str, DataFrame], cutoff: str, children: dict[str, tuple[str, str]], observation: str = "observation") -> dict[str, DataFrame]:
    """SRC-10: observations until the cutoff, the revisions they brought, and the children of those; ``children`` has (parent table, key) by table."""
    out = {observation: tables[observation].filter(F.col("observed_at") <= F.lit(cutoff).cast("timestamp"))}
    for name, df in tables.items():
        if name != observation and name not in children:
            out[name] = df.join(out[observation].select("observation_id"), "observation_id", "left_semi")
    for name, (parent, key) in children.items():
        out[name] = tables[name].join(out[parent].select(key), key, "left_semi")
    return out


def lineage_orphans(tables: dict[str, DataFrame], observation: str = "observation") -> DataFrame:
    """SRC-10: (table, orphans): revisions without their observation."""
    out = None
    for name, df in tables.items():
        if name != observation and "observation_id" in df.columns:
            one = df.join(tables[observation].select("observation_id"), "observation_id", "left_anti").agg(F.count("*").alias("orphans")).select(F.lit(name).alias("table"), "orphans")
            out = one if out is None else out.unionByName(one)
    return out


def slim(df: DataFrame, columns: list[str], json_col: str | None = None, attributes: list[str] = ()) -> DataFrame:
    """SRC-11: the columns that later steps use; of a JSON column only the attributes that they use."""
    picked = [F.col(c) for c in columns]
    if json_col:
        picked.append(F.to_json(F.struct(*(F.get_json_object(json_col, f"$.{a}").alias(a) for a in attributes))).alias(json_col))
    return df.select(*picked)
