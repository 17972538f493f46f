import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from revlake.operators import ledger, sets
from revlake.sources import scans, sinks, versions


@pytest.fixture
def days(spark):
    return spark.createDataFrame([("2024-01-01", 1), ("2024-01-02", 2), ("2024-01-03", 3)], "d string, x int").withColumn("d", F.to_date("d"))


def read(spark, path):
    return sorted((str(r["d"]), r["x"]) for r in versions.read(spark, path, "x int, d date").collect())


def test_window_overwrite_empties_days_and_is_rerun_safe(spark, days, tmp_path):
    path = str(tmp_path / "t")
    sinks.overwrite_window(spark, days, path, "d", "2024-01-01", "2024-01-04")
    new = days.filter("x = 2").withColumn("x", F.lit(20))
    for _ in range(2):
        sinks.overwrite_window(spark, new, path, "d", "2024-01-02", "2024-01-04")
        assert read(spark, path) == [("2024-01-01", 1), ("2024-01-02", 20)]


def test_compaction_keeps_rows(spark, days, tmp_path):
    source, target = str(tmp_path / "a"), str(tmp_path / "b")
    days.unionByName(days).withColumn("run_id", F.lit("r1")).repartition(5).write.parquet(source)
    assert sinks.compact(spark, source, target, run_id="r2") == 1
    assert spark.read.parquet(target).select("run_id").distinct().first()[0] == "r2"
    assert sets.multiset_equal(spark.read.parquet(source), spark.read.parquet(target), ["run_id"])
    assert sinks.compaction_candidates(spark.read.parquet(source), "d").count() >= 1


def test_committed_scan_reads_effective_runs(spark, tmp_path):
    rows = [("s1", "1", "r1", "2024-01-01"), ("s2", "1", "r2", "2024-01-01"), ("s3", "1", "r3", "2024-01-02")]
    df = spark.createDataFrame(rows, "source_id string, source_version string, run_id string, source_date string").withColumns({"source_date": F.to_date("source_date"), "ingested_at": F.lit("2024-01-03").cast("timestamp"), "payload": F.lit("{}")}).withColumn("content_hash", F.sha2("payload", 256))
    df.write.partitionBy("source_date", "run_id").parquet(str(tmp_path / "plan"))
    at = [("plan", "2024-01-01", "r1", "success", "2024-01-01 01:00:00", 1), ("plan", "2024-01-01", "r2", "success", "2024-01-01 02:00:00", 1), ("plan", "2024-01-02", "r3", "failed", "2024-01-01 02:00:00", 1)]
    attempts = spark.createDataFrame(at, "resource string, source_date string, run_id string, status string, started_at string, bronze_records long").withColumns({"source_date": F.to_date("source_date"), "started_at": F.col("started_at").cast("timestamp")})
    got = scans.read_committed(spark, str(tmp_path), attempts, "plan")
    assert [r["source_id"] for r in got.collect()] == ["s2"]
    assert scans.verify_scan(got, attempts.filter("run_id = 'r2'")).count() == 0
    assert scans.verify_scan(got.withColumn("payload", F.lit("{1}")), attempts.filter("run_id = 'r2'")).count() == 1
    assert scans.read_union(spark, []).count() == 0


def test_versions_and_schema(spark, days, tmp_path):
    scans.write_version(days, str(tmp_path), "1")
    scans.write_version(days.filter("x > 1"), str(tmp_path), "2")
    assert scans.read_version(spark, str(tmp_path), "1").count() == 3
    assert sinks.check_schema(days.schema, days.withColumn("x", F.lit("a")).schema, ["d", "y"])


def test_incremental_equals_rebuild(spark):
    rows = [("o1", "a", 1), ("o1", "b", 2), ("o2", "a", 3), ("o3", "c", 4)]
    grain, measures = ["g"], {"x": "bigint"}
    old = spark.createDataFrame(rows, "owner_key string, g string, x long")
    new = spark.createDataFrame([("o1", "d", 9)], old.schema)
    affected = spark.createDataFrame([("o1",), ("o3",)], "owner_key string")
    book, fact = ledger.retract(old, ledger.aggregate(old, grain, measures), new, affected, grain, measures)
    assert rows_of(fact) == rows_of(ledger.aggregate(book, grain, measures))
    again = ledger.retract(book, fact, new, affected, grain, measures)[1]
    assert rows_of(again) == rows_of(fact)


def test_replay_refuses_a_wrong_before_image(spark, days):
    with pytest.raises(Exception, match="before-image"):
        sets.replace_rows(days, days.withColumn("x", F.lit(99)), days).collect()


def test_differences_are_counted_after_rows_are_spread(spark):
    one = spark.createDataFrame([(1, None), (1, None), (2, "b"), (3, "c")], "x int, y string").coalesce(1)
    plan = sets.symmetric_difference(one, one)._jdf.queryExecution().sparkPlan().toString().splitlines()
    assert any("REPARTITION_BY_COL" in line for line in plan[next(i for i, line in enumerate(plan) if "partial_sum" in line) :])
    other = spark.createDataFrame([(1, None), (2, "b"), (2, "b")], "x int, y string")
    assert rows_of(sets.symmetric_difference(one, other))[1] == sorted(map(repr, [(1, "left", 1, None), (1, "left", 3, "c"), (1, "right", 2, "b")]))


def test_compaction_into_several_files_keeps_hot_rows(spark, tmp_path):
    source, target = str(tmp_path / "a"), str(tmp_path / "b")
    spark.range(1000, numPartitions=1).select((F.col("id") % 2).alias("x"), F.lit("r1").alias("run_id")).write.parquet(source)
    files = sinks.compact(spark, source, target, target_bytes=300, run_id="r2")
    sizes = [r["n"] for r in spark.read.parquet(target).groupBy(F.col("_metadata.file_path")).agg(F.count("*").alias("n")).collect()]
    assert len(sizes) == files > 1 and sum(sizes) == 1000 and max(sizes) < 1000 / files * 1.5
