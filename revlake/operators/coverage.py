"""Coverage calendars, freshness, run metrics, late openings (OPS, SLV-28)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revlake.operators import positions


def calendar(spark: SparkSession, start: str, end: str) -> DataFrame:
    """A row for each day from ``start`` to ``end``."""
    return spark.range(1).select(F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))).alias("source_date"))


def coverage(attempts: DataFrame, start: str, end: str) -> DataFrame:
    """OPS-1: (resource, source_date, state, run_id): success if any attempt had it, else running, failed, no_attempt."""
    days = attempts.select("resource").distinct().crossJoin(F.broadcast(calendar(attempts.sparkSession, start, end)))
    per = attempts.groupBy("resource", "source_date").agg(F.max_by(F.when(F.col("status") == "success", F.col("run_id")), F.struct((F.col("status") == "success"), "started_at", "run_id")).alias("run_id"), *(F.bool_or(F.col("status") == s).alias(s) for s in ("success", "running")))
    state = F.when(F.col("success"), "success").when(F.col("running"), "running").when(F.col("success").isNotNull(), "failed").otherwise("no_attempt")
    return days.join(per, ["resource", "source_date"], "left").select("resource", "source_date", state.alias("state"), "run_id")


def health(covered: DataFrame, today: str) -> DataFrame:
    """OPS-2: latest success, days since, failed dates that no success followed."""
    return covered.groupBy("resource").agg(F.max(F.when(F.col("state") == "success", F.col("source_date"))).alias("latest_success"), F.count_if(F.col("state") == "failed").alias("failed_dates"), F.count_if(F.col("state") == "no_attempt").alias("missing_dates")).withColumn("freshness_days", F.datediff(F.lit(today).cast("date"), "latest_success"))


def date_list(attempts: DataFrame) -> DataFrame:
    """OPS-3: attempts of each date, the effective run and the latest one."""
    at = F.struct("started_at", "run_id")
    return attempts.groupBy("resource", "source_date").agg(F.count("*").alias("attempts"), F.max_by("run_id", F.when(F.col("status") == "success", at)).alias("effective_run"), F.max_by("run_id", at).alias("latest_run"))


def run_summary(attempts: DataFrame) -> DataFrame:
    """OPS-4."""
    return attempts.groupBy("run_id").agg(F.count("*").alias("dates"), F.count_if(F.col("status") == "success").alias("succeeded"), F.count_if(F.col("status") == "failed").alias("failed"), F.sum("bronze_records").alias("records"), F.min("started_at").alias("started_at"), F.max("completed_at").alias("completed_at"))


def merged_page_stats(stats: DataFrame, key: list[str], counts: str) -> DataFrame:
    """OPS-5: maps of counts by kind added up."""
    return stats.select(*key, F.explode(counts).alias("kind", "n")).groupBy(*key, "kind").agg(F.sum("n").alias("n"))


def page_faults(pages: DataFrame, results: DataFrame, size: int) -> DataFrame:
    """OPS-6: (query, fault): totals that change between pages, pages that aren't full before the last, keys seen twice."""
    total = pages.groupBy("query").agg(F.countDistinct("total").alias("totals"), F.max("page").alias("last"))
    unstable = total.filter("totals > 1").select("query", F.lit("unstable_total").alias("fault"))
    short = pages.join(total, "query").filter((F.col("page") < F.col("last")) & (F.col("rows") < size)).select("query", F.lit("short_page").alias("fault"))
    twice = results.groupBy("query", "key").agg(F.count("*").alias("n")).filter("n > 1").select("query", F.lit("repeated_key").alias("fault"))
    return unstable.unionByName(short).unionByName(twice).distinct()


def request_metrics(attempts: DataFrame) -> DataFrame:
    """OPS-7, AGG-11: per endpoint, success rate, retries, exact percentiles by nearest rank, and busy seconds (WIN-9)."""
    m = attempts.groupBy("endpoint").agg(F.count("*").alias("requests"), F.avg(F.col("ok").cast("double")).alias("success_rate"), F.sum(F.col("attempt") - 1).alias("retries"))
    m = m.join(positions.ranks(attempts, ["endpoint"], "latency", {"p50": positions.nearest(0.5), "p95": positions.nearest(0.95)}), "endpoint", "left")
    return m.join(positions.union_length(attempts, ["endpoint"], "started_at", "ended_at").withColumnRenamed("seconds", "busy_seconds"), "endpoint", "left")


def late_openings(notices: DataFrame, openings: DataFrame, now: str, grace: str = "1 hour") -> DataFrame:
    """OPS-8: captured once an opening is there; pending until an hour after the planned time, then unresolved."""
    seen = openings.groupBy("notify_no").agg(F.min("captured_at").alias("captured_at"))
    due = F.col("bid_open_date") + F.expr(f"INTERVAL {grace}")
    state = F.when(F.col("captured_at").isNotNull(), "captured").when(due > F.lit(now).cast("timestamp"), "pending").otherwise("unresolved")
    return notices.join(seen, "notify_no", "left").withColumns({"due_at": due, "state": state})


def day_acceptance(slices: DataFrame, resources: list[str], start: str, end: str) -> DataFrame:
    """SLV-28: (resource, source_date, fault) for each resource and day that isn't there exactly once, complete and clean."""
    spark = slices.sparkSession
    wanted = calendar(spark, start, end).select(F.explode(F.array(*map(F.lit, resources))).alias("resource"), "source_date")
    per = slices.groupBy("resource", "source_date").agg(F.count("*").alias("n"), F.bool_and(F.col("status") == "completed").alias("done"), F.sum("quarantined").alias("q"), F.sum("blocking").alias("b"), F.bool_and(F.col("lineage_ok")).alias("lineage"))
    fault = F.when(F.col("n").isNull(), "missing").when(F.col("n") > 1, "repeated").when(~F.col("done"), "incomplete").when(F.col("q") > 0, "quarantine").when(F.col("b") > 0, "blocking_issue").when(~F.col("lineage"), "lineage")
    return wanted.join(per, ["resource", "source_date"], "left").withColumn("fault", fault).filter("fault is not null").select("resource", "source_date", "fault")


