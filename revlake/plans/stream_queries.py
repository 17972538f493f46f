"""Queries of streams with state and of tables under a commit: rows of the given tables arrive in several rounds, out of order and late."""

from __future__ import annotations

from pyspark.sql import functions as F

from revlake.operators import ledger
from revlake.operators.graph import scratch
from revlake.plans.catalog import query, table
from revlake.plans.rows_queries import orders
from revlake.sources import sinks, versions
from revlake.streaming import streams


def events(spark, sf):
    return table(spark, sf, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type", F.round(F.col("value") * 100).cast("long").alias("cents"))


@query("""SELECT user_id, event_id, ts, event_type, CAST(round(value * 100) AS BIGINT) AS cents FROM events QUALIFY ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""")
def stream_upsert(spark, sf):
    """STR-1: the newest event of each user. Four files, a micro-batch each, have events of all times, so that many arrive after newer ones of their user."""
    root, e = scratch(spark, "upsert"), events(spark, sf)
    e.repartition(4, "event_id").write.parquet(f"{root}/in")
    arrivals = streams.read_arrivals(spark, f"{root}/in", e.schema, files=1)
    streams.start_upsert(arrivals, f"{root}/out", ["user_id"], f"{root}/state", newest=["ts", "event_id"]).awaitTermination()
    return streams.upserted(spark, f"{root}/out", e.schema)


#: Every notice has an opening at most; of those, some are captured after the hour and count as none.
CAPTURED = "CASE WHEN event_id % 3 <> 0 THEN ts + INTERVAL 1 MINUTE * (event_id % 90) END"


@query(f"""
    WITH e AS (SELECT event_id AS notify_no, ts AS bid_open_date, {CAPTURED} AS captured FROM events)
    SELECT notify_no, bid_open_date, CASE WHEN captured <= bid_open_date + INTERVAL 1 HOUR THEN captured END AS captured_at,
           CASE WHEN captured <= bid_open_date + INTERVAL 1 HOUR THEN 'captured' ELSE 'unresolved' END AS state FROM e WHERE bid_open_date IS NOT NULL""")
def stream_late_watch(spark, sf):
    """STR-2: notices and openings arrive in two rounds by their times; a third, of one notice and one opening long after, lets the watermarks pass all others."""
    root, e = scratch(spark, "watch"), events(spark, sf)
    notices = e.select(F.col("event_id").alias("notify_no"), F.col("ts").alias("bid_open_date"))
    openings = e.filter("event_id % 3 != 0").select(F.col("event_id").alias("notify_no"), F.expr("ts + make_dt_interval(0, 0, event_id % 90)").alias("captured_at"))
    ends = e.agg(F.min("ts").alias("a"), F.max("ts").alias("b"))
    half = ends.select((F.unix_micros("a") + (F.unix_micros("b") - F.unix_micros("a")) / 2).cast("long")).first()[0]
    late = ends.select(F.lit(-1).cast("long"), F.expr("b + INTERVAL 30 DAYS"))
    out = None
    for k in range(3):
        for name, df, time in (("notices", notices, "bid_open_date"), ("openings", openings, "captured_at")):
            early = F.unix_micros(time) <= F.lit(half)
            (late.toDF(*df.columns) if k == 2 else df.filter(early if k == 0 else ~early)).write.mode("append").parquet(f"{root}/{name}")
        n, o = (streams.read_arrivals(spark, f"{root}/{name}", df.schema) for name, df in (("notices", notices), ("openings", openings)))
        out = streams.late_watch(n, o)
        out.writeStream.outputMode("append").format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/state").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(out.schema).parquet(f"{root}/out").filter("notify_no >= 0")


@query("""SELECT CAST(ts AS DATE) AS report_date, event_type, COUNT(*) AS rows, CAST(SUM(round(value * 100)) AS BIGINT) AS cents FROM events WHERE ts IS NOT NULL GROUP BY ALL""")
def stream_daily_final(spark, sf):
    """STR-4: the daily fact in append mode equals the batch fact once the watermark has passed; events come in two rounds by their days, an event long after ends them."""
    root, e = scratch(spark, "daily"), events(spark, sf)
    last = e.agg(F.max("ts").alias("ts"))
    out = None
    span = [r[0] for r in e.select(F.to_date("ts").alias("d")).filter("d is not null").distinct().orderBy("d").collect()]  # one row per day
    middle = span[len(span) // 2] if span else None
    rounds = [e.filter(F.col("ts") < F.lit(middle)), e.filter(F.col("ts") >= F.lit(middle)), last.select(F.lit(-1).cast("long").alias("event_id"), F.expr("ts + INTERVAL 30 DAYS").alias("ts"), F.lit(0).cast("long").alias("user_id"), F.lit("end").alias("event_type"), F.lit(0).cast("long").alias("cents"))]
    for part in rounds:
        part.write.mode("append").parquet(f"{root}/in")
        out = streams.daily(streams.read_arrivals(spark, f"{root}/in", e.schema), "ts", ["event_type"], ["cents"])
        out.writeStream.outputMode("append").format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/state").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(out.schema).parquet(f"{root}/out").filter("event_type != 'end'")


@query("""
    WITH e AS (SELECT CAST(ts AS DATE) AS d, event_type, CAST(round(value * 100) AS BIGINT) AS cents, event_id % 5 = 0 AS second FROM events WHERE ts IS NOT NULL),
    f AS (SELECT *, second AND d < (SELECT MAX(d) FROM e WHERE NOT second) - 2 AS late FROM e)
    SELECT d AS report_date, event_type, COUNT(*) FILTER (NOT late) AS rows, CAST(SUM(cents) FILTER (NOT late) AS BIGINT) AS cents, COUNT(*) FILTER (late) AS late_rows FROM f GROUP BY ALL""")
def stream_daily_late(spark, sf):
    """STR-4: a fifth of the events comes in a second round, where those of final days are counted apart; the second round is run again with a number that is there already."""
    root, e = scratch(spark, "late"), events(spark, sf)
    for k in (1, 0):
        e.filter(f"(event_id % 5 = 0) = {'false' if k else 'true'}").write.mode("append").parquet(f"{root}/in")
        streams.start_daily(streams.read_arrivals(spark, f"{root}/in", e.schema), f"{root}/out", f"{root}/state", "ts", ["event_type"], ["cents"]).awaitTermination()
    note = versions.current(spark, f"{root}/out").note
    assert not streams.merge_daily(e, int(note["batch"]), f"{root}/out", f"{root}/state", "ts", ["event_type"], ["cents"], 2)
    return versions.read(spark, f"{root}/out", "event_type string, rows long, cents long, late_rows long, report_date date")


@query("""SELECT o_orderstatus, COUNT(*) AS n, 2 AS refused FROM orders GROUP BY ALL""")
def candidate_acceptance(spark, sf):
    """INC-4: a fact of half the orders is accepted, then one of all; a candidate with a repeated grain and one made from the version before are refused and change nothing."""
    root = f"{scratch(spark, 'candidate')}/star"
    fact = lambda rows: rows.groupBy("o_orderstatus").agg(F.count("*").alias("n"))
    faults = lambda tables: ledger.grain_violations(tables["fact"], ["o_orderstatus"])
    o = orders(spark, sf)
    star = lambda df: {"fact": df, "dim": df.select("o_orderstatus").distinct()}
    first = versions.current(spark, root)
    half = sinks.accept_candidate(spark, root, star(fact(o.filter("o_orderkey % 2 = 0"))), first, faults)
    refused = 0
    for candidate, on in ((fact(o).unionByName(fact(o)), half), (fact(o), first)):
        try:
            sinks.accept_candidate(spark, root, star(candidate), on, faults)
        except ValueError:
            refused += 1
    sinks.accept_candidate(spark, root, star(fact(o)), half, faults)
    return sinks.accepted(spark, root, "fact", fact(o).schema).withColumn("refused", F.lit(refused))
