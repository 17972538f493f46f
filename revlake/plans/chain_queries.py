"""Queries of the silver jobs, the sources and sinks and the streams: payloads are made from the given tables, written to the shared folder and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from revlake.operators import ledger, profiling, quality
from revlake.operators.graph import scratch
from revlake.plans import reporting, silver
from revlake.plans.catalog import query, table
from revlake.plans.rows_queries import orders
from revlake.sources import scans, sinks, versions
from revlake.streaming import streams

def key():
    return F.col("o_orderkey").cast("string")


def price():
    return F.col("o_totalprice").cast("decimal(18,2)").cast("string")


def day():
    return F.date_format("o_orderdate", "yyyy-MM-dd")


def bronze(spark, sf, payload):
    """An observation of each order; ``payload`` is a column of JSON text. Orders are spread first: a file of one row group is one task, which would make and parse all payloads."""
    rows = orders(spark, sf).repartition("o_orderkey").select(key().alias("source_id"), F.lit("1").alias("source_version"), F.lit("r1").alias("run_id"), F.col("o_orderdate").alias("source_date"), F.lit("2024-01-02").cast("timestamp").alias("ingested_at"), payload.alias("payload"))
    return rows.withColumn("content_hash", F.sha2("payload", 256))


def obj(**fields):
    return F.to_json(F.struct(*(c.alias(k) for k, c in fields.items())))


def packages(spark, sf, only=None, fields=None):
    k = F.col("o_orderkey")
    lots = F.array(F.struct(F.lit("1").alias("lotNo"), price().alias("lotPrice")), F.struct(F.lit("2").alias("lotNo"), F.lit("x").alias("lotPrice")))
    place = F.array(F.struct(F.concat(F.lit("|"), (k % 63).cast("string"), F.lit("|")).alias("provCode"), F.lit(" A ").alias("provName")))
    full = obj(
        id=F.when(k % 13 != 0, key()), bidNo=F.concat(F.lit(" B"), key()), planNo=F.when(k % 7 == 0, "N/A").otherwise(F.concat(F.lit("P"), F.col("o_custkey").cast("string"))), bidPrice=F.when(k % 5 == 0, "1.2345678").otherwise(price()), bidPriceUnit=F.when(k % 3 != 0, "VND"),
        bidStartYear=F.year("o_orderdate").cast("string"), bidStartMonth=F.when(k % 11 == 0, "13").otherwise(F.month("o_orderdate").cast("string")), createdDate=F.concat(day(), F.lit("T10:00:00")), bidpBidLotList=lots, bidLocation=F.to_json(place),
    )
    return silver.resource(bronze(spark, sf, F.when(k % 17 != 0, full)), silver.PACKAGE, "package", only=only, fields=fields)


_GOOD = "o_orderkey % 17 <> 0 AND o_orderkey % 13 <> 0"


@query(f"""
    SELECT 'B' || o_orderkey AS package_no, CASE WHEN o_orderkey % 7 <> 0 THEN 'P' || o_custkey END AS plan_no, CASE WHEN o_orderkey % 5 <> 0 THEN CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DECIMAL(38,6)) END AS bid_price, CASE WHEN o_orderkey % 3 <> 0 THEN 'VND' END AS currency,
           CAST(year(o_orderdate) AS BIGINT) AS bid_start_year, CASE WHEN o_orderkey % 11 <> 0 THEN CAST(month(o_orderdate) AS BIGINT) END AS bid_start_month, CAST(o_orderdate AS DATE) AS public_date FROM orders WHERE {_GOOD}""")
def silver_package(spark, sf):
    """SLV-1, SLV-6."""
    return packages(spark, sf, ["package_revision"], ["package_no", "plan_no", "bid_price", "currency", "bid_start_year", "bid_start_month", "public_date"])["package_revision"].select("package_no", "plan_no", "bid_price", "currency", F.col("bid_start_year").cast("bigint").alias("bid_start_year"), F.col("bid_start_month").cast("bigint").alias("bid_start_month"), "public_date")


@query(f"""
    SELECT 'B' || o_orderkey AS package_no, ordinal, lot_no, CASE WHEN lot_no = '1' THEN CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DECIMAL(38,6)) END AS lot_price, CASE WHEN o_orderkey % 3 <> 0 THEN 'VND' END AS currency
    FROM orders, (VALUES (0, '1'), (1, '2')) v(ordinal, lot_no) WHERE {_GOOD}""")
def silver_package_lots(spark, sf):
    """SLV-8: lots with the package's currency."""
    t = packages(spark, sf, ["package_lot", "package_revision"], ["package_no"])
    return t["package_lot"].join(t["package_revision"].select("revision_id", "package_no").hint("merge"), "revision_id").select("package_no", "ordinal", "lot_no", "lot_price", "currency")


@query(f"""SELECT 'B' || o_orderkey AS package_no, CAST(o_orderkey % 63 AS VARCHAR) AS province_code, 'A' AS province_name FROM orders WHERE {_GOOD}""")
def silver_locations(spark, sf):
    """SLV-3, SLV-8: places from an array that is text."""
    t = packages(spark, sf, ["package_location", "package_revision"], ["package_no"])
    return t["package_location"].join(t["package_revision"].select("revision_id", "package_no").hint("merge"), "revision_id").select("package_no", "province_code", "province_name")


@query("""SELECT CASE WHEN o_orderkey % 17 = 0 THEN 'missing_root' ELSE 'missing_identity' END AS reason, COUNT(*) AS n FROM orders WHERE o_orderkey % 17 = 0 OR o_orderkey % 13 = 0 GROUP BY 1""")
def silver_quarantine(spark, sf):
    """SLV-1: what has no root or no identity."""
    return packages(spark, sf, ["quarantine"])["quarantine"].groupBy("reason").agg(F.count("*").alias("n"))


@query(f"""
    SELECT violation, n FROM (SELECT 'lost_observation' AS violation, COUNT(*) AS n FROM orders WHERE {_GOOD} AND o_orderkey % 19 = 0 UNION ALL SELECT 'orphan_package_lot', 2 * COUNT(*) FROM orders WHERE {_GOOD} AND o_orderkey % 19 = 0
    UNION ALL SELECT 'orphan_package_location', COUNT(*) FROM orders WHERE {_GOOD} AND o_orderkey % 19 = 0) WHERE n > 0""")
def silver_integrity(spark, sf):
    """SLV-27: without the revisions of some packages their observations are lost and their children orphaned; all else is whole."""
    t, root = packages(spark, sf, ["observation", "quarantine", "package_revision", "package_lot", "package_location"], ["package_no"]), scratch(spark, "integrity")
    # Tables that are read several times are stored, else every reading parses all payloads again.
    for name, columns in {"observation": ["observation_id"], "quarantine": ["observation_id"], "package_revision": ["observation_id", "revision_id", "package_no"], "package_lot": ["revision_id"], "package_location": ["revision_id"]}.items():
        t[name].select(*columns).write.parquet(f"{root}/{name}")
        t[name] = spark.read.schema(t[name].select(*columns).schema).parquet(f"{root}/{name}")
    some = t | {"package_revision": t["package_revision"].filter("cast(substring(package_no, 2) as bigint) % 19 != 0")}
    return silver.integrity(some, "package_revision", ["package_lot", "package_location"]).groupBy("violation").agg(F.count("*").alias("n"))


@query(f"""
    SELECT CAST(date_trunc('month', CAST(o_orderdate AS DATE)) AS DATE) AS source_month, COUNT(*) AS revisions, COUNT(*) AS current_revisions FROM orders WHERE {_GOOD} GROUP BY 1""")
def silver_assembled(spark, sf):
    """SLV-26: observations read twice give each revision once."""
    t = packages(spark, sf)
    twice = t | {"package_revision": t["package_revision"].unionByName(t["package_revision"])}
    rows = silver.assemble(twice, "package_revision", ["package_lot"])["package_revision"]
    return rows.groupBy("source_month").agg(F.count("*").alias("revisions"), F.count_if("is_current").alias("current_revisions"))


@query("""
    SELECT CAST(o_orderkey AS VARCHAR) AS project_no, CASE WHEN o_orderkey % 2 = 0 THEN 'VND' WHEN o_orderkey % 3 = 0 THEN NULL ELSE 'USD' END AS currency, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DECIMAL(38,6)) AS invest_total, CAST(o_orderdate AS DATE) AS public_date FROM orders""")
def silver_project(spark, sf):
    """SLV-2: fields of the nested root; money, currency, dates."""
    unit = F.when(F.col("o_orderkey") % 2 == 0, " vnd ").when(F.col("o_orderkey") % 3 != 0, "USD")
    payload = obj(projectDTO=F.struct(key().alias("id"), key().alias("no"), price().alias("investTotal"), unit.alias("investTotalUnit"), day().alias("publicDate")), name=F.lit("outside"))
    return silver.resource(bronze(spark, sf, payload), silver.PROJECT, "project")["project_revision"].select("project_no", "currency", "invest_total", "public_date")


@query("""SELECT 'PL' || o_orderkey AS plan_no, CASE WHEN o_orderkey % 4 <> 0 THEN 'J' || o_custkey END AS project_id, CAST(o_orderkey % 10 AS BIGINT) AS package_total, CAST(o_orderdate AS DATE) AS public_date FROM orders""")
def silver_plan(spark, sf):
    """SLV-4, SLV-5."""
    payload = obj(id=key(), planNo=F.concat(F.lit("PL"), key()), pid=F.when(F.col("o_orderkey") % 4 == 0, "NULL").otherwise(F.concat(F.lit("J"), F.col("o_custkey").cast("string"))), bidPack=(F.col("o_orderkey") % 10).cast("string"), publicDate=day())
    return silver.resource(bronze(spark, sf, payload), silver.PLAN, "plan")["plan_revision"].select("plan_no", "project_id", F.col("package_total").cast("bigint").alias("package_total"), "public_date")


def notices(spark, sf, only=None, fields=None):
    k = F.col("o_orderkey")
    main = F.struct(key().alias("id"), F.concat(F.lit("T"), key()).alias("notifyNo"), F.lit("1").alias("notifyVersion"), F.concat(day(), F.lit("T09:00:00")).alias("publicDate"))
    other = F.struct(key().alias("id"), F.when(k % 10 == 0, "other").otherwise(F.concat(F.lit("T"), key())).alias("notifyNo"))
    return silver.notice_tables({"standard": bronze(spark, sf, obj(bidoNotifyContractorM=main, bidoNotifyContractorP=other))}, only, fields)


@query("""SELECT 'T' || o_orderkey AS notify_no, 'VND' AS currency, 'standard' AS source_family, CAST(o_orderdate AS DATE) AS public_date FROM orders WHERE o_orderkey % 10 <> 0""")
def silver_notice(spark, sf):
    """SLV-9, SLV-11."""
    return notices(spark, sf, ["notice_revision"], ["notify_no", "currency", "public_date"])["notice_revision"].select("notify_no", "currency", "source_family", "public_date")


@query("""SELECT 'conflicting_identity' AS code, 'notifyNo' AS path, COUNT(*) AS n FROM orders WHERE o_orderkey % 10 = 0 GROUP BY ALL""")
def silver_notice_conflicts(spark, sf):
    """SLV-10."""
    return notices(spark, sf, ["quality_issue"])["quality_issue"].groupBy("code", "path").agg(F.count("*").alias("n"))


def results(spark, sf, only=("result_revision",)):
    k = F.col("o_orderkey")
    win = lambda won, code: F.struct(F.lit("c1").alias("orgCode"), code.alias("bidResult"), won.alias("bidWiningPrice"))
    lots = F.array(F.struct(F.lit("1").alias("lotNo"), F.array(win(price(), F.lit("1")), win(F.lit(None).cast("string"), F.lit("0"))).alias("contractorList")), F.struct(F.lit("2").alias("lotNo"), F.array(win(F.when(k % 4 != 0, "100.5"), F.when(k % 6 != 0, "1"))).alias("contractorList")))
    return silver.result_tables(bronze(spark, sf, obj(bideContractorInputResultDTO=F.struct(key().alias("id"), F.concat(F.lit("T"), key()).alias("notifyNo"), F.lit("VND").alias("bidPriceUnit"), F.when(k % 9 == 0, "USD").alias("bidEstimatePriceUnit"), lots.alias("lotResultDTO")))), only)


@query("""
    SELECT 'T' || o_orderkey AS notify_no, CASE WHEN o_orderkey % 9 <> 0 AND o_orderkey % 4 <> 0 AND o_orderkey % 6 <> 0 AND CAST(o_totalprice AS DECIMAL(18,2)) > 10 THEN CAST(CAST(o_totalprice AS DECIMAL(18,2)) + 100.5 AS DECIMAL(38,6)) END AS winning_price,
           CASE WHEN o_orderkey % 9 <> 0 THEN 'VND' END AS currency FROM orders""")
def silver_result(spark, sf):
    """SLV-12, SLV-14, SLV-15: totals where all parts are certain."""
    return results(spark, sf)["result_revision"].select("notify_no", "winning_price", "currency")


@query("""SELECT c.lot_ordinal, c.contractor_ordinal, c.won AS is_winner, COUNT(*) AS n FROM orders, LATERAL (VALUES (0, 0, TRUE), (0, 1, FALSE), (1, 0, o_orderkey % 6 <> 0)) c(lot_ordinal, contractor_ordinal, won) GROUP BY ALL""")
def silver_award_contractors(spark, sf):
    """SLV-13, SLV-17."""
    return results(spark, sf)["award_contractor"].groupBy("lot_ordinal", "contractor_ordinal", "is_winner").agg(F.count("*").alias("n"))


@query("""
    SELECT code, n FROM (SELECT 'missing_outcome' AS code, COUNT(*) FILTER (o_orderkey % 6 = 0) AS n FROM orders UNION ALL SELECT 'incomplete_winner_price', COUNT(*) FILTER (o_orderkey % 4 = 0 AND o_orderkey % 6 <> 0) FROM orders
    UNION ALL SELECT 'conflicting_currency', COUNT(*) FILTER (o_orderkey % 9 = 0) FROM orders) WHERE n > 0""")
def silver_result_issues(spark, sf):
    """SLV-16."""
    return results(spark, sf, ["quality_issue"])["quality_issue"].filter("code in ('missing_outcome', 'incomplete_winner_price', 'conflicting_currency')").groupBy("code").agg(F.count("*").alias("n"))


@query("""
    SELECT contract_code, contract_version, CASE WHEN contract_version = '1' THEN 'resolved' WHEN o_orderkey % 5 = 0 THEN 'missing_contract' ELSE 'missing_contract_version' END AS resolution
    FROM (SELECT o_orderkey, 'C' || o_orderkey AS contract_code, CASE WHEN o_orderkey % 5 = 0 OR o_orderkey % 3 = 0 THEN '2' ELSE '1' END AS contract_version FROM orders)""")
def silver_contract_links(spark, sf):
    """SLV-19, SLV-30."""
    k, code = F.col("o_orderkey"), F.concat(F.lit("C"), key())
    version = F.when((k % 5 == 0) | (k % 3 == 0), "2").otherwise("1")
    one = lambda c: obj(contract=F.struct(c.alias("contractCode"), F.lit("1").alias("contractVersion")))
    contracts = silver.resource(bronze(spark, sf, F.when(k % 5 != 0, one(code))), silver.CONTRACT, "contract")["contract_revision"]
    reports = silver.resource(bronze(spark, sf, obj(performance=F.struct(key().alias("id"), code.alias("contractCode"), version.alias("contractVersion"), F.lit("1").alias("contractStatus")))), silver.PERFORMANCE, "performance")["contract_performance_revision"]
    return silver.link_contracts(reports, contracts).select("contract_code", "contract_version", "resolution")


# Sources and sinks.


def attempts_of(spark, sf):
    days = orders(spark, sf).select("o_orderdate").distinct()
    runs = days.select(F.lit("orders").alias("resource"), F.col("o_orderdate").alias("source_date"), F.explode(F.array(F.lit("r0"), F.lit("r1"), F.lit("r2"))).alias("run_id"))
    runs = runs.withColumns({"status": F.when(F.col("run_id") == "r2", "failed").otherwise("success"), "started_at": F.col("source_date").cast("timestamp")})
    n = orders(spark, sf).groupBy(F.col("o_orderdate").alias("source_date")).agg(F.count("*").alias("bronze_records"))
    return runs.join(n, "source_date")


@query("""SELECT CAST(o_orderdate AS DATE) AS source_date, 'r1' AS run_id, COUNT(*) AS n FROM orders GROUP BY ALL""")
def committed_scan(spark, sf):
    """SRC-2: of three runs a day the last that succeeded is read."""
    root = scratch(spark, "committed")
    b = bronze(spark, sf, obj(id=key())).withColumn("source_date", F.trunc("source_date", "year"))
    all_runs = b.drop("run_id").withColumn("run_id", F.explode(F.array(F.lit("r0"), F.lit("r1"), F.lit("r2"))))
    all_runs.write.partitionBy("source_date", "run_id").parquet(f"{root}/orders")
    years = attempts_of(spark, sf).withColumn("source_date", F.trunc("source_date", "year")).groupBy("resource", "source_date", "run_id", "status").agg(F.min("started_at").alias("started_at"))
    read = scans.read_committed(spark, root, years, "orders").select(F.col("source_id").cast("long").alias("o_orderkey"), "run_id")
    return read.join(orders(spark, sf), "o_orderkey").groupBy(F.col("o_orderdate").alias("source_date"), "run_id").agg(F.count("*").alias("n"))


@query("""SELECT CAST(o_orderdate AS DATE) AS source_date, 'r1' AS run_id, 'content_hash' AS violation, CAST(o_orderkey AS VARCHAR) AS detail FROM orders WHERE o_orderkey % 100 = 0""")
def verified_scan(spark, sf):
    """SRC-3: one payload in a hundred was changed after it was hashed; all counts agree."""
    b = bronze(spark, sf, obj(id=key()))
    b = b.withColumn("payload", F.when(F.col("source_id").cast("long") % 100 == 0, F.lit("{}")).otherwise(F.col("payload")))
    return scans.verify_scan(b, attempts_of(spark, sf).filter("run_id = 'r1'"))


@query("""SELECT CAST(o_orderdate AS DATE) AS source_date, 'r1' AS run_id, COUNT(*) FILTER (o_orderkey % 10 <> 0) AS observed, COUNT(*) AS expected FROM orders GROUP BY ALL""")
def commit_counts(spark, sf):
    """SRC-12."""
    return scans.count_against_commits(bronze(spark, sf, obj(id=key())).filter("source_id % 10 != 0"), attempts_of(spark, sf).filter("run_id = 'r1'"))


@query("""SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus END AS o_orderstatus, CASE WHEN o_orderkey % 2 = 1 THEN o_orderpriority END AS o_orderpriority FROM orders""")
def union_scan(spark, sf):
    """SRC-4, SRC-5: two folders with different columns, united by name."""
    root, o = scratch(spark, "union"), orders(spark, sf).withColumn("o_orderkey", F.col("o_orderkey").cast("long"))
    o.filter("o_orderkey % 2 = 0").select("o_orderkey", "o_orderstatus").write.parquet(f"{root}/even")
    o.filter("o_orderkey % 2 = 1").select("o_orderkey", "o_orderpriority").write.parquet(f"{root}/odd")
    return scans.read_union(spark, [f"{root}/even", f"{root}/odd"]).select("o_orderkey", "o_orderstatus", "o_orderpriority")


@query("""SELECT CAST(event_id AS BIGINT) AS event_id, event_type, event_id % 20 = 0 AS corrupt FROM events WHERE event_id % 20 <> 0 UNION ALL SELECT NULL, NULL, TRUE FROM events WHERE event_id % 20 = 0""")
def jsonl_scan(spark, sf):
    """SRC-7: lines that can't be read are kept apart."""
    root = scratch(spark, "jsonl")
    line = F.when(F.col("event_id") % 20 == 0, F.lit("{broken")).otherwise(F.to_json(F.struct("event_id", "event_type")))
    table(spark, sf, "events").select(line.alias("value")).write.text(f"{root}/t")
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("event_type", T.StringType())])
    return scans.read_jsonl(spark, f"{root}/t", schema).select("event_id", "event_type", F.col("_corrupt").isNotNull().alias("corrupt"))


@query("""SELECT o_orderstatus, COUNT(*) AS n FROM orders WHERE o_orderkey % 2 = 0 GROUP BY ALL""")
def versioned_read(spark, sf):
    """SRC-9: the first of two versions."""
    root, o = scratch(spark, "versions"), orders(spark, sf).select("o_orderkey", "o_orderstatus")
    scans.write_version(o.filter("o_orderkey % 2 = 0"), root, "1")
    scans.write_version(o, root, "2")
    return scans.read_version(spark, root, "1").groupBy("o_orderstatus").agg(F.count("*").alias("n"))


@query("""
    WITH d AS (SELECT CAST(date_trunc('year', CAST(o_orderdate AS DATE)) AS DATE) AS d, o_orderkey FROM orders)
    SELECT d, CASE WHEN d BETWEEN DATE '1994-01-01' AND DATE '1995-12-31' THEN 'new' ELSE 'old' END AS kind, COUNT(*) AS n FROM d WHERE NOT d BETWEEN DATE '1995-01-01' AND DATE '1995-12-31' GROUP BY ALL""")
def window_overwrite(spark, sf):
    """SNK-1, SNK-7: two years are replaced, of which the second has no new rows."""
    path = f"{scratch(spark, 'window')}/t"
    o = orders(spark, sf).select(F.trunc("o_orderdate", "year").alias("d"), "o_orderkey", F.lit("old").alias("kind"))
    sinks.overwrite_window(spark, o, path, "d", "1900-01-01", "2100-01-01")
    sinks.overwrite_window(spark, o.filter("year(d) = 1994").withColumn("kind", F.lit("new")), path, "d", "1994-01-01", "1996-01-01")
    return versions.read(spark, path, o.select("o_orderkey", "kind", "d").schema).groupBy("d", "kind").agg(F.count("*").alias("n"))


@query("""SELECT o_custkey, 'new' AS o_orderstatus FROM orders WHERE o_custkey % 3 = 0 UNION ALL SELECT o_custkey, o_orderstatus FROM orders WHERE o_custkey % 3 <> 0""")
def keyed_merge(spark, sf):
    """SNK-8: keys with several rows on both sides."""
    o = orders(spark, sf).select("o_custkey", "o_orderstatus")
    return sinks.merge(o, o.filter("o_custkey % 3 = 0").withColumn("o_orderstatus", F.lit("new")), ["o_custkey"])


@query("""SELECT 'r2' AS run_id, o_orderstatus, COUNT(*) AS n FROM orders GROUP BY ALL""")
def compaction(spark, sf):
    """SNK-10..12: the rows of many files in one, checked as multisets."""
    root = scratch(spark, "compaction")
    orders(spark, sf).select("o_orderkey", "o_orderstatus", F.lit("r1").alias("run_id")).repartition(7, "o_orderkey").write.parquet(f"{root}/a")
    sinks.compact(spark, f"{root}/a", f"{root}/b", run_id="r2")
    return spark.read.parquet(f"{root}/b").groupBy("run_id", "o_orderstatus").agg(F.count("*").alias("n"))


@query("""SELECT CAST(date_trunc('year', CAST(o_orderdate AS DATE)) AS DATE) AS d, CAST(3 AS BIGINT) AS files FROM orders GROUP BY ALL""")
def compaction_plan(spark, sf):
    """SNK-11."""
    path = f"{scratch(spark, 'plan')}/t"
    o = orders(spark, sf).select(F.trunc("o_orderdate", "year").alias("d"), "o_orderkey")
    for _ in range(3):
        o.repartition("d").write.mode("append").partitionBy("d").parquet(path)
    return sinks.compaction_candidates(spark.read.parquet(path), "d").select(F.col("d").cast("date").alias("d"), "files")


# Streams, run until all files are read.


def _streamed(spark, stream, name, mode="append"):
    root = scratch(spark, name)
    stream.writeStream.outputMode(mode).format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/state").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{root}/out")


@query("""SELECT CAST(event_id AS BIGINT) AS event_id, event_type, event_id % 20 = 0 AS corrupt FROM events WHERE event_id % 20 <> 0 UNION ALL SELECT NULL, NULL, TRUE FROM events WHERE event_id % 20 = 0""")
def jsonl_scan(spark, sf):
    """SRC-7: lines that can't be read are kept apart."""
    root = scratch(spark, "jsonl")
    line = F.when(F.col("event_id") % 20 == 0, F.lit("{broken")).otherwise(F.to_json(F.struct("event_id", "event_type")))
    table(spark, sf, "events").select(line.alias("value")).write.text(f"{root}/t")
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("event_type", T.StringType())])
    return scans.read_jsonl(spark, f"{root}/t", schema).select("event_id", "event_type", F.col("_corrupt").isNotNull().alias("corrupt"))


@query("""SELECT o_orderstatus, COUNT(*) AS n FROM orders WHERE o_orderkey % 2 = 0 GROUP BY ALL""")
def versioned_read(spark, sf):
    """SRC-9: the first of two versions."""
    root, o = scratch(spark, "versions"), orders(spark, sf).select("o_orderkey", "o_orderstatus")
    scans.write_version(o.filter("o_orderkey % 2 = 0"), root, "1")
    scans.write_version(o, root, "2")
    return scans.read_version(spark, root, "1").groupBy("o_orderstatus").agg(F.count("*").alias("n"))


@query("""
    WITH d AS (SELECT CAST(date_trunc('year', CAST(o_orderdate AS DATE)) AS DATE) AS d, o_orderkey FROM orders)
    SELECT d, CASE WHEN d BETWEEN DATE '1994-01-01' AND DATE '1995-12-31' THEN 'new' ELSE 'old' END AS kind, COUNT(*) AS n FROM d WHERE NOT d BETWEEN DATE '1995-01-01' AND DATE '1995-12-31' GROUP BY ALL""")
def window_overwrite(spark, sf):
    """SNK-1, SNK-7: two years are replaced, of which the second has no new rows."""
    path = f"{scratch(spark, 'window')}/t"
    o = orders(spark, sf).select(F.trunc("o_orderdate", "year").alias("d"), "o_orderkey", F.lit("old").alias("kind"))
    sinks.overwrite_window(spark, o, path, "d", "1900-01-01", "2100-01-01")
    sinks.overwrite_window(spark, o.filter("year(d) = 1994").withColumn("kind", F.lit("new")), path, "d", "1994-01-01", "1996-01-01")
    return versions.read(spark, path, o.select("o_orderkey", "kind", "d").schema).groupBy("d", "kind").agg(F.count("*").alias("n"))


@query("""SELECT o_custkey, 'new' AS o_orderstatus FROM orders WHERE o_custkey % 3 = 0 UNION ALL SELECT o_custkey, o_orderstatus FROM orders WHERE o_custkey % 3 <> 0""")
def keyed_merge(spark, sf):
    """SNK-8: keys with several rows on both sides."""
    o = orders(spark, sf).select("o_custkey", "o_orderstatus")
    return sinks.merge(o, o.filter("o_custkey % 3 = 0").withColumn("o_orderstatus", F.lit("new")), ["o_custkey"])


@query("""SELECT 'r2' AS run_id, o_orderstatus, COUNT(*) AS n FROM orders GROUP BY ALL""")
def compaction(spark, sf):
    """SNK-10..12: the rows of many files in one, checked as multisets."""
    root = scratch(spark, "compaction")
    orders(spark, sf).select("o_orderkey", "o_orderstatus", F.lit("r1").alias("run_id")).repartition(7, "o_orderkey").write.parquet(f"{root}/a")
    sinks.compact(spark, f"{root}/a", f"{root}/b", run_id="r2")
    return spark.read.parquet(f"{root}/b").groupBy("run_id", "o_orderstatus").agg(F.count("*").alias("n"))


@query("""SELECT CAST(date_trunc('year', CAST(o_orderdate AS DATE)) AS DATE) AS d, CAST(3 AS BIGINT) AS files FROM orders GROUP BY ALL""")
def compaction_plan(spark, sf):
    """SNK-11."""
    path = f"{scratch(spark, 'plan')}/t"
    o = orders(spark, sf).select(F.trunc("o_orderdate", "year").alias("d"), "o_orderkey")
    for _ in range(3):
        o.repartition("d").write.mode("append").partitionBy("d").parquet(path)
    return sinks.compaction_candidates(spark.read.parquet(path), "d").select(F.col("d").cast("date").alias("d"), "files")


# Streams, run until all files are read.


def _streamed(spark, stream, name, mode="append"):
    root = scratch(spark, name)
    stream.writeStream.outputMode(mode).format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/state").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{root}/out")


@query("""SELECT user_id, MAX(event_id) AS event_id FROM events GROUP BY user_id""")
def stream_upsert(spark, sf):
    """STR-1: the newest event of each user, upserted file by file."""
    root = scratch(spark, "upsert")
    e = table(spark, sf, "events").select("user_id", "event_id")
    e.repartitionByRange(3, "event_id").sortWithinPartitions("event_id").write.parquet(f"{root}/in")
    arrivals = streams.read_arrivals(spark, f"{root}/in", e.schema)
    streams.start_upsert(arrivals, f"{root}/out", ["user_id"], f"{root}/state", newest="event_id").awaitTermination()
    return spark.read.parquet(f"{root}/out/v=0")


@query("""SELECT CAST(event_id AS BIGINT) AS event_id FROM events""")
def stream_first_seen(spark, sf):
    """STR-3: every event arrives twice."""
    root = scratch(spark, "seen")
    e = table(spark, sf, "events").select(F.col("event_id").cast("long").alias("event_id"), F.lit("2024-01-01").cast("timestamp").alias("seen_at"))
    e.unionByName(e).write.parquet(f"{root}/in")
    return _streamed(spark, streams.first_seen(streams.read_arrivals(spark, f"{root}/in", e.schema), ["event_id"], "seen_at"), "seen-out").select("event_id")


# Increments, measures, profiles.


@query("""SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey % 10 <> 0""")
def scope_guard(spark, sf):
    """INC-2."""
    o = orders(spark, sf).select("o_orderkey", "o_custkey")
    return ledger.out_of_scope(o, o.filter("o_custkey % 10 = 0"), "o_custkey")


@query("""SELECT 'before' AS image, o_orderkey, o_orderstatus FROM orders WHERE o_custkey % 7 = 0 UNION ALL SELECT 'after', o_orderkey, 'X' FROM orders WHERE o_custkey % 7 = 0 AND o_orderkey % 2 = 0""")
def slice_images(spark, sf):
    """INC-8."""
    o = orders(spark, sf).select("o_orderkey", "o_custkey", "o_orderstatus")
    after = o.filter("o_custkey % 7 != 0 or o_orderkey % 2 = 0").withColumn("o_orderstatus", F.when(F.col("o_custkey") % 7 == 0, "X").otherwise(F.col("o_orderstatus")))
    images = ledger.slice_change(o, after, o.filter("o_custkey % 7 = 0").select("o_custkey").distinct(), ["o_custkey"])
    before, after = (df.select(F.lit(name).alias("image"), "o_orderkey", "o_orderstatus") for name, df in zip(("before", "after"), images, strict=True))
    return before.unionByName(after)


@query("""SELECT o_orderkey, 'content_hash_mismatch' AS fault FROM orders WHERE o_orderkey % 50 = 0 UNION ALL SELECT o_orderkey, 'wrong_table' FROM orders WHERE o_orderkey % 30 = 0""")
def day_faults(spark, sf):
    """DQ-6."""
    b = orders(spark, sf).select("o_orderkey", F.when(F.col("o_orderkey") % 30 == 0, "b").otherwise("a").alias("t"), key().alias("payload")).withColumn("content_hash", F.sha2(F.when(F.col("o_orderkey") % 50 == 0, "?").otherwise(F.col("payload")), 256))
    return quality.day_audit(b, ["o_orderkey"], "t", F.lit("a")).select("o_orderkey", F.explode("faults").alias("fault"))


@query("""SELECT CAST(o_orderdate AS DATE) AS report_date, CASE WHEN SUM(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) > 0 THEN CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(38,6)) END AS planned FROM orders GROUP BY 1""")
def measure_blank_sum(spark, sf):
    """MEA-2: blank, not zero, without an eligible sample."""
    o = orders(spark, sf).withColumn("ok", (F.col("o_orderstatus") == "F").cast("int"))
    return o.groupBy(F.col("o_orderdate").alias("report_date")).agg(reporting.blank_sum("o_totalprice", "ok").cast("decimal(38,6)").alias("planned"))


@query("""SELECT 'events' AS t, COUNT(DISTINCT p) AS fields, COUNT(DISTINCT p) FILTER (p LIKE '$.k%') AS business_fields FROM (SELECT '$' AS p FROM events UNION ALL SELECT '$.k' FROM events WHERE json_exists(props, '$.k'))""")
def profile_field_counts(spark, sf):
    """PRF-12."""
    flat = profiling.flatten_json(table(spark, sf, "events"), "event_id", "props").withColumn("t", F.lit("events"))
    return profiling.field_counts(flat, "t", ["$.k"])


@query("""SELECT 'kept' AS target, '$.k' AS path, COUNT(json_extract_string(props, '$.k')) / COUNT(*)::DOUBLE AS populated_ratio FROM events UNION ALL SELECT 'absent', '$.z', 0.0::DOUBLE FROM (SELECT COUNT(*) FROM events)""")
def profile_mapping(spark, sf):
    """PRF-13."""
    e = table(spark, sf, "events")
    metrics = profiling.path_metrics(profiling.flatten_json(e, "event_id", "props"), e.count())
    return profiling.mapping_coverage(metrics, spark.createDataFrame([("$.k", "kept"), ("$.z", "absent")], "path string, target string"))
