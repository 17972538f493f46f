"""Queries that audit: routing, contracts, cohorts, coverage, calendars, page and request metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from revlake.operators import coverage, profiling, quality
from revlake.plans.catalog import query, table
from revlake.plans.rows_queries import attempts, orders

RULES = {"urgent": ({"o_orderpriority": "1-URGENT"}, [{"o_orderstatus": "F"}]), "open": ({"o_orderstatus": "O"}, []), "paid": ({"o_orderstatus": "F"}, [{"o_orderpriority": "5-LOW"}])}


@query("""
    WITH m AS (SELECT o_orderkey, list_filter([CASE WHEN o_orderpriority = '1-URGENT' AND o_orderstatus <> 'F' THEN 'urgent' END, CASE WHEN o_orderstatus = 'O' THEN 'open' END, CASE WHEN o_orderstatus = 'F' AND o_orderpriority <> '5-LOW' THEN 'paid' END], lambda x: x IS NOT NULL) AS m FROM orders)
    SELECT o_orderkey, CASE WHEN len(m) = 1 THEN m[1] END AS rule, CASE WHEN len(m) = 1 THEN 'routed' WHEN len(m) = 0 THEN 'no_rule' ELSE 'several_rules' END AS routing FROM m""")
def routing(spark, sf):
    return quality.route(orders(spark, sf), RULES).select("o_orderkey", "rule", "routing")


CHECKS = {"no_amount": ("l_extendedprice <= 0", "error"), "deep_discount": ("l_discount >= 0.09", "warning"), "late": ("l_linestatus = 'F' and l_returnflag = 'N'", "error")}


@query("""
    SELECT status, code, COUNT(*) AS n FROM (SELECT CASE WHEN l_extendedprice <= 0 OR (l_linestatus = 'F' AND l_returnflag = 'N') THEN 'error' WHEN l_discount >= 0.09 THEN 'warning' ELSE 'ok' END AS status,
        unnest(list_filter([CASE WHEN l_extendedprice <= 0 THEN 'no_amount' END, CASE WHEN l_discount >= 0.09 THEN 'deep_discount' END, CASE WHEN l_linestatus = 'F' AND l_returnflag = 'N' THEN 'late' END], lambda x: x IS NOT NULL)) AS code FROM lineitem) GROUP BY ALL""")
def record_contract(spark, sf):
    return quality.check(table(spark, sf, "lineitem"), CHECKS).select("status", F.explode("issues.code").alias("code")).groupBy("status", "code").agg(F.count("*").alias("n"))


@query("""SELECT COALESCE(CASE WHEN l_quantity > 45 AND l_discount > 0.05 THEN 'bulk_discount' WHEN l_quantity > 45 THEN 'bulk' WHEN l_discount = 0 THEN 'list_price' END, 'none') AS pattern, COUNT(*) AS n FROM lineitem GROUP BY 1""")
def first_pattern(spark, sf):
    rows = quality.first_pattern(table(spark, sf, "lineitem"), {"bulk_discount": "l_quantity > 45 and l_discount > 0.05", "bulk": "l_quantity > 45", "list_price": "l_discount = 0"})
    return rows.groupBy(F.coalesce("pattern", F.lit("none")).alias("pattern")).agg(F.count("*").alias("n"))


@query("""
    WITH d AS (SELECT *, length(text) AS size, md5(text) AS content FROM documents), m AS (SELECT lang, source, MEDIAN(size) AS med, COUNT(*) AS n FROM d GROUP BY ALL), s AS (SELECT content, COUNT(DISTINCT doc_id) AS k FROM d GROUP BY 1)
    SELECT doc_id, n >= 3 AND size < 0.25 * med AS small_payload, k > 1 AS shared_payload FROM d JOIN m USING (lang, source) JOIN s USING (content)""")
def cohort_warnings(spark, sf):
    d = table(spark, sf, "documents").withColumns({"size": F.length("text"), "content": F.md5("text")})
    w = quality.cohort_warnings(d, ["lang", "source"], "size", "doc_id", "content")
    return w.select("doc_id", F.array_contains("warnings", "small_payload").alias("small_payload"), F.array_contains("warnings", "shared_payload").alias("shared_payload"))


@query("""
    WITH e AS (SELECT event_id, event_id % 4 AS m, event_id % 3 AS q, '{"k":' || user_id || CASE WHEN event_id % 4 >= 1 THEN ',"a":' || CASE WHEN event_id % 3 = 0 THEN 'null' ELSE '"x"' END ELSE '' END || CASE WHEN event_id % 4 >= 2 THEN ',"b":' || CASE WHEN event_id % 3 = 1 THEN 'null' ELSE '""' END ELSE '' END || '}' AS payload FROM events)
    SELECT event_id, strlen(payload) AS bytes, CAST(1 + CASE WHEN m >= 1 THEN 1 ELSE 0 END + CASE WHEN m >= 2 THEN 1 ELSE 0 END AS BIGINT) AS fields, CAST(1 + CASE WHEN m >= 1 AND q <> 0 THEN 1 ELSE 0 END AS BIGINT) AS populated,
        sha256(CASE WHEN m = 0 THEN '["k"]' WHEN m = 1 THEN '["a","k"]' ELSE '["a","b","k"]' END) AS shape_hash, sha256(CASE WHEN m >= 2 AND q = 0 THEN '["a","b"]' WHEN m >= 2 THEN '["b"]' WHEN m = 1 AND q = 0 THEN '["a"]' ELSE '[]' END) AS null_hash FROM e""")
def payload_metrics(spark, sf):
    """DQ-3: payloads of one to three fields, of which some are null or empty."""
    k, q = F.col("event_id") % 4, F.col("event_id") % 3
    text = F.concat(F.lit('{"k":'), F.col("user_id").cast("string"), F.when(k >= 1, F.concat(F.lit(',"a":'), F.when(q == 0, "null").otherwise('"x"'))).otherwise(""), F.when(k >= 2, F.concat(F.lit(',"b":'), F.when(q == 1, "null").otherwise('""'))).otherwise(""), F.lit("}"))
    e = table(spark, sf, "events").select("event_id", text.alias("props"))
    flat = profiling.flatten_json(e, "event_id", "props")
    out = quality.payload_metrics(flat, e.select(F.col("event_id").alias("record"), F.col("props").alias("payload")))
    return out.select(F.col("record").alias("event_id"), F.col("bytes").cast("bigint").alias("bytes"), "fields", "populated", "shape_hash", "null_hash")


@query("""
    WITH p AS (SELECT c_nationkey AS k, COUNT(DISTINCT c_mktsegment) AS n, MIN(c_mktsegment) AS v FROM customer WHERE c_custkey % 200 = 0 GROUP BY 1), f AS (SELECT n_nationkey AS k, COUNT(DISTINCT n_name) AS n, MIN(n_name) AS v FROM nation WHERE n_nationkey % 3 <> 0 GROUP BY 1)
    SELECT s_suppkey, CASE WHEN p.n = 1 THEN p.v WHEN p.n IS NULL AND f.n = 1 THEN f.v END AS context, CASE WHEN p.n = 1 OR (p.n IS NULL AND f.n = 1) THEN 'resolved' WHEN p.n IS NULL AND f.n IS NULL THEN 'missing' ELSE 'ambiguous' END AS context_state FROM supplier LEFT JOIN p ON p.k = s_nationkey LEFT JOIN f ON f.k = s_nationkey""")
def context_lookup(spark, sf):
    primary = table(spark, sf, "customer").filter("c_custkey % 200 = 0").select(F.col("c_nationkey").alias("k"), F.col("c_mktsegment").alias("v"))
    fallback = table(spark, sf, "nation").filter("n_nationkey % 3 != 0").select(F.col("n_nationkey").alias("k"), F.col("n_name").alias("v"))
    return quality.context_of(table(spark, sf, "supplier").withColumn("k", F.col("s_nationkey")), primary, fallback, "k", "v").select("s_suppkey", "context", "context_state")


@query("""SELECT dimension, value, COUNT(*) AS rows FROM (SELECT unnest(['o_orderstatus', 'o_orderpriority']) AS dimension, unnest([o_orderstatus, o_orderpriority]) AS value FROM orders) GROUP BY ALL""")
def audit_summary(spark, sf):
    return quality.audit_summary(orders(spark, sf), ["o_orderstatus", "o_orderpriority"])


_STATUS = "CASE WHEN {t} < 20000 THEN 'error' WHEN {t} < 100000 THEN 'warning' ELSE 'ok' END"


@query(f"""
    WITH b AS (SELECT o_orderkey, {_STATUS.format(t="o_totalprice")} AS before_status FROM orders WHERE o_orderkey % 11 <> 0), a AS (SELECT o_orderkey, {_STATUS.format(t="o_totalprice * (1 + o_orderkey % 3) / 2")} AS after_status FROM orders WHERE o_orderkey % 13 <> 0),
    j AS (SELECT * FROM b FULL JOIN a USING (o_orderkey)), w AS (SELECT *, CASE before_status WHEN 'error' THEN 2 WHEN 'warning' THEN 1 ELSE 0 END AS x, CASE after_status WHEN 'error' THEN 2 WHEN 'warning' THEN 1 ELSE 0 END AS y FROM j)
    SELECT before_status, after_status, CASE WHEN before_status IS NULL THEN 'added' WHEN after_status IS NULL THEN 'removed' WHEN y < x THEN 'repaired' WHEN y > x THEN 'regressed' ELSE 'same' END AS outcome, COUNT(*) AS records FROM w GROUP BY ALL""")
def audit_comparison(spark, sf):
    status = lambda t: F.when(t < 20000, "error").when(t < 100000, "warning").otherwise("ok")
    o = table(spark, sf, "orders")
    k = F.col("o_orderkey")
    before = o.filter(k % 11 != 0).select("o_orderkey", status(F.col("o_totalprice")).alias("status"))
    after = o.filter(k % 13 != 0).select("o_orderkey", status(F.col("o_totalprice") * (1 + k % 3) / 2).alias("status"))
    return quality.compare_audits(before, after, ["o_orderkey"])


@query(f"""
    WITH x AS (SELECT CAST(o_orderdate AS DATE) AS day, {_STATUS.format(t="o_totalprice")} AS status, CASE WHEN o_custkey % 20 = 0 THEN 'missing' ELSE 'resolved' END AS c FROM orders)
    SELECT day, COUNT(*) FILTER (status = 'error') AS failing, COUNT(*) FILTER (c <> 'resolved') AS unresolved, COUNT(*) FILTER (c <> 'resolved') > 0 AS blocked FROM x GROUP BY day HAVING COUNT(*) FILTER (status = 'error') > 0 OR COUNT(*) FILTER (c <> 'resolved') > 0""")
def repair_plan(spark, sf):
    t = F.col("o_totalprice")
    rows = orders(spark, sf).select(F.col("o_orderdate").alias("day"), F.when(t < 20000, "error").when(t < 100000, "warning").otherwise("ok").alias("status"), F.when(F.col("o_custkey") % 20 == 0, "missing").otherwise("resolved").alias("context_state"))
    return quality.repair_plan(rows, "day")


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 9 = 0 THEN 'fixed' ELSE o_orderstatus END AS o_orderstatus, o_custkey FROM orders""")
def repair_reconstruction(spark, sf):
    o = orders(spark, sf).select("o_orderkey", "o_orderstatus", "o_custkey")
    return quality.reconstruct(o, o.filter("o_orderkey % 9 = 0").withColumn("o_orderstatus", F.lit("fixed")), ["o_orderkey"], ["o_orderstatus"])


@query("""SELECT doc_id FROM documents WHERE length(text) < 200 OR text LIKE '%|%' """)
def suspicions(spark, sf):
    return quality.suspicions(table(spark, sf, "documents"), {"short": "length(text) < 200", "table": "text like '%|%'"}).select("doc_id")


@query("""SELECT c_nationkey, c_mktsegment, COUNT(*) AS samples, COUNT(DISTINCT CASE WHEN c_acctbal > 0 THEN c_custkey % 2 END) AS outcomes, CASE COUNT(DISTINCT CASE WHEN c_acctbal > 0 THEN c_custkey % 2 END) WHEN 0 THEN 'unresolved' WHEN 1 THEN 'verified' ELSE 'ambiguous' END AS evidence FROM customer GROUP BY 1, 2""")
def evidence_class(spark, sf):
    c = table(spark, sf, "customer").withColumn("outcome", F.when(F.col("c_acctbal") > 0, F.col("c_custkey") % 2))
    return quality.evidence_class(c, ["c_nationkey", "c_mktsegment"], "outcome")


@query("""
    SELECT o_custkey, CASE WHEN COUNT(DISTINCT o_orderstatus) = 1 THEN MIN(o_orderstatus) END AS o_orderstatus, CASE WHEN COUNT(DISTINCT o_orderpriority) = 1 THEN MIN(o_orderpriority) END AS o_orderpriority, CAST((COUNT(DISTINCT o_orderstatus) > 1)::INT + (COUNT(DISTINCT o_orderpriority) > 1)::INT AS BIGINT) AS conflicts FROM orders GROUP BY 1""")
def merged_context(spark, sf):
    return quality.merged_context(orders(spark, sf), ["o_custkey"], ["o_orderstatus", "o_orderpriority"]).withColumn("conflicts", F.size("conflicts").cast("bigint"))


@query("""
    WITH w AS (SELECT o_orderkey, MIN(CAST(o_orderdate AS DATE)) AS wide_day, COUNT(*) AS wide_rows FROM orders WHERE o_orderkey % 10 <> 0 GROUP BY 1), d AS (SELECT o_orderkey, CASE WHEN o_orderkey % 17 = 0 THEN CAST(o_orderdate AS DATE) + 1 ELSE CAST(o_orderdate AS DATE) END AS daily_day FROM orders WHERE o_orderkey % 7 <> 0)
    SELECT o_orderkey FROM w FULL JOIN d USING (o_orderkey) WHERE wide_day IS DISTINCT FROM daily_day""")
def overlap_faults(spark, sf):
    o = orders(spark, sf).select("o_orderkey", "o_orderdate")
    daily = o.filter("o_orderkey % 7 != 0").withColumn("o_orderdate", F.when(F.col("o_orderkey") % 17 == 0, F.date_add("o_orderdate", 1)).otherwise(F.col("o_orderdate")))
    return quality.overlap_faults(o.filter("o_orderkey % 10 != 0"), daily, ["o_orderkey"], "o_orderdate").select("o_orderkey")


_ATTEMPTS = "a AS (SELECT event_type AS resource, CAST(ts AS DATE) AS source_date, CAST(event_id AS VARCHAR) AS run_id, CASE WHEN value > 30 THEN 'success' WHEN value > 10 THEN 'failed' ELSE 'running' END AS status, ts, event_id % 50 AS n FROM events)"


@query(f"""
    WITH {_ATTEMPTS}, d AS (SELECT CAST(unnest(range(DATE '2023-12-30', DATE '2024-02-02', INTERVAL 1 DAY)) AS DATE) AS source_date), r AS (SELECT DISTINCT resource FROM a),
    p AS (SELECT resource, source_date, BOOL_OR(status = 'success') AS s, BOOL_OR(status = 'running') AS u, arg_max(run_id, (ts, run_id)) FILTER (status = 'success') AS run_id FROM a GROUP BY ALL)
    SELECT resource, source_date, CASE WHEN s THEN 'success' WHEN u THEN 'running' WHEN s IS NOT NULL THEN 'failed' ELSE 'no_attempt' END AS state, run_id FROM r CROSS JOIN d LEFT JOIN p USING (resource, source_date)""")
def calendar_coverage(spark, sf):
    return coverage.coverage(attempts(spark, sf), "2023-12-30", "2024-02-01")


@query(f"""
    WITH {_ATTEMPTS}, p AS (SELECT resource, source_date, BOOL_OR(status = 'success') AS s, BOOL_OR(status = 'running') AS u FROM a GROUP BY ALL)
    SELECT resource, MAX(source_date) FILTER (s) AS latest_success, COUNT(*) FILTER (NOT s AND NOT u) AS failed_dates, 34 - COUNT(*) AS missing_dates, CAST(DATE '2024-02-10' - MAX(source_date) FILTER (s) AS BIGINT) AS freshness_days FROM p GROUP BY 1""")
def resource_health(spark, sf):
    h = coverage.health(calendar_coverage(spark, sf), "2024-02-10")
    return h.select("resource", "latest_success", "failed_dates", "missing_dates", F.col("freshness_days").cast("bigint").alias("freshness_days"))


@query(f"""WITH {_ATTEMPTS} SELECT resource, source_date, COUNT(*) AS attempts, arg_max(run_id, (ts, run_id)) FILTER (status = 'success') AS effective_run, arg_max(run_id, (ts, run_id)) AS latest_run FROM a GROUP BY ALL""")
def date_list(spark, sf):
    return coverage.date_list(attempts(spark, sf))


@query(f"""WITH {_ATTEMPTS} SELECT resource AS run_id, COUNT(*) AS dates, COUNT(*) FILTER (status = 'success') AS succeeded, COUNT(*) FILTER (status = 'failed') AS failed, CAST(SUM(n) AS BIGINT) AS records FROM a GROUP BY 1""")
def run_summary(spark, sf):
    return coverage.run_summary(attempts(spark, sf).withColumn("run_id", F.col("resource"))).select("run_id", "dates", "succeeded", "failed", "records")


@query("""SELECT user_id, event_type AS kind, COUNT(*) AS n FROM events GROUP BY ALL""")
def page_stats(spark, sf):
    stats = table(spark, sf, "events").select("user_id", F.create_map(F.col("event_type"), F.lit(1).cast("bigint")).alias("counts"))
    return coverage.merged_page_stats(stats, ["user_id"], "counts")


@query("""
    WITH t AS (SELECT conv_id AS query, turn AS page, CASE WHEN conv_id % 9 = 0 THEN turn ELSE 5 END AS total, CASE WHEN turn % 7 = 3 THEN 5 ELSE 10 END AS rows, role AS key FROM conversations), l AS (SELECT query, MAX(page) AS last, COUNT(DISTINCT total) AS totals FROM t GROUP BY 1)
    SELECT query, 'unstable_total' AS fault FROM l WHERE totals > 1 UNION SELECT query, 'short_page' FROM t JOIN l USING (query) WHERE page < last AND rows < 10 UNION SELECT query, 'repeated_key' FROM (SELECT query, key FROM t GROUP BY ALL HAVING COUNT(*) > 1)""")
def page_faults(spark, sf):
    c = table(spark, sf, "conversations")
    q = F.col("conv_id").alias("query")
    pages = c.select(q, F.col("turn").alias("page"), F.when(F.col("conv_id") % 9 == 0, F.col("turn")).otherwise(5).alias("total"), F.when(F.col("turn") % 7 == 3, 5).otherwise(10).alias("rows"))
    return coverage.page_faults(pages, c.select(q, F.col("role").alias("key")), 10)


@query("""
    WITH e AS (SELECT event_type, ts AS s, ts + INTERVAL 1 MINUTE AS t FROM events), r AS (SELECT *, MAX(t) OVER (PARTITION BY event_type ORDER BY s, t ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM e),
    b AS (SELECT event_type, CAST(SUM(GREATEST(0, CAST(FLOOR(epoch(t)) AS BIGINT) - CAST(FLOOR(epoch(GREATEST(COALESCE(reach, s), s))) AS BIGINT))) AS BIGINT) AS busy_seconds FROM r GROUP BY 1)
    SELECT event_type AS endpoint, COUNT(*) AS requests, AVG(CASE WHEN value > 10 THEN 1.0 ELSE 0.0 END) AS success_rate, CAST(SUM(user_id % 3) AS BIGINT) AS retries, quantile_disc(value, 0.5) AS p50, quantile_disc(value, 0.95) AS p95, ANY_VALUE(busy_seconds) AS busy_seconds
    FROM events JOIN b USING (event_type) GROUP BY 1""")
def request_metrics(spark, sf):
    e = table(spark, sf, "events")
    rows = e.select(F.col("event_type").alias("endpoint"), (F.col("value") > 10).alias("ok"), (F.col("user_id") % 3 + 1).alias("attempt"), F.col("value").alias("latency"), F.col("ts").alias("started_at"), (F.col("ts") + F.expr("INTERVAL 1 MINUTE")).alias("ended_at"))
    return coverage.request_metrics(rows)


@query("""
    WITH o AS (SELECT l_orderkey, MIN(l_shipdate) AS c FROM lineitem WHERE l_orderkey % 3 <> 0 GROUP BY 1)
    SELECT o_orderkey AS notify_no, CASE WHEN c IS NOT NULL THEN 'captured' WHEN o_orderdate + INTERVAL 1 HOUR > TIMESTAMP '1998-01-01' THEN 'pending' ELSE 'unresolved' END AS state FROM orders LEFT JOIN o ON l_orderkey = o_orderkey""")
def late_openings(spark, sf):
    n = table(spark, sf, "orders").select(F.col("o_orderkey").alias("notify_no"), F.col("o_orderdate").alias("bid_open_date"))
    o = table(spark, sf, "lineitem").filter("l_orderkey % 3 != 0").select(F.col("l_orderkey").alias("notify_no"), F.col("l_shipdate").alias("captured_at"))
    return coverage.late_openings(n, o, "1998-01-01").select("notify_no", "state")


@query("""
    WITH s AS (SELECT event_type AS resource, CAST(ts AS DATE) AS source_date, COUNT(*) AS n FROM events GROUP BY ALL), w AS (SELECT e AS resource, CAST(d AS DATE) AS source_date FROM (SELECT DISTINCT event_type AS e FROM events) CROSS JOIN (SELECT unnest(range(DATE '2024-01-01', DATE '2024-02-05', INTERVAL 1 DAY)) AS d))
    SELECT resource, source_date, CASE WHEN n IS NULL THEN 'missing' WHEN n % 5 = 0 THEN 'quarantine' END AS fault FROM w LEFT JOIN s USING (resource, source_date) WHERE n IS NULL OR n % 5 = 0""")
def day_acceptance(spark, sf):
    slices = table(spark, sf, "events").groupBy(F.col("event_type").alias("resource"), F.to_date("ts").alias("source_date")).agg(F.count("*").alias("n"))
    slices = slices.select("resource", "source_date", F.lit("completed").alias("status"), F.when(F.col("n") % 5 == 0, 1).otherwise(0).alias("quarantined"), F.lit(0).alias("blocking"), F.lit(True).alias("lineage_ok"))
    return coverage.day_acceptance(slices, ["click", "error", "purchase", "signup", "view"], "2024-01-01", "2024-02-04")
