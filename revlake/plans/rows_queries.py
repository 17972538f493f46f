"""Queries that choose, join, replace and compare rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revlake.operators import graph, ledger, positions, references, selection, sets
from revlake.plans.catalog import query, table
from revlake.sources import scans, sinks

MONEY = "decimal(38,6)"


def orders(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").withColumns({"o_totalprice": F.col("o_totalprice").cast(MONEY), "o_orderdate": F.to_date("o_orderdate")})


@query("""
    WITH r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderkey % 20 DESC NULLS LAST, CAST(o_orderdate AS DATE) DESC NULLS LAST, o_orderkey DESC) AS rn FROM orders)
    SELECT o_custkey, o_orderkey, CAST(o_orderkey % 20 AS BIGINT) AS version_number, CAST(o_orderdate AS DATE) AS o_orderdate FROM r WHERE rn = 1""")
def latest_revision(spark, sf):
    rows = orders(spark, sf).withColumn("version", F.concat(F.lit("v"), (F.col("o_orderkey") % 20).cast("string")))
    by = [*selection.order(selection.version_number(F.col("version")), F.col("o_orderdate")), F.col("o_orderkey").desc()]
    return selection.latest(rows, ["o_custkey"], by).select("o_custkey", "o_orderkey", selection.version_number(F.col("version")).alias("version_number"), "o_orderdate")


@query("""SELECT o_custkey, o_orderpriority, COUNT(*) AS ties, COALESCE(MIN(o_orderstatus) <> MAX(o_orderstatus), FALSE) AS tie_conflict FROM orders GROUP BY ALL""")
def tie_conflict(spark, sf):
    return selection.tie_conflict(orders(spark, sf), ["o_custkey", "o_orderpriority"], "o_orderstatus")


@query("""SELECT l_orderkey, l_linenumber, l_partkey, COUNT(*) OVER (PARTITION BY l_partkey, l_suppkey) AS decisions FROM lineitem""")
def overlap_count(spark, sf):
    return selection.overlap_count(table(spark, sf, "lineitem"), ["l_partkey", "l_suppkey"]).select("l_orderkey", "l_linenumber", "l_partkey", "decisions")


_REFERENCES = """
    r AS (SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN NULL WHEN 1 THEN CAST(-1 - o_custkey AS VARCHAR) WHEN 2 THEN ' ' ELSE CAST(o_custkey AS VARCHAR) END AS ref_id,
                 CASE o_orderkey % 3 WHEN 0 THEN c_name WHEN 1 THEN c_mktsegment END AS ref_code FROM orders JOIN customer ON o_custkey = c_custkey),
    c AS (SELECT code, COUNT(DISTINCT e) AS n, MIN(e) AS e FROM (SELECT c_name AS code, c_custkey AS e FROM customer UNION ALL SELECT c_mktsegment, c_custkey FROM customer) GROUP BY code)"""


@query(f"""
    WITH {_REFERENCES}
    SELECT o_orderkey, CASE WHEN k.c_custkey IS NOT NULL THEN k.c_custkey WHEN c.n = 1 THEN c.e END AS customer_entity,
           CASE WHEN k.c_custkey IS NOT NULL THEN 'id' WHEN c.n = 1 THEN 'code' WHEN c.n > 1 THEN 'ambiguous' ELSE 'unresolved' END AS customer_state
    FROM r LEFT JOIN customer k ON r.ref_id = CAST(k.c_custkey AS VARCHAR) LEFT JOIN c ON r.ref_code = c.code""")
def reference_resolution(spark, sf):
    c = table(spark, sf, "customer")
    key = F.col("o_orderkey")
    refs = orders(spark, sf).join(c, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey",
        F.when(key % 4 == 1, (-1 - F.col("o_custkey")).cast("string")).when(key % 4 == 2, " ").when(key % 4 == 3, F.col("o_custkey").cast("string")).alias("ref_id"),
        F.when(key % 3 == 0, F.col("c_name")).when(key % 3 == 1, F.col("c_mktsegment")).alias("ref_code"),
    )
    target = c.select("c_custkey", F.col("c_name").alias("code")).unionByName(c.select("c_custkey", F.col("c_mktsegment").alias("code")))
    return references.resolve(refs, target, id_col="ref_id", code_col="ref_code", entity="c_custkey", raw_id=None, target_code="code", prefix="customer").select("o_orderkey", "customer_entity", "customer_state")


@query(f"""
    WITH {_REFERENCES}, s AS (SELECT o_orderkey, ref_id, CASE WHEN k.c_custkey IS NOT NULL THEN k.c_custkey WHEN c.n = 1 THEN c.e END AS e, k.c_custkey IS NULL AND c.n > 1 AS amb
    FROM r LEFT JOIN customer k ON r.ref_id = CAST(k.c_custkey AS VARCHAR) LEFT JOIN c ON r.ref_code = c.code)
    SELECT CASE WHEN e IS NOT NULL THEN 'resolved' WHEN amb THEN 'CUS_AMBIGUOUS' ELSE 'CUS_UNRESOLVED' END AS kind, COUNT(*) AS n FROM s GROUP BY 1""")
def minted_keys(spark, sf):
    rows = reference_resolution(spark, sf)
    key = references.minted_key("CUS", F.col("customer_entity").cast("string"), F.col("customer_state"), F.col("o_orderkey").cast("string"))
    kind = F.substring_index(key, ":", 1)
    return rows.groupBy(F.when(kind == "CUS", "resolved").otherwise(kind).alias("kind")).agg(F.count("*").alias("n"))


@query("""
    SELECT s_suppkey, u.c_custkey AS only_customer FROM supplier LEFT JOIN
    (SELECT c_nationkey, CAST(FLOOR(c_acctbal / 100) AS BIGINT) AS band, MIN(c_custkey) AS c_custkey FROM customer GROUP BY ALL HAVING COUNT(*) = 1) u
    ON s_nationkey = c_nationkey AND CAST(FLOOR(s_acctbal / 100) AS BIGINT) = band""")
def unique_lookup(spark, sf):
    band = lambda c: F.floor(F.col(c) / 100)
    left = table(spark, sf, "supplier").select("s_suppkey", F.col("s_nationkey").alias("nation"), band("s_acctbal").alias("band"))
    right = table(spark, sf, "customer").select(F.col("c_nationkey").alias("nation"), band("c_acctbal").alias("band"), F.col("c_custkey").alias("only_customer"))
    return references.unique_lookup(left, right, ["nation", "band"], ["only_customer"]).select("s_suppkey", "only_customer")


@query("""
    SELECT DISTINCT s_suppkey, p_partkey FROM supplier, part WHERE s_suppkey = p_partkey OR CAST(s_acctbal AS BIGINT) = CAST(p_retailprice AS BIGINT) OR s_suppkey * 7 = p_partkey""")
def or_key_join(spark, sf):
    s = table(spark, sf, "supplier").select("s_suppkey", F.rint("s_acctbal").cast("bigint").alias("bal"), (F.col("s_suppkey") * 7).alias("seven"))
    p = table(spark, sf, "part").select("p_partkey", F.rint("p_retailprice").cast("bigint").alias("price"))
    return references.any_key_join(s, p, [("s_suppkey", "p_partkey"), ("bal", "price"), ("seven", "p_partkey")], "s_suppkey", "p_partkey")


@query("""
    SELECT DISTINCT l_orderkey FROM lineitem WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_size = 50) OR l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_acctbal < 0)""")
def touched_rows(spark, sf):
    seeds = table(spark, sf, "part").filter("p_size = 50").select(F.lit("l_partkey").alias("family"), F.col("p_partkey").cast("string").alias("key"))
    seeds = seeds.unionByName(table(spark, sf, "supplier").filter("s_acctbal < 0").select(F.lit("l_suppkey").alias("family"), F.col("s_suppkey").cast("string").alias("key")))
    return references.touched(table(spark, sf, "lineitem"), ["l_partkey", "l_suppkey"], seeds, "l_orderkey")


@query("""
    SELECT o_orderkey, CASE WHEN CAST(o_orderdate AS DATE) < DATE '1995-01-01' THEN 'v1' WHEN CAST(o_orderdate AS DATE) < DATE '1997-01-01' THEN 'v2' ELSE 'v3' END || ':' || n_name AS geography
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey""")
def geography_versions(spark, sf):
    spans = spark.sql("SELECT * FROM VALUES ('v1', CAST(NULL AS DATE), DATE '1995-01-01'), ('v2', DATE '1995-01-01', DATE '1997-01-01'), ('v3', DATE '1997-01-01', NULL) AS t(version, valid_from, valid_to)")
    versions = table(spark, sf, "nation").select(F.col("n_nationkey").alias("nation"), "n_name").crossJoin(F.broadcast(spans)).withColumn("valid_from", F.coalesce("valid_from", F.lit("0001-01-01").cast("date")))
    rows = orders(spark, sf).join(table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("nation")), "o_custkey")
    return references.interval_join(rows, versions, equal=["nation"], value="o_orderdate", low="valid_from", high="valid_to").select("o_orderkey", F.concat_ws(":", "version", "n_name").alias("geography"))


@query("""SELECT c_custkey, c_nationkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P') AND c_custkey % 2 = 1""")
def upstream_closure(spark, sf):
    c = table(spark, sf, "customer")
    return references.missing_parents(orders(spark, sf).filter("o_orderstatus = 'P'"), c.filter("c_custkey % 2 = 0"), c, "o_custkey", "c_custkey").select("c_custkey", "c_nationkey")


@query("""SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_totalprice > 400000)""")
def children_of_parents(spark, sf):
    return references.children_of(table(spark, sf, "lineitem"), table(spark, sf, "orders").filter("o_totalprice > 400000"), "l_orderkey", "o_orderkey").select("l_orderkey", "l_linenumber")


@query("""SELECT c_custkey, c_name FROM customer WHERE c_custkey % 3 = 0 UNION ALL SELECT DISTINCT o_custkey, 'synthetic' FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 3 = 0)""")
def synthetic_lineage(spark, sf):
    parents = table(spark, sf, "customer").filter("c_custkey % 3 = 0").select("c_custkey", "c_name")
    return references.synthetic_parents(orders(spark, sf), parents, "o_custkey", "c_custkey", c_name=F.lit("synthetic"))


@query("""
    SELECT 'l_partkey' AS foreign_key, COUNT(*) AS orphan_rows FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size <= 40)
    UNION ALL SELECT 'l_suppkey', COUNT(*) FROM lineitem WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0)""")
def fk_orphans(spark, sf):
    return references.orphans(table(spark, sf, "lineitem"), {"l_partkey": (table(spark, sf, "part").filter("p_size <= 40"), "p_partkey"), "l_suppkey": (table(spark, sf, "supplier").filter("s_acctbal > 0"), "s_suppkey")})


@query("""
    SELECT p_partkey FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 45) AND p_partkey NOT IN (SELECT s_suppkey FROM supplier)""")
def unguarded_labels(spark, sf):
    used = table(spark, sf, "lineitem").filter("l_quantity > 45").select(F.col("l_partkey").alias("p_partkey"))
    return references.unguarded(table(spark, sf, "part"), "p_partkey", used, table(spark, sf, "supplier").select(F.col("s_suppkey").alias("p_partkey"))).select("p_partkey")


@query("""
    WITH b AS (SELECT o_orderkey, o_orderstatus AS before FROM orders WHERE o_orderkey % 5 <> 0), a AS (SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN 'X' ELSE o_orderstatus END AS after FROM orders WHERE o_orderkey % 3 <> 0)
    SELECT o_orderkey, before, after, CASE WHEN b.before IS NULL THEN 'added' WHEN a.after IS NULL THEN 'removed' WHEN before <> after THEN 'changed' ELSE 'same' END AS change FROM b FULL JOIN a USING (o_orderkey)""")
def record_changes(spark, sf):
    o = orders(spark, sf)
    after = o.filter("o_orderkey % 3 != 0").withColumn("o_orderstatus", F.when(F.col("o_orderkey") % 7 == 0, "X").otherwise(F.col("o_orderstatus")))
    return references.diff_records(o.filter("o_orderkey % 5 != 0"), after, ["o_orderkey"], "o_orderstatus")


@query("""SELECT c_custkey, COALESCE(CASE WHEN c_mktsegment <> 'BUILDING' THEN c_mktsegment END, n_name, c_mktsegment) AS known FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey AND n_nationkey % 2 = 0""")
def known_first(spark, sf):
    n = table(spark, sf, "nation").filter("n_nationkey % 2 = 0")
    return table(spark, sf, "customer").join(n, F.col("c_nationkey") == F.col("n_nationkey"), "left").select("c_custkey", references.known_first("BUILDING", F.col("c_mktsegment"), F.col("n_name")).alias("known"))


@query("""
    WITH e AS (SELECT event_type, user_id, ts, ROW_NUMBER() OVER (PARTITION BY event_type, user_id ORDER BY ts, event_id) AS rn, COUNT(*) OVER (PARTITION BY event_type, user_id) AS n FROM events)
    SELECT event_type, user_id, rn AS position FROM e WHERE rn = 1 OR rn = n OR rn = (n + 1) // 2""")
def spread_sample(spark, sf):
    return selection.spread_sample(table(spark, sf, "events"), ["event_type", "user_id"], [F.col("ts"), F.col("event_id")]).select("event_type", "user_id", F.col("position").cast("bigint").alias("position"))


@query("""
    SELECT event_id, FIRST_VALUE(CASE WHEN value > 50 THEN value END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts DESC, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS last_large FROM events""")
def last_known(spark, sf):
    e = table(spark, sf, "events").withColumn("large", F.when(F.col("value") > 50, F.col("value")))
    return selection.last_known(e, ["user_id"], [F.col("ts").desc(), F.col("event_id")], "large", "last_large").select("event_id", "last_large")


@query("""
    WITH e AS (SELECT user_id, ts AS s, ts + INTERVAL 2 HOUR AS t FROM events), m AS (SELECT *, MAX(t) OVER (PARTITION BY user_id ORDER BY s, t ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM e)
    SELECT user_id, CAST(SUM(GREATEST(0, CAST(FLOOR(epoch(t)) AS BIGINT) - CAST(FLOOR(epoch(GREATEST(COALESCE(reach, s), s))) AS BIGINT))) AS BIGINT) AS seconds FROM m GROUP BY user_id""")
def interval_union(spark, sf):
    e = table(spark, sf, "events").select("user_id", F.col("ts").alias("s"), (F.col("ts") + F.expr("INTERVAL 2 HOURS")).alias("t"))
    return positions.union_length(e, ["user_id"], "s", "t")


@query("""
    WITH e AS (SELECT event_id, user_id, ts, ROW_NUMBER() OVER (ORDER BY ts NULLS FIRST, event_id) AS n, ROW_NUMBER() OVER (PARTITION BY event_type ORDER BY ts NULLS FIRST, event_id) AS of_type,
        SUM(user_id) OVER (PARTITION BY event_type ORDER BY ts NULLS FIRST, event_id ROWS UNBOUNDED PRECEDING) AS users FROM events)
    SELECT event_id, of_type, CAST(users AS BIGINT) AS users FROM e WHERE n % 7 = 0""")
def every_nth(spark, sf):
    """SRC-8: each seventh event in the order of time, with its number and a running sum in its type, which has a quarter of all rows."""
    e = table(spark, sf, "events").select("event_id", "user_id", "ts", "event_type")
    rows = positions.numbered(positions.running(e, ["event_type"], ["ts", "event_id"], {"users": ("sum", "user_id", True)}), ["ts", "event_id"], ["event_type"], "of_type")
    return positions.every_nth(rows, ["ts", "event_id"], 7).select("event_id", "of_type", "users")


@query("""
    WITH d AS (SELECT event_type, CAST(ts AS DATE) AS report_date, COUNT(*) AS n FROM events GROUP BY ALL)
    SELECT * FROM d WHERE report_date IN (SELECT MAX(report_date) FROM d GROUP BY date_trunc('week', report_date))""")
def status_last_day(spark, sf):
    days = table(spark, sf, "events").groupBy("event_type", F.to_date("ts").alias("report_date")).agg(F.count("*").alias("n"))
    return selection.last_of_period(days, "week")


@query("""
    SELECT o_custkey, CASE WHEN COUNT(DISTINCT o_orderpriority) = 1 THEN MIN(o_orderpriority) END AS only_priority, string_agg(DISTINCT o_orderstatus, ',' ORDER BY o_orderstatus) AS statuses,
           BOOL_OR(o_totalprice > 400000) AS any_large, BOOL_AND(o_totalprice > 1000) AS all_paid, COUNT(DISTINCT COALESCE(o_orderpriority, o_orderstatus)) AS kinds,
           (array_agg(o_orderpriority ORDER BY CAST(o_orderdate AS DATE), o_orderkey))[1] AS first_priority FROM orders GROUP BY o_custkey""")
def group_values(spark, sf):
    return orders(spark, sf).groupBy("o_custkey").agg(
        selection.only_value("o_orderpriority").alias("only_priority"), selection.joined_set("o_orderstatus").alias("statuses"), F.bool_or(F.col("o_totalprice") > 400000).alias("any_large"), F.bool_and(F.col("o_totalprice") > 1000).alias("all_paid"),
        F.countDistinct(F.coalesce("o_orderpriority", "o_orderstatus")).alias("kinds"), selection.first_by("o_orderpriority", "o_orderdate", "o_orderkey").alias("first_priority"),
    )


@query("""SELECT event_type, quantile_disc(value, 0.5) AS p50, quantile_disc(value, 0.95) AS p95, MEDIAN(value) AS median, MIN(value) AS low, MAX(value) AS high, COUNT(*) FILTER (value > 100) AS large FROM events GROUP BY event_type""")
def percentiles(spark, sf):
    return table(spark, sf, "events").groupBy("event_type").agg(F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY value)").alias("p50"), F.expr("percentile_disc(0.95) WITHIN GROUP (ORDER BY value)").alias("p95"), F.median("value").alias("median"), F.min("value").alias("low"), F.max("value").alias("high"), F.count_if(F.col("value") > 100).alias("large"))


@query("""SELECT l_suppkey, CAST(SUM(CAST(l_extendedprice AS DECIMAL(38,6))) AS DECIMAL(38,6)) AS total FROM lineitem GROUP BY l_suppkey ORDER BY total DESC, l_suppkey LIMIT 10""")
def top_suppliers(spark, sf):
    per = table(spark, sf, "lineitem").groupBy("l_suppkey").agg(F.sum(F.col("l_extendedprice").cast(MONEY)).cast(MONEY).alias("total"))
    return selection.top(per, "total", "l_suppkey", 10)


@query("""SELECT DISTINCT d FROM (SELECT CAST(o_orderdate AS DATE) AS d FROM orders UNION ALL SELECT CAST(l_shipdate AS DATE) FROM lineitem)""")
def distinct_days(spark, sf):
    return sets.union_distinct(orders(spark, sf).select(F.col("o_orderdate").alias("d")), table(spark, sf, "lineitem").select(F.to_date("l_shipdate").alias("d")))


_TWO = """b AS (SELECT l_partkey, l_suppkey FROM lineitem WHERE l_linenumber <= 4), a AS (SELECT l_partkey, l_suppkey FROM lineitem WHERE l_linenumber >= 3)"""


@query(f"""
    WITH {_TWO}, l AS (SELECT * FROM b EXCEPT ALL SELECT * FROM a), r AS (SELECT * FROM a EXCEPT ALL SELECT * FROM b)
    SELECT l_partkey, l_suppkey, 'left' AS side, COUNT(*) AS copies FROM l GROUP BY ALL UNION ALL SELECT l_partkey, l_suppkey, 'right', COUNT(*) FROM r GROUP BY ALL""")
def multiset_diff(spark, sf):
    x = table(spark, sf, "lineitem").select("l_partkey", "l_suppkey", "l_linenumber")
    return sets.symmetric_difference(x.filter("l_linenumber <= 4").drop("l_linenumber"), x.filter("l_linenumber >= 3").drop("l_linenumber"))


@query("""
    SELECT o_orderkey, CASE WHEN o_orderkey % 6 = 0 AND o_orderkey % 4 = 0 THEN 'Z' WHEN o_orderkey % 6 = 0 THEN 'Y' WHEN o_orderkey % 4 = 0 THEN 'W' ELSE o_orderstatus END AS status FROM orders WHERE o_orderkey % 10 <> 3""")
def change_replay(spark, sf):
    base = orders(spark, sf).select("o_orderkey", F.col("o_orderstatus").alias("status"))
    k = F.col("o_orderkey")
    one = base.filter(k % 6 == 0)
    second = base.withColumn("status", F.when(k % 6 == 0, "Y").otherwise(F.col("status"))).filter(k % 4 == 0)
    third = base.withColumn("status", F.when((k % 6 == 0) & (k % 4 == 0), "Z").when(k % 6 == 0, "Y").when(k % 4 == 0, "W").otherwise(F.col("status"))).filter(k % 10 == 3)
    changes = [(one, one.withColumn("status", F.lit("Y"))), (second, second.withColumn("status", F.when(k % 6 == 0, "Z").otherwise("W"))), (third, third.limit(0))]
    return ledger.replay(base, changes)


@query("""
    SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey % 3 <> 0 UNION ALL SELECT o_orderkey, 'new' FROM orders WHERE o_orderkey % 3 = 0 AND o_orderkey % 2 = 0
    UNION ALL SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey % 3 = 0 AND o_orderkey % 2 <> 0 UNION ALL SELECT -1 - o_orderkey, 'new' FROM orders WHERE o_orderkey % 100 = 0""")
def keyed_upsert(spark, sf):
    o = orders(spark, sf).select("o_orderkey", "o_orderstatus")
    new = o.filter("o_orderkey % 6 = 0").withColumn("o_orderstatus", F.lit("new"))
    more = o.filter("o_orderkey % 100 = 0").select((-1 - F.col("o_orderkey")).alias("o_orderkey"), F.lit("new").alias("o_orderstatus"))
    return sinks.upsert(o, new.unionByName(more), ["o_orderkey"])


@query("""SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)""")
def insert_absent(spark, sf):
    return sinks.insert_absent(orders(spark, sf).select(F.col("o_custkey").alias("c_custkey")), table(spark, sf, "customer").select("c_custkey"), ["c_custkey"])


@query("""SELECT l_orderkey, l_linenumber, l_returnflag FROM lineitem WHERE l_orderkey % 4 <> 0 UNION ALL SELECT l_orderkey, l_linenumber, 'Q' FROM lineitem WHERE l_orderkey % 8 = 0""")
def owner_replace(spark, sf):
    x = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    owners = orders(spark, sf).filter("o_orderkey % 4 = 0").select(F.col("o_orderkey").alias("l_orderkey"))
    return sinks.replace_owners(x, x.filter("l_orderkey % 8 = 0").withColumn("l_returnflag", F.lit("Q")), "l_orderkey", owners)


@query("""SELECT event_id, event_type FROM events WHERE NOT (event_type = 'click' AND CAST(ts AS DATE) = DATE '2024-01-05') UNION ALL SELECT event_id, 'again' FROM events WHERE event_type = 'click' AND CAST(ts AS DATE) = DATE '2024-01-05' AND value > 20""")
def slice_replace(spark, sf):
    e = table(spark, sf, "events").select("event_id", "event_type", F.to_date("ts").alias("day"), "value")
    hit = e.filter("event_type = 'click' and day = date'2024-01-05'")
    slices = spark.sql("SELECT 'click' AS event_type, DATE '2024-01-05' AS day")
    return sinks.replace_slice(e, hit.filter("value > 20").withColumn("event_type", F.lit("again")), slices).select("event_id", "event_type")


@query("""
    WITH x AS (SELECT CASE WHEN l_partkey % 11 = 0 THEN NULL ELSE l_partkey END AS k, l_linenumber AS cohort, l_orderkey FROM lineitem), m AS (SELECT k, MAX(cohort) AS cohort FROM x GROUP BY k)
    SELECT x.* FROM x JOIN m ON x.k = m.k AND x.cohort = m.cohort UNION ALL SELECT * FROM x WHERE k IS NULL""")
def last_cohort(spark, sf):
    x = table(spark, sf, "lineitem").select(F.when(F.col("l_partkey") % 11 != 0, F.col("l_partkey")).alias("k"), F.col("l_linenumber").alias("cohort"), "l_orderkey")
    return sinks.last_cohort(x, ["k"], "cohort").select("k", "cohort", "l_orderkey")


@query("""SELECT l_orderkey, l_linenumber FROM lineitem JOIN (SELECT l_orderkey AS k, MAX(l_linenumber) AS m FROM lineitem GROUP BY 1) ON l_orderkey = k AND l_linenumber = m""")
def owner_cohort(spark, sf):
    x = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber")
    return sinks.follow_owner(x, x, "l_orderkey", "l_linenumber")


@query("""
    WITH a AS (SELECT event_type AS resource, CAST(ts AS DATE) AS source_date, event_id, ts, value > 30 AS ok FROM events)
    SELECT resource, source_date, CAST(arg_max(event_id, (ts, event_id)) AS VARCHAR) AS run_id FROM a WHERE ok GROUP BY ALL""")
def effective_attempts(spark, sf):
    return scans.effective_attempts(attempts(spark, sf))


def attempts(spark: SparkSession, sf: str) -> DataFrame:
    """Events read as runs: a type is a resource, an event an attempt."""
    e = table(spark, sf, "events")
    return e.select(F.col("event_type").alias("resource"), F.to_date("ts").alias("source_date"), F.col("event_id").cast("string").alias("run_id"), F.when(F.col("value") > 30, "success").when(F.col("value") > 10, "failed").otherwise("running").alias("status"), F.col("ts").alias("started_at"), (F.col("ts") + F.expr("INTERVAL 90 MINUTES")).alias("completed_at"), (F.col("event_id") % 50).alias("bronze_records"))


@query("""SELECT 'supplier' AS source_table, s_suppkey AS k, s_name AS name, NULL AS segment FROM supplier UNION ALL SELECT 'customer', c_custkey, c_name, c_mktsegment FROM customer""")
def family_union(spark, sf):
    s = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("k"), F.col("s_name").alias("name"))
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    return scans.family_union({"supplier": s, "customer": c})


@query("""
    SELECT 'orders' AS name, COUNT(*) AS n FROM orders WHERE o_orderdate <= TIMESTAMP '1996-06-30' UNION ALL
    SELECT 'lineitem', COUNT(*) FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderdate <= TIMESTAMP '1996-06-30') UNION ALL
    SELECT 'customer', COUNT(*) FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderdate <= TIMESTAMP '1996-06-30')""")
def source_freeze(spark, sf):
    o = table(spark, sf, "orders").withColumns({"observed_at": F.col("o_orderdate"), "observation_id": F.col("o_custkey")})
    tables = {"orders": o, "customer": table(spark, sf, "customer").withColumn("observation_id", F.col("c_custkey")), "lineitem": table(spark, sf, "lineitem").withColumn("o_orderkey", F.col("l_orderkey"))}
    frozen = scans.freeze(tables, "1996-06-30", {"lineitem": ("orders", "o_orderkey")}, observation="orders")
    out = None
    for name, df in frozen.items():
        one = df.agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "n")
        out = one if out is None else out.unionByName(one)
    return out


@query("""SELECT event_id, '{"k":"' || json_extract_string(props, '$.k') || '"}' AS props FROM events""")
def slim_projection(spark, sf):
    return scans.slim(table(spark, sf, "events"), ["event_id"], "props", ["k"])


_NEGATIVE = "WITH neg AS (SELECT c_nationkey, MIN(CAST(c_custkey AS VARCHAR)) AS m, BOOL_OR(c_custkey % 50 = 0) AS hit FROM customer WHERE c_acctbal < 500 GROUP BY 1)"


@query(f"""{_NEGATIVE} SELECT CAST(c_custkey AS VARCHAR) AS node, COALESCE(CASE WHEN c_acctbal < 500 THEN m END, CAST(c_custkey AS VARCHAR)) AS component FROM customer c LEFT JOIN neg ON c.c_nationkey = neg.c_nationkey""")
def graph_components(spark, sf):
    return graph.components(_customer_links(spark, sf))


def _customer_links(spark: SparkSession, sf: str) -> DataFrame:
    return graph.links(table(spark, sf, "customer"), F.col("c_custkey").cast("string"), {"name": F.col("c_name"), "nation": F.when(F.col("c_acctbal") < 500, F.col("c_nationkey"))})


@query(f"""{_NEGATIVE} SELECT CAST(c_custkey AS VARCHAR) AS node FROM customer c JOIN neg ON c.c_nationkey = neg.c_nationkey AND c_acctbal < 500 AND hit UNION SELECT CAST(c_custkey AS VARCHAR) FROM customer WHERE c_acctbal >= 500 AND c_custkey % 50 = 0""")
def impact_frontier(spark, sf):
    seeds = table(spark, sf, "customer").filter("c_custkey % 50 = 0").select(F.col("c_custkey").cast("string").alias("node"))
    return graph.impact(_customer_links(spark, sf), seeds)


@query(f"""{_NEGATIVE}, l AS (SELECT c_custkey, COALESCE(CASE WHEN c_acctbal < 500 THEN m END, CAST(c_custkey AS VARCHAR)) AS component FROM customer c LEFT JOIN neg ON c.c_nationkey = neg.c_nationkey),
    n AS (SELECT o_custkey, COUNT(*) AS n FROM orders GROUP BY 1)
    SELECT component, COUNT(*) AS nodes, CAST(SUM(COALESCE(n, 0)) AS BIGINT) AS rows, SUM(COALESCE(n, 0)) > 100 AS oversized FROM l LEFT JOIN n ON c_custkey = o_custkey GROUP BY component""")
def component_sizes(spark, sf):
    charges = orders(spark, sf).groupBy(F.col("o_custkey").cast("string").alias("node")).agg(F.count("*").alias("rows"))
    return graph.component_sizes(graph_components(spark, sf), charges, 100)


@query("""SELECT s_suppkey, s_nationkey, MIN(CAST(s_suppkey AS VARCHAR)) OVER (PARTITION BY s_nationkey) AS component FROM supplier""")
def linkage_index(spark, sf):
    s = table(spark, sf, "supplier").withColumn("revision", F.col("s_nationkey"))
    index = graph.linkage_index(s, "s_suppkey", "revision", {"nation": F.col("s_nationkey")})
    return index.select(F.col("entity_id").cast("bigint").alias("s_suppkey"), F.col("revision_id").alias("s_nationkey"), "component")


@query("""
    WITH l AS (SELECT s_suppkey, CASE WHEN s_suppkey % 10 = 0 THEN s_nationkey + 1 ELSE s_nationkey END AS nation FROM supplier)
    SELECT CAST(s_suppkey AS VARCHAR) AS node, MIN(CAST(s_suppkey AS VARCHAR)) OVER (PARTITION BY nation) AS component FROM l""")
def incremental_components(spark, sf):
    s = table(spark, sf, "supplier")
    old = graph.links(s, F.col("s_suppkey").cast("string"), {"nation": F.col("s_nationkey")})
    changed = s.filter("s_suppkey % 10 = 0")
    new = graph.links(changed, F.col("s_suppkey").cast("string"), {"nation": F.col("s_nationkey") + 1})
    return graph.refresh_components(graph.components(old), old, changed.select(F.col("s_suppkey").cast("string").alias("node")), new)
