"""Queries of typing, record contracts, and the bridges and dimensions of the business relations."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from revlake.functions import coercion
from revlake.operators import quality
from revlake.plans import business
from revlake.plans.catalog import query, table
from revlake.plans.rows_queries import MONEY, orders


def text(c: str):
    return F.col(c).cast("string")


def key():
    return F.col("o_orderkey")


TYPES = T.StructType([T.StructField("id", T.LongType()), T.StructField("amount", T.DecimalType(38, 6)), T.StructField("on", T.DateType()), T.StructField("open", T.BooleanType()), T.StructField("note", T.StringType()), T.StructField("absent", T.LongType())])


def untyped(spark, sf):
    amount = F.when(key() % 5 == 0, "12,5").otherwise(F.concat(F.lit(" "), F.col("o_totalprice").cast("decimal(18,2)").cast("string")))
    day = F.when(key() % 7 == 0, "2024-02-30").when(key() % 11 == 0, " ").otherwise(F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("T01:02:03")))
    return orders(spark, sf).select(text("o_orderkey").alias("id"), amount.alias("amount"), day.alias("on"), F.when(key() % 3 == 0, "YES").when(key() % 3 == 1, " f ").otherwise("maybe").alias("open"), F.col("o_orderstatus").alias("note"), F.lit("x").alias("extra"))


@query("""
    SELECT o_orderkey AS id, CASE WHEN o_orderkey % 5 <> 0 THEN CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DECIMAL(38,6)) END AS amount, CASE WHEN o_orderkey % 7 <> 0 AND o_orderkey % 11 <> 0 THEN CAST(o_orderdate AS DATE) END AS "on",
        CASE o_orderkey % 3 WHEN 0 THEN TRUE WHEN 1 THEN FALSE END AS open, o_orderstatus AS note, CAST(NULL AS BIGINT) AS absent FROM orders""")
def type_coercion(spark, sf):
    """PRJ-18."""
    return coercion.coerce(untyped(spark, sf), TYPES, ["id"])[0]


@query("""
    SELECT CAST(o_orderkey AS VARCHAR) AS id, 'amount' AS "column", '12,5' AS raw_value, 'not_decimal' AS issue FROM orders WHERE o_orderkey % 5 = 0
    UNION ALL SELECT CAST(o_orderkey AS VARCHAR), 'on', '2024-02-30', 'not_date' FROM orders WHERE o_orderkey % 7 = 0
    UNION ALL SELECT CAST(o_orderkey AS VARCHAR), 'open', 'maybe', 'not_boolean' FROM orders WHERE o_orderkey % 3 = 2""")
def type_issues(spark, sf):
    """PRJ-18: what could not be typed."""
    return coercion.coerce(untyped(spark, sf), TYPES, ["id"])[1]


@query("""SELECT o_orderkey, sha256('{"a":{"c":[1,"x"],"z":' || o_custkey || '},"b":"' || o_orderpriority || '"}') AS content_hash FROM orders""")
def content_hash(spark, sf):
    """PRJ-16: keys out of order at two levels, with blanks."""
    payload = F.concat(F.lit('{ "b": "'), "o_orderpriority", F.lit('", "a": {"z": '), text("o_custkey"), F.lit(', "c": [1, "x"]} }'))
    return orders(spark, sf).select("o_orderkey", coercion.content_hash(payload).alias("content_hash"))


@query("""
    WITH x AS (SELECT o_orderkey AS k, o_custkey AS c FROM orders), i AS (
        SELECT k, 'empty_payload' AS code, 'fail' AS severity, '' AS path FROM x WHERE k % 17 = 0
        UNION ALL SELECT k, 'missing_business_root', 'fail', '' FROM x WHERE k % 17 <> 0 AND k % 13 = 0
        UNION ALL SELECT k, 'missing_detail_identity', 'fail', 'bid.main.id' FROM x WHERE k % 17 <> 0 AND k % 13 <> 0 AND k % 5 = 0
        UNION ALL SELECT k, 'conflicting_identity_aliases', 'fail', 'bid.main.notifyNo' FROM x WHERE k % 17 <> 0 AND k % 13 <> 0 AND k % 7 = 0
        UNION ALL SELECT k, 'conflicting_business_roots', 'fail', 'notifyNo' FROM x WHERE k % 17 <> 0 AND k % 13 <> 0 AND k % 7 = 0
        UNION ALL SELECT k, 'identity_mismatch', 'fail', 'bid.main.notifyNo' FROM x WHERE k % 17 <> 0 AND k % 13 <> 0 AND c % 10 = 0
        UNION ALL SELECT k, 'missing_identity_context', 'unresolved', 'id' FROM x WHERE k % 17 <> 0 AND k % 13 <> 0 AND k % 11 = 0
        UNION ALL SELECT k, 'missing_detail_version', 'fail', 'bid.main.notifyVersion' FROM x WHERE k % 17 <> 0 AND k % 13 <> 0 AND k % 19 = 0
        UNION ALL SELECT k, 'error_envelope', 'fail', '' FROM x WHERE k % 17 <> 0 AND k % 13 <> 0 AND k % 23 = 0
        UNION ALL SELECT k, 'high_empty_ratio', 'warn', 'bid.main' FROM x WHERE k % 17 <> 0 AND k % 13 <> 0 AND (k % 5 = 0 AND k % 7 <> 0 OR k % 19 = 0 AND k % 7 <> 0 OR k % 5 = 0 AND k % 19 = 0)),
    s AS (SELECT k, CASE WHEN bool_or(severity = 'fail') THEN 'fail' WHEN bool_or(severity = 'unresolved') THEN 'unresolved' ELSE 'warn' END AS status FROM i GROUP BY 1)
    SELECT x.k AS o_orderkey, COALESCE(s.status, 'pass') AS status, i.code, i.severity, i.path FROM x LEFT JOIN s USING (k) LEFT JOIN i USING (k)""")
def detail_contract(spark, sf):
    """DQ-2: of ten fields at least seven are empty, and one more for each of the id, the other number and the version that is not there."""
    number = F.concat(F.lit("N"), text("o_custkey"))
    other = F.when(key() % 7 == 0, "other").otherwise("")
    blank = {f"f{j}": (F.lit(""), F.array(), F.lit(None).cast("string"))[j % 3] for j in range(6)}
    main = F.struct(F.when(key() % 5 != 0, text("o_orderkey")).alias("id"), number.alias("notifyNo"), other.alias("no"), F.when(key() % 19 != 0, "00").alias("notifyVersion"), *(c.alias(n) for n, c in blank.items()))
    full = F.to_json(F.struct(F.when(key() % 13 != 0, F.struct(main.alias("main"))).alias("bid"), (key() % 23 != 0).alias("success")), {"ignoreNullFields": "false"})
    rows = orders(spark, sf).select("o_orderkey", F.when(key() % 17 != 0, full).alias("payload"), F.when(key() % 11 != 0, text("o_orderkey")).alias("id"), F.when(F.col("o_custkey") % 10 == 0, "none").otherwise(number).alias("notifyNo"), F.lit("00").alias("notifyVersion"))
    out = quality.detail_contract(rows, ["bid.main", "other"], {"id": ["id"], "notifyNo": ["notifyNo", "no"], "notifyVersion": ["notifyVersion"]})
    return out.select("o_orderkey", "status", F.explode_outer("issues").alias("i")).select("o_orderkey", "status", "i.*")


@query("""
    WITH c AS (SELECT l_orderkey || ':' || l_linenumber AS e, CAST(l_extendedprice AS DECIMAL(38,6)) AS p, CASE WHEN l_linenumber % 2 = 1 THEN l_orderkey END AS s, CASE WHEN l_linenumber % 3 = 0 THEN l_orderkey END AS n FROM lineitem)
    SELECT CAST(o_orderkey AS VARCHAR) AS revision_id, CAST(SUM(p) AS DECIMAL(38,6)) AS contract_price FROM orders JOIN c ON o_orderkey = s OR o_orderkey = n WHERE p > 0 GROUP BY 1""")
def contract_prices(spark, sf):
    """BIZ-27: contracts that are found by bid, by result and by notice at once count once."""
    key = text("l_orderkey")
    contracts = table(spark, sf, "lineitem").select(F.concat_ws(":", key, text("l_linenumber")).alias("entity_id"), F.col("l_extendedprice").cast(MONEY).alias("price_after_tax"), F.when(F.col("l_linenumber") % 2 == 1, key).alias("result_source_id"), F.when(F.col("l_linenumber") % 3 == 0, key).alias("notice_no"))
    results = orders(spark, sf).select(*(text("o_orderkey").alias(c) for c in ("revision_id", "bid_id", "result_id", "notify_no")))
    return business.contract_prices(results, contracts).withColumn("contract_price", F.col("contract_price").cast(MONEY))


@query("""SELECT l_suppkey, l_partkey, l_returnflag FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY l_suppkey ORDER BY '{"l_suppkey":' || l_suppkey || ',"l_partkey":' || l_partkey || ',"l_returnflag":"' || l_returnflag || '"}') AS rn FROM lineitem) WHERE rn = 1""")
def one_per_key(spark, sf):
    """DIM-7."""
    return business.one_per_key(table(spark, sf, "lineitem").select("l_suppkey", "l_partkey", "l_returnflag"), "l_suppkey")


@query("""
    WITH n AS (SELECT 'GEO_' || n_nationkey AS g, CAST(n_nationkey AS VARCHAR) AS c, n_name, 'R' || n_regionkey AS r, n_nationkey AS k FROM nation),
    seen AS (SELECT 'GEO_' || c_nationkey + 5 AS g, CAST(c_nationkey + 5 AS VARCHAR) AS c, CASE WHEN MIN(c_mktsegment) = MAX(c_mktsegment) THEN MIN(c_mktsegment) END AS s FROM customer WHERE c_nationkey + 5 >= 15 GROUP BY c_nationkey),
    b AS (SELECT g, c, n_name AS name, r FROM n WHERE k < 15 UNION ALL SELECT g, c, 'old', NULL FROM n WHERE k >= 15)
    SELECT COALESCE(b.g, seen.g) AS geography_key, COALESCE(b.c, seen.c) AS province_code, CASE WHEN seen.g IS NOT NULL THEN seen.s ELSE b.name END AS province_name, b.r AS region_name FROM b FULL JOIN seen ON b.g = seen.g""")
def geography_dimension(spark, sf):
    """DIM-6: 15 canonical places, older rows beside and under them, and codes that only customers have."""
    n = table(spark, sf, "nation").select("n_nationkey", F.concat(F.lit("GEO_"), text("n_nationkey")).alias("geography_key"), text("n_nationkey").alias("province_code"), F.col("n_name").alias("province_name"), F.concat(F.lit("R"), text("n_regionkey")).alias("region_name"))
    known = n.withColumns({"province_name": F.lit("old"), "region_name": F.lit(None).cast("string")})
    places = table(spark, sf, "customer").select(F.concat(F.lit(" "), (F.col("c_nationkey") + 5).cast("string")).alias("province_code"), F.col("c_mktsegment").alias("province_name"))
    canonical = n.filter("n_nationkey < 15")
    return business.dim_geography(known, canonical, places, canonical.select(F.col("province_code").alias("raw_code")))


def items(spark, sf):
    """An award for each line of an order; every fourth order's is for the whole package."""
    li = table(spark, sf, "lineitem")
    lot = F.when(F.col("l_orderkey") % 4 != 0, text("l_linenumber"))
    return li.select(F.concat_ws(":", F.lit("AWARD"), text("l_orderkey"), F.coalesce(lot, F.lit("PKG"))).alias("award_business_key"), text("l_orderkey").alias("revision_id"), lot.alias("award_lot_id"), F.concat(F.lit("PKG:"), text("l_partkey")).alias("package_key"), F.concat(F.lit("PKG:"), text("l_partkey"), F.when(lot.isNotNull(), F.concat(F.lit(":LOT:"), lot)).otherwise(":PACKAGE"), F.lit(":ROUND:"), text("l_suppkey")).alias("scope_key"))


def bidders(spark, sf):
    code = text("l_suppkey")
    return table(spark, sf, "lineitem").select(text("l_orderkey").alias("revision_id"), text("l_linenumber").alias("award_lot_id"), F.lit(0).alias("lot_ordinal"), (F.col("l_quantity") > 10).alias("is_winner"), F.when(F.col("l_suppkey") % 3 != 0, code).alias("contractor_code"), code.alias("tax_code"), F.when(F.col("l_partkey") % 5 == 0, F.concat(F.lit("V"), (F.col("l_partkey") % 50).cast("string"))).alias("venture_code"))


_WON = """i AS (SELECT DISTINCT 'AWARD:' || l_orderkey || ':' || CASE WHEN l_orderkey % 4 <> 0 THEN CAST(l_linenumber AS VARCHAR) ELSE 'PKG' END AS a, l_orderkey AS o, CASE WHEN l_orderkey % 4 <> 0 THEN l_linenumber END AS lot FROM lineitem),
    won AS (SELECT a, l_suppkey AS code, l_suppkey % 3 <> 0 AS own, CASE WHEN l_partkey % 5 = 0 THEN 'V' || l_partkey % 50 END AS v FROM i JOIN lineitem ON l_orderkey = o AND (lot IS NULL OR lot = l_linenumber) WHERE l_quantity > 10)"""


def won(spark, sf):
    own = items(spark, sf).select("award_business_key", "revision_id", "award_lot_id", F.lit("s").alias("scope_key")).distinct()
    return business.winners(own, bidders(spark, sf))


@query(f"WITH {_WON} SELECT a AS award_business_key, COUNT(*) AS n, COUNT(DISTINCT code) AS codes FROM won GROUP BY 1")
def award_winners(spark, sf):
    """BIZ-17."""
    return won(spark, sf).groupBy("award_business_key").agg(F.count("*").alias("n"), F.countDistinct("tax_code").alias("codes"))


@query(f"WITH {_WON} SELECT 'CON:' || v AS consortium_key, 'PARTY:' || code AS party_key, CAST(code AS VARCHAR) AS tax_code FROM won WHERE v IS NOT NULL GROUP BY ALL")
def consortium_members(spark, sf):
    """BIZ-21."""
    return business.consortium_members(won(spark, sf))


@query(f"""
    WITH {_WON}, s AS (SELECT a, COUNT(DISTINCT code) AS w, bool_or(v IS NOT NULL) AS h FROM won GROUP BY 1)
    SELECT DISTINCT a AS award_business_key, CASE WHEN v IS NOT NULL THEN 'CON:' || v ELSE 'PARTY:' || code END AS party_key, CASE WHEN w = 1 AND NOT h THEN CAST(100 AS DECIMAL(10,4)) END AS allocated_percent FROM won JOIN s USING (a)""")
def award_recipients(spark, sf):
    """BIZ-22."""
    w = won(spark, sf).withColumns({"is_consortium": F.lit(False), "award_contractor_id": F.lit("x")})
    return business.recipient_bridge(w, business.recipient_summary(w))


@query("""SELECT 'PKG:' || l_partkey AS package_key, CAST(l_suppkey AS VARCHAR) AS scope_round, COUNT(*) AS lot_count FROM lineitem WHERE l_orderkey % 4 <> 0 GROUP BY ALL""")
def lot_counts(spark, sf):
    """BIZ-26."""
    return business.lot_counts(items(spark, sf))


def packages(spark, sf):
    return table(spark, sf, "part").filter("p_partkey % 3 != 0").select(text("p_partkey").alias("entity_id"), F.concat(F.lit("B"), text("p_partkey")).alias("package_no"), F.col("p_name").alias("title"))


@query("""
    SELECT 'PKG:' || p_partkey AS package_key, 'B' || p_partkey AS package_no, p_name AS title, FALSE AS is_placeholder FROM part WHERE p_partkey % 3 <> 0
    UNION ALL SELECT DISTINCT 'PKG:' || l_partkey, NULL, NULL, TRUE FROM lineitem WHERE NOT EXISTS (SELECT 1 FROM part WHERE p_partkey = l_partkey AND p_partkey % 3 <> 0)""")
def package_dimension(spark, sf):
    """BIZ-11."""
    return business.dim_package(packages(spark, sf), items(spark, sf))


@query("""
    SELECT 'PKG:' || p_partkey AS scope_key, 'PKG:' || p_partkey AS package_key, 'PACKAGE' AS scope_type FROM part WHERE p_partkey % 3 <> 0
    UNION ALL SELECT DISTINCT 'PKG:' || l_partkey || CASE WHEN l_orderkey % 4 <> 0 THEN ':LOT:' || l_linenumber ELSE ':PACKAGE' END || ':ROUND:' || l_suppkey, 'PKG:' || l_partkey, CASE WHEN l_orderkey % 4 <> 0 THEN 'LOT' ELSE 'PACKAGE' END FROM lineitem""")
def scope_dimension(spark, sf):
    """BIZ-12."""
    return business.dim_scope(packages(spark, sf), items(spark, sf))


@query("""SELECT DISTINCT 'S' || o_custkey AS location_set_key, CAST(l_suppkey % 63 AS VARCHAR) AS province_code FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_linenumber <> 2""")
def location_bridge(spark, sf):
    """BIZ-14."""
    places = table(spark, sf, "lineitem").select(text("l_orderkey").alias("revision_id"), F.when(F.col("l_linenumber") != 2, (F.col("l_suppkey") % 63).cast("string")).alias("province_code"))
    return business.location_bridge(places, orders(spark, sf).select(text("o_orderkey").alias("revision_id"), F.concat(F.lit("S"), text("o_custkey")).alias("location_set_key")))


@query("""SELECT 'EVD:AWARD:' || l_orderkey AS evidence_set_key, 'award' AS evidence_kind, CAST(l_orderkey AS VARCHAR) AS revision_id FROM lineitem GROUP BY l_orderkey UNION ALL SELECT 'EVD:NOTICE:' || o_orderkey, 'notice', CAST(o_orderkey AS VARCHAR) FROM orders""")
def evidence_bridge(spark, sf):
    """BIZ-24, BIZ-29."""
    a = table(spark, sf, "lineitem").select(F.concat(F.lit("EVD:AWARD:"), text("l_orderkey")).alias("evidence_set_key"))
    n = orders(spark, sf).select(F.concat(F.lit("EVD:NOTICE:"), text("o_orderkey")).alias("evidence_set_key"))
    return business.evidence_bridge({"award": a, "notice": n})


@query("""
    SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber % 2 = 0 THEN CAST(l_extendedprice AS DECIMAL(38,6)) WHEN l_linenumber = 1 AND l_tax > 0 THEN CAST(l_quantity AS DECIMAL(38,6)) END AS baseline_amount,
        CASE WHEN l_linenumber % 2 = 0 THEN 'source_declared_lot_price' WHEN l_linenumber = 1 AND l_tax > 0 THEN 'planned_package_bid_price' ELSE 'unavailable_baseline' END AS baseline_basis,
        CASE WHEN l_linenumber % 2 = 0 THEN CAST(l_shipdate AS DATE) WHEN l_linenumber = 1 AND l_tax > 0 THEN CAST(l_shipdate AS DATE) END AS baseline_date, CASE WHEN l_linenumber % 2 = 0 THEN 'USD' WHEN l_linenumber = 1 AND l_tax > 0 THEN 'VND' ELSE 'CUR_UNKNOWN' END AS baseline_currency_key FROM lineitem""")
def scope_baselines(spark, sf):
    """BIZ-25: lots of even numbers have a price; first lines stand for whole packages, matched where there is tax."""
    n = F.col("l_linenumber")
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.when(n % 2 == 0, F.col("l_extendedprice").cast(MONEY)).alias("lot_price"), F.to_date("l_shipdate").alias("award_published_date"), F.lit(" usd").alias("lot_currency"), F.when(n != 1, text("l_linenumber")).alias("award_lot_id"), F.when(F.col("l_tax") > 0, "resolved_deterministic").otherwise("unresolved").alias("relationship_state"), F.col("l_quantity").cast(MONEY).alias("_planned"), F.to_date("l_shipdate").alias("_planned_on"), F.lit("VND").alias("_planned_cur"))
    return business.scope_baselines(li).select("l_orderkey", "l_linenumber", "baseline_amount", "baseline_basis", "baseline_date", "baseline_currency_key")
