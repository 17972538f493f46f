"""Queries of projects' places, price anomalies of results and approved exceptions."""

from __future__ import annotations

from pyspark.sql import functions as F

from revlake.operators import sets
from revlake.plans import silver
from revlake.plans.catalog import query, table
from revlake.plans.chain_queries import bronze, key, obj, price
from revlake.plans.rows_queries import orders
from revlake.sources import sinks


@query("""
    WITH o AS (SELECT o_orderkey AS k, o_orderkey % 5 AS m, o_custkey % 63 AS c FROM orders)
    SELECT k, 0 AS ordinal, CAST(c AS VARCHAR) AS province_code, 'P' AS province_name, CASE WHEN m IN (0, 1) THEN 'W, P' ELSE NULL END AS location_name FROM o WHERE m IN (0, 1, 2)
    UNION ALL SELECT k, 2, NULL, NULL, 'W' FROM o WHERE m IN (0, 1) UNION ALL SELECT k, 0, NULL, NULL, 'somewhere' FROM o WHERE m = 3""")
def silver_project_places(spark, sf):
    """SLV-3: places in a list, in a list written as text, in the project's own fields, in words, and nowhere; items that are no objects or name nothing are left out."""
    k, m = F.col("o_orderkey"), F.col("o_orderkey") % 5
    code = F.concat(F.lit("|"), (F.col("o_custkey") % 63).cast("string"), F.lit("|"))
    items = F.concat(F.lit('[{"provCode":"'), code, F.lit('","provName":" P ","wardName":"W"},7,{"wardName":"W"},{"provName":"N/A"}]'))
    own = lambda c: F.when(m == 2, c)
    written = F.when(m == 1, items).when(m == 3, "somewhere").when(m == 4, "[]")
    payload = F.when(m == 0, F.concat(F.lit('{"projectDTO":{"id":"'), key(), F.lit('"},"plocation":'), items, F.lit("}"))).otherwise(obj(projectDTO=F.struct(key().alias("id"), own(code).alias("provCode"), own(F.lit("P")).alias("provName"), written.alias("plocation"))))
    out = silver.project_tables(bronze(spark, sf, payload))
    ids = out["project_revision"].select("revision_id", F.get_json_object("root_json", "$.id").cast("long").alias("k"))
    return out["project_location"].join(ids.hint("merge"), "revision_id").select("k", "ordinal", "province_code", "province_name", "location_name")


@query("""
    WITH o AS (SELECT o_orderkey AS k, o_orderkey % 4 AS m, CAST(o_totalprice AS DECIMAL(18,2)) AS p FROM orders)
    SELECT k, CAST(p AS DOUBLE) AS lot_price, CAST(CASE m WHEN 0 THEN p * 200 WHEN 3 THEN p END AS DOUBLE) AS winning_price, m IN (1, 2) AS is_unresolved, CASE m WHEN 0 THEN 'price_scale_anomaly lotResultDTO[0]' WHEN 3 THEN '' ELSE 'unverified_zero_winning_price lotResultDTO[0]' END AS issues FROM o""")
def silver_price_anomalies(spark, sf):
    """SLV-16, SLV-17: prices two hundred times the lot's, zero, a few dong, and plausible ones: lots and their issues."""
    m = F.col("o_orderkey") % 4
    won = F.when(m == 0, (F.col("o_totalprice").cast("decimal(18,2)") * 200).cast("string")).when(m == 1, "0").when(m == 2, "5").otherwise(price())
    lots = F.array(F.struct(F.lit("1").alias("lotNo"), price().alias("lotPrice"), F.array(F.struct(F.lit("c").alias("orgCode"), F.lit("1").alias("bidResult"), won.alias("bidWiningPrice"))).alias("contractorList")))
    out = silver.result_tables(bronze(spark, sf, obj(bideContractorInputResultDTO=F.struct(key().alias("id"), F.lit("VND").alias("bidPriceUnit"), lots.alias("lotResultDTO")))), ["quality_issue"])
    found = out["quality_issue"].groupBy("observation_id").agg(F.array_join(F.array_sort(F.collect_set(F.concat_ws(" ", "code", "path"))), ",").alias("issues"))
    heads = out["result_revision"].select("revision_id", "observation_id", F.get_json_object("root_json", "$.id").cast("long").alias("k")).join(found.hint("merge"), "observation_id", "left")
    return out["award_lot"].join(heads.hint("merge"), "revision_id").select("k", F.col("lot_price").cast("double").alias("lot_price"), F.col("winning_price").cast("double").alias("winning_price"), "is_unresolved", F.coalesce("issues", F.lit("")).alias("issues"))


@query("""SELECT o_orderkey AS k FROM orders WHERE NOT (o_orderkey % 3 = 0 AND o_orderkey % 2 = 0)""")
def unapproved_errors(spark, sf):
    """SLV-29: every order is an error; a third is approved, of which the half that has a root counts all the same."""
    o = orders(spark, sf)
    errors = o.select(F.col("o_orderkey").alias("k"), F.when(F.col("o_orderkey") % 2 == 0, "null").otherwise("{}").alias("root"))
    return silver.unapproved(errors, o.filter("o_orderkey % 3 = 0").select(F.col("o_orderkey").alias("k")), ["k"], F.col("root")).select("k")


def notice_families(spark, sf, families=("standard", "vk_adb", "reoffer"), only=None, fields=("notify_no",)):
    """Notices of three families by order key, or of some of them; a standard one with an even key has its lots in the mirror list as well, with another name. Prices, dates and flags are wrong in turn."""
    k = F.col("o_orderkey")
    lot = lambda no, cost: F.struct(F.lit(no).alias("lotNo"), cost.alias("lotPrice"), F.lit("12").alias("cperiod"), F.lit("VND").alias("lotPriceUnit"))
    lots = lambda tag: F.array(lot(f"{tag}1", price()), lot(f"{tag}2", F.when(k % 5 == 0, "x").otherwise("7.5")))
    place = lambda name: F.array(F.struct(F.concat(F.lit("|"), (k % 63).cast("string"), F.lit("|")).alias("provCode"), F.lit(name).alias("wardName")))
    head = [key().alias("id"), F.concat(F.lit("T"), key()).alias("notifyNo"), lots("r").alias("lotDTOList")]
    mirror = F.when(k % 2 == 0, F.struct(F.struct(lots("m").alias("lotDTOList")).alias("bidNotification")))
    standard = obj(bidoNotifyContractorM=F.struct(*head), bidNoContractorResponse=mirror, bidpBidLocationList=place(" a "), lsBidpBidLocationDTO=F.lit("none"))
    foreign = obj(bidoNotifyContractorP=F.struct(*head), lsBidpBidLocationDTO=place("b"), bidDetail=F.struct(place("c").alias("bidLocation")))
    offer = F.struct(F.lit("c1").alias("contractorCode"), F.when(k % 4 == 0, "1.2345678").otherwise(price()).alias("reofferPrice"), F.when(k % 5 == 0, "soon").otherwise(F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("T01:00:00Z"))).alias("reofferDate"), F.when(k % 7 == 0, "maybe").otherwise("true").alias("isNewest"))
    every = F.when(k % 2 == 0, F.array(offer, offer))
    reoffer = obj(id=key(), notifyNo=F.concat(F.lit("T"), key()), lotDTOList=lots("r"), contractorsResult=F.array(offer), contractorsResultAll=every)
    payloads = {"standard": (0, standard), "vk_adb": (1, foreign), "reoffer": (2, reoffer)}
    return silver.notice_tables({f: bronze(spark, sf, F.when(k % 3 == m, payload)).filter("payload is not null") for f, (m, payload) in payloads.items() if f in families}, only, fields)


@query("""
    WITH o AS (SELECT o_orderkey AS k, o_orderkey % 3 AS m, o_orderkey % 3 = 0 AND o_orderkey % 2 = 0 AS mirrored, CAST(o_totalprice AS DECIMAL(18,2)) AS p FROM orders)
    SELECT 'T' || k AS notify_no, ['standard', 'vk_adb', 'reoffer'][CAST(m AS INT) + 1] AS source_family, CASE WHEN mirrored THEN 'bidNoContractorResponse.bidNotification.lotDTOList' ELSE ['bidoNotifyContractorM.', 'bidoNotifyContractorP.', ''][CAST(m AS INT) + 1] || 'lotDTOList' END AS source_path,
           i AS ordinal, CASE WHEN mirrored THEN 'm' ELSE 'r' END || (i + 1) AS lot_no, CAST(CASE WHEN i = 0 THEN p WHEN k % 5 <> 0 THEN 7.5 END AS DOUBLE) AS lot_price, 'VND' AS currency, '12' AS contract_duration_raw FROM o, LATERAL (VALUES (0), (1)) v(i)""")
def silver_notice_lots(spark, sf):
    """SLV-9, SLV-11: lots of all three families, of the root or of the mirror list."""
    out = notice_families(spark, sf, only=["notice_revision", "notice_lot"])
    heads = out["notice_revision"].select("revision_id", "notify_no", "source_family")
    return out["notice_lot"].drop("notify_no").join(heads.hint("merge"), "revision_id").select("notify_no", "source_family", "source_path", "ordinal", "lot_no", F.col("lot_price").cast("double").alias("lot_price"), "currency", "contract_duration_raw")


@query("""
    SELECT 'T' || o_orderkey AS notify_no, source_path, 0 AS ordinal, CAST(o_orderkey % 63 AS VARCHAR) AS province_code, ward_name FROM orders JOIN
    (VALUES (0, 'bidpBidLocationList', 'a'), (1, 'lsBidpBidLocationDTO', 'b'), (1, 'bidDetail.bidLocation', 'c')) v(m, source_path, ward_name) ON o_orderkey % 3 = m""")
def silver_notice_places(spark, sf):
    """SLV-11: places of all three lists; what is no list has none."""
    out = notice_families(spark, sf, ("standard", "vk_adb"), ["notice_revision", "notice_location"])
    return out["notice_location"].join(out["notice_revision"].select("revision_id", "notify_no").hint("merge"), "revision_id").select("notify_no", "source_path", "ordinal", "province_code", "ward_name")


@query("""
    WITH o AS (SELECT o_orderkey AS k, CAST(o_totalprice AS DECIMAL(18,2)) AS p FROM orders WHERE o_orderkey % 3 = 2)
    SELECT 'T' || k AS notify_no, source_path, i AS ordinal, 'c1' AS contractor_code, CAST(CASE WHEN k % 4 <> 0 THEN p END AS DOUBLE) AS price, k % 5 <> 0 AS has_time, CASE WHEN k % 7 <> 0 THEN TRUE END AS is_newest
    FROM o JOIN (VALUES ('contractorsResult', 0), ('contractorsResultAll', 0), ('contractorsResultAll', 1)) v(source_path, i) ON source_path = 'contractorsResult' OR k % 2 = 0""")
def silver_reoffer_submissions(spark, sf):
    """SLV-11: submissions of both lists of a new offer."""
    out = notice_families(spark, sf, ("reoffer",), ["notice_revision", "notice_reoffer_submission"])
    rows = out["notice_reoffer_submission"].join(out["notice_revision"].select("revision_id", "notify_no").hint("merge"), "revision_id")
    return rows.select("notify_no", "source_path", "ordinal", "contractor_code", F.col("price").cast("double").alias("price"), F.col("offered_at").isNotNull().alias("has_time"), "is_newest")


@query("""
    WITH o AS (SELECT o_orderkey AS k FROM orders),
    s AS (SELECT k, source_path || '[' || i || '].' AS spot FROM o JOIN (VALUES ('contractorsResult', 0), ('contractorsResultAll', 0), ('contractorsResultAll', 1)) v(source_path, i) ON source_path = 'contractorsResult' OR k % 2 = 0 WHERE k % 3 = 2),
    x AS (SELECT k, spot || 'reofferPrice' AS path FROM s WHERE k % 4 = 0 UNION ALL SELECT k, spot || 'reofferDate' FROM s WHERE k % 5 = 0 UNION ALL SELECT k, spot || 'isNewest' FROM s WHERE k % 7 = 0
          UNION ALL SELECT k, 'lotDTOList[1].lotPrice' FROM o WHERE k % 3 = 2 AND k % 5 = 0)
    SELECT path, COUNT(*) AS n FROM x GROUP BY path""")
def silver_notice_list_issues(spark, sf):
    """SLV-11: each field of a new offer's lists that can't be read is an issue at its place in its list."""
    return notice_families(spark, sf, ("reoffer",), ["quality_issue"])["quality_issue"].groupBy("path").agg(F.count("*").alias("n"))


@query("""
    WITH o AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 2 = 0 THEN '1' WHEN o_orderkey % 3 = 0 THEN '7' END AS version FROM orders)
    SELECT k, version, target, scheme, value FROM o, LATERAL (VALUES ('notice', 'notify_no', 'T' || k), ('package', 'uuid', CASE WHEN k % 5 <> 0 THEN 'B' || k END), ('plan', 'number', CASE WHEN k % 7 <> 0 THEN 'P' || k END)) v(target, scheme, value) WHERE value IS NOT NULL""")
def silver_result_references(spark, sf):
    """SLV-18: the envelope's version, else the result's own, else none; the notices, packages and plans that results name."""
    k = F.col("o_orderkey")
    text = lambda p: F.concat(F.lit(p), key())
    root = F.struct(key().alias("id"), text(" T").alias("notifyNo"), F.when(k % 5 != 0, text("B")).otherwise(" ").alias("bidId"), F.when(k % 7 != 0, text("P")).alias("planNo"), F.when(k % 3 == 0, "7").alias("resultVersion"))
    rows = bronze(spark, sf, obj(bideContractorInputResultDTO=root)).withColumn("source_version", F.when(F.col("source_id").cast("long") % 2 == 0, "1"))
    out = silver.result_tables(rows, [])
    heads = out["result_revision"].select("revision_id", "version", F.get_json_object("root_json", "$.id").cast("long").alias("k"))
    return out["record_reference"].join(heads.hint("merge"), "revision_id").select("k", "version", "target", "scheme", "value")


@query("""
    WITH a AS (SELECT l_orderkey AS k, l_linenumber AS i, CAST(l_quantity AS INT) AS q FROM lineitem), b AS (SELECT k, i, q + CAST(k % 100 = 0 AS INT) AS q FROM a WHERE k % 50 <> 1 UNION ALL SELECT * FROM a WHERE k % 50 = 2),
    n AS (SELECT k, i, q, SUM(s) AS net, COUNT(*) FILTER (s = 1) AS l, COUNT(*) FILTER (s = -1) AS r FROM (SELECT *, 1 AS s FROM a UNION ALL SELECT *, -1 FROM b) GROUP BY ALL)
    SELECT md5(CAST(k AS VARCHAR))[1:1] AS bucket, CAST(SUM(l) AS BIGINT) AS left_rows, CAST(SUM(r) AS BIGINT) AS right_rows, CAST(SUM(abs(net)) AS BIGINT) AS differing FROM n GROUP BY 1""")
def bucket_differences(spark, sf):
    """SNK-14: line items against themselves with some changed, some gone and some twice."""
    a = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("i"), F.col("l_quantity").cast("int").alias("q"))
    b = a.filter("k % 50 <> 1").withColumn("q", F.col("q") + (F.col("k") % 100 == 0).cast("int"))
    return sets.bucket_differences(a, b.unionByName(a.filter("k % 50 = 2")), ["k"])


@query("""
    SELECT 'orders' AS part, o_custkey AS owner, COUNT(*) AS n, CAST(SUM(CASE WHEN o_orderkey % 10 = 0 THEN 1 ELSE 0 END) AS BIGINT) AS changed FROM orders GROUP BY ALL
    UNION ALL SELECT 'lines', l_orderkey, COUNT(*), CAST(SUM(CASE WHEN l_orderkey % 10 = 0 THEN 1 ELSE 0 END) AS BIGINT) FROM lineitem WHERE NOT (l_orderkey % 10 = 0 AND (l_linenumber > 2 OR l_orderkey % 20 = 0)) GROUP BY ALL""")
def delta_application(spark, sf):
    """SNK-16: every tenth order is merged by its key; its line items are replaced by the first two, or by none."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", F.lit(0).alias("changed"))
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.lit(0).alias("changed"))
    new = lines.filter("l_orderkey % 10 = 0 and l_orderkey % 20 <> 0 and l_linenumber <= 2").withColumn("changed", F.lit(1))
    concerned = o.filter("o_orderkey % 10 = 0").select(F.col("o_orderkey").alias("l_orderkey"))
    out = sinks.apply_delta({"orders": o, "lines": lines}, {"orders": o.filter("o_orderkey % 10 = 0").withColumn("changed", F.lit(1)), "lines": new}, {"orders": ["o_orderkey"]}, {"lines": ("l_orderkey", concerned)})
    by = lambda part, name, owner: part.groupBy(F.lit(name).alias("part"), F.col(owner).alias("owner")).agg(F.count("*").alias("n"), F.sum("changed").alias("changed"))
    return by(out["orders"], "orders", "o_custkey").unionByName(by(out["lines"], "lines", "l_orderkey"))
