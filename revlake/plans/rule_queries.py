"""Queries of provinces, assembled openings, version chains and exact positions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from revlake.operators import assembly, ledger, positions, provinces
from revlake.plans import linkage
from revlake.plans.catalog import query, table
from revlake.plans.chain_queries import bronze
from revlake.plans.opening_queries import FREE, chosen, columns

_CODES = ["' 01 '", "'1'", "'hni'", "'101'", "'TP HCM'", "'Sài Gòn'", "'Thành phố Hồ  Chí Minh'", "'tỉnh bà rịa vũng tàu'", "'Đắk-Lắk'", "'T. Đồng Nai'", "'824'", "'999'", "'atlantis'", "'  '", "NULL", "'5'", "'HGG2'", "'DA NANG'"]
_MEANT = ["HNI", "HNI", "HNI", "HNI", "HCM", "HCM", "HCM", "VTU", "DLC", "DNI", None, None, None, None, None, None, "HGG2", "DNG"]


@query(f"""
    WITH c AS (SELECT c_custkey, c_custkey % {len(_CODES)} AS m FROM customer)
    SELECT c_custkey, CASE m {' '.join(f"WHEN {i} THEN '{x}'" for i, x in enumerate(_MEANT) if x)} END AS short_code, CASE m {' '.join(f"WHEN {i} THEN 'GEO_{x}'" for i, x in enumerate(_MEANT) if x)} WHEN 10 THEN 'GEO_MULTI_UNALLOCATED' WHEN 11 THEN 'GEO_UNKNOWN' END AS geography_key,
           CASE WHEN m IN (10, 11) THEN 'special' WHEN m IN (12, 15) THEN 'unknown' WHEN m IN (13, 14) THEN 'blank' ELSE 'resolved' END AS province_state FROM c""")
def province_normaliser(spark, sf):
    """PRJ-19: codes with and without zeros, short and source codes, aliases, names with and without accents, codes of no province, and what is none."""
    place = F.expr(f"CASE c_custkey % {len(_CODES)} " + " ".join(f"WHEN {i} THEN {c}" for i, c in enumerate(_CODES)) + " END")
    return provinces.normalise(table(spark, sf, "customer").select("c_custkey", place.alias("place")), "place").select("c_custkey", "short_code", "geography_key", "province_state")


_LOT = '[{"notifyId":"<k>"}]'
_FULL = '{"notify":{"bidNoContractorResponse":{"bidNotification":{"notifyNo":"N<k>","notifyVersion":"00","bidMode":"<mode>"}}},"roundmng":{"bidoBidroundMngViewDTO":{"countContractor":<n><tc>}}'
_ONE, _TECHNICAL, _FINANCIAL = (',"bid_open%s":%s,"lot_open_detail%s":%s' % (x, FREE, x, _LOT) for x in ("", "_technical", "_financial"))  # noqa: UP031


@query("""
    WITH o AS (SELECT o_orderkey AS k, o_orderkey % 12 AS m, CASE WHEN o_orderkey % 5 <> 0 THEN 'contractor_count_mismatch' ELSE '' END AS n FROM orders),
    c AS (SELECT k, CASE WHEN m IN (6, 7, 8) THEN NULL WHEN m IN (1, 4) THEN 'awaiting_financial' WHEN m = 11 THEN 'cancelled_after_technical' ELSE 'complete' END AS collection_status,
        [CASE m WHEN 3 THEN 'lot_identity_mismatch' WHEN 4 THEN 'unexpected_opening_components' WHEN 5 THEN 'invalid_component_list' WHEN 6 THEN 'unresolved_opening_phase' WHEN 7 THEN 'unresolved_opening_phase' WHEN 8 THEN 'unresolved_opening_phase' WHEN 9 THEN 'invalid_component' WHEN 10 THEN 'missing_assembly_version' ELSE '' END,
         CASE WHEN m IN (5, 6, 7, 8) THEN '' ELSE n END] AS codes FROM o)
    SELECT k, collection_status, array_to_string(list_sort(list_filter(codes, lambda x: x <> '')), ',') AS codes FROM c""")
def opening_assembly(spark, sf):
    """DQ-13: complete, awaiting, lots of another notice, a part before its time, no list, modes that differ, no publication context, a bad one, an error, no version, and a cancellation that was proven."""
    k = F.col("o_orderkey")
    m = k % 12
    templates = [_FULL + _ONE, _FULL + _TECHNICAL, _FULL + _TECHNICAL + _FINANCIAL, _FULL + _ONE.replace("<k>", "x"), _FULL + _TECHNICAL + _FINANCIAL, _FULL + _ONE.replace("[]", "null"), _FULL + _ONE, _FULL + _TECHNICAL, _FULL + _TECHNICAL, _FULL + _ONE.replace('{"bidSub', '{"error":"e","bidSub'), (_FULL + _ONE).replace('"00"', '" "'), _FULL + _TECHNICAL + _FINANCIAL.replace("[]", "null") + ',"cancellation_notice":{}']
    # Each is closed; templates use the braces of JSON only.
    payload = chosen(m, [t + "}" for t in templates], **columns(mode=F.when(m.isin(0, 3, 5, 6, 9, 10), "1_MTHS").otherwise("1_HTHS"), tc=F.when(m.isin(1, 4), ',"successBidOpenDateTc":null').when(m.isin(2, 11), ',"successBidOpenDateTc":"2024-01-05T00:00:00"').when(m == 8, ',"successBidOpenDateTc":"soon"').otherwise("")))
    rows = bronze(spark, sf, payload).withColumns({"v": F.try_parse_json("payload"), "context_id": F.col("source_id"), "k": F.col("source_id").cast("long")})
    rows = rows.withColumns({"context_mode": F.when(F.col("k") % 12 == 6, "1_HTHS"), "exception": F.when(F.col("k") % 12 == 11, "cancelled_after_technical")})
    found = assembly.check(rows, [assembly.NOTICE, assembly.ROUND])
    return found.select("k", "collection_status", F.array_join(F.array_sort("issues.code"), ",").alias("codes"))


@query("""
    WITH v AS (SELECT o_orderkey, ROW_NUMBER() OVER (ORDER BY o_orderkey) AS i, LAG(o_orderkey) OVER (ORDER BY o_orderkey) AS p, COUNT(*) OVER () AS n FROM orders)
    SELECT i - 10 AS position, 'v' || p AS "from", 'v' || o_orderkey AS "to" FROM v WHERE i > 10 AND i <= n - 5""")
def change_chain(spark, sf):
    """INC-9: an edge from each order to the next; the chain from the tenth to the sixth last."""
    o = table(spark, sf, "orders").select("o_orderkey")
    at = positions.numbered(o, ["o_orderkey"], name="i")
    edges = at.alias("a").join(at.alias("b"), F.expr("a.i + 1 = b.i")).select(F.expr("'v' || a.o_orderkey").alias("from"), F.expr("'v' || b.o_orderkey").alias("to"))
    n = at.count()
    ends = {r["i"]: f"v{r['o_orderkey']}" for r in at.filter(F.col("i").isin(10, n - 5)).collect()}
    return ledger.change_chain(edges, ends[10], ends[n - 5])


def roots(spark, sf):
    """Six root tables from orders and one from customers: a package for each order, notices, results, openings, contracts and reports for some; a plan for each customer."""
    o = table(spark, sf, "orders")
    k = F.col("o_orderkey").cast("string")
    of = lambda letter, c=k: F.concat(F.lit(letter), c)
    day = lambda n: F.date_add(F.to_date("o_orderdate"), n)
    made = lambda where, letter, days, **columns: o.filter(where).select(of(letter).alias("entity_id"), of(f"r{letter}").alias("revision_id"), day(days).alias("public_date"), *(c.alias(n) for n, c in columns.items()))
    customer = F.col("o_custkey").cast("string")
    plans = table(spark, sf, "customer").select(of("L", F.col("c_custkey").cast("string")).alias("entity_id"), of("rL", F.col("c_custkey").cast("string")).alias("revision_id"), F.lit("1990-01-01").cast("date").alias("public_date"), of("N", F.col("c_custkey").cast("string")).alias("plan_no"))
    return {
        "package_revision": made("true", "P", -90, source_id=F.lit(" "), package_no=F.concat(F.lit(" B"), k), plan_id=F.when(F.col("o_orderkey") % 2 == 0, of("L", customer)), plan_no=of("N", customer)), "plan_revision": plans,
        "notice_revision": made("o_orderkey % 2 = 0", "T", -60, package_no=of("B"), notify_no=of("T")), "result_revision": made("o_orderkey % 3 = 0", "R", 0, bid_id=of("P"), package_no=F.lit("")), "opening_revision": made("o_orderkey % 5 = 0", "O", -30, package_no=of("B")),
        "contract_revision": made("o_orderkey % 4 = 0", "C", 30, notice_no=of("T"), contract_code=of("K")), "contract_performance_revision": made("o_orderkey % 8 = 0", "F", 60, contract_code=of("K")),
    }


_NODES = """
    n AS (SELECT o_orderkey AS k, o_custkey AS c, unnest(list_filter(['package_revision:P' || o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN 'notice_revision:T' || o_orderkey END, CASE WHEN o_orderkey % 3 = 0 THEN 'result_revision:R' || o_orderkey END, CASE WHEN o_orderkey % 5 = 0 THEN 'opening_revision:O' || o_orderkey END,
        CASE WHEN o_orderkey % 4 = 0 THEN 'contract_revision:C' || o_orderkey END, CASE WHEN o_orderkey % 8 = 0 THEN 'contract_performance_revision:F' || o_orderkey END], lambda x: x IS NOT NULL)) AS node FROM orders),
    p AS (SELECT c_custkey AS c, 'plan_revision:L' || c_custkey AS node FROM customer)"""


@query(f"""WITH {_NODES} SELECT node, MIN(node) OVER (PARTITION BY k) AS component_id FROM n UNION ALL SELECT node, node FROM p""")
def linkage_families(spark, sf):
    """GRF-1, GRF-5: a component for each order over seven tables; plans don't link."""
    return linkage.index(roots(spark, sf)).select(F.concat_ws(":", "entity_type", "entity_id").alias("node"), "component_id")


@query(f"""WITH {_NODES}, u AS (SELECT c, node FROM n UNION ALL SELECT * FROM p) SELECT node, MIN(node) OVER (PARTITION BY c) AS component_id FROM u""")
def linkage_plans(spark, sf):
    """GRF-5: with plan links, by id or number, a component for each customer."""
    return linkage.index(roots(spark, sf), plan_links=True).select(F.concat_ws(":", "entity_type", "entity_id").alias("node"), "component_id")


@query("""
    WITH o AS (SELECT o_orderkey AS k, CAST(o_orderdate AS DATE) AS d FROM orders WHERE o_orderkey % 3 = 0 AND CAST(o_orderdate AS DATE) >= DATE '1996-01-01')
    SELECT 'package_revision' AS entity_type, 'rP' || k AS revision_id FROM o WHERE d - 90 < DATE '1996-01-01' UNION ALL SELECT 'notice_revision', 'rT' || k FROM o WHERE k % 2 = 0 AND d - 60 < DATE '1996-01-01' UNION ALL SELECT 'opening_revision', 'rO' || k FROM o WHERE k % 5 = 0 AND d - 30 < DATE '1996-01-01'""")
def component_closure(spark, sf):
    """JN-11: what results since 1996 need from before, over the components of three tables; plans aren't in them."""
    tables = roots(spark, sf)
    found = linkage.upstream(linkage.index(tables), tables["result_revision"].filter("public_date >= '1996-01-01'"), tables, "1996-01-01")
    parts = [df.select(F.lit(name).alias("entity_type"), "revision_id") for name, df in found.items()]
    return reduce(lambda a, b: a.unionByName(b), parts)


@query(f"""
    WITH {_NODES}, t AS (SELECT node, unnest(list_filter(CASE split_part(node, '_', 1) WHEN 'package' THEN ['package:P' || k, 'package_code: B' || k, CASE WHEN k % 2 = 0 THEN 'plan:L' || c END, 'plan_code:N' || c] WHEN 'notice' THEN ['package_code:B' || k, 'notice:T' || k] WHEN 'result' THEN ['package:P' || k, 'result:R' || k]
        WHEN 'opening' THEN ['package_code:B' || k] ELSE CASE WHEN node LIKE 'contract_revision%' THEN ['notice:T' || k, 'contract:K' || k] ELSE ['contract:K' || k] END END, lambda x: x IS NOT NULL)) AS token FROM n
        UNION ALL SELECT node, unnest(['plan:L' || c, 'plan_code:N' || c]) FROM p)
    SELECT node, replace(token, ': B', ':B') AS token FROM t""")
def typed_links(spark, sf):
    """GRF-1: the typed families of each root table."""
    return linkage.impact_links(roots(spark, sf))
