"""Queries over business relations, daily facts, policies, ledgers, rollups and measures, on orders read as packages and lineitems as awards."""

from __future__ import annotations

from pyspark.sql import functions as F

from revlake.operators import ledger, policies, selection
from revlake.plans import business, facts, reporting
from revlake.plans.catalog import query, table
from revlake.plans.rows_queries import MONEY, orders

START, END = "1995-01-01", "1998-12-31"


# Packages: an order is a package, its customer's nation the place, its segment the sector. The planned amount is a hundred thousand times the price.
_PACKAGES = f"""
    p AS (SELECT o_orderkey, 'PKG:' || CAST(o_orderkey AS VARCHAR) AS package_key, CAST(o_orderdate AS DATE) AS day, 'GEO_' || CAST(c_nationkey AS VARCHAR) AS geography_key, 'SEC_' || c_mktsegment AS sector_key,
                 CASE WHEN o_orderkey % 10 = 0 THEN 'CUR_UNKNOWN' ELSE 'VND' END AS currency_key, CAST(CAST(o_totalprice AS DECIMAL(38,6)) * 10000 AS DECIMAL(38,6)) AS amount, o_orderstatus FROM orders JOIN customer ON o_custkey = c_custkey),
    b AS (SELECT *, CASE WHEN currency_key <> 'VND' THEN 'BAND_UNKNOWN' WHEN amount < 100000000 THEN 'UNDER_100M' WHEN amount < 500000000 THEN '100M_TO_500M' WHEN amount < 5000000000 THEN '500M_TO_5B' WHEN amount < 20000000000 THEN '5B_TO_20B' WHEN amount < 100000000000 THEN '20B_TO_100B' ELSE 'OVER_100B' END AS value_band_key FROM p),
    w AS (SELECT * FROM b WHERE day BETWEEN DATE '{START}' AND DATE '{END}')"""


def demand(spark, sf):
    rows = orders(spark, sf).join(table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey", "c_mktsegment"), "o_custkey")
    known = F.col("o_orderkey") % 10 != 0
    amount = (F.col("o_totalprice") * 10_000).cast(MONEY)
    return rows.select(
        F.concat(F.lit("PKG:"), F.col("o_orderkey").cast("string")).alias("package_key"), F.col("o_orderdate").alias("package_published_date"), F.concat(F.lit("GEO_"), F.col("c_nationkey").cast("string")).alias("geography_key"), F.concat(F.lit("SEC_"), "c_mktsegment").alias("sector_key"),
        F.when(known, "VND").otherwise("CUR_UNKNOWN").alias("currency_key"), amount.alias("planned_package_amount"), known.alias("is_amount_eligible"), F.lit("M1").alias("method_key"), "o_orderkey", "o_orderstatus",
        F.when(F.col("o_orderstatus") != "O", "observed").otherwise("not_observed").alias("notice_observation_state"), F.when(F.col("o_orderstatus") == "F", "observed").otherwise("not_observed").alias("award_observation_state"),
    )


_DEMAND = f"""{_PACKAGES}, f AS (SELECT day AS report_date, geography_key, sector_key, value_band_key, currency_key, COUNT(*) AS package_count, COUNT(*) FILTER (currency_key = 'VND') AS eligible_amount_count,
    CAST(SUM(CASE WHEN currency_key = 'VND' THEN amount ELSE 0 END) AS DECIMAL(38,6)) AS planned_amount_sum FROM w GROUP BY ALL)"""
_KEY = "sha256(to_json(list_value(CAST(report_date AS VARCHAR), geography_key, sector_key, value_band_key, currency_key)))"


def demand_fact(spark, sf):
    return facts.build("fact_demand_daily", facts.demand_contributions(demand(spark, sf), START, END))


@query(f"WITH {_DEMAND} SELECT *, {_KEY} AS group_key FROM f")
def daily_fact_demand(spark, sf):
    return demand_fact(spark, sf)


@query(f"""WITH {_DEMAND} SELECT CAST(date_trunc('month', report_date) AS DATE) AS period_start, sector_key, currency_key, CAST(SUM(package_count) AS BIGINT) AS package_count, CAST(SUM(eligible_amount_count) AS BIGINT) AS eligible_amount_count, CAST(SUM(planned_amount_sum) AS DECIMAL(38,6)) AS planned_amount_sum FROM f GROUP BY ALL""")
def rollup_month(spark, sf):
    return reporting.rollup("fact_demand_daily", demand_fact(spark, sf), "month", ["sector_key", "currency_key"])


@query(f"""WITH {_DEMAND} SELECT CAST(date_trunc('quarter', report_date) AS DATE) AS period_start, geography_key, sector_key, value_band_key, currency_key, CAST(SUM(package_count) AS BIGINT) AS package_count, CAST(SUM(eligible_amount_count) AS BIGINT) AS eligible_amount_count, CAST(SUM(planned_amount_sum) AS DECIMAL(38,6)) AS planned_amount_sum FROM f GROUP BY ALL""")
def rollup_quarter(spark, sf):
    return reporting.rollup("fact_demand_daily", demand_fact(spark, sf), "quarter")


@query(f"""WITH {_PACKAGES} SELECT package_key, value_band_key AS band_key FROM b""")
def value_band(spark, sf):
    rows = demand(spark, sf).select("package_key", "currency_key", "planned_package_amount")
    return policies.apply_bands(rows, "planned_package_amount", policies.value_bands(spark)).select("package_key", "band_key")


@query("""
    SELECT n_regionkey, COUNT(*) AS overlaps FROM (SELECT n_regionkey, n_nationkey * 10 AS low, n_nationkey * 10 + 10 + 60 * (n_nationkey % 2) AS high, LAG(n_nationkey * 10 + 10 + 60 * (n_nationkey % 2)) OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) AS before FROM nation) WHERE before > low GROUP BY n_regionkey""")
def policy_overlaps(spark, sf):
    k = F.col("n_nationkey")
    p = table(spark, sf, "nation").select("n_regionkey", (k * 10).alias("low"), (k * 10 + 10 + 60 * (k % 2)).alias("high"))
    return policies.policy_violations(p, ["n_regionkey"], "low", "high").groupBy("n_regionkey").agg(F.count("*").alias("overlaps"))


@query(f"""
    WITH {_PACKAGES}, d AS (SELECT report_date, sector_key, status, COUNT(*) AS package_count FROM (SELECT day AS report_date, sector_key, 'STATUS_' || sha256(to_json(list_value(CASE WHEN o_orderstatus <> 'O' THEN 'observed' ELSE 'not_observed' END, CASE WHEN o_orderstatus = 'F' THEN 'observed' ELSE 'not_observed' END))) AS status FROM w) GROUP BY ALL)
    SELECT CAST(date_trunc('year', report_date) AS DATE) AS period_start, status AS status_key, sector_key, CAST(SUM(package_count) AS BIGINT) AS package_count, MAX(report_date) AS observed_date FROM d WHERE report_date IN (SELECT MAX(report_date) FROM d GROUP BY date_trunc('year', report_date)) GROUP BY ALL""")
def rollup_status(spark, sf):
    fact = facts.build("fact_status_daily", facts.status_contributions(demand(spark, sf), START, END))
    return reporting.rollup("fact_status_daily", fact, "year")


# Notices: an order with its ship dates; families by priority.
@query(f"""
    WITH x AS (SELECT CAST(o_orderdate AS DATE) AS report_date, 'GEO_' || CAST(o_custkey % 7 AS VARCHAR) AS geography_key, 'SEC_' || o_orderstatus AS sector_key, 'METHOD_UNKNOWN' AS method_key, o_orderpriority AS notice_family, o_orderkey % 13 = 0 AS cancelled FROM orders WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '{START}' AND DATE '{END}')
    SELECT report_date, geography_key, sector_key, method_key, notice_family, COUNT(*) AS notice_count, COUNT(*) FILTER (cancelled) AS cancelled_notice_count, sha256(to_json(list_value(CAST(report_date AS VARCHAR), geography_key, sector_key, method_key, notice_family))) AS group_key FROM x GROUP BY ALL""")
def daily_fact_notice(spark, sf):
    return facts.build("fact_notice_daily", facts.notice_contributions(notices(spark, sf), START, END))


def notices(spark, sf):
    k = F.col("o_orderkey")
    return orders(spark, sf).select(F.concat(F.lit("PKG:"), k.cast("string")).alias("package_key"), F.col("o_orderdate").alias("published_date"), F.concat(F.lit("GEO_"), (F.col("o_custkey") % 7).cast("string")).alias("geography_key"), F.concat(F.lit("SEC_"), "o_orderstatus").alias("sector_key"), F.lit("METHOD_UNKNOWN").alias("method_key"), F.col("o_orderpriority").alias("source_family"), F.when(k % 13 == 0, "cancelled").otherwise("none").alias("cancellation_state"))


# Awards: a line of an order is an award to its supplier; its part's price times quantity is the baseline.
_AWARDS = """
    s AS (SELECT *, CAST(CAST(l_extendedprice AS DECIMAL(38,6)) * CASE WHEN l_orderkey % 17 = 0 THEN 1000 WHEN l_orderkey % 19 = 0 THEN 3 ELSE 1 END AS DECIMAL(38,6)) AS raw, CAST(CAST(p_retailprice * l_quantity AS DECIMAL(18,2)) AS DECIMAL(38,6)) AS baseline,
                 CASE l_returnflag WHEN 'R' THEN 'CANCELLED' WHEN 'A' THEN 'is_publish' ELSE CASE WHEN l_linestatus = 'O' THEN NULL ELSE 'Published' END END AS status, CASE WHEN l_suppkey % 9 = 0 THEN 0 WHEN l_suppkey % 9 = 1 THEN 3 ELSE 1 END AS winner_count,
                 CASE WHEN l_partkey % 12 = 0 THEN 'CUR_UNKNOWN' WHEN l_partkey % 12 = 1 THEN 'USD' ELSE 'VND' END AS currency_key, COUNT(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS decisions FROM lineitem JOIN part ON l_partkey = p_partkey),
    t AS (SELECT *, CASE WHEN raw <= baseline * 2 THEN raw WHEN floor(raw / 1000000) BETWEEN baseline * 0.3 AND baseline * 1.2 THEN floor(raw / 1000000) WHEN floor(raw / 1000) BETWEEN baseline * 0.3 AND baseline * 1.2 THEN floor(raw / 1000) WHEN floor(raw / 100) BETWEEN baseline * 0.3 AND baseline * 1.2 THEN floor(raw / 100) WHEN floor(raw / 10) BETWEEN baseline * 0.3 AND baseline * 1.2 THEN floor(raw / 10) ELSE raw END AS a FROM s),
    a AS (SELECT *, CAST(a AS DECIMAL(38,6)) AS amount, CASE WHEN status = 'CANCELLED' THEN 'cancelled' WHEN decisions > 1 THEN 'unresolved_overlap' WHEN winner_count = 0 THEN 'no_confirmed_winner' WHEN status IS NOT NULL THEN 'effective' ELSE 'unresolved_status' END AS award_state,
                 COALESCE(upper(status) IN ('IS_PUBLISH', 'PUBLISHED') AND winner_count > 0 AND currency_key <> 'CUR_UNKNOWN' AND decisions = 1 AND a > 0 AND a <= baseline * 2, FALSE) AS eligible, CAST(l_shipdate AS DATE) AS day FROM t)"""


def awards(spark, sf):
    li = selection.overlap_count(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])
    p = table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_retailprice")
    k, s = F.col("l_orderkey"), F.col("l_suppkey") % 9
    raw = (F.col("l_extendedprice").cast(MONEY) * F.when(k % 17 == 0, 1000).when(k % 19 == 0, 3).otherwise(1)).cast(MONEY)
    rows = li.join(p, "l_partkey").withColumns({
        "raw": raw, "baseline": (F.col("p_retailprice") * F.col("l_quantity")).cast("decimal(18,2)").cast(MONEY), "status": F.when(F.col("l_returnflag") == "R", "CANCELLED").when(F.col("l_returnflag") == "A", "is_publish").when(F.col("l_linestatus") != "O", "Published"),
        "winner_count": F.when(s == 0, 0).when(s == 1, 3).otherwise(1), "currency_key": F.when(F.col("l_partkey") % 12 == 0, "CUR_UNKNOWN").when(F.col("l_partkey") % 12 == 1, "USD").otherwise("VND"),
    })
    rows = rows.withColumn("award_amount", business.recover_award_amount(F.col("raw"), F.col("baseline")))
    state = business.award_state(F.col("status"), F.col("decisions"), F.col("winner_count"))
    ok = business.award_eligible(F.col("status"), F.col("winner_count"), F.col("award_amount"), F.col("currency_key"), F.col("decisions"), F.col("baseline"))
    return rows.withColumns({
        "award_state": state, "is_amount_eligible": ok, "award_published_date": F.to_date("l_shipdate"), "package_key": F.concat(F.lit("PKG:"), k.cast("string")), "geography_key": F.concat(F.lit("GEO_"), (F.col("l_suppkey") % 5).cast("string")), "sector_key": F.lit("SEC_X"), "method_key": F.lit("M1"),
        "recipient_set_key": F.concat(F.lit("PARTY:"), F.col("l_suppkey").cast("string")), "recipient_allocation_state": F.when(F.col("winner_count") == 0, "no_winner").when(F.col("winner_count") == 1, "single_recipient").otherwise("independent_winners"),
    })


@query(f"""WITH {_AWARDS} SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, amount AS award_amount, award_state, eligible AS is_amount_eligible FROM a""")
def award_state(spark, sf):
    return awards(spark, sf).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "award_amount", "award_state", "is_amount_eligible")


_MEASURED = "COUNT(*) AS award_scope_count, COUNT(*) FILTER (award_state = 'effective') AS effective_award_scope_count, COUNT(*) FILTER (award_state = 'effective' AND eligible) AS eligible_amount_count, CAST(SUM(CASE WHEN award_state = 'effective' AND eligible THEN amount ELSE 0 END) AS DECIMAL(38,6)) AS award_amount_sum"
_AWARD_GRAIN = "day AS report_date, 'GEO_' || CAST(l_suppkey % 5 AS VARCHAR) AS geography_key, 'SEC_X' AS sector_key, 'M1' AS method_key, currency_key"


@query(f"""WITH {_AWARDS}, f AS (SELECT {_AWARD_GRAIN}, {_MEASURED} FROM a WHERE day BETWEEN DATE '{START}' AND DATE '{END}' GROUP BY ALL) SELECT *, sha256(to_json(list_value(CAST(report_date AS VARCHAR), geography_key, sector_key, method_key, currency_key))) AS group_key FROM f""")
def daily_fact_award(spark, sf):
    return facts.build("fact_award_daily", facts.award_contributions(awards(spark, sf), START, END))


_SUPPLIER = f"""{_AWARDS}, f AS (SELECT day AS report_date, 'GEO_' || CAST(l_suppkey % 5 AS VARCHAR) AS geography_key, 'SEC_X' AS sector_key, currency_key, 'PARTY:' || CAST(l_suppkey AS VARCHAR) AS party_key, CASE winner_count WHEN 0 THEN 'no_winner' WHEN 1 THEN 'single_recipient' ELSE 'independent_winners' END AS recipient_allocation_state, {_MEASURED} FROM a WHERE day BETWEEN DATE '{START}' AND DATE '{END}' GROUP BY ALL)"""


def supplier_fact(spark, sf):
    return facts.build("fact_supplier_daily", facts.supplier_contributions(awards(spark, sf), START, END))


@query(f"""WITH {_SUPPLIER} SELECT *, sha256(to_json(list_value(CAST(report_date AS VARCHAR), geography_key, sector_key, currency_key, party_key, recipient_allocation_state))) AS group_key FROM f""")
def daily_fact_supplier(spark, sf):
    return supplier_fact(spark, sf)


@query(f"""WITH {_SUPPLIER} SELECT geography_key, CAST(SUM(award_amount_sum) AS DECIMAL(38,6)) AS recipient_value, COUNT(DISTINCT party_key) AS recipients, CAST(SUM(eligible_amount_count) AS BIGINT) AS recipient_scopes FROM f WHERE currency_key = 'VND' AND recipient_allocation_state = 'single_recipient' AND eligible_amount_count > 0 GROUP BY ALL""")
def measure_recipients(spark, sf):
    return reporting.recipients(supplier_fact(spark, sf), ["geography_key"]).withColumn("recipient_value", F.col("recipient_value").cast(MONEY))


@query(f"""WITH {_SUPPLIER} SELECT recipient_allocation_state, CAST(SUM(award_scope_count) AS BIGINT) AS award_scope_count, CAST(SUM(award_amount_sum) AS DECIMAL(38,6)) AS award_amount_sum FROM f GROUP BY ALL""")
def measure_allocation(spark, sf):
    return reporting.allocation(supplier_fact(spark, sf)).withColumn("award_amount_sum", F.col("award_amount_sum").cast(MONEY))


@query(f"""WITH {_SUPPLIER}, pp AS (SELECT party_key, SUM(award_amount_sum) AS v FROM f GROUP BY 1), best AS (SELECT SUM(v) AS top FROM (SELECT v FROM pp ORDER BY v DESC, party_key LIMIT 10)), whole AS (SELECT SUM(v) AS total FROM pp)
    SELECT CAST(top AS DECIMAL(38,6)) AS top, CAST(total AS DECIMAL(38,6)) AS total, CAST(top AS DOUBLE) / CAST(total AS DOUBLE) AS top_share FROM best, whole""")
def topn_share(spark, sf):
    return reporting.top_share(supplier_fact(spark, sf), "party_key", "award_amount_sum").withColumns({c: F.col(c).cast(MONEY) for c in ("top", "total")})


@query(f"""
    WITH {_AWARDS}, r AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, award_state, currency_key, eligible, amount, day, baseline AS b0, CASE WHEN l_partkey % 23 = 0 THEN NULL ELSE baseline END AS base, CASE WHEN l_partkey % 29 = 0 THEN NULL WHEN l_partkey % 31 = 0 THEN day + 5 ELSE day - 30 END AS base_day, CASE WHEN l_partkey % 37 = 0 THEN 'CUR_UNKNOWN' ELSE 'VND' END AS base_currency FROM a)
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN day > DATE '{END}' OR day < DATE '{START}' THEN 'result_outside_period' WHEN base IS NULL THEN 'missing_baseline' WHEN base_day IS NULL THEN 'unknown_baseline_date' WHEN base_day > day THEN 'baseline_after_award' WHEN award_state = 'cancelled' THEN 'cancelled_award' WHEN award_state <> 'effective' THEN 'unresolved_award'
           WHEN currency_key = 'CUR_UNKNOWN' THEN 'unknown_currency' WHEN base_currency = 'CUR_UNKNOWN' THEN 'unknown_baseline_currency' WHEN base_currency <> currency_key THEN 'currency_mismatch' WHEN NOT eligible THEN 'invalid_award_amount' WHEN amount > base * 2 THEN 'extreme_overrun_anomaly' END AS reason FROM r""")
def savings_reason(spark, sf):
    p, day = F.col("l_partkey"), F.col("award_published_date")
    base = F.when(p % 23 != 0, F.col("baseline"))
    base_day = F.when(p % 29 == 0, None).when(p % 31 == 0, F.date_add(day, 5)).otherwise(F.date_sub(day, 30))
    reason = business.exclusion_reason(day, START, END, base, base_day, F.lit(False), F.col("award_state"), F.col("currency_key"), F.when(p % 37 == 0, "CUR_UNKNOWN").otherwise("VND"), F.col("is_amount_eligible"), F.col("award_amount"))
    return awards(spark, sf).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", reason.alias("reason"))


_SAVED = f"""{_AWARDS}, f AS (SELECT day AS report_date, 'GEO_' || CAST(l_suppkey % 5 AS VARCHAR) AS geography_key, 'SEC_X' AS sector_key, 'M1' AS method_key, CASE WHEN baseline < 100000000 THEN 'UNDER_100M' ELSE '100M_TO_500M' END AS value_band_key, currency_key, COUNT(*) AS scope_count,
    COUNT(*) FILTER (ok) AS descriptive_sample_count, CAST(0 AS BIGINT) AS verified_sample_count, COUNT(*) FILTER (con) AS contract_sample_count, CAST(SUM(CASE WHEN ok THEN baseline ELSE 0 END) AS DECIMAL(38,6)) AS descriptive_baseline_sum, CAST(SUM(CASE WHEN ok THEN amount ELSE 0 END) AS DECIMAL(38,6)) AS descriptive_award_sum,
    CAST(SUM(CASE WHEN ok THEN baseline - amount ELSE 0 END) AS DECIMAL(38,6)) AS descriptive_difference_sum, CAST(0 AS DECIMAL(38,6)) AS verified_baseline_sum, CAST(0 AS DECIMAL(38,6)) AS verified_award_sum, CAST(0 AS DECIMAL(38,6)) AS verified_saving_sum,
    CAST(SUM(CASE WHEN con THEN baseline ELSE 0 END) AS DECIMAL(38,6)) AS contract_amount_sum, CAST(0 AS DECIMAL(38,6)) AS contract_saving_sum
    FROM (SELECT *, award_state = 'effective' AND eligible AND currency_key = 'VND' AS ok, award_state = 'effective' AND l_linenumber = 1 AS con FROM a) WHERE day BETWEEN DATE '{START}' AND DATE '{END}' GROUP BY ALL)"""


def savings_fact(spark, sf):
    ok = (F.col("award_state") == "effective") & F.col("is_amount_eligible") & (F.col("currency_key") == "VND")
    con = (F.col("award_state") == "effective") & (F.col("l_linenumber") == 1)
    rows = awards(spark, sf).withColumns({"is_descriptive_eligible": ok, "is_contract_eligible": con, "baseline_amount": F.col("baseline"), "baseline_currency_key": F.lit("VND"), "descriptive_difference": F.col("baseline") - F.col("award_amount"), "contract_amount": F.col("baseline"), "contract_saving": F.lit(0).cast(MONEY)})
    return facts.build("fact_savings_daily", facts.savings_contributions(rows, START, END))


@query(f"""WITH {_SAVED} SELECT *, sha256(to_json(list_value(CAST(report_date AS VARCHAR), geography_key, sector_key, method_key, value_band_key, currency_key))) AS group_key FROM f""")
def daily_fact_savings(spark, sf):
    return savings_fact(spark, sf)


@query(f"""WITH {_SAVED} SELECT CAST(date_trunc('year', report_date) AS DATE) AS period_start, currency_key, 100 * CAST(SUM(descriptive_difference_sum) AS DOUBLE) / NULLIF(CAST(SUM(descriptive_baseline_sum) AS DOUBLE), 0) AS descriptive_difference_percent FROM f GROUP BY ALL""")
def rollup_savings(spark, sf):
    return reporting.rollup("fact_savings_daily", savings_fact(spark, sf), "year", ["currency_key"]).select("period_start", "currency_key", "descriptive_difference_percent")


# Rounds: an order is a round: noticed at its date, closed a month on, awarded from its first to its last ship date.
_ROUNDS = f"""
    g AS (SELECT l_orderkey, MIN(CAST(l_shipdate AS DATE)) AS fa, MAX(CAST(l_shipdate AS DATE)) AS ca FROM lineitem GROUP BY 1),
    r AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS nd, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) + 20 END AS cd, CAST(o_orderdate AS DATE) - 10 + CAST(15 * (o_orderkey % 2) AS INTEGER) AS pd, fa, ca, CASE WHEN o_orderkey % 5 <> 0 THEN CAST(o_orderdate AS DATE) + 25 END AS od, CAST(o_orderdate AS DATE) + 200 AS pc, CASE WHEN o_orderkey % 3 = 0 THEN CAST(o_orderdate AS DATE) + 190 + CAST(o_orderkey % 30 AS INTEGER) END AS ac FROM orders LEFT JOIN g ON l_orderkey = o_orderkey)"""


def rounds(spark, sf):
    o = orders(spark, sf)
    k, d = F.col("o_orderkey"), F.col("o_orderdate")
    rid = k.cast("string").alias("round_business_key")
    close = F.when(k % 7 != 0, F.date_add(d, 20))
    side = o.select(rid, F.concat(F.lit("PKG:"), k.cast("string")).alias("package_key"), F.lit("SEC_X").alias("sector_key"), F.lit("M1").alias("method_key"), F.date_add(d, (15 * (k % 2) - 10).cast("int")).alias("plan_date"), d.alias("planned_start_from"), d.alias("planned_start_to"), d.alias("notice_date"), d.cast("timestamp").alias("notice_at"), close.alias("close_date"), close.cast("timestamp").alias("close_at"), F.lit(False).alias("is_cancelled"), F.lit(None).cast("string").alias("cancel_reason"))
    day = F.to_date("l_shipdate")
    won = business.round_awards(table(spark, sf, "lineitem").select(F.col("l_orderkey").cast("string").alias("round_business_key"), day.alias("award_published_date"), F.lit(None).cast("date").alias("award_decision_date"), F.lit("effective").alias("award_state")))
    opened = o.filter(k % 5 != 0).select(rid, F.date_add(d, 25).cast("timestamp").alias("open_at"))
    done = o.select(rid, F.date_add(d, 200).alias("planned_completion_date"), F.when(k % 3 == 0, F.date_add(d, (190 + k % 30).cast("int"))).alias("actual_completion_date"))
    return business.selection_rounds(side, won, opened, done)


_DAYS = "CASE WHEN {b} >= {a} THEN {b} - {a} END"


@query(f"""
    WITH {_ROUNDS} SELECT CAST(o_orderkey AS VARCHAR) AS round_business_key, CAST(CASE WHEN nd >= pd THEN nd - pd END AS DECIMAL(38,6)) AS plan_to_notice_days, CAST(CASE WHEN cd >= nd THEN (cd - nd) * 24 END AS DECIMAL(38,6)) AS notice_to_close_hours, CAST(CASE WHEN fa >= cd THEN fa - cd END AS DECIMAL(38,6)) AS close_to_first_award_days,
           CAST(CASE WHEN ca >= cd THEN ca - cd END AS DECIMAL(38,6)) AS close_to_complete_award_days, CAST(CASE WHEN od >= cd THEN (od - cd) * 24 END AS DECIMAL(38,6)) AS close_to_open_hours, CAST(CASE WHEN ca >= od THEN ca - od END AS DECIMAL(38,6)) AS open_to_award_days, CAST(ac - pc AS DECIMAL(38,6)) AS planned_to_actual_delay_days FROM r""")
def round_durations(spark, sf):
    return rounds(spark, sf).select("round_business_key", *business.DURATIONS)


@query(f"""
    WITH {_ROUNDS}, u AS (SELECT nd AS report_date, 'plan_to_notice_days' AS metric_key, CASE WHEN nd >= pd THEN nd - pd END AS v FROM r UNION ALL SELECT cd, 'notice_to_close_hours', CASE WHEN cd >= nd THEN (cd - nd) * 24 END FROM r UNION ALL SELECT fa, 'close_to_first_award_days', CASE WHEN fa >= cd THEN fa - cd END FROM r UNION ALL SELECT ca, 'close_to_complete_award_days', CASE WHEN ca >= cd THEN ca - cd END FROM r
        UNION ALL SELECT od, 'close_to_open_hours', CASE WHEN od >= cd THEN (od - cd) * 24 END FROM r UNION ALL SELECT ca, 'open_to_award_days', CASE WHEN ca >= od THEN ca - od END FROM r UNION ALL SELECT ac, 'planned_to_actual_delay_days', ac - pc FROM r),
    f AS (SELECT report_date, 'SEC_X' AS sector_key, 'M1' AS method_key, metric_key, COUNT(*) AS interval_count, COUNT(*) FILTER (v IS NULL) AS excluded_sample_count, COUNT(v) AS sample_count, CAST(COALESCE(SUM(v), 0) AS DECIMAL(38,6)) AS duration_sum FROM u WHERE report_date BETWEEN DATE '{START}' AND DATE '{END}' OR report_date IS NULL GROUP BY ALL)
    SELECT *, sha256(to_json(list_value(CAST(report_date AS VARCHAR), sector_key, method_key, metric_key))) AS group_key FROM f""")
def daily_fact_duration(spark, sf):
    return facts.build("fact_duration_daily", facts.duration_contributions(rounds(spark, sf), START, END))


# Competition: an order is an opening, its lines the bids.
_BIDS = """
    s AS (SELECT l_orderkey, l_suppkey, l_linenumber, l_tax, CAST(l_extendedprice AS DECIMAL(38,6)) AS bid, CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(38,6)) AS final FROM lineitem),
    c AS (SELECT l_orderkey, COUNT(DISTINCT l_suppkey) AS bidders, COUNT(*) FILTER (l_linenumber % 2 = 1) AS tp, COUNT(*) FILTER (l_linenumber % 2 = 0) AS tf, COUNT(*) FILTER (l_tax > 0.05 OR bid > final) AS db, CAST(SUM(bid) AS DECIMAL(38,6)) AS tb, CAST(SUM(CASE WHEN bid > final THEN bid - final ELSE 0 END) AS DECIMAL(38,6)) AS td, CAST(SUM(final) AS DECIMAL(38,6)) AS tfb FROM s GROUP BY 1)"""


def competition_rows(spark, sf):
    bid = F.col("l_extendedprice").cast(MONEY)
    final = (F.col("l_extendedprice").cast("decimal(18,2)") * (1 - F.col("l_discount").cast("decimal(4,2)"))).cast(MONEY)
    subs = table(spark, sf, "lineitem").select(F.col("l_orderkey").cast("string").alias("revision_id"), F.col("l_suppkey").cast("string").alias("contractor_code"), F.lit(None).cast("string").alias("contractor_name"), F.col("l_linenumber").cast("string").alias("submission_id"), bid.alias("bid_price"), final.alias("final_bid_price"), (F.col("l_linenumber") % 2).cast("string").alias("tech_result"), F.when(F.col("l_tax") > 0.05, F.col("l_tax")).otherwise(0).alias("discount_rate"))
    context = orders(spark, sf).select(F.col("o_orderkey").cast("string").alias("revision_id"), F.lit(None).cast(MONEY).alias("baseline"), F.col("o_orderdate").alias("report_date"), F.lit(None).cast("string").alias("package_key"), F.lit("GEO_1").alias("geography_key"), F.lit("SEC_X").alias("sector_key"), F.lit("M1").alias("method_key"))
    return business.fact_competition(context, business.submission_summary(subs, context))


@query(f"""
    WITH {_BIDS} SELECT 'OPN:' || CAST(o_orderkey AS VARCHAR) AS opening_key, COALESCE(bidders, 0) AS total_bidders, CAST(COALESCE(bidders, 0) = 1 AS INTEGER) AS single_bidder_count, CAST(COALESCE(bidders, 0) >= 2 AS INTEGER) AS multi_bidder_count, COALESCE(tp, 0) AS tech_passed_count, COALESCE(tf, 0) AS tech_failed_count, COALESCE(db, 0) AS discounted_bidder_count,
           COALESCE(tb, 0) AS total_bid_amount, COALESCE(td, 0) AS total_discount_amount, COALESCE(tfb, 0) AS total_final_bid_amount FROM orders LEFT JOIN c ON l_orderkey = o_orderkey""")
def competition(spark, sf):
    cols = ["opening_key", *list(facts.FACTS["fact_bidding_competition_daily"].measures)[1:]]
    return competition_rows(spark, sf).select(cols)


@query(f"""
    WITH {_BIDS}, f AS (SELECT CAST(o_orderdate AS DATE) AS report_date, 'GEO_1' AS geography_key, 'SEC_X' AS sector_key, 'M1' AS method_key, 'BAND_UNKNOWN' AS value_band_key, COUNT(*) AS opening_count, CAST(SUM(COALESCE(bidders, 0)) AS BIGINT) AS total_bidders, COUNT(*) FILTER (bidders = 1) AS single_bidder_count, COUNT(*) FILTER (bidders >= 2) AS multi_bidder_count, CAST(SUM(COALESCE(tp, 0)) AS BIGINT) AS tech_passed_count, CAST(SUM(COALESCE(tf, 0)) AS BIGINT) AS tech_failed_count,
        CAST(SUM(COALESCE(db, 0)) AS BIGINT) AS discounted_bidder_count, CAST(SUM(COALESCE(tb, 0)) AS DECIMAL(38,6)) AS total_bid_amount, CAST(SUM(COALESCE(td, 0)) AS DECIMAL(38,6)) AS total_discount_amount, CAST(SUM(COALESCE(tfb, 0)) AS DECIMAL(38,6)) AS total_final_bid_amount FROM orders LEFT JOIN c ON l_orderkey = o_orderkey WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '{START}' AND DATE '{END}' GROUP BY ALL)
    SELECT *, sha256(to_json(list_value(CAST(report_date AS VARCHAR), geography_key, sector_key, method_key, value_band_key))) AS group_key FROM f""")
def daily_fact_competition(spark, sf):
    return facts.build("fact_bidding_competition_daily", facts.competition_contributions(competition_rows(spark, sf), START, END))


@query(f"""WITH {_BIDS} SELECT CAST(date_trunc('year', CAST(o_orderdate AS DATE)) AS DATE) AS report_year, CAST(SUM(COALESCE(bidders, 0)) AS DOUBLE) / COUNT(*) AS bidders_per_opening FROM orders LEFT JOIN c ON l_orderkey = o_orderkey WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '{START}' AND DATE '{END}' GROUP BY 1""")
def measure_competition(spark, sf):
    fact = daily_fact_competition(spark, sf).withColumn("report_year", F.trunc("report_date", "year"))
    return reporting.measure({"fact_bidding_competition_daily": fact}, "bidders_per_opening", ["report_year"])


@query(f"""WITH {_DEMAND} SELECT sector_key, CAST(SUM(planned_amount_sum) AS DOUBLE) / NULLIF(SUM(eligible_amount_count), 0) AS planned_average FROM f WHERE currency_key = 'VND' GROUP BY 1""")
def measure_planned_average(spark, sf):
    return reporting.measure({"fact_demand_daily": demand_fact(spark, sf)}, "planned_average", ["sector_key"])


@query("""SELECT l_suppkey, winners AS winner_count, CAST(SUM(CASE WHEN winners = 1 THEN 1 ELSE 0 END) OVER () AS BIGINT) AS sole FROM (SELECT l_suppkey, COUNT(DISTINCT l_partkey) AS winners FROM lineitem GROUP BY 1)""")
def recipient_summary(spark, sf):
    won = table(spark, sf, "lineitem").select(F.col("l_suppkey").cast("string").alias("award_business_key"), F.col("l_partkey").cast("string").alias("contractor_code"), F.lit(None).cast("string").alias("tax_code"), F.lit(False).alias("is_consortium"), F.lit(None).cast("string").alias("venture_code"), F.lit("x").alias("award_contractor_id"))
    s = business.recipient_summary(won).select(F.col("award_business_key").cast("bigint").alias("l_suppkey"), "winner_count")
    return s.crossJoin(s.agg(F.count_if(F.col("winner_count") == 1).alias("sole")))


@query("""
    WITH x AS (SELECT 'PARTY:' || CAST(c_custkey % 300 AS VARCHAR) AS party_key, 'customer' AS k, c_name AS n, NULL AS tax, 2 AS p FROM customer UNION ALL SELECT 'PARTY:' || CAST(s_suppkey AS VARCHAR), 'supplier', s_name, CASE WHEN s_suppkey % 2 = 0 THEN CAST(s_nationkey AS VARCHAR) END, 1 FROM supplier)
    SELECT party_key, (array_agg(k ORDER BY p, k))[1] AS party_kind, (array_agg(n ORDER BY p, n))[1] AS party_name, (array_agg(tax ORDER BY p, tax) FILTER (tax IS NOT NULL))[1] AS tax_code FROM x GROUP BY 1 UNION ALL SELECT 'PARTY_UNKNOWN', 'placeholder', NULL, NULL""")
def party_first(spark, sf):
    c = table(spark, sf, "customer").select(F.concat(F.lit("PARTY:"), (F.col("c_custkey") % 300).cast("string")).alias("party_key"), F.lit("customer").alias("party_kind"), F.lit(None).cast("string").alias("party_code"), F.col("c_name").alias("party_name"), F.lit(None).cast("string").alias("tax_code"), F.lit(2).alias("priority"))
    s = table(spark, sf, "supplier").select(F.concat(F.lit("PARTY:"), F.col("s_suppkey").cast("string")).alias("party_key"), F.lit("supplier").alias("party_kind"), F.lit(None).cast("string").alias("party_code"), F.col("s_name").alias("party_name"), F.when(F.col("s_suppkey") % 2 == 0, F.col("s_nationkey").cast("string")).alias("tax_code"), F.lit(1).alias("priority"))
    placeholders = spark.sql("SELECT 'PARTY_UNKNOWN' AS party_key, 'placeholder' AS party_kind")
    return business.dim_party([c, s], placeholders).select("party_key", "party_kind", "party_name", "tax_code")


@query("""
    SELECT d AS date_key, year(d) AS year, quarter(d) AS quarter, month(d) AS month, day(d) AS day, dayofweek(d) AS day_of_week, dayofweek(d) IN (0, 6) AS is_weekend, strftime(d, '%Y-%m') AS year_month, CAST(year(d) AS VARCHAR) || '-Q' || CAST(quarter(d) AS VARCHAR) AS year_quarter, isoyear(d) AS iso_year, week(d) AS iso_week, CAST(date_trunc('week', d) AS DATE) AS week_start_date
    FROM (SELECT CAST(unnest(range(DATE '1996-01-01', DATE '1998-01-01', INTERVAL 1 DAY)) AS DATE) AS d UNION SELECT CAST(o_orderdate AS DATE) FROM orders)""")
def date_dimension(spark, sf):
    out = business.dim_date(orders(spark, sf).select("o_orderdate"), "1996-01-01", "1997-12-31")
    return out.withColumns({c: F.col(c).cast("bigint") for c in ("year", "quarter", "month", "day", "day_of_week", "iso_year", "iso_week")})


@query("""SELECT DISTINCT 'MTH:' || md5(o_orderpriority || '|' || o_orderstatus || '|true||' || '|v1') AS method_key, o_orderpriority AS bid_form, o_orderstatus AS bid_mode FROM orders""")
def method_dimension(spark, sf):
    rows = orders(spark, sf).select(F.col("o_orderpriority").alias("bid_form"), F.col("o_orderstatus").alias("bid_mode"), F.lit(True).alias("is_domestic"), F.lit(None).cast("boolean").alias("is_internet"), F.lit(None).cast("string").alias("contract_type"))
    return business.dim_method(rows).select("method_key", "bid_form", "bid_mode")


@query("""SELECT o_custkey, CASE WHEN COUNT(DISTINCT o_orderpriority) > 1 THEN 'GEO_MULTI_UNALLOCATED' ELSE 'GEO_' || MIN(o_orderpriority) END AS geography_key, 'LOC_SET:' || md5(string_agg(DISTINCT o_orderpriority, ',' ORDER BY o_orderpriority)) AS location_set_key, COUNT(DISTINCT o_orderpriority) AS province_count FROM orders GROUP BY 1""")
def geography_sets(spark, sf):
    places = orders(spark, sf).select(F.col("o_custkey").alias("revision_id"), F.col("o_orderpriority").alias("province_code"))
    return business.geography(places).select(F.col("revision_id").alias("o_custkey"), "geography_key", "location_set_key", "province_count")


# Ledger: orders owned by customers; those with keys divisible by four are corrected, by eight deleted.
_LEDGER = "x AS (SELECT o_custkey, CAST(o_orderdate AS DATE) AS report_date, o_orderpriority AS p, CAST(o_totalprice AS DECIMAL(38,6)) * CASE WHEN o_custkey % 4 = 0 THEN 2 ELSE 1 END AS v FROM orders WHERE o_custkey % 8 <> 0)"


@query(f"""WITH {_LEDGER} SELECT report_date, p AS priority, COUNT(*) AS n, CAST(SUM(v) AS DECIMAL(38,6)) AS amount, sha256(to_json(list_value(CAST(report_date AS VARCHAR), p))) AS group_key FROM x GROUP BY ALL""")
def owner_retraction(spark, sf):
    grain, measures = ["report_date", "priority"], {"n": "bigint", "amount": MONEY}
    rows = orders(spark, sf).select(F.col("o_custkey").alias("owner_key"), F.col("o_orderdate").alias("report_date"), F.col("o_orderpriority").alias("priority"), F.lit(1).cast("bigint").alias("n"), F.col("o_totalprice").alias("amount"))
    affected = rows.filter("owner_key % 4 = 0").select("owner_key").distinct()
    new = rows.filter("owner_key % 4 = 0 and owner_key % 8 != 0").withColumn("amount", (F.col("amount") * 2).cast(MONEY))
    _, fact = ledger.retract(rows, ledger.aggregate(rows, grain, measures), new, affected, grain, measures)
    return fact


@query("""SELECT event_type, CAST(ts AS DATE) AS report_date, COUNT(*) AS n FROM events WHERE CAST(ts AS DATE) <> DATE '2024-01-10' GROUP BY ALL UNION ALL SELECT 'all', DATE '2024-01-10', COUNT(*) FROM events""")
def snapshot_day(spark, sf):
    e = table(spark, sf, "events")
    fact = e.groupBy("event_type", F.to_date("ts").alias("report_date")).agg(F.count("*").alias("n"))
    new = e.agg(F.lit("all").alias("event_type"), F.lit("2024-01-10").cast("date").alias("report_date"), F.count("*").alias("n"))
    return ledger.replace_day(fact, new, "2024-01-10")


@query("""SELECT DISTINCT 'PKG:' || CAST(o_orderkey AS VARCHAR) AS owner_key FROM orders UNION SELECT 'PKG_UNRESOLVED:' || CAST(o_orderkey AS VARCHAR) FROM orders""")
def affected_owners(spark, sf):
    nodes = orders(spark, sf).select(F.concat(F.lit("package:"), F.col("o_orderkey").cast("string")).alias("node"))
    return ledger.affected_owners(nodes, {"package": ["PKG", "PKG_UNRESOLVED"]})


@query("""SELECT DISTINCT o_custkey FROM orders WHERE o_orderkey % 50 = 0""")
def source_seeds(spark, sf):
    o = orders(spark, sf).select("o_orderkey", "o_custkey", "o_orderstatus")
    return ledger.source_seeds(o, o.withColumn("o_orderstatus", F.when(F.col("o_orderkey") % 50 == 0, "X").otherwise(F.col("o_orderstatus"))), "o_custkey")


@query("""SELECT o_custkey, o_orderpriority, COUNT(*) AS rows, 'duplicate_grain' AS violation FROM orders GROUP BY 1, 2 HAVING COUNT(*) > 1""")
def grain_check(spark, sf):
    return ledger.grain_violations(orders(spark, sf), ["o_custkey", "o_orderpriority"])


@query("""SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE NOT (l_discount <= 0.08) OR NOT (l_quantity * 900 <= l_extendedprice)""")
def identity_check(spark, sf):
    return ledger.identity_violations(table(spark, sf, "lineitem"), {"discount": "l_discount <= 0.08", "price": "l_quantity * 900 <= l_extendedprice"}).select("l_orderkey", "l_linenumber", "l_partkey")


@query(f"""
    WITH {_DEMAND} SELECT 'planned' AS "check", (SELECT CAST(SUM(planned_amount_sum) AS DECIMAL(38,6)) FROM f) AS fact_total, (SELECT CAST(SUM(amount) AS DECIMAL(38,6)) FROM b) AS source_total, CAST((SELECT SUM(planned_amount_sum) FROM f) - (SELECT SUM(amount) FROM b) AS DECIMAL(38,6)) AS difference""")
def reconciliation(spark, sf):
    return ledger.reconcile({"planned": (demand_fact(spark, sf), "planned_amount_sum", demand(spark, sf), "planned_package_amount")})


@query(f"""WITH {_DEMAND} SELECT 'fact_demand_daily' AS fact, MIN(report_date) AS first_day, MAX(report_date) AS last_day, COUNT(*) AS rows FROM f""")
def observed_range(spark, sf):
    return reporting.observed_range({"fact_demand_daily": demand_fact(spark, sf)})


@query("""SELECT r_name, c_mktsegment, CAST(SUM(CAST(o_totalprice AS DECIMAL(38,6))) AS DECIMAL(38,6)) AS total FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ALL""")
def star_join(spark, sf):
    c, n, r = (table(spark, sf, t) for t in ("customer", "nation", "region"))
    wide = reporting.star(orders(spark, sf), {"o_custkey": (c.drop("c_name", "c_acctbal"), "c_custkey"), "c_nationkey": (n, "n_nationkey"), "n_regionkey": (r, "r_regionkey")})
    return wide.groupBy("r_name", "c_mktsegment").agg(F.sum("o_totalprice").cast(MONEY).alias("total"))


@query("""
    SELECT measure, CAST(SUM(CAST(v AS DECIMAL(38,6))) AS DECIMAL(38,6)) AS exact, round(SUM(v), 2) AS approximate, abs(SUM(v) - CAST(SUM(CAST(v AS DECIMAL(38,6))) AS DOUBLE)) <= 0.000000001 * SUM(v) AS near
    FROM (SELECT 'l_extendedprice' AS measure, l_extendedprice AS v FROM lineitem UNION ALL SELECT 'l_quantity', l_quantity FROM lineitem UNION ALL SELECT 'third', l_quantity + 0.0000004 FROM lineitem) GROUP BY 1""")
def precision_check(spark, sf):
    """MEA-13: exact sums, sums of doubles, and whether the gap between them is none to speak of; one measure has digits that the exact type cuts off."""
    rows = table(spark, sf, "lineitem").withColumn("third", F.col("l_quantity") + 0.0000004)
    out = reporting.precision(rows, ["l_extendedprice", "l_quantity", "third"])
    return out.select("measure", F.col("exact").cast(MONEY).alias("exact"), F.round("approximate", 2).alias("approximate"), (F.col("gap") <= 1e-9 * F.col("approximate")).alias("near"))


@query("""
    SELECT COUNT(*) AS rows, COUNT(DISTINCT o_orderkey) AS distinct_keys, COUNT(*) FILTER (o_orderkey IS NULL) AS null_keys, CAST(MAX(CAST(o_orderdate AS DATE)) - MIN(CAST(o_orderdate AS DATE)) + 1 - COUNT(DISTINCT CAST(o_orderdate AS DATE)) AS BIGINT) AS missing_days,
           (SELECT COUNT(*) FROM (SELECT 1 FROM orders GROUP BY o_custkey, o_orderpriority HAVING COUNT(*) > 1)) AS repeated_grains FROM orders""")
def source_audit(spark, sf):
    return reporting.audit_source(orders(spark, sf), "o_orderkey", ["o_custkey", "o_orderpriority"], "o_orderdate")
