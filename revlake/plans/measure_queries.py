"""Queries of measures, dictionaries, promoted views, single days and profiles of several windows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from revlake.operators import ledger, profiling
from revlake.operators.graph import scratch
from revlake.plans import business, facts, reporting
from revlake.plans.business_queries import stored
from revlake.plans.catalog import query, table
from revlake.plans.fact_queries import _BIDS, _DEMAND, _ROUNDS, END, START, daily_fact_competition, daily_fact_duration, daily_fact_notice, demand, demand_fact
from revlake.plans.rows_queries import orders
from revlake.sources import sinks, versions

_NOTICES = f"x AS (SELECT CAST(o_orderdate AS DATE) AS d, o_orderpriority AS notice_family, o_orderkey % 13 = 0 AS cancelled FROM orders WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '{START}' AND DATE '{END}')"


@query(f"""WITH {_NOTICES} SELECT notice_family, COUNT(*) AS notice_count, COUNT(*) FILTER (cancelled) AS cancelled_notice_count FROM x GROUP BY 1""")
def measure_counts(spark, sf):
    """MEA-1: additive counts of a fact."""
    return daily_fact_notice(spark, sf).groupBy("notice_family").agg(*(c.alias(k) for k, c in reporting.sums("notice_count", "cancelled_notice_count").items()))


@query(f"""WITH {_NOTICES} SELECT notice_family, CAST(COUNT(*) FILTER (cancelled) AS DOUBLE) / COUNT(*) AS cancellation_rate FROM x GROUP BY 1""")
def measure_cancellation(spark, sf):
    """MEA-5."""
    return reporting.measure({"fact_notice_daily": daily_fact_notice(spark, sf)}, "cancellation_rate", ["notice_family"])


@query(f"""
    WITH {_ROUNDS}, u AS (SELECT nd AS d, 'plan_to_notice_days' AS m, CASE WHEN nd >= pd THEN nd - pd END AS v FROM r UNION ALL SELECT cd, 'notice_to_close_hours', CASE WHEN cd >= nd THEN (cd - nd) * 24 END FROM r UNION ALL SELECT ac, 'planned_to_actual_delay_days', ac - pc FROM r),
    f AS (SELECT * FROM u WHERE d BETWEEN DATE '{START}' AND DATE '{END}' OR d IS NULL)
    SELECT m AS view, CAST(SUM(v) AS DOUBLE) / NULLIF(COUNT(v), 0) AS average_duration FROM f GROUP BY 1 UNION ALL SELECT 'all', NULL""")
def measure_duration(spark, sf):
    """MEA-6: an average of each metric; blank where several are in view."""
    fact = daily_fact_duration(spark, sf).filter(F.col("metric_key").isin("plan_to_notice_days", "notice_to_close_hours", "planned_to_actual_delay_days"))
    each = reporting.duration_measure(fact, ["metric_key"]).withColumnRenamed("metric_key", "view")
    return each.unionByName(reporting.duration_measure(fact.withColumn("view", F.lit("all")), ["view"]))


@query(f"""
    WITH {_BIDS}, f AS (SELECT CAST(o_orderdate AS DATE) AS d, SUM(COALESCE(bidders, 0)) AS b, SUM(COALESCE(tp, 0)) + SUM(COALESCE(tf, 0)) AS t FROM orders LEFT JOIN c ON l_orderkey = o_orderkey WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '{START}' AND DATE '{END}' GROUP BY 1)
    SELECT CAST(date_trunc('year', d) AS DATE) AS report_year, COUNT(*) FILTER (t > b) AS tech_over_bidders, CAST(0 AS BIGINT) AS money_identity_off FROM f GROUP BY 1""")
def measure_anomalies(spark, sf):
    """MEA-10: groups with more technical results than bidders; groups whose amounts don't add up, of which there are none as prices are repaired before."""
    fact = stored(daily_fact_competition(spark, sf), "competition").withColumn("report_year", F.trunc("report_date", "year"))
    star = {"fact_bidding_competition_daily": fact}
    return reporting.measure(star, "tech_over_bidders", ["report_year"]).join(reporting.measure(star, "money_identity_off", ["report_year"]), "report_year")


@query("""SELECT * FROM (VALUES ('same rows in another order', TRUE), ('one row less', FALSE), ('one row twice', FALSE)) AS t("case", unchanged) WHERE (SELECT COUNT(*) FROM orders) > 1""")
def unchanged_sources(spark, sf):
    """INC-7: a run has nothing to do if each source has the same rows as before, as often."""
    o = orders(spark, sf).select("o_orderkey", "o_orderstatus")
    first = o.filter(F.col("o_orderkey") == o.agg(F.min("o_orderkey")).first()[0])
    cases = {"same rows in another order": o.repartition(3, "o_orderstatus"), "one row less": o.join(first, "o_orderkey", "left_anti"), "one row twice": o.unionByName(first)}
    return spark.createDataFrame([(k, ledger.unchanged([(o, o), (o, df)])) for k, df in cases.items()], "case string, unchanged boolean")


@query(f"""WITH {_DEMAND} SELECT f.* FROM f WHERE report_date <> (SELECT MIN(report_date) FROM f) UNION ALL SELECT * REPLACE (package_count * 2 AS package_count, eligible_amount_count * 2 AS eligible_amount_count, CAST(planned_amount_sum * 2 AS DECIMAL(38,6)) AS planned_amount_sum) FROM f WHERE report_date = (SELECT MIN(report_date) FROM f)""")
def rebuilt_day(spark, sf):
    """INC-11: a fact's first day is built again from twice the contributions and put in its place; other days stay."""
    path = f"{scratch(spark, 'day')}/fact"
    contributions = facts.demand_contributions(demand(spark, sf), START, END)
    fact = demand_fact(spark, sf)
    sinks.overwrite_window(spark, fact, path, "report_date", "1900-01-01", "2100-01-01")
    day = fact.agg(F.min("report_date")).first()[0]
    again = facts.build_day("fact_demand_daily", contributions.unionByName(contributions), str(day))
    sinks.overwrite_window(spark, again, path, "report_date", str(day), str(day + dt.timedelta(days=1)))
    columns = [c for c in fact.columns if c != "report_date"]
    return versions.read(spark, path, fact.select(*columns, "report_date").schema).drop("group_key")


@query("""WITH s AS (SELECT DISTINCT CASE WHEN o_orderkey % 2 = 0 THEN 'observed' ELSE 'not_observed' END AS n, CASE WHEN o_orderkey % 3 = 0 THEN 'observed' ELSE 'not_observed' END AS a FROM orders) SELECT n AS notice_observation_state, a AS award_observation_state, 'STATUS_' || sha256('["' || n || '","' || a || '"]') AS status_key FROM s""")
def status_states(spark, sf):
    """DIM-2: the pairs of states that occur."""
    seen = lambda n: F.when(F.col("o_orderkey") % n == 0, "observed").otherwise("not_observed")
    return facts.status_dictionary(orders(spark, sf).select(seen(2).alias("notice_observation_state"), seen(3).alias("award_observation_state")))


@query("""WITH s AS (SELECT 'BUILDING' AS currency_key, 'seed' AS currency_name UNION ALL SELECT 'XXX', 'seed') SELECT * FROM s UNION ALL SELECT DISTINCT c_mktsegment, NULL FROM customer WHERE c_mktsegment NOT IN (SELECT currency_key FROM s)""")
def seeded_dimension(spark, sf):
    """BIZ-6, DIM-4: the seed, or the keys of the version before, and keys that are observed beside it."""
    seed = spark.createDataFrame([("BUILDING", "seed"), ("XXX", "seed")], "currency_key string, currency_name string")
    return business.dim_seeded(table(spark, sf, "customer").select(F.col("c_mktsegment").alias("currency_key")), "currency_key", seed)


@query("""SELECT DISTINCT 'SEC_' || o_orderstatus AS sector_key, o_orderstatus AS sector_code, CASE o_orderstatus WHEN 'F' THEN 'filled' WHEN 'O' THEN 'open' ELSE 'unknown' END AS sector_name, CASE WHEN o_orderstatus IN ('F', 'O') THEN 'known' ELSE 'other' END AS sector_group FROM orders""")
def sector_dimension(spark, sf):
    """BIZ-8."""
    return business.dim_sector(orders(spark, sf).select(F.concat(F.lit("SEC_"), "o_orderstatus").alias("sector_key")), {"F": ("filled", "known"), "O": ("open", "known")})


@query("""SELECT o_orderstatus, COUNT(*) AS n FROM orders GROUP BY 1""")
def promoted_view(spark, sf):
    """SNK-15: a reporting view over the active version; the version before had half the rows."""
    root, o = f"{scratch(spark, 'promoted')}/orders", orders(spark, sf).select("o_orderkey", "o_orderstatus")
    commit = versions.Commit()
    for df in (o.filter("o_orderkey % 2 = 0"), o):
        commit = versions.commit(spark, root, versions.write(df, root), commit)
        sinks.promote({"reported_orders": versions.read(spark, root, o.schema)})
    return spark.sql("SELECT o_orderstatus, COUNT(*) AS n FROM reported_orders GROUP BY o_orderstatus")


@query("""
    WITH w AS (SELECT CAST(floor((dayofmonth(ts) - 1) / 8) AS INT) AS w, event_type, event_id, value FROM events), p AS (SELECT w, COUNT(*) FILTER (CASE WHEN w = 1 THEN event_id % 2 = 1 ELSE FALSE END) * 1.0 / COUNT(*) AS r FROM w GROUP BY 1)
    SELECT 'kept' AS path, 'null_shift' AS drift, b.w AS "window" FROM p a JOIN p b ON b.w = a.w + 1 WHERE abs(a.r - b.r) >= 0.1 UNION ALL SELECT 'late', 'new_field', 2""")
def profile_windows(spark, sf):
    """PRF-11: drifts along four windows of a month: in the second a field loses half its values, from the third on there is a new one."""
    e = table(spark, sf, "events").withColumn("w", F.floor((F.dayofmonth("ts") - 1) / 8).cast("int"))
    ratio = lambda c: (F.count_if(c.isNull()) / F.count("*")).alias("null_ratio")

    def profile(w):
        rows = e.filter(F.col("w") == w)
        kept = F.when((F.lit(w) != 1) | (F.col("event_id") % 2 == 0), F.col("event_type"))
        one = rows.agg(F.lit("kept").alias("path"), F.lit("text").alias("type"), ratio(kept), F.lit(0.1).alias("cardinality_ratio"))
        return one.unionByName(rows.agg(F.lit("late").alias("path"), F.lit("number").alias("type"), ratio(F.col("value")), F.lit(0.1).alias("cardinality_ratio"))) if w >= 2 else one

    return profiling.window_drifts([profile(w) for w in range(4)]).select("path", "drift", "window")
