"""Guarded rollups and measures over a star of facts and dimensions (RPT, MEA)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revlake.operators.selection import last_of_period, ratio, top
from revlake.plans.facts import FACTS

PERIODS = ("day", "week", "month", "quarter", "year")


def rollup(name: str, fact: DataFrame, period: str = "month", dimensions: list[str] | None = None) -> DataFrame:
    """RPT-1: a fact by period and dimensions. Currencies and duration metrics are never added together; of a snapshot fact each period's last day counts."""
    f = FACTS[name]
    grain = [c for c in f.grain if c != "report_date"]
    dims = grain if dimensions is None else list(dimensions)
    if period not in PERIODS:
        raise ValueError(f"unknown period {period}")
    if len(set(dims)) < len(dims) or not set(dims) <= set(grain):
        raise ValueError("dimensions must be distinct columns of the fact's grain")
    for kept, what in (("currency_key", "currencies"), ("metric_key", "metrics")):
        if kept in grain and kept not in dims:
            raise ValueError(f"{what} can't be added together: keep {kept}")
    rows = last_of_period(fact, period) if name == "fact_status_daily" else fact
    more: list[Column] = []
    if name == "fact_duration_daily":
        more = [ratio(F.sum("duration_sum"), F.sum("sample_count")).alias("average_duration")]
    if name == "fact_status_daily":
        more = [F.max("report_date").alias("observed_date")]
    if name == "fact_savings_daily":
        more = [(100 * ratio(F.sum(f"{k}_sum"), F.sum(f"{b}_sum"))).alias(f"{k}_percent") for k, b in (("descriptive_difference", "descriptive_baseline"), ("verified_saving", "verified_baseline"))]
    return rows.groupBy(F.date_trunc(period, "report_date").cast("date").alias("period_start"), *dims).agg(*(F.sum(m).cast(t).alias(m) for m, t in f.measures.items()), *more)


def sums(*columns: str) -> dict[str, Column]:
    """MEA-1."""
    return {c: F.sum(c) for c in columns}


def blank_sum(amount: str, samples: str, scale: int = 1) -> Column:
    """MEA-2: a sum that is blank, not zero, where no sample is eligible."""
    return F.when(F.sum(samples) > 0, F.sum(amount) / scale if scale > 1 else F.sum(amount))


#: MEA-1..5, MEA-10: each measure's fact and expression.
MEASURES: dict[str, tuple[str, Callable[[], Column]]] = {
    "planned_average": ("fact_demand_daily", lambda: ratio(F.sum("planned_amount_sum"), F.sum("eligible_amount_count"))),
    "amount_coverage": ("fact_demand_daily", lambda: ratio(F.sum("eligible_amount_count"), F.sum("package_count"))),
    "planned_billions": ("fact_demand_daily", lambda: blank_sum("planned_amount_sum", "eligible_amount_count", 1_000_000_000)),
    "award_amount": ("fact_award_daily", lambda: blank_sum("award_amount_sum", "eligible_amount_count")),
    "descriptive_rate": ("fact_savings_daily", lambda: ratio(F.sum("descriptive_difference_sum"), F.sum("descriptive_baseline_sum"))),
    "bidders_per_opening": ("fact_bidding_competition_daily", lambda: ratio(F.sum("total_bidders"), F.sum("opening_count"))),
    "single_bidder_share": ("fact_bidding_competition_daily", lambda: ratio(F.sum("single_bidder_count"), F.sum("opening_count"))),
    "multi_bidder_share": ("fact_bidding_competition_daily", lambda: ratio(F.sum("multi_bidder_count"), F.sum("opening_count"))),
    "discount_share": ("fact_bidding_competition_daily", lambda: ratio(F.sum("discounted_bidder_count"), F.sum("total_bidders"))),
    "cancellation_rate": ("fact_notice_daily", lambda: ratio(F.sum("cancelled_notice_count"), F.sum("notice_count"))),
    "tech_over_bidders": ("fact_bidding_competition_daily", lambda: F.count_if(F.col("tech_passed_count") + F.col("tech_failed_count") > F.col("total_bidders"))),
    "money_identity_off": ("fact_bidding_competition_daily", lambda: F.count_if(F.abs(F.col("total_bid_amount") - F.col("total_discount_amount") - F.col("total_final_bid_amount")) > 0.01)),
}


def measure(star: dict[str, DataFrame], name: str, by: list[str]) -> DataFrame:
    """A measure by columns of its fact. Where the fact has currencies, only VND is added."""
    fact, of = MEASURES[name]
    rows = star[fact].filter("currency_key = 'VND'") if "currency_key" in star[fact].columns else star[fact]
    return rows.groupBy(*by).agg(of().alias(name))


def duration_measure(fact: DataFrame, by: list[str]) -> DataFrame:
    """MEA-6: the mean duration, blank unless exactly one metric is in view."""
    one = F.min("metric_key") == F.max("metric_key")
    return fact.groupBy(*by).agg(F.when(one, ratio(F.sum("duration_sum"), F.sum("sample_count"))).alias("average_duration"))


def recipients(fact: DataFrame, by: list[str]) -> DataFrame:
    """MEA-7: value, distinct recipients and scopes of single, known recipients in VND with eligible amounts."""
    rows = fact.filter("currency_key = 'VND' and recipient_allocation_state = 'single_recipient' and eligible_amount_count > 0 and party_key != 'PARTY_UNKNOWN'")
    return rows.groupBy(*by).agg(F.sum("award_amount_sum").alias("recipient_value"), F.countDistinct("party_key").alias("recipients"), F.sum("eligible_amount_count").alias("recipient_scopes"))


def allocation(fact: DataFrame) -> DataFrame:
    """MEA-8."""
    return fact.groupBy("recipient_allocation_state").agg(F.sum("award_scope_count").alias("award_scope_count"), F.sum("award_amount_sum").alias("award_amount_sum"))


def top_share(fact: DataFrame, entity: str, value: str, n: int = 10) -> DataFrame:
    """MEA-9, TOP-2: share of the ``n`` largest in the total."""
    per = fact.groupBy(entity).agg(F.sum(value).alias("v"))
    best = top(per, "v", entity, n).agg(F.sum("v").alias("top"))
    return best.crossJoin(per.agg(F.sum("v").alias("total"))).select("top", "total", ratio(F.col("top"), F.col("total")).alias("top_share"))


def observed_range(facts: dict[str, DataFrame]) -> DataFrame:
    """MEA-11: first and last day and rows of each fact."""
    out = None
    for name, df in facts.items():
        one = df.agg(F.min("report_date").alias("first_day"), F.max("report_date").alias("last_day"), F.count("*").alias("rows")).select(F.lit(name).alias("fact"), "first_day", "last_day", "rows")
        out = one if out is None else out.unionByName(one)
    return out


def star(fact: DataFrame, dims: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """MEA-12: a fact with its dimensions; ``dims`` has (dimension, key) by foreign key. Spark broadcasts what its statistics say is small."""
    for fk, (dim, key) in dims.items():
        fact = fact.join(dim.withColumnRenamed(key, fk), fk, "left")
    return fact


def precision(fact: DataFrame, columns: list[str]) -> DataFrame:
    """MEA-13: exact sums beside sums of doubles."""
    one = fact.agg(*(x for c in columns for x in (F.sum(F.col(c).cast("decimal(38,6)")).alias(f"e_{c}"), F.sum(F.col(c).cast("double")).alias(f"d_{c}"))))
    each = F.explode(F.array(*(F.struct(F.lit(c).alias("measure"), F.col(f"e_{c}").alias("exact"), F.col(f"d_{c}").alias("approximate")) for c in columns)))
    return one.select(each.alias("x")).select("x.*", F.abs(F.col("x.approximate") - F.col("x.exact").cast("double")).alias("gap"))


def audit_source(df: DataFrame, key: str, grain: list[str], day: str) -> DataFrame:
    """MEA-14: rows, distinct and null keys, repeated grains, and days without a row between the first and the last."""
    groups = df.groupBy(*grain).agg(F.count("*").alias("n")).agg(F.coalesce(F.sum(F.when(F.col("n") > 1, 1)), F.lit(0)).alias("repeated_grains"))
    one = df.agg(F.count("*").alias("rows"), F.countDistinct(key).alias("distinct_keys"), F.count_if(F.col(key).isNull()).alias("null_keys"), (F.datediff(F.max(day), F.min(day)) + 1 - F.countDistinct(F.to_date(day))).alias("missing_days"))
    return one.crossJoin(groups)
