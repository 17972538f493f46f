"""Daily contributions of the eight facts, their contracts, and the windowed aggregate (FCT, BIZ-37, INC-11)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revlake.functions.cleaning import digest
from revlake.operators.ledger import aggregate, grain_violations
from revlake.operators.policies import band_of
from revlake.plans.business import DURATION_DAYS, DURATIONS

COUNT, MONEY = "bigint", "decimal(38,6)"
GOOD = ["effective", "effective_completed"]


@dataclass(frozen=True)
class Fact:
    grain: tuple[str, ...]
    measures: dict[str, str]


def _f(grain: str, counts: str, amounts: str = "") -> Fact:
    return Fact(("report_date", *grain.split()), dict.fromkeys(counts.split(), COUNT) | dict.fromkeys(amounts.split(), MONEY))


FACTS = {
    "fact_demand_daily": _f("geography_key sector_key value_band_key currency_key", "package_count eligible_amount_count", "planned_amount_sum"),
    "fact_notice_daily": _f("geography_key sector_key method_key notice_family", "notice_count cancelled_notice_count"),
    "fact_award_daily": _f("geography_key sector_key method_key currency_key", "award_scope_count effective_award_scope_count eligible_amount_count", "award_amount_sum"),
    "fact_savings_daily": _f("geography_key sector_key method_key value_band_key currency_key", "scope_count descriptive_sample_count verified_sample_count contract_sample_count", "descriptive_baseline_sum descriptive_award_sum descriptive_difference_sum verified_baseline_sum verified_award_sum verified_saving_sum contract_amount_sum contract_saving_sum"),
    "fact_duration_daily": _f("sector_key method_key metric_key", "interval_count excluded_sample_count sample_count", "duration_sum"),
    "fact_status_daily": _f("status_key sector_key", "package_count"),
    "fact_supplier_daily": _f("geography_key sector_key currency_key party_key recipient_allocation_state", "award_scope_count effective_award_scope_count eligible_amount_count", "award_amount_sum"),
    "fact_bidding_competition_daily": _f("geography_key sector_key method_key value_band_key", "opening_count total_bidders single_bidder_count multi_bidder_count tech_passed_count tech_failed_count discounted_bidder_count", "total_bid_amount total_discount_amount total_final_bid_amount"),
}


def in_window(day: Column, start: str, end: str) -> Column:
    """FLT-3: in the window, or without a date."""
    return F.coalesce(day.between(F.lit(start).cast("date"), F.lit(end).cast("date")), F.lit(False)) | day.isNull()


def _one(condition: Column) -> Column:
    return F.when(condition, 1).otherwise(0).cast(COUNT)


def _amount(condition: Column, c: str) -> Column:
    return F.coalesce(F.when(condition, F.col(c)), F.lit(0)).cast(MONEY)


def demand_contributions(rows: DataFrame, start: str, end: str) -> DataFrame:
    ok = F.col("is_amount_eligible")
    return rows.filter(in_window(F.col("package_published_date"), start, end)).select(F.col("package_key").alias("owner_key"), F.col("package_published_date").alias("report_date"), "geography_key", "sector_key", F.coalesce(F.when(F.col("currency_key") == "VND", band_of(F.col("planned_package_amount"))), F.lit("BAND_UNKNOWN")).alias("value_band_key"), "currency_key", _one(F.lit(True)).alias("package_count"), _one(ok).alias("eligible_amount_count"), _amount(ok, "planned_package_amount").alias("planned_amount_sum"))


def notice_contributions(rows: DataFrame, start: str, end: str) -> DataFrame:
    return rows.filter(in_window(F.col("published_date"), start, end)).select(F.col("package_key").alias("owner_key"), F.col("published_date").alias("report_date"), "geography_key", "sector_key", "method_key", F.col("source_family").alias("notice_family"), _one(F.lit(True)).alias("notice_count"), _one(F.col("cancellation_state") == "cancelled").alias("cancelled_notice_count"))


def _award_measures() -> list[Column]:
    good = F.col("award_state").isin(GOOD)
    both = good & F.col("is_amount_eligible")
    return [_one(F.lit(True)).alias("award_scope_count"), _one(good).alias("effective_award_scope_count"), _one(both).alias("eligible_amount_count"), _amount(both, "award_amount").alias("award_amount_sum")]


def award_contributions(rows: DataFrame, start: str, end: str) -> DataFrame:
    return rows.filter(in_window(F.col("award_published_date"), start, end)).select(F.col("package_key").alias("owner_key"), F.col("award_published_date").alias("report_date"), "geography_key", "sector_key", "method_key", "currency_key", *_award_measures())


def supplier_contributions(rows: DataFrame, start: str, end: str) -> DataFrame:
    return rows.filter(in_window(F.col("award_published_date"), start, end)).select(F.col("package_key").alias("owner_key"), F.col("award_published_date").alias("report_date"), "geography_key", "sector_key", "currency_key", F.col("recipient_set_key").alias("party_key"), "recipient_allocation_state", *_award_measures())


def savings_contributions(rows: DataFrame, start: str, end: str) -> DataFrame:
    d, c, none = F.col("is_descriptive_eligible"), F.col("is_contract_eligible"), F.lit(False)
    band = F.coalesce(F.when(F.col("baseline_currency_key") == "VND", band_of(F.col("baseline_amount"))), F.lit("BAND_UNKNOWN"))
    return rows.filter(in_window(F.col("award_published_date"), start, end)).select(
        F.col("package_key").alias("owner_key"), F.col("award_published_date").alias("report_date"), "geography_key", "sector_key", "method_key", band.alias("value_band_key"), "currency_key", _one(F.lit(True)).alias("scope_count"),
        _one(d).alias("descriptive_sample_count"), _amount(d, "baseline_amount").alias("descriptive_baseline_sum"), _amount(d, "award_amount").alias("descriptive_award_sum"), _amount(d, "descriptive_difference").alias("descriptive_difference_sum"),
        _one(none).alias("verified_sample_count"), *(_amount(none, "baseline_amount").alias(f"verified_{x}_sum") for x in ("baseline", "award", "saving")), _one(c).alias("contract_sample_count"), _amount(c, "contract_amount").alias("contract_amount_sum"), _amount(c, "contract_saving").alias("contract_saving_sum"),
    )


def duration_contributions(rounds: DataFrame, start: str, end: str) -> DataFrame:
    """FCT-5: a row per round and duration, each on its own day; one unpivot instead of seven scans."""
    each = F.explode(F.array(*(F.struct(F.lit(m).alias("metric_key"), F.col(day).alias("report_date"), F.col(m).alias("value")) for m, day in zip(DURATIONS, DURATION_DAYS, strict=True))))
    rows = rounds.select(F.col("package_key").alias("owner_key"), "sector_key", "method_key", each.alias("x")).select("owner_key", "sector_key", "method_key", "x.*").filter(in_window(F.col("report_date"), start, end))
    known = F.col("value").isNotNull()
    return rows.select("owner_key", "report_date", F.coalesce("sector_key", F.lit("SEC_UNKNOWN")).alias("sector_key"), F.coalesce("method_key", F.lit("METHOD_UNKNOWN")).alias("method_key"), "metric_key", _one(F.lit(True)).alias("interval_count"), _one(~known).alias("excluded_sample_count"), _amount(known, "value").alias("duration_sum"), _one(known).alias("sample_count"))


def status_contributions(rows: DataFrame, start: str, end: str) -> DataFrame:
    key = F.concat(F.lit("STATUS_"), digest(F.col("notice_observation_state"), F.col("award_observation_state")))
    return rows.filter(in_window(F.col("package_published_date"), start, end)).select(F.col("package_key").alias("owner_key"), F.col("package_published_date").alias("report_date"), key.alias("status_key"), "sector_key", _one(F.lit(True)).alias("package_count"))


def competition_contributions(rows: DataFrame, start: str, end: str) -> DataFrame:
    f = FACTS["fact_bidding_competition_daily"]
    band = F.coalesce(band_of(F.col("baseline")), F.lit("BAND_UNKNOWN"))
    known = {"geography_key": "GEO_UNKNOWN", "sector_key": "SEC_UNKNOWN", "method_key": "METHOD_UNKNOWN"}
    return rows.filter(in_window(F.col("report_date"), start, end)).select(F.coalesce("package_key", "opening_key").alias("owner_key"), "report_date", *(F.coalesce(k, F.lit(v)).alias(k) for k, v in known.items()), band.alias("value_band_key"), *(F.coalesce(m, F.lit(0)).cast(t).alias(m) for m, t in f.measures.items()))


def build(name: str, contributions: DataFrame) -> DataFrame:
    """FCT-10: a fact from its contributions."""
    f = FACTS[name]
    return aggregate(contributions, list(f.grain), f.measures)


def build_day(name: str, contributions: DataFrame, day: str) -> DataFrame:
    """INC-11: one day of a fact, for rerunning that day by ``sinks.overwrite_window``."""
    return build(name, contributions.filter(F.col("report_date") == F.lit(day).cast("date")))


def gate(name: str, fact: DataFrame, contributions: DataFrame) -> DataFrame:
    """BIZ-37: (violation, rows): repeated or null grains of the fact, contributions without an owner."""
    grains = grain_violations(fact, [c for c in FACTS[name].grain if c != "report_date"] + ["report_date"]).filter("violation = 'duplicate_grain'").agg(F.count("*").alias("rows")).select(F.lit("duplicate_grain").alias("violation"), "rows")
    return grains.unionByName(contributions.filter("owner_key is null").agg(F.count("*").alias("rows")).select(F.lit("null_owner").alias("violation"), "rows"))


def metric_dictionary(spark) -> DataFrame:
    """DIM-2: the seven durations and their units."""
    rows = ", ".join(f"('{m}', '{m.rsplit('_', 1)[0]}', '{m.rsplit('_', 1)[1]}')" for m in DURATIONS)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(metric_key, metric_name, duration_unit)")


def status_dictionary(rows: DataFrame) -> DataFrame:
    """DIM-2: observed pairs of states and their key."""
    return rows.select("notice_observation_state", "award_observation_state").distinct().withColumn("status_key", F.concat(F.lit("STATUS_"), digest(F.col("notice_observation_state"), F.col("award_observation_state"))))
