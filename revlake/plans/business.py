"""Business relations: packages, notices, awards, savings, rounds, competition (BIZ). Each is one function of the relations before it."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revlake.functions.amounts import norm_bid_price, recover_award_amount
from revlake.operators import policies as P
from revlake.operators.references import known_first, minted_key, resolve, unique_lookup, wanted
from revlake.operators.selection import first_by, joined_set, latest, only_value, order, rare_overlap_count, tie_conflict, version_number

MONEY = "decimal(38,6)"
# Source states.
CANCELLED = ["CANCELLED", "REVOKED", "HUY_THAU", "HUY", "HỦY KẾT QUẢ"]
EFFECTIVE = ["IS_PUBLISH", "PUBLISHED", "EFFECTIVE", "HOAT_DONG"]
NO_CURRENCY = ["", "UNKNOWN", "CUR_UNKNOWN", "NONE"]
LARGEST_AWARD = 50_000_000_000_000


def _filled(c: str) -> Column:
    return F.nullif(F.trim(c), F.lit(""))


def currency_key(c: str) -> Column:
    upper = F.upper(F.trim(c))
    return F.when(upper.isNull() | upper.isin(NO_CURRENCY), "CUR_UNKNOWN").otherwise(upper)


def candidates(revisions: DataFrame, price: str | None = None, version: str = "version") -> DataFrame:
    """BIZ-1, BIZ-3: the current revision of each entity, and whether revisions that tie with it disagree on the price."""
    by = [*order(version_number(F.col(version)), F.col("observed_at"), F.col("public_date")), F.col("revision_id").desc()]
    rows = latest(revisions, ["entity_id"], by)
    if not price:
        return rows
    ties = tie_conflict(revisions, ["entity_id"], price)
    same = revisions.groupBy("entity_id", version_number(F.col(version)).alias("_v"), F.col("observed_at").alias("_o")).agg(F.count("*").alias("_n"))
    at = (F.col("_v").eqNullSafe(version_number(F.col(version)))) & (F.col("_o").eqNullSafe(F.col("observed_at")))
    rows = rows.alias("r").join(same.alias("s"), (F.col("r.entity_id") == F.col("s.entity_id")) & at, "left").select("r.*", "_n")
    state = F.when((F.col("_n") > 1) & F.col("tie_conflict"), "tie_conflict").otherwise("resolved_deterministic")
    return rows.join(ties.drop("ties"), "entity_id", "left").withColumn("resolution_state", state).drop("_n", "tie_conflict")


def geography(places: DataFrame, provinces: DataFrame | None = None) -> DataFrame:
    """BIZ-2: per revision, the number of provinces, the only one, the geography key and a key of the set of places."""
    rows = places if provinces is None else places.join(F.broadcast(provinces), places["province_code"] == provinces["raw_code"], "left").withColumn("province_code", F.coalesce("canonical_code", places["province_code"]))
    per = rows.groupBy("revision_id").agg(F.countDistinct("province_code").alias("province_count"), only_value("province_code").alias("only_province"), joined_set("province_code").alias("codes"))
    return per.select("revision_id", "province_count", "only_province", F.when(F.col("province_count") == 1, F.concat(F.lit("GEO_"), F.col("only_province"))).when(F.col("province_count") > 1, "GEO_MULTI_UNALLOCATED").otherwise("GEO_UNKNOWN").alias("geography_key"), F.concat(F.lit("LOC_SET:"), F.when(F.col("codes") == "", "UNKNOWN").otherwise(F.md5("codes"))).alias("location_set_key"))


def notice_keys(notices: DataFrame) -> DataFrame:
    """BIZ-3: business and round keys of notices."""
    key = F.concat_ws(":", F.lit("NOT"), "source_family", "notify_no")
    return notices.withColumns({"notice_business_key": key, "round_business_key": F.concat(F.lit("RND:"), key)})


def package_match(rows: DataFrame, packages: DataFrame) -> DataFrame:
    """BIZ-4: the package of each result or notice, by id, else by a code that one package has."""
    found = resolve(rows, packages, id_col="package_id", code_col="package_no", entity="entity_id", raw_id="source_id" if "source_id" in packages.columns else None, target_code="package_no", prefix="package")
    own = F.col("entity_id")
    key = minted_key("PKG", F.col("package_entity"), F.col("package_state"), F.concat_ws(":", F.coalesce("package_id", "package_no", F.lit("")), own))
    return found.withColumn("package_key", key)


def dim_date(days: DataFrame, start: str, end: str) -> DataFrame:
    """BIZ-5, DIM-1: every day of the scope and the days observed outside it, with calendar and ISO parts."""
    spark = days.sparkSession
    dense = spark.range(1).select(F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))).alias("date_key"))
    d = dense.unionByName(days.select(F.col(days.columns[0]).cast("date").alias("date_key")).filter("date_key is not null")).distinct()
    return d.select("date_key", F.year("date_key").alias("year"), F.quarter("date_key").alias("quarter"), F.month("date_key").alias("month"), F.dayofmonth("date_key").alias("day"), (F.dayofweek("date_key") - 1).alias("day_of_week"), F.dayofweek("date_key").isin(1, 7).alias("is_weekend"), F.date_format("date_key", "yyyy-MM").alias("year_month"), F.concat(F.year("date_key").cast("string"), F.lit("-Q"), F.quarter("date_key").cast("string")).alias("year_quarter"), F.extract(F.lit("yearofweek"), "date_key").cast("int").alias("iso_year"), F.weekofyear("date_key").alias("iso_week"), F.trunc("date_key", "week").alias("week_start_date"))


def dim_seeded(observed: DataFrame, key: str, seed: DataFrame) -> DataFrame:
    """BIZ-6, BIZ-7, DIM-4: the seed, and keys observed beside it."""
    more = observed.select(key).filter(F.col(key).isNotNull()).distinct().join(seed.select(key), key, "left_anti")
    return seed.unionByName(more, allowMissingColumns=True)


def dim_sector(observed: DataFrame, labels: dict[str, tuple[str, str]]) -> DataFrame:
    """BIZ-8: sector codes with labels and groups; ``labels`` has (name, group) by code."""
    code = F.substring_index("sector_key", "SEC_", -1)
    name, group = F.lit("unknown"), F.lit("other")
    for k, (n, g) in labels.items():
        name, group = F.when(code == k, n).otherwise(name), F.when(code == k, g).otherwise(group)
    return observed.select("sector_key").distinct().select("sector_key", code.alias("sector_code"), name.alias("sector_name"), group.alias("sector_group"))


def dim_method(rows: DataFrame) -> DataFrame:
    """BIZ-10: methods by the key of their five attributes."""
    five = ["bid_form", "bid_mode", "is_domestic", "is_internet", "contract_type"]
    return rows.select(P.method_key(*map(F.col, five)).alias("method_key"), *five).distinct()


def dim_package(packages: DataFrame, matched: DataFrame) -> DataFrame:
    """BIZ-11: known packages, and a placeholder for each key that a document minted without one."""
    known = packages.select(F.concat(F.lit("PKG:"), "entity_id").alias("package_key"), "package_no", "title", F.lit(False).alias("is_placeholder"))
    lost = matched.select("package_key").distinct().join(known.select("package_key"), "package_key", "left_anti")
    return known.unionByName(lost.withColumn("is_placeholder", F.lit(True)), allowMissingColumns=True)


def dim_scope(packages: DataFrame, items: DataFrame) -> DataFrame:
    """BIZ-12: package, lot and package-round scopes; a scope that appears once more often than a key allows isn't one."""
    own = packages.select(F.concat(F.lit("PKG:"), "entity_id").alias("package_key")).select(F.col("package_key").alias("scope_key"), "package_key", F.lit("PACKAGE").alias("scope_type"))
    used = items.select("scope_key", "package_key", F.when(F.col("scope_key").contains(":LOT:"), "LOT").otherwise("PACKAGE").alias("scope_type")).distinct()
    return own.unionByName(used.join(own.select("scope_key"), "scope_key", "left_anti"))


def demand(packages: DataFrame, plans: DataFrame, places: DataFrame, notices: DataFrame, results: DataFrame) -> DataFrame:
    """BIZ-13: one row per package: amounts, keys, planned start and what was observed later."""
    found = resolve(packages, plans, id_col="plan_id", code_col="plan_no", entity="entity_id", raw_id=None, target_code="plan_no", prefix="plan")
    plan = plans.select(F.col("entity_id").alias("plan_entity"), "investor_name", "project_no", F.col("public_date").alias("plan_published_date"))
    seen = lambda df, name: df.select(F.col("package_entity").alias("entity_id")).filter("entity_id is not null").distinct().withColumn(name, F.lit(True))
    rows = found.join(plan, "plan_entity", "left").join(places, "revision_id", "left").join(seen(notices, "_notice"), "entity_id", "left").join(seen(results, "_result"), "entity_id", "left")
    y, m = F.col("bid_start_year").cast("int"), F.col("bid_start_month").cast("int")
    start = F.when(m.isNotNull(), F.try_make_date(y, m, F.lit(1)) if hasattr(F, "try_make_date") else F.make_date(y, m, F.lit(1))).otherwise(F.make_date(y, F.lit(1), F.lit(1)))
    end = F.when(m.isNotNull(), F.last_day(start)).otherwise(F.make_date(y, F.lit(12), F.lit(31)))
    precision = F.when(m.isNotNull(), "month").when(F.col("bid_start_quarter").isNotNull(), "quarter").when(y.isNotNull(), "year").otherwise("unresolved")
    investor = F.when(F.col("plan_entity").isNotNull() & _filled("investor_name").isNotNull(), F.concat(F.lit("PARTY_INVESTOR_NAME:"), F.md5(F.upper(F.trim("investor_name"))))).when(F.col("plan_entity").isNotNull(), F.concat(F.lit("PARTY_UNRESOLVED:PLAN_INVESTOR:"), "plan_entity")).otherwise("PARTY_INVESTOR:UNKNOWN")
    state = lambda c: F.when(F.col(c), "observed").otherwise("not_observed")
    return rows.select(
        F.concat(F.lit("PKG:"), "entity_id").alias("package_key"), F.concat(F.lit("SEC_"), F.coalesce(_filled("bid_field"), F.lit("UNKNOWN"))).alias("sector_key"), P.method_key(F.col("bid_form"), F.col("bid_mode"), F.col("is_domestic"), F.col("is_internet"), F.col("contract_type")).alias("method_key"),
        investor.alias("investor_party_key"), currency_key("currency").alias("currency_key"), F.col("public_date").alias("package_published_date"), "plan_published_date",
        F.when(y.isNotNull(), start).alias("planned_start_from"), F.when(y.isNotNull(), end).alias("planned_start_to"), precision.alias("planned_start_precision"),
        F.coalesce("geography_key", F.lit("GEO_UNKNOWN")).alias("geography_key"), F.coalesce("location_set_key", F.lit("LOC_SET:UNKNOWN")).alias("location_set_key"),
        F.col("bid_price").alias("planned_package_amount"), F.coalesce((F.col("bid_price") > 0) & (currency_key("currency") != "CUR_UNKNOWN"), F.lit(False)).alias("is_amount_eligible"),
        state("_notice").alias("notice_observation_state"), state("_result").alias("award_observation_state"), F.coalesce("resolution_state", F.lit("resolved_deterministic")).alias("relationship_state"), "project_no", F.concat(F.lit("EVD:DEMAND:"), "revision_id").alias("evidence_set_key"),
    )


def contract_prices(results: DataFrame, contracts: DataFrame) -> DataFrame:
    """BIZ-27: (revision_id, contract_price): prices of the contracts of each result, found by bid, by result or by notice; a contract that
    is found in several ways counts once. The OR is a union of equi-joins."""
    paid = contracts.filter("price_after_tax > 0").select("entity_id", "price_after_tax", "result_source_id", "notice_no")
    ways = [("bid_id", "result_source_id"), ("result_id", "result_source_id"), ("notify_no", "notice_no")]
    met = [results.select("revision_id", F.col(a).alias("_k")).join(paid.select(F.col(b).alias("_k"), "entity_id", "price_after_tax"), "_k").drop("_k") for a, b in ways]
    return reduce(DataFrame.unionByName, met).distinct().groupBy("revision_id").agg(F.sum("price_after_tax").alias("contract_price"))


def one_per_key(dimension: DataFrame, key: str) -> DataFrame:
    """DIM-7: of the rows that batches brought for a key, the one whose JSON text is the smallest. A grouped minimum, so hot keys combine before the shuffle."""
    row = F.struct(*(F.col(c) for c in dimension.columns))
    return dimension.groupBy(key).agg(F.min_by(row, F.to_json(row)).alias("_r")).select("_r.*")


def dim_geography(known: DataFrame, canonical: DataFrame, places: DataFrame, provinces: DataFrame) -> DataFrame:
    """DIM-6: (geography_key, province_code, province_name, region_name): canonical rows over ``known`` ones; then codes of ``places`` that
    ``provinces`` (raw_code) doesn't map, with their name where it is the same everywhere, which replaces the name of a known row."""
    fields = ["geography_key", "province_code", "province_name", "region_name"]
    base = canonical.select(fields).unionByName(known.select(fields).join(canonical.select("geography_key"), "geography_key", "left_anti"))
    code = F.upper(_filled("province_code"))
    seen = places.select(code.alias("code"), _filled("province_name").alias("name")).filter("code is not null").groupBy("code").agg(only_value("name").alias("name"))
    seen = seen.join(provinces.select(F.col("raw_code").alias("code")).distinct(), "code", "left_anti").select(F.concat(F.lit("GEO_"), "code").alias("geography_key"), "code", "name", F.lit(True).alias("_seen"))
    both = base.join(seen, "geography_key", "full")
    return both.select("geography_key", F.coalesce("province_code", "code").alias("province_code"), F.when(F.col("_seen"), F.col("name")).otherwise(F.col("province_name")).alias("province_name"), "region_name")


def location_bridge(places: DataFrame, keys: DataFrame) -> DataFrame:
    """BIZ-14: (location_set_key, province_code), once each."""
    return places.join(keys.select("revision_id", "location_set_key"), "revision_id").select("location_set_key", "province_code").filter("province_code is not null").distinct()


def named_demand(demand_rows: DataFrame, rows: DataFrame) -> DataFrame:
    """The demand of packages that ``rows`` name. Keys that were minted for want of one package name none."""
    none = F.col("package_key").startswith("PKG_UNRESOLVED:") | F.col("package_key").startswith("PKG_AMBIGUOUS:")
    return wanted(demand_rows, "package_key", rows.filter(~none))


def tender_notice(notices: DataFrame, demand_rows: DataFrame, places: DataFrame, keep: list[str] = ()) -> DataFrame:
    """BIZ-15: one row per notice: preparation hours, cancellation, and the demand's keys where the notice has none. ``keep`` are columns of the notices to have beside."""
    rows = notices.join(places, "revision_id", "left").withColumnRenamed("geography_key", "_own_geo").join(demand_rows.select("package_key", F.col("geography_key").alias("_geo"), "sector_key", "method_key", F.col("currency_key").alias("_cur")), "package_key", "left")
    hours = F.when(F.col("bid_close_date") >= F.col("published_at"), F.round((F.unix_seconds("bid_close_date") - F.unix_seconds("published_at")) / 3600, 2).cast(MONEY))
    cancelled = F.col("cancel_date").isNotNull() | F.upper(F.coalesce("status_raw", F.lit(""))).isin(CANCELLED)
    return rows.select("notice_business_key", "round_business_key", "package_key", F.coalesce("sector_key", F.concat(F.lit("SEC_"), F.coalesce(_filled("bid_field"), F.lit("UNKNOWN")))).alias("sector_key"), F.coalesce("method_key", F.lit("METHOD_UNKNOWN")).alias("method_key"), known_first("GEO_UNKNOWN", F.col("_own_geo"), F.col("_geo"), F.lit("GEO_UNKNOWN")).alias("geography_key"), "source_family", "published_at", F.to_date("published_at").alias("published_date"), F.col("bid_close_date").alias("close_at"), F.to_date("bid_close_date").alias("close_date"), hours.alias("preparation_hours"), F.when(_filled("guarantee_currency").isNotNull(), currency_key("guarantee_currency")).otherwise(F.coalesce("_cur", F.lit("CUR_UNKNOWN"))).alias("guarantee_currency_key"), F.when(cancelled, "cancelled").otherwise("none").alias("cancellation_state"), "cancel_reason", F.to_date("cancel_date").alias("cancel_date"), F.concat(F.lit("EVD:NOTICE:"), "revision_id").alias("evidence_set_key"), *keep)


def award_items(results: DataFrame, lots: DataFrame, notices: DataFrame) -> DataFrame:
    """BIZ-16: one item per lot of a result, or one for the whole package where it has no lot. Where ``notices`` have a geography (BIZ-15), items keep the round and the
    geography of their one notice, so that BIZ-23 need not look for it again."""
    own = {"round_business_key": "round_business_key", "geography_key": "notice_geography_key"} if "geography_key" in notices.columns else {}
    rounds = notices.groupBy("notify_no").agg(F.count("*").alias("_n"), F.min("round_business_key").alias("_round"), *(F.min(c).alias(name) for c, name in own.items())).filter("_n = 1").drop("_n")
    r = results.join(rounds, "notify_no", "left").withColumn("_round", F.coalesce("_round", F.concat(F.lit("RESULT:"), "entity_id")))
    head = ["revision_id", "package_key", "status_raw", "notify_no", *own.values()]
    dates = [F.col("public_date").alias("award_published_date"), F.col("decision_date").alias("award_decision_date")]
    each = lots.filter(_filled("lot_no").isNotNull()).select("revision_id", "award_lot_id", "lot_no", "source_lot_id", F.col("winning_price").alias("_won"), "lot_price", "lot_currency")
    ident = F.coalesce(_filled("source_lot_id"), F.concat(F.lit("REVISION:"), "award_lot_id"))
    by_lot = r.join(each, "revision_id").select(*head, *dates, "award_lot_id", F.concat("package_key", F.lit(":LOT:"), "lot_no", F.lit(":"), ident, F.lit(":ROUND:"), "_round").alias("scope_key"), F.concat(F.lit("AWARD:"), "revision_id", F.lit(":LOT:"), "award_lot_id").alias("award_business_key"), F.col("_won").alias("raw_amount"), "lot_price", "lot_currency", F.coalesce("lot_currency", "currency").alias("currency"))
    whole = r.join(lots.select("revision_id").distinct(), "revision_id", "left_anti").select(*head, *dates, F.lit(None).cast("string").alias("award_lot_id"), F.concat("package_key", F.lit(":PACKAGE:ROUND:"), "_round").alias("scope_key"), F.concat(F.lit("AWARD:"), "revision_id", F.lit(":PKG")).alias("award_business_key"), F.col("winning_price").alias("raw_amount"), F.lit(None).cast(MONEY).alias("lot_price"), F.col("currency").alias("lot_currency"), "currency")
    return by_lot.unionByName(whole)


def winners(items: DataFrame, contractors: DataFrame) -> DataFrame:
    """BIZ-17: winning contractors of each item: of its lot, or of all the result's where it is for the whole package."""
    won = contractors.filter("is_winner").drop("lot_ordinal")
    lot = items.filter("award_lot_id is not null").select("award_business_key", "scope_key", "revision_id", "award_lot_id").join(won, ["revision_id", "award_lot_id"])
    whole = items.filter("award_lot_id is null").select("award_business_key", "scope_key", "revision_id").join(won, "revision_id")
    return lot.unionByName(whole.select(lot.columns))


def recipient_summary(won: DataFrame) -> DataFrame:
    """BIZ-18: distinct winners of each item, whether a consortium is among them, and a sample of their names."""
    code = F.coalesce(_filled("contractor_code"), _filled("tax_code"))
    who = F.when(code.isNotNull(), F.concat(F.lit("PARTY:"), code)).otherwise(F.concat(F.lit("UNRESOLVED:"), "award_contractor_id"))
    return won.groupBy("award_business_key").agg(F.countDistinct(who).alias("winner_count"), F.bool_or(F.col("is_consortium") | _filled("venture_code").isNotNull()).alias("has_consortium"), F.min("venture_code").alias("sample_venture_code"), F.min(code).alias("sample_party_code"))


def resolved_awards(items: DataFrame, summary: DataFrame, demand_rows: DataFrame) -> DataFrame:
    """BIZ-19: amounts repaired against a baseline, state of each award, and whether its amount may be summed."""
    rows = rare_overlap_count(items, ["package_key", "scope_key"]).join(summary, "award_business_key", "left").join(demand_rows.select("package_key", "planned_package_amount"), "package_key", "left")
    positive = lambda c: F.when(F.col(c) > 0, F.col(c))
    rows = rows.withColumn("baseline", F.coalesce(positive("lot_price"), F.when(F.col("award_lot_id").isNull(), positive("planned_package_amount"))))
    rows = rows.withColumns({"award_amount": recover_award_amount(F.col("raw_amount"), F.col("baseline")), "winner_count": F.coalesce("winner_count", F.lit(0))})
    return rows.withColumns({"award_state": award_state(F.col("status_raw"), F.col("decisions"), F.col("winner_count")), "is_amount_eligible": award_eligible(F.col("status_raw"), F.col("winner_count"), F.col("award_amount"), currency_key("currency"), F.col("decisions"), F.col("baseline"))}).drop("planned_package_amount")


def award_state(status: Column, decisions: Column, winner_count: Column) -> Column:
    s = F.upper(F.coalesce(status, F.lit("")))
    return F.when(s.isin(CANCELLED), "cancelled").when(decisions > 1, "unresolved_overlap").when(winner_count == 0, "no_confirmed_winner").when(s.isin(EFFECTIVE), "effective").otherwise("unresolved_status")


def award_eligible(status: Column, winner_count: Column, amount: Column, currency: Column, decisions: Column, baseline: Column) -> Column:
    effective = F.upper(F.coalesce(status, F.lit(""))).isin(EFFECTIVE)
    believable = (amount > 0) & (amount <= LARGEST_AWARD) & (baseline.isNull() | (amount <= baseline * 2))
    return F.coalesce(effective & (winner_count > 0) & (currency != "CUR_UNKNOWN") & (decisions == 1) & believable, F.lit(False))


def dim_party(sources: list[DataFrame], placeholders: DataFrame) -> DataFrame:
    """BIZ-20, DIM-3, DIM-5: one row per party: of the sources, each with (party_key, party_kind, party_code, party_name, tax_code, priority), each
    attribute from the first source that has the party; placeholders where none has."""
    rows = reduce(DataFrame.unionByName, sources).filter("party_key is not null")
    fields = ["party_kind", "party_code", "party_name"]
    known = rows.groupBy("party_key").agg(*(first_by(c, "priority", c).alias(c) for c in fields), F.min_by("tax_code", F.when(F.col("tax_code").isNotNull(), F.struct("priority", "tax_code"))).alias("tax_code"))
    return known.unionByName(placeholders.join(known.select("party_key"), "party_key", "left_anti"), allowMissingColumns=True)


def consortium_members(won: DataFrame) -> DataFrame:
    """BIZ-21: members of each venture, with a code only where it is the same everywhere."""
    return won.filter(_filled("venture_code").isNotNull()).groupBy(F.concat(F.lit("CON:"), "venture_code").alias("consortium_key"), F.concat(F.lit("PARTY:"), F.coalesce("contractor_code", "tax_code")).alias("party_key")).agg(only_value("tax_code").alias("tax_code"))


def recipient_bridge(won: DataFrame, summary: DataFrame) -> DataFrame:
    """BIZ-22: recipients of each award; a sole winner has all of it, others have no share that is known."""
    code = F.coalesce(_filled("contractor_code"), _filled("tax_code"))
    rows = won.join(summary.select("award_business_key", "winner_count", "has_consortium"), "award_business_key")
    party = F.when(_filled("venture_code").isNotNull(), F.concat(F.lit("CON:"), "venture_code")).when(code.isNotNull(), F.concat(F.lit("PARTY:"), code)).otherwise("PARTY_UNKNOWN")
    share = F.when((F.col("winner_count") == 1) & ~F.col("has_consortium"), F.lit(100)).cast("decimal(10,4)")
    return rows.select("award_business_key", party.alias("party_key"), share.alias("allocated_percent")).distinct()


def award_evidence() -> Column:
    return F.concat(F.lit("EVD:AWARD:"), "revision_id")


def fact_award(awards: DataFrame, demand_rows: DataFrame, notices: DataFrame) -> DataFrame:
    """BIZ-23: awards with their keys; the demand's geography unless it is unknown, then the notice's."""
    d = demand_rows.select("package_key", F.col("geography_key").alias("_d"), "sector_key", "method_key", "relationship_state", F.col("planned_package_amount").alias("_planned"), F.col("package_published_date").alias("_planned_on"), F.col("currency_key").alias("_planned_cur"))
    rows = awards.join(d, "package_key", "left")
    if "notice_geography_key" in awards.columns:
        rows = rows.withColumnRenamed("notice_geography_key", "_n")
    elif "notify_no" in notices.columns:
        once = notices.groupBy("notify_no").agg(F.count("*").alias("_k"), F.min("geography_key").alias("_n"), F.min("round_business_key").alias("round_business_key")).filter("_k = 1").drop("_k")
        rows = rows.join(once, "notify_no", "left")
    else:
        rows = rows.withColumns({"_n": F.lit(None).cast("string"), "round_business_key": F.lit(None).cast("string")})
    none = F.col("winner_count") == 0
    state = F.when(none, "no_winner").when(F.col("has_consortium"), "unallocated_consortium").when(F.col("winner_count") == 1, "single_recipient").otherwise("independent_winners")
    recipient = F.when(none, "REC_NONE").when(F.col("has_consortium"), F.coalesce(F.concat(F.lit("CON:"), "sample_venture_code"), F.lit("REC_CONSORTIUM"))).when(F.col("winner_count") == 1, F.coalesce(F.concat(F.lit("PARTY:"), "sample_party_code"), F.lit("PARTY_UNKNOWN"))).otherwise("REC_MULTIPLE_INDEPENDENT")
    return rows.withColumns({"geography_key": known_first("GEO_UNKNOWN", F.col("_d"), F.col("_n"), F.lit("GEO_UNKNOWN")), "currency_key": currency_key("currency"), "sector_key": F.coalesce("sector_key", F.lit("SEC_UNKNOWN")), "method_key": F.coalesce("method_key", F.lit("METHOD_UNKNOWN")), "recipient_allocation_state": state, "recipient_set_key": recipient, "evidence_set_key": award_evidence()}).drop("_d", "_n")


def evidence_bridge(facts: dict[str, DataFrame]) -> DataFrame:
    """BIZ-24, BIZ-29: (evidence_set_key, evidence_kind, revision_id) of facts' evidence keys."""
    parts = [df.select("evidence_set_key", F.lit(kind).alias("evidence_kind"), F.substring_index("evidence_set_key", ":", -1).alias("revision_id")) for kind, df in facts.items()]
    return reduce(DataFrame.unionByName, parts).distinct()


def scope_baselines(awards: DataFrame) -> DataFrame:
    """BIZ-25: what an award is compared with: its lot's price, else the planned price of a package that was matched without doubt."""
    lot = F.when(F.col("lot_price") > 0, F.struct(F.col("lot_price").alias("amount"), F.lit("source_declared_lot_price").alias("basis"), F.col("award_published_date").alias("day"), currency_key("lot_currency").alias("currency")))
    certain = (F.col("award_lot_id").isNull()) & (F.col("relationship_state") == "resolved_deterministic") & (F.col("_planned") > 0)
    planned = F.when(certain, F.struct(F.col("_planned").alias("amount"), F.lit("planned_package_bid_price").alias("basis"), F.col("_planned_on").alias("day"), F.col("_planned_cur").alias("currency")))
    b = F.coalesce(lot, planned)
    return awards.withColumn("_b", b).withColumns({"baseline_amount": F.col("_b.amount"), "baseline_basis": F.coalesce("_b.basis", F.lit("unavailable_baseline")), "baseline_date": F.col("_b.day"), "baseline_currency_key": F.coalesce("_b.currency", F.lit("CUR_UNKNOWN"))}).drop("_b", "_planned", "_planned_on", "_planned_cur")


def lot_counts(awards: DataFrame) -> DataFrame:
    """BIZ-26: lots of each package and round."""
    return awards.filter(F.col("scope_key").contains(":LOT:")).groupBy("package_key", F.split_part("scope_key", F.lit(":ROUND:"), F.lit(2)).alias("scope_round")).agg(F.count("*").alias("lot_count"))


def exclusion_reason(day: Column, start: str, end: str, baseline: Column, baseline_day: Column, part: Column, state: Column, currency: Column, baseline_currency: Column, eligible: Column, amount: Column) -> Column:
    """BIZ-28: the first reason for which a difference isn't counted, else null; the order is fixed."""
    unknown = lambda c: c.isin("CUR_UNKNOWN", "UNKNOWN")
    rules = [
        ("unknown_award_date", day.isNull()), ("result_outside_period", (day > F.lit(end).cast("date")) | (day < F.lit(start).cast("date"))), ("missing_baseline", baseline.isNull() | (baseline <= 0)), ("unknown_baseline_date", baseline_day.isNull()),
        ("baseline_after_award", baseline_day > day), ("lot_partition_precedence", part), ("cancelled_award", state == "cancelled"), ("unresolved_award", state != "effective"), ("unknown_currency", unknown(currency)), ("unknown_baseline_currency", unknown(baseline_currency)),
        ("currency_mismatch", baseline_currency != currency), ("invalid_award_amount", ~eligible), ("extreme_overrun_anomaly", amount > baseline * 2),
    ]
    out = F.when(rules[0][1], rules[0][0])
    for name, rule in rules[1:]:
        out = out.when(rule, name)
    return out


def fact_savings(awards: DataFrame, contracts: DataFrame, start: str, end: str) -> DataFrame:
    """BIZ-28: difference between baseline and award of each scope, why it doesn't count, and the contract's saving. Nothing is verified: the
    sources don't say what taxes and scope a price covers. ``contracts`` has (revision_id, contract_price)."""
    b = scope_baselines(awards).withColumn("scope_round", F.split_part("scope_key", F.lit(":ROUND:"), F.lit(2)))
    rows = b.join(lot_counts(awards), ["package_key", "scope_round"], "left").join(contracts, "revision_id", "left").withColumn("lot_count", F.coalesce("lot_count", F.lit(0)))
    # As the sources have it: scope keys of packages go on after ":PACKAGE", so this never holds for them.
    part = F.col("scope_key").like("%:PACKAGE") & (F.col("lot_count") > 0)
    reason = exclusion_reason(F.col("award_published_date"), start, end, F.col("baseline_amount"), F.col("baseline_date"), part, F.col("award_state"), F.col("currency_key"), F.col("baseline_currency_key"), F.col("is_amount_eligible"), F.col("award_amount"))
    contract = F.coalesce((F.col("award_state") == "effective") & F.col("scope_key").like("%:PACKAGE%") & (F.col("lot_count") == 0) & (F.col("baseline_amount") > 0) & (F.col("contract_price") > 0) & (F.col("contract_price") <= F.col("baseline_amount") * 2), F.lit(False))
    return rows.withColumns({"comparison_key": F.concat(F.lit("CMP:"), "scope_key"), "descriptive_exclusion_reason": reason, "is_contract_eligible": contract}).withColumns({"is_descriptive_eligible": F.col("descriptive_exclusion_reason").isNull(), "descriptive_difference": F.when(F.col("descriptive_exclusion_reason").isNull(), F.col("baseline_amount") - F.col("award_amount")), "verified_saving": F.lit(None).cast(MONEY), "contract_amount": F.when(contract, F.col("contract_price")), "contract_saving": F.when(contract, F.col("baseline_amount") - F.col("contract_price")), "scope_completeness": F.when(part, "partial").otherwise("unverified")})


def round_notices(notices: DataFrame, demand_rows: DataFrame) -> DataFrame:
    """BIZ-30: each round's notice side; closing times count only if all its notices agree."""
    d = demand_rows.select("package_key", F.col("package_published_date").alias("_plan"), "planned_start_from", "planned_start_to")
    return notices.join(d, "package_key", "left").groupBy("round_business_key").agg(F.min("package_key").alias("package_key"), F.min("sector_key").alias("sector_key"), F.min("method_key").alias("method_key"), F.min("_plan").alias("plan_date"), F.min("planned_start_from").alias("planned_start_from"), F.min("planned_start_to").alias("planned_start_to"), F.min("published_date").alias("notice_date"), F.min("published_at").alias("notice_at"), only_value("close_date").alias("close_date"), only_value("close_at").alias("close_at"), F.bool_or(F.col("cancellation_state") == "cancelled").alias("is_cancelled"), F.min("cancel_reason").alias("cancel_reason"))


def round_awards(awards: DataFrame) -> DataFrame:
    """BIZ-31: each round's award side."""
    return awards.filter("round_business_key is not null").groupBy("round_business_key").agg(F.min("award_published_date").alias("first_award_date"), F.max("award_published_date").alias("complete_award_date"), F.min("award_decision_date").alias("first_decision_date"), F.max("award_decision_date").alias("complete_decision_date"), F.count("*").alias("award_count"), F.bool_and(F.col("award_state") == "effective").alias("all_effective"))


DURATIONS = ["plan_to_notice_days", "notice_to_close_hours", "close_to_first_award_days", "close_to_complete_award_days", "close_to_open_hours", "open_to_award_days", "planned_to_actual_delay_days"]
#: The day that each duration is reported on.
DURATION_DAYS = ["notice_date", "close_date", "first_award_date", "complete_award_date", "open_date", "complete_award_date", "contract_complete_date"]


def selection_rounds(notice_side: DataFrame, award_side: DataFrame, openings: DataFrame, contracts: DataFrame) -> DataFrame:
    """BIZ-32: seven durations of each round, null where an end is missing or comes before its start (a delay may be negative).
    ``openings`` has (round_business_key, open_at); ``contracts`` (round_business_key, planned_completion_date, actual_completion_date)."""
    opened = openings.groupBy("round_business_key").agg(F.min("open_at").alias("open_at")).withColumn("open_date", F.to_date("open_at"))
    done = contracts.groupBy("round_business_key").agg(F.max("planned_completion_date").alias("planned_completion_date"), F.max("actual_completion_date").alias("actual_completion_date"))
    rows = notice_side.join(award_side, "round_business_key", "left").join(opened, "round_business_key", "left").join(done, "round_business_key", "left").withColumn("contract_complete_date", F.col("actual_completion_date"))
    days = lambda a, b, ok=None: F.when((F.col(b) >= F.col(a)) & (F.lit(True) if ok is None else ok), F.datediff(F.col(b), F.col(a)).cast(MONEY))
    hours = lambda a, b: F.when(F.col(b) >= F.col(a), F.round((F.unix_seconds(b) - F.unix_seconds(a)) / 3600, 2).cast(MONEY))
    decided = lambda c: F.col(c).isNull() | (F.col(c) >= F.col("close_date"))
    values = [days("plan_date", "notice_date"), hours("notice_at", "close_at"), days("close_date", "first_award_date", decided("first_decision_date")), days("close_date", "complete_award_date", decided("complete_decision_date")), hours("close_at", "open_at"), days("open_date", "complete_award_date"), F.datediff("actual_completion_date", "planned_completion_date").cast(MONEY)]
    timing = F.when(F.col("planned_start_from").isNull(), "unresolved").when(F.col("notice_date").between(F.col("planned_start_from"), F.col("planned_start_to")), "within").when(F.col("notice_date") < F.col("planned_start_from"), "before").otherwise("after")
    completion = F.when(F.col("all_effective"), "partially_observed").when(F.col("award_count") > 0, "unresolved").otherwise("not_observed")
    return rows.withColumns(dict(zip(DURATIONS, values, strict=True)) | {"start_timing_status": timing, "round_state": F.when(F.col("is_cancelled"), "cancelled").otherwise("in_progress"), "award_completion_state": completion})


def round_documents(notices: DataFrame, awards: DataFrame) -> DataFrame:
    """BIZ-33: documents of each round."""
    n = notices.select("round_business_key", F.lit("notice").alias("document_kind"), F.col("evidence_set_key").alias("document_key"))
    return n.unionByName(awards.filter("round_business_key is not null").select("round_business_key", F.lit("award").alias("document_kind"), F.col("evidence_set_key").alias("document_key"))).distinct()


def opening_context(openings: DataFrame, notices: DataFrame, demand_rows: DataFrame) -> DataFrame:
    """BIZ-34: the latest opening of each notice, with its package's keys and planned price as baseline."""
    last = latest(openings, ["source_id"], [*order(version_number(F.col("source_version")), F.col("observed_at")), F.col("revision_id").desc()])
    n = unique_lookup(last.withColumnRenamed("source_id", "notify_no"), notices, ["notify_no"], ["package_key", "round_business_key"])
    return n.join(demand_rows.select("package_key", "geography_key", "sector_key", "method_key", F.when(F.col("planned_package_amount") > 0, F.col("planned_package_amount")).alias("baseline")), "package_key", "left")


def submission_summary(submissions: DataFrame, context: DataFrame) -> DataFrame:
    """BIZ-35: bidders, results, discounts and amounts of each opening, prices repaired against its baseline.

    Submissions are dealt over all shuffle partitions: all steps up to the summary are one task a partition, which holds much more than it reads, so partitions are not to be put together by what they read."""
    dealt = submissions.repartition(int(submissions.sparkSession.conf.get("spark.sql.shuffle.partitions")), "revision_id")
    rows = dealt.join(context.select("revision_id", "baseline"), "revision_id", "left").withColumns({"bid": norm_bid_price(F.col("bid_price"), F.col("baseline")), "final": norm_bid_price(F.col("final_bid_price"), F.col("baseline"))})
    off = F.col("bid") > F.col("final")
    zero = F.lit(0).cast(MONEY)
    total = lambda c: F.coalesce(F.sum(c), zero).cast(MONEY)
    return rows.groupBy("revision_id").agg(F.countDistinct(F.coalesce("contractor_code", "contractor_name", "submission_id")).alias("bidders"), F.count_if(F.col("tech_result") == "1").alias("tech_passed_count"), F.count_if(F.col("tech_result") == "0").alias("tech_failed_count"), F.count_if((F.col("discount_rate") > 0) | off).alias("discounted_bidder_count"), total(F.coalesce("bid", zero)).alias("total_bid_amount"), total(F.when(off, F.col("bid") - F.col("final")).otherwise(zero)).alias("total_discount_amount"), total(F.coalesce("final", "bid", zero)).alias("total_final_bid_amount"))


def fact_competition(context: DataFrame, summary: DataFrame, declared: str | None = None) -> DataFrame:
    """BIZ-36: one row per opening; the declared number of bidders where no submission is known."""
    rows = context.join(summary, "revision_id", "left")
    n = F.coalesce("bidders", F.col(declared) if declared else F.lit(None).cast("long"), F.lit(0))
    zero = [c for c in summary.columns if c not in ("revision_id", "bidders")]
    return rows.withColumns({"opening_key": F.concat(F.lit("OPN:"), "revision_id"), "opening_count": F.lit(1), "total_bidders": n, "single_bidder_count": (n == 1).cast("int"), "multi_bidder_count": (n >= 2).cast("int")} | {c: F.coalesce(c, F.lit(0)) for c in zero}).drop("bidders")


def input_gates(observations: DataFrame, revisions: dict[str, DataFrame]) -> DataFrame:
    """BIZ-0: (gate, table, rows): repeated or null observation ids, revisions without lineage. All zero if the inputs are sound."""
    ids = observations.groupBy("observation_id").agg(F.count("*").alias("n"))
    one = lambda df, gate, table: df.agg(F.count("*").alias("rows")).select(F.lit(gate).alias("gate"), F.lit(table).alias("table"), "rows")
    parts = [one(ids.filter("n > 1"), "duplicate_id", "observation"), one(ids.filter("observation_id is null"), "null_id", "observation")]
    parts += [one(df.join(observations.select("observation_id"), "observation_id", "left_anti"), "missing_lineage", t) for t, df in revisions.items()]
    return reduce(DataFrame.unionByName, parts)
