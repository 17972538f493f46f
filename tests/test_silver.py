import json

from conftest import DATA
from pyspark.sql import functions as F

from revlake.plans import business, catalog, facts, silver


def bronze(spark, payloads, ids=None):
    rows = [(str(ids[i] if ids else i), "1", "r1", json.dumps(p) if p is not None else None) for i, p in enumerate(payloads)]
    df = spark.createDataFrame(rows, "source_id string, source_version string, run_id string, payload string")
    return df.withColumns({"source_date": F.lit("2024-01-02").cast("date"), "ingested_at": F.lit("2024-01-02").cast("timestamp"), "content_hash": F.sha2("payload", 256)})


def solid(x):
    """Tables computed once, so that what is built on them has small plans."""
    if isinstance(x, dict):
        return {k: solid(v) for k, v in x.items()}
    return x.sparkSession.createDataFrame(x.collect(), x.schema)


def test_package_with_children_and_issues(spark):
    good = {"id": "p1", "bidNo": "B1", "bidPrice": "1000.50", "bidPriceUnit": "VND", "planNo": "N/A", "createdDate": "0222-05-06T00:00:00", "bidStartYear": "2024", "bidStartMonth": "13", "bidLocation": json.dumps([{"provCode": "|79|", "provName": "X"}]), "bidpBidLotList": [{"id": "l1", "lotNo": "1", "lotPrice": "5"}, {"lotNo": "2", "lotPrice": "x"}]}
    out = solid(silver.resource(bronze(spark, [good, {"bidNo": "no id"}, None]), silver.PACKAGE, "package"))
    r = out["package_revision"].collect()
    assert len(r) == 1 and str(r[0]["bid_price"]) == "1000.500000" and r[0]["plan_no"] is None and str(r[0]["public_date"]) == "2022-05-06" and r[0]["bid_start_month"] is None
    assert [x["province_code"] for x in out["package_location"].collect()] == ["79"]
    assert sorted((x["ordinal"], x["currency"]) for x in out["package_lot"].collect()) == [(0, "VND"), (1, "VND")]
    assert sorted(x["reason"] for x in out["quarantine"].collect()) == ["missing_identity", "missing_root"]
    codes = {x["code"] for x in out["quality_issue"].collect()}
    assert {"invalid_number", "invalid_money", "date_year_repaired_0222_to_2022", "missing_root", "missing_identity"} <= codes
    assert silver.integrity(out, "package_revision", ["package_lot", "package_location"]).count() == 0


def test_notice_conflicts_are_quarantined(spark):
    ok = {"bidoNotifyContractorM": {"id": "n1", "notifyNo": "T1", "notifyVersion": "1", "bidCloseDate": "2024-02-02T09:00:00", "bidOpenDate": "2024-02-01T09:00:00", "publicDate": "2024-01-01T09:00:00"}}
    bad = {"bidoNotifyContractorM": {"id": "n2", "notifyNo": "T2"}, "bidoNotifyContractorP": {"id": "n2", "notifyNo": "T3"}}
    out = solid(silver.notice_tables({"standard": bronze(spark, [ok, bad], ["n1", "n2"])}))
    assert [x["currency"] for x in out["notice_revision"].collect()] == ["VND"]
    assert {x["code"] for x in out["quality_issue"].collect()} == {"close_after_open", "conflicting_identity"}


def result(i, lots, **more):
    return {"bideContractorInputResultDTO": {"id": i, "notifyNo": "T1", "bidPriceUnit": "VND", "status": "IS_PUBLISH", "publicDate": "2024-03-01", "lotResultDTO": lots} | more}


def test_result_totals_only_when_certain(spark):
    win = lambda p, code="c", **k: {"orgCode": code, "bidResult": 1, "bidWiningPrice": p} | k
    cases = [
        result("r1", [{"lotNo": "1", "contractorList": [win("100"), {"orgCode": "z", "bidResult": "0"}]}, {"lotNo": "2", "contractorList": [win("50.5")]}]),
        result("r2", [{"lotNo": "1", "contractorList": [win("100"), {"orgCode": "z"}]}]),
        result("r3", [{"lotNo": "1", "contractorList": [win("5")]}]),
        result("r4", [{"lotNo": "1", "contractorList": [win("100", ventureCode="v"), win("200", "d", ventureCode="v")]}]),
        result("r5", [{"lotNo": "1", "contractorList": [win("100")]}], bidEstimatePriceUnit="USD"),
    ]
    out = solid(silver.result_tables(bronze(spark, cases)))
    total = {json.loads(r["root_json"])["id"]: None if r["winning_price"] is None else float(r["winning_price"]) for r in out["result_revision"].collect()}
    assert total == {"r1": 150.5, "r2": None, "r3": None, "r4": None, "r5": None}
    assert {"missing_outcome", "unverified_zero_winning_price", "unverified_consortium_allocation", "conflicting_currency"} <= {x["code"] for x in out["quality_issue"].collect()}


def test_from_payloads_to_facts(spark):
    plans = solid(silver.resource(bronze(spark, [{"id": "l1", "planNo": "P1", "investorName": "Inv", "publicDate": "2024-01-01"}]), silver.PLAN, "plan")["plan_revision"])
    packs = [{"id": f"p{i}", "bidNo": f"B{i}", "planId": "x", "planNo": "P1", "bidPrice": str(1000 * (i + 1)), "bidPriceUnit": "VND", "bidField": "XL", "createdDate": "2024-01-05", "bidLocation": [{"provCode": "79"}]} for i in range(3)]
    tables = solid(silver.assemble(solid(silver.resource(bronze(spark, packs), silver.PACKAGE, "package")), "package_revision", ["package_location"]))
    cand = solid(business.candidates(tables["package_revision"].filter("is_current"), "bid_price"))
    geo = business.geography(tables["package_location"])
    res = solid(silver.result_tables(bronze(spark, [result("r1", [{"lotNo": "1", "lotPrice": "1100", "contractorList": [{"orgCode": "c", "bidResult": 1, "bidWiningPrice": "900"}]}], bidNo="B0", decisionDate="2024-02-20")])))
    results = solid(business.package_match(business.candidates(res["result_revision"]), cand))
    seen = solid(silver.notice_tables({"vk_adb": bronze(spark, [{"bidoNotifyContractorP": {"id": "n1", "notifyNo": "T1", "bidNo": "B0", "publicDate": "2024-01-20T00:00:00"}}], ["n1"])})["notice_revision"])
    notices = solid(business.notice_keys(business.package_match(seen, cand)))
    dem = solid(business.demand(cand, plans, geo, notices, results))
    rows = {r["package_key"]: r for r in dem.collect()}
    assert len(rows) == 3 and {r["geography_key"] for r in rows.values()} == {"GEO_79"} and sum(r["award_observation_state"] == "observed" for r in rows.values()) == 1
    items = business.award_items(results, res["award_lot"], notices)
    won = business.winners(items, res["award_contractor"])
    award = solid(business.fact_award(business.resolved_awards(items, business.recipient_summary(won), dem), dem, business.tender_notice(notices, dem, geo).withColumn("notify_no", F.lit("T1"))))
    a = award.collect()
    assert len(a) == 1 and a[0]["award_state"] == "effective" and a[0]["is_amount_eligible"] and a[0]["recipient_allocation_state"] == "single_recipient"
    none = spark.createDataFrame([], "revision_id string, contract_price decimal(38,6)")
    s = business.fact_savings(award, none, "2024-01-01", "2024-12-31").collect()[0]
    assert s["is_descriptive_eligible"] and float(s["descriptive_difference"]) == 200.0 and s["verified_saving"] is None
    fact = facts.build("fact_award_daily", facts.award_contributions(award, "2024-01-01", "2024-12-31"))
    assert fact.count() == 1 and facts.gate("fact_award_daily", fact, facts.award_contributions(award, "2024-01-01", "2024-12-31")).filter("rows > 0").count() == 0
    assert facts.build("fact_demand_daily", facts.demand_contributions(dem, "2024-01-01", "2024-12-31")).agg(F.sum("package_count")).first()[0] == 3


def test_project_places(spark):
    one = {"provCode": "|7|", "provName": "P", "wardName": " W "}
    cases = [{"projectDTO": {"id": "a", "plocation": [one, 3, {}, {"districtCode": "d"}]}}, {"projectDTO": {"id": "b"}, "plocation": json.dumps([one])}, {"projectDTO": {"id": "c", "provCode": "1", "plocation": []}}, {"projectDTO": {"id": "d", "plocation": "here"}}, {"projectDTO": {"id": "e"}}, {"projectDTO": {"id": "f", "plocation": {"x": 1}, "districtName": "D"}}]
    out = silver.project_tables(bronze(spark, cases))
    ids = out["project_revision"].select("revision_id", F.get_json_object("root_json", "$.id").alias("id"))
    got = sorted(tuple(r) for r in out["project_location"].join(ids, "revision_id").select("id", "ordinal", "province_code", "district_code", "district_name", "location_name").fillna("-").collect())
    assert got == [("a", 0, "7", "-", "-", "W, P"), ("a", 3, "-", "d", "-", "-"), ("b", 0, "7", "-", "-", "W, P"), ("c", 0, "1", "-", "-", "-"), ("d", 0, "-", "-", "-", "here"), ("f", 0, "-", "-", "D", "-")]


def test_payloads_are_spread_and_never_broadcast(spark):
    """A file of one row group is one task, and Spark's guess of what is parsed out of payloads is far too small; at 60 times sf0.1 these queries were one task, or broadcast all children."""
    for name in ("silver_locations", "silver_package_lots", "silver_result"):
        plan = catalog.queries()[name](spark, DATA)._jdf.queryExecution().executedPlan().toString()
        assert "Exchange hashpartitioning(o_orderkey" in plan and "Broadcast" not in plan and "SortMergeJoin" in plan


def test_what_is_not_asked_for_is_not_planned(spark):
    """All issues of a contractor and all of a lot are one pass each: payloads were made and parsed in 13 places of this plan. Tables and fields that nobody asks for are left out."""
    plan = catalog.queries()["silver_result_issues"](spark, DATA)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") <= 4
    out = silver.resource(bronze(spark, [{"id": "p1", "bidNo": "B1"}]), silver.PACKAGE, "package", only=["package_revision"], fields=["package_no"])
    assert list(out) == ["package_revision"] and "package_no" in out["package_revision"].columns and "title" not in out["package_revision"].columns
