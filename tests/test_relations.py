"""Typing by a schema, content hashes, record contracts and the dimensions that several batches bring."""

import hashlib
from decimal import Decimal

from conftest import rows_of
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revlake.functions import coercion
from revlake.operators import quality
from revlake.plans import business


def test_coercion_edges(spark):
    df = spark.createDataFrame([(1, "0.125", "7.0", True), (2, "0.135", " 12 ", False), (3, "1e2", "", None), (4, "nan", None, True), (5, "99999", "1_0", True)], "k int, d string, i string, b boolean")
    schema = T.StructType([T.StructField("d", T.DecimalType(6, 2)), T.StructField("i", T.IntegerType()), T.StructField("b", T.IntegerType())])
    rows, lost = coercion.coerce(df, schema, ["k"])
    assert [r["d"] for r in rows.collect()] == [Decimal("0.12"), Decimal("0.14"), Decimal("100.00"), None, None]
    assert [r["i"] for r in rows.collect()] == [None, 12, None, None, None]
    assert {tuple(r) for r in lost.filter("column != 'b'").collect()} == {(1, "i", "7.0", "not_integer"), (4, "d", "nan", "not_decimal"), (5, "d", "99999", "not_decimal"), (5, "i", "1_0", "not_integer")}
    assert lost.filter("column = 'b'").count() == 4
    assert coercion.coerce(df.limit(0), schema, ["k"])[1].count() == 0


def test_content_hash(spark):
    df = spark.createDataFrame([(1, '{"b":1,"a":[{"d":2,"c":"é"}]}'), (2, '{ "a":[{"c":"é","d":2}], "b":1 }'), (3, "{no"), (4, None), (5, "null")], "k int, p string")
    got = [r["h"] for r in df.orderBy("k").select(coercion.content_hash("p").alias("h")).collect()]
    want = hashlib.sha256('{"a":[{"c":"é","d":2}],"b":1}'.encode()).hexdigest()
    assert got == [want, want, None, None, hashlib.sha256(b"null").hexdigest()]


def test_contract_of_clean_and_broken_records(spark):
    rows = [(1, '{"id":"1","x":"y"}', "1"), (2, "[]", "2"), (3, '{"id":"1","error":"no"}', "2"), (4, '{"id":"","ident":"4","error":""}', "4"), (5, "{bad", None), (6, None, "6"), (7, '{"id":"7"}', "")]
    out = quality.detail_contract(spark.createDataFrame(rows, "k int, payload string, id string"), [""], {"id": ["id", "ident"]}, least_fields=3, empty_ratio=0.6)
    got = {r["k"]: (r["status"], sorted(i["code"] for i in r["issues"])) for r in out.collect()}
    assert got == {1: ("pass", []), 2: ("fail", ["empty_payload"]), 3: ("fail", ["error_envelope", "identity_mismatch"]), 4: ("warn", ["high_empty_ratio"]), 5: ("fail", ["empty_payload"]), 6: ("fail", ["empty_payload"]), 7: ("unresolved", ["missing_identity_context"])}


def test_contract_price_counts_a_contract_once(spark):
    results = spark.createDataFrame([("r1", "a", "b", "n"), ("r2", None, None, "n"), ("r3", "z", None, None)], "revision_id string, bid_id string, result_id string, notify_no string")
    contracts = spark.createDataFrame([("c1", 5.0, "a", "n"), ("c2", 7.0, "b", None), ("c3", 0.0, "z", None), ("c4", 5.0, None, "n")], "entity_id string, price_after_tax double, result_source_id string, notice_no string")
    assert {tuple(r) for r in business.contract_prices(results, contracts).collect()} == {("r1", 17.0), ("r2", 10.0)}


def test_dimensions_of_batches(spark):
    rows = spark.createDataFrame([("a", "2"), ("a", "1"), ("a", None), ("b", None), (None, "x")], "k string, v string")
    # A row's JSON leaves nulls out, so {"k":"a"} comes after {"k":"a","v":"1"}.
    assert {tuple(r) for r in business.one_per_key(rows, "k").collect()} == {("a", "1"), ("b", None), (None, "x")}
    geo = "geography_key string, province_code string, province_name string, region_name string"
    known = spark.createDataFrame([("GEO_1", "1", "old", None), ("GEO_9", "9", "nine", None)], geo)
    canonical = spark.createDataFrame([("GEO_1", "1", "One", "North")], geo)
    places = spark.createDataFrame([(" 9", "Nine"), ("9", "Neuf"), ("x", "Ex "), ("1", "no"), ("", "none"), (None, None)], "province_code string, province_name string")
    got = business.dim_geography(known, canonical, places, canonical.select(F.col("province_code").alias("raw_code")))
    assert {tuple(r) for r in got.collect()} == {("GEO_1", "1", "One", "North"), ("GEO_9", "9", None, None), ("GEO_X", "X", "Ex", None)}


def test_few_references_are_resolved_without_shuffling_rows(spark):
    from revlake.operators import references, selection

    target = spark.createDataFrame([("e1", "c1"), ("e2", "c2"), ("e3", "c2")], "e string, code string")
    left = spark.createDataFrame([(1, "e1", None), (2, None, "c1"), (3, None, "c2"), (4, None, None), (5, "x", "c1"), (6, "e1", None)], "k int, id string, code string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = references.resolve(left, target, id_col="id", code_col="code", entity="e", raw_id=None, target_code="code")
        assert "SortMergeJoin" not in got._jdf.queryExecution().sparkPlan().toString()
        assert sorted((r["k"], r["ref_entity"], r["ref_state"]) for r in got.collect()) == [(1, "e1", "id"), (2, "e1", "code"), (3, None, "ambiguous"), (4, None, "unresolved"), (5, "e1", "code"), (6, "e1", "id")]
        for keys in (["code"], ["id", "code"]):
            assert rows_of(selection.rare_overlap_count(left, keys)) == rows_of(selection.overlap_count(left, keys))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_submissions_are_dealt_over_all_partitions(spark):
    context = spark.createDataFrame([("r1", None)], "revision_id string, baseline decimal(38,6)")
    one = spark.createDataFrame([("r1", "a", None, "1", None, None, "1", None)], "revision_id string, contractor_code string, contractor_name string, submission_id string, bid_price decimal(38,6), final_bid_price decimal(38,6), tech_result string, discount_rate double")
    summary = business.submission_summary(one, context)
    assert "REPARTITION_BY_NUM" in summary._jdf.queryExecution().sparkPlan().toString()
    assert [(r["bidders"], r["tech_passed_count"]) for r in summary.collect()] == [(1, 1)]
