import pytest
from pyspark.sql import functions as F

from revlake.operators import graph, policies, quality
from revlake.plans import facts, reporting, silver
from revlake.streaming import streams


def test_components_against_union_find(spark):
    import random

    rng = random.Random(3)
    edges = [(f"n{rng.randrange(60)}", f"t{rng.randrange(45)}") for _ in range(70)] + [(f"c{i}", f"k{i}") for i in range(12)] + [(f"c{i + 1}", f"k{i}") for i in range(11)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for n, t in edges:
        parent[root("T" + t)] = root(n)
    groups = {}
    for n, _ in edges:
        groups.setdefault(root(n), set()).add(n)
    want = {n: min(g) for g in groups.values() for n in g}
    got = {r["node"]: r["component"] for r in graph.components(spark.createDataFrame(edges, "node string, token string")).collect()}
    assert got == want
    seeds = spark.createDataFrame([("c0",)], "node string")
    assert {r[0] for r in graph.impact(spark.createDataFrame(edges, "node string, token string"), seeds).collect()} == {f"c{i}" for i in range(12)}


def test_rollup_guards(spark):
    empty = spark.createDataFrame([], "report_date date, geography_key string, sector_key string, value_band_key string, currency_key string, package_count long, eligible_amount_count long, planned_amount_sum decimal(38,6)")
    assert reporting.rollup("fact_demand_daily", empty, "week").count() == 0
    for kw in ({"dimensions": ["sector_key"]}, {"dimensions": ["nothing", "currency_key"]}, {"period": "decade"}):
        with pytest.raises(ValueError):
            reporting.rollup("fact_demand_daily", empty, **kw)
    assert len(facts.FACTS) == 8 and facts.metric_dictionary(spark).count() == 7


def test_bands_agree_with_their_table(spark):
    rows = spark.createDataFrame([(float(x),) for x in (0, 99_999_999, 100_000_000, 5e8, 5e9, 2e10, 1e11, 9e12)], "a double").withColumns({"a": F.col("a").cast("decimal(38,6)"), "currency_key": F.lit("VND")})
    got = policies.apply_bands(rows, "a", policies.value_bands(spark)).withColumn("same", F.col("band_key") == policies.band_of(F.col("a")))
    assert got.filter("same").count() == 8


def test_contract_links_and_exceptions(spark):
    reports = spark.createDataFrame([("a", "1"), ("a", "2"), ("b", "1")], "contract_code string, contract_version string")
    contracts = spark.createDataFrame([("a", "1", "e1")], "contract_code string, contract_version string, entity_id string")
    assert sorted(r["resolution"] for r in silver.link_contracts(reports, contracts).collect()) == ["missing_contract", "missing_contract_version", "resolved"]
    errors = spark.createDataFrame([("x", None), ("y", "{}")], "k string, root string")
    assert [r["k"] for r in silver.unapproved(errors, errors.select("k"), ["k"], F.col("root")).collect()] == ["y"]
    assert quality.day_audit(spark.createDataFrame([("i", "t", "{}", "h"), ("i", "t", "{}", "h")], "i string, t string, payload string, content_hash string"), ["i"], "t", F.lit("t")).filter(F.array_contains("faults", "duplicate_identity")).count() == 2


def test_streams(spark, tmp_path):
    src, out, chk = str(tmp_path / "src"), str(tmp_path / "out"), str(tmp_path / "chk")
    schema = "id string, x int, ingested_at timestamp"
    make = lambda rows: spark.createDataFrame(rows, "id string, x int, t string").select("id", "x", F.col("t").cast("timestamp").alias("ingested_at"))
    from pyspark.sql.types import _parse_datatype_string

    make([("a", 1, "2024-01-01"), ("a", 2, "2024-01-02"), ("b", 1, "2024-01-01")]).coalesce(1).write.mode("append").parquet(src)
    for rows in ([], [("b", 5, "2024-01-03")]):
        if rows:
            make(rows).coalesce(1).write.mode("append").parquet(src)
        streams.start_upsert(streams.read_arrivals(spark, src, _parse_datatype_string(schema)), out, ["id"], chk).awaitTermination()
    assert {(r["id"], r["x"]) for r in streams.upserted(spark, out, _parse_datatype_string(schema)).collect()} == {("a", 2), ("b", 5)}
    q = streams.daily(streams.read_arrivals(spark, src, _parse_datatype_string(schema)), "ingested_at", ["id"], ["x"]).writeStream.format("memory").queryName("daily_x").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.table("daily_x").agg(F.sum("rows")).first()[0] == 4
    d = streams.first_seen(streams.read_arrivals(spark, src, _parse_datatype_string(schema)), ["id"], "ingested_at").writeStream.format("memory").queryName("first_x").outputMode("append").trigger(availableNow=True).start()
    d.awaitTermination()
    assert spark.table("first_x").count() == 2
