"""Running values, ranks and interval unions that are carried over parts, version chains, provinces and assembled openings, against brute force."""

import json
import math
import random

import pytest
from pyspark.sql import functions as F

from revlake.operators import assembly, coverage, graph, ledger, positions, profiling, provinces


@pytest.fixture(scope="module")
def rows(spark):
    """One key has two thirds of the rows."""
    rng = random.Random(4)
    made = [(rng.choice(["hot", "hot", "hot", "hot", "a", "b", None, "c"]), i, rng.randint(0, 40), rng.randint(0, 5000), rng.randint(1, 30)) for i in range(3000)]
    made[7] = ("a", 7, None, None, 5)
    return made, spark.createDataFrame(made, "k string, id long, x long, s long, d long").repartition(5)


def test_running_values_equal_a_loop(spark, rows):
    made, df = rows
    found = positions.running(df, ["k"], ["x", "id"], {"n": ("sum", "d", True), "before": ("sum", "d", False), "top": ("max", "s", False)})
    got = {r["id"]: (r["n"], r["before"], r["top"]) for r in found.collect()}
    for k in {r[0] for r in made}:
        total, before, top = 0, None, None
        for _, i, _, s, d in sorted((r for r in made if r[0] == k), key=lambda r: (r[2] is not None, r[2] or 0, r[1])):
            total += d
            assert got[i] == (total, before, top)
            before = total
            top = s if top is None else top if s is None else max(top, s)
    assert positions.running(df.limit(0), ["k"], ["x"], {"n": ("sum", "d", True)}).count() == 0


def test_every_nth_row_is_exact(spark, rows):
    made, df = rows
    order = sorted(made, key=lambda r: (r[2] is not None, r[2] or 0, r[1]))
    assert {r["id"] for r in positions.every_nth(df, ["x", "id"], 7).collect()} == {r[1] for i, r in enumerate(order, 1) if i % 7 == 0}
    assert {r["id"] for r in positions.every_nth(df, ["x", "id"], 7, at_most=3).collect()} == {order[i][1] for i in (6, 13, 20)}
    assert {r["id"]: r["position"] for r in positions.numbered(df, ["x", "id"]).collect()} == {r[1]: i for i, r in enumerate(order, 1)}


def test_ranks_of_hot_keys(spark, rows):
    made, df = rows
    got = {r["k"]: (r["low"], r["mid"], r["p95"]) for r in positions.ranks(df, ["k"], "s", {"low": positions.nearest(0.0), "mid": positions.nearest(0.5), "p95": positions.nearest(0.95)}).collect()}
    for k in {r[0] for r in made}:
        values = sorted(r[3] for r in made if r[0] == k and r[3] is not None)
        assert got[k] == tuple(values[max(0, math.ceil(round(len(values) * q, 9)) - 1)] for q in (0, 0.5, 0.95))
    whole = sorted(r[3] for r in made if r[3] is not None)
    assert positions.ranks(df, [], "s", {"mid": positions.nearest(0.5)}).first()["mid"] == whole[math.ceil(len(whole) / 2) - 1]
    stats = {r["k"]: r for r in profiling.numeric_stats(df.filter("k is not null"), ["k"], F.col("s")).collect()}
    values = sorted(float(r[3]) for r in made if r[0] == "hot")
    assert stats["hot"]["n"] == len(values) and all(stats["hot"][name] == values[int(q * len(values))] for name, q in profiling.RANKS.items())


def test_interval_union_of_hot_keys(spark, rows):
    made, df = rows
    found = df.filter("x is not null").select("k", F.timestamp_seconds("s").alias("a"), F.timestamp_seconds(F.col("s") + F.col("d")).alias("b"))
    got = {r["k"]: r["seconds"] for r in positions.union_length(found, ["k"], "a", "b").collect()}
    for k in {r[0] for r in made}:
        assert got[k] == len({t for r in made if r[0] == k and r[2] is not None for t in range(r[3], r[3] + r[4])})
    attempts = found.select(F.col("k").alias("endpoint"), F.lit(True).alias("ok"), F.lit(1).alias("attempt"), F.lit(5).alias("latency"), F.col("a").alias("started_at"), F.col("b").alias("ended_at")).filter("endpoint = 'hot'")
    assert coverage.request_metrics(attempts).first()["busy_seconds"] == got["hot"]


def test_change_chains(spark):
    edges = spark.createDataFrame([(f"v{i}", f"v{i + 1}", i) for i in range(40)] + [("x", "y", 99)], "from string, to string, n long").repartition(3)
    found = sorted(tuple(r) for r in ledger.change_chain(edges, "v3", "v36").collect())
    assert found == [(i - 2, f"v{i}", f"v{i + 1}", i) for i in range(3, 36)]
    assert [tuple(r) for r in ledger.change_chain(edges, "v0", "v1").collect()] == [(1, "v0", "v1", 0)] and ledger.change_chain(edges, "v5", "v5").count() == 0
    for start, end in (("v5", "v3"), ("v0", "y"), ("v0", "nowhere")):
        with pytest.raises(ValueError, match="no unbroken chain"):
            ledger.change_chain(edges, start, end)
    with pytest.raises(ValueError, match="two changes"):
        ledger.change_chain(edges.union(spark.createDataFrame([("z", "v9", 0)], edges.schema)), "v0", "v2")
    circle = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a")], "from string, to string")
    assert [r["to"] for r in sorted(ledger.change_chain(circle, "a", "c").collect())] == ["b", "c"]
    with pytest.raises(ValueError):
        ledger.change_chain(circle, "q", "c")


def test_provinces_by_every_tier(spark):
    assert provinces.provinces(spark).count() == 63 and provinces.dimension_rows(spark).select("geography_key").distinct().count() == 65
    keys = provinces.province_keys(provinces.provinces(spark), provinces.aliases(spark))
    assert keys.filter("n > 1").count() == 0, "no key leads to two provinces"
    cases = {"79": "HCM", "1": "HNI", "01": "HNI", " hgg2 ": "HGG2", "lson": "LSON", "816": "HGG2", "tp hcm": "HCM", "Đà Nẵng": "DNG", "TP. Đà Nẵng": "DNG", "ba ria - vung tau": "VTU", "Thừa Thiên - Huế": "TTH", "Đắk Lắk": "DLC", "Hòa Bình": "HBH", "07": None, "x": None, "": None, None: None, "824": None, "unknown": None}
    rows = {r["place"]: r for r in provinces.normalise(spark.createDataFrame([(k,) for k in cases], "place string"), "place").collect()}
    assert {k: r["short_code"] for k, r in rows.items()} == cases
    assert [rows[k]["geography_key"] for k in ("824", "unknown", "x", "79")] == ["GEO_MULTI_UNALLOCATED", "GEO_UNKNOWN", None, "GEO_HCM"]
    # A table of the user's in which a key is ambiguous in one tier.
    own = spark.createDataFrame([("10", "AA", "500", "Foo", "r"), ("11", "BB", "501", "Föo", "r")], provinces.PROVINCE)
    got = {r["place"]: (r["gso_code"], r["province_state"]) for r in provinces.normalise(spark.createDataFrame([("foo",), ("AA",), ("?",), ("foo",)], "place string"), "place", provinces.province_keys(own), own).collect()}
    assert got == {"foo": (None, "ambiguous"), "AA": ("10", "resolved"), "?": (None, "unknown")}


def test_assembled_openings(spark):
    part = lambda n=1, **more: {"bidSubmissionByContractorViewResponse": {"bidSubmissionDTOList": [{}] * n}} | more
    lots = [{"notifyId": "id"}]

    def opening(mode="1_HTHS", count=1, version="00", **parts):
        tc = {k: parts.pop(k) for k in ("successBidOpenDateTc",) if k in parts}
        return {"notify": {"bidNoContractorResponse": {"bidNotification": {"notifyVersion": version, "bidMode": mode}}}, "roundmng": {"bidoBidroundMngViewDTO": {"countContractor": count} | tc}} | parts

    technical, financial = {"bid_open_technical": part(), "lot_open_detail_technical": lots}, {"bid_open_financial": part(0), "lot_open_detail_financial": lots}
    cases = [
        (opening("1_MTHS", bid_open=part(), lot_open_detail=lots), None, "complete", []), (opening(successBidOpenDateTc=None, **technical), None, "awaiting_financial", []), (opening(successBidOpenDateTc="2024-01-01", **technical, **financial), None, "complete", []),
        (opening(successBidOpenDateTc="2024-01-01", **technical), None, "complete", ["invalid_component", "invalid_component_list", "invalid_component_list", "unexpected_opening_components"]), (opening(successBidOpenDateTc=5, **technical), None, None, ["unresolved_opening_phase"]), (opening(**technical), None, None, ["unresolved_opening_phase"]), (opening("2_X"), None, None, ["unresolved_opening_phase"]),
        (opening("1_MTHS", 2, " ", bid_open=part(), lot_open_detail=[{"notifyId": "id"}, {}, {"notifyId": "other"}]), None, "complete", ["contractor_count_mismatch", "lot_identity_mismatch", "lot_identity_mismatch", "missing_assembly_version"]),
        (opening(successBidOpenDateTc="2024-01-01", **technical, bid_open_financial={"success": True}, lot_open_detail_financial=[], cancellation_notice={}), "financial_source_conflict", "financial_source_conflict", ["financial_null_with_publication_marker_conflict"]), ({"notify": {"error": "x"}}, None, None, ["invalid_component", "invalid_component", "missing_assembly_version", "missing_component_root", "missing_component_root", "unresolved_opening_phase"]),
    ]
    df = spark.createDataFrame([(i, json.dumps(c[0]), c[1]) for i, c in enumerate(cases)], "i int, payload string, exception string").withColumns({"v": F.try_parse_json("payload"), "context_id": F.lit("id"), "context_mode": F.lit(None).cast("string")})
    got = {r["i"]: (r["collection_status"], sorted(x["code"] for x in r["issues"])) for r in assembly.check(df, [assembly.NOTICE, assembly.ROUND]).collect()}
    assert got == {i: (c[2], c[3]) for i, c in enumerate(cases)}


def test_deeply_nested_json_ends_no_job(spark):
    """Records nested deeper than the parser goes are unreadable and have no hash; others are read."""
    from revlake.functions import coercion

    deep = "[" * 100_000 + "]" * 100_000
    df = spark.createDataFrame([(1, deep), (2, '{"a":[1]}'), (3, "no json")], "i int, p string")
    got = {(r["record"], r["path"]): (r["state"], r["type"]) for r in profiling.flatten_json(df, "i", "p").collect()}
    assert got[1, "$"] == ("unreadable", "unreadable") and got[2, "$.a[]"] == ("populated", "int") and got[3, "$"] == ("populated", "string")
    hashes = {r["i"]: r["h"] for r in df.select("i", coercion.content_hash("p").alias("h")).collect()}
    assert hashes[1] is None and hashes[2] is not None and hashes[3] is None


def test_components_go_on_with_what_is_left(spark, monkeypatch):
    """Links shrink to at most half of their nodes a round, down long paths, hot tokens and circles alike; before, each round joined all links again."""
    path = [(f"n{i:03d}", f"t{j}") for i in range(200) for j in (i, i + 1)]
    hot = [(f"h{i}", "hot") for i in range(50)] + [("h0", "own"), ("alone", "own-too")]
    ring = [(f"r{i}", f"ring{j % 30}") for i in range(30) for j in (i, i + 1)]
    sizes, kept = [], graph._kept

    def counting(df, where):
        out = kept(df, where)
        if "/edges-" in where:
            sizes.append(out.count())
        return out

    monkeypatch.setattr(graph, "_kept", counting)
    found = {r["node"]: r["component"] for r in graph.components(spark.createDataFrame(path + hot + ring, "node string, token string")).collect()}
    assert found == {n: "n000" for n, _ in path} | {n: "h0" for n, _ in hot[:-1]} | {"alone": "alone"} | {n: "r0" for n, _ in ring}
    assert sizes[0] > 200 and sizes[-1] == 0 and all(b <= a / 2 for a, b in zip(sizes, sizes[1:]))
    assert graph.components(spark.createDataFrame([("a", "x"), ("b", "y")], "node string, token string")).filter("node = component").count() == 2


def test_change_chain_takes_versions_out(spark, tmp_path, monkeypatch):
    """Above ``small`` versions each round stores fewer links than the one before, and only the rest is doubled; before, each doubling stored all versions again. Branches and circles don't matter."""
    edges = spark.createDataFrame([(f"v{i}", f"v{i + 1}", i) for i in range(60)] + [(f"v{i}", f"side{i}", -i) for i in range(0, 60, 6)] + [("o1", "o2", 0), ("o2", "o1", 0)], "from string, to string, n int").coalesce(1)
    monkeypatch.setattr(ledger, "scratch", lambda spark, name: str(tmp_path / name))
    found = sorted(tuple(r) for r in ledger.change_chain(edges, "v3", "v55", small=20).collect())
    assert found == [(i - 2, f"v{i}", f"v{i + 1}", i) for i in range(3, 55)]
    sizes = [spark.read.parquet(str(p)).count() for p in sorted((tmp_path / "chain").glob("links-*"))]
    assert len(sizes) > 3 and sizes == sorted(sizes, reverse=True) and sizes[-1] <= 20 and len(list((tmp_path / "chain").glob("jump-*"))) < 5
