from pyspark.sql import functions as F

from revlake.functions import cleaning as C


def values(spark, rule, items):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(items)], "i int, raw string")
    out = rule(F.col("raw"))
    value, issue = out if isinstance(out, tuple) else (out, F.lit(None).cast("string"))
    return [(None if r["v"] is None else str(r["v"]), r["e"]) for r in df.select("i", value.alias("v"), issue.alias("e")).orderBy("i").collect()]


def test_money_is_exact(spark):
    got = values(spark, C.parse_money, ["1.234567", "1.2345678", "0.1000000", " 5 ", "1e3", "", None, "-0", "9" * 32, "9" * 33, "nan"])
    assert got == [("1.234567", None), (None, "money_scale"), ("0.100000", None), ("5.000000", None), ("1000.000000", None), (None, None), (None, None), ("0.000000", None), ("9" * 32 + ".000000", None), (None, "money_magnitude"), (None, "invalid_money")]


def test_year_repairs(spark):
    got = [v for v, _ in values(spark, C.parse_date, ["0222-01-02", "2222-01-02", "203-01-02", "3025-01-02", "2077-01-02", "2034-01-02", "0223-01-02", "0209-01-02", "2229-01-02", "1977-01-02", "2020-13-01"])]
    assert got == ["2022-01-02", "2022-01-02", "2023-01-02", "2025-01-02", "2027-01-02", "2024-01-02", "2023-01-02", "2029-01-02", "2029-01-02", "1977-01-02", None]


def test_anchor_snaps_far_years_only(spark):
    got = [v for v, _ in values(spark, lambda c: C.parse_date(c, F.lit("2021-05-05")), ["2022-01-02", "2023-01-02", "1990-01-02"])]
    assert got == ["2022-01-02", "2021-01-02", "1990-01-02"]


def test_instants_are_local_without_offset(spark):
    got = [v for v, _ in values(spark, C.parse_instant, ["2024-01-01T07:00:00", "2024-01-01T07:00:00Z", "2024-01-01T07:00:00+07:00", "never"])]
    assert got == ["2024-01-01 00:00:00", "2024-01-01 07:00:00", "2024-01-01 00:00:00", None]


def test_text_sentinels_and_names(spark):
    assert [v for v, _ in values(spark, C.clean_text, [" 007 ", "N/A", "--", "Không có", "", None])] == ["007", None, None, None, None, None]
    assert values(spark, C.normalised_name, ["  Thừa Thiên   Huế "])[0][0] == "THUA THIEN HUE"


def test_digest_keeps_nulls(spark):
    import hashlib

    df = spark.createDataFrame([("a", None)], "x string, y string")
    assert df.select(C.digest(F.col("x"), F.col("y"))).first()[0] == hashlib.sha256(b'["a",null]').hexdigest()


def test_money_with_exponents(spark):
    rows = [("1E9",), ("1.5e3",), ("25e-2",), ("1e-7",), ("1E40",), ("1e",), ("-2.50",)]
    v, i = C.parse_money(F.col("x"))
    got = [(None if r["v"] is None else float(r["v"]), r["i"]) for r in spark.createDataFrame(rows, "x string").select(v.alias("v"), i.alias("i")).collect()]
    assert got == [(1e9, None), (1500.0, None), (0.25, None), (None, "money_scale"), (None, "money_magnitude"), (None, "invalid_money"), (-2.5, None)]


def test_json_walk_has_no_depth_limit_and_keeps_types(spark):
    from revlake.operators import profiling

    deep = "{\"a\":" * 200 + "1.50" + "}" * 200
    rows = [(1, deep), (2, "{not json}"), (3, None), (4, '{"s":"123","n":[1,{"x":null}],"d":"2024-01-02","e":{},"b":true," ":" "}')]
    flat = profiling.flatten_json(spark.createDataFrame(rows, "id long, p string"), "id", "p").collect()
    got = {(r["record"], r["path"]): (r["value"], r["state"], r["type"]) for r in flat}
    assert got[1, "$" + ".a" * 200] == ("1.50", "populated", "float") and sum(r["record"] == 1 for r in flat) == 201
    assert got[2, "$"] == ("{not json}", "populated", "string") and got[3, "$"] == (None, "null", "null")
    assert got[4, "$.s"][2] == "string" and got[4, "$.n[].x"] == (None, "null", "null") and got[4, "$.d"][2] == "date" and got[4, "$.e"] == (None, "empty", "object") and got[4, "$.b"] == ("true", "populated", "bool") and got[4, "$. "][1] == "empty"
