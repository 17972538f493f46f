"""Queries over single fields: cleaning rules, amounts, keys, profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from revlake.functions import amounts, cleaning
from revlake.operators import profiling
from revlake.plans.catalog import query, table
from revlake.plans.rows_queries import MONEY, orders

# Raw texts made of order columns, in both dialects: each rule sees good values, blanks, sentinels and junk.
_RAW = {
    "text": """CASE o_orderkey % 7 WHEN 0 THEN '  ' || o_orderpriority || ' ' WHEN 1 THEN 'N/A' WHEN 2 THEN '' WHEN 3 THEN ' None ' WHEN 4 THEN NULL WHEN 5 THEN 'không' ELSE '00' || CAST(o_orderkey AS STRING) END""",
    "money": """CASE o_orderkey % 8 WHEN 0 THEN CAST(o_orderkey AS STRING) || '.50' WHEN 1 THEN '-' || CAST(o_orderkey AS STRING) WHEN 2 THEN '12.3456789' WHEN 3 THEN '1,000' WHEN 4 THEN NULL WHEN 5 THEN '123456789012345678901234567890123' WHEN 6 THEN ' 7.250000000 ' ELSE 'abc' END""",
    "date": """CASE o_orderkey % 9 WHEN 0 THEN '0222-03-04' WHEN 1 THEN '202-05-06T10:00:00' WHEN 2 THEN '3024-01-02 08:00' WHEN 3 THEN '2066-07-08' WHEN 4 THEN '1984-02-03' WHEN 5 THEN 'soon' WHEN 6 THEN '2031-09-10' WHEN 7 THEN '2024-02-30' ELSE '2024-11-12' END""",
    "flag": """CASE o_orderkey % 6 WHEN 0 THEN 'Yes' WHEN 1 THEN '0' WHEN 2 THEN ' T ' WHEN 3 THEN 'maybe' WHEN 4 THEN '' ELSE 'FALSE' END""",
    "code": """CASE o_orderkey % 4 WHEN 0 THEN '|115|' WHEN 1 THEN '||' WHEN 2 THEN ' 79 ' ELSE 'null' END""",
    "currency": """CASE o_orderkey % 6 WHEN 0 THEN 'vnđ' WHEN 1 THEN 'Dollar' WHEN 2 THEN ' euro ' WHEN 3 THEN 'jpy' WHEN 4 THEN 'n/a' ELSE 'VND' END""",
    "count": """CASE o_orderkey % 5 WHEN 0 THEN CAST(o_orderkey AS STRING) WHEN 1 THEN '-3' WHEN 2 THEN '2.5' WHEN 3 THEN '12' ELSE '' END""",
}


def raw(spark, sf, name: str):
    return table(spark, sf, "orders").select("o_orderkey", F.expr(_RAW[name]).alias("raw"))


def _duck(name: str) -> str:
    return f"(SELECT o_orderkey, {_RAW[name].replace('STRING', 'VARCHAR')} AS raw FROM orders)"


_SENTINEL = "('n/a','na','null','none','unknown','undefined','-','--','chưa có','không có','không')"
_CLEAN = f"CASE WHEN lower(trim(raw)) IN {_SENTINEL} OR trim(raw) = '' THEN NULL ELSE trim(raw) END"


@query(f"""SELECT o_orderkey, {_CLEAN} AS cleaned, trim(raw) <> '' AS filled FROM {_duck("text")}""")
def clean_text(spark, sf):
    return raw(spark, sf, "text").select("o_orderkey", cleaning.clean_text(F.col("raw")).alias("cleaned"), F.when(F.col("raw").isNotNull(), cleaning.not_blank(F.col("raw"))).alias("filled"))


@query(f"""SELECT o_orderkey, CASE WHEN upper({_CLEAN}) IN ('N/A','NA','NULL','NONE') THEN NULL ELSE {_CLEAN} END AS reference FROM {_duck("code")}""")
def clean_reference(spark, sf):
    return raw(spark, sf, "code").select("o_orderkey", cleaning.clean_reference(F.col("raw")).alias("reference"))


@query(f"""
    SELECT o_orderkey, CASE WHEN o_orderkey % 8 IN (0, 1, 6) THEN CAST(trim(raw) AS DECIMAL(38,6)) END AS amount,
           CASE o_orderkey % 8 WHEN 2 THEN 'money_scale' WHEN 3 THEN 'invalid_money' WHEN 5 THEN 'money_magnitude' WHEN 7 THEN 'invalid_money' END AS issue FROM {_duck("money")}""")
def money_parse(spark, sf):
    value, issue = cleaning.parse_money(F.col("raw"))
    return raw(spark, sf, "money").select("o_orderkey", value.alias("amount"), issue.alias("issue"))


@query("""
    SELECT o_orderkey, CAST(CASE o_orderkey % 9 WHEN 0 THEN '2022-03-04' WHEN 1 THEN '2022-05-06' WHEN 2 THEN '2024-01-02' WHEN 3 THEN '2026-07-08' WHEN 4 THEN '1984-02-03' WHEN 6 THEN '2031-09-10' WHEN 8 THEN '2024-11-12' END AS DATE) AS day,
           CAST(CASE o_orderkey % 9 WHEN 0 THEN '2022-03-04' WHEN 1 THEN '2022-05-06' WHEN 2 THEN '2024-01-02' WHEN 3 THEN '2023-07-08' WHEN 4 THEN '1984-02-03' WHEN 6 THEN '2023-09-10' WHEN 8 THEN '2024-11-12' END AS DATE) AS anchored,
           CAST(CASE o_orderkey % 9 WHEN 0 THEN '2022-03-04' WHEN 1 THEN '2022-05-06' WHEN 2 THEN '2024-01-02' WHEN 3 THEN '2026-07-08' WHEN 8 THEN '2024-11-12' END AS DATE) AS bounded,
           CASE WHEN o_orderkey % 9 IN (5, 7) THEN 'invalid_date' END AS issue,
           CASE o_orderkey % 9 WHEN 0 THEN 'date_year_repaired_0222_to_2022' WHEN 1 THEN 'date_year_repaired_202_to_2022' WHEN 2 THEN 'date_year_repaired_3024_to_2024' WHEN 3 THEN 'date_year_repaired_2066_to_2026' END AS repair FROM orders""")
def year_repair(spark, sf):
    day, issue = cleaning.parse_date(F.col("raw"))
    anchored, _ = cleaning.parse_date(F.col("raw"), F.lit("2023-01-01"))
    return raw(spark, sf, "date").select("o_orderkey", day.alias("day"), anchored.alias("anchored"), cleaning.bounded_date(F.col("raw")).alias("bounded"), issue.alias("issue"), cleaning.date_repair(F.col("raw")).alias("repair"))


@query("""
    SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN CAST(o_orderdate AS TIMESTAMP) - INTERVAL 7 HOUR WHEN 1 THEN CAST(o_orderdate AS TIMESTAMP) - INTERVAL 2 HOUR ELSE CAST(o_orderdate AS TIMESTAMP) END AS instant FROM orders""")
def local_instants(spark, sf):
    text = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss")
    c = F.when(F.col("o_orderkey") % 3 == 0, text).when(F.col("o_orderkey") % 3 == 1, F.concat(text, F.lit("+02:00"))).otherwise(F.concat(text, F.lit("Z")))
    value, _ = cleaning.parse_instant(c)
    return table(spark, sf, "orders").select("o_orderkey", value.cast("timestamp_ntz").alias("instant"))


@query(f"""SELECT o_orderkey, CASE WHEN lower(trim(raw)) IN ('true','t','1','yes','y') THEN TRUE WHEN lower(trim(raw)) IN ('false','f','0','no','n') THEN FALSE END AS flag, CASE WHEN raw = 'maybe' THEN 'invalid_boolean' END AS issue FROM {_duck("flag")}""")
def boolean_parse(spark, sf):
    value, issue = cleaning.parse_boolean(F.col("raw"))
    return raw(spark, sf, "flag").select("o_orderkey", value.alias("flag"), issue.alias("issue"))


@query(f"""SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN '115' WHEN 2 THEN '79' END AS code FROM {_duck("code")}""")
def pipe_codes(spark, sf):
    return raw(spark, sf, "code").select("o_orderkey", cleaning.clean_pipe_code(F.col("raw")).alias("code"))


@query(f"""SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN 'VND' WHEN 1 THEN 'USD' WHEN 2 THEN 'EUR' WHEN 3 THEN 'JPY' WHEN 5 THEN 'VND' END AS currency FROM {_duck("currency")}""")
def currency_names(spark, sf):
    return raw(spark, sf, "currency").select("o_orderkey", cleaning.clean_currency(F.col("raw")).alias("currency"))


@query(f"""SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN o_orderkey WHEN 3 THEN 12 END AS whole, CASE WHEN o_orderkey % 5 = 3 OR o_orderkey % 5 = 0 AND o_orderkey BETWEEN 1 AND 12 THEN CAST(raw AS BIGINT) END AS month, CASE WHEN o_orderkey % 5 IN (1, 2) THEN 'invalid_number' END AS issue FROM {_duck("count")}""")
def count_parse(spark, sf):
    value, issue = cleaning.parse_count(F.col("raw"))
    month, _ = cleaning.parse_count(F.col("raw"), 1, 12)
    return raw(spark, sf, "count").select("o_orderkey", value.alias("whole"), month.alias("month"), issue.alias("issue"))


@query("""SELECT event_id, COALESCE(json_extract_string(props, '$.zz'), json_extract_string(props, '$.k')) AS found, sha256(props) AS content_hash FROM events""")
def json_paths(spark, sf):
    return table(spark, sf, "events").select("event_id", cleaning.first_path(F.col("props"), "$.zz", "$.k").alias("found"), F.sha2("props", 256).alias("content_hash"))


@query("""SELECT o_orderkey, sha256(to_json(list_value(CAST(o_custkey AS VARCHAR), o_orderstatus, NULL, o_orderpriority))) AS group_key FROM orders""")
def group_key(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", cleaning.digest(F.col("o_custkey"), F.col("o_orderstatus"), F.lit(None), F.col("o_orderpriority")).alias("group_key"))


@query("""SELECT n_nationkey, 'THANH PHO HO CHI MINH ' || n_name AS name FROM nation""")
def name_normaliser(spark, sf):
    return table(spark, sf, "nation").select("n_nationkey", cleaning.normalised_name(F.concat(F.lit("  Thành phố   Hồ Chí Minh "), F.lower("n_name"))).alias("name"))


_AMOUNTS = """
    a AS (SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_extendedprice AS DECIMAL(38,6)) * CASE l_orderkey % 5 WHEN 0 THEN 1 WHEN 1 THEN 10 WHEN 2 THEN 100 WHEN 3 THEN 1000 ELSE 1000000 END AS x,
                 CASE WHEN l_linenumber = 7 THEN NULL ELSE CAST(CAST(p_retailprice * l_quantity AS DECIMAL(18,2)) AS DECIMAL(38,6)) END AS b FROM lineitem JOIN part ON l_partkey = p_partkey),
    n AS (SELECT l_orderkey, l_linenumber, l_partkey, CAST(x AS DECIMAL(38,6)) AS x, b, floor(x / 1000000) AS m, floor(x / 1000) AS k, floor(x / 100) AS c, floor(x / 10) AS d FROM a)"""


@query(f"""
    WITH {_AMOUNTS}
    SELECT l_orderkey, l_linenumber, l_partkey, CAST(CASE WHEN x <= 0 THEN NULL WHEN b IS NOT NULL AND x <= b * 2 THEN x
        WHEN b IS NOT NULL THEN CASE WHEN m BETWEEN b * 0.2 AND b * 1.5 THEN m WHEN k BETWEEN b * 0.2 AND b * 1.5 THEN k WHEN c BETWEEN b * 0.2 AND b * 1.5 THEN c WHEN d BETWEEN b * 0.2 AND b * 1.5 THEN d END
        WHEN x > 10000000000000 AND k <= 500000000000 THEN k WHEN x <= 50000000000000 THEN x END AS DECIMAL(38,6)) AS price FROM n""")
def bid_price_norm(spark, sf):
    return _amounts(spark, sf).select("l_orderkey", "l_linenumber", "l_partkey", amounts.norm_bid_price(F.col("x"), F.col("b")).alias("price"))


@query(f"""
    WITH {_AMOUNTS}, t AS (SELECT *, CAST(x AS BIGINT) % 1000000 * 1000 AS tail FROM n)
    SELECT l_orderkey, l_linenumber, l_partkey, CAST(CASE WHEN b IS NOT NULL AND x <= b * 2 THEN x
        WHEN b IS NOT NULL THEN CASE WHEN m = b AND tail BETWEEN b * 0.3 AND b THEN tail WHEN m BETWEEN b * 0.3 AND b * 1.2 THEN m WHEN k BETWEEN b * 0.3 AND b * 1.2 THEN k WHEN c BETWEEN b * 0.3 AND b * 1.2 THEN c WHEN d BETWEEN b * 0.3 AND b * 1.2 THEN d ELSE x END
        WHEN x > 10000000000000 AND CAST(k AS BIGINT) % 1000 = 0 AND k <= 500000000000 THEN k ELSE x END AS DECIMAL(38,6)) AS amount FROM t""")
def amount_recovery(spark, sf):
    return _amounts(spark, sf).select("l_orderkey", "l_linenumber", "l_partkey", amounts.recover_award_amount(F.col("x"), F.col("b")).alias("amount"))


def _amounts(spark, sf):
    li, p = table(spark, sf, "lineitem"), table(spark, sf, "part")
    k = F.col("l_orderkey") % 5
    by = F.when(k == 0, 1).when(k == 1, 10).when(k == 2, 100).when(k == 3, 1000).otherwise(1_000_000)
    base = (F.col("p_retailprice") * F.col("l_quantity")).cast("decimal(18,2)").cast(MONEY)
    return li.join(p, F.col("l_partkey") == F.col("p_partkey")).select("l_orderkey", "l_linenumber", "l_partkey", (F.col("l_extendedprice").cast(MONEY) * by).cast(MONEY).alias("x"), F.when(F.col("l_linenumber") != 7, base).alias("b"))


@query("""
    SELECT lang, COUNT(*) AS n, MIN(length(text)) AS min_length, MAX(length(text)) AS max_length, CAST(SUM(length(text)) AS BIGINT) AS total_length, COUNT(*) FILTER (text <> trim(text, ' ' || chr(9) || chr(10) || chr(13))) AS padded
    FROM documents WHERE text IS NOT NULL GROUP BY lang""")
def text_stats(spark, sf):
    """Without the counts of letter cases, as the two engines fold some letters differently; a unit test has those."""
    out = profiling.text_stats(table(spark, sf, "documents"), ["lang"], "text").select("lang", "n", "min_length", "max_length", "total_length", "padded")
    return out.withColumns({c: F.col(c).cast("bigint") for c in ("min_length", "max_length")})


@query("""
    SELECT event_type, COUNT(*) AS n, MIN(value) AS min, MAX(value) AS max, COUNT(*) FILTER (value = 0) AS zeros, COUNT(*) FILTER (value < 0) AS negatives,
           list_sort(list(value))[CAST(floor(0.01 * COUNT(*)) AS BIGINT) + 1] AS p1, list_sort(list(value))[CAST(floor(0.05 * COUNT(*)) AS BIGINT) + 1] AS p5, list_sort(list(value))[CAST(floor(0.25 * COUNT(*)) AS BIGINT) + 1] AS p25,
           list_sort(list(value))[CAST(floor(0.5 * COUNT(*)) AS BIGINT) + 1] AS p50, list_sort(list(value))[CAST(floor(0.75 * COUNT(*)) AS BIGINT) + 1] AS p75, list_sort(list(value))[CAST(floor(0.95 * COUNT(*)) AS BIGINT) + 1] AS p95, list_sort(list(value))[CAST(floor(0.99 * COUNT(*)) AS BIGINT) + 1] AS p99,
           CAST(AVG(value) AS DECIMAL(18,4)) AS mean, CAST(stddev_pop(value) AS DECIMAL(18,4)) AS std FROM events GROUP BY event_type""")
def numeric_stats(spark, sf):
    return profiling.numeric_stats(table(spark, sf, "events"), ["event_type"], F.col("value")).withColumns({"mean": F.col("mean").cast("decimal(18,4)"), "std": F.col("std").cast("decimal(18,4)")})


def _flat(spark, sf):
    e = table(spark, sf, "events")
    nested = F.concat(F.lit('{"a":'), "props", F.lit(',"b":['), F.col("user_id").cast("string"), F.lit(',"x",null],"c":"'), F.when(F.col("event_id") % 3 == 0, "").otherwise(F.col("event_type")), F.lit('"}'))
    return profiling.flatten_json(e.select("event_id", nested.alias("payload")), "event_id", "payload")


@query("""
    WITH e AS (SELECT json_extract_string(props, '$.k') AS k, event_id % 3 = 0 AS blank FROM events), n AS (SELECT COUNT(*) AS n FROM e),
    p AS (SELECT '$' AS path, COUNT(*) AS occurrences, 0 AS nulls, 0 AS empties, COUNT(*) AS filled, 'object' AS types FROM e UNION ALL
          SELECT '$.a', COUNT(*), 0, 0, COUNT(*), 'object' FROM e UNION ALL SELECT '$.a.k', COUNT(*), COUNT(*) FILTER (k IS NULL), COUNT(*) FILTER (trim(k) = ''), COUNT(*) FILTER (trim(k) <> ''), 'int' FROM e UNION ALL
          SELECT '$.b', COUNT(*), 0, 0, COUNT(*), 'array' FROM e UNION ALL SELECT '$.b[]', 3 * COUNT(*), COUNT(*), 0, COUNT(*), 'int,null,string' FROM e UNION ALL
          SELECT '$.c', COUNT(*), 0, COUNT(*) FILTER (blank), COUNT(*) FILTER (NOT blank), 'string' FROM e)
    SELECT path, occurrences, types, 1.0::DOUBLE AS present_ratio, nulls / n::DOUBLE AS null_ratio, empties / n::DOUBLE AS empty_ratio, filled / n::DOUBLE AS populated_ratio, 0.0::DOUBLE AS missing_ratio,
           CASE WHEN filled / n::DOUBLE > 0.99 THEN 'Full' WHEN filled / n::DOUBLE >= 0.95 THEN 'Mostly full' WHEN filled / n::DOUBLE >= 0.8 THEN 'Gaps present' ELSE 'Sparse' END AS tier FROM p, n""")
def json_profile(spark, sf):
    n = table(spark, sf, "events").count()
    return profiling.path_metrics(_flat(spark, sf), n).withColumn("types", F.array_join("types", ","))


@query("""
    SELECT '$.a.k' AS path, COUNT(json_extract_string(props, '$.k')) AS values, COUNT(DISTINCT json_extract_string(props, '$.k')) AS distinct_values FROM events UNION ALL SELECT '$.c', COUNT(*), COUNT(DISTINCT event_type) FROM events WHERE event_id % 3 <> 0
    UNION ALL SELECT '$.b[]', 2 * COUNT(*), COUNT(DISTINCT user_id) + 1 FROM events""")
def path_cardinality(spark, sf):
    return profiling.cardinality(_flat(spark, sf)).select("path", "values", "distinct_values")


@query("""
    WITH v AS (SELECT '$.a.k' AS path, json_extract_string(props, '$.k') AS value FROM events UNION ALL SELECT '$.b[]', CAST(user_id AS VARCHAR) FROM events UNION ALL SELECT '$.b[]', 'x' FROM events UNION ALL SELECT '$.c', event_type FROM events WHERE event_id % 3 <> 0),
    c AS (SELECT path, value, COUNT(*) AS count FROM v WHERE value IS NOT NULL GROUP BY ALL),
    r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY path ORDER BY count DESC, value) AS t, ROW_NUMBER() OVER (PARTITION BY path ORDER BY count, value DESC) AS b FROM c)
    SELECT path, value, count FROM r WHERE t <= 10 OR b <= 5""")
def frequent_values(spark, sf):
    return profiling.frequent(_flat(spark, sf)).select("path", "value", "count")


@query("""
    WITH c AS (SELECT COUNT(*) AS n, COUNT(DISTINCT event_type) FILTER (event_id % 3 <> 0) AS types, COUNT(DISTINCT user_id) + 1 AS items FROM events)
    SELECT '$' AS path, 'Nested' AS role, FALSE AS candidate_key FROM c UNION ALL SELECT '$.a', 'Nested', FALSE FROM c UNION ALL SELECT '$.a.k', 'Measure', FALSE FROM c UNION ALL SELECT '$.b', 'Nested', FALSE FROM c
    UNION ALL SELECT '$.b[]', 'Measure', FALSE FROM c UNION ALL SELECT '$.c', 'Attribute', FALSE FROM c""")
def path_roles(spark, sf):
    flat = _flat(spark, sf)
    n = table(spark, sf, "events").count()
    numbers = profiling.numeric_stats(profiling.scalars(flat), ["path"], F.col("value")).select("path", "mean", "max")
    metrics = profiling.path_metrics(flat, n).join(profiling.cardinality(flat), "path", "left").join(numbers, "path", "left")
    return profiling.role(metrics, n).select("path", "role", "candidate_key")


@query("""
    SELECT 'event_id' AS columns, COUNT(*) AS rows, COUNT(DISTINCT event_id) AS distinct_rows, COUNT(*) = COUNT(DISTINCT event_id) AS is_key FROM events UNION ALL
    SELECT 'user_id,event_type', COUNT(*), COUNT(DISTINCT (user_id, event_type)), COUNT(*) = COUNT(DISTINCT (user_id, event_type)) FROM events UNION ALL SELECT 'user_id,ts', COUNT(*), COUNT(DISTINCT (user_id, ts)), COUNT(*) = COUNT(DISTINCT (user_id, ts)) FROM events""")
def candidate_keys(spark, sf):
    return profiling.candidate_keys(table(spark, sf, "events"), [["event_id"], ["user_id", "event_type"], ["user_id", "ts"]])


@query("""SELECT * FROM (VALUES ('dropped', 'dropped_field'), ('kept', 'null_shift'), ('new', 'new_field'), ('kind', 'type_change')) AS t(path, drift) WHERE (SELECT COUNT(*) FROM events) > 0""")
def profile_drift(spark, sf):
    """Profiles of the first and second half of the month: one renames a field, one has more nulls."""
    e = table(spark, sf, "events")
    early = F.to_date("ts") < "2024-01-15"

    def profile(df, fields):
        n = F.lit(1.0) * F.count("*")
        parts = [df.agg(F.lit(name).alias("path"), F.lit(kind).alias("type"), (F.count_if(c.isNull()) / n).alias("null_ratio"), (F.countDistinct(c) / n).alias("cardinality_ratio")) for name, (kind, c) in fields.items()]
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out

    before = profile(e.filter(early), {"kept": ("text", F.col("event_type")), "kind": ("number", F.col("event_type")), "dropped": ("text", F.col("event_type"))})
    after = profile(e.filter(~early), {"kept": ("text", F.when(F.col("event_id") % 2 == 0, F.col("event_type"))), "kind": ("text", F.col("event_type")), "new": ("text", F.col("event_type"))})
    return profiling.drift(before, after)


@query("""SELECT anomaly, CAST(SUM(n) AS BIGINT) AS paths FROM (SELECT 'sentinel' AS anomaly, 1 AS n UNION ALL SELECT 'padding', 1) WHERE (SELECT COUNT(*) FROM orders) > 0 GROUP BY anomaly""")
def path_anomalies(spark, sf):
    flat = raw(spark, sf, "text").select(F.lit("text").alias("path"), F.col("raw").alias("value"))
    return profiling.anomalies(flat).select(F.explode("anomalies").alias("anomaly")).groupBy("anomaly").agg(F.count("*").alias("paths"))
