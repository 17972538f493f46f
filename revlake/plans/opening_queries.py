"""Queries of the opening family: payloads of all shapes and faults are made from orders and their lines."""

from __future__ import annotations

import re

from pyspark.sql import Window
from pyspark.sql import functions as F

from revlake.plans import openings
from revlake.plans.catalog import query, table
from revlake.plans.chain_queries import bronze
from revlake.plans.rows_queries import orders

K, DAY = "o_orderkey", "o_orderdate"
#: What the queries carry through all steps, so that no join has to bring it back.
SOURCE = ("source_id",)


def text(template: str, **columns):
    """A column of text: ``template`` with each <name> replaced by that column."""
    parts = re.split(r"<(\w+)>", template)
    return F.concat(*(F.lit(p) if i % 2 == 0 else columns[p].cast("string") for i, p in enumerate(parts) if i % 2 or p))


def chosen(by, templates: list[str], **columns):
    """The template with the number ``by``."""
    out = text(templates[-1], **columns)
    for i, t in enumerate(templates[:-1]):
        out = F.when(by == i, text(t, **columns)).otherwise(out)
    return out


NOTICE = '"notify":{"bidNoContractorResponse":{"bidNotification":{"notifyNo":"N<k>","bidName":"T"<more>}}}'
ROUND = '"roundmng":{"bidoBidroundMngViewDTO":{"successBidOpenDate":"<day>T09:00:00","countContractor":<n><tc>}}'
LIST = '{"bidSubmissionByContractorViewResponse":{"bidSubmissionDTOList":[<subs>]<aux>}}'
FREE = LIST.replace("<subs>", "").replace("<aux>", "")


def columns(**more):
    k = F.col(K)
    return {"k": k, "day": F.date_format(DAY, "yyyy-MM-dd"), "n": k % 5, "more": F.lit(""), "tc": F.lit(""), "aux": F.lit("")} | more


@query(f"""
    SELECT CAST({K} AS VARCHAR) AS source_id, CASE {K} % 7 WHEN 0 THEN 'ldt_single_envelope' WHEN 1 THEN 'ldt_two_envelope' WHEN 2 THEN 'ldt_two_envelope' WHEN 3 THEN 'khac_single_envelope' WHEN 4 THEN 'khac_two_envelope' WHEN 5 THEN 'adb_wb_single_envelope' END AS shape,
           CASE WHEN {K} % 7 = 6 THEN 'unknown_opening_shape' ELSE '' END AS codes FROM orders""")
def opening_shapes(spark, sf):
    """SLV-20: the exact set of components, also with a cancellation, decides; a mixture is unknown and an issue."""
    khac = '"bidoNotifyContractorP":{"notifyNo":"N<k>"}'
    templates = [
        "{" + NOTICE + ',"roundmng":{},"bid_open":{},"lot_open_detail":[]}', "{" + NOTICE + ',"roundmng":{},"bid_open_technical":{},"lot_open_detail_technical":[],"cancellation_notice":{}}', "{" + NOTICE + ',"roundmng":{},"bid_open_technical":{},"lot_open_detail_technical":[],"bid_open_financial":null,"lot_open_detail_financial":null}',
        '{"opening_out":{' + khac + "}}", '{"opening_out_technical":{' + khac + '},"opening_out_financial":{}}', '{"opening_adb_wb":{' + NOTICE.partition(":")[2][1:-1] + "}}", "{" + NOTICE + ',"roundmng":{},"bid_open":{},"lot_open_detail_technical":[]}',
    ]
    seen = openings.read(bronze(spark, sf, chosen(F.col(K) % 7, templates, **columns())))
    return openings.revisions(seen.filter("root is not null")).select("source_id", "shape", F.array_join("issues.code", ",").alias("codes"))


@query(f"""
    SELECT CAST({K} AS VARCHAR) AS source_id, CASE {K} % 9 WHEN 0 THEN 'complete' WHEN 2 THEN 'awaiting_financial' WHEN 4 THEN 'complete' END AS collection_status, CAST({K} % 5 AS BIGINT) AS total_bidders,
           CAST(strftime(o_orderdate, '%Y-%m-%d') || ' 02:00:00' AS TIMESTAMP) AS actual_open_date, CASE WHEN {K} % 9 = 6 THEN 'invalid_datetime' ELSE '' END AS codes FROM orders""")
def opening_status(spark, sf):
    """SLV-21: complete, awaiting the financial part, or null where what is there doesn't prove either."""
    single = ["{" + NOTICE + "," + ROUND + ',"bid_open":' + FREE + ',"lot_open_detail":[]}', "{" + NOTICE + "," + ROUND + ',"bid_open":' + FREE + ',"lot_open_detail":[1]}']
    technical = "{" + NOTICE + "," + ROUND + ',"bid_open_technical":' + FREE + ',"lot_open_detail_technical":[]'
    both = technical + ',"bid_open_financial":' + FREE + ',"lot_open_detail_financial":[]}'
    k = F.col(K) % 9
    tc = F.when(k.isin(2, 3), ',"successBidOpenDateTc":null').when(k.isin(4, 5, 8), ',"successBidOpenDateTc":"2024-01-05"').when(k == 6, ',"successBidOpenDateTc":"soon"').otherwise("")
    payload = chosen(k, [*single, technical + "}", both, both, technical + "}", both, technical + "}", both], **columns(tc=tc, more=F.when(k == 8, ',"status":"03"').otherwise("")))
    seen = openings.read(bronze(spark, sf, payload))
    return openings.revisions(seen.filter("root is not null")).select("source_id", "collection_status", "total_bidders", "actual_open_date", F.array_join("issues.code", ",").alias("codes"))


@query(f"""
    WITH p AS (SELECT {K} AS k, unnest(['technical', 'financial']) AS phase FROM orders)
    SELECT CAST(k AS VARCHAR) AS source_id, phase, CASE WHEN phase = 'financial' THEN 'not_fetched' WHEN k % 6 IN (0, 3) THEN 'missing' WHEN k % 6 IN (1, 2) THEN 'null' WHEN k % 6 = 4 THEN 'missing' ELSE 'list' END AS submission_shape,
           CASE WHEN phase = 'technical' THEN CAST(k % 5 AS BIGINT) END AS reported_contractor_count, CASE WHEN phase = 'technical' AND k % 6 = 3 THEN 'invalid_phase_response' WHEN phase = 'technical' AND k % 6 = 4 THEN 'invalid_phase_submissions' ELSE '' END AS codes FROM p""")
def opening_phases(spark, sf):
    """SLV-22: a list that was not fetched, is missing, null or there."""
    states = ["null", '{"bidSubmissionByContractorViewResponse":null}', '{"bidSubmissionByContractorViewResponse":{"bidSubmissionDTOList":null}}', '{"bidSubmissionByContractorViewResponse":7}', '{"bidSubmissionByContractorViewResponse":{"bidSubmissionDTOList":{}}}', FREE]
    payload = chosen(F.col(K) % 6, ["{" + NOTICE + "," + ROUND + ',"bid_open_technical":' + s + ',"lot_open_detail_technical":[]}' for s in states], **columns())
    rows = openings.phases(openings.read(bronze(spark, sf, payload)).filter("root is not null"), carry=SOURCE)
    return rows.select("source_id", "phase", "submission_shape", "reported_contractor_count", F.array_join("issues.code", ",").alias("codes"))


#: Lines of orders, numbered within their order.
LINES = """SELECT l.l_orderkey AS k, ROW_NUMBER() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity) - 1 AS i, l_suppkey AS s, CAST(l_extendedprice AS DECIMAL(18,2)) AS price, CAST(l_quantity AS BIGINT) AS q
           FROM lineitem l JOIN orders ON l_orderkey = o_orderkey"""


def with_lines(spark, sf, line, name="subs", **more):
    """Orders that have lines, and one text column of all their lines' texts in order; ``line`` is a column of (k, i, s, price, q).

    Lines meet their orders once, by a merge join: with that the lines of an order are together, and nothing that follows has to move them. By the size of its file Spark
    would take orders for small and broadcast them, through the driver."""
    o = orders(spark, sf).select(K, DAY)
    rows = table(spark, sf, "lineitem").join(o.hint("merge"), F.col("l_orderkey") == F.col(K))
    place = Window.partitionBy("l_orderkey").orderBy(*(F.asc_nulls_last(c) for c in ("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity")))
    rows = rows.select(F.col("l_orderkey").alias("k"), DAY, (F.row_number().over(place) - 1).alias("i"), F.col("l_suppkey").alias("s"), F.col("l_extendedprice").cast("decimal(18,2)").alias("price"), F.col("l_quantity").cast("bigint").alias("q"))
    texts = {name: line, **more}
    lines = F.array_sort(F.collect_list(F.struct("i", *(c.alias(n) for n, c in texts.items()))))
    joined = rows.groupBy("k").agg(F.min(DAY).alias(DAY), lines.alias("lines"))
    return joined.select(F.col("k").alias(K), DAY, *(F.array_join(F.col("lines")[n], ",").alias(n) for n in texts))


def made(rows, payload):
    out = rows.select(F.col(K).cast("string").alias("source_id"), F.lit("1").alias("source_version"), F.lit("r1").alias("run_id"), F.col(DAY).alias("source_date"), F.lit("2024-01-02").cast("timestamp").alias("ingested_at"), payload.alias("payload"))
    return out.withColumn("content_hash", F.sha2("payload", 256))


@query(f"""
    WITH l AS ({LINES})
    SELECT CAST(k AS VARCHAR) AS source_id, i AS ordinal, CASE WHEN s % 7 <> 0 THEN 'C' || s END AS contractor_code, CAST(CASE WHEN q % 4 <> 0 THEN price END AS DOUBLE) AS bid_price, CAST(CASE WHEN q < 45 THEN q END AS DOUBLE) AS tech_score, s % 7 <> 0 AS accepted,
           CASE WHEN s % 7 = 0 THEN 'missing_contractor_code' WHEN q % 4 = 0 AND q >= 45 THEN 'invalid_numeric,invalid_numeric' WHEN q % 4 = 0 OR q >= 45 THEN 'invalid_numeric' ELSE '' END AS codes FROM l""")
def opening_submissions(spark, sf):
    """SLV-23: a bidder's submission for each line of an order: prices with too many digits behind the point, scores with too many before it, bidders without a code."""
    line = text('{"id":"S<i>","contractorCode":"<c>","bidPrice":"<p>","techScore":<t>}', i=F.col("i"), c=F.when(F.col("s") % 7 != 0, F.concat(F.lit("C"), F.col("s").cast("string"))).otherwise(" "), p=F.when(F.col("q") % 4 == 0, F.concat(F.col("price").cast("string"), F.lit("55555"))).otherwise(F.col("price").cast("string")), t=F.when(F.col("q") >= 45, "1234567890123.5").otherwise(F.col("q").cast("string")))
    rows = with_lines(spark, sf, line)
    seen = openings.read(made(rows, text("{" + NOTICE + "," + ROUND + ',"bid_open":' + LIST + ',"lot_open_detail":[]}', **columns(subs=F.col("subs")))))
    out = openings.submissions(openings.phases(seen.filter("root is not null"), carry=SOURCE), carry=SOURCE)
    shown = lambda c: F.when(F.col("accepted"), F.col(c)).otherwise(F.col(c)).cast("double").alias(c)
    return out.select("source_id", F.col("ordinal").cast("long").alias("ordinal"), "contractor_code", shown("bid_price"), shown("tech_score"), "accepted", F.array_join("issues.code", ",").alias("codes"))


@query(f"""
    WITH l AS ({LINES}), n AS (SELECT k, s, COUNT(*) AS n FROM l GROUP BY ALL)
    SELECT CAST(k AS VARCHAR) AS source_id, i AS ordinal, 'L' || i AS lot_no, 'C' || s AS contractor_code, CAST(price AS DOUBLE) AS lot_price, n = 1 AND s % 3 <> 0 AS linked, CASE WHEN q % 2 = 0 THEN q END AS evaluation_rank,
           CASE WHEN q % 2 = 1 THEN 'invalid_evaluation_rank' ELSE '' END AS codes FROM l JOIN n USING (k, s)""")
def opening_lots(spark, sf):
    """SLV-24: lots in a list of their own; a lot is linked where its bidder has one submission; a third of the bidders has none."""
    code = F.concat(F.lit("C"), F.col("s").cast("string"))
    lot = text('{"lotNo":"L<i>","contractorCode":"<c>","lotPrice":<p>,"ranking":<r>}', i=F.col("i"), c=code, p=F.col("price"), r=F.when(F.col("q") % 2 == 0, F.col("q").cast("string")).otherwise("true"))
    rows = with_lines(spark, sf, text('{"id":"S<i>","contractorCode":"<c>"}', i=F.col("i"), c=F.when(F.col("s") % 3 != 0, code).otherwise("")), lots=lot)
    seen = openings.read(made(rows, text("{" + NOTICE + "," + ROUND + ',"bid_open":' + LIST + ',"lot_open_detail":[<lots>]}', **columns(subs=F.col("subs"), lots=F.col("lots")))))
    of_phase = openings.phases(seen.filter("root is not null"), carry=SOURCE)
    lots, _ = openings.separate_lots(of_phase, openings.submissions(of_phase), carry=SOURCE)
    return lots.select("source_id", F.col("ordinal").cast("long").alias("ordinal"), "lot_no", "contractor_code", F.col("lot_price").cast("double").alias("lot_price"), F.col("submission_id").isNotNull().alias("linked"), "evaluation_rank", F.array_join("issues.code", ",").alias("codes"))


@query(f"""
    WITH l AS ({LINES}), m AS (SELECT *, (k + i) % 6 AS m FROM l)
    SELECT 'lot' AS kind, CAST(k AS VARCHAR) AS source_id, 'C' || i AS name, CAST(price AS DOUBLE) AS lot_price, CAST(CASE WHEN m IN (0, 5) THEN q END AS DOUBLE) AS lot_final_price FROM m
    UNION ALL SELECT CASE m WHEN 0 THEN 'auxiliary_lot_enriched' WHEN 1 THEN 'conflicting_auxiliary_lot' WHEN 2 THEN 'unmatched_auxiliary_lot' WHEN 3 THEN 'invalid_auxiliary_field' WHEN 4 THEN 'unmatched_auxiliary_lot' ELSE 'auxiliary_lot_enriched' END, CAST(k AS VARCHAR),
           'opening_adb_wb.bidSubmissionByContractorViewResponse.bidoLotOpenDetailDTOS[' || i || ']' || CASE WHEN m IN (1, 3) THEN '.lotPrice' ELSE '' END, NULL, NULL FROM m""")
def opening_reconciliation(spark, sf):
    """SLV-25: nested lots with auxiliary details that agree and fill in, by lot or by submission, differ, match nothing, can't be read, or name another submission; lots and issues."""
    i, m = F.col("i"), (F.col("k") + F.col("i")) % 6
    sub = text('{"id":"S<i>","contractorCode":"C<i>","lotNoValueDTOList":[{"lotNo":"L","lotPrice":"<p>"}]}', i=i, p=F.col("price"))
    details = [',"lotPrice":<p>,"lotFinalPrice":<q>', ',"lotPrice":0.01,"lotFinalPrice":<q>', ',"contractorCode":"X<i>"', ',"lotPrice":"x","lotFinalPrice":<q>', ',"bidOpenId":"S999"', ',"bidOpenId":"S<i>","lotFinalPrice":<q>']
    whole = [('{"lotNo":"L","contractorCode":"C<i>"' if "contractorCode" not in d else '{"lotNo":"L"') + d + "}" for d in details]
    rows = with_lines(spark, sf, sub, details=chosen(m, whole, i=i, p=F.col("price"), q=F.col("q")))
    payload = text('{"opening_adb_wb":{' + NOTICE.partition(":")[2][1:-1] + ',"bidoBidroundMngViewDTO":{},' + LIST[1:-1] + "}}", **columns(subs=F.col("subs"), aux=F.concat(F.lit(',"bidoLotOpenDetailDTOS":['), F.col("details"), F.lit("]"))))
    out = openings.openings(made(rows, payload), by=SOURCE)
    lots = out["opening_lot_submission"].select(F.lit("lot").alias("kind"), "source_id", F.col("contractor_code").alias("name"), F.col("lot_price").cast("double").alias("lot_price"), F.col("lot_final_price").cast("double").alias("lot_final_price"))
    none = F.lit(None).cast("double")
    return lots.unionByName(out["quality_issue"].select(F.col("code").alias("kind"), "source_id", F.col("path").alias("name"), none.alias("lot_price"), none.alias("lot_final_price")))
