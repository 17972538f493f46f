"""One query per operator over its whole table, and DuckDB SQL where SQL can express the result."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revlake.llm import bpe, embed_dedup, exact_dedup, fim, html_extract, langid, line_dedup, minhash, packing, quality, runs, url_filter, warc
from revlake.llm.common import run_dir, table

#: From this score on a document is predicted to be of good quality.
QUALITY_SCORE = 0.3


def crc_mod(column: str, n: int):
    return F.crc32(F.col(column).cast("string")) % n


def op1_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = warc.write_archive(table(spark, sf_dir, "pages"), run_dir(spark, "warc"))
    return warc.read_records(spark, path).select(F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    both = bpe.encode(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN, bytes_col="decoded")
    return both.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op4_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_dedup(table(spark, sf_dir, "documents"), percent=85)


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_dedup(table(spark, sf_dir, "documents"))


def op6_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    prototypes = langid.learn(docs.filter(crc_mod("doc_id", 3) != 1))
    found = langid.predict(docs, prototypes)
    return found.select("doc_id", F.coalesce(crc_mod("doc_id", 3) == 1, F.lit(False)).alias("held_out"), "lang_pred", "score")


def scored(spark: SparkSession, docs: DataFrame, labels: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns in ``keep``, with doc_id, and the score of every row of ``docs``; ``labels`` are the rows to learn from."""
    rows = quality.stored(quality.features(docs, keep=keep), f"{run_dir(spark, 'stats')}/stats")
    known = labels.filter("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.max("quality").alias("label"))
    labelled = rows.join(known.hint("merge"), "doc_id").select(F.col("doc_id").alias("id"), "stats", "label")
    labelled = quality.stored(labelled, f"{run_dir(spark, 'labelled')}/labelled")
    return quality.predict(rows, quality.fit(labelled), keep=keep)


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scored(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels").filter(crc_mod("doc_id", 5) != 0))
    return found.select("doc_id", F.coalesce(crc_mod("doc_id", 5) == 0, F.lit(False)).alias("held_out"), "score", (F.col("score") >= QUALITY_SCORE).cast("int").alias("predicted"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(spark, table(spark, sf_dir, "documents"))


def packed(spark: SparkSession, docs: DataFrame) -> DataFrame:
    parts = packing.pieces(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)
    return packing.pack(packing.stored(parts, f"{run_dir(spark, 'pieces')}/pieces"))


def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.near_vectors(table(spark, sf_dir, "embeddings"))


def looped(docs: DataFrame) -> DataFrame:
    """``docs``, of which a tenth, by id, repeats words: each word from number a on becomes one of the p words from there, in turn. Other texts stay."""
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    docs = docs.withColumn("_g", F.when(h % 10 == 0, F.floor(h / 10))).withColumn("_words", F.when(F.col("_g").isNotNull(), words)).withColumn("_n", F.size("_words"))
    docs = docs.withColumn("_a", F.when(F.col("_n") > 0, (F.col("_g") % F.col("_n")).cast("int")))
    docs = docs.withColumn("_p", (1 + F.floor((F.col("_n") - F.col("_a")) / (3 + F.col("_g") % 8))).cast("int"))
    rest = F.col("_n") - F.col("_a")
    again = F.flatten(F.array_repeat(F.slice("_words", F.col("_a") + 1, F.col("_p")), F.ceil(rest / F.col("_p")).cast("int")))
    text = F.array_join(F.concat(F.slice("_words", F.lit(1), F.col("_a")), F.slice(again, F.lit(1), rest)), " ")
    return docs.select(*(F.coalesce(text, "text").alias("text") if c == "text" else c for c in docs.columns if c[0] != "_"))


def op11_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs.periodic_runs(looped(table(spark, sf_dir, "documents")))
    first = F.aggregate("runs", F.lit(None).cast(runs.RUN), lambda best, x: F.when(best.isNull() | (x["length"] * best["period"] > best["length"] * x["period"]), x).otherwise(best))
    lines = F.transform("runs", lambda x: F.concat(F.concat_ws(",", x["start"].cast("string"), x["length"].cast("string"), x["period"].cast("string")), F.lit("\n")))
    found = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), first.alias("b"), F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
    return found.select("doc_id", "n_runs", "b.start", "b.length", "b.period", F.expr("1000 * b.length div b.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")


#: Host, path, verdict.
URL_RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]


def op12_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"), spark.createDataFrame(URL_RULES, url_filter.RULES))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fim.fill_in_middle(table(spark, sf_dir, "documents"))
    hashed = {"output_sha256": F.sha2("output", 256), "restored_sha256": F.sha2(fim.restore(F.col("output"), F.col("form")), 256)}
    return found.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *(c.alias(k) for k, c in hashed.items()))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    import corpus_pipeline

    own = [op1_warc_archive, op2_exact_dedup, op3_bpe, op4_minhash, op5_line_dedup, op6_html_extract, op7_language_id, op8_quality, op9_packing, op10_embedding_dedup, op11_runs, op12_url_filter, op13_fill_in_middle]
    return {f.__name__: f for f in own} | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    return ORACLE


ORACLE = {
    "op1_warc_archive": r"""
        WITH p AS (SELECT page_id, COALESCE(html, '') AS html, MAX(page_id) OVER (PARTITION BY COALESCE(html, '')) AS owner FROM pages),
        q AS (SELECT *, strlen(html) >= 1000 AND owner IS NOT NULL AND page_id IS DISTINCT FROM owner AS again FROM p)
        SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, sha1(html) AS payload_digest,
               CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN again THEN owner END AS refers_to FROM q""",
    "op2_exact_dedup": r"""
        WITH t AS (SELECT doc_id, regexp_replace(COALESCE(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents),
        w AS (SELECT doc_id, t, MIN(doc_id) OVER (PARTITION BY t) AS keep_id, COUNT(*) OVER (PARTITION BY t) AS group_size FROM t)
        SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, sha256(t) AS text_sha256 FROM w""",
    "op5_line_dedup": r"""
        WITH l AS (SELECT ROW_NUMBER() OVER () AS rid, doc_id, sha256(COALESCE(text, '')) AS doc, string_split(COALESCE(text, ''), chr(10)) AS ls FROM documents),
        h AS (SELECT *, list_transform(ls, lambda x: CAST('0x' || substr(md5(x), 1, 7) AS BIGINT)) AS hs, list_transform(ls, lambda x: len(regexp_extract_all(x, '[^\x20\x09-\x0D]+')) >= 50) AS longs FROM l),
        m AS (SELECT *, list_transform(range(1, len(ls) + 1), lambda i: hs[i] + CASE WHEN i > 1 THEN 31 * hs[i - 1] ELSE 0 END) AS rolled FROM h),
        e AS (SELECT *, list_filter(range(1, len(ls) + 1), lambda i: i = len(ls) OR (i > 1 AND rolled[i] < rolled[i - 1] AND rolled[i] <= rolled[i + 1]) OR longs[i] OR COALESCE(longs[i + 1], FALSE)) AS ends FROM m),
        c AS (SELECT rid, doc_id, doc, len(ls) AS n_lines, unnest(list_transform(range(1, len(ends) + 1), lambda k: k)) AS k, ls, ends, longs FROM e),
        d AS (SELECT rid, doc_id, doc, n_lines, k, ls[CASE WHEN k = 1 THEN 1 ELSE ends[k - 1] + 1 END : ends[k]] AS part, longs[ends[k]] AS long FROM c),
        o AS (SELECT *, array_to_string(part, chr(10)) AS chunk, len(part) >= 2 OR long AS passage FROM d),
        r AS (SELECT *, passage AND doc_id IS NOT NULL AND DENSE_RANK() OVER (PARTITION BY passage, chunk ORDER BY doc_id NULLS LAST, doc, k) > 1 AS gone FROM o)
        SELECT doc_id, COALESCE(string_agg(chunk, chr(10) ORDER BY k) FILTER (NOT gone), '') AS text, CAST(MIN(n_lines) AS BIGINT) AS n_lines,
               CAST(COALESCE(SUM(len(part)) FILTER (gone), 0) AS BIGINT) AS removed_lines, COUNT(*) FILTER (gone) AS removed_chunks
        FROM r GROUP BY rid, doc_id""",
    "op13_fill_in_middle": r"""
        WITH t AS (SELECT doc_id, COALESCE(text, '') AS t, sha256('42:' || COALESCE(CAST(doc_id AS VARCHAR), '')) AS x FROM documents),
        u AS (SELECT doc_id, t, regexp_extract_all(t, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u, list_transform(range(4), lambda k: CAST('0x' || substr(x, 8 * k + 1, 8) AS BIGINT)) AS h FROM t),
        f AS (SELECT doc_id, t, u, len(u) AS n, least(h[1] % (len(u) + 1), h[2] % (len(u) + 1)) AS a, greatest(h[1] % (len(u) + 1), h[2] % (len(u) + 1)) AS b,
                     CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h[3] % 100 >= 50 THEN 'plain' WHEN h[4] % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM u),
        p AS (SELECT *, array_to_string(u[1:a], '') AS pre, array_to_string(u[a + 1:b], '') AS mid, array_to_string(u[b + 1:], '') AS suf FROM f)
        SELECT doc_id, n, form, CASE WHEN form != 'plain' THEN length(pre) END AS prefix_chars, CASE WHEN form != 'plain' THEN length(mid) END AS middle_chars,
               sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256, sha256(t) AS restored_sha256 FROM p""",
}
