"""From raw documents to packed training sequences: five stages, each an operator of ``revlake.llm``.

``STAGES`` lists (name, function). Each function takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it as Parquet in the shared
folder and reads it again as the next one's docs. Every stage but the last returns the columns of ``documents``.

A stage decides on rows, not on ids: rows with a null ``doc_id`` and rows that repeat one are judged, kept and dropped each by its own text. Of
rows with equal or near texts exactly one stays: the smallest id that no other row has, or else one of the rows with a null or repeated id. Ties and repeated
rows are such rows. Null and empty texts and texts of any length are judged like others, as each stage says. Every stage takes an empty table and gives an empty one; columns
of other names stay, but for ``_row``, ``_shared``, ``_text``, ``_lang`` and ``_cosine``, which the stages use themselves.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revlake.llm import exact_dedup, langid, minhash
from revlake.llm.common import run_dir, stored, table
from revlake.llm.queries import packed, scored

#: A document is dropped for quality under this score: far under the share of good ones, so that clean documents stay.
LEAST_QUALITY = 0.3
#: Numbers of dropped rows that are broadcast at most, 8 bytes each.
BROADCAST_ROWS = 2_000_000


def _with_row(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """``docs`` and ``_row``, a number for each row: its id, or one above all ids where the id is null or not the row's alone."""
    at = run_dir(spark, "rows")
    shared = stored(docs.groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1 or doc_id is null").select("doc_id"), f"{at}/shared")
    if not shared.limit(1).count():
        return docs.withColumn("_row", F.col("doc_id").cast("long"))
    top = max(docs.agg(F.max("doc_id")).first()[0] or 0, 0)
    marked = docs.join(shared.filter("doc_id is not null").withColumn("_shared", F.lit(True)).hint("merge"), "doc_id", "left")
    alone = F.col("doc_id").isNotNull() & F.col("_shared").isNull()
    rows = marked.select(*docs.columns, F.when(alone, F.col("doc_id").cast("long")).otherwise(F.monotonically_increasing_id() + F.lit(top + 1)).alias("_row"))
    # Stored, as the numbers could differ when they are computed again.
    return stored(rows, f"{at}/rows")


def _without(spark: SparkSession, rows: DataFrame, dropped: DataFrame) -> DataFrame:
    """The rows whose ``_row`` is not in ``dropped``, without it. Few numbers are sent to every task, so that texts aren't shuffled; many are joined by a shuffle."""
    dropped = stored(dropped.select("_row"), f"{run_dir(spark, 'dropped')}/dropped")
    few = dropped.count() <= BROADCAST_ROWS
    return rows.join(F.broadcast(dropped) if few else dropped.hint("merge"), "_row", "left_anti").select([c for c in rows.columns if c != "_row"])


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts that score under ``LEAST_QUALITY`` by a model of the labels; null texts score as empty ones. With no labels all score 0.5 and stay."""
    rows = _with_row(spark, docs)
    found = scored(spark, rows, table(spark, sf_dir, "labels"), keep=("doc_id", "_row"))
    return _without(spark, rows, found.filter(F.col("score") < LEAST_QUALITY))


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts in no language: those that are null or have no letter. A low cosine alone says nothing against a text: short ones have few n-grams.
    Where no row has a language, nothing can be learnt, and nothing is dropped."""
    learnt = langid.learn(docs)
    if not learnt.count:
        return docs
    rows = _with_row(spark, docs)
    found = langid.predict(rows, learnt, keep=("_row",))
    return _without(spark, rows, found.filter(F.col("lang_pred") == langid.UNKNOWN))


def distinct_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group of texts that are equal but for white space; null texts are equal to empty ones."""
    rows = _with_row(spark, docs)
    return _without(spark, rows, exact_dedup.exact_dedup(rows, id_col="_row").filter("not kept"))


def distinct_content(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group of near duplicates; texts without words have none and stay."""
    rows = _with_row(spark, docs)
    return _without(spark, rows, minhash.near_dedup(rows, id_col="_row").filter("not kept"))


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each piece of a document, with its sequence and place there; null and empty texts have one piece, the end mark."""
    return packed(spark, docs)


STAGES = [("quality", good_quality), ("language", known_language), ("exact", distinct_texts), ("near", distinct_content), ("packing", sequences)]

#: The stages' models and searches can't be written in SQL; the operators have tests against brute force, the whole run has not.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    at = run_dir(spark, "pipeline")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs, f"{at}/{k}-{name}")
    return docs
