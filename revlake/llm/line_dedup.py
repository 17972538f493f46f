"""Repeated passages, found as content-defined chunks of lines. DataFrame functions only.

A rolling hash covers the hashes of a line and of the line before. A line ends a chunk where that is lower than at the line before, and not
higher than at the line after. So boundaries move with the lines when lines are put in before them, and chunks have two lines at least, three on average. A line
of ``LONG_LINE`` words or more is a passage by itself: it is a chunk of its own, whatever stands around it. Chunks that occur twice
anywhere, the same bytes, are removed from all places but the first, by document id, text and place in the document; single short lines, which
only a document's ends or long neighbours can leave over, stay. Occurrences are counted by grouping on (SHA-256, whole chunk), which compares bytes; a task's
copies are combined before the shuffle, so a hot passage stays small.

A document is a pair of id and text, by the first 60 bits of the text's SHA-256, so rows that repeat an id go each by their own text; rows that repeat both are one document and
keep or lose the same chunks. Ids may have any type that has an order. Nulls: a null text counts as empty (one empty line, kept); rows with a null
id are counted but never changed. Other columns are not read, so none can clash. An empty table gives an empty result. Time and memory
grow with a text's length, not with its square.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlake.llm.common import run_dir, stored

#: A line of so many words is a chunk of its own.
LONG_LINE = 50


def with_chunks(rows: DataFrame) -> DataFrame:
    """``rows`` and ``c``, an array of arrays of lines. The rolling hash covers two lines: h[i] + 31 * h[i-1], h the first 28 bits of MD5.

    Each array is a column of its own, as what a lambda names it would otherwise compute again for every element."""
    rows = rows.withColumn("lines", F.split(F.coalesce("text", F.lit("")), "\n", -1))
    rows = rows.withColumn("hashed", F.transform("lines", lambda x: F.conv(F.substring(F.md5(x), 1, 7), 16, 10).cast("long")))
    rows = rows.withColumn("long", F.transform("lines", lambda x: F.regexp_count(x, F.lit(r"[^\x20\x09-\x0D]+")) >= LONG_LINE))
    rows = rows.withColumn("rolled", F.transform("hashed", lambda h, i: h + F.when(i > 0, 31 * F.get("hashed", i - 1)).otherwise(0)))
    last = F.size("lines") - 1
    lowest = lambda r, i: (r < F.get("rolled", i - 1)) & (r <= F.get("rolled", i + 1))
    end = lambda r, i: F.when(lowest(r, i) | F.get("long", i) | F.coalesce(F.get("long", i + 1), F.lit(False)) | (i == last), i + 1)
    rows = rows.withColumn("ends", F.filter(F.transform("rolled", end), lambda e: e.isNotNull()))
    start = lambda k: F.when(k > 0, F.get("ends", k - 1)).otherwise(0)
    rows = rows.withColumn("c", F.transform("ends", lambda e, k: F.slice("lines", start(k) + 1, e - start(k))))
    return rows.withColumn("passage", F.transform("ends", lambda e, k: (e - start(k) >= 2) | F.get("long", e - 1))).drop("hashed", "long", "rolled", "ends")


def line_dedup(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, ``text`` without repeated passages, ``n_lines``, ``removed_lines``, ``removed_chunks``."""
    spark = docs.sparkSession
    at = run_dir(spark, "lines")
    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).withColumn("doc", F.conv(F.substring(F.sha2(F.coalesce("text", F.lit("")), 256), 1, 15), 16, 10).cast("long"))
    # The outer form, as Spark infers a filter on the size of the array from the plain one and computes all of it twice.
    each = with_chunks(base).select("id", "doc", "passage", F.posexplode_outer("c").alias("k", "lines")).filter(F.get("passage", F.col("k")))
    occ = stored(each.select(F.array_join("lines", "\n").alias("chunk"), "id", "doc", "k").withColumn("key", F.unhex(F.sha2("chunk", 256))), f"{at}/chunks")
    # Two different chunks with one SHA-256 would make the join below ambiguous: that ends the job.
    twice = occ.groupBy("key", "chunk").agg(F.count("*").alias("n")).groupBy("key").agg(F.max("n").alias("n"), F.count("*").alias("texts")).filter("n > 1 or texts > 1")
    twice = stored(twice.select(F.when(F.col("texts") == 1, F.col("key")).otherwise(F.raise_error(F.lit("different chunks with one SHA-256")).cast("binary")).alias("key")), f"{at}/repeated")
    # Places in order; rows without an id come last.
    place = F.struct(F.col("id").isNull().alias("none"), "id", "doc", "k")
    some = stored(occ.select("key", "id", "doc", "k", place.alias("place")).join(twice.hint("merge"), "key"), f"{at}/places")
    firsts = stored(some.groupBy("key").agg(F.min("place").alias("first")), f"{at}/firsts")
    gone = some.join(firsts.hint("merge"), "key").filter((F.col("place") != F.col("first")) & F.col("id").isNotNull())
    per_doc = stored(gone.groupBy("id", "doc").agg(F.collect_set("k").alias("gone")), f"{at}/removed")
    whole = with_chunks(base.join(per_doc.hint("merge"), ["id", "doc"], "left"))
    gone = F.coalesce("gone", F.array().cast("array<int>"))
    whole = whole.withColumn("stay", F.array_except(F.sequence(F.lit(0), F.size("c") - 1), gone))
    whole = whole.select("id", F.size("lines").alias("n"), F.flatten(F.transform("stay", lambda k: F.get("c", k))).alias("left"), F.size(gone).alias("removed"))
    return whole.select(F.col("id").alias(id_col), F.array_join("left", "\n").alias("text"), F.col("n").cast("long").alias("n_lines"), (F.col("n") - F.size("left")).cast("long").alias("removed_lines"), F.col("removed").cast("long").alias("removed_chunks"))
