"""Recursive profiles of JSON payloads, and drift between them (PRF, AGG-11..14)."""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revlake.functions.cleaning import SENTINELS, strip
from revlake.operators import positions

#: Parts that a path's values are dealt over before the frequent ones are ranked.
SALTS = 64
#: Leaves and containers in an Arrow batch that a record's walk sends back.
ROWS = 10_000


def walk(text: str | None) -> Iterator[tuple[str, str | None, str, str]]:
    """(path, value, state, type) of every node of a JSON text, the root "$" first; one that isn't JSON is a string by itself, one that is nested deeper
    than the parser goes is ``unreadable``, so that it is counted and not taken for a string. Containers have no value."""
    try:
        root = json.loads(text, parse_float=_Float, parse_int=_Int, parse_constant=_Float) if text is not None else None
    except ValueError:
        root = text
    except RecursionError:
        yield "$", None, "unreadable", "unreadable"
        return
    stack = [("$", root)]
    while stack:
        path, x = stack.pop()
        if isinstance(x, dict):
            yield path, None, "populated" if x else "empty", "object"
            stack += [(f"{path}.{k}", v) for k, v in reversed(x.items())]
        elif isinstance(x, list):
            yield path, None, "populated" if x else "empty", "array"
            stack += [(f"{path}[]", v) for v in reversed(x)]
        elif x is None:
            yield path, None, "null", "null"
        elif isinstance(x, bool):
            yield path, "true" if x else "false", "populated", "bool"
        elif isinstance(x, _Int):
            yield path, str(x), "populated", "int"
        elif isinstance(x, _Float):
            yield path, str(x), "populated", "float"
        else:
            yield path, x, "populated" if x.strip() else "empty", "string"


class _Int(str):
    """A whole number as it was written."""


class _Float(str):
    """Another number as it was written."""


def flatten_json(df: DataFrame, record: str, payload: str) -> DataFrame:
    """PRF-1, PRF-2: (record, path, value, state, type) of every leaf and container, the root "$" included; items of arrays share the path "name[]".

    Each record is parsed and walked once, in Python tasks on Arrow batches, whatever its depth; text that looks like a date or a time is typed so."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at: list[int] = []
            found: list[tuple] = []
            for i, text in enumerate(b.column(1).to_pylist()):
                for node in walk(text):
                    at.append(i)
                    found.append(node)
                    if len(found) >= ROWS:
                        yield _batch(b, at, found)
                        at, found = [], []
            if found:
                yield _batch(b, at, found)

    schema = T.StructType([T.StructField("record", df.schema[record].dataType), *(T.StructField(c, T.StringType()) for c in ("path", "value", "state", "type"))])
    flat = df.select(F.col(record).alias("record"), F.col(payload).cast("string").alias("payload")).mapInArrow(run, schema)
    text = strip(F.col("value"))
    dated = F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}"), "datetime").when(text.rlike(r"^\d{4}-\d{2}-\d{2}$"), "date").otherwise("string")
    return flat.withColumn("type", F.when(F.col("type") == "string", dated).otherwise(F.col("type")))


def _batch(b: pa.RecordBatch, at: list[int], found: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at, pa.int32())), *(pa.array(c, pa.string()) for c in zip(*found, strict=True))], ["record", "path", "value", "state", "type"])


def path_metrics(flat: DataFrame, records: int) -> DataFrame:
    """PRF-3: per path, the share of records that have it, that have it null, empty or populated, occurrences, types, and a tier."""
    per_record = flat.groupBy("path", "record").agg(*(F.max((F.col("state") == s).cast("int")).alias(s) for s in ("null", "empty", "populated")), F.count("*").alias("occurrences"), F.collect_set("type").alias("types"))
    n = F.lit(float(max(records, 1)))
    out = per_record.groupBy("path").agg(F.count("*").alias("present"), *(F.sum(s).alias(s) for s in ("null", "empty", "populated")), F.sum("occurrences").alias("occurrences"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("types")))).alias("types"))
    out = out.select("path", "occurrences", "types", *((F.col(c) / n).alias(f"{c}_ratio") for c in ("present", "null", "empty", "populated")), (1 - F.col("present") / n).alias("missing_ratio"))
    p = F.col("populated_ratio")
    return out.withColumn("tier", F.when(p > 0.99, "Full").when(p >= 0.95, "Mostly full").when(p >= 0.80, "Gaps present").otherwise("Sparse"))


def scalars(flat: DataFrame) -> DataFrame:
    """Populated values that aren't containers."""
    return flat.filter((F.col("state") == "populated") & F.col("value").isNotNull())


def cardinality(flat: DataFrame) -> DataFrame:
    """PRF-4: distinct populated values and their share of all."""
    return scalars(flat).groupBy("path").agg(F.count("*").alias("values"), F.countDistinct("value").alias("distinct_values")).withColumn("cardinality_ratio", F.col("distinct_values") / F.col("values"))


def frequent(flat: DataFrame, n: int = 10, rare: int = 5) -> DataFrame:
    """PRF-4, AGG-14: the most and the least frequent values of each path; equal counts by value.

    A path's values are ranked in ``SALTS`` parts first, of which only the first few can be among the first of all."""
    counts = scalars(flat).groupBy("path", "value").agg(F.count("*").alias("count"))
    ups, downs = (F.desc("count"), F.asc("value")), (F.asc("count"), F.desc("value"))
    parts = counts.withColumn("part", F.pmod(F.xxhash64("value"), F.lit(SALTS)))
    rank = lambda keys, order: F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    first = parts.withColumns({"top": rank(["path", "part"], ups), "bottom": rank(["path", "part"], downs)}).filter((F.col("top") <= n) | (F.col("bottom") <= rare)).drop("part", "top", "bottom")
    return first.withColumns({"top": rank(["path"], ups), "bottom": rank(["path"], downs)}).filter((F.col("top") <= n) | (F.col("bottom") <= rare))


#: PRF-5: the ranks of numeric profiles.
RANKS = {"p1": 0.01, "p5": 0.05, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p95": 0.95, "p99": 0.99}


def numeric_stats(df: DataFrame, keys: list[str], value: Column) -> DataFrame:
    """PRF-5, AGG-13: exact statistics of numbers; text with thousands separators is read as a number. A rank q is the sorted value at place int(q * n), from 0.

    Values are counted before they are ranked, and the running counts are carried over parts, so no task sees all values of a key."""
    x = F.regexp_replace(value.cast("string"), ",", "").try_cast("double")
    known = df.withColumn("_x", x).filter("_x is not null")
    stats = known.groupBy(*keys).agg(F.count("*").alias("n"), F.min("_x").alias("min"), F.max("_x").alias("max"), F.avg("_x").alias("mean"), F.stddev_pop("_x").alias("std"), F.count_if(F.col("_x") == 0).alias("zeros"), F.count_if(F.col("_x") < 0).alias("negatives"))
    ranks = positions.ranks(known, keys, "_x", {k: lambda n, q=q: F.floor(F.lit(q) * n) for k, q in RANKS.items()})
    return stats.join(ranks, keys)


def text_stats(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """PRF-6: lengths, padding, letter cases."""
    t = F.col(value)
    letters = F.upper(t) != F.lower(t)
    return df.filter(t.isNotNull()).groupBy(*keys).agg(
        F.count("*").alias("n"), F.min(F.length(t)).alias("min_length"), F.max(F.length(t)).alias("max_length"), F.sum(F.length(t)).alias("total_length"), F.count_if(t != strip(t)).alias("padded"),
        F.count_if(letters & (F.upper(t) == t)).alias("upper_case"), F.count_if(letters & (F.lower(t) == t)).alias("lower_case"), F.count_if(letters & (F.upper(t) != t) & (F.lower(t) != t)).alias("mixed_case"), F.count_if(~letters).alias("no_letters"),
    )


# Parts of names that tell a path's role, in the order they are asked.
KEY_NAMES, TIME_NAMES, TEXT_NAMES = ("id", "code", "no"), ("date", "time"), ("name", "desc", "content", "reason")


def role(metrics: DataFrame, records: int) -> DataFrame:
    """PRF-7: what a path is likely for, and whether it may be a key. ``metrics`` joins PRF-3 and PRF-4 and has ``mean`` and ``max`` of numbers, null without any."""
    name = F.lower("path")
    has = lambda parts: reduce(lambda a, b: a | b, (name.contains(p) for p in parts))
    number = F.col("mean").isNotNull() & ((F.col("mean") != 0) | (F.col("max") != 1))
    kind = (
        F.when(has(KEY_NAMES), "Key").when(has(TIME_NAMES), "Timestamp").when(number, "Measure").when(F.col("types") == F.array(F.lit("bool")), "Flag")
        .when(has(TEXT_NAMES), "Free-text").when(F.arrays_overlap("types", F.array(F.lit("object"), F.lit("array"))), "Nested").otherwise("Attribute")
    )
    key = (F.col("distinct_values") == records) & (F.col("populated_ratio") == 1) & (F.col("null_ratio") == 0) & (F.col("empty_ratio") == 0)
    return metrics.withColumns({"candidate_key": F.coalesce(key, F.lit(False)), "role": kind})


def candidate_keys(df: DataFrame, sets: list[list[str]]) -> DataFrame:
    """PRF-8: (columns, rows, distinct_rows, is_key) of sets of columns, in one pass over the data."""
    counts = [F.countDistinct(F.struct(*s)).alias(f"d{i}") for i, s in enumerate(sets)]
    one = df.agg(F.count("*").alias("rows"), *counts)
    each = F.array(*(F.struct(F.lit(",".join(s)).alias("columns"), F.col(f"d{i}").alias("distinct_rows")) for i, s in enumerate(sets)))
    return one.select("rows", F.explode(each).alias("x")).select("x.columns", "rows", "x.distinct_rows", (F.col("rows") == F.col("x.distinct_rows")).alias("is_key"))


def anomalies(flat: DataFrame) -> DataFrame:
    """PRF-9: per path, which oddities its values show."""
    v = F.col("value")
    found = F.array(F.when(F.lower(strip(v)).isin(SENTINELS), "sentinel"), F.when(v != strip(v), "padding"))
    return flat.select("path", F.explode(found).alias("a")).filter("a is not null").groupBy("path").agg(F.array_sort(F.collect_set("a")).alias("anomalies"))


def drift(before: DataFrame, after: DataFrame, *, null_shift: float = 0.10, cardinality_shift: float = 0.20) -> DataFrame:
    """PRF-10: (path, drift) between two profiles with type, null_ratio and cardinality_ratio by path."""
    cols = ["type", "null_ratio", "cardinality_ratio"]
    b = before.select("path", *(F.col(c).alias(f"b_{c}") for c in cols), F.lit(True).alias("_b"))
    a = after.select("path", *(F.col(c).alias(f"a_{c}") for c in cols), F.lit(True).alias("_a"))
    both = F.col("_b") & F.col("_a")
    far = lambda c, by: F.abs(F.col(f"a_{c}") - F.col(f"b_{c}")) >= by
    kinds = F.array(F.when(F.col("_b").isNull(), "new_field"), F.when(F.col("_a").isNull(), "dropped_field"), F.when(both & ~F.col("b_type").eqNullSafe(F.col("a_type")), "type_change"), F.when(both & far("null_ratio", null_shift), "null_shift"), F.when(both & far("cardinality_ratio", cardinality_shift), "cardinality_shift"))
    return b.join(a, "path", "full_outer").select("path", F.explode(kinds).alias("drift")).filter("drift is not null")


def window_drifts(profiles: list[DataFrame], **limits: float) -> DataFrame:
    """PRF-11: drift of each profile against the one before it, numbered."""
    each = [drift(a, b, **limits).withColumn("window", F.lit(i)) for i, (a, b) in enumerate(zip(profiles, profiles[1:], strict=False), 1)]
    return reduce(DataFrame.unionByName, each)


def field_counts(flat: DataFrame, table: str, roots: list[str] = ()) -> DataFrame:
    """PRF-12: fields of each table and how many of them are under the business roots."""
    inside = reduce(lambda a, b: a | b, (F.col("path").startswith(r) for r in roots), F.lit(False))
    return flat.select(table, "path").distinct().groupBy(table).agg(F.count("*").alias("fields"), F.count_if(inside).alias("business_fields"))


def mapping_coverage(metrics: DataFrame, mapping: DataFrame) -> DataFrame:
    """PRF-13: share of records in which each mapped source path is populated; ``mapping`` has (path, target)."""
    return mapping.join(metrics.select("path", "populated_ratio"), "path", "left").select("target", "path", F.coalesce("populated_ratio", F.lit(0.0)).alias("populated_ratio"))
