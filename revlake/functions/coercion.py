"""Typing of text by a declared schema, and hashes of JSON that don't depend on the order of keys."""

from __future__ import annotations

import hashlib
import json

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revlake.functions.cleaning import strip

# Texts of booleans.
TRUE, FALSE = ["true", "1", "t", "yes", "y"], ["false", "0", "f", "no", "n"]
NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def typed(c: Column, source: T.DataType, target: T.DataType) -> Column:
    """``c`` as ``target``, null where it can't be. Text is trimmed first. An integer has no fraction and no boolean is a number;
    a date is the first ten characters; an instant without a zone is UTC; a decimal with a longer fraction is rounded, ties to even
    (of a text with an exponent: away from zero)."""
    if isinstance(target, T.StringType):
        return c.cast("string")
    if isinstance(source, T.BooleanType):
        return c if isinstance(target, T.BooleanType) else F.lit(None).cast(target)
    text = strip(c.cast("string"))
    if isinstance(target, T.BooleanType):
        low = F.lower(text)
        known = F.when(low.isin(TRUE), True).when(low.isin(FALSE), False)
        return c != 0 if isinstance(source, T.IntegralType) else known
    if isinstance(target, T.IntegralType):
        return F.when(text.rlike(r"^[+-]?\d+$"), text.try_cast(target)) if isinstance(source, T.StringType) else c.try_cast(target)
    if isinstance(target, T.DecimalType):
        fraction = F.substring(F.regexp_extract(text, r"\.(\d*)$", 1), target.scale + 1, 1_000)
        cut = F.regexp_replace(text, rf"(\.\d{{{target.scale}}})\d*$", "$1") if target.scale else F.regexp_replace(text, r"\.\d*$", "")
        even = fraction.rlike("^50*$") & F.regexp_extract(cut, r"(\d)\.?$", 1).isin("0", "2", "4", "6", "8", "")
        return F.when(text.rlike(NUMBER), F.when(even, cut).otherwise(text).try_cast(target))
    if isinstance(target, T.DateType) and isinstance(source, T.StringType):
        day = F.substring(text, 1, 10)
        return F.when(day.rlike(r"^\d{4}-\d{2}-\d{2}$"), day.try_cast(target))
    return (text if isinstance(source, T.StringType) else c).try_cast(target)


def coerce(df: DataFrame, schema: T.StructType, key: list[str]) -> tuple[DataFrame, DataFrame]:
    """PRJ-18: ``df`` with the columns of ``schema``, each typed or null, and a row (*key, column, raw_value, issue) for each value that was there
    but couldn't be typed. Blank text stands for nothing in all types but text. Columns that ``df`` lacks are null, others go.

    One projection; the issues are a second one over the same rows, exploded only where something failed."""
    of = {f.name: f.dataType for f in df.schema}
    values = {f.name: typed(F.col(f.name), of[f.name], f.dataType) if f.name in of else F.lit(None).cast(f.dataType) for f in schema}
    rows = df.select(*(c.alias(name) for name, c in values.items()))
    lost = [
        F.when(F.nullif(strip(F.col(f.name).cast("string")), F.lit("")).isNotNull() & values[f.name].isNull(), F.struct(F.lit(f.name).alias("column"), F.col(f.name).cast("string").alias("raw_value"), F.lit(f"not_{f.dataType.typeName()}").alias("issue")))
        for f in schema if f.name in of
    ]
    found = df.select(*key, F.filter(F.array(*lost), lambda x: x.isNotNull()).alias("_lost")).filter(F.size("_lost") > 0)
    return rows, found.select(*key, F.inline("_lost"))


@F.pandas_udf(T.StringType())
def content_hash(payload: pd.Series) -> pd.Series:
    """PRJ-16: SHA-256 of a JSON text with sorted keys and without blanks; null for nulls and for what can't be read as JSON, be it nested deeper than the parser goes. Spark keeps
    the order of keys and has no function that sorts them at every level, so this runs on Arrow batches."""

    def of(text: str | None) -> str | None:
        try:
            if text is None:
                return None
            return hashlib.sha256(json.dumps(json.loads(text), sort_keys=True, ensure_ascii=False, separators=(",", ":")).encode("utf-8", "surrogatepass")).hexdigest()
        except (ValueError, RecursionError):
            return None

    return payload.map(of, na_action="ignore")
