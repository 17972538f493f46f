"""Versioned policies: value bands, geography, currency (POL, PRJ-19, BIZ-6..9)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Bands of the default policy, in VND; a null end is open.
VALUE_BANDS = [("UNDER_100M", 0, 100_000_000), ("100M_TO_500M", 100_000_000, 500_000_000), ("500M_TO_5B", 500_000_000, 5_000_000_000), ("5B_TO_20B", 5_000_000_000, 20_000_000_000), ("20B_TO_100B", 20_000_000_000, 100_000_000_000), ("OVER_100B", 100_000_000_000, None)]


def value_bands(spark: SparkSession, currency: str = "VND", version: str = "v1") -> DataFrame:
    """BIZ-9: the default policy as a table."""
    rows = ", ".join(f"('{k}', {low}, {'NULL' if high is None else high}, {i})" for i, (k, low, high) in enumerate(VALUE_BANDS, 1))
    return spark.sql(f"SELECT band_key, '{currency}' AS currency_key, '{version}' AS policy_version, CAST(a AS decimal(38,6)) AS min_amount, CAST(b AS decimal(38,6)) AS max_amount, CAST(n AS int) AS band_order FROM VALUES {rows} AS t(band_key, a, b, n)")


def band_of(amount: Column) -> Column:
    """The band of an amount as one expression, for when the default policy is all that is asked."""
    out = F.lit(None).cast("string")
    for key, low, high in VALUE_BANDS:
        out = F.when((amount >= low) & (F.lit(True) if high is None else amount < high), key).otherwise(out)
    return out


def policy_violations(policy: DataFrame, keys: list[str], low: str, high: str) -> DataFrame:
    """POL-2: inverted intervals, and intervals that begin before the one before them ends."""
    w = Window.partitionBy(*keys).orderBy(F.col(low).asc_nulls_first(), F.col(high).asc_nulls_last())
    rows = policy.withColumns({"_end": F.lag(high).over(w), "_n": F.row_number().over(w), "_open": F.lag(F.col(high).isNull()).over(w)})
    fault = F.when(F.col(high) <= F.col(low), "inverted").when((F.col("_n") > 1) & (F.col("_open") | (F.col("_end") > F.col(low))), "overlap")
    return rows.withColumn("violation", fault).filter("violation is not null").drop("_end", "_n", "_open")


def geography_key(provinces: Column) -> Column:
    """BIZ-2: one province, several, or none; from the array of a record's distinct province codes."""
    known = F.filter(provinces, lambda x: x.isNotNull())
    return F.when(F.size(known) > 1, "GEO_MULTI_UNALLOCATED").when(F.size(known) == 1, F.concat(F.lit("GEO_"), F.get(known, F.lit(0)))).otherwise("GEO_UNKNOWN")


def currency_key(code: Column) -> Column:
    return F.coalesce(F.nullif(F.trim(code), F.lit("")), F.lit("CUR_UNKNOWN"))


def method_key(form: Column, mode: Column, domestic: Column, internet: Column, contract: Column, version: str = "v1") -> Column:
    """BIZ-10: a key of five attributes."""
    text = [F.coalesce(c.cast("string"), F.lit("")) for c in (form, mode, domestic, internet, contract)]
    return F.concat(F.lit("MTH:"), F.md5(F.concat_ws("|", *text, F.lit(version))))


def apply_bands(df: DataFrame, amount: str, bands: DataFrame, currency: str = "currency_key") -> DataFrame:
    """POL-1: the band of each row's amount under a policy table; rows without a match have ``BAND_UNKNOWN``."""
    from revlake.operators.references import interval_join

    b = bands.select(F.col("currency_key").alias(currency), "band_key", "min_amount", "max_amount")
    return interval_join(df, b, equal=[currency], value=amount, low="min_amount", high="max_amount").withColumn("band_key", F.coalesce("band_key", F.lit("BAND_UNKNOWN"))).drop("min_amount", "max_amount")
