"""Repairs of amounts against a reference amount (UDF-1, UDF-2), as column expressions on decimals."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(38,6)"
# Divisors tried in order, and sums beyond which an amount without reference isn't believed.
SCALES = [1_000_000, 1_000, 100, 10]
TEN_TRILLION, FIFTY_TRILLION, HALF_TRILLION = 10_000_000_000_000, 50_000_000_000_000, 500_000_000_000


def _down(raw: Column, by: int) -> Column:
    return F.floor(raw / F.lit(by)).cast(MONEY)


def _share(baseline: Column, share: str) -> Column:
    return baseline * F.lit(share).cast("decimal(3,1)")


def _first_scale(raw: Column, baseline: Column, low: str, high: str) -> Column:
    """The amount over the first divisor that brings it between two shares of the baseline, else null."""
    tries = [F.when(_down(raw, s).between(_share(baseline, low), _share(baseline, high)), _down(raw, s)) for s in SCALES]
    return F.coalesce(*tries)


def norm_bid_price(raw: Column, baseline: Column) -> Column:
    """UDF-1: a bid price, scaled down where that explains it, null where nothing does."""
    far = _first_scale(raw, baseline, "0.2", "1.5")
    unknown = F.when((raw > TEN_TRILLION) & (F.floor(raw / 1000) <= HALF_TRILLION), _down(raw, 1000)).when(raw <= FIFTY_TRILLION, raw)
    rules = [(raw.isNull() | (raw <= 0), F.lit(None).cast(MONEY)), (baseline.isNotNull() & (raw <= baseline * 2), raw), (baseline.isNotNull(), far)]
    return reduce(lambda rest, rule: F.when(rule[0], rule[1]).otherwise(rest), reversed(rules), unknown)


def recover_award_amount(raw: Column, baseline: Column) -> Column:
    """UDF-2: an award amount; digits run together with the baseline's are taken apart, others scaled, else it stays."""
    whole = raw.cast("bigint")
    tail = (whole % 1_000_000 * 1000).cast(MONEY)
    joined = (F.floor(raw / 1_000_000) == baseline) & tail.between(_share(baseline, "0.3"), _share(baseline, "1.0"))
    begins = (baseline.cast("bigint") >= 1_000_000) & whole.cast("string").startswith(baseline.cast("bigint").cast("string"))
    far = F.coalesce(F.when(joined, tail), _first_scale(raw, baseline, "0.3", "1.2"), F.when(begins, baseline), raw)
    thousand = F.floor(raw / 1000).cast("bigint")
    unknown = F.when((raw > TEN_TRILLION) & (thousand % 1000 == 0) & (thousand <= HALF_TRILLION), _down(raw, 1000)).otherwise(raw)
    rules = [(raw.isNull() | (raw <= 0), raw), (baseline.isNotNull() & (raw <= baseline * 2), raw), (baseline.isNotNull(), far)]
    return reduce(lambda rest, rule: F.when(rule[0], rule[1]).otherwise(rest), reversed(rules), unknown)
