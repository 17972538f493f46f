"""Owner-keyed contribution ledgers, incremental facts, change replay (INC, FCT-10, VAL)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlake.functions.cleaning import digest
from revlake.operators.graph import scratch
from revlake.operators.sets import replace_rows, symmetric_difference


def with_group_key(df: DataFrame, grain: list[str]) -> DataFrame:
    """FCT-9."""
    return df.withColumn("group_key", digest(*(F.col(c) for c in grain)))


def aggregate(contributions: DataFrame, grain: list[str], measures: dict[str, str]) -> DataFrame:
    """FCT-10, AGG-1: contributions summed by grain; ``measures`` has each measure's type."""
    sums = contributions.groupBy(*grain).agg(*(F.sum(m).cast(t).alias(m) for m, t in measures.items()))
    return with_group_key(sums, grain)


def out_of_scope(contributions: DataFrame, affected: DataFrame, owner: str = "owner_key") -> DataFrame:
    """INC-2: contributions of owners that the run isn't for."""
    return contributions.join(affected.select(owner).distinct(), owner, "left_anti")


def retract(ledger: DataFrame, fact: DataFrame, new: DataFrame, affected: DataFrame, grain: list[str], measures: dict[str, str], owner: str = "owner_key") -> tuple[DataFrame, DataFrame]:
    """INC-1: (ledger, fact) after the affected owners' contributions are replaced by ``new``. Only groups that any old or new contribution
    of these owners touches are summed again; the others keep their rows."""
    owners = affected.select(owner).distinct()
    gone = ledger.join(owners, owner, "left_semi")
    kept = ledger.join(owners, owner, "left_anti")
    after = kept.unionByName(new.select(ledger.columns))
    touched = with_group_key(gone.select(grain).unionByName(new.select(grain)), grain).select("group_key").distinct()
    again = with_group_key(after, grain).join(touched, "group_key", "left_semi")
    return after, fact.join(touched, "group_key", "left_anti").unionByName(aggregate(again, grain, measures).select(fact.columns))


def replace_day(fact: DataFrame, new: DataFrame, day: str, column: str = "report_date") -> DataFrame:
    """INC-3: a snapshot fact keeps other days and takes the observed day whole, even if it is empty now."""
    return fact.filter(~F.col(column).eqNullSafe(F.lit(day).cast("date"))).unionByName(new.filter(F.col(column) == F.lit(day).cast("date")).select(fact.columns))


def affected_owners(impacted: DataFrame, prefixes: dict[str, list[str]]) -> DataFrame:
    """INC-5: owner keys of impacted nodes ("kind:id"): each kind has prefixes, of resolved and unresolved aliases."""
    kind, ident = F.split_part("node", F.lit(":"), F.lit(1)), F.expr("substring(node, instr(node, ':') + 1)")
    maps = F.lit(None).cast("array<string>")
    for k, of in prefixes.items():
        maps = F.when(kind == k, F.array(*(F.lit(p) for p in of))).otherwise(maps)
    return impacted.select(ident.alias("id"), F.explode(maps).alias("p")).select(F.concat("p", F.lit(":"), "id").alias("owner_key")).distinct()


def source_seeds(old: DataFrame, new: DataFrame, node: str) -> DataFrame:
    """INC-6: nodes whose rows differ between two versions of a source."""
    return symmetric_difference(old, new).select(node).distinct()


def unchanged(pairs: list[tuple[DataFrame, DataFrame]]) -> bool:
    """INC-7: whether no source changed, so that a run has nothing to do."""
    return all(symmetric_difference(a, b).isEmpty() for a, b in pairs)


def slice_change(before: DataFrame, after: DataFrame, keys: DataFrame, on: list[str]) -> tuple[DataFrame, DataFrame]:
    """INC-8: before- and after-image of a replaced slice."""
    return before.join(keys, on, "left_semi"), after.join(keys, on, "left_semi")


def change_chain(edges: DataFrame, start: str, end: str, *, small: int = 1_000_000) -> DataFrame:
    """INC-9: (position, from, to), the contiguous edges between two versions in order; none if they are the same. Other columns of ``edges`` come along.

    Versions are walked backwards. A round takes out about a quarter of the versions, none of them next to another: what came after such a version then comes after its predecessor, with the steps
    added. So all rounds together cost a few times the first. ``small`` versions or fewer are walked by pointer doubling; the rounds are then gone back to place what they took out.
    Two edges to one version are a fork, also beside the chain; a version that has none before ``start`` is reached is a gap. Both are errors, as is a circle that ``start`` isn't in."""
    spark, folder = edges.sparkSession, scratch(edges.sparkSession, "chain")
    if edges.groupBy("to").count().filter("count > 1").limit(1).count():
        raise ValueError("two changes lead to one version")
    if start == end:
        return edges.limit(0).select(F.lit(0).cast("long").alias("position"), *edges.columns)

    def kept(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{folder}/{name}")
        return spark.read.schema(df.schema).parquet(f"{folder}/{name}")

    # Each version ``v`` is ``n`` steps behind ``w``, which is before it.
    links = kept(edges.select(F.col("to").alias("v"), F.col("from").alias("w"), F.lit(1).cast("long").alias("n")), "links-0")
    left, taken = links.count(), []
    while left > max(small, 2):
        k = len(taken)
        coin = lambda c: F.xxhash64(F.lit(k), F.col(c)) % 2 == 0  # noqa: B023, E731
        out = coin("v") & ~coin("w") & ~F.col("v").isin(start, end)
        gone = links.filter(out).select(F.col("v").alias("w"), F.col("w").alias("x"), F.col("n").alias("m"))
        both = kept(links.filter(~out).join(gone, "w", "left"), f"both-{k}")
        taken.append(both.filter("m is not null").select("v", "w", "n"))
        shorter = both.select("v", F.coalesce("x", "w").alias("w"), (F.col("n") + F.coalesce("m", F.lit(0))).alias("n"))
        # A circle without ``start`` and ``end`` shrinks to a version that is before itself, and would never go.
        links = kept(shorter.filter((F.col("v") != F.col("w")) | F.col("v").isin(start, end)), f"links-{k + 1}")
        left = links.count()
    jumps = [links]
    while 1 << len(jumps) <= left:
        last = jumps[-1]
        jumps.append(kept(last.join(last.select(F.col("v").alias("w"), F.col("w").alias("x"), F.col("n").alias("m")), "w").select("v", F.col("x").alias("w"), (F.col("n") + F.col("m")).alias("n")), f"jump-{len(jumps)}"))
    # All versions behind ``end``, by their distance: each round doubles them.
    seen = kept(spark.range(1).select(F.lit(end).cast(edges.schema["to"].dataType).alias("v"), F.lit(0).cast("long").alias("back")), "seen")
    for k in reversed(range(len(jumps))):
        seen = kept(seen.unionByName(seen.join(jumps[k], "v").select(F.col("w").alias("v"), (F.col("back") + F.col("n")).alias("back"))), f"seen-{k}")
    far = seen.filter(F.col("v") == F.lit(start)).agg(F.min("back")).first()[0]
    if far is None:
        raise ValueError(f"no unbroken chain from {start} to {end}")
    on = seen.filter(F.col("back") < far)
    for k in reversed(range(len(taken))):
        between = on.join(taken[k], "v").select(F.col("w").alias("v"), (F.col("back") + F.col("n")).alias("back")).filter(F.col("back") < far)
        on = kept(on.unionByName(between), f"on-{k}")
    return edges.join(on.select(F.col("v").alias("to"), (F.lit(far) - F.col("back")).alias("position")), "to").select("position", *edges.columns)


def replay(base: DataFrame, changes: list[tuple[DataFrame, DataFrame]]) -> DataFrame:
    """INC-10: ``base`` with each (before, after) change applied in order."""
    return reduce(lambda t, change: replace_rows(t, *change), changes, base)


def grain_violations(fact: DataFrame, grain: list[str]) -> DataFrame:
    """VAL-1, AGG-15: grains that several rows have, and rows without one."""
    groups = fact.groupBy(*grain).agg(F.count("*").alias("rows"))
    null = reduce(lambda a, b: a | b, (F.col(c).isNull() for c in grain))
    return groups.filter((F.col("rows") > 1) | null).withColumn("violation", F.when(null, "null_grain").otherwise("duplicate_grain"))


def identity_violations(fact: DataFrame, rules: dict[str, str]) -> DataFrame:
    """VAL-1: rows that break a measure identity; ``rules`` has a SQL condition by name, null counts as broken."""
    broken = F.filter(F.array(*(F.when(~F.coalesce(F.expr(rule), F.lit(False)), name) for name, rule in rules.items())), lambda x: x.isNotNull())
    return fact.withColumn("broken", broken).filter(F.size("broken") > 0)


def reconcile(totals: dict[str, tuple[DataFrame, str, DataFrame, str]]) -> DataFrame:
    """VAL-2: (check, fact_total, source_total, difference) for pairs of (fact, measure, source, column)."""
    out = None
    for name, (fact, measure, source, column) in totals.items():
        one = fact.agg(F.sum(measure).cast("decimal(38,6)").alias("fact_total")).crossJoin(source.agg(F.sum(column).cast("decimal(38,6)").alias("source_total")))
        one = one.select(F.lit(name).alias("check"), "fact_total", "source_total", (F.coalesce("fact_total", F.lit(0)) - F.coalesce("source_total", F.lit(0))).cast("decimal(38,6)").alias("difference"))
        out = one if out is None else out.unionByName(one)
    return out
