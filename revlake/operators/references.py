"""Joins that never multiply rows, lookups with precedence, interval joins, closures (JN)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revlake.functions.cleaning import not_blank
from revlake.operators.graph import scratch

#: Rows that a policy table may have to be broadcast; a larger one goes by the plain join.
BROADCAST_ROWS = 100_000


def bounded(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` marked for broadcasting if it has ``rows`` rows at most, counted no further than that."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def settled(df: DataFrame, name: str = "settled") -> DataFrame:
    """``df`` written once and read back, for broadcasting if it is small: what few rows are needed for then isn't shuffled to meet them."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return bounded(df.sparkSession.read.schema(df.schema).parquet(path))


def wanted(target: DataFrame, key: str, rows: DataFrame) -> DataFrame:
    """The rows of ``target`` whose key ``rows`` has, settled. Where many rows name few keys, a join with them shuffles none of the many."""
    return settled(target.join(rows.select(key).distinct(), key, "left_semi"), "wanted")


def resolve(left: DataFrame, target: DataFrame, *, id_col: str, code_col: str, entity: str, raw_id: str | None, target_code: str, prefix: str = "ref") -> DataFrame:
    """JN-1: ``left`` with ``<prefix>_entity`` and ``<prefix>_state``.

    An id that names one entity wins; an id that names several is ambiguous and never falls back; without an id match, a code that names one
    entity is used. The maps are grouped first, so each join has at most one match a row. Distinct pairs of id and code are resolved, not
    rows, so rows are joined once, and aren't shuffled where there are few pairs."""
    ids = target.select(F.col(entity).cast("string").alias("_id"), F.col(entity).alias("_e"))
    if raw_id:
        ids = ids.unionByName(target.select(F.col(raw_id).cast("string").alias("_id"), F.col(entity).alias("_e")))
    by_id = ids.filter(not_blank(F.col("_id"))).groupBy("_id").agg(F.countDistinct("_e").alias("_n_id"), F.min("_e").alias("_by_id"))
    codes = target.select(F.col(target_code).alias("_code"), F.col(entity).alias("_e")).filter(not_blank(F.col("_code")))
    by_code = codes.groupBy("_code").agg(F.countDistinct("_e").alias("_n_code"), F.min("_e").alias("_by_code"))
    pairs = left.select(F.col(id_col).cast("string").alias("_own_id"), F.col(code_col).alias("_own_code")).distinct()
    both = pairs.join(by_id, F.col("_own_id") == F.col("_id"), "left").join(by_code, F.col("_own_code") == F.col("_code"), "left")
    no_id = F.coalesce(F.col("_n_id"), F.lit(0)) == 0
    found = F.when(F.col("_n_id") == 1, F.col("_by_id")).when(no_id & (F.col("_n_code") == 1), F.col("_by_code"))
    state = F.when(F.col("_n_id") == 1, "id").when(F.col("_n_id") > 1, "ambiguous").when(F.col("_n_code") == 1, "code").when(F.col("_n_code") > 1, "ambiguous").otherwise("unresolved")
    resolved = settled(both.select("_own_id", "_own_code", found.alias(f"{prefix}_entity"), state.alias(f"{prefix}_state")), "resolved")
    same = F.col(id_col).cast("string").eqNullSafe(F.col("_own_id")) & F.col(code_col).eqNullSafe(F.col("_own_code"))
    return left.join(resolved, same, "left").drop("_own_id", "_own_code")


def minted_key(prefix: str, entity: Column, state: Column, text: Column) -> Column:
    """JN-2: the key of a resolved reference, or one that says why there is none."""
    p = F.lit(prefix)
    return F.when(entity.isNotNull(), F.concat(p, F.lit(":"), entity)).otherwise(F.concat(p, F.when(state == "ambiguous", "_AMBIGUOUS:").otherwise("_UNRESOLVED:"), F.coalesce(text, F.lit(""))))


def known_first(unknown: str, *choices: Column) -> Column:
    """JN-3: the first choice that isn't null or ``unknown``; else the first that isn't null."""
    return F.coalesce(*(F.when(c != unknown, c) for c in choices), *choices)


def unique_lookup(left: DataFrame, right: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """JN-4, JN-5: values of ``right`` for keys that it has once; null for keys that it has more often, or not."""
    once = right.groupBy(*keys).agg(F.count("*").alias("_n"), *(F.min(v).alias(v) for v in values)).filter("_n = 1").drop("_n")
    return left.join(once, keys, "left")


def any_key_join(left: DataFrame, right: DataFrame, pairs: list[tuple[str, str]], left_id: str, right_id: str) -> DataFrame:
    """JN-6: distinct (left_id, right_id) that agree on any pair of keys: one equi-join a pair, as an OR would be a nested loop."""
    found = None
    for a, b in pairs:
        one = left.select(F.col(a).alias("_k"), left_id).join(right.select(F.col(b).alias("_k"), right_id), "_k").select(left_id, right_id)
        found = one if found is None else found.unionByName(one)
    return found.distinct()


def touched(rows: DataFrame, keys: list[str], seeds: DataFrame, row_id: str) -> DataFrame:
    """JN-7: ids of rows of which any typed key is in ``seeds`` (family, key): keys become rows, so it is one semi join."""
    long = rows.select(row_id, F.explode(F.array(*(F.struct(F.lit(k).alias("family"), F.col(k).cast("string").alias("key")) for k in keys))).alias("x")).select(row_id, "x.family", "x.key")
    return long.join(seeds, ["family", "key"], "left_semi").select(row_id).distinct()


def interval_join(df: DataFrame, intervals: DataFrame, *, equal: list[str], value: str, low: str, high: str) -> DataFrame:
    """JN-8, JN-9: left join on equal columns and low <= value < high (null high: no end). Policy tables are small, which is checked."""
    i = bounded(intervals).alias("i")
    d = df.alias("d")
    on = [F.col(f"d.{c}") == F.col(f"i.{c}") for c in equal] + [F.col(f"d.{value}") >= F.col(f"i.{low}"), F.col(f"i.{high}").isNull() | (F.col(f"d.{value}") < F.col(f"i.{high}"))]
    condition = on[0]
    for x in on[1:]:
        condition = condition & x
    return d.join(i, condition, "left").select("d.*", *(f"i.{c}" for c in intervals.columns if c not in equal))


def missing_parents(children: DataFrame, present: DataFrame, history: DataFrame, ref: str, key: str) -> DataFrame:
    """JN-10, JN-11: rows of ``history`` that ``children`` refer to and ``present`` hasn't."""
    wanted = children.select(F.col(ref).alias(key)).filter(F.col(key).isNotNull()).distinct().join(present.select(key), key, "left_anti")
    return history.join(wanted, key, "left_semi")


def children_of(children: DataFrame, parents: DataFrame, ref: str, key: str) -> DataFrame:
    """JN-12."""
    return children.join(parents.select(F.col(key).alias(ref)), ref, "left_semi")


def synthetic_parents(children: DataFrame, parents: DataFrame, ref: str, key: str, **fill: Column) -> DataFrame:
    """JN-13: a made row for each reference without a parent, and all parents."""
    lost = children.select(F.col(ref).alias(key)).filter(F.col(key).isNotNull()).distinct().join(parents.select(key), key, "left_anti")
    return parents.unionByName(lost.select(key, *(v.alias(k) for k, v in fill.items())), allowMissingColumns=True)


def orphans(fact: DataFrame, dims: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """JN-14: (foreign_key, orphan_rows), a row for each column that is to be in a dimension."""
    out = None
    for fk, (dim, key) in dims.items():
        one = fact.filter(F.col(fk).isNotNull()).join(dim.select(F.col(key).alias(fk)), fk, "left_anti").agg(F.count("*").alias("orphan_rows")).select(F.lit(fk).alias("foreign_key"), "orphan_rows")
        out = one if out is None else out.unionByName(one)
    return out


def unguarded(rows: DataFrame, key: str, *keep: DataFrame) -> DataFrame:
    """JN-15: rows whose key none of the guards has."""
    for guard in keep:
        rows = rows.join(guard.select(key), key, "left_anti")
    return rows


def diff_records(before: DataFrame, after: DataFrame, key: list[str], value: str) -> DataFrame:
    """JN-16: change of each record: added, removed, changed or same."""
    b = before.select(*key, F.col(value).alias("before"), F.lit(True).alias("_b"))
    a = after.select(*key, F.col(value).alias("after"), F.lit(True).alias("_a"))
    change = F.when(F.col("_b").isNull(), "added").when(F.col("_a").isNull(), "removed").when(~F.col("before").eqNullSafe(F.col("after")), "changed").otherwise("same")
    return b.join(a, key, "full_outer").select(*key, "before", "after", change.alias("change"))
