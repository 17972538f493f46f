"""Rule-based audits of records (DQ)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEVERITY = {"error": 2, "warning": 1}


def rule_matches(rules: dict[str, tuple[dict[str, object], list[dict[str, object]]]]) -> Column:
    """DQ-1: names of the rules whose typed equalities all hold and none of whose exclusions does; ``rules`` has (equal, exclusions) by name."""

    def all_equal(wanted: dict[str, object]) -> Column:
        return reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.lit(v)) for c, v in wanted.items()), F.lit(True))

    each = []
    for name, (equal, exclusions) in rules.items():
        out = reduce(lambda a, b: a | b, map(all_equal, exclusions), F.lit(False))
        each.append(F.when(all_equal(equal) & ~out, F.lit(name)))
    return F.filter(F.array(*each), lambda x: x.isNotNull())


def route(df: DataFrame, rules: dict[str, tuple[dict[str, object], list[dict[str, object]]]]) -> DataFrame:
    """DQ-1: the rule of each row if exactly one matches, else why there is none."""
    m = df.withColumn("_m", rule_matches(rules))
    return m.withColumns({"rule": F.when(F.size("_m") == 1, F.get("_m", F.lit(0))), "routing": F.when(F.size("_m") == 1, "routed").when(F.size("_m") == 0, "no_rule").otherwise("several_rules")}).drop("_m")


def check(df: DataFrame, rules: dict[str, tuple[str, str]]) -> DataFrame:
    """DQ-13, DQ-14: ``issues`` (code, severity) of each row and its worst ``status``; ``rules`` has (SQL condition of the fault, severity)."""
    each = F.array(*(F.when(F.coalesce(F.expr(fault), F.lit(False)), F.struct(F.lit(code).alias("code"), F.lit(severity).alias("severity"))) for code, (fault, severity) in rules.items()))
    out = df.withColumn("issues", F.filter(each, lambda x: x.isNotNull()))
    has = lambda s: F.exists("issues", lambda x: x["severity"] == s)
    return out.withColumn("status", F.when(has("error"), "error").when(has("warning"), "warning").otherwise("ok"))


def detail_contract(df: DataFrame, roots: list[str], aliases: dict[str, list[str]], *, payload: str = "payload", optional: str = "notifyVersion", search_version: bool = False, least_fields: int = 10, empty_ratio: float = 0.8) -> DataFrame:
    """DQ-2: ``issues`` (code, severity, path) of each record's JSON text and its worst ``status``: fail, unresolved, warn or pass.

    ``roots`` are dotted paths where the record may lie, "" the payload itself. ``aliases`` has the names of a field in the record; the
    value that the context expects is in the column of the field's name. All of it is one projection without a shuffle.
    A payload that is null, no object or empty has ``empty_payload`` alone, one without a usable root ``missing_business_root`` alone."""
    none = ["", "[]", "{}"]
    text = F.col(payload)
    is_object = lambda c: c.startswith("{") & (c != "{}")
    lies = F.array(*(F.struct(F.lit(r).alias("path"), F.get_json_object(text, f"$.{r}" if r else "$").alias("root")) for r in roots))
    rows = df.withColumn("_roots", F.filter(lies, lambda x: F.coalesce(is_object(x["root"]), F.lit(False)))).withColumn("_root", F.get("_roots", F.lit(0)))
    values = lambda root, names: F.filter(F.array(*(F.get_json_object(root, f"$.{n}") for n in names)), lambda v: v.isNotNull() & ~v.isin(none))
    path = lambda field: F.concat(F.col("_root.path"), F.lit(f".{field}"))
    issue = lambda rule, code, severity, where="": F.when(F.coalesce(rule, F.lit(False)), F.struct(F.lit(code).alias("code"), F.lit(severity).alias("severity"), (F.lit(where) if isinstance(where, str) else where).alias("path")))
    found = []
    for field, names in aliases.items():
        everywhere = F.flatten(F.transform("_roots", lambda x: values(x["root"], names)))  # noqa: B023
        own = values(F.col("_root.root"), names)
        actual, expected = F.get(own, F.lit(0)), F.nullif(F.col(field).cast("string"), F.lit(""))
        found += [issue(F.size(F.array_distinct(everywhere)) > 1, "conflicting_business_roots", "fail", field), issue(F.size(F.array_distinct(own)) > 1, "conflicting_identity_aliases", "fail", path(field))]
        if field != optional:
            found += [issue(actual.isNull(), "missing_detail_identity", "fail", path(field)), issue(expected.isNull(), "missing_identity_context", "unresolved", field)]
        elif not search_version:
            found.append(issue(actual.isNull(), "missing_detail_version", "fail", path(field)))
        found.append(issue(actual != expected, "identity_mismatch", "fail", path(field)))
    error = F.get_json_object(text, "$.error")
    found.append(issue((error.isNotNull() & ~error.isin([*none, "false", "0"])) | (F.get_json_object(text, "$.success") == "false"), "error_envelope", "fail"))
    fields = F.map_values(F.from_json("_root.root", "map<string,string>"))
    hollow = F.size(F.filter(fields, lambda v: v.isNull() | v.isin(none)))
    found.append(issue((F.size(fields) >= least_fields) & (hollow / F.size(fields) >= empty_ratio), "high_empty_ratio", "warn", F.col("_root.path")))
    all_of = F.filter(F.array(*found), lambda x: x.isNotNull())
    nothing = ~F.coalesce(is_object(F.get_json_object(text, "$")), F.lit(False))
    alone = lambda code: F.array(issue(F.lit(True), code, "fail"))
    out = rows.withColumn("issues", F.when(nothing, alone("empty_payload")).when(F.size("_roots") == 0, alone("missing_business_root")).otherwise(all_of))
    has = lambda s: F.exists("issues", lambda x: x["severity"] == s)
    return out.withColumn("status", F.when(has("fail"), "fail").when(has("unresolved"), "unresolved").when(has("warn"), "warn").otherwise("pass")).drop("_roots", "_root")


def first_pattern(df: DataFrame, patterns: dict[str, str], name: str = "pattern") -> DataFrame:
    """DQ-14: the first exceptional pattern that holds; order matters, the narrower ones go first."""
    out = F.lit(None).cast("string")
    for code, condition in reversed(patterns.items()):
        out = F.when(F.coalesce(F.expr(condition), F.lit(False)), code).otherwise(out)
    return df.withColumn(name, out)


def payload_metrics(flat: DataFrame, payloads: DataFrame) -> DataFrame:
    """DQ-3: bytes, fields, ratios and hashes of the shape and of the pattern of nulls; ``flat`` is PRF-1's, ``payloads`` has (record, payload)."""
    empty = F.col("state") != "populated"
    inner = flat.filter("path != '$'").withColumn("path", F.regexp_replace("path", r"^\$\.?", ""))
    per = inner.groupBy("record").agg(F.count("*").alias("fields"), F.count_if(~empty).alias("populated"), F.array_sort(F.collect_set("path")).alias("p"), F.array_sort(F.collect_set(F.when(empty, F.col("path")))).alias("e"))
    per = per.select("record", "fields", "populated", ((F.col("fields") - F.col("populated")) / F.col("fields")).alias("empty_ratio"), F.sha2(F.to_json("p"), 256).alias("shape_hash"), F.sha2(F.to_json("e"), 256).alias("null_hash"))
    return payloads.select("record", F.octet_length("payload").alias("bytes")).join(per, "record", "left")


def cohort_warnings(df: DataFrame, cohort: list[str], size: str, identity: str, content: str, small: float = 0.25) -> DataFrame:
    """DQ-4, AGG-12: warnings of each row against its cohort: far smaller than the median, or one payload for several identities.

    Cohort medians and payload counts are grouped and joined, so no cohort has to be in one window."""
    medians = df.groupBy(*cohort).agg(F.percentile(size, 0.5).alias("median_size"), F.count("*").alias("cohort_rows"))
    shared = df.groupBy(content).agg(F.countDistinct(identity).alias("identities"))
    rows = df.join(medians, cohort).join(shared, content, "left")
    found = F.array(F.when((F.col("cohort_rows") >= 3) & (F.col(size) < small * F.col("median_size")), "small_payload"), F.when(F.col("identities") > 1, "shared_payload"))
    return rows.withColumn("warnings", F.filter(found, lambda x: x.isNotNull()))


def context_of(df: DataFrame, primary: DataFrame, fallback: DataFrame, key: str, value: str) -> DataFrame:
    """DQ-5: the one match in the primary source, else the one in the fallback; several matches are no context."""
    for name, source in (("_p", primary), ("_f", fallback)):
        df = df.join(source.groupBy(key).agg(F.countDistinct(value).alias(f"{name}n"), F.min(value).alias(f"{name}v")), key, "left")
    none = F.coalesce("_pn", F.lit(0)) == 0
    found = F.when(F.col("_pn") == 1, F.col("_pv")).when(none & (F.col("_fn") == 1), F.col("_fv"))
    state = F.when(found.isNotNull(), "resolved").when(none & (F.coalesce("_fn", F.lit(0)) == 0), "missing").otherwise("ambiguous")
    return df.withColumns({"context": found, "context_state": state}).drop("_pn", "_pv", "_fn", "_fv")


def day_audit(df: DataFrame, identity: list[str], table: str, expected_table: Column, payload: str = "payload", stored_hash: str = "content_hash") -> DataFrame:
    """DQ-6: duplicate identities, rows in the wrong table, hashes that differ."""
    repeated = df.groupBy(*identity).agg(F.count("*").alias("_n"))
    rows = df.join(repeated, identity)
    found = F.array(F.when(F.col("_n") > 1, "duplicate_identity"), F.when(~F.col(table).eqNullSafe(expected_table), "wrong_table"), F.when(~F.col(stored_hash).eqNullSafe(F.sha2(payload, 256)), "content_hash_mismatch"))
    return rows.withColumn("faults", F.filter(found, lambda x: x.isNotNull())).drop("_n")


def audit_summary(audit: DataFrame, dimensions: list[str]) -> DataFrame:
    """DQ-7: (dimension, value, rows) of several dimensions, in one pass."""
    each = F.explode(F.array(*(F.struct(F.lit(d).alias("dimension"), F.col(d).cast("string").alias("value")) for d in dimensions)))
    return audit.select(each.alias("x")).groupBy("x.dimension", "x.value").agg(F.count("*").alias("rows"))


def compare_audits(before: DataFrame, after: DataFrame, key: list[str]) -> DataFrame:
    """DQ-8: (before_status, after_status, outcome, records) of two audits."""
    both = before.select(*key, F.col("status").alias("before_status")).join(after.select(*key, F.col("status").alias("after_status")), key, "full_outer")
    worst = lambda c: F.when(F.col(c) == "error", 2).when(F.col(c) == "warning", 1).when(F.col(c) == "ok", 0)
    outcome = F.when(F.col("before_status").isNull(), "added").when(F.col("after_status").isNull(), "removed").when(worst("after_status") < worst("before_status"), "repaired").when(worst("after_status") > worst("before_status"), "regressed").otherwise("same")
    return both.withColumn("outcome", outcome).groupBy("before_status", "after_status", "outcome").agg(F.count("*").alias("records"))


def repair_plan(audit: DataFrame, day: str) -> DataFrame:
    """DQ-9: per day, failing records and whether the day is blocked by records without context."""
    return audit.groupBy(day).agg(F.count_if(F.col("status") == "error").alias("failing"), F.count_if(F.col("context_state") != "resolved").alias("unresolved")).filter("failing > 0 or unresolved > 0").withColumn("blocked", F.col("unresolved") > 0)


def reconstruct(base: DataFrame, replacements: DataFrame, key: list[str], columns: list[str]) -> DataFrame:
    """DQ-10: ``base`` with the columns of rows that have a replacement taken from it; all other rows as they are."""
    new = replacements.select(*key, *(F.col(c).alias(f"_{c}") for c in columns), F.lit(True).alias("_r"))
    return base.join(new, key, "left").select(*(F.when(F.col("_r"), F.col(f"_{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c) for c in base.columns))


def suspicions(df: DataFrame, reasons: dict[str, str]) -> DataFrame:
    """DQ-11: reasons to suspect a row's routing, and rows with any."""
    each = F.array(*(F.when(F.coalesce(F.expr(c), F.lit(False)), name) for name, c in reasons.items()))
    return df.withColumn("reasons", F.filter(each, lambda x: x.isNotNull())).filter(F.size("reasons") > 0)


def evidence_class(outcomes: DataFrame, workflow: list[str], outcome: str) -> DataFrame:
    """DQ-12: each workflow verified (all samples agree), ambiguous (they differ) or unresolved (none told anything)."""
    return outcomes.groupBy(*workflow).agg(F.count("*").alias("samples"), F.countDistinct(outcome).alias("outcomes")).withColumn("evidence", F.when(F.col("outcomes") == 0, "unresolved").when(F.col("outcomes") == 1, "verified").otherwise("ambiguous"))


def merged_context(df: DataFrame, key: list[str], fields: list[str]) -> DataFrame:
    """DQ-15: one value per field of several notices; fields on which they disagree are listed and null."""
    rows = df.groupBy(*key).agg(*(F.collect_set(f).alias(f) for f in fields))
    conflict = F.filter(F.array(*(F.when(F.size(f) > 1, f) for f in fields)), lambda x: x.isNotNull())
    return rows.select(*key, conflict.alias("conflicts"), *(F.when(F.size(f) == 1, F.get(f, F.lit(0))).alias(f) for f in fields))


def overlap_faults(wide: DataFrame, daily: DataFrame, key: list[str], day: str) -> DataFrame:
    """DQ-16: records whose day in a wide extract isn't that of the daily ones, on either side, or that a side has twice."""
    w = wide.groupBy(*key).agg(F.min(day).alias("wide_day"), F.count("*").alias("wide_rows"))
    d = daily.groupBy(*key).agg(F.min(day).alias("daily_day"), F.count("*").alias("daily_rows"))
    return w.join(d, key, "full_outer").filter(~F.col("wide_day").eqNullSafe(F.col("daily_day")) | (F.coalesce("wide_rows", F.lit(0)) > 1) | (F.coalesce("daily_rows", F.lit(0)) > 1))
