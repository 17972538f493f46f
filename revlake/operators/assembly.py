"""Rules across the components of an assembled opening (DQ-13): which components its mode and its state of publication call for, and whether these hold what they must.

The phases are the states of a small machine: a single opening has one; one in two envelopes is opened technically first and waits until the financial part is published.
What an opening must have follows from the state it is in; a mode or a publication that can't be told leaves the rest unjudged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revlake.plans.openings import all_objects, at, fault, faults, fields, instant, is_object, is_set, items, kind, raw

# Modes, paths and the statuses that a verified exception stands for.
SINGLE, DUAL = "1_MTHS", "1_HTHS"
ROUND, NOTICE, SUBMISSIONS = "roundmng.bidoBidroundMngViewDTO", "notify.bidNoContractorResponse.bidNotification", "bidSubmissionByContractorViewResponse.bidSubmissionDTOList"
PAIRS = {"single": ("bid_open", "lot_open_detail"), "technical": ("bid_open_technical", "lot_open_detail_technical"), "financial": ("bid_open_financial", "lot_open_detail_financial")}
EXCEPTIONS = ["cancelled_after_opening", "cancelled_after_technical", "no_qualified_technical_bidders", "financial_source_conflict"]
# End of the fixed values.


def refused(component: Column) -> Column:
    """Not a component that came without an error."""
    error = F.coalesce(is_set(at(component, "error")) & ~raw(at(component, "error")).isin("false", "0", "[]", "{}"), F.lit(False))
    return ~is_object(component) | error | F.coalesce((kind(at(component, "success")) == "BOOLEAN") & (raw(at(component, "success")) == "false"), F.lit(False))


def states(rows: DataFrame) -> DataFrame:
    """``rows`` with ``mode``, ``unresolved`` (why the state can't be told) and ``state``: ``single``, ``awaiting_financial`` or ``published``.

    ``rows`` has the payload as variant ``v`` and ``context_mode``, the mode by the search; all modes that are given have to agree."""
    v = F.col("v")
    given = F.array_distinct(F.filter(F.array("context_mode", F.try_variant_get(v, f"$.{NOTICE}.bidMode", "string"), F.try_variant_get(v, f"$.{ROUND}.bidMode", "string")), lambda x: x.isNotNull()))
    rows = rows.withColumns({"_given": given, "_tc": at(v, f"{ROUND}.successBidOpenDateTc")})
    known = (F.size("_given") == 1) & F.get("_given", F.lit(0)).isin(SINGLE, DUAL)
    rows = rows.withColumns({"mode": F.when(known, F.get("_given", F.lit(0))), "_day": instant(F.col("_tc"))})
    tc = F.col("_tc")
    bad_day = is_set(tc) & ((kind(tc) != "STRING") | raw(tc).isNull() | F.col("_day")["value"].isNull())
    why = F.when(F.col("mode").isNull(), "unknown_mode").when(F.col("mode") == DUAL, F.when(~is_object(at(v, ROUND)) | tc.isNull(), "missing_publication").when(bad_day, "invalid_publication"))
    rows = rows.withColumn("unresolved", why)
    state = F.when(F.col("unresolved").isNotNull(), None).when(F.col("mode") == SINGLE, "single").when(F.is_variant_null("_tc"), "awaiting_financial").otherwise("published")
    return rows.withColumn("state", state).drop("_given", "_tc", "_day")


def check(rows: DataFrame, roots: list[str]) -> DataFrame:
    """DQ-13: ``rows`` with ``state``, ``collection_status`` and ``issues`` (code, path, severity).

    ``rows`` has the payload as variant ``v``; ``context_id`` and ``context_mode``, the notice's id and mode by the search; ``exception``, one of ``EXCEPTIONS`` that a pattern has
    proven, or null. ``roots`` are the paths that have to hold an object with members."""
    v, proven = F.col("v"), F.coalesce(F.col("exception").isin(EXCEPTIONS), F.lit(False))
    rows = states(rows)
    told = F.col("unresolved").isNull()
    applies = {"single": F.col("state") == "single", "technical": F.col("state").isin("awaiting_financial", "published"), "financial": F.col("state") == "published"}
    found = [fault("missing_assembly_version", F.lit("notifyVersion"), F.coalesce(F.trim(raw(at(v, f"{NOTICE}.notifyVersion"))), F.lit("")) == "", "fail")]
    for root in roots:
        excused = (F.col("exception") == "cancelled_after_opening") if root == ROUND else F.lit(False)
        found.append(fault("missing_component_root", F.lit(root), (F.coalesce(F.size(F.map_keys(fields(at(v, root)))), F.lit(0)) == 0) & ~F.coalesce(excused, F.lit(False)), "fail"))
    found += [fault("invalid_component", F.lit(name), refused(at(v, name)), "fail") for name in ("notify", "roundmng")]
    found.append(fault("unresolved_opening_phase", F.col("unresolved"), ~told, "unresolved"))
    pairs = F.filter(F.flatten(F.array(*(F.when(applies[k], F.array(*map(F.lit, pair))).otherwise(F.array().cast("array<string>")) for k, pair in PAIRS.items()))), lambda x: x.isNotNull())
    expected = F.concat(F.array(F.lit("notify"), F.lit("roundmng")), pairs, F.when(proven, F.array(F.lit("cancellation_notice"))).otherwise(F.array().cast("array<string>")))
    there = F.map_keys(fields(v))
    same = (F.size(there) == F.size(expected)) & (F.size(F.array_except(there, expected)) == 0)
    found.append(fault("unexpected_opening_components", F.array_join(F.array_sort(expected), ","), told & ~F.coalesce(same, F.lit(False)), "fail"))
    lots_of: list[Column] = []
    for name, (bid, lot) in PAIRS.items():
        on = told & applies[name]
        subs, lots, count = at(v, f"{bid}.{SUBMISSIONS}"), at(v, lot), at(v, f"{ROUND}.countContractor")
        excused = F.coalesce(F.col("exception").isin(EXCEPTIONS[1:]), F.lit(False)) & ~is_set(subs) if name == "financial" else F.lit(False)
        found += [fault("invalid_component", F.lit(bid), on & refused(at(v, bid)), "fail"), fault("invalid_component_list", F.lit(bid), on & ~all_objects(subs) & ~excused, "fail"), fault("invalid_component_list", F.lit(lot), on & ~all_objects(lots), "fail")]
        other = lambda x: is_object(x) & ~raw(at(x, "notifyId")).eqNullSafe(F.col("context_id"))
        issue = F.struct(F.lit("lot_identity_mismatch").alias("code"), F.lit(f"{lot}.notifyId").alias("path"), F.lit("fail").alias("severity"))
        lots_of.append(F.when(on & items(lots).isNotNull(), F.transform(F.filter(items(lots), other), lambda _: issue)))  # noqa: B023
        if name != "financial":
            differs = kind(count).isin("BIGINT", "INT") & (F.try_variant_get(count, "$", "bigint") != F.size(items(subs))) & items(subs).isNotNull()
            found.append(fault("contractor_count_mismatch", F.lit(bid), on & F.coalesce(differs, F.lit(False)), "warn"))
    found.append(fault("financial_null_with_publication_marker_conflict", F.lit("bid_open_financial.bidSubmissionByContractorViewResponse"), told & F.coalesce(F.col("exception") == "financial_source_conflict", F.lit(False)), "warn"))
    none = F.array().cast("array<struct<code:string,path:string,severity:string>>")
    status = F.when(~told, None).when(proven, F.col("exception")).when(F.col("state") == "awaiting_financial", "awaiting_financial").otherwise("complete")
    return rows.withColumns({"collection_status": status, "issues": F.concat(faults(*found), *(F.coalesce(x, none) for x in lots_of))})
