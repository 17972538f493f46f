"""Raw observations to typed revisions, children, issues and quarantine: one declarative spec per resource (SLV).

``resource`` runs a spec as one lazy plan per table. Payloads stay JSON text; all members of an object that a spec names are read in one pass, so numbers keep their text until
they are cast. Rows without a root or an identity go to quarantine, all others get an entity and a revision. Of a key that an object has twice the last value that isn't null counts.
Spark takes what is parsed out of payloads for far smaller than it is and would broadcast it whole, so tables made here are joined with the hint ``merge``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, field
from functools import cache, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revlake.functions import cleaning as C

Rule = Callable[[Column], "Column | C.Ruled"]
#: Rules of a text and its anchor, whose repairs are told.
DATED = (C.parse_date, C.parse_instant)


@dataclass(frozen=True)
class Field:
    """A target column: a rule over the first path of the root that holds anything."""

    rule: Rule
    paths: tuple[str, ...]
    anchor: str | None = None


@dataclass(frozen=True)
class Child:
    """A child table: items of the first array found at ``paths`` (also an array written as text), with fields of each item."""

    paths: tuple[str, ...]
    fields: dict[str, Field]
    inherit: tuple[str, ...] = ()


@dataclass(frozen=True)
class Spec:
    entity: str
    roots: tuple[str, ...]
    identity: str
    fields: dict[str, Field]
    children: dict[str, Child] = field(default_factory=dict)
    scheme: str = "source_id"
    versioned: bool = True
    same_in_roots: tuple[str, ...] = ()
    version_path: str | None = None
    version_fallback: str | None = None  # where neither version_path nor the envelope names a version
    checks: tuple[tuple[str, str, str], ...] = ()  # (code, SQL fault over targets, severity)
    contract: str = "v1"


def F1(rule: Rule, *paths: str, anchor: str | None = None) -> Field:
    return Field(rule, paths, anchor)


Reader = Callable[[str], Column]


def members(df: DataFrame, json: str, paths: Iterable[str]) -> tuple[DataFrame, Reader]:
    """``df`` with members of the JSON objects in column ``json``, parsed once, and the text at each of ``paths``. The parsed members are columns of a generator, so
    whatever is computed from them, however often it names them, doesn't parse again."""
    heads = list(dict.fromkeys(p.partition(".")[0] for p in paths))
    named = {h: f"_{json}.{h}" for h in heads}
    rows = df.select("*", F.json_tuple(json, *heads).alias(*named.values())) if heads else df

    def at(path: str) -> Column:
        head, _, rest = path.partition(".")
        found = F.col(f"`{named[head]}`")
        return F.get_json_object(found, f"$.{rest}") if rest else found

    return rows, at


def field_paths(fields: dict[str, Field]) -> list[str]:
    return [p for f in fields.values() for p in (*f.paths, *([f.anchor] if f.anchor else []))]


def each_of(items: Column) -> Column:
    """Generator of (ordinal, item); drop rows with a null ordinal. The outer form has no condition on the list, which Spark would compute again, from the payload, in a filter below."""
    return F.posexplode_outer(items)


def found_issues(rows: DataFrame, *more: str) -> DataFrame:
    """``rows``' ids, columns ``more`` and issues ``x``, a row each."""
    return rows.select("observation_id", *more, F.explode_outer("issues").alias("x")).filter("x is not null")


@cache
def is_ruled(rule: Rule) -> bool:
    """Whether a rule gives (value, issue)."""
    return isinstance(rule(F.lit("")), tuple)


def can_fail(fields: dict[str, Field]) -> bool:
    return any(is_ruled(f.rule) for f in fields.values())


def read_rule(rule: Rule, issues: bool) -> Callable[[Column], Column]:
    """What ``rule`` makes of an item: a value of a text, or of (raw, path, anchor) a value and, where asked for, its issues."""
    if not is_ruled(rule):
        return lambda raw: rule(raw)

    def read(x: Column) -> Column:
        args = [x["raw"], x["anchor"]] if rule in DATED else [x["raw"]]
        value, issue = rule(*args)
        repair = [(x["path"], C.date_repair(*args), "info")] if rule in DATED and issues else []
        # Most fields of a payload are absent; a text that is null has neither value nor issue.
        return F.when(x["raw"].isNotNull(), F.struct(value.alias("value"), *([C.issues((x["path"], issue, "warn"), *repair).alias("issues")] if issues else [])))

    return read


def read_fields(rows: DataFrame, at: Reader, fields: dict[str, Field], path: Callable[[str], str] = str, issues: bool = True) -> DataFrame:
    """``rows`` with the columns of ``fields`` and, where asked for, their ``issues``, ``at`` giving the text at a path and ``path`` what an issue calls it. The fields of one rule are
    one list that the rule is mapped over, so a plan has each rule once and not once a field: building, planning and compiling it takes a fraction of the time."""

    def item(f: Field) -> Column:
        raw = F.coalesce(*map(at, f.paths))
        if not is_ruled(f.rule):
            return raw
        anchor = [(at(f.anchor) if f.anchor else F.lit(None).cast("string")).alias("anchor")] if f.rule in DATED else []
        return F.struct(raw.alias("raw"), *([F.lit(path(f.paths[0])).alias("path")] if issues else []), *anchor)

    by_rule: dict[Rule, list[str]] = {}
    for target, f in fields.items():
        by_rule.setdefault(f.rule, []).append(target)
    lists, values, found = {}, {}, []
    for n, (rule, targets) in enumerate(by_rule.items()):
        name = f"_read{n}"
        lists[name] = F.transform(F.array(*(item(fields[t]) for t in targets)), read_rule(rule, issues))
        values |= {t: F.get(F.col(name), F.lit(i))["value"] if is_ruled(rule) else F.get(F.col(name), F.lit(i)) for i, t in enumerate(targets)}
        found += [F.flatten(F.filter(F.col(name)["issues"], lambda x: x.isNotNull()))] if is_ruled(rule) and issues else []
    if issues:
        values["issues"] = F.concat(*found) if found else C.issues()
    return rows.withColumns(lists).withColumns(values).drop(*lists) if fields else rows.withColumns(values)


def observation(bronze: DataFrame, resource: str, namespace: str = "main") -> DataFrame:
    """SLV-1: ``bronze`` with an id for each physical row: of its file and place if there is one, else of its content."""
    place = F.col("file_path") if "file_path" in bronze.columns else F.concat_ws("/", "source_date", "run_id")
    ident = C.digest(F.lit(namespace), F.lit(resource), place, F.col("source_id"), F.col("source_version"), F.sha2("payload", 256))
    return bronze.withColumns({"observation_id": ident, "resource": F.lit(resource), "observed_at": F.col("ingested_at")})


def resource(bronze: DataFrame, spec: Spec, name: str, namespace: str = "main", carry: tuple[str, ...] = (), only: Iterable[str] | None = None, fields: Iterable[str] | None = None) -> dict[str, DataFrame]:
    """``observation``, ``<entity>_revision``, its children, ``quality_issue`` and ``quarantine``; revisions also have the columns of ``bronze`` that ``carry`` names.
    ``only`` names the tables to build, ``fields`` the fields that revisions are to have; both give all if None. What nobody asks for is neither planned nor read out of payloads."""
    asked = lambda t: only is None or t in only
    revision, issue_asked = f"{spec.entity}_revision", asked("quality_issue")
    kept = [f for f in spec.fields if asked(revision) and (fields is None or f in fields)]
    children = {t: c for t, c in spec.children.items() if asked(t) or issue_asked and can_fail(c.fields)}
    read = set(spec.fields) if issue_asked else {*kept, *(f for c in children.values() for f in c.inherit)}
    seen = observation(bronze, name, namespace)
    rows, top = members(seen, "payload", [r for r in spec.roots if r])
    names = [f"_root{i}" for i in range(len(spec.roots))]
    rows = rows.withColumns({n: top(r) if r else F.col("payload") for n, r in zip(names, spec.roots, strict=True)})
    at = [F.col(n) for n in names]
    is_object = lambda c: F.trim(c).startswith("{")
    root = F.coalesce(*(F.when(is_object(c), c) for c in at))
    rows = rows.withColumn("root", root)
    copies = []
    for n in names if spec.same_in_roots else []:
        rows, copy = members(rows, n, spec.same_in_roots)
        copies.append(copy)
    versions = [p for p in (spec.version_path, spec.version_fallback) if p]
    rows, of = members(rows, "root", [spec.identity, *versions, *field_paths({t: f for t, f in spec.fields.items() if t in read}), *(p for c in children.values() for p in c.paths)])
    identity = C.clean_text(of(spec.identity))
    # Fields that have to agree in all roots, and with the envelope.
    differ = []
    for p in spec.same_in_roots:
        values = F.array_distinct(F.filter(F.transform(F.array(*(c(p) for c in copies)), lambda c: C.clean_text(c)), lambda x: x.isNotNull()))
        differ.append(F.when(F.size(values) > 1, p))
    own = {"identity": identity} | ({"named": C.clean_text(of(spec.version_path))} if spec.version_path else {})
    # Columns of a generator are computed once, where a filter on them would compute them again.
    rows = rows.select("*", F.inline_outer(F.array(F.struct(*(c.alias(k) for k, c in own.items())))))
    if spec.version_path:
        differ.append(F.when(F.col("identity") != C.clean_text(F.col("source_id")), "source_id"))
        differ.append(F.when(F.col("named") != C.clean_text(F.col("source_version")), "source_version"))
    conflicts = F.filter(F.array(*differ), lambda x: x.isNotNull()) if differ else F.array().cast("array<string>")
    rows = rows.select("*", F.inline_outer(F.array(F.struct(conflicts.alias("conflicts"))))) if differ else rows.withColumn("conflicts", conflicts)
    reason = F.when(F.col("root").isNull(), "missing_root").when(F.col("identity").isNull(), "missing_identity").when(F.size("conflicts") > 0, "conflicting_identity")
    rows = rows.withColumn("reason", reason)
    versions = [F.col("named")] if spec.version_path else []
    versions += map(C.clean_text, [F.col("source_version")] + ([of(spec.version_fallback)] if spec.version_fallback else []))
    good = rows.filter("reason is null").withColumn("entity_id", C.digest(F.lit(namespace), F.lit(spec.entity), F.lit(spec.scheme), F.col("identity")))
    good = good.withColumn("version", F.coalesce(*versions) if spec.versioned else F.lit(None).cast("string"))
    good = good.withColumn("revision_id", C.digest(F.col("entity_id"), F.col("version"), F.sha2("payload", 256), F.lit(spec.contract)))
    out = {}
    if asked("observation"):
        out["observation"] = seen.select("observation_id", "resource", "source_date", "run_id", "observed_at", "source_id", "source_version", "content_hash")
    if asked(revision):
        typed = read_fields(good, of, {f: spec.fields[f] for f in kept}, issues=False)
        out[revision] = typed.select("revision_id", "entity_id", "observation_id", "observed_at", "version", *kept, F.col("root").alias("root_json"), *carry)
    if asked("quarantine"):
        out["quarantine"] = rows.filter("reason is not null").select("observation_id", "reason")
    issue = []
    if issue_asked:
        # Rows that go to quarantine have an issue for each conflict or one for their root, all others those of their fields: one pass over both.
        typed = read_fields(rows, of, spec.fields)
        fields_and_checks = F.concat("issues", C.issues(*((code, F.when(F.coalesce(F.expr(fault), F.lit(False)), code), severity) for code, fault, severity in spec.checks)))
        spots = F.when(F.size("conflicts") > 0, F.col("conflicts")).otherwise(F.array(F.lit("root")))
        refused = F.transform(spots, lambda x: F.struct(F.col("reason").alias("code"), x.alias("path"), F.lit("error").alias("severity")))
        typed = typed.withColumn("issues", F.when(F.col("reason").isNull(), fields_and_checks).otherwise(refused))
        issue.append(found_issues(typed).select("observation_id", "x.code", "x.path", "x.severity"))
    for table, child in children.items():
        source = read_fields(good, of, {f: spec.fields[f] for f in child.inherit}, issues=False)
        items, child_issues = _children(source, table, child, of, issue_asked)
        if asked(table):
            out[table] = items
        issue += child_issues
    if issue_asked:
        out["quality_issue"] = reduce(DataFrame.unionByName, issue).withColumn("issue_id", C.digest(F.col("observation_id"), F.col("code"), F.col("path"))).dropDuplicates(["issue_id"])
    return out


def json_items(c: Column) -> Column:
    """Items of a JSON array, or of a text that holds one; null if it is neither."""
    bare = F.when(F.trim(c).startswith("["), c).otherwise(F.get_json_object(F.concat(F.lit('{"x":'), c, F.lit("}")), "$.x"))
    return C.bind(bare, lambda b: F.when(F.trim(b).startswith("["), F.from_json(b, "array<string>")))


def _children(source: DataFrame, table: str, child: Child, of: Reader, with_issues: bool) -> tuple[DataFrame, list[DataFrame]]:
    items = F.coalesce(*(json_items(of(p)) for p in child.paths))
    rows = source.select("revision_id", "observation_id", *child.inherit, each_of(items).alias("ordinal", "item")).filter(F.trim("item").startswith("{"))
    rows, at = members(rows, "item", field_paths(child.fields))
    with_issues = with_issues and can_fail(child.fields)
    rows = read_fields(rows, at, child.fields, lambda p: f"{table}.{p}", with_issues).withColumn(f"{table}_id", C.digest(F.col("revision_id"), F.lit(table), F.col("ordinal")))
    issues = [found_issues(rows, "ordinal").select("observation_id", "x.code", F.concat(F.col("x.path"), F.lit("["), F.col("ordinal").cast("string"), F.lit("]")).alias("path"), "x.severity")] if with_issues else []
    return rows.select(f"{table}_id", "revision_id", "ordinal", *child.inherit, *child.fields), issues


# Resources. Paths are the sources' field names.
T, R, M, D, I, B = C.clean_text, C.clean_reference, C.parse_money, C.parse_date, C.parse_instant, C.parse_boolean
_place = {"province_code": F1(C.clean_pipe_code, "provCode"), "province_name": F1(T, "provName"), "district_code": F1(C.clean_pipe_code, "districtCode"), "district_name": F1(T, "districtName"), "ward_code": F1(C.clean_pipe_code, "wardCode")}
_year = lambda c: C.parse_count(c, 1)
_quarter = lambda c: C.parse_count(c, 1, 4)
_month = lambda c: C.parse_count(c, 1, 12)

PROJECT = Spec(
    "project", ("projectDTO", ""), "id",
    {"project_no": F1(R, "no"), "title": F1(T, "name"), "investor_code": F1(T, "investorCode"), "investor_name": F1(T, "investorName"), "invest_total": F1(M, "investTotal"), "currency": F1(C.clean_currency, "investTotalUnit"), "decision_no": F1(T, "decisionNo"), "decision_date": F1(D, "decisionDate", anchor="publicDate"), "public_date": F1(D, "publicDate"), "province_code": F1(C.clean_pipe_code, "provCode"), "district_code": F1(C.clean_pipe_code, "districtCode"), "status_raw": F1(T, "status")},
    {"project_location": Child(("plocation",), _place)},
    checks=(("decision_after_publication", "decision_date > public_date", "warn"), ("unknown_currency", "invest_total is not null and currency is null", "warn")),
)
PLAN = Spec(
    "plan", ("",), "id",
    {"plan_no": F1(R, "planNo"), "title": F1(T, "name"), "investor_name": F1(T, "investorName"), "project_id": F1(R, "pid"), "project_no": F1(R, "pno"), "plan_type": F1(T, "planType"), "invest_total": F1(M, "investTotal"), "currency": F1(C.clean_currency, "investTotalUnit"), "public_date": F1(D, "publicDate"), "decision_date": F1(D, "decisionDate", anchor="publicDate"), "decision_no": F1(T, "decisionNo"), "package_total": F1(C.parse_count, "bidPack"), "location": F1(T, "location"), "status_raw": F1(T, "status")},
)
PACKAGE = Spec(
    "package", ("",), "id",
    {"package_no": F1(T, "bidNo"), "title": F1(T, "bidName"), "plan_no": F1(R, "planNo"), "plan_id": F1(R, "planId"), "bid_price": F1(M, "bidPrice"), "currency": F1(T, "bidPriceUnit"), "bid_field": F1(T, "bidField"), "bid_form": F1(T, "bidForm"), "bid_mode": F1(T, "bidMode"), "contract_type": F1(T, "ctype"), "execution_period": F1(C.parse_count, "cperiod"), "is_domestic": F1(B, "isDomestic"), "is_internet": F1(B, "isInternet"), "bid_start_year": F1(_year, "bidStartYear"), "bid_start_quarter": F1(_quarter, "bidStartQuarter"), "bid_start_month": F1(_month, "bidStartMonth"), "public_date": F1(D, "createdDate", "originalCreateDate", "exchangeDate")},
    {"package_location": Child(("bidLocation",), _place), "package_lot": Child(("bidpBidLotList",), {"source_lot_id": F1(T, "id"), "lot_no": F1(T, "lotNo"), "lot_name": F1(T, "lotName"), "lot_price": F1(M, "lotPrice"), "quantity": F1(M, "quantity"), "uom": F1(T, "uom")}, ("currency",))},
    versioned=False, checks=(("unknown_currency", "bid_price is not null and currency is null", "warn"),),
)
_notice = {"notify_no": F1(T, "notifyNo"), "notify_version": F1(T, "notifyVersion"), "package_id": F1(R, "bidId"), "package_no": F1(T, "bidNo"), "plan_no": F1(R, "planNo"), "title": F1(T, "bidName"), "procuring_entity_code": F1(T, "procuringEntityCode"), "procuring_entity_name": F1(T, "procuringEntityName"), "investor_name": F1(T, "investorName"), "bid_price": F1(M, "bidPrice"), "currency": F1(T, "bidPriceUnit"), "guarantee_currency": F1(T, "bidGuaranteeUnit"), "bid_field": F1(T, "investField"), "bid_form": F1(T, "bidForm"), "bid_mode": F1(T, "bidMode"), "status_raw": F1(T, "status"), "bid_open_date": F1(I, "bidOpenDate", anchor="publicDate"), "bid_close_date": F1(I, "bidCloseDate", anchor="publicDate"), "published_at": F1(I, "publicDate"), "public_date": F1(D, "publicDate"), "cancel_date": F1(I, "cancelDate", anchor="publicDate"), "cancel_reason": F1(T, "cancelReason")}
_notice_checks = (("close_after_open", "bid_close_date > bid_open_date", "warn"), ("published_after_close", "published_at > bid_close_date", "warn"))
_notice_lot = {"lot_no": F1(T, "lotNo"), "lot_name": F1(T, "lotName"), "lot_price": F1(M, "lotPrice"), "estimate_price": F1(M, "lotEstimatePrice"), "currency": F1(T, "lotPriceUnit"), "guarantee_amount": F1(M, "lotGuaranteeValue"), "contract_duration_raw": F1(T, "cperiod"), "contract_duration_unit": F1(T, "cperiodUnit"), "notify_id": F1(T, "notifyId"), "notify_no": F1(T, "notifyNo")}
_submission = {"submission_id": F1(T, "reofferSubmissionId"), "reoffer_id": F1(T, "reofferId"), "lot_no": F1(T, "lotNo"), "contractor_code": F1(T, "contractorCode"), "contractor_name": F1(T, "contractorName"), "venture_code": F1(T, "ventureCode"), "venture_name": F1(T, "ventureName"), "times_raw": F1(T, "times"), "offered_at_raw": F1(T, "reofferDate"), "form_code": F1(T, "formCode"), "form_value": F1(T, "formValue"), "currency": F1(T, "reofferPriceUnit"), "price": F1(M, "reofferPrice"), "final_price": F1(M, "reofferPriceFinal"), "offered_at": F1(I, "reofferDate"), "is_newest": F1(B, "isNewest")}
#: SLV-11: lists of a notice's payload that are read one after the other, and the list of lots that goes before a standard notice's own.
NOTICE_PLACES = ("bidpBidLocationList", "lsBidpBidLocationDTO", "bidDetail.bidLocation")
SUBMISSIONS = ("contractorsResult", "contractorsResultAll")
LOT_MIRROR = "bidNoContractorResponse.bidNotification.lotDTOList"
NOTICES = {
    "standard": Spec("notice", ("bidoNotifyContractorM", "bidoNotifyContractorP", ""), "id", _notice | {"currency": F1(lambda c: F.coalesce(C.clean_currency(c), F.lit("VND")), "bidPriceUnit")}, same_in_roots=("id", "notifyNo", "notifyVersion", "bidId"), version_path="notifyVersion", checks=_notice_checks),
    "vk_adb": Spec("notice", ("bidoNotifyContractorP",), "id", _notice | {"contract_type": F1(T, "cType")}, version_path="notifyVersion", checks=_notice_checks),
    "reoffer": Spec("notice", ("",), "id", _notice, scheme="reoffer_no", version_path="reofferVersion", checks=_notice_checks),
}
CONTRACT = Spec("contract", ("contract",), "contractCode", {"contract_code": F1(T, "contractCode"), "contract_version": F1(T, "contractVersion"), "price_after": F1(M, "priceAfter"), "notify_no": F1(T, "notifyNo"), "result_id": F1(R, "resultId")}, version_path=None)
PERFORMANCE = Spec("contract_performance", ("performance",), "id", {"contract_code": F1(T, "contractCode"), "contract_version": F1(T, "contractVersion"), "progress_status": F1(T, "contractStatus"), "planned_completion_date": F1(D, "completePlanDate"), "actual_completion_date": F1(D, "completeRealityDate")}, checks=(("unknown_progress_status", "progress_status is not null and progress_status not in ('0', '1', '2', '3', '4')", "warn"),))
RESULT = Spec("result", ("bideContractorInputResultDTO", ""), "id", {"notify_no": F1(T, "notifyNo"), "notify_version": F1(T, "notifyVersion"), "package_id": F1(R, "bidId"), "package_no": F1(T, "bidNo"), "plan_no": F1(R, "planNo"), "status_raw": F1(T, "status"), "decision_date": F1(D, "decisionDate", anchor="publicDate"), "public_date": F1(D, "publicDate"), "unit": F1(C.clean_currency, "bidPriceUnit"), "estimate_unit": F1(C.clean_currency, "bidEstimatePriceUnit")}, version_fallback="resultVersion", checks=(("conflicting_currency", "unit != estimate_unit", "warn"),))


def project_tables(bronze: DataFrame) -> dict[str, DataFrame]:
    """SLV-2, SLV-3: projects and their places: items of the list ``plocation``, of the payload or else of its root, also a list written as text; where there is no
    list, or an empty one, the one place that the payload's or root's own fields name. Items that are no objects or name nothing are no places."""
    out = resource(bronze, PROJECT, "project")
    rows = out["project_revision"].select("revision_id", "observation_id", "root_json").join(observation(bronze, "project").select("observation_id", "payload").hint("merge"), "observation_id")
    own = ("provCode", "provName", "districtCode", "districtName")
    rows, outer = members(rows, "payload", ("plocation", *own))
    rows, inner = members(rows, "root_json", ("plocation", *own))
    either = lambda p: F.coalesce(F.nullif(outer(p), F.lit("")), inner(p))
    rows = rows.withColumns({"raw": either("plocation"), **{k: either(k) for k in own}}).withColumn("items", json_items(F.col("raw")))
    # A list that is none or empty has one row without an ordinal here, the place of the project's own fields.
    rows = rows.select("revision_id", "raw", *own, each_of(F.col("items")).alias("ordinal", "item"))
    codes, names = {"province_code": "provCode", "district_code": "districtCode", "ward_code": "wardCode"}, {"province_name": "provName", "district_name": "districtName", "ward_name": "wardName"}
    listed, of = members(rows.filter(F.trim("item").startswith("{")), "item", [*codes.values(), *names.values()])
    listed = listed.select("revision_id", "ordinal", *(C.clean_pipe_code(of(p)).alias(k) for k, p in codes.items()), *(T(of(p)).alias(k) for k, p in names.items()))
    listed = listed.withColumn("location_name", F.nullif(F.concat_ws(", ", "ward_name", "district_name", "province_name"), F.lit("")))
    none = F.lit(None).cast("string")
    single = rows.filter("ordinal is null").select("revision_id", F.lit(0).alias("ordinal"), C.clean_pipe_code(F.col("provCode")).alias("province_code"), C.clean_pipe_code(F.col("districtCode")).alias("district_code"), none.alias("ward_code"), T(F.col("provName")).alias("province_name"), T(F.col("districtName")).alias("district_name"), none.alias("ward_name"), T(F.when(~F.trim("raw").rlike(r"^[\[{]"), F.col("raw"))).alias("location_name"))
    places = listed.unionByName(single).filter("coalesce(province_code, district_code, location_name, province_name, district_name) is not null")
    place = [F.col(c) for c in ("province_code", "province_name", "district_code", "district_name", "ward_code", "ward_name", "location_name")]
    out["project_location"] = places.withColumn("project_location_id", C.digest(F.col("revision_id"), F.lit("location"), F.col("ordinal"), *place))
    return out


def notice_lists(rows: DataFrame, family: str, only: Iterable[str] | None = None) -> tuple[dict[str, DataFrame], list[DataFrame]]:
    """SLV-11: ``notice_lot``, ``notice_location`` and ``notice_reoffer_submission`` of revisions with ``root_json`` and ``payload``, and the issues of their fields;
    ``only`` is as in ``resource``.

    All lists of a kind are read, so a place that two lists name has two rows, told apart by ``source_path``. Lots are those of the root; of a standard notice those of ``LOT_MIRROR``
    where that is a list, an empty one too. Items that are no objects have no row; a list that is null, absent or no list has none."""
    roots = NOTICES[family].roots
    with_lots, top = members(rows, "payload", [*(r for r in roots if r), *([LOT_MIRROR] if family == "standard" else [])])
    with_lots, inside = members(with_lots, "root_json", ["lotDTOList"])
    with_places, place = members(rows, "payload", NOTICE_PLACES)
    with_offers, offer = members(rows, "payload", SUBMISSIONS)
    is_object = lambda r: F.coalesce(F.trim(top(r) if r else F.col("payload")).startswith("{"), F.lit(False))
    lot_path = F.coalesce(*(F.when(is_object(r), f"{r}.lotDTOList" if r else "lotDTOList") for r in roots))
    lots = json_items(inside("lotDTOList"))
    if family == "standard":
        mirror = json_items(top(LOT_MIRROR))
        lot_path, lots = F.when(mirror.isNotNull(), LOT_MIRROR).otherwise(lot_path), F.coalesce(mirror, lots)
    kinds = {"notice_lot": (with_lots, [(lot_path, lots)], _notice_lot), "notice_location": (with_places, [(F.lit(p), json_items(place(p))) for p in NOTICE_PLACES], _place | {"ward_name": F1(T, "wardName")}), "notice_reoffer_submission": (with_offers, [(F.lit(p), json_items(offer(p))) for p in SUBMISSIONS if family == "reoffer"], _submission)}
    asked = lambda t: only is None or t in only
    out, issues = {}, []
    for name, (source, lists, fields) in kinds.items():
        with_issues = asked("quality_issue") and can_fail(fields)
        if not lists or not (asked(name) or with_issues):
            continue
        each = source.select("revision_id", "observation_id", F.explode(F.array(*(F.struct(p.alias("source_path"), x.alias("items")) for p, x in lists))).alias("list"))
        each = each.select("revision_id", "observation_id", "list.source_path", each_of(F.col("list.items")).alias("ordinal", "item")).filter(F.trim("item").startswith("{"))
        each, of = members(each, "item", ["id", *field_paths(fields)])
        at = F.concat("source_path", F.lit("["), F.col("ordinal").cast("string"), F.lit("]."))
        own = {f"{name}_id": C.digest(F.col("revision_id"), F.col("source_path"), F.col("ordinal"), F.col("item")), "source_id": C.clean_text(of("id")), "at": at}
        read = read_fields(each, of, fields, issues=with_issues).withColumns(own)
        if with_issues:
            issues.append(found_issues(read, "at").select("observation_id", "x.code", F.concat("at", "x.path").alias("path"), "x.severity"))
        if asked(name):
            out[name] = read.select(f"{name}_id", "revision_id", "source_path", "ordinal", "source_id", *fields)
    return out, issues


def notice_tables(bronze: dict[str, DataFrame], only: Iterable[str] | None = None, fields: Iterable[str] | None = None) -> dict[str, DataFrame]:
    """SLV-9..11: the three families of notices, each by its spec, with their lists, united by name; ``only`` and ``fields`` as in ``resource``."""
    out: dict[str, DataFrame] = {}
    for family, df in bronze.items():
        # Lists are read out of revisions, which need no fields where nobody else asks for them.
        asked = only is None or "notice_revision" in only
        tables = resource(df, NOTICES[family], f"notice_{family}", carry=("payload",), only=None if only is None else {*only, "notice_revision"}, fields=fields if asked else ())
        revision = tables.pop("notice_revision")
        lists, issues = notice_lists(revision, family, only)
        tables |= lists
        if asked:
            tables["notice_revision"] = revision.drop("payload").withColumn("source_family", F.lit(family))
        if issues:
            more = reduce(DataFrame.unionByName, issues).withColumn("issue_id", C.digest(F.col("observation_id"), F.col("code"), F.col("path")))
            tables["quality_issue"] = tables["quality_issue"].unionByName(more).dropDuplicates(["issue_id"])
        for t, part in tables.items():
            out[t] = out[t].unionByName(part, allowMissingColumns=True) if t in out else part
    return out


def outcome(raw: Column) -> tuple[Column, Column]:
    """SLV-13: (code, issue) of a contractor's result: text or a whole number; only "1" wins, "0" to "3" are known."""
    text = C.clean_text(raw, sentinels=False)
    known = lambda t: t.rlike(r"^[0-3]$")
    return C.bind(text, lambda t: F.when(known(t), t)), C.bind(text, lambda t: F.when(t.isNull(), "missing_outcome").when(~known(t), "unsupported_outcome"))


def result_tables(bronze: DataFrame, only: Iterable[str] | None = None) -> dict[str, DataFrame]:
    """SLV-12..18: results with ``award_lot`` and ``award_contractor``, and totals where every part of them is certain; ``record_reference`` has a row for each notice, package
    and plan that a result names. The version is the envelope's, else the result's own. ``only`` names the tables to build besides ``award_lot``, ``award_contractor``,
    ``record_reference`` and ``result_revision``, which are always there."""
    out = resource(bronze, RESULT, "result", only=None if only is None else {*only, "result_revision"})
    names = [("notice", "notify_no", "notifyNo"), ("package", "uuid", "bidId"), ("plan", "number", "planNo")]
    naming, of = members(out["result_revision"], "root_json", [path for _, _, path in names])
    named = [F.struct(F.lit(target).alias("target"), F.lit(scheme).alias("scheme"), C.clean_text(of(path)).alias("value"), F.lit(path).alias("path")) for target, scheme, path in names]
    refs = naming.select("revision_id", F.explode(F.array(*named)).alias("r")).select("revision_id", "r.*").filter("value is not null")
    out["record_reference"] = refs.withColumn("reference_id", C.digest(F.col("revision_id"), F.col("target"), F.col("value"))).dropDuplicates(["reference_id"])
    head = out["result_revision"].withColumn("currency", F.when(F.col("unit").eqNullSafe(F.col("estimate_unit")) | F.col("unit").isNull() | F.col("estimate_unit").isNull(), F.coalesce("unit", "estimate_unit")))
    head = head.withColumn("currency_conflict", F.coalesce(F.col("unit") != F.col("estimate_unit"), F.lit(False)))
    lots, of = members(head, "root_json", ["lotResultDTO"])
    lots = lots.select("revision_id", "observation_id", "currency", "currency_conflict", each_of(json_items(of("lotResultDTO"))).alias("lot_ordinal", "lot")).filter("lot_ordinal is not null")
    lots, lot = members(lots, "lot", ["id", "lotNo", "lotName", "lotPrice", "lotPriceUnit", "bidPriceUnit", "contractorList"])
    price, price_issue = M(lot("lotPrice"))
    lot_unit = C.clean_currency(F.coalesce(lot("lotPriceUnit"), lot("bidPriceUnit")))
    lots = lots.select("revision_id", "observation_id", "lot_ordinal", lot("contractorList").alias("contractors"), C.clean_text(lot("id")).alias("source_lot_id"), C.clean_text(lot("lotNo")).alias("lot_no"), C.clean_text(lot("lotName")).alias("lot_name"), price.alias("lot_price"), price_issue.alias("price_issue"), F.when(~F.col("currency_conflict"), F.coalesce(lot_unit, "currency")).alias("lot_currency"), (F.col("currency_conflict") | F.coalesce(lot_unit != F.col("currency"), F.lit(False))).alias("lot_conflict"))
    lots = lots.withColumn("award_lot_id", C.digest(F.col("revision_id"), F.lit("lot"), F.col("lot_ordinal")))
    people = lots.select("award_lot_id", "revision_id", "observation_id", "lot_ordinal", "lot_currency", each_of(json_items(F.col("contractors"))).alias("contractor_ordinal", "c")).filter("contractor_ordinal is not null")
    people, of = members(people, "c", ["bidResult", "bidWiningPrice", "ventureCode", "ventureName", "orgCode", "taxCode"])
    code, code_issue = outcome(of("bidResult"))
    won, won_issue = M(of("bidWiningPrice"))
    venture = C.clean_text(of("ventureCode"))
    people = people.select("award_lot_id", "revision_id", "observation_id", "lot_ordinal", "lot_currency", "contractor_ordinal", F.coalesce(C.clean_text(F.coalesce(F.nullif(of("orgCode"), F.lit("")), of("taxCode"))), F.lit("UNKNOWN")).alias("contractor_code"), C.clean_text(of("taxCode")).alias("tax_code"), venture.alias("venture_code"), (venture.isNotNull() | C.clean_text(of("ventureName")).isNotNull()).alias("is_consortium"), code.alias("outcome"), code_issue.alias("outcome_issue"), won.alias("winning_price"), won_issue.alias("winning_price_issue"))
    people = people.withColumns({"is_winner": F.coalesce(F.col("outcome") == "1", F.lit(False)), "award_contractor_id": C.digest(F.col("award_lot_id"), F.col("contractor_ordinal"))})
    win = F.col("is_winner")
    tiny = win & ((F.col("winning_price") == 0) | (F.col("winning_price") <= 10) & (F.coalesce("lot_currency", F.lit("VND")) == "VND"))
    per_lot = people.groupBy("award_lot_id").agg(F.count_if(win).alias("winners"), F.bool_or(F.col("outcome_issue").isNotNull()).alias("open_outcome"), F.bool_or(win & F.col("winning_price").isNull()).alias("no_price"), F.bool_or(tiny).alias("tiny_price"), (F.count_if(win & F.col("is_consortium")) > 1).alias("split_consortium"), F.sum(F.when(win, F.col("winning_price"))).alias("won"))
    lots = lots.join(per_lot.hint("merge"), "award_lot_id", "left")
    yes = lambda c: F.coalesce(F.col(c), F.lit(False))
    has = F.coalesce("winners", F.lit(0)) > 0
    unresolved = yes("open_outcome") | yes("no_price") | yes("tiny_price") | yes("split_consortium") | F.col("lot_conflict") | (has & F.col("lot_currency").isNull())
    fits = F.abs("won") < F.lit("1e32").cast("double")
    lots = lots.withColumns({"is_unresolved": unresolved, "winning_price": F.when(~unresolved & has & fits, F.col("won").cast(C.MONEY))})
    per_result = lots.groupBy("revision_id").agg(F.bool_or("is_unresolved").alias("u"), F.count_if(has).alias("w"), F.countDistinct(F.when(has, F.col("lot_currency"))).alias("n"), F.min(F.when(has, F.col("lot_currency"))).alias("only"), F.sum(F.when(has, F.col("winning_price"))).cast(C.MONEY).alias("total"), F.count_if(has & F.col("winning_price").isNull()).alias("none"))
    head = head.join(per_result.hint("merge"), "revision_id", "left")
    certain = ~yes("u") & (F.col("w") > 0) & (F.col("none") == 0) & (F.col("n") == 1) & ~F.col("currency_conflict")
    out["result_revision"] = head.withColumns({"winning_price": F.when(certain, F.col("total")), "currency": F.coalesce("currency", F.when(certain, F.col("only")))}).drop("u", "w", "n", "only", "total", "none", "currency_conflict", "unit", "estimate_unit")
    out["award_lot"] = lots.select("award_lot_id", "revision_id", "lot_ordinal", "source_lot_id", "lot_no", "lot_name", "lot_price", "lot_currency", "winning_price", "is_unresolved")
    out["award_contractor"] = people.drop("outcome_issue", "winning_price_issue", "lot_currency", "observation_id")
    if only is not None and "quality_issue" not in only:
        return out
    lot_path = F.concat(F.lit("lotResultDTO["), F.col("lot_ordinal").cast("string"), F.lit("]"))
    person = F.concat(lot_path, F.lit(".contractorList["), F.col("contractor_ordinal").cast("string"), F.lit("]"))
    scale = F.coalesce(F.col("winning_price") > F.col("lot_price") * 100, F.lit(False))
    # All issues of a contractor, and all of a lot, in one pass each.
    of_lot = [(lot_path, F.when(fault, code), "warn") for code, fault in (("incomplete_winner_price", yes("no_price")), ("unverified_zero_winning_price", yes("tiny_price")), ("unverified_consortium_allocation", yes("split_consortium")), ("price_scale_anomaly", scale))]
    more = [found_issues(people.withColumn("issues", C.issues((person, F.col("outcome_issue"), "warn"), (person, F.col("winning_price_issue"), "warn")))), found_issues(lots.withColumn("issues", C.issues(*of_lot, (lot_path, F.col("price_issue"), "warn"))))]
    added = reduce(DataFrame.unionByName, more).select("observation_id", "x.code", "x.path", "x.severity").withColumn("issue_id", C.digest(F.col("observation_id"), F.col("code"), F.col("path")))
    out["quality_issue"] = out["quality_issue"].unionByName(added).dropDuplicates(["issue_id"])
    return out


def assemble(tables: dict[str, DataFrame], revision: str, children: list[str] = (), day: str = "public_date") -> dict[str, DataFrame]:
    """SLV-26: revisions once each, ``source_month``, and ``is_current`` where an entity's latest observation names one revision only."""
    out = dict(tables)
    one = tables[revision].groupBy("revision_id").agg(F.max("observed_at").alias("_seen")).join(tables[revision].dropDuplicates(["revision_id"]).hint("merge"), "revision_id")
    latest = one.groupBy("entity_id").agg(F.max("_seen").alias("_last"))
    at_last = one.join(latest.hint("merge"), "entity_id").filter("_seen = _last").groupBy("entity_id").agg(F.count("*").alias("_n"), F.min("revision_id").alias("_r"))
    rows = one.join(at_last.hint("merge"), "entity_id").withColumn("is_current", (F.col("_n") == 1) & (F.col("revision_id") == F.col("_r")))
    rows = rows.withColumn("source_month", F.trunc(day if day in one.columns else F.to_date("observed_at"), "month"))
    out[revision] = rows.drop("_seen", "_n", "_r")
    for c in children:
        out[c] = tables[c].dropDuplicates([f"{c}_id"] if f"{c}_id" in tables[c].columns else None).join(out[revision].select("revision_id", "source_month").hint("merge"), "revision_id")
    conflict = rows.filter((F.col("_n") > 1)).select("observation_id", F.lit("conflicting_revisions").alias("code"), F.lit("revision").alias("path"), F.lit("error").alias("severity")).distinct()
    conflict = conflict.withColumn("issue_id", C.digest(F.col("observation_id"), F.col("code"), F.col("path")))
    out["quality_issue"] = tables["quality_issue"].unionByName(conflict) if "quality_issue" in tables else conflict
    return out


def integrity(tables: dict[str, DataFrame], revision: str, children: list[str] = ()) -> DataFrame:
    """SLV-27: (violation, key): observations neither accepted nor quarantined, or both, and children without their revision."""
    obs, rev, qua = tables["observation"].select("observation_id").distinct(), tables[revision].select("observation_id"), tables["quarantine"].select("observation_id")
    found = [obs.join(rev.unionByName(qua).hint("merge"), "observation_id", "left_anti").select(F.lit("lost_observation").alias("violation"), F.col("observation_id").alias("key")), rev.join(qua.hint("merge"), "observation_id", "left_semi").select(F.lit("accepted_and_quarantined").alias("violation"), F.col("observation_id").alias("key"))]
    found += [tables[c].join(tables[revision].select("revision_id").hint("merge"), "revision_id", "left_anti").select(F.lit(f"orphan_{c}").alias("violation"), F.col("revision_id").alias("key")) for c in children]
    return reduce(DataFrame.unionByName, found)


def unapproved(errors: DataFrame, approved: DataFrame, key: list[str], root: Column) -> DataFrame:
    """SLV-29: errors that no approved exception covers; an exception holds only while the record's root is null."""
    return errors.withColumn("_null", root.isNull() | (F.trim(root) == "null")).join(approved.select(*key).withColumn("_null", F.lit(True)), [*key, "_null"], "left_anti").drop("_null")


def link_contracts(reports: DataFrame, contracts: DataFrame) -> DataFrame:
    """SLV-30: performance reports with their contract by code and version, and why there is none."""
    codes = contracts.select("contract_code").distinct().withColumn("_c", F.lit(True))
    exact = contracts.groupBy("contract_code", "contract_version").agg(F.min("entity_id").alias("contract_entity_id"))
    rows = reports.join(codes, "contract_code", "left").join(exact, ["contract_code", "contract_version"], "left")
    return rows.withColumn("resolution", F.when(F.col("contract_entity_id").isNotNull(), "resolved").when(F.col("_c"), "missing_contract_version").otherwise("missing_contract")).drop("_c")

