"""The index of linked revisions over the seven root tables: typed tokens, components, optional plan links (GRF-1, GRF-5), and closures over components (JN-11)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revlake.operators.graph import components, links

# Where each root table has its keys; of several columns the first that isn't blank.
KEYS = {
    "package_revision": {"package_id": ["source_id", "entity_id"], "package_no": ["package_no"], "plan_id": ["plan_id"], "plan_no": ["plan_no"]},
    "plan_revision": {"plan_id": ["source_id", "entity_id"], "plan_no": ["plan_no"]},
    "notice_revision": {"package_id": ["package_id"], "package_no": ["package_no"], "notify_no": ["notify_no"]},
    "result_revision": {"package_id": ["bid_id"], "package_no": ["package_no"], "notify_no": ["notify_no"]},
    "opening_revision": {"package_id": ["package_id"], "package_no": ["package_no"], "notify_no": ["notify_no"]},
    "contract_revision": {"notify_no": ["notice_no"], "plan_no": ["contract_code"]},
    "contract_performance_revision": {"plan_no": ["contract_code"]},
}
# Token families of each table's impact links: family, column, and whether it is the id inside the stored root.
FAMILIES = {
    "package_revision": [("package", "entity_id", False), ("package", "id", True), ("package_code", "package_no", False), ("plan", "plan_id", False), ("plan_code", "plan_no", False)],
    "plan_revision": [("plan", "entity_id", False), ("plan", "id", True), ("plan_code", "plan_no", False)],
    "notice_revision": [("package", "package_id", False), ("package_code", "package_no", False), ("notice", "notify_no", False)],
    "result_revision": [("package", "bid_id", False), ("package_code", "package_no", False), ("notice", "notify_no", False), ("result", "result_id|entity_id", False)],
    "opening_revision": [("notice", "notify_no", False), ("package_code", "package_no", False), ("package", "package_id", False)],
    "contract_revision": [("notice", "notice_no", False), ("contract", "contract_code", False)],
    "contract_performance_revision": [("contract", "contract_code", False)],
}
CONTRACTS, PLANNED = ["contract_revision", "contract_performance_revision"], ["package_revision", "plan_revision"]
UPSTREAM = ["package_revision", "notice_revision", "plan_revision", "opening_revision", "contract_revision"]
# End of the fixed values.

COLUMNS = ["package_id", "package_no", "notify_no", "plan_id", "plan_no"]


def first_filled(df: DataFrame, names: list[str], *, trimmed: bool = True) -> Column:
    """The first of the columns that ``df`` has and that isn't blank; null if there is none."""
    found = [F.col(n).cast("string") for n in names if n in df.columns]
    return F.coalesce(*(F.nullif(F.trim(c), F.lit("")) if trimmed else c for c in found), F.lit(None).cast("string"))


def revision_keys(tables: dict[str, DataFrame]) -> DataFrame:
    """(entity_type, entity_id, revision_id, public_date, source_month, keys) of all revisions of an entity; tables that aren't there count as empty.

    A contract's code stands in ``plan_no``. Contracts without a publication date have that of their source."""
    out = []
    for name, keys in KEYS.items():
        df = tables.get(name)
        if df is None:
            continue
        date = F.coalesce(*(F.col(c).cast("date") for c in (["public_date", "source_date"] if name in CONTRACTS else ["public_date"]) if c in df.columns), F.lit(None).cast("date"))
        rows = df.filter("entity_id is not null").select(F.lit(name).alias("entity_type"), F.col("entity_id").cast("string").alias("entity_id"), "revision_id", date.alias("public_date"), *(first_filled(df, keys.get(k, [])).alias(k) for k in COLUMNS))
        out.append(rows.withColumn("source_month", F.date_format("public_date", "yyyy-MM")))
    return reduce(DataFrame.unionByName, out)


def tokens(rows: DataFrame, plan_links: bool = False) -> DataFrame:
    """(node, token) of ``revision_keys``. A plan's id and number link only if asked for: with them all packages of a plan are one component; without, they are kept as keys."""
    of = lambda names: F.col("entity_type").isin(names)
    families = {"pkg_id": "package_id", "pkg_no": "package_no", "notify_no": "notify_no"}
    each = [(family, F.col(c)) for family, c in families.items()] + [("pkg_id", F.when(of(["package_revision"]), F.col("entity_id"))), ("contract", F.when(of(CONTRACTS), F.col("plan_no")))]
    if plan_links:
        each += [("plan_id", F.col("plan_id")), ("plan_id", F.when(of(["plan_revision"]), F.col("entity_id"))), ("plan_no", F.when(of(PLANNED), F.col("plan_no")))]
    found = F.array(*(F.when(c.isNotNull(), F.concat(F.lit(f"{family}:"), c)) for family, c in each))
    return rows.select(F.concat_ws(":", "entity_type", "entity_id").alias("node"), F.explode(found).alias("token")).filter("token is not null").distinct()


def index(tables: dict[str, DataFrame], plan_links: bool = False) -> DataFrame:
    """GRF-5: ``revision_keys`` with ``component_id``, the smallest node (``entity_type:entity_id``) that shared tokens reach; an entity without tokens is its own component."""
    rows = revision_keys(tables)
    found = components(tokens(rows, plan_links))
    node = F.concat_ws(":", "entity_type", "entity_id")
    return rows.withColumn("node", node).join(found, "node", "left").select(F.coalesce("component", "node").alias("component_id"), "entity_type", "entity_id", "revision_id", "public_date", "source_month", *COLUMNS)


def upstream(index_: DataFrame, seeds: DataFrame, tables: dict[str, DataFrame], before: str) -> dict[str, DataFrame]:
    """JN-11: of each upstream table the revisions that share a component with a revision in ``seeds`` and were published before the day ``before``; those without a date aren't known to be.

    Components of seeds are grouped before they meet the index, and only revision ids go on to the tables."""
    hit = index_.join(seeds.select("revision_id").distinct(), "revision_id", "left_semi").select("component_id").distinct()
    linked = index_.filter(F.col("public_date") < F.lit(before).cast("date")).join(hit, "component_id", "left_semi").select("entity_type", "revision_id").distinct()
    return {name: tables[name].join(linked.filter(F.col("entity_type") == name).select("revision_id"), "revision_id", "left_semi") for name in UPSTREAM if name in tables}


def impact_links(tables: dict[str, DataFrame]) -> DataFrame:
    """GRF-1: distinct (node, token) over the root tables by their typed families; the id inside a stored root (``root_json``) links like the entity's own."""
    out = []
    for name, families in FAMILIES.items():
        df = tables.get(name)
        if df is None:
            continue
        for family, column, inside in families:
            if inside and "root_json" not in df.columns:
                continue
            value = F.get_json_object("root_json", f"$.{column}") if inside else first_filled(df, column.split("|"), trimmed=False)
            out.append(links(df, F.concat(F.lit(f"{name}:"), F.col("entity_id").cast("string")), {family: value}))
    return reduce(DataFrame.unionByName, out).distinct()
