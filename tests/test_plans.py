"""What plans must not do: parse a payload once for each use of each of its fields."""

from pathlib import Path

import pytest
from conftest import DATA
from pyspark.sql import functions as F

from revlake.plans import catalog


@pytest.mark.parametrize("name", ["silver_package", "silver_package_lots", "silver_result_references"])
def test_fields_are_read_in_one_pass(spark, name):
    plan = catalog.queries()[name](spark, DATA)._jdf.queryExecution().optimizedPlan().toString()
    # What is left reads a list that is text, and the path inside a member; each list once.
    assert plan.count("get_json_object(") <= 8
    assert "json_tuple(" in plan


@pytest.mark.parametrize("name", ["opening_submissions", "opening_lots"])
def test_openings_are_parsed_once_a_scan(spark, name):
    plan = catalog.queries()[name](spark, DATA)._jdf.queryExecution().optimizedPlan().toString()
    assert 0 < plan.count("parse_json(") + plan.count("parseJson") <= 4


def through_driver(spark, name):
    """Broadcasts in a query's plan: what they send goes through the driver whole."""
    return catalog.queries()[name](spark, DATA)._jdf.queryExecution().executedPlan().toString().count("BroadcastExchange")


@pytest.mark.parametrize("name", ["opening_phases", "opening_submissions", "opening_lots"])
def test_payloads_are_not_broadcast(spark, name):
    assert through_driver(spark, name) == 0


def test_openings_store_no_digests(spark):
    """Digests don't compress: tables that hold some for each lot take many times the disk of the input."""
    base = Path(spark.conf.get("spark.checkpoint.dir"))
    before = set(base.glob("openings-*"))
    catalog.queries()["opening_reconciliation"](spark, DATA)
    (folder,) = set(base.glob("openings-*")) - before
    for path in sorted(folder.iterdir()):
        df = spark.read.parquet(str(path))
        texts = [f.name for f in df.schema if f.dataType.simpleString() == "string"]
        found = df.select(*(F.max(F.col(c).rlike("^[0-9a-f]{64}$")).alias(c) for c in texts)).first().asDict()
        assert not [c for c, digest in found.items() if digest], path.name
