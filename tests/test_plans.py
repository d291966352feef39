"""What the physical plans must and must not contain."""

import re

import pytest

from telmart import schemas
from telmart.operators import crm, device, enrich
from telmart.plans import marts, registry
from telmart.sources import fixtures

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(autouse=True)
def no_automatic_broadcast(spark):
    """Plans as they are for tables that are too large to broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.fixture
def inputs(spark, tmp_path):
    frames = []
    for name, schema, rows in (
        ("crm", schemas.CRM, fixtures.crm_raw), ("device", schemas.DEVICE, fixtures.device_raw),
        ("revenue", schemas.REVENUE, fixtures.revenue),
    ):
        rows(spark, SF_DIR).write.parquet(f"{tmp_path}/{name}")
        frames.append(spark.read.schema(schema).parquet(f"{tmp_path}/{name}"))
    return frames


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def shuffles(frame):
    return re.findall(r"Exchange (\w+\(.*?\)|\w+)", plan_of(frame))


def test_cleaning_shuffles(inputs):
    raw_crm, raw_device, _ = inputs
    assert len(shuffles(crm.clean(raw_crm))) == 2
    assert len(shuffles(device.clean(raw_device))) == 1


def test_full_join_adds_no_shuffle(inputs):
    raw_crm, raw_device, _ = inputs
    known = enrich.subscribers(crm.clean(raw_crm), device.clean(raw_device))
    assert len(shuffles(known)) == 3


def test_report_joins_reuse_the_cleaned_partitioning(inputs):
    raw_crm, raw_device, revenue = inputs
    for weekly, roll_up_shuffles in ((True, 2), (False, 1)):
        rows = enrich.subscriber_activity(
            crm.clean(raw_crm), device.clean(raw_device), enrich.activity(revenue, weekly))
        assert len(shuffles(rows)) == 3 + roll_up_shuffles


def test_four_sorts_clean_the_customers(inputs):
    sorts = [line for line in plan_of(crm.clean(inputs[0])).splitlines() if re.search(r"- Sort \[", line)]
    assert len(sorts) <= 4


def test_reports_read_only_their_columns(inputs):
    raw_crm, raw_device, revenue = inputs
    rows = enrich.subscriber_activity(
        crm.clean(raw_crm), device.clean(raw_device), enrich.activity(revenue, weekly=False))
    plan = plan_of(marts.build(marts.BY_NAME["customers_by_mobile_type"], rows))
    assert "msisdn:string" in re.findall(r"ReadSchema: struct<([^>]*)>", plan)


def test_reports_without_device_columns_do_not_choose_devices(spark):
    for mart in marts.MARTS:
        plan = plan_of(registry.queries()[mart.name](spark, SF_DIR))
        assert ("p_brand" in plan) == mart.shows_devices


@pytest.mark.parametrize("name", ["crm_clean", "device_clean", "subscriber_week", *marts.BY_NAME])
def test_no_pairs_without_a_key(spark, name):
    plan = plan_of(registry.queries()[name](spark, SF_DIR))
    assert "Cartesian" not in plan and "NestedLoop" not in plan and "Broadcast" not in plan
    assert "Python" not in plan and "Pandas" not in plan
