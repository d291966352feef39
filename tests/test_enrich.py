from collections import Counter
from decimal import Decimal

from pyspark.sql import functions as F

from telmart import schemas
from telmart.functions.money import cents, dollars
from telmart.operators import crm, device, enrich
from telmart.plans import marts, registry
from telmart.sources import fixtures

SF_DIR = "/root/testdata/sf0.001"
CRM = "msisdn string, gender string, year_of_birth string, system_status string, mobile_type string, value_segment string"


def small(spark):
    customers = spark.createDataFrame(
        [("both", "male", "1980", "ACTIVE", "Prepaid", "Tier_1"),
         ("crm", "female", "Not Available", "IDLE", "Prepaid", "Tier_2")], CRM)
    devices = spark.createDataFrame(
        [("both", "1", "b", "m", "o", "v"), ("device", "2", "b", "m", "o", "v")], schemas.DEVICE)
    revenue = spark.createDataFrame(
        [("both", 22, Decimal("1.0050")), ("both", 22, Decimal("0.1250")), ("both", 23, None),
         ("crm", 22, Decimal("2.0049")), ("device", 23, Decimal("4.0000")),
         ("stranger", 22, Decimal("9.0000")), (None, 22, Decimal("9.0000"))], schemas.REVENUE)
    return customers, devices, revenue


def test_inner_join_keeps_known_subscribers_only(spark):
    customers, devices, revenue = small(spark)
    facts = enrich.subscriber_week(enrich.subscribers(customers, devices), revenue)
    assert facts.columns == schemas.FACTS.names
    assert Counter(row.msisdn for row in facts.collect()) == {"both": 3, "crm": 1, "device": 1}


def test_cents_are_rounded_before_the_sum(spark):
    customers, devices, revenue = small(spark)
    rows = enrich.subscriber_activity(customers, devices, enrich.activity(revenue, weekly=False))
    found = {row.msisdn: (row.events, row.revenue, row.highest, row.lowest) for row in rows.collect()}
    assert found["both"] == (3, 114, 101, 13)
    assert found["crm"] == (1, 200, 200, 200)


def test_amounts_in_reports_are_exact(spark):
    frame = spark.createDataFrame(
        [(Decimal("99999999999999.9950"),), (Decimal("-0.0050"),), (Decimal("0.0049"),), (None,),
         (Decimal("1.00499"),), (Decimal("7.444999"),), (Decimal("7.4450000001"),)],
        "usd decimal(28,10)")
    found = frame.select(cents(F.col("usd")), dollars(cents(F.col("usd")))).collect()
    assert [tuple(row) for row in found] == [
        (10**16, 1e14), (-1, -0.01), (0, 0.0), (None, None), (100, 1.0), (744, 7.44), (745, 7.45)]


def test_ages_without_a_birth_year(spark):
    customers, devices, revenue = small(spark)
    rows = enrich.subscriber_activity(customers, devices, enrich.activity(revenue))
    report = marts.build(marts.BY_NAME["brand_by_age_band"], rows, "2024-06-30")
    assert {tuple(row) for row in report.collect()} == {("40-49", "b", 3), (None, None, 1), (None, "b", 1)}


def test_empty_facts_count_zero(spark):
    customers, devices, revenue = small(spark)
    rows = enrich.subscriber_activity(customers, devices, enrich.activity(revenue.filter("false")))
    assert marts.build(marts.BY_NAME["total_customers"], rows).first()[0] == 0
    assert marts.build(marts.BY_NAME["total_devices"], rows).first()[0] == 0


def test_reports_agree_on_events_roll_up_and_summary(spark):
    customers = crm.clean(fixtures.crm_raw(spark, SF_DIR))
    devices = device.clean(fixtures.device_raw(spark, SF_DIR))
    revenue = fixtures.revenue(spark, SF_DIR)
    events = enrich.as_activity(enrich.subscriber_week(enrich.subscribers(customers, devices), revenue))
    rolled_up = enrich.subscriber_activity(customers, devices, enrich.activity(revenue))
    summary = marts.summary(events)
    for name in ("revenue_by_segment_age_week", "revenue_range_by_os_week", "active_devices_by_week"):
        mart = marts.BY_NAME[name]
        results = [
            Counter(map(tuple, marts.build(mart, rows, registry.AS_OF).collect()))
            for rows in (events, rolled_up, summary)
        ]
        assert results[0] and results[0] == results[1] == results[2]


def test_hot_subscribers_are_split_in_the_event_join(spark):
    settings = {
        "spark.sql.shuffle.partitions": "32",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        revenue = spark.range(0, 60000, 1, 8).selectExpr(
            "if(id % 3 = 0, 'hot', string(id % 5000)) AS msisdn", "22 AS week_number",
            "cast(id AS decimal(28,10)) AS revenue_usd")
        known = spark.range(0, 5001, 1, 2).selectExpr(
            "if(id = 5000, 'hot', string(id)) AS msisdn", "'male' AS gender")
        facts = enrich.subscriber_week(known, revenue)
        assert len(facts.collect()) == 60000
        plan = facts._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin(skew=true)" in plan
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
