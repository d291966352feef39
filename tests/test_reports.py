"""Reports after new facts, while they are read, and when a build fails."""

import pytest
from pyspark.sql import functions as F

from telmart.plans import jobs, marts, registry

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def activity(spark, tmp_path_factory):
    place = str(tmp_path_factory.mktemp("activity") / "a")
    registry.queries()["subscriber_activity"](spark, SF_DIR).withColumns(
        {name: F.round(F.col(name) * 100).cast("bigint") for name in ("revenue", "highest", "lowest")}
    ).write.partitionBy("week_number").parquet(place)
    return spark.read.parquet(place)


def contents(spark, tables):
    return {table.split("_", 1)[1]: sorted(map(repr, spark.table(table).collect())) for table in tables}


def test_a_new_week_reads_that_week_and_equals_a_rebuild(spark, activity, tmp_path):
    whole = jobs.create_marts(spark, activity, f"{tmp_path}/whole", registry.AS_OF, "whole_")
    jobs.create_marts(spark, activity.where("week_number < 25"), f"{tmp_path}/steps", registry.AS_OF, "steps_")
    rows = activity.where(F.col("week_number").isin([25, 26]))
    plan = marts.by_week(rows)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [week_number" in plan and plan.count("FileScan") == 1
    untouched = sorted(x.name for x in (tmp_path / "steps/weeks/part=summary/week_number=22").glob("*.parquet"))
    # A week comes again as a whole: it replaces what it was.
    for weeks in ([25], [25, 26], [22]):
        steps = jobs.create_marts(spark, activity, f"{tmp_path}/steps", registry.AS_OF, "steps_", weeks)
        if weeks != [22]:
            now = sorted(x.name for x in (tmp_path / "steps/weeks/part=summary/week_number=22").glob("*.parquet"))
            assert now == untouched
    assert contents(spark, steps) == contents(spark, whole)
    numbers = spark.read.parquet(f"{tmp_path}/steps/numbers")
    assert numbers.count() == numbers.select("number").distinct().count() == numbers.select("imei_tac").distinct().count()
    jobs.drop_tables(spark, whole + steps)


def test_readers_and_failed_builds_keep_the_old_reports(spark, activity, tmp_path, monkeypatch):
    few = activity.where("week_number = 22")
    tables = jobs.create_marts(spark, few, str(tmp_path), registry.AS_OF, "kept_")
    reader, before = spark.table("kept_total_customers_weekwise"), contents(spark, tables)
    real = marts.build

    def fail(mart, *rest):
        if mart.name == "os_by_age_band":
            raise RuntimeError("no space")
        return real(mart, *rest)

    monkeypatch.setattr(marts, "build", fail)
    with pytest.raises(RuntimeError):
        jobs.create_marts(spark, activity, str(tmp_path), registry.AS_OF, "kept_")
    assert contents(spark, tables) == before
    monkeypatch.setattr(marts, "build", real)
    jobs.create_marts(spark, activity, str(tmp_path), registry.AS_OF, "kept_")
    assert [row.week_number for row in reader.collect()] == [22]
    assert spark.table("kept_total_customers_weekwise").count() > 1
    jobs.drop_tables(spark, tables)


def test_devices_are_counted_once_over_weeks_and_statuses(spark, tmp_path):
    rows = [(22, "ACTIVE", "a"), (22, "IDLE", "a"), (23, "ACTIVE", "a"), (23, "ACTIVE", "b"), (23, None, "c"), (24, "ACTIVE", None)]
    empty = {name: F.lit(None).cast("string") for name in marts.DIMENSIONS if name not in ("week_number", "system_status")}
    frame = spark.createDataFrame(rows, "week_number int, system_status string, imei_tac string").withColumns(empty).withColumns(
        {name: F.lit(1).cast("bigint") for name in ("events", "revenue", "highest", "lowest")})
    for weeks in (None, [23], [22, 24]):
        jobs.create_marts(spark, frame, str(tmp_path), registry.AS_OF, "count_", weeks)
        assert spark.table("count_total_devices").first()[0] == 3
        assert spark.table("count_total_active_devices").first()[0] == 2
        assert spark.table("count_total_customers").first()[0] == 6
    jobs.drop_tables(spark, [f"count_{mart.table}" for mart in marts.MARTS])


def test_no_facts(spark, activity, tmp_path):
    tables = jobs.create_marts(spark, activity.limit(0), str(tmp_path), registry.AS_OF, "none_")
    assert spark.table("none_total_devices").first()[0] == 0 and spark.table("none_total_customers_weekwise").count() == 0
    jobs.drop_tables(spark, tables)
