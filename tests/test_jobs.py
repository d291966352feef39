from collections import Counter
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from telmart import __main__ as command
from telmart.functions.labels import age
from telmart.plans import jobs, marts, registry
from telmart.session import new_folder
from telmart.sources import files, fixtures, messages

SF_DIR = "/root/testdata/sf0.001"


def test_progress_moves_only_after_success(spark, tmp_path):
    revenue, progress = fixtures.revenue(spark, SF_DIR), f"{tmp_path}/progress"

    def fail(rows):
        raise OSError("broker gone")

    assert jobs.next_week(spark, progress) == 22
    with pytest.raises(OSError):
        jobs.publish_next_week(spark, revenue, progress, fail)
    assert jobs.next_week(spark, progress) == 22
    sent = []
    for _ in range(2):
        jobs.publish_next_week(spark, revenue, progress, lambda rows: sent.append(rows.count()))
    assert jobs.next_week(spark, progress) == 24
    assert sent == [revenue.filter(f"week_number = {week}").count() for week in (22, 23)]


def test_a_staged_week_is_one_partition(spark, tmp_path):
    revenue = fixtures.revenue(spark, SF_DIR)
    jobs.stage_revenue(revenue, f"{tmp_path}/staged")
    staged = jobs.read_staged_revenue(spark, f"{tmp_path}/staged")
    assert Counter(map(tuple, staged.collect())) == Counter(map(tuple, revenue.collect()))
    plan = messages.week_messages(staged, 23)._jdf.queryExecution().executedPlan().toString()
    assert "week_number = 23" in plan or "(week_number#" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_loaded_collections_are_left_alone(spark, tmp_path):
    place = f"{tmp_path}/collection"
    assert not jobs.is_loaded(spark, place)
    one = spark.range(1)
    one.filter("id > 5").write.parquet(place)
    assert not jobs.is_loaded(spark, place)
    assert jobs.guarded_load(spark, place, lambda: one)
    assert not jobs.guarded_load(spark, place, lambda: pytest.fail("must not be read"))
    assert spark.read.parquet(place).count() == 1


def test_collections_lose_their_identifier(spark, tmp_path):
    rows = spark.range(3).selectExpr("string(id) AS msisdn", "uuid() AS _id")
    for _ in range(2):
        files.append_collection(rows, f"{tmp_path}/c")
    found = files.read_collection(spark, f"{tmp_path}/c")
    assert found.columns == ["msisdn"] and found.count() == 6


def test_a_second_run_replaces_reports(spark, tmp_path):
    activity = registry.queries()["subscriber_activity"](spark, SF_DIR)
    for _ in range(2):
        tables = jobs.create_marts(spark, activity, str(tmp_path), registry.AS_OF, "twice_")
        jobs.export_tables(spark, tables, f"{tmp_path}/out")
    assert len(tables) == len(marts.MARTS) == 35
    for table in ("twice_total_devices", "twice_distrbution_os_name_by_age"):
        assert jobs.read_export(spark, table, f"{tmp_path}/out").count() == spark.table(table).count() > 0


class Settings:
    def __init__(self, **settings):
        self.conf = {key.replace("_", "."): value for key, value in settings.items()}


def test_one_rule_for_the_shared_folder(spark):
    assert new_folder(spark, "x") != new_folder(spark, "x")
    assert new_folder(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    for master in ("yarn", "local[2]"):
        own = Settings(spark_master=master, spark_sql_warehouse_dir="hdfs:///warehouse")
        assert new_folder(own, "x").startswith("hdfs:///warehouse/x-")
        own = Settings(spark_master=master, spark_sql_warehouse_dir="w", spark_checkpoint_dir="hdfs:///shared/")
        assert new_folder(own, "x").startswith("hdfs:///shared/x-")


def test_a_week_is_sent_when_it_is_staged(spark, tmp_path):
    revenue, staged, progress = fixtures.revenue(spark, SF_DIR), f"{tmp_path}/staged", f"{tmp_path}/progress"
    sent = []

    def publish():
        return jobs.publish_next_week(
            spark, jobs.read_staged_revenue(spark, staged), progress, lambda rows: sent.append(rows.count()))

    jobs.stage_revenue(revenue.filter("week_number = 22"), staged)
    assert [publish(), publish(), publish()] == [22, None, None]
    jobs.stage_revenue(revenue.filter("week_number <= 23"), staged)
    assert [publish(), publish()] == [23, None]
    assert sent == [revenue.filter(f"week_number = {week}").count() for week in (22, 23)]


def text_file(path, text):
    path.write_text(text)
    return str(path)


def test_text_tables_are_read_by_header(spark, tmp_path):
    text = "gender,value_segment,year_of_birth,x,msisdn,mobile_type,system_status\nmale,Tier_1, 1990.0 ,?,k1,Prepaid,ACTIVE\n"
    row = files.scan_crm(spark, text_file(tmp_path / "crm.csv", text)).first()
    assert row.asDict() == {
        "msisdn": "k1", "gender": "male", "year_of_birth": "1990.0", "system_status": "ACTIVE",
        "mobile_type": "Prepaid", "value_segment": "Tier_1"}
    text = "week_number,revenue_usd,msisdn\n 22 ,1.00499,k1\n23, ,k2\n"
    rows = files.scan_revenue(spark, text_file(tmp_path / "revenue.csv", text)).collect()
    assert [(r.msisdn, r.week_number, r.revenue_usd) for r in rows] == [("k1", 22, Decimal("1.00499")), ("k2", 23, None)]


def test_text_tables_that_are_wrong_stop_the_job(spark, tmp_path):
    with pytest.raises(ValueError, match="week_number"):
        files.scan_revenue(spark, text_file(tmp_path / "a.csv", "week,revenue_usd,msisdn\n22,1,k\n"))
    for line in ("22,a lot,k", "soon,1,k"):
        path = text_file(tmp_path / "b.csv", f"week_number,revenue_usd,msisdn\n{line}\n")
        with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
            files.scan_revenue(spark, path).collect()
    folder = tmp_path / "two"
    folder.mkdir()
    text_file(folder / "1.csv", "week_number,revenue_usd,msisdn\n22,1,k\n")
    text_file(folder / "2.csv", "msisdn,week_number,revenue_usd\nk,22,1\n")
    with pytest.raises(Exception, match="(?i)header"):
        files.scan_revenue(spark, str(folder)).collect()


@pytest.mark.parametrize("year, years", [("1990", 34), ("1990.0", 34), (" 1990", 34), ("1990.5", None), ("x", None), (None, None)])
def test_ages_of_whole_numbers(spark, year, years):
    frame = spark.createDataFrame([(year,)], "y string")
    assert frame.select(age(F.col("y"), registry.AS_OF)).first()[0] == years


@pytest.mark.parametrize("more", [
    ["--folder", "f", "--max-messages", "5", "--facts", "x"], ["--servers", "s", "--broadcast-messages", "--facts", "x"],
    ["--folder", "f"], ["--folder", "f", "--facts", "x", "--format", "orc"],
])
def test_options_that_do_not_go_together(more, capsys):
    with pytest.raises(SystemExit):
        command.main(["enrich", "--cleaned", "c", "--checkpoint", "p", *more])


def test_jobs_from_the_command_line(spark, tmp_path):
    files.write_text_table(fixtures.crm_raw(spark, SF_DIR), f"{tmp_path}/crm.csv")
    files.write_text_table(fixtures.device_raw(spark, SF_DIR), f"{tmp_path}/device.csv")
    files.write_text_table(fixtures.revenue(spark, SF_DIR), f"{tmp_path}/revenue.csv")
    path = {name: f"{tmp_path}/{name}" for name in
            ("cleaned", "staged", "progress", "topic", "facts", "checkpoint", "tables", "export")}

    def run(job, *names, **more):
        arguments = [job]
        for name in names:
            arguments += [f"--{name}", path[name]]
        for name, value in more.items():
            arguments += [f"--{name.replace('_', '-')}"] + ([] if value is True else [value])
        command.main(arguments)

    run("clean", "cleaned", crm=f"{tmp_path}/crm.csv", device=f"{tmp_path}/device.csv")
    run("stage", "staged", revenue=f"{tmp_path}/revenue.csv")
    for _ in range(2):
        run("publish", "staged", "progress", folder=path["topic"])
    run("enrich", "cleaned", "facts", "checkpoint", folder=path["topic"], once=True)
    run("marts", "facts", "tables", "export", as_of=registry.AS_OF)
    report = spark.table("total_customers_weekwise").collect()
    expected = registry.queries()["customers_by_week"](spark, SF_DIR).filter("week_number <= 23").collect()
    assert [tuple(row) for row in report] == [tuple(row) for row in expected]
    exported = jobs.read_export(spark, "total_customers_weekwise", path["export"])
    assert sorted(map(tuple, exported.collect())) == [tuple(row) for row in expected]
