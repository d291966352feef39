"""Text files with faults, collections whose documents differ, added rows."""

import json

import pytest
from pyspark.sql import functions as F, types as T

from telmart import __main__ as command, schemas
from telmart.operators import crm, device
from telmart.plans import added, jobs
from telmart.sources import collections, files

REVENUE = "week_number,further,msisdn,revenue_usd\n"


def text(folder, name, content):
    path = folder / name
    path.write_text(content)
    return str(path)


def test_records_that_cannot_be_used(spark, tmp_path):
    path = text(tmp_path, "revenue.csv", REVENUE + "22,x,a,1.5\n 23 ,x,b,\nw24,x,c,2\n25,x\n26,x,d,n/a,more\nw27,\"x,y\",,zz\n,x,,\n")
    rows = jobs.scan_checked(spark, path, schemas.REVENUE, f"{tmp_path}/rejects", most=0.6)
    assert sorted((r.msisdn or "", r.week_number, r.revenue_usd and float(r.revenue_usd)) for r in rows.collect()) == [
        ("", None, None), ("a", 22, 1.5), ("b", 23, None)]
    found = {(r.text, r.cause) for r in jobs.read_rejects(spark, f"{tmp_path}/rejects").collect()}
    assert found == {
        ("w24,x,c,2", "week_number"), ("25,x", "fields"), ("26,x,d,n/a,more", "fields"),
        ('w27,"x,y",,zz', "week_number, revenue_usd")}


def test_too_many_rejects_stop_the_load_and_are_kept(spark, tmp_path):
    path = text(tmp_path, "revenue.csv", REVENUE + "22,x,a,1.5\nw24,x,c,2\n")
    with pytest.raises(ValueError, match="1 of 2"):
        jobs.scan_checked(spark, path, schemas.REVENUE, f"{tmp_path}/rejects", most=0.4)
    assert jobs.read_rejects(spark, f"{tmp_path}/rejects").count() == 1
    with pytest.raises(ValueError, match="no column msisdn"):
        jobs.scan_checked(spark, text(tmp_path, "other.csv", "a,b\n1,2\n"), schemas.REVENUE, f"{tmp_path}/other")


def test_an_empty_file_has_no_rejects(spark, tmp_path):
    path = text(tmp_path, "revenue.csv", REVENUE)
    assert jobs.scan_checked(spark, path, schemas.REVENUE, f"{tmp_path}/rejects").collect() == []


@pytest.mark.parametrize("one, two, both", [
    ("int", "bigint", "bigint"), ("tinyint", "smallint", "smallint"), ("int", "double", "double"),
    ("bigint", "double", "string"), ("decimal(5,2)", "int", "decimal(12,2)"), ("decimal(38,0)", "decimal(38,10)", "string"),
    ("float", "smallint", "double"), ("date", "int", "string"), ("boolean", "boolean", "boolean"),
    ("array<int>", "array<bigint>", "array<bigint>"), ("array<int>", "int", "string"),
    ("struct<a:int>", "struct<A:string,b:date>", "struct<a:string,b:date>"), ("void", "date", "date"),
])
def test_the_type_that_holds_both(one, two, both):
    kinds = [T.StructType.fromDDL(f"x {kind}")[0].dataType for kind in (one, two)]
    assert collections.widest(*kinds).simpleString() == both
    if not both.startswith("struct"):
        assert collections.widest(*reversed(kinds)).simpleString() == both


def test_documents_of_different_fields(spark, tmp_path):
    place = f"{tmp_path}/c"
    collections.append_documents(spark.sql(
        "SELECT 1 AS id, named_struct('a', 1) AS inner, array(1, null) AS many, 'k' AS _id"), place)
    collections.append_documents(spark.sql("""
        SELECT named_struct('b', 'x', 'A', 5L) AS inner, 2L AS ID, array(7L) AS many, named_struct('q', 1) AS `odd.name`
        UNION ALL SELECT null, null, null, null"""), place)
    collections.append_documents(spark.sql("SELECT 'three' AS `odd.name`, 3 AS id"), place)
    collections.append_documents(spark.sql("SELECT 4 AS id, named_struct('a', 4) AS inner, array() :: array<int> AS many, 'k' AS _id"), place)
    found = collections.read_documents(spark, place)
    assert found.dtypes == [
        ("id", "bigint"), ("inner", "struct<a:bigint,b:string>"), ("many", "array<bigint>"), ("odd.name", "string")]
    rows = {row.id: row for row in found.collect()}
    assert rows[1].inner.asDict() == {"a": 1, "b": None} and rows[1].many == [1, None]
    assert rows[2].inner.asDict() == {"a": 5, "b": "x"} and json.loads(rows[2]["odd.name"]) == {"q": 1}
    assert rows[3]["odd.name"] == "three" and rows[3].inner is None and rows[4].inner.a == 4
    assert rows[None].inner is None


def test_an_append_that_breaks_off_is_not_read(spark, tmp_path):
    place = f"{tmp_path}/c"
    collections.append_documents(spark.range(3), place)
    broken = spark.range(4).select(F.when(F.col("id") > 2, F.raise_error(F.lit("gone"))).otherwise(F.col("id").cast("string")).alias("id"))
    with pytest.raises(Exception, match="gone"):
        collections.append_documents(broken, place)
    assert collections.read_documents(spark, place).dtypes == [("id", "bigint")]
    assert collections.read_documents(spark, place).count() == 3


def customers(spark, rows):
    full = [(msisdn, gender, "1980", status, "Prepaid", None) for msisdn, gender, status in rows]
    return spark.createDataFrame(full, schemas.CRM)


def test_only_named_subscribers_are_cleaned_again(spark, tmp_path):
    parts = [
        [("a", "male", "ACTIVE"), ("b", None, "IDLE"), (None, "f", "ACTIVE"), ("c", "x", "SUSPEND")],
        [("b", "female", "ACTIVE"), ("d", None, "DEACTIVE")],
        [(None, "m", "IDLE"), ("b", "female", "ACTIVE")],
        [],
    ]
    cleaned = []

    def clean(raw):
        cleaned.append(raw)
        return crm.clean(raw)

    for i in range(len(parts)):
        found = added.add(spark, customers(spark, parts[i]), f"{tmp_path}/t", clean)
        want = crm.clean(customers(spark, sum(parts[: i + 1], [])))
        assert sorted(map(str, found.collect())) == sorted(map(str, want.collect()))
        if i == 1:  # from here on the raw rows of what was touched
            touched = {row.msisdn for raw in cleaned for row in raw.select("msisdn").collect() if raw.count() == 3}
            assert touched == {"b", "d"}


def test_missing_devices_and_their_label_are_one(spark, tmp_path):
    rows = [(None, "1", "b", None, None, None), ("x", "2", None, None, None, None), ("Not Available", "3", "b", "m", None, None)]
    for row in rows:
        found = added.add(spark, spark.createDataFrame([row], schemas.DEVICE), f"{tmp_path}/t", device.clean)
    want = device.clean(spark.createDataFrame(rows, schemas.DEVICE))
    assert sorted(map(str, found.collect())) == sorted(map(str, want.collect()))


def test_an_addition_that_breaks_off_is_done_again(spark, tmp_path):
    first, second = customers(spark, [("a", "male", "ACTIVE")]), customers(spark, [("a", "female", "IDLE"), ("b", None, "IDLE")])
    before = added.add(spark, first, f"{tmp_path}/t", crm.clean)

    def broken(raw):
        return crm.clean(raw).withColumn("gender", F.raise_error(F.lit("gone")).cast("string"))

    with pytest.raises(Exception, match="gone"):
        added.add(spark, second, f"{tmp_path}/t", broken)
    assert added.current(spark, f"{tmp_path}/t", first).collect() == before.collect()
    found = added.add(spark, second, f"{tmp_path}/t", crm.clean)
    assert sorted(found.collect()) == sorted(crm.clean(first.unionAll(second)).collect())


def test_added_files_from_the_command_line(spark, tmp_path):
    head, devices = ",".join(schemas.CRM.names) + "\n", ",".join(schemas.DEVICE.names) + "\n"
    for number, line in enumerate(["a,male,1980,ACTIVE,Prepaid,Tier_1\n", "b,f, 1990 ,IDLE,Prepaid,Tier_2\nshort\n"]):
        command.main([
            "clean", "--add", "--crm", text(tmp_path, f"crm{number}.csv", head + line), "--device",
            text(tmp_path, f"device{number}.csv", devices + "a,1,brand,model,os,vendor\n"),
            "--cleaned", f"{tmp_path}/cleaned", "--rejects", f"{tmp_path}/rejects", "--most-rejected", "0.5"])
    found = jobs.read_subscribers(spark, f"{tmp_path}/cleaned/subscribers").select("msisdn", "year_of_birth", "brand_name")
    assert sorted(tuple(row) for row in found.where("gender IS NOT NULL").collect())[0] == ("a", "1980", "brand")
    assert {row.msisdn for row in found.collect()} == {"a", "b"}
    assert [(row.text, row.cause) for row in jobs.read_rejects(spark, f"{tmp_path}/rejects").collect()] == [("short", "fields")]
