from telmart import schemas
from telmart.operators import device

NA = "Not Available"


def clean(spark, rows):
    frame = device.clean(spark.createDataFrame(rows, schemas.DEVICE))
    return sorted(tuple(row) for row in frame.collect())


def test_nulls_get_the_label(spark):
    assert clean(spark, [("a", "1", None, "m", None, None)]) == [("a", "1", NA, "m", NA, NA)]


def test_the_complete_row_wins(spark):
    rows = [("a", "1", None, "m", "o", "v"), ("a", "2", "b", "m", "o", "v"), ("a", "0", None, None, "o", "v")]
    assert clean(spark, rows) == [("a", "2", "b", "m", "o", "v")]


def test_ties_go_by_details_nulls_last(spark):
    rows = [("a", None, "b", "m", "o", "v"), ("a", "9", None, "m", "o", "v"), ("a", "9", "b", "m", "o", None)]
    assert clean(spark, rows) == [("a", "9", "b", "m", "o", NA)]


def test_rows_without_a_key_become_one(spark):
    rows = [(None, "1", "b", "m", "o", "v"), (None, "2", "b", "m", "o", None), ("a", "1", "b", "m", "o", "v")]
    assert clean(spark, rows) == [(NA, "1", "b", "m", "o", "v"), ("a", "1", "b", "m", "o", "v")]


def test_keys_are_those_of_the_cleaned_rows(spark):
    raw = spark.createDataFrame([("a", *[None] * 5), ("a", *["1"] * 5), (None, *["1"] * 5)], schemas.DEVICE)
    assert sorted(device.keys(raw).collect()) == sorted(device.clean(raw).select("msisdn").collect())


def test_one_row_per_key_and_task_is_shuffled(spark):
    raw = spark.range(0, 20000, 1, 8).selectExpr(
        "if(id % 3 = 0, 'hot', string(id % 100)) AS msisdn", "string(id) AS imei_tac", "'b' AS brand_name",
        "'m' AS model_name", "'o' AS os_name", "'v' AS os_vendor",
    )
    plan = device.clean(raw)._jdf.queryExecution().executedPlan().toString()
    below_exchange = plan[plan.index("Exchange hashpartitioning"):]
    assert "WindowGroupLimit" in below_exchange and "Partial" in below_exchange
