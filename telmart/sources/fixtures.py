"""The three raw inputs, derived from whole test tables (see FIXTURES.md)."""

from pyspark.sql import DataFrame, SparkSession

# Spellings of gender found in raw customer records.
GENDER_SPELLINGS = """array(
    'M', 'F', 'male', 'FEMALE', 'mal', 'femal', 'mle', 'emmle', 'fmale', 'unknown',
    null, null, 'Male]', 'female#', 'mael', 'eml', 'fmle', 'amle', 'feml', 'x')"""

STATUS = """CASE
    WHEN o_orderkey % 53 = 0 THEN null
    WHEN o_orderkey % 59 = 0 THEN 'BARRED'
    WHEN o_custkey % 4 = 0 THEN
        CASE o_orderkey % 3 WHEN 0 THEN 'ACTIVE' WHEN 1 THEN 'SUSPEND' ELSE 'IDLE' END
    WHEN o_custkey % 4 = 1 THEN CASE o_orderkey % 3 WHEN 0 THEN 'IDLE' ELSE 'SUSPEND' END
    WHEN o_custkey % 4 = 2 THEN CASE o_orderkey % 5 WHEN 0 THEN 'ACTIVE' ELSE 'SUSPEND' END
    ELSE CASE o_orderkey % 4 WHEN 0 THEN 'DEACTIVE' WHEN 1 THEN 'IDLE' ELSE 'SUSPEND' END
    END"""


# Parts of a cent on both sides of its half, with more digits than four.
CENT_PARTS = """CASE event_id % 8
    WHEN 0 THEN 0.00499BD WHEN 1 THEN 0.005BD WHEN 2 THEN 0.00501BD WHEN 3 THEN 0.004999BD
    WHEN 4 THEN 0.0050000001BD WHEN 5 THEN 0.0049999999BD
    ELSE cast(event_id % 100 AS decimal(10,0)) * 0.0001BD + 0.0000010000BD END"""


def _table(spark: SparkSession, sf_dir: str, name: str, columns: str) -> DataFrame:
    return spark.read.schema(columns).parquet(f"{sf_dir}/{name}.parquet")


def crm_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _table(spark, sf_dir, "orders", "o_orderkey bigint, o_custkey bigint")
    return orders.selectExpr(
        "if(o_orderkey % 101 <> 0, if(o_custkey % 10 = 0, 'C', '') || o_custkey, null) AS msisdn",
        f"get({GENDER_SPELLINGS}, int(o_orderkey % 20)) AS gender",
        "if(o_orderkey % 7 <> 0, 1945 + (o_custkey + o_orderkey % 2) % 60"
        " || if(o_custkey % 17 = 0, '.0', ''), null) AS year_of_birth",
        f"{STATUS} AS system_status",
        "if(o_orderkey % 31 <> 0, if(o_orderkey % 2 = 0, 'Prepaid', 'Postpaid'), null) AS mobile_type",
        "if(o_orderkey % 37 <> 0, 'Tier_' || (o_orderkey % 3 + 1), null) AS value_segment",
    )


def device_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _table(spark, sf_dir, "lineitem", "l_orderkey bigint, l_partkey bigint, l_linenumber int")
    orders = _table(spark, sf_dir, "orders", "o_orderkey bigint, o_custkey bigint")
    parts = _table(
        spark, sf_dir, "part", "p_partkey bigint, p_name string, p_brand string, p_type string"
    )
    return (
        lines.withColumnRenamed("l_orderkey", "o_orderkey").join(orders, "o_orderkey")
        .withColumnRenamed("l_partkey", "p_partkey").join(parts, "p_partkey")
        .selectExpr(
            "if(o_orderkey % 103 <> 0, if(o_custkey % 10 = 1, 'D', '') || o_custkey, null) AS msisdn",
            "string(p_partkey) AS imei_tac",
            "if(l_linenumber % 3 <> 0, p_brand, null) AS brand_name",
            "p_name AS model_name",
            "if(l_linenumber % 4 <> 0, p_type, null) AS os_name",
            "if(l_linenumber % 2 <> 0, 'V_' || p_type, null) AS os_vendor",
        )
    )


def revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _table(
        spark, sf_dir, "events", "event_id bigint, ts timestamp_ntz, user_id bigint, value double"
    )
    return events.selectExpr(
        "if(event_id % 89 <> 0, if(event_id % 97 = 0, 'U', '') || user_id, null) AS msisdn",
        "int(22 + datediff(date(ts), DATE '2024-01-01') div 7) AS week_number",
        f"cast(cast(value AS decimal(16,2)) + {CENT_PARTS} AS decimal(28,10)) AS revenue_usd",
    )
