"""Column layouts of the inputs; nothing is inferred from the data."""

from pyspark.sql import types as T

CRM = T.StructType([
    T.StructField("msisdn", T.StringType()),
    T.StructField("gender", T.StringType()),
    # As text: it may be written 1990.0, and becomes a label where it is missing.
    T.StructField("year_of_birth", T.StringType()),
    T.StructField("system_status", T.StringType()),
    T.StructField("mobile_type", T.StringType()),
    T.StructField("value_segment", T.StringType()),
])

DEVICE = T.StructType([
    T.StructField("msisdn", T.StringType()),
    T.StructField("imei_tac", T.StringType()),
    T.StructField("brand_name", T.StringType()),
    T.StructField("model_name", T.StringType()),
    T.StructField("os_name", T.StringType()),
    T.StructField("os_vendor", T.StringType()),
])

# Money is decimal, so that sums do not depend on the order of the rows, with
# all the digits that are sent: it is rounded once, to cents.
REVENUE = T.StructType([
    T.StructField("msisdn", T.StringType()),
    T.StructField("week_number", T.IntegerType()),
    T.StructField("revenue_usd", T.DecimalType(28, 10)),
])

# Revenue as it is staged: each row of a week has a number of its own, which
# stays as long as the row does.
STAGED = T.StructType([*REVENUE.fields, T.StructField("ordinal", T.LongType())])

# Subscribers with the columns of both cleaned sides, and their revenue events.
SUBSCRIBERS = T.StructType([*CRM.fields, *DEVICE.fields[1:]])

FACTS = T.StructType([*SUBSCRIBERS.fields, *REVENUE.fields[1:]])

# One record of a message topic, as Spark's topic reader hands it over.
MESSAGE = T.StructType([
    T.StructField("key", T.BinaryType()),
    T.StructField("value", T.BinaryType()),
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("timestampType", T.IntegerType()),
])
