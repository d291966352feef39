"""Revenue events as JSON messages on a topic."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from telmart import schemas

FIRST_WEEK = 22


def encode(revenue: DataFrame) -> DataFrame:
    """One JSON text per row, all columns."""
    return revenue.select(F.to_json(F.struct("*")).alias("value"))


def week_messages(revenue: DataFrame, week: int) -> DataFrame:
    """The messages of one week; the filter reaches the scan. Where rows have
    an ordinal, (week, ordinal) is the message's key: a week that is sent again
    has the same keys, by which its messages are known."""
    rows = revenue.filter(F.col("week_number") == week)
    if "ordinal" not in revenue.columns:
        return encode(rows)
    value = F.to_json(F.struct(*[name for name in revenue.columns if name != "ordinal"]))
    return rows.select(F.concat_ws("-", "week_number", "ordinal").alias("key"), value.alias("value"))


def decode(messages: DataFrame) -> DataFrame:
    """Revenue columns of each message. Unreadable messages give a row of
    nulls; they fall out at the join on msisdn. Inlined as a one-element
    array, since a filter on a plain struct field would be pushed below the
    decoding and parse every message a second time."""
    payload = F.from_json(F.col("value").cast("string"), schemas.REVENUE)
    return messages.select(F.inline(F.array(payload)))


# What every decoded message carries beside its revenue columns.
RECEIVED = "message_id string, text string, msisdn string, week_number int, revenue_usd decimal(28,10), cause string"


def received(messages: DataFrame) -> DataFrame:
    """Every message with its key, its text, its revenue columns, and for one
    that cannot be used the cause: ``no text``, ``unreadable`` (no column can
    be read) or ``no key`` (it names no subscriber)."""
    payload = F.from_json(F.col("value").cast("string"), schemas.REVENUE)
    rows = messages.select(
        F.col("key").cast("string").alias("message_id"), F.col("value").cast("string").alias("text"),
        F.inline(F.array(payload)),
    )
    empty = F.coalesce(F.trim("text"), F.lit("")) == ""
    nothing = F.coalesce(F.col("msisdn"), F.col("week_number").cast("string"), F.col("revenue_usd").cast("string")).isNull()
    cause = F.when(empty, "no text").when(nothing, "unreadable").when(F.col("msisdn").isNull(), "no key")
    return rows.withColumn("cause", cause)


def publish(messages: DataFrame, fmt: str = "kafka", **options) -> None:
    """Sends ``value`` texts to a topic, with their ``key`` if there is one
    (options: kafka.bootstrap.servers, topic)."""
    messages.select(*[name for name in ("key", "value") if name in messages.columns]).write.format(fmt).options(**options).save()


def topic_options(servers: str, topic: str, max_messages: int | None = None) -> dict[str, str]:
    """From the earliest message on, tolerant of messages that the broker has
    dropped already, at most ``max_messages`` per micro-batch."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
        "failOnDataLoss": "false",
    }
    if max_messages is not None:
        options["maxOffsetsPerTrigger"] = str(max_messages)
    return options


def topic_stream(
    spark: SparkSession, servers: str, topic: str, max_messages: int | None = None
) -> DataFrame:
    options = topic_options(servers, topic, max_messages)
    return spark.readStream.format("kafka").options(**options).load()


# Without a broker, a folder of files with a topic's columns is the topic.

def as_topic_rows(messages: DataFrame, topic: str) -> DataFrame:
    key = F.col("key") if "key" in messages.columns else F.lit(None)
    return messages.select(
        key.cast("binary").alias("key"),
        F.col("value").cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        F.lit(0).alias("partition"),
        F.monotonically_increasing_id().alias("offset"),
        F.current_timestamp().alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )


def publish_folder(messages: DataFrame, folder: str, topic: str = "revenue") -> None:
    as_topic_rows(messages, topic).write.mode("append").parquet(folder)


def folder_stream(spark: SparkSession, folder: str, max_files: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schemas.MESSAGE)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(folder)
