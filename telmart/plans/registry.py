"""The named queries: each takes a session and a folder of test tables."""

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from telmart import schemas
from telmart.functions import gender
from telmart.functions.labels import age, age_band, or_not_available
from telmart.functions.money import dollars
from telmart.operators import crm, device, enrich
from telmart.plans import added, jobs, marts
from telmart.session import new_folder, remove_folder
from telmart.sources import collections, files, fixtures, messages
from telmart.streaming import enrichment

AS_OF = "2024-06-30"

Query = Callable[[SparkSession, str], DataFrame]


def _in_double(rows: DataFrame) -> DataFrame:
    return rows.withColumn("revenue_usd", F.col("revenue_usd").cast("double"))


def _crm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crm.clean(fixtures.crm_raw(spark, sf_dir))


def _device(spark: SparkSession, sf_dir: str) -> DataFrame:
    return device.clean(fixtures.device_raw(spark, sf_dir))


def _activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    rolled_up = enrich.activity(fixtures.revenue(spark, sf_dir))
    return enrich.subscriber_activity(_crm(spark, sf_dir), _device(spark, sf_dir), rolled_up)


# Sources


def _reordered(rows: DataFrame) -> DataFrame:
    """The columns back to front, and one more: text files are read by header."""
    return rows.select(F.lit("x").alias("further"), *reversed(rows.columns))


def scan_crm(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "crm-text")
    files.write_text_table(_reordered(fixtures.crm_raw(spark, sf_dir)), path)
    return files.scan_crm(spark, path)


def scan_device(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "device-text")
    files.write_text_table(_reordered(fixtures.device_raw(spark, sf_dir)), path)
    return files.scan_device(spark, path)


def scan_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "revenue-text")
    files.write_text_table(_reordered(fixtures.revenue(spark, sf_dir)), path)
    return _in_double(files.scan_revenue(spark, path))


def collection_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "collection")
    documents = _crm(spark, sf_dir).withColumn("_id", F.xxhash64("msisdn"))
    files.append_collection(documents, path)
    return files.read_collection(spark, path)


def collection_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two appends with different columns, two of them of different types."""
    path, rows = new_folder(spark, "merged"), _crm(spark, sf_dir)
    low = F.coalesce(F.right("msisdn", F.lit(1)) < "5", F.lit(False))
    whole_year = F.expr("if(year_of_birth rlike '^[0-9]+$', int(year_of_birth), null)").alias("year_of_birth")
    collections.append_documents(
        rows.where(low).select("msisdn", "gender", whole_year, "mobile_type", F.length("msisdn").alias("n_chars")), path)
    collections.append_documents(rows.where(~low).select(
        "value_segment", "msisdn", "year_of_birth", "mobile_type", "system_status",
        F.length("msisdn").cast("long").alias("n_chars"), F.xxhash64("msisdn").alias("_id"),
    ), path)
    return collections.read_documents(spark, path)


def _text_with_faults(spark: SparkSession, sf_dir: str, folder: str) -> dict[str, StructType]:
    """The three inputs as text files, with records of too few or too many
    fields and with words in the place of numbers."""
    def lines(rows: DataFrame, schema: StructType, fields: list[str], short: str, name: str) -> None:
        line = f"if(msisdn LIKE '%77', {short}, concat_ws(',', {', '.join(fields)}))"
        header = ",".join(schema.names)
        # One column under the whole header; the separator is in none of the lines.
        rows.select(F.expr(line).alias(header)).write.option("header", True).option("sep", "\x01").csv(f"{folder}/{name}")

    def plain(schema: StructType) -> list[str]:
        return [f"coalesce({name}, '')" for name in schema.names]

    money = ["coalesce(msisdn, '')", "if(msisdn LIKE '%7' OR msisdn LIKE '%88', 'w', '') || week_number",
             "if(msisdn LIKE '%8', 'n/a', string(revenue_usd))"]
    lines(fixtures.crm_raw(spark, sf_dir), schemas.CRM, plain(schemas.CRM), "msisdn || ',male'", "crm")
    lines(fixtures.device_raw(spark, sf_dir), schemas.DEVICE, plain(schemas.DEVICE), "msisdn || ',a,b,c,d,e,f'", "device")
    lines(fixtures.revenue(spark, sf_dir), schemas.REVENUE, money, "msisdn", "revenue")
    return {"crm": schemas.CRM, "device": schemas.DEVICE, "revenue": schemas.REVENUE}


def scan_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What text scans cannot use, and how many records of each cause they do
    use: ``text`` is null for those."""
    folder, used = new_folder(spark, "scan-rejects"), []
    for name, schema in _text_with_faults(spark, sf_dir, folder).items():
        rows = jobs.scan_checked(spark, f"{folder}/{name}", schema, f"{folder}/rejects", most=0.5)
        used.append(rows.agg(F.count("*").alias("n")).select(
            F.lit(name).alias("source"), F.lit(None).cast("string").alias("text"), F.lit("used").alias("cause"), "n"))
    rejected = jobs.read_rejects(spark, f"{folder}/rejects").withColumn("source", F.substring_index("source", "/", -1))
    return reduce(DataFrame.unionByName, used, rejected.groupBy("source", "text", "cause").agg(F.count("*").alias("n")))


# Customer and device cleaning


def _in_two(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    first = F.pmod(F.xxhash64(*raw.columns), F.lit(5)) > 0
    return raw.where(first), raw.where(~first)


def _cleaned_in_two(spark: SparkSession, raw: DataFrame, clean, name: str) -> DataFrame:
    folder = new_folder(spark, name)
    for rows in _in_two(raw):
        cleaned = added.add(spark, rows, folder, clean)
    return cleaned


def crm_clean_added(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Most customer records first, then the rest."""
    return _cleaned_in_two(spark, fixtures.crm_raw(spark, sf_dir), crm.clean, "crm-added")


def device_clean_added(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cleaned_in_two(spark, fixtures.device_raw(spark, sf_dir), device.clean, "device-added")


def gender_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        fixtures.crm_raw(spark, sf_dir)
        .groupBy(F.col("gender").alias("raw_gender"))
        .agg(F.count("*").alias("n_rows"))
        .select("raw_gender", gender.normalise_gender("raw_gender").alias("gender"), "n_rows")
    )


def gender_function(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same labels through the function registered for SQL."""
    gender.register(spark)
    return spark.sql(
        "SELECT msisdn, normalise_gender(gender) AS gender FROM {raw}", raw=fixtures.crm_raw(spark, sf_dir)
    )


def clean_null_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.crm_raw(spark, sf_dir).select(
        "msisdn",
        or_not_available(F.col("gender")).alias("gender"),
        or_not_available(F.col("year_of_birth")).alias("year_of_birth"),
    )


def gender_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crm.fill_gender(crm.normalise(fixtures.crm_raw(spark, sf_dir)))


def crm_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crm.dedupe(gender_fill(spark, sf_dir))


def crm_window_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crm.with_counts(crm_dedupe(spark, sf_dir)).withColumn("alone", F.col("alone").cast("int"))


def crm_survivor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crm.survivors(crm.with_counts(crm_dedupe(spark, sf_dir)))


def device_null_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return device.with_null_count(fixtures.device_raw(spark, sf_dir))


def device_survivor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return device.one_per_subscriber(device_null_count(spark, sf_dir))


# Joins and ages


def crm_device_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.subscribers(_crm(spark, sf_dir), _device(spark, sf_dir))


def subscriber_week(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = crm_device_full(spark, sf_dir)
    return _in_double(enrich.subscriber_week(known, fixtures.revenue(spark, sf_dir)))


def subscriber_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _activity(spark, sf_dir)
    money = {name: dollars(F.col(name)) for name in ("revenue", "highest", "lowest")}
    return rows.withColumns(money)


def age_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    years = age(F.col("year_of_birth"), AS_OF)
    return _crm(spark, sf_dir).select(
        "msisdn", "year_of_birth", years.alias("age"), age_band(years).alias("age_group")
    )


# Messages and streams


def publish_week_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages.week_messages(fixtures.revenue(spark, sf_dir), messages.FIRST_WEEK)


def _all_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every revenue event, and for each week one text that is no JSON."""
    revenue = fixtures.revenue(spark, sf_dir)
    unreadable = revenue.select("week_number").distinct().select(
        F.concat(F.lit("week "), F.col("week_number").cast("string")).alias("value")
    )
    return messages.encode(revenue).unionByName(unreadable)


def decode_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = messages.as_topic_rows(_all_messages(spark, sf_dir), "revenue")
    return _in_double(messages.decode(rows))


def stream_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "stream-decode")
    messages.publish_folder(_all_messages(spark, sf_dir), f"{folder}/topic")
    rows = messages.decode(messages.folder_stream(spark, f"{folder}/topic"))
    enrichment.append_to_table(
        rows, f"{folder}/decoded", f"{folder}/checkpoint", once=True
    ).awaitTermination()
    _remove(spark, folder, "topic", "checkpoint")
    decoded = spark.read.parquet(f"{folder}/decoded")
    return _in_double(decoded.select("msisdn", "week_number", "revenue_usd"))


def _remove(spark: SparkSession, folder: str, *names: str) -> None:
    """What a result no longer rests on."""
    for name in names:
        remove_folder(spark, f"{folder}/{name}")


def _written_subscribers(spark: SparkSession, sf_dir: str, folder: str) -> str:
    path = f"{folder}/subscribers"
    jobs.write_subscribers(spark, _crm(spark, sf_dir), _device(spark, sf_dir), path)
    return path


def stream_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "stream-enrich")
    known = _written_subscribers(spark, sf_dir, folder)
    messages.publish_folder(_all_messages(spark, sf_dir), f"{folder}/topic")
    stream = messages.folder_stream(spark, f"{folder}/topic")
    jobs.enrich_available(spark, stream, known, f"{folder}/facts", f"{folder}/checkpoint")
    _remove(spark, folder, "subscribers", "topic", "checkpoint")
    return _in_double(jobs.read_facts(spark, f"{folder}/facts"))


def stream_refreshed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One running stream. The first week meets subscribers of the customer side
    only; the others come after the full table has been written."""
    folder = new_folder(spark, "stream-refreshed")
    topic, known = f"{folder}/topic", f"{folder}/subscribers"
    customers, revenue = _crm(spark, sf_dir), fixtures.revenue(spark, sf_dir)
    devices = _device(spark, sf_dir)
    first = F.col("week_number") == messages.FIRST_WEEK
    jobs.write_subscribers(spark, customers, devices.limit(0), known)
    messages.publish_folder(messages.encode(revenue.filter(first)), topic)
    write = enrichment.fact_writer(f"{folder}/facts", f"{folder}/checkpoint")
    running = jobs.enrich_stream(spark, messages.folder_stream(spark, topic), known, write, f"{folder}/checkpoint")
    try:
        running.processAllAvailable()
        jobs.write_subscribers(spark, customers, devices, known)
        messages.publish_folder(messages.encode(revenue.filter(~first)), topic)
        running.processAllAvailable()
    finally:
        running.stop()
    _remove(spark, folder, "subscribers", "topic", "checkpoint")
    return _in_double(jobs.read_facts(spark, f"{folder}/facts"))


def stream_by_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stream appended to a target that has a batch writer only."""
    folder = new_folder(spark, "stream-by-batch")
    known = _written_subscribers(spark, sf_dir, folder)
    messages.publish_folder(_all_messages(spark, sf_dir), f"{folder}/topic")
    write = enrichment.append_once("orc", {"path": f"{folder}/target"}, f"{folder}/staging", "by-batch")

    def twice(rows: DataFrame, number: int) -> None:
        write(rows, number)
        write(rows, number)

    stream = messages.folder_stream(spark, f"{folder}/topic")
    jobs.enrich_stream(spark, stream, known, twice, f"{folder}/checkpoint", once=True).awaitTermination()
    _remove(spark, folder, "subscribers", "topic", "checkpoint", "staging")
    return _in_double(spark.read.orc(f"{folder}/target").select(*schemas.FACTS.names))


def stream_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the stream could not use, with the cause."""
    folder = new_folder(spark, "stream-rejects")
    known = _written_subscribers(spark, sf_dir, folder)
    messages.publish_folder(_all_messages(spark, sf_dir), f"{folder}/topic")
    stream = messages.folder_stream(spark, f"{folder}/topic")
    write = enrichment.fact_writer(f"{folder}/facts", f"{folder}/checkpoint")
    jobs.enrich_stream(
        spark, stream, known, write, f"{folder}/checkpoint", once=True, rejects=f"{folder}/rejects"
    ).awaitTermination()
    _remove(spark, folder, "subscribers", "topic", "checkpoint", "facts")
    return spark.read.schema("text string, cause string").parquet(f"{folder}/rejects").select("text", "cause")


def replay_weeks(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "replay")
    known = _written_subscribers(spark, sf_dir, folder)
    facts = jobs.replay(spark, fixtures.revenue(spark, sf_dir), known, folder)
    _remove(spark, folder, "subscribers", "topic", "checkpoint", "revenue", "progress")
    return _in_double(jobs.read_facts(spark, facts))


def replay_resent_week(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each week's send breaks off when half of its messages are out; the run
    that follows sends the week again."""
    folder = new_folder(spark, "resent")
    known = _written_subscribers(spark, sf_dir, folder)
    revenue = fixtures.revenue(spark, sf_dir)
    begun: set[int] = set()

    def send(rows: DataFrame, topic: str) -> None:
        week = jobs.next_week(spark, f"{folder}/progress")
        if week not in begun:
            begun.add(week)
            messages.publish_folder(rows.where(F.xxhash64("key") % 2 == 0), topic)
            raise ConnectionError("the broker is gone")
        messages.publish_folder(rows, topic)

    facts, checkpoint = f"{folder}/facts", f"{folder}/checkpoint"
    while True:
        try:
            facts = jobs.replay(spark, revenue, known, folder, send)
            break
        except ConnectionError:
            # The half that went out is joined before the rest comes.
            jobs.enrich_available(spark, messages.folder_stream(spark, f"{folder}/topic"), known, facts, checkpoint)
    _remove(spark, folder, "subscribers", "topic", "checkpoint", "revenue", "progress")
    return _in_double(jobs.read_facts(spark, facts))


def replay_next_week(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs of the publisher: the first week there is, then the next."""
    folder = new_folder(spark, "next-week")
    jobs.stage_revenue(fixtures.revenue(spark, sf_dir), f"{folder}/revenue")
    revenue = jobs.read_staged_revenue(spark, f"{folder}/revenue")
    for _ in range(2):
        jobs.publish_next_week(
            spark, revenue, f"{folder}/progress",
            lambda rows: messages.publish_folder(rows, f"{folder}/topic"),
        )
    _remove(spark, folder, "revenue", "progress")
    return _in_double(messages.decode(spark.read.parquet(f"{folder}/topic")))


# Loads and exports


def guarded_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads of the cleaned devices; the second finds them there."""
    folder = new_folder(spark, "guarded")
    for _ in range(2):
        jobs.guarded_load(spark, folder, lambda: _device(spark, sf_dir))
    return files.read_collection(spark, folder)


def _exported(spark: SparkSession, folder: str, tables: list[str]) -> DataFrame:
    """All report tables exported and read back in one long form: table,
    group, measure, value. The tables are dropped."""
    jobs.export_tables(spark, tables, f"{folder}/out")
    schemas = [spark.table(table).schema for table in tables]
    jobs.drop_tables(spark, tables)

    def long_form(mart: marts.Mart, table: str, schema: StructType) -> DataFrame:
        # A report by exact age shows the band as well.
        labels = [*mart.keys, *(["age_group"] if "age" in mart.keys else [])]
        keys = [F.coalesce(F.col(key).cast("string"), F.lit("-")) for key in labels]
        rows = jobs.read_export(spark, table, f"{folder}/out", schema).select(
            F.lit(mart.table).alias("table_name"),
            F.concat_ws("|", *keys).alias("group_label"),
            *[F.col(name).cast("double").alias(name) for name in mart.measures],
        )
        return rows.unpivot(["table_name", "group_label"], list(mart.measures), "measure", "value")

    return reduce(DataFrame.unionByName, map(long_form, marts.MARTS, tables, schemas))


def export_marts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All reports created as tables, exported, and read back."""
    folder = new_folder(spark, "export")
    _activity(spark, sf_dir).write.parquet(f"{folder}/activity")
    tables = jobs.create_marts(
        spark, spark.read.parquet(f"{folder}/activity"), f"{folder}/reports", AS_OF, f"export_{folder.rsplit('-', 1)[1]}_")
    result = _exported(spark, folder, tables)
    _remove(spark, folder, "activity", "reports")
    return result


def marts_after_new_week(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All reports over all weeks but the last, then brought up to date for
    that week alone: the same as all reports over all weeks."""
    folder = new_folder(spark, "new-week")
    _activity(spark, sf_dir).write.partitionBy("week_number").parquet(f"{folder}/activity")
    activity, prefix = spark.read.parquet(f"{folder}/activity"), f"week_{folder.rsplit('-', 1)[1]}_"
    last = activity.agg(F.max("week_number")).first()[0]
    jobs.create_marts(spark, activity.where(F.col("week_number") < last), f"{folder}/reports", AS_OF, prefix)
    tables = jobs.create_marts(spark, activity, f"{folder}/reports", AS_OF, prefix, weeks=[last])
    result = _exported(spark, folder, tables)
    _remove(spark, folder, "activity", "reports")
    return result


def _mart_query(mart: marts.Mart) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        raw_device = fixtures.device_raw(spark, sf_dir)
        rows = enrich.subscriber_activity(
            _crm(spark, sf_dir),
            device.clean(raw_device) if mart.shows_devices else device.keys(raw_device),
            enrich.activity(fixtures.revenue(spark, sf_dir), mart.weekly),
        )
        return marts.build(mart, rows, AS_OF)

    run.__name__ = mart.name
    return run


def queries() -> dict[str, Query]:
    named: dict[str, Query] = {
        query.__name__: query
        for query in (
            scan_crm, scan_device, scan_revenue, scan_rejects, collection_roundtrip, collection_merged,
            crm_clean_added, device_clean_added,
            gender_normalize, gender_function, clean_null_labels, gender_fill, crm_dedupe,
            crm_window_counts, crm_survivor, device_null_count, device_survivor,
            crm_device_full, subscriber_week, subscriber_activity,
            publish_week_json, decode_payload, stream_decode, stream_enrich,
            stream_refreshed, stream_by_batch,
            replay_weeks, replay_resent_week, replay_next_week, stream_rejects, guarded_load, export_marts, marts_after_new_week,
        )
    }
    named["crm_clean"] = _crm
    named["device_clean"] = _device
    named["age_band"] = age_bands
    named.update({mart.name: _mart_query(mart) for mart in marts.MARTS})
    return named
