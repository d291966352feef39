"""The jobs: clean, publish a week, enrich, refresh the reports, export."""

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType
from pyspark.sql.utils import AnalysisException

from telmart import schemas
from telmart.operators import crm, device, enrich
from telmart.plans import added, marts
from telmart.plans.ledger import DONE, INTENT, Ledger
from telmart.session import new_folder, pieces, remove_folder
from telmart.sources import files, messages
from telmart.streaming import enrichment

JOBS_AT_ONCE = 8
# A task sends so many shuffled bytes of a staged week: the tasks of a send become
# those that decode its messages, which takes about a second for so many.
SENT_BYTES = "4m"


def is_loaded(spark: SparkSession, location: str, fmt: str = "parquet", **options) -> bool:
    """Whether a collection exists and holds a row."""
    try:
        return not files.read_collection(spark, location, fmt, **options).isEmpty()
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return False


def guarded_load(
    spark: SparkSession, location: str, rows: Callable[[], DataFrame], fmt: str = "parquet", **options
) -> bool:
    """Appends ``rows()`` to a collection unless it is loaded already."""
    if is_loaded(spark, location, fmt, **options):
        return False
    files.append_collection(rows(), location, fmt, **options)
    return True


def scan_checked(
    spark: SparkSession, path: str, schema: StructType, rejects: str, most: float = 0.0
) -> DataFrame:
    """The records of headered text files that can be used. The others go with
    their text and the cause to the table ``rejects``; the load stops where they
    are more than the share ``most`` of all, after they have been written. The
    files are read once, into a table that the result rests on."""
    folder, seen = new_folder(spark, "scanned"), Observation()
    marked = files.read_with_causes(spark, path, schema)
    marked.observe(seen, F.count("*").alias("read"), F.count("cause").alias("rejected")).write.parquet(folder)
    rows, found = spark.read.schema(marked.schema).parquet(folder), seen.get
    rejected = rows.where("cause IS NOT NULL").select(F.lit(path).alias("source"), "text", "cause")
    rejected.write.mode("append").parquet(rejects)
    if found["rejected"] > most * found["read"]:
        raise ValueError(f"{found['rejected']} of {found['read']} records of {path} cannot be used, see {rejects}")
    return rows.where("cause IS NULL").select(*schema.names)


def read_rejects(spark: SparkSession, rejects: str) -> DataFrame:
    return spark.read.schema("source string, text string, cause string").parquet(rejects)


def _scans(spark: SparkSession, rejects: str | None, most: float):
    """How customer and device files are read: to the letter, or with rejects."""
    if rejects is None:
        return files.scan_crm, files.scan_device
    return (
        lambda spark, path: files.birth_years(scan_checked(spark, path, schemas.CRM, rejects, most)),
        lambda spark, path: scan_checked(spark, path, schemas.DEVICE, rejects, most),
    )


def clean_files(
    spark: SparkSession, crm_path: str, device_path: str, folder: str, rejects: str | None = None, most: float = 0.0
) -> None:
    """Text files to the cleaned collections ``crm`` and ``device`` and the
    static side of the stream join, ``subscribers``. A cleaned collection that
    is there already stays as it is. Records that cannot be used stop the job,
    or go to ``rejects`` if that is given, up to the share ``most``."""
    scan_crm, scan_device = _scans(spark, rejects, most)
    guarded_load(spark, f"{folder}/crm", lambda: crm.clean(scan_crm(spark, crm_path)))
    guarded_load(spark, f"{folder}/device", lambda: device.clean(scan_device(spark, device_path)))
    write_subscribers(
        spark,
        files.read_collection(spark, f"{folder}/crm"),
        files.read_collection(spark, f"{folder}/device"),
        f"{folder}/subscribers",
    )


def clean_added_files(
    spark: SparkSession, crm_path: str, device_path: str, folder: str, rejects: str | None = None, most: float = 0.0
) -> None:
    """Adds the files' rows to those of earlier calls: the subscribers that
    they name are cleaned again, and ``subscribers`` gets a new version. What
    ``clean_files`` has loaded is another collection, without its raw rows."""
    scan_crm, scan_device = _scans(spark, rejects, most)
    customers = added.add(spark, scan_crm(spark, crm_path), f"{folder}/crm-added", crm.clean)
    devices = added.add(spark, scan_device(spark, device_path), f"{folder}/device-added", device.clean)
    write_subscribers(spark, customers, devices, f"{folder}/subscribers")


def stage_revenue(revenue: DataFrame, path: str) -> None:
    """Revenue as a table by week, so that publishing a week reads that week
    only. Rebalancing splits a large week over several tasks and files. Rows
    are numbered once, here: a week that is sent again has the same numbers."""
    numbered = revenue.withColumn("ordinal", F.monotonically_increasing_id())
    numbered.hint("rebalance", "week_number").write.mode("overwrite").partitionBy("week_number").parquet(path)


def read_staged_revenue(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.REVENUE).parquet(path).select(*schemas.REVENUE.names)


def read_staged_messages(spark: SparkSession, path: str) -> DataFrame:
    """Staged revenue with the rows' numbers, by which messages are known."""
    return spark.read.schema(schemas.STAGED).parquet(path).select(*schemas.STAGED.names)


def progress_ledger(spark: SparkSession, progress: str) -> Ledger:
    return Ledger(spark, progress, "week_number")


def next_week(spark: SparkSession, progress: str) -> int:
    """The week after the last one that was published."""
    last = progress_ledger(spark, progress).last()
    return messages.FIRST_WEEK if last is None else last + 1


def publish_next_week(
    spark: SparkSession, revenue: DataFrame, progress: str, publish: Callable[[DataFrame], None]
) -> int | None:
    """Publishes one week. The ledger has the intent before the send and its
    end after it: a send that breaks off leaves an intent alone, and the next
    run sends that week again, with the same message keys. A week that
    ``revenue`` does not hold yet is neither sent nor recorded: the result is
    None, and a later run sends it."""
    week, ledger = next_week(spark, progress), progress_ledger(spark, progress)
    if revenue.filter(F.col("week_number") == week).isEmpty():
        return None
    ledger.record(week, INTENT)
    # A week may be one staged file; its messages are spread over tasks evenly.
    rows = revenue.filter(F.col("week_number") == week).hint("rebalance")
    with pieces(spark, SENT_BYTES):
        publish(messages.week_messages(rows, week))
    ledger.record(week, DONE)
    return week


def _record(spark: SparkSession, name: str, number: int, path: str) -> None:
    spark.range(1).select(F.lit(number).cast("int").alias(name)).write.mode("append").parquet(path)


def _last_recorded(spark: SparkSession, name: str, path: str) -> int | None:
    try:
        done = spark.read.schema(f"{name} int").parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return done.agg(F.max(name)).first()[0]


def write_subscribers(spark: SparkSession, crm_rows: DataFrame, device_rows: DataFrame, path: str) -> DataFrame:
    """A new version of the static side of the stream join, in a folder of its
    own and recorded last: readers of the version before are not disturbed, and
    nobody reads one that is not complete."""
    version = (_last_recorded(spark, "version", f"{path}/versions") or 0) + 1
    enrich.subscribers(crm_rows, device_rows).write.mode("overwrite").parquet(f"{path}/version-{version}")
    _record(spark, "version", version, f"{path}/versions")
    return read_subscribers(spark, path)


def read_subscribers(spark: SparkSession, path: str) -> DataFrame:
    """The subscribers as they are now."""
    version = _last_recorded(spark, "version", f"{path}/versions")
    if version is None:
        raise ValueError(f"no subscribers have been written to {path}")
    return spark.read.schema(schemas.SUBSCRIBERS).parquet(f"{path}/version-{version}")


def enrich_stream(
    spark: SparkSession, stream: DataFrame, subscribers_path: str, write: enrichment.Writer, checkpoint: str,
    once: bool = False, every: str | None = None, broadcast: bool = False, rejects: str | None = None,
    counted: Callable[[int, dict[str, int]], None] | None = None,
) -> StreamingQuery:
    """Joins each micro-batch with the subscribers as they are when it runs and
    hands it to ``write``. ``broadcast`` reads the subscribers past a micro-batch
    without a shuffle; only for a source that limits its micro-batches.

    A micro-batch is decoded once, into a table of its own, which has the text of
    messages that cannot be used. Messages that come
    again, in it or after an earlier one, count once where the target knows the
    identities of what it has. Those that cannot be used go to the folder
    ``rejects``, if there is one; ``counted`` is told how many messages a batch
    has received, accepted and rejected."""
    def run(batch: DataFrame, number: int) -> None:
        session, seen = batch.sparkSession, Observation()
        folder = new_folder(session, "micro-batch")
        measures = (
            F.count("*").alias("received"), F.count("cause").alias("rejected"),
            F.min("week_number").alias("low"), F.max("week_number").alias("high"),
        )
        received = messages.received(batch).withColumn("text", F.when(F.col("cause").isNotNull(), F.col("text")))
        received.observe(seen, *measures).write.parquet(folder)
        rows, found = session.read.schema(messages.RECEIVED).parquet(folder), seen.get
        if rejects is not None:
            enrichment.reject_writer(rejects, checkpoint)(rows.where("cause IS NOT NULL"), number)
        revenue = rows.where("cause IS NULL").select("message_id", *schemas.REVENUE.names)
        weeks = (found["low"], found["high"])
        keeps_identity = hasattr(write, "seen")
        earlier = write.seen(session, weeks, number) if keeps_identity and None not in weeks else None
        facts = enrichment.matched(
            enrichment.once_each(revenue, earlier), read_subscribers(session, subscribers_path), broadcast, revenue
        )
        write(facts if keeps_identity else facts.drop("message_id"), number)
        if counted is not None:
            counted(number, {
                "received": found["received"], "rejected": found["rejected"],
                "accepted": found["received"] - found["rejected"],
            })
        remove_folder(session, folder)

    return enrichment.append_by_batch(stream, run, checkpoint, once, every)


def enrich_available(
    spark: SparkSession, stream: DataFrame, subscribers_path: str, facts: str, checkpoint: str
) -> None:
    """Brings every message that is there now into the fact table."""
    write = enrichment.fact_writer(facts, checkpoint)
    enrich_stream(spark, stream, subscribers_path, write, checkpoint, once=True).awaitTermination()


def replay(
    spark: SparkSession, revenue: DataFrame, subscribers_path: str, folder: str,
    publish: Callable[[DataFrame, str], None] = messages.publish_folder,
) -> str:
    """Week after week: publish it, then run the enrichment from where its
    checkpoint stands. Ends after the last week that has revenue; a week
    without any is passed over, as all revenue is there. After a failure a
    further call goes on with the revenue that is staged."""
    topic, facts = f"{folder}/topic", f"{folder}/facts"
    if not is_loaded(spark, f"{folder}/revenue"):
        stage_revenue(revenue, f"{folder}/revenue")
    revenue = read_staged_messages(spark, f"{folder}/revenue")
    last = revenue.agg(F.max("week_number")).first()[0]
    while last is not None and next_week(spark, f"{folder}/progress") <= last:
        sent = publish_next_week(
            spark, revenue, f"{folder}/progress", lambda rows: publish(rows, topic)
        )
        if sent is None:
            progress_ledger(spark, f"{folder}/progress").record(next_week(spark, f"{folder}/progress"), DONE)
            continue
        stream = messages.folder_stream(spark, topic)
        enrich_available(spark, stream, subscribers_path, facts, f"{folder}/checkpoint")
    return facts


def read_facts(spark: SparkSession, facts: str) -> DataFrame:
    """The fact table that the stream writes, in its column order."""
    return spark.read.schema(schemas.FACTS).parquet(facts).select(*schemas.FACTS.names)


def drop_tables(spark: SparkSession, tables: list[str]) -> None:
    for table in tables:
        spark.sql(f"DROP VIEW IF EXISTS {table}")


def refresh_weeks(spark: SparkSession, activity: DataFrame, folder: str, weeks: list[int] | None = None) -> None:
    """Brings the written weekly sums and device bitmaps up to date: all of
    them, or those of ``weeks`` alone, whose facts are then the only ones read
    and whose partitions the only ones replaced. Facts are only added, so a
    week that had some has some."""
    rows = activity if weeks is None else activity.where(F.col("week_number").isin(weeks))
    replace = {"partitionOverwriteMode": "static" if weeks is None else "dynamic"}
    marts.by_week(rows).write.mode("overwrite").options(**replace).partitionBy("part", "week_number").parquet(
        f"{folder}/weeks")
    devices = marts.devices_of(_read_weeks(spark, activity, folder))
    if weeks is not None:
        devices = devices.where(F.col("week_number").isin(weeks))
    _number_devices(spark, devices, f"{folder}/numbers")
    marts.device_bitmaps(devices, _read_numbers(spark, folder)).write.mode("overwrite").options(**replace).partitionBy(
        "week_number").parquet(f"{folder}/bitmaps")


def _read_weeks(spark: SparkSession, activity: DataFrame, folder: str) -> DataFrame:
    return spark.read.schema(marts.by_week(activity).schema).parquet(f"{folder}/weeks")


def _read_numbers(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema("imei_tac string, number long").parquet(f"{folder}/numbers")


def _number_devices(spark: SparkSession, devices: DataFrame, path: str) -> None:
    """Gives each device that has none a number, above all that are given."""
    new, above = devices.select("imei_tac").distinct(), 0
    try:
        known = spark.read.schema("imei_tac string, number long").parquet(path)
        above = (known.agg(F.max("number")).first()[0] or 0)
        new = new.join(known, "imei_tac", "left_anti")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
    new.select("imei_tac", (F.monotonically_increasing_id() + above + 1).alias("number")).write.mode("append").parquet(path)


def create_marts(
    spark: SparkSession, activity: DataFrame, folder: str, as_of: str | None = None, prefix: str = "",
    weeks: list[int] | None = None,
) -> list[str]:
    """Creates or replaces every report table. All are built from written sums
    and device bitmaps by week, for which the facts are read once; with
    ``weeks`` only the facts of those are. The reports are small and
    independent: several run at once.

    They are written as a new version beside the old one, and their names, as
    views, are switched to it last: a reader that has begun goes on with the
    old rows, a failed build leaves the old reports, and the version before
    the last one is removed."""
    refresh_weeks(spark, activity, folder, weeks)
    summary = marts.summary_of(_read_weeks(spark, activity, folder))
    bitmaps = spark.read.schema(marts.BITMAPS).parquet(f"{folder}/bitmaps")
    version = (_last_recorded(spark, "version", f"{folder}/versions") or 0) + 1

    def place(mart: marts.Mart) -> str:
        return f"{folder}/version-{version}/{mart.table}"

    def build(mart: marts.Mart) -> None:
        rows = marts.count_devices(mart, bitmaps) if mart.counts_devices else marts.build(mart, summary, as_of)
        rows.write.mode("overwrite").parquet(place(mart))

    with ThreadPoolExecutor(JOBS_AT_ONCE) as pool:
        list(pool.map(build, marts.MARTS))
    for mart in marts.MARTS:
        spark.sql(f"CREATE OR REPLACE VIEW {prefix}{mart.table} AS SELECT * FROM parquet.`{place(mart)}`")
    _record(spark, "version", version, f"{folder}/versions")
    if version > 2:
        remove_folder(spark, f"{folder}/version-{version - 2}")
    return [prefix + mart.table for mart in marts.MARTS]


def export_tables(spark: SparkSession, tables: list[str], folder: str) -> None:
    """Each table's own rows as text files, replacing an earlier export."""
    def export(table: str) -> None:
        files.write_text_table(spark.table(table), f"{folder}/{table}")

    with ThreadPoolExecutor(JOBS_AT_ONCE) as pool:
        list(pool.map(export, tables))


def read_export(spark: SparkSession, table: str, folder: str, schema: StructType | None = None) -> DataFrame:
    """An export with the columns of its table, or of ``schema`` if the table is
    gone."""
    schema = schema or spark.table(table).schema
    return files.read_text_table(spark, f"{folder}/{table}", schema, schema.names)
