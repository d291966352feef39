"""The revenue stream joined with the cleaned subscribers.

The join keeps no state. Each micro-batch is joined as a batch, with the
subscribers as they are then; a subscriber with very many events in it is split
by adaptive skew-join handling.
"""

from collections.abc import Callable
from zlib import crc32

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.utils import AnalysisException

from telmart.operators.bloom import key_filter, may_match
from telmart.operators.enrich import subscriber_week
from telmart.plans.ledger import DONE, INTENT, Ledger
from telmart.session import pieces, remove_folder
from telmart.sources.messages import decode

# Takes the rows of a micro-batch and its number.
Writer = Callable[[DataFrame, int], None]


def enriched(messages: DataFrame, known: DataFrame, broadcast: bool = False) -> DataFrame:
    """The revenue of known subscribers with all their columns. Both sides are
    shuffled by msisdn unless ``broadcast`` marks the messages; that is for
    micro-batches which their source limits."""
    revenue = decode(messages)
    return subscriber_week(known, F.broadcast(revenue) if broadcast else revenue)


def matched(
    revenue: DataFrame, known: DataFrame, broadcast: bool = False, stored: DataFrame | None = None
) -> DataFrame:
    """The same for revenue that is decoded and stored already. A Bloom filter
    of its subscribers goes to the scan of the known ones, so that a
    micro-batch shuffles about as many of them as it has, not all. The filter is
    made from ``stored``, if given: rows that have all subscribers of ``revenue``
    and cost only a scan, where finding ``revenue`` itself takes shuffles."""
    if broadcast:
        return subscriber_week(known, F.broadcast(revenue))
    keys = revenue if stored is None else stored
    return subscriber_week(may_match(known, "msisdn", key_filter(keys, "msisdn")), revenue)


def once_each(revenue: DataFrame, seen: DataFrame | None) -> DataFrame:
    """Of messages with one identity the first, and none whose identity is in
    ``seen``. Messages without an identity stay as they are."""
    named = revenue.where(F.col("message_id").isNotNull()).dropDuplicates(["message_id"])
    if seen is not None:
        again = may_match(seen, "message_id", key_filter(revenue, "message_id"))
        named = named.join(again, "message_id", "left_anti")
    return named.unionByName(revenue.where(F.col("message_id").isNull()))


# A task writes so many shuffled bytes of a week's facts to a file.
FACT_BYTES = "16m"


class FactTable:
    """Writes micro-batches to the fact table. Each gets a folder of its own,
    by the stream that its checkpoint names and its number: a batch that comes
    again replaces itself. Rows are gathered by week first, so a batch writes
    few files a week; rebalancing splits a large week."""

    def __init__(self, path: str, checkpoint: str):
        self._path, self._stream = path, f"{crc32(checkpoint.encode()):08x}"

    def __call__(self, rows: DataFrame, number: int) -> None:
        with pieces(rows.sparkSession, FACT_BYTES):
            rows.hint("rebalance", "week_number").write.mode("overwrite").partitionBy("week_number").parquet(
                f"{self._path}/stream={self._stream}/batch={number}"
            )

    def seen(self, spark: SparkSession, weeks: tuple[int, int], number: int) -> DataFrame | None:
        """message_id of all facts of a range of weeks that other batches have
        written; two columns of those weeks' files are read."""
        layout = "message_id string, stream string, batch long, week_number int"
        try:
            facts = spark.read.schema(layout).parquet(self._path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return None
        own = (F.col("stream") == self._stream) & (F.col("batch") == number)
        return facts.where(F.col("week_number").between(*weeks) & ~own & F.col("message_id").isNotNull()).select("message_id")


def fact_writer(path: str, checkpoint: str) -> FactTable:
    return FactTable(path, checkpoint)


def format_writer(fmt: str, options: dict[str, str]) -> Writer:
    """Appends a micro-batch to a target that has a batch writer and cannot be
    read. A batch that comes again after a failure is appended again, unless
    the target knows its rows; ``append_once`` is for targets that Spark reads."""
    def write(rows: DataFrame, number: int) -> None:
        rows.write.mode("append").format(fmt).options(**options).save()

    return write


def append_once(fmt: str, options: dict[str, str], staging: str, checkpoint: str) -> Writer:
    """Appends each micro-batch once to a target that has a batch writer and a
    batch reader, in two phases. The batch's rows are first staged, numbered;
    the ledger then says so, and from there on only the staged rows count. What
    the target does not have of them is appended, and the ledger records the
    batch. A batch that comes again after a failure at any point, half of the
    append included, adds just what is missing. The target's rows name their
    batch (``batch_id``) and their number in it (``batch_row``)."""
    stream = f"{crc32(checkpoint.encode()):08x}"

    def write(rows: DataFrame, number: int) -> None:
        spark, batch_id, place = rows.sparkSession, f"{stream}-{number}", f"{staging}/{stream}/batch-{number}"
        ledger = Ledger(spark, f"{staging}/{stream}/ledger", "batch")
        if ledger.has(number, DONE):
            return
        if not ledger.has(number, INTENT):
            rows.withColumns(
                {"batch_id": F.lit(batch_id), "batch_row": F.monotonically_increasing_id()}
            ).write.mode("overwrite").parquet(place)
            ledger.record(number, INTENT)
        staged = spark.read.parquet(place)
        there = _rows_of(spark, fmt, options, batch_id)
        missing = staged if there is None else staged.join(there, "batch_row", "left_anti").select(*staged.columns)
        missing.write.mode("append").format(fmt).options(**options).save()
        ledger.record(number, DONE)
        remove_folder(spark, place)

    return write


def _rows_of(spark: SparkSession, fmt: str, options: dict[str, str], batch_id: str) -> DataFrame | None:
    """The numbers of a batch's rows that the target has; None before it has any table."""
    try:
        target = spark.read.format(fmt).options(**options).load()
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None
    return target.where(F.col("batch_id") == batch_id).select("batch_row")


def reject_writer(path: str, checkpoint: str) -> Writer:
    """Keeps the messages that cannot be used, text and cause, by batch."""
    stream = f"{crc32(checkpoint.encode()):08x}"

    def write(rows: DataFrame, number: int) -> None:
        rows.select("text", "cause").write.mode("overwrite").parquet(f"{path}/stream={stream}/batch={number}")

    return write


def _triggered(writer: DataStreamWriter, checkpoint: str, once: bool, every: str | None) -> DataStreamWriter:
    """``once`` takes what is there now and ends, and the checkpoint carries on
    next time. Otherwise the stream runs on, ``every`` so often if given: each
    micro-batch reads the subscribers, so fewer and larger ones cost less."""
    writer = writer.outputMode("append").option("checkpointLocation", checkpoint)
    if once:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=every) if every else writer


def append_to_table(
    rows: DataFrame, path: str, checkpoint: str, once: bool = False, every: str | None = None
) -> StreamingQuery:
    """Appends a stream to a parquet table, partitioned by week."""
    writer = rows.writeStream.format("parquet").partitionBy("week_number")
    return _triggered(writer, checkpoint, once, every).start(path)


def append_by_batch(
    rows: DataFrame, write: Writer, checkpoint: str, once: bool = False, every: str | None = None,
) -> StreamingQuery:
    """Hands each micro-batch of a stream to ``write`` with its number; a batch
    may come again after a failure, under the same number."""
    writer = rows.writeStream.foreachBatch(write)
    return _triggered(writer, checkpoint, once, every).start()
