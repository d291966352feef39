from collections import Counter

import pytest
from pyspark.sql import functions as F

from telmart import schemas
from telmart.operators import crm, device, enrich
from telmart.plans import jobs
from telmart.sources import fixtures, messages
from telmart.streaming import enrichment

SF_DIR = "/root/testdata/sf0.001"


def rows_of(frame):
    return Counter(map(tuple, frame.collect()))


def prepare(spark, folder):
    known = jobs.write_subscribers(
        spark, crm.clean(fixtures.crm_raw(spark, SF_DIR)), device.clean(fixtures.device_raw(spark, SF_DIR)),
        f"{folder}/subscribers")
    return known, fixtures.revenue(spark, SF_DIR)


def test_restart_takes_up_where_the_checkpoint_stands(spark, tmp_path):
    known, revenue = prepare(spark, tmp_path)
    topic, facts = f"{tmp_path}/topic", f"{tmp_path}/facts"
    for part in (revenue.filter("week_number <= 23"), revenue.filter("week_number > 23")):
        messages.publish_folder(messages.encode(part), topic)
        for _ in range(2):
            jobs.enrich_available(
                spark, messages.folder_stream(spark, topic, max_files=1), f"{tmp_path}/subscribers",
                facts, f"{tmp_path}/checkpoint")
    assert rows_of(jobs.read_facts(spark, facts)) == rows_of(enrich.subscriber_week(known, revenue))


def test_unreadable_messages_drop_out(spark, tmp_path):
    known, _ = prepare(spark, tmp_path)
    key = known.filter("msisdn IS NOT NULL").first().msisdn
    texts = [
        f'{{"msisdn":"{key}","week_number":22,"revenue_usd":1.5}}',
        f'{{"msisdn":"{key}","week_number":22.0,"revenue_usd":2.5}}',
        '{"msisdn":"nobody","week_number":22,"revenue_usd":3.5}',
        '{"week_number":22}', "{msisdn:", "", None,
    ]
    frame = spark.createDataFrame([(text,) for text in texts], "value string")
    decoded = messages.decode(messages.as_topic_rows(frame, "revenue"))
    assert decoded.columns == ["msisdn", "week_number", "revenue_usd"]
    assert decoded.count() == len(texts)
    messages.publish_folder(frame, f"{tmp_path}/topic")
    jobs.enrich_available(
        spark, messages.folder_stream(spark, f"{tmp_path}/topic"), f"{tmp_path}/subscribers",
        f"{tmp_path}/facts", f"{tmp_path}/checkpoint")
    found = jobs.read_facts(spark, f"{tmp_path}/facts").collect()
    assert sorted((row.msisdn, row.week_number, float(row.revenue_usd)) for row in found if row.week_number) == [
        (key, 22, 1.5)]
    assert len(found) == 2


def test_every_message_is_parsed_once(spark):
    known = spark.createDataFrame([("a", "male")], "msisdn string, gender string")
    rows = messages.as_topic_rows(spark.createDataFrame([("{}",)], "value string"), "revenue")
    plan = enrichment.enriched(rows, known)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_messages_are_marked_for_broadcast_only_on_demand(spark):
    known = spark.createDataFrame([("a", "male")], "msisdn string, gender string")
    rows = messages.as_topic_rows(spark.createDataFrame([("{}",)], "value string"), "revenue")
    plans = [enrichment.enriched(rows, known, *more)._jdf.queryExecution().logical().toString() for more in ((), (True,))]
    assert ["broadcast" in plan for plan in plans] == [False, True]
    assert messages.topic_options("host", "t", 5)["maxOffsetsPerTrigger"] == "5"
    assert "maxOffsetsPerTrigger" not in messages.topic_options("host", "t")


def test_batches_to_a_target_without_a_stream_writer(spark, tmp_path):
    known, revenue = prepare(spark, tmp_path)
    messages.publish_folder(messages.encode(revenue), f"{tmp_path}/topic")
    write = enrichment.format_writer("orc", {"path": f"{tmp_path}/warehouse"})
    for _ in range(2):
        jobs.enrich_stream(
            spark, messages.folder_stream(spark, f"{tmp_path}/topic"), f"{tmp_path}/subscribers", write,
            f"{tmp_path}/checkpoint", once=True).awaitTermination()
    assert rows_of(spark.read.orc(f"{tmp_path}/warehouse")) == rows_of(enrich.subscriber_week(known, revenue))


def test_a_batch_that_comes_again_replaces_itself(spark, tmp_path):
    known, revenue = prepare(spark, tmp_path)
    write = enrichment.fact_writer(f"{tmp_path}/facts", "checkpoint")
    facts = enrich.subscriber_week(known, revenue)
    write(facts.filter("week_number < 24"), 0)
    write(facts.filter("week_number >= 24"), 1)
    write(facts.filter("week_number < 24"), 0)
    assert rows_of(jobs.read_facts(spark, f"{tmp_path}/facts")) == rows_of(facts)
    enrichment.fact_writer(f"{tmp_path}/facts", "another checkpoint")(facts.limit(1), 0)
    assert jobs.read_facts(spark, f"{tmp_path}/facts").count() == facts.count() + 1


def test_a_batch_writes_few_files_a_week(spark, tmp_path):
    known, revenue = prepare(spark, tmp_path)
    facts = enrich.subscriber_week(known, revenue.repartition(40)).repartition(40)
    enrichment.fact_writer(f"{tmp_path}/facts", "checkpoint")(facts, 0)
    weeks = revenue.select("week_number").distinct().count()
    assert len(list((tmp_path / "facts").rglob("*.parquet"))) == weeks


def test_subscribers_are_versions(spark, tmp_path):
    known, _ = prepare(spark, tmp_path)
    older = jobs.read_subscribers(spark, f"{tmp_path}/subscribers")
    before = older.count()
    empty = device.clean(fixtures.device_raw(spark, SF_DIR)).limit(0)
    jobs.write_subscribers(spark, crm.clean(fixtures.crm_raw(spark, SF_DIR)), empty, f"{tmp_path}/subscribers")
    assert older.count() == before, "a running reader is not disturbed"
    assert jobs.read_subscribers(spark, f"{tmp_path}/subscribers").count() < before
    with pytest.raises(ValueError):
        jobs.read_subscribers(spark, f"{tmp_path}/nothing")


def test_hot_subscribers_are_split_in_a_stream(spark, tmp_path):
    settings = {
        "spark.sql.shuffle.partitions": "32",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        revenue = spark.range(0, 60000, 1, 8).selectExpr(
            "if(id % 3 = 0, 'hot', string(id % 5000)) AS msisdn", "22 AS week_number",
            "cast(id AS decimal(28,10)) AS revenue_usd")
        messages.publish_folder(messages.encode(revenue), f"{tmp_path}/topic")
        customers = spark.range(0, 5001, 1, 2).selectExpr(
            "if(id = 5000, 'hot', string(id)) AS msisdn", "'male' AS gender", "'1980' AS year_of_birth",
            "'ACTIVE' AS system_status", "'Prepaid' AS mobile_type", "'Tier_1' AS value_segment")
        devices = spark.createDataFrame([], schemas.DEVICE)
        jobs.write_subscribers(spark, customers, devices, f"{tmp_path}/subscribers")
        plans = []

        def write(rows, number):
            plans.append((len(rows.collect()), rows._jdf.queryExecution().executedPlan().toString()))

        jobs.enrich_stream(
            spark, messages.folder_stream(spark, f"{tmp_path}/topic"), f"{tmp_path}/subscribers", write,
            f"{tmp_path}/checkpoint", once=True).awaitTermination()
        assert plans[0][0] == 60000 and "SortMergeJoin(skew=true)" in plans[0][1]
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.fixture
def small_pieces(spark, monkeypatch):
    """20 KB of shuffled rows a task where the jobs say how many."""
    monkeypatch.setattr(jobs, "SENT_BYTES", "20k")
    monkeypatch.setattr(enrichment, "FACT_BYTES", "20k")
    key = "spark.sql.adaptive.coalescePartitions.minPartitionSize"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "10k")
    yield
    spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def one_week(spark, rows):
    return spark.range(0, rows, 1, 8).selectExpr(
        "string(id) AS msisdn", "22 AS week_number", "cast(id AS decimal(28,10)) AS revenue_usd")


def test_a_week_in_one_staged_file_is_sent_by_several_tasks(spark, tmp_path, small_pieces):
    """The files of a send are the tasks that decode its messages."""
    size = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    jobs.stage_revenue(one_week(spark, 40000).coalesce(1), f"{tmp_path}/staged")
    assert len(list((tmp_path / "staged").rglob("*.parquet"))) == 1
    jobs.publish_next_week(
        spark, jobs.read_staged_messages(spark, f"{tmp_path}/staged"), f"{tmp_path}/progress",
        lambda rows: messages.publish_folder(rows, f"{tmp_path}/topic"))
    topic = spark.read.parquet(f"{tmp_path}/topic")
    assert topic.select("key").distinct().count() == topic.count() == 40000
    parts = [row["count"] for row in topic.groupBy(F.input_file_name()).count().collect()]
    assert len(parts) >= 4 and max(parts) < 2 * 40000 / len(parts)
    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == size


def test_a_large_week_is_written_by_several_tasks(spark, tmp_path, small_pieces):
    rows = one_week(spark, 40000).withColumn("message_id", F.col("msisdn"))
    enrichment.fact_writer(f"{tmp_path}/facts", "checkpoint")(rows, 0)
    assert len(list((tmp_path / "facts").rglob("*.parquet"))) >= 4
    assert spark.read.parquet(f"{tmp_path}/facts").count() == 40000
