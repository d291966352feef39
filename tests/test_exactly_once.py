"""Sends, batches and messages that come twice; messages that cannot be used."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from telmart.operators import crm, device, enrich
from telmart.operators.bloom import key_filter, may_match
from telmart.plans import jobs
from telmart.plans.ledger import DONE, INTENT, Ledger
from telmart.sources import fixtures, messages
from telmart.streaming import enrichment

SF_DIR = "/root/testdata/sf0.001"


def rows_of(frame):
    return Counter(map(tuple, frame.collect()))


def test_ledger(spark, tmp_path):
    ledger = Ledger(spark, f"{tmp_path}/ledger")
    assert ledger.last() is None and ledger.unfinished() == [] and not ledger.has(1)
    ledger.record(1, INTENT)
    ledger.record(1, DONE)
    ledger.record(2, INTENT)
    assert (ledger.last(), ledger.last(INTENT), ledger.unfinished()) == (1, 2, [2])
    assert ledger.has(1) and not ledger.has(2) and ledger.has(2, INTENT)


def test_a_broken_send_leaves_its_intent_and_the_same_keys(spark, tmp_path):
    jobs.stage_revenue(fixtures.revenue(spark, SF_DIR), f"{tmp_path}/staged")
    staged, progress, sent = jobs.read_staged_messages(spark, f"{tmp_path}/staged"), f"{tmp_path}/progress", []

    def broken(rows):
        sent.append(rows_of(rows))
        raise OSError("gone")

    with pytest.raises(OSError):
        jobs.publish_next_week(spark, staged, progress, broken)
    assert jobs.progress_ledger(spark, progress).unfinished() == [22] and jobs.next_week(spark, progress) == 22
    jobs.publish_next_week(spark, staged, progress, lambda rows: sent.append(rows_of(rows)))
    assert sent[0] == sent[1] and jobs.progress_ledger(spark, progress).unfinished() == []
    keys = Counter(key for key, _ in sent[0].elements())
    assert max(keys.values()) == 1 and all(key.startswith("22-") for key in keys)


def test_messages_count_once_within_and_across_batches(spark, tmp_path):
    known = jobs.write_subscribers(
        spark, crm.clean(fixtures.crm_raw(spark, SF_DIR)), device.clean(fixtures.device_raw(spark, SF_DIR)),
        f"{tmp_path}/subscribers")
    jobs.stage_revenue(fixtures.revenue(spark, SF_DIR), f"{tmp_path}/staged")
    staged, topic = jobs.read_staged_messages(spark, f"{tmp_path}/staged"), f"{tmp_path}/topic"
    for week in (22, 22, 23, 22):
        messages.publish_folder(messages.week_messages(staged, week), topic)
        jobs.enrich_available(
            spark, messages.folder_stream(spark, topic), f"{tmp_path}/subscribers", f"{tmp_path}/facts", f"{tmp_path}/check")
    again = messages.week_messages(staged, 24)
    messages.publish_folder(again.unionByName(again), topic)
    jobs.enrich_available(
        spark, messages.folder_stream(spark, topic), f"{tmp_path}/subscribers", f"{tmp_path}/facts", f"{tmp_path}/check")
    wanted = enrich.subscriber_week(known, fixtures.revenue(spark, SF_DIR).where("week_number <= 24"))
    assert rows_of(jobs.read_facts(spark, f"{tmp_path}/facts")) == rows_of(wanted)


def test_only_a_batch_that_was_finished_is_passed_over(spark, tmp_path):
    rows = spark.range(100).selectExpr("id", "string(id % 7) AS name").repartition(4)
    target, options = f"{tmp_path}/target", {"path": f"{tmp_path}/target"}
    write = enrichment.append_once("orc", options, f"{tmp_path}/staging", "c")

    def stored():
        return rows_of(spark.read.orc(target).select("id", "name"))

    write(rows, 0)
    write(rows, 0)
    assert stored() == rows_of(rows)
    # The append of batch 1 broke off half-way: some rows are there, and the batch is staged.
    calls = []

    class Broken(Exception):
        pass

    real = Ledger.record

    def record(self, number, state):
        calls.append(state)
        if state == DONE:
            raise Broken
        real(self, number, state)

    Ledger.record = record
    try:
        with pytest.raises(Broken):
            write(rows, 1)
    finally:
        Ledger.record = real
    there = spark.read.orc(target).where(F.col("batch_id").endswith("-1"))
    half = there.where("batch_row % 2 = 0").collect()
    kept = spark.read.orc(target).where(~F.col("batch_id").endswith("-1")).collect()
    fresh = f"{tmp_path}/fresh"
    spark.createDataFrame(half + kept, there.schema).write.orc(fresh)
    write = enrichment.append_once("orc", {"path": fresh}, f"{tmp_path}/staging", "c")
    # What comes again may be ordered otherwise; the staged rows count.
    write(rows.orderBy(F.desc("id")), 1)
    assert calls == [INTENT, DONE]
    assert rows_of(spark.read.orc(fresh).select("id", "name")) == rows_of(rows.unionAll(rows))


def test_rejected_and_accepted_make_up_what_was_received(spark, tmp_path):
    jobs.write_subscribers(
        spark, crm.clean(fixtures.crm_raw(spark, SF_DIR)), device.clean(fixtures.device_raw(spark, SF_DIR)),
        f"{tmp_path}/subscribers")
    texts = [None, "", " ", "{msisdn:", "[]", '{"week_number":22}', '{"msisdn":"1","week_number":22,"revenue_usd":2}']
    messages.publish_folder(spark.createDataFrame([(x,) for x in texts], "value string"), f"{tmp_path}/topic")
    counts = []
    jobs.enrich_stream(
        spark, messages.folder_stream(spark, f"{tmp_path}/topic"), f"{tmp_path}/subscribers",
        enrichment.fact_writer(f"{tmp_path}/facts", "c"), f"{tmp_path}/check", once=True,
        rejects=f"{tmp_path}/rejects", counted=lambda number, found: counts.append(found)).awaitTermination()
    assert counts == [{"received": 7, "rejected": 6, "accepted": 1}]
    found = rows_of(spark.read.parquet(f"{tmp_path}/rejects").select("text", "cause"))
    assert found == Counter({
        (None, "no text"): 1, ("", "no text"): 1, (" ", "no text"): 1, ("{msisdn:", "unreadable"): 1, ("[]", "unreadable"): 1,
        ('{"week_number":22}', "no key"): 1})


def test_filter_passes_all_keys_and_few_others(spark):
    keys = spark.range(0, 20000, 7).selectExpr("string(id) AS k").unionAll(spark.sql("SELECT CAST(NULL AS STRING)"))
    rows = spark.range(20000).selectExpr("string(id) AS k", "id").unionAll(spark.sql("SELECT CAST(NULL AS STRING), -1L"))
    passed = {row.id for row in may_match(rows, "k", key_filter(keys, "k")).collect()}
    assert set(range(0, 20000, 7)) <= passed and len(passed) < 2858 + 200 and -1 not in passed
    assert may_match(rows, "k", key_filter(keys.limit(0), "k")).count() == 0


def test_a_micro_batch_shuffles_the_subscribers_that_it_has(spark):
    known = spark.range(50000).selectExpr("string(id) AS msisdn", "'male' AS gender")
    revenue = spark.range(100).selectExpr("string(id * 3) AS msisdn", "22 AS week_number")
    plan = enrichment.matched(revenue, known)
    text = plan._jdf.queryExecution().executedPlan().toString()
    subscribers = text[text.index("SortMergeJoin") if "SortMergeJoin" in text else 0:]
    assert "bitmap_construct_agg" in subscribers and "BroadcastHashJoin" in subscribers
    assert may_match(known, "msisdn", key_filter(revenue, "msisdn")).count() < 150
    assert plan.count() == 100
    assert "bitmap" not in enrichment.matched(revenue, known, True)._jdf.queryExecution().executedPlan().toString()
