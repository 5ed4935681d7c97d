"""Arrival orders, replays, empty batches and escalation through the streams."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import enrichment, trajectory
from ledgerloom.plans.portfolio import Portfolio
from ledgerloom.sources.tables import ENTITY_SCHEMAS, append_missing, write_version
from ledgerloom.streaming import jobs
from ledgerloom.streaming.store import Store

TEXTS = {
    1: "I am late because the business is slow. I will pay Rs 500 by 2 March.",
    2: "I missed my last promise because my phone was lost. I will pay Rs 500 by 9 March.",
    3: "I kept my last promise. Thanks.",
}


def call(borrower, seq):
    return (f"{borrower}-{seq}", borrower, None, "CALL", seq, 3, dt.date(2024, 1, seq), 1, TEXTS[seq], False,
            dt.datetime(2024, 1, seq, 9), False)


def land(spark, path, calls):
    spark.createDataFrame(calls, ENTITY_SCHEMAS["call_transcript"]).coalesce(1).write.mode("append").parquet(path)


def rows(df):
    return {tuple(r[c] for c in trajectory.TRANSITION_COLUMNS) for r in df.collect()}


def drain(spark, base):
    jobs.start_enrichment(spark, f"{base}/in", f"{base}/scored", f"{base}/c1", jobs.CATCH_UP).awaitTermination()
    jobs.start_transitions(spark, f"{base}/scored", f"{base}/out", f"{base}/c2", jobs.CATCH_UP).awaitTermination()


@pytest.mark.parametrize("order", [[1, 2, 3], [1, 3, 2], [3, 2, 1], [1, 2, 2]])
def test_any_arrival_order_gives_the_batch_result(spark, tmp_path, order):
    base = str(tmp_path)
    for seq in order:
        land(spark, f"{base}/in", [call("B", seq)])
        drain(spark, base)
    drain(spark, base)  # nothing new: nothing changes
    got = jobs.read_transitions(spark, f"{base}/out")
    batch = spark.createDataFrame([call("B", s) for s in sorted(set(order))], ENTITY_SCHEMAS["call_transcript"])
    scored = enrichment.scored_calls(batch)
    want = trajectory.call_transitions(scored)
    assert got.count() == len(set(order)) - 1
    assert rows(got) == rows(want)
    late = scored.filter(F.col("transcript_sequence_number") == order[-1])
    only = trajectory.call_transitions(scored, late.select("interaction_id"))
    assert rows(only) <= rows(want) and rows(only)


def test_repeats_and_late_calls_count_once(spark, tmp_path):
    base = str(tmp_path)
    land(spark, f"{base}/in", [call("B", 3), call("B", 3), call("B", 2)])
    drain(spark, base)
    land(spark, f"{base}/in", [call("B", 1), call("B", 2)])  # days behind what was read
    drain(spark, base)
    assert sorted(r.interaction_id for r in jobs.read_scored(spark, f"{base}/scored").collect()) == ["B-1", "B-2", "B-3"]
    assert jobs.read_transitions(spark, f"{base}/out").count() == 2


def test_broken_promise_escalates_the_reminder(spark, tmp_path):
    base = str(tmp_path)
    pf = Portfolio(spark, "/root/testdata/sf0.001", folder=f"{base}/tables")
    mild = pf.scored_loans.filter("current_dpd BETWEEN 1 AND 30").select("borrower_id", "loan_id").orderBy("loan_id")
    borrower, loan = mild.first()
    land(spark, f"{base}/in", [call(borrower, 1)])
    args = (pf, f"{base}/scored", f"{base}/pub", f"{base}/c3", jobs.CATCH_UP)

    def cycle():
        jobs.start_enrichment(spark, f"{base}/in", f"{base}/scored", f"{base}/c1", jobs.CATCH_UP).awaitTermination()
        jobs.start_refresh(*args).awaitTermination()

    def action():
        recs = jobs.current(spark, f"{base}/pub", "nba_recommendation")
        return recs.filter(F.col("loan_id") == loan).first().action_code

    cycle()
    assert action() == "SOFT_REMIND"
    everyone = jobs.current(spark, f"{base}/pub", "customer_360").count()
    land(spark, f"{base}/in", [call(borrower, 2)])
    cycle()
    assert action() == "PART_PAY_PLAN"
    now = jobs.current(spark, f"{base}/pub", "customer_360")
    assert now.count() == everyone == pf.state.count()
    assert now.filter(F.col("borrower_id") == borrower).first().any_ptp_made_then_missed
    before = sorted(map(str, now.collect()))
    cycle()  # an empty cycle leaves every row as it was
    assert sorted(map(str, jobs.current(spark, f"{base}/pub", "customer_360").collect())) == before


def test_sinks_are_repeatable(spark, tmp_path):
    df = spark.range(5)
    path = write_version(df, f"{tmp_path}/t", 1)
    write_version(df, f"{tmp_path}/t", 1)
    assert spark.read.parquet(path).count() == 5
    target = f"{tmp_path}/log"
    append_missing(df, None, ["id"], target)
    append_missing(spark.range(7), spark.read.schema("id bigint").parquet(target), ["id"], target)
    assert spark.read.parquet(target).count() == 7


def test_a_small_bucket_is_one_file_and_a_large_one_several(spark, tmp_path):
    rows = spark.range(20_000).select(F.format_string("B%06d", F.col("id") % 900).alias("borrower_id"), F.md5(F.col("id").cast("string")).alias("x"))
    rows = rows.repartition(12)
    small = Store(spark, f"{tmp_path}/small", 6)
    got = small.write(0, "t", rows)
    assert got.count() == 20_000 and got.exceptAll(rows).isEmpty()
    files = got.select(F.input_file_name().alias("f")).distinct()
    assert files.count() == 6
    setting = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(setting, "64k")
    try:
        got = Store(spark, f"{tmp_path}/large", 1).write(0, "t", rows)
    finally:
        spark.conf.unset(setting)
    assert got.count() == 20_000 and got.select(F.input_file_name()).distinct().count() > 1
