"""Ranking and pairing when one key holds a third of all rows, against brute force."""

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import ranking, trajectory


@pytest.fixture(scope="module")
def events(spark):
    rng = random.Random(5)
    start = pd.Timestamp("2024-01-01")
    rows = []
    for i in range(6000):
        key = "HOT" if i % 3 == 0 else f"K{rng.randrange(400)}"
        rows.append((i, key, (start + pd.Timedelta(minutes=rng.randrange(40000))).to_pydatetime()))
    return pd.DataFrame(rows, columns=["id", "key", "ts"])


def written(spark, df, path):
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def test_sequence_of_a_hot_key(spark, events, tmp_path):
    df = spark.createDataFrame(events, "id bigint, key string, ts timestamp_ntz").repartition(6)
    df = written(spark, ranking.cut_by_range(df, "key", "ts", "id"), f"{tmp_path}/cut")
    got = ranking.keyed_sequence(df, "key", ["ts", "id"], F.col("_slice"), "ts").toPandas()
    want = events.sort_values(["key", "ts", "id"]).copy()
    by = want.groupby("key")
    want["seq"], want["seq_length"] = by.cumcount() + 1, by["id"].transform("size")
    want["previous_time"] = by["ts"].shift()
    cols = ["id", "seq", "seq_length", "previous_time"]
    pd.testing.assert_frame_equal(
        got[cols].sort_values("id").reset_index(drop=True), want[cols].sort_values("id").reset_index(drop=True),
        check_dtype=False)


def test_a_hot_hour_is_dealt_over_many_slices(spark, tmp_path):
    # One borrower, all calls within one hour; small advisory sizes keep the ranges apart.
    base = spark.range(20000).selectExpr("id", "'HOT' AS key", "TIMESTAMP_NTZ'2024-01-01 09:00:00' AS ts")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        cut = written(spark, ranking.cut_by_range(base, "key", "ts", "id"), f"{tmp_path}/cut")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    sizes = [r["count"] for r in cut.groupBy("_slice").count().collect()]
    assert len(sizes) >= 6 and max(sizes) < 20000 / 4
    got = ranking.keyed_sequence(cut, "key", ["ts", "id"], F.col("_slice"), "ts")
    assert got.filter("seq <> id + 1 OR seq_length <> 20000").count() == 0


def test_global_row_number_over_written_ranges(spark, tmp_path):
    # All keys share a long prefix, which the range cut does not mind.
    ids = [f"COMMON-PREFIX-{n:06d}" for n in random.Random(4).sample(range(200000), 5000)]
    df = spark.createDataFrame([(i,) for i in ids], "id string").repartition(7)
    ranking.cut_by_range(df, "id").write.parquet(f"{tmp_path}/cut")
    cut = spark.read.schema("id string, _slice bigint").parquet(f"{tmp_path}/cut")
    got = {r.id: r.n for r in ranking.global_row_number(cut, "id", "n").collect()}
    assert got == {i: k + 1 for k, i in enumerate(sorted(ids))}


def test_lag_pairs_over_slices(spark):
    rows = [("HOT", k, f"H{k}", "neutral") for k in range(1, 2000)] + [("B", k, f"B{k}", "mixed") for k in (1, 2, 3)]
    df = spark.createDataFrame(rows, "borrower_id string, transcript_sequence_number bigint, interaction_id string, sentiment string")
    got = {(r.from_interaction_id, r.to_interaction_id) for r in trajectory.lag_pairs(df, slice_size=64).collect()}
    want = {(f"H{k}", f"H{k + 1}") for k in range(1, 1999)} | {("B1", "B2"), ("B2", "B3")}
    assert got == want


def test_a_missing_call_gives_no_pair(spark):
    rows = [("B", 1, 3, "I1"), ("B", 3, 3, "I3")]
    df = spark.createDataFrame(rows, "borrower_id string, transcript_sequence_number bigint, total_sequence_length bigint, interaction_id string")
    df = df.withColumns({c: F.lit("None") for c in ("sentiment", "stated_reason", "promise_to_pay_amount", "previous_promise_missed_raw")})
    df = df.withColumn("days_since_previous_contact", F.lit(1))
    assert trajectory.pair_calls(df, df).count() == 0
