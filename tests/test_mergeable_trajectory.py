"""Summaries and runs merged batch by batch: any arrival order, repeats, gaps, and what a batch reads."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import call_runs, enrichment, trajectory
from ledgerloom.sources.tables import ENTITY_SCHEMAS
from ledgerloom.streaming import jobs
from ledgerloom.streaming.store import Store

TEXTS = [
    "I am late because the business is slow. I will pay Rs 500 by 2 March.",
    "I missed my last promise because my phone was lost. I will pay Rs 500 by 9 March.",
    "I kept my last promise. Thanks.",
    "The bank made an error. I am angry.",
    "",
]


def call(borrower, seq, of=9):
    text = TEXTS[(seq * 7 + len(borrower)) % len(TEXTS)]
    day = dt.date(2024, 1, 1) + dt.timedelta(days=seq * (1 + seq % 3))
    return (f"{borrower}-{seq}", borrower, None, "CALL", seq, of, day, 1 + seq % 4, text, False, dt.datetime(2024, 1, 1), False)


@pytest.fixture(scope="module")
def scored(spark):
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")  # few rows, many small jobs
    calls = [call(b, s) for b, n in (("A", 9), ("BB", 6), ("CCC", 1), ("DDDD", 30)) for s in range(1, n + 1)]
    calls += [call("E", s, 1) for s in (1, 2)] + [call("F", s) for s in (2, 3, 7, 9)]
    found = enrichment.scored_calls(spark.createDataFrame(calls, ENTITY_SCHEMAS["call_transcript"])).persist()
    yield found
    found.unpersist()
    spark.conf.set("spark.sql.shuffle.partitions", partitions)


def rows(df):
    return sorted(str(r) for r in df.collect())


def feed(spark, folder, scored, batches):
    for version, ids in enumerate(batches):
        store = Store(spark, folder, 2)
        batch = scored.filter(F.col("interaction_id").isin(ids))
        buckets = store.buckets_of(batch)
        taken = jobs.Intake(store, version, batch, buckets, jobs.borrowers_of(store, version, batch))
        store.commit(version, taken.tables, buckets, taken.appended)
    return Store(spark, folder)


@pytest.mark.parametrize("seed", range(2))
def test_any_arrival_order_and_repeats_equal_the_batch(spark, tmp_path, scored, seed):
    rng = random.Random(seed)
    ids = [r[0] for r in scored.select("interaction_id").collect()]
    order = ids + rng.sample(ids, 8)
    rng.shuffle(order)
    cuts = sorted(rng.sample(range(1, len(order)), 3))
    store = feed(spark, str(tmp_path), scored, [order[a:b] for a, b in zip([0, *cuts], [*cuts, len(order)])])
    pairs = trajectory.call_transitions(scored)
    assert rows(store.read("call_transition")) == rows(pairs)
    assert rows(store.read("scored_call")) == rows(scored)
    got = trajectory.trajectory_rows(store.read("trajectory_state"))
    assert rows(got) == rows(trajectory.trajectory_summary(scored, pairs))
    runs = {(r.borrower_id, r.lo, r.hi) for r in store.read("call_run").collect()}
    assert runs == {("A", 1, 9), ("BB", 1, 6), ("CCC", 1, 1), ("DDDD", 1, 30), ("E", 1, 2), ("F", 2, 3), ("F", 7, 7), ("F", 9, 9)}


def test_a_batch_reads_the_same_however_many_came_before(spark, tmp_path, scored, monkeypatch):
    read, count = Store.read, []

    def counted(self, name, buckets=None, before=None):
        found = read(self, name, buckets, before)
        count.append((name, found.count() if before in (2, 20) else None))
        return found

    monkeypatch.setattr(Store, "read", counted)
    per_batch = []
    for seq in range(1, 21):
        store = Store(spark, str(tmp_path), 1)
        batch = scored.filter(F.col("interaction_id") == f"DDDD-{seq}")
        taken = jobs.Intake(store, seq, batch, [0], jobs.borrowers_of(store, seq, batch))
        store.commit(seq, taken.tables, [0], taken.appended)
        per_batch.append(sorted(count))
        count.clear()
    assert {name for batch in per_batch for name, _ in batch} == {"call_run", "trajectory_state"}
    assert per_batch[1] == per_batch[19] and {n for _, n in per_batch[19]} == {1}


def test_an_aborted_version_leaves_no_rows(spark, tmp_path, scored):
    store = feed(spark, str(tmp_path), scored, [["A-1", "A-2"]])
    lost, kept = (scored.filter(F.col("interaction_id") == i) for i in ("A-3", "A-4"))
    jobs.Intake(store, 1, lost, [0, 1], jobs.borrowers_of(store, 1, lost))  # never committed
    store = Store(spark, str(tmp_path))
    assert store.next_version() == 1 and store.read("scored_call").count() == 2
    taken = jobs.Intake(store, 1, kept, [0, 1], jobs.borrowers_of(store, 1, kept))
    store.commit(1, taken.tables, [0, 1], taken.appended)
    assert rows(Store(spark, str(tmp_path)).read("scored_call").select("interaction_id")) == [f"Row(interaction_id='A-{i}')" for i in (1, 2, 4)]


def test_calls_without_number_or_borrower_do_not_enter(spark, scored):
    odd = scored.limit(1).withColumn("transcript_sequence_number", F.lit(None).cast("bigint"))
    odd = odd.unionByName(scored.limit(1).withColumn("borrower_id", F.lit(None).cast("string")))
    assert call_runs.unheard(odd, None).count() == 0
