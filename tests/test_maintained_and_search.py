"""Maintained totals and top against recomputation, and text search against a scan."""

import random

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import search
from ledgerloom.plans import reports
from ledgerloom.streaming import maintained as m

SCHEMA = (
    "borrower_id string, full_name string, borrower_asset_class string, bt_is_a_flight_risk boolean, has_retention_offer boolean, "
    "is_npa boolean, npa_upgrade_eligible boolean, bt_retention_value_if_offered_inr bigint, ltv_expected_interest_inr decimal(18,2), "
    "bt_risk_score decimal(9,2)"
)


@pytest.fixture(autouse=True)
def few_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def row(rng, i):
    from decimal import Decimal

    some = lambda n: rng.choice([None, rng.randrange(n)])
    value = some(6)
    return (f"B{i:03}", f"N{i}", rng.choice(["STANDARD", "SMA-1", "NPA"]), rng.choice([True, True, False, None]), rng.random() < 0.5,
            rng.random() < 0.5, rng.choice([True, None]), some(50), None if value is None else Decimal(value), Decimal(1))


def rows(df):
    return sorted(str(r) for r in df.collect())


def test_totals_and_top_after_random_updates_and_deletions(spark, tmp_path):
    rng = random.Random(6)
    table = {i: row(rng, i) for i in range(40)}
    k, size, refills = 4, 7, 0
    step = [0]

    def frame(ids):
        return spark.createDataFrame([table[i] for i in ids if i in table], SCHEMA).coalesce(1)

    def write(df):
        step[0] += 1
        path = f"{tmp_path}/{step[0]}"
        df.coalesce(1).write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    totals = write(m.totals(frame(table)))
    reserve, floor = m.filled_reserve(frame(table), write, size)
    for _ in range(7):
        risky = [i for i in table if table[i][3]]
        ids = set(rng.sample(range(44), 5)) | set(rng.sample(risky, min(len(risky), rng.randrange(6))))
        old = frame(ids)
        touched = spark.createDataFrame([(f"B{i:03}",) for i in ids], "borrower_id string")
        for i in ids:
            table.pop(i, None)
            if rng.random() < 0.7:
                table[i] = row(rng, i)
        now = frame(ids)
        totals = write(m.added(totals, m.totals(old, -1), m.totals(now)))
        assert rows(totals) == rows(m.totals(frame(table)))
        known = totals.agg(F.sum("flight_risks")).first()[0] or 0
        reserve, floor, refilled = m.kept_reserve(reserve, floor, touched, m.flight_risks(now), lambda: frame(table), write, known, k, size)
        refills += refilled
        assert [tuple(r) for r in m.best(reserve, k).collect()] == [tuple(r) for r in m.best(m.flight_risks(frame(table)), k).collect()]
    assert refills < 7
    assert [tuple(r) for r in m.kpis(totals).collect()] == [tuple(r) for r in reports.portfolio_kpis(frame(table)).collect()]


def test_totals_of_nothing(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert m.totals(empty).count() == 0
    assert m.kpis(m.totals(empty)).collect() == reports.portfolio_kpis(empty).collect()
    assert m.filled_reserve(empty, lambda df: df)[1] is None


NAMES = ["Asha Rao", "asha raO", "Bhaskara Rao", "व्यापार सिंह", "İpek Ö", "a%b_c\\d", "", None, "ab", "RAO RAO RAO", "Xavier"]


@pytest.mark.parametrize("text", ["rao", "RAO", "asha", "a r", "ापा", "000", "b00", "ra", "", "zzz", "raozzz", "a%b", "rao%rao", "s_a", "c\\\\d", "İpe"])
def test_search_equals_a_scan(spark, text):
    people = spark.createDataFrame([(f"B{i:04}", n) for i, n in enumerate(NAMES)], "borrower_id string, full_name string")
    grams = search.postings(people)
    found = search.candidates(people, grams, search.gram_counts(grams), text).filter(search.contains(text))
    assert rows(found) == rows(people.filter(search.contains(text)))


def test_search_reads_the_candidates_only(spark, tmp_path):
    people = spark.range(5000).select(F.format_string("B%05d", "id").alias("borrower_id"), F.md5(F.col("id").cast("string")).alias("full_name"))
    people.coalesce(1).write.parquet(f"{tmp_path}/people")
    search.postings(people).coalesce(1).sortWithinPartitions("gram").write.parquet(f"{tmp_path}/grams")
    people, grams = (spark.read.parquet(f"{tmp_path}/{n}") for n in ("people", "grams"))
    assert grams.groupBy("gram", "borrower_id").count().filter("count > 1").count() == 0
    found = search.candidates(people, grams, search.gram_counts(grams), "04321")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(borrower_id,B04321)" in plan and "Join" not in plan
    assert "B04321" in {r.borrower_id for r in found.collect()} and found.count() <= 5
    lists = search.holders(grams, search.rarest(search.gram_counts(grams), "04321"))
    assert "EqualTo(gram," in lists._jdf.queryExecution().executedPlan().toString()
