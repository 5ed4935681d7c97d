"""Golden demonstration cases and properties that hold for every book."""

from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import loan_book, rules
from ledgerloom.plans.portfolio import Portfolio
from ledgerloom.plans import quality

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def pf(spark):
    return Portfolio(spark, SF_DIR)


def test_demo_contrast(pf):
    got = {r.borrower_id: r for r in pf.customer_360.filter("is_demo_case").collect()}
    short, long = got["BRW000001"], got["BRW000002"]
    assert (short.own_loan_count, long.own_loan_count) == (1, 1)
    assert abs(short.ltv_expected_interest_inr - D("12353.50")) <= D("0.01")
    assert abs(long.ltv_expected_interest_inr - D("462895.80")) <= D("0.01")
    assert (short.bt_is_a_flight_risk, long.bt_is_a_flight_risk) == (False, True)
    assert (short.bt_risk_score, long.bt_risk_score) == (D("0.0"), D("25.7"))
    assert long.bt_retention_value_if_offered_inr == 58618
    assert (short.has_retention_offer, long.has_retention_offer) == (False, True)
    actions = {r.borrower_id: r.action_code for r in pf.recs.filter(
        F.col("borrower_id").isin(*got) & F.col("loan_id").isNotNull()).collect()}
    assert actions == {"BRW000001": "BT_LET_GO", "BRW000002": "BT_COUNTER"}


def test_schedule_residue_of_demo_loans(pf):
    last = pf.schedule.join(pf.loans.select("loan_id", "tenor_months"), "loan_id").filter(
        (F.col("installment_number") == F.col("tenor_months")) & F.col("borrower_id").isin("BRW000001", "BRW000002"))
    got = {r.borrower_id: r.closing_balance_inr for r in last.collect()}
    assert round(got["BRW000001"], 2) == D("-2.56")
    assert round(got["BRW000002"], 2) == D("64.78")


def test_schedule_closes_and_principal_adds_up(pf):
    per_loan = pf.schedule.groupBy("loan_id").agg(
        F.sum("principal_component_inr").alias("paid"), F.min_by("closing_balance_inr", -F.col("installment_number")).alias("left"))
    bad = per_loan.join(pf.loans, "loan_id").filter(
        (F.abs(F.col("left")) > F.col("tenor_months"))
        | (F.abs(F.col("paid") + F.col("left") - F.col("sanction_amount_inr")) > 0.05))
    assert bad.count() == 0


def test_both_lifetime_values_agree(pf):
    assert pf.ltv.exceptAll(loan_book.lifetime_value(pf.loans, pf.schedule)).count() == 0


def test_distress_means_no_transfer_risk(pf):
    late = pf.scored_loans.filter("borrower_max_dpd_own >= 1")
    assert late.count() > 0
    assert late.filter("bt_risk_score <> 0 OR bt_is_economically_rational OR bt_reduction_needed_pct <> 0").count() == 0


def test_assertions_all_hold(pf):
    rows = quality.standing_assertions(
        pf.recs, pf.log, pf.state, pf.loan_economics, pf.loans, quality.baseline(pf.recs)).collect()
    assert len(rows) == 9 and all(r.violation_count == 0 for r in rows)


def test_assertions_catch_violations(pf):
    recs = pf.recs.withColumn("rule_basis", F.lit(None).cast("string")).withColumn("bureau_disclosure", F.lit(None))
    loans = pf.loans.withColumn("unpaid_emi_count", F.col("months_elapsed") + 1)
    got = {r.assertion[:2]: r.violation_count for r in quality.standing_assertions(
        recs, pf.log.limit(0), pf.state, pf.loan_economics, loans, quality.baseline(pf.recs)).collect()}
    n = pf.recs.count()
    assert got["A2"] == n and got["A4"] == n and got["C1"] == pf.loans.count()


@pytest.mark.parametrize("partitions", ["1", "7", "64"])
def test_results_do_not_depend_on_partitioning(spark, pf, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        again = Portfolio(spark, SF_DIR)
        assert quality.run_difference(pf.recs, again.recs).count() == 0
        assert again.calls.exceptAll(pf.calls).count() == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_recommendation_ids_are_unique_and_stable(pf):
    assert pf.recs.groupBy("recommendation_id").count().filter("count > 1").count() == 0
    again = rules.stage_recommendations(pf.spark, pf.candidates, pf.p)
    assert again.select("recommendation_id").exceptAll(pf.recs.select("recommendation_id")).count() == 0
