"""One small row on each side of every threshold."""

import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from ledgerloom.config import Params
from ledgerloom.functions.columns import padded_id, strict_greatest, strict_least
from ledgerloom.functions.finance import instalment, outstanding, share_of_income
from ledgerloom.operators import actions, borrower_state, economics, loan_book, rules, trajectory
from ledgerloom.plans import spend

P = Params()


def column(spark, schema, rows, expr):
    df = spark.createDataFrame(rows, schema).coalesce(1)
    return [r[0] for r in df.select(expr).collect()]


def test_asset_class_and_npa_flag(spark):
    dpds = [0, 1, 30, 31, 60, 61, 89, 90, 91]
    got = column(spark, "d bigint", [(d,) for d in dpds], borrower_state.asset_class("d"))
    assert got == ["STANDARD", "SMA-0", "SMA-0", "SMA-1", "SMA-1", "SMA-2", "SMA-2", "SMA-2", "NPA"]


def test_dpd_is_clamped_to_age(spark):
    assert column(spark, "d bigint, m bigint", [(200, 2), (20, 2), (91, 0)],
                  loan_book.clamped_dpd(F.col("d"), "m")) == [60, 20, 0]


def test_drawn_dpd_tiers(spark):
    rows = [(249, 269, D("2.500")), (250, 59, D("2.500")), (499, 60, D("2.500")), (500, 29, D("2.500")),
            (1249, 0, D("2.500")), (1250, 5, D("2.500"))]
    assert column(spark, "s bigint, v bigint, g decimal(6,3)", rows, loan_book.drawn_dpd("s", "v", "g")) == [
        360, 90, 31, 30, 1, 0]


@pytest.mark.parametrize("dpd,clear,expected", [
    (90, 11, 0), (90, 34, 930), (90, 35, 3000), (89, 5, 3000), (91, 12, 1280), (0, 50, 0), (1, 50, 1000)])
def test_arrears(spark, dpd, clear, expected):
    # 34 % 23 = 11 hundredths on top of a fifth; 12 % 23 = 12.
    assert column(spark, "d bigint, e bigint, h bigint", [(dpd, 1000, clear)], loan_book.arrears("d", "e", "h")) == [
        expected]


def test_income_share_without_income(spark):
    assert column(spark, "a bigint, i bigint", [(100, 0), (9740, 40000)], share_of_income("a", "i")) == [
        None, D("24.4")]


def test_strict_extremes(spark):
    rows = [(None, 1), (3, 1)]
    assert column(spark, "a bigint, b bigint", rows, strict_greatest("a", "b")) == [None, 3]
    assert column(spark, "a bigint, b bigint", rows, strict_least("a", "b")) == [None, 1]


def test_ids_wider_than_the_pad_are_kept(spark):
    assert column(spark, "n bigint", [(7,), (12345678,)], padded_id("LN", "n", 7)) == ["LN0000007", "LN12345678"]


def test_interest_free_loan(spark):
    got = column(spark, "p bigint, r decimal(7,3), n bigint", [(1200, D("0.000"), 12)], instalment("p", "r", "n"))
    assert got == [100]


def test_demo_loan_figures(spark):
    rows = [(200000, D("15.500"), 24, 10), (1200000, D("12.500"), 84, 12)]
    df = spark.createDataFrame(rows, "p bigint, r decimal(7,3), n bigint, m bigint").coalesce(1)
    df = df.withColumn("e", instalment("p", "r", "n")).withColumn("o", outstanding("p", "r", "e", "m"))
    assert [(x.e, x.o) for x in df.collect()] == [(9745, 124074), (21505, 1085529)]


# --- state ---------------------------------------------------------------------------
LOAN = dict(
    loan_id="L1", borrower_id="B1", product_code="PL", product_name="Personal", is_secured=False,
    sanction_amount_inr=100000, disbursed_amount_inr=100000, roi_pct=D("18.500"),
    bank_benchmark_roi_pct=D("12.500"), rate_gap_vs_bank_pct=D("6.000"), rate_type="FIXED", is_repo_linked=False,
    tenor_months=36, emi_amount_inr=1000, disbursal_date=dt.date(2023, 1, 1), maturity_date=dt.date(2026, 1, 1),
    months_elapsed=6, residual_months=30, outstanding_principal_inr=60000, current_dpd=0, unpaid_emi_count=0,
    arrears_amount_inr=0, sourcing_channel="DSA", has_nach_mandate=True, is_active=True,
)
LOAN_SCHEMA = (
    "loan_id string, borrower_id string, product_code string, product_name string, is_secured boolean, "
    "sanction_amount_inr bigint, disbursed_amount_inr bigint, roi_pct decimal(7,3), "
    "bank_benchmark_roi_pct decimal(6,3), rate_gap_vs_bank_pct decimal(8,3), rate_type string, "
    "is_repo_linked boolean, tenor_months bigint, emi_amount_inr bigint, disbursal_date date, maturity_date date, "
    "months_elapsed bigint, residual_months bigint, outstanding_principal_inr bigint, current_dpd bigint, "
    "unpaid_emi_count bigint, arrears_amount_inr bigint, sourcing_channel string, has_nach_mandate boolean, "
    "is_active boolean"
)


def loans(spark, *changes):
    names = [c.split()[0] for c in LOAN_SCHEMA.split(", ")]
    rows = [tuple({**LOAN, "loan_id": f"L{i}", **c}[n] for n in names) for i, c in enumerate(changes)]
    return spark.createDataFrame(rows, LOAN_SCHEMA)


def state_of(spark, loan_df, lenders=0, income=40000, band="GOOD"):
    from ledgerloom.sources.tables import ENTITY_SCHEMAS

    ids = [r[0] for r in loan_df.select("borrower_id").distinct().collect()]
    borrowers = spark.createDataFrame(
        [(i, f"Name {i}", "C", "S", 1, "HINDI", "TRADE", income, 720, band, False, None) for i in ids],
        "borrower_id string, full_name string, city string, state string, city_tier bigint, primary_language string, "
        "occupation_type string, monthly_income_inr bigint, bureau_score bigint, bureau_score_band string, "
        "is_demo_case boolean, demo_case_label string",
    )
    lines = [(f"T{i}{k}", i, f"LENDER_{k}", "FINTECH", "CARD", False, 10, D("1.00"), 12, None, 5, 1, 0, "ACTIVE", None)
             for i in ids for k in range(lenders)]
    tradelines = spark.createDataFrame(lines, ENTITY_SCHEMAS["bureau_tradeline"])
    mandates = spark.createDataFrame([], "borrower_id string, failure_attribution string, is_early_warning boolean")
    return borrower_state.build_borrower_state(borrowers, loan_df, tradelines, mandates, P)


@pytest.mark.parametrize("lenders,stacked", [(3, False), (4, True)])
def test_stacking(spark, lenders, stacked):
    assert state_of(spark, loans(spark, {}), lenders).first().is_loan_stacked is stacked


def test_class_flag_and_upgrade_at_ninety(spark):
    book = loans(
        spark,
        dict(borrower_id="B89", current_dpd=89), dict(borrower_id="B90", current_dpd=90),
        dict(borrower_id="B91", current_dpd=91, arrears_amount_inr=1),
        dict(borrower_id="B91", current_dpd=0),
    )
    got = {r.borrower_id: r for r in state_of(spark, book).collect()}
    assert [got[b].is_npa for b in ("B89", "B90", "B91")] == [False, True, True]
    assert got["B90"].borrower_asset_class == "SMA-2"
    assert [got[b].npa_upgrade_eligible for b in ("B89", "B90", "B91")] == [False, True, False]
    assert got["B91"].performing_loans_dragged_to_npa == 1


# --- economics -----------------------------------------------------------------------
def scored(spark, *changes):
    book = loans(spark, *changes)
    return economics.score_loans(spark, book, state_of(spark, book), P)


def test_stances(spark):
    got = {r.loan_id: r for r in scored(
        spark,
        dict(borrower_id="A", rate_gap_vs_bank_pct=D("0.400")),
        dict(borrower_id="B", rate_gap_vs_bank_pct=D("0.500"), residual_months=18),
        dict(borrower_id="C", rate_gap_vs_bank_pct=D("0.500"), residual_months=17),
        dict(borrower_id="D", rate_gap_vs_bank_pct=D("7.000"), residual_months=84, current_dpd=1),
        dict(borrower_id="E", product_code="NEW"),
        dict(borrower_id="F", rate_gap_vs_bank_pct=None),
    ).collect()}
    assert got["L0"].bt_recommended_stance == economics.STANCE_NO_SIGNAL
    assert got["L1"].bt_is_economically_rational
    assert got["L2"].bt_recommended_stance == economics.STANCE_NOT_RATIONAL
    assert (got["L3"].bt_recommended_stance, got["L3"].bt_risk_score) == (economics.STANCE_DISTRESS, 0)
    assert got["L4"].bt_recommended_stance is None and not got["L4"].has_economics
    assert got["L5"].bt_reduction_needed_pct is None and got["L5"].bt_risk_score is None


def test_unconfigured_product_is_left_out_of_the_view(spark):
    assert economics.loan_economics(scored(spark, {}, dict(product_code="NEW"))).count() == 1


# --- rules -----------------------------------------------------------------------------
RULE_CASES = [
    # dpd, worst dpd, arrears, mandate, broken promise, stance -> action, message starts
    (75, 75, 3000, "NONE", False, None, "PART_PAY_PLAN", "We understand"),
    (75, 75, 3001, "NONE", False, None, "FIELD_VISIT", "We understand"),
    (45, 45, 0, "TECHNICAL", True, None, "FIX_MANDATE", "We understand"),
    (45, 45, 0, "CAPACITY", True, None, "FIELD_VISIT", "We understand"),
    (45, 45, 0, "CAPACITY", False, None, "PART_PAY_PLAN", "We understand"),
    (15, 15, 0, "TECHNICAL", True, None, "FIX_MANDATE", "We understand"),
    (15, 15, 0, "NONE", True, None, "PART_PAY_PLAN", "We understand"),
    (15, 15, 0, "NONE", False, None, "SOFT_REMIND", "We understand"),
    (0, 40, 0, "TECHNICAL", False, None, "NO_ACTION_REQUIRED", None),
    (90, 90, 0, "NONE", False, None, "PART_PAY_PLAN", "We understand"),
    (91, 91, 0, "NONE", False, None, "RESTRUCT_TENOR", "We understand"),
    (180, 180, 0, "NONE", False, None, "RESTRUCT_TENOR", "We understand"),
    (181, 181, 0, "NONE", False, None, "RESTRUCT_MORAT", "We understand"),
    (270, 270, 0, "NONE", False, None, "RESTRUCT_MORAT", "We understand"),
    (271, 271, 0, "NONE", False, None, "OTS_SETTLE", "We would like"),
    (0, 0, 0, "TECHNICAL", False, economics.STANCE_COUNTER, "FIX_MANDATE", "We noticed"),
    (0, 0, 0, "NONE", False, economics.STANCE_COUNTER, "BT_COUNTER", "We value"),
    (0, 0, 0, "NONE", False, economics.STANCE_LET_GO, "BT_LET_GO", None),
    (0, 0, 0, "NONE", False, economics.STANCE_NOT_RATIONAL, "BT_LET_GO", None),
    (0, 0, 0, "NONE", False, economics.STANCE_NO_SIGNAL, "NO_ACTION_REQUIRED", None),
    (0, 0, 0, "NONE", False, None, "NO_ACTION_REQUIRED", None),
]


def test_rule_ladder(spark):
    rows = [(i, *c[:3], 1000, *c[3:6], "quoted") for i, c in enumerate(RULE_CASES)]
    ctx = spark.createDataFrame(
        rows,
        "n int, current_dpd bigint, max_dpd_own bigint, arrears_amount_inr bigint, emi_amount_inr bigint, "
        "mandate_attribution string, any_ptp_made_then_missed boolean, bt_recommended_stance string, "
        "bt_rationale string",
    )
    got = {r.n: r for r in rules.apply_rules(ctx).collect()}
    for i, case in enumerate(RULE_CASES):
        assert got[i].action_code == case[6], case
        message = got[i].borrower_facing_message
        assert (message is None) if case[7] is None else message.startswith(case[7]), case
        assert got[i].rule_basis
        quoted = case[5] in (economics.STANCE_COUNTER, economics.STANCE_NOT_RATIONAL) and case[3] == "NONE"
        assert (got[i].rule_basis == "quoted") is quoted


def test_growth_eligibility(spark):
    rows = [("a", 0, False, False, "GOOD"), ("b", 0, False, False, "FAIR"), ("c", 0, False, False, None),
            ("d", 0, True, False, "GOOD"), ("e", 0, False, True, "EXCELLENT"), ("f", 1, False, False, "GOOD")]
    df = spark.createDataFrame(
        rows, "borrower_id string, max_dpd_own bigint, is_loan_stacked boolean, "
              "is_pre_delinquent_warning boolean, bureau_score_band string")
    assert [r.borrower_id for r in rules.growth_eligible(df).collect()] == ["a"]


def test_latest_mandate_takes_undated_last(spark):
    rows = [("L", "M1", None, "NONE"), ("L", "M2", dt.date(2024, 1, 1), "CAPACITY"),
            ("L", "M3", dt.date(2024, 1, 5), "TECHNICAL"), ("K", "M4", None, "NONE")]
    df = spark.createDataFrame(rows, "loan_id string, mandate_id string, last_failure_date date, failure_attribution string")
    got = {r.loan_id: r.failure_attribution for r in rules.latest_mandate(df).collect()}
    assert got == {"L": "TECHNICAL", "K": "NONE"}


# --- trajectory --------------------------------------------------------------------------
def test_overall_direction(spark):
    rows = [("negative", "positive"), ("mixed", "negative"), ("neutral", "positive"), ("positive", "neutral"),
            ("mixed", "mixed"), (None, "positive")]
    got = column(spark, "f string, l string", rows, trajectory.overall_direction("f", "l"))
    assert got == ["IMPROVING", "DETERIORATING", "MIXED", "MIXED", "STABLE", "MIXED"]


def test_gap_trend(spark):
    rows = [(None, None, None), (1, 5, 5), (2, 5, 9), (2, 9, 5), (2, 5, 5)]
    got = column(spark, "n_transitions bigint, first_gap bigint, last_gap bigint", rows, trajectory.gap_trend())
    assert got == [trajectory.SINGLE_INTERVAL] * 2 + ["WIDENING", "NARROWING", "STABLE"]


# --- contact window and spend --------------------------------------------------------------
@pytest.mark.parametrize("utc,ok", [((2, 29), False), ((2, 30), True), ((13, 29), True), ((13, 30), False)])
def test_contact_window(spark, utc, ok):
    now = F.lit(dt.datetime(2024, 2, 1, *utc)).cast("timestamp_ntz")
    assert spark.range(1).select(actions.in_contact_window(now, P)).first()[0] is ok


def test_spend_rates_and_tags(spark):
    usage = spark.createDataFrame(
        [(dt.date(2024, 1, 1), "ODD", D("2.000000")), (dt.date(2024, 1, 1), "PIPE", D("1.000000")),
         (dt.date(2024, 1, 1), "PIPE", D("0.000000"))],
        "usage_date date, service_type string, credits_used decimal(18,6)")
    got = {r.service_type: (r.usd_per_credit, r.usd, r.rate_note) for r in spend.spend_daily(spark, usage, P).collect()}
    assert got["ODD"] == (D("2.20"), D("4.4000"), "unmapped - rate assumed 2.20")
    assert got["PIPE"][:2] == (D("3.60"), D("3.6000")) and len(got) == 2
    tags = spark.createDataFrame(
        [("", "F", "m", 1, D("1.000000")), (None, "F", "m", 2, D("1.000000")), ("x", "F", "m", 3, D("1.000000"))],
        "query_tag string, function_name string, model_name string, tokens bigint, token_credits decimal(18,6)")
    assert {r.query_tag: r.tokens for r in spend.text_spend_by_tag(tags).collect()} == {"(untagged)": 3, "x": 3}


def test_four_product_blend():
    # Weighted by count the four cited products give 3.575, a half: decimals must be used.
    weights = [(D("40"), D("2.5")), (D("25"), D("3.5")), (D("20"), D("6.4")), (D("15"), D("2.8"))]
    assert sum(w * g / 100 for w, g in weights) == D("3.575")
