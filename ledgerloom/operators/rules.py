"""Next-best-action rules: an ordered rule table compiled to one CASE per loan."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.config import Params, action_table
from ledgerloom.functions.columns import bucket_sql, moment, nth, pick, whole_ratio
from ledgerloom.operators.economics import STANCE_COUNTER, STANCE_LET_GO, STANCE_NOT_RATIONAL
from ledgerloom.sources.tables import merged

# --- fixed values: rule and message texts ---------------------------------------
BASIS_LAST_RESORT = (
    "RULE: DPD>270, NPA, last-resort tier per DIM_ACTION.is_last_resort. Structured-data-only pass - no "
    "transcript evidence of wilful vs hardship intent yet."
)
BASIS_MORATORIUM = "RULE: DPD 181-270, NPA - moratorium restructuring attempted before last resort."
BASIS_TENOR = "RULE: DPD 91-180, newly NPA - tenure restructuring is the first cure attempt."
BASIS_VISIT = "RULE: SMA-2 (61-90 DPD), arrears exceed 3 EMIs - field-visit threshold."
BASIS_SMA2 = "RULE: SMA-2 (61-90 DPD), below field-visit arrears threshold - part payment plan."
BASIS_SMA1_MANDATE = (
    "RULE: SMA-1 (31-60 DPD) with TECHNICAL mandate failure attribution - fix root cause before any "
    "collections escalation."
)
BASIS_SMA1_BROKEN = (
    "RULE: SMA-1 (31-60 DPD) - escalated to field visit because the borrower has broken a payment promise on "
    "a prior call, per the sequenced-call trajectory signal. A part-payment plan alone is not warranted once "
    "a promise has already been missed."
)
BASIS_SMA1 = "RULE: SMA-1 (31-60 DPD) - part payment plan."
BASIS_SMA0_MANDATE = (
    "RULE: SMA-0 (1-30 DPD) with TECHNICAL mandate failure - fix mandate, most SMA-0 self-cures once the "
    "debit succeeds."
)
BASIS_SMA0_BROKEN = (
    "RULE: SMA-0 (1-30 DPD) - escalated to a part-payment plan because the borrower has already broken a "
    "payment promise on a prior call, per the sequenced-call trajectory signal. A soft reminder alone is not "
    "warranted once a promise has already been missed."
)
BASIS_SMA0 = "RULE: SMA-0 (1-30 DPD) - soft reminder, most self-cures at this bucket."
BASIS_ELSEWHERE = (
    "RULE: this loan is current, but borrower is in distress on another facility (borrower-level RBI asset "
    "classification) - no separate action on this loan, and no growth/retention action anywhere on this "
    "borrower."
)
BASIS_EARLY_MANDATE = (
    "RULE: mandate failed, DPD still zero - earliest warning signal available, addressed before it becomes "
    "delinquency."
)
BASIS_LET_GO = (
    "RULE: transfer is economically rational for the borrower, but the counter-offer costs more margin than "
    "the loan is worth retaining - let go."
)
BASIS_NOTHING = "RULE: no structured-data trigger fired this cycle."
BASIS_GROWTH = (
    "RULE: borrower is clean (DPD=0 across all own facilities, no loan stacking, no pre-delinquent mandate "
    "warning) with GOOD or EXCELLENT bureau standing - eligible for proactive growth outreach."
)
MESSAGE_HARDSHIP = (
    "We understand things can get difficult. We would like to work out a plan together that fits your "
    "situation - please call us back so we can discuss the options available to you."
)
MESSAGE_SETTLEMENT = (
    "We would like to resolve this account with you directly and avoid further escalation. Please contact us "
    "to discuss a settlement that works for both sides."
)
MESSAGE_MANDATE = (
    "We noticed your last auto-debit did not go through. This looks like a bank-side issue rather than "
    "anything on your part - let's get it fixed so your payments continue smoothly."
)
MESSAGE_COUNTER = (
    "We value having you as a customer and would like to offer you a better rate to make sure we remain your "
    "best option."
)
MESSAGE_GROWTH = (
    "You have built a strong repayment record with us - we would like to offer you a benefit as a thank you "
    "for staying on track."
)
GROWTH_ACTIONS = ["TOP_UP", "CROSS_INSURE", "LIMIT_UP"]
GROWTH_BANDS = ["EXCELLENT", "GOOD"]
FROM_ECONOMICS = None  # the rule quotes the loan's own BT rationale


@dataclass(frozen=True)
class Rule:
    action: str
    basis: str | None
    applies: Callable[[], Column]


def _dpd(low: int, high: int | None = None) -> Column:
    d = F.col("current_dpd")
    late = d > low if high is None else d.between(low, high)
    return (F.col("max_dpd_own") >= 1) & late


def _calm() -> Column:
    return F.col("max_dpd_own") == 0


def _technical() -> Column:
    return F.col("mandate_attribution") == "TECHNICAL"


def _broken_promise() -> Column:
    return F.col("any_ptp_made_then_missed")


def _stance(name: str) -> Column:
    return F.col("bt_recommended_stance") == name


LOAN_RULES = [
    Rule("OTS_SETTLE", BASIS_LAST_RESORT, lambda: _dpd(270)),
    Rule("RESTRUCT_MORAT", BASIS_MORATORIUM, lambda: _dpd(181, 270)),
    Rule("RESTRUCT_TENOR", BASIS_TENOR, lambda: _dpd(91, 180)),
    Rule("FIELD_VISIT", BASIS_VISIT,
         lambda: _dpd(61, 90) & (F.col("arrears_amount_inr") > 3 * F.col("emi_amount_inr"))),
    Rule("PART_PAY_PLAN", BASIS_SMA2, lambda: _dpd(61, 90)),
    Rule("FIX_MANDATE", BASIS_SMA1_MANDATE, lambda: _dpd(31, 60) & _technical()),
    Rule("FIELD_VISIT", BASIS_SMA1_BROKEN, lambda: _dpd(31, 60) & _broken_promise()),
    Rule("PART_PAY_PLAN", BASIS_SMA1, lambda: _dpd(31, 60)),
    Rule("FIX_MANDATE", BASIS_SMA0_MANDATE, lambda: _dpd(1, 30) & _technical()),
    Rule("PART_PAY_PLAN", BASIS_SMA0_BROKEN, lambda: _dpd(1, 30) & _broken_promise()),
    Rule("SOFT_REMIND", BASIS_SMA0, lambda: _dpd(1, 30)),
    Rule("NO_ACTION_REQUIRED", BASIS_ELSEWHERE, lambda: _dpd(0, 0)),
    Rule("FIX_MANDATE", BASIS_EARLY_MANDATE, lambda: _calm() & _technical()),
    Rule("BT_COUNTER", FROM_ECONOMICS, lambda: _calm() & _stance(STANCE_COUNTER)),
    Rule("BT_LET_GO", BASIS_LET_GO, lambda: _calm() & _stance(STANCE_LET_GO)),
    Rule("BT_LET_GO", FROM_ECONOMICS, lambda: _calm() & _stance(STANCE_NOT_RATIONAL)),
    Rule("NO_ACTION_REQUIRED", BASIS_NOTHING, lambda: F.lit(True)),
]

CANDIDATE_COLUMNS = [
    "borrower_id", "loan_id", "action_code", "rule_basis", "borrower_facing_message", "product_code",
    "current_dpd", "arrears_amount_inr", "outstanding_principal_inr", "emi_amount_inr",
    "bt_recommended_stance", "bt_net_value_if_offered_inr", "rate_gap_vs_bank_pct", "residual_months",
]


def latest_mandate(mandates: DataFrame) -> DataFrame:
    """Attribution of each loan's latest failure; mandates without one come last.

    An aggregate with map-side combining, not a window: a loan with very many mandates is
    reduced before it is shuffled.  The mandate id breaks ties.
    """
    recency = F.struct("last_failure_date", "mandate_id")
    return mandates.groupBy("loan_id").agg(
        F.max_by("failure_attribution", recency).alias("failure_attribution"),
        F.max_by("mandate_id", recency).alias("mandate_id"),
    )


def loan_context(scored: DataFrame, mandates: DataFrame, trajectory: DataFrame | None) -> DataFrame:
    """Scored loans with mandate and call signals; absent signals get their defaults."""
    mandate = latest_mandate(mandates).select("loan_id", "failure_attribution")
    # The economics view owns these two columns: a loan outside it shows neither.
    inside = F.col("has_economics")
    ctx = (
        scored.withColumn("rate_gap_vs_bank_pct", F.when(inside, F.col("rate_gap_vs_bank_pct")))
        .withColumn("residual_months", F.when(inside, F.col("residual_months")))
        .withColumn("max_dpd_own", F.col("borrower_max_dpd_own"))
        .join(merged(mandate), "loan_id", "left")
        .withColumn("mandate_attribution", F.coalesce("failure_attribution", F.lit("NONE")))
    )
    if trajectory is None:
        return ctx.withColumn("any_ptp_made_then_missed", F.lit(False))
    signal = trajectory.select("borrower_id", "any_ptp_made_then_missed")
    return ctx.join(merged(signal), "borrower_id", "left").withColumn(
        "any_ptp_made_then_missed", F.coalesce("any_ptp_made_then_missed", F.lit(False))
    )


def apply_rules(context: DataFrame, rules: list[Rule] = LOAN_RULES) -> DataFrame:
    """First matching rule per loan.  One CASE finds the rule number; action and basis are
    read from the rule table by that number."""
    numbered = context.withColumn("rule_no", pick([(r.applies(), i) for i, r in enumerate(rules)]))
    quoted = [i for i, r in enumerate(rules) if r.basis is FROM_ECONOMICS]
    # The customer message follows its own ladder: lateness outranks a failed mandate.
    message = pick(
        [
            (_dpd(1, 270), MESSAGE_HARDSHIP),
            (_dpd(270), MESSAGE_SETTLEMENT),
            (_calm() & _technical(), MESSAGE_MANDATE),
            (_calm() & _stance(STANCE_COUNTER), MESSAGE_COUNTER),
        ],
        F.lit(None).cast("string"),
    )
    return numbered.withColumns(
        {
            "action_code": nth([r.action for r in rules], "rule_no"),
            "rule_basis": F.when(F.col("rule_no").isin(*quoted), F.col("bt_rationale")).otherwise(
                nth([r.basis for r in rules], "rule_no")
            ),
            "borrower_facing_message": message,
        }
    )


def loan_rules(scored: DataFrame, mandates: DataFrame, trajectory: DataFrame | None) -> DataFrame:
    return apply_rules(loan_context(scored, mandates, trajectory)).select(*CANDIDATE_COLUMNS)


def growth_eligible(state: DataFrame) -> DataFrame:
    return state.filter(
        (F.col("max_dpd_own") == 0)
        & ~F.col("is_loan_stacked")
        & ~F.col("is_pre_delinquent_warning")
        & F.col("bureau_score_band").isin(*GROWTH_BANDS)
    )


def growth_rules(state: DataFrame) -> DataFrame:
    draw = bucket_sql(["borrower_id"], "growth_pick", len(GROWTH_ACTIONS))
    return growth_eligible(state).select(
        "borrower_id",
        nth(GROWTH_ACTIONS, draw).alias("action_code"),
        F.lit(BASIS_GROWTH).alias("rule_basis"),
        F.lit(MESSAGE_GROWTH).alias("borrower_facing_message"),
        F.col("total_outstanding_inr").alias("outstanding_principal_inr"),
    )


def nba_candidates(
    scored: DataFrame, state: DataFrame, mandates: DataFrame, trajectory: DataFrame | None
) -> DataFrame:
    by_loan = loan_rules(scored, mandates, trajectory)
    return by_loan.unionByName(growth_rules(state), allowMissingColumns=True).select(*CANDIDATE_COLUMNS)


def expected_value(action, margin_bps, outstanding, net_value) -> Column:
    action = F.col(action)
    cents = (F.col(margin_bps) * 100).cast("bigint")
    earned = whole_ratio(cents * F.coalesce(F.col(outstanding), F.lit(0)), 1000000)
    return pick(
        [
            (action == "BT_COUNTER", F.col(net_value)),
            (action.isin("BT_LET_GO", "NO_ACTION_REQUIRED"), F.lit(0).cast("bigint")),
        ],
        earned,
    )


def inputs_snapshot() -> Column:
    """The figures a rule saw, as JSON without absent fields."""
    return F.to_json(
        F.struct(
            "current_dpd",
            "arrears_amount_inr",
            "rate_gap_vs_bank_pct",
            "residual_months",
            F.col("bt_recommended_stance").alias("bt_stance"),
            "product_code",
        )
    )


def recommendation_id(borrower="borrower_id", loan="loan_id", action="action_code") -> Column:
    """Same borrower, loan and action, same id, in every rebuild."""
    return F.md5(F.concat_ws("|", F.col(borrower), F.coalesce(F.col(loan), F.lit("")), F.col(action)))


RECOMMENDATION_COLUMNS = [
    "recommendation_id", "borrower_id", "loan_id", "action_code", "action_family", "rule_basis",
    "model_contribution", "borrower_facing_message", "margin_impact_bps", "expected_value_inr",
    "bureau_disclosure", "requires_human_approval", "status", "created_at",
]
LOG_COLUMNS = [
    "log_id", "recommendation_id", "rule_fired", "model_used", "prompt_version", "confidence",
    "inputs_snapshot", "human_decision", "decided_by", "decided_at", "logged_at",
]


def stage_recommendations(spark: SparkSession, candidates: DataFrame, p: Params) -> DataFrame:
    actions = action_table(spark, p).select(
        "action_code", "action_family", "margin_impact_bps",
        F.col("mandatory_disclosure").alias("bureau_disclosure"), "requires_human_approval",
    )
    return candidates.join(actions, "action_code").withColumns(
        {
            "recommendation_id": recommendation_id(),
            "model_contribution": F.lit("NONE"),
            "expected_value_inr": expected_value(
                "action_code", "margin_impact_bps", "outstanding_principal_inr", "bt_net_value_if_offered_inr"
            ),
            "status": F.lit("PENDING_APPROVAL"),
            "inputs_snapshot": inputs_snapshot(),
            "created_at": moment(p.run_at),
        }
    )


def decision_log(staged: DataFrame) -> DataFrame:
    """One open log row per recommendation, written when the recommendation is made."""
    return staged.select(
        F.md5(F.concat(F.lit("log|"), F.col("recommendation_id"))).alias("log_id"),
        "recommendation_id",
        F.col("rule_basis").alias("rule_fired"),
        F.lit(None).cast("string").alias("model_used"),
        F.lit(None).cast("string").alias("prompt_version"),
        F.lit(1).cast("decimal(4,3)").alias("confidence"),
        "inputs_snapshot",
        F.lit("PENDING").alias("human_decision"),
        F.lit(None).cast("string").alias("decided_by"),
        F.lit(None).cast("timestamp_ntz").alias("decided_at"),
        F.col("created_at").alias("logged_at"),
    )


def nba_recommendations(spark: SparkSession, candidates: DataFrame, p: Params) -> tuple[DataFrame, DataFrame]:
    staged = stage_recommendations(spark, candidates, p)
    return staged.select(*RECOMMENDATION_COLUMNS), decision_log(staged)
