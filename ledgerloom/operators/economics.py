"""Per-loan margin and balance-transfer (BT) risk.

BT risk is forced to zero for any borrower with an instalment overdue, whatever the
rate gap: no rival lender refinances a delinquent borrower.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.config import Params, bt_threshold_table, product_table
from ledgerloom.functions.columns import pick, strict_greatest, strict_least, whole_ratio
from ledgerloom.sources.tables import merged

# --- fixed values: stances and explanation texts -------------------------------
STANCE_DISTRESS = "ZERO_CREDIT_DISTRESS"
STANCE_NO_SIGNAL = "NO_SIGNAL"
STANCE_NOT_RATIONAL = "SIGNAL_BUT_NOT_RATIONAL"
STANCE_COUNTER = "COUNTER_OFFER_JUSTIFIED"
STANCE_LET_GO = "LET_GO_RETENTION_UNPROFITABLE"
TEXT_DISTRESS = (
    "RULE: borrower is in credit distress (own-book DPD >= 1, asset class {borrower_asset_class}). "
    "Credit risk and balance-transfer risk are separate; no rival refinances a delinquent borrower, "
    "so BT risk is forced to zero regardless of rate gap or residual tenor."
)
TEXT_NO_INCENTIVE = "Rate gap below the {bt_min_gap}pp threshold. No transfer incentive exists."
TEXT_NOT_RATIONAL = (
    "Rate gap of {rate_gap_vs_bank_pct}pp exists, but residual tenor of {residual_months} months is below "
    "the {bt_min_residual}-month threshold for {product_code} ({switching_cost_assumption}). Interest saved "
    "cannot cover switching costs - not a genuine flight risk."
)
TEXT_RATIONAL = (
    "Rate gap of {rate_gap_vs_bank_pct}pp with {residual_months} months residual, above the "
    "{bt_min_residual}-month {product_code} threshold - transfer is economically rational."
)

ECONOMICS_COLUMNS = [
    "loan_id", "borrower_id", "product_code", "is_secured", "sanction_amount_inr",
    "outstanding_principal_inr", "emi_amount_inr", "roi_pct", "bank_benchmark_roi_pct",
    "rate_gap_vs_bank_pct", "rate_type", "is_repo_linked", "cost_of_funds_pct", "gross_spread_pct",
    "nim_pct", "tenor_months", "months_elapsed", "residual_months", "current_dpd", "arrears_amount_inr",
    "bt_min_residual", "switching_cost_assumption", "borrower_max_dpd_own", "borrower_asset_class",
    "retained_nim_value_inr", "bt_risk_score", "bt_is_economically_rational", "bt_reduction_needed_pct",
    "bt_offer_cost_inr", "bt_net_value_if_offered_inr", "bt_recommended_stance", "bt_rationale",
]


def fill(template: str) -> Column:
    """Template with ``{column}`` marks as one concat; a NULL part makes the whole NULL."""
    parts: list[Column] = []
    for i, piece in enumerate(template.replace("}", "{").split("{")):
        if piece:
            parts.append(F.col(piece).cast("string") if i % 2 else F.lit(piece))
    return F.concat(*parts)


def with_configuration(spark: SparkSession, loans: DataFrame, p: Params) -> DataFrame:
    """Loans with their product and threshold rows; a loan without either keeps NULLs."""
    products = product_table(spark, p).select("product_code", "target_gnpa_pct")
    thresholds = bt_threshold_table(spark, p)
    return loans.join(products, "product_code", "left").join(thresholds, "product_code", "left")


def score_loans(spark: SparkSession, loans: DataFrame, state: DataFrame, p: Params) -> DataFrame:
    """Every live loan with its economics, or with NULL economics where its product has no
    configuration.  The rules read this directly, so loans are not joined to themselves."""
    risk = state.select("borrower_id", F.col("max_dpd_own").alias("borrower_max_dpd_own"), "borrower_asset_class")
    base = with_configuration(spark, loans.filter("is_active"), p).join(merged(risk), "borrower_id")
    cof, min_gap = p.econ("cost_of_funds_blended_pct"), p.econ("bt_min_rate_gap_pct")
    cap_months = p.econ_int("bt_comfortable_residual_months")
    cap_gap = int(p.score_gap_cap_pct * 1000)

    configured = F.col("target_gnpa_pct").isNotNull() & F.col("bt_min_residual").isNotNull()
    distressed = F.col("borrower_max_dpd_own") >= 1
    gap, residual, left = F.col("rate_gap_vs_bank_pct"), F.col("residual_months"), F.col("outstanding_principal_inr")
    calm_gap = (F.col("borrower_max_dpd_own") == 0) & (gap >= F.lit(min_gap))

    # Whole-number forms of the percentages keep every rounding exact.
    nim_milli = (F.col("nim_pct") * 1000).cast("bigint")
    cut_e4 = (F.col("_cut_pct") * 10000).cast("bigint")
    gap_milli = (gap * 1000).cast("bigint")
    value_at_risk = left * cut_e4 * residual
    net = F.col("retained_nim_value_inr") * 12000000 - value_at_risk

    figures = (
        base.withColumn("bt_min_gap", F.lit(min_gap))
        .withColumn("cost_of_funds_pct", F.lit(cof))
        .withColumn("gross_spread_pct", F.round(F.col("roi_pct") - F.lit(cof), 3).cast("decimal(8,3)"))
        .withColumn(
            "nim_pct",
            F.round(
                F.col("roi_pct") - F.lit(cof) - F.col("target_gnpa_pct") * F.lit(p.loss_share) - F.lit(p.opex_pct), 3
            ).cast("decimal(8,3)"),
        )
        .withColumn("retained_nim_value_inr", whole_ratio(left * nim_milli * residual, 1200000))
        .withColumn("_has_incentive", calm_gap)
        .withColumn("bt_is_economically_rational", calm_gap & (residual >= F.col("bt_min_residual")))
        .withColumn(
            "_cut_pct",
            F.when(distressed, F.lit(0))
            .otherwise(strict_greatest(gap - F.lit(min_gap), F.lit(0)))
            .cast("decimal(12,4)"),
        )
        .withColumn("bt_reduction_needed_pct", F.round("_cut_pct", 3).cast("decimal(12,3)"))
        .withColumn("bt_offer_cost_inr", whole_ratio(value_at_risk, 12000000))
        .withColumn("bt_net_value_if_offered_inr", whole_ratio(net, 12000000))
    )
    no_bt = distressed | ~F.col("_has_incentive") | ~F.col("bt_is_economically_rational")
    # gap/5 (at most 1) times residual/84 (at most 1) times 100, in tenths.
    tenths = whole_ratio(
        strict_least(gap_milli, F.lit(cap_gap)) * strict_least(residual, F.lit(cap_months)) * 1000, cap_gap * cap_months
    )
    rational_or_not = [
        (distressed, STANCE_DISTRESS, TEXT_DISTRESS),
        (~F.col("_has_incentive"), STANCE_NO_SIGNAL, TEXT_NO_INCENTIVE),
        (~F.col("bt_is_economically_rational"), STANCE_NOT_RATIONAL, TEXT_NOT_RATIONAL),
    ]
    scored = figures.withColumns(
        {
            "bt_risk_score": F.when(no_bt, F.lit(0)).otherwise(tenths / F.lit(10)).cast("decimal(6,1)"),
            "bt_recommended_stance": pick(
                [(c, s) for c, s, _ in rational_or_not] + [(net > 0, STANCE_COUNTER)], STANCE_LET_GO
            ),
            "bt_rationale": pick([(c, fill(t)) for c, _, t in rational_or_not], fill(TEXT_RATIONAL)),
        }
    )
    computed = [
        "cost_of_funds_pct", "gross_spread_pct", "nim_pct", "retained_nim_value_inr", "bt_risk_score",
        "bt_is_economically_rational", "bt_reduction_needed_pct", "bt_offer_cost_inr",
        "bt_net_value_if_offered_inr", "bt_recommended_stance", "bt_rationale", "_has_incentive",
    ]
    return scored.withColumn("has_economics", configured).withColumns(
        {c: F.when(configured, F.col(c)) for c in computed}
    )


def loan_economics(scored: DataFrame) -> DataFrame:
    """The published view: live loans whose product is configured."""
    return scored.filter("has_economics").select(*ECONOMICS_COLUMNS)


def bt_summary(scored: DataFrame) -> DataFrame:
    """BT position per borrower."""
    countered = F.col("bt_recommended_stance") == STANCE_COUNTER
    return (
        scored.filter("has_economics")
        .groupBy("borrower_id")
        .agg(
            F.max("bt_risk_score").alias("max_bt_risk_score"),
            F.bool_or("bt_is_economically_rational").alias("any_bt_rational"),
            F.sum(F.when(countered, F.col("bt_net_value_if_offered_inr")).otherwise(0)).alias(
                "total_bt_counter_value_if_offered_inr"
            ),
        )
    )
