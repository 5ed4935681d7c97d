"""The unified row per borrower."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.economics import bt_summary
from ledgerloom.sources.tables import merged

STATE_COLUMNS = [
    "borrower_id", "full_name", "city", "state", "city_tier", "occupation_type", "monthly_income_inr",
    "bureau_score", "bureau_score_band", "own_loan_count", "own_product_count", "total_outstanding_inr",
    "total_arrears_inr", "borrower_asset_class", "is_npa", "npa_upgrade_eligible",
    "arrears_to_clear_for_upgrade_inr", "performing_loans_dragged_to_npa", "is_loan_stacked",
    "total_lender_count", "foir_true_pct", "early_warning_mandates",
]
CALL_COLUMNS = [
    "n_interactions", "overall_sentiment_direction", "any_ptp_made_then_missed", "any_reason_change",
    "days_gap_trend",
]


def nba_summary(recs: DataFrame) -> DataFrame:
    """Pending recommendations per borrower."""
    family = F.col("action_family")
    return (
        recs.filter(F.col("status") == "PENDING_APPROVAL")
        .groupBy("borrower_id")
        .agg(
            F.count("*").alias("n_pending_recommendations"),
            F.count_distinct("action_family").alias("n_action_families"),
            F.bool_or(family == "COLLECTIONS").alias("has_collections_action"),
            F.bool_or((family == "RETENTION") & (F.col("action_code") == "BT_COUNTER")).alias("has_retention_offer"),
            F.bool_or(family == "GROWTH").alias("has_growth_offer"),
        )
    )


def customer_360(
    state: DataFrame, scored: DataFrame, ltv: DataFrame, trajectory: DataFrame, recs: DataFrame
) -> DataFrame:
    """State with lifetime value, BT position, call trajectory and pending actions.

    Every joined table already holds one row per borrower, so each join is one-to-one.
    """
    calls = trajectory.withColumnRenamed("n_calls", "n_interactions").select("borrower_id", *CALL_COLUMNS)
    pending = nba_summary(recs).drop("n_action_families")
    no, zero = F.lit(False), F.lit(0)
    return (
        state.join(merged(ltv), "borrower_id", "left")
        .join(merged(bt_summary(scored)), "borrower_id", "left")
        .join(merged(calls), "borrower_id", "left")
        .join(merged(pending), "borrower_id", "left")
        .select(
            *STATE_COLUMNS,
            F.coalesce("max_bt_risk_score", zero).cast("decimal(6,1)").alias("bt_risk_score"),
            F.coalesce("any_bt_rational", no).alias("bt_is_a_flight_risk"),
            F.coalesce("total_bt_counter_value_if_offered_inr", zero).cast("bigint").alias(
                "bt_retention_value_if_offered_inr"
            ),
            F.coalesce("ltv_expected_interest_inr", zero).cast("decimal(18,2)").alias("ltv_expected_interest_inr"),
            *CALL_COLUMNS,
            F.coalesce("n_pending_recommendations", zero).cast("bigint").alias("n_pending_recommendations"),
            F.coalesce("has_collections_action", no).alias("has_collections_action"),
            F.coalesce("has_retention_offer", no).alias("has_retention_offer"),
            F.coalesce("has_growth_offer", no).alias("has_growth_offer"),
            "is_demo_case",
            "demo_case_label",
        )
    )
