"""Portfolio, calibration and application reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerloom.config import (
    ASSET_CLASS_DEFINITIONS,
    GROSS_BENCHMARK_NOTE,
    Params,
    economic_table,
    product_table,
)
from ledgerloom.functions.columns import lookup
from ledgerloom.operators import search
from ledgerloom.sources.tables import merged


def product_bounds(spark: SparkSession, p: Params) -> DataFrame:
    """Cumulative weight interval of each product, in code order (one row per product)."""
    running = F.sum("count_weight_pct").over(W.orderBy("product_code").rowsBetween(W.unboundedPreceding, 0))
    return product_table(spark, p).select(
        "product_code",
        ((running - F.col("count_weight_pct")) * 1000).cast("bigint").alias("cum_lo"),
        (running * 1000).cast("bigint").alias("cum_hi"),
    )


def gnpa_blend(spark: SparkSession, loans: DataFrame, p: Params) -> DataFrame:
    """Target GNPA per product weighted by count and by value, beside the generated book.

    GNPA is a ratio of values, so the value weights are the regulatory view.  The realised
    columns come from the loans: one aggregate, joined to one row per product.
    """
    mid_ticket = (F.col("ticket_min_inr") + F.col("ticket_max_inr")).cast("decimal(18,0)") / F.lit(2)
    weight = F.col("count_weight_pct")
    base = product_table(spark, p).select(
        "product_code",
        "product_name",
        "count_weight_pct",
        mid_ticket.cast("decimal(18,1)").alias("avg_ticket_inr"),
        "target_gnpa_pct",
    ).withColumn("value_units", (weight * F.col("avg_ticket_inr")).cast("decimal(24,4)"))
    share = F.col("value_units").cast("double") / F.sum("value_units").over(W.partitionBy()).cast("double")
    late = F.col("current_dpd") >= 90
    book = loans.groupBy("product_code").agg(
        F.count("*").alias("book_loans"),
        F.sum("outstanding_principal_inr").alias("book_outstanding_inr"),
        F.sum(F.when(late, F.col("outstanding_principal_inr")).otherwise(0)).alias("book_npa_inr"),
    )
    return (
        base.withColumn("_share", share)
        .join(book, "product_code", "left")
        .select(
            "product_code",
            "product_name",
            "count_weight_pct",
            "avg_ticket_inr",
            F.round(F.col("_share") * 100, 3).alias("value_weight_pct"),
            "target_gnpa_pct",
            F.round(weight * F.col("target_gnpa_pct") / F.lit(100), 4).cast("decimal(12,4)").alias(
                "contrib_count_weighted_pct"
            ),
            F.round(F.col("_share") * F.col("target_gnpa_pct").cast("double"), 4)
            .cast("decimal(12,4)")
            .alias("contrib_value_weighted_pct"),
            F.coalesce("book_loans", F.lit(0)).cast("bigint").alias("book_loans"),
            F.coalesce("book_outstanding_inr", F.lit(0)).cast("bigint").alias("book_outstanding_inr"),
            F.coalesce("book_npa_inr", F.lit(0)).cast("bigint").alias("book_npa_inr"),
        )
    )


def gnpa_summary(blend: DataFrame, p: Params) -> DataFrame:
    return blend.agg(
        F.round(F.sum("contrib_value_weighted_pct"), 2).cast("decimal(12,2)").alias(
            "blended_gnpa_value_weighted_pct"
        ),
        F.round(F.sum("contrib_count_weighted_pct"), 2).cast("decimal(12,2)").alias(
            "blended_gnpa_count_weighted_pct"
        ),
        F.sum("book_npa_inr").alias("book_npa_inr"),
        F.sum("book_outstanding_inr").alias("book_outstanding_inr"),
    ).select(
        "blended_gnpa_value_weighted_pct",
        "blended_gnpa_count_weighted_pct",
        F.lit(p.econ("benchmark_system_gnpa_pct")).alias("system_benchmark_pct"),
        F.lit(GROSS_BENCHMARK_NOTE).alias("interpretation"),
        F.round(
            F.lit(100).cast("decimal(3,0)")
            * F.col("book_npa_inr").cast("decimal(20,0)")
            / F.nullif(F.col("book_outstanding_inr").cast("decimal(16,0)"), F.lit(0)),
            2,
        ).cast("decimal(12,2)").alias("book_gnpa_pct"),
    )


def delinquency_distribution(state: DataFrame, p: Params) -> DataFrame:
    counts = state.groupBy("borrower_asset_class").agg(F.count("*").alias("borrowers"))
    total = F.sum("borrowers").over(W.partitionBy())
    pct = F.lit(100).cast("decimal(3,0)") * F.col("borrowers").cast("decimal(18,0)") / total.cast("decimal(18,0)")
    return counts.select(
        "borrower_asset_class",
        "borrowers",
        F.round(pct, 2).cast("decimal(6,2)").alias("pct_of_borrowers"),
        lookup("borrower_asset_class", ASSET_CLASS_DEFINITIONS).alias("rbi_definition"),
        F.lit(p.econ("benchmark_retail_par_31_180_pct")).alias("benchmark_par_31_180_pct"),
        F.lit(p.econ("benchmark_system_gnpa_pct")).alias("benchmark_system_gnpa_pct"),
    )


def config_pivot(spark: SparkSession, p: Params) -> DataFrame:
    """The key/value parameters the margin needs, as one row."""
    keys = ["bt_min_rate_gap_pct", "cost_of_funds_blended_pct"]
    return (
        economic_table(spark, p)
        .filter(F.col("param_key").isin(*keys))
        .groupBy()
        .pivot("param_key", keys)
        .agg(F.first("param_value"))
    )


# --- application queries over the 360 table and the recommendations ------------------
def asset_class_counts(c360: DataFrame) -> DataFrame:
    return c360.groupBy("borrower_asset_class").agg(F.count("*").alias("n"))


def portfolio_kpis(c360: DataFrame) -> DataFrame:
    return c360.agg(
        F.count_if("bt_is_a_flight_risk").alias("flight_risks"),
        F.count_if("has_retention_offer").alias("retention_offers"),
        F.sum("bt_retention_value_if_offered_inr").alias("total_retention_value_inr"),
        F.sum("ltv_expected_interest_inr").alias("total_ltv_inr"),
    )


def flight_risk_topk(c360: DataFrame, k: int = 20) -> DataFrame:
    return (
        c360.filter("bt_is_a_flight_risk")
        .select("borrower_id", "full_name", "ltv_expected_interest_inr", "bt_risk_score")
        .orderBy(F.desc_nulls_last("ltv_expected_interest_inr"), "borrower_id")
        .limit(k)
    )


LOOKUP_COLUMNS = [
    "borrower_id", "full_name", "city", "borrower_asset_class", "bt_risk_score", "bt_is_a_flight_risk",
    "ltv_expected_interest_inr", "overall_sentiment_direction", "any_ptp_made_then_missed",
    "n_pending_recommendations",
]


def borrower_lookup(c360: DataFrame, text: str, limit: int = 25) -> DataFrame:
    """Borrowers whose id or name contains the text, any letter case."""
    return c360.filter(search.contains(text)).select(*LOOKUP_COLUMNS).orderBy("borrower_id").limit(limit)


def borrower_search(c360: DataFrame, grams: DataFrame, counts: DataFrame, text: str, limit: int = 25) -> DataFrame:
    """The same through posting lists: only the rows of candidates are read."""
    return borrower_lookup(search.candidates(c360, grams, counts, text), text, limit)


def borrower_detail(spark: SparkSession, c360: DataFrame, borrower_id: str) -> DataFrame:
    return spark.sql("SELECT * FROM {c360} WHERE borrower_id = :id", args={"id": borrower_id}, c360=c360)


def borrower_pending(recs: DataFrame, borrower_id: str) -> DataFrame:
    return recs.filter((F.col("borrower_id") == borrower_id) & (F.col("status") == "PENDING_APPROVAL")).select(
        "recommendation_id", "action_code", "action_family", "rule_basis", "expected_value_inr",
        "bureau_disclosure", "status",
    )


def borrower_history(recs: DataFrame, borrower_id: str) -> DataFrame:
    return (
        recs.filter(F.col("borrower_id") == borrower_id)
        .orderBy(F.desc("created_at"), "recommendation_id")
        .select("action_code", "rule_basis", "model_contribution", "expected_value_inr", "status")
    )


def borrower_calls(calls: DataFrame, borrower_id: str) -> DataFrame:
    return (
        calls.filter(F.col("borrower_id") == borrower_id)
        .select("transcript_sequence_number", "contact_date", "transcript_text")
        .orderBy("transcript_sequence_number")
    )


def first_call(calls: DataFrame) -> DataFrame:
    """Text of every borrower's first call, in one pass instead of a query per borrower."""
    return calls.groupBy("borrower_id").agg(
        F.min_by("transcript_text", "transcript_sequence_number").alias("first_call_text")
    )


def action_queue(recs: DataFrame, family: str | None = None, k: int = 200) -> DataFrame:
    pending = recs.filter(F.col("status") == "PENDING_APPROVAL")
    if family is not None:
        pending = pending.filter(F.col("action_family") == family)
    return (
        pending.select(
            "recommendation_id", "borrower_id", "action_code", "action_family", "expected_value_inr", "rule_basis"
        )
        .orderBy(F.desc_nulls_last("expected_value_inr"), "recommendation_id")
        .limit(k)
    )


def demo_contrast(c360: DataFrame) -> DataFrame:
    return (
        c360.filter("is_demo_case")
        .select(
            "borrower_id", "full_name", "borrower_asset_class", "bt_risk_score", "bt_is_a_flight_risk",
            "ltv_expected_interest_inr", "has_retention_offer", "demo_case_label",
        )
        .orderBy("borrower_id")
    )


def deteriorating(c360: DataFrame) -> DataFrame:
    return c360.filter(F.col("overall_sentiment_direction") == "DETERIORATING").select(
        "borrower_id", "full_name", "overall_sentiment_direction", "any_ptp_made_then_missed"
    )


def pending_collections(recs: DataFrame) -> DataFrame:
    return recs.filter(
        (F.col("status") == "PENDING_APPROVAL") & (F.col("action_family") == "COLLECTIONS")
    ).select("borrower_id", "action_code", "rule_basis", "expected_value_inr")


def npa_upgrade_count(c360: DataFrame) -> DataFrame:
    return c360.filter(F.col("is_npa") & F.col("npa_upgrade_eligible")).agg(F.count("*").alias("n"))


def cross_entity(recs: DataFrame, c360: DataFrame) -> DataFrame:
    """Recommendations with their borrower's row, as the declared relationship joins them."""
    who = c360.select("borrower_id", "full_name", "borrower_asset_class", "bt_risk_score", "ltv_expected_interest_inr")
    return recs.select("recommendation_id", "borrower_id", "action_code", "action_family", "status").join(
        merged(who), "borrower_id", "left"
    )
