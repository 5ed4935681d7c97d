"""Borrower-level roll-up and regulatory classification."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.config import DEMO_BORROWERS, Params
from ledgerloom.functions.columns import pick
from ledgerloom.functions.finance import share_of_income
from ledgerloom.sources.tables import merged


def asset_class(dpd) -> Column:
    dpd = F.col(dpd) if isinstance(dpd, str) else dpd
    return pick([(dpd > 90, "NPA"), (dpd > 60, "SMA-2"), (dpd > 30, "SMA-1"), (dpd >= 1, "SMA-0")], "STANDARD")


def own_book(loans: DataFrame) -> DataFrame:
    """The borrower's own loans in one pass; counts the still-performing ones as well,
    which saves a second aggregation for the loans dragged into NPA."""
    return (
        loans.filter("is_active")
        .groupBy("borrower_id")
        .agg(
            F.count("*").alias("own_loan_count"),
            F.count_distinct("product_code").alias("own_product_count"),
            F.sum("outstanding_principal_inr").alias("total_outstanding_inr"),
            F.sum("arrears_amount_inr").alias("total_arrears_inr"),
            F.sum("emi_amount_inr").alias("own_emi_inr"),
            F.max("current_dpd").alias("max_dpd_own"),
            F.min("residual_months").alias("min_residual_months"),
            F.max("residual_months").alias("max_residual_months"),
            F.max("rate_gap_vs_bank_pct").alias("max_rate_gap_vs_bank_pct"),
            F.count_if(F.col("current_dpd") < 90).alias("performing_loans"),
        )
    )


def external_book(tradelines: DataFrame) -> DataFrame:
    return (
        tradelines.filter((F.col("tradeline_status") == "ACTIVE") & ~F.col("borrower_id").isin(*DEMO_BORROWERS))
        .groupBy("borrower_id")
        .agg(
            F.count("*").alias("external_tradeline_count"),
            F.count_distinct("lender_name").alias("external_lender_count"),
            F.sum("current_balance_inr").alias("external_balance_inr"),
            F.sum("emi_amount_inr").alias("external_emi_inr"),
            F.max("current_dpd").alias("external_max_dpd"),
            F.count_if(F.col("lender_type") == "FINTECH").alias("fintech_tradelines"),
            F.count_if(F.col("lender_type") == "MFI").alias("mfi_tradelines"),
        )
    )


def mandate_failures(mandates: DataFrame) -> DataFrame:
    kind = F.col("failure_attribution")
    return mandates.groupBy("borrower_id").agg(
        F.count_if("is_early_warning").alias("early_warning_mandates"),
        F.count_if(kind == "TECHNICAL").alias("technical_mandate_failures"),
        F.count_if(kind == "CAPACITY").alias("capacity_mandate_failures"),
        F.count_if(kind == "INTENT").alias("intent_mandate_failures"),
    )


EXTERNAL_FIGURES = [
    "external_tradeline_count", "external_lender_count", "external_balance_inr", "external_emi_inr",
    "external_max_dpd", "fintech_tradelines", "mfi_tradelines",
]
MANDATE_FIGURES = [
    "early_warning_mandates", "technical_mandate_failures", "capacity_mandate_failures",
    "intent_mandate_failures",
]


def build_borrower_state(
    borrowers: DataFrame, loans: DataFrame, tradelines: DataFrame, mandates: DataFrame, p: Params
) -> DataFrame:
    """One row per borrower with a live loan.  Each input is aggregated to one row per
    borrower before the joins, so the joins meet unique keys only."""
    zeroed = {c: F.coalesce(F.col(c), F.lit(0).cast("bigint")) for c in EXTERNAL_FIGURES + MANDATE_FIGURES}
    npa = F.col("max_dpd_own") >= 90
    no_figure = F.lit(0).cast("bigint")
    return (
        borrowers.join(merged(own_book(loans)), "borrower_id")
        .join(merged(external_book(tradelines)), "borrower_id", "left")
        .join(merged(mandate_failures(mandates)), "borrower_id", "left")
        .withColumns(zeroed)
        .withColumn("total_lender_count", F.col("external_lender_count") + 1)
        .withColumn("total_emi_inr", F.col("own_emi_inr") + F.col("external_emi_inr"))
        .select(
            "borrower_id", "full_name", "city", "state", "city_tier", "primary_language", "occupation_type",
            "monthly_income_inr", "bureau_score", "bureau_score_band",
            "own_loan_count", "own_product_count", "total_outstanding_inr", "total_arrears_inr", "own_emi_inr",
            "max_dpd_own", "min_residual_months", "max_residual_months", "max_rate_gap_vs_bank_pct",
            asset_class("max_dpd_own").alias("borrower_asset_class"),
            npa.alias("is_npa"),
            (npa & (F.coalesce("total_arrears_inr", no_figure) == 0)).alias("npa_upgrade_eligible"),
            F.when(npa, F.col("total_arrears_inr")).otherwise(no_figure).alias("arrears_to_clear_for_upgrade_inr"),
            F.when(npa, F.col("performing_loans")).otherwise(no_figure).alias("performing_loans_dragged_to_npa"),
            "external_tradeline_count", "external_lender_count", "total_lender_count",
            (F.col("total_lender_count") >= F.lit(p.econ("loan_stacking_lender_threshold"))).alias("is_loan_stacked"),
            "external_balance_inr", "external_emi_inr", "external_max_dpd", "fintech_tradelines", "mfi_tradelines",
            "total_emi_inr",
            share_of_income("own_emi_inr", "monthly_income_inr").alias("foir_own_book_pct"),
            share_of_income("total_emi_inr", "monthly_income_inr").alias("foir_true_pct"),
            *MANDATE_FIGURES,
            ((F.col("early_warning_mandates") > 0) & (F.col("max_dpd_own") == 0)).alias("is_pre_delinquent_warning"),
            "is_demo_case", "demo_case_label",
        )
    )
