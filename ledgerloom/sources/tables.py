"""Base tables with declared schemas; nothing is inferred."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

BASE_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "events": (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    ),
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}

# Entity tables as a caller with own data would hand them in.
ENTITY_SCHEMAS = {
    "borrower": (
        "borrower_id string, full_name string, gender string, date_of_birth date, age bigint, "
        "occupation_type string, monthly_income_inr bigint, city string, state string, region string, "
        "city_tier bigint, pincode string, primary_language string, pan_masked string, "
        "aadhaar_linked boolean, kyc_status string, bureau_score bigint, bureau_score_band string, "
        "onboard_date date, is_demo_case boolean, demo_case_label string"
    ),
    "bureau_tradeline": (
        "tradeline_id string, borrower_id string, lender_name string, lender_type string, "
        "product_type string, is_own_book boolean, sanctioned_amount_inr bigint, roi_pct decimal(27,2), "
        "tenor_months bigint, opened_date date, current_balance_inr bigint, emi_amount_inr bigint, "
        "current_dpd bigint, tradeline_status string, last_reported_date date"
    ),
    "loan_account": (
        "loan_id string, borrower_id string, product_code string, product_name string, is_secured boolean, "
        "sanction_amount_inr bigint, disbursed_amount_inr bigint, roi_pct decimal(7,3), "
        "bank_benchmark_roi_pct decimal(6,3), rate_gap_vs_bank_pct decimal(8,3), rate_type string, "
        "is_repo_linked boolean, tenor_months bigint, emi_amount_inr bigint, disbursal_date date, "
        "maturity_date date, months_elapsed bigint, residual_months bigint, outstanding_principal_inr bigint, "
        "current_dpd bigint, unpaid_emi_count bigint, arrears_amount_inr bigint, sourcing_channel string, "
        "has_nach_mandate boolean, is_active boolean"
    ),
    "mandate": (
        "mandate_id string, loan_id string, borrower_id string, mandate_type string, sponsor_bank string, "
        "registration_date date, mandate_status string, last_failure_reason string, last_failure_date date, "
        "consecutive_failures bigint, failure_attribution string, is_early_warning boolean"
    ),
    "repayment_schedule": (
        "schedule_id string, loan_id string, borrower_id string, installment_number bigint, due_date date, "
        "due_amount_inr double, interest_component_inr double, principal_component_inr double, "
        "opening_balance_inr double, closing_balance_inr double"
    ),
    "call_transcript": (
        "interaction_id string, borrower_id string, loan_id string, channel string, "
        "transcript_sequence_number bigint, total_sequence_length bigint, contact_date date, "
        "days_since_previous_contact bigint, transcript_text string, is_truncated boolean, "
        "created_at timestamp_ntz, is_stub boolean"
    ),
}


def read_base(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(BASE_SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def read_entity(spark: SparkSession, path: str, name: str) -> DataFrame:
    return spark.read.schema(ENTITY_SCHEMAS[name]).parquet(path)


def conformed(df: DataFrame, name: str) -> DataFrame:
    """A caller's table with the declared columns and types of an entity; a missing column is NULL,
    a type that cannot be widened is refused."""
    return df.to(StructType.fromDDL(ENTITY_SCHEMAS[name]))


def merged(df: DataFrame) -> DataFrame:
    """A side of a join that grows with the input: both sides are sorted and merged in the tasks.

    The optimiser judges a few columns of a wide, compressed table by their share of its bytes, so ids and
    hashes that compress badly look small and would be sent whole through the driver.
    """
    return df.hint("merge")


def listing(spark: SparkSession, folder: str) -> str:
    """A digest of the files below a folder: names, sizes and times of change."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listFiles(path, True)
    base, files = path.toUri().getPath(), []
    while found.hasNext():
        f = found.next()
        files.append((f.getPath().toUri().getPath().removeprefix(base), f.getLen(), f.getModificationTime()))
    return hashlib.md5(repr(sorted(files)).encode()).hexdigest()


def write_manifest(spark: SparkSession, folder: str, facts: dict[str, str]) -> None:
    """The last thing written to a published folder."""
    rows = spark.createDataFrame(sorted(facts.items()), "name string, value string")
    rows.coalesce(1).write.mode("overwrite").parquet(f"{folder}/manifest")


def read_manifest(spark: SparkSession, folder: str) -> dict[str, str]:
    rows = spark.read.schema("name string, value string").parquet(f"{folder}/manifest")
    return {r["name"]: r["value"] for r in rows.collect()}


def write_version(df: DataFrame, base: str, version: int) -> str:
    """Write one whole generation of a table; repeating a version replaces it."""
    path = f"{base}/version={version}"
    df.write.mode("overwrite").parquet(path)
    return path


def append_missing(df: DataFrame, existing: DataFrame | None, keys: list[str], path: str) -> None:
    """Append only rows whose key is not stored yet, so a repeated append adds nothing."""
    fresh = df if existing is None else df.join(existing.select(*keys), keys, "left_anti")
    fresh.write.mode("append").parquet(path)
