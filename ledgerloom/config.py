"""Fixed business values and run parameters.

Everything an operator needs that is not row data comes in through ``Params``:
the reporting date, regulatory and economic constants, product calibration,
the action catalogue and the credit rates.  Nothing reads the wall clock.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field
from decimal import Decimal as D

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.functions import broadcast

# --- fixed values: economic and regulatory constants ------------------------
ECONOMIC_COLUMNS = "param_key string, param_value decimal(14,4), unit string, source_status string"
ECONOMIC_ROWS = [
    ("repo_rate_pct", D("5.2500"), "pct", "SOURCED"),
    ("cost_of_funds_blended_pct", D("9.0000"), "pct", "STATED_ASSUMPTION"),
    ("opex_cost_per_collection_call_inr", D("45.0000"), "INR", "STATED_ASSUMPTION"),
    ("opex_cost_per_field_visit_inr", D("350.0000"), "INR", "STATED_ASSUMPTION"),
    ("opex_cost_per_sms_inr", D("0.2500"), "INR", "STATED_ASSUMPTION"),
    ("dpd_sma0_min", D("1.0000"), "days", "SOURCED"),
    ("dpd_sma0_max", D("30.0000"), "days", "SOURCED"),
    ("dpd_sma1_min", D("31.0000"), "days", "SOURCED"),
    ("dpd_sma1_max", D("60.0000"), "days", "SOURCED"),
    ("dpd_sma2_min", D("61.0000"), "days", "SOURCED"),
    ("dpd_sma2_max", D("90.0000"), "days", "SOURCED"),
    ("dpd_npa_threshold", D("90.0000"), "days", "SOURCED"),
    ("npa_upgrade_requires_full_arrears", D("1.0000"), "boolean", "SOURCED"),
    ("bt_min_rate_gap_pct", D("0.5000"), "pct", "SOURCED"),
    ("bt_min_residual_months", D("60.0000"), "months", "SOURCED"),
    ("bt_comfortable_residual_months", D("84.0000"), "months", "SOURCED"),
    ("max_within_lender_score_spread_pct", D("1.5000"), "pct", "SOURCED"),
    ("fpc_call_window_start_hour", D("8.0000"), "hour", "SOURCED"),
    ("fpc_call_window_end_hour", D("19.0000"), "hour", "SOURCED"),
    ("loan_stacking_lender_threshold", D("5.0000"), "lenders", "SOURCED"),
    ("bureau_reporting_frequency_days", D("7.0000"), "days", "SOURCED"),
    ("benchmark_system_gnpa_pct", D("1.8000"), "pct", "SOURCED"),
    ("benchmark_retail_secured_gnpa_pct", D("0.7000"), "pct", "SOURCED"),
    ("benchmark_retail_unsecured_gnpa_pct", D("1.7000"), "pct", "SOURCED"),
    ("benchmark_retail_par_31_180_pct", D("2.9000"), "pct", "SOURCED"),
    ("benchmark_small_ticket_pl_delinq_pct", D("6.4000"), "pct", "SOURCED"),
    ("gen_seed", D("20260821.0000"), "seed", "DERIVED"),
    ("gen_borrower_count", D("5000.0000"), "count", "DERIVED"),
    ("gen_observation_months", D("18.0000"), "months", "DERIVED"),
]

# --- fixed values: product calibration --------------------------------------
# LAP and the narrowed weights of PL and MSME are our seeds; the weights must
# add up to 100 or the last product in code order loses its tail.
PRODUCT_COLUMNS = (
    "product_code string, product_name string, is_secured boolean, count_weight_pct decimal(6,3), "
    "ticket_min_inr bigint, ticket_max_inr bigint, tenor_min_months bigint, tenor_max_months bigint, "
    "base_roi_pct decimal(6,3), bank_benchmark_roi_pct decimal(6,3), target_gnpa_pct decimal(6,3), "
    "nach_mandate_share_pct decimal(6,3), source_status string"
)
PRODUCT_ROWS = [
    ("TW", "Two-wheeler loan", True, D("40.000"), 45000, 140000, 12, 36,
     D("14.500"), D("11.000"), D("2.500"), D("85.000"), "STATED_ASSUMPTION"),
    ("CD", "Consumer durable loan", False, D("25.000"), 15000, 90000, 6, 24,
     D("17.500"), D("13.000"), D("3.500"), D("90.000"), "STATED_ASSUMPTION"),
    ("PL", "Personal loan (small ticket)", False, D("18.000"), 50000, 150000, 12, 60,
     D("18.500"), D("12.500"), D("6.400"), D("80.000"), "SOURCED"),
    ("MSME", "MSME business loan", False, D("12.000"), 200000, 2500000, 12, 60,
     D("16.000"), D("11.500"), D("2.800"), D("70.000"), "STATED_ASSUMPTION"),
    ("LAP", "Loan against property", True, D("5.000"), 500000, 2500000, 60, 120,
     D("12.000"), D("11.000"), D("1.000"), D("75.000"), "STATED_ASSUMPTION"),
]

# --- fixed values: least residual tenor for a rational balance transfer ------
BT_THRESHOLD_COLUMNS = (
    "product_code string, bt_min_residual bigint, switching_cost_assumption string"
)
BT_THRESHOLD_ROWS = [
    ("LAP", 60, "legal, valuation and re-registration charges"),
    ("MSME", 30, "processing fee and collateral re-documentation"),
    ("PL", 18, "processing fee and foreclosure charge"),
    ("TW", 12, "hypothecation change and foreclosure charge"),
    ("CD", 12, "foreclosure charge"),
]

# --- fixed values: action catalogue (margins and costs are our seeds) --------
ACTION_COLUMNS = (
    "action_code string, action_name string, action_family string, "
    "bureau_reporting_impact string, margin_impact_bps decimal(8,2), opex_cost_inr decimal(10,2), "
    "requires_human_approval boolean, is_last_resort boolean, mandatory_disclosure string"
)
_SETTLED = "A settlement is reported to credit bureaus as settled and stays visible to other lenders."
_RESTRUCTURED = "A restructured account is reported to credit bureaus as restructured."
ACTION_ROWS = [
    ("SOFT_REMIND", "Soft reminder", "COLLECTIONS", "NONE", D("5.00"), D("0.25"), True, False, None),
    ("PART_PAY_PLAN", "Part payment plan", "COLLECTIONS", "NONE", D("40.00"), D("45.00"), True, False, None),
    ("FIELD_VISIT", "Field visit", "COLLECTIONS", "NONE", D("60.00"), D("350.00"), True, False, None),
    ("RESTRUCT_TENOR", "Tenor restructuring", "COLLECTIONS", "RESTRUCTURED", D("-75.00"), D("450.00"),
     True, False, _RESTRUCTURED),
    ("RESTRUCT_MORAT", "Moratorium restructuring", "COLLECTIONS", "RESTRUCTURED", D("-120.00"), D("450.00"),
     True, False, _RESTRUCTURED),
    ("OTS_SETTLE", "One-time settlement", "COLLECTIONS", "SETTLED", D("-2500.00"), D("900.00"),
     True, True, _SETTLED),
    ("EMI_REDUCE", "Instalment reduction", "COLLECTIONS", "RESTRUCTURED", D("-90.00"), D("450.00"),
     True, False, _RESTRUCTURED),
    ("BT_COUNTER", "Balance-transfer counter offer", "RETENTION", "NONE", D("-100.00"), D("45.00"),
     True, False, None),
    ("BT_LET_GO", "Let the transfer go", "RETENTION", "NONE", D("0.00"), D("0.00"), True, False, None),
    ("TOP_UP", "Top-up loan", "GROWTH", "NONE", D("150.00"), D("45.00"), True, False, None),
    ("CROSS_INSURE", "Insurance cross-sell", "GROWTH", "NONE", D("60.00"), D("45.00"), True, False, None),
    ("LIMIT_UP", "Limit enhancement", "GROWTH", "NONE", D("110.00"), D("45.00"), True, False, None),
    ("FIX_MANDATE", "Repair the debit mandate", "SERVICE", "NONE", D("20.00"), D("45.00"), True, False, None),
    ("NO_ACTION_REQUIRED", "No action", "MONITOR", "NONE", D("0.00"), D("0.00"), False, False, None),
]
DISCLOSED_ACTIONS = ("OTS_SETTLE", "RESTRUCT_TENOR", "RESTRUCT_MORAT", "EMI_REDUCE")

# --- fixed values: owning team per action family ----------------------------
TEAM_BY_FAMILY = {
    "COLLECTIONS": "Collections Team",
    "RETENTION": "Retention Desk",
    "GROWTH": "Relationship & Growth Team",
    "SERVICE": "Servicing Operations",
}
TEAM_OTHERWISE = "General Queue"

# --- fixed values: price of one credit per metered service -------------------
RATE_COLUMNS = "service_type string, usd_per_credit decimal(6,2), rate_note string"
RATE_ROWS = [
    ("WAREHOUSE_METERING", D("3.60"), "Platform credit - XSMALL warehouse compute"),
    ("CLOUD_SERVICES", D("3.60"), "Platform credit - cloud services layer"),
    ("PIPE", D("3.60"), "Platform credit - serverless pipe"),
    ("TELEMETRY_DATA_INGEST", D("3.60"), "Platform credit - telemetry"),
    ("AI_FUNCTIONS", D("2.20"), "AI credit - text function inference"),
    ("AI_SERVICES", D("2.20"), "AI credit - other text services"),
    ("CODE_ASSISTANT_CLI", D("2.00"), "AI credit - code assistant, command line"),
    ("CODE_ASSISTANT_WEB", D("2.00"), "AI credit - code assistant, browser"),
    ("CODE_ASSISTANT_DESKTOP", D("2.00"), "AI credit - code assistant, desktop"),
]
DEFAULT_RATE_USD = D("2.20")
DEFAULT_RATE_NOTE = "unmapped - rate assumed 2.20"

# --- fixed values: sponsor banks of debit mandates ---------------------------
SPONSOR_BANKS = [
    "State Bank of India", "HDFC Bank", "ICICI Bank", "Axis Bank", "Bank of Baroda",
    "Punjab National Bank", "Kotak Mahindra Bank", "Canara Bank", "Union Bank of India",
    "IndusInd Bank", "Bank of Maharashtra", "Federal Bank",
]

# --- fixed values: the two demonstration customers ---------------------------
DEMO_LOAN_COLUMNS = (
    "demo_borrower_id string, demo_product_code string, demo_sanction_inr bigint, "
    "demo_roi_pct decimal(7,3), demo_bank_roi_pct decimal(6,3), demo_tenor bigint, demo_elapsed bigint"
)
DEMO_LOAN_ROWS = [
    ("BRW000001", "PL", 200000, D("15.500"), D("12.500"), 24, 10),
    ("BRW000002", "LAP", 1200000, D("12.500"), D("11.000"), 84, 12),
]
DEMO_BORROWERS = ("BRW000001", "BRW000002")
DEMO_LABELS = {
    "BRW000001": (
        "DEMO: BT_NOT_RATIONAL_SHORT_TENOR - competitor rate gap (3.0pp) exists but residual tenor "
        "(14mo) is below the PL switching-cost threshold (18mo). Correct action: BT_LET_GO, protect margin."
    ),
    "BRW000002": (
        "DEMO: BT_RATIONAL_LONG_TENOR - LAP with 72mo residual, gap 1.5pp >= threshold. "
        "Retention counter-offer is economically justified."
    ),
}

# --- fixed values: texts and bounds of the calibration reports and the loan draws ------
GROSS_BENCHMARK_NOTE = (
    "Value-weighted is the regulatory definition and the headline. Above system benchmark because this "
    "book is unsecured-heavy NBFC, not because asset quality is deteriorating."
)

ASSET_CLASS_DEFINITIONS = {
    "STANDARD": "n/a - performing",
    "SMA-0": "1-30 DPD, early warning, most self-cure",
    "SMA-1": "31-60 DPD",
    "SMA-2": "61-90 DPD, one step from NPA",
    "NPA": "90+ DPD, borrower-level per RBI IRAC",
}

# Upper hash bounds (out of 100) and the loans a borrower then holds.
LOAN_COUNT_BOUNDS = [(65, 1), (90, 2), (98, 3), (100, 4)]
SCORE_SPREAD_PCT = {"EXCELLENT": D("0.00"), "GOOD": D("0.50"), "FAIR": D("1.00")}
SCORE_SPREAD_OTHERWISE = D("1.50")
# Bureau band floors are our seeds.
SCORE_BANDS = [(750, "EXCELLENT"), (700, "GOOD"), (650, "FAIR")]
SCORE_BAND_OTHERWISE = "POOR"


@dataclass(frozen=True)
class Params:
    """One run's parameters.  ``as_of`` replaces every use of the current date."""

    as_of: dt.date = dt.date(2024, 2, 1)
    run_at: dt.datetime = dt.datetime(2024, 2, 1, 6, 0, 0)
    economic_rows: tuple = field(default_factory=lambda: tuple(ECONOMIC_ROWS))
    product_rows: tuple = field(default_factory=lambda: tuple(PRODUCT_ROWS))
    bt_threshold_rows: tuple = field(default_factory=lambda: tuple(BT_THRESHOLD_ROWS))
    action_rows: tuple = field(default_factory=lambda: tuple(ACTION_ROWS))
    rate_rows: tuple = field(default_factory=lambda: tuple(RATE_ROWS))
    demo_loan_rows: tuple = field(default_factory=lambda: tuple(DEMO_LOAN_ROWS))
    loss_share: D = D("0.60")
    opex_pct: D = D("1.0")
    score_gap_cap_pct: D = D("5.0")
    budget_usd: D = D("400.00")
    credit_quota: D = D("50")
    quota_pcts: tuple = (50, 75, 90, 95, 100)
    # The demo customers' mandates have the numbers from here on; generated ones step over them.
    demo_mandate_from: int = 9000001

    def econ(self, key: str) -> D:
        for row in self.economic_rows:
            if row[0] == key:
                return row[1]
        raise KeyError(key)

    def econ_int(self, key: str) -> int:
        return int(self.econ(key))

    def product_bounds(self) -> list[tuple[str, D, D]]:
        """(code, low, high) cumulative weights in code order, in thousandths of a percent."""
        out, low = [], D(0)
        for row in sorted(self.product_rows, key=lambda r: r[0]):
            high = low + row[3]
            out.append((row[0], low * 1000, high * 1000))
            low = high
        return out


def sql_literal(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return "TRUE" if value else "FALSE"
    if isinstance(value, (int, D)):
        return str(value)
    return "'" + str(value).replace("'", "''") + "'"


def inline_rows_sql(rows, columns: str) -> str:
    """``SELECT`` over an inline ``VALUES`` table, understood by Spark and by the SQL checks."""
    names = [c.strip().split(" ", 1) for c in _split_columns(columns)]
    body = ", ".join("(" + ", ".join(sql_literal(v) for v in row) + ")" for row in rows)
    raw = ", ".join(f"v{i}" for i in range(len(names)))
    casts = ", ".join(
        f"CAST(v{i} AS {_ansi_type(kind)}) AS {name}" for i, (name, kind) in enumerate(names)
    )
    return f"SELECT {casts} FROM (VALUES {body}) AS t({raw})"


def _split_columns(columns: str) -> list[str]:
    out, depth, cur = [], 0, ""
    for ch in columns:
        depth += (ch == "(") - (ch == ")")
        if ch == "," and depth == 0:
            out.append(cur)
            cur = ""
        else:
            cur += ch
    return [*out, cur]


def _ansi_type(kind: str) -> str:
    # STRING is accepted by both engines as a type name.
    return kind.strip().upper()


# A constant table up to this many rows may be sent to every executor.
MAX_BROADCAST_ROWS = 10_000


def inline_table(spark: SparkSession, rows, columns: str) -> DataFrame:
    """A constant table, to be broadcast while its counted rows are few.

    Its keys are few and heavy (a product may hold half of all loans), so a shuffle on them
    would be uneven; a longer table is left to the optimiser's own size limit.
    """
    table = spark.sql(inline_rows_sql(rows, columns))
    return broadcast(table) if len(rows) <= MAX_BROADCAST_ROWS else table


def economic_table(spark, p: Params) -> DataFrame:
    return inline_table(spark, p.economic_rows, ECONOMIC_COLUMNS)


def product_table(spark, p: Params) -> DataFrame:
    return inline_table(spark, p.product_rows, PRODUCT_COLUMNS)


def bt_threshold_table(spark, p: Params) -> DataFrame:
    return inline_table(spark, p.bt_threshold_rows, BT_THRESHOLD_COLUMNS)


def action_table(spark, p: Params) -> DataFrame:
    return inline_table(spark, p.action_rows, ACTION_COLUMNS)


def rate_table(spark, p: Params) -> DataFrame:
    return inline_table(spark, p.rate_rows, RATE_COLUMNS)


def demo_loan_table(spark, p: Params) -> DataFrame:
    return inline_table(spark, p.demo_loan_rows, DEMO_LOAN_COLUMNS)
