"""The deterministic loan book, its debit mandates and its repayment schedule."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.config import (
    DEMO_BORROWERS,
    LOAN_COUNT_BOUNDS,
    SCORE_SPREAD_OTHERWISE,
    SCORE_SPREAD_PCT,
    SPONSOR_BANKS,
    Params,
    demo_loan_table,
    product_table,
)
from ledgerloom.functions.columns import bucket, lookup, nth, padded_id, pick, strict_least
from ledgerloom.functions.finance import balance_after, instalment, monthly_rate, outstanding, to_money
from ledgerloom.operators.ranking import global_row_number, running_total_before
from ledgerloom.sources.tables import merged

# Salts of the independent draws made for each loan, and their ranges.
LOAN_DRAWS = {
    "prod": 100000, "tick": 1000, "ten": 1000, "strs": 10000, "dpdv": 1000,
    "elap": 1000, "chan": 100, "rt": 100, "nach": 100, "clear": 100,
}
MANDATE_DRAWS = {"mstat": 1000, "mrsn": 100, "mbank": 12, "mfail": 60, "mcons": 100, "mtype": 100}

LOAN_COLUMNS = [
    "loan_id", "borrower_id", "product_code", "product_name", "is_secured", "sanction_amount_inr",
    "disbursed_amount_inr", "roi_pct", "bank_benchmark_roi_pct", "rate_gap_vs_bank_pct", "rate_type",
    "is_repo_linked", "tenor_months", "emi_amount_inr", "disbursal_date", "maturity_date",
    "months_elapsed", "residual_months", "outstanding_principal_inr", "current_dpd",
    "unpaid_emi_count", "arrears_amount_inr", "sourcing_channel", "has_nach_mandate", "is_active",
]


def loan_count(draw: str) -> Column:
    return pick([(F.col(draw) < bound, n) for bound, n in LOAN_COUNT_BOUNDS]).cast("bigint")


def explode_loans(borrowers: DataFrame, p: Params) -> DataFrame:
    """One row per (borrower, seq) with the dense loan number along (borrower_id, seq).

    The number of loans of all earlier borrowers is a two-level running total over the
    borrowers, which were cut by range and written, so no task orders the whole loan table.
    """
    counted = with_draws(borrowers.select("borrower_id", "bureau_score_band", "_slice"), ["borrower_id"], {"lc": 100})
    counted = counted.withColumn("loan_count", loan_count("h_lc")).drop("h_lc")
    numbered = running_total_before(
        counted,
        ["borrower_id"],
        F.col("_slice"),
        F.col("loan_count"),
        "_loans_before",
    )
    return numbered.select(
        "borrower_id",
        "bureau_score_band",
        "loan_count",
        "_loans_before",
        F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("loan_count"))).alias("seq"),
    ).withColumn("loan_no", F.col("_loans_before") + F.col("seq")).drop("_loans_before")


def with_draws(df: DataFrame, keys: list[str], draws: dict[str, int]) -> DataFrame:
    return df.withColumns({f"h_{salt}": bucket(keys, salt, n) for salt, n in draws.items()})


def product_of(draw: Column, p: Params) -> Column:
    """Half-open weight interval that holds the draw, as a CASE over the few bounds."""
    return pick([((draw >= lo) & (draw < hi), code) for code, lo, hi in p.product_bounds()])


def score_spread(band) -> Column:
    return lookup(band, SCORE_SPREAD_PCT, SCORE_SPREAD_OTHERWISE).cast("decimal(4,2)")


def drawn_dpd(stress, value, gnpa_pct) -> Column:
    """Days past due before the age clamp, by severity tier of the stress draw."""
    stress, value, gnpa = (F.col(c) if isinstance(c, str) else c for c in (stress, value, gnpa_pct))
    return pick(
        [
            (stress < gnpa * 100, F.lit(91) + value % 270),
            (stress < gnpa * 200, F.lit(31) + value % 60),
            (stress < gnpa * 500, F.lit(1) + value % 30),
        ],
        F.lit(0),
    ).cast("bigint")


def clamped_dpd(drawn: Column, months_elapsed) -> Column:
    """A loan is never more days late than it is old."""
    return strict_least(drawn, F.col(months_elapsed) * 30)


def unpaid_instalments(dpd) -> Column:
    dpd = F.col(dpd) if isinstance(dpd, str) else dpd
    return F.ceil(dpd / F.lit(30)).cast("bigint")


def arrears(dpd, emi, clearance) -> Column:
    """Overdue amount; badly late loans may have cleared all or part of it."""
    dpd, emi, clearance = (F.col(c) if isinstance(c, str) else c for c in (dpd, emi, clearance))
    due = unpaid_instalments(dpd) * emi
    partial = F.round(due * (F.lit(20) + clearance % 23) / F.lit(100)).cast("bigint")
    return pick(
        [((dpd >= 90) & (clearance < 12), F.lit(0).cast("bigint")), ((dpd >= 90) & (clearance < 35), partial)],
        due,
    )


def loan_terms(spark: SparkSession, exploded: DataFrame, p: Params) -> DataFrame:
    """Product, ticket, tenor, price and age of every loan."""
    drawn = with_draws(exploded, ["borrower_id", "seq"], LOAN_DRAWS)
    top = p.product_bounds()[-1][2]
    if top < LOAN_DRAWS["prod"]:  # weights below 100 leave draws without a product
        drawn = drawn.filter(F.col("h_prod") < F.lit(top))
    # Every draw left has its product, so a left join equals an inner one and spares the
    # null filter that would hash the key a second time.
    drawn = drawn.withColumn("product_code", product_of(F.col("h_prod"), p))
    span = F.col("ticket_max_inr") - F.col("ticket_min_inr")
    return (
        drawn.join(product_table(spark, p), "product_code", "left")
        .withColumn("score_spread_pct", score_spread("bureau_score_band"))
        .withColumn(
            "sanction_amount_inr",
            F.round((F.col("ticket_min_inr") * 1000 + F.col("h_tick") * span) / F.lit(1000000)).cast("bigint") * 1000,
        )
        .withColumn(
            "tenor_months",
            F.col("tenor_min_months")
            + F.expr("h_ten * (tenor_max_months - tenor_min_months + 1) DIV 1000"),
        )
        .withColumn("roi_pct", (F.col("base_roi_pct") + F.col("score_spread_pct")).cast("decimal(7,3)"))
        .withColumn("months_elapsed", strict_least(F.expr("h_elap * tenor_months DIV 1000"), F.col("tenor_months") - 1))
    )


def keep_first_loan(loans: DataFrame, borrower_ids) -> DataFrame:
    """Drop every loan but the lowest loan_id of the named borrowers."""
    named = loans.filter(F.col("borrower_id").isin(*borrower_ids))
    first = named.groupBy("borrower_id").agg(F.min("loan_id").alias("first_loan_id"))
    extra = (
        named.join(first, "borrower_id")
        .filter(F.col("loan_id") != F.col("first_loan_id"))
        .select("loan_id")
    )
    return loans.join(extra, "loan_id", "left_anti")


def override_demo_terms(spark: SparkSession, terms: DataFrame, p: Params) -> DataFrame:
    """Give the demonstration borrowers one loan with fixed terms.

    The overrides act on the inputs of the loan formulas, so instalment, balance, dates and
    arrears follow from them without a second statement of those formulas.
    """
    demo = demo_loan_table(spark, p)
    products = product_table(spark, p).select(
        F.col("product_code").alias("demo_product_code"),
        F.col("product_name").alias("demo_product_name"),
        F.col("is_secured").alias("demo_is_secured"),
    )
    fixed = demo.join(products, "demo_product_code")
    joined = terms.join(fixed, F.col("borrower_id") == F.col("demo_borrower_id"), "left")
    is_demo = F.col("demo_borrower_id").isNotNull()

    def swap(column: str, demo_value) -> Column:
        value = F.col(demo_value) if isinstance(demo_value, str) else demo_value
        return F.when(is_demo, value).otherwise(F.col(column))

    return (
        joined.filter(~is_demo | (F.col("seq") == 1))
        .withColumns(
            {
                "product_code": swap("product_code", "demo_product_code"),
                "product_name": swap("product_name", "demo_product_name"),
                "is_secured": swap("is_secured", "demo_is_secured"),
                "sanction_amount_inr": swap("sanction_amount_inr", "demo_sanction_inr"),
                "roi_pct": swap("roi_pct", "demo_roi_pct"),
                "bank_benchmark_roi_pct": swap("bank_benchmark_roi_pct", "demo_bank_roi_pct"),
                "tenor_months": swap("tenor_months", "demo_tenor"),
                "months_elapsed": swap("months_elapsed", "demo_elapsed"),
                "_drawn_dpd": F.when(is_demo, F.lit(0)).otherwise(F.col("_drawn_dpd")).cast("bigint"),
                "_floating": is_demo | F.col("_floating"),
                "_has_mandate": is_demo | F.col("_has_mandate"),
            }
        )
    )


def finish_loans(terms: DataFrame, p: Params) -> DataFrame:
    """Amounts, dates and flags that follow from the terms."""
    as_of = F.lit(p.as_of)
    age = F.col("months_elapsed").cast("int")
    return (
        terms.withColumn("emi_amount_inr", instalment("sanction_amount_inr", "roi_pct", "tenor_months"))
        .withColumn("current_dpd", clamped_dpd(F.col("_drawn_dpd"), "months_elapsed"))
        .withColumns(
            {
                "loan_id": padded_id("LN", "loan_no", 7),
                "disbursed_amount_inr": F.col("sanction_amount_inr"),
                "rate_gap_vs_bank_pct": (F.col("roi_pct") - F.col("bank_benchmark_roi_pct")).cast("decimal(8,3)"),
                "rate_type": F.when(F.col("_floating"), "FLOATING").otherwise("FIXED"),
                "is_repo_linked": F.col("_floating"),
                "disbursal_date": F.add_months(as_of, -age),
                "maturity_date": F.add_months(as_of, F.col("tenor_months").cast("int") - age),
                "residual_months": F.col("tenor_months") - F.col("months_elapsed"),
                "outstanding_principal_inr": outstanding(
                    "sanction_amount_inr", "roi_pct", "emi_amount_inr", "months_elapsed"
                ),
                "unpaid_emi_count": unpaid_instalments("current_dpd"),
                "arrears_amount_inr": arrears("current_dpd", "emi_amount_inr", "h_clear"),
                "sourcing_channel": pick(
                    [(F.col("h_chan") < 30, "DEALER"), (F.col("h_chan") < 55, "DSA"), (F.col("h_chan") < 80, "DIGITAL")],
                    "BRANCH",
                ),
                "has_nach_mandate": F.col("_has_mandate"),
                "is_active": F.lit(True),
            }
        )
        .select(*LOAN_COLUMNS)
    )


def generated_terms(spark: SparkSession, borrowers: DataFrame, p: Params) -> DataFrame:
    floating_below = F.when(F.col("product_code").isin("MSME", "LAP"), 50).otherwise(15)
    return loan_terms(spark, explode_loans(borrowers, p), p).withColumns(
        {
            "_drawn_dpd": drawn_dpd("h_strs", "h_dpdv", "target_gnpa_pct"),
            "_floating": F.col("h_rt") < floating_below,
            "_has_mandate": F.col("h_nach") < F.col("nach_mandate_share_pct"),
        }
    )


def build_loan_account(spark: SparkSession, borrowers: DataFrame, p: Params, demo: bool = True) -> DataFrame:
    terms = generated_terms(spark, borrowers, p)
    if demo:
        terms = override_demo_terms(spark, terms, p)
    return finish_loans(terms, p)


def mandate_status(dpd: Column, draw: Column) -> Column:
    late, very_late = (dpd >= 1) & (dpd <= 60), dpd > 60
    return pick(
        [
            ((dpd == 0) & (draw < 70), "FAILED_DPD_ZERO"),
            (dpd == 0, "ACTIVE"),
            (late & (draw < 820), "FAILED_ACTIVE_ARREARS"),
            (very_late & (draw < 700), "REVOKED"),
            (very_late, "FAILED_ACTIVE_ARREARS"),
        ],
        "ACTIVE",
    )


def sponsor_bank(draw: str) -> Column:
    return nth(SPONSOR_BANKS, draw)


def mandated_loans(loans: DataFrame) -> DataFrame:
    """What a mandate takes from its loan, for all loans but the demo borrowers'."""
    return loans.filter(F.col("has_nach_mandate") & ~F.col("borrower_id").isin(*DEMO_BORROWERS)).select(
        "loan_id", "borrower_id", "current_dpd", "disbursal_date"
    )


def build_mandate(loans: DataFrame, p: Params, mandated: DataFrame) -> DataFrame:
    """Debit mandates of the loans that have one; demo borrowers get a fixed, clean one.

    ``mandated`` brings ``mandated_loans`` cut by range on ``loan_id``, and written.
    """
    is_demo = F.col("borrower_id").isin(*DEMO_BORROWERS)
    numbered = global_row_number(mandated, "loan_id", "_no")
    beyond = (F.col("_no") >= p.demo_mandate_from).cast("int")
    numbered = numbered.withColumn("_no", F.col("_no") + beyond * len(DEMO_BORROWERS))
    status = F.col("mandate_status")
    reason = F.col("h_mrsn")
    generated = (
        with_draws(numbered, ["loan_id"], MANDATE_DRAWS)
        .withColumn("mandate_status", mandate_status(F.col("current_dpd"), F.col("h_mstat")))
        .select(
            padded_id("MND", "_no", 7).alias("mandate_id"),
            "loan_id",
            "borrower_id",
            F.when(F.col("h_mtype") < 78, "NACH_DEBIT").otherwise("UPI_AUTOPAY").alias("mandate_type"),
            sponsor_bank("h_mbank").alias("sponsor_bank"),
            F.date_sub("disbursal_date", 3).alias("registration_date"),
            "mandate_status",
            pick(
                [
                    ((status == "FAILED_DPD_ZERO") & (reason < 45), "MANDATE_NOT_REGISTERED"),
                    ((status == "FAILED_DPD_ZERO") & (reason < 78), "TECHNICAL_DECLINE"),
                    (status == "FAILED_DPD_ZERO", "PAYER_ACCOUNT_INOPERATIVE"),
                    ((status == "FAILED_ACTIVE_ARREARS") & (reason < 82), "INSUFFICIENT_FUNDS"),
                    ((status == "FAILED_ACTIVE_ARREARS") & (reason < 92), "ACCOUNT_CLOSED"),
                    (status == "FAILED_ACTIVE_ARREARS", "TECHNICAL_DECLINE"),
                    (status == "REVOKED", "MANDATE_REVOKED_BY_CUSTOMER"),
                ]
            ).alias("last_failure_reason"),
            F.when(status != "ACTIVE", F.date_sub(F.lit(p.as_of), F.col("h_mfail").cast("int"))).alias(
                "last_failure_date"
            ),
            pick(
                [
                    (status == "FAILED_DPD_ZERO", F.lit(1)),
                    (status == "FAILED_ACTIVE_ARREARS", F.lit(1) + F.col("h_mcons") % 4),
                    (status == "REVOKED", F.lit(1) + F.col("h_mcons") % 3),
                ],
                F.lit(0),
            ).cast("bigint").alias("consecutive_failures"),
            lookup(
                "mandate_status", {"ACTIVE": "NONE", "FAILED_DPD_ZERO": "TECHNICAL", "REVOKED": "INTENT"}, "CAPACITY"
            ).alias("failure_attribution"),
            (status == "FAILED_DPD_ZERO").alias("is_early_warning"),
        )
    )
    # One loan per demo borrower by now: numbered by their place in the list.
    demo_no = lookup("borrower_id", {b: p.demo_mandate_from + i for i, b in enumerate(DEMO_BORROWERS)})
    demo = loans.filter(is_demo).select(
        padded_id("MND", demo_no, 7).alias("mandate_id"),
        "loan_id",
        "borrower_id",
        F.lit("NACH_DEBIT").alias("mandate_type"),
        F.lit("HDFC Bank").alias("sponsor_bank"),
        F.date_sub("disbursal_date", 3).alias("registration_date"),
        F.lit("ACTIVE").alias("mandate_status"),
        F.lit(None).cast("string").alias("last_failure_reason"),
        F.lit(None).cast("date").alias("last_failure_date"),
        F.lit(0).cast("bigint").alias("consecutive_failures"),
        F.lit("NONE").alias("failure_attribution"),
        F.lit(False).alias("is_early_warning"),
    )
    return generated.unionByName(demo)


def amortization(loans: DataFrame) -> DataFrame:
    """Repayment schedule: every opening balance in closed form, no recursion."""
    rows = loans.withColumn(
        "installment_number", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("tenor_months")))
    )
    before = balance_after(
        "sanction_amount_inr", "roi_pct", "emi_amount_inr", F.col("installment_number") - 1
    )
    return (
        rows.withColumn("_opening", before)
        .withColumn("_interest", F.col("_opening") * monthly_rate("roi_pct"))
        .withColumn("_principal", F.col("emi_amount_inr").cast("double") - F.col("_interest"))
        .select(
            F.concat_ws("-", "loan_id", "installment_number").alias("schedule_id"),
            "loan_id",
            "borrower_id",
            "installment_number",
            F.add_months("disbursal_date", F.col("installment_number").cast("int")).alias("due_date"),
            F.col("emi_amount_inr").alias("due_amount_inr"),
            to_money("_interest").alias("interest_component_inr"),
            to_money("_principal").alias("principal_component_inr"),
            to_money("_opening").alias("opening_balance_inr"),
            to_money(F.col("_opening") - F.col("_principal")).alias("closing_balance_inr"),
            (F.col("installment_number") > F.col("months_elapsed")).alias("is_future"),
        )
    )


def lifetime_value(loans: DataFrame, schedule: DataFrame) -> DataFrame:
    """Interest still to be earned per borrower, from a stored repayment schedule."""
    due = schedule.select("loan_id", "installment_number", "interest_component_inr")
    live = loans.filter("is_active").select("loan_id", "borrower_id", "months_elapsed")
    return (
        merged(live).join(due, "loan_id")
        .filter(F.col("installment_number") > F.col("months_elapsed"))
        .groupBy("borrower_id")
        .agg(F.round(F.sum("interest_component_inr"), 2).cast("decimal(18,2)").alias("ltv_expected_interest_inr"))
    )


def future_interest(loans: DataFrame) -> DataFrame:
    """The same figure straight from the loan terms: no schedule table, no join."""
    return (
        amortization(loans.filter("is_active"))
        .filter("is_future")
        .groupBy("borrower_id")
        .agg(F.round(F.sum("interest_component_inr"), 2).cast("decimal(18,2)").alias("ltv_expected_interest_inr"))
    )
