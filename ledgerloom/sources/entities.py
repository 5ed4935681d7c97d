"""Lending entities derived from the base tables.

The base tables are a generic order-and-event star, so customers stand in for
borrowers, orders for bureau tradelines, error events for calls and all events for
metered usage.  Every rule here is ours; the operators only see the entity schemas.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.config import (
    DEMO_BORROWERS,
    DEMO_LABELS,
    SCORE_BAND_OTHERWISE,
    SCORE_BANDS,
    Params,
    inline_table,
)
from ledgerloom.functions.columns import bucket, bucket_sql, lookup, nth, padded_id, pick
from ledgerloom.operators.ranking import keyed_sequence
from ledgerloom.sources.tables import merged, read_base

LANGUAGES = ["HINDI", "TAMIL", "TELUGU", "KANNADA", "MARATHI"]
LENDER_TYPES = ["FINTECH", "MFI", "BANK", "NBFC"]
TRADELINE_PRODUCTS = ["PERSONAL", "VEHICLE", "HOME", "CARD"]

# Persona of a borrower's calls: upper hash bound (of 100) and label.
PERSONA_BOUNDS = [
    (18, "GENUINE_HARDSHIP"),
    (36, "TECHNICAL_BOUNCE"),
    (54, "BT_RATIONAL_RATE_SHOPPER"),
    (72, "BT_NOT_RATIONAL_RATE_SHOPPER"),
    (88, "GROWTH_CLEAN"),
    (94, "AMBIGUOUS_FIRST_BOUNCE"),
    (100, "WILFUL_DEFAULT_ADVERSARIAL"),
]

CALL_TEMPLATE_COLUMNS = "persona string, variant bigint, template string"
CALL_TEMPLATES = [
    ("GENUINE_HARDSHIP", 0,
     "I am worried about this month. I cannot pay in full because my father is in hospital for surgery. "
     "The bill was Rs {amount} last week. I will pay Rs {part} by {day} {month}."),
    ("GENUINE_HARDSHIP", 1,
     "I am struggling, please note it. I am behind because my salary was cut at the factory 2 months ago. "
     "I can pay Rs {part} on {day} {month}."),
    ("GENUINE_HARDSHIP", 2,
     "Thank you for your patience. I kept my last promise and paid part of it. "
     "I am still short because my father is in hospital for surgery. I will pay Rs {part} by {day} {month}."),
    ("TECHNICAL_BOUNCE", 0,
     "My auto-debit bounced even though the balance was there. "
     "It happened because the bank server was down. Please check the mandate."),
    ("TECHNICAL_BOUNCE", 1,
     "The mandate failed again and I am frustrated. "
     "The instalment bounced because the mandate was not registered at the branch portal."),
    ("TECHNICAL_BOUNCE", 2,
     "Thanks, the mandate is working now and the auto-debit went through. That is good."),
    ("BT_RATIONAL_RATE_SHOPPER", 0,
     "{bank} is offering me {rate} percent on a balance transfer. "
     "I would like a lower rate or I will switch."),
    ("BT_RATIONAL_RATE_SHOPPER", 1,
     "I am seriously thinking of a balance transfer. {bank} is offering {rate}% and my rate here is unfair."),
    ("BT_RATIONAL_RATE_SHOPPER", 2,
     "What are the foreclosure charges? {bank} is offering me {rate} percent. "
     "I am happy with your service but the lower rate matters."),
    ("BT_NOT_RATIONAL_RATE_SHOPPER", 0,
     "A friend told me about a lower rate. {bank} is offering {rate}%. I have only a few instalments left."),
    ("BT_NOT_RATIONAL_RATE_SHOPPER", 1,
     "Just asking if a lower rate is possible. I have been happy so far."),
    ("BT_NOT_RATIONAL_RATE_SHOPPER", 2,
     "Could you share a brochure and the new loan rates? I may look at a switch some day."),
    ("GROWTH_CLEAN", 0,
     "I am five years with you and I appreciate the service. Do I qualify for a top-up?"),
    ("GROWTH_CLEAN", 1,
     "Please send the insurance brochure. All my payments are on time, thanks."),
    ("GROWTH_CLEAN", 2,
     "Is there a lower rate for old customers? Another lender is offering one. Can my limit go up?"),
    ("AMBIGUOUS_FIRST_BOUNCE", 0,
     "This is the first time I missed a payment. I am embarrassed, it slipped because I was travelling "
     "for work. I will pay Rs {part} by {day} {month}."),
    ("AMBIGUOUS_FIRST_BOUNCE", 1,
     "I am not sure what went wrong. I was confused because the due date changed."),
    ("AMBIGUOUS_FIRST_BOUNCE", 2,
     "I missed my last promise because I was travelling for work. I forgot. "
     "I will pay Rs {part} on {day} {month}."),
    ("WILFUL_DEFAULT_ADVERSARIAL", 0,
     "There is some problem with the medical bills. I am late because the business is slow. "
     "I will pay Rs {part} next week."),
    ("WILFUL_DEFAULT_ADVERSARIAL", 1,
     "I missed my last promise, sorry. I did not pay because my phone was lost. "
     "I will pay Rs {part} by {day} {month}, please call later."),
    ("WILFUL_DEFAULT_ADVERSARIAL", 2,
     "I am out of town and busy. I did not keep my last promise because a relative took the money. "
     "I can pay Rs {part} on {day} {month}."),
]
COMPETITORS = ["Meridian Bank", "Lotus Finance", "Banyan Bank", "Saffron Capital"]
CALL_MONTHS = ["January", "February", "March", "April"]


def borrower_id(customer_key) -> Column:
    return padded_id("BRW", customer_key, 6)


def borrowers(spark: SparkSession, sf_dir: str, p: Params) -> DataFrame:
    customer = read_base(spark, sf_dir, "customer")
    nation = read_base(spark, sf_dir, "nation")
    region = read_base(spark, sf_dir, "region")
    key = "borrower_id"
    base = (
        customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .withColumn("borrower_id", borrower_id("c_custkey"))
        .withColumn("bureau_score", F.lit(300) + bucket([key], "cibil", 601))
        .withColumn("age", F.lit(21) + bucket([key], "age", 45))
    )
    band = pick([(F.col("bureau_score") >= low, name) for low, name in SCORE_BANDS], SCORE_BAND_OTHERWISE)
    as_of = F.lit(p.as_of)
    return base.select(
        "borrower_id",
        F.col("c_name").alias("full_name"),
        nth(["F", "M"], bucket_sql([key], "gender", 2)).alias("gender"),
        F.add_months(as_of, (F.col("age") * -12).cast("int")).alias("date_of_birth"),
        "age",
        F.col("c_mktsegment").alias("occupation_type"),
        F.greatest(F.lit(15000), F.lit(30000) + F.lit(5) * F.round("c_acctbal").cast("bigint")).alias(
            "monthly_income_inr"
        ),
        F.concat(F.col("n_name"), F.lit("_CITY_"), bucket([key], "city", 10).cast("string")).alias("city"),
        F.col("n_name").alias("state"),
        F.col("r_name").alias("region"),
        (F.lit(1) + bucket([key], "tier", 3)).alias("city_tier"),
        (F.lit(100000) + bucket([key], "pin", 900000)).cast("string").alias("pincode"),
        nth(LANGUAGES, "r_regionkey").alias("primary_language"),
        F.concat(F.lit("XXXXX"), F.lpad(bucket([key], "pan", 10000).cast("string"), 4, "0"), F.lit("X")).alias(
            "pan_masked"
        ),
        (bucket([key], "aadhaar", 100) < 92).alias("aadhaar_linked"),
        nth(["FULL", "MINIMUM"], f"{bucket_sql([key], 'kyc', 100)} >= 90").alias("kyc_status"),
        "bureau_score",
        band.alias("bureau_score_band"),
        F.date_sub(as_of, (F.lit(90) + bucket([key], "onb", 2000)).cast("int")).alias("onboard_date"),
        F.col(key).isin(*DEMO_BORROWERS).alias("is_demo_case"),
        lookup(key, DEMO_LABELS).alias("demo_case_label"),
    )


def tradelines(spark: SparkSession, sf_dir: str, p: Params) -> DataFrame:
    key = "o_orderkey"
    amount = F.round("o_totalprice").cast("bigint")
    late = bucket([key], "tdpd", 100)
    return read_base(spark, sf_dir, "orders").select(
        F.concat(F.lit("TL"), F.col(key).cast("string")).alias("tradeline_id"),
        borrower_id("o_custkey").alias("borrower_id"),
        F.concat(F.lit("LENDER_"), (F.col(key) % 12).cast("string")).alias("lender_name"),
        nth(LENDER_TYPES, bucket_sql([key], "ltype", 4)).alias("lender_type"),
        nth(TRADELINE_PRODUCTS, bucket_sql([key], "lprod", 4)).alias("product_type"),
        F.lit(False).alias("is_own_book"),
        amount.alias("sanctioned_amount_inr"),
        (F.lit(10) + bucket([key], "lroi", 1500) / F.lit(100)).cast("decimal(27,2)").alias("roi_pct"),
        (F.lit(12) + bucket([key], "lten", 49)).alias("tenor_months"),
        F.to_date("o_orderdate").alias("opened_date"),
        F.expr("CAST(ROUND(o_totalprice) AS BIGINT) DIV 2").alias("current_balance_inr"),
        F.expr("CAST(ROUND(o_totalprice) AS BIGINT) DIV 60").alias("emi_amount_inr"),
        F.when(late < 5, F.lit(1) + bucket([key], "tdpdv", 120)).otherwise(0).cast("bigint").alias("current_dpd"),
        F.when(F.col("o_orderstatus") == "O", "ACTIVE").otherwise("CLOSED").alias("tradeline_status"),
        F.lit(p.as_of).alias("last_reported_date"),
    )


def with_persona(df: DataFrame, out: str) -> DataFrame:
    """The draw is a column of its own, so its hash is computed once per row."""
    draw = F.col("_draw")
    label = pick([(draw < bound, label) for bound, label in PERSONA_BOUNDS])
    return df.withColumn("_draw", bucket(["borrower_id"], "persona", 100)).withColumn(out, label).drop("_draw")


def call_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = read_base(spark, sf_dir, "events").filter(F.col("event_type") == "error")
    return events.select(
        F.concat(F.lit("INT"), F.col("event_id").cast("string")).alias("interaction_id"),
        borrower_id(F.col("user_id") * 10 + F.col("event_id") % 3).alias("borrower_id"),
        "event_id",
        "ts",
    )


#: Calls are cut by range along these, so that a borrower's busiest hour may span many slices.
CALL_ORDER = ("borrower_id", "ts", "event_id")


def calls(spark: SparkSession, events: DataFrame, p: Params) -> DataFrame:
    """Call transcripts: one per error event, numbered along time per borrower.

    ``events`` are the ``call_events`` cut by range along ``CALL_ORDER``, and written.
    """
    ordered = keyed_sequence(events, "borrower_id", ["ts", "event_id"], F.col("_slice"), "ts")
    key = "interaction_id"
    part = F.lit(1000) + F.lit(500) * bucket([key], "part", 12)
    fills = {
        "{amount}": F.format_number(F.lit(20000) + F.lit(1000) * bucket([key], "amt", 60), 0),
        "{part}": F.format_number(part, 0),
        "{day}": (F.lit(1) + bucket([key], "day", 28)).cast("string"),
        "{month}": nth(CALL_MONTHS, bucket_sql([key], "month", 4)),
        "{bank}": nth(COMPETITORS, bucket_sql([key], "bank", 4)),
        "{rate}": F.concat(
            (F.lit(9) + bucket([key], "rate", 4)).cast("string"), F.lit("."), bucket([key], "frac", 10).cast("string")
        ),
    }
    text = F.col("template")
    for mark, value in fills.items():
        text = F.replace(text, F.lit(mark), value)
    templates = inline_table(spark, CALL_TEMPLATES, CALL_TEMPLATE_COLUMNS)
    return (
        with_persona(ordered, "persona")
        .withColumn("variant", (F.col("seq") - 1) % 3)
        .join(templates, ["persona", "variant"], "left")
        .select(
            "interaction_id",
            "borrower_id",
            F.lit(None).cast("string").alias("loan_id"),
            F.lit("CALL").alias("channel"),
            F.col("seq").alias("transcript_sequence_number"),
            F.col("seq_length").alias("total_sequence_length"),
            F.to_date("ts").alias("contact_date"),
            F.datediff(F.to_date("ts"), F.to_date("previous_time")).cast("bigint").alias(
                "days_since_previous_contact"
            ),
            text.alias("transcript_text"),
            F.lit(False).alias("is_truncated"),
            F.col("ts").alias("created_at"),
            F.lit(False).alias("is_stub"),
        )
    )


def ground_truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hidden labels of the calls; only evaluation reads this."""
    return with_persona(call_events(spark, sf_dir), "ground_truth_label").select(
        "interaction_id",
        "ground_truth_label",
        F.lit("template").alias("generation_model"),
        F.col("ts").alias("generated_at"),
    )


# --- metered usage -------------------------------------------------------------
SERVICE_BY_EVENT = {
    "purchase": "WAREHOUSE_METERING",
    "view": "CLOUD_SERVICES",
    "click": "AI_FUNCTIONS",
    "signup": "AI_SERVICES",
}
UNLISTED_SERVICE = "UNLISTED_SERVICE"
TEXT_FUNCTIONS = ["SENTIMENT", "CLASSIFY", "EXTRACT"]


def metered_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Credits per day and service."""
    credits = F.col("value").cast("decimal(12,2)") / F.lit(1000).cast("decimal(4,0)")
    return (
        read_base(spark, sf_dir, "events")
        .groupBy(
            F.to_date("ts").alias("usage_date"),
            lookup("event_type", SERVICE_BY_EVENT, UNLISTED_SERVICE).alias("service_type"),
        )
        .agg(F.sum(credits.cast("decimal(18,6)")).alias("credits_used"))
    )


def text_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per text-function call with its tag, tokens and credits."""
    tag = bucket(["event_id"], "tag", 4)
    return (
        read_base(spark, sf_dir, "events")
        .filter(F.col("event_type").isin("click", "signup"))
        .select(
            pick(
                [(tag == 0, ""), (tag == 1, F.lit(None).cast("string"))],
                F.concat(F.lit("batch_"), (F.col("user_id") % 5).cast("string")),
            ).alias("query_tag"),
            nth(TEXT_FUNCTIONS, bucket_sql(["event_id"], "fn", 3)).alias("function_name"),
            F.concat(F.lit("model_"), bucket(["event_id"], "mdl", 2).cast("string")).alias("model_name"),
            (F.lit(50) + bucket(["event_id"], "tok", 900)).alias("tokens"),
            (F.col("value").cast("decimal(12,2)") / F.lit(10000).cast("decimal(5,0)"))
            .cast("decimal(18,6)")
            .alias("token_credits"),
        )
    )


# --- customer papers -----------------------------------------------------------
def papers(borrower: DataFrame, loans: DataFrame) -> DataFrame:
    """Text of one income statement, one bank statement and one letter per borrower.

    Amounts come from the borrower's own income and instalments, so the cross-check of
    papers against records has something to find.
    """
    dues = loans.groupBy("borrower_id").agg(F.sum("emi_amount_inr").alias("emi"))
    net = F.expr("monthly_income_inr * net_share DIV 100")
    base = (
        borrower.select("borrower_id", "full_name", "monthly_income_inr")
        .join(merged(dues), "borrower_id")
        .withColumn("net_share", F.lit(90) + bucket(["borrower_id"], "net", 16))
        .withColumn("net", net)
    )

    def rs(c) -> Column:
        return F.format_number(c, 0)

    slip = F.concat(
        F.lit("Income Statement\nName: "), F.col("full_name"),
        F.lit("\nMonth: January 2024\n\nGross Professional Fees:  Rs "), rs(F.col("net") + 5000),
        F.lit("\nLess: Tax Deducted:       Rs "), rs(F.lit(5000)),
        F.lit("\nNet Amount Paid:          Rs "), rs(F.col("net")), F.lit("\n"),
    )
    statement = F.concat(
        F.lit("Bank Statement Excerpt - January 2024\nAccount Holder: "), F.col("full_name"),
        F.lit("\n\nDate         Description   Debit(Rs)   Credit(Rs)\n01-Jan-2024  Opening Balance   0   "),
        rs(F.col("monthly_income_inr")),
        F.lit("\n10-Jan-2024  Consulting Fee   0   "), rs(F.col("net")),
        F.lit("\n20-Jan-2024  Electricity Bill   1,500   0\n28-Jan-2024  EMI - Loan account   "),
        rs(F.col("emi")), F.lit("   0\n"),
    )
    letter = F.concat(
        F.lit("Subject: Request for a part-payment arrangement\n\nDear Team,\n\nA client paid late, so I ask "
              "for a part payment this month.\n\nBest regards,\n"),
        F.col("full_name"), F.lit("\n"),
    )
    kinds = F.array(
        F.struct(F.lit("INCOME_STATEMENT").alias("doc_type"), slip.alias("text")),
        F.struct(F.lit("BANK_STATEMENT").alias("doc_type"), statement.alias("text")),
        F.struct(F.lit("HARDSHIP_LETTER").alias("doc_type"), letter.alias("text")),
    )
    return base.select("borrower_id", F.inline(kinds)).select(
        F.concat_ws("-", "borrower_id", "doc_type").alias("paper_id"), "borrower_id", "doc_type", "text"
    )
