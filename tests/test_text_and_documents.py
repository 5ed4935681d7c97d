import pytest

from ledgerloom.functions import text as tx
from ledgerloom.operators import documents
from ledgerloom.operators.enrichment import backfill, enrich_transcripts
from ledgerloom.sources.tables import ENTITY_SCHEMAS


def one(spark, text, expr):
    return spark.createDataFrame([(text,)], "t string").select(expr).first()[0]


@pytest.mark.parametrize("text,label", [
    ("Thank you, great.", "positive"), ("I am worried.", "negative"), ("Thanks, but I am upset.", "mixed"),
    ("Please call.", "neutral"), (None, None)])
def test_sentiment(spark, text, label):
    assert one(spark, text, tx.sentiment("t")) == label


@pytest.mark.parametrize("text,label", [
    ("The mandate bounced at the hospital", "technical_issue_or_dispute"),
    ("Father in hospital, mandate failed", "genuine_hardship"),  # one hit each: the earlier label
    ("Hello there", tx.FALLBACK_INTENT), (None, None)])
def test_intent(spark, text, label):
    assert one(spark, text, tx.intent("t")) == label


def test_hardship_needs_detail(spark):
    assert one(spark, "My salary was cut 2 months ago", tx.credible_hardship("t")) is True
    assert one(spark, "My salary was cut", tx.credible_hardship("t")) is False


def test_extraction(spark):
    text = ("I missed my last promise because the shop was shut. I will pay Rs 12,500 by 14 March. "
            "Lotus Finance is offering me 9.5 percent.")
    assert one(spark, text, tx.extract_struct("t")).asDict() == {
        "promise_to_pay_amount": "12500", "promise_to_pay_date": "14 March",
        "competitor_name_mentioned": "Lotus Finance", "competitor_rate_mentioned": "9.5",
        "stated_reason": "the shop was shut", "previous_promise_missed_raw": "yes"}
    assert set(one(spark, "Hello", tx.extract_struct("t")).asDict().values()) == {"None"}


def test_whole_text_is_read(spark):
    text = "word " * 50000 + "I will pay Rs 700 by 3 April."
    assert one(spark, text, tx.extract_struct("t")).promise_to_pay_date == "3 April"


@pytest.mark.parametrize("a,b,changed", [
    ("my father is in hospital", "Father in the hospital!", False), ("the business is slow", "my phone was lost", True),
    ("None", "my phone was lost", None), (None, "x", None)])
def test_reasons(spark, a, b, changed):
    df = spark.createDataFrame([(a, b)], "a string, b string")
    got = df.select(tx.reasons_differ("a", "b", tx.reason_words("a"), tx.reason_words("b"))).first()[0]
    assert got is changed


def test_backfill_keeps_stored_rows(spark):
    def call(i, text):
        return (i, "B", None, "CALL", 1, 1, None, None, text, False, None, False)

    calls = spark.createDataFrame([call("I1", "Thanks"), call("I2", "Thanks")], ENTITY_SCHEMAS["call_transcript"])
    from pyspark.sql import functions as F

    legacy = enrich_transcripts(calls.filter("interaction_id = 'I1'")).withColumn("sentiment", F.lit("stored"))
    got = {r.interaction_id: r.sentiment for r in backfill(legacy, calls).collect()}
    assert got == {"I1": "stored", "I2": "positive"}


SLIP = "Income Statement\nName: A Borrower\n\nGross Professional Fees:  Rs 50,000\nNet Amount Paid:  Rs 43,650\n"
STATEMENT = ("Bank Statement\nAccount Holder: A Borrower\n\n10-Jul-2026  Consulting Fee   0   22,300\n"
             "28-Jul-2026  EMI - Loan account   21,506   0\n")


def test_document_corroboration(spark):
    papers = spark.createDataFrame(
        [("1", "B", "INCOME_STATEMENT", SLIP), ("2", "B", "BANK_STATEMENT", STATEMENT),
         ("3", "B", "HARDSHIP_LETTER", "Dear team\n\nBest regards,\nA Borrower\n")],
        "paper_id string, borrower_id string, doc_type string, text string")
    fields = documents.extract_fields(papers)
    got = {r.doc_type: r for r in fields.collect()}
    assert {r.holder_name for r in got.values()} == {"A Borrower"}
    assert got["INCOME_STATEMENT"].net_income_inr == 43650 and got["BANK_STATEMENT"].emi_debit_inr == 21506
    state = spark.createDataFrame([("B", 44600, 48.2)], "borrower_id string, monthly_income_inr bigint, foir_true_pct double")
    row = documents.income_corroboration(fields, state).first()
    assert [float(x) for x in (row.income_gap_pct, row.emi_to_document_income_pct, row.emi_to_recorded_income_pct)] == [
        2.1, 49.3, 48.2]
    assert row.income_corroborated
    lines = {r.description: (r.debit_inr, r.credit_inr) for r in documents.statement_lines(papers).collect()}
    assert lines == {"Consulting Fee": (0, 22300), "EMI - Loan account": (21506, 0)}
