"""Reading typed fields out of document text and checking them against records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.sources.tables import merged

NAME_LINE = r"(?:Name|Account Holder): ([^\n]+)"
SIGNATURE = r"regards,\n([^\n]+)"
NET_PAID = r"Net Amount Paid: +Rs +([0-9,]+)"
EMI_LINE = r"EMI - [^\n0-9]*?  +([0-9,]+)"
INCOME_TOLERANCE_PCT = 5


def _text(df_col: str, pattern: str) -> Column:
    return F.nullif(F.trim(F.regexp_extract(F.col(df_col), pattern, 1)), F.lit(""))


def _amount(df_col: str, pattern: str) -> Column:
    return F.regexp_replace(_text(df_col, pattern), ",", "").try_cast("bigint")


def extract_fields(papers: DataFrame) -> DataFrame:
    return papers.select(
        "paper_id",
        "borrower_id",
        "doc_type",
        F.coalesce(_text("text", NAME_LINE), _text("text", SIGNATURE)).alias("holder_name"),
        _amount("text", NET_PAID).alias("net_income_inr"),
        _amount("text", EMI_LINE).alias("emi_debit_inr"),
    )


DATED_LINE = r"^[0-9]{2}-[A-Z][a-z]{2}-[0-9]{4} "


def _dated_lines(papers: DataFrame) -> DataFrame:
    lines = papers.filter(F.col("doc_type") == "BANK_STATEMENT").select(
        "borrower_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line")
    )
    dated = lines.filter(F.col("line").rlike(DATED_LINE))
    return dated.withColumn("line_no", F.col("line_no").cast("bigint")).withColumn("cells", F.split("line", " {2,}"))


def _cell_amount(place: int) -> Column:
    return F.regexp_replace(F.get("cells", F.lit(place)), ",", "").try_cast("bigint")


def _complete() -> Column:
    """Date, description, debit and credit; the two amounts must read as numbers."""
    return (F.size("cells") >= 4) & _cell_amount(2).isNotNull() & _cell_amount(3).isNotNull()


def statement_lines(papers: DataFrame) -> DataFrame:
    """Bank statements as one row per transaction line; the running balance is NULL where a
    statement has no such column."""
    return _dated_lines(papers).filter(_complete()).select(
        "borrower_id",
        "line_no",
        F.get("cells", F.lit(0)).alias("booked_on"),
        F.get("cells", F.lit(1)).alias("description"),
        _cell_amount(2).alias("debit_inr"),
        _cell_amount(3).alias("credit_inr"),
        _cell_amount(4).alias("balance_inr"),
    )


def statement_rejects(papers: DataFrame) -> DataFrame:
    """Dated lines that are no complete transaction, as they stand."""
    return _dated_lines(papers).filter(~_complete()).select("borrower_id", "line_no", "line")


def income_corroboration(fields: DataFrame, state: DataFrame) -> DataFrame:
    """Document income and instalment next to the borrower's recorded income."""
    per_borrower = fields.groupBy("borrower_id").agg(
        F.max("net_income_inr").alias("document_income_inr"), F.max("emi_debit_inr").alias("document_emi_inr")
    )
    recorded = state.select("borrower_id", "monthly_income_inr", "foir_true_pct")
    doc, rec, emi = (F.col(c) for c in ("document_income_inr", "monthly_income_inr", "document_emi_inr"))

    def pct(part: Column, whole: Column) -> Column:
        safe = F.nullif(whole.cast("decimal(18,0)"), F.lit(0))
        return F.round(F.lit(100).cast("decimal(3,0)") * part.cast("decimal(18,0)") / safe, 1).cast("decimal(12,1)")

    return (
        per_borrower.join(merged(recorded), "borrower_id")
        .withColumn("income_gap_pct", pct(F.abs(rec - doc), rec))
        .withColumn("emi_to_document_income_pct", pct(emi, doc))
        .withColumn("emi_to_recorded_income_pct", pct(emi, rec))
        .withColumn("income_corroborated", F.col("income_gap_pct") <= INCOME_TOLERANCE_PCT)
    )


def scan_documents(documents: DataFrame) -> DataFrame:
    """Landed documents with the size of their whole text."""
    return documents.select(
        "doc_id",
        "lang",
        "source",
        F.length("text").cast("bigint").alias("text_chars"),
        F.size(F.split("text", "\n")).cast("bigint").alias("text_lines"),
        (F.length("text") == F.col("n_chars")).alias("length_as_declared"),
    )
