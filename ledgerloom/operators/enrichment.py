"""Call enrichment: pure per-row projections, so the same code serves batch and stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import text as tx
from ledgerloom.sources.tables import merged

SIGNAL_COLUMNS = ["sentiment", "predicted_intent", "is_credible_hardship", *tx.EXTRACT_FIELDS]
INSIGHT_COLUMNS = ["interaction_id", *SIGNAL_COLUMNS, "raw_extract_full", "enriched_at"]


def score_text(df: DataFrame, text_col: str = "transcript_text") -> DataFrame:
    """Add every signal read from the whole text.  A vectorised scorer with the same
    columns may take this function's place."""
    return (
        df.withColumn("raw_extract_full", tx.extract_struct(text_col))
        .withColumns(
            {
                "sentiment": tx.sentiment(text_col),
                "predicted_intent": tx.intent(text_col),
                "is_credible_hardship": tx.credible_hardship(text_col),
            }
        )
        .withColumns({f: F.col(f"raw_extract_full.{f}") for f in tx.EXTRACT_FIELDS})
    )


def enrich_transcripts(calls: DataFrame, text_col: str = "transcript_text") -> DataFrame:
    """One insight row per call; the time stamp is the call's own, so a rerun changes nothing."""
    return (
        score_text(calls, text_col)
        .withColumn("enriched_at", F.col("created_at"))
        .select(*INSIGHT_COLUMNS)
    )


CALL_KEYS = [
    "borrower_id", "transcript_sequence_number", "total_sequence_length", "contact_date",
    "days_since_previous_contact",
]


def scored_calls(calls: DataFrame, text_col: str = "transcript_text") -> DataFrame:
    """Calls and their insight side by side: enrichment keeps the row, so no join is needed."""
    return (
        score_text(calls, text_col)
        .withColumn("enriched_at", F.col("created_at"))
        .select(*INSIGHT_COLUMNS, *CALL_KEYS)
    )


def backfill(legacy: DataFrame, calls: DataFrame) -> DataFrame:
    """Keep stored insight as it is and read only the calls it does not cover."""
    fresh = calls.join(merged(legacy.select("interaction_id")), "interaction_id", "left_anti")
    return legacy.unionByName(enrich_transcripts(fresh))
