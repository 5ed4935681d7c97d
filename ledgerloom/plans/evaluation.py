"""Evaluation of text signals against hidden labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.columns import lookup, none_if_missing
from ledgerloom.functions.text import EXTRACT_FIELDS
from ledgerloom.sources.tables import merged

WILFUL = "WILFUL_DEFAULT_ADVERSARIAL"
# Whether a transfer would pay off is not in the text, so both rate-shopping labels
# expect the same prediction.
EXPECTED_INTENT = {
    "GENUINE_HARDSHIP": "genuine_hardship",
    "TECHNICAL_BOUNCE": "technical_issue_or_dispute",
    "BT_RATIONAL_RATE_SHOPPER": "rate_shopping_balance_transfer",
    "BT_NOT_RATIONAL_RATE_SHOPPER": "rate_shopping_balance_transfer",
    "GROWTH_CLEAN": "relationship_or_growth_call",
    "AMBIGUOUS_FIRST_BOUNCE": "first_missed_payment_uncertain",
    WILFUL: "payment_avoidance_pattern",
}


def labelled(truth: DataFrame, insight: DataFrame) -> DataFrame:
    return (
        truth.select("interaction_id", "ground_truth_label")
        .join(merged(insight), "interaction_id")
        .withColumn("expected_intent", lookup("ground_truth_label", EXPECTED_INTENT))
    )


def confusion_matrix(joined: DataFrame) -> DataFrame:
    return joined.groupBy("ground_truth_label", "predicted_intent").agg(F.count("*").alias("n"))


def _pct(part: Column, whole: Column, places: int = 1) -> Column:
    safe = F.nullif(whole.cast("decimal(18,0)"), F.lit(0))
    return F.round(F.lit(100).cast("decimal(3,0)") * part.cast("decimal(18,0)") / safe, places).cast(
        f"decimal(6,{places})"
    )


def class_accuracy(joined: DataFrame) -> DataFrame:
    """Per label: size, accuracy and the wrong prediction made most often (the
    alphabetically first of equals)."""
    cells = confusion_matrix(joined)
    right = F.col("predicted_intent") == lookup("ground_truth_label", EXPECTED_INTENT)
    missed = F.when(~right, F.col("n"))
    per_label = cells.groupBy("ground_truth_label").agg(
        F.sum("n").alias("n_calls"),
        F.coalesce(F.sum(F.when(right, F.col("n"))), F.lit(0)).alias("n_right"),
        F.max(missed).alias("confusion_count"),
    )
    top = (
        cells.filter(~right)
        .join(per_label.select("ground_truth_label", "confusion_count"), "ground_truth_label")
        .filter(F.col("n") == F.col("confusion_count"))
        .groupBy("ground_truth_label")
        .agg(F.min("predicted_intent").alias("dominant_confusion"))
    )
    return per_label.join(top, "ground_truth_label", "left").select(
        "ground_truth_label",
        "n_calls",
        _pct(F.col("n_right"), F.col("n_calls")).alias("accuracy_pct"),
        "dominant_confusion",
        "confusion_count",
    )


def borrower_signals(
    truth: DataFrame, scored_calls: DataFrame, trajectory: DataFrame, mandates: DataFrame
) -> DataFrame:
    """One row per called borrower: the true label and each signal."""
    flags = (
        scored_calls.select("interaction_id", "borrower_id", "predicted_intent")
        .join(merged(truth.select("interaction_id", "ground_truth_label")), "interaction_id")
        .groupBy("borrower_id")
        .agg(
            F.bool_or(F.col("ground_truth_label") == WILFUL).alias("is_wilful"),
            F.bool_or(F.col("predicted_intent") == EXPECTED_INTENT[WILFUL]).alias("text_flag"),
        )
    )
    behaviour = trajectory.select("borrower_id", "any_ptp_made_then_missed", "any_reason_change")
    revoked = mandates.groupBy("borrower_id").agg(
        F.bool_or(F.col("failure_attribution") == "INTENT").alias("structural_flag")
    )
    return (
        flags.join(merged(behaviour), "borrower_id", "left")
        .join(merged(revoked), "borrower_id", "left")
        .select(
            "borrower_id",
            "is_wilful",
            "text_flag",
            F.coalesce("any_ptp_made_then_missed", F.lit(False)).alias("broken_promise"),
            F.coalesce("any_reason_change", F.lit(False)).alias("reason_change"),
            F.coalesce("structural_flag", F.lit(False)).alias("structural_flag"),
        )
    )


def signal_combination(signals: DataFrame) -> DataFrame:
    """Recall, false-positive rate and precision of each way to combine the signals.

    The structural signal selected the label in the first place, so it is listed last and
    is no finding.
    """
    score = sum(F.col(c).cast("int") for c in ("text_flag", "broken_promise", "reason_change"))
    flags = {
        "text_only": F.col("text_flag"),
        "any_of_3": score >= 1,
        "two_of_3": score >= 2,
        "structural_circular": F.col("structural_flag"),
    }
    wilful = F.col("is_wilful")
    sums = signals.agg(
        F.count_if(wilful).alias("positives"),
        F.count_if(~wilful).alias("negatives"),
        *[F.count_if(wilful & f).alias(f"tp_{k}") for k, f in flags.items()],
        *[F.count_if(~wilful & f).alias(f"fp_{k}") for k, f in flags.items()],
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(k).alias("signal"),
                F.col("positives").alias("n_positive"),
                F.col("negatives").alias("n_negative"),
                F.col(f"tp_{k}").alias("true_positives"),
                F.col(f"fp_{k}").alias("false_positives"),
            )
            for k in flags
        ]
    )
    tp, fp = F.col("true_positives"), F.col("false_positives")
    return sums.select(F.inline(rows)).select(
        "signal",
        "n_positive",
        "n_negative",
        "true_positives",
        "false_positives",
        _pct(tp, F.col("n_positive")).alias("recall_pct"),
        _pct(fp, F.col("n_negative")).alias("false_positive_rate_pct"),
        _pct(tp, tp + fp).alias("precision_pct"),
    )


def extract_null_rates(joined: DataFrame) -> DataFrame:
    """Share of calls per label without each extracted field."""
    counts = joined.groupBy("ground_truth_label").agg(
        F.count("*").alias("n_calls"),
        *[F.count_if(none_if_missing(f).isNull()).alias(f) for f in EXTRACT_FIELDS],
    )
    rows = F.array(
        *[F.struct(F.lit(f).alias("field"), F.col(f).alias("n_missing")) for f in EXTRACT_FIELDS]
    )
    return counts.select("ground_truth_label", "n_calls", F.inline(rows)).select(
        "ground_truth_label",
        "field",
        "n_calls",
        "n_missing",
        _pct(F.col("n_missing"), F.col("n_calls")).alias("null_rate_pct"),
    )


def _reader_shares(read: DataFrame) -> DataFrame:
    """Rows stand for ``n_calls`` calls each.  ``MACRO`` comes from the labels' few rows, so nothing is read twice."""

    def mean(value: Column) -> Column:
        return F.sum(value * F.col("n_calls")) / F.sum(F.when(value.isNotNull(), F.col("n_calls")))

    per_label = read.groupBy("ground_truth_label").agg(
        F.sum("n_calls").alias("n_calls"),
        mean((F.col("predicted_intent") == F.col("expected_intent")).cast("int")).alias("rules"),
        mean((F.col("trained_intent") == F.col("expected_intent")).cast("int")).alias("trained"),
        mean(F.col("confidence")).alias("confidence"),
    )
    none = read.sparkSession.range(1).select(
        F.lit("MACRO").alias("ground_truth_label"),
        F.lit(0).cast("bigint").alias("n_calls"),
        *[F.lit(None).cast("double").alias(c) for c in ("rules", "trained", "confidence")],
    )
    twice = F.explode(F.array("ground_truth_label", F.lit("MACRO")))
    return per_label.withColumn("ground_truth_label", twice).unionByName(none).groupBy("ground_truth_label").agg(
        F.sum("n_calls").alias("n_calls"), *[F.avg(c).alias(c) for c in ("rules", "trained", "confidence")]
    )


def trained_reading(read: DataFrame, reworded: DataFrame) -> DataFrame:
    """Per label, and over all labels alike (``MACRO``): accuracy of the rules, of the trained reader on calls of
    borrowers it never saw, and on wordings it never saw, with the gap between mean confidence and accuracy.  Rows
    stand for ``n_calls`` calls each.

    Where many borrowers say the same sentences, the first figure tells only that sentences are recognised;
    the second is the one to judge the reader by.
    """
    known = _reader_shares(read)
    new = _reader_shares(reworded).select(
        "ground_truth_label", F.col("trained").alias("reworded"), F.col("confidence").alias("reworded_confidence")
    )

    def pct(share) -> Column:
        return F.round(share * 100, 1)

    return known.join(new, "ground_truth_label", "left").select(
        "ground_truth_label",
        "n_calls",
        pct(F.col("rules")).alias("rules_accuracy_pct"),
        pct(F.col("trained")).alias("new_borrower_accuracy_pct"),
        pct(F.abs(F.col("confidence") - F.col("trained"))).alias("new_borrower_gap_pct"),
        pct(F.col("reworded")).alias("new_wording_accuracy_pct"),
        pct(F.abs(F.col("reworded_confidence") - F.col("reworded"))).alias("new_wording_gap_pct"),
    )
