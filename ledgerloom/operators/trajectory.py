"""Signals across consecutive calls of a borrower."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerloom.functions.columns import lookup, pick
from ledgerloom.functions.text import reason_words, reasons_differ
from ledgerloom.sources.tables import merged

SINGLE_INTERVAL = "N/A - single contact interval"
TRANSITION_COLUMNS = [
    "borrower_id", "from_interaction_id", "to_interaction_id", "from_seq", "to_seq", "days_gap",
    "from_sentiment", "to_sentiment", "sentiment_direction", "ptp_was_made_on_prior_call",
    "ptp_flagged_missed_on_this_call", "from_reason", "to_reason", "reason_changed",
]


def mood(sentiment) -> Column:
    return lookup(sentiment, {"positive": 1, "negative": -1}, 0)


def pair_calls(later: DataFrame, earlier: DataFrame) -> DataFrame:
    """Each later call next to the call numbered one before it.

    The join is on (borrower, sequence number), which spreads the calls of a busy borrower
    over all partitions.  A missing number gives no pair.
    """
    to = later.filter(
        (F.col("total_sequence_length") >= 2) & (F.col("transcript_sequence_number") >= 2)
    ).select(
        "borrower_id",
        F.col("transcript_sequence_number").alias("to_seq"),
        (F.col("transcript_sequence_number") - 1).alias("from_seq"),
        F.col("interaction_id").alias("to_interaction_id"),
        F.col("days_since_previous_contact").alias("days_gap"),
        F.col("sentiment").alias("to_sentiment"),
        F.col("stated_reason").alias("to_reason"),
        "previous_promise_missed_raw",
    )
    back = earlier.select(
        "borrower_id",
        F.col("transcript_sequence_number").alias("from_seq"),
        F.col("interaction_id").alias("from_interaction_id"),
        F.col("sentiment").alias("from_sentiment"),
        F.col("promise_to_pay_amount").alias("from_ptp_amount"),
        F.col("stated_reason").alias("from_reason"),
    )
    return to.join(merged(back), ["borrower_id", "from_seq"])


def describe_pairs(pairs: DataFrame) -> DataFrame:
    before, after = mood("from_sentiment"), mood("to_sentiment")
    return (
        pairs.withColumn(
            "sentiment_direction", pick([(after > before, "IMPROVING"), (after < before, "DETERIORATING")], "STABLE")
        )
        .withColumn("ptp_was_made_on_prior_call", F.coalesce(F.col("from_ptp_amount") != "None", F.lit(False)))
        .withColumn("ptp_flagged_missed_on_this_call", F.col("previous_promise_missed_raw").ilike("%yes%"))
        .withColumns({"_a": reason_words("from_reason"), "_b": reason_words("to_reason")})
        .withColumn("reason_changed", reasons_differ("from_reason", "to_reason", F.col("_a"), F.col("_b")))
        .select(*TRANSITION_COLUMNS)
    )


def call_transitions(scored: DataFrame, only_ids: DataFrame | None = None) -> DataFrame:
    """Transitions of all calls, or only of pairs that a listed interaction takes part in.

    Both sides of a pair are tried, so a call that arrives late still gets its pair with the
    call after it.
    """
    if only_ids is None:
        return describe_pairs(pair_calls(scored, scored))
    fresh = scored.join(only_ids.select("interaction_id").distinct(), "interaction_id", "left_semi")
    arriving = pair_calls(fresh, scored)
    followed = pair_calls(scored, fresh)
    return describe_pairs(arriving.unionByName(followed).dropDuplicates(["from_interaction_id", "to_interaction_id"]))


def lag_pairs(scored: DataFrame, slice_size: int = 1024) -> DataFrame:
    """Pairs by position instead of by number; equal to ``call_transitions`` while numbers
    have no gaps.

    The calls of a borrower are cut into slices of the sequence, so that a borrower with
    very many calls is not one task; the last call of a slice is handed to the next one.
    """
    seq = F.col("transcript_sequence_number")
    sliced = scored.select(
        "borrower_id", "interaction_id", "sentiment", "transcript_sequence_number"
    ).withColumn("_slice", F.floor(seq / slice_size))
    # The number of a slice's last call first, its fields by a join: a number needs no sorted rows.
    last = sliced.groupBy("borrower_id", "_slice").agg(F.max("transcript_sequence_number").alias("transcript_sequence_number"))
    fields = sliced.select("borrower_id", "transcript_sequence_number", F.struct("interaction_id", "sentiment").alias("_last"))
    last = last.join(merged(fields), ["borrower_id", "transcript_sequence_number"])
    along = W.partitionBy("borrower_id").orderBy("_slice")
    handed = last.select("borrower_id", "_slice", F.lag("_last").over(along).alias("_handed"))
    inside = W.partitionBy("borrower_id", "_slice").orderBy("transcript_sequence_number")
    before = F.coalesce(F.lag(F.struct("interaction_id", "sentiment")).over(inside), F.col("_handed"))
    return (
        sliced.join(merged(handed), ["borrower_id", "_slice"], "left")
        .withColumn("_before", before)
        .filter(F.col("_before").isNotNull())
        .select(
            "borrower_id",
            F.col("_before.interaction_id").alias("from_interaction_id"),
            F.col("interaction_id").alias("to_interaction_id"),
            F.col("_before.sentiment").alias("from_sentiment"),
            F.col("sentiment").alias("to_sentiment"),
        )
    )


#: Sentiments as numbers, so that extremes are kept in fixed-width buffers and no rows are sorted for them.
MOODS = ["positive", "neutral", "mixed", "negative"]


def mood_code(sentiment) -> Column:
    return lookup(sentiment, {name: i for i, name in enumerate(MOODS, 1)}, None)


def mood_name(code: str) -> Column:
    return F.get(F.array(*map(F.lit, MOODS)), F.col(code) - 1)


# --- summaries that can be merged ----------------------------------------------------------
# One row per borrower, from any set of calls and the pairs among them.  Two of them add up to the summary of both
# sets, in any order and grouping, and so a batch costs its own calls and the stored row.
_CALL_SUMS, _PAIR_SUMS = ["n_calls"], ["n_transitions", "n_broken", "n_reason_changes", "n_reason_comparisons_possible"]


def call_summary(scored: DataFrame) -> DataFrame:
    seq = F.col("transcript_sequence_number")
    told = scored.withColumn("_mood", mood_code("sentiment"))
    return told.groupBy("borrower_id").agg(
        F.count("*").alias("n_calls"),
        F.min(seq).alias("first_seq"),
        F.min_by("_mood", seq).alias("first_mood"),
        F.max(seq).alias("last_seq"),
        F.max_by("_mood", seq).alias("last_mood"),
        F.min("contact_date").alias("first_contact_date"),
        F.max("contact_date").alias("last_contact_date"),
    )


def pair_summary(transitions: DataFrame) -> DataFrame:
    broken = F.col("ptp_was_made_on_prior_call") & F.col("ptp_flagged_missed_on_this_call")
    return transitions.groupBy("borrower_id").agg(
        F.min("from_seq").alias("first_gap_seq"),
        F.min_by("days_gap", "from_seq").alias("first_gap"),
        F.max("from_seq").alias("last_gap_seq"),
        F.max_by("days_gap", "from_seq").alias("last_gap"),
        F.count("*").alias("n_transitions"),
        F.count_if(broken).alias("n_broken"),
        F.count_if("reason_changed").alias("n_reason_changes"),
        F.count("reason_changed").alias("n_reason_comparisons_possible"),
    )


def partial_summary(scored: DataFrame, transitions: DataFrame) -> DataFrame:
    """The summary of some calls and of the pairs that they complete."""
    none = F.lit(0).cast("bigint")
    joined = call_summary(scored).join(merged(pair_summary(transitions)), "borrower_id", "left")
    return joined.withColumns({c: F.coalesce(c, none) for c in _PAIR_SUMS})


def merged_summaries(one: DataFrame, other: DataFrame) -> DataFrame:
    """Sums add up, extremes compare; a gap without a pair has no number and gives way."""
    return one.unionByName(other).groupBy("borrower_id").agg(
        *[F.sum(c).alias(c) for c in _CALL_SUMS + _PAIR_SUMS],
        F.min("first_seq").alias("first_seq"),
        F.min_by("first_mood", "first_seq").alias("first_mood"),
        F.max("last_seq").alias("last_seq"),
        F.max_by("last_mood", "last_seq").alias("last_mood"),
        F.min("first_contact_date").alias("first_contact_date"),
        F.max("last_contact_date").alias("last_contact_date"),
        F.min("first_gap_seq").alias("first_gap_seq"),
        F.min_by("first_gap", "first_gap_seq").alias("first_gap"),
        F.max("last_gap_seq").alias("last_gap_seq"),
        F.max_by("last_gap", "last_gap_seq").alias("last_gap"),
    ).select(*one.columns)


def first_last(scored: DataFrame) -> DataFrame:
    return call_summary(scored).select(
        "borrower_id", mood_name("first_mood").alias("first_sentiment"), mood_name("last_mood").alias("last_sentiment"),
        "n_calls", "first_contact_date", "last_contact_date",
    )


def overall_direction(first, last) -> Column:
    first, last = F.col(first), F.col(last)
    return pick(
        [
            (first == last, "STABLE"),
            ((last == "positive") & first.isin("negative", "mixed"), "IMPROVING"),
            ((last == "negative") & first.isin("positive", "mixed", "neutral"), "DETERIORATING"),
        ],
        "MIXED",
    )


def gap_trend() -> Column:
    many = F.col("n_transitions") >= 2
    return pick(
        [
            (many & (F.col("last_gap") > F.col("first_gap")), "WIDENING"),
            (many & (F.col("last_gap") < F.col("first_gap")), "NARROWING"),
            (many, "STABLE"),
        ],
        SINGLE_INTERVAL,
    )


def trajectory_rows(summary: DataFrame) -> DataFrame:
    """What is published of a summary."""
    named = summary.withColumns({"first_sentiment": mood_name("first_mood"), "last_sentiment": mood_name("last_mood")})
    return named.select(
        "borrower_id",
        "n_calls",
        "first_sentiment",
        "last_sentiment",
        overall_direction("first_sentiment", "last_sentiment").alias("overall_sentiment_direction"),
        "first_contact_date",
        "last_contact_date",
        (F.col("n_broken") > 0).alias("any_ptp_made_then_missed"),
        (F.col("n_reason_changes") > 0).alias("any_reason_change"),
        # Without any pair there was nothing to compare: not known, rather than none.
        F.when(F.col("n_transitions") > 0, F.col("n_reason_comparisons_possible")).alias("n_reason_comparisons_possible"),
        gap_trend().alias("days_gap_trend"),
    )


def trajectory_summary(scored: DataFrame, transitions: DataFrame) -> DataFrame:
    return trajectory_rows(partial_summary(scored, transitions))
