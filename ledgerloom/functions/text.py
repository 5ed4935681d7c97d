"""Deterministic reading of call transcripts with regular expressions only.

The word lists and patterns are our own; they honour the output contract of the
enrichment step (labels, field names, the word ``None`` for an absent field) and
make no claim to the accuracy of a language model.  Patterns keep to the subset
that Java and RE2 read alike, so the SQL checks use the very same strings.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloom.functions.columns import _col, pick

# --- fixed values: labels of the enrichment contract -------------------------
SENTIMENTS = ("positive", "negative", "mixed", "neutral")
INTENTS = (
    "genuine_hardship",
    "technical_issue_or_dispute",
    "payment_avoidance_pattern",
    "first_missed_payment_uncertain",
    "rate_shopping_balance_transfer",
    "relationship_or_growth_call",
)
FALLBACK_INTENT = "relationship_or_growth_call"
EXTRACT_FIELDS = (
    "promise_to_pay_amount",
    "promise_to_pay_date",
    "competitor_name_mentioned",
    "competitor_rate_mentioned",
    "stated_reason",
    "previous_promise_missed_raw",
)

# --- our word lists ------------------------------------------------------------
POSITIVE_WORDS = r"\b(thank|thanks|appreciate|grateful|happy|glad|pleased|helpful|great|relieved|good)\b"
NEGATIVE_WORDS = (
    r"\b(worried|upset|angry|frustrated|unfair|stressed|struggling|cannot|hospital|lost|"
    r"delayed|failed|bounced|harassing|slow|missed)\b"
)
INTENT_WORDS = {
    "genuine_hardship": r"\b(hospital|surgery|salary|factory|layoff|flood|medical|treatment|harvest)\b",
    "technical_issue_or_dispute": r"\b(bounced|mandate|auto-debit|bank server|technical|debited twice|branch portal)\b",
    "payment_avoidance_pattern": r"\b(next week|some problem|call later|not now|busy|will see|out of town)\b",
    "first_missed_payment_uncertain": r"\b(first time|forgot|not sure|slipped|embarrassed|confused)\b",
    "rate_shopping_balance_transfer": r"\b(lower rate|balance transfer|offering|competitor|foreclosure|switch)\b",
    "relationship_or_growth_call": r"\b(top-up|insurance|new loan|limit|upgrade|years with you|brochure)\b",
}
HARDSHIP_WORDS = r"\b(hospital|surgery|salary|factory|layoff|flood|medical|treatment|harvest)\b"
CONCRETE_DETAIL = r"(rs [0-9][0-9,]*|\b[0-9]{1,2} (january|february|march|april)\b|[0-9]+ (days|weeks|months))"

PROMISE_AMOUNT = r"(?i)i (?:will|can|shall) pay rs ([0-9][0-9,]*)"
PROMISE_DATE = r"(?i)pay rs [0-9][0-9,]* (?:by|on|before) ([0-9]{1,2} [A-Za-z]+)"
COMPETITOR_NAME = r"([A-Z][a-z]+ (?:Bank|Finance|Capital)) is offering"
COMPETITOR_RATE = r"is offering (?:me )?([0-9]+(?:\.[0-9]+)?) ?(?:percent|%)"
STATED_REASON = r"(?i)because ([^.\n]+)"
PROMISE_MISSED = r"(?i)(?:missed|broke|did not keep) (?:my|the) (?:last|previous|earlier) (?:promise|commitment)"
PROMISE_KEPT = r"(?i)kept (?:my|the) (?:last|previous|earlier) (?:promise|commitment)"

# Reasons are compared as sets of the words that carry meaning.
REASON_NOISE = ("a", "an", "and", "at", "for", "i", "in", "is", "it", "my", "of", "the", "this", "to", "was")
# Two reasons are the same when shared words make up at least half of all words.
SAME_REASON_NUM, SAME_REASON_DEN = 1, 2


def _hits(text, pattern: str) -> Column:
    return F.regexp_count(F.lower(_col(text)), F.lit(pattern))


def _has(text, pattern: str) -> Column:
    return F.lower(_col(text)).rlike(pattern)


def sentiment(text) -> Column:
    """Each word list is tried once: its two answers index the label."""
    index = _has(text, POSITIVE_WORDS).cast("int") + _has(text, NEGATIVE_WORDS).cast("int") * 2
    return F.get(F.array(*[F.lit(s) for s in ("neutral", "positive", "negative", "mixed")]), index)


def intent(text) -> Column:
    """Label with most keyword hits; earlier labels win ties, none at all falls back.

    The greatest (hits, priority, label) struct, so every keyword list is counted once.
    The fallback has no hits but outranks any label that has none either.
    """
    entries = [
        F.struct(
            _hits(text, INTENT_WORDS[label]).alias("hits"), F.lit(-i).alias("priority"), F.lit(label).alias("label")
        )
        for i, label in enumerate(INTENTS)
    ]
    fallback = F.struct(
        F.lit(0).alias("hits"), F.lit(1).alias("priority"), F.lit(FALLBACK_INTENT).alias("label")
    )
    return F.when(_col(text).isNotNull(), F.array_max(F.array(*entries, fallback))["label"])


def credible_hardship(text) -> Column:
    """A hardship word together with an amount, a date or a duration."""
    return _has(text, HARDSHIP_WORDS) & _has(text, CONCRETE_DETAIL)


def _field(text, pattern: str) -> Column:
    found = F.nullif(F.trim(F.regexp_extract(_col(text), pattern, 1)), F.lit(""))
    return F.coalesce(found, F.lit("None"))


def extract_struct(text) -> Column:
    missed = pick(
        [(_col(text).rlike(PROMISE_MISSED), "yes"), (_col(text).rlike(PROMISE_KEPT), "no")], "None"
    )
    return F.struct(
        F.regexp_replace(_field(text, PROMISE_AMOUNT), ",", "").alias("promise_to_pay_amount"),
        _field(text, PROMISE_DATE).alias("promise_to_pay_date"),
        _field(text, COMPETITOR_NAME).alias("competitor_name_mentioned"),
        _field(text, COMPETITOR_RATE).alias("competitor_rate_mentioned"),
        _field(text, STATED_REASON).alias("stated_reason"),
        missed.alias("previous_promise_missed_raw"),
    )


def reason_words(text) -> Column:
    plain = F.trim(F.regexp_replace(F.lower(_col(text)), "[^a-z0-9]+", " "))
    words = F.array_distinct(F.split(plain, " "))
    return F.array_except(words, F.array(*[F.lit(w) for w in (*REASON_NOISE, "")]))


def reasons_differ(first, second, first_words: Column, second_words: Column) -> Column:
    """TRUE/FALSE for two given reasons, NULL when either is missing or holds no word that
    could be compared (one in another script, say)."""
    shared = F.size(F.array_intersect(first_words, second_words))
    total = F.size(F.array_union(first_words, second_words))
    given = _present(first) & _present(second) & (F.size(first_words) > 0) & (F.size(second_words) > 0)
    return F.when(given, shared * SAME_REASON_DEN < total * SAME_REASON_NUM)


def _present(text) -> Column:
    return F.coalesce((_col(text) != "None"), F.lit(False))
