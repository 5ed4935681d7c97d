"""The calls heard so far as runs of consecutive numbers, so that new calls need no history.

A run keeps the fields of its first and of its last call that pairing needs.  A call with a number inside a
run is a repeat.  Of all others, only the ends of runs can be next to a new call: a new call extends
a run, joins two, or starts one.  While calls arrive in order a borrower has one run, however many calls
that is; a gap in the numbers costs one more run until it is filled.  Since a pair is two calls with consecutive
numbers, a late call completes pairs and never splits one, and the runs of two sets of calls give those of
both in whatever order they come together.

A borrower's number names one call; calls without borrower or number do not enter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerloom.operators.trajectory import describe_pairs, pair_calls

END_FIELDS = [
    "interaction_id", "total_sequence_length", "days_since_previous_contact", "sentiment", "stated_reason",
    "promise_to_pay_amount", "previous_promise_missed_raw",
]
SLICE = 4096  # numbers of a borrower whose calls are joined by one task


def single_runs(calls: DataFrame) -> DataFrame:
    """``borrower_id, lo, hi, lo_call, hi_call``: each call as a run of its own."""
    fields, seq = F.struct(*END_FIELDS), F.col("transcript_sequence_number")
    return calls.select("borrower_id", seq.alias("lo"), seq.alias("hi"), fields.alias("lo_call"), fields.alias("hi_call"))


def numbered(calls: DataFrame) -> DataFrame:
    known = F.col("borrower_id").isNotNull() & F.col("transcript_sequence_number").isNotNull()
    return calls.filter(known).dropDuplicates(["borrower_id", "transcript_sequence_number"])


def unheard(calls: DataFrame, runs: DataFrame | None) -> DataFrame:
    """Calls that lie in no run, each number once."""
    calls = numbered(calls)
    if runs is None:
        return calls
    r = runs.select(F.col("borrower_id").alias("_b"), "lo", "hi")
    seq = F.col("transcript_sequence_number")
    return calls.join(r, (F.col("borrower_id") == F.col("_b")) & (seq >= F.col("lo")) & (seq <= F.col("hi")), "left_anti")


def _ends(runs: DataFrame, end: str) -> DataFrame:
    return runs.select("borrower_id", F.col(end).alias("transcript_sequence_number"), f"{end}_call.*")


def completed_pairs(nodes: DataFrame) -> DataFrame:
    """The pairs between the end of one run and the start of the next; by (borrower, number), which spreads a busy borrower."""
    return describe_pairs(pair_calls(_ends(nodes, "lo"), _ends(nodes, "hi")))


def _joined(runs: DataFrame, *keys) -> DataFrame:
    """Neighbouring runs of one key as one.  Of a chain of neighbours only its two ends are kept, next to each other."""
    order = W.partitionBy(*keys).orderBy("lo")
    starts = F.coalesce(F.lag("hi").over(order) + 1 != F.col("lo"), F.lit(True))
    ends = F.coalesce(F.lead("lo").over(order) - 1 != F.col("hi"), F.lit(True))
    borders = runs.withColumns({"_starts": starts, "_ends": ends}).filter("_starts OR _ends")
    last = {c: F.when(F.col("_ends"), F.col(c)).otherwise(F.lead(c).over(order)) for c in ("hi", "hi_call")}
    return borders.withColumns(last).filter("_starts").drop("_starts", "_ends")


def joined_runs(nodes: DataFrame) -> DataFrame:
    """Runs without neighbours.  First within slices of the numbers, so that a borrower with very many new calls
    is the work of many tasks; what is left of a slice without gaps is one run."""
    sliced = nodes.withColumn("_slice", F.floor(F.col("lo") / SLICE))
    return _joined(_joined(sliced, "borrower_id", "_slice").drop("_slice"), "borrower_id")
