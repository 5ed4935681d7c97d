"""Search for a text anywhere in borrowers' ids and names, by lists of who has which three characters.

A posting is a run of three characters, in lower case, and a borrower whose id or name holds it.  A search takes the rarest
runs of its text, intersects their lists, and compares what is left in full.  Texts without three
characters in a row, and texts with an escape character, are compared with every row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SIZE = 3
LISTS = 3  # that are intersected
FEW = 2_000  # candidates whose ids are handed to the scan, which then reads their row groups only
FIELDS = ("borrower_id", "full_name")


def _runs(text) -> Column:
    """The different runs of a text; none of a shorter one."""
    low = F.lower(text)
    starts = F.sequence(F.lit(1), F.greatest(F.length(low) - SIZE + 1, F.lit(1)))
    runs = F.transform(starts, lambda i: F.substring(low, i, F.lit(SIZE)))
    return F.array_distinct(F.filter(runs, lambda r: F.length(r) == SIZE))


def postings(rows: DataFrame) -> DataFrame:
    """``gram, borrower_id``, each once."""
    none = F.array().cast("array<string>")
    runs = F.array_union(*[F.coalesce(_runs(F.col(c)), none) for c in FIELDS])
    return rows.select(F.explode(runs).alias("gram"), "borrower_id")


def gram_counts(grams: DataFrame) -> DataFrame:
    return grams.groupBy("gram").agg(F.count("*").alias("n"))


def contains(text: str) -> Column:
    like = F.lit(f"%{text}%")
    return F.ilike(FIELDS[0], like) | F.ilike(FIELDS[1], like)


def rarest(counts: DataFrame, text: str) -> list[str] | None:
    """The rarest runs of the text's plain pieces, at most ``LISTS``; None without any.  A run that no one has
    makes the list empty."""
    spark = counts.sparkSession
    pieces = F.split(F.lit(text), "[%_]")
    asked = spark.range(1).select(F.explode(F.flatten(F.transform(pieces, _runs))).alias("gram")).distinct()
    runs = [r["gram"] for r in asked.collect()]  # as many as the text has characters
    if not runs or "\\" in text:
        return None
    known = {r["gram"]: r["n"] for r in counts.filter(F.col("gram").isin(runs)).collect()}
    return sorted(runs, key=lambda g: (known[g], g))[:LISTS] if len(known) == len(runs) else []


def holders(grams: DataFrame, runs: list[str]) -> DataFrame:
    """Borrowers in the lists of all the runs, starting from the rarest."""
    lists = [grams.filter(F.col("gram") == g).select("borrower_id") for g in runs]
    found = lists[0]
    for other in lists[1:]:
        found = found.join(other, "borrower_id", "left_semi")
    return found


def candidates(rows: DataFrame, grams: DataFrame, counts: DataFrame, text: str) -> DataFrame:
    """The rows that may hold the text; all rows if the lists cannot tell."""
    runs = rarest(counts, text)
    if runs is None:
        return rows
    if not runs:
        return rows.filter(F.lit(False))
    found = holders(grams, runs)
    few = [r[0] for r in found.limit(FEW + 1).collect()]
    if len(few) <= FEW:
        return rows.filter(F.col("borrower_id").isin(few)) if few else rows.filter(F.lit(False))
    return rows.join(found, "borrower_id", "left_semi")
