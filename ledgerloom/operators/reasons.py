"""Stated reasons of any script compared by a weighted cosine.

A reason's words are runs of letters, marks and digits of any script, each once.  A word weighs more the
fewer reasons hold it; weights are whole numbers, so sums do not depend on their order.  Equal reasons are
one row with their number before anything is joined.

Defined cases.  A reason that is NULL, ``None`` or without word is not compared: its similarity and its
``reason_changed`` are NULL.  A reason that was not counted weighs its unknown words as if no reason held them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = r"[\p{L}\p{M}\p{N}]+"
SCALE = 1000  # of weights and similarities
SAME_FROM = 500  # thousandths of similarity from which two reasons are the same


def words(text) -> Column:
    """The different words of a reason, in lower case; NULL if there is nothing to compare."""
    found = F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(WORD), 0))
    return F.when((F.col(text) != "None") & (F.size(found) > 0), found)


def counted(reasons: DataFrame, column: str) -> DataFrame:
    """Different reasons that can be compared: ``reason, n, words``."""
    return (
        reasons.groupBy(F.col(column).alias("reason"))
        .agg(F.count("*").alias("n"))
        .withColumn("words", words("reason"))
        .filter("words IS NOT NULL")
    )


def frequencies(counts: DataFrame) -> DataFrame:
    """``word, held_by``: how many reasons, repeats counted, hold the word."""
    return counts.select("n", F.explode("words").alias("word")).groupBy("word").agg(F.sum("n").alias("held_by"))


def weighed(rows: DataFrame, held: DataFrame, total: DataFrame) -> DataFrame:
    """Rows with a ``word``, and the square of its weight; ``total`` is one row ``total``: how many reasons were counted."""
    rarity = F.log((F.col("total") + 1) / (F.coalesce("held_by", F.lit(0)) + 1))
    weight = (SCALE + F.round(SCALE * rarity)).cast("bigint")
    return (
        rows.join(held, "word", "left")
        .withColumn("total", total.select("total").scalar())
        .withColumn("square", weight * weight)
        .drop("held_by", "total")
    )


def similarity(pairs: DataFrame, held: DataFrame, total: DataFrame) -> DataFrame:
    """Different pairs ``from_reason, to_reason`` with ``similarity``, in thousandths.  Words are joined and
    summed as rows, so a long reason is many small rows."""
    key = ["from_reason", "to_reason"]
    pairs = pairs.select(*key).distinct().withColumns({"_a": words("from_reason"), "_b": words("to_reason")})
    pairs = pairs.filter("_a IS NOT NULL AND _b IS NOT NULL")
    told = pairs.select(F.explode(F.array(*key)).alias("reason")).distinct()
    told = told.select("reason", F.explode(words("reason")).alias("word"))
    norms = weighed(told, held, total).groupBy("reason").agg(F.sum("square").alias("norm"))
    shared = pairs.select(*key, F.explode(F.array_intersect("_a", "_b")).alias("word"))
    dots = weighed(shared, held, total).groupBy(*key).agg(F.sum("square").alias("dot"))
    a = norms.select(F.col("reason").alias("from_reason"), F.col("norm").alias("_na"))
    b = norms.select(F.col("reason").alias("to_reason"), F.col("norm").alias("_nb"))
    cosine = F.coalesce("dot", F.lit(0)) / (F.sqrt("_na") * F.sqrt("_nb"))
    return (
        pairs.select(*key).join(a, "from_reason").join(b, "to_reason").join(dots, key, "left")
        .select(*key, F.round(cosine * SCALE).cast("bigint").alias("similarity"))
    )


def compare_reasons(transitions: DataFrame, reasons: DataFrame, column: str = "stated_reason") -> DataFrame:
    """Transitions with the similarity of their two reasons, weighed by all ``reasons``."""
    counts = counted(reasons, column)
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total"))
    told = similarity(transitions, frequencies(counts), total)
    return transitions.join(told, ["from_reason", "to_reason"], "left").select(
        "borrower_id", "from_interaction_id", "to_interaction_id", "similarity",
        (F.col("similarity") < SAME_FROM).alias("reason_changed"),
    )
