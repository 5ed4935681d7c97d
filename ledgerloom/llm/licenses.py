"""Licence notices in documents, by the Dice coefficient over word bigrams.

DataFrame functions only.  A document's units are its lines, its sentences (cut at line ends,
and not), and all runs of consecutive lines, so also paragraphs and whole texts; a run has at most (2 - t) / t times the template's words.  Units and templates
are normalised alike: A-Z lower-cased, everything but letters and digits taken as white space.
With a and b different bigrams and c common ones, the coefficient is 2 c / (a + b), so it can reach
t only if c is at least t b / (2 - t).  So of any b - c + 1 of the template's bigrams a text holds one:
those with the longest words give each template its anchors, and a text is read on only if it holds an
anchor of a template that it is long enough for.  An inverted index of bigrams then leaves the texts that
share so many with a template, and gives the places of its bigrams in texts of several lines.  A run is read
only from a line from which so many places lie within the run's greatest length; it meets the text by
blocks of words, so a long text costs no more than its length.

Defined cases: null and empty texts hold nothing; a unit of one word has no bigrams; units that
occur more than once in a document count once; rows that repeat a ``doc_id`` are scanned as one
document; rows without an id are left out; an empty document or template table gives no findings.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerloom.llm.common import id_and_text, stored
from ledgerloom.llm.decontaminate import LOWER, SEPARATORS, UPPER, few
from ledgerloom.llm.license_texts import texts

#: Least coefficient of a finding.
DICE = 0.8
#: Where a text is cut into units: at line ends, and behind a full stop, question or exclamation mark.
LINES, SENTENCES = r"[\n\r]+", r"[\n\r]+|[.!?][ \t]+"

BLOCK = 128  # words
ANCHORS = 20_000  # words that are sent with the tasks
SIZES = [0, 16, 128, 1024]  # templates of like size share a test for anchors

#: Sentences over line ends; a blank line ends one.
WRAPPED = r"[.!?][ \t\n\r]+|\r?\n[ \t]*\r?\n"

# Notices by which texts name their licence.
TEMPLATES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the terms of the MIT license."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is licensed under the GNU General Public License, version 3 or later."),
    ("GPL-2.0", "This program is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related rights to this work."),
]


def templates(spark: SparkSession) -> DataFrame:
    return _table(spark, TEMPLATES)


def all_templates(spark: SparkSession) -> DataFrame:
    """The notices, and whole texts and headers."""
    return _table(spark, [*TEMPLATES, *texts()])


def _table(spark: SparkSession, known: list[tuple[str, str]]) -> DataFrame:
    rows = F.array(*(F.struct(F.lit(name).alias("license"), F.lit(text).alias("text")) for name, text in known))
    return spark.range(1).select(F.inline(rows))


def _pieces(text: Column) -> Column:
    """Words, and an empty one where the text begins or ends with separators.  ``lower`` changes A-Z only if all is ASCII."""
    lowered = F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
    return F.split(lowered, SEPARATORS + "+")


def _words(text: Column) -> Column:
    return F.filter(_pieces(text), lambda w: w != "")


def _bigrams(words: str | Column) -> Column:
    n = F.greatest(F.size(words) - 1, F.lit(0))
    pairs = F.zip_with(F.slice(words, 1, n), F.slice(words, 2, n), lambda a, b: F.concat(a, F.lit(" "), b))
    return F.array_distinct(pairs)


def find_licenses(docs: DataFrame, notices: DataFrame, least: float = DICE) -> DataFrame:
    """``doc_id, license, dice``: the best coefficient of each licence found in a document."""
    share = least / (2 - least)
    known = notices.filter("license is not null").select("license", _words(F.col("text")).alias("words")).filter("size(words) > 1")
    known = known.select("license", F.size("words").alias("n"), F.xxhash64(F.array_join("words", " ")).alias("template"), _bigrams("words").alias("bigrams"))
    known = stored(known.dropDuplicates(["license", "template"]).withColumn("b", F.size("bigrams")), "templates")
    names = few(stored(known.select("license", "template"), "template-names"))
    own = known.select("template", "b", "n", "bigrams").dropDuplicates(["template"])
    need = F.ceil(share * F.col("b") - 1e-9).cast("int").alias("need")
    index = few(stored(own.select("template", "b", "n", need, F.explode("bigrams").alias("bigram")), "template-bigrams"))

    # A unit shares at least ``need`` bigrams with its template, so its text does.
    docs = id_and_text(docs).filter("doc_id is not null and text <> ''").withColumn("row", F.xxhash64("text"))
    held = docs.filter(_may_hold(stored(_anchors(index), "template-anchors")))
    held = stored(held.dropDuplicates(["doc_id", "row"]), "texts")
    paired = held.select("doc_id", "row", F.explode(_bigrams(_words(F.col("text")))).alias("bigram")).join(index, "bigram")
    may = paired.groupBy("doc_id", "row", "template", "need").agg(F.count("*").alias("c")).filter("c >= need")
    may = few(stored(may.select("doc_id", "row", "template"), "may-hold"))
    held = held.join(may.select("doc_id", "row").distinct(), ["doc_id", "row"], "left_semi")

    best = _of_units(held, index, least).unionByName(_of_runs(held, may, index, least))
    found = best.groupBy("doc_id", "template").agg(F.max("dice").alias("dice"))
    return found.join(names, "template").groupBy("doc_id", "license").agg(F.max("dice").alias("dice"))


def _anchors(index: DataFrame) -> DataFrame:
    """``word, template, need``: a text with ``need`` of a template's bigrams holds one of its anchors."""
    one, other = F.split("bigram", " ")[0], F.split("bigram", " ")[1]
    longer = F.when(F.length(one) >= F.length(other), one).otherwise(other)
    ranked = index.withColumn("word", longer)
    rank = F.row_number().over(W.partitionBy("template").orderBy(F.length("word").desc(), "word", "bigram"))
    return ranked.withColumn("rank", rank).filter("rank <= b - need + 1").select("word", "template", "need").distinct()


def _may_hold(anchors: DataFrame) -> Column:
    """Whether a text holds an anchor of templates that it has words enough for; more than ``ANCHORS`` rule out nothing."""
    known = anchors.limit(ANCHORS + 1).collect()
    if len(known) > ANCHORS:
        return F.lit(True)
    tiers = [(low, sorted({r["word"] for r in known if low <= r["need"] < high})) for low, high in zip(SIZES, [*SIZES[1:], float("inf")])]

    def tests(pieces: Column) -> Column:
        found = F.lit(False)
        for low, words in tiers:
            if words:
                found |= (F.size(pieces) > low) & F.arrays_overlap(pieces, F.array(*map(F.lit, words)))
        return found

    return F.exists(F.array(_pieces(F.col("text"))), tests)  # cuts a text once for all tests


def _of_units(held: DataFrame, index: DataFrame, least: float) -> DataFrame:
    """``doc_id, template, dice`` of lines and of sentences, also wrapped ones, however many words they repeat."""
    text = F.col("text")
    units = held.select("doc_id", F.explode(F.array_union(F.array_union(F.split(text, LINES), F.split(text, SENTENCES)), F.split(text, WRAPPED))).alias("unit"))
    counted = units.select("doc_id", F.xxhash64("unit").alias("unit"), _bigrams(_words(F.col("unit"))).alias("bigrams"))
    counted = counted.withColumn("a", F.size("bigrams")).filter("a > 0").dropDuplicates(["doc_id", "unit"])
    met = counted.select("doc_id", "unit", "a", F.explode("bigrams").alias("bigram")).join(index, "bigram")
    met = met.filter((F.col("a") >= F.col("b") * least / (2 - least)) & (F.col("a") <= F.col("b") * (2 - least) / least))
    common = met.groupBy("doc_id", "unit", "a", "template", "b").agg(F.count("*").alias("c"))
    dice = 2 * F.col("c") / (F.col("a") + F.col("b"))
    return common.withColumn("dice", dice).filter(F.col("dice") >= least).select("doc_id", "template", "dice")


def _places(held: DataFrame) -> DataFrame:
    """``doc_id, row, p, bigram, k, end, first`` for every two words in a row: where they stand, the lines
    of both, and where the first one's line begins."""
    words = F.flatten(
        F.transform(F.split("text", LINES), lambda x, k: F.transform(_words(x), lambda w, i: F.struct(w.alias("word"), k.alias("k"), i.alias("i"))))
    )
    n = F.greatest(F.size("words") - 1, F.lit(0))
    pair = lambda x, y: F.struct(F.concat(x["word"], F.lit(" "), y["word"]).alias("bigram"), x["k"].alias("k"), y["k"].alias("end"), x["i"].alias("i"))
    pairs = F.zip_with(F.slice("words", 1, n), F.slice("words", 2, n), pair)
    placed = held.select("doc_id", "row", words.alias("words")).select("doc_id", "row", F.posexplode(pairs).alias("p", "pair"))
    return placed.select("doc_id", "row", "p", "pair.bigram", "pair.k", "pair.end", (F.col("p") - F.col("pair.i")).alias("first"))


def _of_runs(held: DataFrame, may: DataFrame, index: DataFrame, least: float) -> DataFrame:
    """``doc_id, template, dice`` of runs of lines.  The best run begins in a line in which one
    of the template's bigrams begins: without another first line it would be no worse."""
    text = ["doc_id", "row"]
    held = held.filter(F.col("text").rlike(LINES))  # one line is a unit
    hits = _places(held).join(index, "bigram").join(may, [*text, "template"], "left_semi").drop("bigram", "end")
    hits = hits.withColumn("most", F.floor(F.col("n") * (2 - least) / least + 1e-9).cast("int"))
    # From a line's first hit the ``need``-th must lie in the longest run.
    hits = hits.withColumn("r", F.row_number().over(W.partitionBy(*text, "template").orderBy("p")))
    lines = hits.groupBy(*text, "template", "b", "most", "need", "k", "first").agg(F.min("r").alias("r"))
    reached = hits.select(*text, "template", F.col("r").alias("reached"), F.col("p").alias("at"))
    lines = lines.withColumn("reached", F.col("r") + F.col("need") - 1).join(reached, [*text, "template", "reached"])
    starts = lines.filter("at < first + most - 1").select(*text, "template", "b", "most", F.col("k").alias("start"), "first")
    starts = stored(starts, "starts")

    # A bigram counts in a run unless the run holds its last occurrence too.
    placed = _places(held.join(starts.select(*text).distinct(), text, "left_semi")).withColumn("key", F.xxhash64("bigram"))
    placed = placed.select(*text, "p", "key", "k", "end").withColumn("last", F.lag("k").over(W.partitionBy(*text, "key").orderBy("p")))
    placed = placed.withColumn("block", F.expr(f"p div {BLOCK}"))
    blocks = F.sequence(F.expr(f"first div {BLOCK}"), F.expr(f"(first + most - 1) div {BLOCK}"))
    ahead = placed.drop("k").join(starts.withColumn("block", F.explode(blocks)), [*text, "block"])
    ahead = ahead.filter("p between first and first + most - 1 and (last is null or last < start or p = first + most - 1)")
    ahead = ahead.withColumn("new", F.expr("int(last is null or last < start)"))
    mine = index.select("template", F.xxhash64("bigram").alias("key"), F.lit(1).alias("mine"))
    ends = ahead.join(mine, ["template", "key"], "left").groupBy(*text, "template", "b", "most", "start", "first", "end")
    ends = ends.agg(F.sum("new").alias("a"), F.sum(F.col("new") * F.coalesce("mine", F.lit(0))).alias("c"), F.max("p").alias("p"))
    so_far = W.partitionBy(*text, "template", "start").orderBy("end").rowsBetween(W.unboundedPreceding, 0)
    runs = ends.withColumn("a", F.sum("a").over(so_far)).withColumn("c", F.sum("c").over(so_far)).filter("p < first + most - 1")
    return runs.withColumn("dice", 2 * F.col("c") / (F.col("a") + F.col("b"))).filter(F.col("dice") >= least).select("doc_id", "template", "dice")


def license_report(docs: DataFrame, notices: DataFrame, least: float = DICE) -> DataFrame:
    """One row per id: ``doc_id, n_licenses, licenses, best_dice``; null without a finding."""
    found = find_licenses(docs, notices, least).groupBy("doc_id").agg(
        F.count("*").alias("n"), F.array_join(F.array_sort(F.collect_set("license")), ",").alias("licenses"), F.max("dice").alias("best_dice")
    )
    ids = docs.select(F.col("doc_id").cast("bigint").alias("doc_id")).filter("doc_id is not null").distinct()
    n = F.coalesce("n", F.lit(0).cast("bigint")).alias("n_licenses")
    return ids.join(found, "doc_id", "left").select("doc_id", n, F.coalesce("licenses", F.lit("")).alias("licenses"), "best_dice")
