"""Benchmark passages in documents, by a positional inverted index of the documents.

DataFrame functions only.  A window is ``size`` consecutive words of a benchmark item (an item of
fewer words is one window).

1. One pass counts how often each benchmark term occurs in all documents.
2. Each window takes its rarest terms as anchors; a window with a term that never occurs is out.
3. One pass stores the postings ``term, doc_id, pos`` of the anchors.
4. The postings, less the anchor's offset in its window, are the starts at which the window may
   lie.  Starts that every anchor of the window gives are the intersection of its lists.
5. What the intersection leaves is compared word for word with the documents.

The benchmark side is broadcast only while its counted rows are few; beyond that the same joins
shuffle, and adaptive execution splits frequent terms.

Defined cases: null texts and texts without words hold nothing; items without an id are left
out; rows that repeat a ``doc_id`` are one document each in the counts of words, and share the
hits of their id; a document without ``doc_id`` is returned without hits; an empty benchmark or
document table gives no hits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerloom.llm.common import id_and_text, stored

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ANCHORS = 2  # lists that are intersected for each window
BROADCAST_ROWS = 200_000  # of short rows, some 20 MB


def few(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """With a broadcast hint if it has few rows; ``df`` is a stored table."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def _pieces(docs: DataFrame, id_col: str) -> DataFrame:
    """``pieces`` are the words, behind an empty one (``lead``) where the text begins with a
    separator, before an empty one (``tail``) where it ends with one."""
    lowered = F.translate("text", UPPER, LOWER)
    return docs.filter("text <> ''").select(
        F.col(id_col),
        F.split(lowered, SEPARATORS + "+").alias("pieces"),
        F.col("text").rlike("^" + _raw_separators()).cast("int").alias("lead"),
        F.substring("text", -1, 1).rlike(_raw_separators()).cast("int").alias("tail"),
    )


def _raw_separators() -> str:
    """In a text that is not lower-cased, A-Z are letters."""
    return r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"


def _counted(pieces: DataFrame) -> Column:
    return (F.size("pieces") - F.col("lead") - F.col("tail")).cast("bigint")


def _tokens(docs: DataFrame) -> DataFrame:
    """``doc_id, pos, term`` for every word; ``pos`` counts from 0."""
    pieces = _pieces(docs.filter("doc_id is not null"), "doc_id")
    exploded = pieces.select("doc_id", "lead", F.posexplode("pieces").alias("p", "term"))
    return exploded.select("doc_id", (F.col("p") - F.col("lead")).alias("pos"), "term")


def windows(benchmark: DataFrame, size: int) -> DataFrame:
    """``item_id, window, phrase, words``: each item's distinct windows."""
    pieces = _pieces(id_and_text(benchmark, "item_id").filter("item_id is not null"), "item_id")
    words = pieces.select("item_id", F.filter("pieces", lambda x: x != "").alias("words")).filter("size(words) > 0")
    starts = F.explode(F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("words") - size + 1))).alias("at")
    cut = words.select("item_id", "words", starts).select("item_id", F.slice("words", F.col("at"), size).alias("words"))
    phrase = F.array_join("words", " ")
    return cut.select("item_id", F.xxhash64(phrase).alias("window"), phrase.alias("phrase"), "words").dropDuplicates(
        ["item_id", "phrase"]
    )


def _anchors(phrases: DataFrame, frequencies: DataFrame, n: int) -> DataFrame:
    """``window, term, offset, place``: each window's rarest places, rarest first."""
    places = phrases.select("window", F.size("words").alias("size"), F.posexplode("words").alias("offset", "term"))
    known = places.join(frequencies, "term")
    own = W.partitionBy("window")
    ranked = known.withColumn("place", F.row_number().over(own.orderBy("frequency", "term", "offset")))
    whole = ranked.withColumn("known", F.count("*").over(own)).filter("known >= size")
    return whole.filter(F.col("place") <= n).select("window", "term", "offset", "place")


def phrase_matches(docs: DataFrame, benchmark: DataFrame, size: int = 10, anchors: int = ANCHORS) -> DataFrame:
    """``doc_id, item_id, start, length`` for each occurrence of an item's window."""
    docs = id_and_text(docs)
    of_items = stored(windows(benchmark, size), "windows")
    phrases = of_items.select("window", "phrase", "words").dropDuplicates(["phrase"])
    terms = few(stored(phrases.select(F.explode("words").alias("term")).distinct(), "terms"))
    tokens = _tokens(docs)
    counted = tokens.join(terms, "term").groupBy("term").agg(F.count("*").alias("frequency"))
    frequencies = stored(counted, "frequencies")
    chosen = few(stored(_anchors(phrases, frequencies, anchors), "anchors"))
    anchor_terms = few(stored(chosen.select("term").distinct(), "anchor-terms"))
    postings = stored(tokens.join(anchor_terms, "term"), "postings")

    starts = postings.join(chosen, "term").select(
        "window", "doc_id", (F.col("pos") - F.col("offset")).alias("start"), F.expr("shiftleft(1, place - 1)").alias("bit")
    )
    wanted = few(stored(chosen.groupBy("window").agg(F.count("*").alias("n")), "wanted"))
    common = starts.filter("start >= 0").groupBy("window", "doc_id", "start").agg(F.bit_or("bit").alias("bits"))
    candidates = common.join(wanted, "window").filter("bit_count(bits) >= n")
    candidates = stored(candidates.select("window", "doc_id", "start"), "candidates")

    # Word for word, in the documents that still have candidates.
    asked = few(stored(candidates.select("doc_id").distinct(), "candidate-documents"), 1_000_000)
    pieces = _pieces(docs.join(asked, "doc_id", "left_semi"), "doc_id")
    phrase_rows = few(stored(phrases.select("window", "phrase", F.size("words").alias("length")), "phrases"))
    open_pairs = candidates.join(phrase_rows, "window").groupBy("doc_id", "start").agg(
        F.collect_set(F.struct("window", "phrase", "length")).alias("asked")
    )
    per_document = open_pairs.groupBy("doc_id").agg(F.collect_list(F.struct("start", "asked")).alias("asked"))
    held = per_document.join(pieces, "doc_id").select("doc_id", "pieces", "lead", F.explode("asked").alias("at"))
    held = held.select("doc_id", "pieces", "lead", F.col("at.start").alias("start"), F.explode("at.asked").alias("w"))
    there = F.array_join(F.slice("pieces", F.col("start") + F.col("lead") + 1, F.col("w.length")), " ")
    exact = held.filter(there == F.col("w.phrase")).select("doc_id", "start", F.col("w.phrase").alias("phrase"), F.col("w.length").alias("length"))
    owners = few(stored(of_items.select("phrase", "item_id"), "owners"))
    return exact.distinct().join(owners, "phrase").select("doc_id", "item_id", "start", "length")


def near_matches(docs: DataFrame, benchmark: DataFrame, terms: int = 3, within: int = 20) -> DataFrame:
    """``doc_id, item_id, start``: places where an item's ``terms`` rarest different words lie, in
    any order, within ``within`` words; an item with fewer known words has no place."""
    items = stored(windows(benchmark, 1).select("item_id", F.col("phrase").alias("term")).distinct(), "items")
    wanted = few(stored(items.select("term").distinct(), "terms"))
    tokens = _tokens(id_and_text(docs))
    frequencies = stored(tokens.join(wanted, "term").groupBy("term").agg(F.count("*").alias("frequency")), "frequencies")
    own = W.partitionBy("item_id").orderBy("frequency", "term")
    rare = items.join(frequencies, "term").withColumn("place", F.row_number().over(own)).filter(F.col("place") <= terms)
    rare = few(stored(rare.select("item_id", "term"), "rare"))
    postings = tokens.join(rare, "term")
    ahead = W.partitionBy("doc_id", "item_id").orderBy("pos").rangeBetween(0, within - 1)
    counted = postings.withColumn("near", F.size(F.collect_set("term").over(ahead)))
    return counted.filter(F.col("near") >= terms).select("doc_id", "item_id", F.col("pos").alias("start"))


def contamination(docs: DataFrame, benchmark: DataFrame, size: int = 10) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_hit, item_ids, contaminated``."""
    docs = id_and_text(docs)
    found = stored(phrase_matches(docs, benchmark, size), "matches")
    spans = found.select("doc_id", "start", "length").distinct()
    covered = spans.select("doc_id", F.explode(F.expr("sequence(start, start + length - 1)")).alias("pos")).distinct()
    hits = covered.groupBy("doc_id").agg(F.count("*").alias("n_hit"))
    items = found.groupBy("doc_id").agg(F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("item_ids"))
    counted = _pieces(docs, "doc_id")
    counted = counted.select("doc_id", _counted(counted).alias("n_words")).unionByName(
        docs.filter("text is null or text = ''").select("doc_id", F.lit(0).cast("bigint").alias("n_words"))
    )
    both = counted.join(hits.join(items, "doc_id"), "doc_id", "left")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("bigint"))
    return both.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
        (n_hit > 0).alias("contaminated"),
    )
