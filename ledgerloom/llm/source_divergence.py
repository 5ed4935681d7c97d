"""How far the sources of a language differ in their words, with identical texts read once.

1. **Collapse.** Every task sends a text of a language once, with a digest, and for every source how often it
   met that text; later copies send numbers only.  Rows are dealt and sorted by language and digest,
   so all that is known of a text lies together, and a text that fills a third of the table costs
   one row a task.
2. **Read once.** Each different text is cut into terms once; its counts enter with the number of
   copies of each source: ``n_terms`` and ``n_documents`` of (lang, source, term), added up by Spark.
3. **Vocabulary.** A language keeps the terms that stand in at least ``MIN_DOCUMENTS`` documents.
4. **Sparse pairs.** A share ``p`` depends on a term through its count only.  Sources are joined on the
   terms that both hold; all other terms are in one of the sources or in neither, and enter through
   each source's table of counts (how many kept terms occur ``c`` times) and through the size of the vocabulary.

Texts of equal SHA-256 digests count as identical.  All arithmetic is on whole numbers.

Defined cases: null texts, languages and sources count as empty strings; a group without terms has
pairs, and no row of part ``term``; without kept terms all pairs are 0; a language with one source
has no pairs; repeated rows are documents of their own; texts of any length are read in one piece; an
empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerloom.llm.common import stored
from ledgerloom.llm.textblocks import raw_texts, slices, words_of

MIN_DOCUMENTS = 10
TOP_TERMS = 10
UNIT = 1_000_000_000
SALTS = 16

#: Bytes that part terms: all ASCII but letters.
SEPARATORS = np.array([b < 0x80 and not chr(b).isalpha() for b in range(256)])

COPIES = "lang string, digest binary, source string, n long, text string"


def collapse(docs: DataFrame) -> DataFrame:
    """``lang, digest, source, n, text``: of each task every text once, and ``n`` copies of a source."""

    def run(batches):
        sent: dict[tuple[str, bytes], bool] = {}
        copies: dict[tuple[str, bytes, str], int] = {}
        for batch in batches:
            langs, sources = batch.column("lang").to_pylist(), batch.column("source").to_pylist()
            new = []
            for i, (lang, source, text) in enumerate(zip(langs, sources, raw_texts(batch))):
                digest = hashlib.sha256(text).digest()
                if (lang, digest) in sent:
                    key = lang, digest, source
                    copies[key] = copies.get(key, 0) + 1
                else:
                    sent[lang, digest] = True
                    new.append((i, digest))
            if new:
                rows = batch.take(pa.array([i for i, _ in new]))
                digests = pa.array([d for _, d in new], pa.binary())
                one = pa.array(np.ones(len(new), np.int64))
                yield pa.RecordBatch.from_arrays(
                    [rows.column("lang"), digests, rows.column("source"), one, rows.column("text")],
                    names=["lang", "digest", "source", "n", "text"],
                )
        if copies:
            lang, digest, source = zip(*copies)
            yield pa.RecordBatch.from_arrays(
                [pa.array(lang), pa.array(digest, pa.binary()), pa.array(source), pa.array(list(copies.values())),
                 pa.nulls(len(lang), pa.string())],
                names=["lang", "digest", "source", "n", "text"],
            )

    named = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    return named.mapInArrow(run, COPIES)


def _codes(values: pa.Array) -> tuple[np.ndarray, pa.Array]:
    coded = values.dictionary_encode()
    return coded.indices.to_numpy().astype(np.int64), coded.dictionary


def _groups(part: pa.RecordBatch) -> np.ndarray:
    """The number of each row's (lang, digest), from 0 on; rows are sorted by them."""
    keys = list(zip(part.column("lang").to_pylist(), part.column("digest").to_pylist()))
    return np.cumsum([0, *(a != b for a, b in zip(keys[:-1], keys[1:]))])


def _held(part: pa.RecordBatch, group: np.ndarray) -> tuple[pa.RecordBatch, pa.RecordBatch]:
    """All groups but the last, and the last one, whose rows may go on: one row for each source."""
    first = int(np.searchsorted(group, group[-1]))
    last = part.slice(first)
    texts = [t for t in last.column("text").to_pylist() if t is not None][:1]
    sums: dict[str, int] = {}
    for source, n in zip(last.column("source").to_pylist(), last.column("n").to_pylist()):
        sums[source] = sums.get(source, 0) + n
    k = len(sums)
    rows = [
        pa.array([last.column("lang")[0].as_py()] * k), pa.array([last.column("digest")[0].as_py()] * k, pa.binary()),
        pa.array(list(sums)), pa.array(list(sums.values()), pa.int64()), pa.array([*texts, *[None] * k][:k], pa.string()),
    ]
    return part.slice(0, first), pa.RecordBatch.from_arrays(rows, schema=part.schema)


def _counted(part: pa.RecordBatch, group: np.ndarray) -> pa.RecordBatch:
    """``lang, source, term, n_terms, n_documents`` of whole groups."""
    texts = raw_texts(part)
    own = np.flatnonzero(part.column("text").is_valid().to_numpy(zero_copy_only=False))
    own = own[np.diff(group[own], prepend=-1) != 0]  # several tasks may have sent the text
    words = words_of([texts[i] for i in own], lower=True, separators=SEPARATORS)
    size = words.ends - words.starts
    letters = words.data[~SEPARATORS[words.data]]
    offsets = np.concatenate(([0], np.cumsum(size))).astype(np.int32)
    term, terms = _codes(pa.Array.from_buffers(pa.string(), len(size), [None, pa.py_buffer(offsets), pa.py_buffer(letters)]))
    text = np.repeat(np.arange(len(own)), np.diff(words.first))
    pair, count = np.unique(text * max(1, len(terms)) + term, return_counts=True)
    text, term = pair // max(1, len(terms)), pair % max(1, len(terms))
    # Rows of the part: copies of a text in a source.
    of = np.full(group[-1] + 1, -1)
    of[group[own]] = np.arange(len(own))
    row_text = of[group]
    first, last = np.searchsorted(text, row_text), np.searchsorted(text, row_text, side="right")
    at = np.repeat(first - np.concatenate(([0], np.cumsum(last - first)[:-1])), last - first) + np.arange((last - first).sum())
    row = np.repeat(np.arange(len(group)), last - first)
    n = part.column("n").to_numpy()[row]
    lang, langs = _codes(part.column("lang"))
    source, sources = _codes(part.column("source"))
    key = (lang[row] * len(sources) + source[row]) * max(1, len(terms)) + term[at]
    order = np.argsort(key, kind="stable")
    key = key[order]
    begin = np.flatnonzero(np.diff(key, prepend=-1))
    totals = [np.add.reduceat(v[order], begin) if len(begin) else v for v in (n * count[at], n)]
    key = key[begin]
    place = key // max(1, len(terms))
    return pa.RecordBatch.from_arrays(
        [langs.take(pa.array(place // len(sources))), sources.take(pa.array(place % len(sources))),
         terms.take(pa.array(key % max(1, len(terms)))), *map(pa.array, totals)],
        names=["lang", "source", "term", "n_terms", "n_documents"],
    )


def term_counts(docs: DataFrame) -> DataFrame:
    """``lang, source, term, n_terms, n_documents``, stored."""

    def run(batches):
        held = None
        for batch in batches:
            for part in slices(batch, limit=8 << 20):
                if held is not None:
                    part = pa.Table.from_batches([held, part]).combine_chunks().to_batches()[0]
                done, held = _held(part, _groups(part))
                if done.num_rows:
                    yield _counted(done, _groups(done))
        if held is not None:
            yield _counted(held, _groups(held))

    copies = collapse(docs).repartition("lang", "digest").sortWithinPartitions("lang", "digest")
    partial = copies.mapInArrow(run, "lang string, source string, term string, n_terms long, n_documents long")
    sums = partial.groupBy("lang", "source", "term").agg(F.sum("n_terms").alias("n_terms"), F.sum("n_documents").alias("n_documents"))
    return stored(sums, "term-counts")


def share(count: Column, total: Column, kept: Column) -> Column:
    """``1 + floor(UNIT * (count + 2) / (total + 2 * kept))``, exactly; 1 without kept terms."""
    above = F.lit(UNIT).cast("decimal(10,0)") * (count + 2).cast("decimal(19,0)")
    below = (total + 2 * kept).cast("decimal(19,0)")
    return F.lit(1) + F.coalesce(F.call_function("div", above, F.when(below > 0, below)), F.lit(0))


def gap(p: Column, q: Column) -> Column:
    """``floor((p - q)**2 / (p + q))``; shares are at most UNIT + 1, so this stays within a long."""
    return F.call_function("div", (p - q) * (p - q), p + q)


def _few(df: DataFrame, rows: int = 200_000) -> DataFrame:
    """With a broadcast hint if it has few, short rows; ``df`` is a stored table."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def source_divergence(docs: DataFrame, min_documents: int = MIN_DOCUMENTS, top: int = TOP_TERMS) -> DataFrame:
    """``lang, source, part, item, value, rank``."""
    groups = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]).distinct()
    counts = term_counts(docs)
    of_lang = counts.groupBy("lang", "term").agg(F.sum("n_terms").alias("lang_count"), F.sum("n_documents").alias("n_documents"))
    vocabulary = stored(of_lang.filter(F.col("n_documents") >= min_documents).select("lang", "term", "lang_count"), "vocabulary")
    sizes = vocabulary.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("lang_count").alias("lang_total"))
    kept = stored(counts.join(vocabulary, ["lang", "term"]).select("lang", "source", "term", "n_terms", "lang_count"), "kept-terms")
    totals = kept.groupBy("lang", "source").agg(F.sum("n_terms").alias("total"), F.count("*").alias("held"))
    zero = F.lit(0).cast("bigint")
    whole = groups.join(totals, ["lang", "source"], "left").join(sizes, "lang", "left").select(
        "lang", "source", *[F.coalesce(F.col(c), zero).alias(c) for c in ("total", "held", "kept", "lang_total")]
    )
    whole = _few(stored(whole.withColumn("p0", share(zero, F.col("total"), F.col("kept"))), "sources"))

    shares = kept.join(whole, ["lang", "source"]).withColumn("p", share(F.col("n_terms"), F.col("total"), F.col("kept")))
    terms = _terms(shares, top)

    shares = stored(shares.select("lang", "source", "term", "n_terms", "p", "p0"), "shares")
    a, b = (shares.select("lang", "term", *[F.col(c).alias(f"{c}_{x}") for c in ("source", "p", "p0")]) for x in "ab")
    # Terms that both sources hold; added up before anything is shuffled again.
    common = a.join(b, ["lang", "term"]).filter("source_a < source_b").groupBy("lang", "source_a", "source_b").agg(
        F.count("*").alias("both"),
        F.sum(
            gap(F.col("p_a"), F.col("p_b")) - gap(F.col("p_a"), F.col("p0_b")) - gap(F.col("p0_a"), F.col("p_b"))
            + gap(F.col("p0_a"), F.col("p0_b"))
        ).alias("shared"),
    )
    common = common.select("lang", "source_a", "source_b", "shared").unionByName(
        common.select("lang", F.col("source_b").alias("source_a"), F.col("source_a").alias("source_b"), "shared")
    )
    # Each source's kept terms by their count, held against every other source's share of an absent term.
    by_count = shares.groupBy("lang", "source", "p").agg(F.count("*").alias("n"))
    other = whole.select("lang", F.col("source").alias("source_b"), F.col("p0").alias("p0_b"))
    alone = by_count.withColumnRenamed("source", "source_a").join(other, "lang").groupBy("lang", "source_a", "source_b").agg(
        F.sum(F.col("n") * gap(F.col("p"), F.col("p0_b"))).alias("alone")
    )
    alone = stored(alone, "one-sided")
    back = alone.select("lang", F.col("source_a").alias("source_b"), F.col("source_b").alias("source_a"), F.col("alone").alias("back"))
    x = whole.select("lang", "kept", *[F.col(c).alias(f"{c}_a") for c in ("source", "p0", "held")])
    y = whole.select("lang", *[F.col(c).alias(f"{c}_b") for c in ("source", "p0", "held")])
    pair = ["lang", "source_a", "source_b"]
    pairs = (
        x.join(y, "lang").filter("source_a <> source_b")
        .join(common, pair, "left").join(alone, pair, "left").join(back, pair, "left")
    )
    rest = (F.col("kept") - F.col("held_a") - F.col("held_b")) * gap(F.col("p0_a"), F.col("p0_b"))
    value = sum((F.coalesce(F.col(c), zero) for c in ("shared", "alone", "back")), rest)
    return terms.unionByName(_ranked(pairs, "source_a", "pair", F.col("source_b"), value))


def _ranked(rows: DataFrame, source: str, part: str, item: Column, value: Column) -> DataFrame:
    order = W.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    named = rows.select("lang", F.col(source).alias("source"), F.lit(part).alias("part"), item.alias("item"), value.alias("value"))
    return named.withColumn("rank", F.row_number().over(order))


def _terms(shares: DataFrame, top: int) -> DataFrame:
    """The terms that a source holds more often than its language; first the best of each of several
    pieces of a source, then of the source."""
    q = share(F.col("lang_count"), F.col("lang_total"), F.col("kept"))
    above = shares.withColumn("q", q).filter("p > q").withColumn("value", gap(F.col("p"), F.col("q")))
    above = above.select("lang", "source", "term", "value", F.pmod(F.xxhash64("term"), F.lit(SALTS)).alias("piece"))
    order = W.partitionBy("lang", "source", "piece").orderBy(F.desc("value"), "term")
    best = above.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= top)
    return _ranked(best, "source", "term", F.col("term"), F.col("value")).filter(F.col("rank") <= top)
