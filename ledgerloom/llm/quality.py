"""Quality by hierarchical empirical Bayes: a document's own evidence, its host's and its path's.

*Document.*  Boosted trees over a text's form (case, symbols, repetition, word lengths) give a
calibrated probability that its label is good.

*Host and path.*  Over all documents, grouped sums count what is known of each host and of each
path below it: a labelled document counts with its label, another with the document probability.
Host rates have a Beta prior whose mean and weight are fitted by moments over all hosts; path rates
have a Beta prior around their host's posterior, its weight fitted over all paths alike.  A sparse
site is so shrunk toward its host, and a sparse host toward the global rate.  A document's own
contribution is taken out of its site's counts before they judge it.

*Together.*  The log-odds of the path posterior, less those of the global rate, are added to the
document's.  In the table of documents ``source`` is the host and ``lang`` the path below it.

The trees learn from a bounded sample of ``SAMPLE`` labelled rows; all counts cover all documents.

Defined cases: a null text is scored like an empty one; a document without host or path belongs to
the host or path "none"; a null label counts as no label, and of repeated labels the largest;
without any label every score is 0.5 and every document is kept; empty tables give empty results.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.boosting import BoostedTrees, platt, sigmoid
from ledgerloom.llm.common import stored
from ledgerloom.llm.decontaminate import few
from ledgerloom.llm.spans import hashed_share
from ledgerloom.llm.textblocks import raw_texts, slices, word_hashes, words_of

SAMPLE = 12_000  # labelled rows that the trees see
KEEP = 0.5
LEAST, MOST = 1.0, 1e6  # weight of a Beta prior, in documents

#: The bytes counted together, each as a share of the text.
SIGNS = [b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b"|", b"!", b"?", b"#*%&$@~^_=+<>{}[]\\/", b".", b",", b"\n", b" \t"]


def text_features(texts: list[bytes | None]) -> np.ndarray:
    words = words_of(texts)
    counts = np.diff(words.first)
    sizes = np.maximum(np.diff(words.bounds) - 1, 1)
    columns = [np.log1p(sizes), np.log1p(counts)]
    for signs in SIGNS:
        hit = np.isin(np.arange(256), list(signs))[words.data]
        sums = np.concatenate(([0], np.cumsum(hit)))[words.bounds]
        # The space behind each text is no part of it.
        columns.append((np.diff(sums) - (b" " in signs)) / sizes)
    hashes = word_hashes(words)
    lengths = (words.ends - words.starts).astype(float)
    distinct, most, same_next, spread = (np.zeros(len(texts)) for _ in range(4))
    for t, (low, high) in enumerate(zip(words.first[:-1], words.first[1:])):
        if high > low:
            own = hashes[low:high]
            times = np.unique(own, return_counts=True)[1]
            distinct[t], most[t] = len(times) / len(own), times.max() / len(own)
            same_next[t] = np.mean(own[1:] == own[:-1]) if len(own) > 1 else 0
            spread[t] = lengths[low:high].std()
    total = np.concatenate(([0], np.cumsum(lengths)))[words.first]
    return np.stack([*columns, np.diff(total) / np.maximum(counts, 1), spread, distinct, most, same_next], axis=1)


class FormModel:
    """Trees over a text's form with calibrated output."""

    def __init__(self, x: np.ndarray, y: np.ndarray, seed: int = 3):
        held = np.random.default_rng(seed).random(len(y)) < 0.3
        if not held.any() or held.all():
            held = np.arange(len(y)) % 2 == 1
        self.trees = BoostedTrees(trees=80).fit(x[~held], y[~held])
        self.slope, self.shift = platt(self.trees.margin(x[held]), y[held])

    def probability(self, texts: list[bytes | None]) -> np.ndarray:
        return sigmoid(self.slope * self.trees.margin(text_features(texts)) + self.shift)


def _labelled(labels: DataFrame) -> DataFrame:
    known = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("quality").cast("int").alias("good"))
    return known.filter("doc_id is not null and good is not null").groupBy("doc_id").agg(F.max("good").alias("good"))


def fit_form(docs: DataFrame, labels: DataFrame) -> FormModel | None:
    def features(batches):
        for batch in batches:
            for part in slices(batch):
                x = text_features(raw_texts(part))
                rows = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]), pa.array(x.ravel()))
                yield pa.RecordBatch.from_arrays([part.column("good"), rows], names=["good", "x"])

    # About SAMPLE short rows, so the broadcast side is bounded.
    sample = hashed_share(_labelled(labels), SAMPLE, 5)
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").join(F.broadcast(sample), "doc_id")
    rows = texts.select("good", "text").mapInArrow(features, "good int, x array<double>").toArrow()
    y = rows.column("good").to_numpy().astype(float)
    if len(y) < 4:
        return None
    return FormModel(np.array(rows.column("x").to_pylist()), y)


def _fitted_weight(sites: DataFrame, centre: Column) -> float:
    """The weight of a Beta prior by moments: how much site rates differ beyond chance.

    ``sites`` has ``n`` documents and ``good`` of them; ``centre`` is the prior mean of each.
    """
    rate = F.col("good") / F.col("n")
    chance = centre * (1 - centre)
    row = sites.filter("n > 0").agg(
        F.sum("n"), F.sum(F.col("n") * (rate - centre) * (rate - centre)), F.sum(chance), F.sum(F.col("n") * chance)
    ).first()
    total, squares, chances, weighted = (float(v or 0) for v in row)
    # E[n (rate - centre)^2] = chance + (n - 1) chance / (weight + 1), summed over sites.
    beyond = squares - chances
    if beyond <= 0 or weighted <= chances:
        return MOST
    return float(np.clip((weighted - chances) / beyond - 1, LEAST, MOST))


def _log_odds(p: Column) -> Column:
    p = F.least(F.greatest(p, F.lit(1e-6)), F.lit(1 - 1e-6))
    return F.log(p / (1 - p))


def quality_scores(docs: DataFrame, labels: DataFrame, host: str = "source", path: str = "lang") -> DataFrame:
    """One row per document: ``doc_id, p_document, p_host, p_path, score, keep``."""
    spark = docs.sparkSession
    docs = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        F.coalesce(F.col(host).cast("string"), F.lit("none")).alias("host"),
        F.coalesce(F.col(path).cast("string"), F.lit("none")).alias("path"),
    )
    model = fit_form(docs, labels)

    def score(batches):
        for batch in batches:
            for part in slices(batch):
                p = model.probability(raw_texts(part)) if model else np.full(part.num_rows, 0.5)
                columns = [part.column(c) for c in ("doc_id", "host", "path")] + [pa.array(p)]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "host", "path", "p_document"])

    scored = docs.mapInArrow(score, "doc_id long, host string, path string, p_document double")
    known = _labelled(labels)
    # Fixed-point evidence: sums do not depend on their order.
    seen = F.coalesce(F.col("good").cast("double"), F.col("p_document")).cast("decimal(12,10)").alias("seen")
    scored = stored(scored.join(known, "doc_id", "left").select("doc_id", "host", "path", "p_document", seen), "scored")

    paths = stored(scored.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum("seen").cast("double").alias("good")), "paths")
    hosts = stored(paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("good").alias("good")), "hosts")
    total = hosts.agg(F.sum("n"), F.sum("good")).first()
    if not total[0]:
        return spark.createDataFrame([], "doc_id long, p_document double, p_host double, p_path double, score double, keep boolean")
    rate = F.lit(min(max(float(total[1]) / total[0], 1e-6), 1 - 1e-6))
    host_weight = F.lit(_fitted_weight(hosts, rate))
    centred = hosts.select("host", F.col("n").alias("host_n"), F.col("good").alias("host_good"))
    centre = (F.col("host_good") + host_weight * rate) / (F.col("host_n") + host_weight)
    sites = stored(paths.join(centred, "host").withColumn("centre", centre), "sites")
    path_weight = F.lit(_fitted_weight(sites, F.col("centre")))

    joined = scored.join(few(sites), ["host", "path"])
    own = F.col("seen").cast("double")
    joined = joined.withColumn("p_host", (F.col("host_good") - own + host_weight * rate) / (F.col("host_n") - 1 + host_weight))
    joined = joined.withColumn("p_path", (F.col("good") - own + path_weight * F.col("p_host")) / (F.col("n") - 1 + path_weight))
    joined = joined.withColumn("score", 1 / (1 + F.exp(-(_log_odds(F.col("p_document")) + _log_odds(F.col("p_path")) - _log_odds(rate)))))
    return joined.select("doc_id", "p_document", "p_host", "p_path", "score", (F.round("score", 6) >= KEEP).alias("keep"))
