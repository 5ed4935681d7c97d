"""Toxicity by non-negative positive-unlabelled learning (Kiryo et al., 2017).

A text is the set of its distinct words and word beginnings, hashed to ``2**22`` places.  The
confirmed toxic texts are the positives P; all learnable texts, labelled or not, are the
unlabelled sample U, in which toxic ones are hidden with the class prior pi.  A linear model
minimises the non-negative risk estimate::

    pi * R_P(+) + max(0, R_U(-) - pi * R_P(-))

with the logistic loss, so its output estimates the probability of the label.  Where the inner
difference turns negative, the step goes the other way, as the method says.  pi is the share of
toxic ones among all labelled learnable rows.

Labels are learnt only from rows that are not held out; P and U are bounded samples
(``POSITIVES``, ``UNLABELLED``).  Places enter the model if they tell P from U apart
(``PLACES_USED`` at most).  Every text is scored whole, whatever its length.

Defined cases: null and empty texts are scored by the intercept; a label that is null counts as
no label; rows that repeat a ``doc_id`` are scored one by one, and a repeated label counts as
toxic if any row says so; without any positive all scores are 0 (below 1e-9); empty tables give empty results.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.boosting import sigmoid
from ledgerloom.llm.common import id_and_text
from ledgerloom.llm.spans import hashed_share
from ledgerloom.llm.textblocks import mix, raw_texts, slices, word_hashes, words_of

POSITIVES = 6_000
UNLABELLED = 12_000
PLACES_USED = 4_096
PLACE_BITS = 22
LEAST = 3  # texts of P that a place must be in
TEXTS = -1  # stands for all texts among the places
BEGINNINGS = (4, 5, 6)  # bytes
THRESHOLD = 0.7
RIDGE = 1e-4

#: All but ASCII letters separate words; other alphabets are letters.
NOT_LETTERS = np.array([b < 128 and not chr(b).isalpha() for b in range(256)])


def places(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """``(text, place)`` of each word and beginning, with repeats."""
    words = words_of(texts, lower=True, separators=NOT_LETTERS)
    size = words.ends - words.starts
    owner = np.repeat(np.arange(len(texts)), np.diff(words.first))
    parts, owners = [word_hashes(words)], [owner]
    state = np.full(len(size), 17, np.uint64)
    for k in range(max(BEGINNINGS)):
        long = size > k
        state[long] = state[long] * np.uint64(0x100000001B3) + words.data[words.starts[long] + k]
        if k + 1 in BEGINNINGS:
            parts.append(mix(state[long] * np.uint64(64) + np.uint64(k)))
            owners.append(owner[long])
    return np.concatenate(owners), (np.concatenate(parts) >> np.uint64(64 - PLACE_BITS)).astype(np.int64)


def _distinct(owner: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    both = np.unique((owner << PLACE_BITS) | place)
    return both >> PLACE_BITS, both & ((1 << PLACE_BITS) - 1)


def _known(texts: list[bytes | None], used: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ``(text, slot)`` of the places that are in ``used``."""
    owner, place = places(texts)
    slot = np.minimum(np.searchsorted(used, place), len(used) - 1)
    known = used[slot] == place
    return _distinct(owner[known], slot[known])


class ToxicityModel:
    """Places in use, their weights, the intercept; some 100 kB, sent to every task."""

    def __init__(self, used: np.ndarray, weights: np.ndarray, intercept: float):
        self.used, self.weights, self.intercept = used, weights, intercept

    def score(self, texts: list[bytes | None]) -> np.ndarray:
        total = np.full(len(texts), self.intercept)
        if len(self.used):
            owner, slot = _known(texts, self.used)
            np.add.at(total, owner, self.weights[slot])
        return sigmoid(total)


def _chosen_places(place: np.ndarray, in_p: np.ndarray, in_u: np.ndarray, n_p: int, n_u: int, prior: float) -> np.ndarray:
    """Places, given in order, whose share of texts differs most between P and U, in standard errors.

    A place that toxic texts alone have is 1 / pi times as frequent in P as in U.
    """
    share = (in_p + in_u + 0.5) / (n_p + n_u + 1)
    z = (in_p / n_p - in_u / n_u) / np.sqrt(share * (1 - share).clip(1e-9) * (1 / n_p + 1 / n_u))
    z[(in_p < LEAST) | (in_p / n_p * prior < 0.4 * in_u / n_u)] = 0
    best = np.argsort(-z, kind="stable")[:PLACES_USED]
    return place[np.sort(best[z[best] > 5])]


def train(used: np.ndarray, p: tuple[np.ndarray, np.ndarray], n_p: int, u: tuple[np.ndarray, np.ndarray], n_u: int, prior: float) -> ToxicityModel:
    """``p`` and ``u`` are distinct ``(text, slot)`` pairs of the two samples, slots being those of ``used``."""
    (owner_p, slot_p), (owner_u, slot_u) = p, u
    w, b = np.zeros(len(used)), float(np.log(prior / (1 - prior)))
    mean, square = np.zeros(len(used) + 1), np.zeros(len(used) + 1)
    for step in range(1, 401):
        out_p = b + np.bincount(owner_p, w[slot_p], n_p)
        out_u = b + np.bincount(owner_u, w[slot_u], n_u)
        negative = np.logaddexp(0, out_u).mean() - prior * np.logaddexp(0, out_p).mean()
        up_p = -prior * sigmoid(-out_p) / n_p  # of pi * R_P(+)
        down_p, down_u = -prior * sigmoid(out_p) / n_p, sigmoid(out_u) / n_u  # of R_U(-) - pi * R_P(-)
        if negative >= 0:
            d_p, d_u = up_p + down_p, down_u
        else:
            d_p, d_u = -down_p, -down_u
        gradient = np.bincount(slot_p, d_p[owner_p], len(used)) + np.bincount(slot_u, d_u[owner_u], len(used))
        gradient = np.append(gradient + RIDGE * w, d_p.sum() + d_u.sum())
        mean, square = 0.9 * mean + 0.1 * gradient, 0.99 * square + 0.01 * gradient**2
        change = 0.05 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
        w, b = w - change[:-1], b - change[-1]
    return ToxicityModel(used, w, float(b))


def held_out(doc_id: Column) -> Column:
    """Rows that nothing is learnt from; one without an id is among them."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(True))


def fit_toxicity(docs: DataFrame, labels: DataFrame) -> ToxicityModel:
    docs = id_and_text(docs).filter(~held_out(F.col("doc_id")))
    labels = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), "toxic").filter("toxic is not null and doc_id is not null")
    labels = labels.filter(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    prior = labels.agg(F.avg("toxic")).first()[0] or 0.0

    # At most POSITIVES ids (and a few by chance), so the broadcast side is bounded.
    positive = hashed_share(labels.filter("toxic = 1").select("doc_id"), POSITIVES, 1)
    p, u = docs.join(F.broadcast(positive), "doc_id", "left_semi"), hashed_share(docs, UNLABELLED, 2)

    # Places are counted and texts reduced to the chosen ones in tasks: the driver gets some 1 MB of each.
    common = _frequencies(p).filter(f"n >= {LEAST} or place = {TEXTS}").withColumnRenamed("n", "in_p")
    counts = common.join(_frequencies(u).withColumnRenamed("n", "in_u"), "place", "left").select("place", "in_p", F.coalesce("in_u", F.lit(0)).alias("in_u"))
    place, in_p, in_u = (c.to_numpy() for c in counts.toArrow().columns)
    order = np.argsort(place)
    place, in_p, in_u = place[order].astype(np.int64), in_p[order], in_u[order]
    n_p, n_u = (int(n[place == TEXTS].sum()) for n in (in_p, in_u))
    if not n_p or not n_u:
        return ToxicityModel(np.zeros(0, np.int64), np.zeros(0), -1e9)
    prior = float(np.clip(prior, 1e-3, 0.999))
    used = _chosen_places(place[1:], in_p[1:], in_u[1:], n_p, n_u, prior)
    if not len(used):
        return ToxicityModel(used, np.zeros(0), float(np.log(prior / (1 - prior))))

    def slots(batches):
        for batch in batches:
            for part in slices(batch):
                owner, slot = _known(raw_texts(part), used)
                ends = np.searchsorted(owner, np.arange(part.num_rows + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array(ends), pa.array(slot.astype(np.int32)))], names=["slots"])

    def reduced(rows: DataFrame):
        column = rows.select("doc_id", "text").mapInArrow(slots, "slots array<int>").toArrow().column("slots")
        counts = pc.list_value_length(column).to_numpy()
        slot = np.concatenate([np.zeros(0, np.int64), *(c.flatten().to_numpy() for c in column.chunks)])
        return (np.repeat(np.arange(len(counts)), counts), slot), len(counts)

    p, n_p = reduced(p)
    u, n_u = reduced(u)
    return train(used, p, n_p, u, n_u, prior)


def _frequencies(rows: DataFrame) -> DataFrame:
    """``place, n``: in how many texts each place is; and at place ``TEXTS`` how many texts there are."""

    def counted(batches):
        for batch in batches:
            for part in slices(batch):
                found, n = np.unique(_distinct(*places(raw_texts(part)))[1], return_counts=True)
                place = pa.array(np.insert(found, 0, TEXTS).astype(np.int32))
                yield pa.RecordBatch.from_arrays([place, pa.array(np.insert(n, 0, part.num_rows))], names=["place", "n"])

    found = rows.select("doc_id", "text").mapInArrow(counted, "place int, n long")
    return found.groupBy("place").agg(F.sum("n").alias("n"))


def score_toxicity(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """``doc_id, score`` for every row."""

    def scored(batches):
        for batch in batches:
            for part in slices(batch):
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(model.score(raw_texts(part)))], names=["doc_id", "score"]
                )

    return id_and_text(docs).mapInArrow(scored, "doc_id long, score double")


def drop_toxic(docs: DataFrame, model: ToxicityModel, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with all its columns, less the texts that score ``threshold`` or more."""

    def clean(batches):
        for batch in batches:
            for part in slices(batch):
                yield part.filter(pa.array(model.score(raw_texts(part)) < threshold))

    return docs.mapInArrow(clean, docs.schema)
