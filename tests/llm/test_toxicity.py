import random
import tracemalloc
import zlib

import numpy as np
import pytest

from ledgerloom.llm.toxicity import drop_toxic, fit_toxicity, held_out, places, score_toxicity

SCHEMA = "doc_id long, text string, score double, toxic int"
BAD = ["blarg", "snorfle", "quibbish"]


def made(rng, n):
    rows, labels = [], []
    for d in range(n):
        words = [f"w{rng.choice('abcdefghij')}{rng.choice('klmnop')}{rng.choice('qrstu')}" for _ in range(rng.randrange(20, 80))]
        toxic = rng.random() < 0.2
        if toxic:
            for _ in range(3):
                words[rng.randrange(len(words))] = rng.choice(BAD) + rng.choice(["", "ed", "ing", "s"])
        rows.append((d, " ".join(words), 0.0, 0))
        if d % 2:
            labels.append((d, int(toxic)))
    return rows, labels


def test_held_out_accuracy_and_defined_cases(spark):
    rows, labels = made(random.Random(1), 1500)
    truth = dict(labels)
    extra = [(None, "blarg snorfle quibbish", 0.0, 0), (9001, None, 0.0, 0), (9002, "", 0.0, 0), (9003, "quibbish " * 5000, 0.0, 0), (9003, "wako", 0.0, 0)]
    docs = spark.createDataFrame(rows + extra, SCHEMA).repartition(4)
    marked = spark.createDataFrame(labels + [(3, None), (None, 1)], "doc_id long, toxic int")
    model = fit_toxicity(docs, marked)
    scored = score_toxicity(docs, model).collect()
    assert len(scored) == len(rows) + len(extra) and all(0 <= r["score"] <= 1 for r in scored)
    own = {r["doc_id"]: r["score"] for r in scored if r["doc_id"] is not None and r["doc_id"] < 9000}
    unseen = [d for d in truth if zlib.crc32(str(d).encode()) % 3 == 1]
    right = np.mean([(own[d] >= 0.7) == bool(truth[d]) for d in unseen])
    assert right >= 0.97
    assert sorted(r["score"] >= 0.7 for r in scored if r["doc_id"] == 9003) == [False, True]
    kept = drop_toxic(docs, model)
    assert kept.columns == docs.columns
    assert kept.count() == sum(r["score"] < 0.7 for r in scored)
    assert drop_toxic(docs.limit(0), model).count() == 0
    got = {r["doc_id"]: r["h"] for r in docs.select("doc_id", held_out(docs["doc_id"]).alias("h")).collect()}
    assert got[None] and all(got[d] == (zlib.crc32(str(d).encode()) % 3 == 1) for d in range(100))


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "a b", 0.0, 0), (2, None, 0.0, 0)], SCHEMA)
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert [r["score"] for r in score_toxicity(docs, fit_toxicity(docs, labels)).collect()] == pytest.approx([0.0, 0.0], abs=1e-9)
    assert score_toxicity(docs.limit(0), fit_toxicity(docs.limit(0), labels)).count() == 0


def test_beginnings_are_shared():
    owner, place = places([b"blarging", b"blargs", b"other"])
    sets = [set(place[owner == i]) for i in range(3)]
    assert len(sets[0] & sets[1]) == 2 and not sets[0] & sets[2]


def test_the_driver_gets_little_of_the_samples(spark):
    """All pairs of text and place, and arrays over all 2 ** 22 places, took some 300 MB of the driver."""
    rows, labels = made(random.Random(4), 1500)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    marked = spark.createDataFrame(labels, "doc_id long, toxic int")
    tracemalloc.start()
    model = fit_toxicity(docs, marked)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()

    def learnable(d):
        return zlib.crc32(str(d).encode()) % 3 != 1

    def counts(texts):
        out = np.zeros(1 << 22, int)
        for t in texts:
            out[np.unique(places([t.encode()])[1])] += 1
        return out, len(texts)

    known = {d: toxic for d, toxic in labels if learnable(d)}
    (in_p, n_p), (in_u, n_u) = counts([r[1] for r in rows if known.get(r[0])]), counts([r[1] for r in rows if learnable(r[0])])
    prior, share = np.mean(list(known.values())), (in_p + in_u + 0.5) / (n_p + n_u + 1)
    z = (in_p / n_p - in_u / n_u) / np.sqrt(share * (1 - share) * (1 / n_p + 1 / n_u))
    z[(in_p < 3) | (in_p / n_p * prior < 0.4 * in_u / n_u)] = 0
    assert len(model.used) and model.used.tolist() == np.flatnonzero(z > 5).tolist()
    assert peak < 10e6
