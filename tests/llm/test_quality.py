import random

import numpy as np
import pytest

from ledgerloom.llm.quality import quality_scores

SCHEMA = "doc_id long, text string, source string, lang string, host string, n int"
LABELS = "doc_id long, quality int"


def text(rng, good):
    words = [rng.choice(["the", "house", "river", "of", "and", "morning"]) + rng.choice(["", "s", ","]) for _ in range(60)]
    return " ".join(words) + "." if good else " ".join(w.upper() + "!!" for w in words[:20] * 3)


def test_sites_shrink_and_held_out_documents_are_told_apart(spark):
    rng = random.Random(1)
    rows, truth = [], {}
    for d in range(1200):
        host = f"h{d % 5}"
        good = rng.random() < (0.3 if host == "h0" else 0.9)
        looks = good if rng.random() < 0.9 else not good
        rows.append((d, text(rng, looks), host, "p", "x", 0))
        truth[d] = good
    rows += [(9000, "", "new", "p", "x", 0), (9001, None, None, None, "x", 0), (None, "a b", "h1", "p", "x", 0)]
    docs = spark.createDataFrame(rows, SCHEMA)
    labels = spark.createDataFrame([(d, int(g)) for d, g in truth.items() if d % 3] + [(0, None), (None, 1), (4, 0), (4, 1)], LABELS)
    got = {r["doc_id"]: r for r in quality_scores(docs, labels).collect()}
    assert len(got) == len(rows)
    unseen = [d for d in truth if d % 3 == 0]
    assert np.mean([got[d]["keep"] == truth[d] for d in unseen]) >= 0.85
    assert got[5]["p_host"] < 0.55 < 0.75 < got[6]["p_host"]
    rate = np.mean([r["p_document"] for r in got.values()])
    assert abs(got[9000]["p_path"] - rate) < 0.2  # a site of one document says next to nothing
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_nothing_known(spark):
    docs = spark.createDataFrame([(1, "a", "h", "p", "", 0), (1, "a", "h", "p", "", 0), (2, None, None, None, "", 0)], SCHEMA)
    none = spark.createDataFrame([], LABELS)
    got = quality_scores(docs, none).collect()
    assert [(r["doc_id"], r["keep"]) for r in sorted(got, key=lambda r: r["doc_id"])] == [(1, True), (1, True), (2, True)]
    assert all(r["score"] == pytest.approx(0.5) for r in got)
    assert quality_scores(docs.limit(0), none).count() == 0
