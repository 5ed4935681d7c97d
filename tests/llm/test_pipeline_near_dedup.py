"""The near_dedup stage against all pairs of shingle sets of 5 words."""

import random

import corpus_pipeline
from ledgerloom.llm.common import table

SF_DIR = "/root/testdata/sf0.001"


def shingles(text, size):
    w = text.lower().split()
    return {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))}


def similarity(a, b, size):
    a, b = shingles(a, size), shingles(b, size)
    return len(a & b) / len(a | b)


def kept_by_brute_force(rows):
    parent = {d: d for d, _ in rows}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    for i, (a, s) in enumerate(rows):
        for b, t in rows[i + 1 :]:
            if similarity(s, t, 5) >= 0.8:
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    return {d for d in parent if root(d) == d}


def test_stage_takes_shingles_of_five_words(spark):
    rng = random.Random(5)
    rows = []
    for base in range(12):
        words = [f"w{rng.randrange(10**6)}" for _ in range(42)]
        other, longer = list(words), [*words, "tail"]
        other[20 + base % 3] = "other"
        assert similarity(" ".join(words), " ".join(other), 4) >= 0.8 > similarity(" ".join(words), " ".join(other), 5)
        rows += [(len(rows) + i, " ".join(w)) for i, w in enumerate((words, other, longer))]
    schema = table(spark, SF_DIR, "documents").select("doc_id", "text").schema
    docs = spark.createDataFrame(rows, schema).repartition(3)
    kept = {r["doc_id"] for r in corpus_pipeline.near_dedup(spark, docs, SF_DIR).collect()}
    want = kept_by_brute_force(rows)
    assert kept == want
    assert len(want) == 24
