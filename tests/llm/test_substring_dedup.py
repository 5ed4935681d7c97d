import random
import re

import pytest
from pyspark.sql import functions as F

from ledgerloom.llm.substring_dedup import remove_repeated_windows

SCHEMA = "doc_id long, text string, slot string, words int"


def brute_force(rows, size):
    words = {d: re.findall(r"[^\x20\x09-\x0D]+", t or "") for d, t in rows}
    first = {}
    for d in sorted(words):
        for i in range(len(words[d]) - size + 1):
            first.setdefault(tuple(words[d][i : i + size]), d)
    out = {}
    for d, w in words.items():
        gone = set()
        for i in range(len(w) - size + 1):
            if first[tuple(w[i : i + size])] < d:
                gone.update(range(i, i + size))
        out[d] = (len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone))
    return out


@pytest.mark.parametrize("slot_bytes", [200, 4000, 1 << 20])
def test_equals_brute_force(spark, slot_bytes):
    rng = random.Random(slot_bytes)
    vocabulary = ["a", "bé", "漢字", "the", "x" * 40, "of", " ", "q\x00r"]
    passage = " ".join(rng.choice(vocabulary) + str(i) for i in range(30))
    rows = [(0, None), (1, ""), (2, " \t\n"), (3, "one two"), (4, passage), (5, passage), (6, passage + " end")]
    for d in range(7, 120):
        text = rng.choice(["\n", "  "]).join(rng.choice(vocabulary) for _ in range(rng.randrange(60)))
        rows.append((d, text + " " + passage if d % 3 == 0 else text))
    rng.shuffle(rows)
    docs = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], SCHEMA).repartition(5)
    got = {r["doc_id"]: r for r in remove_repeated_windows(docs, 5, slot_bytes).collect()}
    want = brute_force(rows, 5)
    assert set(got) == set(want)
    for d, (n, gone, text) in want.items():
        row = got[d]
        spans = [(s["start"], s["end"]) for s in row["removed"]]
        assert (row["n_words"], sum(e - s for s, e in spans), row["kept_text"]) == (n, gone, text)
        assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))


def test_empty_table_and_missing_ids(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert remove_repeated_windows(docs).count() == 0
    text = "a b c d e f g"
    docs = spark.createDataFrame([(None, text, "", 0), (None, text, "", 0), (1, text, "", 0), (1, text, "", 0), (2, text, "", 0)], SCHEMA)
    rows = remove_repeated_windows(docs, 3).orderBy(F.col("doc_id").asc_nulls_first()).collect()
    assert [(r["doc_id"], r["kept_text"]) for r in rows] == [(None, text)] * 2 + [(1, text)] * 2 + [(2, "")]
