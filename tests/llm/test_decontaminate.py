import random
import re

from ledgerloom.llm.decontaminate import contamination, near_matches

SCHEMA = "doc_id long, text string, window string, term int"


def words(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def brute_force(docs, items, size):
    wanted = {}
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - size + 1)):
            if w:
                wanted.setdefault(tuple(w[i : i + size]), set()).add(str(item))
    out = {}
    for d, text in docs:
        w, hit, found = words(text), set(), set()
        for n in {len(x) for x in wanted}:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in wanted:
                    hit.update(range(i, i + n))
                    found |= wanted[tuple(w[i : i + n])]
        out[d] = (len(w), len(hit), sorted(found), bool(hit))
    return out


def rows_and_items(rng):
    vocabulary = ["the", "of", "Été", "x1", "漢字", "a", "b_c", "Rare"]
    items = [(i, " ".join(rng.choice(vocabulary) + ("" if j % 3 else str(j)) for j in range(rng.randrange(3, 20)))) for i in range(12)]
    items += [(20, "one two"), (21, "ONE, two!"), (22, ""), (23, None), (24, "the the the the the the the the the the the"), (25, "absent")]
    docs = [(0, None), (1, ""), (2, "--- !!"), (3, "-one.TWO?"), (4, "the " * 50), (5, "one")]
    for d in range(6, 90):
        text = " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(50)))
        docs.append((d, text + "; " + rng.choice(items[:12])[1].upper() + "! " + text if d % 3 else text))
    return docs, items


def test_equals_brute_force(spark):
    docs, items = rows_and_items(random.Random(5))
    df = spark.createDataFrame([(d, t, "x", 1) for d, t in docs], SCHEMA).repartition(3)
    bench = spark.createDataFrame([(i, t, "y") for i, t in items], "item_id long, text string, phrase string")
    got = {r["doc_id"]: (r["n_words"], r["n_hit"], r["item_ids"], r["contaminated"]) for r in contamination(df, bench, 5).collect()}
    assert got == brute_force(docs, items, 5)


def test_empty_tables_repeats_and_missing_ids(spark):
    docs = spark.createDataFrame([(None, "one two", "", 0), (1, "one two", "", 0), (1, "one two", "", 0)], SCHEMA)
    bench = spark.createDataFrame([(7, "one two"), (None, "one")], "item_id long, text string")
    got = sorted((tuple(r) for r in contamination(docs, bench).collect()), key=str)
    assert got == [(1, 2, 2, ["7"], True)] * 2 + [(None, 2, 0, [], False)]
    assert contamination(docs.limit(0), bench).count() == 0
    assert contamination(docs, bench.limit(0)).filter("contaminated").count() == 0


def test_near_matches_in_any_order(spark):
    docs = spark.createDataFrame([(1, "gamma x x alpha x beta", "", 0), (2, "alpha " + "x " * 30 + "beta gamma", "", 0)], SCHEMA)
    bench = spark.createDataFrame([(7, "alpha beta gamma x")], "item_id long, text string")
    got = [tuple(r) for r in near_matches(docs, bench, terms=3, within=6).collect()]
    assert got == [(1, 7, 0)]
