import random
import re

from ledgerloom.llm.components import connected_components
from ledgerloom.llm.near_dedup import drop_near_duplicates, near_duplicates

SCHEMA = "doc_id long, text string, kept string, component_id int"


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def brute_force(rows):
    sets = {}
    for d, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", lowered(t))
        sets[d] = {tuple(w[i : i + 4]) for i in range(max(1, len(w) - 3))} if w else set()
    parent = {d: d for d in sets}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= 80 * len(sets[a] | sets[b]):
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    return {d: (len(sets[d]), root(d)) for d in ids}


def copies(rng):
    rows = [(0, None), (1, ""), (2, "  "), (3, "one two"), (4, "ONE  two"), (5, "one two three"), (6, "Éa b c d")]
    for base in range(6):
        words = [f"w{rng.randrange(400)}" for _ in range(rng.choice([30, 80, 300]))]
        for _ in range(25):
            own = list(words)
            for _ in range(rng.randrange(len(words) // 12)):
                own[rng.randrange(len(own))] = f"n{rng.randrange(10**6)}"
            rows.append((len(rows), " ".join(own)))
        rows.append((len(rows), " ".join(words)))
        rows.append((len(rows), "\n".join(words).upper()))
    rng.shuffle(rows)
    return rows


def test_equals_brute_force(spark):
    rows = copies(random.Random(3))
    docs = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], SCHEMA).repartition(4)
    want = brute_force(rows)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_duplicates(docs).collect()}
    assert got == want


def test_missing_ids_repeats_and_empty_table(spark):
    rows = [(None, "a b c d e"), (3, "a b c d e"), (3, "a b c d e"), (None, "f g h i"), (7, None), (None, None)]
    docs = spark.createDataFrame([(d, t, "", 0) for d, t in rows], SCHEMA)
    got = sorted((tuple(r) for r in near_duplicates(docs).drop("text_hash").collect()), key=str)
    assert got == sorted(
        [(None, 2, 3, False), (3, 2, 3, True), (3, 2, 3, True), (None, 1, None, True), (7, 0, 7, True), (None, 0, None, True)],
        key=str,
    )
    kept = drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str) == sorted(
        [(3, "a b c d e"), (None, "f g h i"), (7, None), (None, None)], key=str
    )
    assert near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(500, 500)]
    links = spark.createDataFrame(chain, "a long, b long")
    got = {r["node"]: r["component"] for r in connected_components(links).collect()}
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 160)}
