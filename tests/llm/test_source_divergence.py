import random
import re
from collections import Counter, defaultdict

from ledgerloom.llm.source_divergence import collapse, source_divergence

SCHEMA = "doc_id long, text string, lang string, source string, term string, n int"
TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def brute(rows, least, top):
    count, docs, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        words = TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        groups.add((lang, source))
        count[lang, source].update(words)
        docs[lang].update(set(words))
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for t, n in docs[lang].items() if n >= least]
        sources = sorted(s for g, s in groups if g == lang)

        def shares(c):
            n = sum(c[t] for t in kept)
            return {t: 1 + 1_000_000_000 * (c[t] + 2) // (n + 2 * len(kept)) for t in kept}

        q = shares(sum((count[lang, s] for s in sources), Counter()))
        p = {s: shares(count[lang, s]) for s in sources}

        def gap(a, b):
            return (a - b) ** 2 // (a + b)

        for s in sources:
            pairs = [(-sum(gap(p[s][t], p[o][t]) for t in kept), o.encode()) for o in sources if o != s]
            terms = [(-gap(p[s][t], q[t]), t.encode()) for t in kept if count[lang, s][t] and p[s][t] > q[t]]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
                out += [(lang, s, part, i.decode(), -v, r) for r, (v, i) in enumerate(found, 1)]
    return sorted(out)


def check(spark, rows, least=3, top=4):
    df = spark.createDataFrame([(i, t, l, s, "x", 1) for i, (t, l, s) in enumerate(rows)], SCHEMA).repartition(5)
    got = source_divergence(df, least, top)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, got.collect())) == brute(rows, least, top)


def test_against_brute_force(spark):
    rng = random.Random(5)
    words = ["Alpha", "beta", "GAMMA", "über", "Ü", "don't", "x1y", "漢字", "z", "\x85", "\xa0q"] + [f"w{chr(97 + i)}" for i in range(20)]
    rows = [(" ".join(rng.choices(words, k=rng.randrange(30))), rng.choice(["en", "de", None]), rng.choice(["a", "b", "c", None, "é"])) for _ in range(120)]
    rows += [("one text that fills many rows beta", "en", rng.choice("ab"))] * 100  # copies
    rows += [("one text that fills many rows beta", "de", s) for s in "abc"]
    rows += [(None, "fr", "only"), ("", "it", "a"), ("1 2 3", "it", "b"), ("rare words", "it", "c"), ("long " * 100_000, "en", "a")]
    check(spark, rows)


def test_ties_and_no_kept_terms(spark):
    check(spark, [("a b c d e f", "en", s) for s in ("x", "y", "z")] * 2, least=2)
    check(spark, [("a b", "en", "x"), ("c", "en", "y")], least=5)
    assert source_divergence(spark.createDataFrame([], SCHEMA)).count() == 0


def test_a_task_sends_a_text_once(spark):
    rows = [(i, "same text", "en", "ab"[i % 2], "x", 1) for i in range(1000)]
    sent = collapse(spark.createDataFrame(rows, SCHEMA).coalesce(1)).collect()
    assert len(sent) == 3 and sum(r["text"] is not None for r in sent) == 1
    assert sum(r["n"] for r in sent) == 1000
