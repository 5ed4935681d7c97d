import random
import re

from ledgerloom.llm.licenses import DICE, TEMPLATES, find_licenses, license_report, templates

SCHEMA = "doc_id long, text string, license string, a int"


def bigrams(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    return set(zip(w, w[1:]))


def brute_force(text):
    best = {}
    for unit in re.split(r"[\n\r]+", text or "") + re.split(r"[\n\r]+|[.!?][ \t]+", text or ""):
        a = bigrams(unit)
        for name, notice in TEMPLATES:
            b = bigrams(notice)
            dice = 2 * len(a & b) / (len(a) + len(b)) if a else 0
            if dice >= DICE:
                best[name] = max(best.get(name, 0), dice)
    return best


def test_equals_brute_force(spark):
    rng = random.Random(8)
    rows = [(0, None), (1, ""), (2, "MIT"), (3, "..\n\n!! ")]
    for d in range(4, 120):
        words = rng.choice(TEMPLATES)[1].split()
        for _ in range(rng.randrange(4)):
            words[rng.randrange(len(words))] = rng.choice(["THE", "work", "été", "under", ""])
        around = " ".join(rng.choice(["und", "The", "of", "License"]) for _ in range(rng.randrange(30)))
        rows.append((d, f"{around}. {' '.join(words)}\n{around}! {around}"))
    docs = spark.createDataFrame([(d, t, "x", 0) for d, t in rows], SCHEMA)
    got = {}
    for r in find_licenses(docs, templates(spark)).collect():
        got.setdefault(r["doc_id"], {})[r["license"]] = r["dice"]
    want = {d: brute_force(t) for d, t in rows}
    assert got == {d: b for d, b in want.items() if b}
    assert len(got) > 40


def test_report_and_defined_cases(spark):
    line = "Released under the MIT License."
    docs = spark.createDataFrame([(1, line, "", 0), (1, line + " " + line, "", 0), (None, line, "", 0), (2, None, "", 0)], SCHEMA)
    got = sorted(tuple(r) for r in license_report(docs, templates(spark)).collect())
    assert got == [(1, 1, "MIT", 1.0), (2, 0, "", None)]
    assert license_report(docs.limit(0), templates(spark)).count() == 0
    assert find_licenses(docs, templates(spark).limit(0)).count() == 0


def test_a_long_text_and_a_hot_row(spark):
    words = "the work is under terms of this license version licensed and a public".split()
    rng = random.Random(3)
    filler = lambda n: "\n".join(" ".join(rng.choice(words) for _ in range(9)) for _ in range(n))
    notice = TEMPLATES[6][1]
    rows = [(1, f"{filler(3000)}\n{notice}\n{filler(3000)}")] + [(2, notice)] * 300
    got = {}
    for r in find_licenses(spark.createDataFrame([(d, t, "x", 0) for d, t in rows], SCHEMA), templates(spark)).collect():
        got.setdefault(r["doc_id"], {})[r["license"]] = r["dice"]
    assert got[1]["GPL-3.0"] == 1 and got[2] == brute_force(notice)
