"""Whole texts, headers and wrapped notices; runs of lines against brute force."""

import random
import re
import textwrap

from ledgerloom.llm.license_texts import texts
from ledgerloom.llm.licenses import DICE, TEMPLATES, all_templates, find_licenses, templates


def words(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def brute_force(text):
    cut = r"[\n\r]+|[.!?][ \t]+"
    wrapped = r"[.!?][ \t\n\r]+|\r?\n[ \t]*\r?\n"
    lines = [words(x) for x in re.split(r"[\n\r]+", text)]
    units = [(w, False) for w in lines] + [(words(x), False) for c in (cut, wrapped) for x in re.split(c, text)]
    units += [(sum(lines[i:j], []), True) for i in range(len(lines)) for j in range(i + 1, len(lines) + 1)]
    best = {}
    for w, run in units:
        a = set(zip(w, w[1:]))
        for name, notice in TEMPLATES:
            n = words(notice)
            b = set(zip(n, n[1:]))
            dice = 2 * len(a & b) / (len(a) + len(b))
            if a and dice >= DICE and not (run and len(w) > len(n) * (2 - DICE) / DICE):
                best[name] = max(best.get(name, 0), dice)
    return best


def found(spark, rows, known):
    got = {}
    for r in find_licenses(spark.createDataFrame(rows, "doc_id long, text string"), known).collect():
        got.setdefault(r["doc_id"], {})[r["license"]] = r["dice"]
    return got


def test_runs_equal_brute_force(spark):
    rng = random.Random(4)
    rows = []
    for d in range(120):
        w = rng.choice(TEMPLATES)[1].split()
        for _ in range(rng.randrange(3)):
            w[rng.randrange(len(w))] = rng.choice(["THE", "work", "under", ""])
        around = [" ".join(rng.choice(["und", "The", "of", "License"]) for _ in range(rng.randrange(8))) for _ in range(2)]
        rows.append((d, f"{around[0]}.\t{textwrap.fill(' '.join(w), rng.choice([12, 30, 60]))}! {around[1]}\n{around[0]}"))
    want = {d: brute_force(t) for d, t in rows}
    got = found(spark, rows, templates(spark))
    assert got == {d: b for d, b in want.items() if b}
    assert len(got) > 60


def test_whole_texts_headers_and_wrapped_notices(spark):
    known = texts()
    rows = [(i, f"int main;\n\n{textwrap.fill(t, 70)}\n\nand more of the file") for i, (_, t) in enumerate(known) if len(words(t)) > 10]
    bsd = next(t for name, t in TEMPLATES if name == "BSD-3-Clause")
    rows += [(900, textwrap.fill(bsd, 80)), (901, "MIT License\n\nCopyright (c) 2020 A. Lee"), (902, "nothing of the kind\nhere")]
    got = found(spark, rows, all_templates(spark))
    for i, _ in rows[:-3]:
        assert known[i][0] in got[i], known[i][0]
    assert got[900]["BSD-3-Clause"] == 1 and got[901] == {"MIT": 1.0} and 902 not in got
