import hashlib
import math
import random
from fractions import Fraction

import numpy as np
import pytest

from ledgerloom.llm.vector_codes import Walk, encode_vectors, tree, tree_order, with_label_error

SCHEMA = "vec_id long, embedding array<double>, label int, code string, error int"


def floored(x):
    return math.floor(Fraction(x) * 256)


def brute(rows, parts, entries, rounds):
    """Plain Python, in unbounded whole numbers."""
    good = [(i, v, l) for i, v, l in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    ids = sorted({i for i, _, _ in good if i is not None})
    of = {i: min(v for j, v, _ in good if j == i) for i in ids}
    if not ids or len(of[ids[0]]) % parts:
        return []
    size = len(of[ids[0]])
    good = [(i, [floored(x) for x in v], l) for i, v, l in good if len(v) == size]
    of = {i: [floored(x) for x in min(v for j, v, _ in rows if j == i and v and len(v) == size)] for i in ids if any(j == i for j, _, _ in good)}
    d = size // parts
    cut = [[v[p * d : p * d + d] for p in range(parts)] for _, v, _ in good]
    books = [[of[i][p * d : p * d + d] for i in sorted(of)[:entries]] for p in range(parts)]

    def near(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(books[p]))

    for _ in range(rounds):
        found = [[near(p, c[p])[1] for c in cut] for p in range(parts)]
        for p in range(parts):
            for k in range(len(books[p])):
                own = [c[p] for c, f in zip(cut, found[p]) if f == k]
                if own:
                    books[p][k] = [sum(x) // len(own) for x in zip(*own)]
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    out = []
    for (i, _, label), c in zip(good, cut):
        pairs = [near(p, c[p]) for p in range(parts)]
        out.append((i, "".join(f"{k:02x}" for _, k in pairs), sum(f for f, _ in pairs), label, sha))
    return out


def check(spark, rows, parts=4, entries=8, rounds=2):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(3)
    got = [(r["vec_id"], r["code"].hex(), r["error"], None if r["label"] is None else int(r["label"]), r["codebooks_sha256"])
           for r in encode_vectors(df, parts, entries, rounds).collect()]
    want = [(i, c, e if e < 2**63 else None, l, s) for i, c, e, l, s in brute(rows, parts, entries, rounds)]
    assert sorted(map(str, got)) == sorted(map(str, want))
    return got


def test_against_brute_force_with_odd_rows(spark):
    rng = random.Random(1)
    rows = [(i, [rng.choice([-1.0, 0.25, 0.5, rng.gauss(0, 1)]) for _ in range(12)], rng.choice([None, 1, 2])) for i in range(150)]
    rows += [(200, None, 1), (201, [], 1), (202, [1.0] * 11 + [None], 1), (203, [float("nan")] * 12, 2), (204, [math.inf] * 12, 2)]
    rows += [(205, [1.0] * 8, 1), (None, [0.1] * 12, 3), (3, [9.0] * 12, 1), (3, [-9.0] * 12, 1)] + [(206, [0.0] * 12, None)] * 40
    assert len(check(spark, rows)) == 150 + 1 + 2 + 40


def test_numbers_beyond_a_long(spark):
    rng = random.Random(2)
    rows = [(i, [rng.gauss(0, 1) * 10.0 ** rng.choice([0, 5, 30, 300]) for _ in range(4)], 1) for i in range(30)]
    check(spark, rows, parts=2, entries=4)


def test_few_rows_and_none(spark):
    check(spark, [(5, [0.5, -0.5], 1)], parts=2, entries=8)
    check(spark, [(None, [0.5, -0.5], 1)], parts=2)
    check(spark, [(1, [0.5, -0.5, 1.0], 1)], parts=2)
    assert encode_vectors(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("spread", [1, 4, 1000])
def test_walk_equals_plain_assignment(spread):
    rng = np.random.default_rng(spread)
    x = rng.integers(-spread, spread + 1, (3, 700, 3))
    entries = rng.integers(-spread, spread + 1, (3, 37, 3))
    walk = Walk(x, tree(x, tree_order(x), 16), entries)
    far = ((x[:, :, None] - entries[:, None]) ** 2).sum(axis=3)
    assert (walk.assigned() == far.argmin(axis=2)).all()
    counts, sums = walk.sums()
    for p in range(3):
        for e in range(37):
            own = x[p][far[p].argmin(axis=1) == e]
            assert counts[p, e] == len(own) and (sums[p, e] == own.sum(axis=0)).all()


def test_whole_nodes_are_assigned_at_once():
    rng = np.random.default_rng(0)
    centres = rng.integers(-100_000, 100_000, (1, 20, 4))
    x = centres[:, rng.integers(0, 20, 3000)] + rng.integers(-5, 6, (1, 3000, 4))
    walk = Walk(x, tree(x, tree_order(x), 16), centres)
    assert sum(w.shape[1] for w in walk.whole) < 1500
    assert sum((w[2] - w[1]).sum() for w in walk.whole) > 1500


def test_label_errors(spark):
    rows = [(i, [i / 7, -i / 3], label) for i, label in enumerate([1, 1, None, None, 2] * 20)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    got = with_label_error(encode_vectors(df, 2, 4)).collect()
    sums = {}
    for r in got:
        sums[r["label"]] = sums.get(r["label"], 0) + r["error"]
    assert len(got) == 100 and all(r["label_error"] == sums[r["label"]] for r in got)
