import hashlib
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerloom.llm import pii, secret_scan
from ledgerloom.llm.boosting import platt
from ledgerloom.llm.spans import PERSONAL, SECRET, base_spans, digest, digits_of, hashed_rows, luhn, redacted

SCHEMA = "doc_id long, text string, spans string, kind int"


def plain(text):
    """The patterns as they are written down, with Python's own matcher."""
    out = set()
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.add(("email", *m.span()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.add(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        if 14 <= len(digits_of(m[0])) <= 19 and luhn(digits_of(m[0])):
            out.add(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(digits_of(m[0])) <= 15:
            out.add(("phone", *m.span()))
    key = "(password|passwd|secret|token|api_?key)"
    key = re.sub("[a-z]", lambda c: f"[{c[0]}{c[0].upper()}]", key)
    for m in re.finditer(key + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m[2]) >= 6:
            out.add(("assign", *m.span()))
    for m in re.finditer("AKIA[A-Z0-9]+", text):
        if len(m[0]) >= 20:
            out.add(("access", *m.span()))
    for m in re.finditer("[0-9a-f]+", text):
        if len(m[0]) >= 24:
            out.add(("hex", *m.span()))
    return out


PIECES = ["a@b.c", "@", ".", "+", "x.y", "4539578763621486", "4539 5787-6362 1486", "1.2.3.4", "255.256.1.1", "1.2.3.4.5.6.7.8",
          "+1 (502) 555-6996", "+12", " ", "é", "((", "-", "00000001.2.3.4", "token", "PassWord", "api_key", "toKen", "=", ": ", '"',
          "abc123", "AKIA", "ABCDEFGHIJ0123456789", "deadbeef", "0" * 30, "%", "mail.example.com", "ſecret=abcdef", "7"]


@settings(max_examples=600, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=14).map("".join))
def test_rules_equal_their_patterns(text):
    got = {*base_spans(text, PERSONAL), *base_spans(text, SECRET)}
    assert got == plain(text)


def test_luhn_and_redaction():
    assert luhn("4539578763621486") and not luhn("4539578763621487")
    spans = [("hex", 4, 9), ("assign", 0, 9), ("email", 12, 14)]
    assert redacted("token abc de@ x", spans) == "[ASSIGN] de[EMAIL]x"


def test_long_texts_take_linear_time():
    for text in ("1" * 200_000, "a" * 200_000, "a." * 100_000 + "@", "+1" + "(" * 100_000, "token" + " " * 100_000, "f" * 23 + "g" * 100_000):
        base_spans(text, PERSONAL), base_spans(text, SECRET), pii.proposals(text), secret_scan.candidates(text)


@pytest.fixture(scope="module")
def judge():
    return pii.Judge([])


@pytest.fixture(scope="module")
def detector():
    return secret_scan.Detector([])


def test_trees_find_other_notations_and_leave_other_numbers(judge):
    rng = random.Random(99)
    good = bad = found = wrong = 0
    for i in range(400):
        kind = pii.KINDS[i % 4]
        for value in pii._rewritten(kind, pii._value(kind, rng), rng):
            good += 1
            found += bool(judge.find(f"the words {value} and of"))
        value = pii._other(rng)[1]
        if not plain(value):
            bad += 1
            wrong += bool(judge.find(f"the words {value} and of"))
    assert found >= 0.9 * good and wrong <= 0.05 * bad


def test_network_finds_other_secrets_and_leaves_ordinary_runs(detector):
    rng = random.Random(99)
    secrets = [secret_scan._secret(rng) for _ in range(300)]
    found = sum(bool(detector.find(f"the words {s} and of")) for s in secrets)
    words = ["page", "index", "reading", "of", "value"]
    ordinary = [secret_scan._harmless(rng, words) for _ in range(300)]
    wrong = sum(bool(detector.find(f"the words {s} and of")) for s in ordinary)
    assert found >= 285 and wrong <= 15


def test_tables(spark, judge, detector):
    rows = [(1, "mail é a.b@c.org, 1.2.3.4"), (1, "mail é a.b@c.org, 1.2.3.4"), (2, None), (None, ""), (4, "token=abcdef12 x")]
    docs = spark.createDataFrame([(d, t, "", 0) for d, t in rows], SCHEMA)
    got = [(r["doc_id"], [(s["kind"], s["start"], s["end"], s["base"]) for s in r["spans"]]) for r in pii.find_personal_data(docs, judge).collect()]
    one = (1, [("email", 7, 16, True), ("ip", 18, 25, True)])
    assert got == [one, one, (2, []), (None, []), (4, [])]
    clean = pii.redact_personal_data(docs, judge).collect()
    assert [r["text"] for r in clean] == ["mail é [EMAIL], [IP]"] * 2 + [None, "", "token=abcdef12 x"]
    assert clean[0].asDict().keys() == {"doc_id", "text", "spans", "kind"}
    got = secret_scan.find_secrets(docs, detector).collect()
    assert [tuple(s) for s in got[4]["spans"]] == [("assign", 0, 14, True)]
    shown = digest(pii.find_personal_data(docs, judge), PERSONAL).collect()[0]
    base = hashlib.sha256(b"email:7:16,ip:18:25").hexdigest()
    assert tuple(shown) == (1, 1, 1, 0, 0, base, "email:7:16,ip:18:25")
    assert pii.find_personal_data(docs.limit(0)).count() == 0
    assert secret_scan.find_secrets(docs.limit(0)).count() == 0


def test_samples_do_not_follow_the_order_of_files(spark):
    rows = spark.range(4000).selectExpr("id % 3000 as id", "string(id % 3000) as text")
    one, other = hashed_rows(rows.repartition(7), 500), hashed_rows(rows.orderBy("text").coalesce(1), 500)
    assert one == other and 400 < len(one) < 600 and max(one)[0] > 2500
    assert len(hashed_rows(rows, 5000)) == 3000 and hashed_rows(rows.limit(0), 5) == []


def test_values_behind_a_key_are_candidates():
    find = lambda t: [t[a:b] for a, b in secret_scan.candidates(t)]
    assert find("pwd: hunter2x, passphrase: correcthorsebattery") == ["hunter2x", "correcthorsebattery"]
    assert find("x = abcdefghijkl0123456789 https://example.com/a b:12345") == ["abcdefghijkl0123456789"]
    assert find("key=abc.defghijklmn0123 :" + " " * 9 + "valueone") == ["defghijklmn0123", "valueone"]
    secret_scan.candidates(": " * 100_000 + "=" * 100_000)


def test_network_tells_keys_of_secrets_from_other_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    fitted = secret_scan.fit_detector(docs.filter("doc_id % 2 = 0"))
    rng = random.Random(5)
    words = sorted({w for r in docs.filter("doc_id % 2 = 1").collect() for w in re.findall("[A-Za-z]{2,14}", r["text"] or "")})
    texts = {b: ["the words {}{} and of".format(*secret_scan._behind_a_key(rng, words, b)) for _ in range(300)] for b in (True, False)}
    found, wrong = (sum(bool(fitted.find(t)) for t in texts[b]) for b in (True, False))
    assert found >= 270 and wrong <= 30
    assert fitted.held_out["recall"] >= 0.97


def test_network_learns_from_every_finding_of_all_documents(spark):
    rng = random.Random(3)
    many = " and ".join(f"token={secret_scan._random(rng, '0123456789abcdef', 20)}" for _ in range(300))
    assert sum(label for *_, label in secret_scan._snippets(many)) == 300
    long = "secret: " + secret_scan._random(rng, "abcXYZ0189", 500)
    rows = [(1, many), (2, many), (3, None), (4, long), *((i, f"words {i} note: value{i}a here") for i in range(5, 205))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    snippets = secret_scan.all_snippets(docs)
    assert snippets.filter("label").count() == 301 and snippets.filter("not label").count() == 200
    assert snippets.selectExpr("max(end - start)").first()[0] == len(long)
    examples = secret_scan.dealt_examples(snippets, 4, invented=40).collect()
    assert len(examples) == 501 + 4 * 160 and {r.part for r in examples} == {0, 1, 2, 3}
    assert sum(len(r.codes) == 80 * -(-len(long) // 48) for r in examples) == 1
    assert secret_scan.parts_of(snippets, 512) == 1 and secret_scan.parts_of(snippets.filter("end - start > 100"), 2) == 6
    one, other = (secret_scan.fit_detector(d, size=150, invented=40) for d in (docs.repartition(5), docs.orderBy("text").coalesce(1)))
    assert (one.net.state() == other.net.state()).all() and one.least == other.least and one.held_out == other.held_out
    assert one.held_out["recall"] >= 0.98
    assert len(secret_scan.dealt_examples(snippets.limit(0), 2, invented=40).collect()) == 320


def test_threshold_and_calibration_are_those_of_all_margins(spark):
    rng = np.random.default_rng(1)
    margin = np.concatenate([rng.normal(0, 2, 3000), np.full(500, 0.25), [1e9, -1e9]])
    label = rng.random(len(margin)) < 1 / (1 + np.exp(-margin.clip(-9, 9)))
    rows = spark.createDataFrame([(float(m), bool(y)) for m, y in zip(margin, label)], "margin double, label boolean")
    for n in (0, 1, 1700, 1800, len(margin) - 1):
        assert secret_scan.nth_smallest(rows, "margin", n, few=10) == np.sort(margin)[n]
    near = rows.filter("abs(margin) < 9")
    within = np.abs(margin) < 9
    assert secret_scan._calibrated(near) == pytest.approx(platt(margin[within], label[within].astype(float)), abs=1e-6)
