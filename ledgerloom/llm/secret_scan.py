"""Secrets: a character convolutional network reads every candidate with its surroundings.

The fixed rules of ``spans.SECRET`` always stand.  Candidates are runs of token characters that
mix letters and digits, and values behind ``=`` or ``:``.  The network scores each one with 16
characters before and behind it; its held-out margins are calibrated, and the threshold is the
highest that still keeps ``RECALL`` of the held-out labelled findings.  Candidates above it that overlap no fixed span become spans of the kind ``token``.

The network learns from all documents and whole texts: findings of the rules are the labelled
positives, other candidates are negative, and each counts once with its surroundings, however many
copies there are.  They are dealt by a hash into parts of about ``PART`` windows; each part adds ``INVENTED`` rounds of invented
ones: positives with other key names, prefixes, alphabets, short and letters-only values behind a key, and as negatives
long words, addresses, numbers and paths.  In an epoch every part learns from all its examples, starting from the same network, and
the parts' states are averaged.  Calibration and threshold come from the margins of all held-out examples of all parts.

Defined cases: a null text has no spans; empty tables give empty results (the network then learns from invented
examples alone); repeated rows are judged one by one; a very long run is read window by window and its best window
counts, in learning, too.
"""

from __future__ import annotations

import random
import re
import string
from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.boosting import platt, platt_by_sums, recall_threshold, sigmoid
from ledgerloom.llm.charcnn import CharCNN
from ledgerloom.llm.common import id_and_text, stored, temporary
from ledgerloom.llm.spans import SECRET, base_spans, find_spans, redact_spans

PART = 12_000  # windows of findings and candidates that one task learns from
INVENTED = 2500  # rounds of four invented examples, in each part
EPOCHS = 8
HELD_OUT = 0.3
RECALL = 0.98
SEED = 11
MIN_LENGTH = 12
MIN_VALUE = 6  # characters of a value behind = or :

KINDS = [*SECRET, "token"]
_PLAIN_RUN = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % MIN_LENGTH)
_VALUE = re.compile(r"""[=:]\x20*["']?([A-Za-z0-9+_][A-Za-z0-9+/_.=-]{%d,})""" % (MIN_VALUE - 1))


def candidates(text: str) -> list[tuple[int, int]]:
    """Runs of token characters with letters and digits both, and values behind = or : that overlap none."""
    out = []
    for m in _PLAIN_RUN.finditer(text):
        run = m[0]
        if not run.isalpha() and not run.isdigit() and re.search("[0-9]", run) and re.search("[A-Za-z]", run):
            out.append(m.span())
    starts, ends = [a for a, _ in out], [b for _, b in out]
    for m in _VALUE.finditer(text):
        start, end = m.span(1)
        if bisect_left(starts, end) == bisect_right(ends, start):  # no run ends behind its start and starts before its end
            out.append((start, end))
    return sorted(out)


def free_candidates(text: str, base: list[tuple[str, int, int]]) -> list[tuple[int, int]]:
    """Candidates that overlap no span of ``base``."""
    asked = candidates(text)
    if base and asked:
        edges = sorted((s, e) for _, s, e in base)
        tops = np.maximum.accumulate([e for _, e in edges])
        before = np.searchsorted([s for s, _ in edges], [e for _, e in asked], side="left") - 1
        asked = [a for a, i in zip(asked, before) if i < 0 or tops[i] <= a[0]]
    return asked


def _random(rng: random.Random, alphabet: str, n: int) -> str:
    return "".join(rng.choice(alphabet) for _ in range(n))


_LETTERS_DIGITS = string.ascii_letters + string.digits


def _secret(rng: random.Random) -> str:
    sort, n = rng.randrange(6), rng.randrange(20, 45)
    if sort == 0:
        return _random(rng, string.hexdigits.lower()[:16], n)
    if sort == 1:
        return "AKIA" + _random(rng, string.ascii_uppercase + string.digits, 16)
    if sort == 2:
        return rng.choice(["sk_live_", "ghp_", "xoxb-", "key-", "pat_"]) + _random(rng, _LETTERS_DIGITS, n)
    if sort == 3:
        return _random(rng, _LETTERS_DIGITS + "+/", n) + "=" * rng.randrange(3)
    if sort == 4:
        return _random(rng, _LETTERS_DIGITS + "_-", n)
    return "eyJ" + _random(rng, _LETTERS_DIGITS + "_-", n)


def _harmless(rng: random.Random, words: list[str]) -> str:
    word = lambda: rng.choice(words)
    sort = rng.randrange(8)
    if sort == 0:
        return "-".join(word() for _ in range(rng.randrange(2, 5))) + str(rng.randrange(100))
    if sort == 1:
        return "/".join(word() for _ in range(rng.randrange(2, 6))) + f"/{rng.randrange(10000)}"
    if sort == 2:
        return "_".join(word() for _ in range(2)) + f"_{rng.randrange(10)}"
    if sort == 3:
        return word().capitalize() * 2 + str(rng.randrange(2000, 2030)) + word()
    if sort == 4:
        return f"{rng.randrange(2000, 2030)}-{rng.randrange(1, 13):02d}-{rng.randrange(1, 29):02d}T{rng.randrange(24):02d}"
    if sort == 5:
        return word() + word() + str(rng.randrange(1000)) + word()
    if sort == 6:
        return _random(rng, string.digits, rng.randrange(10, 20)) + rng.choice(["eur", "usd", "kg", "ms"])
    return "-".join(str(rng.randrange(1000)) for _ in range(3)) + "-" + word() + word()


# Names that announce a secret, beyond those of the rules, and names that do not.
KEYS = ["pwd", "pass", "passphrase", "auth", "credential", "credentials", "private key", "login key", "access code", "pin code"]
LABELS = ["note", "title", "name", "date", "status", "type", "color", "author", "version", "file", "size", "see", "example", "page"]


def _behind_a_key(rng: random.Random, words: list[str], secret: bool) -> tuple[str, str]:
    """A key and a value of 6 characters or more that is short or holds letters only."""
    sort, word = rng.randrange(4), rng.choice(words)
    value = word + rng.choice(words) if sort == 0 else word + str(rng.randrange(10000)) if sort == 1 else word
    if secret and sort > 1:
        value = _random(rng, _LETTERS_DIGITS, rng.randrange(6, 13)) if sort == 2 else word + str(rng.randrange(10)) + rng.choice(words)
    key = rng.choice(KEYS) if secret else rng.choice(rng.choice([LABELS, words]))
    if secret and len(value) < MIN_VALUE:
        value += _random(rng, string.ascii_lowercase, MIN_VALUE)
    elif len(value) < MIN_VALUE:
        value += rng.choice(["-", "_", ""]) + rng.choice([w for w in LABELS if len(w) > 4])
    return key + rng.choice([": ", "=", ":", " = "]), value


Snippet = tuple[str, int, int, bool]  # text around, start and end in it, whether a secret


def _invented(snippets: list[Snippet], rng: random.Random, rounds: int) -> Iterator[Snippet]:
    """Invented values put between the words of a part's snippets, whose own values are shown to 200 characters."""
    contexts = [t[: s + min(e - s, 200)] + t[e:] for t, s, e, _ in snippets]
    contexts = contexts or ["written on the page for all of them to read and keep"]
    words = sorted({w for c in contexts for w in re.findall("[A-Za-z]{2,14}", c)}) or ["page"]

    def placed(lead: str, value: str, label: bool) -> Snippet:
        context = rng.choice(contexts)
        at = context.find(" ", rng.randrange(len(context) + 1)) + 1
        return context[:at] + lead + value + " " + context[at:], at + len(lead), at + len(lead) + len(value), label

    for _ in range(rounds):
        for label, value in ((True, _secret(rng)), (False, _harmless(rng, words))):
            yield placed(rng.choice(["", "", "key: ", "auth=", "Bearer ", "id "]), value, label)
        for label in (True, False):
            yield placed(*_behind_a_key(rng, words, label), label)


def _examples(snippets: list[Snippet], part: int, seed: int, invented: int = INVENTED) -> Iterator[tuple[int, bool, bool, int, bytes]]:
    """Number, whether held out, label, characters and coded windows of a part's snippets and its invented ones."""
    net, held = CharCNN(seed=seed), np.random.default_rng([seed, part])
    snippets = sorted(snippets)
    rows = [*snippets, *_invented(snippets, random.Random(seed + 1_000_003 * part), invented)]
    for i, (text, start, end, label) in enumerate(rows):
        yield i, bool(held.random() < HELD_OUT), label, end - start, net.encode(text, start, end)[0].tobytes()


class Part:
    """The examples of one part, all their windows ready to be read."""

    def __init__(self, rows: Iterable[tuple[int, bool, bool, int, bytes]], net: CharCNN, part: int, seed: int):
        rows = sorted(rows)
        self.net, self.part, self.seed = net, part, seed
        self.held, self.y = np.array([r[1] for r in rows], bool), np.array([r[2] for r in rows], float)
        length = np.array([r[3] for r in rows])
        count = np.maximum(1, -(-length // net.inside))
        self.first = np.cumsum(count) - count
        self.owner = np.repeat(np.arange(len(rows)), count)
        self.codes = np.frombuffer(b"".join(r[4] for r in rows), np.uint8).reshape(len(self.owner), -1)
        self.own = np.minimum(net.inside, length[self.owner] - net.inside * (np.arange(len(self.owner)) - self.first[self.owner]))
        self.many = np.flatnonzero(count[self.owner] > 1)

    def best(self) -> np.ndarray:
        """For each example the window that the network likes best."""
        best = self.first.copy()
        margin = self.net.margin(self.codes[self.many], self.own[self.many])
        order = self.many[np.lexsort((margin, self.owner[self.many]))]
        best[self.owner[order]] = order  # the last one of an owner stays
        return best

    def learn(self, epoch: int) -> None:
        """An epoch over all examples not held out; the first one reads the first windows."""
        rows = (self.best() if epoch else self.first)[~self.held]
        self.net.epoch(self.codes[rows], self.own[rows], self.y[~self.held], [self.seed, self.part, epoch])

    def judged(self) -> tuple[np.ndarray, np.ndarray]:
        """Margins and labels of the examples held out."""
        rows = self.best()[self.held]
        return self.net.margin(self.codes[rows], self.own[rows]), self.y[self.held]


class Detector:
    """Fitted network, calibration and threshold; small, and sent to every task."""

    def __init__(self, snippets: list[Snippet], seed: int = SEED):
        """Fitted here, on the snippets of one part; ``fit_detector`` fits on tables."""
        net = CharCNN(seed=seed)
        part = Part(_examples(snippets, 0, seed), net, 0, seed)
        for epoch in range(EPOCHS):
            part.learn(epoch)
        margin, y = part.judged()
        least = recall_threshold(margin, y, RECALL)
        held_out = {"recall": float((margin >= least)[y > 0].mean()), "precision": float(y[margin >= least].mean())}
        self._take(net, *platt(margin, y), least, held_out)

    @classmethod
    def fitted(cls, *learned) -> Detector:
        detector = cls.__new__(cls)
        detector._take(*learned)
        return detector

    def _take(self, net: CharCNN, slope: float, shift: float, least: float, held_out: dict[str, float]) -> None:
        """``least`` is the threshold as a margin."""
        self.net, self.slope, self.shift, self.least, self.held_out = net, slope, shift, least, held_out
        self.threshold = float(sigmoid(slope * np.array(least) + shift))

    def margin(self, text: str, spans: list[tuple[int, int]]) -> np.ndarray:
        codes, own, owner = self.net.windows([(text, *s) for s in spans])
        best = np.full(len(spans), -np.inf)
        np.maximum.at(best, owner, self.net.margin(codes, own))
        return best

    def probability(self, text: str, spans: list[tuple[int, int]]) -> np.ndarray:
        return sigmoid(self.slope * self.margin(text, spans) + self.shift)

    def find(self, text: str) -> list[tuple[str, int, int, bool]]:
        base = base_spans(text, SECRET)
        chosen = [(k, s, e, True) for k, s, e in base]
        asked = free_candidates(text, base)
        for at in range(0, len(asked), 4096):
            part = asked[at : at + 4096]
            margin = self.margin(text, part)
            chosen += [("token", s, e, False) for (s, e), m in zip(part, margin) if m >= self.least]
        return sorted(chosen, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def _snippets(text: str, around: int = 16) -> Iterator[Snippet]:
    """Every finding of the rules and every other candidate of a text, whole, with its surroundings."""
    base = base_spans(text, SECRET)
    for label, spans in ((True, [b[1:] for b in base]), (False, free_candidates(text, base))):
        for start, end in spans:
            low = max(0, start - 2 * around)
            yield text[low : end + 2 * around], start - low, end - low, label


def _batches(rows: Iterable[tuple], schema: pa.Schema, size: int = 1000) -> Iterator[pa.RecordBatch]:
    def batch(some: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*some), schema.types)], schema=schema)

    waiting: list[tuple] = []
    for row in rows:
        waiting.append(row)
        if len(waiting) == size:
            yield batch(waiting)
            waiting = []
    if waiting:
        yield batch(waiting)


_SNIPPET = pa.schema([("text", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("label", pa.bool_())])
_EXAMPLE = pa.schema(
    [("part", pa.int64()), ("example", pa.int64()), ("held", pa.bool_()), ("label", pa.bool_()), ("length", pa.int64()), ("codes", pa.binary())]
)


def all_snippets(docs: DataFrame) -> DataFrame:
    """Each different snippet of all documents once: ``text, start, end, label``."""

    def found(batches):
        yield from _batches((r for b in batches for t in b.column("text") for r in _snippets(t.as_py() or "")), _SNIPPET)

    return docs.select("text").mapInArrow(found, "text string, start long, end long, label boolean").distinct()


def dealt_examples(snippets: DataFrame, parts: int, seed: int = SEED, invented: int = INVENTED) -> DataFrame:
    """The snippets and the invented ones of each part, coded: ``part, example, held, label, length, codes``."""

    def coded(batches):
        rows = [r for b in batches for r in zip(*(c.to_pylist() for c in b.columns))]
        for part in sorted({r[0] for r in rows}):
            own = [r[1:] for r in rows if r[0] == part and r[1] is not None]
            yield from _batches(((part, *e) for e in _examples(own, part, seed, invented)), _EXAMPLE)

    names = ["text", "start", "end", "label"]
    dealt = snippets.select(F.pmod(F.xxhash64(*names), F.lit(parts)).alias("part"), *names)
    # One row more for each part, so that one without snippets has its invented examples all the same.
    empty = snippets.sparkSession.range(parts).select(F.col("id").alias("part"), *[F.lit(None).cast(snippets.schema[n].dataType).alias(n) for n in names])
    schema = "part long, example long, held boolean, label boolean, length long, codes binary"
    return _by_part(dealt.unionByName(empty), parts).mapInArrow(coded, schema)


def parts_of(snippets: DataFrame, size: int = PART) -> int:
    """So many that each has about ``size`` windows: of long runs fewer go into one part."""
    windows = snippets.agg(F.sum(F.ceil((F.col("end") - F.col("start")) / CharCNN().inside))).first()[0] or 0
    return max(1, -(-windows // size))


def _by_part(rows: DataFrame, parts: int) -> DataFrame:
    """A task for each part."""
    return rows.repartitionById(parts, F.col("part").cast("int"))


def _parts(batches, net: CharCNN, seed: int) -> Iterator[Part]:
    rows = [r for b in batches for r in zip(*(c.to_pylist() for c in b.columns))]
    for part in sorted({r[0] for r in rows}):
        yield Part((r[1:] for r in rows if r[0] == part), net, part, seed)


def _epoch(examples: DataFrame, parts: int, net: CharCNN, epoch: int, seed: int) -> np.ndarray:
    """The mean state of the networks that started as ``net`` and learned from one part each."""
    start = net.state()
    schema = pa.schema([("part", pa.int64()), ("place", pa.int64()), ("value", pa.float64())])

    def learned(batches):
        for part in _parts(batches, net, seed):
            net.restored(start)
            part.learn(epoch)
            state = net.state()
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(state), part.part)), pa.array(np.arange(len(state))), pa.array(state)], schema=schema
            )

    states = _by_part(examples, parts).mapInArrow(learned, "part long, place long, value double")
    # Added in the order of the parts: sums of doubles depend on it.
    ordered = states.groupBy("place").agg(F.array_sort(F.collect_list(F.struct("part", "value"))).alias("values"))
    total = F.aggregate("values", F.lit(0.0), lambda n, x: n + x["value"])
    return np.array([r[1] for r in sorted(ordered.select("place", total / F.lit(parts)).collect())])


def _judged(examples: DataFrame, parts: int, net: CharCNN, seed: int) -> DataFrame:
    schema = pa.schema([("margin", pa.float64()), ("label", pa.bool_())])

    def judged(batches):
        for part in _parts(batches, net, seed):
            margin, y = part.judged()
            yield pa.RecordBatch.from_arrays([pa.array(margin), pa.array(y > 0)], schema=schema)

    return _by_part(examples, parts).mapInArrow(judged, "margin double, label boolean")


def nth_smallest(values: DataFrame, column: str, n: int, few: int = 10_000) -> float:
    """The value that has ``n`` before it in ascending order, exactly: the range that holds it is narrowed until few are left."""
    value = F.col(column)
    low, high, left = values.agg(F.min(value), F.max(value), F.count(value)).first()
    while left > few and low < high:
        inside = values.filter(value.between(low, high))
        slot = F.floor((value - F.lit(low)) / F.lit(high - low) * 1000)
        slots = inside.groupBy(slot.alias("slot")).agg(F.min(value), F.max(value), F.count(value)).orderBy("slot").collect()
        for _, low, high, left in slots:
            if n < left:
                break
            n -= left
    if low == high:
        return low
    return sorted(r[0] for r in values.filter(value.between(low, high)).select(column).collect())[n]


def _calibrated(judged: DataFrame) -> tuple[float, float]:
    up, down = judged.agg(F.count_if("label"), F.count_if(~F.col("label"))).first()
    margin = F.col("margin")
    target = F.when(F.col("label"), (up + 1) / (up + 2)).otherwise(1 / (down + 2))

    def sums(a: float, b: float) -> tuple:
        p = 1 / (1 + F.exp(-F.greatest(F.lit(-40.0), F.least(F.lit(40.0), a * margin + b))))
        w = F.greatest(p * (1 - p), F.lit(1e-6))
        return tuple(judged.agg(*[F.sum(x) for x in ((p - target) * margin, p - target, w * margin * margin, w * margin, w)]).first())

    return platt_by_sums(sums)


def fit_detector(docs: DataFrame, seed: int = SEED, size: int = PART, invented: int = INVENTED) -> Detector:
    with temporary(docs.sparkSession):
        snippets = stored(all_snippets(id_and_text(docs)), "snippets")
        parts = parts_of(snippets, size)
        examples = stored(dealt_examples(snippets, parts, seed, invented), "examples")
        net = CharCNN(seed=seed)
        for epoch in range(EPOCHS):
            net.restored(_epoch(examples, parts, net, epoch, seed))
        judged = stored(_judged(examples, parts, net, seed), "judged")
        secrets = judged.filter("label")
        n = secrets.count()
        least = nth_smallest(secrets, "margin", int((1 - RECALL) * n))
        above = judged.filter(F.col("margin") >= least)
        found, right = above.agg(F.count("*"), F.count_if("label")).first()
        return Detector.fitted(net, *_calibrated(judged), least, {"recall": right / n, "precision": right / found})


def find_secrets(docs: DataFrame, detector: Detector | None = None) -> DataFrame:
    """``doc_id, spans``: every span with its kind, offsets and whether a fixed rule gave it."""
    detector = detector or fit_detector(docs)
    return find_spans(id_and_text(docs), lambda: detector.find)


def redact_secrets(docs: DataFrame, detector: Detector | None = None) -> DataFrame:
    """``docs`` with each span replaced by its kind in brackets."""
    detector = detector or fit_detector(docs)
    return redact_spans(docs, lambda: detector.find)
