"""Fixed rules for personal data and secrets, and what both span operators share.

A rule's matches are the leftmost non-overlapping matches of its pattern over the whole text, less
those that fail its check; offsets are code points, ends exclusive.  The functions find the same
spans as the plain patterns in the docstrings, in time linear in the text.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Span = tuple[int, int]

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A | re.I
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")


def luhn(digits: str) -> bool:
    total = sum(int(d) for d in digits[::-2])
    return (total + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def emails(text: str) -> Iterator[Span]:
    r"""``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+``, found from its @."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            free = domain.end()
            yield start, free
        at = text.find("@", max(at + 1, free))


def ips(text: str) -> Iterator[Span]:
    r"""``[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)`` with parts of at most 255."""
    for m in _IP.finditer(text):
        parts = [p.lstrip("0") for p in m[0].split(".")]
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
            yield m.span()


def cards(text: str) -> Iterator[Span]:
    r"""``[0-9]([\x20-]?[0-9])+`` with 14 to 19 digits that pass Luhn."""
    for m in _CARD.finditer(text):
        if 14 <= m.end() - m.start() <= 37:
            digits = digits_of(m[0])
            if 14 <= len(digits) <= 19 and luhn(digits):
                yield m.span()


def phones(text: str) -> Iterator[Span]:
    r"""``\+[0-9][\x20().0-9-]+[0-9]`` with 10 to 15 digits."""
    for m in _PHONE.finditer(text):
        if 10 <= len(digits_of(m[0])) <= 15:
            yield m.span()


def assigns(text: str) -> Iterator[Span]:
    """A named value of 6 characters or more; see ``_ASSIGN``."""
    return (m.span() for m in _ASSIGN.finditer(text) if len(m[2]) >= 6)


def accesses(text: str) -> Iterator[Span]:
    """``AKIA[A-Z0-9]+`` of 20 characters or more."""
    return (m.span() for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20)


def hexes(text: str) -> Iterator[Span]:
    """``[0-9a-f]+`` of 24 characters or more."""
    return (m.span() for m in _HEX.finditer(text))


PERSONAL: dict[str, Callable[[str], Iterable[Span]]] = {"email": emails, "ip": ips, "card": cards, "phone": phones}
SECRET: dict[str, Callable[[str], Iterable[Span]]] = {"assign": assigns, "access": accesses, "hex": hexes}


def base_spans(text: str, rules: dict[str, Callable]) -> list[tuple[str, int, int]]:
    return [(kind, start, end) for kind, rule in rules.items() for start, end in rule(text)]


def overlaps(start: int, end: int, taken: Iterable[tuple]) -> bool:
    return any(start < t[-1] and t[-2] < end for t in taken)


def redacted(text: str, spans: list[tuple[str, int, int]]) -> str:
    """Each run of overlapping spans becomes the name of the first of them."""
    out, at, open_until = [], 0, -1
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start >= open_until:
            out += [text[at:start], f"[{kind.upper()}]"]
        at = open_until = max(open_until, end)
    return "".join(out) + text[at:]


SPANS = "array<struct<kind:string,start:long,end:long,base:boolean>>"
SPANS_ARROW = pa.list_(
    pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())])
)

#: ``text -> [(kind, start, end, is base)]``
Finder = Callable[[str], list[tuple[str, int, int, bool]]]


def spans_column(texts: list[str | None], finder: Finder) -> pa.Array:
    names = ("kind", "start", "end", "base")
    return pa.array([[dict(zip(names, s)) for s in finder(t or "")] for t in texts], SPANS_ARROW)


def find_spans(docs: DataFrame, make_finder: Callable[[], Finder]) -> DataFrame:
    """``doc_id, spans`` in the order of start, then kind as the rules list them."""

    def found(batches):
        finder = make_finder()
        for batch in batches:
            spans = spans_column(batch.column("text").to_pylist(), finder)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), spans], names=["doc_id", "spans"])

    return docs.mapInArrow(found, f"doc_id long, spans {SPANS}")


def redact_spans(docs: DataFrame, make_finder: Callable[[], Finder]) -> DataFrame:
    """``docs`` with all its columns; ``text`` without what the finder finds.  A null stays null."""

    def cleaned(batches):
        finder = make_finder()
        for batch in batches:
            texts = [
                t and redacted(t, [s[:3] for s in finder(t)]) for t in batch.column("text").to_pylist()
            ]
            at = batch.schema.get_field_index("text")
            yield batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))

    out = docs.mapInArrow(cleaned, docs.schema)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def named(spans: Column) -> Column:
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def digest(found: DataFrame, kinds: Iterable[str]) -> DataFrame:
    """Counts of base spans by kind, the hash of the base spans, and all spans."""
    base = F.filter("spans", lambda s: s["base"])

    def count(kind: str) -> Column:
        own = F.filter(base, lambda s: s["kind"] == F.lit(kind))
        return F.size(own).cast("bigint").alias(f"n_{kind}")

    counts = [count(kind) for kind in kinds]
    return found.select("doc_id", *counts, F.sha2(named(base), 256).alias("base_sha256"), named(F.col("spans")).alias("spans"))


def hashed_share(docs: DataFrame, rows: int, salt: int) -> DataFrame:
    """About ``rows`` rows, chosen by a hash of the id: the bounded sample a model is fitted on."""
    share = min(1.0, rows / max(1, docs.count()))
    return docs.filter(F.pmod(F.xxhash64("doc_id", F.lit(salt)), F.lit(1 << 30)) < int(share * (1 << 30)))


def hashed_rows(found: DataFrame, rows: int) -> list[tuple]:
    """About ``rows`` different rows, chosen by a hash of the whole row, in order; all, if they are fewer."""
    found = found.distinct()
    share = min(1.0, rows / max(1, found.count()))
    chosen = found.filter(F.pmod(F.xxhash64(*found.columns), F.lit(1 << 30)) < int(share * (1 << 30)))
    return sorted(tuple(r) for r in chosen.collect())
