"""Near-duplicate documents by circulant MinHash, confirmed by exact Jaccard similarity.

A document is the set of its distinct shingles (``size`` words in a row, A-Z lower-cased).

*Signature.*  Circulant MinHash (Li and Li, 2022): one permutation scatters the shingles over
``2**20`` places, and coordinate ``k`` is the minimum of a second permutation that is shifted
circularly by ``k``.  So the coordinates a shingle contributes are one contiguous run of a stored
permutation.

*Candidates.*  200 coordinates are banded.  40 bands of 5 miss a pair with similarity 0.8 with
probability (1 - 0.8**5)**40 = 1.2e-7.  One bit of each of 256 coordinates is a sketch: the bits
of a pair with similarity s agree with probability (1 + s) / 2.  A pair of one band is compared
in full unless its sketches agree in fewer bits than ``DEVIATIONS`` standard deviations below what
the wanted similarity gives (below 1e-6), so documents that merely share a passage cost a bit
count.  Where many pairs are left, two bits of each of 1024 coordinates tell more.

*Links.*  Equal sets are one class, found by a grouped minimum, so thousands of exact copies cost
one row each.  Among classes, each bucket first compares its members with one pivot.  Confirmed
links are contracted to components, and only pairs of different components are left to compare.
For the members concerned, the shingles that no other of them has are counted: a pair cannot be
linked if what one of them shares with anyone is less than the common part it would need.  Each
bucket then tries its most central member as pivot, and every pair that is still left and may be
linked is compared.  So no pair of different components that share a band goes unchecked, while a
large group of near copies costs some stars instead of all its pairs.  Links are confirmed on full
sets.

Defined cases: a text with fewer than ``size`` words is one shingle, its whole sequence; null
texts and texts without words are linked with nothing and kept; rows that repeat a ``doc_id`` are
judged by their own text; a row without ``doc_id`` joins the class of its text if that has an id
(it then is a copy) and is kept otherwise; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import erase, id_and_text, let_go, stored, temporary
from ledgerloom.llm.components import connected_components
from ledgerloom.llm.textblocks import mix, raw_texts, slices, window_hashes, window_starts, word_hashes, words_of

PLACES = 1 << 20
BANDS, ROWS = 40, 5
BITS = 256
DEEP = 1024  # coordinates of the finer sketch, two bits of each
DEVIATIONS = 5.0
SEED = 20240817

WORDS = [f"s{i}" for i in range(BITS // 64)]
SIGNATURE = "doc_id long, text_hash long, n_shingles long, set_key binary, bands array<long>, " + ", ".join(f"{w} long" for w in WORDS)


def shingle_sets(texts: list[bytes | None], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Each text's distinct shingle hashes, sorted, one text after the other; and where they begin."""
    words = words_of(texts, lower=True)
    hashes = word_hashes(words)
    counts = np.diff(words.first)
    starts = window_starts(words.first, size)
    shingles = window_hashes(hashes, starts, size)
    short = np.flatnonzero((counts > 0) & (counts < size))
    at = np.searchsorted(starts, words.first)
    if len(short):
        whole = [window_hashes(hashes, words.first[t : t + 1], int(counts[t]))[0] for t in short]
        shingles = np.insert(shingles, at[short], whole)
        at += np.searchsorted(short, np.arange(len(at)))
    for low, high in zip(at[:-1], at[1:]):
        shingles[low:high].sort()
    new = np.ones(len(shingles) + 1, bool)
    new[1:-1] = shingles[1:] != shingles[:-1]
    new[at] = True
    keep = np.flatnonzero(new[:-1])
    return shingles[keep], np.searchsorted(keep, at)


@lru_cache(maxsize=2)
def _circulant(coordinates: int) -> np.ndarray:
    """Row ``i`` is the second permutation at places ``i, i + 1, ...``, around the circle."""
    second = np.random.default_rng(SEED).permutation(PLACES).astype(np.uint32)
    around = np.concatenate((second, second[:coordinates]))
    return np.lib.stride_tricks.sliding_window_view(around, coordinates)


def signatures(shingles: np.ndarray, at: np.ndarray, coordinates: int) -> np.ndarray:
    rows = _circulant(coordinates)
    places = (mix(shingles ^ np.uint64(SEED)) >> np.uint64(64 - 20)).astype(np.int64)
    out = np.full((len(at) - 1, coordinates), PLACES, np.uint32)
    step = 1024
    for low in range(0, len(places), step):
        high = min(low + step, len(places))
        first = int(np.searchsorted(at, low, side="right")) - 1
        last = int(np.searchsorted(at, high, side="left"))
        begins = np.maximum(at[first:last], low)
        full = np.flatnonzero(np.minimum(at[first + 1 : last + 1], high) > begins)
        least = np.minimum.reduceat(rows[places[low:high]], begins[full] - low, axis=0)
        out[first + full] = np.minimum(out[first + full], least)
    return out


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key for each band, which also tells the bands apart."""
    values = signature.reshape(len(signature), bands, rows).astype(np.uint64)
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), values.shape[:2]).copy()
    for r in range(rows):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + values[:, :, r])
    return key.view(np.int64)


def sketches(signature: np.ndarray, bit: int = 0) -> np.ndarray:
    """One bit of each coordinate, 64 to a number."""
    bits = np.packbits(((signature >> bit) & 1).astype(np.uint8), axis=1, bitorder="little")
    return bits.view(np.int64)


def _most_different(places: int, bits: int, per_cent: int) -> int:
    """In how many places the sketches of a pair that is to be linked may differ."""
    similar = per_cent / 100
    share = similar + (1 - similar) / 2**bits
    return places - int(places * share - DEVIATIONS * np.sqrt(places * share * (1 - share)))


def alike(per_cent: int) -> str:
    """Whether the sketches ``s0...`` and ``t0...`` may belong to a pair that is to be linked."""
    differ = " + ".join(f"bit_count({w} ^ t{w[1:]})" for w in WORDS)
    return f"{differ} <= {_most_different(BITS, 1, per_cent)}"


def much_alike(per_cent: int) -> str:
    """The same for the finer sketches ``deep`` and ``o_deep``: all first bits, then all second."""
    half = DEEP // 64
    differ = " + ".join(
        f"bit_count((deep[{i}] ^ o_deep[{i}]) | (deep[{i + half}] ^ o_deep[{i + half}]))" for i in range(half)
    )
    return f"{differ} <= {_most_different(DEEP, 2, per_cent)}"


def sign_documents(docs: DataFrame, size: int, bands: int, rows: int) -> DataFrame:
    """``doc_id, n_shingles, set_key, bands`` and the sketch; without words the key is null."""

    def sign(batches):
        for batch in batches:
            for part in slices(batch):
                shingles, at = shingle_sets(raw_texts(part), size)
                counts = np.diff(at)
                raw = shingles.tobytes()
                keys = [
                    hashlib.blake2b(raw[8 * low : 8 * high], digest_size=16).digest() if high > low else None
                    for low, high in zip(at[:-1], at[1:])
                ]
                signature = signatures(shingles, at, max(BITS, bands * rows))
                key = band_keys(np.ascontiguousarray(signature[:, : bands * rows]), bands, rows)
                sketch = sketches(signature[:, :BITS])
                flat = pa.array(key[counts > 0].ravel(), pa.int64())
                ends = np.concatenate(([0], np.cumsum((counts > 0) * bands))).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        part.column("text_hash"),
                        pa.array(counts, pa.int64()),
                        pa.array(keys, pa.binary()),
                        pa.ListArray.from_arrays(pa.array(ends), flat),
                        *(pa.array(np.ascontiguousarray(column)) for column in sketch.T),
                    ],
                    names=["doc_id", "text_hash", "n_shingles", "set_key", "bands", *WORDS],
                )

    return docs.mapInArrow(sign, SIGNATURE)


def _confirmed(pairs: DataFrame, texts: DataFrame, size: int, per_cent: int) -> DataFrame:
    """``a, b, linked`` for each pair, on full shingle sets."""

    def confirm(batches):
        for batch in batches:
            for part in slices(batch, ("text_a", "text_b")):
                a, b = part.column("a").to_numpy(), part.column("b").to_numpy()
                sides = raw_texts(part, "text_a") + raw_texts(part, "text_b")
                known = {t: i for i, t in enumerate(dict.fromkeys(sides))}
                shingles, at = shingle_sets(list(known), size)
                linked = []
                for left, right in zip(sides[: len(a)], sides[len(a) :]):
                    i, j = known[left], known[right]
                    x, y = shingles[at[i] : at[i + 1]], shingles[at[j] : at[j + 1]]
                    fits = 100 * min(len(x), len(y)) >= per_cent * max(len(x), len(y))
                    common = len(np.intersect1d(x, y, assume_unique=True)) if fits else 0
                    linked.append(common > 0 and 100 * common >= per_cent * (len(x) + len(y) - common))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(linked, pa.bool_())],
                    names=["a", "b", "linked"],
                )

    left = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    both = pairs.join(right, "b").join(left, "a").select("a", "b", "text_a", "text_b")
    return both.mapInArrow(confirm, "a long, b long, linked boolean")


def _labelled(buckets: DataFrame, components: DataFrame | None) -> DataFrame:
    """``key, node, component`` of the buckets that hold more than one component."""
    if components is None:
        return buckets.withColumn("component", F.col("node"))
    labelled = buckets.join(components, "node", "left").withColumn("component", F.coalesce("component", "node"))
    mixed = labelled.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    return labelled.join(mixed.filter("low < high").select("key"), "key", "left_semi")


def _fit(per_cent: int) -> str:
    """Whether two nodes may be linked at all: what they share is at most what either shares with
    any node, and similarity p needs (1 + p) times the common part to reach p times both sizes."""
    return f"{100 + per_cent} * least(shared, o_shared) >= {per_cent} * (n + o_n)"


def _around_pivots(labelled: DataFrame, order: Column, may_link: str) -> DataFrame:
    """Pairs of each bucket's pivot, the first by ``order``, with the members of other components."""
    own = [c for c in ("n", "shared", "deep") if c in labelled.columns]
    pivot = F.min(F.struct(order.alias("place"), "node", "component", *own, *WORDS)).alias("p")
    other = [F.col(f"p.{c}").alias(f"o_{c}") for c in own] + [F.col(f"p.{w}").alias(f"t{w[1:]}") for w in WORDS]
    pivots = labelled.groupBy("key").agg(pivot).select("key", F.col("p.node").alias("o"), F.col("p.component").alias("c"), *other)
    return _pairs(labelled.join(pivots, "key").filter("component <> c").filter(may_link))


def _pairs(both: DataFrame) -> DataFrame:
    return both.select(F.least("node", "o").alias("a"), F.greatest("node", "o").alias("b")).distinct()


def _split(labelled: DataFrame) -> DataFrame:
    """Adds ``main``, the bucket's largest component, and ``cross``, its pairs that are left."""
    sizes = labelled.groupBy("key", "component").agg(F.count("*").alias("n"))
    mains = sizes.groupBy("key").agg(
        F.max(F.struct("n", "component"))["component"].alias("main"),
        ((F.sum("n") * F.sum("n") - F.sum(F.col("n") * F.col("n"))) / 2).alias("cross"),
    )
    return labelled.join(mains, "key")


def _all_left(split: DataFrame, may_link: str, bands: int) -> DataFrame:
    """Every pair of one bucket and two components, starting from the members outside ``main``.

    A pair that shares several buckets is made in the first of them only; being of two components
    there, none of its buckets has been left out.
    """
    other = [F.col(c).alias(f"o_{c}") for c in ("n", "shared", "deep", "bands")] + [F.col(w).alias(f"t{w[1:]}") for w in WORDS]
    right = split.select("key", F.col("node").alias("o"), F.col("component").alias("c"), *other)
    first = ", ".join(f"if(bands[{i}] = o_bands[{i}], bands[{i}], null)" for i in range(bands))
    once = f"component <> c and (c = main or node < o) and key = coalesce({first})"
    return _pairs(split.filter("component <> main").join(right, "key").filter(once).filter(may_link))


def _deep_sketches(texts: DataFrame, size: int) -> DataFrame:
    """``node, deep``: the finer sketches of some documents."""

    def sketch(batches):
        for batch in batches:
            for part in slices(batch):
                signature = signatures(*shingle_sets(raw_texts(part), size), DEEP)
                deep = np.concatenate([sketches(signature, bit) for bit in (0, 1)], axis=1)
                ends = np.arange(len(deep) + 1, dtype=np.int32) * deep.shape[1]
                rows = pa.ListArray.from_arrays(pa.array(ends), pa.array(deep.ravel()))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), rows], names=["node", "deep"])

    return texts.mapInArrow(sketch, "node long, deep array<long>").dropDuplicates(["node"])


def _shared_parts(nodes: DataFrame, texts: DataFrame, members: DataFrame, size: int) -> DataFrame:
    """``node, n, shared``: the size of each node's set, and how many of its shingles any other of
    ``nodes`` has too."""

    def exploded(batches):
        for batch in batches:
            for part in slices(batch, limit=1 << 20):
                shingles, at = shingle_sets(raw_texts(part), size)
                node = np.repeat(part.column("doc_id").to_numpy(), np.diff(at))
                yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(shingles.view(np.int64))], names=["node", "shingle"])

    own = texts.join(nodes.withColumnRenamed("node", "doc_id"), "doc_id", "left_semi")
    rows = own.mapInArrow(exploded, "node long, shingle long")
    # Of a shingle that several nodes have it does not matter which one stands for it.
    held = rows.groupBy("shingle").agg(F.min("node").alias("node"), F.max("node").alias("last"))
    alone = held.filter("node = last").groupBy("node").agg(F.count("*").alias("alone"))
    sizes = members.filter("doc_id = rep").groupBy(F.col("rep").alias("node")).agg(
        F.min("n_shingles").alias("n"), F.max("n_shingles").alias("top")
    )
    # Rows that repeat an id with other texts: nothing is ruled out by their sizes.
    shared = F.when(F.col("n") < F.col("top"), F.col("top")).otherwise(F.greatest(F.col("n") - F.coalesce("alone", F.lit(0)), F.lit(0)))
    return sizes.join(nodes, "node", "left_semi").join(alone, "node", "left").select("node", "n", shared.alias("shared"))


def near_duplicates(
    docs: DataFrame, size: int = 4, per_cent: int = 80, bands: int = BANDS, rows: int = ROWS
) -> DataFrame:
    """One row per document: ``doc_id, text_hash, n_shingles, component_id, kept``.

    ``text_hash`` tells rows that repeat an id apart; ``component_id`` is the smallest ``doc_id`` that links reach, ``kept`` marks that document.
    """
    docs = id_and_text(docs)
    hashed = docs.withColumn("text_hash", F.xxhash64("text"))
    signed = stored(sign_documents(hashed, size, bands, rows), "signatures")
    # Written, like other grouped tables that are joined with hot keys: then both sides of the
    # join are shuffled for it, and adaptive execution can split the hot side.
    classes = signed.filter("set_key is not null").groupBy("set_key").agg(F.min("doc_id").alias("rep"))
    classes = stored(classes, "classes")
    members = stored(signed.select("doc_id", "text_hash", "n_shingles", "set_key").join(classes, "set_key", "left").drop("set_key"), "members")

    reps = signed.join(classes.select("set_key", F.col("rep").alias("doc_id")), ["set_key", "doc_id"], "left_semi")
    reps = reps.dropDuplicates(["set_key", "doc_id"]).select(F.col("doc_id").alias("node"), "bands", *WORDS)
    reps = stored(reps, "representatives")
    erase(docs.sparkSession, signed.stored_at)  # all that is needed of it has been stored anew
    keyed = reps.select("node", F.explode("bands").alias("key"))
    shared = keyed.groupBy("key").agg(F.min("node").alias("low"), F.max("node").alias("high"))
    shared = stored(shared.filter("low < high").select("key"), "shared")
    buckets = stored(keyed.join(shared, "key", "left_semi").join(reps.select("node", *WORDS), "node"), "buckets")
    nodes = buckets.select(F.col("node").alias("doc_id")).distinct()
    texts = stored(docs.join(nodes, "doc_id", "left_semi"), "texts")
    let_go(docs.sparkSession)
    like = alike(per_cent)

    def linked(pairs: DataFrame, tested: DataFrame | None) -> tuple[DataFrame, DataFrame]:
        """All pairs compared so far, and the components of those that are linked."""
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        found = stored(_confirmed(pairs, texts, size, per_cent), "pairs")
        let_go(docs.sparkSession)
        found = found if tested is None else tested.unionByName(found)
        components = stored(connected_components(found.filter("linked")), "components")
        let_go(docs.sparkSession)
        return found, components

    tested, components = linked(_around_pivots(_labelled(buckets, None), F.col("node"), like), None)
    split = stored(_split(_labelled(buckets, components)), "split")
    if split.limit(1).count():
        # Second pivots: the members that share most of their shingles with others.
        parts = _shared_parts(split.select("node").distinct(), texts, members, size)
        parts = stored(parts.filter(f"100 * shared >= {per_cent} * n"), "shared-parts")
        own = texts.join(parts.select(F.col("node").alias("doc_id")), "doc_id", "left_semi")
        parts = parts.join(_deep_sketches(own, size), "node").join(reps.select("node", "bands").dropDuplicates(["node"]), "node")
        buckets = stored(split.select("key", "node", *WORDS).join(parts, "node"), "left")
        let_go(docs.sparkSession)
        central, like = -F.col("shared") / F.col("n"), f"{like} and {much_alike(per_cent)} and {_fit(per_cent)}"
        tested, components = linked(_around_pivots(_labelled(buckets, components), central, like), tested)
        split = stored(_split(_labelled(buckets, components)), "split")
        if split.limit(1).count():
            tested, components = linked(_all_left(split, like, bands), tested)

    label = F.coalesce("component", "rep", "doc_id")
    found = members.join(components.withColumnRenamed("node", "rep"), "rep", "left")
    return found.select(
        "doc_id",
        "text_hash",
        "n_shingles",
        label.alias("component_id"),
        F.coalesce(F.col("doc_id") == label, F.col("rep").isNull()).alias("kept"),
    )


def drop_near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with all its columns, of each group the document with the smallest id; rows that
    repeat an id and a text become one."""
    with temporary(docs.sparkSession):
        found = near_duplicates(docs, **options).filter("kept")
        kept = found.groupBy(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).agg(F.count("*").alias("_n"))
        kept = stored(kept, "kept", lasting=True)
    rows = docs.withColumn("_text_hash", F.xxhash64(F.col("text").cast("string")))
    same = F.col("doc_id").cast("bigint").eqNullSafe(F.col("_id")) & (F.col("_text_hash") == F.col("_hash"))
    rows = rows.join(kept, same, "left_semi")
    if kept.filter("_n > 1").limit(1).count():  # else the texts need no second shuffle
        rows = rows.dropDuplicates(["doc_id", "_text_hash"])
    return rows.drop("_text_hash")
