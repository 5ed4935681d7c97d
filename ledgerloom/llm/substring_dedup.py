"""Removal of repeated passages by Rabin-Karp hashes of every window of words.

A window is ``size`` consecutive words of one document.  A word goes if it lies in a window whose
words also start in a document with a smaller id.  Windows are judged on the input, so the earliest
document of each repeated passage keeps it.

1. Documents are dealt into slots, which are ranges of ``doc_id``.  A slot hashes each of its
   windows and sends its distinct hashes, sorted, to buckets of the hash: one row for each slot
   and bucket, so a window that a third of all documents hold costs one entry a slot.
2. A bucket finds the hashes that an earlier slot holds too and returns one bit an entry.
3. The slot, read again from the same exchange, adds what repeats inside it, merges the windows to
   maximal intervals and cuts them out.

Every window counts; nothing is sampled.  The hash has 64 bits: among n different windows about
n**2 / 2**65 pairs collide (0.0005 for 135 million windows, some thousands for 10**12, each of
which would cost one passage of ``size`` words).

Defined cases: a null text has no words; a text shorter than a window loses nothing and is no
source; rows without ``doc_id`` are kept whole and are no source; rows that repeat a ``doc_id``
are judged one by one and never remove each other's words; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from ledgerloom.llm.common import id_and_text
from ledgerloom.llm.textblocks import Words, window_hashes, window_starts, word_hashes, words_of

SLOT_BYTES = 8 << 20  # of text that one group of documents has, on average
BUCKET_WINDOWS = 1 << 20  # entries that one bucket has, on average
_KEPT_BYTES = 7  # of each hash; the bucket number holds the others

RESULT = "doc_id long, n_words long, removed array<struct<start:long,end:long>>, kept_text string"


def _windows(texts: list[bytes | None], size: int) -> tuple[Words, np.ndarray, np.ndarray]:
    words = words_of(texts)
    starts = window_starts(words.first, size)
    return words, starts, window_hashes(word_hashes(words), starts, size)


def _bucket_edges(hashes: np.ndarray, bits: int) -> np.ndarray:
    """Where each bucket begins in sorted hashes, and the end."""
    tops = np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits)
    return np.append(np.searchsorted(hashes, tops), len(hashes))


def _packed(hashes: np.ndarray) -> bytes:
    """The low bytes, plane by plane: in sorted hashes the upper planes compress."""
    planes = hashes.view(np.uint8).reshape(-1, 8)[:, :_KEPT_BYTES]
    return np.ascontiguousarray(planes.T).tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(_KEPT_BYTES, -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, :_KEPT_BYTES] = planes.T
    return out.view(np.uint64).ravel()


def _texts(group: pa.Table) -> list[bytes | None]:
    return group.column("text").cast(pa.binary()).to_pylist()


def _slot_hashes(group: pa.Table, size: int) -> np.ndarray:
    known = group.filter(pa.compute.is_valid(group.column("doc_id")))
    return np.unique(_windows(_texts(known), size)[2])


def _removed(doc_ids: np.ndarray, texts: list[bytes | None], size: int, seen: dict[int, bytes], bits: int):
    """Words of the slot, and for each whether it goes; texts are in order of ``doc_ids``."""
    words, starts, hashes = _windows(texts, size)
    gone = np.zeros(words.first[-1] + 1, np.int64)
    if len(starts):
        unique, first_at, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        earlier = np.zeros(len(unique), bool)
        edges = _bucket_edges(unique, bits)
        for bucket, packed in seen.items():
            low, high = edges[bucket], edges[bucket + 1]
            flags = np.unpackbits(np.frombuffer(packed, np.uint8))
            if not high - low <= len(flags) < high - low + 8:
                raise RuntimeError("a slot's documents changed while the query ran")
            earlier[low:high] = flags[: high - low]
        owner = np.repeat(np.arange(len(texts)), np.diff(words.first))[starts]
        repeated = earlier[inverse] | (doc_ids[owner] > doc_ids[owner[first_at[inverse]]])
        np.add.at(gone, starts[repeated], 1)
        np.add.at(gone, starts[repeated] + size, -1)
    return words, np.cumsum(gone[:-1]) > 0


def _cut(words: Words, gone: np.ndarray) -> tuple[list, list[bytes]]:
    """Each text's maximal removed intervals, and its kept words joined by one space."""
    step = np.diff(np.concatenate(([0], gone.astype(np.int8), [0])))
    # An interval ends with its text, also where the next text begins with one.
    inner = words.first[1:-1]
    inner = np.unique(inner[(inner > 0) & (inner < len(gone))])
    inner = inner[gone[inner] & gone[inner - 1]]
    begins = np.union1d(np.flatnonzero(step[:-1] == 1), inner)
    finishes = np.union1d(np.flatnonzero(step[1:] == -1) + 1, inner)
    kept = np.zeros(len(words.data) + 1, np.int32)
    np.add.at(kept, words.starts[~gone], 1)
    np.add.at(kept, words.ends[~gone] + 1, -1)  # with the byte behind the word
    kept = np.cumsum(kept[:-1]) > 0
    data = words.data.copy()
    data[words.ends] = 0x20
    out, at = data[kept].tobytes(), np.concatenate(([0], np.cumsum(kept)))[words.bounds]
    of_text = np.searchsorted(begins, words.first)
    intervals, texts = [], []
    for t in range(len(words.bounds) - 1):
        own = slice(of_text[t], of_text[t + 1])
        low = words.first[t]
        intervals.append([{"start": int(b - low), "end": int(e - low)} for b, e in zip(begins[own], finishes[own])])
        texts.append(out[at[t] : max(at[t], at[t + 1] - 1)])
    return intervals, texts


def remove_repeated_windows(docs: DataFrame, size: int = 13, slot_bytes: int = SLOT_BYTES) -> DataFrame:
    """One row per document: ``doc_id, n_words, removed, kept_text``.

    ``removed`` lists maximal intervals of word positions, ends exclusive; ``kept_text`` joins the
    other words by one space.
    """
    docs = id_and_text(docs)
    n_bytes = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_slots = max(1, -(-n_bytes // slot_bytes))
    bounds = []
    if n_slots > 1:
        at = [i / n_slots for i in range(1, n_slots)]
        row = docs.agg(F.percentile_approx("doc_id", at, 100 * n_slots)).first()
        bounds = sorted(set(row[0] or []))
    bits = max(8, (n_bytes // 6 // BUCKET_WINDOWS).bit_length())
    edges = np.array(bounds, np.int64)

    @F.pandas_udf(LongType())
    def slot_of(doc_id: pd.Series) -> pd.Series:
        missing = doc_id.isna()
        ids = doc_id.fillna(0).astype("int64").to_numpy()
        return pd.Series(np.where(missing, -1, np.searchsorted(edges, ids, side="right")))

    def hashed(group: pa.Table) -> pa.Table:
        unique = _slot_hashes(group, size)
        cuts = _bucket_edges(unique, bits)
        full = np.flatnonzero(np.diff(cuts))
        slot = group.column("slot")[0].as_py()
        return pa.table(
            {
                "slot": pa.array([slot] * len(full), pa.int64()),
                "bucket": pa.array(full, pa.int64()),
                "hashes": pa.array([_packed(unique[cuts[b] : cuts[b + 1]]) for b in full], pa.binary()),
            }
        )

    def compared(group: pa.Table) -> pa.Table:
        group = group.sort_by("slot")
        parts = [_unpacked(x) for x in group.column("hashes").to_pylist()]
        values = np.concatenate(parts)
        order = np.argsort(values, kind="stable")  # of equal hashes the earliest slot comes first
        repeated = np.zeros(len(values), bool)
        in_order = values[order]
        repeated[order[1:]] = in_order[1:] == in_order[:-1]
        flags = np.split(repeated, np.cumsum([len(p) for p in parts])[:-1])
        hit = [i for i, f in enumerate(flags) if f.any()]
        return pa.table(
            {
                "slot": group.column("slot").take(pa.array(hit, pa.int64())),
                "bucket": group.column("bucket").take(pa.array(hit, pa.int64())),
                "flags": pa.array([np.packbits(flags[i]).tobytes() for i in hit], pa.binary()),
            }
        )

    def cut(group: pa.Table, marks: pa.Table) -> pa.Table:
        group = group.sort_by("doc_id")  # rows without an id are in a slot of their own
        seen = dict(zip(marks.column("bucket").to_pylist(), marks.column("flags").to_pylist()))
        ids, texts = group.column("doc_id"), _texts(group)
        if ids.null_count:
            words = words_of(texts)
            gone = np.zeros(words.first[-1], bool)
        else:
            words, gone = _removed(ids.to_numpy(), texts, size, seen, bits)
        intervals, kept = _cut(words, gone)
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        return pa.table(
            {
                "doc_id": ids,
                "n_words": pa.array(np.diff(words.first), pa.int64()),
                "removed": pa.array(intervals, kind),
                "kept_text": pa.array(kept, pa.binary()).cast(pa.string()),
            }
        )

    placed = docs.withColumn("slot", slot_of("doc_id")).repartition(n_slots, "slot")
    hashes = placed.groupBy("slot").applyInArrow(hashed, "slot long, bucket long, hashes binary")
    marks = hashes.groupBy("bucket").applyInArrow(compared, "slot long, bucket long, flags binary")
    return placed.groupBy("slot").cogroup(marks.groupBy("slot")).applyInArrow(cut, RESULT)
