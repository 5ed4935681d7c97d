"""Packing along a Hilbert curve: similar documents share sequences, and almost nothing is padded.

1. One pass turns each text into token ids and into a point: its hashed words, projected by random
   signs to ``DIMENSIONS`` numbers, each squeezed to ``BITS`` bits.  The ids are stored once.
2. The documents are range-sorted by the Hilbert key of the point.  A running total of their tokens
   along the curve, slice by slice, gives each document's place in one endless row of tokens.
3. The row is cut every ``length`` tokens.  A document that crosses a cut goes on in the next
   sequence, so all sequences but the last are full.

The sort is by key and row, so many equal documents are dealt over several slices.

Defined cases: a null text counts as empty, and an empty one is the end id alone; repeated rows and
rows without ``doc_id`` are packed like any other; an empty table gives an empty result.
"""

from __future__ import annotations

import string
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import id_and_text
from ledgerloom.llm.textblocks import LOWER, Words, raw_texts, slices, word_hashes, words_of
from ledgerloom.operators.ranking import running_total_before
from ledgerloom.session import work_folder

LENGTH = 4096
END_ID = 2
DIMENSIONS, BITS = 4, 8
CACHED_RUNS = 300_000
CACHED_BYTES = 64
SLICE = 1 << 20  # bytes of text, or of ids, that a worker has in hand at a time

PIECES = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


# What a byte is: 1 an ASCII letter, 2 ASCII punctuation but the apostrophe, which may bind letters.
_CLASS = np.zeros(256, np.int8)
_CLASS[list(string.ascii_letters.encode())] = 1
_CLASS[list(string.punctuation.replace("'", "").encode())] = 2


def runs_of(texts: list[bytes | None]) -> Words:
    """The texts' runs: words, also parted between ASCII letters and punctuation, in lower case.

    A text that may hold a special token is left in one piece, since those are matched as written.
    """
    words = words_of(texts)
    special = np.array([b"<|" in (t or b"") for t in texts], bool)
    kind = _CLASS[words.data]
    pair = kind[1:] + kind[:-1] * 4
    cut = np.zeros(len(words.data), bool)
    cut[1:] = (pair == 6) | (pair == 9)  # a letter before punctuation, or behind it
    if special.any():
        cut &= ~np.repeat(special, np.diff(words.bounds))
    starts, ends = cut.copy(), cut
    starts[words.starts], ends[words.ends] = True, True  # an end is a byte behind, at most the last space
    starts, ends = np.flatnonzero(starts), np.flatnonzero(ends)
    data = words.data if special.any() else LOWER[words.data]
    return Words(data, starts, ends, np.searchsorted(starts, words.bounds), words.bounds)


class RunIds:
    """Ids of texts from those of their runs, as bytes.

    Only for tokenizers that drop white space and case and part letters from punctuation, as
    ``word_bpe_49k`` does: a text's ids then are those of its runs in turn.  Runs of letters that
    a batch brings for the first time are encoded together.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.kind = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.known: dict[bytes, bytes] = {}

    def _encoded(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.kind).tobytes()

    def _learn(self, runs: list[bytes]) -> None:
        letters = []
        for run in runs:
            text = run.decode("utf-8", "replace")
            if text.isalpha() and len(run) <= CACHED_BYTES:
                letters.append((run, text))
            else:
                self.known[run] = self._encoded(text)
        for at in range(0, len(letters), 500):
            own = letters[at : at + 500]
            found = self.tokenizer.encode(" ".join([t for _, t in own]), add_special_tokens=False)
            ids, owner = np.array(found.ids, self.kind), np.array(found.word_ids, np.int64)
            ends = np.searchsorted(owner, np.arange(len(own) + 1)).tolist()
            if len(ids) and owner[-1] == len(own) - 1:
                self.known.update([(r, ids[x:y].tobytes()) for (r, _), x, y in zip(own, ends[:-1], ends[1:])])
            else:  # the tokenizer parts some of them after all
                self.known.update([(r, self._encoded(t)) for r, t in own])

    def of(self, words: Words, hashes: np.ndarray) -> list[bytes]:
        """The ids of each text; equal runs of one batch are looked up once, by their hash."""
        if len(self.known) > CACHED_RUNS:
            self.known.clear()
        _, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        raw = words.data.tobytes()
        runs = [raw[x:y] for x, y in zip(words.starts[first].tolist(), words.ends[first].tolist())]
        self._learn([r for r in runs if r not in self.known])
        packed = list(map(self.known.__getitem__, runs))
        for run in [r for r in runs if len(r) > CACHED_BYTES]:
            self.known.pop(run, None)
        size = np.array(list(map(len, packed)), np.int64) // self.kind.itemsize
        flat, begin = np.frombuffer(b"".join(packed), self.kind), np.cumsum(size) - size
        count = size[inverse]
        ends = np.concatenate(([0], np.cumsum(count)))
        ids = flat[np.repeat(begin[inverse] - ends[:-1], count) + np.arange(ends[-1])]
        at = ends[words.first].tolist()
        return [ids[x:y].tobytes() for x, y in zip(at[:-1], at[1:])]


@lru_cache(maxsize=1)
def _run_ids(path: str) -> RunIds:
    return RunIds(path)


def hilbert_keys(points: np.ndarray, bits: int) -> np.ndarray:
    """The place of each point (rows of ``bits``-bit whole numbers) on the Hilbert curve
    (Skilling's transform: undo the turns from the top bit down, then Gray-code)."""
    x = [points[:, i].astype(np.uint64) for i in range(points.shape[1])]
    one = np.uint64(1)
    for b in range(bits - 1, 0, -1):
        low = np.uint64((1 << b) - 1)
        for i in range(len(x)):
            turned = (x[i] >> np.uint64(b)) & one == one
            swap = np.where(turned, np.uint64(0), (x[0] ^ x[i]) & low)
            x[0] = np.where(turned, x[0] ^ low, x[0] ^ swap)
            if i:
                x[i] = x[i] ^ swap
    for i in range(1, len(x)):
        x[i] = x[i] ^ x[i - 1]
    flip = np.zeros(len(points), np.uint64)
    for b in range(bits - 1, 0, -1):
        flip = np.where((x[-1] >> np.uint64(b)) & one == one, flip ^ np.uint64((1 << b) - 1), flip)
    key = np.zeros(len(points), np.uint64)
    for b in range(bits - 1, -1, -1):
        for value in x:
            key = (key << one) | (((value ^ flip) >> np.uint64(b)) & one)
    return key.astype(np.int64)


def document_points(words: Words, hashes: np.ndarray) -> np.ndarray:
    """Hashed bags of words, projected by random signs and squeezed to whole numbers."""
    counts = np.diff(words.first)
    out = np.empty((len(counts), DIMENSIONS), np.int64)
    for k in range(DIMENSIONS):
        signs = ((hashes >> np.uint64(8 + k)) & np.uint64(1)).astype(np.int8) * 2 - 1
        sums = np.concatenate(([0], np.cumsum(signs, dtype=np.int64)))
        z = (sums[words.first[1:]] - sums[words.first[:-1]]) / np.sqrt(np.maximum(counts, 1))
        out[:, k] = np.minimum((1 << BITS) / (1 + np.exp(-1.7 * z.clip(-20, 20))), (1 << BITS) - 1)
    return out


def token_batches(batches, tokenizer: str):
    """Batches of ``doc_id, text`` as ``doc_id, curve, n_tokens, ids``, by slices of bounded size: a worker
    shares its executor's memory with a grown heap."""
    known = _run_ids(tokenizer)
    end = np.array([END_ID], known.kind).tobytes()
    for batch in batches:
        for part in slices(batch, limit=SLICE):
            words = runs_of(raw_texts(part))
            hashes = word_hashes(words)
            ids = [i + end for i in known.of(words, hashes)]
            keys = hilbert_keys(document_points(words, hashes), BITS)
            del words, hashes
            n = pa.array([len(i) // known.kind.itemsize for i in ids], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(keys), n, pa.array(ids, pa.binary())],
                names=["doc_id", "curve", "n_tokens", "ids"],
            )
        pa.default_memory_pool().release_unused()
    known.known.clear()  # the worker goes on to other tasks, of other stages too


def _tokenised(docs: DataFrame, tokenizer: str) -> DataFrame:
    """``row, doc_id, curve, n_tokens, ids``, stored: row numbers must not change any more."""
    tokens = docs.mapInArrow(lambda batches: token_batches(batches, tokenizer), "doc_id long, curve long, n_tokens long, ids binary")
    tokens = tokens.withColumn("row", F.monotonically_increasing_id())
    path = work_folder(docs.sparkSession, "tokens")
    tokens.write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.schema(tokens.schema).parquet(path)


def pack_documents(docs: DataFrame, tokenizer: str, length: int = LENGTH) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids, doc_tokens, sequence_id, offset``.

    ``ids`` are little-endian unsigned 32-bit numbers.  ``tokenizer`` is the path of a file for the
    ``tokenizers`` library whose tokenizer drops white space, readable on every executor.
    """
    spark = docs.sparkSession
    tokens = _tokenised(id_and_text(docs), tokenizer)
    light = tokens.select("row", "curve", "n_tokens").repartitionByRange("curve", "row")
    light = light.withColumn("slice", F.spark_partition_id().cast("bigint"))
    path = work_folder(spark, "curve")
    light.write.parquet(path)
    light = spark.read.schema(light.schema).parquet(path)
    placed = running_total_before(light, ["curve", "row"], F.col("slice"), F.col("n_tokens"), "before")

    def cut(batches):
        kind = _run_ids(tokenizer).kind
        names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
        for batch in batches:
            for part in slices(batch, ("ids",), SLICE):
                before, n = part.column("before").to_numpy(), part.column("n_tokens").to_numpy()
                sequences = (before + n - 1) // length - before // length + 1
                of = np.repeat(np.arange(len(n)), sequences)
                nth = np.arange(len(of)) - np.repeat(np.cumsum(sequences) - sequences, sequences)
                sequence = before[of] // length + nth
                low = np.maximum(before[of], sequence * length)
                high = np.minimum(before[of] + n[of], (sequence + 1) * length)
                wide = [np.frombuffer(i, kind).astype("<u4") for i in part.column("ids").to_pylist()]
                start = low - before[of]
                ids = [wide[d][s : s + k].tobytes() for d, s, k in zip(of, start, high - low)]
                columns = [
                    part.column("doc_id").take(pa.array(of)), pa.array(start), pa.array(high - low),
                    pa.array(ids, pa.binary()), pa.array(n[of]), pa.array(sequence), pa.array(low - sequence * length),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=names)
            pa.default_memory_pool().release_unused()

    rows = tokens.select("row", "doc_id", "n_tokens", "ids").join(placed.select("row", "before"), "row")
    return rows.select("doc_id", "n_tokens", "ids", "before").mapInArrow(cut, PIECES)


def sequences(pieces: DataFrame) -> DataFrame:
    """``sequence_id, n_tokens, ids``: the pieces of each sequence in order, at most one sequence's
    tokens in a group."""
    parts = F.array_sort(F.collect_list(F.struct("offset", F.hex("ids").alias("ids"))))
    joined = F.unhex(F.array_join(F.transform(parts, lambda p: p["ids"]), ""))
    return pieces.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), joined.alias("ids"))
