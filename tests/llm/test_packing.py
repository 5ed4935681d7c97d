import random
import tracemalloc

import numpy as np
import public_tokenizers
import pyarrow as pa
from tokenizers import Tokenizer

from ledgerloom.llm.packing import hilbert_keys, pack_documents, sequences, token_batches

SCHEMA = "doc_id long, text string, start string, ids int"
PATH = public_tokenizers.path("word_bpe_49k.json")


def test_neighbours_on_the_curve_are_neighbours_in_space():
    for dimensions, bits in ((2, 4), (3, 3), (4, 2)):
        axes = np.indices([1 << bits] * dimensions).reshape(dimensions, -1).T
        keys = hilbert_keys(axes, bits)
        assert sorted(keys) == list(range(1 << (bits * dimensions)))
        walk = axes[np.argsort(keys)]
        assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_every_id_lies_in_exactly_one_piece(spark):
    rng = random.Random(2)
    odd = ["İstanbul ΟΔΟΣ Σ", "a b c\x1cd\x85e", "x<|endoftext|>y <|startoftext|>", "é ́e", "don't it's 12345", "", "\n\t ", "漢字 ß"]
    rows = [(i, t) for i, t in enumerate(odd)] + [(100, None), (None, "no id"), (101, "long " * 900 + "run" * 500)]
    rows += [(200 + i, " ".join(rng.choice(["the", "Of", "zebra,", "été"]) for _ in range(rng.randrange(300)))) for i in range(60)]
    rows += [(7, "again")] * 40
    docs = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], SCHEMA).repartition(6)
    pieces = pack_documents(docs, PATH, 64)
    got = pieces.collect()
    own = Tokenizer.from_file(PATH)
    want = sorted(([*own.encode(t or "", add_special_tokens=False).ids, 2] for _, t in rows))
    by_sequence, by_document = {}, {}
    for r in sorted(got, key=lambda r: (r["sequence_id"], r["offset"])):
        ids = np.frombuffer(r["ids"], "<u4")
        assert len(ids) == r["length"] > 0
        assert r["offset"] == sum(map(len, by_sequence.setdefault(r["sequence_id"], [])))
        by_sequence[r["sequence_id"]].append(ids)
        if r["start"] == 0:
            by_document.setdefault((r["doc_id"], r["doc_tokens"]), []).append([])
        by_document[r["doc_id"], r["doc_tokens"]][-1].append((r["start"], ids))
    back = []
    for copies in by_document.values():
        for parts in copies:
            at = 0
            for start, ids in parts:
                assert start == at
                at += len(ids)
            back.append([int(i) for _, ids in parts for i in ids])
    assert sorted(back) == want
    total = sum(map(len, want))
    assert sorted(by_sequence) == list(range(-(-total // 64)))
    assert all(sum(map(len, p)) == 64 for s, p in by_sequence.items() if s < total // 64)
    whole = {r["sequence_id"]: np.frombuffer(r["ids"], "<u4") for r in sequences(pieces).collect()}
    assert all((np.concatenate(by_sequence[s]) == whole[s]).all() for s in by_sequence)


def test_empty_table(spark):
    assert pack_documents(spark.createDataFrame([], SCHEMA), PATH).count() == 0


def test_a_worker_holds_little_at_a_time():
    rng = random.Random(4)
    texts = [" ".join(rng.choice(["the", "of", "zebra", f"{rng.randrange(10**6)}"]) for _ in range(1500)) for _ in range(1000)]
    batch = pa.record_batch([pa.array(range(len(texts))), pa.array(texts)], names=["doc_id", "text"])
    whole = sum(b.num_rows for b in token_batches([batch.slice(0, 1)], PATH))  # the tokenizer is loaded before
    tracemalloc.start()
    try:
        whole += sum(b.num_rows for b in token_batches([batch], PATH))
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert whole == len(texts) + 1
    assert most < 80 << 20
