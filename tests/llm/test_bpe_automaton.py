import itertools
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer, pre_tokenizers

from ledgerloom.llm.bpe_automaton import Automaton, Codec, decode, encode

PATH = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, ids string, lang int"


@pytest.fixture(scope="module")
def codec():
    return Codec(PATH)


def merged(word, merges, of):
    """Rules in their order, each from left to right: the definition."""
    tokens = [of[bytes([b])] for b in word]
    for u, v, w in merges:
        out, i = [], 0
        while i < len(tokens):
            if tokens[i : i + 2] == [u, v]:
                out.append(w)
                i += 2
            else:
                out.append(tokens[i])
                i += 1
        tokens = out
    return tokens


@pytest.mark.parametrize("seed", range(6))
def test_automaton_has_exactly_the_paths_of_the_rules(seed):
    rng = random.Random(seed)
    of = {b"a": 0, b"b": 1, b"c": 2}
    merges = []
    while len(merges) < 14:
        u, v = rng.choices(list(of), k=2)
        if u + v not in of and len(u + v) < 7:
            of[u + v] = len(of)
            merges.append((of[u], of[v], of[u + v]))
    automaton = Automaton({t: w for w, t in of.items()}, merges)
    words = [bytes(w) for n in range(1, 8) for w in itertools.product(b"abc", repeat=n)]
    words += [bytes(rng.choices(b"abc", k=rng.randrange(41, 90))) for _ in range(50)]
    import numpy as np

    got = [np.frombuffer(x, "<i4").tolist() for x in automaton.encode_words(words)]
    assert got == [merged(w, merges, of) for w in words]


def test_random_texts_as_the_library_does(codec):
    own = Tokenizer.from_file(PATH)
    rng = random.Random(3)
    bits = ["a", "The", "th", "in", " ", "  ", "\n", "\t", "é", "漢", "🙂", "'", "'s", "'ll", "1", "22", "\x85", "　", "\xa0", "\x1c",
            "<|endoftext|>", "<|endof", "!?", "====", "aaaaaa", "́", "²", "ⅷ", "﻿", "ſ", "\U000323b0", "-- "]
    texts = ["".join(rng.choices(bits, k=rng.randrange(60))) for _ in range(800)]
    texts += ["a" * 3000, "".join(rng.choices("etaoin", k=9000)), "x y " * 60_000 + "<|endoftext|>" + "漢" * 2000, ""]
    for text in texts:
        import numpy as np

        ids = np.frombuffer(codec.encode_batch([text])[0], "<i4").tolist()
        want = own.encode(text, add_special_tokens=False).ids
        assert ids == want, text[:80]
        assert codec.decode(ids).decode("utf-8", "replace") == own.decode(want, skip_special_tokens=False)


def test_character_classes(codec):
    split = pre_tokenizers.ByteLevel(add_prefix_space=False)
    points = [*range(0x3100), *range(0xA000, 0xB000), *range(0x10800, 0x11000), *range(0x18C00, 0x19200), *range(0x32000, 0x33500)]
    for low in range(0, len(points), 256):
        text = "".join(f"a{chr(p)}a1{chr(p)}1 {chr(p)}" for p in points[low : low + 256])
        words = [w for part in codec.words(text) for w in part]
        cuts = [0, *itertools.accumulate(map(len, words))]
        assert cuts == [0, *[end for _, (_, end) in split.pre_tokenize_str(text)]], hex(points[low])


def test_any_id_decodes_to_its_label(spark, codec):
    rng = random.Random(4)
    own = Tokenizer.from_file(PATH)
    rows = [(i, [rng.randrange(50257) for _ in range(30)]) for i in range(50)] + [(90, []), (91, None), (92, [50256, 99999, 15])]
    got = {r["doc_id"]: r["text"] for r in decode(spark.createDataFrame(rows, "doc_id long, ids array<int>"), PATH).collect()}
    for i, ids in rows[:50]:
        assert got[i] == own.decode(ids, skip_special_tokens=False)
    assert got[90] == got[91] == "" and got[92] == "<|endoftext|>" + own.decode([15])


def test_rows_of_any_kind(spark):
    own = Tokenizer.from_file(PATH)
    texts = [(1, None), (2, ""), (None, "no id"), (3, "same"), (3, "same"), (4, "long word" + "q" * 70_000 + " " + "of text " * 200_000)]
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in texts], SCHEMA)
    got = sorted((str(r["doc_id"]), r["ids"], r["text"]) for r in encode(docs, PATH, with_text=True).collect())
    assert got == sorted((str(i), own.encode(t or "", add_special_tokens=False).ids, t or "") for i, t in texts)
    assert encode(spark.createDataFrame([], SCHEMA), PATH).count() == 0
