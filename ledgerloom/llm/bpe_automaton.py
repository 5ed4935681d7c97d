"""Byte-pair encoding and decoding by an automaton over token sequences.

The automaton reads tokens, not characters, and has exactly those token sequences as paths that the
merge rules make of some word (Berglund, Martens and van der Merwe, 2024).

1. **Compile.** At first one state has an arc for each byte.  The rules go in one after the other.
   The gadget of rule ``(u, v) -> w`` copies the state behind ``u``, takes the ``v`` arc out of the
   copy, leads ``u`` to the copy from now on, and leads ``w`` to where ``v`` led before.  A rule so adds
   one state.  A state differs from the one it was copied from by one lost arc, so the states form a tree,
   and the automaton is stored as that tree: the lost arcs, sorted by token and by place in a walk of it.
   An arc ``w`` leaves a state if its left part ``u`` left it when the rule went in, so whether an arc
   leaves a state takes one look-up for each left part of the arc's token.
2. **Encode.** Texts are split as the tokenizer's pattern says; each different word goes through the
   tables once.  At every byte the words that have a path so far are extended by all tokens that go on
   there and whose arc leaves the state.  Each beginning of a word has exactly one path, so there is
   nothing to choose between.
3. **Decode.** The labels of the arcs, one after the other.

Everything runs inside the tasks that read the texts; no text is shuffled.

Defined cases: a null text counts as empty, an empty one has no ids; bytes that are no UTF-8 count as
U+FFFD; added tokens of the tokenizer are matched as written, longest first, and decoded to their
text; ids outside the vocabulary decode to nothing; repeated rows and rows without ``doc_id`` are
encoded like any other; texts and words of any length are taken in pieces; an empty table gives an
empty result.
"""

from __future__ import annotations

import json
import re
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from ledgerloom.llm.common import id_and_text
from ledgerloom.llm.textblocks import raw_texts, slices

# Fixed values of the pre-splitting rule of byte-level tokenizers: its white space, and its letters and numbers
# below U+0180, where a plain pattern serves.
SPACE = r"\t-\r\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
LATIN_LETTERS, LATIN_NUMBERS = r"A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u017f", r"0-9\xb2\xb3\xb9\xbc-\xbe"
# Letters and numbers that Unicode has only since version 17; the rule's tables are those of 16.
NEWER = (
    "558 58B-58C 88F C5C CDC 208F 209D-209F A7CE-A7CF A7D2 A7D4 A7DD A7E2 A7F1 AB6C-AB6D 107BB-107BF 10940-10959 "
    "10EC5-10EC7 10ED9-10EEE 11B0A 11DB0-11DDB 11DE0-11DE9 11DF1 1246F 12475-1247F 12550-12686 16EA0-16EB8 "
    "16EBB-16ED3 16FF2-16FF6 187F8-187FF 18CD6-18CDA 18D09-18D20 18D80-18DF2 18E00-19191 191A0-191D2 1B123-1B128 "
    "1B168 1D6A6 1DF1F-1DF24 1DF2B-1DF81 1DF90-1DF96 1DFCD-1DFFF 1E6C0-1E6DE 1E6E0-1E6E2 1E6E4-1E6E5 1E6E7-1E6ED "
    "1E6F0-1E6F4 1E6FE-1E6FF 2B73A-2B73F 2B81E 2CEA2-2CEAD 323B0-33479 3D000-3FC3F"
)


def word_pattern(letters: str, numbers: str, other: str) -> str:
    return (
        rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{letters}]+| ?[{numbers}]+| ?{other}+"
        rf"|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
    )


def word_patterns() -> tuple[re.Pattern, regex.Pattern]:
    """The rule for texts below U+0180, and for any text."""
    newer = "".join("-".join(rf"\U{int(x, 16):08X}" for x in span.split("-")) for span in NEWER.split())
    plain = word_pattern(LATIN_LETTERS, LATIN_NUMBERS, f"[^{SPACE}{LATIN_LETTERS}{LATIN_NUMBERS}]")
    any_ = word_pattern(rf"\p{{L}}--[{newer}]", rf"\p{{N}}--[{newer}]", rf"(?:[^{SPACE}\p{{L}}\p{{N}}]|[{newer}])")
    return re.compile(plain), regex.compile("(?V1)" + any_)


BEYOND_LATIN = re.compile("[^\x00-\u017f]")

WIDE = 40  # bytes of words that share a matrix; longer words go one by one
ROWS = 20_000  # words of a matrix
KNOWN_WORDS, KNOWN_BYTES = 400_000, 64  # kept while a task runs
KNOWN_STEPS = 1 << 20
MATCHES = 100_000  # words of a text at a time
LONG = 1 << 16  # bytes of a long word at a time


def byte_of_character() -> dict[str, int]:
    """How the vocabulary spells bytes: visible Latin-1 characters as they are, the others from U+0100 on."""
    visible = [b for b in range(256) if 33 <= b <= 126 or b >= 161 and b != 173]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Automaton:
    """``label[t]`` the bytes of token ``t``; ``target[t]`` the state behind it; state 0 is the start."""

    def __init__(self, labels: dict[int, bytes], merges: list[tuple[int, int, int]]):
        size = max(labels) + 1
        self.label = [labels.get(t, b"") for t in range(size)]
        self.left, self.right = np.full(size, -1), np.full(size, -1)
        self.born = np.zeros(size, np.int64)
        self.target = np.zeros(size, np.int64)
        live = np.array([len(x) == 1 for x in self.label])
        self.rule: dict[tuple[int, int], int] = {}
        parent, lost = [0], [-1]
        when = [0]
        for rank, (u, v, w) in enumerate(merges, 1):
            if not (live[u] and live[v] and self.leaves(u, v)):
                continue  # the pair never comes to stand together
            if live[w]:
                raise ValueError(f"two rules make token {w}")
            live[w] = True
            self.left[w], self.right[w], self.born[w] = u, v, rank
            self.target[w] = self.target[v]
            parent.append(int(self.target[u]))
            lost.append(v)
            when.append(rank)
            self.target[u] = len(parent) - 1
            self.rule[u, v] = rank
        self._tables(np.array(parent), np.array(lost), np.array(when))
        self._trie([t for t in range(size) if live[t]])

    def leaves(self, last: int, token: int) -> bool:
        """Whether ``token`` leaves the state behind ``last``, by the rules that are in so far."""
        x, until = last, len(self.rule) + len(self.born) + 1
        while x >= 0:
            y, above = token, 1 << 60
            while y >= 0:
                rank = self.rule.get((x, y))
                if rank is not None and rank < until and rank <= above:
                    return False
                y, above = int(self.left[y]), int(self.born[y])
            x, until = int(self.right[x]), int(self.born[x])
        return True

    def _tables(self, parent: np.ndarray, lost: np.ndarray, when: np.ndarray) -> None:
        """Number the states in the order of a walk of their tree, so that those below a state are a range."""
        n = len(parent)
        below = np.ones(n, np.int64)
        for s in range(n - 1, 0, -1):
            below[parent[s]] += below[s]
        place, free = np.zeros(n, np.int64), np.ones(n, np.int64)
        for s in range(1, n):
            p = parent[s]
            place[s] = free[p]
            free[s] = place[s] + 1
            free[p] += below[s]
        self.target = place[self.target]
        order = np.lexsort((place[1:], lost[1:])) + 1
        self.lost_key = (lost[order] << 32) | place[order]
        self.lost_until = place[order] + below[order]
        self.lost_when = when[order]

    def _trie(self, tokens: list[int]) -> None:
        nodes: dict[bytes, int] = {b"": 0}
        edges, at = [], [-1]
        for t in tokens:
            word = self.label[t]
            for i in range(1, len(word) + 1):
                if word[:i] not in nodes:
                    edges.append((nodes[word[: i - 1]] << 8 | word[i - 1], len(nodes)))
                    nodes[word[:i]] = len(nodes)
                    at.append(-1)
            at[nodes[word]] = t
        edges.sort()
        self.edge = np.array([e for e, _ in edges])
        self.child = np.array([c for _, c in edges])
        self.token_at = np.array(at)

    def step(self, nodes: np.ndarray, bytes_: np.ndarray) -> np.ndarray:
        """The trie nodes behind the bytes, -1 where there is none."""
        key = nodes << 8 | bytes_
        i = np.minimum(np.searchsorted(self.edge, key), len(self.edge) - 1)
        return np.where(self.edge[i] == key, self.child[i], -1)

    def arcs(self, states: np.ndarray, tokens: np.ndarray) -> np.ndarray:
        """Whether each token's arc leaves each state, from the tables."""
        missing = np.zeros(len(states), bool)
        if not len(self.lost_key):
            return ~missing
        rows, y = np.arange(len(states)), tokens
        above = np.full(len(states), 1 << 60)
        while len(rows):
            s = states[rows]
            i = np.searchsorted(self.lost_key, (y << 32) | s, side="right") - 1
            hit = (i >= 0) & (self.lost_key[i] >> 32 == y) & (s < self.lost_until[i]) & (self.lost_when[i] <= above)
            missing[rows[hit]] = True
            on = ~hit & (self.left[y] >= 0)
            rows, above, y = rows[on], self.born[y[on]], self.left[y[on]]
        return ~missing

    def encode_words(self, words: list[bytes]) -> list[bytes]:
        """The ids of each word, as little-endian 32-bit numbers."""
        out = [b""] * len(words)
        length = np.array(list(map(len, words)), np.int64)
        order = np.argsort(length, kind="stable")
        short = order[length[order] <= WIDE]
        for at in range(0, len(short), ROWS):
            own = short[at : at + ROWS]
            for i, ids in zip(own.tolist(), self._matrix([words[i] for i in own], length[own])):
                out[i] = ids
        steps: dict[int, bool] = {}
        for i in order[len(short) :].tolist():
            out[i] = self._long(words[i], steps)
        return out

    def _matrix(self, words: list[bytes], length: np.ndarray) -> list[bytes]:
        """Words in the order of their length, one byte position after the other."""
        wide = int(length[-1])
        text = np.zeros((len(words), wide), np.int64)
        inside = np.arange(wide) < length[:, None]
        text[inside] = np.frombuffer(b"".join(words), np.uint8)
        last = np.full((len(words), wide + 1), -1)
        start = np.zeros((len(words), wide + 1), np.int64)
        for i in range(wide):
            rows = np.arange(np.searchsorted(length, i, side="right"), len(words))
            state = self.target[last[rows, i]] if i else np.zeros(len(rows), np.int64)
            node = np.zeros(len(rows), np.int64)
            for j in range(i, wide):
                node = self.step(node, text[rows, j])
                on = (node >= 0) & (length[rows] > j)
                rows, state, node = rows[on], state[on], node[on]
                if not len(rows):
                    break
                token = self.token_at[node]
                ends = np.flatnonzero(token >= 0)
                ends = ends[self.arcs(state[ends], token[ends])]
                last[rows[ends], j + 1] = token[ends]
                start[rows[ends], j + 1] = i
        found, at, every = [], length.copy(), np.arange(len(words))
        while at.any():
            found.append(np.where(at > 0, last[every, at], -1))
            at = start[every, at]
        if not found:
            return [b""] * len(words)
        ids = np.stack(found[::-1], axis=1)
        packed, ends = ids[ids >= 0].astype("<i4").tobytes(), (4 * (ids >= 0).sum(axis=1)).cumsum().tolist()
        return [packed[x:y] for x, y in zip([0, *ends], ends)]

    def _long(self, word: bytes, steps: dict[int, bool]) -> bytes:
        """One long word: the tokens at all starts at once, then from start to start."""
        text = np.frombuffer(word, np.uint8).astype(np.int64)
        last, start = np.full(len(text) + 1, -1), np.zeros(len(text) + 1, np.int64)
        for low in range(0, len(text), LONG):
            begins = np.arange(low, min(low + LONG, len(text)))
            node, found, deep = np.zeros(len(begins), np.int64), [], 0
            while len(begins):
                node = self.step(node, text[begins + deep])
                begins, node = begins[node >= 0], node[node >= 0]
                deep += 1
                token = self.token_at[node]
                found.append(np.stack((begins, begins + deep, token))[:, token >= 0])
                inside = begins + deep < len(text)
                begins, node = begins[inside], node[inside]
            found = np.concatenate(found, axis=1)
            found = found[:, np.argsort(found[0], kind="stable")]
            for i, j, token in zip(*found.tolist()):
                before = int(last[i])
                key = before << 32 | token
                if i and key not in steps:
                    if len(steps) > KNOWN_STEPS:
                        steps.clear()
                    steps[key] = self.leaves(before, token)
                if not i or steps[key]:
                    last[j], start[j] = token, i
        ids, at = [], len(text)
        while at:
            ids.append(last[at])
            at = start[at]
        return np.array(ids[::-1], "<i4").tobytes()


class Codec:
    """A tokenizer file, compiled: byte-level, split by the pattern above, with added tokens."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, split = spec["model"], spec["pre_tokenizer"]
        plain = not any(model.get(k) for k in ("dropout", "byte_fallback", "ignore_merges", "end_of_word_suffix", "continuing_subword_prefix"))
        if model["type"] != "BPE" or spec["normalizer"] or not plain:
            raise ValueError("not a plain byte-pair tokenizer")
        if split["type"] != "ByteLevel" or split.get("add_prefix_space") or not split.get("use_regex", True):
            raise ValueError("not a byte-level tokenizer with the usual pattern")
        byte, vocabulary = byte_of_character(), model["vocab"]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
            raise ValueError("added tokens that look around are not supported")
        labels = {t: bytes(map(byte.__getitem__, word)) for word, t in vocabulary.items() if word not in added}
        merges = [(vocabulary[u], vocabulary[v], vocabulary[u + v]) for u, v in pairs]
        self.automaton = Automaton(labels, merges)
        self.labels = labels | {t: word.encode() for word, t in added.items()}
        self.added = added
        self.latin, self.word = word_patterns()
        spelled = sorted(added, key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, spelled))) if spelled else None
        self.known: dict[str, bytes] = {}

    def words(self, text: str):
        """The text's words, in lists of bounded length; added tokens are numbers among them."""
        at = 0
        for special in self.special.finditer(text) if self.special else ():
            yield from self._words(text[at : special.start()])
            yield [self.added[special[0]]]
            at = special.end()
        yield from self._words(text[at:] if at else text)

    def _words(self, text: str):
        pattern = self.word if BEYOND_LATIN.search(text) else self.latin
        if len(text) <= MATCHES:
            yield pattern.findall(text)
            return
        found = pattern.finditer(text)
        while part := [m[0] for m in islice(found, MATCHES)]:
            yield part

    def _learn(self, words: set) -> None:
        new = [w for w in words if w not in self.known]
        spelled = [w for w in new if isinstance(w, str)]
        self.known.update(zip(spelled, self.automaton.encode_words([w.encode() for w in spelled])))
        self.known.update({w: np.array([w], "<i4").tobytes() for w in new if not isinstance(w, str)})

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian 32-bit numbers."""
        if len(self.known) > KNOWN_WORDS:
            self.known.clear()
        if len(texts) == 1 and len(texts[0]) > MATCHES:  # a long text, list by list
            return [b"".join(self._encoded(part) for part in self.words(texts[0]))]
        split = [list(self.words(t)) for t in texts]
        self._learn({w for parts in split for part in parts for w in part})
        ids = [b"".join([b"".join(map(self.known.__getitem__, part)) for part in parts]) for parts in split]
        self._drop_long()
        return ids

    def _encoded(self, part: list) -> bytes:
        self._learn(set(part))
        ids = b"".join(map(self.known.__getitem__, part))
        self._drop_long()
        if len(self.known) > KNOWN_WORDS:
            self.known.clear()
        return ids

    def _drop_long(self) -> None:
        for w in [w for w in islice(reversed(self.known), MATCHES) if isinstance(w, str) and len(w) > KNOWN_BYTES]:
            del self.known[w]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join([self.labels.get(i, b"") for i in ids])


def _columns(codec: Codec, part: pa.RecordBatch, with_text: bool) -> pa.RecordBatch:
    texts = [(t or b"").decode("utf-8", "replace") for t in raw_texts(part)]
    packed = codec.encode_batch(texts)
    ends = np.concatenate(([0], np.cumsum([len(i) // 4 for i in packed])))
    values = np.frombuffer(b"".join(packed), "<i4")
    columns = {"doc_id": part.column("doc_id"), "ids": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values))}
    if with_text:
        columns["text"] = _texts(codec, columns["ids"])
    return pa.RecordBatch.from_pydict(columns)


def _texts(codec: Codec, ids: pa.ListArray) -> pa.Array:
    flat = ids.flatten().to_numpy(zero_copy_only=False)
    ends = ids.value_lengths().fill_null(0).to_numpy().cumsum().tolist()
    return pa.array([codec.decode(flat[x:y].tolist()).decode("utf-8", "replace") for x, y in zip([0, *ends], ends)], pa.string())


def encode(docs: DataFrame, path: str, with_text: bool = False) -> DataFrame:
    """``doc_id, ids``, and ``text`` as decoded from the ids if asked for.

    ``path`` is a file for the ``tokenizers`` library; only the driver reads it."""
    compiled = docs.sparkSession.sparkContext.broadcast(Codec(path))

    def run(batches):
        codec = compiled.value
        for batch in batches:
            for part in slices(batch, limit=2 << 20):
                yield _columns(codec, part, with_text)
        codec.known.clear()  # the worker goes on to other tasks

    return id_and_text(docs).mapInArrow(run, "doc_id long, ids array<int>" + (", text string" if with_text else ""))


def decode(rows: DataFrame, path: str) -> DataFrame:
    """``doc_id, text`` of ``doc_id, ids``."""
    compiled = rows.sparkSession.sparkContext.broadcast(Codec(path))

    def run(batches):
        for batch in batches:
            text = _texts(compiled.value, batch.column("ids"))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), text], names=["doc_id", "text"])

    return rows.selectExpr("doc_id", "cast(ids as array<int>) as ids").mapInArrow(run, "doc_id long, text string")
