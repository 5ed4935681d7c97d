"""The stages one after the other on planted cases, and the whole run on a small folder."""

import re

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from ledgerloom.llm.common import stored, table

SF_DIR = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """The small tables with planted rows."""
    base = str(tmp_path_factory.mktemp("planted"))
    docs = table(spark, SF_DIR, "documents")
    passage = table(spark, SF_DIR, "benchmark").first()["text"]
    long = " ".join(f"word{i}" for i in range(60))
    rows = [
        (10**6, f"{long} {passage} and more {long[::-1]}", "en", "x", 1),
        (10**6 + 1, long, "en", "x", 1),
        (10**6 + 2, long + " tail", "en", "x", 1),
        (10**6 + 3, "write to ann.lee@mail.example.com or +1 (502) 555-6996 at once", None, None, None),
        (10**6 + 4, None, None, None, None),
    ]
    planted = docs.unionByName(spark.createDataFrame(rows, docs.schema)).withColumn("keep", docs["lang"])
    planted.write.parquet(f"{base}/documents.parquet")
    for name in ("benchmark", "labels"):
        table(spark, SF_DIR, name).write.parquet(f"{base}/{name}.parquet")
    return base


def test_stages(spark, folder):
    docs = table(spark, folder, "documents")
    before = {r["doc_id"]: r["text"] for r in docs.collect()}
    after = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, folder), name)
        if name != "packing":
            assert docs.columns == [*COLUMNS, "keep"]
            after[name] = {r["doc_id"]: r["text"] for r in docs.collect()}
    new = 10**6
    labels = {r["doc_id"]: r["toxic"] for r in table(spark, folder, "labels").collect()}
    gone = set(before) - set(after["toxicity"])
    clean = [d for d, toxic in labels.items() if not toxic and d in before]
    assert sum(d in gone for d in clean) <= 0.05 * len(clean)
    assert {new, new + 1, new + 2, new + 3, new + 4} <= set(after["toxicity"])
    assert new + 2 not in after["near_dedup"] and {new + 1, new + 4} <= set(after["near_dedup"])
    texts = [t for t in after["near_dedup"].values() if t and words(t)]
    assert len(texts) == len(set(texts))
    wanted = set()
    for r in table(spark, folder, "benchmark").collect():
        w = words(r["text"])
        wanted |= {tuple(w[i : i + 10]) for i in range(max(1, len(w) - 9))} if w else set()

    def hit(text):
        w = words(text)
        return any(tuple(w[i : i + n]) in wanted for n in {len(x) for x in wanted} for i in range(len(w) - n + 1))

    assert set(after["decontamination"]) == {d for d, t in after["near_dedup"].items() if not hit(t)}
    assert new not in after["decontamination"]
    assert after["personal_data"][new + 3] == "write to [EMAIL] or [PHONE] at once"
    assert set(after["personal_data"]) == set(after["decontamination"]) and after["personal_data"][new + 4] is None
    own = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    packed = {}
    for r in docs.orderBy("doc_id", "start").collect():
        packed.setdefault(r["doc_id"], []).extend(np.frombuffer(r["ids"], "<u4").tolist())
    for d, text in after["personal_data"].items():
        assert packed[d] == [*own.encode(text or "", add_special_tokens=False).ids, 2]


def test_run(spark):
    packed = corpus_pipeline.run(spark, SF_DIR)
    assert {"doc_id", "sequence_id", "offset", "length"} <= set(packed.columns)
    assert packed.groupBy("sequence_id").sum("length").filter("`sum(length)` > 4096").count() == 0
    assert packed.count() > 0


def test_empty_documents(spark, folder):
    docs = table(spark, folder, "documents").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, folder), name)
    assert docs.count() == 0
