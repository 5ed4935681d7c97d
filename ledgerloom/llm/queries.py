"""One query for each operator, over its whole table, and its SQL where SQL can express it."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.llm import bpe_automaton
from ledgerloom.llm.common import table
from ledgerloom.llm.decontaminate import contamination
from ledgerloom.llm.licenses import all_templates, license_report
from ledgerloom.llm.near_dedup import near_duplicates
from ledgerloom.llm.packing import pack_documents
from ledgerloom.llm.pii import find_personal_data
from ledgerloom.llm.secret_scan import find_secrets
from ledgerloom.llm.quality import quality_scores
from ledgerloom.llm.source_divergence import source_divergence
from ledgerloom.llm.spans import PERSONAL, SECRET, digest
from ledgerloom.llm.substring_dedup import remove_repeated_windows
from ledgerloom.llm.toxicity import THRESHOLD, fit_toxicity, held_out, score_toxicity
from ledgerloom.llm.vamana import nearest
from ledgerloom.llm.vector_codes import encode_vectors, with_label_error


def op1_vamana_neighbours(spark, sf_dir):
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op2_substring_dedup(spark, sf_dir):
    found = remove_repeated_windows(table(spark, sf_dir, "documents"))
    gone = F.aggregate("removed", F.lit(0).cast("bigint"), lambda n, x: n + x["end"] - x["start"])
    return found.select(
        "doc_id", "n_words", gone.alias("n_removed"), F.sha2("kept_text", 256).alias("kept_sha256")
    )


def op3_pii_boosted_candidates(spark, sf_dir):
    return digest(find_personal_data(table(spark, sf_dir, "documents")), PERSONAL)


def op4_secret_scan_char_cnn(spark, sf_dir):
    return digest(find_secrets(table(spark, sf_dir, "documents")), SECRET)


def op5_quality_empirical_bayes(spark, sf_dir):
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_minhash_near_dedup(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents")).drop("text_hash")


def op7_toxicity_nnpu(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    scored = score_toxicity(docs, fit_toxicity(docs, table(spark, sf_dir, "labels")))
    predicted = (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", predicted)


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op8_hilbert_packing(spark, sf_dir):
    pieces = pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op9_license_scan(spark, sf_dir):
    return license_report(table(spark, sf_dir, "documents"), all_templates(spark))


def op10_benchmark_decontamination(spark, sf_dir):
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        "contaminated",
    )


def op11_bpe_automaton(spark, sf_dir):
    coded = bpe_automaton.encode(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), with_text=True)
    return coded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )


def op12_dual_tree_codes(spark, sf_dir):
    coded = with_label_error(encode_vectors(table(spark, sf_dir, "embeddings")))
    return coded.select("vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error", "codebooks_sha256")


def op13_source_divergence(spark, sf_dir):
    return source_divergence(table(spark, sf_dir, "documents"))


LLM_QUERIES = {
    "op1_vamana_neighbours": op1_vamana_neighbours,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_pii_boosted_candidates": op3_pii_boosted_candidates,
    "op4_secret_scan_char_cnn": op4_secret_scan_char_cnn,
    "op5_quality_empirical_bayes": op5_quality_empirical_bayes,
    "op6_minhash_near_dedup": op6_minhash_near_dedup,
    "op7_toxicity_nnpu": op7_toxicity_nnpu,
    "op8_hilbert_packing": op8_hilbert_packing,
    "op9_license_scan": op9_license_scan,
    "op10_benchmark_decontamination": op10_benchmark_decontamination,
    "op11_bpe_automaton": op11_bpe_automaton,
    "op12_dual_tree_codes": op12_dual_tree_codes,
    "op13_source_divergence": op13_source_divergence,
}
