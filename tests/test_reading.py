"""The trained reader and the comparison of reasons, against small fixtures and brute force."""

import math
import re

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from ledgerloom.functions.text import FALLBACK_INTENT
from ledgerloom.operators import reading, reasons
from ledgerloom.plans import evaluation
from ledgerloom.plans.catalog import QUERIES, trained_reading_of
from ledgerloom.plans.portfolio import Portfolio

SAID = {
    "genuine_hardship": ["my son is ill and the wages stopped", "wages stopped after the flood", "मेरी तनख्वाह रुक गई"],
    "technical_issue_or_dispute": ["the debit failed at your server", "your server took it twice", "mandate server failed"],
    "payment_avoidance_pattern": ["call me some other day", "some other day please", "not today some other day"],
}
CALL = "interaction_id string, borrower_id string, text string, label string"


def calls(spark, extra=()):
    rows = [
        (f"I{i}-{label}-{j}", f"B{i}", text, label)
        for i in range(40) for label, texts in SAID.items() for j, text in enumerate(texts)
    ]
    return spark.createDataFrame([*rows, *extra], CALL)


@pytest.fixture(scope="module")
def reader(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("reader") / "model")
    extra = [("X1", "B1", None, "genuine_hardship"), ("X2", "B2", "wages", None), ("X3", None, "  ", "genuine_hardship")]
    return reading.fit_and_save(calls(spark, extra), "text", "label", path), path


def test_reads_new_wording_in_any_script(spark, reader):
    asked = [("1", "B", "the wages stopped again", None), ("2", "B", "SERVER failed!", None),
             ("3", "B", "तनख्वाह रुक गई", None), ("4", "B", "some other day " * 20000, None)]
    got = {r.interaction_id: r for r in reading.read(reader[0], spark.createDataFrame(asked, CALL), "text").collect()}
    assert [got[k].trained_intent for k in "1234"] == [
        "genuine_hardship", "technical_issue_or_dispute", "genuine_hardship", "payment_avoidance_pattern"]
    assert all(0 < r.confidence <= 1 for r in got.values())


def test_unreadable_text_gets_the_fallback(spark, reader):
    asked = spark.createDataFrame([("1", "B", None, None), ("2", "B", "", None), ("3", "B", " ?! ", None)], CALL)
    got = reading.read(reader[0], asked, "text")
    assert {(r.trained_intent, r.confidence) for r in got.collect()} == {(FALLBACK_INTENT, None)}
    assert got.columns == [*asked.columns, "trained_intent", "confidence"]
    assert reading.read(reader[0], asked.limit(0), "text").count() == 0


def test_loaded_model_scores_a_stream_as_a_batch(spark, reader, tmp_path):
    calls(spark).write.parquet(str(tmp_path / "in"))
    model = PipelineModel.load(reader[1])
    stream = spark.readStream.schema(CALL).parquet(str(tmp_path / "in"))
    (reading.read(model, stream, "text").writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "c"))
     .trigger(availableNow=True).start(str(tmp_path / "out")).awaitTermination())
    cols = ["interaction_id", "trained_intent", "confidence"]
    streamed = spark.read.parquet(str(tmp_path / "out")).select(cols)
    batch = reading.read(reader[0], calls(spark), "text").select(cols)
    assert sorted(streamed.collect()) == sorted(batch.collect())


def test_no_label_of_the_scored_row_is_used(spark, tmp_path):
    """Turning one borrower's labels around changes nothing in how that borrower's calls are read."""
    plain = calls(spark)
    turned = plain.withColumn("label", F.expr(
        "CASE WHEN borrower_id = 'B7' THEN 'payment_avoidance_pattern' ELSE label END"))
    read = [
        {r.interaction_id: (r.trained_intent, round(r.confidence, 6))
         for r in reading.read_by_other_folds(df, "text", "label", str(tmp_path / name)).filter("borrower_id = 'B7'").collect()}
        for name, df in (("plain", plain), ("turned", turned))]
    assert len(read[0]) == 9 and read[0] == read[1]


def test_repeats_are_weights(spark):
    got = reading.examples(calls(spark), "text", "label").collect()
    assert len(got) == 9 and {r["_weight"] for r in got} == {40.0}


@pytest.mark.parametrize("shown", ["_label = 'genuine_hardship'", "false"])
def test_labels_that_calibration_lacks(spark, shown):
    rows = reading.examples(calls(spark), "text", "label")
    few = rows.filter(shown)
    model = reading.fit(rows, few)
    got = reading.read(model, calls(spark), "text")
    assert got.filter("trained_intent <> label").count() == 0
    with pytest.raises(ValueError, match="two labels"):
        reading.fit(few, few)


def test_scale_against_brute_force(spark):
    """Margins that are four times too sure are scaled down, with repeats as weights."""
    from pyspark.ml.linalg import Vectors

    rows = [(Vectors.dense([4.0, 0.0]), 0.0, 73.1), (Vectors.dense([4.0, 0.0]), 1.0, 26.9), (Vectors.dense([-4.0, 0.0]), 1.0, 7.0)]

    def loss(scale):
        return sum(w * (math.log(sum(math.exp(m * scale) for m in v)) - v[int(y)] * scale) for v, y, w in rows)

    got = reading.best_scale(spark.createDataFrame(rows, ["_margins", "_index", "_weight"]))
    assert got == min(reading.SCALES, key=loss) and got < 0.5


def test_held_out_accuracy_beside_the_rules(spark):
    rows = {r.ground_truth_label: r for r in QUERIES["trained_reading"](Portfolio(spark, "/root/testdata/sf0.01")).collect()}
    assert set(rows) <= set(evaluation.EXPECTED_INTENT) | {"MACRO"}
    macro = rows["MACRO"]
    assert macro.n_calls == sum(r.n_calls for k, r in rows.items() if k != "MACRO")
    # The sentences are few, so other borrowers say them too; new wordings show what is really read, and no
    # accuracy is asked of them here: with three sentences a label it depends on which ones are set aside.
    assert macro.new_borrower_accuracy_pct >= 80
    assert macro.new_wording_accuracy_pct <= macro.new_borrower_accuracy_pct


def test_what_many_calls_say_alike_is_read_once(spark, tmp_path):
    odd = [("O1", None, "no wages", "genuine_hardship"), ("O2", "B1", None, "genuine_hardship")]
    said = calls(spark, odd).selectExpr(
        "interaction_id", "borrower_id", "text AS transcript_text", "upper(label) AS ground_truth_label",
        "label AS expected_intent", "if(text LIKE '%server%', label, 'other') AS predicted_intent")
    got = {r.ground_truth_label: r for r in trained_reading_of(said, str(tmp_path / "once")).collect()}
    written = spark.read.parquet(str(tmp_path / "once" / "borrowers" / "calls"))
    assert written.agg(F.sum("n_calls")).first()[0] == said.count() == 362
    assert written.count() <= 9 * reading.FOLDS + 2
    rows = reading.read_by_other_folds(said, "transcript_text", "expected_intent", str(tmp_path / "each")).collect()
    shares = {}
    for label in {r.ground_truth_label for r in rows}:
        own = [r for r in rows if r.ground_truth_label == label]
        sure = [r.confidence for r in own if r.confidence is not None]
        trained = sum(r.trained_intent == r.expected_intent for r in own) / len(own)
        shares[label] = sum(r.predicted_intent == r.expected_intent for r in own) / len(own), trained, sum(sure) / len(sure)
        assert got[label].n_calls == len(own)
    shares["MACRO"] = [sum(x) / len(shares) for x in zip(*shares.values())]
    assert set(got) == set(shares) and got["MACRO"].n_calls == len(rows)
    for label, (rules, trained, sure) in shares.items():
        assert got[label].rules_accuracy_pct == pytest.approx(100 * rules, abs=0.051)
        assert got[label].new_borrower_accuracy_pct == pytest.approx(100 * trained, abs=0.051)
        assert got[label].new_borrower_gap_pct == pytest.approx(100 * abs(sure - trained), abs=0.051)
    none = trained_reading_of(said.limit(0), str(tmp_path / "none")).collect()
    assert [(r.ground_truth_label, r.n_calls) for r in none] == [("MACRO", 0)]


def test_folds_without_two_labels_and_empty_tables_are_not_read(spark, tmp_path):
    one = calls(spark).filter("label = 'genuine_hardship'")
    got = reading.read_by_other_folds(one, "text", "label", str(tmp_path / "one"))
    assert got.count() == 120 and got.filter("confidence IS NOT NULL OR trained_intent <> '" + FALLBACK_INTENT + "'").count() == 0
    assert reading.read_by_other_folds(one.limit(0), "text", "label", str(tmp_path / "none")).count() == 0


def test_a_filled_in_sentence_is_one_wording(spark):
    said = [("I will pay Rs 12,500 by 3 March, said Lotus Bank",), ("I will pay Rs 900 by 14 January, said Tulip Finance",), (None,), ("",)]
    folds = [r.f for r in spark.createDataFrame(said, "t string").select(reading.wording_fold("t").alias("f")).collect()]
    assert folds[0] == folds[1] and folds[2] == folds[3]


def test_no_wording_is_read_by_a_model_that_saw_it(spark, tmp_path):
    """One wording whose label nothing else has is never found when its own fold is set aside."""
    odd = spark.createDataFrame([(f"O{i}", f"B{i}", "quite unlike the rest", "odd") for i in range(30)], CALL)
    both = calls(spark).unionByName(odd)
    found = reading.read_by_other_folds(both, "text", "label", str(tmp_path), reading.wording_fold("text"))
    assert found.count() == both.count()
    assert found.filter("label = 'odd' AND trained_intent = 'odd'").count() == 0


# --- reasons ----------------------------------------------------------------------------------------------------
GIVEN = ["my father is in hospital", "my father is in hospital", "father in the hospital", "the shop was shut",
         "मेरे पिता अस्पताल में हैं", "पिता अस्पताल में भर्ती हैं", "दुकान बंद थी", "None", None, "...", "the the the"]


def brute(a, b):
    def words(t):
        return None if t in (None, "None") else set(re.findall(r"[\wऀ-ॿ]+", t.lower())) or None

    known = [w for w in map(words, GIVEN) if w]
    wa, wb = words(a), words(b)
    if not wa or not wb:
        return None
    weight = {w: 1000 + round(1000 * math.log((len(known) + 1) / (sum(w in k for k in known) + 1))) for w in wa | wb}
    norm = [math.sqrt(sum(weight[w] ** 2 for w in s)) for s in (wa, wb)]
    return round(1000 * sum(weight[w] ** 2 for w in wa & wb) / (norm[0] * norm[1]))


def test_reasons_of_any_script_against_brute_force(spark):
    told = spark.createDataFrame([(g,) for g in GIVEN], "stated_reason string")
    pairs = [("B", f"{i}", f"{j}", a, b) for i, a in enumerate(GIVEN) for j, b in enumerate(GIVEN)]
    pairs.append(("B", "new", "0", "a wholly unseen cause", GIVEN[0]))
    schema = "borrower_id string, from_interaction_id string, to_interaction_id string, from_reason string, to_reason string"
    frame = spark.createDataFrame(pairs, schema)
    got = {(r.from_interaction_id, r.to_interaction_id): r for r in reasons.compare_reasons(frame, told).collect()}
    assert len(got) == len(pairs)
    for _, i, j, a, b in pairs:
        want = brute(a, b)
        assert got[i, j].similarity == want, (a, b)
        assert got[i, j].reason_changed is (None if want is None else want < reasons.SAME_FROM)
    assert got["4", "5"].reason_changed is False and got["4", "6"].reason_changed is True


def test_no_reasons_at_all(spark):
    schema = "borrower_id string, from_interaction_id string, to_interaction_id string, from_reason string, to_reason string"
    none = spark.createDataFrame([("B", "1", "2", None, "None")], schema)
    told = spark.createDataFrame([], "stated_reason string")
    row = reasons.compare_reasons(none, told).first()
    assert row.similarity is None and row.reason_changed is None
