"""A trained reader of call transcripts: what the call is about, with a calibrated confidence.

Words and pairs of neighbouring words are hashed into counts, a multinomial logistic regression
reads them, and one factor for all margins, chosen on calls the regression has not seen, turns them into
probabilities.  All of it is one saved ``PipelineModel``, which scores batches and streams alike.

Defined cases.  A text that is NULL or holds no word is not read: it gets the fallback label with
confidence NULL, and takes no part in fitting.  A call without label takes no part in fitting.  Equal
texts with equal labels are one weighted row, so a sentence that makes up a third of all calls costs one.
A borrower's calls lie in one fold; calls without borrower are in the fold of their own id.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import (
    ElementwiseProduct,
    HashingTF,
    IndexToString,
    NGram,
    RegexTokenizer,
    StringIndexer,
    VectorAssembler,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.text import FALLBACK_INTENT

WORD = r"[\p{L}\p{M}\p{N}]+"  # of any script
FEATURES = 1 << 12  # buckets each of words and of pairs
FOLDS = 3
SCALES = [2.0 ** (k / 4) for k in range(-12, 13)]  # from an eighth to eight
TEXT, LABEL, WEIGHT = "_text", "_label", "_weight"
SCRATCH = ["_words", "_pairs", "_word_counts", "_pair_counts", "_features", "_margins", "_p", "_m", "_top"]


def fold_of(borrower_id: str = "borrower_id", call_id: str = "interaction_id") -> Column:
    return F.pmod(F.xxhash64(F.coalesce(borrower_id, call_id), F.lit("fold")), F.lit(FOLDS)).cast("int")


def wording_fold(text: str) -> Column:
    """A fold by what is said, without figures and capitalised words: one sentence filled in with other
    amounts and names lies in one fold, so a model is asked about wordings that it never saw."""
    bare = F.regexp_replace(F.coalesce(F.col(text), F.lit("")), r"[0-9][0-9.,]*|\b[A-Z]\w*", "")
    return F.pmod(F.xxhash64(bare, F.lit("wording")), F.lit(FOLDS)).cast("int")


def _readable(text) -> Column:
    return F.coalesce(F.col(text).rlike(WORD), F.lit(False))


def told(calls: DataFrame, fold: Column, *columns: str) -> DataFrame:
    """Different rows of the columns in each ``_fold`` with their number ``n_calls``: what many calls say alike
    is read once."""
    return calls.groupBy(*columns, fold.alias("_fold")).agg(F.count("*").alias("n_calls"))


def examples(calls: DataFrame, text: str, label: str, *keep: str, number: str | None = None) -> DataFrame:
    """Different (text, label, kept columns) with their number; a row stands for ``number`` calls, or for one."""
    rows = calls.filter(_readable(text) & F.col(label).isNotNull())
    return rows.groupBy(F.col(text).alias(TEXT), F.col(label).alias(LABEL), *keep).agg(
        (F.sum(number) if number else F.count("*")).cast("double").alias(WEIGHT)
    )


def fit(train: DataFrame, calibrate: DataFrame, iterations: int = 25, penalty: float = 1e-3) -> PipelineModel:
    """A reader fitted on ``train`` and calibrated on ``calibrate``, both from ``examples``.

    ``calibrate`` must hold other borrowers than ``train``; its examples with a label that ``train`` lacks
    are left out.  Without any example there the margins stand as they are.
    """
    indexer = StringIndexer(
        inputCol=LABEL, outputCol="_index", stringOrderType="alphabetAsc", handleInvalid="skip"
    ).fit(train)
    if len(indexer.labels) < 2:
        raise ValueError("a reader needs examples of two labels")
    counted = Pipeline(stages=[
        RegexTokenizer(inputCol=TEXT, outputCol="_words", pattern=WORD, gaps=False, toLowercase=True),
        NGram(n=2, inputCol="_words", outputCol="_pairs"),
        HashingTF(numFeatures=FEATURES, inputCol="_words", outputCol="_word_counts"),
        HashingTF(numFeatures=FEATURES, inputCol="_pairs", outputCol="_pair_counts"),
        VectorAssembler(inputCols=["_word_counts", "_pair_counts"], outputCol="_features"),
    ]).fit(train)
    reader = LogisticRegression(
        featuresCol="_features", labelCol="_index", weightCol=WEIGHT, rawPredictionCol="_margins",
        probabilityCol="_p", predictionCol="_best", family="multinomial", maxIter=iterations, regParam=penalty,
    ).fit(counted.transform(indexer.transform(train)))
    seen = PipelineModel(stages=[*counted.stages, reader]).transform(indexer.transform(calibrate))
    scaled = ElementwiseProduct(
        scalingVec=Vectors.dense([best_scale(seen)] * len(indexer.labels)), inputCol="_margins", outputCol="_scaled"
    )
    names = IndexToString(inputCol="_best", outputCol="_intent", labels=indexer.labels)
    return PipelineModel(stages=[*counted.stages, reader, scaled, names])


def _with_margins(scored: DataFrame, margins: str) -> DataFrame:
    """``_m`` and ``_top``, the margins as an array and the highest, as columns: inside the functions below the
    vector would be unpacked anew for each margin of each scale."""
    return scored.withColumn("_m", vector_to_array(margins)).withColumn("_top", F.array_max("_m"))


def _log_sum_exp(scale: float = 1.0) -> Column:
    top = F.col("_top") * scale
    return top + F.log(F.aggregate("_m", F.lit(0.0), lambda s, m: s + F.exp(m * scale - top)))


def best_scale(seen: DataFrame) -> float:
    """The factor for all margins that makes the labels of ``seen`` likeliest, of ``SCALES``: one pass, one row."""
    own = F.get(F.col("_m"), F.col("_index").cast("int"))
    losses = [F.sum(F.col(WEIGHT) * (_log_sum_exp(scale) - own * scale)).alias(f"l{i}") for i, scale in enumerate(SCALES)]
    row = _with_margins(seen.select("_margins", "_index", WEIGHT), "_margins").agg(*losses).first()
    found = [(loss, abs(scale - 1), scale) for loss, scale in zip(row, SCALES) if loss is not None]
    return min(found)[2] if found else 1.0


def fit_and_save(calls: DataFrame, text: str, label: str, path: str) -> PipelineModel:
    """A reader of all labelled calls, stored: fitted on all folds but one, calibrated on that."""
    rows = examples(calls.withColumn("_fold", fold_of()), text, label, "_fold").persist()
    try:
        model = fit(rows.filter(f"_fold <> {FOLDS - 1}"), rows.filter(f"_fold = {FOLDS - 1}"))
    finally:
        rows.unpersist()
    model.write().overwrite().save(path)
    return PipelineModel.load(path)


def read(model: PipelineModel, calls: DataFrame, text: str = "transcript_text") -> DataFrame:
    """The calls, batch or stream, with ``trained_intent`` and ``confidence`` (probability of that label)."""
    scored = _with_margins(model.transform(calls.withColumn(TEXT, F.coalesce(F.col(text), F.lit("")))), "_scaled")
    sure = F.exp(F.col("_top") - _log_sum_exp())
    return scored.withColumns({
        "trained_intent": F.when(_readable(text), F.col("_intent")).otherwise(F.lit(FALLBACK_INTENT)),
        "confidence": F.when(_readable(text), sure),
    }).drop(TEXT, "_scaled", "_best", "_intent", *SCRATCH)


def read_by_other_folds(
    calls: DataFrame, text: str, label: str, folder: str, fold: Column | None = None, number: str | None = None
) -> DataFrame:
    """Every call read by a model that saw no call of its fold (by default: of its borrower): per fold one
    model, fitted on the next fold and calibrated on the one after.  Where the next fold shows fewer than two
    labels there is no model, and its calls get the fallback label with confidence NULL.  Calls and examples are written below ``folder``, one part a fold, so
    that each model reads its own part only.  A row stands for ``number`` calls, or for one."""
    fold = fold_of() if fold is None else fold
    dealt = _by_fold(calls.withColumn("_fold", fold), f"{folder}/calls")
    rows = _by_fold(examples(dealt, text, label, "_fold", number=number), f"{folder}/examples")
    whole = None
    for f in range(FOLDS):
        learnt, set_aside = (f + 1) % FOLDS, (f + 2) % FOLDS
        lessons, asked = rows.filter(f"_fold = {learnt}"), dealt.filter(f"_fold = {f}")
        if lessons.select(LABEL).distinct().limit(2).count() < 2:
            part = asked.withColumns({"trained_intent": F.lit(FALLBACK_INTENT), "confidence": F.lit(None).cast("double")})
        else:
            part = read(fit(lessons, rows.filter(f"_fold = {set_aside}")), asked, text)
        whole = part if whole is None else whole.unionByName(part)
    return whole.drop("_fold")


def _by_fold(df: DataFrame, path: str) -> DataFrame:
    df.write.partitionBy("_fold").mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
