"""Salary model: features, training, batch prediction, prediction records, storage."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from multiprocessing.pool import ThreadPool

import numpy as np
import pyarrow as pa
from pyspark import inheritable_thread_target, keyword_only
from pyspark.ml import Estimator, Pipeline, PipelineModel, Transformer
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import (CountVectorizerModel, ElementwiseProduct, FeatureHasher, IDF, NGram, Normalizer, OneHotEncoder, RegexTokenizer,
                                StandardScaler, StringIndexer, VectorAssembler)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasInputCols, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from vacantia.functions.labels import JUNIOR_WORDS, SENIOR_WORDS, TECH_WORDS, category, keyword_flag
from vacantia.functions.salary import TARGET_RANGE, confidence, floor_prediction, monthly_target
from vacantia.functions.text import fold_accents, search_text
from vacantia.operators.boosting import BoostedTrees
from vacantia.session import staged
from vacantia.sources.tables import try_read

CATEGORIES = ("pays", "type_contrat", "source", "secteur", "taille_entreprise")
FLAGS = ("is_senior", "is_junior", "has_tech")
TARGET = "salaire_cible"
PREDICTED = "salaire_predit_eur"
MODEL_TAG = "gradient_boosting_v1"

HASHED_SIZE = 1 << 12
ROWS_PER_PARTITION = 25_000


@dataclass(frozen=True)
class ModelSettings:
    """The defaults are those of the model to reproduce.

    Categories named in ``hashed`` get ``HASHED_SIZE`` columns by a hash; the others one for each value, the list of which
    passes through the driver. Name those with many values.
    """

    terms: int = 300
    trees: int = 200
    rate: float = 0.08
    depth: int = 5
    leaf: int = 5
    subsample: float = 0.8
    seed: int = 42
    test_percent: int = 20
    folds: int = 5
    at_least: int = 20
    hashed: tuple[str, ...] = ()


@dataclass
class SalaryModel:
    pipeline: PipelineModel
    metrics: dict[str, float] = field(default_factory=dict)


def engineer_features(postings: DataFrame, max_chars: int | None = None) -> DataFrame:
    """Add target, text, flags and cleaned categories. ``max_chars`` bounds the description in the text."""
    text = search_text(F.col("titre"), F.col("rome_libelle"), F.col("experience"), F.col("description"), max_chars)
    return postings.withColumns({
        TARGET: monthly_target(F.col("salaire_min"), F.col("salaire_max"), F.col("salaire_libelle")),
        "texte": text,
        "is_senior": keyword_flag(F.col("titre"), SENIOR_WORDS),
        "is_junior": keyword_flag(F.col("titre"), JUNIOR_WORDS),
        **{c: category(F.col(c)) for c in CATEGORIES},
    }).withColumn("has_tech", keyword_flag(F.col("texte"), TECH_WORDS))


def training_rows(features: DataFrame) -> DataFrame:
    """Rows with a target inside the accepted range."""
    return features.filter(F.col(TARGET).between(*TARGET_RANGE))


class FoldAccents(Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Lower-case text without accents."""

    @keyword_only
    def __init__(self, *, inputCol=None, outputCol=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, dataset):
        return dataset.withColumn(self.getOutputCol(), fold_accents(F.lower(self.getInputCol())))


class JoinWords(Transformer, HasInputCols, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Single words and word pairs as one list."""

    @keyword_only
    def __init__(self, *, inputCols=None, outputCol=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, dataset):
        return dataset.withColumn(self.getOutputCol(), F.concat(*self.getInputCols()))


class SublinearCounts(Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Counts c > 0 become 1 + ln(c)."""

    @keyword_only
    def __init__(self, *, inputCol=None, outputCol=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, dataset):
        @F.arrow_udf(VectorUDT())
        def damped(counts: pa.Array) -> pa.Array:
            listed = counts.field("values")
            c = listed.values.to_numpy(zero_copy_only=False)
            values = pa.ListArray.from_arrays(listed.offsets, pa.array(np.where(c > 0, 1 + np.log(np.where(c > 0, c, 1)), 0.0)))
            return pa.StructArray.from_arrays([counts.field("type"), counts.field("size"), counts.field("indices"), values],
                                              ["type", "size", "indices", "values"])

        return dataset.withColumn(self.getOutputCol(), damped(F.col(self.getInputCol())))


class AddVectors(Transformer, HasInputCols, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Sum of two vectors. Models stored before ``SmoothIDF`` hold it."""

    @keyword_only
    def __init__(self, *, inputCols=None, outputCol=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, dataset):
        a, b = (vector_to_array(c) for c in self.getInputCols())
        return dataset.withColumn(self.getOutputCol(), array_to_vector(F.zip_with(a, b, lambda x, y: x + y)))


class SmoothIDF(Estimator, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """tf * (idf + 1), in vectors that stay sparse."""

    @keyword_only
    def __init__(self, *, inputCol=None, outputCol=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset):
        idf = IDF(inputCol=self.getInputCol(), outputCol=self.getOutputCol()).fit(dataset).idf
        return ElementwiseProduct(scalingVec=Vectors.dense(idf.toArray() + 1), inputCol=self.getInputCol(), outputCol=self.getOutputCol())


class TopTerms(Estimator, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Counts of the most frequent terms. Equal frequencies are ordered by name, so the vocabulary is the same in every run."""

    size = Param(Params._dummy(), "size", "number of terms", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, inputCol=None, outputCol=None, size=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset):
        terms = dataset.select(F.explode(self.getInputCol()).alias("term")).groupBy("term").agg(F.count("*").alias("n"))
        best = terms.orderBy(F.desc("n"), "term").limit(self.getOrDefault(self.size)).collect()
        model = CountVectorizerModel.from_vocabulary([r.term for r in best], self.getInputCol(), self.getOutputCol())
        return model


def _term_stages() -> list:
    """Words and word pairs of a text. Nothing is learned here."""
    return [
        FoldAccents(inputCol="texte", outputCol="_folded"),
        RegexTokenizer(inputCol="_folded", outputCol="_words", pattern=r"(?U)\w\w+", gaps=False),
        NGram(n=2, inputCol="_words", outputCol="_pairs"),
        JoinWords(inputCols=["_words", "_pairs"], outputCol="_terms"),
    ]


def _weight_stages(terms: int) -> list:
    """Weights of the most frequent terms, unit length."""
    return [
        TopTerms(inputCol="_terms", outputCol="_counts", size=terms),
        SublinearCounts(inputCol="_counts", outputCol="_tf"),
        SmoothIDF(inputCol="_tf", outputCol="_weighted"),
        Normalizer(inputCol="_weighted", outputCol="_text", p=2.0),
    ]


def feature_stages(terms: int, listed: Sequence[str], hashed: Sequence[str]) -> list:
    """Weights of ``_terms``, one column per listed category value (unknown values give zeros), hashed categories,
    standardised flags; one vector."""
    stages = _weight_stages(terms)
    parts = ["_text"]
    if listed:
        index, hot = [f"_{c}_index" for c in listed], [f"_{c}_hot" for c in listed]
        stages += [StringIndexer(inputCols=list(listed), outputCols=index, handleInvalid="keep"),
                   OneHotEncoder(inputCols=index, outputCols=hot, dropLast=True)]
        parts += hot
    if hashed:
        stages.append(FeatureHasher(inputCols=list(hashed), outputCol="_hashed", numFeatures=HASHED_SIZE))
        parts.append("_hashed")
    stages += [
        VectorAssembler(inputCols=list(FLAGS), outputCol="_flags"),
        StandardScaler(inputCol="_flags", outputCol="_scaled", withMean=True),
        VectorAssembler(inputCols=[*parts, "_scaled"], outputCol="_features"),
    ]
    return stages


def term_weights(features: DataFrame, terms: int = ModelSettings.terms, key: str = "offre_id") -> DataFrame:
    """(key, term, weight): the text part of the feature vector, its non-zero entries."""
    top, *weigh = _weight_stages(terms)
    words = PipelineModel(_term_stages()).transform(features.select(key, "texte"))
    counts = top.fit(words)
    names = counts.vocabulary
    # Texts are cut into words for the vocabulary and for the counts; weights are learned and computed from the counts.
    counted = staged(counts.transform(words).select(key, "_counts"), "counts")
    model = Pipeline(stages=weigh).fit(counted)
    weights = F.transform(vector_to_array("_text"), lambda w, i: F.struct(F.get(F.lit(names), i).alias("term"), w.alias("weight")))
    rows = model.transform(counted).select(key, F.explode(F.filter(weights, lambda w: w["weight"] > 0)).alias("w"))
    return rows.select(key, "w.term", "w.weight")


def scaled_flags(features: DataFrame, key: str = "offre_id") -> DataFrame:
    """The standardised flags of the feature vector."""
    stages = [VectorAssembler(inputCols=list(FLAGS), outputCol="_flags"), StandardScaler(inputCol="_flags", outputCol="_scaled", withMean=True)]
    scaled = Pipeline(stages=stages).fit(features).transform(features)
    return scaled.select(key, *[F.get(vector_to_array("_scaled"), F.lit(i)).alias(f) for i, f in enumerate(FLAGS)])


def _share(key: str, seed: int, parts: int) -> Column:
    """Part 0..parts-1 of a row by a hash of its id: the same in every run and after a lost executor."""
    return F.pmod(F.xxhash64(F.lit(seed), F.col(key).cast("string")), F.lit(parts))


def train(postings: DataFrame, settings: ModelSettings = ModelSettings(), key: str = "offre_id",
          max_chars: int | None = None) -> SalaryModel:
    """Fit the model and measure it on held-out rows and, with ``folds`` > 1, by cross-validation."""
    columns = [key, "_terms", *CATEGORIES, *FLAGS, TARGET]
    words = PipelineModel(_term_stages())
    features = engineer_features(postings, max_chars)
    counts = features.agg(
        F.count("*").alias("n_offres_total"), F.count_if(F.col(TARGET).isNull()).alias("n_sans_salaire"),
        F.count_if(F.col(TARGET).between(*TARGET_RANGE)).alias("usable")).first()
    if counts.usable < settings.at_least:
        raise ValueError(f"{counts.usable} rows with a usable salary, {settings.at_least} are needed")
    # The features of each split take a handful of short jobs over these rows. Texts are cut into words once for all splits.
    parts = -(-counts.usable // ROWS_PER_PARTITION)
    rows = words.transform(training_rows(features).select(key, "texte", *columns[2:]).repartition(parts, key)).select(*columns).persist()
    listed = [c for c in CATEGORIES if c not in settings.hashed]
    regressor = BoostedTrees(
        featuresCol="_features", labelCol=TARGET, predictionCol="prediction", keyCol=key, maxIter=settings.trees,
        stepSize=settings.rate, maxDepth=settings.depth, minInstancesPerNode=settings.leaf,
        subsamplingRate=settings.subsample, seed=settings.seed)

    def fit_and_score(fit_on: Column) -> tuple[PipelineModel, dict[str, float]]:
        """Fit features and trees on some rows, score on the rest. Features are computed once for both."""
        stages = Pipeline(stages=feature_stages(settings.terms, listed, settings.hashed)).fit(rows.filter(fit_on))
        vectors = stages.transform(rows).select(key, "_features", TARGET, fit_on.alias("_fit")).persist()
        try:
            trees = regressor.fit(vectors.filter("_fit"))
            scored = trees.transform(vectors.filter("NOT _fit"))
            scores = {m: RegressionEvaluator(labelCol=TARGET, metricName=m).evaluate(scored) for m in ("mae", "r2")}
            sizes = {r["_fit"]: r["count"] for r in vectors.groupBy("_fit").count().collect()}
        finally:
            vectors.unpersist()
        scores |= {"n_train": sizes.get(True, 0), "n_test": sizes.get(False, 0)}
        return PipelineModel([*words.stages, *stages.stages, trees]), scores

    splits = [_share(key, settings.seed, 100) >= settings.test_percent]
    if settings.folds > 1:
        splits += [_share(key, settings.seed + 1, settings.folds) != i for i in range(settings.folds)]
    try:
        # A split is boosted by one task, or by a chain of short jobs if its rows are many; the splits go side by side.
        with ThreadPool(len(splits)) as pool:
            fitted = pool.map(inheritable_thread_target(postings.sparkSession)(fit_and_score), splits)
    finally:
        rows.unpersist()
    model, held_out = fitted[0]
    metrics = {"mae_eur": held_out["mae"], "r2_score": held_out["r2"], "n_train": held_out["n_train"], "n_test": held_out["n_test"],
               "n_offres_total": counts.n_offres_total, "n_sans_salaire": counts.n_sans_salaire}
    if settings.folds > 1:
        scores = [s["r2"] for _, s in fitted[1:]]
        mean = sum(scores) / len(scores)
        metrics["cv_r2_mean"] = mean
        metrics["cv_r2_std"] = (sum((s - mean) ** 2 for s in scores) / len(scores)) ** 0.5
    return SalaryModel(model, metrics)


def _predict(model: SalaryModel, features: DataFrame) -> DataFrame:
    scored = model.pipeline.transform(features)
    return scored.select(*features.columns, "prediction")


def predict_batch(model: SalaryModel, postings: DataFrame, max_chars: int | None = None) -> DataFrame:
    """Feature columns plus the predicted monthly salary where the salary is unknown (two digits, floor 500)."""
    scored = _predict(model, engineer_features(postings.drop(PREDICTED), max_chars))
    value = floor_prediction(F.bround("prediction", 2))
    return scored.withColumn(PREDICTED, F.when(F.col(TARGET).isNull(), value)).drop("prediction")


def prediction_records(model: SalaryModel, postings: DataFrame, max_chars: int | None = None) -> DataFrame:
    """Estimate, ten-percent band, confidence and flags for every posting."""
    scored = _predict(model, engineer_features(postings.drop(PREDICTED), max_chars))
    value = floor_prediction(F.col("prediction"))
    return scored.select(
        "offre_id", F.bround(value, 2).alias("salaire_estime_eur"),
        F.bround(value * 0.90, 2).alias("fourchette_basse"), F.bround(value * 1.10, 2).alias("fourchette_haute"),
        confidence(F.col("pays"), F.col("type_contrat"), F.col("secteur"), F.col("texte")).alias("confiance"),
        *[F.col(f).cast("boolean").alias(f) for f in FLAGS], "pays", "type_contrat")


def prediction_export(predicted: DataFrame, at: Column, tag: str = MODEL_TAG) -> DataFrame:
    """Predictions with the model tag and the time they were made."""
    return predicted.select("offre_id", "titre", "pays", "type_contrat", TARGET, PREDICTED,
                            F.lit(tag).alias("source_prediction"), at.cast("string").alias("generated_at"))


def save_model(model: SalaryModel, spark: SparkSession, path: str) -> None:
    model.pipeline.write().overwrite().save(f"{path}/pipeline")
    row = {k: float(v) for k, v in model.metrics.items()}
    spark.createDataFrame([row]).write.mode("overwrite").parquet(f"{path}/metrics")


def load_model(spark: SparkSession, path: str) -> SalaryModel:
    metrics = spark.read.parquet(f"{path}/metrics").first().asDict()
    return SalaryModel(PipelineModel.load(f"{path}/pipeline"), metrics)


def model_status(spark: SparkSession, path: str) -> dict:
    """Whether a model is stored, with its metrics."""
    metrics = try_read(spark, f"{path}/metrics")
    return {"available": False} if metrics is None else {"available": True, **metrics.first().asDict()}


def train_or_load(postings: DataFrame, path: str, force: bool = False,
                  settings: ModelSettings = ModelSettings()) -> SalaryModel:
    """The stored model, or a new one when there is none or ``force`` asks for it."""
    spark = postings.sparkSession
    if not force and model_status(spark, path)["available"]:
        return load_model(spark, path)
    model = train(postings, settings)
    save_model(model, spark, path)
    return model
