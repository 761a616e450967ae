"""Classifiers by name, fitting, scoring, importances and a versioned model folder."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.ml import Model, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
    NaiveBayes,
    OneVsRest,
    OneVsRestModel,
    RandomForestClassifier,
)
from pyspark.ml.feature import Bucketizer, OneHotEncoderModel, SQLTransformer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, NumericType, StructType

from larkspur.operators.aggregates import top_n
from larkspur.operators.encode import FittedPreprocessor, Preprocessor
from larkspur.operators.joins import Lookup, training_set
from larkspur.operators.neighbours import neighbour_vote, smote
from larkspur.operators.resample import over_sample, under_sample
from larkspur.workspace import dealt, materialize, shared_root, tasks_for

FEATURES = "_features"

_COMMON = {"random_state": "seed", "max_depth": "maxDepth", "min_samples_leaf": "minInstancesPerNode"}
_FOREST = {**_COMMON, "n_estimators": "numTrees", "max_features": "featureSubsetStrategy", "criterion": "impurity"}
_BOOST = {
    **_COMMON,
    "n_estimators": "maxIter",
    "iterations": "maxIter",
    "depth": "maxDepth",
    "learning_rate": "stepSize",
    "subsample": "subsamplingRate",
}
_LINEAR = {"max_iter": "maxIter", "tol": "tol", "fit_intercept": "fitIntercept"}

# The boosting libraries and plain gradient boosting share Spark's boosted trees.
_KNOWN: dict[str, tuple[type, dict[str, str], dict[str, Any]]] = {
    "random_forest": (RandomForestClassifier, _FOREST, {"numTrees": 100}),
    "decision_tree": (DecisionTreeClassifier, {**_COMMON, "criterion": "impurity"}, {}),
    "logistic": (LogisticRegression, _LINEAR, {}),
    "svm": (LinearSVC, _LINEAR, {}),
    "naive_bayes": (NaiveBayes, {}, {"modelType": "gaussian"}),
    **{name: (GBTClassifier, _BOOST, {}) for name in ("gradient_boosting", "lightgbm", "xgboost", "catboost")},
}
# Fitted with a penalty on unscaled columns.
_PENALIZED = (LogisticRegression, LinearSVC)
_SEEDED = (RandomForestClassifier, DecisionTreeClassifier, GBTClassifier)
# Fitted once per class when there are more.
_TWO_CLASSES = (GBTClassifier, LinearSVC)
# Grown from counted rows where there are many.
_COUNTED = (DecisionTreeClassifier, GBTClassifier)
#: Rows from which trees are grown from counted rows.
_MANY_ROWS = 1_000_000
#: Different values (estimated) up to which a column is not cut into bins: the classifier does so itself, if need be.
_FEW_VALUES = 100
#: Error of the shares at which columns are cut.
_CUT_ERROR = 0.001
_BIN = "_bin_"
CLASSIFIERS = (*_KNOWN, "knn")


def create_classifier(name: str, task: str = "classification", rows: int | None = None, **params):
    """A Spark classifier by name. Parameters take their common names or Spark's own; ``knn`` has its own class.

    ``C`` of the linear models weighs the sum of the losses against the penalty, 1 unless given; Spark weighs their mean, so
    it needs the number of training rows, ``rows``.
    """
    if task != "classification":
        raise ValueError(f"only classification is offered, not {task}")
    if name == "knn":
        return NeighbourClassifier(**params)
    if name not in _KNOWN:
        raise ValueError(f"no classifier goes by the name {name}; there are {', '.join(CLASSIFIERS)}")
    kind, names, defaults = _KNOWN[name]
    chosen = dict(defaults)
    for given, value in params.items():
        if given == "C" and kind in _PENALIZED:
            continue
        elif given == "random_state" and kind not in _SEEDED:
            continue
        else:
            chosen[names.get(given, given)] = value
    estimator = kind(featuresCol=FEATURES, labelCol="_label")
    unknown = [p for p in chosen if not estimator.hasParam(p)]
    if unknown:
        raise ValueError(f"{name} has no parameter {unknown}")
    if kind in _PENALIZED and "regParam" not in chosen:
        if rows is None:
            raise ValueError("the penalty depends on the number of training rows")
        chosen |= {"regParam": 1.0 / (params.get("C", 1.0) * max(rows, 1)), "standardization": False}
    return estimator._set(**chosen)


def _named(columns: Sequence[str], names: Sequence[str]) -> list[Column]:
    return [F.col("`" + c.replace("`", "``") + "`").alias(n) for c, n in zip(columns, names, strict=True)]


def _assembler(names: Sequence[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=list(names), outputCol=FEATURES, handleInvalid="keep")


class NeighbourClassifier:
    """Majority of the k nearest training rows; the training table is the model."""

    def __init__(self, n_neighbors: int = 5):
        self.k = n_neighbors
        self.train: DataFrame | None = None

    def fit(self, rows: DataFrame) -> NeighbourClassifier:
        fitted = NeighbourClassifier(self.k)
        # Written, so that the ids stay the same wherever the table is read again.
        fitted.train = materialize(
            rows.select(
                F.monotonically_increasing_id().alias("_id"), vector_to_array(FEATURES).alias("_vector"), "_label"
            ),
            "neighbours",
        )
        return fitted


@dataclass(frozen=True)
class ModelPlan:
    """Preprocessing, optional class balancing while fitting, and a classifier."""

    model: str
    preprocessor: Preprocessor
    params: Mapping[str, Any] = field(default_factory=dict)
    resampling: str | None = None
    resampling_params: Mapping[str, Any] = field(default_factory=dict)

    def __post_init__(self):
        if self.resampling not in (None, "smote", "random_over", "random_under"):
            raise ValueError(f"resampling is smote, random_over or random_under, not {self.resampling}")

    def fit(
        self, df: DataFrame, label: str, keys: Sequence[str], prepared: FittedPreprocessor | None = None
    ) -> FittedModel:
        """Fit on ``df``. Key and label are no features; rows are balanced here and never when scoring.

        ``prepared`` is the preprocessing, where it has been fitted before.
        """
        if prepared is None:
            # Each statistic reads the rows anew: what is behind them is worked out once.
            df = materialize(dealt(df.select(*self._used(df, keys, label))), "rows")
            prepared = self.preprocessor.fit(df, exclude=[*keys, label])
        elif self.resampling is not None:
            df = materialize(df.select(*self._used(df, keys, label)), "rows")
        labelled = df.withColumn("_label", F.col(label).cast("double"))
        grown = _KNOWN.get(self.model, (None,))[0] in _COUNTED
        if grown and df.count() >= _MANY_ROWS and self._counts(prepared.transform(df.limit(0)), prepared):
            return self._fit_counted(labelled, prepared)
        steps = PipelineModel([*prepared.stages(df.sparkSession), _assembler(prepared.names)])
        rows = self._balanced(labelled, steps, keys)
        if self.model == "knn":
            return FittedModel(steps, neighbours=NeighbourClassifier(**self.params).fit(rows))
        if prepared.dictionaries:
            # Looked-up categories are joined once.
            rows = materialize(rows, "features")
        # Hundreds of short passes: as many tasks as there are cores, fewer for few rows.
        return self._fitted(rows.select("_label", FEATURES).coalesce(tasks_for(df)), steps)

    def _counts(self, features: DataFrame, prepared: FittedPreprocessor) -> bool:
        """Whether a row that counts n times does what n equal rows do: no draw of rows, no least number of them."""
        if self.resampling is not None or prepared.dictionaries:
            return False
        classifier = create_classifier(self.model, **self.params)
        drawn = classifier.hasParam("subsamplingRate") and classifier.getOrDefault("subsamplingRate") < 1.0
        numbers = all(isinstance(f.dataType, NumericType | BooleanType) for f in features.schema)
        return numbers and not drawn and classifier.getMinInstancesPerNode() == 1 and not classifier.isSet("weightCol")

    def _fit_counted(self, rows: DataFrame, prepared: FittedPreprocessor) -> FittedModel:
        """Fit trees on the different rows and their numbers, after columns of many values have been cut into bins.

        Trees look at ``maxBins`` bins a column only. Cut beforehand, at shares of all rows instead of those of a sample, rows of
        the same bins and label are equal to them: what the fit keeps and passes over hundreds of times is bounded by the
        bins that occur together, not by the rows.
        """
        short = [f"_{i}" for i in range(len(prepared.names))]
        values = prepared.transform(rows).toDF(*short)
        differing = values.agg(*[F.approx_count_distinct(c).alias(c) for c in short]).first()
        many = [i for i, c in enumerate(short) if differing[c] > _FEW_VALUES]
        bins = create_classifier(self.model, **self.params).getMaxBins()
        cuts = values.approxQuantile([short[i] for i in many], [i / bins for i in range(1, bins)], _CUT_ERROR)
        names = list(prepared.names)
        stages = prepared.stages(rows.sparkSession)
        if many:
            splits = [[-float("inf"), *sorted(set(c)), float("inf")] for c in cuts]
            columns = [names[i] for i in many]
            names = [_BIN + c if i in many else c for i, c in enumerate(names)]
            binned = [_BIN + c for c in columns]
            stages.append(Bucketizer(splitsArray=splits, inputCols=columns, outputCols=binned, handleInvalid="keep"))
        found = PipelineModel(stages).transform(rows).select("_label", *_named(names, short))
        counted = materialize(dealt(found.groupBy("_label", *short).agg(F.count("*").cast("double").alias("_rows"))), "counted")
        training = _assembler(short).transform(counted).select("_label", "_rows", FEATURES)
        return self._fitted(training.coalesce(tasks_for(counted)), PipelineModel([*stages, _assembler(names)]), "_rows")

    def _fitted(self, training: DataFrame, steps: PipelineModel, weight: str | None = None) -> FittedModel:
        """The classifier, fitted on label and features, behind the steps."""
        context = training.sparkSession.sparkContext
        if context.getCheckpointDir() is None:
            # Boosting checkpoints every ten trees, so that hundreds of them don't hang on one lineage.
            context.setCheckpointDir(f"{shared_root(training.sparkSession)}/checkpoints")
        several = _KNOWN.get(self.model, (None,))[0] in _TWO_CLASSES and training.select("_label").distinct().limit(3).count() > 2
        weights = {"weightCol": weight} if weight else {}
        if _KNOWN.get(self.model, (None,))[0] in _PENALIZED:
            # Linear fits keep the rows in blocks of their own, after two passes: kept here as well, they would fill the
            # memory twice.
            classifier = create_classifier(self.model, rows=training.count(), **self.params)
        else:
            classifier = create_classifier(self.model, **self.params, **weights)
            training = training.persist(StorageLevel.MEMORY_AND_DISK)
        if several:
            classifier = OneVsRest(classifier=classifier, featuresCol=FEATURES, labelCol="_label", **weights)
        try:
            return FittedModel(PipelineModel([*steps.stages, classifier.fit(training)]))
        finally:
            training.unpersist()

    def _used(self, df: DataFrame, keys: Sequence[str], label: str) -> list[str]:
        """The columns that the fit reads."""
        chosen = self.preprocessor
        if not chosen.drop:
            return df.columns
        return list(dict.fromkeys([*keys, label, *chosen.numeric, *chosen.categorical, *chosen.passthrough]))

    def _balanced(self, df: DataFrame, steps: PipelineModel, keys: Sequence[str]) -> DataFrame:
        """Key, ``_label`` and feature vector of the rows to fit on."""

        def features(rows: DataFrame) -> DataFrame:
            return steps.transform(rows).select(*keys, "_label", FEATURES)

        if self.resampling is None:
            return features(df)
        options = {"seed": 42, **self.resampling_params}
        if "random_state" in options:
            options["seed"] = options.pop("random_state")
        if self.resampling in ("random_over", "random_under"):
            # Drawn before the vectors are made: the columns are smaller to move. Read several times by the fit.
            sample = over_sample if self.resampling == "random_over" else under_sample
            return features(materialize(sample(df, "_label", keys, **options), "balanced"))
        # Read several times by the neighbour search and the fit.
        rows = materialize(features(df), "features")
        # Several key columns are one struct to the neighbour search.
        arrays, key = rows, keys[0]
        if len(keys) != 1:
            arrays, key = rows.withColumn("_key", F.to_json(F.struct(*keys))), "_key"
        if "k_neighbors" in options:
            options["k"] = options.pop("k_neighbors")
        arrays = arrays.withColumn(FEATURES, vector_to_array(FEATURES)).select(key, "_label", FEATURES)
        made = smote(arrays, "_label", key, FEATURES, **options)
        both = materialize(arrays.unionByName(made.select(arrays.columns)), "balanced")
        return both.withColumn(FEATURES, array_to_vector(FEATURES))


@dataclass(frozen=True)
class FittedModel:
    """A fitted Spark model, or preprocessing steps with a neighbour table."""

    spark_model: PipelineModel
    neighbours: NeighbourClassifier | None = None

    def score(self, df: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
        """The input with ``prediction`` and ``probability``, the probability of class 1.

        The linear SVM, and boosted trees of more than two classes, give no probability.
        """
        if self.neighbours is not None:
            return self._vote(df, keys)
        scored = self.spark_model.transform(df)
        chance = F.lit(None).cast("double")
        if "probability" in scored.columns:
            chance = F.get(vector_to_array("probability"), F.lit(1))
        return scored.select(*df.columns, "prediction", chance.alias("probability"))

    def _vote(self, df: DataFrame, keys: Sequence[str]) -> DataFrame:
        if not keys:
            raise ValueError("scoring with neighbours needs the key")
        id = F.col(keys[0]) if len(keys) == 1 else F.to_json(F.struct(*keys))
        rows = self.spark_model.transform(df).select(id.alias("_id"), vector_to_array(FEATURES).alias("_vector"))
        votes = neighbour_vote(self.neighbours.train, rows, "_id", "_vector", "_label", self.neighbours.k)
        return df.withColumn("_id", id).join(votes, "_id").drop("_id")

    @property
    def classifier(self) -> Model:
        return self.spark_model.stages[-1]

    def feature_names(self) -> list[str]:
        """A name for each number of the feature vector; those of a one-hot vector are the codes of its dictionary."""
        sizes = {}
        for stage in self.spark_model.stages:
            if isinstance(stage, OneHotEncoderModel):
                sizes |= dict(zip(stage.getOutputCols(), stage.categorySizes, strict=True))
        columns = next(s for s in self.spark_model.stages if isinstance(s, VectorAssembler)).getInputCols()
        columns = [c.removeprefix(_BIN) for c in columns]
        return [n for c in columns for n in ([f"{c}[{k}]" for k in range(sizes[c])] if c in sizes else [c])]


def score_with_lookups(
    model: FittedModel, base: DataFrame, lookups: Sequence[Lookup], keys: Sequence[str] = ()
) -> DataFrame:
    """Look the features up by key, then score."""
    return model.score(training_set(base, lookups), keys)


def score_in_batches(df: DataFrame, predict: Callable[[pd.DataFrame], pd.DataFrame], schema: StructType | str) -> DataFrame:
    """Score with a model that is not Spark's: ``predict`` gets Arrow batches as pandas frames, on the executors."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield predict(batch)

    return df.mapInPandas(run, schema)


def _importances(classifier: Model) -> np.ndarray:
    if hasattr(classifier, "featureImportances"):
        return classifier.featureImportances.toArray()
    if not classifier.hasParam("regParam"):
        raise ValueError("Model has no feature importances or coefficients")
    # The first class of a multinomial model.
    several = getattr(classifier, "numClasses", 2) > 2
    return abs(classifier.coefficientMatrix.toArray()[0] if several else classifier.coefficients.toArray())


def feature_importance(spark: SparkSession, model: FittedModel, n: int | None = None) -> DataFrame:
    """``feature`` and ``importance``: tree importances or absolute coefficients, largest first."""
    classifier = model.classifier
    # One model per class: the mean over the classes.
    each = classifier.models if isinstance(classifier, OneVsRestModel) else [classifier]
    values = sum(_importances(c) for c in each) / len(each)
    rows = [(name, float(v)) for name, v in zip(model.feature_names(), values, strict=True)]
    return top_n(spark.createDataFrame(rows, "feature string, importance double"), "importance", "feature", n)


class ModelFolder:
    """Models under numbered versions in one folder. A version counts once its row is in the version table."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _versions(self) -> DataFrame:
        return self.spark.read.schema("version int, alias string").parquet(f"{self.path}/versions")

    def latest(self, alias: str = "latest-model") -> int | None:
        jvm = self.spark.sparkContext._jvm
        table = jvm.org.apache.hadoop.fs.Path(f"{self.path}/versions")
        if not table.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(table):
            return None
        return self._versions().where(F.col("alias") == alias).agg(F.max("version")).first()[0]

    def register(self, model: FittedModel, alias: str = "latest-model") -> int:
        """Save as the next version, which becomes the newest under the alias."""
        version = (self.latest(alias) or 0) + 1
        stages = [self._own_tables(s, f"{self.path}/{alias}/tables/v={version}") for s in model.spark_model.stages]
        PipelineModel(stages).write().save(f"{self.path}/{alias}/v={version}")
        if model.neighbours is not None:
            table = model.neighbours.train.withColumn("_k", F.lit(model.neighbours.k))
            table.write.parquet(f"{self.path}/{alias}/neighbours/v={version}")
        row = self.spark.createDataFrame([(version, alias)], "version int, alias string")
        row.coalesce(1).write.mode("append").parquet(f"{self.path}/versions")
        return version

    def _own_tables(self, stage, path: str):
        """The stage, reading from copies of its tables that are kept with the model."""
        if not isinstance(stage, SQLTransformer):
            return stage
        statement = stage.getStatement()
        for i, table in enumerate(dict.fromkeys(re.findall(r"parquet\.`([^`]+)`", statement))):
            self.spark.read.parquet(table).write.partitionBy("column").parquet(f"{path}/{i}")
            statement = statement.replace(f"parquet.`{table}`", f"parquet.`{path}/{i}`")
        return SQLTransformer(statement=statement)

    def load(self, version: int | None = None, alias: str = "latest-model") -> FittedModel:
        chosen = version or self.latest(alias)
        if chosen is None:
            raise LookupError(f"no model under {self.path} with alias {alias}")
        stages = PipelineModel.load(f"{self.path}/{alias}/v={chosen}")
        if isinstance(stages.stages[-1], Model):
            return FittedModel(stages)
        table = self.spark.read.parquet(f"{self.path}/{alias}/neighbours/v={chosen}")
        neighbours = NeighbourClassifier(table.select("_k").first()[0])
        neighbours.train = table.drop("_k")
        return FittedModel(stages, neighbours)
