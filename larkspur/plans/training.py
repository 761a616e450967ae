"""Training from end to end: feature table, lookup, fit, evaluation, verdict, promotion."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.operators import feature_table
from larkspur.operators.evaluate import champion_verdict, classification_metrics
from larkspur.operators.joins import Lookup, training_set
from larkspur.operators.models import ModelFolder, ModelPlan
from larkspur.operators.tables import table_exists
from larkspur.workspace import materialize


@dataclass(frozen=True)
class TrainingJob:
    """One model's tables and settings. Rows given to ``run`` hold key, features and label."""

    spark: SparkSession
    feature_table: str
    models: ModelFolder
    plan: ModelPlan
    keys: Sequence[str]
    label: str

    def update_features(self, train: DataFrame, test: DataFrame) -> None:
        """Create the feature table from both parts, or merge them into it."""
        rows = train.unionByName(test, allowMissingColumns=True).drop(self.label)
        if table_exists(self.spark, self.feature_table):
            feature_table.merge_into(self.spark, self.feature_table, rows, self.keys)
        else:
            feature_table.create_feature_table(rows, self.feature_table, self.keys)

    def lookups(self) -> list[Lookup]:
        table = feature_table.read_feature_table(self.spark, self.feature_table)
        return [Lookup(table, [c for c in table.columns if c not in self.keys], self.keys)]

    def training_rows(self, rows: DataFrame) -> DataFrame:
        """Key and label with the looked-up features."""
        return training_set(rows.select(*self.keys, self.label), self.lookups(), label=self.label)

    def run(self, train: DataFrame, test: DataFrame) -> DataFrame:
        """Fit, compare with the newest saved model on the same test rows, and save when strictly better.

        One row: the new model's metrics, both F1 scores, the verdict and the newest version afterwards.
        """
        self.update_features(train, test)
        # Read several times by the fit and by both models: looked up once.
        trained = materialize(self.training_rows(train), "train")
        tested = materialize(self.training_rows(test), "test")
        model = self.plan.fit(trained, self.label, self.keys)
        scores = model.score(tested, self.keys).withColumnRenamed("prediction", "challenger")
        champion = None
        if self.models.latest() is not None:
            champion = "champion"
            old = self.models.load().score(tested, self.keys).select(*self.keys, F.col("prediction").alias(champion))
            scores = scores.join(old, list(self.keys))
        scores = materialize(scores.select(*self.keys, self.label, "challenger", "probability", *([champion] if champion else [])), "scores")
        verdict = champion_verdict(scores, self.label, "challenger", champion).first()
        if verdict["improved"]:
            self.models.register(model)
        metrics = classification_metrics(scores, self.label, "challenger", "probability")
        return metrics.withColumns(
            {
                "challenger_f1": F.lit(verdict["challenger"]),
                "champion_f1": F.lit(verdict["champion"]).cast("double"),
                "improved": F.lit(verdict["improved"]),
                "version": F.lit(self.models.latest()),
            }
        )
