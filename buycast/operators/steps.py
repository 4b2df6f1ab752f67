"""A logistic model with its weights after each kept step."""

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from buycast.functions.numbers import sigmoid
from buycast.operators.metrics import auc


class StepModel:
    """Weights after each kept step, for standardised features behind an intercept: row i of ``weights`` belongs to step
    ``steps[i]``. The last row is the model."""

    def __init__(self, features, means, spreads, steps, weights):
        self.features, self.steps = list(features), list(steps)
        self.means, self.spreads = np.array(means, dtype=float), np.array(spreads, dtype=float)
        self.weights = np.array(weights, dtype=float).reshape(len(self.steps), len(self.features) + 1)

    def _packed(self):
        return F.array(*[F.col(f"`{f}`").cast("double") for f in self.features])

    def _margins(self, last):
        model, weights = self, self.weights[-1:] if last else self.weights

        @F.pandas_udf("array<double>")
        def margins(rows: pd.Series) -> pd.Series:
            return pd.Series(list(model.matrix(rows) @ weights.T)) if len(rows) else pd.Series([], dtype=object)

        return margins(self._packed())

    def matrix(self, rows):
        x = (np.stack(rows.to_numpy()).astype(float) - self.means) / self.spreads
        return np.hstack([np.ones((len(x), 1)), x])

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with ``margin`` and ``probability``; null features give null."""
        margin = self._margins(last=True)[0]
        return df.withColumn("margin", F.when(~F.isnan(margin), margin)).withColumn("probability", sigmoid(F.col("margin")))

    def staged_auc(self, df: DataFrame, label="label") -> DataFrame:
        """(iteration, auc) on ``df`` after each kept step, from one pass over the rows."""
        rows = df.filter(F.col(label).isNotNull()).select(F.col(label).alias("label"), self._margins(last=False).alias("margins"))
        steps = F.array(*[F.lit(s) for s in self.steps])
        long = rows.select(F.inline(F.arrays_zip(steps.alias("iteration"), F.col("margins").alias("margin"))), "label")
        return auc(long, "label", "margin", groups=("iteration",))

    def weight_table(self, spark: SparkSession) -> DataFrame:
        """(iteration, feature, weight); the intercept has no feature."""
        rows = [(s, f, float(w)) for s, own in zip(self.steps, self.weights) for f, w in zip([None, *self.features], own)]
        return spark.createDataFrame(rows, "iteration int, feature string, weight double")

    def save(self, path):
        row = (self.features, self.means.tolist(), self.spreads.tolist(), self.steps, self.weights.ravel().tolist())
        SparkSession.active().createDataFrame(
            [row], "features array<string>, means array<double>, spreads array<double>, steps array<int>, weights array<double>"
        ).coalesce(1).write.mode("overwrite").parquet(f"{path}/steps")

    @staticmethod
    def load(path):
        return StepModel(*SparkSession.active().read.parquet(f"{path}/steps").first())
