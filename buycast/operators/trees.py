"""Additive trees as tables: node rows, storage, scores by expression or in Arrow batches, staged scores, importances.

A node row is (tree, node, feature, threshold, missing_left, left, right, value, gain, cover, n): ``feature`` is null in
leaves. Rows with ``feature <= threshold`` go left, null and NaN where ``missing_left`` says. ``value`` is added to the
margin; ``cover`` is the sum of second derivatives, ``n`` the number of training rows.
"""

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from buycast.functions.numbers import sigmoid

NODE_SCHEMA = ("tree int, node int, feature string, threshold double, missing_left boolean, left int, right int, "
               "value double, gain double, cover double, n long")


def leaf_of(x, missing, feature, cut, missing_left, left, right):
    """The leaf that each row of the matrix ``x`` reaches; arrays describe one tree, ``feature`` is −1 in leaves."""
    node, rows = np.zeros(len(x), dtype=np.int64), np.arange(len(x))
    while len(rows):
        rows = rows[feature[node[rows]] >= 0]
        at = node[rows]
        value = x[rows, feature[at]]
        goes_left = np.where(missing(value), missing_left[at], value <= cut[at])
        node[rows] = np.where(goes_left, left[at], right[at])
    return node


class TreeModel:
    """Trees over named features; the margin of a row is ``base`` plus one value per tree."""

    def __init__(self, features, nodes, base=0.0):
        self.features, self.base = list(features), float(base)
        self.nodes = sorted(nodes, key=lambda r: (r["tree"], r["node"]))
        place = {f: i for i, f in enumerate(self.features)}
        self.trees = []
        for t in range(self.rounds):
            own = [r for r in self.nodes if r["tree"] == t]
            self.trees.append({
                "feature": np.array([place.get(r["feature"], -1) for r in own]),
                "cut": np.array([np.nan if r["threshold"] is None else r["threshold"] for r in own]),
                "missing_left": np.array([bool(r["missing_left"]) for r in own]),
                "left": np.array([r["left"] or 0 for r in own]), "right": np.array([r["right"] or 0 for r in own]),
                "value": np.array([r["value"] for r in own])})

    @property
    def rounds(self):
        return 1 + max((r["tree"] for r in self.nodes), default=-1)

    def first(self, rounds):
        """The model after its first ``rounds`` trees."""
        return TreeModel(self.features, [r for r in self.nodes if r["tree"] < rounds], self.base)

    def node_table(self, spark: SparkSession) -> DataFrame:
        names = [c.split()[0] for c in NODE_SCHEMA.split(", ")]
        return spark.createDataFrame([tuple(r[c] for c in names) for r in self.nodes], NODE_SCHEMA)

    def _steps(self, x):
        """The values of all trees, one after the other, for the rows of a matrix."""
        for t in self.trees:
            yield t["value"][leaf_of(x, np.isnan, *(t[k] for k in ("feature", "cut", "missing_left", "left", "right")))]

    def _packed(self):
        return F.array(*[F.col(f"`{f}`").cast("double") for f in self.features])

    def margin(self):
        """Column: the margin, in Arrow batches; for any number of trees."""
        model = self

        @F.pandas_udf("double")
        def margin(rows: pd.Series) -> pd.Series:
            out = np.full(len(rows), model.base)
            if len(rows):
                for step in model._steps(np.stack(rows.to_numpy()).astype(float)):
                    out += step
            return pd.Series(out)

        return margin(self._packed())

    def margin_expression(self):
        """Column: the margin as one expression of built-in functions; for few trees, since it grows with them."""
        def below(t, node):
            feature = t["feature"][node]
            if feature < 0:
                return F.lit(float(t["value"][node]))
            x = F.col(f"`{self.features[feature]}`").cast("double")
            lost = x.isNull() | F.isnan(x)
            known = x <= F.lit(float(t["cut"][node]))
            goes_left = (lost | known) if t["missing_left"][node] else (~lost & known)
            return F.when(goes_left, below(t, t["left"][node])).otherwise(below(t, t["right"][node]))

        out = F.lit(self.base)
        for t in self.trees:
            out = out + below(t, 0)
        return out

    def staged(self):
        """Column: an array of the margins after 1, 2 … trees."""
        model = self

        @F.pandas_udf("array<double>")
        def margins(rows: pd.Series) -> pd.Series:
            if not len(rows):
                return pd.Series([], dtype=object)
            steps = np.stack([np.zeros(len(rows)), *model._steps(np.stack(rows.to_numpy()).astype(float))])
            return pd.Series(list((model.base + np.cumsum(steps, axis=0))[1:].T))

        return margins(self._packed())

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with ``margin`` and ``probability``."""
        return df.withColumn("margin", self.margin()).withColumn("probability", sigmoid(F.col("margin")))

    def save(self, path):
        """Write the node table, and beside it the features and the base."""
        spark = SparkSession.active()
        self.node_table(spark).coalesce(1).write.mode("overwrite").parquet(f"{path}/nodes")
        spark.createDataFrame([(self.features, self.base)], "features array<string>, base double").coalesce(1).write.mode(
            "overwrite").parquet(f"{path}/about")

    @staticmethod
    def load(path):
        spark = SparkSession.active()
        about = spark.read.parquet(f"{path}/about").first()
        return TreeModel(about.features, [r.asDict() for r in spark.read.parquet(f"{path}/nodes").collect()], about.base)


def split_importances(nodes: DataFrame) -> DataFrame:
    """(feature, splits, gain, cover) of a node table: how often a feature splits, and the gains and covers of its splits."""
    return nodes.filter(F.col("feature").isNotNull()).groupBy("feature").agg(
        F.count(F.lit(1)).alias("splits"), F.sum("gain").alias("gain"), F.sum("cover").alias("cover"))
