"""Logistic regression by a fixed number of full-batch gradient steps, one aggregation per step."""

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from buycast.operators.steps import StepModel
from buycast.runtime import dealt, stored


def descend(train: DataFrame, features, steps=400, rate=0.1, label="label", keep_every=1) -> StepModel:
    """Gradient descent on the mean log loss from weights of 0, with the training table's means and population deviations.

    A deviation of 0 counts as 1. Rows without a label are left out; features must not be null. Weights of every
    ``keep_every``-th step and the last are kept. The rows are written once; each step is one pass that sends one
    sum per weight and task.
    """
    features = list(features)
    rows = train.filter(F.col(label).isNotNull())
    stats = rows.agg(F.count(F.lit(1)), *[f(F.col(f"`{c}`").cast("double")) for f in (F.avg, F.stddev_pop) for c in features]).first()
    n, means, spreads = stats[0], np.array(stats[1:len(features) + 1]), np.array(stats[len(features) + 1:])
    if not n:
        raise ValueError("no labelled rows")
    spreads = np.where(spreads == 0, 1.0, spreads.astype(float))
    frame = StepModel(features, means, spreads, [0], [np.zeros(len(features) + 1)])
    rows = stored(dealt(rows.select(F.col(label).cast("double").alias("y"), frame._packed().alias("x"))))

    def gradient(weights):
        def add(batches):
            total = np.zeros(len(weights))
            for batch in batches:
                x = frame.matrix(batch["x"])
                total += x.T @ (1 / (1 + np.exp(-(x @ weights))) - batch["y"].to_numpy())
            yield pd.DataFrame({"place": np.arange(len(weights)), "sum": total})

        sums = rows.mapInPandas(add, "place int, sum double").groupBy("place").agg(F.sum("sum").alias("sum")).collect()
        return np.array([r["sum"] for r in sorted(sums)]) / n

    weights, kept = np.zeros(len(features) + 1), []
    for i in range(1, steps + 1):
        weights = weights - rate * gradient(weights)
        if i % keep_every == 0 or i == steps:
            kept.append((i, weights))
    return StepModel(features, means, spreads, *zip(*kept)) if kept else frame
