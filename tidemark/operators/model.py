"""ML1-ML3, F11: in-warehouse linear regression (train with a split, evaluate, predict).

``train_value_model`` fits with ``pyspark.ml``. ``least_squares`` is the same fit as
one SQL aggregate: counts, sums and products of the columns (the Gram matrix) are summed over
all rows by partial aggregation, and only those (features + 2)^2 / 2 numbers reach the driver,
which solves the normal equations; training data never does. Several fits (per fold, per group) are one
aggregate with ``by``.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.hashing import u01


def split(df: DataFrame, key: str, train_share: float = 0.8):
    """Deterministic split by a hash of the key (re-runs see the same split)."""
    d = u01(key, "split")
    return df.filter(d < train_share), df.filter(d >= train_share)


def train_value_model(df: DataFrame, features: list[str], label: str, solver: str = "normal") -> PipelineModel:
    """ML1: assemble features, ordinary least squares (no regularisation)."""
    pipe = Pipeline(stages=[VectorAssembler(inputCols=features, outputCol="features"),
                            LinearRegression(featuresCol="features", labelCol=label, predictionCol="prediction",
                                             solver=solver, regParam=0.0, elasticNetParam=0.0)])
    return pipe.fit(df)


def evaluate(model: PipelineModel, df: DataFrame, label: str) -> dict:
    """ML2: mean absolute error and R²."""
    pred = model.transform(df)
    ev = RegressionEvaluator(labelCol=label, predictionCol="prediction")
    return {"mae": ev.setMetricName("mae").evaluate(pred), "r2": ev.setMetricName("r2").evaluate(pred)}


def predict(model: PipelineModel, df: DataFrame) -> DataFrame:
    """ML3: predictions for new rows."""
    return model.transform(df).drop("features")


def coefficients(model: PipelineModel) -> tuple[list[float], float]:
    lr = model.stages[-1]
    return [float(c) for c in lr.coefficients], float(lr.intercept)


def noise(key, salt: str, scale: float) -> Column:
    """noise drawn from the key, the same on every run: uniform in [-scale, scale)."""
    return (u01(key, salt) * 2 - 1) * scale


def gram(df: DataFrame, features: list[str], label: str, by: list[str] = ()) -> DataFrame:
    """ML1: per group, the rows, sums and products of the features and the label. Rows with a NULL
    in any of them take no part."""
    cols = [*features, label]
    x = [F.col(c).cast("double") for c in cols]
    usable = df.where(sum((c.isNull().cast("int") for c in x), F.lit(0)) == 0)
    sums = [F.sum(a).alias("s%d" % i) for i, a in enumerate(x)]
    sums += [F.sum(x[i] * x[j]).alias("p%d_%d" % (i, j)) for i in range(len(x)) for j in range(i, len(x))]
    return usable.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), *sums)


def solve(row, k: int) -> dict | None:
    """The fit of one ``gram`` row over k features: intercept, coefficients and R² on the rows it was summed over;
    None without rows or when the features do not determine the coefficients."""
    import numpy as np
    n = row["n"]
    if not n:
        return None
    s = np.array([row["s%d" % i] for i in range(k + 1)])
    p = np.zeros((k + 1, k + 1))
    for i in range(k + 1):
        for j in range(i, k + 1):
            p[i, j] = p[j, i] = row["p%d_%d" % (i, j)]
    c = p - np.outer(s, s) / n                  # centred: sums of products about the means
    scale = np.sqrt(np.maximum(np.diag(c), 0))
    if (scale[:k] == 0).any() or np.linalg.cond(c[:k, :k] / np.outer(scale[:k], scale[:k])) > 1e12:
        return None
    coef = np.linalg.solve(c[:k, :k] / np.outer(scale[:k], scale[:k]), c[:k, k] / scale[:k]) / scale[:k]
    explained = float(coef @ c[:k, k])
    return {"n": n, "intercept": float((s[k] - coef @ s[:k]) / n), "coefficients": [float(b) for b in coef],
            "r2": explained / float(c[k, k]) if c[k, k] > 0 else 0.0}


def least_squares(df: DataFrame, features: list[str], label: str) -> dict | None:
    """ML1: ordinary least squares with an intercept."""
    return solve(gram(df, features, label).first(), len(features))


def fitted(fit: dict, features: list[str]) -> Column:
    """ML3: the fit as a column expression."""
    return sum((F.lit(b) * F.col(c) for b, c in zip(fit["coefficients"], features)), F.lit(fit["intercept"]))


def scores(df: DataFrame, prediction: Column, label: str) -> DataFrame:
    """ML2: rows, mean absolute error and R² of a prediction on ``df``, in one pass."""
    y, e = F.col(label), F.col(label) - prediction
    return df.agg(F.count(label).alias("n"), F.avg(F.abs(e)).alias("mae"),
                  (1 - F.sum(e * e) / (F.sum(y * y) - F.sum(y) * F.sum(y) / F.count(label))).alias("r2"))
