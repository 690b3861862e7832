"""Logistic regression by Newton steps (G2, G3): a few passes instead of a thousand.

Features that nearly repeat each other make gradient methods crawl. A Newton step needs one more matrix, as wide as the
features are many, and that sums up like the gradient does: a task keeps one such matrix, and they merge in a tree. Rows
are read from their table again for each step, so nothing is held in memory and nothing is spilled.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark import SparkContext
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import StandardScaler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditloom.operators.merging import merged_state

DECREMENT = 1e-16     # squared Newton decrement, relative to the loss, where the optimum counts as reached
HALVINGS = 30


def _sums(df: DataFrame, centre: np.ndarray, scale: np.ndarray, at: np.ndarray) -> tuple[float, float, np.ndarray, np.ndarray]:
    """Weight, loss, gradient and Hessian of the weighted log loss at ``at`` (coefficients, then the intercept), one scan.

    ``df`` holds the features, the label and the weight, in this order.
    """
    size = len(at)

    def partial(batches):
        total = None
        for batch in batches:
            if batch.num_rows:
                cells = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns]).astype(float)
                if np.isnan(cells).any():
                    raise ValueError("Features, label and weight must not be NULL or NaN")
                x, y, w = (cells[:, :-2] - centre) * scale, cells[:, -2], cells[:, -1]
                x = np.column_stack([x, np.ones(len(x))])
                margin = x @ at
                p = 0.5 * (1.0 + np.tanh(0.5 * margin))
                loss = w * (np.logaddexp(0.0, margin) - y * margin)
                own = np.concatenate([[w.sum(), loss.sum()], x.T @ (w * (p - y)), ((x.T * (w * p * (1.0 - p))) @ x).ravel()])
                total = own if total is None else total + own
        return None if total is None else total.tobytes()

    def merge(a, b):
        return (np.frombuffer(a) + np.frombuffer(b)).tobytes()

    flat = np.frombuffer(merged_state(df, partial, merge))
    return flat[0], flat[1], flat[2:2 + size], flat[2 + size:].reshape(size, size)


def newton(df: DataFrame, centre: np.ndarray, scale: np.ndarray, penalty: float, steps: int) -> tuple[np.ndarray, float]:
    """Coefficients and intercept at the minimum of the mean weighted loss + ``penalty`` |w|^2 / 2.

    The loss is convex; a step that doesn't lower it is halved, so the loss falls from step to step.
    """
    ridge = np.full(len(centre) + 1, penalty)
    ridge[-1] = 0.0

    def measured(at):
        weight, loss, gradient, hessian = _sums(df, centre, scale, at)
        return loss / weight + 0.5 * float(ridge @ (at * at)), gradient / weight + ridge * at, hessian / weight + np.diag(ridge)

    at = np.zeros(len(ridge))
    loss, gradient, hessian = measured(at)
    for _ in range(steps):
        step = np.linalg.lstsq(hessian, gradient, rcond=1e-15)[0]
        if float(gradient @ step) <= DECREMENT * loss:
            break
        for _ in range(HALVINGS):
            found = measured(at - step)
            if found[0] <= loss:
                break
            step = step / 2
        else:
            break
        at, (loss, gradient, hessian) = at - step, found
    return at[:-1], float(at[-1])


def _fitted(estimator: LogisticRegression, coefficients: np.ndarray, intercept: float) -> LogisticRegressionModel:
    """Spark's own model with these coefficients, so that it scores, is stored and is served as any other."""
    context = SparkContext._active_spark_context
    values = context._gateway.new_array(context._jvm.double, len(coefficients))
    for i, value in enumerate(coefficients):
        values[i] = float(value)
    vector = context._jvm.org.apache.spark.ml.linalg.DenseVector(values)
    made = context._jvm.org.apache.spark.ml.classification.LogisticRegressionModel(estimator.uid, vector, intercept)
    return estimator._copyValues(LogisticRegressionModel(made))


def fit_pipeline(stages: Sequence, df: DataFrame, features: Sequence[str]) -> PipelineModel:
    """Fit assembler, scaler if there is one, and logistic regression, the last by Newton steps."""
    *before, estimator = stages
    fitted, rows = [], df
    for stage in before:
        fitted.append(stage.fit(rows) if isinstance(stage, StandardScaler) else stage)
        rows = fitted[-1].transform(rows)
    scaler = next((s for s in fitted if hasattr(s, "std")), None)
    centre, scale = np.zeros(len(features)), np.ones(len(features))
    if scaler is not None:
        centre, spread = np.array(scaler.mean), np.array(scaler.std)
        scale = np.divide(1.0, spread, out=np.zeros_like(spread), where=spread != 0)
    weight = F.col(estimator.getWeightCol()) if estimator.isSet("weightCol") else F.lit(1.0)
    narrow = df.select(*[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(features)],
                       F.col(estimator.getLabelCol()).cast("double").alias("y"), weight.cast("double").alias("w"))
    found = newton(narrow, centre, scale, estimator.getRegParam(), estimator.getMaxIter())
    return PipelineModel(stages=[*fitted, _fitted(estimator, *found)])
