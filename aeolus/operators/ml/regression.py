"""Regression: mean baseline, OLS, ridge, lasso and their scores."""

from __future__ import annotations

import logging

from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ...constants import LASSO_ALPHA, RIDGE_ALPHA
from .prep import Prepared

log = logging.getLogger("aeolus.ml")

MODELS = ("linear_regression", "ridge", "lasso")


def regression_scores(df: DataFrame, label: str, prediction: str | Column = "prediction") -> DataFrame:
    """One row (mae, rmse, r2, rows) in one aggregate pass.

    R^2 = 1 - SSE / (n * var_pop(y)); a constant target gives 1 for a perfect
    fit and 0 otherwise (the usual finite convention)."""
    p = F.col(prediction) if isinstance(prediction, str) else prediction
    e = F.col(label) - p
    agg = df.agg(F.avg(F.abs(e)).alias("mae"),
                 F.sqrt(F.avg(e * e)).alias("rmse"),
                 F.sum(e * e).alias("_sse"),
                 (F.count(F.lit(1)) * F.var_pop(label)).alias("_sst"),
                 F.count(F.lit(1)).alias("rows"))
    r2 = (F.when(F.col("_sst") > 0, F.lit(1.0) - F.col("_sse") / F.col("_sst"))
          .when(F.col("_sse") == 0, F.lit(1.0)).otherwise(F.lit(0.0)))
    return agg.select("mae", "rmse", r2.alias("r2"), "rows")


def train_mean(train: DataFrame, label: str) -> float:
    """M6: mean of the training target (one number to the driver); 0 without rows."""
    return float(train.agg(F.coalesce(F.avg(label), F.lit(0.0))).first()[0])


def baseline_scores(prep: Prepared, label: str) -> DataFrame:
    """M6 + M10: predict the train mean for every test row."""
    mean = train_mean(prep.data.filter(~F.col("is_test")), label)
    return regression_scores(prep.data.filter(F.col("is_test")), label, F.lit(mean))


def fit(prep: Prepared, label: str, model: str, alpha: float | None = None) -> LinearRegressionModel:
    """M7-M9 on scaled features, by L-BFGS (OWL-QN for the lasso) at every width.

    * OLS: no penalty.
    * ridge ``||y - Xw||^2 + a||w||^2``: Spark halves the squared error, takes
      its mean and divides the label by its sample std, so
      ``regParam = a * std_samp(y) / n``.
    * lasso ``||y - Xw||^2 / 2n + a||w||_1``: ``regParam = a`` with
      ``elasticNetParam = 1``.

    All one-hot levels are kept, which leaves the unpenalised coefficients free
    along one direction; predictions are unique, and the tolerance is tight
    enough for them to match an exact solution. A fit that stops at the
    iteration limit is reported."""
    train = prep.data.filter(~F.col("is_test"))
    common = dict(featuresCol="features", labelCol=label, standardization=False,
                  fitIntercept=True, tol=1e-12, solver="l-bfgs")
    limit = 20000 if model == "lasso" else 1000
    if model == "linear_regression":
        est = LinearRegression(regParam=0.0, elasticNetParam=0.0, maxIter=limit, **common)
    elif model == "ridge":
        a = RIDGE_ALPHA if alpha is None else alpha
        row = train.agg(F.count(F.lit(1)).alias("n"), F.stddev_samp(label).alias("sd")).first()
        reg = a * float(row["sd"] or 0.0) / float(row["n"]) if row["n"] else 0.0
        est = LinearRegression(regParam=reg, elasticNetParam=0.0, maxIter=limit, **common)
    elif model == "lasso":
        a = LASSO_ALPHA if alpha is None else alpha
        est = LinearRegression(regParam=a, elasticNetParam=1.0, maxIter=limit, **common)
    else:
        raise ValueError(f"unknown model {model!r}; expected one of {MODELS}")
    fitted = est.fit(train)
    if fitted.hasSummary and fitted.summary.totalIterations >= limit:
        log.warning("%s on %s stopped at the limit of %d iterations", model, label, limit)
    return fitted


def model_scores(prep: Prepared, label: str, model: str, alpha: float | None = None) -> DataFrame:
    """Fit on train, score on test: (model, mae, rmse, r2, rows)."""
    m = fit(prep, label, model, alpha)
    scored = m.transform(prep.data.filter(F.col("is_test")))
    return regression_scores(scored, label).select(F.lit(model).alias("model"), "*")
