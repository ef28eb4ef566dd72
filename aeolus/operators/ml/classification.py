"""Classification: weighted logistic regression, scores, confusion, AUC."""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ...constants import LOGREG_C, PROBA_CUT
from .prep import Prepared, with_class_weights


def fit_logistic(prep: Prepared, label: str, c: float = LOGREG_C,
                 max_iter: int = 1000) -> LogisticRegressionModel:
    """L2 logistic regression with balanced class weights.

    The source objective ``C * sum(w_i * loss_i) + ||w||^2 / 2`` equals Spark's
    ``sum(w_i * loss_i) / sum(w) + reg/2 ||w||^2`` with ``reg = 1 / (C * sum(w))``;
    balanced weights sum to n. (liblinear also penalises the intercept; Spark
    does not, which moves the intercept slightly.)"""
    data = with_class_weights(prep.data, label)
    train = data.filter(~F.col("is_test"))
    n = train.agg(F.sum("weight")).first()[0] or 1.0
    est = LogisticRegression(featuresCol="features", labelCol=label, weightCol="weight",
                             regParam=1.0 / (c * float(n)), elasticNetParam=0.0,
                             standardization=False, maxIter=max_iter, tol=1e-10,
                             family="binomial")
    return est.fit(train)


def score(model: LogisticRegressionModel, df: DataFrame, cut: float = PROBA_CUT) -> DataFrame:
    """Positive-class probability and the ``proba >= cut`` decision
    (Spark's own ``prediction`` may differ exactly at the cut)."""
    out = model.transform(df)
    proba = vector_to_array(F.col("probability"))[1]
    return (out.withColumn("congestion_proba", proba)
               .withColumn("is_congested_pred", (F.col("congestion_proba") >= cut).cast("int"))
               .drop("rawPrediction", "probability", "prediction"))


def classification_scores(scored: DataFrame, actual: str = "is_congested_actual",
                          pred: str = "is_congested_pred") -> DataFrame:
    """Accuracy, precision, recall, F1 (0 on zero division), one pass."""
    a, p = F.col(actual), F.col(pred)
    agg = scored.agg(F.count(F.lit(1)).alias("n"),
                     F.count(F.when((a == 1) & (p == 1), 1)).alias("tp"),
                     F.count(F.when((a == 0) & (p == 1), 1)).alias("fp"),
                     F.count(F.when((a == 1) & (p == 0), 1)).alias("fn"),
                     F.count(F.when(a == p, 1)).alias("hit"))
    prec = F.coalesce(F.try_divide(F.col("tp"), F.col("tp") + F.col("fp")), F.lit(0.0))
    rec = F.coalesce(F.try_divide(F.col("tp"), F.col("tp") + F.col("fn")), F.lit(0.0))
    f1 = F.coalesce(F.try_divide(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")),
                    F.lit(0.0))
    return agg.select(F.try_divide(F.col("hit"), F.col("n")).alias("accuracy"), prec.alias("precision"),
                      rec.alias("recall"), f1.alias("f1"))


def confusion_matrix(scored: DataFrame, actual: str = "is_congested_actual",
                     pred: str = "is_congested_pred") -> DataFrame:
    """The full 2 x 2 grid (zero cells included), from one aggregate."""
    a, p = F.col(actual), F.col(pred)
    cells = [(i, j) for i in (0, 1) for j in (0, 1)]
    agg = scored.agg(*[F.count(F.when((a == i) & (p == j), 1)).alias(f"c{i}{j}") for i, j in cells])
    stack = ", ".join(f"{i}, {j}, c{i}{j}" for i, j in cells)
    return agg.selectExpr(f"stack(4, {stack}) as (actual, predicted, rows)")


def roc_auc(scored: DataFrame, actual: str = "is_congested_actual",
            proba: str = "congestion_proba") -> float | None:
    """Exact ROC AUC (``numBins=0``: every distinct score is a threshold,
    ties averaged — the rank-sum statistic); None with a single class.

    The evaluator aggregates by distinct score and sorts distributed; it
    never collects the rows."""
    n_classes = scored.agg(F.countDistinct(actual)).first()[0]
    if n_classes < 2:
        return None
    ev = BinaryClassificationEvaluator(rawPredictionCol=proba, labelCol=actual,
                                       metricName="areaUnderROC", numBins=0)
    return float(ev.evaluate(scored.select(F.col(proba).cast("double").alias(proba),
                                           F.col(actual).cast("double").alias(actual))))


def predictions_table(model: LogisticRegressionModel, prep: Prepared, label: str,
                      author: str) -> DataFrame:
    """Score every row (train and test) for the map and the sink."""
    return (score(model, prep.data)
            .select(F.col("event_hour").cast("timestamp").alias("event_hour"), "lat", "lon",
                    F.col(label).cast("int").alias("is_congested_actual"),
                    "is_congested_pred", "congestion_proba", F.lit(author).alias("author")))
