"""Evaluation: accuracy and support-weighted F1 from ONE confusion-count
aggregate, exact area under ROC, per-class counts.

The confusion table has at most k^2 rows (k = classes), so everything after
the single aggregation pass is tiny."""

from __future__ import annotations

from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def confusion_counts(df: DataFrame, label: str, prediction: str) -> DataFrame:
    return df.groupBy(F.col(label).alias("y"), F.col(prediction).alias("z")).agg(
        F.count(F.lit(1)).alias("n"))


def accuracy_f1(df: DataFrame, label: str, prediction: str, digits: int = 9) -> DataFrame:
    """(accuracy, f1) with f1 = sum_c f1_c * support_c / total (Spark's "f1").

    One scan of the input: the confusion cells (k^2 rows) are aggregated
    once more per class -- every cell counts towards the support of its
    actual class and the predictions of its predicted class."""
    cm = confusion_counts(df, label, prediction)
    cell = F.explode(F.array(
        F.struct(F.col("y").alias("c"), F.col("n").alias("support"),
                 F.when(F.col("y") == F.col("z"), F.col("n")).otherwise(0).alias("tp"),
                 F.lit(0).cast("bigint").alias("pred")),
        F.struct(F.col("z").alias("c"), F.lit(0).cast("bigint").alias("support"),
                 F.lit(0).cast("bigint").alias("tp"), F.col("n").alias("pred"))))
    per_class = (cm.select(cell.alias("e")).select("e.*")
                   .groupBy("c").agg(F.sum("support").alias("support"), F.sum("tp").alias("tp"),
                                     F.sum("pred").alias("pred"))
                   .where(F.col("support") > 0))
    p = F.col("tp") / F.col("pred")
    r = F.col("tp") / F.col("support")
    f = F.when(F.col("tp") > 0, 2 * p * r / (p + r)).otherwise(F.lit(0.0))
    return per_class.agg(
        F.round(F.sum("tp") / F.sum("support"), digits).alias("accuracy"),
        F.round(F.sum(f * F.col("support")) / F.sum("support"), digits).alias("f1"))


def multiclass_metrics(df: DataFrame, label: str, prediction: str) -> dict[str, float]:
    row = accuracy_f1(df, label, prediction, digits=15).first()
    return {"accuracy": row.accuracy, "f1": row.f1}


def area_under_roc(df: DataFrame, label: str, score: str) -> float:
    """Exact AUC (ties averaged).  ``numBins=0`` disables down-sampling of the
    ROC curve; the computation is Spark's distributed sort + per-partition
    cumulative counts."""
    data = df.select(F.col(score).cast("double").alias("score"),
                     F.col(label).cast("double").alias("label"))
    ev = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label",
                                       metricName="areaUnderROC", numBins=0)
    return ev.evaluate(data)


def auc_frame(spark: SparkSession, df: DataFrame, label: str, score: str,
              digits: int = 9) -> DataFrame:
    auc = area_under_roc(df, label, score)
    return spark.createDataFrame([(round(auc, digits),)], "auc double")
