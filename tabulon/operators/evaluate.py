"""Classification metrics; everything derives from one (label, prediction) count table."""
from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from tabulon.functions.numeric import ratio


def pair_counts(df: DataFrame, label: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by, F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(
        F.count("*").alias("n"))


def confusion_matrix(df: DataFrame, label: str, prediction: str, classes: Sequence) -> DataFrame:
    """One row per true class, one ``pred_<class>`` column per predicted class."""
    counts = pair_counts(df, label, prediction)
    return counts.groupBy("label").agg(*[
        F.coalesce(F.sum(F.when(F.col("prediction") == F.lit(c), F.col("n"))), F.lit(0)).cast("long").alias(f"pred_{c}")
        for c in classes])


def class_report(df: DataFrame, label: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    """Precision, recall, f1 and support of every class (0 where undefined)."""
    counts = pair_counts(df, label, prediction, by)
    zero, n = F.lit(0).cast("long"), F.col("n")
    hit = F.when(F.col("label") == F.col("prediction"), n).otherwise(zero)
    sides = counts.select(*by, F.explode(F.array(
        F.struct(F.col("label").alias("cls"), n.alias("t"), zero.alias("p"), hit.alias("tp")),
        F.struct(F.col("prediction").alias("cls"), zero.alias("t"), n.alias("p"), zero.alias("tp")))).alias("s")
    ).select(*by, "s.*")
    sums = sides.groupBy(*by, "cls").agg(F.sum("t").cast("long").alias("support"), F.sum("p").alias("_p"),
                                         F.sum("tp").alias("_tp"))
    return sums.select(
        *by, "cls", ratio(F.col("_tp"), F.col("_p"), 0).alias("precision"),
        ratio(F.col("_tp"), F.col("support"), 0).alias("recall"),
        ratio(2 * F.col("_tp"), F.col("_p") + F.col("support"), 0).alias("f1"), "support")


def scores(df: DataFrame, label: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    """Accuracy, f1_micro, f1_macro (and the row count) for each group of ``by``."""
    by = list(by)
    rep = class_report(df, label, prediction, by)
    hits = (F.col("recall") * F.col("support"))
    return rep.groupBy(*by).agg(
        ratio(F.sum(hits), F.sum("support")).alias("accuracy"),
        ratio(F.sum(hits), F.sum("support")).alias("f1_micro"),
        F.avg("f1").alias("f1_macro"), F.sum("support").cast("long").alias("n"))


def report_averages(report: DataFrame) -> DataFrame:
    """Macro and support-weighted averages of a class report."""
    total = F.sum("support")
    parts = []
    for c in ("precision", "recall", "f1"):
        parts += [F.avg(c).alias(f"macro_{c}"), ratio(F.sum(F.col(c) * F.col("support")), total).alias(f"weighted_{c}")]
    return report.agg(*parts, total.cast("long").alias("support"))


def leaderboard(results: DataFrame, name: str = "model") -> DataFrame:
    """Results ordered by f1_micro, then f1_macro; name breaks ties."""
    return results.orderBy(F.col("f1_micro").desc(), F.col("f1_macro").desc(), name)


def best(results: DataFrame, name: str = "model") -> DataFrame:
    return leaderboard(results, name).limit(1)


def strategy_summary(results: DataFrame) -> DataFrame:
    """Mean, min and max accuracy and number of columns per strategy, best mean first."""
    return results.groupBy("strategy").agg(
        F.avg("accuracy").alias("accuracy_mean"), F.min("accuracy").alias("accuracy_min"),
        F.max("accuracy").alias("accuracy_max"), F.countDistinct("column").alias("n_columns")
    ).orderBy(F.col("accuracy_mean").desc(), "strategy")


def majority_baseline(train: DataFrame, rows: DataFrame, label: str) -> DataFrame:
    """Every row predicted as the most frequent training class (smaller class on ties)."""
    top = train.groupBy(label).count().orderBy(F.col("count").desc(), label).limit(1).select(
        F.col(label).alias("prediction")).first()[0]
    return rows.withColumn("prediction", F.lit(top))


def history_is_consistent(history: DataFrame, change: int) -> DataFrame:
    """Check of a search history: sizes move by ``change`` per step, steps chain, no feature twice."""
    w = Window.partitionBy(F.lit(1)).orderBy("step")
    chained = history.withColumn("prev", F.lag("n_features_after").over(w))
    ok = ((F.col("n_features_after") == F.col("n_features_before") + F.lit(change))
          & (F.col("prev").isNull() | (F.col("prev") == F.col("n_features_before"))))
    return chained.agg(F.count("*").alias("n_steps"), F.count_if(~ok).alias("n_bad_steps"),
                       (F.count("*") - F.countDistinct("feature")).alias("n_repeated"))
