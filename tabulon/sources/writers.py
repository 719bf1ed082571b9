"""Sinks: preprocessed tables, rankings, summaries, feature sets and parameters."""
from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession

FORMATS = ("parquet", "csv")


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    if fmt not in FORMATS:
        raise ValueError(f"format must be one of {FORMATS}")
    writer = df.write.mode(mode)
    writer.option("header", True).csv(path) if fmt == "csv" else writer.parquet(path)


def write_preprocessed(train: DataFrame, labels: DataFrame, test: DataFrame, key: str, folder: str,
                       fmt: str = "parquet") -> dict[str, str]:
    """Train, test and train joined with labels under one folder."""
    out = {"train": f"{folder}/train_values_preprocessed.{fmt}", "test": f"{folder}/test_values_preprocessed.{fmt}",
           "labelled": f"{folder}/train_features_labels_preprocessed.{fmt}"}
    write_table(train, out["train"], fmt)
    write_table(test, out["test"], fmt)
    write_table(train.join(labels, key), out["labelled"], fmt)
    return out


def write_report(df: DataFrame, path: str) -> None:
    """A ranking or history (one row per feature or step) as one CSV file."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def write_summary(spark: SparkSession, summary: dict, path: str) -> None:
    """Scalars of a run as one JSON row."""
    spark.createDataFrame([(json.dumps(summary, default=str),)], "value string").coalesce(1).write.mode(
        "overwrite").text(path)


def feature_set_table(spark: SparkSession, sets: dict[str, list[str]] | DataFrame) -> DataFrame:
    """(feature_set, rank, feature) in long form, from lists by name or a frame (feature_set, features)."""
    from pyspark.sql import functions as F
    wide = sets if isinstance(sets, DataFrame) else spark.createDataFrame(
        [(n, list(f)) for n, f in sets.items()], "feature_set string, features array<string>")
    return wide.select("feature_set", F.posexplode("features").alias("pos", "feature")).select(
        "feature_set", (F.col("pos") + 1).alias("rank"), "feature")


def write_feature_sets(spark: SparkSession, sets: dict[str, list[str]], summaries: dict[str, dict], folder: str) -> None:
    write_report(feature_set_table(spark, sets), f"{folder}/feature_sets.csv")
    for method, values in summaries.items():
        write_summary(spark, {"method": method, **values}, f"{folder}/summary_{method}.json")


def write_params(spark: SparkSession, params: dict[str, dict] | DataFrame, path: str) -> None:
    """Parameters by expert name, from a dictionary or a frame (expert, params as JSON text)."""
    if not isinstance(params, DataFrame):
        rows = [(e, json.dumps(p)) for e, p in sorted(params.items())]
        params = spark.createDataFrame(rows, "expert string, params string").coalesce(1)
    params.write.mode("overwrite").json(path)
