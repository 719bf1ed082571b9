"""Classifiers behind one fit/profile interface: MLlib models, kNN, boosting and baselines."""
from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any, Callable, Sequence

import math

from pyspark.ml.classification import (DecisionTreeClassifier, GBTClassifier, LogisticRegression,
                                       MultilayerPerceptronClassifier, RandomForestClassifier)
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from tabulon.functions.numeric import first_argmax
from tabulon.operators import neighbors
from tabulon.operators.encode import Scaler, apply_scaler, fit_standard
from tabulon.session import cut

MAX_DEPTH = 30  # MLlib's limit; stands for "unlimited"


@dataclass(frozen=True)
class ModelSpec:
    """Kind and parameters of a classifier; ``scale`` standardises the features first."""
    kind: str
    params: dict[str, Any] = field(default_factory=dict)
    scale: bool = False

    def with_params(self, **params) -> "ModelSpec":
        return ModelSpec(self.kind, {**self.params, **params}, self.scale)


@dataclass
class Fitted:
    spec: ModelSpec
    features: list[str]
    classes: list
    label: str
    id_col: str
    scaler: Scaler | None
    profile: Callable[[DataFrame], DataFrame]   # (id, probs array in class order)


def _depth(v):
    if v is not None and int(v) > MAX_DEPTH:
        raise ValueError(f"tree depth {v} is more than {MAX_DEPTH}; None takes the largest")
    return MAX_DEPTH if v is None else int(v)


def _impurity(p):
    return p.get("criterion", "gini")


def _assembled(df: DataFrame, features: list[str], keep: Sequence[str]) -> DataFrame:
    return VectorAssembler(inputCols=features, outputCol="_x").transform(
        df.select(*keep, *[F.col(c).cast("double").alias(c) for c in features])).select(*keep, "_x")


def _mllib(spec: ModelSpec, n_rows: int, n_features: int, n_classes: int):
    p = spec.params
    common = {"featuresCol": "_x", "labelCol": "_l"}
    seed = p.get("seed", 42)
    if spec.kind == "tree":
        return DecisionTreeClassifier(**common, impurity=_impurity(p), maxDepth=_depth(p.get("max_depth")), seed=seed,
                                      minInstancesPerNode=p.get("min_samples_leaf", 1), maxBins=p.get("max_bins", 64))
    if spec.kind == "forest":
        return RandomForestClassifier(**common, impurity=_impurity(p), numTrees=p.get("n_estimators", 100), seed=seed,
                                      maxDepth=_depth(p.get("max_depth")), maxBins=p.get("max_bins", 64),
                                      minInstancesPerNode=p.get("min_samples_leaf", 1),
                                      featureSubsetStrategy=p.get("max_features", "sqrt") or "all")
    if spec.kind == "logistic":
        # 0.5 |w|^2 + C * sum(loss) is mean(loss) + |w|^2 / (2 C n)
        return LogisticRegression(**common, regParam=1.0 / (p.get("C", 1.0) * n_rows), elasticNetParam=0.0,
                                  standardization=False, maxIter=p.get("max_iter", 100), family="multinomial",
                                  weightCol="_w")
    if spec.kind == "perceptron":
        return MultilayerPerceptronClassifier(**common, layers=[n_features, *p.get("hidden", (64, 32)), n_classes],
                                              maxIter=p.get("max_iter", 100), seed=seed)
    raise ValueError(f"unknown model kind {spec.kind}")


def fit(spec: ModelSpec, train: DataFrame, features: Sequence[str], label: str, id_col: str) -> Fitted:
    """Fit one classifier on its features; class order is ascending."""
    features = [c for c in features if c in train.columns]
    if not features:
        raise ValueError("none of the model's features exists")
    scaler = fit_standard(train, features) if spec.scale else None
    sizes = {r[0]: r[1] for r in train.where(F.col(label).isNotNull()).groupBy(label).count().collect()}
    classes = sorted(sizes)
    n = sum(sizes.values())
    data = apply_scaler(train, scaler) if scaler else train
    index = F.array_position(F.array(*[F.lit(c) for c in classes]), F.col(label)) - 1
    data = data.where(F.col(label).isNotNull()).withColumn("_l", index.cast("double"))

    def ready(df):
        return apply_scaler(df, scaler) if scaler else df

    if spec.kind == "majority":
        top = max(classes, key=lambda c: (sizes[c], -classes.index(c)))
        probs = F.array(*[F.lit(1.0 if c == top else 0.0) for c in classes])
        profile = lambda df: df.select(id_col, probs.alias("probs"))
    elif spec.kind == "knn":
        refs = cut(data.select(id_col, "_l", *features))
        profile = lambda df: _knn_profile(spec, refs, ready(df), features, id_col, len(classes))
    elif spec.kind == "boosting":
        profile = _fit_boosting(spec, data, features, id_col, len(classes), ready)
    elif spec.kind == "adaboost":
        profile = _fit_adaboost(spec, data, features, id_col, len(classes), ready)
    else:
        weight = F.lit(1.0)
        if spec.params.get("class_weight") == "balanced":
            for i, c in enumerate(classes):
                weight = F.when(F.col("_l") == i, F.lit(n / (len(classes) * sizes[c]))).otherwise(weight)
        model = _mllib(spec, n, len(features), len(classes)).fit(
            _assembled(data.withColumn("_w", weight), features, ["_l", "_w"]))
        profile = lambda df: model.transform(_assembled(ready(df), features, [id_col])).select(
            id_col, vector_to_array("probability").alias("probs"))
    return Fitted(spec, features, classes, label, id_col, scaler, profile)


def _knn_profile(spec, refs, rows, features, id_col, n_classes):
    p = spec.params
    k = max(1, min(int(p.get("n_neighbors", 5)), refs.count()))
    near = neighbors.nearest(rows, refs, features, k, id_col, ["_l"], p.get("metric", "euclidean"), p.get("p", 2.0))
    shares = neighbors.class_shares(near, "_l", p.get("weights", "uniform"))
    return shares.groupBy(F.col("query_id").alias(id_col)).agg(F.array(*[
        F.coalesce(F.sum(F.when(F.col("_l") == i, F.col("proba"))), F.lit(0.0)) for i in range(n_classes)
    ]).alias("probs"))


def _fit_boosting(spec, data, features, id_col, n_classes, ready):
    """One binary gradient-boosted model per class, probabilities normalised over the classes."""
    p = spec.params
    vec = cut(_assembled(data, features, ["_l"]))
    fitted = [GBTClassifier(featuresCol="_x", labelCol="_b", maxIter=p.get("max_iter", 20),
                            maxDepth=_depth(p.get("max_depth", 5)), stepSize=p.get("learning_rate", 0.1),
                            maxBins=p.get("max_bins", 64), seed=p.get("seed", 42),
                            minInstancesPerNode=p.get("min_samples_leaf", 1))
              .fit(vec.withColumn("_b", (F.col("_l") == i).cast("double"))) for i in range(n_classes)]

    def profile(df):
        out = _assembled(ready(df), features, [id_col])
        for i, m in enumerate(fitted):
            out = m.transform(out).withColumn(f"_p{i}", vector_to_array("probability")[1]).drop(
                "rawPrediction", "probability", "prediction")
        total = sum((F.col(f"_p{i}") for i in range(n_classes)), F.lit(0.0))
        return out.select(id_col, F.array(*[
            F.coalesce(F.try_divide(F.col(f"_p{i}"), total), F.lit(1.0 / n_classes)) for i in range(n_classes)
        ]).alias("probs"))
    return profile


def _fit_adaboost(spec, data, features, id_col, n_classes, ready):
    """Multi-class AdaBoost: reweight misclassified rows by a column expression each round."""
    p = spec.params
    rounds, rate = p.get("n_estimators", 50), p.get("learning_rate", 1.0)
    work = cut(_assembled(data, features, ["_l"]).withColumn("_w", F.lit(1.0)))
    steps = []
    for i in range(rounds):
        tree = DecisionTreeClassifier(featuresCol="_x", labelCol="_l", weightCol="_w", impurity="gini",
                                      maxDepth=_depth(p.get("max_depth", 1)), maxBins=p.get("max_bins", 64),
                                      minInstancesPerNode=p.get("min_samples_leaf", 1), seed=p.get("seed", 42)).fit(work)
        wrong = tree.transform(work).withColumn("_e", (F.col("prediction") != F.col("_l")).cast("double"))
        row = wrong.agg(F.sum(F.col("_w") * F.col("_e")).alias("e"), F.sum("_w").alias("t")).first()
        err = row["e"] / row["t"]
        if err <= 0:
            steps.append((tree, 1.0))
            break
        if err >= 1.0 - 1.0 / n_classes:
            break
        alpha = rate * (math.log((1 - err) / err) + math.log(n_classes - 1)) if n_classes > 1 else 0.0
        steps.append((tree, alpha))
        if i + 1 < rounds:
            # Weights keep a mean of 1, so they neither vanish nor overflow.
            grown = row["t"] - row["e"] + row["e"] * math.exp(alpha)
            n = row["t"] / grown
            work = wrong.select("_l", "_x", (F.col("_w") * F.exp(F.col("_e") * F.lit(alpha)) * F.lit(n)).alias("_w"))
            work = cut(work) if i % 5 == 4 else work
    if not steps:
        raise ValueError("the first weak learner is no better than chance")

    def profile(df):
        out = _assembled(ready(df), features, [id_col])
        total = sum(a for _, a in steps)
        votes = [F.lit(0.0)] * n_classes
        for i, (tree, a) in enumerate(steps):
            out = tree.transform(out).withColumnRenamed("prediction", f"_t{i}").drop("rawPrediction", "probability")
            votes = [v + F.when(F.col(f"_t{i}") == c, F.lit(a)).otherwise(F.lit(-a / max(1, n_classes - 1)))
                     for c, v in enumerate(votes)]
        soft = [F.exp(v / F.lit(total * max(1, n_classes - 1))) for v in votes]
        out = out.select(id_col, F.array(*soft).alias("s"))
        norm = F.aggregate("s", F.lit(0.0), lambda x, y: x + y)
        return out.select(id_col, F.transform("s", lambda v: v / norm).alias("probs"))
    return profile


def predict(fitted: Fitted, df: DataFrame) -> DataFrame:
    """(id, prediction): class with the largest probability, the lower class on ties."""
    classes = F.array(*[F.lit(c) for c in fitted.classes])
    return fitted.profile(df).select(
        fitted.id_col, F.element_at(classes, first_argmax(F.col("probs")) + 1).alias("prediction"))
