"""Models, tuning and ensembles; results come from iterative fits, so they have no SQL twin."""
from __future__ import annotations

from pyspark.sql import functions as F

from tabulon.catalog.base import out, query, table
from tabulon.operators import ensemble, evaluate, models, tuning
from tabulon.operators.ensemble import Expert
from tabulon.operators.models import ModelSpec
from tabulon.operators.sampling import split
from tabulon.plans import benchmarks, preprocess
from tabulon.spec import DatasetSpec

_DIMS = 64
_FEATURES = [f"e{i}" for i in range(_DIMS)]


def _vectors(spark, d):
    """Vectors with three groups of labels as classes."""
    return table(spark, d, "embeddings").select(
        "vec_id", (F.col("label") % 3).alias("cls"),
        *[F.col("embedding")[i].cast("double").alias(f"e{i}") for i in range(_DIMS)])


def _halves(spark, d):
    return split(_vectors(spark, d), "vec_id", "cls", 0.2, materialize=True)


def _scored(spark, d, spec):
    train, test = _halves(spark, d)
    fitted = models.fit(spec, train, _FEATURES, "cls", "vec_id")
    done = models.predict(fitted, test).join(test.select("vec_id", "cls"), "vec_id")
    return out(evaluate.class_report(done, "cls", "prediction"))


@query("decision_tree")
def decision_tree(spark, d):
    return _scored(spark, d, ModelSpec("tree", {"criterion": "entropy", "max_depth": 6, "min_samples_leaf": 8}))


@query("random_forest")
def random_forest(spark, d):
    return _scored(spark, d, ModelSpec("forest", {"n_estimators": 20, "max_depth": 6}))


@query("logistic_regression")
def logistic_regression(spark, d):
    return _scored(spark, d, ModelSpec("logistic", {"C": 1.0, "class_weight": "balanced"}, scale=True))


@query("gradient_boosting")
def gradient_boosting(spark, d):
    return _scored(spark, d, ModelSpec("boosting", {"max_iter": 5, "max_depth": 3}))


@query("adaboost")
def adaboost(spark, d):
    return _scored(spark, d, ModelSpec("adaboost", {"n_estimators": 6, "max_depth": 2, "learning_rate": 0.5}))


@query("perceptron")
def perceptron(spark, d):
    return _scored(spark, d, ModelSpec("perceptron", {"hidden": (8,), "max_iter": 30}, scale=True))


def _experts():
    return [Expert("tree", ModelSpec("tree", {"max_depth": 5}), tuple(_FEATURES)),
            Expert("logistic", ModelSpec("logistic", scale=True), tuple(_FEATURES[:4])),
            Expert("knn", ModelSpec("knn", {"n_neighbors": 15, "weights": "distance"}, scale=True), tuple(_FEATURES[2:]))]


@query("fitted_decision_profile")
def fitted_decision_profile(spark, d):
    train, test = _halves(spark, d)
    return out(ensemble.decision_profile(ensemble.fit_experts(_experts(), train, "cls", "vec_id"), test))


@query("stacking")
def stacking(spark, d):
    train, test = _halves(spark, d)
    done = ensemble.stacking(_experts(), train, test, _FEATURES, "cls", "vec_id").join(
        test.select(F.col("vec_id").alias("id"), F.col("cls").alias("label")), "id")
    return out(evaluate.scores(done, "label", "prediction", ["model"]))


@query("grid_search")
def grid_search(spark, d):
    train, test = _halves(spark, d)
    results = [
        tuning.grid_search(ModelSpec("knn", scale=True), {"n_neighbors": [3, 15, 31], "weights": ["uniform", "distance"],
                                                          "metric": ["euclidean", "manhattan"]},
                           train, test, _FEATURES, "cls", "vec_id", folds=3),
        tuning.grid_search(ModelSpec("tree"), {"criterion": ["gini", "entropy"], "max_depth": [3]},
                           train, test, _FEATURES, "cls", "vec_id", folds=3)]
    return out(tuning.results_frame(spark, results))


@query("expert_tuning")
def expert_tuning(spark, d):
    train, test = _halves(spark, d)
    got = tuning.grid_search(ModelSpec("logistic", scale=True), {"C": [0.1, 1.0], "class_weight": [None, "balanced"]},
                             train, test, _FEATURES, "cls", "vec_id", folds=3)
    done = models.predict(got["fitted"], test).join(test.select("vec_id", "cls"), "vec_id")
    return out(evaluate.class_report(done, "cls", "prediction").withColumn("C", F.lit(got["best_params"]["C"])))


@query("selection_method_comparison")
def selection_method_comparison(spark, d):
    return out(benchmarks.compare_methods(
        _vectors(spark, d), "vec_id", "cls", ("pca", "lasso", "correlation", "max_min"),
        {"knn": (ModelSpec("knn", scale=True), {"n_neighbors": [5, 21]})}, max_features=3, folds=2))


@query("ensemble_comparison")
def ensemble_comparison(spark, d):
    got = benchmarks.compare_ensembles(_vectors(spark, d), "vec_id", "cls", lambda sets: _experts(), max_per_class=None,
                                       top_k=2, sets={"full": _FEATURES})
    return out(got["leaderboard"])


@query("preprocessing_run")
def preprocessing_run(spark, d):
    """All preprocessing steps on parts, labelled by brand number."""
    p = table(spark, d, "part").select("p_partkey", "p_size", "p_type", F.col("p_retailprice").alias("price"))
    p = p.withColumn("price", F.when(F.col("p_partkey") % 97 == 0, F.col("price") * 50).otherwise(F.col("price")))
    labels = table(spark, d, "part").select("p_partkey", F.substring("p_brand", 7, 2).cast("int").alias("brand_no"))
    spec = DatasetSpec("p_partkey", "brand_no", ("p_size", "price"), ("p_type",))
    done = preprocess.preprocess(p, labels, p.where("p_type <> 'PROMO'"), spec, strategy="median")
    return out(done.labelled)
