"""Grid search over stratified folds, scored by f1_micro."""
from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from itertools import product
from typing import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from tabulon.operators import evaluate, models, neighbors
from tabulon.operators.encode import apply_scaler, fit_standard
from tabulon.operators.sampling import stratified_folds
from tabulon.session import cut

# Parameter grids of the three stock algorithms.
GRIDS = {
    "knn": {"n_neighbors": [3, 5, 7, 9, 15, 21, 31], "weights": ["uniform", "distance"],
            "metric": ["euclidean", "manhattan", "minkowski"]},
    "forest": {"n_estimators": [100, 200, 500], "max_depth": [None, 10, 20, 30],
               "min_samples_leaf": [1, 2, 4], "max_features": ["sqrt", "log2"]},
    "tree": {"criterion": ["gini", "entropy"], "max_depth": [None, 5, 10, 15, 20, 30],
             "min_samples_leaf": [1, 2, 4, 8]},
}
# Grids of the targeted expert tuning.
EXPERT_GRIDS = {
    "logistic": {"C": [0.1, 0.3, 1.0, 3.0, 10.0], "class_weight": [None, "balanced"]},
    "forest": {"n_estimators": [200, 400], "max_depth": [None, 16, 24], "min_samples_leaf": [1, 2, 4],
               "max_features": ["sqrt", "log2"]},
    "boosting": {"learning_rate": [0.04, 0.06, 0.08], "max_iter": [160, 220], "max_depth": [4, 5]},
    "adaboost": {"n_estimators": [80, 120, 180], "learning_rate": [0.3, 0.5, 0.8], "max_depth": [1, 2, 3],
                 "min_samples_leaf": [4, 8, 16]},
}


def combinations(grid: dict[str, list]) -> list[dict]:
    names = list(grid)
    return [dict(zip(names, values)) for values in product(*[grid[n] for n in names])]


def _fold_score(spec, folded, features, label, id_col, fold) -> float:
    fitted = models.fit(spec, folded.where(F.col("_fold") != fold), features, label, id_col)
    held = folded.where(F.col("_fold") == fold)
    done = models.predict(fitted, held).join(held.select(id_col, label), id_col)
    return done.agg(F.avg((F.col("prediction") == F.col(label)).cast("double"))).first()[0] or 0.0


def _knn_scores(combos, spec, folded, features, label, id_col, folds) -> list[float]:
    """One neighbour search per (fold, metric) at the largest k serves every k and weighting."""
    total = [0.0] * len(combos)
    largest = max(c.get("n_neighbors", 5) for c in combos)
    for metric in sorted({c.get("metric", "euclidean") for c in combos}):
        for fold in range(folds):
            train, held = folded.where(F.col("_fold") != fold), folded.where(F.col("_fold") == fold)
            if spec.scale:
                s = fit_standard(train, features)
                train, held = apply_scaler(train, s), apply_scaler(held, s)
            near = (neighbors.nearest(held, train, features, largest, id_col, [label], metric)
                    .join(held.select(F.col(id_col).alias("query_id"), F.col(label).alias("_truth")), "query_id"))
            mine = [(i, c) for i, c in enumerate(combos) if c.get("metric", "euclidean") == metric]
            query = Window.partitionBy("query_id")
            # The nearest of a query decides for every k whether only exact matches count.
            exact = F.max((F.col("distance") == 0).cast("int")).over(query)
            weigh = {"uniform": F.lit(1.0), "distance": F.when(F.col("_exact") == 1, (F.col("distance") == 0).cast("double")).otherwise(
                F.try_divide(F.lit(1.0), F.col("distance")))}
            votes = near.withColumn("_exact", exact).groupBy("query_id", "_truth", label).agg(*[
                F.sum(F.when(F.col("rank") <= c.get("n_neighbors", 5), weigh["uniform" if c.get("weights", "uniform") == "uniform" else "distance"]))
                .alias(f"_w{i}") for i, c in mine])
            shares = votes.select("query_id", "_truth", label, *[
                F.round(F.col(f"_w{i}") / F.sum(f"_w{i}").over(query), 12).alias(f"_w{i}") for i, _ in mine])
            # The largest share, the smaller class on ties; a class without a vote has none.
            best = shares.groupBy("query_id").agg(*[
                F.min(F.when(F.col(f"_w{i}").isNotNull(), F.struct((-F.col(f"_w{i}")).alias("s"), F.col(label).alias("c"), F.col("_truth").alias("t"))))
                .alias(f"_b{i}") for i, _ in mine])
            hit = best.select(F.explode(F.array(*[
                F.struct(F.lit(i).alias("combo"), F.col(f"_b{i}.c").alias("c"), F.col(f"_b{i}.t").alias("t")) for i, _ in mine])).alias("b")).groupBy(
                "b.combo").agg(F.avg((F.col("b.c") == F.col("b.t")).cast("double")).alias("s"))
            for r in hit.collect():
                total[r["combo"]] += r["s"] / folds
    return total


def grid_search(spec: models.ModelSpec, grid: dict[str, list], train: DataFrame, valid: DataFrame,
                features: Sequence[str], label: str, id_col: str, folds: int = 5, seed: int = 42,
                parallel: int = 4) -> dict:
    """Best combination by mean fold f1_micro (first maximum), refitted and scored on the validation rows."""
    folded = cut(stratified_folds(train, id_col, label, folds, True, seed, "_fold"))
    combos = combinations(grid)
    if spec.kind == "knn":
        got = _knn_scores(combos, spec, folded, features, label, id_col, folds)
    else:
        jobs = [(c, f) for c in combos for f in range(folds)]
        with ThreadPoolExecutor(parallel) as pool:
            flat = list(pool.map(lambda j: _fold_score(
                spec.with_params(**j[0]), folded, features, label, id_col, j[1]), jobs))
        got = [sum(flat[i * folds:(i + 1) * folds]) / folds for i in range(len(combos))]
    top = max(range(len(combos)), key=lambda i: (got[i], -i))
    fitted = models.fit(spec.with_params(**combos[top]), train, features, label, id_col)
    done = models.predict(fitted, valid).join(valid.select(id_col, label), id_col)
    s = evaluate.scores(done, label, "prediction").first()
    return {"algorithm": spec.kind, "f1_micro_cv": round(got[top], 4), "f1_micro_val": round(s["f1_micro"], 4),
            "f1_macro_val": round(s["f1_macro"], 4), "accuracy_val": round(s["accuracy"], 4),
            "best_params": combos[top], "all": list(zip(combos, got)), "fitted": fitted, "n_features": len(features)}


def results_frame(spark, results: list[dict], name: str = "algorithm") -> DataFrame:
    """Tuning leaderboard, best validation f1_micro first."""
    rows = [(r[name], r["f1_micro_cv"], r["f1_micro_val"], r["f1_macro_val"], r["accuracy_val"], r["n_features"],
             str(sorted(r["best_params"].items()))) for r in results]
    return spark.createDataFrame(rows, (
        "model string, f1_micro_cv double, f1_micro double, f1_macro double, accuracy double, n_features int, "
        "best_params string")).orderBy(F.col("f1_micro").desc(), F.col("f1_macro").desc(), "model")
