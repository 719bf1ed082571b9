"""End-to-end comparisons: feature-selection methods and multi-expert ensembles."""
from __future__ import annotations

import logging
from typing import Callable, Sequence

from pyspark.sql import DataFrame, functions as F

from tabulon.operators import ensemble, evaluate, pca, ranking, selection, tuning
from tabulon.operators.ensemble import Expert
from tabulon.operators.models import ModelSpec
from tabulon.operators.sampling import balanced_sample, split, stratified_sample
from tabulon.session import cut

log = logging.getLogger("tabulon")

METHODS = ("pca", "lasso", "correlation", "relief", "information_gain", "forward", "backward", "bidirectional",
           "max_min", "best_first")


def select_by(method: str, train: DataFrame, features: Sequence[str], id_col: str, label: str, max_features: int = 15,
              max_rows: int | None = None, seed: int = 42, patience: int = 5, relief_draws: int = 5000) -> list[str]:
    """Features one method chooses on the training rows (PCA has its own path)."""
    features = list(features)
    n = min(max_features, len(features))
    data = train.select(id_col, label, *features)
    if method == "lasso":
        return selection.lasso(data, id_col, label, features, alpha=0.002)[1]["selected"][:n]
    if method == "correlation":
        return [r["feature"] for r in ranking.rank_correlations(data, label, [id_col])["supervised"].limit(n).collect()]
    if method == "relief":
        got = ranking.relief(data, id_col, label, n_iterations=relief_draws, seed=seed)["ranking"]
        return [r["feature"] for r in got.limit(n).collect()]
    if method == "information_gain":
        got = ranking.rank_information_gain(data, label, [id_col])["ranking"]
        return [r["feature"] for r in got.limit(n).collect()]
    if method == "max_min":
        return selection.max_min(data, label, features, n)[1]["selected"]
    if method == "best_first":
        capped = selection.cap_rows(data, id_col, label, max_rows, seed)
        scorer = selection.CrossValidatedScorer(capped, id_col, ModelSpec("tree"), label)
        return selection.best_first(scorer, features, patience).selected
    a, b = selection.holdout(data, id_col, label, max_rows, 0.2, seed)
    scorer = selection.KnnScorer(a, b, features, id_col, label, scale=method == "forward")
    if method == "forward":
        return selection.forward(scorer, features, n).selected
    if method == "backward":
        return selection.backward(scorer, features, min(n, len(features) - 1)).selected
    if method == "bidirectional":
        return selection.bidirectional(scorer, features, max_features=n).selected
    raise ValueError(f"unknown method {method}")


def compare_methods(df: DataFrame, id_col: str, label: str, methods: Sequence[str] = METHODS,
                    tune: dict[str, tuple[ModelSpec, dict]] | None = None, max_features: int = 15,
                    max_rows: int | None = None, test_share: float = 0.2, folds: int = 5, seed: int = 42,
                    **options) -> DataFrame:
    """Leaderboard of the methods: each chooses features, which are scored by tuned models.

    ``tune`` maps an algorithm name to its model and grid. A method that fails is logged and
    has a row with its ``error`` and without scores. ``max_rows`` caps the rows that the
    wrapper searches compare (None: all).
    """
    tune = tune or {"forest": (ModelSpec("forest"), tuning.GRIDS["forest"])}
    work, features = selection.prepare(df, id_col, label)
    train, valid = split(work, id_col, "_y", test_share, seed, materialize=True)
    rows = []
    for method in methods:
        try:
            if method == "pca":
                fitted = pca.fit_pca(train, [id_col, "_y"])
                k = pca.elbow(pca.variance_table(train, fitted))
                fitted = pca.Components(fitted.features, fitted.mean, fitted.variance[:k], fitted.loadings[:k])
                a, b = (cut(pca.apply_pca(x, fitted, [id_col, "_y"])) for x in (train, valid))
                chosen = [f"PC{i + 1}" for i in range(k)]
            else:
                a, b = train, valid
                chosen = select_by(method, train, features, id_col, "_y", max_features, max_rows, seed, **options)
            if not chosen:
                continue
            results = [tuning.grid_search(spec, grid, a, b, chosen, "_y", id_col, folds, seed)
                       for spec, grid in tune.values()]
            top = max(results, key=lambda r: r["f1_micro_val"])
            rows.append((method, top["algorithm"], len(chosen), ", ".join(chosen), top["f1_micro_cv"],
                         top["f1_micro_val"], top["f1_macro_val"], top["accuracy_val"], None))
        except Exception as e:
            log.exception("feature-selection method %s failed", method)
            rows.append((method, None, None, None, None, None, None, None, f"{type(e).__name__}: {e}"))
    table = df.sparkSession.createDataFrame(rows, (
        "model string, algorithm string, n_features int, features string, f1_micro_cv double, f1_micro double, "
        "f1_macro double, accuracy double, error string"))
    return evaluate.leaderboard(table)


def feature_sets(train: DataFrame, features: Sequence[str], id_col: str, label: str, top_k: int = 25,
                 stored: dict[str, list[str]] | None = None, relief_draws: int = 2000, max_rows: int | None = None,
                 patience: int = 3, sbs_min_features: int = 20, sbs_max_steps: int = 12,
                 seed: int = 42) -> tuple[dict[str, list[str]], dict[str, dict]]:
    """Named feature lists for the experts, and summaries of the two searches.

    Stored lists (Lasso, Max-Min) that match no column fall back to the first ``top_k``
    columns and to the first 12 of the Lasso list.
    """
    features = list(features)
    stored = stored or {}
    have = set(features)
    lasso = [c for c in stored.get("lasso", []) if c in have][:top_k] or features[:top_k]
    max_min = [c for c in stored.get("max_min", []) if c in have] or lasso[:12]
    data = train.select(id_col, label, *features)
    rel = ranking.relief(data, id_col, label, n_iterations=relief_draws, seed=seed, encode=False)["ranking"]
    gain = ranking.rank_information_gain(data, label, [id_col], few_valued_too=True)["ranking"]

    def names(t):
        return [r["feature"] for r in t.limit(top_k).collect()]
    capped = cut(selection.cap_rows(data, id_col, label, max_rows, seed))
    bf = selection.best_first(selection.CrossValidatedScorer(capped, id_col, ModelSpec("tree"), label, 3), features, patience)
    a, b = split(capped, id_col, label, 0.2, seed)
    sbs = None
    if sbs_min_features < len(features):
        sbs = selection.backward(selection.KnnScorer(a, b, features, id_col, label), features, sbs_min_features,
                                 max_steps=sbs_max_steps)
    sets = {"full": features, "lasso_top": lasso, "max_min": max_min, "relief_top": names(rel),
            "information_gain_top": names(gain), "best_first": bf.selected, "sbs": sbs.selected if sbs else features}
    return sets, {"best_first": bf.summary, "sbs": sbs.summary if sbs else {}}


def stock_experts(sets: dict[str, list[str]]) -> list[Expert]:
    """The twelve experts of the ensemble benchmark.

    Names and parameters are fixed values: stored parameters are looked up by these names.
    """
    knn = ModelSpec("knn", {"n_neighbors": 15, "weights": "distance"}, scale=True)
    tree = ModelSpec("tree", {"criterion": "entropy", "max_depth": 15, "min_samples_leaf": 8})
    ada = ModelSpec("adaboost", {"max_depth": 2, "min_samples_leaf": 8, "n_estimators": 120, "learning_rate": 0.5})
    forest = ModelSpec("forest", {"n_estimators": 250, "max_depth": None, "min_samples_leaf": 2})
    table = [
        ("knn_lasso_top25", knn, "lasso_top"), ("knn_relief_top25", knn, "relief_top"), ("decision_tree_max_min", tree, "max_min"),
        ("decision_tree_best_first", tree, "best_first"), ("adaboost_lasso_top25", ada, "lasso_top"),
        ("adaboost_best_first", ada, "best_first"), ("knn_sbs", knn, "sbs"), ("random_forest_full", forest, "full"),
        ("random_forest_information_gain_top25", forest, "information_gain_top"),
        ("hist_gradient_boosting_lasso_top25", ModelSpec("boosting", {"learning_rate": 0.08, "max_iter": 180}), "lasso_top"),
        ("hist_gradient_boosting_full", ModelSpec("boosting", {"learning_rate": 0.06, "max_iter": 180}), "full"),
        ("logistic_lasso_top25", ModelSpec("logistic", {"C": 1.0}, scale=True), "lasso_top"),
    ]
    return [Expert(n, s, tuple(sets[f])) for n, s, f in table]


def compare_ensembles(df: DataFrame, id_col: str, label: str, make_experts: Callable[[dict], list[Expert]] = stock_experts,
                      max_per_class: int | None = None, n_samples: int | None = None, test_share: float = 0.2,
                      top_k: int = 4, stacking: bool = True, tuned: dict[str, dict] | None = None, seed: int = 42,
                      sets: dict[str, list[str]] | None = None, **set_options) -> dict[str, DataFrame]:
    """Single experts, five rules, stacking, top-k and diverse-k ensembles: leaderboard and reports.

    Experts are fitted once; every rule then works on the stored decision profile.
    """
    if n_samples is not None:
        df = stratified_sample(df, id_col, label, n_samples, seed)
    elif max_per_class is not None:
        df = balanced_sample(df, id_col, label, max_per_class, seed)
    work, features = selection.prepare(df, id_col, label)
    train, valid = split(work, id_col, "_y", test_share, seed, materialize=True)
    summaries: dict = {}
    if sets is None:
        sets, summaries = feature_sets(train, features, id_col, "_y", seed=seed, **set_options)
    experts = ensemble.with_tuned_params(make_experts(sets), tuned or {})
    profile = cut(ensemble.decision_profile(ensemble.fit_experts(experts, train, "_y", id_col), valid))
    truth = cut(valid.select(F.col(id_col).alias("id"), F.col("_y").alias("label")))

    single = cut(ensemble.score_experts(profile, truth))
    weights = {r["model"]: r["weight"] for r in single.collect()}
    results = single.drop("weight").unionByName(ensemble.score_rules(profile, truth, weights))
    names = [e.name for e in experts]
    pairs = cut(ensemble.diversity(ensemble.expert_predictions(profile), truth, names))
    chosen = ensemble.diverse_experts(single, pairs, top_k)
    if stacking:
        done = ensemble.stacking(experts, train, valid, features, "_y", id_col, seed).join(truth, "id")
        results = results.unionByName(
            evaluate.scores(done, "label", "prediction", ["model"]).select("model", "f1_micro", "f1_macro", "accuracy"))
    if 0 < top_k < len(experts):
        for prefix, keep in ((f"mes_top{top_k}", [r["model"] for r in ensemble.top_experts(single, top_k).collect()]),
                             (f"mes_diverse{top_k}", [r["expert"] for r in chosen.collect()])):
            part = profile.where(F.col("expert").isin(keep))
            results = results.unionByName(ensemble.score_rules(
                part, truth, {e: weights[e] for e in keep}, prefix))
    return {"leaderboard": evaluate.leaderboard(results), "diversity": pairs, "diverse_choice": chosen,
            "profile": profile, "truth": truth, "sets": sets, "summaries": summaries}


__all__ = ["METHODS", "select_by", "compare_methods", "feature_sets", "stock_experts", "compare_ensembles"]
