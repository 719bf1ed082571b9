"""Feature-subset selection: searches over feature names on the driver, scoring on Spark."""
from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from typing import Callable, Iterable, Protocol, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tabulon.operators import models, subsetvote
from tabulon.operators.clean import candidate_features, feature_kinds, require_no_nulls
from tabulon.operators.encode import apply_scaler, dummies, encode_label, fit_standard
from tabulon.operators.moments import centred, cross_products, means
from tabulon.operators.order import by_value_rank
from tabulon.operators.ranking import correlations
from tabulon.operators.sampling import cap_rows, fold_of, split, stratified_folds
from tabulon.session import cut


# ---- preparation ----------------------------------------------------------------------------------

def prepare(df: DataFrame, id_col: str, label: str, exclude: Iterable[str] = ()) -> tuple[DataFrame, list[str]]:
    """(id, _y, encoded features): text columns one-hot, label as integer, no NULL allowed."""
    cand = [c for c in candidate_features(df, label, exclude) if c != id_col]
    work = encode_label(df.select(id_col, label, *cand), label, "_y").drop(label)
    work = dummies(work, feature_kinds(work.select(cand))["categorical"])
    features = [c for c in work.columns if c not in (id_col, "_y")]
    require_no_nulls(work, features)
    return work.select(id_col, "_y", *features), features


def holdout(df: DataFrame, id_col: str, label: str, max_rows: int | None, test_share: float,
            seed: int) -> tuple[DataFrame, DataFrame]:
    """Optional stratified row cap, then a stratified split."""
    if max_rows is not None and max_rows <= 200:
        raise ValueError("max_rows must be above 200 or None")
    return split(cap_rows(df, id_col, label, max_rows, seed), id_col, label, test_share, seed, materialize=True)


# ---- scorers --------------------------------------------------------------------------------------

class Scorer(Protocol):
    """Scores many feature subsets at once; higher is better."""

    def __call__(self, subsets: Sequence[Sequence[str]]) -> list[float]: ...


class KnnScorer:
    """Holdout accuracy (equal to f1_micro) of a k-nearest-neighbour vote.

    All subsets of a search step are scored in one job. The validation rows are dealt to blocks; a task has one block and
    meets the train rows in id order, a stretch at a time, keeping k rows per subset and query. The layout is stored once.
    """

    valid_block = 8192

    def __init__(self, train: DataFrame, valid: DataFrame, features: Sequence[str], id_col: str,
                 label: str = "_y", k: int = 5, weights: str = "distance", scale: bool = False):
        self.features, self.weights = list(features), weights
        if scale:
            fitted = fit_standard(train, features)
            train, valid = apply_scaler(train, fitted), apply_scaler(valid, fitted)
        x = F.array(*[F.col(c).cast("double") for c in self.features]).alias("x")
        train, valid = (cut(df.select(F.col(id_col).alias("id"), x, F.col(label).cast("int").alias("y"))) for df in (train, valid))
        n_train, self.n_valid = train.count(), valid.count()
        self.k = max(1, min(k, n_train))
        self.evaluated = 0
        # A small validation set still gets a block per core, but none under 32 rows; more blocks than cores keep all cores busy to the end.
        cores = valid.sparkSession.sparkContext.defaultParallelism
        n = max(1, -(-self.n_valid // self.valid_block), min(cores, -(-self.n_valid // 32)))
        n = n if n <= cores else -(-n // cores) * cores
        # Rows with equal ids share one block; a null id has no vote.
        asks = valid.where("id IS NOT NULL").select(F.pmod(F.xxhash64("id"), F.lit(n)).cast("int").alias("block"), F.lit(0).alias("side"), "*")
        refs = train.select(F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("block"), F.lit(1).alias("side"), "*")
        self.rows = cut(asks.unionByName(refs).repartitionById(n, F.col("block")).sortWithinPartitions("block", "side", "id"))

    def __call__(self, subsets: Sequence[Sequence[str]]) -> list[float]:
        at = {c: i for i, c in enumerate(self.features)}
        sets = [[at[c] for c in s] for s in subsets]
        self.evaluated += len(sets)
        k, weights = self.k, self.weights

        def count(batches):
            for hits in subsetvote.hits_of_blocks(batches, sets, k, weights):
                yield pa.RecordBatch.from_pydict({"subset": pa.array(range(len(sets)), pa.int32()), "hits": pa.array(hits, pa.int64())})
        hits = {r[0]: r[1] for r in self.rows.mapInArrow(count, "subset int, hits long").groupBy("subset").agg(F.sum("hits")).collect()}
        return [hits.get(i, 0) / self.n_valid for i in range(len(sets))]


class ModelScorer:
    """Holdout accuracy (equal to f1_micro) of any model of ``models``; subsets are fitted in parallel jobs."""

    def __init__(self, train: DataFrame, valid: DataFrame, id_col: str, spec: models.ModelSpec,
                 label: str = "_y", parallel: int = 4):
        self.train, self.valid, self.id_col = cut(train), cut(valid), id_col
        self.spec, self.label, self.parallel = spec, label, parallel
        self.evaluated = 0

    def _one(self, subset) -> float:
        fitted = models.fit(self.spec, self.train, list(subset), self.label, self.id_col)
        done = models.predict(fitted, self.valid).join(self.valid.select(self.id_col, self.label), self.id_col)
        return done.agg(F.avg((F.col("prediction") == F.col(self.label)).cast("double"))).first()[0] or 0.0

    def __call__(self, subsets):
        self.evaluated += len(subsets)
        with ThreadPoolExecutor(self.parallel) as pool:
            return list(pool.map(self._one, subsets))


class CrossValidatedScorer(ModelScorer):
    """Mean accuracy over stratified folds."""

    def __init__(self, data: DataFrame, id_col: str, spec: models.ModelSpec, label: str = "_y", folds: int = 5,
                 parallel: int = 4):
        folded = stratified_folds(data, id_col, label, folds, shuffle=False, name="_fold")
        super().__init__(folded, data.limit(0), id_col, spec, label, parallel)
        self.folds = folds

    def _one(self, subset):
        if not subset:
            return 0.0
        parts = []
        for f in range(self.folds):
            fitted = models.fit(self.spec, self.train.where(F.col("_fold") != f), list(subset), self.label, self.id_col)
            out = self.train.where(F.col("_fold") == f)
            done = models.predict(fitted, out).join(out.select(self.id_col, self.label), self.id_col)
            parts.append(done.agg(F.avg((F.col("prediction") == F.col(self.label)).cast("double"))).first()[0] or 0.0)
        return sum(parts) / len(parts)


# ---- searches -------------------------------------------------------------------------------------

@dataclass
class Search:
    selected: list[str]
    history: list[dict]
    summary: dict = field(default_factory=dict)

    def history_frame(self, spark) -> DataFrame:
        schema = ("step int, cycle int, phase string, n_features_before int, n_features_after int, feature string, "
                  "score_before double, score_after double, delta_score double")
        names = [c.strip().split(" ")[0] for c in schema.split(",")]
        return spark.createDataFrame([tuple(h.get(c) for c in names) for h in self.history], schema)


def _best(scores: list[float]) -> int:
    """Position of the first maximum."""
    return int(np.argmax(scores))


def _ordered(features, chosen):
    keep = set(chosen)
    return [c for c in features if c in keep]


@dataclass(frozen=True)
class Move:
    """One way to change the current set, and when its best neighbour is refused.

    ``refusals`` are (reason, test of (new score, old score)); the first that holds counts. The first set of a
    search has no old score and is taken as it is. ``possible`` tests the number of features.
    """
    grows: bool
    refusals: tuple[tuple[str, Callable[[float, float], bool]], ...]
    possible: Callable[[int], bool] = lambda size: True


class _Walk:
    """The current set of a search and the steps that led to it."""

    def __init__(self, scorer: Scorer, features: Sequence[str], chosen: Sequence[str] = (), score: float | None = None):
        self.scorer, self.features = scorer, list(features)
        self.chosen, self.score = list(chosen), score
        self.history, self.evaluated, self.rounds = [], 0, 0

    def toggled(self, feature: str) -> list[str]:
        return [c for c in self.features if (c in self.chosen) != (c == feature)]

    def go(self, move: Move, **extra) -> str | None:
        """Go to the best neighbour; the reason if it is refused."""
        names = [c for c in self.features if (c in self.chosen) != move.grows]
        sets = [self.toggled(c) for c in names]
        got = self.scorer(sets)
        self.evaluated += len(sets)
        i = _best(got)
        if self.score is not None:
            for reason, holds in move.refusals:
                if holds(got[i], self.score):
                    return reason
        self.history.append({
            "step": len(self.history) + 1, "n_features_before": len(self.chosen), "n_features_after": len(sets[i]),
            "feature": names[i], "score_before": self.score, "score_after": got[i],
            "delta_score": None if self.score is None else got[i] - self.score, **extra})
        self.chosen, self.score = sets[i], got[i]
        return None

    def run(self, moves: Sequence[Move], goal: Callable[[int], bool], goal_reason: str, limit: int | None, limit_reason: str,
            phases: bool = False) -> str:
        """Rounds of the moves until the goal or the limit is reached or a round changes nothing; why it stopped."""
        if limit is not None and limit <= 0:
            raise ValueError("the number of rounds must be positive or None")
        while not goal(len(self.chosen)):
            if limit is not None and self.rounds >= limit:
                return limit_reason
            self.rounds += 1
            tag = {"cycle": self.rounds} if phases else {}
            refused = [self.go(m, **tag, **({"phase": "forward" if m.grows else "backward"} if phases else {}))
                       for m in moves if m.possible(len(self.chosen))]
            if None not in refused:
                return refused[-1]
        return goal_reason


def forward(scorer: Scorer, features: Sequence[str], max_features: int = 15, min_improvement: float = 0.0,
            max_steps: int | None = None) -> Search:
    """Add the best feature while the score strictly rises."""
    if not 0 < max_features <= len(features):
        raise ValueError("max_features out of range")
    walk = _Walk(scorer, features)
    grow = Move(True, (("score_not_rising", lambda new, old: new <= old),
                       ("improvement_too_small", lambda new, old: new < old + min_improvement)))
    stop = walk.run([grow], lambda n: n >= max_features, "max_features_reached", max_steps, "max_steps_reached")
    p = len(features)
    return Search(walk.chosen, walk.history, {"best_score": walk.score, "evaluated_models": walk.evaluated, "stop_reason": stop,
                                              "theoretical_models": max_features * (2 * p - max_features + 1) // 2})


def backward(scorer: Scorer, features: Sequence[str], min_features: int = 10, min_improvement: float = 0.0,
             max_steps: int | None = None) -> Search:
    """Remove the feature whose removal scores best; equal scores are accepted."""
    if not 0 < min_features < len(features):
        raise ValueError("min_features out of range")
    baseline = scorer([list(features)])[0]
    walk = _Walk(scorer, features, features, baseline)
    shrink = Move(False, (("score_falling", lambda new, old: new < old),
                          ("improvement_too_small", lambda new, old: new < old + min_improvement)))
    stop = walk.run([shrink], lambda n: n <= min_features, "min_features_reached", max_steps, "max_steps_reached")
    p, m = len(features), min_features
    return Search(walk.chosen, walk.history, {
        "baseline_score": baseline, "best_score": walk.score, "delta_vs_baseline": walk.score - baseline,
        "evaluated_models": 1 + walk.evaluated, "stop_reason": stop,
        "theoretical_models": 1 + (p + m + 1) * (p - m) // 2, "removed": [h["feature"] for h in walk.history]})


def bidirectional(scorer: Scorer, features: Sequence[str], min_features: int = 1, max_features: int | None = None,
                  min_improvement: float = 0.0, max_cycles: int | None = None) -> Search:
    """One forward and one backward step per cycle, both only on a strict gain; the first forward always counts."""
    most = len(features) if max_features is None else max_features
    if not 0 < min_features <= most <= len(features):
        raise ValueError("min_features <= max_features <= number of features is required")
    no_gain = (("no_improvement", lambda new, old: new <= old + min_improvement),)
    walk = _Walk(scorer, features)
    stop = walk.run([Move(True, no_gain, lambda n: n < most), Move(False, no_gain, lambda n: n > min_features)],
                    lambda n: n >= most, "max_features_reached", max_cycles, "max_cycles_reached", phases=True)
    if walk.history:  # the first set is compared with itself
        walk.history[0] |= {"score_before": walk.history[0]["score_after"], "delta_score": 0.0}
    return Search(walk.chosen, walk.history, {"best_score": walk.score, "evaluated_models": walk.evaluated, "cycles": walk.rounds,
                                              "steps": len(walk.history), "stop_reason": stop})


def best_first(scorer: Scorer, features: Sequence[str], patience: int = 5) -> Search:
    """Best-first search: expand the best open subset by one feature, stop after ``patience`` idle expansions.

    Subsets are ranked by score, equal ones by the places of their features; each is scored once.
    """
    known: dict[tuple[int, ...], float] = {}
    waiting: set[tuple[int, ...]] = set()

    def rank(subset):
        return -known[subset], subset

    def name(subset):
        return ", ".join(features[j] for j in subset)

    def grown(subset):
        """The best of the new subsets with one feature more, all of which wait from now on."""
        new = {tuple(sorted({*subset, j})) for j in range(len(features))} - known.keys() - {subset}
        new = sorted(new)
        known.update(zip(new, scorer([[features[j] for j in s] for s in new]) if new else []))
        waiting.update(new)
        return min(new, key=rank, default=None)

    top, idle, history = grown(()), 0, []
    while waiting and idle < patience:
        current = min(waiting, key=rank)
        waiting.remove(current)
        child = grown(current)
        better = child is not None and known[child] > known[top]
        top, idle = (child, 0) if better else (top, idle + 1)
        history.append({"step": len(history) + 1, "expanded_subset": name(current), "best_child_generated": name(child or ()),
                        "score_of_expanded": known[current], "score_of_best_child": known.get(child),
                        "global_best_score": known[top], "stagnation_count": idle})
    return Search([features[j] for j in top], history, {
        "best_score": known[top], "evaluated_models": len(known), "stop_reason": "patience_reached" if waiting else "queue_empty",
        "patience": patience})


# ---- Max-Min --------------------------------------------------------------------------------------

def max_min(df: DataFrame, label: str, features: Sequence[str], max_features: int | None = None,
            stop_at_negative: bool = True) -> tuple[DataFrame, dict]:
    """Greedy choice by |corr(f, label)| minus the largest |corr(f, chosen)|.

    One pass gives all correlations; the greedy loop runs on that p*p table.
    """
    features = list(features)
    if max_features is not None and not 0 < max_features <= len(features):
        raise ValueError("max_features out of range")
    rows = correlations(df.select(*features, F.col(label).cast("double").alias("_y")), [*features, "_y"]).collect()
    corr = {}
    for r in rows:
        v = abs(r["corr"]) if r["corr"] is not None else 0.0
        corr[r["feature_1"], r["feature_2"]] = corr[r["feature_2"], r["feature_1"]] = v
    chosen, steps, stop = [], [], "all_features_selected"
    while len(chosen) < len(features):
        if max_features is not None and len(chosen) >= max_features:
            stop = "max_features_reached"
            break
        cands = []
        for f in features:
            if f not in chosen:
                rel, red = corr[f, "_y"], max((corr[f, s] for s in chosen), default=0.0)
                cands.append((-(rel - red), -rel, red, f))
        neg, rel, red, f = min(cands)
        if stop_at_negative and -neg < 0:
            stop = "score_negative"
            break
        chosen.append(f)
        steps.append((len(chosen), f, -rel, red, -neg))
    table = df.sparkSession.createDataFrame(
        steps, "step int, selected_feature string, relevance double, redundancy double, score double")
    return table, {"selected": chosen, "stop_reason": stop, "n_features_initial": len(features)}


# ---- Lasso ----------------------------------------------------------------------------------------

def _descend(c: np.ndarray, alpha: float, start: np.ndarray, max_iter: int, tol: float = 1e-10) -> np.ndarray:
    """Coordinate descent of 1/2 w'Gw - w'b + alpha |w| on a p*p moment matrix."""
    g, b, w = c[:-1, :-1], c[:-1, -1], start.copy()
    for _ in range(max_iter):
        move = 0.0
        for j in range(len(w)):
            if g[j, j] <= 0:
                continue
            r = b[j] - g[j] @ w + g[j, j] * w[j]
            new = np.sign(r) * max(abs(r) - alpha, 0.0) / g[j, j]
            move = max(move, abs(new - w[j]))
            w[j] = new
        if move < tol:
            break
    return w


def choose_alpha(df: DataFrame, features: Sequence[str], label: str, fold: str, n_alphas: int = 100,
                 eps: float = 1e-3, max_iter: int = 1000) -> tuple[float, list[tuple[float, float]]]:
    """Alpha with the smallest mean squared error over the folds, and the whole path.

    Fold moments add up, so one pass over the data serves every fold and every alpha.
    """
    columns = [*features, label]
    shift = means(df, columns)  # keeps the sums small; every fold is centred again below
    parts = cross_products(df, columns, shift, fold)
    whole = sum(parts.values())
    _, _, c = centred(whole)
    top = float(np.abs(c[:-1, -1]).max()) or 1e-12
    alphas = np.geomspace(top, top * eps, n_alphas)
    errors = np.zeros(n_alphas)
    for held in parts.values():
        _, mean, c = centred(whole - held)
        w = np.zeros(len(features))
        for a, alpha in enumerate(alphas):
            w = _descend(c, alpha, w, max_iter, 1e-7)
            v = np.concatenate([[-(mean[-1] - w @ mean[:-1])], -w, [1.0]])
            errors[a] += (v @ held @ v) / held[0, 0] / len(parts)
    return float(alphas[int(errors.argmin())]), list(zip(alphas.tolist(), errors.tolist()))


def lasso(df: DataFrame, id_col: str, label: str, features: Sequence[str], alpha: float | None = None,
          cv_folds: int = 5, max_iter: int = 1000, tolerance: float = 1e-8) -> tuple[DataFrame, dict]:
    """Coefficients of an L1 regression on standardised features, ranked; (table, summary).

    ``alpha=None`` chooses it over contiguous folds in id order. The final fit is MLlib's normal
    solver: one pass over the data, then iterations on the moments.
    """
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression
    features = list(features)
    if alpha is not None and alpha <= 0:
        raise ValueError("alpha must be positive")
    if cv_folds < 2:
        raise ValueError("cv_folds must be at least 2")
    data = cut(df.select(id_col, F.col(label).cast("double").alias("_t"), *features))
    std = apply_scaler(data, fit_standard(data, features))
    path = []
    if alpha is None:
        folded = by_value_rank(std, id_col, [], lambda rn, n: fold_of(rn, n, cv_folds), "_fold")
        chosen, path = choose_alpha(folded, features, "_t", "_fold", max_iter=max_iter)
    else:
        chosen = float(alpha)
    vec = VectorAssembler(inputCols=features, outputCol="_x").transform(std).select("_x", "_t")
    model = LinearRegression(featuresCol="_x", labelCol="_t", elasticNetParam=1.0, regParam=chosen,
                             standardization=False, maxIter=max_iter, tol=1e-10,
                             solver="normal").fit(vec)
    coef = sorted(((c, float(w)) for c, w in zip(features, model.coefficients)), key=lambda t: (-abs(t[1]), t[0]))
    rows = [(i + 1, c, w, abs(w), abs(w) > tolerance) for i, (c, w) in enumerate(coef)]
    table = df.sparkSession.createDataFrame(
        rows, "rank int, feature string, coefficient double, abs_coefficient double, is_selected boolean")
    kept = [r[1] for r in rows if r[4]]
    return table, {"selected": kept, "alpha": chosen, "intercept": float(model.intercept), "path": path,
                   "n_features_initial": len(features), "n_selected": len(kept)}


# ---- checks ---------------------------------------------------------------------------------------

def monotonicity(scorer: Scorer, features: Sequence[str], trials: int = 20, seed: int = 42,
                 tolerance: float = 1e-6) -> dict:
    """Share of random subsets that do not score lower after one more feature."""
    rng = np.random.default_rng(seed)
    small, large = [], []
    for _ in range(trials):
        n = int(rng.integers(1, max(2, len(features) - 1)))
        order = rng.permutation(len(features))
        if n >= len(features):
            continue
        small.append(_ordered(features, [features[i] for i in order[:n]]))
        large.append(_ordered(features, [features[i] for i in order[:n + 1]]))
    got = scorer(small + large)
    a, b = got[:len(small)], got[len(small):]
    bad = sum(y < x - tolerance for x, y in zip(a, b))
    share = 100.0 * (1 - bad / max(1, len(small)))
    verdict = "holds" if share > 95 else "partly" if share > 80 else "fails"
    return {"tests": len(small), "violations": bad, "compliance_pct": share, "verdict": verdict}


def compare_to_full(make_scorer: Callable[[DataFrame, DataFrame], Scorer], train: DataFrame, test: DataFrame,
                    features: Sequence[str], selected: Sequence[str]) -> dict:
    """Score of a subset and of all features on the same split, and the difference."""
    subset, full = make_scorer(train, test)([list(selected), list(features)])
    return {"n_features_full": len(features), "n_features_selected": len(selected), "subset_accuracy": subset,
            "full_accuracy": full, "delta_accuracy": subset - full}


def outer_holdout(df: DataFrame, features: Sequence[str], id_col: str, label: str = "_y", test_share: float = 0.2,
                  inner_share: float = 0.2, seed: int = 42, k: int = 5, max_features: int | None = None,
                  max_cycles: int | None = None) -> dict:
    """Select inside the training part, then compare subset and full set on the untouched part."""
    train, test = split(df, id_col, label, test_share, seed, materialize=True)
    inner_train, inner_valid = split(train, id_col, label, inner_share, seed + 1, materialize=True)
    found = bidirectional(KnnScorer(inner_train, inner_valid, features, id_col, label, k), features,
                          max_features=max_features, max_cycles=max_cycles)
    out = compare_to_full(lambda a, b: KnnScorer(a, b, features, id_col, label, k), train, test, features, found.selected)
    return {**out, "selected": found.selected}


__all__ = ["prepare", "holdout", "KnnScorer", "ModelScorer", "CrossValidatedScorer", "Search", "forward", "backward",
           "bidirectional", "best_first", "max_min", "lasso", "choose_alpha", "monotonicity", "compare_to_full",
           "outer_holdout"]
