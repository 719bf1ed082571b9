"""Searches against brute force, model invariants and the end-to-end plans."""
import itertools

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabulon import DatasetSpec
from tabulon.operators import ensemble, evaluate, models, pca, ranking, selection, subsetvote, tuning
from tabulon.operators.ensemble import Expert
from tabulon.operators.models import ModelSpec
from tabulon.operators.sampling import split
from tabulon.plans import benchmarks, preprocess

NAMES = ["a", "b", "c", "d"]


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(11)
    n = 360
    y = np.arange(n) % 3
    x = rng.normal(size=(n, 4)) + np.column_stack([y * 1.2, -y, np.zeros(n), np.zeros(n)])
    return spark.createDataFrame(pd.DataFrame(x.round(4), columns=NAMES).assign(id=np.arange(n), y=y.astype("int32")))


def test_knn_scorer_equals_brute_force(data):
    train, valid = split(data, "id", "y", 0.25)
    t, v = train.toPandas(), valid.toPandas()
    sets = [list(s) for r in (1, 2, 4) for s in itertools.combinations(NAMES, r)]
    got = selection.KnnScorer(train, valid, NAMES, "id", "y")(sets)
    for s, score in zip(sets, got):
        d = sum((v[c].to_numpy()[:, None] - t[c].to_numpy()[None, :]) ** 2 for c in s)
        hits = 0
        for i in range(len(v)):
            near = np.lexsort((t["id"].to_numpy(), d[i]))[:5]
            w = 1 / np.sqrt(d[i][near]) if (d[i][near] > 0).all() else (d[i][near] == 0).astype(float)
            votes = [round(w[t["y"].to_numpy()[near] == c].sum() / w.sum(), 12) for c in range(3)]
            hits += int(np.argmax(votes)) == v["y"].iloc[i]
        assert score == pytest.approx(hits / len(v))


def _vote_by_hand(d, y, k, weights):
    """The class that the k nearest of distances ``d`` choose; null classes (-1) lose ties."""
    near = [j for j in np.lexsort((np.arange(len(d)), d))[:k] if np.isfinite(d[j])]
    w = {j: 1.0 if weights == "uniform" else float(d[j] == 0) if d[near[0]] == 0 else 1 / np.sqrt(d[j]) for j in near}
    votes = {c: round(sum(w[j] for j in near if y[j] == c) / sum(w.values()), 12) for c in {y[j] for j in near}}
    return min(votes, key=lambda c: (-votes[c], c < 0, c)) if votes else None


@pytest.mark.parametrize("k,weights", [(5, "distance"), (3, "uniform")])
def test_streamed_votes_equal_all_pairs(monkeypatch, k, weights):
    """Stretches, bounds and windows leave the votes of all pairs, also with copies, nulls and repeated ids; few pairs are added up."""
    for name, value in (("FIRST", 16), ("STRETCH", 200), ("ASKS", 13), ("PAIRS", 50)):
        monkeypatch.setattr(subsetvote, name, value)
    rng = np.random.default_rng(4)
    b, q = rng.normal(size=(1500, 6)), rng.normal(size=(80, 6))
    b[200:900] = b[5]
    b[:, 4] = np.round(b[:, 4])
    q[:10], q[10:20, 4], q[30], b[1000, 2] = b[5], 0.0, np.nan, np.nan
    y, truth = rng.integers(0, 3, len(b)), rng.integers(0, 3, len(q))
    y[7], truth[3] = -1, -1
    ids = pd.Series([i // 2 if i < 6 else i for i in range(len(q))])
    every = list(range(6))
    searches = {"single": [[c] for c in every], "grow": [[1, 3, c] for c in (0, 2, 4, 5)] + [[1, 3]], "shrink": [[c for c in every if c != j] for j in every],
                "prefixes": [every[:m] for m in range(1, 7)], "any": [[0], [2, 4], [1, 3, 5]]}
    for sets in searches.values():
        pairs = []
        exact = subsetvote.Nearest._exact
        monkeypatch.setattr(subsetvote.Nearest, "_exact", lambda self, i, rows, which: (pairs.append(len(i)), exact(self, i, rows, which))[1])
        near = subsetvote.Nearest(q, sets, k)
        for s in range(0, len(b), 400):
            near.meet(b[s:s + 400], np.where(y < 0, subsetvote._NO_CLASS, y)[s:s + 400])
        got = near.hits(ids, np.where(truth < 0, subsetvote._NO_TRUTH, truth), weights)
        monkeypatch.setattr(subsetvote.Nearest, "_exact", exact)
        assert sum(pairs) < len(sets) * b.shape[0] * q.shape[0] / 4
        for s, n in zip(sets, got):
            d = np.zeros((len(q), len(b)))
            for c in s:
                d = d + (q[:, c:c + 1] - b[None, :, c]) ** 2
            d[np.isnan(d)] = np.inf
            want = 0
            for i in range(len(q)):
                same = np.flatnonzero(ids == ids[i])  # rows of one id vote together: each brings its distances
                both = np.stack([d[i] for i in same], 1).ravel()
                want += truth[i] >= 0 and _vote_by_hand(both, np.repeat(y, len(same)), k, weights) == truth[i]
            assert n == want, s


@pytest.mark.parametrize("shape", ["plain", "offset", "huge", "tiny", "mixed"])
def test_screens_let_in_little_and_lose_nothing(monkeypatch, shape):
    """A backward step adds up few pairs besides those that enter, whatever the scale of the columns, and gives the nearest of all rows."""
    rng = np.random.default_rng(8)
    x = rng.normal(size=(3040, 12))
    x = {"plain": x, "offset": x + 1e7, "huge": x * 1e60, "tiny": x * 1e-30, "mixed": x * np.resize([1, 1e3, 10, 1e-3], 12)}[shape]
    q, b, every = x[:40], x[40:], list(range(12))
    for sets in ([[c for c in every if c != j] for j in every], [every[:m] for m in range(1, 13)], [[0, 3, c] for c in (1, 2, 4, 5)]):
        pairs, exact = [], subsetvote.Nearest._exact
        monkeypatch.setattr(subsetvote.Nearest, "_exact", lambda self, i, rows, which: (pairs.append(len(i)), exact(self, i, rows, which))[1])
        near = subsetvote.Nearest(q, sets, 5)
        near.meet(b, np.zeros(len(b), int))
        monkeypatch.setattr(subsetvote.Nearest, "_exact", exact)
        if len(sets) == 12 and len(sets[0]) == 11 and shape in ("plain", "offset"):
            assert sum(pairs) < len(q) * len(b) / 4
        for n, s in enumerate(sets):
            d = ((q[:, None, s] - b[None, :, s]) ** 2).sum(2)
            want = np.argsort(d, axis=1, kind="stable")[:, :5]
            assert (np.sort(near.row[n], 1) == np.sort(want, 1)).all()


@pytest.mark.parametrize("case", ["grow", "shrink"])
def test_steps_add_up_few_gaps(monkeypatch, case):
    """A search step adds up gaps for few sets of a pair, not for all sets of each pair that is near over the common columns."""
    rng = np.random.default_rng(3)
    q, b, met = rng.normal(size=(150, 16)), rng.normal(size=(6000, 16)), []
    b[100:140] = b[7]
    q[5], q[6, 3], b[50, 2] = b[7], np.nan, np.nan
    sets = [[0, 3, 9, c] for c in range(16) if c not in (0, 3, 9)] if case == "grow" else [[c for c in range(9) if c != j] for j in range(9)]
    gap = subsetvote._Screen.gap
    monkeypatch.setattr(subsetvote._Screen, "gap", lambda self, i, j, c: (met.append(len(i)), gap(self, i, j, c))[1])
    near = subsetvote.Nearest(q, sets, 5)
    for s in range(0, len(b), 2500):
        near.meet(b[s:s + 2500], np.zeros(len(b[s:s + 2500]), int))
    assert sum(met) < (100 if case == "grow" else 250) * len(q) * len(sets)
    for n, s in enumerate(sets):
        d = ((q[:, None, s] - b[None, :, s]) ** 2).sum(2)
        want = np.argsort(d, axis=1, kind="stable")[:, :5]
        known = ~np.isnan(d).all(1)
        assert (np.sort(near.row[n], 1) == np.sort(want, 1))[known].all() and (near.row[n][~known] == -1).all()


class Table:
    """A scorer over a fixed score of every subset."""

    def __init__(self, seed):
        rng = np.random.default_rng(seed)
        self.scores = {frozenset(s): round(float(rng.uniform()), 1)
                       for r in range(1, 5) for s in itertools.combinations(NAMES, r)}

    def __call__(self, subsets):
        return [self.scores[frozenset(s)] for s in subsets]


@pytest.mark.parametrize("seed", range(12))
def test_search_rules(seed):
    table = Table(seed)
    f = selection.forward(table, NAMES, 4)
    scores = [h["score_after"] for h in f.history]
    assert all(b > a for a, b in zip(scores, scores[1:]))
    assert f.summary["theoretical_models"] == 10
    b = selection.backward(table, NAMES, 1)
    assert all(h["score_after"] >= h["score_before"] for h in b.history)
    assert b.summary["theoretical_models"] == 10 and b.summary["best_score"] >= b.summary["baseline_score"]
    both = selection.bidirectional(table, NAMES)
    assert all(h["score_after"] > h["score_before"] for h in both.history[1:])
    assert both.summary["best_score"] == table([both.selected])[0]
    best = selection.best_first(table, NAMES, patience=16)
    assert best.summary["best_score"] == max(table.scores.values())
    assert best.summary["evaluated_models"] == 15


@pytest.mark.parametrize("seed", range(8))
def test_walks_take_the_best_neighbour(seed):
    """Each step against all neighbours of its set, and the refused step at the end."""
    table, worth = Table(seed), lambda s: table.scores.get(frozenset(s), 0.0)
    for found, start, grows in ((selection.forward(table, NAMES, 4), set(), True), (selection.backward(table, NAMES, 1), set(NAMES), False)):
        current, evaluated = start, 0 if grows else 1
        around = lambda s: [(worth(s ^ {c}), c) for c in NAMES if (c in s) != grows]
        for h in found.history:
            best = max(v for v, _ in around(current))
            evaluated += len(around(current))
            assert h["score_after"] == best and h["feature"] == next(c for v, c in around(current) if v == best)
            assert h["n_features_before"] == len(current)
            current = current ^ {h["feature"]}
            assert h["n_features_after"] == len(current)
        if found.summary["stop_reason"] in ("score_not_rising", "score_falling"):
            best = max(v for v, _ in around(current))
            evaluated += len(around(current))
            assert best <= worth(current) if grows else best < worth(current)
        assert set(found.selected) == current and found.summary["evaluated_models"] == evaluated
    limited = selection.forward(table, NAMES, 4, max_steps=1)
    assert len(limited.history) == 1 and limited.summary["stop_reason"] in ("max_steps_reached", "max_features_reached")
    strict = selection.forward(table, NAMES, 4, min_improvement=5.0)
    assert len(strict.history) == 1 and strict.summary["stop_reason"] in ("score_not_rising", "improvement_too_small")
    both = selection.bidirectional(table, NAMES, max_cycles=1)
    assert both.summary["cycles"] == 1 and [h["phase"] for h in both.history][0] == "forward"


def test_search_arguments():
    with pytest.raises(ValueError):
        selection.forward(Table(0), NAMES, 9)
    with pytest.raises(ValueError):
        selection.backward(Table(0), NAMES, 4)
    with pytest.raises(ValueError):
        selection.bidirectional(Table(0), NAMES, 3, 2)


def test_lasso_equals_coordinate_descent(data):
    table, info = selection.lasso(data, "id", "y", NAMES, alpha=0.05)
    p = data.toPandas()
    x = (p[NAMES] - p[NAMES].mean()) / p[NAMES].std(ddof=0)
    c = np.cov(np.column_stack([x, p["y"]]).T, ddof=0)
    want = selection._descend(c, 0.05, np.zeros(4), 5000)
    got = {r["feature"]: r["coefficient"] for r in table.collect()}
    assert np.allclose([got[n] for n in NAMES], want, atol=1e-5)
    cv, info = selection.lasso(data, "id", "y", NAMES)
    assert info["alpha"] > 0 and len(info["path"]) == 100 and set(info["selected"]) >= {"a", "b"}


def test_correlations_equal_numpy(data):
    frame = data.withColumn("k", F.lit(1.0)).withColumn("a", F.when(F.col("id") % 5 > 0, F.col("a")))
    cols = [*NAMES, "k"]
    got = {(r.feature_1, r.feature_2): r["corr"] for r in ranking.correlations(frame, cols).collect()}
    want = frame.select(*cols).toPandas().corr()
    assert len(got) == len(cols) * (len(cols) - 1) // 2
    for (x, y), v in got.items():
        assert v is None if "k" in (x, y) else abs(v - want.loc[x, y]) < 1e-9


def test_information_gain_bounds(data):
    got = ranking.information_gain(data.withColumn("sign", (F.col("a") > 0).cast("int")), "y", ["sign", "y"])
    for r in got.collect():
        assert 0 <= r["information_gain"] <= r["target_entropy"] + 1e-9
    with pytest.raises(ValueError):
        ranking.rank_information_gain(data.select("a", "y"), "y")


def test_pca_equals_numpy(data):
    fitted = pca.fit_pca(data, ["id", "y"])
    want = np.sort(np.linalg.eigvalsh(np.cov(data.select(NAMES).toPandas().T.to_numpy())))[::-1]
    assert np.allclose(fitted.variance, want)
    pcs = pca.apply_pca(data, fitted, ["id"]).toPandas().sort_values("id")
    assert np.allclose(pcs[["PC1", "PC2"]].var(ddof=1), want[:2])
    assert all(max(row, key=abs) > 0 for row in fitted.loadings)


@pytest.mark.parametrize("spec", [
    ModelSpec("majority"), ModelSpec("tree", {"max_depth": 4}), ModelSpec("logistic", scale=True),
    ModelSpec("knn", {"weights": "distance"}), ModelSpec("adaboost", {"n_estimators": 4, "max_depth": 2}),
    ModelSpec("boosting", {"max_iter": 2, "max_depth": 2})])
def test_profiles_sum_to_one(data, spec):
    fitted = models.fit(spec, data, NAMES, "y", "id")
    p = np.stack(fitted.profile(data).toPandas()["probs"].to_numpy())
    assert p.shape == (360, 3) and np.allclose(p.sum(1), 1) and (p >= 0).all()
    done = models.predict(fitted, data).join(data.select("id", "y"), "id")
    acc = evaluate.scores(done, "y", "prediction").first()["accuracy"]
    assert acc >= (1 / 3 if spec.kind == "majority" else 0.55)


def test_knn_grid_equals_single_fits(data):
    train, valid = split(data, "id", "y", 0.25)
    got = tuning.grid_search(ModelSpec("knn", scale=True), {"n_neighbors": [3, 9], "weights": ["distance"]},
                             train, valid, NAMES, "y", "id", folds=2)
    folded = tuning.stratified_folds(train, "id", "y", 2, True, 42, "_fold")
    for combo, score in got["all"]:
        one = [tuning._fold_score(ModelSpec("knn", combo, True), folded, NAMES, "y", "id", f) for f in range(2)]
        assert score == pytest.approx(sum(one) / 2)


def _votes(spark):
    rows = [(1, e, c, p) for e, ps in (("x", (.5, .5)), ("y", (.2, .8)), ("z", (.8, .2))) for c, p in zip((0, 1), ps)]
    return spark.createDataFrame(rows, "id int, expert string, cls int, proba double")


def test_ties_and_weights(spark):
    p = _votes(spark)
    for rule in ensemble.RULES:
        assert ensemble.combine(p, rule, {"x": 0.0, "y": 0.0, "z": 0.0}).first()["prediction"] == 0
    with pytest.raises(ValueError):
        ensemble.aggregate(p, "weighted_mean", {"x": -1.0, "y": 1.0, "z": 1.0})
    with pytest.raises(ValueError):
        ensemble.aggregate(p, "best")


def test_diversity_of_perfect_experts(spark):
    pred = spark.createDataFrame([(i, e, i % 2) for i in range(4) for e in ("x", "y")], "id int, expert string, prediction int")
    truth = spark.createDataFrame([(i, i % 2) for i in range(4)], "id int, label int")
    r = ensemble.diversity(pred, truth, ["x", "y"]).first()
    assert (r["n11"], r["disagreement"], r["double_fault"], r["q_statistic"], r["correlation_phi"]) == (4, 0, 0, 0, 0)


def test_ensemble_plan(data):
    def experts(sets):
        return [Expert("tree", ModelSpec("tree", {"max_depth": 4}), tuple(sets["full"])),
                Expert("logistic", ModelSpec("logistic", scale=True), tuple(sets["lasso_top"])),
                Expert("base", ModelSpec("majority"), tuple(sets["max_min"]))]
    got = benchmarks.compare_ensembles(
        data, "id", "y", experts, max_per_class=100, top_k=2, sets={"full": NAMES, "lasso_top": NAMES[:2], "max_min": NAMES[:1]})
    board = got["leaderboard"].toPandas()
    assert len(board) == 3 + 5 + 2 + 10 and board["f1_micro"].is_monotonic_decreasing
    assert got["diverse_choice"].count() == 2


def test_method_comparison_reports_failures(data, caplog):
    board = benchmarks.compare_methods(
        data, "id", "y", ("correlation", "information_gain"), {"majority": (ModelSpec("majority"), {"unused": [1]})},
        max_features=2, folds=2)
    good, failed = board.collect()  # the one without scores comes last
    assert good["model"] == "correlation" and good["error"] is None and good["f1_micro"] is not None
    assert failed["model"] == "information_gain" and "no discrete feature" in failed["error"]
    assert failed["f1_micro"] is None and failed["f1_macro"] is None


def test_preprocess_and_stream(spark, tmp_path):
    spec = DatasetSpec("id", "y", ("age", "area"), ("kind",), ("monum_flag",), age_col="age", allowed={"kind": ("p", "q")})
    rng = np.random.default_rng(2)
    n = 300
    pdf = pd.DataFrame({"id": np.arange(n), "age": rng.integers(5, 60, n).astype(float), "area": rng.normal(50, 5, n),
                        "kind": np.where(np.arange(n) % 3 == 0, "p", "q")})
    pdf.loc[:4, "age"] = [995.0, 240.0, 245.0, 200.0, 995.0]
    train = spark.createDataFrame(pdf)
    labels = spark.createDataFrame(pd.DataFrame({"id": np.arange(n), "y": np.arange(n) % 3}))
    done = preprocess.preprocess(train, labels, train, spec, strategy="median")
    assert done.bounds.keys() >= {"age"} and done.strategy == "median"
    out = done.train.toPandas().sort_values("id")
    assert abs(out["age"].mean()) < 1e-9 and abs(out["age"].std(ddof=0) - 1) < 1e-9
    assert list(out["monum_flag"][:5]) == [0, 1, 1, 1, 0] and {"kind_p", "kind_q"} <= set(out.columns)

    from tabulon.streaming.apply import transform_stream
    train.write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(train.schema).parquet(f"{tmp_path}/in")
    q = transform_stream(stream, done.transform, f"{tmp_path}/out", f"{tmp_path}/ck")
    q.awaitTermination(120)
    streamed = spark.read.parquet(f"{tmp_path}/out").toPandas().sort_values("id")[list(out.columns)]
    assert np.allclose(streamed.to_numpy(dtype=float), out.to_numpy(dtype=float))


def test_auto_strategy(spark):
    rng = np.random.default_rng(4)
    n = 240
    x = rng.normal(10, 2, n)
    df = spark.createDataFrame(pd.DataFrame({"id": np.arange(n), "x": x, "v": np.where(np.arange(n) % 9 == 0, np.nan, x * 2)}))
    df = df.withColumn("v", F.when(~F.isnan("v"), F.col("v")))
    labels = spark.createDataFrame(pd.DataFrame({"id": np.arange(n), "y": (x > 10).astype(int)}))
    best, results = preprocess.choose_imputation(df, labels, ["v"], "id", "y", max_rows=210)
    got = results.toPandas()
    assert best in set(got["strategy"]) and (got["n_rows"] == 210).all() and (got["missing_after"] == 0).all()
