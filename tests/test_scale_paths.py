"""The branches meant for large data give the same results as the small ones."""
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window, functions as F

from tabulon.operators import clean, density, graph, neighbors, order, sampling


@pytest.fixture()
def frame(spark):
    rng = np.random.default_rng(3)
    n = 3000
    v = np.round(rng.exponential(10, n), 2)
    v[: n // 3] = 7.0  # a third of all rows shares one value
    return spark.createDataFrame(pd.DataFrame({
        "id": np.arange(n), "g": np.where(np.arange(n) % 3 == 0, "hot", (np.arange(n) % 40).astype(str)), "v": v,
        "w": rng.normal(size=n)}))


def _table(df):
    return sorted(tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in df.collect())


def test_range_quantiles_equal_builtin(frame):
    probs = [0.0, 0.25, 0.5, 0.98, 1.0]
    small = order.quantiles(frame, ["v", "w"], probs)
    large = order.quantiles(frame, ["v", "w"], probs, group_limit=10)
    assert _table(small) == _table(large)
    assert _table(order.quantiles(frame, ["v"], [0.5], ["g"])) == _table(
        order.quantiles(frame, ["v"], [0.5], ["g"], group_limit=10))


def test_numbered_rows_without_one_task(frame):
    got = order.number_rows(frame.select("id", "v"), [F.col("v").desc_nulls_last(), "id"])
    want = frame.select("id", "v", F.row_number().over(Window.orderBy(F.col("v").desc_nulls_last(), "id")).alias("row_no"))
    assert _table(got.select("id", "row_no")) == _table(want.select("id", "row_no"))


def test_components_without_the_driver(spark):
    rng = np.random.default_rng(5)
    e = pd.DataFrame({"u": rng.integers(0, 300, 260), "v": rng.integers(0, 300, 260)})
    chain = pd.DataFrame({"u": np.arange(1000, 1060), "v": np.arange(1001, 1061)})
    hub = pd.DataFrame({"u": 2000, "v": np.arange(2001, 2100)})
    both = pd.concat([e, chain, hub], ignore_index=True)
    both = both[both.u != both.v]
    root = {x: x for x in {*both.u, *both.v}}
    changed = True
    while changed:
        changed = False
        for u, v in both.itertuples(index=False):
            low = min(root[u], root[v])
            changed |= root[u] != low or root[v] != low
            root[u] = root[v] = low
    got = {r.node: r.root for r in graph.components(spark.createDataFrame(both)).collect()}
    assert got == root


def _brute(x, y, k):
    d = np.zeros((len(x), len(y)))
    for j in range(x.shape[1]):
        d += (x[:, j:j + 1] - y[None, :, j]) ** 2
    return [list(np.lexsort((np.arange(len(y)), row))[:k]) for row in d]


@pytest.mark.parametrize("limits", [{"BLOCK_ROWS": 60}, {"BLOCK_ROWS": 20, "COARSE": 4, "REGION_ROWS": 50, "SAMPLE_ROWS": 120}, {}])
def test_pruned_neighbours_are_exact(spark, monkeypatch, limits):
    for name, value in limits.items():
        monkeypatch.setattr(neighbors, name, value)
    rng = np.random.default_rng(7)
    ref = np.concatenate([rng.normal(size=(500, 3)), np.zeros((300, 3)), rng.uniform(-5, 5, (100, 3))]).round(2)
    ask = np.concatenate([rng.normal(size=(80, 3)), np.zeros((20, 3))]).round(2)

    def df(x):
        return spark.createDataFrame(pd.DataFrame(x, columns=["a", "b", "c"]).assign(id=np.arange(len(x))))
    near = neighbors.nearest(df(ask), df(ref), ["a", "b", "c"], 7, "id").toPandas()
    got = near.sort_values("rank").groupby("query_id")["neighbor_id"].apply(list).to_dict()
    assert [got[i] for i in range(len(ask))] == _brute(ask, ref, 7)
    assert neighbors.nearest(df(ask), df(ref).limit(0), ["a", "b", "c"], 7, "id").count() == 0
    assert neighbors.nearest(df(ask).limit(0), df(ref), ["a", "b", "c"], 7, "id").count() == 0
    far = df(np.array([[900.0, -900.0, 3.0], [0.0, 0.0, 0.0]]))  # beyond all boxes, and among copies
    got = neighbors.nearest(far, df(ref), ["a", "b", "c"], 2, "id", metric="manhattan").orderBy("query_id", "rank").collect()
    order = np.lexsort((np.arange(len(ref)), np.abs(ref - [900.0, -900.0, 3.0]).sum(1)))[:2]
    assert [r.neighbor_id for r in got] == [*order, 500, 501]


@pytest.mark.parametrize("metric", ["euclidean", "manhattan"])
def test_boxes_of_a_rare_value_and_blocks_of_queries(spark, monkeypatch, metric):
    """0/1 columns: boxes stay even; queries of several boxes share a block; equal distances go to the smaller id."""
    rng = np.random.default_rng(5)
    ref = np.hstack([np.eye(25)[rng.integers(0, 25, 4000)] * 5, rng.integers(0, 60, (4000, 2))])
    box = neighbors._Boxes(ref, 40).assign(ref)
    assert np.bincount(box).max() < 400 and len(set(box)) == 40
    for name, value in {"BLOCK_ROWS": 100, "COARSE": 8, "ASKED_ROWS": 64, "ASKS": 16, "PAIRS": 128}.items():
        monkeypatch.setattr(neighbors, name, value)
    ask = np.hstack([np.eye(25)[rng.integers(0, 25, 300)] * 5, rng.integers(-9, 70, (300, 2))])
    names = [f"f{j}" for j in range(27)]

    def df(x):
        return spark.createDataFrame(pd.DataFrame(x, columns=names).assign(id=[f"r{i:05d}" for i in range(len(x))], v=np.arange(len(x))))
    near = neighbors.nearest(df(ask), df(ref), names, 6, "id", ["v"], metric).toPandas().sort_values(["query_id", "rank"])
    d = sum(np.abs(ask[:, j:j + 1] - ref[None, :, j]) ** (2 if metric == "euclidean" else 1) for j in range(27))
    want = [np.lexsort((np.arange(len(ref)), row))[:6] for row in d]
    assert near["v"].tolist() == np.concatenate(want).tolist()
    assert near["neighbor_id"].tolist() == [f"r{i:05d}" for w in want for i in w]


def _dbscan(x, eps, min_samples):
    n, label, c = len(x), np.full(len(x), -1), 0
    d = sum((x[:, j:j + 1] - x[None, :, j]) ** 2 for j in range(x.shape[1]))
    near = d <= eps * eps
    core = near.sum(1) >= min_samples
    for i in range(n):
        if core[i] and label[i] == -1:
            label[i], todo = c, [i]
            while todo:
                p = todo.pop()
                if core[p]:
                    for q in np.nonzero(near[p] & (label == -1))[0]:
                        label[q] = c
                        todo.append(q)
            c += 1
    return label


@pytest.mark.parametrize("dim,eps,box", [(1, 0.02, 64), (2, 0.12, 64), (2, 0.5, 2), (3, 0.4, 64), (5, 0.9, 64), (5, 1.6, 2)])
def test_dbscan_equals_brute_force(spark, monkeypatch, dim, eps, box):
    monkeypatch.setattr(density, "BOX_POINTS", box)
    rng = np.random.default_rng(dim)
    x = np.concatenate([rng.normal(0, .5, (150, dim)), rng.normal(3, .5, (150, dim)), rng.uniform(-3, 6, (60, dim)),
                        np.zeros((120, dim))]).round(3)
    names = [f"f{j}" for j in range(dim)]
    df = spark.createDataFrame(pd.DataFrame(x, columns=names).assign(id=np.arange(len(x))))
    got = density.dbscan(df, "id", names, eps, 6).toPandas().sort_values("id")["cluster"].to_numpy()
    assert (got == _dbscan(x, eps, 6)).all()


def test_dbscan_meets_few_cells_where_points_are_close(spark, monkeypatch):
    met = []

    def counted(*args, near=density._near_cells, **options):
        pairs = near(*args, **options)
        met.append(pairs.count())
        return pairs
    monkeypatch.setattr(density, "_near_cells", counted)
    x = np.random.default_rng(5).uniform(0, 1, (1500, 3)).round(4)
    df = spark.createDataFrame(pd.DataFrame(x, columns=["a", "b", "c"]).assign(id=np.arange(len(x))))
    got = density.dbscan(df, "id", ["a", "b", "c"], 0.2, 6).toPandas().sort_values("id")["cluster"].to_numpy()
    assert (got == _dbscan(x, 0.2, 6)).all()
    assert sum(met) < 10_000  # 20,435 when every near cell is met


def test_density_run_in_one_call(spark):
    rng = np.random.default_rng(11)
    x = np.concatenate([rng.normal(0, 1, (120, 3)), rng.normal(8, 1, (60, 3)), rng.uniform(-20, 20, (8, 3))])
    known = x.copy()
    known[::9, 1] = np.nan
    df = spark.createDataFrame([(i, *[None if np.isnan(v) else float(v) for v in r]) for i, r in enumerate(known)],
                               "id long, a double, b double, c double")
    got = density.density_outliers(df, "id", ["a", "b", "c"], min_samples=6)
    filled = np.where(np.isnan(known), np.nanmedian(known, axis=0), known)
    scaled = (filled - filled.mean(0)) / filled.std(0)
    dist = np.sqrt(((scaled[:, None] - scaled[None]) ** 2).sum(2))
    assert got["eps"] == pytest.approx(np.percentile(np.sort(dist, 1)[:, 5], 98))
    rows = got["rows"].orderBy("id").toPandas()
    assert (rows["cluster"].to_numpy() == _dbscan(scaled, got["eps"], 6)).all()
    assert rows["b"].isna().sum() == np.isnan(known[:, 1]).sum()
    assert {r["is_outlier"]: r["n"] for r in got["profile"].collect()} == rows["is_outlier"].value_counts().to_dict()
    same = spark.createDataFrame([(i, 1.0) for i in range(30)], "id long, a double")
    with pytest.raises(ValueError):
        density.density_outliers(same, "id", ["a"], min_samples=6)
    assert density.dbscan(df.limit(0).select("id", "a", "b", "c"), "id", ["a", "b", "c"], 1.0, 3).count() == 0


def test_same_samples_at_any_partitioning(spark, frame):
    def sample(parts):
        spark.conf.set("spark.sql.shuffle.partitions", str(parts))
        try:
            df = frame.repartition(parts)
            a = sampling.balanced_sample(df, "id", "g", 50)
            f = sampling.stratified_folds(df, "id", "g", 3)
            return _table(a.select("id")), _table(f.select("id", "fold"))
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert sample(1) == sample(13)


def test_split_is_disjoint_and_complete(frame):
    train, test = sampling.split(frame, "id", "g", 0.25)
    assert train.count() + test.count() == frame.count()
    assert train.select("id").intersect(test.select("id")).count() == 0
    capped = sampling.cap_rows(frame, "id", "g", 777)
    assert capped.count() == 777


@pytest.mark.parametrize("ids", ["even", "skewed", "text"])
def test_draws_hit_rows_by_place(spark, monkeypatch, ids):
    monkeypatch.setattr(order, "RANGES", 7)
    monkeypatch.setattr(order, "BINS", 3)
    n = 500
    values = {"even": np.arange(n) - 40, "skewed": np.concatenate([np.arange(n - 3), [10**9, 10**12, 10**15]]),
              "text": np.array([f"k{i:04d}" for i in range(n)])}[ids]
    df = spark.createDataFrame(pd.DataFrame({"id": values})).repartition(5)
    got = {r["draw"]: r["id"] for r in sampling.draw_with_replacement(df, "id", 300, seed=9).collect()}
    import hashlib
    want = {i: sorted(values)[int(hashlib.md5(f"{i}:9".encode()).hexdigest()[:15], 16) % n] for i in range(300)}
    assert got == want
    assert sampling.draw_with_replacement(df.limit(0), "id", 5).count() == 0


def test_ordered_folds_in_narrow_bins(spark, monkeypatch):
    df = spark.createDataFrame([(i * i - 50, i % 3) for i in range(90)], "id long, y long")
    many = _table(sampling.stratified_folds(df, "id", "y", 4, shuffle=False))
    monkeypatch.setattr(order, "RANGES", 2)
    monkeypatch.setattr(order, "BINS", 1)
    assert many == _table(sampling.stratified_folds(df, "id", "y", 4, shuffle=False))


def test_few_valued_is_exact_at_the_limit(spark):
    df = spark.range(2000).select(
        *[(F.col("id") % d / 7.0).alias(f"d{d}") for d in (1, 49, 50, 51, 90, 130, 2000)],
        F.lit(None).cast("double").alias("none"), F.col("id").cast("string").alias("text"))
    assert clean.few_valued(df, 50) == ["d1", "d49", "d50", "none", "text"]
    assert clean.few_valued(df, 1) == ["d1", "none", "text"]
    assert clean.few_valued(df.limit(0), 50) == df.columns
    assert clean.few_valued(df, 1999) == [c for c in df.columns if c != "d2000"]


@pytest.mark.parametrize("power", [1.0, 2.0])
def test_sieve_adds_up_few_pairs(monkeypatch, power):
    """Many columns: estimates leave few pairs to add up, and the nearest of all rows, also with copies, offsets, flags and nulls."""
    rng = np.random.default_rng(11)
    q, b, met = rng.normal(size=(60, 24)), rng.normal(size=(5000, 24)), []
    b[40:90], q[3] = b[7], b[7]
    q[:, 5] += 1e4
    b[:, 5] += 1e4
    q[:, 6], b[:, 6] = rng.integers(0, 2, 60), rng.integers(0, 2, 5000)
    q[9], b[4000] = np.nan, np.nan
    sums, distances = neighbors.power_sums, getattr(neighbors._Nearer, "_distances", None)
    monkeypatch.setattr(neighbors, "power_sums", lambda a, b, p: (met.append(len(a) * len(b)), sums(a, b, p))[1])
    monkeypatch.setattr(neighbors._Nearer, "_distances", lambda self, x, r, i, j: (met.append(len(i)), distances(self, x, r, i, j))[1], raising=False)
    near, found = neighbors._Nearer(q, np.full(60, -1), np.full(60, np.inf), 6, power), []
    for s in range(0, len(b), 500):
        i, j, d = near.meet(0, b[s:s + 500])
        found += zip(i.tolist(), d.tolist(), (j + s).tolist())
    assert sum(met) < len(q) * len(b) / 6
    for i in range(len(q)):
        d = np.cumsum(np.abs(q[i] - b) ** power, axis=1)[:, -1]
        want = [(d[j], j) for j in np.lexsort((np.arange(len(b)), d))[:6]] if i != 9 else []
        assert sorted((e, j) for n, e, j in found if n == i)[:6] == want


@pytest.mark.parametrize("metric", ["euclidean", "manhattan"])
def test_many_dimensions_need_no_boxes(spark, monkeypatch, metric):
    """Where a query would meet most boxes, blocks of queries meet all rows in one job."""
    rng = np.random.default_rng(13)
    ref, ask = rng.normal(size=(900, 20)).round(1), rng.normal(size=(70, 20)).round(1)
    ref[100:130], ask[4], ask[8] = ref[3], ref[3], ask[5]
    names = [f"f{j}" for j in range(20)]

    def boxes(*_):
        raise AssertionError("boxes")
    for name, value in {"BLOCK_ROWS": 50, "ASKED_ROWS": 16, "ASKS": 8, "PAIRS": 64, "_boxed": boxes}.items():
        monkeypatch.setattr(neighbors, name, value)

    def df(x):
        return spark.createDataFrame(pd.DataFrame(x, columns=names).assign(id=np.arange(len(x)), v=np.arange(len(x)) % 7))
    near = neighbors.nearest(df(ask), df(ref), names, 5, "id", ["v"], metric).toPandas().sort_values(["query_id", "rank"])
    d = sum(np.abs(ask[:, j:j + 1] - ref[None, :, j]) ** (2 if metric == "euclidean" else 1) for j in range(20))
    want = np.concatenate([np.lexsort((np.arange(len(ref)), row))[:5] for row in d])
    assert near["neighbor_id"].tolist() == want.tolist() and near["v"].tolist() == (want % 7).tolist()
    # Few dimensions keep their boxes.
    assert not neighbors._needs_most_boxes(rng.normal(size=(5000, 2)), 100_000, 5, 2.0)
