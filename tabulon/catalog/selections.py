"""Feature-subset searches and embedded selection."""
from __future__ import annotations

from pyspark.sql import functions as F

from tabulon.catalog.base import homes, longs, out, query, table
from tabulon.operators import evaluate, pca, selection
from tabulon.operators.models import ModelSpec
from tabulon.operators.sampling import split

_DIMS = 64
_FEATURES = [f"e{i}" for i in range(_DIMS)]


def _vectors(spark, d):
    return table(spark, d, "embeddings").select(
        "vec_id", F.col("label").alias("_y"), *[F.col("embedding")[i].cast("double").alias(f) for i, f in enumerate(_FEATURES)])


def _scorer(spark, d, scale=False):
    train, valid = split(_vectors(spark, d), "vec_id", "_y", 0.2)
    return selection.KnnScorer(train, valid, _FEATURES, "vec_id", scale=scale)


# Holdout accuracy of the first m features, for every m.
@query("subset_scores", f"""WITH e AS (SELECT vec_id AS id, label AS y, embedding::DOUBLE[] AS x,
 row_number() OVER (PARTITION BY label ORDER BY md5(concat_ws(':', vec_id::VARCHAR, '42')), vec_id) AS rn, count(*) OVER (PARTITION BY label) AS n FROM embeddings),
gaps AS (SELECT q.id, q.y AS truth, r.id AS r, r.y, m, (q.x[m] - r.x[m]) * (q.x[m] - r.x[m]) AS g
 FROM e q JOIN e r ON q.rn <= round_even(q.n * 0.2, 0) AND r.rn > round_even(r.n * 0.2, 0), range(1, {_DIMS + 1}) t(m)),
dist AS (SELECT m, id, truth, r, y, sum(g) OVER (PARTITION BY id, r ORDER BY m) AS s FROM gaps),
nn AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY m, id ORDER BY s, r) AS rank FROM dist) WHERE rank <= 5),
v AS (SELECT m, id, truth, y, sum(CASE WHEN z THEN (s = 0)::INT::DOUBLE ELSE 1 / sqrt(s) END) AS w FROM (SELECT *, min(s) OVER (PARTITION BY m, id) = 0 AS z FROM nn) GROUP BY ALL),
pk AS (SELECT m, id, truth, y, row_number() OVER (PARTITION BY m, id ORDER BY w DESC, y) AS o FROM (SELECT m, id, truth, y, round(w / sum(w) OVER (PARTITION BY m, id), 12) AS w FROM v))
SELECT m AS subset, round(count(*) FILTER (truth = y)::DOUBLE / count(*), 6) AS score FROM pk WHERE o = 1 GROUP BY m""")
def subset_scores(spark, d):
    got = _scorer(spark, d)([_FEATURES[:m] for m in range(1, _DIMS + 1)])
    return out(spark.createDataFrame([(m + 1, s) for m, s in enumerate(got)], "subset bigint, score double"))


def _steps(spark, found):
    return out(found.history_frame(spark).drop("cycle", "phase"))


@query("forward_selection")
def forward_selection(spark, d):
    return _steps(spark, selection.forward(_scorer(spark, d), _FEATURES, _DIMS))


@query("backward_selection")
def backward_selection(spark, d):
    return _steps(spark, selection.backward(_scorer(spark, d), _FEATURES, 1))


@query("search_history_check")
def search_history_check(spark, d):
    found = selection.forward(_scorer(spark, d), _FEATURES, _DIMS)
    return evaluate.history_is_consistent(found.history_frame(spark), 1)


@query("bidirectional_selection")
def bidirectional_selection(spark, d):
    return out(selection.bidirectional(_scorer(spark, d), _FEATURES).history_frame(spark))


@query("forward_selection_scaled")
def forward_selection_scaled(spark, d):
    return out(selection.forward(_scorer(spark, d, scale=True), _FEATURES, _DIMS).history_frame(spark))


@query("forward_selection_logistic")
def forward_selection_logistic(spark, d):
    """Over the first four features only: every candidate is a Spark fit of its own."""
    train, valid = split(_vectors(spark, d), "vec_id", "_y", 0.2)
    scorer = selection.ModelScorer(train, valid, "vec_id", ModelSpec("logistic", {"max_iter": 30}, scale=True))
    return out(selection.forward(scorer, _FEATURES[:4], 2).history_frame(spark))


@query("best_first_search")
def best_first_search(spark, d):
    """Cross-validated trees over the first three features only: every candidate is a Spark fit per fold."""
    scorer = selection.CrossValidatedScorer(_vectors(spark, d), "vec_id", ModelSpec("tree", {"max_depth": 5}), folds=3)
    return _expansions(spark, selection.best_first(scorer, _FEATURES[:3], patience=2))


@query("best_first_neighbours")
def best_first_neighbours(spark, d):
    """All features, scored by the neighbour vote."""
    return _expansions(spark, selection.best_first(_scorer(spark, d), _FEATURES, patience=5))


def _expansions(spark, found):
    return out(spark.createDataFrame([tuple(h.values()) for h in found.history], (
        "step int, expanded_subset string, best_child_generated string, score_of_expanded double, "
        "score_of_best_child double, global_best_score double, stagnation_count int")))


@query("monotonicity_check")
def monotonicity_check(spark, d):
    r = selection.monotonicity(_scorer(spark, d), _FEATURES, trials=20)
    return spark.createDataFrame([(r["tests"], r["violations"], r["compliance_pct"], r["verdict"])],
                                 "tests int, violations int, compliance_pct double, verdict string")


@query("subset_against_full")
def subset_against_full(spark, d):
    r = selection.outer_holdout(_vectors(spark, d), _FEATURES, "vec_id")
    return out(spark.createDataFrame([(r["n_features_full"], r["n_features_selected"], r["subset_accuracy"],
                                       r["full_accuracy"], r["delta_accuracy"])], (
        "n_features_full int, n_features_selected int, subset_accuracy double, full_accuracy double, delta_accuracy double")))


@query("prepared_features", """SELECT o_orderkey, (CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END)::BIGINT AS _y, o_totalprice, """ + ", ".join(
    f"""(o_orderpriority = '{v}')::BIGINT AS "o_orderpriority_{v}" """
    for v in ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")) + " FROM orders")
def prepared_features(spark, d):
    o = table(spark, d, "orders").drop("o_orderdate", "o_custkey")
    return longs(selection.prepare(o, "o_orderkey", "o_orderstatus")[0])


@query("lasso_one_feature", """WITH s AS (SELECT covar_pop(l_extendedprice, l_quantity) / stddev_pop(l_quantity) AS r FROM lineitem)
SELECT 1::BIGINT AS rank, 'l_quantity' AS feature, round(sign(r) * greatest(abs(r) - 5000, 0), 2) AS coefficient, round(greatest(abs(r) - 5000, 0), 2) AS abs_coefficient, abs(r) > 5000 AS is_selected FROM s""")
def lasso_one_feature(spark, d):
    li = table(spark, d, "lineitem").select("l_orderkey", "l_quantity", "l_extendedprice")
    return out(selection.lasso(li, "l_orderkey", "l_extendedprice", ["l_quantity"], alpha=5000.0)[0], 2)


def _home_numbers(spark, d):
    return homes(spark, d).select("id", "geo1", "geo2", "geo3", "balance",
                                  (F.col("geo2") * 3 - F.col("geo1")).alias("mix"), "price")


@query("lasso_selection")
def lasso_selection(spark, d):
    return out(selection.lasso(_home_numbers(spark, d), "id", "price", ["geo1", "geo2", "geo3", "balance", "mix"],
                               alpha=100.0)[0], 4)


@query("lasso_cross_validated")
def lasso_cross_validated(spark, d):
    table_, info = selection.lasso(_home_numbers(spark, d), "id", "balance", ["geo1", "geo2", "geo3", "price"])
    return out(table_.withColumn("alpha", F.lit(info["alpha"])), 4)


# ---- PCA --------------------------------------------------------------------------------------------------

def _embedding_columns(spark, d, dims=64):
    return table(spark, d, "embeddings").select(
        "vec_id", "label", *[F.col("embedding")[i].cast("double").alias(f"e{i}") for i in range(dims)])


@query("pca_projection", """WITH c AS (SELECT var_samp(l_quantity) AS a, var_samp(l_discount * 100) AS b, covar_samp(l_quantity, l_discount * 100) AS c, avg(l_quantity) AS ma, avg(l_discount * 100) AS mb FROM lineitem),
ev AS (SELECT *, (a + b) / 2 + sqrt(((a - b) / 2) ** 2 + c * c) AS v1 FROM c), ld AS (SELECT *, CASE WHEN a >= b THEN v1 - b ELSE c END AS x, CASE WHEN a >= b THEN c ELSE v1 - a END AS y FROM ev)
SELECT l_orderkey, round(((l_quantity - ma) * x + (l_discount * 100 - mb) * y) / sqrt(x * x + y * y), 5) + 0.0 AS "PC1" FROM lineitem, ld""")
def pca_projection(spark, d):
    t = table(spark, d, "lineitem").select("l_orderkey", "l_quantity", (F.col("l_discount") * 100).alias("discount_pct"))
    return out(pca.apply_pca(t, pca.fit_pca(t, ["l_orderkey"], 1), ["l_orderkey"]), 5)


@query("pca_loadings")
def pca_loadings(spark, d):
    e = _embedding_columns(spark, d)
    return out(pca.loadings_table(e, pca.fit_pca(e, ["vec_id", "label"], 3)))


@query("pca_full_run")
def pca_full_run(spark, d):
    e = _embedding_columns(spark, d)
    train, test = split(e, "vec_id", "label", 0.2)
    done = pca.run_pca(train, test, ["vec_id"], "label")
    return out(done["train_with_label"])
