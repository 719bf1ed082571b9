"""Neighbours, density clustering, Relief and the imputation comparisons built on them."""
from __future__ import annotations

from pyspark.sql import functions as F

from tabulon.catalog.base import PARTS, longs, out, parts, query, table
from tabulon.operators import density, evaluate, impute, neighbors, ranking, sampling
from tabulon.plans import preprocess


def _customers(spark, d):
    return table(spark, d, "customer").select(
        "c_custkey", (F.col("c_nationkey") * 100.0).alias("nation"), F.col("c_acctbal").alias("balance"), "c_mktsegment")


_PAIRS = """c AS (SELECT c_custkey AS id, c_nationkey * 100.0::DOUBLE AS a, c_acctbal AS b, c_mktsegment AS seg FROM customer),
pairs AS (SELECT q.id AS query_id, r.id AS neighbor_id, r.seg AS seg, (q.a - r.a) * (q.a - r.a) + (q.b - r.b) * (q.b - r.b) AS s FROM c q, c r)"""


@query("nearest_neighbors", f"""WITH {_PAIRS}, k AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY s, neighbor_id) AS rank FROM pairs)
SELECT query_id, neighbor_id, rank, round(sqrt(s), 6) AS distance FROM k WHERE rank <= 5""")
def nearest_neighbors(spark, d):
    c = _customers(spark, d)
    return out(neighbors.nearest(c, c, ["nation", "balance"], 5, "c_custkey"))


@query("nearest_neighbors_manhattan", """WITH p AS (SELECT a.s_suppkey AS query_id, b.s_suppkey AS neighbor_id, abs(a.s_nationkey * 100.0::DOUBLE - b.s_nationkey * 100.0::DOUBLE) + abs(a.s_acctbal - b.s_acctbal) AS s FROM supplier a, supplier b),
k AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY s, neighbor_id) AS rank FROM p) SELECT query_id, neighbor_id, rank, round(s, 6) AS distance FROM k WHERE rank <= 3""")
def nearest_neighbors_manhattan(spark, d):
    s = table(spark, d, "supplier").select("s_suppkey", (F.col("s_nationkey") * 100.0).alias("n"), "s_acctbal")
    return out(neighbors.nearest(s, s, ["n", "s_acctbal"], 3, "s_suppkey", metric="manhattan"))


_SPLIT = """ranked AS (SELECT *, row_number() OVER (PARTITION BY p_type ORDER BY md5(concat_ws(':', p_partkey::VARCHAR, '42')), p_partkey) AS rn, count(*) OVER (PARTITION BY p_type) AS n FROM part),
train AS (SELECT * FROM ranked WHERE rn > round_even(n * 0.2, 0)), test AS (SELECT * FROM ranked WHERE rn <= round_even(n * 0.2, 0))"""
_NEAR = _SPLIT + """, near AS (SELECT * FROM (SELECT q.p_partkey AS id, q.p_type AS truth, r.p_type AS label, (q.p_size::DOUBLE - r.p_size) * (q.p_size::DOUBLE - r.p_size) + (q.p_retailprice - r.p_retailprice) * (q.p_retailprice - r.p_retailprice) AS s,
 row_number() OVER (PARTITION BY q.p_partkey ORDER BY (q.p_size::DOUBLE - r.p_size) * (q.p_size::DOUBLE - r.p_size) + (q.p_retailprice - r.p_retailprice) * (q.p_retailprice - r.p_retailprice), r.p_partkey) AS rank FROM test q, train r) WHERE rank <= 5),
votes AS (SELECT id, label, sum(CASE WHEN z THEN (s = 0)::INT::DOUBLE ELSE 1 / sqrt(s) END) AS w, count(*) AS u FROM (SELECT *, min(s) OVER (PARTITION BY id) = 0 AS z FROM near) GROUP BY ALL)"""


def _split_parts(spark, d):
    return sampling.split(table(spark, d, "part"), "p_partkey", "p_type", 0.2)


@query("knn_classify", f"""WITH {_NEAR} SELECT id AS p_partkey, label AS prediction FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY w DESC, label) AS r FROM (SELECT id, label, round(w / sum(w) OVER (PARTITION BY id), 12) AS w FROM votes)) WHERE r = 1""")
def knn_classify(spark, d):
    train, test = _split_parts(spark, d)
    return neighbors.classify(train, test, ["p_size", "p_retailprice"], "p_type", "p_partkey", 5)


@query("knn_classify_uniform", f"""WITH {_NEAR} SELECT id AS p_partkey, label AS prediction FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY u DESC, label) AS r FROM votes) WHERE r = 1""")
def knn_classify_uniform(spark, d):
    train, test = _split_parts(spark, d)
    return neighbors.classify(train, test, ["p_size", "p_retailprice"], "p_type", "p_partkey", 5, weights="uniform")


@query("knn_class_shares", f"WITH {_NEAR} SELECT id AS query_id, label AS p_type, round(w / sum(w) OVER (PARTITION BY id), 6) AS proba FROM votes")
def knn_class_shares(spark, d):
    train, test = _split_parts(spark, d)
    near = neighbors.nearest(test, train, ["p_size", "p_retailprice"], 5, "p_partkey", ["p_type"])
    return out(neighbors.class_shares(near, "p_type"))


@query("impute_knn", f"""WITH {PARTS}, near AS (SELECT * FROM (SELECT q.p_partkey AS id, r.p_size AS v, (q.p_retailprice - r.p_retailprice) * (q.p_retailprice - r.p_retailprice) AS s,
 row_number() OVER (PARTITION BY q.p_partkey ORDER BY (q.p_retailprice - r.p_retailprice) * (q.p_retailprice - r.p_retailprice), r.p_partkey) AS rank
 FROM (SELECT * FROM parts WHERE p_size IS NULL) q, (SELECT * FROM parts WHERE p_size IS NOT NULL AND p_type <> 'PROMO') r) WHERE rank <= 5),
est AS (SELECT id, sum(w * v) / sum(w) AS e FROM (SELECT id, v, CASE WHEN min(s) OVER (PARTITION BY id) = 0 THEN (s = 0)::INT::DOUBLE ELSE 1 / sqrt(s) END AS w FROM near) GROUP BY 1)
SELECT p_partkey, round(coalesce(p_size, greatest(e, 0)), 6) AS p_size FROM parts LEFT JOIN est ON id = p_partkey""")
def impute_knn(spark, d):
    p = parts(spark, d)
    done = impute.impute_knn(p.where("p_type <> 'PROMO'"), p, "p_size", "p_partkey", ["p_retailprice"], 5)
    return out(done.test.select("p_partkey", "p_size"))


@query("k_distances", f"""WITH {_PAIRS}, k AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY s, neighbor_id) AS rank FROM pairs)
SELECT query_id AS c_custkey, round(sqrt(s), 6) AS k_distance FROM k WHERE rank = 10""")
def k_distances(spark, d):
    return out(density.k_distances(_customers(spark, d), "c_custkey", ["nation", "balance"], 10))


@query("suggested_eps", f"""WITH {_PAIRS}, k AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY s, neighbor_id) AS rank FROM pairs)
SELECT round(quantile_cont(sqrt(s), 0.98), 6) AS eps FROM k WHERE rank = 10""")
def suggested_eps(spark, d):
    kd = density.k_distances(_customers(spark, d), "c_custkey", ["nation", "balance"], 10)
    return out(spark.createDataFrame([(density.suggest_eps(kd),)], "eps double"))


@query("prepared_continuous", f"""WITH {PARTS}, f AS (SELECT p_partkey, coalesce(p_size, (SELECT median(p_size) FROM parts)) AS s, p_retailprice AS r FROM parts), m AS (SELECT avg(s) AS ms, stddev_pop(s) AS ss, avg(r) AS mr, stddev_pop(r) AS sr FROM f)
SELECT p_partkey, round((s - ms) / ss, 6) + 0.0 AS p_size, round((r - mr) / sr, 6) + 0.0 AS p_retailprice FROM f, m""")
def prepared_continuous(spark, d):
    return out(density.prepare_continuous(parts(spark, d), "p_partkey", ["p_size", "p_retailprice"]))


_LINE = """c AS (SELECT event_id, value, count(*) OVER (ORDER BY value RANGE BETWEEN 0.505 PRECEDING AND 0.505 FOLLOWING) >= 12 AS core FROM events),
g AS (SELECT event_id, value, sum(new) OVER (ORDER BY value, event_id) AS grp FROM (SELECT *, CASE WHEN value - lag(value) OVER (ORDER BY value, event_id) <= 0.505 THEN 0 ELSE 1 END AS new FROM c WHERE core)),
n AS (SELECT grp, row_number() OVER (ORDER BY min(event_id)) - 1 AS cluster FROM g GROUP BY 1),
named AS (SELECT c.event_id, c.value, n.cluster FROM c LEFT JOIN g USING (event_id) LEFT JOIN n USING (grp)),
final AS (SELECT event_id, value, coalesce(cluster, min(cluster) OVER (ORDER BY value RANGE BETWEEN 0.505 PRECEDING AND 0.505 FOLLOWING), -1) AS cluster FROM named)"""


def _value_clusters(spark, d):
    e = table(spark, d, "events").select("event_id", "value")
    return e.join(density.dbscan(e, "event_id", ["value"], 0.505, 12), "event_id")


@query("density_clusters", f"WITH {_LINE} SELECT event_id, cluster, (cluster = -1)::BIGINT AS is_outlier FROM final")
def density_clusters(spark, d):
    return longs(_value_clusters(spark, d).select("event_id", "cluster", "is_outlier"))


@query("density_outlier_profile", f"""WITH {_LINE} SELECT (cluster = -1)::BIGINT AS is_outlier, count(*) AS n, round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM final), 2) AS pct, round(avg(value), 2) AS mean_value FROM final GROUP BY 1""")
def density_outlier_profile(spark, d):
    return longs(density.outlier_profile(_value_clusters(spark, d), "is_outlier", ["value"]))


@query("density_clusters_plane", """WITH RECURSIVE c AS (SELECT c_custkey AS id, c_nationkey * 100.0::DOUBLE AS a, c_acctbal AS b FROM customer),
near AS (SELECT q.id AS i, r.id AS j FROM c q, c r WHERE (q.a - r.a) * (q.a - r.a) + (q.b - r.b) * (q.b - r.b) <= 180.5 * 180.5),
core AS (SELECT i FROM near GROUP BY 1 HAVING count(*) >= 6), link AS (SELECT i, j FROM near WHERE i IN (FROM core) AND j IN (FROM core)),
reach AS (SELECT i AS src, i AS dst FROM core UNION SELECT src, j FROM reach JOIN link ON dst = i),
root AS (SELECT dst AS i, min(src) AS root FROM reach GROUP BY 1), named AS (SELECT i, dense_rank() OVER (ORDER BY root) - 1 AS cluster FROM root),
final AS (SELECT c.id AS i, coalesce(any_value(own.cluster), min(other.cluster), -1) AS cluster FROM c LEFT JOIN named own ON own.i = c.id LEFT JOIN near ON near.i = c.id LEFT JOIN named other ON other.i = near.j GROUP BY 1)
SELECT i AS c_custkey, cluster, (cluster = -1)::BIGINT AS is_outlier FROM final""")
def density_clusters_plane(spark, d):
    return longs(density.dbscan(_customers(spark, d), "c_custkey", ["nation", "balance"], 180.5, 6))


_FIVE = ["balance", "n_orders", "total", "mean_price", "largest"]
_FIVE_SQL = """t AS (SELECT o_custkey, count(*)::DOUBLE AS n_orders, sum(o_totalprice::DOUBLE) AS total, avg(o_totalprice::DOUBLE) AS mean_price, max(o_totalprice::DOUBLE) AS largest FROM orders GROUP BY 1),
c AS (SELECT c_custkey AS id, c_acctbal::DOUBLE AS balance, n_orders, total, mean_price, largest FROM customer LEFT JOIN t ON o_custkey = c_custkey),
f AS (SELECT id, """ + ", ".join(f"coalesce({c}, (SELECT median({c}) FROM c)) AS {c}" for c in _FIVE) + """ FROM c),
s AS (SELECT id, """ + ", ".join(f"({c} - (SELECT avg({c}) FROM f)) / (SELECT stddev_pop({c}) FROM f) AS {c}" for c in _FIVE) + """ FROM f),
pairs AS (SELECT q.id AS i, r.id AS j, """ + " + ".join(f"(q.{c} - r.{c}) * (q.{c} - r.{c})" for c in _FIVE) + """ AS d FROM s q, s r),
kd AS (SELECT sqrt(d) AS d FROM (SELECT d, row_number() OVER (PARTITION BY i ORDER BY d, j) AS rank FROM pairs) WHERE rank = 10),
eps AS (SELECT quantile_cont(d, 0.98) AS e FROM kd), near AS (SELECT i, j FROM pairs, eps WHERE d <= e * e),
core AS (SELECT i FROM near GROUP BY 1 HAVING count(*) >= 10), link AS (SELECT i, j FROM near WHERE i IN (FROM core) AND j IN (FROM core)),
reach AS (SELECT i AS src, i AS dst FROM core UNION SELECT src, j FROM reach JOIN link ON dst = i),
root AS (SELECT dst AS i, min(src) AS root FROM reach GROUP BY 1), named AS (SELECT i, dense_rank() OVER (ORDER BY root) - 1 AS cluster FROM root),
final AS (SELECT id, coalesce(any_value(own.cluster), min(other.cluster), -1) AS cluster FROM s LEFT JOIN named own ON own.i = id LEFT JOIN near ON near.i = id LEFT JOIN named other ON other.i = near.j GROUP BY 1)"""


def _five_columns(spark, d):
    orders = table(spark, d, "orders").withColumn("p", F.col("o_totalprice").cast("double")).groupBy("o_custkey").agg(
        F.count("*").cast("double").alias("n_orders"), F.sum("p").alias("total"), F.avg("p").alias("mean_price"),
        F.max("p").alias("largest"))
    c = table(spark, d, "customer")
    return c.join(orders, c.c_custkey == orders.o_custkey, "left").select(
        F.col("c_custkey").alias("id"), F.col("c_acctbal").cast("double").alias("balance"), *_FIVE[1:])


@query("density_outlier_run", f"WITH RECURSIVE {_FIVE_SQL} SELECT id, cluster, (cluster = -1)::BIGINT AS is_outlier FROM final")
def density_outlier_run(spark, d):
    return longs(density.density_outliers(_five_columns(spark, d), "id", _FIVE)["rows"].select("id", "cluster", "is_outlier"))


@query("density_outlier_run_profile", f"WITH RECURSIVE {_FIVE_SQL} SELECT (cluster = -1)::BIGINT AS is_outlier, count(*) AS n, round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM c), 2) AS pct, "
       + ", ".join(f"round(avg({c}), 2) AS mean_{c}" for c in _FIVE) + " FROM final JOIN c USING (id) GROUP BY 1")
def density_outlier_run_profile(spark, d):
    return longs(density.density_outliers(_five_columns(spark, d), "id", _FIVE)["profile"])


_RELIEF = """base AS (SELECT c_custkey AS id, c_mktsegment AS y, (c_acctbal - (SELECT min(c_acctbal) FROM customer)) / (SELECT max(c_acctbal) - min(c_acctbal) FROM customer) AS balance,
 (c_nationkey::DOUBLE - (SELECT min(c_nationkey) FROM customer)) / (SELECT max(c_nationkey) - min(c_nationkey) FROM customer) AS nation FROM customer),
near AS (SELECT * FROM (SELECT q.id AS q, r.id AS r, q.y = r.y AS hit, (q.balance - r.balance) * (q.balance - r.balance) AS gb, (q.nation - r.nation) * (q.nation - r.nation) AS gn,
 row_number() OVER (PARTITION BY q.id ORDER BY (q.balance - r.balance) * (q.balance - r.balance) + (q.nation - r.nation) * (q.nation - r.nation), r.id) AS rank FROM base q, base r) WHERE rank <= 50 AND q <> r),
f AS (SELECT q, arg_min(gb, rank) FILTER (hit) AS hb, arg_min(gb, rank) FILTER (NOT hit) AS mb, arg_min(gn, rank) FILTER (hit) AS hn, arg_min(gn, rank) FILTER (NOT hit) AS mn FROM near GROUP BY 1),
ok AS (SELECT * FROM f WHERE hb IS NOT NULL AND mb IS NOT NULL)"""


def _relief(spark, d, **options):
    c = table(spark, d, "customer").select("c_custkey", "c_mktsegment", F.col("c_acctbal").alias("balance"),
                                           F.col("c_nationkey").alias("nation"))
    return ranking.relief(c, "c_custkey", "c_mktsegment", **options)


@query("relief_ranking", f"""WITH {_RELIEF} SELECT 'balance' AS feature, round(avg(mb - hb), 8) + 0.0 AS relief_weight, round(abs(avg(mb - hb)), 8) AS abs_relief_weight FROM ok
UNION ALL SELECT 'nation', round(avg(mn - hn), 8) + 0.0, round(abs(avg(mn - hn)), 8) FROM ok""")
def relief_ranking(spark, d):
    return out(_relief(spark, d, n_iterations=None)["ranking"], 8)


@query("relief_sampled", f"""WITH {_RELIEF}, no AS (SELECT c_custkey AS id, row_number() OVER (ORDER BY c_custkey) AS no FROM customer),
draws AS (SELECT id AS q FROM range(2000) t(range) JOIN no ON no.no = ('0x' || substr(md5(concat_ws(':', range::VARCHAR, '42')), 1, 15))::BIGINT % (SELECT count(*) FROM customer) + 1)
SELECT 'balance' AS feature, round(avg(mb - hb), 8) + 0.0 AS relief_weight, round(abs(avg(mb - hb)), 8) AS abs_relief_weight FROM ok JOIN draws USING (q)
UNION ALL SELECT 'nation', round(avg(mn - hn), 8) + 0.0, round(abs(avg(mn - hn)), 8) FROM ok JOIN draws USING (q)""")
def relief_sampled(spark, d):
    return out(_relief(spark, d, n_iterations=2000, encode=False)["ranking"], 8)


@query("relief_summary", f"""WITH {_RELIEF} SELECT (SELECT count(*) FROM customer) AS n_samples, 2::BIGINT AS n_features, (SELECT count(*) FROM customer) AS n_draws, count(*) AS n_valid, 50::BIGINT AS k FROM ok""")
def relief_summary(spark, d):
    return longs(_relief(spark, d, n_iterations=None)["summary"])


_HOLDOUT = f"""{PARTS}, filled AS (SELECT p_partkey AS id, coalesce(p_size::DOUBLE, (SELECT avg(p_size) FROM parts)) AS a, p_retailprice AS b, p_brand, p_type AS y FROM parts),
ranked AS (SELECT *, row_number() OVER (PARTITION BY y ORDER BY md5(concat_ws(':', id::VARCHAR, '42')), id) AS rn, count(*) OVER (PARTITION BY y) AS n FROM filled),
tr AS (SELECT * FROM ranked WHERE rn > round_even(n * 0.2, 0)), te AS (SELECT * FROM ranked WHERE rn <= round_even(n * 0.2, 0)),
sd AS (SELECT stddev_pop(a) AS sa, stddev_pop(b) AS sb FROM tr),
br AS (SELECT p_brand, (count(*)::DOUBLE / (SELECT count(*) FROM tr)) AS f FROM tr GROUP BY 1), bv AS (SELECT p_brand, 1 / (f * (1 - f)) AS v FROM br),
pr AS (SELECT q.id, q.y AS truth, r.id AS r, r.y, ((q.a - r.a) / sa) ** 2 + ((q.b - r.b) / sb) ** 2 + CASE WHEN q.p_brand = r.p_brand THEN 0 ELSE coalesce(x.v, 1) + z.v END AS s
 FROM te q, tr r, sd, bv x, bv z WHERE x.p_brand = q.p_brand AND z.p_brand = r.p_brand),
nn AS (SELECT *, min(s) OVER (PARTITION BY id) = 0 AS zero FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY s, r) AS rank FROM pr) WHERE rank <= 5),
v AS (SELECT id, truth, y, sum(CASE WHEN zero THEN (s = 0)::INT::DOUBLE ELSE 1 / sqrt(s) END) AS w FROM nn GROUP BY ALL),
p AS (SELECT id, truth, y, row_number() OVER (PARTITION BY id ORDER BY w DESC, y) AS o FROM (SELECT id, truth, y, round(w / sum(w) OVER (PARTITION BY id), 12) AS w FROM v))"""


@query("imputation_holdout_accuracy", f"WITH {_HOLDOUT} SELECT round(avg((truth = y)::INT), 6) AS accuracy, count(*) AS n FROM p WHERE o = 1")
def imputation_holdout_accuracy(spark, d):
    p = parts(spark, d)
    done = impute.impute_mean(p, p, "p_size").train
    got = preprocess.knn_accuracy(done, "p_partkey", "p_type")
    return out(spark.createDataFrame([(got["accuracy"], got["n_valid"])], "accuracy double, n bigint"))


def _labelled_parts(spark, d):
    p = parts(spark, d)
    labels = table(spark, d, "part").select("p_partkey", F.substring("p_brand", 7, 2).cast("int").alias("brand_no"))
    return p.select("p_partkey", "p_size", "p_retailprice", "p_type"), labels


@query("imputation_comparison")
def imputation_comparison(spark, d):
    train, labels = _labelled_parts(spark, d)
    return out(preprocess.compare_imputations(train, labels, "p_size", "p_partkey", "brand_no", max_rows=None))


@query("imputation_auto_choice")
def imputation_auto_choice(spark, d):
    train, labels = _labelled_parts(spark, d)
    train = train.withColumn("p_retailprice", F.when(F.col("p_retailprice") < 1500, F.col("p_retailprice")))
    best, results = preprocess.choose_imputation(train, labels, ["p_size", "p_retailprice"], "p_partkey", "brand_no",
                                                 max_rows=None)
    return out(evaluate.strategy_summary(results).withColumn("is_best", F.col("strategy") == best))


@query("multiplier_comparison")
def multiplier_comparison(spark, d):
    c = table(spark, d, "customer")
    results = preprocess.compare_multipliers(
        c.select("c_custkey", "c_acctbal", "c_nationkey"), c.select("c_custkey", "c_mktsegment"), ["c_acctbal"],
        "c_custkey", "c_mktsegment")
    return out(results.withColumn("is_best", F.col("k") == preprocess.best_multiplier(results)))
