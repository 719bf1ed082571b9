"""Outliers, imputation, sampling, rankings, evaluation and decision-profile rules."""
from __future__ import annotations

from pyspark.sql import functions as F

from tabulon.catalog.base import HOMES, PARTS, homes, longs, out, parts, query, table
from tabulon.operators import ensemble, evaluate, impute, order, outliers, pca, quality, ranking, sampling, selection

# ---- outliers --------------------------------------------------------------------------------------------

_IQR = """q AS (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM {t}),
b AS (SELECT q1, q3, q3 - q1 AS iqr, greatest(0.0, q1 - {k} * (q3 - q1)) AS lo, q3 + {k} * (q3 - q1) AS hi FROM q)"""


@query("iqr_outlier_report", f"""WITH {_IQR.format(c='value', t='events', k=3.0)}
SELECT 'value' AS "column", round_even(q1, 2) AS q1, round_even(q3, 2) AS q3, round_even(iqr, 2) AS iqr, round_even(lo, 2) AS lower_bound, round_even(hi, 2) AS upper_bound,
 (SELECT count(*) FROM events WHERE value < lo OR value > hi) AS n_outliers,
 round_even((SELECT count(*) FROM events WHERE value < lo OR value > hi) * 100.0::DOUBLE / (SELECT count(*) FROM events), 2) AS perc_outliers FROM b""")
def iqr_outlier_report(spark, d):
    return outliers.iqr_report(table(spark, d, "events"), ["value"], k=3.0)


@query("quality_checks", f"""WITH {_IQR.format(c='value', t='events', k=3.0)},
d AS (SELECT count(*) - count(DISTINCT user_id) AS n_duplicates FROM events)
SELECT 'value' AS "column", (SELECT n_duplicates FROM d) AS n_duplicates, round_even(lo, 2) AS lower_bound, round_even(hi, 2) AS upper_bound,
 (SELECT count(*) FROM events WHERE value < lo OR value > hi) AS n_outliers FROM b""")
def quality_checks(spark, d):
    """The quality driver: normalised names, later occurrences of a key and the outlier report."""
    raw = table(spark, d, "events").select(F.col("user_id").alias(" USER_ID"), F.col("value").alias(" Value "))
    _, keys, report = quality.run_checks(raw, "user_id", ["value"])
    return report.withColumn("n_duplicates", F.lit(keys.first()["n_duplicates"])).select(
        "column", "n_duplicates", "lower_bound", "upper_bound", "n_outliers")


@query("iqr_floored_bounds", f"""WITH {_IQR.format(c='c_acctbal', t='customer', k=1.5)}
SELECT 'c_acctbal' AS "column", round(q1, 6) AS q1, round(q3, 6) AS q3, round(iqr, 6) AS iqr, round(lo, 6) AS lower_bound, round(hi, 6) AS upper_bound,
 (SELECT count(*) FROM customer WHERE c_acctbal < lo OR c_acctbal > hi) AS n_outliers,
 round((SELECT count(*) FROM customer WHERE c_acctbal < lo OR c_acctbal > hi) * 100.0::DOUBLE / (SELECT count(*) FROM customer), 6) AS perc_outliers FROM b""")
def iqr_floored_bounds(spark, d):
    return out(outliers.iqr_report(table(spark, d, "customer"), ["c_acctbal"], k=1.5, digits=None))


_FLAT = """flat AS (SELECT CASE WHEN l_quantity = 50 AND l_discount >= 0.08 THEN l_linenumber + 1 WHEN l_tax = 0.08 THEN 2 ELSE 1 END AS units FROM lineitem)"""


@query("rare_value_outliers", f"""WITH {_FLAT}, f AS (SELECT units, count(*) AS c, count(*)::DOUBLE / (SELECT count(*) FROM flat) AS share FROM flat GROUP BY 1)
SELECT 'units' AS "column", 1.0::DOUBLE AS q1, 1.0::DOUBLE AS q3, 0.0::DOUBLE AS iqr, min(units) FILTER (share >= 0.005)::DOUBLE AS lower_bound, max(units) FILTER (share >= 0.005)::DOUBLE AS upper_bound,
 coalesce(sum(c) FILTER (share < 0.005), 0)::BIGINT AS n_outliers, round(coalesce(sum(c) FILTER (share < 0.005), 0) * 100.0::DOUBLE / sum(c), 6) AS perc_outliers FROM f""")
def rare_value_outliers(spark, d):
    li = table(spark, d, "lineitem").select(
        F.when((F.col("l_quantity") == 50) & (F.col("l_discount") >= 0.08), F.col("l_linenumber") + 1)
        .when(F.col("l_tax") == 0.08, 2).otherwise(1).alias("units"))
    return out(outliers.iqr_report(li, ["units"], digits=None))


@query("replace_outliers_train_bounds", f"""WITH {_IQR.format(c='value', t="(SELECT value FROM events WHERE event_type <> 'error')", k=3.0)}
SELECT event_id, CASE WHEN value BETWEEN round_even(lo, 2) AND round_even(hi, 2) THEN value END AS value FROM events, b""")
def replace_outliers_train_bounds(spark, d):
    e = table(spark, d, "events").select("event_id", "event_type", "value")
    _, test, _ = outliers.replace_outliers(e.where("event_type <> 'error'"), e, ["value"])
    return test.select("event_id", "value")


_KS = "(VALUES (1.5), (2.0), (2.5), (3.0), (4.0))"


@query("iqr_multiplier_sweep", f"""WITH q AS (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events),
b AS (SELECT k::DOUBLE AS k, greatest(0.0, q1 - k * (q3 - q1)) AS lo, q3 + k * (q3 - q1) AS hi FROM q, {_KS} t(k)),
r AS (SELECT k, any_value(lo) AS lo, any_value(hi) AS hi, count(*) FILTER (value < lo OR value > hi) AS n_outliers, count(*) AS n,
 median(value) FILTER (value BETWEEN round_even(lo, 2) AND round_even(hi, 2)) AS m, count(*) FILTER (NOT value BETWEEN round_even(lo, 2) AND round_even(hi, 2)) AS n_filled
 FROM b, events GROUP BY k)
SELECT k, 'value' AS "column", round_even(lo, 2) AS lower_bound, round_even(hi, 2) AS upper_bound, n_outliers, round_even(n_outliers * 100.0::DOUBLE / n, 2) AS perc_outliers, round(m, 6) AS fill_median, n_filled FROM r""")
def iqr_multiplier_sweep(spark, d):
    return out(outliers.sweep(table(spark, d, "events"), ["value"]))


# ---- imputation ---------------------------------------------------------------------------------------------

def _train_test(spark, d):
    p = parts(spark, d)
    return p.where("p_type <> 'PROMO'"), p


def _fill_sql(expr: str) -> str:
    return f"""WITH {PARTS}, train AS (SELECT * FROM parts WHERE p_type <> 'PROMO')
SELECT p_partkey, round(coalesce(p_size, (SELECT {expr} FROM train)), 6) AS p_size FROM parts"""


@query("impute_mean", _fill_sql("avg(p_size)"))
def impute_mean(spark, d):
    return out(impute.impute_mean(*_train_test(spark, d), "p_size").test.select("p_partkey", "p_size"))


@query("impute_median", _fill_sql("median(p_size)"))
def impute_median(spark, d):
    return out(impute.impute_median(*_train_test(spark, d), "p_size").test.select("p_partkey", "p_size"))


@query("impute_mean_and_median", f"""WITH {PARTS}, train AS (SELECT * FROM parts WHERE p_type <> 'PROMO')
SELECT p_partkey, round(coalesce(p_size, (SELECT avg(p_size) FROM train)), 6) AS by_mean, round(coalesce(p_size, (SELECT median(p_size) FROM train)), 6) AS by_median FROM parts""")
def impute_mean_and_median(spark, d):
    got = impute.impute_mean_median(*_train_test(spark, d), "p_size")
    a = got["mean"].test.select("p_partkey", F.col("p_size").alias("by_mean"))
    return out(a.join(got["median"].test.select("p_partkey", F.col("p_size").alias("by_median")), "p_partkey"))


def _geo_prices(spark, d):
    h = homes(spark, d).select("id", "geo1", "geo2", "geo3", "segment",
                               F.when(F.col("price") < 400000, F.col("price")).alias("price"))
    return h.where("segment <> 'BUILDING'"), h


_GEO = f"""{HOMES}, g AS (SELECT id, geo1, geo2, geo3, segment, CASE WHEN price < 400000 THEN price END AS price FROM homes),
train AS (SELECT * FROM g WHERE segment <> 'BUILDING'),
m3 AS (SELECT geo1, geo2, geo3, median(price) AS m FROM train GROUP BY ALL HAVING count(price) > 0),
m2 AS (SELECT geo1, geo2, median(price) AS m FROM train GROUP BY ALL HAVING count(price) > 0),
m1 AS (SELECT geo1, median(price) AS m FROM train GROUP BY ALL HAVING count(price) > 0),
filled AS (SELECT id, CASE WHEN price IS NOT NULL THEN 0 WHEN m3.m IS NOT NULL THEN 1 WHEN m2.m IS NOT NULL THEN 2 WHEN m1.m IS NOT NULL THEN 3 ELSE 4 END::BIGINT AS level,
 round(coalesce(price, m3.m, m2.m, m1.m, (SELECT median(price) FROM train)), 4) AS price
 FROM g LEFT JOIN m3 USING (geo1, geo2, geo3) LEFT JOIN m2 USING (geo1, geo2) LEFT JOIN m1 USING (geo1))"""
_LEVELS = [["geo1", "geo2", "geo3"], ["geo1", "geo2"], ["geo1"]]


@query("group_medians", f"WITH {_GEO} SELECT geo1::BIGINT AS geo1, geo2::BIGINT AS geo2, round(m, 4) AS median FROM m2")
def group_medians(spark, d):
    train, _ = _geo_prices(spark, d)
    return out(impute.group_medians(train, "price", _LEVELS)[1], 4)


@query("hierarchical_fill", f"WITH {_GEO} SELECT id, level, price FROM filled")
def hierarchical_fill(spark, d):
    train, test = _geo_prices(spark, d)
    tables = impute.group_medians(train, "price", _LEVELS)
    overall = order.fit_medians(train, ["price"])["price"]
    return out(impute.apply_group_medians(test, "price", tables, overall, "level").select("id", "level", "price"), 4)


@query("hierarchical_fill_counts", f"WITH {_GEO} SELECT level, count(*) AS n FROM filled GROUP BY 1")
def hierarchical_fill_counts(spark, d):
    return hierarchical_fill(spark, d).groupBy("level").agg(F.count("*").alias("n"))


@query("impute_group_median", f"WITH {_GEO} SELECT id, price FROM filled")
def impute_group_median(spark, d):
    return out(impute.impute_group_median(*_geo_prices(spark, d), "price", _LEVELS).test.select("id", "price"), 4)


_LINEAR = f"""WITH {PARTS}, train AS (SELECT * FROM parts WHERE p_type <> 'PROMO'),
m AS (SELECT regr_slope(p_size, p_retailprice) AS a, regr_intercept(p_size, p_retailprice) AS b FROM train)"""


@query("impute_linear", _LINEAR + """ SELECT p_partkey, round(coalesce(p_size, greatest(a * p_retailprice + b, 0)), 5) AS p_size FROM parts, m""")
def impute_linear(spark, d):
    done = impute.impute_linear(*_train_test(spark, d), "p_size", features=["p_retailprice"])
    return out(done.test.select("p_partkey", "p_size"), 5)


@query("imputed_statistics", _LINEAR + """, f AS (SELECT greatest(a * p_retailprice + b, 0) AS v FROM parts, m WHERE p_size IS NULL)
SELECT count(*) AS n_imputed, round(avg(v), 5) AS mean_imputed, round(median(v), 5) AS median_imputed, round(min(v), 5) AS min_imputed, round(max(v), 5) AS max_imputed FROM f""")
def imputed_statistics(spark, d):
    done = impute.impute_linear(*_train_test(spark, d), "p_size", features=["p_retailprice"], flag="was_null")
    return out(impute.imputed_stats(done.test, "p_size", "was_null"), 5)


@query("imputation_null_report", f"""WITH {PARTS}, train AS (SELECT * FROM parts WHERE p_type <> 'PROMO')
SELECT 'mean' AS strategy, 'p_size' AS "column", (SELECT count(*) - count(p_size) FROM train) AS missing_train_before, 0::BIGINT AS missing_train_after,
 (SELECT count(*) - count(p_size) FROM parts) AS missing_test_before, 0::BIGINT AS missing_test_after""")
def imputation_null_report(spark, d):
    before = _train_test(spark, d)
    return impute.null_report(before, impute.impute(*before, "p_size", "1", "p_partkey"))


@query("residual_fill", f"""WITH {PARTS}, train AS (SELECT * FROM parts WHERE p_type <> 'PROMO')
SELECT p_partkey, round(coalesce(p_size, (SELECT median(p_size) FROM train), 0), 6) AS p_size, round(coalesce(empty_col, 0), 6) AS empty_col
FROM (SELECT p_partkey, p_size, CASE WHEN p_type = 'PROMO' THEN p_retailprice END AS empty_col FROM parts)""")
def residual_fill(spark, d):
    p = parts(spark, d).withColumn("empty_col", F.when(F.col("p_type") == "PROMO", F.col("p_retailprice")))
    fitted = order.fit_medians(p.where("p_type <> 'PROMO'"), ["p_size", "empty_col"])
    return out(impute.fill_medians(p, fitted, 0.0).select("p_partkey", "p_size", "empty_col"))


# ---- sampling ------------------------------------------------------------------------------------------------

_RANKED = "SELECT o_orderkey, o_orderstatus, row_number() OVER (PARTITION BY o_orderstatus ORDER BY md5(concat_ws(':', o_orderkey::VARCHAR, '42')), o_orderkey) AS rn, count(*) OVER (PARTITION BY o_orderstatus) AS n FROM orders"


@query("balanced_sample", f"SELECT o_orderkey, o_orderstatus FROM ({_RANKED}) WHERE rn <= 500")
def balanced_sample(spark, d):
    return sampling.balanced_sample(table(spark, d, "orders"), "o_orderkey", "o_orderstatus", 500).select(
        "o_orderkey", "o_orderstatus")


@query("stratified_sample", f"SELECT o_orderkey, o_orderstatus FROM ({_RANKED}) WHERE rn <= round_even(n::DOUBLE / (SELECT count(*) FROM orders) * 1000.0, 0)")
def stratified_sample(spark, d):
    return sampling.stratified_sample(table(spark, d, "orders"), "o_orderkey", "o_orderstatus", 1000).select(
        "o_orderkey", "o_orderstatus")


@query("uniform_sample", "SELECT event_id FROM events ORDER BY md5(concat_ws(':', event_id::VARCHAR, '7')), event_id LIMIT 700")
def uniform_sample(spark, d):
    return sampling.uniform_sample(table(spark, d, "events"), "event_id", 700, seed=7).select("event_id")


@query("full_shuffle", "SELECT event_id, row_number() OVER (ORDER BY md5(concat_ws(':', event_id::VARCHAR, '42')), event_id) AS shuffle_no FROM events")
def full_shuffle(spark, d):
    return sampling.shuffled(table(spark, d, "events"), "event_id").select("event_id", "shuffle_no")


@query("stratified_row_cap", f"""WITH r AS ({_RANKED}), c AS (SELECT o_orderstatus, any_value(n) AS n, 1000.0::DOUBLE * any_value(n) / (SELECT count(*) FROM orders) AS e FROM r GROUP BY 1),
a AS (SELECT o_orderstatus, floor(e) + CASE WHEN row_number() OVER (ORDER BY e - floor(e) DESC, o_orderstatus) <= 1000 - sum(floor(e)) OVER () THEN 1 ELSE 0 END AS q FROM c)
SELECT o_orderkey, o_orderstatus FROM r JOIN a USING (o_orderstatus) WHERE rn <= q""")
def stratified_row_cap(spark, d):
    return sampling.cap_rows(table(spark, d, "orders"), "o_orderkey", "o_orderstatus", 1000).select(
        "o_orderkey", "o_orderstatus")


@query("stratified_split", f"SELECT o_orderkey, (rn <= round_even(n * 0.2, 0))::BIGINT AS is_test FROM ({_RANKED})")
def stratified_split(spark, d):
    return longs(sampling.mark_split(table(spark, d, "orders"), "o_orderkey", "o_orderstatus", 0.2).select(
        "o_orderkey", "is_test"))


@query("stratified_folds_ordered", "SELECT o_orderkey, ntile(5) OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey) - 1 AS fold FROM orders")
def stratified_folds_ordered(spark, d):
    return longs(sampling.stratified_folds(table(spark, d, "orders"), "o_orderkey", "o_orderstatus", 5, shuffle=False)
                 .select("o_orderkey", "fold"))


@query("stratified_folds_shuffled", "SELECT o_orderkey, ntile(3) OVER (PARTITION BY o_orderstatus ORDER BY md5(concat_ws(':', o_orderkey::VARCHAR, '42')), o_orderkey) - 1 AS fold FROM orders")
def stratified_folds_shuffled(spark, d):
    return longs(sampling.stratified_folds(table(spark, d, "orders"), "o_orderkey", "o_orderstatus", 3).select(
        "o_orderkey", "fold"))


@query("draws_with_replacement", """WITH n AS (SELECT event_id, row_number() OVER (ORDER BY event_id) AS no FROM events),
t AS (SELECT range AS draw, ('0x' || substr(md5(concat_ws(':', range::VARCHAR, '42')), 1, 15))::BIGINT % (SELECT count(*) FROM events) + 1 AS no FROM range(2000))
SELECT draw, event_id FROM t JOIN n USING (no)""")
def draws_with_replacement(spark, d):
    return sampling.draw_with_replacement(table(spark, d, "events").select("event_id"), "event_id", 2000).select(
        "draw", "event_id")


# ---- information gain ------------------------------------------------------------------------------------------

@query("target_entropy", """SELECT round(-sum(p * log2(p)), 6) AS entropy FROM (SELECT count(*)::DOUBLE / (SELECT count(*) FROM orders) AS p FROM orders GROUP BY o_orderpriority)""")
def target_entropy(spark, d):
    return out(ranking.entropy(table(spark, d, "orders"), "o_orderpriority"))


_IG_COLS = ["geo1", "geo2", "geo3", "priority", "segment"]


def _ig_sql(cols: list[str], base: str) -> str:
    cells = " UNION ALL ".join(f"SELECT '{c}' AS feature, {c}::VARCHAR AS x, y FROM {base}" for c in cols)
    return f"""cells AS ({cells}), known AS (SELECT * FROM cells WHERE x IS NOT NULL AND y IS NOT NULL),
xy AS (SELECT feature, x, y, count(*)::DOUBLE AS c FROM known GROUP BY ALL),
hx AS (SELECT feature, x, sum(c) AS cx FROM xy GROUP BY ALL),
n AS (SELECT feature, sum(cx) AS n, count(*) AS u FROM hx GROUP BY 1),
hyx AS (SELECT xy.feature, -sum(c / n.n * log2(c / cx)) AS v FROM xy JOIN hx USING (feature, x) JOIN n ON n.feature = xy.feature GROUP BY 1),
hy AS (SELECT feature, -sum(cy / n * log2(cy / n)) AS v FROM (SELECT feature, y, sum(c) AS cy FROM xy GROUP BY ALL) JOIN n USING (feature) GROUP BY 1),
ig AS (SELECT feature, round(hy.v, 6) + 0.0 AS target_entropy, round(hyx.v, 6) + 0.0 AS conditional_entropy, round(hy.v - hyx.v, 6) + 0.0 AS information_gain,
 n.n::BIGINT AS n_samples, n.u AS n_unique_values FROM n JOIN hy USING (feature) JOIN hyx USING (feature))"""


_IG = f"WITH {HOMES}, base AS (SELECT geo1, geo2, geo3, priority, segment, status AS y FROM homes), {_ig_sql(_IG_COLS, 'base')}"


@query("information_gain_ranking", _IG + " SELECT * FROM ig")
def information_gain_ranking(spark, d):
    h = homes(spark, d)
    return out(ranking.rank_information_gain(h, "status", exclude=["id"])["ranking"])


@query("conditional_entropy", _IG + " SELECT feature, conditional_entropy FROM ig")
def conditional_entropy(spark, d):
    return out(ranking.information_gain(homes(spark, d), "status", _IG_COLS).select("feature", "conditional_entropy"))


@query("information_gain_with_nulls", f"""WITH {PARTS}, base AS (SELECT p_size, p_brand, p_type AS y FROM parts), {_ig_sql(['p_size', 'p_brand'], 'base')}
SELECT * FROM ig""")
def information_gain_with_nulls(spark, d):
    return out(ranking.information_gain(parts(spark, d), "p_type", ["p_size", "p_brand"]))


@query("information_gain_summary", f"""WITH {HOMES} SELECT 'status' AS label_column, 7::BIGINT AS n_feature_candidates, 5::BIGINT AS n_discrete_features, 2::BIGINT AS n_skipped_non_discrete,
 round(-sum(p * log2(p)), 6) AS target_entropy_global, 2.0::DOUBLE AS log_base FROM (SELECT count(*)::DOUBLE / (SELECT count(*) FROM homes) AS p FROM homes GROUP BY status)""")
def information_gain_summary(spark, d):
    return out(ranking.rank_information_gain(homes(spark, d), "status", exclude=["id"])["summary"])


@query("information_gain_few_valued", f"""WITH base AS (SELECT l_quantity, l_discount, l_tax, l_linenumber, l_linestatus, l_returnflag AS y FROM lineitem),
{_ig_sql(['l_quantity', 'l_discount', 'l_tax', 'l_linenumber', 'l_linestatus'], 'base')} SELECT feature, greatest(information_gain, 0) AS information_gain, n_unique_values FROM ig""")
def information_gain_few_valued(spark, d):
    li = table(spark, d, "lineitem").select("l_quantity", "l_discount", "l_tax", "l_linenumber", "l_linestatus",
                                            "l_returnflag", "l_extendedprice")
    got = ranking.rank_information_gain(li, "l_returnflag", few_valued_too=True)["ranking"]
    return out(got.select("feature", "information_gain", "n_unique_values"))


@query("top_features", _IG + " SELECT feature, information_gain FROM ig ORDER BY information_gain DESC, feature LIMIT 2")
def top_features(spark, d):
    got = ranking.information_gain(homes(spark, d), "status", _IG_COLS).select("feature", "information_gain")
    return out(ranking.head(got, "information_gain", 2))


# ---- correlation -----------------------------------------------------------------------------------------------

_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"]


def _lines(spark, d):
    li = table(spark, d, "lineitem")
    return li.select(*_NUM, "l_returnflag")


def _corr_pairs(cols: list[str], base: str) -> str:
    return " UNION ALL ".join(f"SELECT '{a}' AS feature_1, '{b}' AS feature_2, corr({a}::DOUBLE, {b}::DOUBLE) AS corr FROM {base}"
                              for i, a in enumerate(cols) for b in cols[i + 1:])


_CORR = f"""WITH base AS (SELECT {', '.join(_NUM)}, (CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END) AS y FROM lineitem),
pairs AS ({_corr_pairs([*_NUM, 'y'], 'base')}),
both_ways AS (SELECT feature_1 AS feature, feature_2 AS other, corr FROM pairs UNION ALL SELECT feature_2, feature_1, corr FROM pairs),
red AS (SELECT feature, avg(abs(corr)) AS mean_abs, max(abs(corr)) AS max_abs FROM both_ways WHERE feature <> 'y' AND other <> 'y' GROUP BY 1),
sup AS (SELECT feature, corr FROM both_ways WHERE other = 'y')"""


@query("correlation_matrix", _CORR + " SELECT feature, other, round(corr, 6) + 0.0 AS corr FROM both_ways WHERE feature <> 'y' AND other <> 'y'")
def correlation_matrix(spark, d):
    return out(ranking.correlation_matrix(ranking.correlations(_lines(spark, d), _NUM)))


@query("redundancy_ranking", _CORR + " SELECT feature, round(mean_abs, 6) AS mean_abs_corr_with_other_features, round(max_abs, 6) AS max_abs_corr_with_other_features FROM red")
def redundancy_ranking(spark, d):
    return out(ranking.rank_correlations(_lines(spark, d).drop("l_returnflag"))["redundancy"])


@query("supervised_ranking", _CORR + " SELECT feature, round(corr, 6) + 0.0 AS corr_with_label, round(abs(corr), 6) AS abs_corr_with_label FROM sup")
def supervised_ranking(spark, d):
    return out(ranking.rank_correlations(_lines(spark, d), "l_returnflag")["supervised"])


@query("combined_ranking", _CORR + """ SELECT feature, round(mean_abs, 6) AS mean_abs_corr_with_other_features, round(max_abs, 6) AS max_abs_corr_with_other_features,
 round(corr, 6) + 0.0 AS corr_with_label, round(abs(corr), 6) AS abs_corr_with_label, round(abs(corr) - mean_abs, 6) + 0.0 AS balance_score FROM red JOIN sup USING (feature)""")
def combined_ranking(spark, d):
    return out(ranking.rank_correlations(_lines(spark, d), "l_returnflag")["combined"])


@query("top_correlated_pairs", _CORR + """ SELECT feature_1, feature_2, round(corr, 6) + 0.0 AS corr, round(abs(corr), 6) AS abs_corr FROM pairs
WHERE feature_2 <> 'y' ORDER BY abs(corr) DESC LIMIT 4""")
def top_correlated_pairs(spark, d):
    return out(ranking.top_pairs(ranking.correlations(_lines(spark, d), _NUM), 4))


@query("correlation_with_nulls", f"""WITH {PARTS} SELECT round(corr(p_size, p_retailprice), 6) AS corr FROM parts""")
def correlation_with_nulls(spark, d):
    p = parts(spark, d).withColumn("constant", F.lit(1.0))
    return out(ranking.correlations(p, ["p_size", "p_retailprice", "constant"]).where("corr IS NOT NULL").select("corr"))


_EMB = 64


@query("wide_correlations", f"""WITH e AS (SELECT vec_id, i, embedding[i]::DOUBLE AS v FROM embeddings, range(1, {_EMB + 1}) t(i))
SELECT 'e' || (a.i - 1) AS feature_1, 'e' || (b.i - 1) AS feature_2, round(corr(a.v, b.v), 6) + 0.0 AS corr FROM e a JOIN e b ON a.vec_id = b.vec_id AND a.i < b.i GROUP BY a.i, b.i""")
def wide_correlations(spark, d):
    e = table(spark, d, "embeddings").select(*[F.col("embedding")[i].cast("double").alias(f"e{i}") for i in range(_EMB)])
    return out(ranking.correlations(e, e.columns).select("feature_1", "feature_2", "corr"))


_MM = [f"e{i}" for i in range(_EMB)]


@query("max_min_selection", f"""WITH RECURSIVE base AS (SELECT {', '.join(f'embedding[{i + 1}]::DOUBLE AS e{i}' for i in range(_EMB))}, label AS y FROM embeddings),
pairs AS ({_corr_pairs([*_MM, 'y'], 'base')}),
m AS (SELECT feature_1 AS f, feature_2 AS g, coalesce(abs(corr), 0) AS v FROM pairs UNION ALL SELECT feature_2, feature_1, coalesce(abs(corr), 0) FROM pairs),
rel AS (SELECT f, v AS rel FROM m WHERE g = 'y'),
pick AS (
 SELECT 1 AS step, [f] AS chosen, f AS selected_feature, rel AS relevance, 0.0::DOUBLE AS redundancy, rel AS score
 FROM (SELECT f, rel FROM rel ORDER BY rel DESC, f LIMIT 1)
 UNION ALL
 SELECT step + 1, list_append(chosen, b.f), b.f, b.rel, b.red, b.rel - b.red FROM pick, LATERAL (
  SELECT rel.f AS f, rel.rel AS rel, (SELECT max(v) FROM m WHERE m.f = rel.f AND list_contains(chosen, m.g)) AS red FROM rel
  WHERE NOT list_contains(chosen, rel.f) ORDER BY rel.rel - (SELECT max(v) FROM m WHERE m.f = rel.f AND list_contains(chosen, m.g)) DESC, rel.rel DESC, rel.f LIMIT 1) b
 WHERE b.rel - b.red >= 0)
SELECT step::BIGINT AS step, selected_feature, round(relevance, 6) AS relevance, round(redundancy, 6) AS redundancy, round(score, 6) AS score FROM pick""")
def max_min_selection(spark, d):
    e = table(spark, d, "embeddings").select(
        *[F.col("embedding")[i].cast("double").alias(f"e{i}") for i in range(_EMB)], "label")
    return out(selection.max_min(e, "label", _MM)[0])


# ---- PCA -----------------------------------------------------------------------------------------------------------

_PCA2 = """WITH c AS (SELECT var_samp(l_quantity) AS a, var_samp(l_discount * 100) AS b, covar_samp(l_quantity, l_discount * 100) AS c FROM lineitem),
ev AS (SELECT (a + b) / 2 + sqrt(((a - b) / 2) ** 2 + c * c) AS v1, (a + b) / 2 - sqrt(((a - b) / 2) ** 2 + c * c) AS v2 FROM c)"""


def _two(spark, d):
    return table(spark, d, "lineitem").select("l_quantity", (F.col("l_discount") * 100).alias("discount_pct"))


@query("pca_variance_table", _PCA2 + """ SELECT 'PC1' AS component, round(v1, 5) AS explained_variance, round(v1, 5) AS cumulative_explained_variance, NULL::DOUBLE AS delta_explained_variance FROM ev
UNION ALL SELECT 'PC2', round(v2, 5), round(v1 + v2, 5), round(v2 - v1, 5) FROM ev""")
def pca_variance_table(spark, d):
    t = _two(spark, d)
    return out(pca.variance_table(t, pca.fit_pca(t)).drop("component_no"), 5)


@query("scree_elbow", """WITH t AS (SELECT row_number() OVER (ORDER BY v DESC) AS x, v FROM (SELECT round(sum(p_retailprice), 6) AS v FROM part GROUP BY p_brand)),
e AS (SELECT max(x) AS xn, arg_min(v, x) AS y1, arg_max(v, x) AS yn FROM t)
SELECT x AS component_no, round(v, 4) AS explained_variance, round(abs((xn - 1) * (v - y1) - (yn - y1) * (x - 1)) / sqrt((xn - 1) ** 2 + (yn - y1) ** 2), 4) + 0.0 AS chord_distance FROM t, e""")
def scree_elbow(spark, d):
    t = table(spark, d, "part").groupBy("p_brand").agg(F.round(F.sum("p_retailprice"), 6).alias("explained_variance"))
    return out(pca.elbow_table(order.number_rows(t, [F.col("explained_variance").desc()], "component_no")), 4)


# ---- evaluation -----------------------------------------------------------------------------------------------------

def _guesses(spark, d):
    """A rule as classifier of the order status: price bands."""
    h = homes(spark, d)
    guess = F.when(F.col("price") < 150000, "F").when(F.col("price") < 350000, "O").otherwise("P")
    return h.select("id", "status", guess.alias("guess"))


_GUESS = f"""{HOMES}, g AS (SELECT id, status, CASE WHEN price < 150000 THEN 'F' WHEN price < 350000 THEN 'O' ELSE 'P' END AS guess FROM homes),
rep AS (SELECT cls, (SELECT count(*) FROM g WHERE status = cls) AS support, (SELECT count(*) FROM g WHERE guess = cls)::DOUBLE AS p, (SELECT count(*) FROM g WHERE status = cls AND guess = cls)::DOUBLE AS tp FROM (VALUES ('F'), ('O'), ('P')) t(cls))"""


@query("prediction_scores", f"WITH {_GUESS} SELECT round(sum(tp) / sum(support), 6) AS accuracy, round(sum(tp) / sum(support), 6) AS f1_micro, round(avg(2 * tp / (p + support)), 6) AS f1_macro, sum(support)::BIGINT AS n FROM rep")
def prediction_scores(spark, d):
    return out(evaluate.scores(_guesses(spark, d), "status", "guess"))


@query("confusion_matrix", f"""WITH {_GUESS} SELECT status AS label, count(*) FILTER (guess = 'F') AS "pred_F", count(*) FILTER (guess = 'O') AS "pred_O", count(*) FILTER (guess = 'P') AS "pred_P" FROM g GROUP BY 1""")
def confusion_matrix(spark, d):
    return evaluate.confusion_matrix(_guesses(spark, d), "status", "guess", ["F", "O", "P"])


@query("class_report", f"WITH {_GUESS} SELECT cls, round(tp / p, 6) AS precision, round(tp / support, 6) AS recall, round(2 * tp / (p + support), 6) AS f1, support FROM rep")
def class_report(spark, d):
    return out(evaluate.class_report(_guesses(spark, d), "status", "guess"))


@query("report_averages", f"""WITH {_GUESS} SELECT round(avg(tp / p), 6) AS macro_precision, round(sum(tp / p * support) / sum(support), 6) AS weighted_precision, round(avg(tp / support), 6) AS macro_recall,
 round(sum(tp) / sum(support), 6) AS weighted_recall, round(avg(2 * tp / (p + support)), 6) AS macro_f1, round(sum(2 * tp / (p + support) * support) / sum(support), 6) AS weighted_f1, sum(support)::BIGINT AS support FROM rep""")
def report_averages(spark, d):
    return out(evaluate.report_averages(evaluate.class_report(_guesses(spark, d), "status", "guess")))


@query("majority_baseline", """SELECT event_id, (SELECT event_type FROM events GROUP BY 1 ORDER BY count(*) DESC, event_type LIMIT 1) AS prediction FROM events""")
def majority_baseline(spark, d):
    e = table(spark, d, "events")
    return evaluate.majority_baseline(e, e, "event_type").select("event_id", "prediction")


@query("strategy_summary", """WITH r AS (SELECT event_type AS strategy, user_id % 7 AS c, avg(value) AS a FROM events GROUP BY ALL)
SELECT strategy, round(avg(a), 6) AS accuracy_mean, round(min(a), 6) AS accuracy_min, round(max(a), 6) AS accuracy_max, count(DISTINCT c) AS n_columns FROM r GROUP BY 1""")
def strategy_summary(spark, d):
    r = table(spark, d, "events").groupBy(F.col("event_type").alias("strategy"), (F.col("user_id") % 7).alias("column")).agg(
        F.avg("value").alias("accuracy"))
    return out(evaluate.strategy_summary(r))


# ---- decision profiles ------------------------------------------------------------------------------------------------

_EXPERTS = ["by_price", "by_priority", "by_segment", "by_region"]
_CLASSES = ["F", "O", "P"]


def _profile(spark, d):
    """Four rule experts with fixed class probabilities over all orders."""
    h = homes(spark, d)
    price = (F.when(F.col("price") < 150000, F.array(F.lit(0.5), F.lit(0.3), F.lit(0.2)))
             .when(F.col("price") < 350000, F.array(F.lit(0.2), F.lit(0.6), F.lit(0.2)))
             .otherwise(F.array(F.lit(0.1), F.lit(0.2), F.lit(0.7))))
    priority = (F.when(F.col("priority") < "2", F.array(F.lit(0.9), F.lit(0.1), F.lit(0.0)))
                .when(F.col("priority") < "4", F.array(F.lit(0.1), F.lit(0.5), F.lit(0.4)))
                .otherwise(F.array(F.lit(0.3), F.lit(0.3), F.lit(0.4))))
    segment = (F.when(F.col("segment") < "C", F.array(F.lit(0.2), F.lit(0.4), F.lit(0.4)))
               .otherwise(F.array(F.lit(0.45), F.lit(0.25), F.lit(0.3))))
    region = (F.when(F.col("geo1") < 2, F.array(F.lit(0.35), F.lit(0.35), F.lit(0.3)))
              .otherwise(F.array(F.lit(0.0), F.lit(0.15), F.lit(0.85))))
    cells = F.explode(F.array(*[
        F.struct(F.lit(e).alias("expert"), F.lit(c).alias("cls"), p[i].alias("proba"))
        for e, p in zip(_EXPERTS, (price, priority, segment, region)) for i, c in enumerate(_CLASSES)]))
    return h.select("id", cells.alias("c")).select("id", "c.expert", "c.cls", "c.proba"), h.select(
        "id", F.col("status").alias("label"))


_PROFILE = f"""{HOMES}, raw AS (
 SELECT id, 'by_price' AS expert, CASE WHEN price < 150000 THEN [0.5::DOUBLE, 0.3, 0.2] WHEN price < 350000 THEN [0.2::DOUBLE, 0.6, 0.2] ELSE [0.1::DOUBLE, 0.2, 0.7] END AS p FROM homes
 UNION ALL SELECT id, 'by_priority', CASE WHEN priority < '2' THEN [0.9::DOUBLE, 0.1, 0.0] WHEN priority < '4' THEN [0.1::DOUBLE, 0.5, 0.4] ELSE [0.3::DOUBLE, 0.3, 0.4] END FROM homes
 UNION ALL SELECT id, 'by_segment', CASE WHEN segment < 'C' THEN [0.2::DOUBLE, 0.4, 0.4] ELSE [0.45::DOUBLE, 0.25, 0.3] END FROM homes
 UNION ALL SELECT id, 'by_region', CASE WHEN geo1 < 2 THEN [0.35::DOUBLE, 0.35, 0.3] ELSE [0.0::DOUBLE, 0.15, 0.85] END FROM homes),
profile AS (SELECT id, expert, unnest(['F', 'O', 'P']) AS cls, unnest(p)::DOUBLE AS proba FROM raw),
w AS (SELECT * FROM (VALUES ('by_price', 0.5::DOUBLE), ('by_priority', 0.25::DOUBLE), ('by_segment', 0.125::DOUBLE), ('by_region', 0.125::DOUBLE)) t(expert, weight)),
pred AS (SELECT id, expert, arg_max(cls, proba * 1000 - (cls = 'O')::INT * 1e-6 - (cls = 'P')::INT * 2e-6) AS prediction FROM profile GROUP BY ALL)"""
_W = {"by_price": 0.5, "by_priority": 0.25, "by_segment": 0.125, "by_region": 0.125}


@query("profile_mean", f"WITH {_PROFILE} SELECT id, cls, round(avg(proba), 6) AS score FROM profile GROUP BY ALL")
def profile_mean(spark, d):
    return out(ensemble.aggregate(_profile(spark, d)[0], "mean"))


@query("profile_weighted_mean", f"WITH {_PROFILE} SELECT id, cls, round(sum(weight * proba) / sum(weight), 6) AS score FROM profile JOIN w USING (expert) GROUP BY ALL")
def profile_weighted_mean(spark, d):
    return out(ensemble.aggregate(_profile(spark, d)[0], "weighted_mean", _W))


@query("profile_median", f"WITH {_PROFILE} SELECT id, cls, round(median(proba), 6) AS score FROM profile GROUP BY ALL")
def profile_median(spark, d):
    return out(ensemble.aggregate(_profile(spark, d)[0], "median"))


@query("profile_product", f"""WITH {_PROFILE}, p AS (SELECT id, cls, product(least(greatest(proba, 1e-12), 1)) AS v FROM profile GROUP BY ALL)
SELECT id, cls, round(v / sum(v) OVER (PARTITION BY id), 6) AS score FROM p""")
def profile_product(spark, d):
    return out(ensemble.aggregate(_profile(spark, d)[0], "product"))


@query("profile_majority_vote", f"""WITH {_PROFILE}, v AS (SELECT id, prediction AS cls, sum(weight) AS v FROM pred JOIN w USING (expert) GROUP BY ALL)
SELECT id, cls, coalesce(v, 0) AS score FROM (SELECT DISTINCT id, cls FROM profile) LEFT JOIN v USING (id, cls)""")
def profile_majority_vote(spark, d):
    return out(ensemble.aggregate(_profile(spark, d)[0], "majority_vote", _W))


@query("profile_decision", f"""WITH {_PROFILE}, s AS (SELECT id, cls, sum(weight * proba) / sum(weight) AS score FROM profile JOIN w USING (expert) GROUP BY ALL)
SELECT id, cls AS prediction FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY round(score, 9) DESC, cls) AS r FROM s) WHERE r = 1""")
def profile_decision(spark, d):
    s = ensemble.aggregate(_profile(spark, d)[0], "weighted_mean", _W)
    return ensemble.decide(s.withColumn("score", F.round("score", 9)))


@query("hard_profile", f"""WITH {_PROFILE} SELECT id, expert, cls, (cls = prediction)::INT::DOUBLE AS proba FROM pred, (VALUES ('F'), ('O'), ('P')) t(cls)""")
def hard_profile(spark, d):
    return ensemble.profile_from_hard(ensemble.expert_predictions(_profile(spark, d)[0]), _CLASSES)


@query("expert_predictions_wide", f"""WITH {_PROFILE} SELECT id, max(prediction) FILTER (expert = 'by_price') AS by_price, max(prediction) FILTER (expert = 'by_priority') AS by_priority,
 max(prediction) FILTER (expert = 'by_segment') AS by_segment, max(prediction) FILTER (expert = 'by_region') AS by_region FROM pred GROUP BY 1""")
def expert_predictions_wide(spark, d):
    return ensemble.predictions_wide(_profile(spark, d)[0], _EXPERTS)


_SCORED = f"""WITH {_PROFILE}, j AS (SELECT expert, status, prediction FROM pred JOIN homes USING (id)),
cells AS (SELECT expert, cls, count(*) FILTER (status = cls) AS t, count(*) FILTER (prediction = cls) AS p, count(*) FILTER (status = cls AND prediction = cls) AS tp FROM j, (VALUES ('F'), ('O'), ('P')) c(cls) GROUP BY ALL),
f AS (SELECT expert AS model, sum(tp)::DOUBLE / sum(t) AS acc, avg(2.0::DOUBLE * tp / (p + t)) AS macro FROM cells GROUP BY 1)"""


@query("expert_scores", _SCORED + " SELECT model, round(acc, 6) AS f1_micro, round(macro, 6) AS f1_macro, round(acc, 6) AS accuracy, round(greatest(acc, 1e-6), 6) AS weight FROM f")
def expert_scores(spark, d):
    return out(ensemble.score_experts(*_profile(spark, d)))


@query("best_experts", _SCORED + " SELECT model, round(acc, 6) AS f1_micro FROM f ORDER BY acc DESC, macro DESC, model LIMIT 2")
def best_experts(spark, d):
    return out(ensemble.top_experts(ensemble.score_experts(*_profile(spark, d)), 2).select("model", "f1_micro"))


@query("result_leaderboard", _SCORED + " SELECT model, round(acc, 6) AS f1_micro, round(macro, 6) AS f1_macro FROM f ORDER BY acc DESC, macro DESC, model LIMIT 1")
def result_leaderboard(spark, d):
    return out(evaluate.best(ensemble.score_experts(*_profile(spark, d))).select("model", "f1_micro", "f1_macro"))


_PAIRS = """hits AS (SELECT id, expert, prediction = status AS ok FROM pred JOIN homes USING (id)),
cnt AS (SELECT a.expert AS expert_a, b.expert AS expert_b, count(*) FILTER (a.ok AND b.ok) AS n11, count(*) FILTER (NOT a.ok AND NOT b.ok) AS n00,
 count(*) FILTER (a.ok AND NOT b.ok) AS n10, count(*) FILTER (NOT a.ok AND b.ok) AS n01 FROM hits a JOIN hits b ON a.id = b.id AND list_position(['by_price', 'by_priority', 'by_segment', 'by_region'], a.expert) < list_position(['by_price', 'by_priority', 'by_segment', 'by_region'], b.expert) GROUP BY ALL)"""


@query("expert_diversity", f"""WITH {_PROFILE}, {_PAIRS} SELECT *, round((n10 + n01)::DOUBLE / (n11 + n00 + n10 + n01), 6) AS disagreement, round(n00::DOUBLE / (n11 + n00 + n10 + n01), 6) AS double_fault,
 round(coalesce((n11::DOUBLE * n00 - n10::DOUBLE * n01) / nullif(n11::DOUBLE * n00 + n10::DOUBLE * n01, 0), 0), 6) + 0.0 AS q_statistic,
 round(coalesce((n11::DOUBLE * n00 - n10::DOUBLE * n01) / nullif(sqrt((n11 + n10)::DOUBLE * (n01 + n00) * (n11 + n01) * (n10 + n00)), 0), 0), 6) + 0.0 AS correlation_phi FROM cnt""")
def expert_diversity(spark, d):
    p, truth = _profile(spark, d)
    return out(ensemble.diversity(ensemble.expert_predictions(p), truth, _EXPERTS))


@query("aggregation_rule_scores", f"""WITH {_PROFILE}, s AS (
 SELECT 'mes_mean' AS model, id, cls, avg(proba) AS score FROM profile GROUP BY ALL UNION ALL
 SELECT 'mes_weighted_mean', id, cls, sum(weight * proba) / sum(weight) FROM profile JOIN w USING (expert) GROUP BY ALL UNION ALL
 SELECT 'mes_product', id, cls, product(least(greatest(proba, 1e-12), 1)) FROM profile GROUP BY ALL UNION ALL
 SELECT 'mes_median', id, cls, median(proba) FROM profile GROUP BY ALL UNION ALL
 SELECT 'mes_majority_vote', id, cls, coalesce(v, 0) FROM (SELECT DISTINCT id, cls FROM profile)
  LEFT JOIN (SELECT id, prediction AS cls, sum(weight) AS v FROM pred JOIN w USING (expert) GROUP BY ALL) USING (id, cls)),
g AS (SELECT model, id, cls AS prediction FROM (SELECT *, row_number() OVER (PARTITION BY model, id ORDER BY round(score, 12) DESC, cls) AS r FROM s) WHERE r = 1),
j AS (SELECT model, status, prediction FROM g JOIN homes USING (id)),
cells AS (SELECT model, cls, count(*) FILTER (status = cls) AS t, count(*) FILTER (prediction = cls) AS p, count(*) FILTER (status = cls AND prediction = cls) AS tp FROM j, (VALUES ('F'), ('O'), ('P')) c(cls) GROUP BY ALL)
SELECT model, round(sum(tp)::DOUBLE / sum(t), 6) AS f1_micro, round(avg(2.0::DOUBLE * tp / (p + t)), 6) AS f1_macro, round(sum(tp)::DOUBLE / sum(t), 6) AS accuracy FROM cells GROUP BY 1""")
def aggregation_rule_scores(spark, d):
    p, truth = _profile(spark, d)
    return out(ensemble.score_rules(p, truth, _W))


@query("diverse_expert_choice", _SCORED + f""", {_PAIRS}, pp AS (SELECT expert_a AS a, expert_b AS b, (n10 + n01)::DOUBLE / (n11 + n00 + n10 + n01) AS dis, n00::DOUBLE / (n11 + n00 + n10 + n01) AS dbl FROM cnt
 UNION ALL SELECT expert_b, expert_a, (n10 + n01)::DOUBLE / (n11 + n00 + n10 + n01), n00::DOUBLE / (n11 + n00 + n10 + n01) FROM cnt),
s1 AS (SELECT model, acc FROM f ORDER BY acc DESC, macro DESC, model LIMIT 1),
s2 AS (SELECT f.model, f.acc, dis, dbl, f.acc + 0.12 * dis - 0.08 * dbl AS score FROM f JOIN pp ON pp.a = f.model JOIN s1 ON pp.b = s1.model ORDER BY score DESC, f.acc DESC, f.model LIMIT 1)
SELECT 1::BIGINT AS step, model AS expert, round(acc, 6) AS f1_micro, 0.0::DOUBLE AS avg_disagreement, 0.0::DOUBLE AS avg_double_fault, round(acc, 6) AS selection_score FROM s1
UNION ALL SELECT 2, model, round(acc, 6), round(dis, 6), round(dbl, 6), round(score, 6) FROM s2""")
def diverse_expert_choice(spark, d):
    p, truth = _profile(spark, d)
    pairs = ensemble.diversity(ensemble.expert_predictions(p), truth, _EXPERTS)
    return out(ensemble.diverse_experts(ensemble.score_experts(p, truth), pairs, 2))
