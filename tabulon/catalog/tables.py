"""Sources, projections, filters, scalar functions, joins, quality and set operations."""
from __future__ import annotations

from pyspark.sql import Window, functions as F

from tabulon.catalog.base import HOMES, PARTS, homes, longs, out, parts, query, scratch, table
from tabulon.functions import numeric, text
from tabulon.operators import clean, encode, order, quality
from tabulon.sources import readers, writers

# ---- sources and sinks -----------------------------------------------------------------------------


@query("csv_scan", """SELECT p_partkey, p_name, p_size::BIGINT AS p_size, round(p_retailprice, 6) AS p_retailprice FROM part""")
def csv_scan(spark, d):
    path = scratch(spark, "part") + ".csv"
    writers.write_table(table(spark, d, "part").select("p_partkey", "p_name", "p_size", "p_retailprice"), path, "csv")
    return out(readers.read_table(spark, path, "p_partkey bigint, p_name string, p_size int, p_retailprice double"))


@query("labelled_source", """SELECT o_orderkey, c_acctbal, o_orderstatus FROM orders JOIN customer ON o_custkey = c_custkey""")
def labelled_source(spark, d):
    values = table(spark, d, "orders").withColumnRenamed("o_custkey", "c_custkey")
    return readers.join_labels(values, table(spark, d, "customer"), "c_custkey").select(
        "o_orderkey", "c_acctbal", "o_orderstatus")


@query("required_columns_source", "SELECT count(*) AS n_rows, sum(l_linenumber)::BIGINT AS s FROM lineitem")
def required_columns_source(spark, d):
    df = readers.load_preprocessed(spark, f"{d}/lineitem.parquet", ("l_orderkey", "l_linenumber"))
    return df.agg(F.count("*").alias("n_rows"), F.sum("l_linenumber").alias("s"))


@query("feature_list_source", """SELECT p_brand AS feature, row_number() OVER (ORDER BY n DESC, p_brand) AS rank FROM (
  SELECT p_brand, count(*) AS n FROM part GROUP BY 1) ORDER BY n DESC, p_brand LIMIT 10""")
def feature_list_source(spark, d):
    ranking = table(spark, d, "part").groupBy("p_brand").count()
    ranked = order.number_rows(ranking, [F.col("count").desc(), "p_brand"], "rank")
    path = scratch(spark, "ranking") + ".csv"
    writers.write_report(ranked.orderBy("rank"), path)
    names = readers.read_feature_list(spark, path, "p_brand", 10, order="rank")
    kept = spark.createDataFrame([(i + 1, n) for i, n in enumerate(names)], "rank bigint, feature string")
    return kept.select("feature", "rank")


@query("preprocessed_sink", """SELECT o_orderkey, o_orderstatus, c_acctbal FROM orders JOIN customer ON o_custkey = c_custkey""")
def preprocessed_sink(spark, d):
    values = table(spark, d, "orders").select("o_orderkey", F.col("o_custkey").alias("k"), "o_orderstatus")
    labels = table(spark, d, "customer").select(F.col("c_custkey").alias("k"), "c_acctbal")
    paths = writers.write_preprocessed(values, labels, values, "k", scratch(spark, "sink"))
    return spark.read.parquet(paths["labelled"]).select("o_orderkey", "o_orderstatus", "c_acctbal")


@query("feature_sets_long", """WITH a AS (SELECT p_type, list(DISTINCT p_brand ORDER BY p_brand) AS brands FROM part GROUP BY 1)
SELECT p_type AS feature_set, unnest(range(1, len(brands) + 1)) AS rank, unnest(brands) AS feature FROM a""")
def feature_sets_long(spark, d):
    rows = table(spark, d, "part").select("p_type", "p_brand").distinct().groupBy("p_type").agg(
        F.array_sort(F.collect_set("p_brand")).alias("features"))
    return longs(writers.feature_set_table(spark, rows.withColumnRenamed("p_type", "feature_set")))


@query("best_params_store", """SELECT p_type AS expert, max(p_size)::BIGINT AS max_depth FROM part GROUP BY 1""")
def best_params_store(spark, d):
    best = table(spark, d, "part").groupBy(F.col("p_type").alias("expert")).agg(F.max("p_size").alias("max_depth"))
    path = scratch(spark, "params")
    writers.write_params(spark, best.select("expert", F.to_json(F.struct("max_depth")).alias("params")), path)
    return readers.params_table(spark, path).select("expert", F.from_json("params", "max_depth bigint")["max_depth"].alias("max_depth"))


# ---- projections and filters ------------------------------------------------------------------------

@query("normalized_names", "SELECT s_suppkey AS s_key, s_name AS supplier_name FROM supplier")
def normalized_names(spark, d):
    raw = table(spark, d, "supplier").select("s_suppkey", "s_name").toDF(" S_Key", "SUPPLIER_Name ")
    return longs(clean.normalize_names(raw))


@query("candidate_columns", """SELECT unnest(['p_name', 'p_brand', 'p_size', 'p_retailprice']) AS feature,
  unnest(['categorical', 'categorical', 'numeric', 'numeric']) AS kind, unnest([count(DISTINCT p_name), count(DISTINCT p_brand), count(DISTINCT p_size), count(DISTINCT p_retailprice)]) AS n_values FROM part""")
def candidate_columns(spark, d):
    p = table(spark, d, "part")
    cand = clean.candidate_features(p, "p_type", ["p_partkey"])
    kinds = clean.feature_kinds(p.select(cand))
    kind = {c: k for k in ("numeric", "categorical") for c in kinds[k]}
    return p.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.lit(kind[c]).alias("kind"), F.col(c).cast("string").alias("v"))
        for c in cand])).alias("c")).select("c.*").distinct().groupBy("feature", "kind").agg(F.count("v").alias("n_values"))


@query("few_valued_columns", """WITH n AS (
  SELECT 'l_quantity' AS feature, count(DISTINCT l_quantity) AS n FROM lineitem UNION ALL
  SELECT 'l_discount', count(DISTINCT l_discount) FROM lineitem UNION ALL
  SELECT 'l_tax', count(DISTINCT l_tax) FROM lineitem UNION ALL
  SELECT 'l_extendedprice', count(DISTINCT l_extendedprice) FROM lineitem)
SELECT feature FROM n WHERE n <= 50 UNION ALL SELECT 'l_linenumber' UNION ALL SELECT 'l_returnflag'""")
def few_valued_columns(spark, d):
    li = table(spark, d, "lineitem").select("l_linenumber", "l_quantity", "l_discount", "l_tax", "l_extendedprice",
                                            "l_returnflag")
    return spark.createDataFrame([(c,) for c in clean.few_valued(li)], "feature string")


@query("existing_columns", "SELECT s_suppkey, s_acctbal FROM supplier")
def existing_columns(spark, d):
    s = table(spark, d, "supplier")
    return s.select("s_suppkey", *clean.existing(s, ["s_acctbal", "not_there"]))


@query("null_outside_bounds", """SELECT event_id, CASE WHEN value BETWEEN 1.5 AND 200 THEN value END AS value FROM events""")
def null_outside_bounds(spark, d):
    return clean.null_outside(table(spark, d, "events").select("event_id", "value"), {"value": (1.5, 200.0)})


@query("outside_bound_counts", """SELECT 'value' AS "column", 1.5::DOUBLE AS lower, 200::DOUBLE AS upper,
  count(*) FILTER (value < 1.5 OR value > 200) AS n_replaced FROM events""")
def outside_bound_counts(spark, d):
    return clean.outside_counts(table(spark, d, "events"), {"value": (1.5, 200.0)})


@query("null_inside_range", """SELECT p_partkey, CASE WHEN p_size NOT BETWEEN 40 AND 45 THEN p_size::BIGINT END AS p_size,
  p_size BETWEEN 40 AND 45 AS was_sentinel FROM part""")
def null_inside_range(spark, d):
    return longs(clean.null_inside(table(spark, d, "part").select("p_partkey", "p_size"), "p_size", 40, 45, "was_sentinel"))


@query("upper_bound_flag", """SELECT monum_flag, count(*) AS n FROM (
  SELECT CASE WHEN value > 200 AND value <= 250 THEN 1 ELSE 0 END::BIGINT AS monum_flag FROM events) GROUP BY 1""")
def upper_bound_flag(spark, d):
    return longs(clean.upper_flag(table(spark, d, "events"), "value", 200.0, 250.0).groupBy("monum_flag").agg(
        F.count("*").alias("n")))


@query("rows_with_label", f"""WITH {PARTS} SELECT p_partkey, p_size::BIGINT AS p_size FROM parts WHERE p_size IS NOT NULL""")
def rows_with_label(spark, d):
    return longs(clean.labelled_rows(parts(spark, d), "p_size").select("p_partkey", "p_size"))


@query("null_guard", f"""WITH {PARTS} SELECT 'p_size' AS "column", count(*) - count(p_size) AS n_null FROM parts
UNION ALL SELECT 'p_retailprice', count(*) - count(p_retailprice) FROM parts""")
def null_guard(spark, d):
    got = clean.null_counts(parts(spark, d), ["p_size", "p_retailprice"])
    return spark.createDataFrame(list(got.items()), "column string, n_null bigint")


# ---- scalar functions --------------------------------------------------------------------------------

@query("ascii_fold", r"""SELECT doc_id, nullif(regexp_replace(strip_accents(regexp_replace(text, '^\s+|\s+$', '', 'g')), '[^\x00-\x7F]', '', 'g'), '') AS folded FROM documents""")
def ascii_fold(spark, d):
    return table(spark, d, "documents").select("doc_id", text.ascii_fold(F.col("text")).alias("folded"))


@query("clean_categories", r"""SELECT conv_id, turn, nullif(regexp_replace(lower(regexp_replace(strip_accents(regexp_replace(text, '^\s+|\s+$', '', 'g')), '[^\x00-\x7F]', '', 'g')), '^\s+|\s+$', '', 'g'), '') AS cleaned, role FROM conversations""")
def clean_categories(spark, d):
    df = table(spark, d, "conversations").select("conv_id", "turn", F.col("text").alias("cleaned"), "role")
    return clean.clean_categories(df, ["cleaned", "role"])


@query("label_codes", "SELECT o_orderkey, (CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END)::BIGINT AS label_idx FROM orders")
def label_codes(spark, d):
    return longs(encode.encode_label(table(spark, d, "orders"), "o_orderstatus").select("o_orderkey", "label_idx"))


@query("label_decode", "SELECT o_orderkey, o_orderstatus AS decoded FROM orders")
def label_decode(spark, d):
    o = table(spark, d, "orders")
    index = encode.value_index(o, "o_orderstatus")
    coded = encode.encode_label(o, "o_orderstatus", "label_code").select("o_orderkey", "label_code")
    return encode.decode_label(coded, index, "o_orderstatus", "label_code", "decoded").select("o_orderkey", "decoded")


@query("geo_index", f"""WITH {HOMES}, train AS (SELECT * FROM homes WHERE segment <> 'BUILDING'),
 g2 AS (SELECT geo2, row_number() OVER (ORDER BY geo2) AS i FROM (SELECT DISTINCT geo2 FROM train)),
 g3 AS (SELECT geo3, row_number() OVER (ORDER BY geo3) AS i FROM (SELECT DISTINCT geo3 FROM train))
SELECT id, coalesce(g2.i, 0) AS geo2_idx, coalesce(g3.i, 0) AS geo3_idx
FROM homes LEFT JOIN g2 USING (geo2) LEFT JOIN g3 USING (geo3)""")
def geo_index(spark, d):
    h = homes(spark, d)
    fitted = encode.fit_geo_index(h.where("segment <> 'BUILDING'"), ["geo2", "geo3"])
    return longs(encode.apply_geo_index(h, fitted).select("id", "geo2_idx", "geo3_idx"))


_PRI = {"1-URGENT": "1-URGENT", "2-HIGH": "2-HIGH", "3-MEDIUM": "3-MEDIUM", "4-NOT SPECIFIED": "4-NOT SPECIFIED"}


@query("one_hot_unseen", "SELECT o_orderkey, " + ", ".join(
    f"""(o_orderpriority = '{v}')::BIGINT AS "o_orderpriority_{v}" """ for v in _PRI) + " FROM orders")
def one_hot_unseen(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_orderpriority")
    fitted = encode.fit_one_hot(o.where("o_orderpriority <> '5-LOW'"), ["o_orderpriority"])
    return longs(encode.apply_one_hot(o, fitted))


@query("dummies_with_null", f"""SELECT p_partkey, coalesce(p_type = 'ECONOMY', false)::BIGINT AS "p_type_ECONOMY",
 coalesce(p_type = 'LARGE', false)::BIGINT AS "p_type_LARGE", coalesce(p_type = 'MEDIUM', false)::BIGINT AS "p_type_MEDIUM",
 coalesce(p_type = 'SMALL', false)::BIGINT AS "p_type_SMALL", coalesce(p_type = 'STANDARD', false)::BIGINT AS "p_type_STANDARD",
 (p_type IS NULL)::BIGINT AS p_type_nan FROM (SELECT p_partkey, CASE WHEN p_type <> 'PROMO' THEN p_type END AS p_type FROM part)""")
def dummies_with_null(spark, d):
    p = table(spark, d, "part").select("p_partkey", F.when(F.col("p_type") != "PROMO", F.col("p_type")).alias("p_type"))
    return longs(encode.dummies(p, null_column=True))


@query("standardize", f"""WITH {PARTS}, s AS (SELECT avg(p_size) AS m1, stddev_pop(p_size) AS s1, avg(p_retailprice) AS m2,
 stddev_pop(p_retailprice) AS s2 FROM parts WHERE p_type <> 'PROMO')
SELECT p_partkey, round((p_size - m1) / s1, 6) + 0.0 AS p_size, round((p_retailprice - m2) / s2, 6) + 0.0 AS p_retailprice FROM parts, s""")
def standardize(spark, d):
    p = parts(spark, d)
    fitted = encode.fit_standard(p.where("p_type <> 'PROMO'"), ["p_size", "p_retailprice"])
    return out(encode.apply_scaler(p, fitted).select("p_partkey", "p_size", "p_retailprice"))


@query("scaler_parameters", """SELECT 'value' AS "column", round(avg(value), 6) AS mean_train, round(stddev_pop(value), 6) AS std_train FROM events""")
def scaler_parameters(spark, d):
    e = table(spark, d, "events")
    return out(encode.scaler_table(e, encode.fit_standard(e, ["value"])))


@query("scale_without_centering", "SELECT event_id, round(value / (SELECT stddev_pop(value) FROM events), 6) AS value FROM events")
def scale_without_centering(spark, d):
    e = table(spark, d, "events").select("event_id", "value")
    return out(encode.apply_scaler(e, encode.fit_standard(e, ["value"], center=False)))


@query("min_max_scale", """WITH s AS (SELECT min(l_extendedprice) AS a, max(l_extendedprice) - min(l_extendedprice) AS r FROM lineitem)
SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, round((l_extendedprice - a) / r, 6) AS l_extendedprice FROM lineitem, s""")
def min_max_scale(spark, d):
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return out(encode.apply_scaler(li, encode.fit_minmax(li, ["l_extendedprice"])))


@query("scaled_ranges", """WITH s AS (SELECT avg(value) AS m, stddev_pop(value) AS s FROM events)
SELECT 'value' AS "column", round(min((value - m) / s), 6) AS min, round(max((value - m) / s), 6) AS max FROM events, s""")
def scaled_ranges(spark, d):
    e = table(spark, d, "events")
    return out(encode.ranges(encode.apply_scaler(e, encode.fit_standard(e, ["value"])), ["value"]))


@query("clip_values", """SELECT c_custkey, greatest(c_acctbal, 0.0) AS low, least(greatest(c_acctbal / 10000, 1e-12), 1.0) AS both_ends FROM customer""")
def clip_values(spark, d):
    b = F.col("c_acctbal")
    return table(spark, d, "customer").select(
        "c_custkey", numeric.clip(b, low=0.0).alias("low"), numeric.clip(b / 10000, 1e-12, 1.0).alias("both_ends"))


@query("numeric_helpers", """SELECT p_partkey, abs(p_size - 25)::BIGINT AS dist, round(sqrt(p_retailprice), 6) AS root,
 round(ln(p_size) / ln(2), 6) + 0.0 AS log2_size,
 (CASE WHEN p_size >= 25 AND p_size >= p_partkey % 50 THEN 0 WHEN 25 >= p_partkey % 50 THEN 1 ELSE 2 END)::BIGINT AS first_max FROM part""")
def numeric_helpers(spark, d):
    s = F.col("p_size")
    arr = F.array(s.cast("double"), F.lit(25.0), (F.col("p_partkey") % 50).cast("double"))
    return out(table(spark, d, "part").select(
        "p_partkey", F.abs(s - 25).cast("bigint").alias("dist"), F.sqrt("p_retailprice").alias("root"),
        numeric.log_base(s.cast("double"), 2).alias("log2_size"), numeric.first_argmax(arr).alias("first_max")))


# ---- joins ---------------------------------------------------------------------------------------------

@query("label_lookup", """SELECT doc_id, quality::BIGINT AS quality FROM documents LEFT JOIN labels USING (doc_id)""")
def label_lookup(spark, d):
    return longs(readers.map_labels(table(spark, d, "documents").select("doc_id"), table(spark, d, "labels"),
                                    "doc_id", "quality"))


@query("positional_alignment", """SELECT a.s_suppkey, b.s_name FROM (SELECT s_suppkey, row_number() OVER (ORDER BY s_suppkey) AS p FROM supplier) a
JOIN (SELECT s_name, row_number() OVER (ORDER BY s_name) AS p FROM supplier) b USING (p)""")
def positional_alignment(spark, d):
    s = table(spark, d, "supplier")
    return readers.align_by_position(s.select("s_suppkey"), s.select("s_name", F.col("s_name").alias("o")),
                                     "s_suppkey", "o", "s_name")


# ---- quality -----------------------------------------------------------------------------------------------

@query("duplicate_keys", """SELECT count(*) AS n_rows, count(DISTINCT l_orderkey * 10 + l_linenumber) AS n_keys,
 count(*) - count(DISTINCT l_orderkey * 10 + l_linenumber) AS n_duplicates FROM lineitem""")
def duplicate_keys(spark, d):
    li = table(spark, d, "lineitem").withColumn("k", F.col("l_orderkey") * 10 + F.col("l_linenumber"))
    return quality.duplicate_keys(li, "k")


@query("later_duplicates", """SELECT o_orderkey, (row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) > 1)::BIGINT AS is_duplicate FROM orders""")
def later_duplicates(spark, d):
    return longs(quality.mark_later_duplicates(table(spark, d, "orders"), "o_custkey", "o_orderkey").select(
        "o_orderkey", "is_duplicate"))


@query("total_nulls", f"WITH {PARTS} SELECT count(*) - count(p_size) AS total_nulls FROM parts")
def total_nulls(spark, d):
    return quality.total_nulls(parts(spark, d))


def _sparse(spark, d):
    e = table(spark, d, "events")
    return e.select("event_id", F.when(F.col("value") > 100, F.col("value")).alias("big"),
                    F.when(F.col("value") > 60, F.col("value")).alias("middle"),
                    F.when(F.col("event_type") == "error", F.col("user_id")).alias("err_user"))


_SPARSE = """sparse AS (SELECT event_id, CASE WHEN value > 100 THEN value END AS big, CASE WHEN value > 60 THEN value END AS middle,
 CASE WHEN event_type = 'error' THEN user_id END AS err_user FROM events)"""


@query("null_share", f"""WITH {_SPARSE}, a AS (SELECT count(*) AS n, count(event_id) AS c0, count(big) AS c1, count(middle) AS c2, count(err_user) AS c3 FROM sparse)
SELECT unnest(['event_id', 'big', 'middle', 'err_user']) AS "column", unnest([n - c0, n - c1, n - c2, n - c3]) AS n_null,
 unnest([round((n - c0) * 100.0::DOUBLE / n, 6), round((n - c1) * 100.0::DOUBLE / n, 6), round((n - c2) * 100.0::DOUBLE / n, 6), round((n - c3) * 100.0::DOUBLE / n, 6)]) AS null_pct FROM a""")
def null_share(spark, d):
    return out(quality.null_share(_sparse(spark, d)))


@query("sparse_columns", f"""WITH {_SPARSE}, a AS (SELECT 'big' AS "column", count(*) - count(big) AS n_null, count(*) AS n FROM sparse UNION ALL
 SELECT 'middle', count(*) - count(middle), count(*) FROM sparse UNION ALL SELECT 'err_user', count(*) - count(err_user), count(*) FROM sparse)
SELECT "column", n_null, round(n_null * 100.0::DOUBLE / n, 6) AS null_pct FROM a WHERE n_null * 100.0 / n > 70""")
def sparse_columns(spark, d):
    return out(quality.sparse_columns(_sparse(spark, d)))


@query("sparse_rows", f"""WITH {_SPARSE} SELECT event_id, 75.0::DOUBLE AS null_pct FROM sparse
WHERE big IS NULL AND middle IS NULL AND err_user IS NULL""")
def sparse_rows(spark, d):
    return quality.sparse_rows(_sparse(spark, d), "event_id")


@query("class_distribution", """SELECT o_orderstatus, count(*) AS n, round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM orders), 1) AS pct FROM orders GROUP BY 1""")
def class_distribution(spark, d):
    return quality.class_distribution(table(spark, d, "orders"), "o_orderstatus")


@query("class_weights", """SELECT event_type, count(*) AS n, round((SELECT count(*) FROM events) / (count(*)::DOUBLE * (SELECT count(DISTINCT event_type) FROM events)), 6) AS weight FROM events GROUP BY 1""")
def class_weights(spark, d):
    return out(quality.class_weights(table(spark, d, "events"), "event_type"))


def _flags(spark, d):
    return table(spark, d, "labels").select(
        "quality", "toxic", F.when(F.col("doc_id") % 3 == 0, 2).when(F.col("doc_id") % 3 == 1, 1).alias("odd"))


_FLAGS = """flags AS (SELECT 'quality' AS feature, quality::DOUBLE AS value FROM labels UNION ALL SELECT 'toxic', toxic::DOUBLE FROM labels
 UNION ALL SELECT 'odd', (CASE doc_id % 3 WHEN 0 THEN 2 WHEN 1 THEN 1 END)::DOUBLE FROM labels)"""


@query("flag_domain_check", f"""WITH {_FLAGS} SELECT feature, count(*) AS n_total, count(value) AS n_not_null, count(*) - count(value) AS n_null,
 count(DISTINCT value) AS n_values, count(DISTINCT value) FILTER (value NOT IN (0, 1)) AS n_invalid_values,
 count(*) FILTER (value NOT IN (0, 1)) AS n_invalid_rows, count(*) FILTER (value NOT IN (0, 1)) > 0 AS has_errors FROM flags GROUP BY 1""")
def flag_domain_check(spark, d):
    return quality.check_flags(_flags(spark, d), ["quality", "toxic", "odd", "absent"])


@query("flag_values", f"""WITH {_FLAGS} SELECT feature, value, count(*) AS n, value IS NULL OR value IN (0, 1) AS is_allowed FROM flags GROUP BY 1, 2""")
def flag_values(spark, d):
    return quality.flag_values(_flags(spark, d), ["quality", "toxic", "odd"])


_ALLOWED = {"event_type": ("view", "click", "purchase", "error")}


@query("category_domain_check", """SELECT 'event_type' AS feature, count(*) AS n_total, count(*) AS n_not_null, 0::BIGINT AS n_null, count(DISTINCT event_type) AS n_values,
 count(DISTINCT event_type) FILTER (event_type = 'signup') AS n_invalid_values, count(*) FILTER (event_type = 'signup') AS n_invalid_rows, true AS has_errors FROM events""")
def category_domain_check(spark, d):
    return quality.check_categories(table(spark, d, "events"), _ALLOWED)


@query("invalid_category_values", "SELECT 'event_type' AS feature, event_type AS value, count(*) AS n FROM events WHERE event_type = 'signup' GROUP BY ALL")
def invalid_category_values(spark, d):
    return quality.invalid_values(quality.category_values(table(spark, d, "events"), _ALLOWED))


@query("validation_report", """WITH f AS (SELECT 'flag' AS "check", 'big' AS feature, (value > 300)::INT + (value > 350)::INT AS v FROM events)
SELECT "check", feature, count(*) AS n_total, count(*) AS n_not_null, 0::BIGINT AS n_null, count(DISTINCT v) AS n_values,
 count(DISTINCT v) FILTER (v > 1) AS n_invalid_values, count(*) FILTER (v > 1) AS n_invalid_rows, count(*) FILTER (v > 1) > 0 AS has_errors FROM f GROUP BY ALL
UNION ALL SELECT 'category', 'event_type', count(*), count(*), 0, count(DISTINCT event_type), count(DISTINCT event_type) FILTER (event_type = 'signup'),
 count(*) FILTER (event_type = 'signup'), true FROM events""")
def validation_report(spark, d):
    e = table(spark, d, "events").withColumn("big", (F.col("value") > 300).cast("int") + (F.col("value") > 350).cast("int"))
    return quality.validate(e, ["big"], _ALLOWED)


# ---- windows, sorts and sets -----------------------------------------------------------------------------

@query("cumulative_and_delta", """WITH t AS (SELECT p_size, sum(p_retailprice) AS v FROM part GROUP BY 1)
SELECT p_size::BIGINT AS p_size, round(sum(v) OVER (ORDER BY p_size), 3) AS cumulative, round(v - lag(v) OVER (ORDER BY p_size), 3) + 0.0 AS delta FROM t""")
def cumulative_and_delta(spark, d):
    w = Window.orderBy("p_size")  # at most one row per size code
    t = table(spark, d, "part").groupBy("p_size").agg(F.sum("p_retailprice").alias("v"))
    return out(t.select("p_size", F.sum("v").over(w).alias("cumulative"), (F.col("v") - F.lag("v").over(w)).alias("delta")), 3)


@query("row_numbers", "SELECT event_id, row_number() OVER (ORDER BY value DESC, event_id) AS rank FROM events")
def row_numbers(spark, d):
    return order.number_rows(table(spark, d, "events").select("event_id", "value"),
                             [F.col("value").desc(), F.col("event_id")], "rank").select("event_id", "rank")


@query("multi_key_top", "SELECT p_partkey, p_size::BIGINT AS p_size, p_retailprice FROM part ORDER BY p_size DESC, p_retailprice, p_partkey LIMIT 25")
def multi_key_top(spark, d):
    return longs(order.top_n(table(spark, d, "part").select("p_partkey", "p_size", "p_retailprice"), 25,
                             F.col("p_size").desc(), "p_retailprice", "p_partkey"))


@query("argmax_row", "SELECT event_type, arg_max(event_id, value * 1e9 - event_id) AS event_id, max(value) AS value FROM events GROUP BY 1")
def argmax_row(spark, d):
    return table(spark, d, "events").groupBy("event_type").agg(
        F.max_by("event_id", F.struct("value", -F.col("event_id"))).alias("event_id"), F.max("value").alias("value"))


@query("union_of_frames", "SELECT s_nationkey::BIGINT AS nation, s_acctbal AS balance FROM supplier UNION ALL SELECT c_nationkey, c_acctbal FROM customer")
def union_of_frames(spark, d):
    s = table(spark, d, "supplier").select(F.col("s_nationkey").alias("nation"), F.col("s_acctbal").alias("balance"))
    c = table(spark, d, "customer").select(F.col("c_acctbal").alias("balance"), F.col("c_nationkey").alias("nation"))
    return longs(s.unionByName(c))


@query("observed_not_allowed", "SELECT DISTINCT p_type AS value FROM part WHERE p_type NOT IN ('SMALL', 'LARGE')")
def observed_not_allowed(spark, d):
    allowed = spark.createDataFrame([("SMALL",), ("LARGE",)], "value string")
    return table(spark, d, "part").select(F.col("p_type").alias("value")).distinct().join(allowed, "value", "left_anti")


@query("distinct_values", "SELECT DISTINCT lang, source FROM documents")
def distinct_values(spark, d):
    return table(spark, d, "documents").select("lang", "source").distinct()
