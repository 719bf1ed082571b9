"""Branches the given tables do not reach."""
import pytest
from pyspark.sql import functions as F

from tabulon import BUILDING_DAMAGE
from tabulon.functions import text
from tabulon.operators import clean, encode, evaluate, impute, outliers, quality
from tabulon.sources import readers, writers


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_ascii_fold(spark):
    df = spark.createDataFrame([(" Ñ ",), ("é",), ("ß",), ("",), (None,), (" Ａb ",), ("\t x\n",)], "s string")
    got = [r[0] for r in df.select(text.clean_category(F.col("s"))).collect()]
    assert got == ["n", "e", None, None, None, "b", "x"]


def test_fold_equals_python_on_all_marks(spark):
    import unicodedata
    chars = [chr(c) for c in range(0x80, 0x2500)]
    df = spark.createDataFrame([(i, f"a{c}b") for i, c in enumerate(chars)], "i int, s string")
    got = {r[0]: r[1] for r in df.select("i", text.ascii_fold(F.col("s"))).collect()}
    want = {i: unicodedata.normalize("NFD", f"a{c}b").encode("ascii", "ignore").decode() for i, c in enumerate(chars)}
    assert got == want


def test_floored_bound_and_null_is_no_outlier(spark):
    df = spark.createDataFrame([(v,) for v in (-5.0, 0.0, 1.0, 2.0, 3.0, 100.0, None)], "v double")
    r = outliers.iqr_report(df, ["v"], k=1.5).first()
    assert (r["q1"], r["q3"], r["lower_bound"], r["upper_bound"], r["n_outliers"]) == (0.25, 2.75, 0.0, 6.5, 2)
    assert r["perc_outliers"] == round(2 / 7 * 100, 2)
    free = outliers.iqr_report(df, ["v"], k=1.5, floor=None).first()
    assert free["lower_bound"] == -3.5


def test_iqr_zero_counts_rare_values(spark):
    df = spark.createDataFrame([(1.0,)] * 398 + [(2.0,), (0.0,)], "v double")
    r = outliers.iqr_report(df, ["v"]).first()
    assert (r["iqr"], r["lower_bound"], r["upper_bound"], r["n_outliers"]) == (0.0, 1.0, 1.0, 2)
    assert outliers.fit_bounds(df, ["v"]) == {"v": (1.0, 1.0)}


def test_constant_column(spark):
    df = spark.createDataFrame([(3.0,), (3.0,)], "v double")
    assert rows(encode.apply_scaler(df, encode.fit_standard(df, ["v"]))) == [(0.0,), (0.0,)]
    assert rows(encode.apply_scaler(df, encode.fit_minmax(df, ["v"]))) == [(0.0,), (0.0,)]


def test_one_hot_unseen_and_null(spark):
    train = spark.createDataFrame([("a",), ("b",)], "c string")
    test = spark.createDataFrame([("a",), ("c",), (None,)], "c string")
    got = encode.apply_one_hot(test, encode.fit_one_hot(train, ["c"]))
    assert got.columns == ["c_a", "c_b"] and rows(got) == [(0, 0), (0, 0), (1, 0)]
    seen_null = encode.fit_one_hot(test, ["c"])
    assert seen_null.names("c") == ["c_a", "c_c", "c_nan"]


def test_duplicates_with_null_keys(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,), (None,)], "k int")
    assert quality.duplicate_keys(df, "k").first()["n_duplicates"] == 2
    with pytest.raises(ValueError):
        quality.duplicate_keys(df, "other")


def test_later_duplicates_of_a_null_key(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), (5, 3), (5, 4), (6, 5)], "k int, o int")
    got = {r["o"]: r["is_duplicate"] for r in quality.mark_later_duplicates(df, "k", "o").collect()}
    assert got == {1: 0, 2: 1, 3: 0, 4: 1, 5: 0}
    assert quality.drop_duplicate_keys(df, "k", "o").count() == 3


def test_hierarchy_falls_back_to_global(spark):
    train = spark.createDataFrame([(1, 1, 1, 10.0), (1, 1, 1, 20.0), (1, 2, 3, 40.0), (2, 5, 6, None)],
                                  "a int, b int, c int, v double")
    test = spark.createDataFrame([(1, 1, 1, None), (1, 1, 9, None), (1, 7, 7, None), (8, 8, 8, None), (1, 1, 1, 5.0)],
                                 "a int, b int, c int, v double")
    levels = [["a", "b", "c"], ["a", "b"], ["a"]]
    tables = impute.group_medians(train, "v", levels)
    got = rows(impute.apply_group_medians(test, "v", tables, 20.0, "level").select("level", "v"))
    assert got == [(0, 5.0), (1, 15.0), (2, 15.0), (3, 20.0), (4, 20.0)]


def test_imputation_errors_and_codes(spark):
    empty = spark.createDataFrame([(1, None)], "id int, v double")
    for fn in (impute.impute_mean, impute.impute_median):
        with pytest.raises(ValueError):
            fn(empty, empty, "v")
    with pytest.raises(ValueError):
        impute.impute(empty, empty, "v", "9", "id")
    assert impute.CODE_OF["knn"] == "4"


def test_knn_imputation_zero_distance_takes_all(spark):
    train = spark.createDataFrame([(1, 1.0, 10.0), (2, 1.0, 20.0), (3, 9.0, 90.0), (4, 1.0, None)], "id int, x double, v double")
    done = impute.impute_knn(train, train, "v", "id", ["x"], k=3)
    assert {r["id"]: r["v"] for r in done.train.collect()}[4] == 15.0


def test_linear_imputation_matches_numpy(spark):
    import numpy as np
    rng = np.random.default_rng(1)
    x = rng.normal(size=(60, 3))
    y = 3 + x @ [1.0, -2.0, 0.5] + rng.normal(size=60) * 0.1
    data = [(i, *map(float, x[i]), None if i % 7 == 0 else float(y[i])) for i in range(60)]
    df = spark.createDataFrame(data, "id int, a double, b double, c double, v double")
    known = [i for i in range(60) if i % 7]
    coef = np.linalg.lstsq(np.column_stack([np.ones(len(known)), x[known]]), y[known], rcond=None)[0]
    got = {r["id"]: r["v"] for r in impute.impute_linear(df, df, "v", "id").train.collect()}
    for i in range(0, 60, 7):
        assert abs(got[i] - max(0.0, coef[0] + x[i] @ coef[1:])) < 1e-8


def test_guards(spark):
    df = spark.createDataFrame([(1, None, "a"), (2, 1.0, "b"), (3, 2.0, "b")], "id int, v double, y string")
    with pytest.raises(ValueError):
        clean.require_no_nulls(df, ["v"])
    with pytest.raises(ValueError):
        clean.require_numeric(df, ["y"])
    with pytest.raises(ValueError):
        clean.require_class_size(df, "y", 2)
    with pytest.raises(ValueError):
        clean.candidate_features(df, "y", ["id", "v"])


def test_nan_becomes_null(spark):
    df = spark.createDataFrame([(float("nan"),), (1.0,)], "v double")
    assert clean.nan_to_null(df).where("v IS NULL").count() == 1


def test_default_spec_reports_bad_codes(spark):
    df = spark.createDataFrame([("n", 1), ("zz", 7), (None, 0)], "roof_type string, monum_flag int")
    rep = {r["feature"]: r for r in quality.validate(df, BUILDING_DAMAGE.flags, BUILDING_DAMAGE.allowed).collect()}
    assert rep["roof_type"]["n_invalid_rows"] == 1 and rep["roof_type"]["n_null"] == 1
    assert rep["monum_flag"]["has_errors"]


def test_sources_and_sinks(spark, tmp_path):
    values = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id int, c string")
    labels = spark.createDataFrame([(1, 5), (2, 6)], "id int, y int")
    base = str(tmp_path)
    writers.write_table(values, f"{base}/v.csv", "csv")
    writers.write_table(labels, f"{base}/l.parquet")
    assert readers.load_labelled(spark, "id", f"{base}/v.csv", f"{base}/l.parquet").count() == 2
    with pytest.raises(FileNotFoundError):
        readers.load_labelled(spark, "id", f"{base}/none", f"{base}/none2")
    with pytest.raises(ValueError):
        readers.load_preprocessed(spark, f"{base}/l.parquet", ("nope",))
    with pytest.raises(ValueError):
        readers.map_labels(values, labels.unionByName(labels), "id", "y")
    assert readers.read_feature_list(spark, f"{base}/absent.csv", "c") == []
    assert readers.read_feature_list(spark, f"{base}/v.csv", "absent") == []
    assert readers.read_params(spark, f"{base}/absent") == {}
    raw, lab, test = readers.read_raw(spark, f"{base}/v.csv", f"{base}/l.parquet", f"{base}/v.csv", BUILDING_DAMAGE)
    assert raw.count() == test.count() == 3 and lab.count() == 2


def test_history_check_finds_breaks(spark):
    bad = spark.createDataFrame([(1, 0, 1, "a"), (2, 1, 2, "a"), (3, 3, 4, "b")],
                                "step int, n_features_before int, n_features_after int, feature string")
    r = evaluate.history_is_consistent(bad, 1).first()
    assert (r["n_steps"], r["n_bad_steps"], r["n_repeated"]) == (3, 1, 1)
