"""Preprocessing from raw tables to model-ready ones; lazy apart from the fitted scalars."""
from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from tabulon.operators import encode, evaluate, impute, neighbors, outliers, quality
from tabulon.operators.clean import labelled_rows, normalize_names, null_outside, upper_flag
from tabulon.operators.order import fit_medians
from tabulon.operators.sampling import cap_rows, split
from tabulon.session import cut
from tabulon.sources.readers import join_labels, map_labels
from tabulon.spec import DatasetSpec


@dataclass(frozen=True)
class Transform:
    """Fitted state of a preprocessing run; applies to any frame, also a streaming one."""
    bounds: dict
    fills: dict
    scaler: encode.Scaler
    one_hot: encode.OneHot
    age_col: str | None = None
    age_upper: float | None = None

    def apply(self, df: DataFrame) -> DataFrame:
        """Flag, outliers to NULL, fill, scale, one-hot: projections only, no state and no shuffle."""
        out = normalize_names(df)
        if self.age_col and self.age_upper is not None and self.age_col in out.columns:
            out = upper_flag(out, self.age_col, self.age_upper)
        out = null_outside(out, self.bounds)
        fills = {c: v for c, v in self.fills.items() if c in out.columns}
        out = impute.fill_medians(out, fills)
        return encode.apply_one_hot(encode.apply_scaler(out, self.scaler), self.one_hot)


@dataclass
class Preprocessed:
    train: DataFrame
    test: DataFrame
    labelled: DataFrame
    strategy: str | None
    bounds: dict
    scaler: encode.Scaler
    one_hot: encode.OneHot
    reports: dict = field(default_factory=dict)
    transform: Transform | None = None   # only for the mean and median strategies


def _model_ready(df: DataFrame, id_col: str, label: str, seed: int, test_share: float):
    """One-hot with NULL column, split, median/0 fill and scaling without centring: (train, valid, features)."""
    wide = encode.dummies(df, [c for c, t in df.dtypes if t == "string" and c not in (id_col, label)], null_column=True)
    features = [c for c in wide.columns if c not in (id_col, label)]
    train, valid = split(wide, id_col, label, test_share, seed, materialize=True)
    # One-hot columns are never NULL, only the columns that were numeric before can need a fill.
    medians = fit_medians(train, [c for c in features if c in df.columns])
    train, valid = impute.fill_medians(train, medians, 0.0), impute.fill_medians(valid, medians, 0.0)
    scaler = encode.fit_standard(train, features, center=False)
    return encode.apply_scaler(train, scaler), encode.apply_scaler(valid, scaler), features


def knn_accuracy(df: DataFrame, id_col: str, label: str, k: int = 5, test_share: float = 0.2,
                 seed: int = 42) -> dict:
    """Holdout accuracy of a distance-weighted vote on one-hot, filled, scaled features."""
    train, valid, features = _model_ready(df, id_col, label, seed, test_share)
    done = neighbors.classify(train, valid, features, label, id_col, k).join(valid.select(id_col, label), id_col)
    s = evaluate.scores(done, label, "prediction").first()
    return {"accuracy": s["accuracy"], "f1_micro": s["f1_micro"], "n_features": len(features), "n_valid": s["n"]}


def compare_imputations(train: DataFrame, labels: DataFrame, column: str, id_col: str, label: str,
                        strategies=("mean", "median", "linear", "knn"), max_rows: int | None = None, k: int = 5,
                        test_share: float = 0.2, seed: int = 42) -> DataFrame:
    """(strategy, accuracy, n_rows, n_features, missing_after) of each strategy, best first.

    ``max_rows`` is the stratified row cap of the comparison; None uses every row.
    """
    data = labelled_rows(map_labels(train, labels, id_col, label), label)
    data = cut(cap_rows(data, id_col, label, max_rows, seed))
    n, rows = data.count(), []
    for s in strategies:
        done = impute.impute(data.drop(label), data.drop(label).limit(0), column, s, id_col, k)
        full = cut(done.train.join(data.select(id_col, label), id_col))
        left = full.agg(F.count_if(F.col(column).isNull())).first()[0]
        got = knn_accuracy(full, id_col, label, k, test_share, seed)
        rows.append((s, round(got["accuracy"], 6), n, got["n_features"], left))
    return train.sparkSession.createDataFrame(
        rows, "strategy string, accuracy double, n_rows bigint, n_features int, missing_after bigint"
    ).orderBy(F.col("accuracy").desc(), "strategy")


def choose_imputation(train: DataFrame, labels: DataFrame, columns, id_col: str, label: str, **options) -> tuple[str, DataFrame]:
    """Best strategy by mean accuracy over the columns, and the per-column results."""
    parts = [compare_imputations(train, labels, c, id_col, label, **options).withColumn("column", F.lit(c))
             for c in columns]
    results = reduce(DataFrame.unionByName, parts)
    return evaluate.strategy_summary(results).first()["strategy"], results


def compare_multipliers(train: DataFrame, labels: DataFrame, columns, id_col: str, label: str,
                        ks=(1.5, 2.0, 2.5, 3.0, 4.0), max_rows: int | None = None, seed: int = 42) -> DataFrame:
    """(k, n_outliers, accuracy, f1_micro): effect of the IQR multiplier on a kNN holdout score."""
    stats = outliers.sweep(train, columns, ks).collect()
    rows = []
    for k in ks:
        mine = [r for r in stats if r["k"] == k]
        bounds = {r["column"]: (r["lower_bound"], r["upper_bound"]) for r in mine}
        fills = {r["column"]: r["fill_median"] for r in mine}
        data = impute.fill_medians(null_outside(train, bounds), fills)
        data = cut(cap_rows(join_labels(data, labels, id_col), id_col, label, max_rows, seed))
        got = knn_accuracy(data, id_col, label, seed=seed)
        rows.append((float(k), sum(r["n_outliers"] for r in mine), got["accuracy"], got["f1_micro"]))
    return train.sparkSession.createDataFrame(rows, "k double, n_outliers bigint, accuracy double, f1_micro double")


def best_multiplier(results: DataFrame) -> float:
    """First k with the largest f1_micro."""
    return results.orderBy(F.col("f1_micro").desc(), "k").first()["k"]


def preprocess(train: DataFrame, labels: DataFrame, test: DataFrame, spec: DatasetSpec, strategy: str = "auto",
               k: float = 3.0, max_rows: int | None = None, seed: int = 42) -> Preprocessed:
    """Quality reports, flag, outliers, imputation, validation, scaling, one-hot and label join.

    Everything is fitted on train. ``strategy`` is a menu code, a name, or "auto" for the
    best strategy by ``compare_imputations``.
    """
    train, test = normalize_names(train), normalize_names(test)
    cols = [c for c in spec.present(train, "continuous") if c in test.columns]
    reports = {"duplicates": quality.duplicate_keys(train, spec.id_col),
               "outliers_train": outliers.iqr_report(train, cols, k), "outliers_test": outliers.iqr_report(test, cols, k)}
    bounds = outliers.fit_bounds(train, cols, k, only_with_outliers=True)
    upper = None
    if spec.age_col in train.columns:
        upper = outliers.fit_bounds(train, [spec.age_col], k)[spec.age_col][1]
        train, test = upper_flag(train, spec.age_col, upper), upper_flag(test, spec.age_col, upper)
    train, test = cut(null_outside(train, bounds)), cut(null_outside(test, bounds))

    chosen, fills = None, {}
    if bounds:
        chosen = strategy
        if strategy == "auto":
            chosen, reports["imputation_results"] = choose_imputation(
                train, labels, list(bounds), spec.id_col, spec.label_col, max_rows=max_rows, seed=seed)
        for c in bounds:  # later columns see the values imputed before
            done = impute.impute(train, test, c, chosen, spec.id_col)
            train, test = cut(done.train), cut(done.test)
            fills[c] = done.info.get("value")

    flags, allowed = spec.present(train, "flags"), {c: v for c, v in spec.allowed.items() if c in train.columns}
    if flags or allowed:
        reports["validation_train"] = quality.validate(train, flags, allowed)
        reports["validation_test"] = quality.validate(test, flags, allowed)
    scaler = encode.fit_standard(train, cols)
    one_hot = encode.fit_one_hot(train, spec.present(train, "categorical"))
    train = encode.apply_one_hot(encode.apply_scaler(train, scaler), one_hot)
    test = encode.apply_one_hot(encode.apply_scaler(test, scaler), one_hot)
    labelled = join_labels(train, labels, spec.id_col)
    reports["nulls"] = quality.null_share(labelled)
    reports["classes"] = quality.class_distribution(labelled, spec.label_col)
    simple = all(v is not None for v in fills.values())
    transform = Transform(bounds, fills, scaler, one_hot, spec.age_col, upper) if simple else None
    return Preprocessed(train, test, labelled, chosen, bounds, scaler, one_hot, reports, transform)
