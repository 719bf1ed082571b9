"""Imputation fitted on train and applied to train and test."""
from __future__ import annotations

from dataclasses import dataclass, field
from typing import Callable, Iterable, Sequence

import numpy as np
from pyspark.sql import DataFrame, functions as F, types as T

from tabulon.functions.numeric import clip
from tabulon.operators import neighbors
from tabulon.operators.order import fit_medians, quantiles
from tabulon.operators.moments import centred, cross_products, means
from tabulon.session import cut


@dataclass
class Imputed:
    """Result of one imputation: both frames and what was done."""
    train: DataFrame
    test: DataFrame
    strategy: str
    column: str
    info: dict = field(default_factory=dict)


def _check(train, test, column):
    if column not in train.columns or column not in test.columns:
        raise ValueError(f"column {column} must be in train and test")


def _fill(df: DataFrame, column: str, value: float) -> DataFrame:
    return df.withColumn(column, F.coalesce(F.col(column).cast("double"), F.lit(float(value))))


def impute_mean(train: DataFrame, test: DataFrame, column: str) -> Imputed:
    _check(train, test, column)
    value = train.agg(F.avg(column)).first()[0]
    if value is None:
        raise ValueError(f"{column} has no known value in train")
    return Imputed(_fill(train, column, value), _fill(test, column, value), "mean", column, {"value": float(value)})


def impute_median(train: DataFrame, test: DataFrame, column: str) -> Imputed:
    _check(train, test, column)
    value = fit_medians(train, [column])[column]
    if value is None:
        raise ValueError(f"{column} has no known value in train")
    return Imputed(_fill(train, column, value), _fill(test, column, value), "median", column, {"value": float(value)})


def impute_mean_median(train: DataFrame, test: DataFrame, column: str) -> dict[str, Imputed]:
    return {"mean": impute_mean(train, test, column), "median": impute_median(train, test, column)}


# ---- hierarchical group medians ---------------------------------------------------------------

def group_medians(train: DataFrame, column: str, levels: Sequence[Sequence[str]]) -> list[DataFrame]:
    """Per level a table (keys..., median) of groups with at least one known value."""
    every = sorted({k for keys in levels for k in keys if k in train.columns})
    known = cut(train.where(F.col(column).isNotNull()).select(*every, column))
    out = []
    for keys in levels:
        keys = list(keys)
        if all(k in train.columns for k in keys):
            out.append(quantiles(known, [column], [0.5], keys).select(*keys, F.col("q0").alias("median")))
    return out


def apply_group_medians(df: DataFrame, column: str, tables: list[DataFrame], overall: float,
                        level_col: str | None = None) -> DataFrame:
    """Fill NULLs from the finest level that knows the group, else with the overall median.

    ``level_col`` records the source: 0 kept, 1..L the level, L+1 the overall median.
    """
    value, level = F.col(column).cast("double"), F.when(F.col(column).isNotNull(), 0)
    out = df
    for i, table in enumerate(tables):
        keys = [c for c in table.columns if c != "median"]
        out = _lookup(out, table, keys, column, f"_m{i}")
        value = F.coalesce(value, F.col(f"_m{i}"))
        level = level.when(F.col(f"_m{i}").isNotNull(), i + 1)
    value = F.coalesce(value, F.lit(float(overall)))
    if level_col:
        out = out.withColumn(level_col, level.otherwise(len(tables) + 1))
    return out.withColumn(column, value).drop(*[f"_m{i}" for i in range(len(tables))])


def _lookup(df, table, keys, column, name):
    right = table.select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col("median").alias(name))
    cond = F.lit(True)
    for k in keys:
        cond = cond & (F.col(k) == F.col(f"_k_{k}"))
    return df.join(right, cond, "left").drop(*[f"_k_{k}" for k in keys])


def impute_group_median(train: DataFrame, test: DataFrame, column: str,
                        levels: Sequence[Sequence[str]]) -> Imputed:
    """Group medians from the finest to the coarsest level, then the overall median."""
    _check(train, test, column)
    overall = fit_medians(train, [column])[column]
    if overall is None:
        raise ValueError(f"{column} has no known value in train")
    tables = group_medians(train, column, levels)
    return Imputed(apply_group_medians(train, column, tables, overall),
                   apply_group_medians(test, column, tables, overall),
                   "group_median", column, {"value": overall, "levels": [list(x) for x in levels]})


# ---- model based --------------------------------------------------------------------------------

def predictors(df: DataFrame, column: str, id_col: str | None, wanted: Iterable[str] | None = None) -> list[str]:
    """Numeric columns other than the target and the id, or the wanted ones that exist."""
    if wanted is None:
        wanted = [f.name for f in df.schema
                  if isinstance(f.dataType, T.NumericType) and f.name not in {column, id_col}]
    out = [c for c in wanted if c in df.columns and c != column]
    if not out:
        raise ValueError(f"no numeric predictor for {column}")
    return out


def fill_medians(df: DataFrame, medians: dict[str, float | None], default: float | None = None) -> DataFrame:
    """coalesce(value, train median, default) for every fitted column, one projection."""
    def fill(c):
        out = [F.col(c).cast("double")]
        if medians[c] is not None:
            out.append(F.lit(float(medians[c])))
        if default is not None:
            out.append(F.lit(float(default)))
        return F.coalesce(*out).alias(c)
    return df.select([fill(c) if c in medians else F.col(c) for c in df.columns])


def _known(train, column):
    n = train.where(F.col(column).isNotNull()).count()
    if n < 2:
        raise ValueError(f"{column} needs at least two known values, found {n}")
    return n


def fit_linear(df: DataFrame, target: str, features: Sequence[str]) -> tuple[float, dict[str, float]]:
    """Least-squares intercept and coefficients (minimum norm if singular).

    Only the (p+1)x(p+1) centred moment matrix is solved here; the data stay on the executors.
    """
    names = [*features, target]
    shift = means(df, names)
    _, rest, c = centred(cross_products(df, names, shift)[0])
    mean, a, b = shift + rest, c[:-1, :-1], c[:-1, -1]
    s = np.sqrt(np.where(np.diag(a) > 0, np.diag(a), 1.0))
    w = np.linalg.lstsq(a / np.outer(s, s), b / s, rcond=1e-12)[0] / s
    return float(mean[-1] - np.dot(w, mean[:-1])), dict(zip(features, map(float, w)))


def impute_linear(train: DataFrame, test: DataFrame, column: str, id_col: str | None = None,
                  features: Iterable[str] | None = None, flag: str | None = None) -> Imputed:
    """Linear regression on the other numeric columns, predictions not below zero."""
    _check(train, test, column)
    cols = predictors(train, column, id_col, features)
    _known(train, column)
    medians = fit_medians(train, cols)
    filled = fill_medians(train.select(*cols, column), medians)
    intercept, weights = fit_linear(filled.where(F.col(column).isNotNull()), column, cols)
    guess = F.lit(intercept)
    for c in cols:
        known = [F.col(c).cast("double")] + ([F.lit(float(medians[c]))] if medians[c] is not None else [])
        guess = guess + F.coalesce(*known) * F.lit(weights[c])
    guess = clip(guess, low=0.0)

    def apply(df):
        out = df if flag is None else df.withColumn(flag, F.col(column).isNull())
        return out.withColumn(column, F.coalesce(F.col(column).cast("double"), guess))
    return Imputed(apply(train), apply(test), "linear", column,
                   {"features": cols, "intercept": intercept, "weights": weights})


def impute_knn(train: DataFrame, test: DataFrame, column: str, id_col: str,
               features: Iterable[str] | None = None, k: int = 5, scale: bool = False,
               flag: str | None = None) -> Imputed:
    """Inverse-distance mean of the k nearest known rows, not below zero.

    Predictors are unscaled unless ``scale``; a neighbour at distance zero takes all the weight.
    """
    from tabulon.operators.encode import apply_scaler, fit_standard
    _check(train, test, column)
    cols = predictors(train, column, id_col, features)
    k = max(1, min(int(k), _known(train, column)))
    medians = fit_medians(train, cols)
    scaler = fit_standard(fill_medians(train.select(*cols), medians), cols) if scale else None

    def ready(df):
        out = fill_medians(df.select(id_col, *cols, column), medians)
        return apply_scaler(out, scaler) if scaler else out
    refs = ready(train).where(F.col(column).isNotNull())

    def apply(df):
        asks = ready(df).where(F.col(column).isNull()).drop(column)
        near = neighbors.nearest(asks, refs, cols, k, id_col, payload=[column])
        guess = neighbors.weighted_mean(near, column).select(
            F.col("query_id").alias(id_col), clip(F.col("estimate"), low=0.0).alias("_guess"))
        out = df if flag is None else df.withColumn(flag, F.col(column).isNull())
        return (out.join(guess, id_col, "left")
                .withColumn(column, F.coalesce(F.col(column).cast("double"), F.col("_guess"))).drop("_guess"))
    return Imputed(apply(train), apply(test), "knn", column, {"features": cols, "k": k})


def imputed_stats(df: DataFrame, column: str, flag: str) -> DataFrame:
    """Mean, median, min and max of the imputed values; NULL if nothing was imputed."""
    rows = df.where(F.col(flag)).select(column)
    q = quantiles(rows, [column], [0.5]).select(F.col("q0").alias("median_imputed"))
    return rows.agg(F.count("*").alias("n_imputed"), F.avg(column).alias("mean_imputed"),
                    F.min(column).alias("min_imputed"), F.max(column).alias("max_imputed")
                    ).withColumn("_j", F.lit(1)).join(q.withColumn("_j", F.lit(1)), "_j").drop("_j")


def null_report(before: tuple[DataFrame, DataFrame], done: Imputed) -> DataFrame:
    """NULLs of the column before and after, in train and test."""
    def n(df):
        return df.agg(F.count_if(F.col(done.column).isNull())).first()[0]
    row = (done.strategy, done.column, n(before[0]), n(done.train), n(before[1]), n(done.test))
    return done.train.sparkSession.createDataFrame([row], (
        "strategy string, column string, missing_train_before bigint, missing_train_after bigint, "
        "missing_test_before bigint, missing_test_after bigint"))


# ---- dispatch -------------------------------------------------------------------------------------

# Menu codes of the four strategies.
STRATEGY_CODES = {"1": "mean", "2": "median", "3": "linear", "4": "knn"}
CODE_OF = {name: code for code, name in STRATEGY_CODES.items()}

_BY_NAME: dict[str, Callable[..., Imputed]] = {
    "mean": lambda tr, te, c, id_col, k: impute_mean(tr, te, c),
    "median": lambda tr, te, c, id_col, k: impute_median(tr, te, c),
    "linear": lambda tr, te, c, id_col, k: impute_linear(tr, te, c, id_col),
    "knn": lambda tr, te, c, id_col, k: impute_knn(tr, te, c, id_col, k=k),
}


def register_strategy(name: str, fn: Callable[..., Imputed]) -> None:
    """Add a strategy: fn(train, test, column, id_col, k) -> Imputed."""
    _BY_NAME[name] = fn


def impute(train: DataFrame, test: DataFrame, column: str, choice: str, id_col: str, k: int = 5) -> Imputed:
    """Run a strategy given by menu code or name."""
    name = STRATEGY_CODES.get(choice, choice)
    if name not in _BY_NAME:
        raise ValueError(f"unknown imputation strategy {choice}")
    return _BY_NAME[name](train, test, column, id_col, k)
