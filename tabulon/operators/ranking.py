"""Feature rankings: information gain, correlation and Relief."""
from __future__ import annotations

from typing import Iterable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from tabulon.operators import neighbors
from tabulon.operators.clean import (candidate_features, feature_kinds, few_valued, require_class_size,
                                     require_no_nulls)
from tabulon.operators.encode import apply_scaler, dummies, encode_label, fit_minmax
from tabulon.operators.order import top_n
from tabulon.operators.sampling import draw_with_replacement
from tabulon.session import cut


# ---- entropy and information gain ---------------------------------------------------------------

def _clogc(c, base):
    return c * F.log(float(base), c.cast("double"))


def entropy(df: DataFrame, column: str, base: float = 2.0) -> DataFrame:
    """One row: H(column) = log n - sum(c log c) / n, NULLs dropped, 0 for an empty column."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("c"))
    s = counts.agg(F.sum("c").cast("double").alias("n"), F.sum(_clogc(F.col("c"), base)).alias("s"))
    h = F.coalesce(F.log(float(base), F.col("n")) - F.col("s") / F.col("n"), F.lit(0.0))
    return s.select(F.when(F.abs(h) < 1e-10, F.lit(0.0)).otherwise(h).alias("entropy"))


def information_gain(df: DataFrame, label: str, features: Sequence[str], base: float = 2.0) -> DataFrame:
    """H(Y), H(Y|X), gain, rows and distinct values of every feature from one grouped count.

    Rows with a NULL in label or feature drop out pairwise. Sums of c*log(c) replace
    per-group windows, so a value held by a third of the rows is one partial count.
    """
    cells = df.where(F.col(label).isNotNull()).select(F.col(label).alias("y"), F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("x")) for c in features
    ])).alias("c")).select("y", "c.*").where("x IS NOT NULL")
    xy = cells.groupBy("feature", "x", "y").agg(F.count("*").alias("c"))

    def clogc(c):
        return _clogc(c, base)
    # Both margins from one lineage: a cell counts once for its value and once for its class.
    sides = xy.select("feature", "c", F.explode(F.array(
        F.struct(F.lit(0).alias("side"), F.col("x").alias("v")),
        F.struct(F.lit(1).alias("side"), F.col("y").cast("string").alias("v")))).alias("s")).select("feature", "c", "s.*")
    margins = sides.groupBy("feature", "side", "v").agg(F.sum("c").alias("m"), F.sum(clogc(F.col("c"))).alias("sc"))
    on_x, on_y = F.col("side") == 0, F.col("side") == 1
    f = margins.groupBy("feature").agg(
        F.sum(F.when(on_x, F.col("m"))).alias("n"), F.count_if(on_x).alias("n_unique_values"),
        F.sum(F.when(on_x, F.col("sc"))).alias("sxy"), F.sum(F.when(on_x, clogc(F.col("m")))).alias("sx"),
        F.sum(F.when(on_y, clogc(F.col("m")))).alias("sy"))
    none = df.sparkSession.createDataFrame([(c,) for c in features], "feature string")
    n = F.col("n").cast("double")
    h_y = F.coalesce(F.log(float(base), n) - F.col("sy") / n, F.lit(0.0))
    h_yx = F.coalesce((F.col("sx") - F.col("sxy")) / n, F.lit(0.0))
    # Sums of logarithms leave rounding noise around zero; the gain itself is never negative.
    snap = lambda c: F.when(F.abs(c) < 1e-10, F.lit(0.0)).otherwise(c)
    return none.join(f, "feature", "left").select(
        "feature", snap(h_y).alias("target_entropy"), snap(h_yx).alias("conditional_entropy"),
        snap(h_y - h_yx).alias("information_gain"), F.coalesce("n", F.lit(0)).cast("long").alias("n_samples"),
        F.coalesce("n_unique_values", F.lit(0)).cast("long").alias("n_unique_values"))


def rank_information_gain(df: DataFrame, label: str, exclude: Iterable[str] = (), base: float = 2.0,
                          few_valued_too: bool = False) -> dict[str, DataFrame]:
    """Ranking of the discrete features, the skipped ones, and a summary row.

    ``few_valued_too`` also takes non-integer columns with at most 50 values.
    """
    cand = candidate_features(df, label, exclude)
    view = df.select(cand)
    chosen = few_valued(view) if few_valued_too else [c for c in cand if c in set(feature_kinds(view)["discrete"])]
    if not chosen:
        raise ValueError("no discrete feature")
    ranking = information_gain(df, label, chosen, base).orderBy(F.col("information_gain").desc(), "feature")
    spark = df.sparkSession
    skipped = [c for c in cand if c not in chosen]
    summary = entropy(df, label, base).select(
        F.lit(label).alias("label_column"), F.lit(len(cand)).alias("n_feature_candidates"),
        F.lit(len(chosen)).alias("n_discrete_features"), F.lit(len(skipped)).alias("n_skipped_non_discrete"),
        F.col("entropy").alias("target_entropy_global"), F.lit(float(base)).alias("log_base"))
    return {"ranking": ranking, "skipped": spark.createDataFrame([(c,) for c in skipped], "skipped_feature string"),
            "summary": summary}


# ---- correlation ------------------------------------------------------------------------------------

def correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pairwise-complete Pearson correlation of every pair i < j: (i, j, feature_1, feature_2, corr).

    Co-moments of all pairs as matrix products per Arrow batch, added up by pair; a constant
    column (relative variance below 1e-12) gives NULL.
    """
    columns = list(columns)
    if len(columns) < 2:
        raise ValueError("at least two numeric features are needed")
    p = len(columns)
    means = df.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(columns)]).first()
    shift = np.array([means[f"m{i}"] or 0.0 for i in range(p)])
    x = df.select(*[F.col(c).cast("double").alias(f"v{i}") for i, c in enumerate(columns)])
    schema = "i int, j int, n double, si double, sj double, sii double, sjj double, sij double"
    upper = np.triu_indices(p, 1)

    def block(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = None
        for pdf in batches:
            a = pdf.to_numpy(dtype=float) - shift
            m = (~np.isnan(a)).astype(float)
            a = np.nan_to_num(a)
            sq = a * a
            part = np.stack([m.T @ m, a.T @ m, m.T @ a, sq.T @ m, m.T @ sq, a.T @ a])
            total = part if total is None else total + part
        if total is not None:
            yield pd.DataFrame({"i": upper[0], "j": upper[1],
                                **{name: total[q][upper] for q, name in
                                   enumerate(("n", "si", "sj", "sii", "sjj", "sij"))}})
    s = x.mapInPandas(block, schema).groupBy("i", "j").agg(*[
        F.sum(c).alias(c) for c in ("n", "si", "sj", "sii", "sjj", "sij")])
    cov = F.col("sij") - F.try_divide(F.col("si") * F.col("sj"), F.col("n"))
    vi = F.col("sii") - F.try_divide(F.col("si") * F.col("si"), F.col("n"))
    vj = F.col("sjj") - F.try_divide(F.col("sj") * F.col("sj"), F.col("n"))
    names = F.array(*[F.lit(c) for c in columns])
    tiny = 1e-12
    corr = F.when((vi > F.col("sii") * tiny) & (vj > F.col("sjj") * tiny), F.try_divide(cov, F.sqrt(vi) * F.sqrt(vj)))
    return s.select("i", "j", names[F.col("i")].alias("feature_1"), names[F.col("j")].alias("feature_2"),
                    corr.alias("corr"))


def correlation_matrix(pairs: DataFrame) -> DataFrame:
    """Both directions of every pair: (feature, other, corr)."""
    return (pairs.select(F.col("feature_1").alias("feature"), F.col("feature_2").alias("other"), "corr")
            .unionByName(pairs.select(F.col("feature_2").alias("feature"), F.col("feature_1").alias("other"), "corr")))


def redundancy_ranking(pairs: DataFrame) -> DataFrame:
    """Mean and largest absolute correlation of each feature with the others."""
    a = F.abs("corr")
    return correlation_matrix(pairs).groupBy("feature").agg(
        F.avg(a).alias("mean_abs_corr_with_other_features"), F.max(a).alias("max_abs_corr_with_other_features")
    ).orderBy(F.col("mean_abs_corr_with_other_features").desc(),
              F.col("max_abs_corr_with_other_features").desc(), "feature")


def top_pairs(pairs: DataFrame, n: int = 20) -> DataFrame:
    """The n most correlated pairs by absolute value; undefined pairs are left out."""
    return top_n(pairs.where(F.col("corr").isNotNull()).select(
        "feature_1", "feature_2", "corr", F.abs("corr").alias("abs_corr")),
        n, F.col("abs_corr").desc(), "feature_1", "feature_2")


def rank_correlations(df: DataFrame, label: str | None = None, exclude: Iterable[str] = ()) -> dict[str, DataFrame]:
    """Pairs, redundancy ranking and, with a label, supervised and combined rankings (one data pass)."""
    cand = candidate_features(df, label, exclude)
    numeric = [c for c in cand if c in set(feature_kinds(df)["numeric"])]
    if len(numeric) < 2:
        raise ValueError("at least two numeric features are needed")
    if label is None:
        pairs = cut(correlations(df, numeric))
        return {"pairs": pairs, "redundancy": redundancy_ranking(pairs)}
    coded = encode_label(df, label, "_y")
    # p*p rows that three rankings share: computed once.
    every = cut(correlations(coded.select(*numeric, F.col("_y").cast("double").alias("_y")), [*numeric, "_y"]))
    pairs = every.where("feature_2 <> '_y'")
    redundancy = redundancy_ranking(pairs)
    supervised = every.where("feature_2 = '_y'").select(
        F.col("feature_1").alias("feature"), F.col("corr").alias("corr_with_label"),
        F.abs("corr").alias("abs_corr_with_label"))
    combined = redundancy.join(supervised, "feature", "left").withColumn(
        "balance_score", F.col("abs_corr_with_label") - F.col("mean_abs_corr_with_other_features"))
    return {"pairs": pairs, "redundancy": redundancy,
            "supervised": supervised.orderBy(F.col("abs_corr_with_label").desc_nulls_last(), "feature"),
            "combined": combined.orderBy(F.col("balance_score").desc_nulls_last(), "feature")}


# ---- Relief --------------------------------------------------------------------------------------------

def relief(df: DataFrame, id_col: str, label: str, exclude: Iterable[str] = (), n_iterations: int | None = 5000,
           k: int = 50, seed: int = 42, encode: bool = True) -> dict[str, DataFrame]:
    """Relief weights: mean of miss distance minus hit distance per min-max scaled feature.

    ``n_iterations`` rows are drawn with replacement (None takes every row once). The hit
    and the miss are the nearest other rows of the same and of another class among the k
    nearest; a draw without both is skipped.
    """
    cand = [c for c in candidate_features(df, label, exclude) if c != id_col]
    work = encode_label(df.select(id_col, label, *cand), label, "_y").drop(label)
    if encode:
        work = dummies(work, feature_kinds(work.select(cand))["categorical"])
    features = [c for c in work.columns if c not in (id_col, "_y")]
    require_no_nulls(work, features)
    require_class_size(work, "_y", 2)
    scaled = cut(apply_scaler(work, fit_minmax(work, features)))
    n = scaled.count()
    k = max(3, min(int(k), n))
    if n_iterations is None:
        drawn = scaled.select(id_col, "_y", *features).withColumn("times", F.lit(1))
    else:
        if n_iterations <= 0:
            raise ValueError("n_iterations must be positive")
        times = draw_with_replacement(scaled.select(id_col), id_col, n_iterations, seed).groupBy(id_col).agg(
            F.count("*").alias("times"))
        drawn = scaled.join(times, id_col)
    # Neighbours carry id and class only; features are fetched for the hit and the miss of a draw.
    near = neighbors.nearest(drawn, scaled, features, k, id_col, payload=["_y"])
    near = near.where(F.col("neighbor_id") != F.col("query_id"))
    own = drawn.select(F.col(id_col).alias("query_id"), F.col("_y").alias("y0"), "times")
    place = F.struct("rank", F.col("neighbor_id").alias("id"))
    same = F.col("_y") == F.col("y0")
    picked = cut(near.join(own, "query_id").groupBy("query_id").agg(
        F.first("times").alias("times"), F.min(F.when(same, place)).alias("hit"), F.min(F.when(~same, place)).alias("miss"))
        .where("hit IS NOT NULL AND miss IS NOT NULL").select("query_id", "times", F.col("hit.id").alias("hit"), F.col("miss.id").alias("miss")))
    rows = scaled.select(F.col(id_col).alias("_id"), F.array(*features).alias("_x"))

    def fetch(t, key, name):
        return t.join(rows.select(F.col("_id").alias(key), F.col("_x").alias(name)), key)
    three = fetch(fetch(fetch(picked, "query_id", "q"), "hit", "h"), "miss", "m")

    def gap(name, i):
        return (F.col("q")[i] - F.col(name)[i]) * (F.col("q")[i] - F.col(name)[i])
    total = three.agg(F.sum("times").alias("n_valid"), *[
        F.sum(F.col("times") * (gap("m", i) - gap("h", i))).alias(f"w{i}") for i in range(len(features))]).first()
    n_valid = total["n_valid"]
    if not n_valid:
        raise ValueError("no draw has both a hit and a miss among its neighbours")
    spark = df.sparkSession  # one row of sums gives both results
    ranking = spark.createDataFrame([(c, total[f"w{i}"] / n_valid, abs(total[f"w{i}"] / n_valid)) for i, c in enumerate(features)],
                                    "feature string, relief_weight double, abs_relief_weight double")
    draws = n if n_iterations is None else n_iterations
    summary = spark.createDataFrame([(n, len(features), draws, n_valid, k)],
                                    "n_samples bigint, n_features int, n_draws bigint, n_valid bigint, k int")
    return {"ranking": ranking.orderBy(F.col("relief_weight").desc(), "feature"), "summary": summary}


def head(ranking: DataFrame, score: str, n: int, name: str = "feature") -> DataFrame:
    """Top n of a ranking; ``name`` breaks ties."""
    return top_n(ranking, n, F.col(score).desc_nulls_last(), name)
