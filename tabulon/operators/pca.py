"""Principal components from one covariance aggregate."""
from __future__ import annotations

from dataclasses import dataclass
from typing import Iterable, Sequence

import numpy as np
from pyspark.sql import DataFrame, Window, functions as F

from tabulon.operators.clean import require_no_nulls, require_numeric
from tabulon.operators.moments import centred, cross_products, means


@dataclass(frozen=True)
class Components:
    features: list[str]
    mean: list[float]
    variance: list[float]          # descending eigenvalues of the sample covariance
    loadings: list[list[float]]    # one row per component, largest absolute entry positive


def covariance(df: DataFrame, features: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Means and sample covariance matrix; two passes, only p*p numbers reach the driver."""
    shift = means(df, features)
    got = cross_products(df, features, shift)
    n = got[0][0, 0] if got else 0
    if n < 2:
        raise ValueError("at least two rows are needed")
    _, rest, c = centred(got[0])
    return shift + rest, c * n / (n - 1)


def fit_pca(df: DataFrame, exclude: Iterable[str] = (), n_components: int | None = None) -> Components:
    """Fit on all numeric, non-null columns but the excluded ones; data are centred, not scaled."""
    skip = set(exclude)
    features = [c for c in df.columns if c not in skip]
    require_numeric(df, features)
    require_no_nulls(df, features)
    if n_components is not None and not 0 < n_components <= len(features):
        raise ValueError("n_components out of range")
    mean, cov = covariance(df, features)
    values, vectors = np.linalg.eigh(cov)
    order = np.argsort(values)[::-1][: n_components or len(features)]
    loads = vectors[:, order].T
    for row in loads:
        if row[np.abs(row).argmax()] < 0:
            row *= -1
    return Components(features, mean.tolist(), np.maximum(values[order], 0).tolist(), loads.tolist())


def apply_pca(df: DataFrame, fitted: Components, keep: Iterable[str] = ()) -> DataFrame:
    """Project to PC1..PCk, keeping the named columns in front."""
    missing = [c for c in [*fitted.features, *keep] if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}")
    out = []
    for i, row in enumerate(fitted.loadings):
        pc = F.lit(0.0)
        for c, m, w in zip(fitted.features, fitted.mean, row):
            pc = pc + (F.col(c).cast("double") - F.lit(m)) * F.lit(w)
        out.append(pc.alias(f"PC{i + 1}"))
    return df.select(*keep, *out)


def variance_table(df: DataFrame, fitted: Components) -> DataFrame:
    """(component, explained, cumulative, delta) rounded to six digits."""
    raw = df.sparkSession.createDataFrame(
        [(i + 1, float(v)) for i, v in enumerate(fitted.variance)], "component_no int, v double")
    w = Window.partitionBy(F.lit(1)).orderBy("component_no")
    ev = F.round("v", 6)
    return raw.select(
        F.concat(F.lit("PC"), F.col("component_no")).alias("component"), "component_no",
        ev.alias("explained_variance"), F.round(F.sum("v").over(w), 6).alias("cumulative_explained_variance"),
        F.round(ev - F.lag(ev).over(w), 6).alias("delta_explained_variance"))


def loadings_table(df: DataFrame, fitted: Components) -> DataFrame:
    rows = [(f"PC{i + 1}", c, float(v)) for i, row in enumerate(fitted.loadings) for c, v in zip(fitted.features, row)]
    return df.sparkSession.createDataFrame(rows, "component string, feature string, loading double")


def elbow_table(table: DataFrame) -> DataFrame:
    """Distance of every scree point to the chord between the first and the last one."""
    every = Window.partitionBy(F.lit(1))
    x, y = F.col("component_no").cast("double"), F.col("explained_variance")
    y1 = F.min_by("explained_variance", "component_no").over(every)
    y2 = F.max_by("explained_variance", "component_no").over(every)
    dx = F.max("component_no").over(every) - 1
    dy = y2 - y1
    cross = F.abs(dx * (y - y1) - dy * (x - 1))
    dist = F.coalesce(F.try_divide(cross, F.sqrt(dx * dx + dy * dy)), F.lit(0.0))
    return table.select("component_no", "explained_variance", dist.alias("chord_distance"))


def elbow(table: DataFrame) -> int:
    """Number of components at the elbow; the first maximum wins."""
    return elbow_table(table).orderBy(F.col("chord_distance").desc(), "component_no").first()["component_no"]


def run_pca(train: DataFrame, test: DataFrame, id_cols: Sequence[str], label: str | None = None,
            labels: DataFrame | None = None, exclude: Iterable[str] = (), n_components: int | None = None) -> dict:
    """Fit all components, choose how many (elbow unless given), project both frames, re-attach the label."""
    keep = [c for c in id_cols if c in train.columns]
    skip = {*exclude, *id_cols, *([label] if label else [])}
    skip_train = [c for c in train.columns if c in skip]
    require_no_nulls(train, train.columns)
    require_no_nulls(test, test.columns)
    full = fit_pca(train, skip_train)
    table = variance_table(train, full)
    n = n_components or elbow(table)
    if not 0 < n <= len(full.features):
        raise ValueError("n_components out of range")
    chosen = Components(full.features, full.mean, full.variance[:n], full.loadings[:n])
    out = {"variance": table, "loadings": loadings_table(train, chosen), "n_components": n, "fitted": chosen,
           "train": apply_pca(train, chosen, keep),
           "test": apply_pca(test, chosen, [c for c in id_cols if c in test.columns])}
    source = labels if labels is not None else train if label in train.columns else None
    if label and source is not None:
        out["train_with_label"] = out["train"].join(source.select(*keep, label), keep)
    return out
