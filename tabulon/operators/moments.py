"""Sums of cross products of many columns in one pass."""
from __future__ import annotations

from typing import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F


def means(df: DataFrame, columns: Sequence[str]) -> np.ndarray:
    row = df.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(columns)]).first()
    return np.array([row[i] if row[i] is not None else 0.0 for i in range(len(columns))], dtype=float)


def cross_products(df: DataFrame, columns: Sequence[str], shift: np.ndarray | None = None,
                   fold: str | None = None) -> dict[int, np.ndarray]:
    """Per fold the matrix of sums of products of (1, columns - shift).

    Every Arrow batch is one matrix product; tasks emit p*p partial sums, which are
    added up by entry, so nothing but those p*p numbers reaches the driver.
    """
    p = len(columns) + 1
    at = np.zeros(p - 1) if shift is None else np.asarray(shift, dtype=float)
    which = F.col(fold).cast("int") if fold else F.lit(0)
    x = df.select(which.alias("fold"), *[F.col(c).cast("double").alias(f"v{i}") for i, c in enumerate(columns)])
    i, j = np.triu_indices(p)

    def block(batches):
        sums: dict = {}
        for pdf in batches:
            for f, part in pdf.groupby("fold"):
                a = np.column_stack([np.ones(len(part)), part.iloc[:, 1:].to_numpy(dtype=float) - at])
                sums[f] = sums.get(f, 0.0) + a.T @ a
        for f, m in sums.items():
            yield pd.DataFrame({"fold": np.full(len(i), f, dtype="int32"), "i": i, "j": j, "s": m[i, j]})
    out: dict[int, np.ndarray] = {}
    cells = x.mapInPandas(block, "fold int, i int, j int, s double")
    for r in cells.groupBy("fold", "i", "j").agg(F.sum("s").alias("s")).collect():
        m = out.setdefault(r["fold"], np.zeros((p, p)))
        m[r["i"], r["j"]] = m[r["j"], r["i"]] = r["s"]
    return out


def centred(m: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """(rows, means, population covariance) of a cross-product matrix."""
    n = m[0, 0]
    mean = m[0, 1:] / n
    return n, mean, m[1:, 1:] / n - np.outer(mean, mean)
