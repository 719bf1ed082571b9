"""Encoders and scalers: fit on one frame, apply to any frame (also a streaming one)."""
from __future__ import annotations

from dataclasses import dataclass
from typing import Iterable

from pyspark.sql import DataFrame, functions as F, types as T

from tabulon.operators.order import number_rows
from tabulon.session import cut


# ---- labels and indexes -------------------------------------------------------------------

def value_index(df: DataFrame, column: str, start: int = 0, name: str = "idx") -> DataFrame:
    """(column, idx) of the sorted distinct non-null values."""
    values = df.where(F.col(column).isNotNull()).select(column).distinct()
    return number_rows(values, [column], name=name).withColumn(
        name, (F.col(name) + (start - 1)).cast("int"))


def encode_label(df: DataFrame, label: str, name: str = "label_idx") -> DataFrame:
    """Numeric labels are cast to integer; others get the 0-based code of their sorted values."""
    if isinstance(df.schema[label].dataType, T.NumericType):
        return df.withColumn(name, F.col(label).cast("int"))
    return df.join(value_index(df, label, 0, name), label, "left")


def decode_label(df: DataFrame, index: DataFrame, label: str, column: str, name: str) -> DataFrame:
    """Inverse of ``encode_label``: integer codes in ``column`` back to label values."""
    back = index.select(F.col("idx").alias(column), F.col(label).alias(name))
    return df.join(back, column, "left")


def fit_geo_index(train: DataFrame, columns: Iterable[str]) -> dict[str, DataFrame]:
    """Per column a 1-based index of the values seen in training."""
    return {c: value_index(train, c, 1, f"{c}_idx") for c in columns}


def apply_geo_index(df: DataFrame, fitted: dict[str, DataFrame]) -> DataFrame:
    """Add ``<column>_idx``; values not seen in training get 0."""
    for c, index in fitted.items():
        df = df.join(index, c, "left").withColumn(f"{c}_idx", F.coalesce(F.col(f"{c}_idx"), F.lit(0)))
    return df


# ---- one-hot -------------------------------------------------------------------------------

@dataclass(frozen=True)
class OneHot:
    categories: dict[str, list]   # sorted values; None last when NULL is a category
    drop: bool = True

    def names(self, column: str) -> list[str]:
        return [f"{column}_{'nan' if v is None else v}" for v in self.categories[column]]


def fit_one_hot(train: DataFrame, columns: Iterable[str], null_column: bool | None = None,
                max_categories: int = 10_000) -> OneHot:
    """Learn each column's categories in one job.

    ``null_column=None`` makes NULL a category only where training has it, True
    always adds it, False never does. A category becomes a column, so a column with more
    than ``max_categories`` of them is an error; ``geo_index`` suits it.
    """
    columns = [c for c in columns if c in train.columns]
    if not columns:
        return OneHot({})
    cells = train.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns
    ])).alias("c")).select("c.*").distinct()
    cells = cut(cells)
    many = [r["column"] for r in cells.groupBy("column").count().where(F.col("count") > max_categories).collect()]
    if many:
        raise ValueError(f"more than {max_categories} categories in {sorted(many)}; use an index instead of one-hot columns")
    rows = cells.collect()  # at most max_categories a column
    found: dict[str, list] = {c: [] for c in columns}
    for r in rows:
        found[r["column"]].append(r["value"])
    cats = {}
    for c in columns:
        values = sorted(v for v in found[c] if v is not None)
        has_null = None in found[c]
        if null_column is True or (null_column is None and has_null):
            values.append(None)
        cats[c] = values
    return OneHot(cats)


def apply_one_hot(df: DataFrame, fitted: OneHot) -> DataFrame:
    """0/1 columns ``<column>_<value>`` in place of the originals; unseen values give zeros."""
    have = [c for c in fitted.categories if c in df.columns]
    out = [F.col(c) for c in df.columns if c not in have]
    for c in have:
        for v, name in zip(fitted.categories[c], fitted.names(c)):
            hit = F.col(c).isNull() if v is None else F.col(c).cast("string") == F.lit(v)
            out.append(F.coalesce(hit, F.lit(False)).cast("int").alias(name))
    return df.select(out)


def dummies(df: DataFrame, columns: Iterable[str] | None = None, null_column: bool = False) -> DataFrame:
    """One-hot of the frame's own text columns; ``null_column`` adds a NULL indicator for each."""
    if columns is None:
        columns = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    return apply_one_hot(df, fit_one_hot(df, columns, null_column=null_column))


# ---- scalers -------------------------------------------------------------------------------

@dataclass(frozen=True)
class Scaler:
    center: dict[str, float]
    scale: dict[str, float]


def fit_standard(train: DataFrame, columns: Iterable[str], center: bool = True) -> Scaler:
    """Mean and population deviation of each column in one aggregate; zero deviation scales by 1."""
    cols = [c for c in columns if c in train.columns]
    if not cols:
        raise ValueError("no column to standardise")
    aggs = []
    for i, c in enumerate(cols):
        aggs += [F.avg(c).alias(f"m{i}"), F.stddev_pop(c).alias(f"s{i}")]
    row = train.agg(*aggs).first()
    return Scaler({c: (row[f"m{i}"] or 0.0) if center else 0.0 for i, c in enumerate(cols)},
                  {c: row[f"s{i}"] or 1.0 for i, c in enumerate(cols)})


def fit_minmax(train: DataFrame, columns: Iterable[str]) -> Scaler:
    """Minimum and range of each column in one aggregate; zero range scales by 1."""
    cols = [c for c in columns if c in train.columns]
    aggs = []
    for i, c in enumerate(cols):
        aggs += [F.min(F.col(c).cast("double")).alias(f"a{i}"), F.max(F.col(c).cast("double")).alias(f"b{i}")]
    row = train.agg(*aggs).first()
    low = {c: row[f"a{i}"] or 0.0 for i, c in enumerate(cols)}
    return Scaler(low, {c: ((row[f"b{i}"] or 0.0) - low[c]) or 1.0 for i, c in enumerate(cols)})


def apply_scaler(df: DataFrame, fitted: Scaler) -> DataFrame:
    """(value - center) / scale for every fitted column the frame has; one projection."""
    return df.select([
        ((F.col(c).cast("double") - F.lit(float(fitted.center[c]))) / F.lit(float(fitted.scale[c]))).alias(c)
        if c in fitted.scale else F.col(c) for c in df.columns
    ])


def scaler_table(df: DataFrame, fitted: Scaler) -> DataFrame:
    """Fitted parameters as (column, mean_train, std_train)."""
    rows = [(c, float(fitted.center[c]), float(fitted.scale[c])) for c in fitted.scale]
    return df.sparkSession.createDataFrame(rows, "column string, mean_train double, std_train double")


def ranges(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """(column, min, max) after scaling, one aggregate."""
    cols = list(columns)
    one = df.agg(*[f(F.col(c).cast("double")).alias(f"{p}{i}")
                   for i, c in enumerate(cols) for p, f in (("a", F.min), ("b", F.max))])
    return one.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"a{i}").alias("min"), F.col(f"b{i}").alias("max"))
        for i, c in enumerate(cols)])).alias("r")).select("r.*")
