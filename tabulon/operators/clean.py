"""Projection, filters and precondition guards."""
from __future__ import annotations

import math
from typing import Iterable

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tabulon.functions.text import clean_category


def normalize_names(df: DataFrame) -> DataFrame:
    """Lower-case and strip every column name."""
    return df.toDF(*[c.lower().strip() for c in df.columns])


def clean_categories(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """ASCII-fold and normalise the listed text columns that exist."""
    have = set(df.columns)
    return df.withColumns({c: clean_category(F.col(c)) for c in columns if c in have})


def nan_to_null(df: DataFrame) -> DataFrame:
    """Missing values are SQL NULL everywhere; NaN from outside sources becomes NULL."""
    floats = {f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    return df.select([
        F.when(~F.isnan(c), F.col(c)).alias(c) if c in floats else F.col(c) for c in df.columns
    ])


def candidate_features(df: DataFrame, label: str | None, exclude: Iterable[str] = ()) -> list[str]:
    """All columns but the label and the excluded ones, in order."""
    skip = set(exclude) | {label}
    out = [c for c in df.columns if c not in skip]
    if not out:
        raise ValueError("no candidate feature is left")
    return out


def existing(df: DataFrame, wanted: Iterable[str], fallback_first: int | None = None) -> list[str]:
    """The wanted columns the frame has; optionally its first columns when none matches."""
    have = set(df.columns)
    out = [c for c in wanted if c in have]
    if not out:
        if fallback_first is None:
            raise ValueError("none of the requested features exists")
        out = df.columns[:fallback_first]
    return out


def feature_kinds(df: DataFrame) -> dict[str, list[str]]:
    """Split columns by type: numeric, categorical (text) and discrete (text, bool, integer)."""
    kinds: dict[str, list[str]] = {"numeric": [], "categorical": [], "discrete": []}
    for f in df.schema:
        if isinstance(f.dataType, T.NumericType):
            kinds["numeric"].append(f.name)
        if isinstance(f.dataType, T.StringType):
            kinds["categorical"].append(f.name)
        if isinstance(f.dataType, (T.StringType, T.BooleanType, T.IntegralType)):
            kinds["discrete"].append(f.name)
    return kinds


def few_valued(df: DataFrame, max_distinct: int = 50) -> list[str]:
    """Discrete columns plus every other column with at most ``max_distinct`` values.

    A pass with one sketch per column sorts out the columns with far more values; only the others are counted by
    value, of which each task then holds few. The answer is exact: d values fill at most d of a sketch's m registers,
    so its estimate is at most m * ln(m / (m - d)), which is below 2 * d as long as m is at least 4 * d.
    """
    discrete = set(feature_kinds(df)["discrete"])
    rest = [c for c in df.columns if c not in discrete]
    keep = set(discrete)
    if rest:
        bits = max(9, math.ceil(math.log2(4 * max(1, max_distinct))))
        error = 1.106 / 2 ** (bits / 2)  # gives 2^bits registers
        few = df.agg(*[F.approx_count_distinct(F.col(c).cast("string"), error).alias(f"n{i}") for i, c in enumerate(rest)]).first()
        rest = [c for i, c in enumerate(rest) if few[f"n{i}"] <= 2 * max(1, max_distinct)]
    if rest:
        cells = df.select(F.explode(F.array(*[
            F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("value")) for c in rest
        ])).alias("cell")).select("cell.*").where("value IS NOT NULL")
        counted = cells.groupBy("feature", "value").agg(F.lit(1).alias("one")).groupBy("feature").count()
        n = {r["feature"]: r["count"] for r in counted.collect()}
        keep |= {c for c in rest if n.get(c, 0) <= max_distinct}
    return [c for c in df.columns if c in keep]


def outside(col: Column, lower: float, upper: float) -> Column:
    return (col < F.lit(lower)) | (col > F.lit(upper))


def null_outside(df: DataFrame, bounds: dict[str, tuple[float, float]]) -> DataFrame:
    """Values outside their inclusive bounds become NULL, all columns in one projection."""
    return df.select([
        F.when(~outside(F.col(c), *bounds[c]), F.col(c)).alias(c) if c in bounds else F.col(c)
        for c in df.columns
    ])


def outside_counts(df: DataFrame, bounds: dict[str, tuple[float, float]]) -> DataFrame:
    """(column, lower, upper, n_replaced) of ``null_outside``, from one aggregate."""
    cols = [c for c in df.columns if c in bounds]
    one = df.agg(*[F.count_if(outside(F.col(c), *bounds[c])).alias(c) for c in cols])
    return one.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.lit(float(bounds[c][0])).alias("lower"),
                 F.lit(float(bounds[c][1])).alias("upper"), F.col(c).alias("n_replaced"))
        for c in cols
    ])).alias("r")).select("r.*")


def null_inside(df: DataFrame, column: str, low: float, high: float, mask: str | None = None) -> DataFrame:
    """Values inside the inclusive range (sentinels) become NULL; optionally keep the mask."""
    if column not in df.columns:
        raise ValueError(f"no column {column}")
    hit = F.coalesce(F.col(column).between(low, high), F.lit(False))
    out = df if mask is None else df.withColumn(mask, hit)
    return out.withColumn(column, F.when(~hit, F.col(column)))


def upper_flag(df: DataFrame, column: str, above: float, at_most: float = 250.0,
               name: str = "monum_flag") -> DataFrame:
    """1 where above < value <= at_most, else 0 (NULL gives 0)."""
    hit = (F.col(column) > F.lit(above)) & (F.col(column) <= F.lit(at_most))
    return df.withColumn(name, F.coalesce(hit, F.lit(False)).cast("int"))


def labelled_rows(df: DataFrame, label: str) -> DataFrame:
    """Rows with a label, label as integer."""
    return df.where(F.col(label).isNotNull()).withColumn(label, F.col(label).cast("int"))


def require_numeric(df: DataFrame, columns: Iterable[str]) -> None:
    kinds = {f.name: f.dataType for f in df.schema}
    bad = [c for c in columns if not isinstance(kinds[c], (T.NumericType, T.BooleanType))]
    if bad:
        raise ValueError(f"not numeric: {bad}")


def null_counts(df: DataFrame, columns: Iterable[str]) -> dict[str, int]:
    cols = list(columns)
    row = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"c{i}") for i, c in enumerate(cols)]).first()
    return {c: row[f"c{i}"] for i, c in enumerate(cols)}


def require_no_nulls(df: DataFrame, columns: Iterable[str]) -> None:
    bad = {c: n for c, n in null_counts(df, columns).items() if n}
    if bad:
        raise ValueError(f"impute first, NULL counts: {bad}")


def require_class_size(df: DataFrame, label: str, at_least: int = 2) -> None:
    bad = df.groupBy(label).count().where(F.col("count") < at_least).limit(5).collect()
    if bad:
        raise ValueError(f"classes with fewer than {at_least} rows, for example {[r[0] for r in bad]}")
