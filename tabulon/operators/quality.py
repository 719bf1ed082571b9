"""Data-quality reports; each is one aggregate over the table."""
from __future__ import annotations

from typing import Iterable

from pyspark.sql import DataFrame, Window, functions as F

from tabulon.operators.clean import normalize_names


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """One row: rows, distinct keys (NULL is one key) and later occurrences."""
    if key not in df.columns:
        raise ValueError(f"no key column {key}")
    keys = df.groupBy(key).agg(F.count("*").alias("c"))
    return keys.agg(F.coalesce(F.sum("c"), F.lit(0)).cast("long").alias("n_rows"),
                    F.count("*").alias("n_keys"),
                    (F.coalesce(F.sum("c"), F.lit(0)) - F.count("*")).cast("long").alias("n_duplicates"))


def mark_later_duplicates(df: DataFrame, key: str, order_col: str, name: str = "is_duplicate") -> DataFrame:
    """1 for every row of a key but the first in a unique order.

    Joins on (key, order), so a key with many rows is spread over all tasks.
    """
    first = df.groupBy(F.col(key).alias("_k")).agg(F.min(order_col).alias("_o"))
    same = F.col(key).eqNullSafe(F.col("_k")) & (F.col(order_col) == F.col("_o"))
    return (df.join(first, same, "left")
            .withColumn(name, F.when(F.col("_o").isNull(), 1).otherwise(0)).drop("_k", "_o"))


def drop_duplicate_keys(df: DataFrame, key: str, order_col: str) -> DataFrame:
    return mark_later_duplicates(df, key, order_col, "_dup").where("_dup = 0").drop("_dup")


def _null_sum(columns):
    total = F.lit(0)
    for c in columns:
        total = total + F.col(c).isNull().cast("int")
    return total


def total_nulls(df: DataFrame) -> DataFrame:
    return df.agg(F.coalesce(F.sum(_null_sum(df.columns)), F.lit(0)).cast("long").alias("total_nulls"))


def null_share(df: DataFrame) -> DataFrame:
    """(column, n_null, null_pct) of every column, from one aggregate."""
    one = df.agg(F.count("*").alias("_n"),
                 *[F.count_if(F.col(c).isNull()).alias(f"c{i}") for i, c in enumerate(df.columns)])
    return one.select("_n", F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"c{i}").alias("n_null"))
        for i, c in enumerate(df.columns)])).alias("r")).select(
        "r.column", "r.n_null", F.try_divide(F.col("r.n_null") * 100.0, F.col("_n")).alias("null_pct"))


def sparse_columns(df: DataFrame, threshold: float = 70.0) -> DataFrame:
    return null_share(df).where(F.col("null_pct") > threshold)


def sparse_rows(df: DataFrame, id_col: str, threshold: float = 70.0) -> DataFrame:
    """(id, null_pct) of the rows with more than ``threshold`` percent NULLs."""
    pct = _null_sum(df.columns) * 100.0 / F.lit(len(df.columns))
    return df.select(id_col, pct.alias("null_pct")).where(F.col("null_pct") > threshold)


def class_distribution(df: DataFrame, label: str) -> DataFrame:
    """(label, n, pct) with one decimal; the window runs over the few class rows only."""
    counts = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count("*").alias("n"))
    every = Window.partitionBy(F.lit(1))
    return counts.withColumn("pct", F.round(F.col("n") * 100.0 / F.sum("n").over(every), 1)).orderBy(label)


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Balanced weights N / (K * n_k) per class."""
    counts = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count("*").alias("n"))
    every = Window.partitionBy(F.lit(1))
    return counts.withColumn(
        "weight", F.sum("n").over(every) / (F.count("*").over(every) * F.greatest(F.col("n"), F.lit(1))))


def _cells(df: DataFrame, columns: list[str], kind: str) -> DataFrame:
    return df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).cast(kind).alias("value")) for c in columns
    ])).alias("c")).select("c.*").groupBy("feature", "value").agg(F.count("*").alias("n"))


def flag_values(df: DataFrame, flags: Iterable[str], allowed: Iterable[float] = (0.0, 1.0)) -> DataFrame:
    """Every distinct value of every flag column with its count and whether it is allowed."""
    cols = [c for c in flags if c in df.columns]
    ok = F.col("value").isin([float(v) for v in allowed])
    return _cells(df, cols, "double").withColumn("is_allowed", F.when(F.col("value").isNull(), True).otherwise(ok))


def category_values(df: DataFrame, allowed: dict[str, Iterable[str]]) -> DataFrame:
    """Every distinct value of every category column, checked against its allowed set."""
    cols = [c for c in allowed if c in df.columns]
    rows = [(c, v, True) for c in cols for v in allowed[c]]
    known = df.sparkSession.createDataFrame(rows, "feature string, value string, _ok boolean")
    return (_cells(df, cols, "string").join(known, ["feature", "value"], "left")
            .withColumn("is_allowed", F.col("value").isNull() | F.coalesce("_ok", F.lit(False))).drop("_ok"))


def domain_summary(values: DataFrame) -> DataFrame:
    """Per feature: rows, non-null, null, distinct values, invalid values, invalid rows, has_errors."""
    null, bad = F.col("value").isNull(), ~F.col("is_allowed")
    n = F.col("n")
    zero = F.lit(0)
    return values.groupBy("feature").agg(
        F.sum("n").cast("long").alias("n_total"),
        F.sum(F.when(null, zero).otherwise(n)).cast("long").alias("n_not_null"),
        F.sum(F.when(null, n).otherwise(zero)).cast("long").alias("n_null"),
        F.count_if(~null).alias("n_values"),
        F.count_if(bad).alias("n_invalid_values"),
        F.sum(F.when(bad, n).otherwise(zero)).cast("long").alias("n_invalid_rows"),
        (F.count_if(bad) > 0).alias("has_errors"))


def check_flags(df: DataFrame, flags: Iterable[str], allowed: Iterable[float] = (0.0, 1.0)) -> DataFrame:
    return domain_summary(flag_values(df, flags, allowed))


def check_categories(df: DataFrame, allowed: dict[str, Iterable[str]]) -> DataFrame:
    return domain_summary(category_values(df, allowed))


def invalid_values(values: DataFrame) -> DataFrame:
    """The observed values outside the allowed set, with their row counts."""
    return values.where(~F.col("is_allowed")).drop("is_allowed")


def validate(df: DataFrame, flags: Iterable[str], allowed: dict[str, Iterable[str]],
             flag_allowed: Iterable[float] = (0.0, 1.0)) -> DataFrame:
    """Flag and category checks in one report; rows are reported, never dropped."""
    parts = []
    flags = [c for c in flags if c in df.columns]
    allowed = {c: v for c, v in allowed.items() if c in df.columns}
    if flags:
        parts.append(check_flags(df, flags, flag_allowed).withColumn("check", F.lit("flag")))
    if allowed:
        parts.append(check_categories(df, allowed).withColumn("check", F.lit("category")))
    if not parts:
        raise ValueError("no flag or category column to check")
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def run_checks(df: DataFrame, key: str, continuous: Iterable[str], k: float = 3.0):
    """Normalised frame, duplicate count and outlier report."""
    from tabulon.operators.outliers import iqr_report
    clean = normalize_names(df)
    return clean, duplicate_keys(clean, key), iqr_report(clean, continuous, k=k)
