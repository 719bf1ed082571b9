"""Exact, reproducible sampling and splitting in hash order.

Every operator orders rows by md5(id:seed), so the result depends neither on
partitioning nor on the engine; sizes are exact.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tabulon.operators.order import (
    bucketed, by_hash_rank, by_value_rank, hash_order, hash_rank, number_rows, value_bins)
from tabulon.session import cut


def _first_rows(df: DataFrame, id_col: str, seed: int, by: list[str], quota) -> DataFrame:
    """The first quota(class size) rows of every class in hash order."""
    return by_hash_rank(df, id_col, seed, by, lambda rn, n: rn <= quota(n), "_in").where("_in").drop("_in")


def balanced_sample(df: DataFrame, id_col: str, label: str, max_per_class: int, seed: int = 42) -> DataFrame:
    """At most ``max_per_class`` rows of every class."""
    return _first_rows(df.where(F.col(label).isNotNull()), id_col, seed, [label], lambda n: F.lit(int(max_per_class)))


def stratified_sample(df: DataFrame, id_col: str, label: str, n: int, seed: int = 42) -> DataFrame:
    """round(share * n) rows of every class (half to even); the whole table if n covers it."""
    total = df.count()
    if n >= total:
        return df
    labelled = df.where(F.col(label).isNotNull())
    known = labelled.count()
    return _first_rows(labelled, id_col, seed, [label],
                       lambda size: F.bround(size.cast("double") / F.lit(float(known)) * F.lit(float(n)), 0))


def uniform_sample(df: DataFrame, id_col: str, n: int, seed: int = 42) -> DataFrame:
    """Exactly n rows without replacement."""
    return _first_rows(df, id_col, seed, [], lambda size: F.lit(int(n)))


def shuffled(df: DataFrame, id_col: str, seed: int = 42, name: str = "shuffle_no") -> DataFrame:
    """All rows with their position in the reproducible shuffle."""
    return hash_rank(df, id_col, seed, rank=name).drop("class_n")


def _allocation(df: DataFrame, label: str, n: int) -> dict:
    """Largest-remainder allocation of n rows to the classes; sums to n exactly."""
    counts = {r[0]: r[1] for r in df.groupBy(label).count().collect()}
    total = sum(counts.values())
    exact = {c: n * k / total for c, k in counts.items()}
    out = {c: int(v) for c, v in exact.items()}
    order = sorted(counts, key=lambda c: (-(exact[c] - out[c]), str(c)))
    for c in order[: n - sum(out.values())]:
        out[c] += 1
    return out


def _quota(label: str, alloc: dict) -> Column:
    out = F.lit(0)
    for value, k in alloc.items():
        out = F.when(F.col(label).eqNullSafe(F.lit(value)), F.lit(k)).otherwise(out)
    return out


def cap_rows(df: DataFrame, id_col: str, label: str, n: int | None, seed: int = 42) -> DataFrame:
    """Stratified sample of exactly n rows when the table is larger (the ``max_rows`` option)."""
    if n is None or df.count() <= n:
        return df
    quota = _quota(label, _allocation(df, label, int(n)))
    return _first_rows(df, id_col, seed, [label], lambda size: quota)


def mark_split(df: DataFrame, id_col: str, label: str, test_share: float = 0.2, seed: int = 42,
               name: str = "is_test") -> DataFrame:
    """Stratified train/test mark: the first bround(share * class size) rows of each class are test."""
    if not 0 < test_share < 1:
        raise ValueError("test_share must be in (0, 1)")
    return by_hash_rank(df, id_col, seed, [label], lambda rn, n: (
        rn <= F.bround(n.cast("double") * F.lit(float(test_share)), 0)).cast("int"), name)


def split(df: DataFrame, id_col: str, label: str, test_share: float = 0.2, seed: int = 42,
          materialize: bool = False) -> tuple[DataFrame, DataFrame]:
    """Disjoint, complete (train, test) pair; ``materialize`` evaluates the source once for both."""
    marked = mark_split(df, id_col, label, test_share, seed, name="_test")
    if materialize:
        marked = cut(marked)
    return (marked.where("_test = 0").drop("_test"), marked.where("_test = 1").drop("_test"))


def fold_of(rn: Column, n: Column, k: int) -> Column:
    """Contiguous fold number of rank rn out of n rows; the first n % k folds hold one more."""
    rn = rn - 1
    small, extra = F.floor(n / F.lit(k)), n % F.lit(k)
    big = extra * (small + 1)
    later = extra + F.floor(F.try_divide(rn - big, small))
    return F.when(rn < big, F.floor(rn / (small + 1))).otherwise(later).cast("int")


def stratified_folds(df: DataFrame, id_col: str, label: str, k: int = 5, shuffle: bool = True,
                     seed: int = 42, name: str = "fold") -> DataFrame:
    """0-based stratified fold per row: in id order, or in hash order when shuffled."""
    if k < 2:
        raise ValueError("k must be at least 2")
    def value(rn, n):
        return fold_of(rn, n, k)
    if shuffle:
        return by_hash_rank(df, id_col, seed, [label], value, name)
    return by_value_rank(df, id_col, [label], value, name)


def draw_with_replacement(df: DataFrame, id_col: str, m: int, seed: int = 42) -> DataFrame:
    """m draws with replacement: (draw, row), draw i takes row md5(i:seed) mod n in id order.

    Counts of id ranges and of bins inside them give the bin and the place in it of every draw; only bins that a draw
    has hit are ranked, so the ids are never sorted as a whole and the table is not copied. Ids that are not numbers
    are numbered by a sort.
    """
    spark = df.sparkSession
    at = F.conv(F.substring(F.md5(F.concat_ws(":", F.col("id").cast("string"), F.lit(str(seed)))), 1, 15), 16, 10).cast("long")
    if not isinstance(df.schema[id_col].dataType, T.NumericType):
        numbered = number_rows(df, [id_col], name="_no")
        draws = spark.range(m).select(F.col("id").alias("draw"), (at % F.lit(max(numbered.count(), 1)) + 1).alias("_no"))
        return draws.join(numbered, "_no").drop("_no")
    keyed = value_bins(df, id_col, "_range", "_bin")
    bins = cut(keyed.groupBy("_range", "_bin").agg(F.count("*").alias("_c")))
    start, starts = 0, []
    for r in bins.groupBy("_range").agg(F.sum("_c").alias("c")).orderBy("_range").collect():  # at most RANGES rows
        starts.append((r["_range"], start))
        start += r["c"]
    draws = spark.range(m).select(F.col("id").alias("draw"), (at % F.lit(max(start, 1))).alias("_at"))
    draws = bucketed(draws.withColumn("_d", F.col("_at").cast("double")), "_d", [s for _, s in starts[1:]], "_i")
    firsts = spark.createDataFrame([(i, r, s) for i, (r, s) in enumerate(starts)], "_i int, _range int, _start long")
    over = Window.partitionBy("_range").orderBy("_bin")
    ends = bins.withColumn("_to", F.sum("_c").over(over)).withColumn("_from", F.col("_to") - F.col("_c"))
    placed = cut(draws.join(firsts, "_i").withColumn("_at", F.col("_at") - F.col("_start")).join(ends, "_range")
                 .where("_at >= _from AND _at < _to").select("draw", "_range", "_bin", (F.col("_at") - F.col("_from") + 1).alias("_no")))
    hit = keyed.join(placed.select("_range", "_bin").distinct(), ["_range", "_bin"], "left_semi").withColumn(
        "_no", F.row_number().over(Window.partitionBy("_range", "_bin").orderBy(id_col)).cast("long"))
    return placed.join(hit, ["_range", "_bin", "_no"]).drop("_range", "_bin", "_no")


__all__ = ["balanced_sample", "stratified_sample", "uniform_sample", "shuffled", "cap_rows", "mark_split",
           "split", "stratified_folds", "draw_with_replacement", "hash_order"]
