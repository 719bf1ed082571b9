"""Exact order statistics and row numbers that never put one group into one task."""
from __future__ import annotations

import math
from typing import Iterable, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window, functions as F

from tabulon.session import cut

# Above this many values per group the built-in percentile (buffers in one task per group) is not used.
GROUP_LIMIT = 4_000_000
_SPLITS = 1000
#: Ranges of a numeric column, and bins of each.
RANGES = 1024
BINS = 256


def _largest_group(df: DataFrame, keys: Sequence[str]) -> int:
    return df.groupBy(*keys).count().agg(F.max("count")).first()[0] or 0


def quantiles(df: DataFrame, columns: Iterable[str], probs: Sequence[float],
              keys: Sequence[str] = (), group_limit: int = GROUP_LIMIT) -> DataFrame:
    """Exact linearly interpolated quantiles: one row per (keys, column), one ``q<i>`` per prob.

    NULLs are skipped; a group without values gives NULL. Small groups use the
    built-in aggregate. Larger ones are counted per distinct value, cut into value
    ranges by global splitters, and only the ranges that hold a wanted rank are sorted.
    """
    columns, probs, keys = list(columns), [float(p) for p in probs], list(keys)
    # The whole table bounds every group, so most tables need one cheap count only.
    rows = group_limit // max(1, len(columns))
    if df.count() <= rows or (keys and _largest_group(df, keys) <= rows):
        arr = F.array(*[F.lit(p) for p in probs])
        wide = df.groupBy(*keys).agg(*[
            F.percentile(F.col(c).cast("double"), arr).alias(f"_q{i}") for i, c in enumerate(columns)
        ])
        cells = F.explode(F.array(*[
            F.struct(F.lit(c).alias("column"), F.col(f"_q{i}").alias("q")) for i, c in enumerate(columns)
        ]))
        return wide.select(*keys, cells.alias("_c")).select(
            *keys, "_c.column", *[F.col("_c.q")[i].alias(f"q{i}") for i in range(len(probs))])
    return _ranged_quantiles(df, columns, probs, keys)


def bucketed(df: DataFrame, column: str, edges: Sequence[float], name: str) -> DataFrame:
    """Number of the value range of a non-null double column, by binary search over the edges."""
    if not len(edges):
        return df.withColumn(name, F.lit(0))
    splits = [-math.inf, *sorted({float(e) for e in edges}), math.inf]
    return Bucketizer(splits=splits, inputCol=column, outputCol=name).transform(df).withColumn(
        name, F.col(name).cast("int"))


def _ranged_quantiles(df, columns, probs, keys):
    cells = df.select(*keys, F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns
    ])).alias("_c")).select(*keys, "_c.column", "_c.value").where("value IS NOT NULL")
    by = [*keys, "column"]
    counts = cut(cells.groupBy(*by, "value").agg(F.count("*").alias("c")))

    grid = F.array(*[F.lit(i / _SPLITS) for i in range(1, _SPLITS)])
    splits = {r["column"]: sorted(set(r["s"])) for r in counts.groupBy("column").agg(
        F.percentile_approx("value", grid, F.lit(10 * _SPLITS)).alias("s")).collect()}
    bucket = F.lit(0)
    for i, (name, s) in enumerate(splits.items()):
        counts = bucketed(counts, "value", s, f"_b{i}")
        bucket = F.when(F.col("column") == name, F.col(f"_b{i}")).otherwise(bucket)
    counts = counts.withColumn("bucket", bucket).drop(*[f"_b{i}" for i in range(len(splits))])

    ranges = counts.groupBy(*by, "bucket").agg(F.sum("c").alias("bc"))
    over = Window.partitionBy(*by)
    ranges = (ranges
              .withColumn("before", F.sum("bc").over(over.orderBy("bucket")) - F.col("bc"))
              .withColumn("n", F.sum("bc").over(over)))

    def rank(p: float, up: bool) -> Column:
        h = (F.col("n") - 1) * F.lit(p)
        return (F.ceil(h) if up else F.floor(h)).cast("long")

    wanted = [rank(p, up) for p in probs for up in (False, True)]
    hit = F.lit(False)
    for r in wanted:
        hit = hit | ((r >= F.col("before")) & (r < F.col("before") + F.col("bc")))
    ranges = ranges.where(hit).drop("bc")

    inside = Window.partitionBy(*by, "bucket").orderBy("value")
    placed = (counts.join(ranges, [*by, "bucket"])
              .withColumn("hi", F.col("before") + F.sum("c").over(inside))
              .withColumn("lo", F.col("hi") - F.col("c")))

    def at(r: Column) -> Column:
        return F.max(F.when((r >= F.col("lo")) & (r < F.col("hi")), F.col("value")))

    aggs = [F.first("n").alias("n")]
    for i, p in enumerate(probs):
        aggs += [at(rank(p, False)).alias(f"a{i}"), at(rank(p, True)).alias(f"b{i}")]
    out = placed.groupBy(*by).agg(*aggs)
    for i, p in enumerate(probs):
        h = (F.col("n") - 1) * F.lit(p)
        out = out.withColumn(f"q{i}", F.col(f"a{i}") + (h - F.floor(h)) * (F.col(f"b{i}") - F.col(f"a{i}")))
    return out.select(*by, *[f"q{i}" for i in range(len(probs))])


def fit_quantiles(df: DataFrame, columns: Iterable[str], probs: Sequence[float],
                  group_limit: int = GROUP_LIMIT) -> dict[str, list[float | None]]:
    """Table-wide quantiles as fitted values, one list per column."""
    columns = list(columns)
    rows = quantiles(df, columns, probs, group_limit=group_limit).collect()
    out = {r["column"]: [r[f"q{i}"] for i in range(len(probs))] for r in rows}
    return {c: out.get(c, [None] * len(probs)) for c in columns}


def fit_medians(df: DataFrame, columns: Iterable[str]) -> dict[str, float | None]:
    return {c: q[0] for c, q in fit_quantiles(df, columns, [0.5]).items()}


def number_rows(df: DataFrame, order: Sequence[str | Column], name: str = "row_no") -> DataFrame:
    """1-based row number over the whole frame in a total order.

    The range-sorted frame is materialised and every partition's offset is added to its own positions.
    """
    placed = cut(df.orderBy(*order).withColumn("_m", F.monotonically_increasing_id()))
    part, pos = F.shiftright("_m", 33), F.col("_m").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = sorted(placed.groupBy(part.alias("p")).count().collect())
    start, starts = 0, {}
    for p, n in sizes:
        starts[p] = start
        start += n
    offsets = df.sparkSession.createDataFrame(list(starts.items()), "_p bigint, _start bigint")
    return (placed.withColumn("_p", part.cast("bigint")).join(offsets, "_p")
            .withColumn(name, (F.col("_start") + pos + 1).cast("long")).drop("_m", "_p", "_start"))


def hash_order(id_col: str, seed: int) -> Column:
    """Reproducible random order key that any SQL engine can compute."""
    return F.md5(F.concat_ws(":", F.col(id_col).cast("string"), F.lit(str(seed))))


def _ranged(df: DataFrame, bucket: Column, order: Sequence[str], by: list[str], rank: str, total: str,
            value=None, name: str | None = None) -> DataFrame:
    """Rank within each class in an order that ``bucket`` cuts into ranges.

    Range sizes give each range's offset, so a class is never sorted as a whole. With a
    ``value(rank, size)`` that is monotone in the rank, a range whose first and last row
    agree is settled by its offset alone: its rows pass without sort or shuffle, and only
    the few ranges that hold a step of the value are sorted.
    """
    keyed = df.withColumn("_b", bucket)
    over = Window.partitionBy(*(by or [F.lit(1)]))
    sizes = (keyed.groupBy(*by, "_b").agg(F.count("*").alias("_c"))
             .withColumn("_before", F.sum("_c").over(over.orderBy("_b")) - F.col("_c"))
             .withColumn(total, F.sum("_c").over(over)))
    extra = []
    if value is not None:
        first, last = value(F.col("_before") + 1, F.col(total)), value(F.col("_before") + F.col("_c"), F.col(total))
        sizes = sizes.withColumn("_v", first).withColumn("_edge", ~first.eqNullSafe(last))
        extra = ["_v", "_edge"]
    keys = [*by, "_b"]
    right = cut(sizes.select(*[F.col(c).alias(f"_r_{c}") for c in keys], "_before", total, *extra))  # read by two branches
    same = F.lit(True)
    for c in keys:
        same = same & F.col(c).eqNullSafe(F.col(f"_r_{c}"))
    joined = keyed.join(right, same)
    place = (F.col("_before") + F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).cast("long")
    work = ["_b", "_before", *[f"_r_{c}" for c in keys], *extra]
    if value is None:
        return joined.withColumn(rank, place).drop(*work)
    sure = joined.where(~F.col("_edge")).withColumn(name, F.col("_v"))
    edge = joined.where(F.col("_edge")).withColumn("_rn", place).withColumn(
        name, value(F.col("_rn"), F.col(total))).drop("_rn")
    return sure.unionByName(edge).drop(*work, total)


def hash_rank(df: DataFrame, id_col: str, seed: int, by: Sequence[str] = (),
              rank: str = "rn", total: str = "class_n") -> DataFrame:
    """Exact 1-based rank in hash order within each class, and the class size."""
    keyed = df.withColumn("_h", hash_order(id_col, seed))
    return _ranged(keyed, F.substring("_h", 1, 3), ["_h", id_col], list(by), rank, total).drop("_h")


def by_hash_rank(df: DataFrame, id_col: str, seed: int, by: Sequence[str], value, name: str) -> DataFrame:
    """Column ``name`` = value(rank, class size) for a value that is monotone in the hash rank."""
    keyed = df.withColumn("_h", hash_order(id_col, seed))
    return _ranged(keyed, F.substring("_h", 1, 3), ["_h", id_col], list(by), "rn", "class_n", value, name).drop("_h")


def value_bins(df: DataFrame, order_col: str, range_name: str, bin_name: str) -> DataFrame:
    """Ranges of about equal size of a numeric column and, in each, bins of equal width; both ascend with the value.

    At most ``RANGES`` ranges of ``BINS`` bins, so that a bin of 10^11 evenly spread values holds some 400,000 rows.
    NULL lies in the first bin.
    """
    value = F.coalesce(F.col(order_col).cast("double"), F.lit(-math.inf))
    grid = F.array(*[F.lit(i / RANGES) for i in range(1, RANGES)])
    known = F.col(order_col).cast("double")
    row = df.agg(F.percentile_approx(known, grid, F.lit(10 * RANGES)).alias("s"), F.min(known).alias("lo"),
                 F.max(known).alias("hi")).first()
    edges = sorted({float(e) for e in row["s"] or [0.0]})
    low, high = [row["lo"] or 0.0, *edges], [*edges, row["hi"] or 0.0]
    out = bucketed(df.withColumn("_o", value), "_o", edges, range_name)
    place = F.col(range_name) + 1

    def at(values):
        return F.element_at(F.array(*[F.lit(float(v)) for v in values]), place)
    share = F.try_divide(F.col("_o") - at(low), at(high) - at(low))
    inside = F.floor(F.coalesce(share, F.lit(0.0)) * F.lit(float(BINS)))
    return out.withColumn(bin_name, F.greatest(F.lit(0), F.least(inside, F.lit(BINS - 1))).cast("int")).drop("_o")


def by_value_rank(df: DataFrame, order_col: str, by: Sequence[str], value, name: str) -> DataFrame:
    """Like ``by_hash_rank`` in the order of a unique numeric column, cut into the bins of ``value_bins``."""
    keyed = value_bins(df, order_col, "_range", "_bin")
    bucket = F.col("_range") * F.lit(BINS) + F.col("_bin")
    return _ranged(keyed, bucket, [order_col], list(by), "rn", "class_n", value, name).drop("_range", "_bin")


def top_n(df: DataFrame, n: int, *order: Column | str) -> DataFrame:
    """First ``n`` rows in the given order; ``n`` must be positive."""
    if n <= 0:
        raise ValueError("n must be positive")
    return df.orderBy(*order).limit(int(n))


def half_even(x: float, digits: int = 0) -> float:
    return float(round(x, digits)) if not math.isnan(x) else x
