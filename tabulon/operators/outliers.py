"""IQR outliers: report, replacement and the multiplier sweep."""
from __future__ import annotations

from typing import Iterable, Sequence

from pyspark.sql import DataFrame, functions as F

from tabulon.operators.clean import null_outside, outside
from tabulon.operators.order import fit_medians, fit_quantiles, half_even

REPORT = ("column string, q1 double, q3 double, iqr double, lower_bound double, upper_bound double, "
          "n_outliers bigint, perc_outliers double")


def _rare_bounds(df: DataFrame, columns: list[str], rare_share: float) -> dict[str, tuple]:
    """For columns without spread: min and max of the non-rare values, number of rare rows."""
    cells = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns
    ])).alias("c")).select("c.*").where("value IS NOT NULL")
    counts = cells.groupBy("column", "value").agg(F.count("*").alias("c"))
    totals = counts.groupBy("column").agg(F.sum("c").alias("n"))
    rare = F.col("c") / F.col("n") < F.lit(rare_share)
    out = counts.join(totals, "column").groupBy("column").agg(
        F.min(F.when(~rare, F.col("value"))).alias("lo"),
        F.max(F.when(~rare, F.col("value"))).alias("hi"),
        F.sum(F.when(rare, F.col("c")).otherwise(0)).cast("long").alias("n_out"))
    return {r["column"]: (r["lo"], r["hi"], r["n_out"]) for r in out.collect()}


def iqr_rows(df: DataFrame, columns: Iterable[str], ks: Sequence[float], floor: float | None = 0.0,
             rare_share: float = 0.005) -> list[dict]:
    """Unrounded IQR statistics for every (k, column): one quantile pass, one counting pass."""
    columns = [c for c in columns if c in df.columns]
    quart = {c: q for c, q in fit_quantiles(df, columns, [0.25, 0.75]).items() if q[0] is not None}
    flat = [c for c in quart if quart[c][1] - quart[c][0] == 0]
    rare = _rare_bounds(df, flat, rare_share) if flat else {}
    plan, aggs = [], [F.count("*").alias("n")]
    for k in ks:
        for c in columns:
            if c not in quart:
                continue
            q1, q3 = quart[c]
            iqr = q3 - q1
            row = {"k": float(k), "column": c, "q1": q1, "q3": q3, "iqr": iqr}
            if c in rare:
                row["lower"], row["upper"], row["n_outliers"] = rare[c]
            else:
                low = q1 - k * iqr
                row["lower"] = low if floor is None else max(float(floor), low)
                row["upper"] = q3 + k * iqr
                aggs.append(F.count_if(outside(F.col(c), row["lower"], row["upper"])).alias(f"o{len(plan)}"))
                row["slot"] = f"o{len(plan)}"
            plan.append(row)
    counts = df.agg(*aggs).first()
    for row in plan:
        if "slot" in row:
            row["n_outliers"] = counts[row.pop("slot")]
        row["perc"] = row["n_outliers"] / counts["n"] * 100 if counts["n"] else 0.0
    return plan


def iqr_report(df: DataFrame, columns: Iterable[str], k: float = 3.0, floor: float | None = 0.0,
               rare_share: float = 0.005, digits: int | None = 2) -> DataFrame:
    """One row per column: quartiles, bounds, outlier count and percentage.

    Bounds are ``q1 - k*iqr`` (not below ``floor``) and ``q3 + k*iqr``. Where the
    IQR is zero, values with a share below ``rare_share`` are the outliers and the
    bounds are the smallest and largest other value. Counts use unrounded bounds.
    """
    def r(x):
        return None if x is None else float(x) if digits is None else half_even(float(x), digits)
    rows = [(s["column"], r(s["q1"]), r(s["q3"]), r(s["iqr"]), r(s["lower"]), r(s["upper"]),
             int(s["n_outliers"]), r(s["perc"])) for s in iqr_rows(df, columns, [k], floor, rare_share)]
    return df.sparkSession.createDataFrame(rows, REPORT)


def fit_bounds(df: DataFrame, columns: Iterable[str], k: float = 3.0, floor: float | None = 0.0,
               digits: int | None = 2, only_with_outliers: bool = False) -> dict[str, tuple[float, float]]:
    """Replacement bounds per column, rounded as the report shows them (``digits=None`` keeps them exact)."""
    out = {}
    for s in iqr_rows(df, columns, [k], floor):
        if only_with_outliers and not s["n_outliers"]:
            continue
        if s["lower"] is None:
            continue
        lo, hi = float(s["lower"]), float(s["upper"])
        out[s["column"]] = (lo, hi) if digits is None else (half_even(lo, digits), half_even(hi, digits))
    return out


def replace_outliers(train: DataFrame, test: DataFrame, columns: Iterable[str], k: float = 3.0):
    """NULL out both frames by the training bounds; returns (train, test, bounds)."""
    bounds = fit_bounds(train, columns, k, only_with_outliers=True)
    return null_outside(train, bounds), null_outside(test, bounds), bounds


def sweep(df: DataFrame, columns: Iterable[str], ks: Sequence[float] = (1.5, 2.0, 2.5, 3.0, 4.0)) -> DataFrame:
    """Per (k, column): bounds, outliers, values replaced, and the median used to fill them.

    One quantile pass and one counting pass serve every k.
    """
    columns = [c for c in columns if c in df.columns]
    stats = iqr_rows(df, columns, ks)
    wide = df.select(*[
        F.when(~outside(F.col(s["column"]), half_even(s["lower"], 2), half_even(s["upper"], 2)),
               F.col(s["column"]).cast("double")).alias(f"v{i}") for i, s in enumerate(stats)])
    medians = fit_medians(wide, wide.columns)
    nulls = wide.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in wide.columns]).first()
    rows = [(s["k"], s["column"], half_even(s["lower"], 2), half_even(s["upper"], 2), int(s["n_outliers"]),
             half_even(s["perc"], 2), medians[f"v{i}"], int(nulls[f"v{i}"])) for i, s in enumerate(stats)]
    return df.sparkSession.createDataFrame(
        rows, "k double, column string, lower_bound double, upper_bound double, n_outliers bigint, "
              "perc_outliers double, fill_median double, n_filled bigint")
