"""Sources: CSV and Parquet tables, the labelled dataset, feature lists and stored parameters."""
from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from tabulon.operators.clean import clean_categories, nan_to_null
from tabulon.spec import DatasetSpec


def exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.format("binaryFile").load(path).schema  # the path is looked up, no file is read
    except AnalysisException:
        return False
    return True


def read_table(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """Parquet or header CSV by suffix; a CSV without a schema is inferred (one more pass)."""
    if path.rstrip("/").endswith(".csv"):
        reader = spark.read.option("header", True).option("nanValue", "NaN").option("nullValue", "")
        df = reader.schema(schema).csv(path) if schema else reader.option("inferSchema", True).csv(path)
        return nan_to_null(df)
    df = spark.read.schema(schema).parquet(path) if schema else spark.read.parquet(path)
    return nan_to_null(df)


def read_raw(spark: SparkSession, train: str, labels: str, test: str, spec: DatasetSpec,
             schema: StructType | str | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The three raw tables with cleaned category columns."""
    return (clean_categories(read_table(spark, train, schema), spec.categorical),
            read_table(spark, labels),
            clean_categories(read_table(spark, test, schema), spec.categorical))


def join_labels(values: DataFrame, labels: DataFrame, key: str) -> DataFrame:
    """Inner equi-join of values and labels on the key."""
    return values.join(labels, key)


def map_labels(values: DataFrame, labels: DataFrame, key: str, label: str) -> DataFrame:
    """Left lookup of the label; unmatched rows get NULL, repeated keys in the labels are an error."""
    twice = labels.groupBy(key).count().where("count > 1").limit(1).collect()
    if twice:
        raise ValueError(f"labels repeat key {twice[0][0]}")
    return values.join(labels.select(key, label), key, "left")


def align_by_position(values: DataFrame, labels: DataFrame, order_values: str, order_labels: str,
                      label: str) -> DataFrame:
    """Pair rows by their position in declared orders; both sides must have the same number of rows."""
    from tabulon.operators.order import number_rows
    if values.count() != labels.count():
        raise ValueError("values and labels differ in length")
    left = number_rows(values, [order_values], name="_pos")
    right = number_rows(labels.select(F.col(order_labels).alias("_o"), F.col(label)), ["_o"], name="_pos").drop("_o")
    return left.join(right, "_pos").drop("_pos")


def load_labelled(spark: SparkSession, key: str, values: str, labels: str, joined: str | None = None) -> DataFrame:
    """values joined with labels, else the pre-joined table, else an error."""
    if exists(spark, values) and exists(spark, labels):
        return join_labels(read_table(spark, values), read_table(spark, labels), key)
    if joined and exists(spark, joined):
        return read_table(spark, joined)
    raise FileNotFoundError("neither values and labels nor a joined table was found")


def load_preprocessed(spark: SparkSession, path: str, required: tuple[str, ...] = ()) -> DataFrame:
    """A preprocessed table; missing required columns fail before any job runs."""
    if not exists(spark, path):
        raise FileNotFoundError(path)
    df = read_table(spark, path)
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}")
    return df


def read_feature_list(spark: SparkSession, path: str, column: str, limit: int | None = None,
                      order: str | None = None) -> list[str]:
    """One column of a stored ranking, NULLs dropped; a missing file or column gives an empty list."""
    if not exists(spark, path):
        return []
    try:
        df = read_table(spark, path)
    except AnalysisException:
        return []
    if column not in df.columns:
        return []
    df = df.where(F.col(column).isNotNull())
    if order and order in df.columns:
        df = df.orderBy(order)
    df = df.select(F.col(column).cast("string"))
    rows = (df.limit(limit) if limit else df).collect()
    return [r[0] for r in rows]


def params_table(spark: SparkSession, path: str) -> DataFrame:
    """(expert, params): stored parameters, one JSON object per expert, as text."""
    return spark.read.schema("expert string, params string").json(path)


def read_params(spark: SparkSession, path: str) -> dict[str, dict]:
    """Best parameters by expert name; {} if absent.

    Reads rows of ``write_params`` and a single ``{expert: {param: value}}`` document.
    """
    if not exists(spark, path):
        return {}
    import json
    # One row per expert, or one small document.
    texts = [r[0] for r in spark.read.text(path, wholetext=True).collect()]
    out: dict[str, dict] = {}
    for text in texts:
        try:
            document = json.loads(text)
            rows = [document] if set(document) == {"expert", "params"} else []
            out |= {} if rows else document
        except json.JSONDecodeError:
            rows = [json.loads(line) for line in text.splitlines() if line.strip()]
        out |= {r["expert"]: json.loads(r["params"]) for r in rows}
    return out
