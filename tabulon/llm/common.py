"""Helpers shared by the operators of this subpackage."""
from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tabulon.session import cut


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


#: Folders made within each open ``scratch`` block, the innermost last.
_made: list[list[str]] = []


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the session's shared checkpoint folder."""
    if spark.sparkContext.getCheckpointDir() is None:
        cut(spark.range(1).toDF("x"))
    path = f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"
    for block in _made[-1:]:
        block.append(path)
    return path


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that this session has made in the shared checkpoint folder."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """What is stored within the block goes at its end: its results have to be written elsewhere by then."""
    _made.append([])
    try:
        yield
    finally:
        for path in _made.pop():
            remove(spark, path)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read back: lineage ends here, any executor can read it."""
    path = shared_folder(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: The one large object that this Python worker keeps between tasks, by its key.
_held: dict[object, object] = {}


def held(key: object, make: Callable[[], object]) -> object:
    """``make()``, kept for later tasks of this Python worker. A worker serves the tasks of all stages and has room for one such
    object, so that asking for another one lets go of it."""
    if key not in _held:
        let_go()
        _held[key] = make()
    return _held[key]


def let_go() -> None:
    """Free what an earlier stage has left in this Python worker; for tasks that keep nothing themselves."""
    _held.clear()


def spread(spark: SparkSession, least: int = 12) -> int:
    """Number of partitions for a repartition by key: the session's shuffle partitions, at least ``least``."""
    return max(least, int(spark.conf.get("spark.sql.shuffle.partitions")))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column of ``df`` has it (case is ignored)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def whole_text(text: str) -> Column:
    return F.coalesce(F.col(text), F.lit(""))


def row_hash(df: DataFrame) -> Column:
    """A 64-bit hash of a row that a repeated task computes again alike; map columns do not take part."""
    return F.xxhash64(*[F.col(f"`{f.name}`") for f in df.schema if "map<" not in f.dataType.simpleString()])


def prefix_sums(df: DataFrame, order: list[str | Column], sums: dict[str, str], xors: dict[str, str] | None = None) -> DataFrame:
    """``df`` with, for each name of ``sums`` and ``xors``, the sum (exclusive or) of that column over all rows before.

    The columns are non-null longs. Rows are range-sorted by ``order`` and run through within their range; one row per range
    gives what stands before it. ``df`` is read twice (sample and sort), so it should be cheap. Rows that are equal in
    ``order`` follow one another in any order.
    """
    xors = xors or {}
    spark, kinds = df.sparkSession, {n: np.add for n in sums} | {n: np.bitwise_xor for n in xors}
    columns, names = sums | xors, df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, carry = TaskContext.get().partitionId(), dict.fromkeys(columns, np.int64(0))
        for b in batches:
            if not b.num_rows:
                continue
            arrays = [*b.columns, pa.array(np.full(b.num_rows, part, np.int64))]
            for n, c in columns.items():
                x = b.column(c).to_numpy(zero_copy_only=False).astype(np.int64)
                upto = kinds[n](kinds[n].accumulate(x), carry[n])
                arrays.append(pa.array(kinds[n](upto, -x if kinds[n] is np.add else x)))
                carry[n] = upto[-1]
            yield pa.RecordBatch.from_arrays(arrays, [*names, "_part", *columns])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema), "_part long", *(f"`{n}` long" for n in columns)])
    placed = stored(df.repartitionByRange(spread(spark), *order).sortWithinPartitions(*order).mapInArrow(run, schema), "prefix")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    totals = placed.groupBy("_part").agg(*[F.sum(c).alias(f"_{n}") for n, c in sums.items()],
                                         *[F.bit_xor(c).alias(f"_{n}") for n, c in xors.items()])
    # One row per range.
    offsets = totals.select("_part", *[F.coalesce((F.sum if n in sums else F.bit_xor)(f"_{n}").over(before), F.lit(0).cast("long"))
                                       .alias(f"_{n}") for n in columns])
    joined = placed.join(F.broadcast(offsets), "_part")
    return joined.select(*names, *[(F.col(n) + F.col(f"_{n}")).alias(n) for n in sums],
                         *[F.col(n).bitwiseXOR(F.col(f"_{n}")).alias(n) for n in xors])
