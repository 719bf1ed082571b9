"""Session and lineage helpers shared by the operators."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


#: Checkpoints of sessions with one process.
LOCAL_CHECKPOINTS = "/tmp/tabulon-checkpoints"


def local_session(cpus: int | str = "*", app: str = "tabulon", partitions: int = 8) -> SparkSession:
    """A local session for tests and the benchmark; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", LOCAL_CHECKPOINTS)
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder and forget its lineage.

    The folder is the one the session names in ``spark.checkpoint.dir``; ``local_session`` sets one.
    """
    spark = df.sparkSession
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and sc.master.startswith("local["):
            folder = LOCAL_CHECKPOINTS  # driver and executors are one process
        if not folder:
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        sc.setCheckpointDir(folder)
    return df.checkpoint(eager=True)
