"""Session settings and lineage cutting shared by every iterative operator."""

from __future__ import annotations

import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import IntegerType, StructField, StructType

# Runtime settings the operators are designed around.  AQE coalesces small
# shuffle partitions and splits skewed join partitions, also where the split
# costs one more exchange.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # tables split by a few types are written without a sort (and its spill) before
    "spark.sql.maxConcurrentOutputFileWriters": "16",
    # an action's shuffle files go when it ends, not when the driver happens to collect its garbage;
    # a plan that is run once more makes them anew
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}

def build_session(master: str, app_name: str = "graphloom", **conf: str) -> SparkSession:
    """Session for local runs and tests; a cluster brings its own."""
    builder = SparkSession.builder.master(master).appName(app_name)
    settings = {
        **RUNTIME_CONF,
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.shuffle.partitions": "8",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    for key, value in {**settings, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session made by someone else."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def workers_find_library(spark: SparkSession) -> None:
    """Python workers import this library from where the driver did, unless they have a path of their own."""
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[1]))


def checkpoint_dir(spark: SparkSession) -> str:
    """Folder for checkpoints: the cluster's shared one wherever it is named.

    Only a local master may fall back to a temporary folder, because there the
    driver and the executors are one machine.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if context.getCheckpointDir() is None:
        if named is None:
            if not context.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
            named = tempfile.mkdtemp(prefix="graphloom-checkpoint-")
        context.setCheckpointDir(named)
    return context.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` as a table in the shared folder and drop its lineage.

    A lost executor then costs a re-read and not a re-run.  A written table is used
    and not ``checkpoint()`` because a checkpoint keeps the size estimate of the plan
    behind it; in a loop of joins those estimates multiply round after round until
    planning stalls.  A table knows its true size, so later joins broadcast only what
    is small, and its columns can be pruned.
    """
    path = shared_path(df.sparkSession, "cut")
    df.write.option("compression", "zstd").parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table._cut_path = path
    return table


def discard(tables: list[DataFrame]) -> None:
    """Delete tables that ``cut`` wrote and that a loop has left behind; other frames are passed over.

    Only for tables that nothing still to be computed reads.
    """
    for table in tables:
        path = getattr(table, "_cut_path", None)
        if path is not None:
            spark = table.sparkSession
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
    tables.clear()


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path for a written table, in the same shared folder as the checkpoints."""
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


class Layers:
    """A table written in numbered layers and read back as one scan with a column ``level``.

    For loops that need everything found so far: a union would have one branch a round, this
    is one table however many rounds there were.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.path, self.schema = spark, shared_path(spark, name), None

    def add(self, level: int, rows: DataFrame) -> DataFrame:
        """Write one layer and return it read back."""
        place = f"{self.path}/level={level}"
        rows.write.mode("overwrite").option("compression", "zstd").parquet(place)
        self.schema = rows.schema
        return self.spark.read.schema(rows.schema).parquet(place)

    def all(self) -> DataFrame:
        """Every layer so far; a filter on ``level`` reads only the layers asked for."""
        return self.spark.read.schema(StructType([*self.schema.fields, StructField("level", IntegerType())])).parquet(self.path)
