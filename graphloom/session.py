"""Session helpers: building one for local use, reading tables, cutting lineage."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile

from pyspark.sql import DataFrame, SparkSession

#: Rows of one Arrow batch handed to Python; low, since a row may hold a very long text.
ARROW_ROWS = 1000


def local_session(cpus: int = 8, app: str = "graphloom", memory: str = "12g") -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def reach_workers(spark: SparkSession) -> None:
    """Let Python workers import this package from where it lies, whatever folder the session was started in."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    held = spark.sparkContext.environment
    paths = held.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        held["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One Parquet table of a data folder."""
    reach_workers(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession, rows: int = ARROW_ROWS) -> None:
    """Bound the rows of an Arrow batch, so that long texts cannot exhaust a Python worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def materialize(df: DataFrame) -> DataFrame:
    """``df`` written to the reliable checkpoint folder and read again.

    The folder is the one the cluster names in ``spark.checkpoint.dir``; only where that is unset and the session runs on one
    machine a local one is made, which goes when the session does. On a cluster without one this raises. Never a localCheckpoint: a lost
    executor must not lose the data.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        named = context.getConf().get("spark.checkpoint.dir")
        if not named and not context.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        context.setCheckpointDir(named or _local_folder())
    return df.checkpoint(eager=True)


def _local_folder() -> str:
    """A folder of this machine that is removed when the process ends."""
    folder = tempfile.mkdtemp(prefix="graphloom-", dir=os.environ.get("TMPDIR"))
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return f"file://{folder}"
