"""Incremental runs: only scans whose bytes are new.

Scans carry brackets in their names, which the file stream source takes for globs when it reads a file back, so
folders of scans are compared with a table of hashes. Tables of scans are streamed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from graphloom.operators.quality import changed_files
from graphloom.session import materialize
from graphloom.sources.text import SCANS, scan

#: A table of scans, as ``sources.text.scan`` gives them.
SCAN = "doc_id string, src string, file_name string, text string, md5 string"


def resume(scans: DataFrame, known: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(scans to extract, hashes after this run): a scan counts as done if its bytes are known under its name."""
    todo = changed_files(scans, known)
    hashes = scans.select("file_name", "md5")
    return todo, known.join(hashes.select("file_name"), "file_name", "left_anti").select("file_name", "md5").unionByName(hashes)


def run_available(spark: SparkSession, folder: str, hashes: str, step: Callable[[DataFrame], None], pattern: str = SCANS) -> int:
    """Put the scans that are new to the table ``hashes`` through ``step``, then note them; their number.

    Hashes are written after the step, so a run that fails is repeated as a whole.
    """
    scans = scan(spark, folder, pattern)
    path = spark._jvm.org.apache.hadoop.fs.Path(hashes)
    there = path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)
    known = spark.read.parquet(hashes) if there else scans.select("file_name", "md5").limit(0)
    todo, after = resume(scans, known)
    todo, after = materialize(todo), materialize(after)
    n = todo.count()
    if n:
        step(todo)
    after.write.mode("overwrite").parquet(hashes)
    return n


def run_stream(spark: SparkSession, table: str, checkpoint: str, step: Callable[[DataFrame, int], None], files_per_batch: int = 1000) -> StreamingQuery:
    """Put all rows of a Parquet table of scans not yet seen through ``step`` in batches, then end.

    A batch repeated after a failure has the same number, so a step can write under it.
    """
    rows = spark.readStream.schema(SCAN).option("maxFilesPerTrigger", files_per_batch).parquet(table)
    return rows.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
