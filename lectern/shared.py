"""Tables written between steps, in the folder that the cluster names in ``spark.checkpoint.dir``."""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid

from py4j.java_gateway import JavaObject
from pyspark.sql import DataFrame, SparkSession

#: Bytes of an Arrow batch while a table is written, at most: they are held by the JVM and the worker.
BATCH, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 4 << 20
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_written: dict[str, JavaObject] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors see. Only a local session, as in tests, may go without the setting."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors see")
        found = tempfile.mkdtemp(prefix="lectern-")
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def materialize(df: DataFrame, *done: DataFrame) -> DataFrame:
    """Cut the lineage: write ``df`` as Parquet to the shared folder and read it again.

    ``done``: tables from earlier calls that nothing needs any more; their files go. The rest goes when the driver ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/lectern-{uuid.uuid4().hex}"
    # shuffle files of what is written aren't needed again
    wanted = {CLEANUP: "true", BATCH: str(BATCH_BYTES)}
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        df.write.parquet(path)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
    jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    _written[path] = (jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jvm_path)
    out = spark.read.schema(df.schema).parquet(path)
    out._lectern_path = path
    for table in done:
        remove(getattr(table, "_lectern_path", ""))
    return out


def remove(path: str) -> None:
    """Delete a table that :func:`materialize` wrote, if it still is there."""
    files, at = _written.pop(path, (None, None))
    if files is not None:
        files.delete(at, True)


@atexit.register
def _remove_all() -> None:
    for path in list(_written):
        try:
            remove(path)
        except Exception:  # the JVM may be gone by now
            return
