"""Where intermediate tables are written.

Tables that are read more than once, or that cut a long lineage, are written as Parquet
under the shared folder the cluster names in ``spark.checkpoint.dir``, so that losing an
executor never loses them.
"""

from __future__ import annotations

import hashlib
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
# For tables of words: forward tables, which repeat them, take a third less than in Spark's default.
COMPRESSION = "zstd"


def shared_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder; a temporary one only for local masters."""
    folder = spark.conf.get(CHECKPOINT_DIR, None)
    if folder:
        return folder.rstrip("/")
    # Not local-cluster, whose executors are processes with folders of their own.
    master = spark.conf.get("spark.master", "")
    if master != "local" and not master.startswith("local["):
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="lexigraph-")
    spark.sparkContext.setCheckpointDir(folder)
    spark.conf.set(CHECKPOINT_DIR, folder)
    return folder


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]):
    """Sets the session's options; holds for actions within the block."""
    before = {key: spark.conf.get(key) for key in values}
    try:
        for key, value in values.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def small_batches(spark: SparkSession, rows: int = 256):
    """Sends texts to Python in batches of so many rows; holds for actions within the block."""
    return settings(spark, {"spark.sql.execution.arrow.maxRecordsPerBatch": str(rows)})


class Workspace:
    """Named tables of one application and one label (for example an input folder)."""

    def __init__(self, spark: SparkSession, label: str):
        digest = hashlib.sha1(label.encode()).hexdigest()[:12]
        app = spark.conf.get("spark.app.id")
        self.spark = spark
        self.root = f"{shared_folder(spark)}/lexigraph/{app}/{digest}"

    def fresh(self, name: str) -> str:
        """A path no other call has had: tables already handed out are never replaced."""
        return f"{self.root}/{name}-{uuid.uuid4().hex[:8]}"

    def write(self, df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
        """Write ``df`` and return it as a scan of the written table."""
        path = self.fresh(name)
        df.write.parquet(path, compression=compression)
        return self.spark.read.schema(df.schema).parquet(path)
