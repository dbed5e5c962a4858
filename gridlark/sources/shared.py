"""Intermediate tables in the cluster's shared folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from gridlark.session import ensure_checkpoint_dir
from gridlark.sources.versions import remove_folder


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, or the session's own one if unset."""
    ensure_checkpoint_dir(spark)
    return spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()


def materialize(df: DataFrame, spread: bool = False) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Unlike a cache it outlives lost executors, and unlike a checkpointed RDD later
    passes still read only the columns they need and know the table's size.

    ``spread`` deals the rows evenly over the cluster before the write, so that a few
    input row groups do not set the width of everything that follows: worth one shuffle
    before repeated passes, such as fits.
    """
    spark = df.sparkSession
    if spread:
        width = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
        df = df.repartition(width)
    folder = f"{shared_folder(spark).rstrip('/')}/table-{uuid.uuid4().hex}"
    df.write.parquet(folder)
    return spark.read.parquet(folder)


def discard(df: DataFrame) -> None:
    """Remove the files of a table from :func:`materialize`, once nothing reads it any more.

    Only folders that ``materialize`` has made in the shared folder are touched; any other
    frame is left alone.
    """
    home = df.sparkSession._jvm.org.apache.hadoop.fs.Path(shared_folder(df.sparkSession)).toUri().getPath().rstrip("/")
    for folder in {name.rpartition("/")[0] for name in df.inputFiles()}:
        parent, _, own = folder.rpartition("/")
        if own.startswith("table-") and parent.endswith(home):
            remove_folder(df.sparkSession, folder)


def release(spark: SparkSession) -> None:
    """Let the shuffle files of finished queries go.

    Spark removes them once the driver's virtual machine has collected what named them, and a
    driver with little to do hardly ever collects. Worth it after a large table was written.
    """
    spark.sparkContext._jvm.System.gc()
