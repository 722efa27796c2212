"""Where intermediate tables live."""

import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def checkpoint_dir(spark: SparkSession) -> str:
    """The folder that all executors share, as the cluster names it."""
    sc = spark.sparkContext
    known = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not known:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return known


#: With it Spark removes the shuffle files of a query when it ends, not when the driver collects its garbage.
RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _released(spark: SparkSession):
    before = spark.conf.get(RELEASE, None)
    spark.conf.set(RELEASE, "true")
    try:
        yield
    finally:
        spark.conf.unset(RELEASE) if before is None else spark.conf.set(RELEASE, before)


def settle(df: DataFrame) -> DataFrame:
    """Materialize a table that is used several times, as Parquet in the shared folder.

    Later reads take only the columns they need. The files go when the application ends, those of
    its shuffles as soon as it is written.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/tessella-{uuid.uuid4().hex}"
    with _released(spark):
        df.write.parquet(path)
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(target)
    return spark.read.parquet(path)
