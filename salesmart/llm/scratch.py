"""Tables that cut lineage, in the shared folder of ``spark.checkpoint.dir``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from salesmart.session import scratch_path, shuffles_freed  # noqa: F401 (re-exported)


def kept(df: DataFrame, name: str) -> DataFrame:
    """Writes the frame as a table of its own and returns it as read back."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def removed(spark: SparkSession, *frames: DataFrame) -> None:
    """Deletes tables made by ``kept``, or unions of such, that no later step reads."""
    for df in frames:
        for folder in {file.rpartition("/")[0] for file in df.inputFiles()}:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
