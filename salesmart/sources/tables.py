"""Readers for parquet tables: the driver's test tables and contract tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from salesmart.contracts import TableContract

TEST_TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
               "lineitem", "events", "documents", "embeddings", "pages",
               "benchmark", "labels", "conversations")


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, asked of its own filesystem."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)


def test_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the generated parquet test tables (``{sf_dir}/{name}.parquet``)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_table(spark: SparkSession, path: str, contract: TableContract) -> DataFrame:
    """Read a contract table with its declared schema.

    The explicit schema also types the partition columns, so a department
    ``007`` stays the string ``'007'`` and nothing is inferred from folder
    names. Filters on partition columns prune folders; others are pushed
    into the parquet scan.
    """
    return spark.read.schema(contract.schema).parquet(path).select(*contract.names)
