"""Table and report sinks: write modes, partition typing, one-file CSV."""

import glob

import pandas as pd
from pyspark.sql import functions as F

from salesmart.contracts import PRODUCT
from salesmart.sources import sinks
from salesmart.sources.tables import read_table


def products(spark, rows):
    return spark.createDataFrame(rows, PRODUCT.schema)


ROW = ("1", "0", "1", "n", "d", "007", "c")


def test_partition_values_keep_their_text(spark, workdir):
    """A digits-only department '007' and a NULL one read back unchanged."""
    df = products(spark, [ROW, ("2", "0", "2", "n", "d", None, "c")])
    sinks.write_table(df, workdir, PRODUCT, mode="overwrite")
    back = read_table(spark, workdir, PRODUCT)
    assert back.schema == PRODUCT.schema
    assert sorted(back.select("department").collect(), key=str) == sorted(
        [("007",), (None,)], key=str)
    inferred = spark.read.parquet(workdir)
    assert dict(inferred.dtypes)["department"] == "int"  # why contracts are explicit


def test_dynamic_overwrite_keeps_other_partitions(spark, workdir):
    sinks.write_table(products(spark, [ROW, ("2", "0", "2", "n", "d", "A", "c")]), workdir,
                      PRODUCT, mode="append")
    sinks.write_table(products(spark, [("3", "0", "3", "n", "d", "A", "c")]), workdir,
                      PRODUCT, mode="dynamic")
    keys = sorted(r["product_key"] for r in read_table(spark, workdir, PRODUCT).collect())
    assert keys == ["1", "3"]


def test_static_overwrite_replaces_table(spark, workdir):
    sinks.write_table(products(spark, [ROW]), workdir, PRODUCT, mode="append")
    sinks.write_table(products(spark, [("3", "0", "3", "n", "d", "A", "c")]), workdir,
                      PRODUCT, mode="overwrite")
    assert [r["product_key"] for r in read_table(spark, workdir, PRODUCT).collect()] == ["3"]


def test_append_twice_duplicates(spark, workdir):
    df = products(spark, [ROW])
    sinks.write_table(df, workdir, PRODUCT, mode="append")
    sinks.write_table(df, workdir, PRODUCT, mode="append")
    assert read_table(spark, workdir, PRODUCT).count() == 2


def test_unknown_mode(spark, workdir):
    import pytest
    with pytest.raises(ValueError):
        sinks.write_table(products(spark, [ROW]), workdir, PRODUCT, mode="upsert")


def test_sorted_report_is_one_ordered_file(spark, workdir):
    for parts in (4, 8):
        df = spark.range(1000).repartition(parts).select(
            (F.col("id") % 97).cast("string").alias("k"), (F.col("id") * 7 % 1000).alias("total_sales"))
        out = f"{workdir}/r{parts}"
        sinks.write_csv(df, out, [F.col("total_sales").desc(), F.col("k")])
        files = glob.glob(f"{out}/part-*.csv")
        assert len(files) == 1
        got = pd.read_csv(files[0])
        assert got["total_sales"].tolist() == sorted(got["total_sales"], reverse=True)
        assert len(got) == 1000


def test_null_and_empty_in_csv(spark, workdir):
    df = spark.createDataFrame([(None, "a"), ("", "b")], "x string, y string")
    sinks.write_csv(df, workdir, [F.col("y")])
    text = open(glob.glob(f"{workdir}/part-*.csv")[0]).read().splitlines()
    assert text == ["x,y", ",a", '"",b']


def test_partitioned_write_keeps_few_files_per_partition(spark, workdir):
    """Rows are rebalanced on the partition columns before the write, so a
    partition folder gets a file or two, not one per task."""
    import os

    from conftest import SF_SMALL
    from salesmart.contracts import ENRICHED
    from salesmart.plans.registry import enriched
    df = enriched(spark, SF_SMALL).repartition(16)  # many input tasks
    sinks.write_table(df, workdir, ENRICHED, mode="overwrite")
    folders, files = 0, 0
    for _dirpath, _dirs, names in os.walk(workdir):
        parts = [n for n in names if n.startswith("part-")]
        if parts:
            folders += 1
            files += len(parts)
    assert folders > 10
    assert files <= 2 * folders, (files, folders)
