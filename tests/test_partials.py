"""Monthly partial results: folded reports, touched months only, sketches."""

import glob
import os
import shutil

import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from salesmart.contracts import ENRICHED
from salesmart.operators import partials
from salesmart.operators import reports as rep
from salesmart.plans import fixtures, jobs
from salesmart.plans.registry import enriched
from salesmart.sources import sinks
from salesmart.sources.tables import read_table


@pytest.fixture(scope="module")
def sales(spark):
    return enriched(spark, SF_SMALL).where("trans_year in (1994, 1995)").checkpoint()


def rows_of(df):
    return sorted(map(repr, df.collect()))


def test_folded_bundles_equal_those_of_a_scan(sales):
    tables = partials.partials(sales)
    assert rows_of(partials.bundle(tables["store_sums"], tables["product_sums"])) == rows_of(rep.report_bundle(sales))
    assert rows_of(partials.metrics(tables["baskets"])) == rows_of(rep.metrics_bundle(sales))
    exact = {(r["report"], r["trans_year"], r["is_member"]): r for r in rep.metrics_bundle(sales).collect()}
    for r in partials.sketched_metrics(tables["sketches"]).collect():
        want = exact.pop((r["report"], r["trans_year"], r["is_member"]))
        assert (r["total_sales"], r["total_units"]) == (want["total_sales"], want["total_units"])
        for c in ("count_distinct_trans_key", "count_distinct_collector_key"):
            assert abs(r[c] - want[c]) <= 3 * partials.SKETCH_ERROR * want[c]
    assert not exact


def test_sketches_of_months_fold_by_any_key_within_their_error(spark):
    # 300,000 transactions, of which every third is in two months
    t = spark.range(300_000).select(F.col("id").cast("string").alias("trans_key"), (F.col("id") % 50_000).cast("string").alias("collector_key"),
                                    F.lit(1.0).alias("sales"), F.lit(1).alias("units"), *[F.lit("x").alias(c) for c in ("province", "store_num", "department", "category")])
    both = t.withColumn("trans_month", (F.col("trans_key").cast("int") % 12 + 1)).unionByName(
        t.where("trans_key % 3 = 0").withColumn("trans_month", F.lit(5))).withColumn("trans_year", F.lit(2015))
    sketches = partials.partials(both)["sketches"]
    row = partials.sketched_counts(sketches, "trans_year").first()
    assert abs(row["count_distinct_trans_key"] - 300_000) <= 3 * partials.SKETCH_ERROR * 300_000
    assert abs(row["count_distinct_collector_key"] - 50_000) <= 3 * partials.SKETCH_ERROR * 50_000
    none = partials.partials(both.limit(0))["sketches"]
    assert partials.sketched_counts(none, "trans_year").count() == 0


@pytest.fixture(scope="module")
def zone(spark, sales, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("partials"))
    sinks.write_table(sales, jobs.Zones(root).enriched, ENRICHED, mode="overwrite")
    jobs.run(spark, root, "reporting", months=["all"])
    return root


def reports(root):
    out = {}
    for name, folder in rep.REPORT_FOLDERS.items():
        files = glob.glob(f"{root}/reporting/{folder}/part-*.csv")
        out[name] = sorted(pd.read_csv(files[0], dtype=str, keep_default_na=False).values.tolist()) if files else None
    return out


def test_only_touched_months_are_read_and_written(spark, sales, zone, tmp_path):
    root = f"{tmp_path}/zone"
    shutil.copytree(zone, root)
    z = jobs.Zones(root)
    before = {p: os.path.getmtime(p) for p in glob.glob(f"{z.partials}/*/trans_year=*/trans_month=*/*.parquet")}
    # March 1995 loses its first store's sales and doubles the others; all other
    # months of the enriched table cannot be read any more.
    store = sales.where("trans_year = 1995 and trans_month = 3 and store_num is not null").agg(F.min("store_num")).first()[0]
    march = sales.where((F.col("trans_year") == 1995) & (F.col("trans_month") == 3) & (F.col("store_num") != store))
    march = march.withColumn("sales", F.col("sales") * 2).checkpoint()
    rest = sales.where("not (trans_year = 1995 and trans_month = 3)")
    for p in glob.glob(f"{z.enriched}/province=*/trans_year=1995/trans_month=3"):
        shutil.rmtree(p)
    for p in glob.glob(f"{z.enriched}/province=*/trans_year=*/trans_month=*/*.parquet"):
        with open(p, "wb") as f:
            f.write(b"not parquet")
    sinks.write_table(march, z.enriched, ENRICHED, mode="dynamic")
    jobs.run(spark, root, "reporting", months=["1995-03"])
    after = {p: os.path.getmtime(p) for p in glob.glob(f"{z.partials}/*/trans_year=*/trans_month=*/*.parquet")}
    assert {p for p in before if p not in after or after[p] != before[p]} == {p for p in before if "trans_year=1995/trans_month=3/" in p}
    whole = f"{tmp_path}/whole"
    sinks.write_table(rest.unionByName(march), jobs.Zones(whole).enriched, ENRICHED, mode="overwrite")
    jobs.run(spark, whole, "reporting")
    assert reports(root) == reports(whole)


def test_a_month_without_sales_goes_and_a_stopped_refresh_is_made_up_for(spark, zone, tmp_path, monkeypatch):
    root = f"{tmp_path}/zone"
    shutil.copytree(zone, root)
    z = jobs.Zones(root)
    for p in glob.glob(f"{z.enriched}/province=*/trans_year=1994/trans_month=2"):
        shutil.rmtree(p)
    real, calls = sinks.write_table, []

    def failing(df, path, contract, **kwargs):
        calls.append(contract.name)
        if len(calls) == 2:
            raise RuntimeError("lost")
        return real(df, path, contract, **kwargs)
    with monkeypatch.context() as m:
        m.setattr(sinks, "write_table", failing)
        with pytest.raises(RuntimeError):
            jobs.refresh_partials(spark, root, ["1994-02"])
    assert jobs.refresh_partials(spark, root, ["1994-05"])["months"] == ["1994-02", "1994-05"]
    assert jobs.refresh_partials(spark, root, [])["months"] == []
    assert not glob.glob(f"{z.partials}/*/trans_year=1994/trans_month=2")
    jobs.run(spark, root, "reporting", months=[])
    folded = reports(root)
    jobs.run(spark, root, "reporting")
    assert reports(root) == folded


def test_single_reports_and_refused_options(spark, zone, tmp_path):
    root = f"{tmp_path}/zone"
    shutil.copytree(zone, root)
    want = reports(root)
    shutil.rmtree(f"{root}/reporting")
    assert jobs.run(spark, root, "reporting", only=["sales_by_store", "metrics_by_year"]) == {"reports": ["metrics_by_year", "sales_by_store"]}
    got = reports(root)
    assert {k for k, v in got.items() if v is not None} == {"sales_by_store", "metrics_by_year"}
    assert all(got[k] == want[k] for k in ("sales_by_store", "metrics_by_year"))
    jobs.run(spark, root, "reporting", months=[], sketched=True, only=["metrics_by_loyalty"])
    near = reports(root)["metrics_by_loyalty"]
    assert [r[:3] for r in near] == [r[:3] for r in want["metrics_by_loyalty"]]
    for options in ({"only": ["sales"]}, {"sketched": True}, {"months": [], "year": 1995}, {"months": [], "approx_distinct": 0.1}):
        with pytest.raises(ValueError):
            jobs.run(spark, root, "reporting", **options)
    assert read_table(spark, f"{root}/enrichment/partials/sketches", partials.SKETCHES).count() > 0
