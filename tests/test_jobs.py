"""End-to-end pipeline over landing files rendered from the test tables."""

import glob
import os

import pandas as pd
import pytest
from pyspark.sql import functions as F

from salesmart.contracts import ENRICHED, TRANSACTIONS
from salesmart.operators import reports as rep
from salesmart.plans import fixtures, jobs
from salesmart.sources.tables import read_table

from conftest import SF_SMALL, plan_text


@pytest.fixture(scope="module")
def zone(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("zones"))
    landing = f"{root}/landing"
    fixtures.write_landing(spark, SF_SMALL, landing)
    fixtures.write_location_landing(spark, SF_SMALL, landing)
    fixtures.write_product_landing(spark, SF_SMALL, landing)
    results = {a: jobs.run(spark, root, a) for a in jobs.ACTIONS}
    return root, results


def _read_report(root, name):
    folder = f"{root}/reporting/{rep.REPORT_FOLDERS[name]}"
    files = glob.glob(f"{folder}/part-*.csv")
    assert len(files) == 1, "one CSV file per report"
    return pd.read_csv(files[0], dtype=str, keep_default_na=False)


def test_loads_keep_every_row(spark, zone):
    root, results = zone
    assert results["stage-transactions"]["rows"] == 6000
    assert results["stage-transactions"]["rejected"] == 0
    assert results["enrich"]["rows_in"] == results["enrich"]["rows_out"] == 6000
    assert results["enrich"]["rows_with_product"] == 5404
    assert results["enrich"]["rows_with_location"] == 5455
    assert read_table(spark, f"{root}/enrichment/transactions", ENRICHED).count() == 6000


def test_reports_equal_direct_queries(spark, zone):
    """Bundled reports (two scans, split, CSV) equal each report computed
    directly on the enriched table."""
    root, _ = zone
    direct = read_table(spark, f"{root}/enrichment/transactions", ENRICHED)
    for name, fn in rep.REPORTS.items():
        got = _read_report(root, name)
        want = fn(direct).toPandas().astype(str).replace({"None": ""})
        assert list(got.columns) == list(want.columns), name
        key = list(want.columns)
        got = got.sort_values(key).reset_index(drop=True)
        want = want.sort_values(key).reset_index(drop=True)
        pd.testing.assert_frame_equal(got, want, check_dtype=False, obj=name)


def test_sorted_reports_are_in_order(zone):
    root, _ = zone
    store = _read_report(root, "sales_by_store")
    totals = store["total_sales"].astype(float).tolist()
    assert totals == sorted(totals, reverse=True)
    loyal = _read_report(root, "sales_by_loyalty")
    assert loyal["is_member"].tolist() == ["No", "Yes"]


def test_totals_agree_across_reports(zone):
    root, _ = zone
    totals = {n: _read_report(root, n)["total_sales"].astype(float).sum().round(2)
              for n in ("sales_by_province", "sales_by_store", "sales_by_category",
                        "sales_by_loyalty", "metrics_by_year", "metrics_by_loyalty")}
    assert len(set(totals.values())) == 1, totals
    units = {n: _read_report(root, n)["total_units"].astype(int).sum()
             for n in ("metrics_by_year", "metrics_by_loyalty")}
    assert len(set(units.values())) == 1


def test_province_average_is_total_over_stores(spark, zone):
    root, _ = zone
    top = _read_report(root, "top_stores_by_province")
    sales = read_table(spark, f"{root}/enrichment/transactions", ENRICHED)
    by_store = rep.sales_by(sales, "province", "store_num").toPandas()
    for prov, grp in by_store.groupby("province", dropna=False):
        avg = round(sum(grp["total_sales"]) / len(grp), 3)
        shown = top[top["province"] == ("" if pd.isna(prov) else prov)]
        assert {float(x) for x in shown["avg_store_total_sales_in_province"]} == {float(avg)}


def test_rerun_adds_nothing(spark, zone):
    root, _ = zone
    again = jobs.run(spark, root, "stage-transactions")
    assert again == {"files": 0}
    assert read_table(spark, f"{root}/staging/transactions", TRANSACTIONS).count() == 6000
    jobs.run(spark, root, "enrich")
    assert read_table(spark, f"{root}/enrichment/transactions", ENRICHED).count() == 6000


def test_new_file_is_loaded_alone(spark, zone):
    root, _ = zone
    landing = f"{root}/landing"
    # a second drop of the product-first layout under a new name
    lines = fixtures.landing_lines(spark, SF_SMALL).where(F.col("layout") == "trans_fact_8")
    n = lines.count()
    (lines.select(*[F.col("trans_key" if c == "trans_id" else c).alias(c) for c in fixtures.T8_HEADER])
     .write.option("header", True).csv(f"{landing}/trans_fact_8b"))
    res = jobs.run(spark, root, "stage-transactions")
    assert res["files"] >= 1 and res["rows"] == n
    assert read_table(spark, f"{root}/staging/transactions", TRANSACTIONS).count() == 6000 + n


def test_unknown_action(spark, tmp_path):
    with pytest.raises(ValueError):
        jobs.run(spark, str(tmp_path), "publish")


def test_archive_written(zone):
    root, _ = zone
    assert glob.glob(f"{root}/archive/landing/transactions/*/part-*.csv")
    assert all(":" not in os.path.basename(p) for p in glob.glob(f"{root}/archive/landing/*/*"))


def test_reporting_prunes_partitions(spark, zone, tmp_path):
    root, _ = zone
    sales = read_table(spark, f"{root}/enrichment/transactions", ENRICHED)
    year = sales.agg(F.min("trans_year")).first()[0]
    filtered = sales.where(F.col("trans_year") == year)
    plan = plan_text(filtered)
    assert "PartitionFilters: [isnotnull(trans_year" in plan
    jobs.reporting(spark, root, year=year)
    got = _read_report(root, "metrics_by_year")
    assert got["trans_year"].tolist() == [str(year)]


def test_file_arriving_during_a_load_is_not_marked_loaded(spark, tmp_path):
    """The ledger records the files that were read, not a later listing."""
    from salesmart.sources import landing as ld
    root = str(tmp_path)
    fixtures.write_landing(spark, SF_SMALL, f"{root}/landing", ("trans_fact_5",))
    files = ld.freeze(ld.list_files(spark, f"{root}/landing"))
    fixtures.write_landing(spark, SF_SMALL, f"{root}/landing", ("trans_fact_6",))  # arrives late
    ld.record_loaded(files, f"{root}/_ledger", "load-1")
    pending = ld.new_files(ld.list_files(spark, f"{root}/landing"), ld.read_ledger(spark, f"{root}/_ledger"))
    assert [p for p in ld.landing_paths(pending) if "trans_fact_6" in p]
    assert not [p for p in ld.landing_paths(pending) if "trans_fact_5" in p]


def test_written_files_carry_contract_types(spark, zone):
    """Q6: the parquet files themselves hold the contract types (partition
    columns live in folder names and are typed by the contract on read)."""
    from salesmart.contracts import CONTRACTS
    root, _ = zone
    tables = {"location": "staging/location", "product": "staging/product",
              "transactions": "staging/transactions",
              "enriched_transactions": "enrichment/transactions"}
    for name, folder in tables.items():
        contract = CONTRACTS[name]
        files = dict(spark.read.parquet(f"{root}/{folder}").dtypes)
        for field in contract.schema.fields:
            if field.name not in contract.partition_by:
                assert files[field.name] == field.dataType.simpleString(), (name, field.name)


def test_bad_dates_rejected_or_failing(spark, tmp_path):
    root = str(tmp_path)
    os.makedirs(f"{root}/landing")
    with open(f"{root}/landing/trans_fact_1.csv", "w") as f:
        f.write("collector_key,trans_dt,store_location_key,product_key,sales,units,trans_key\n"
                "1,3/1/2015,1,2,3.5,1,10\n1,02/30/2015,1,2,3.5,1,11\n")
    with pytest.raises(ValueError):
        jobs.run(spark, root, "stage-transactions", on_bad="fail")
    res = jobs.run(spark, root, "stage-transactions")
    assert (res["rows"], res["rejected"]) == (2, 1)
    assert [r["trans_key"] for r in spark.read.parquet(f"{root}/staging/transactions_rejects").collect()] == ["11"]
    assert read_table(spark, f"{root}/staging/transactions", TRANSACTIONS).count() == 1


def test_enrich_salted_path_keeps_counts(spark, zone):
    root, results = zone
    staged = read_table(spark, f"{root}/staging/transactions", TRANSACTIONS).count()
    plain = jobs.run(spark, root, "enrich")
    salted = jobs.run(spark, root, "enrich", broadcast_rows=0, row_budget=10)
    assert salted == plain
    assert salted["rows_in"] == salted["rows_out"] == staged
    assert read_table(spark, f"{root}/enrichment/transactions", ENRICHED).count() == staged


def test_file_without_header_stays_pending(spark, tmp_path):
    root = str(tmp_path)
    os.makedirs(f"{root}/landing")
    with open(f"{root}/landing/trans_fact_1.csv", "w") as f:
        f.write("collector_key,trans_dt,store_location_key,product_key,sales,units,trans_key\n"
                "1,3/1/2015,1,2,3.5,1,10\n")
    with open(f"{root}/landing/trans_fact_2.csv", "w") as f:
        f.write("garbage before the header\n"
                "collector_key,trans_dt,store_location_key,product_key,sales,units,trans_key\n"
                "1,3/2/2015,1,2,3.5,1,11\n")
    res = jobs.run(spark, root, "stage-transactions")
    assert res["rows"] == 1 and res["files"] == 1
    assert [p.rsplit("/", 1)[1] for p in res["unrecognized_files"]] == ["trans_fact_2.csv"]
    again = jobs.run(spark, root, "stage-transactions")  # still pending, still reported
    assert again["files"] == 0 and len(again["unrecognized_files"]) == 1
    assert read_table(spark, f"{root}/staging/transactions", TRANSACTIONS).count() == 1


def test_incremental_enrich_rewrites_only_touched_months(spark, tmp_path):
    root = str(tmp_path)
    landing = f"{root}/landing"
    lines = fixtures.landing_lines(spark, SF_SMALL)
    fixtures.write_location_landing(spark, SF_SMALL, landing)
    fixtures.write_product_landing(spark, SF_SMALL, landing)
    first = lines.where(F.col("layout") == "trans_fact_5")
    (first.select(*fixtures.T5_HEADER).write.option("header", True).csv(f"{landing}/trans_fact_a"))
    for action in ("stage-locations", "stage-products", "stage-transactions", "enrich"):
        jobs.run(spark, root, action)
    # a second drop holding lines of a single month
    year_month = lines.where(F.col("layout") == "trans_fact_4").select(
        F.substring(F.col("trans_dt"), -4, 4).alias("y"),
        F.substring_index(F.col("trans_dt"), "/", 1).alias("m")).first()
    late = lines.where((F.col("layout") == "trans_fact_4")
                       & F.col("trans_dt").startswith(f"{year_month['m']}/")
                       & F.col("trans_dt").endswith(f"/{year_month['y']}"))
    late.select(*fixtures.T4_HEADER).write.option("header", True).csv(f"{landing}/trans_fact_b")
    staged = jobs.run(spark, root, "stage-transactions")
    assert staged["months"] == [f"{int(year_month['y']):04d}-{int(year_month['m']):02d}"]
    inc = jobs.run(spark, root, "enrich", months=staged["months"])
    assert inc["rows_in"] == late.count() + first.where(
        F.col("trans_dt").startswith(f"{year_month['y']}-{int(year_month['m']):02d}-")).count()
    cols = ENRICHED.names
    incremental = sorted(map(tuple, read_table(spark, f"{root}/enrichment/transactions", ENRICHED)
                             .select(*cols).collect()), key=str)
    jobs.run(spark, root, "enrich")  # full rebuild for comparison
    rebuilt = sorted(map(tuple, read_table(spark, f"{root}/enrichment/transactions", ENRICHED)
                         .select(*cols).collect()), key=str)
    assert incremental == rebuilt


def test_crash_before_ledger_entry_loads_each_file_once(spark, tmp_path, monkeypatch):
    from salesmart.sources import landing as ld
    root = str(tmp_path)
    landing = f"{root}/landing"
    fixtures.write_landing(spark, SF_SMALL, landing, ("trans_fact_5", "trans_fact_4"))
    real = ld.record_loaded

    def crash(*args, **kwargs):
        raise RuntimeError("driver lost after the table write")
    monkeypatch.setattr(ld, "record_loaded", crash)
    with pytest.raises(RuntimeError):
        jobs.run(spark, root, "stage-transactions")
    written = read_table(spark, f"{root}/staging/transactions", TRANSACTIONS).count()
    assert written > 0  # the half-done load left rows behind
    monkeypatch.setattr(ld, "record_loaded", real)
    fixtures.write_landing(spark, SF_SMALL, landing, ("trans_fact_6",))  # arrives meanwhile
    res = jobs.run(spark, root, "stage-transactions")
    assert len(res["load_ids"]) == 2  # the unfinished load, then the new one
    lines = fixtures.landing_lines(spark, SF_SMALL)
    want = lines.where(F.col("layout").isin("trans_fact_5", "trans_fact_4", "trans_fact_6")).count()
    assert read_table(spark, f"{root}/staging/transactions", TRANSACTIONS).count() == want
    assert jobs.run(spark, root, "stage-transactions") == {"files": 0}


def test_approximate_distinct_counts_stay_close(spark):
    from salesmart.plans.registry import enriched
    sales = enriched(spark, "/root/testdata/sf0.01")
    exact = {r["is_member"]: r for r in rep.metrics_by(sales, "is_member").collect()}
    approx = {r["is_member"]: r for r in rep.metrics_by(sales, "is_member", approx_rsd=0.02).collect()}
    for k, row in exact.items():
        assert approx[k]["total_sales"] == row["total_sales"]  # sums stay exact
        for c in ("count_distinct_trans_key", "count_distinct_collector_key"):
            assert abs(approx[k][c] - row[c]) <= 0.08 * row[c], (k, c)


def _csv(path, *lines):
    import os
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")


STORE_HEADER = "store_location_key,region,province,city,postal_code,banner,store_num"
SALE_HEADER = "collector_key,trans_dt,store_location_key,product_key,sales,units,trans_key"


def test_dimension_change_leaves_no_stale_partition(spark, tmp_path):
    """A store that arrives after its sale: the sale moves, it is not doubled."""
    root = str(tmp_path)
    _csv(f"{root}/landing/product.csv", "product_key,sku,upc,item_name,item_description,department,category", "2,1,1,a,b,c,d")
    _csv(f"{root}/landing/location.csv/a.csv", STORE_HEADER, "1,r,ON,c,p,b,1")
    _csv(f"{root}/landing/trans_fact_1.csv", SALE_HEADER, "5,3/1/2015,1,2,3.5,1,10", "5,3/2/2015,7,2,4.5,1,11")
    for action in ("stage-locations", "stage-products", "stage-transactions", "enrich"):
        jobs.run(spark, root, action)
    _csv(f"{root}/landing/location.csv/b.csv", STORE_HEADER, "7,r,QC,c,p,b,7")
    assert jobs.run(spark, root, "stage-locations")["rows"] == 2
    for options in ({"months": ["2015-03"]}, {}):
        jobs.run(spark, root, "enrich", **options)
        rows = read_table(spark, f"{root}/enrichment/transactions", ENRICHED).collect()
        assert sorted((r["trans_key"], r["province"]) for r in rows) == [("10", "ON"), ("11", "QC")]
        folders = {p.name for p in (tmp_path / "enrichment/transactions").glob("province=*") if any(p.rglob("*.parquet"))}
        assert folders == {"province=ON", "province=QC"}


def test_recovery_reads_what_is_there_and_reports_what_is_gone(spark, tmp_path, monkeypatch):
    import os
    from salesmart.sources import landing as ld
    root = str(tmp_path)
    for n in (1, 2):
        _csv(f"{root}/landing/trans_fact_{n}.csv", SALE_HEADER, f"5,3/1/2015,1,2,3.5,1,{n}")

    def crash(*args, **kwargs):
        raise RuntimeError("lost")
    with monkeypatch.context() as m:
        m.setattr(ld, "record_loaded", crash)
        with pytest.raises(RuntimeError):
            jobs.run(spark, root, "stage-transactions")
    os.remove(f"{root}/landing/trans_fact_1.csv")
    _csv(f"{root}/landing/trans_fact_2.csv", SALE_HEADER, "5,3/1/2015,1,2,3.5,1,20", "5,3/1/2015,1,2,3.5,1,21")
    res = jobs.run(spark, root, "stage-transactions")
    assert [p.rsplit("/", 1)[1] for p in res["gone_files"]] == ["trans_fact_1.csv"]
    assert jobs.run(spark, root, "stage-transactions") == {"files": 0}
    keys = [r["trans_key"] for r in read_table(spark, f"{root}/staging/transactions", TRANSACTIONS).collect()]
    assert sorted(keys) == ["20", "21"]


def test_retired_files_are_gone_and_stay_loaded(spark, tmp_path):
    root = str(tmp_path)
    _csv(f"{root}/landing/trans_fact_1.csv", SALE_HEADER, "5,3/1/2015,1,2,3.5,1,1")
    assert jobs.run(spark, root, "stage-transactions", retire=True)["files"] == 1
    assert not (tmp_path / "landing/trans_fact_1.csv").exists()
    assert jobs.run(spark, root, "stage-transactions") == {"files": 0}
    assert read_table(spark, f"{root}/staging/transactions", TRANSACTIONS).count() == 1
