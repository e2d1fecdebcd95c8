"""Steps whose cost must not grow faster than the input."""

import datetime as dt
import glob
import time

from pyspark.sql import functions as F

from conftest import plan_text
from salesmart.contracts import ENRICHED, TRANSACTIONS
from salesmart.functions.keys import NUMBER_TEXT
from salesmart.operators import joins
from salesmart.operators import staging as stg
from salesmart.plans import adapter, fixtures, io_queries, jobs, registry
from salesmart.sources import commits, sinks

LINE = "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, l_shipdate timestamp"


def _tables(spark, folder):
    """Lines of all layouts, one without a number, one without an order."""
    day = dt.datetime(1995, 4, 3)
    lines = [(o, 10 * o, o, n, 2.0, 1.5, day) for o in (1, 2, 3) for n in (1, 2, 3, 4)]
    lines += [(1, 1, 1, None, 1.0, 1.0, day), (9, 1, 1, 1, 1.0, 1.0, day)]
    spark.createDataFrame(lines, LINE).write.parquet(f"{folder}/lineitem.parquet")
    spark.createDataFrame([(1, 5), (2, 6), (2, 7), (3, None)], "o_orderkey bigint, o_custkey bigint").write.parquet(
        f"{folder}/orders.parquet")


def test_landing_files_are_written_without_a_copy_of_all_lines(spark, workdir):
    _tables(spark, workdir)
    kept = f"{spark.sparkContext.getCheckpointDir().removeprefix('file:')}/rdd-*"
    before = set(glob.glob(kept))
    fixtures.write_landing(spark, workdir, f"{workdir}/landing", where=F.col("l_orderkey") < 3)
    assert set(glob.glob(kept)) == before
    lines = fixtures.landing_lines(spark, workdir)
    for name, (_, header) in fixtures.LAYOUTS.items():
        got = spark.read.option("header", True).csv(f"{workdir}/landing/{name}")
        want = lines.where((F.col("layout") == name) & F.col("trans_key").cast("double").isin(1.0, 2.0))
        want = want.select(*[F.col("trans_key" if c == "trans_id" else c) for c in header])
        assert got.count() == (4 if name == "trans_fact_8" else 3)  # order 2 is there twice; the line without a number
        assert got.columns == list(header) and sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, map(tuple, want.collect())))


def test_hot_sale_keys_are_counted_without_the_orders(spark, workdir, monkeypatch):
    _tables(spark, workdir)
    assert "Join" not in plan_text(adapter.sale_keys(spark, workdir))
    counted, real = [], joins._hot_keys
    monkeypatch.setattr(joins, "_hot_keys", lambda fact, keys, budget: counted.append(fact) or real(fact, keys, budget))
    fact = adapter.transactions(spark, workdir)
    dim = spark.createDataFrame([("10", "a"), ("20", "b")], "product_key string, name string")
    keys = adapter.sale_keys(spark, workdir)
    counted.clear()
    for budget in (1, 1000):  # salted, plain
        out = joins.join_dimensions(fact, [(dim, "product_key")], broadcast_rows=0, row_budget=budget, counted=keys)
        want = fact.join(dim, "product_key", "left")
        assert out.exceptAll(want.select(*out.columns)).isEmpty() and out.count() == want.count() == 17
        assert ("_salt" in plan_text(out)) == (budget == 1)
    assert counted == [keys, keys]


def test_a_snapshot_shuffles_no_rows_by_load(spark, workdir):
    row = ("1", "2", "3", dt.date(2020, 1, 1), 1.0, 1, "4", 2020, 1)
    sinks.write_table(spark.createDataFrame([row], TRANSACTIONS.schema), f"{workdir}/t", TRANSACTIONS, load_id="a")
    commits.decide(spark, f"{workdir}/t", "a", commits.PUBLISHED)
    seen = commits.snapshot(spark, f"{workdir}/t", TRANSACTIONS)
    assert "BroadcastHashJoin" in plan_text(seen) and "SortMergeJoin" not in plan_text(seen)
    assert seen.count() == 1


def test_numbers_are_parsed_once(spark):
    raw = spark.createDataFrame([("1", "1/2/2016", "1", "1", s, u, "1") for s, u in (("1.5", "1.0"), ("NaN", "x"), ("1e15", "3"), (" ", None))],
                                "collector_key string, trans_dt string, store_location_key string, product_key string, sales string, units string, trans_key string")
    clean = stg.clean_transactions(raw)
    got = [(r["sales"], r["units"], r["sales_was_missing"], r["units_was_missing"]) for r in clean.collect()]
    assert got == [(1.5, 1, False, False), (0.0, 0, True, True), (0.0, 3, True, False), (0.0, 0, True, True)]
    plan = clean._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count(NUMBER_TEXT) == 2  # of sales and of units


def _shuffle_files(spark):
    files = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
    return {f for f in (files.apply(i).getName() for i in range(files.size())) if f.startswith("shuffle_")}


def _sales_tables(spark, folder):
    """Lines of six months and one without a date; orders, parts and stores."""
    lines = [(o, 10 * (o % 3), o % 2 + 1, 1, 2.0, 1.5, dt.datetime(1995, 1 + o % 6, 3)) for o in range(1, 40)] + [(5, 10, 1, 1, 1.0, 1.0, None)]
    tables = {"lineitem": (lines, LINE), "orders": ([(o, o) for o in range(1, 40)], "o_orderkey bigint, o_custkey bigint"),
              "part": ([(10, "n", "b", "t", 1), (20, "n", "c", "t", 1)], "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int"),
              "supplier": ([(1, "s", 1), (2, "t", 2)], "s_suppkey bigint, s_name string, s_nationkey int"),
              "nation": ([(1, "x", 1), (2, "y", 2)], "n_nationkey int, n_name string, n_regionkey int"),
              "region": ([(1, "r"), (2, "q")], "r_regionkey int, r_name string")}
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")


def test_the_enriched_table_is_written_in_parts_that_free_their_shuffles(spark, workdir, monkeypatch):
    _sales_tables(spark, workdir)
    monkeypatch.setattr(sinks, "SLICE_ROWS", 14)
    monkeypatch.setattr(joins, "size_within", lambda *a: False)  # joins by shuffle
    kept = f"{spark.sparkContext.getCheckpointDir().removeprefix('file:')}/salesmart/slices-*"
    folders, writes, real = set(glob.glob(kept)), [], sinks.write_table

    def write(*args, **options):
        before = _shuffle_files(spark)
        real(*args, **options)
        for _ in range(50):  # they are deleted in the background
            if not (left := _shuffle_files(spark) - before):
                break
            time.sleep(0.2)
        writes.append(left)

    monkeypatch.setattr(sinks, "write_table", write)
    want = sorted(map(str, registry.enriched(spark, workdir).collect()))
    for query in (io_queries.partitioned_roundtrip, io_queries.schema_contract):
        writes.clear()
        got = query(spark, workdir)
        assert writes == [set()] * 3  # three parts, and no shuffle file of theirs is left
        if query is io_queries.partitioned_roundtrip:
            assert sorted(map(str, got.collect())) == want
        else:
            assert {r["value_count"] for r in got.collect() if r["column_name"] in ("trans_key", "trans_dt")} == {40, 39}
    assert set(glob.glob(kept)) == folders


def test_jobs_in_parts_publish_the_same_reports(spark, workdir, monkeypatch):
    _sales_tables(spark, workdir)
    monkeypatch.setattr(io_queries, "LATE_QUARTER", "1995-04-01")
    want = sorted(map(str, io_queries.report_run(spark, workdir).collect()))
    monkeypatch.setattr(sinks, "SLICE_ROWS", 14)
    monkeypatch.setattr(joins, "size_within", lambda *a: False)
    parts, real, write = [], jobs.enrich, sinks.write_table
    monkeypatch.setattr(sinks, "write_table", lambda df, path, contract, **k: (parts.append((contract.name, k.get("mode"))), write(df, path, contract, **k)))
    metrics = []
    monkeypatch.setattr(jobs, "enrich", lambda *a, **k: metrics.append(real(*a, **k)))
    for query, enriched, baskets in ((io_queries.report_run, 3, 0), (io_queries.report_run_incremental, 4, 4)):
        parts.clear(), metrics.clear()
        assert sorted(map(str, query(spark, workdir).collect())) == want
        # The late quarter is small: one part.
        assert sum(p[0] == ENRICHED.name for p in parts) == enriched and sum(p[0] == "baskets" for p in parts) == baskets
        assert metrics[0]["rows_in"] == metrics[0]["rows_out"] == (39 if baskets == 0 else 20)  # a line without a date is rejected
