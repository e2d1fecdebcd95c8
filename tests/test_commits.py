"""Manifest of loads: snapshot reads, rollback, gates, merged products."""

import os

import pytest
from pyspark.sql import functions as F

from salesmart.contracts import LOCATION, PRODUCT, TRANSACTIONS
from salesmart.operators.gates import Gate, parse
from salesmart.plans import jobs
from salesmart.sources import commits, sinks
from salesmart.sources import landing as ld
from salesmart.streaming.intake import _load_batch, _loader, intake_stream

SALE = "collector_key,trans_dt,store_location_key,product_key,sales,units,trans_key"
PRODUCT_LINE = "product_key,sku,upc,item_name,item_description,department,category"
STORE = "store_location_key,region,province,city,postal_code,banner,store_num"


def drop(path, *lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")


def sale(key, date="3/1/2015", sales="3.5", units="1"):
    return f"5,{date},1,2,{sales},{units},{key}"


def keys_of(spark, root, **options):
    rows = commits.snapshot(spark, jobs.Zones(root).transactions, TRANSACTIONS, **options).collect()
    return sorted(r["trans_key"] for r in rows)


def folders(root, load_id=""):
    return [p for p, _, _ in os.walk(f"{root}/staging/transactions") if os.path.basename(p).startswith(f"load_id={load_id}")]


def crashing(monkeypatch, module, name, action):
    """Runs ``action`` while ``module.name`` fails, as if the driver was lost there."""
    def crash(*args, **kwargs):
        raise RuntimeError("lost")
    with monkeypatch.context() as m:
        m.setattr(module, name, crash)
        with pytest.raises(RuntimeError):
            action()


@pytest.mark.parametrize("left", ["none", "one", "renamed"])
def test_replay_of_a_load_whose_files_are_gone(spark, tmp_path, monkeypatch, left):
    """The lost file's month is its own, so a replay does not write there."""
    root = str(tmp_path)
    drop(f"{root}/landing/trans_fact_1.csv", SALE, sale(1, "1/5/2015"), sale(2, "2/5/2015"))
    drop(f"{root}/landing/trans_fact_2.csv", SALE, sale(3, "3/5/2015"))
    crashing(monkeypatch, ld, "record_loaded", lambda: jobs.run(spark, root, "stage-transactions"))
    assert len(folders(root)) == 3 and keys_of(spark, root) == []
    os.remove(f"{root}/landing/trans_fact_1.csv")
    if left != "one":
        os.remove(f"{root}/landing/trans_fact_2.csv")
    if left == "renamed":
        drop(f"{root}/landing/trans_fact_3.csv", SALE, sale(1, "1/5/2015"), sale(2, "2/5/2015"), sale(3, "3/5/2015"))
    res = jobs.run(spark, root, "stage-transactions")
    assert len(res["gone_files"]) == (1 if left == "one" else 2)
    assert keys_of(spark, root) == {"none": [], "one": ["3"], "renamed": ["1", "2", "3"]}[left]
    assert len(folders(root)) == {"none": 0, "one": 1, "renamed": 3}[left]
    assert not any(os.listdir(f"{root}/archive/landing/transactions")) or left != "none"
    assert jobs.run(spark, root, "stage-transactions") == {"files": 0}


@pytest.mark.parametrize("left", ["none", "one"])
def test_replayed_batch_whose_files_are_gone(spark, tmp_path, monkeypatch, left):
    landing, table = f"{tmp_path}/landing", f"{tmp_path}/staging/transactions"
    drop(f"{landing}/trans_fact_1.csv", SALE, sale(1, "1/5/2015"))
    drop(f"{landing}/trans_fact_2.csv", SALE, sale(2, "2/5/2015"))
    crashing(monkeypatch, ld, "record_loaded", lambda: intake_failing(spark, landing, table, tmp_path))
    assert len(folders(tmp_path)) == 2
    os.remove(f"{landing}/trans_fact_1.csv")
    if left == "none":
        os.remove(f"{landing}/trans_fact_2.csv")
    intake_stream(spark, landing, table, f"{tmp_path}/ckpt")
    rows = commits.snapshot(spark, table, TRANSACTIONS).collect()
    assert [r["trans_key"] for r in rows] == (["2"] if left == "one" else [])
    assert len(folders(tmp_path)) == len(rows)


def intake_failing(spark, landing, table, tmp_path):
    try:
        intake_stream(spark, landing, table, f"{tmp_path}/ckpt")
    except Exception as error:
        raise RuntimeError("the stream ended") from error


def test_a_reader_sees_a_load_only_once_it_is_published(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    drop(f"{root}/landing/trans_fact_1.csv", SALE, sale(1))
    jobs.run(spark, root, "stage-transactions")
    drop(f"{root}/landing/trans_fact_2.csv", SALE, sale(2))
    seen = []
    for module, name in ((sinks, "write_text_csv"), (ld, "record_loaded"), (commits, "decide")):
        real = getattr(module, name)

        def spying(*args, _real=real, **kwargs):
            seen.append(keys_of(spark, root))
            return _real(*args, **kwargs)
        monkeypatch.setattr(module, name, spying)
    jobs.run(spark, root, "stage-transactions")
    assert len(folders(root)) == 2 and seen == [["1"]] * 3
    assert keys_of(spark, root) == ["1", "2"] and keys_of(spark, root, as_of=1) == ["1"]


def test_a_load_that_stops_before_its_commit_is_published_by_the_next_run(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    drop(f"{root}/landing/trans_fact_1.csv", SALE, sale(1))
    crashing(monkeypatch, commits, "decide", lambda: jobs.run(spark, root, "stage-transactions"))
    assert keys_of(spark, root) == []
    assert jobs.run(spark, root, "stage-transactions") == {"files": 0}
    assert keys_of(spark, root) == ["1"]


def test_tables_from_before_manifests_keep_their_loads(spark, tmp_path):
    root = str(tmp_path)
    z = jobs.Zones(root)
    rows = spark.createDataFrame([("1", "2", "5", "2015-03-01", 3.5, 1, "9", 2015, 3)], TRANSACTIONS.names)
    sinks.write_table(rows, z.transactions, TRANSACTIONS, load_id="old")
    assert keys_of(spark, root) == ["9"]
    files = spark.createDataFrame([("p", "t", "1")], ld.FILES_SCHEMA)
    ld.record_loaded(files, f"{z.ledger}/transactions", "old")
    drop(f"{root}/landing/trans_fact_1.csv", SALE, sale(1))
    jobs.run(spark, root, "stage-transactions")
    assert keys_of(spark, root) == ["1", "9"]


def test_gate_quarantines_and_decisions_follow(spark, tmp_path):
    root = str(tmp_path)
    gate = Gate(rejected=0.4, sales_filled=0.5)
    drop(f"{root}/landing/trans_fact_1.csv", SALE, sale(1), sale(2, "13/45/2015"), sale(3, "02/30/2015"))
    res = jobs.run(spark, root, "stage-transactions", gate=gate)
    bad = res["load_id"]
    assert res["quarantined"] == {bad: ["rejected rows: 2 of 3"]} and res["months"] == []
    drop(f"{root}/landing/trans_fact_2.csv", SALE, sale(4), sale(5, sales=""))
    good = jobs.run(spark, root, "stage-transactions", gate=gate)
    assert "quarantined" not in good and good["months"] == ["2015-03"]
    drop(f"{root}/landing/trans_fact_3.csv", SALE, sale(6, sales="x"))
    worse = jobs.run(spark, root, "stage-transactions", gate=gate)["load_id"]
    assert keys_of(spark, root) == ["4", "5"]
    assert jobs.run(spark, root, "stage-transactions") == {"files": 0}
    assert jobs.release(spark, root, bad)["months"] == ["2015-03"]
    assert keys_of(spark, root) == ["1", "4", "5"]
    jobs.discard(spark, root, worse)
    assert folders(root, worse) == []
    for load_id in (worse, bad, "other"):
        with pytest.raises(ValueError):
            jobs.release(spark, root, load_id)


def test_gate_bounds():
    import datetime as dt
    seen = dict(rows=10, rejected=1, sales_filled=0, units_filled=10, keyless=0, lossy_keys=2,
                min_dt=dt.date(2014, 1, 1), max_dt=dt.date(2016, 1, 1))
    assert Gate().reasons(seen) == [] and Gate(rejected=0.1, units_filled=1.0, min_rows=10).reasons(seen) == []
    gate = parse("rejected=0.05, lossy_keys=0.1,min_rows=11,first_date=2015-01-01,last_date=2015-12-31")
    assert len(gate.reasons(seen)) == 5
    assert Gate(rejected=0.0).reasons(seen | {"rows": 0, "rejected": 0, "min_dt": None, "max_dt": None}) == []
    with pytest.raises(ValueError):
        parse("speed=1")


def products(spark, root):
    rows = commits.snapshot(spark, jobs.Zones(root).product, PRODUCT).collect()
    return sorted((r["product_key"] or "", r["department"] or "", r["item_name"] or "") for r in rows)


def test_products_merge_by_key(spark, tmp_path):
    root = str(tmp_path)
    drop(f"{root}/landing/product.csv/a.csv", PRODUCT_LINE, "1,s,u,old,d,A,c", "002,s,u,two,d,A,c", ",s,u,none,d,A,c")
    assert jobs.run(spark, root, "stage-products")["rows"] == 3
    drop(f"{root}/landing/product.csv/b.csv", PRODUCT_LINE, "01,s,u,new,d,B,c", "3,s,u,three,d,,c", ",s,u,again,d,A,c")
    assert jobs.run(spark, root, "stage-products")["rows"] == 3
    want = [("", "A", "again"), ("1", "B", "new"), ("2", "A", "two"), ("3", "", "three")]
    assert products(spark, root) == want
    drop(f"{root}/landing/product.csv/c.csv", PRODUCT_LINE, "3,s,u,four,d,C,c", "3,s,u,five,d,C,c")
    jobs.run(spark, root, "stage-products")
    assert products(spark, root) == [*want[:3], ("3", "C", "five"), ("3", "C", "four")]
    # of the three loads the last two have folders
    assert len({os.path.basename(p) for p, _, _ in os.walk(f"{root}/staging/product") if "load_id=" in os.path.basename(p)}) == 2


def test_products_merged_once_after_a_crash(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    drop(f"{root}/landing/product.csv/a.csv", PRODUCT_LINE, "1,s,u,old,d,A,c", "2,s,u,two,d,A,c")
    jobs.run(spark, root, "stage-products")
    drop(f"{root}/landing/product.csv/b.csv", PRODUCT_LINE, "1,s,u,new,d,B,c")
    crashing(monkeypatch, ld, "record_loaded", lambda: jobs.run(spark, root, "stage-products"))
    assert products(spark, root) == [("1", "A", "old"), ("2", "A", "two")]
    jobs.run(spark, root, "stage-products")
    assert products(spark, root) == [("1", "B", "new"), ("2", "A", "two")]


def test_locations_change_in_one_commit(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    drop(f"{root}/landing/location.csv/a.csv", STORE, "1,r,ON,c,p,b,1", "2,r,ON,c,p,b,2")
    jobs.run(spark, root, "stage-locations")
    drop(f"{root}/landing/location.csv/a.csv", STORE, "2,r,QC,c,p,b,2")
    crashing(monkeypatch, ld, "record_loaded", lambda: jobs.run(spark, root, "stage-locations"))

    def stores():
        rows = commits.snapshot(spark, jobs.Zones(root).location, LOCATION).collect()
        return sorted((r["store_num"], r["province"]) for r in rows)
    assert stores() == [("1", "ON"), ("2", "ON")]
    jobs.run(spark, root, "stage-locations")
    assert stores() == [("2", "QC")]


def test_manifest_prunes_folders(spark, tmp_path):
    from conftest import plan_text
    root = str(tmp_path)
    for n in (1, 2):
        drop(f"{root}/landing/trans_fact_{n}.csv", SALE, sale(n))
        jobs.run(spark, root, "stage-transactions")
    plan = plan_text(commits.snapshot(spark, jobs.Zones(root).transactions, TRANSACTIONS).where(F.col("trans_year") == 2015))
    assert "PartitionFilters" in plan and "dynamicpruning" in plan.lower()


def test_stream_publishes_each_batch(spark, tmp_path):
    landing, table = f"{tmp_path}/landing", f"{tmp_path}/txn"
    drop(f"{landing}/trans_fact_1.csv", SALE, sale(1))
    files = ld.list_files(spark, landing).withColumnRenamed("modification_time", "modificationTime")
    load = _load_batch(spark, _loader(spark, table, f"{table}_ledger", f"{table}_rejects", False), f"{table}_unrecognized")
    load(files, 4)
    assert [r["state"] for r in commits.manifest(spark, table).collect()] == [commits.PUBLISHED]
    assert commits.state_of(spark, table, "stream-0000000004") == commits.PUBLISHED


def scanned_rows(df):
    """Rows that the parquet scans of an executed frame gave out."""
    df.collect()
    plan, total, todo = df._jdf.queryExecution().executedPlan(), 0, []
    todo.append(plan)
    while todo:
        node = todo.pop()
        name = node.nodeName()
        if name.startswith("AdaptiveSparkPlan"):
            todo.append(node.executedPlan())
        elif name.startswith("Scan parquet"):
            total += node.metrics().apply("numOutputRows").value()
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
        if "QueryStage" in name:
            todo.append(node.plan())
    return total


def test_lookups_leave_row_groups_unread(spark, tmp_path):
    rows = spark.range(40_000).select(
        F.lit("1").alias("store_location_key"), (F.col("id") % 997).cast("string").alias("product_key"), F.lit("5").alias("collector_key"),
        F.lit("2015-03-01").cast("date").alias("trans_dt"), F.lit(1.0).alias("sales"), F.lit(1).alias("units"),
        F.col("id").cast("string").alias("trans_key"), F.lit(2015).alias("trans_year"), (F.col("id") % 12 + 1).cast("int").alias("trans_month"))
    path = f"{tmp_path}/t"
    sinks.write_table(rows, path, TRANSACTIONS, load_id="a", max_records_per_file=500)
    table = commits.snapshot(spark, path, TRANSACTIONS)
    one = table.where("trans_key = '12345'")
    assert one.count() == 1 and scanned_rows(one) <= 2_000
    product = table.where("product_key = '77'")
    assert product.count() == 41 and scanned_rows(product) <= 24_000  # 41 rows, each in a file of 500 at most
    assert scanned_rows(table.where("trans_key = 'none'")) <= 2_000


def test_a_hundred_thousand_files_are_listed_without_the_driver(spark, tmp_path, monkeypatch):
    """Listing, ledger and batches are tables: plans hold no path, and the
    driver gets the paths of one batch at a time."""
    from conftest import plan_text
    path = F.concat(F.lit("file:/landing/trans_fact_"), F.col("id"))
    files = spark.range(100_000).select(path.alias("path"), F.lit("t").alias("modification_time"), F.lit("1").alias("length"))
    ledger = f"{tmp_path}/ledger"
    ld.record_loaded(files.where("pmod(xxhash64(path, 1), 2) = 0"), ledger, "one")
    ld.record_intent(files.where("path like '%7' and pmod(xxhash64(path, 1), 2) = 1").limit(3000), ledger, "two")
    listing = ld.freeze(files)
    new = ld.freeze(ld.new_files(listing, ld.read_ledger(spark, ledger)))
    (load_id, there, gone), = ld.unfinished_loads(spark, ledger, listing)
    assert (load_id, there.count(), gone.count()) == ("two", 3000, 0)
    rest = new.join(there.select("path"), "path", "left_anti")
    batches = ld.in_batches(ld.freeze(rest), 10_000)
    sizes = [b.count() for b in batches]
    assert len(sizes) > 4 and max(sizes) < 11_000 and sum(sizes) == rest.count()
    assert all("trans_fact_" not in plan_text(x, "extended") for x in (new, there, rest, *batches))


def test_loads_in_batches_hold_every_line_once(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    for n in range(7):
        drop(f"{root}/landing/trans_fact_{n}.csv", SALE, sale(n))
    monkeypatch.setattr(jobs, "LOAD_FILES", 3)
    res = jobs.run(spark, root, "stage-transactions")
    assert res["files"] == 7 and len(res["load_ids"]) > 1
    assert keys_of(spark, root) == [str(n) for n in range(7)]
    assert jobs.run(spark, root, "stage-transactions") == {"files": 0}
