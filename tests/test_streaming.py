"""Structured Streaming intake: reruns and replayed batches load nothing twice."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from salesmart.contracts import TRANSACTIONS
from salesmart.plans import fixtures
from salesmart.sources import landing as ld
from salesmart.sources.tables import read_table
from salesmart.streaming.intake import _load_batch, _loader, intake_stream


def test_stream_loads_new_files_once(spark, workdir):
    landing, table, ckpt = f"{workdir}/landing", f"{workdir}/txn", f"{workdir}/ckpt"
    fixtures.write_landing(spark, SF_SMALL, landing, ("trans_fact_5",))
    intake_stream(spark, landing, table, ckpt)
    first = read_table(spark, table, TRANSACTIONS).count()
    assert first > 0
    intake_stream(spark, landing, table, ckpt)           # nothing new
    assert read_table(spark, table, TRANSACTIONS).count() == first
    fixtures.write_landing(spark, SF_SMALL, landing, ("trans_fact_6",))
    intake_stream(spark, landing, table, ckpt)           # only the new file
    total = read_table(spark, table, TRANSACTIONS).count()
    lines = fixtures.landing_lines(spark, SF_SMALL)
    assert total == lines.where(F.col("layout").isin("trans_fact_5", "trans_fact_6")).count()


def test_replayed_batch_is_skipped(spark, workdir):
    landing, table = f"{workdir}/landing", f"{workdir}/txn"
    fixtures.write_landing(spark, SF_SMALL, landing, ("trans_fact_4",))
    files = spark.read.format("binaryFile").load(f"{landing}/trans_fact_*").select(
        "path", "modificationTime", "length")
    load = _load_batch(spark, _loader(spark, table, f"{table}_ledger", f"{table}_rejects", False), f"{table}_unrecognized")
    load(files, 7)
    n = read_table(spark, table, TRANSACTIONS).count()
    load(files, 7)  # the same batch id again, as after a crash before the checkpoint commit
    assert read_table(spark, table, TRANSACTIONS).count() == n
    ledger = ld.read_ledger(spark, f"{table}_ledger")
    assert ledger.select("load_id").distinct().collect()[0]["load_id"] == "stream-0000000007"


def test_stream_rejects_bad_dates(spark, workdir):
    import os
    landing, table, ckpt = f"{workdir}/landing", f"{workdir}/txn", f"{workdir}/ckpt"
    os.makedirs(landing)
    with open(f"{landing}/trans_fact_1.csv", "w") as f:
        f.write("collector_key,trans_dt,store_location_key,product_key,sales,units,trans_key\n"
                "1,3/1/2015,1,2,3.5,1,10\n1,13/45/2015,1,2,3.5,1,11\n")
    intake_stream(spark, landing, table, ckpt)
    assert [r["trans_key"] for r in read_table(spark, table, TRANSACTIONS).collect()] == ["10"]
    bad = spark.read.parquet(f"{table}_rejects").collect()
    assert [r["trans_key"] for r in bad] == ["11"]


def test_stream_in_several_batches(spark, workdir):
    landing, table, ckpt = f"{workdir}/landing", f"{workdir}/txn", f"{workdir}/ckpt"
    fixtures.write_landing(spark, SF_SMALL, landing)
    n_files = len(ld.landing_paths(ld.list_files(spark, landing)))
    intake_stream(spark, landing, table, ckpt, max_files_per_trigger=1)
    assert read_table(spark, table, TRANSACTIONS).count() == fixtures.landing_lines(spark, SF_SMALL).count()
    ledger = ld.read_ledger(spark, f"{table}_ledger")
    assert ledger.select("load_id").distinct().count() == n_files
    assert ledger.count() == n_files


def test_replay_after_crash_before_ledger(spark, workdir, monkeypatch):
    landing, table = f"{workdir}/landing", f"{workdir}/txn"
    fixtures.write_landing(spark, SF_SMALL, landing, ("trans_fact_6",))
    files = spark.read.format("binaryFile").load(f"{landing}/trans_fact_*").select(
        "path", "modificationTime", "length")
    load = _load_batch(spark, _loader(spark, table, f"{table}_ledger", f"{table}_rejects", False), f"{table}_unrecognized")
    real = ld.record_loaded

    def crash(*args, **kwargs):
        raise RuntimeError("lost before the ledger entry")
    monkeypatch.setattr(ld, "record_loaded", crash)
    try:
        load(files, 3)
    except RuntimeError:
        pass
    monkeypatch.setattr(ld, "record_loaded", real)
    load(files, 3)  # the replay of batch 3
    want = fixtures.landing_lines(spark, SF_SMALL).where(F.col("layout") == "trans_fact_6").count()
    assert read_table(spark, table, TRANSACTIONS).count() == want


def test_stream_with_source_archive(spark, workdir):
    landing, table, ckpt = f"{workdir}/landing", f"{workdir}/txn", f"{workdir}/ckpt"
    fixtures.write_landing(spark, SF_SMALL, landing, ("trans_fact_5",))
    intake_stream(spark, landing, table, ckpt, source_archive_dir=f"{workdir}/retired")
    fixtures.write_landing(spark, SF_SMALL, landing, ("trans_fact_4",))
    intake_stream(spark, landing, table, ckpt, source_archive_dir=f"{workdir}/retired")
    lines = fixtures.landing_lines(spark, SF_SMALL)
    want = lines.where(F.col("layout").isin("trans_fact_5", "trans_fact_4")).count()
    assert read_table(spark, table, TRANSACTIONS).count() == want


def test_refused_file_is_loaded_once_it_can_be_read(spark, workdir):
    import os
    landing, table, ckpt = f"{workdir}/landing", f"{workdir}/txn", f"{workdir}/ckpt"
    os.makedirs(landing)
    header = "collector_key,trans_dt,store_location_key,product_key,{},units,trans_key\n1,3/1/2015,1,2,3.5,1,10\n"
    for name in ("trans_fact_1.csv", "trans_fact_2.csv"):
        with open(f"{landing}/{name}", "w") as f:
            f.write(header.format("sales" if name.endswith("1.csv") else "amount"))
    intake_stream(spark, landing, table, ckpt)
    pending = spark.read.parquet(f"{table}_unrecognized").collect()
    assert [r["reason"] for r in pending] == ["no column sales"]
    assert read_table(spark, table, TRANSACTIONS).count() == 1
    with open(f"{landing}/trans_fact_2.csv", "w") as f:
        f.write(header.format("Sales"))
    intake_stream(spark, landing, table, ckpt)
    intake_stream(spark, landing, table, ckpt)
    assert read_table(spark, table, TRANSACTIONS).count() == 2


def test_batch_and_stream_share_one_ledger(spark, tmp_path):
    from salesmart.plans import jobs
    root = str(tmp_path)
    z = jobs.Zones(root)
    fixtures.write_landing(spark, SF_SMALL, z.landing, ("trans_fact_5",))
    jobs.run(spark, root, "stage-transactions")
    fixtures.write_landing(spark, SF_SMALL, z.landing, ("trans_fact_6",))
    jobs.stream_transactions(spark, root)
    assert jobs.run(spark, root, "stage-transactions")["files"] == 0
    lines = fixtures.landing_lines(spark, SF_SMALL).where(F.col("layout").isin("trans_fact_5", "trans_fact_6"))
    assert read_table(spark, z.transactions, TRANSACTIONS).count() == lines.count()
