"""Landing files in four layouts, read by header and cleaned."""

import datetime as dt
import os

from salesmart.operators import staging as stg
from salesmart.sources import landing as ld

# Fixed sample lines of the four landing layouts and the clean rows expected.
FILES = {
    "trans_fact_5.csv": ("collector_key,trans_dt,store_location_key,product_key,sales,units,trans_key",
                         "-1,2015-07-24 00:00:00,6973,77105810883,8.53,1,31216969731182201507241448"),
    "trans_fact_4.csv": ("collector_key,trans_dt,store_location_key,product_key,sales,units,trans_key",
                         "-1,1/2/2016,8142,18021700046,64.06,1,3.6831800000E+25"),
    "trans_fact_6.csv": ("collector_key,trans_dt,store_location_key,product_key,sales,units,trans_id",
                         "139518000000,10/14/2015,6973,1000000000000000,0.0,,3.152050000E+24"),
    "trans_fact_8.csv": ("product_key,collector_key,trans_dt,store_location_key,sales,units,trans_id",
                         "62455802158,-1,1/8/2016,6973,,1,3.1846100000E+25"),
}
EXPECTED = {
    "trans_fact_5.csv": ("6973", "77105810883", "-1", dt.date(2015, 7, 24), 8.53, 1,
                         "31216969731182201507241448", 2015, 7),
    "trans_fact_4.csv": ("8142", "18021700046", "-1", dt.date(2016, 1, 2), 64.06, 1,
                         "36831800000000000000000000", 2016, 1),
    "trans_fact_6.csv": ("6973", "1000000000000000", "139518000000", dt.date(2015, 10, 14), 0.0, 0,
                         "3152050000000000000000000", 2015, 10),
    "trans_fact_8.csv": ("6973", "62455802158", "-1", dt.date(2016, 1, 8), 0.0, 1,
                         "31846100000000000000000000", 2016, 1),
}


def write_files(folder, files):
    os.makedirs(folder, exist_ok=True)
    for name, lines in files.items():
        with open(os.path.join(folder, name), "w") as f:
            f.write("\n".join(lines) + "\n")


def test_four_layouts_clean_rows(spark, workdir):
    write_files(workdir, FILES)
    paths = ld.landing_paths(ld.list_files(spark, workdir))
    assert len(paths) == 4
    layouts, refused = ld.header_layouts(spark, paths)
    assert not refused
    assert len(layouts) == 3  # trans_fact_4 and _5 share a header
    clean = stg.clean_transactions(ld.read_transactions(spark, paths))
    rows = {r["landing_name"]: r for r in clean.collect()}
    for name, expected in EXPECTED.items():
        r = rows[name]
        got = tuple(r[c] for c in ("store_location_key", "product_key", "collector_key", "trans_dt",
                                   "sales", "units", "trans_key", "trans_year", "trans_month"))
        assert got == expected, name
        assert r["reject_reason"] is None
    assert rows["trans_fact_6.csv"]["units_was_missing"] is True
    assert rows["trans_fact_8.csv"]["sales_was_missing"] is True
    assert rows["trans_fact_5.csv"]["sales_was_missing"] is False


def test_edge_rows_are_rejected_or_filled(spark, workdir):
    header = "collector_key,trans_dt,store_location_key,product_key,sales,units,trans_key"
    write_files(workdir, {"trans_fact_9.csv": (
        header,
        ",,1,2,3.5,1,10",              # empty collector and date -> reject
        "5,13/45/2015,1,2,3.5,1,11",   # impossible date -> reject
        "5,02/30/2015,1,2,3.5,1,12",   # impossible date -> reject
        "5,3/1/2015,00123,2,x,1.0,13",  # bad sales -> 0, units 1.0 -> 1, key 00123 -> 123
    )})
    paths = ld.landing_paths(ld.list_files(spark, workdir))
    raw = ld.read_transactions(spark, paths)
    clean = stg.clean_transactions(raw)
    good = stg.accepted(clean).collect()
    assert len(good) == 1
    g = good[0]
    assert (g["store_location_key"], g["sales"], g["units"], g["trans_key"]) == ("123", 0.0, 1, "13")
    bad = stg.rejects(raw).collect()
    assert sorted(r["trans_key"] for r in bad) == ["10", "11", "12"]
    assert all(r["reject_reason"] == stg.BAD_TRANS_DT for r in bad)
    lenient = stg.accepted(stg.clean_transactions(raw, lenient_dates=True)).collect()
    assert len(lenient) == 3  # 13/45/2015 and 02/30/2015 roll over


def test_empty_landing_folder(spark, workdir):
    files = ld.list_files(spark, workdir)
    assert files.count() == 0
    assert ld.read_transactions(spark, []).count() == 0


def test_glob_read_would_shift_columns(spark, workdir):
    """Why layouts are read one by one: a single positional read misplaces
    the product key of the product-first layout."""
    write_files(workdir, FILES)
    naive = spark.read.option("header", True).csv(f"{workdir}/trans_fact_*")
    row = [r for r in naive.collect() if r["collector_key"] == "62455802158"]
    assert row, "positional read puts the product key under collector_key"


def test_lossy_keys_counted_per_file(spark, workdir):
    write_files(workdir, FILES)
    paths = ld.landing_paths(ld.list_files(spark, workdir))
    audit = {r["landing_name"]: r for r in
             stg.measure_audit(stg.clean_transactions(ld.read_transactions(spark, paths))).collect()}
    assert audit["trans_fact_5.csv"]["lossy_trans_keys"] == 0
    assert audit["trans_fact_4.csv"]["lossy_trans_keys"] == 1
    assert audit["trans_fact_8.csv"]["sales_filled"] == 1
    assert audit["trans_fact_6.csv"]["units_filled"] == 1


def test_text_scan_finds_the_same_headers(spark, workdir, monkeypatch):
    write_files(workdir, FILES)
    paths = ld.landing_paths(ld.list_files(spark, workdir))
    probed = ld.header_layouts(spark, paths)

    def unopened(batches):
        import pyarrow as pa
        for batch in batches:
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.nulls(n, pa.string()), pa.array([False] * n)],
                                             names=["path", "value", "opened"])
    monkeypatch.setattr(ld, "_probe_batches", unopened)
    assert ld.header_layouts(spark, paths) == probed
    assert len(probed[0]) == 3


def test_header_probe_falls_back_for_unopenable_paths():
    line, opened = ld._first_line("nosuchscheme://bucket/file.csv")
    assert (line, opened) == (None, False)


def test_header_line_beyond_one_chunk_is_read_whole(workdir):
    import os
    path = os.path.join(workdir, "long.csv")
    header = ",".join(f"column_{i}" for i in range(20_000))
    with open(path, "w") as f:
        f.write("\n" + header + "\n1,2\n")
    assert len(header) > ld.PROBE_CHUNK_BYTES
    assert ld._first_line(f"file:{path}") == (header, True)


def test_header_must_be_first_line(spark, workdir):
    write_files(workdir, {"trans_fact_x.csv": (
        "junk line", "collector_key,trans_dt,store_location_key,product_key,sales,units,trans_key",
        "1,3/2/2015,1,2,3.5,1,11")})
    write_files(workdir, FILES)
    paths = ld.landing_paths(ld.list_files(spark, workdir))
    layouts, refused = ld.header_layouts(spark, paths)
    assert len([p for _, ps in layouts for p in ps]) == 4
    assert [p.rsplit("/", 1)[1] for p in refused] == ["trans_fact_x.csv"]


def test_names_match_without_case_and_missing_or_double_columns_refuse(spark, workdir):
    write_files(workdir, {
        "trans_fact_1.csv": ("Collector_Key,TRANS_DT,store_location_key,product_key,Sales,units,Trans_Id",
                             "5,3/1/2015,1,2,3.5,1,13"),
        "trans_fact_2.csv": ("collector_key,trans_dt,store_location_key,product_key,units,trans_key",
                             "5,3/1/2015,1,2,1,14"),
        "trans_fact_3.csv": ("collector_key,trans_dt,store_location_key,product_key,sales,units,trans_key,trans_id",
                             "5,3/1/2015,1,2,3.5,1,15,15")})
    paths = ld.landing_paths(ld.list_files(spark, workdir))
    _, refused = ld.header_layouts(spark, paths)
    reasons = {p.rsplit("/", 1)[1]: r for p, r in refused.items()}
    assert reasons == {"trans_fact_2.csv": "no column sales",
                       "trans_fact_3.csv": "trans_key given twice (trans_key, trans_id)"}
    rows = stg.accepted(stg.clean_transactions(ld.read_transactions(spark, paths))).collect()
    assert [(r["sales"], r["trans_key"]) for r in rows] == [(3.5, "13")]


def test_amounts_that_are_no_finite_number_are_flagged(spark, workdir):
    header = "collector_key,trans_dt,store_location_key,product_key,sales,units,trans_key"
    texts = ("NaN", "Infinity", "-Infinity", "1e15", "1.5d", "1e999", "12.50", "1e14")
    write_files(workdir, {"trans_fact_9.csv": (header, *(
        f"5,3/1/2015,1,2,{t},1,{'1' + '0' * 25 if i == 0 else '2' * 26}" for i, t in enumerate(texts)))})
    clean = stg.clean_transactions(ld.read_transactions(spark, ld.landing_paths(ld.list_files(spark, workdir))))
    rows = clean.collect()
    assert [r["sales_was_missing"] for r in rows] == [True] * 6 + [False] * 2
    assert {r["trans_key"] for r in rows} == {"1" + "0" * 25, "2" * 26}
    audit = stg.measure_audit(clean).first()
    assert audit["total_sales"] == 100000000000012.5 or str(audit["total_sales"]) == "100000000000012.500"
    assert audit["sales_filled"] == 6 and audit["lossy_trans_keys"] == 1
