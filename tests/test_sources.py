import json
import sqlite3
import struct

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from helpers import mzml_text
from pyarrow import feather
from pyspark.sql import functions as F

from peakloom.sources import legacy
from peakloom.sources.mgf import read_mgf
from peakloom.sources.mzml import read_mzml
from peakloom.sources.mzml_writer import write_mzml
from peakloom.sources.tables import (
    assignment_rows,
    in_noise_last_order,
    read_assignment_tsv,
    read_clustering_csv,
    read_tsv,
    with_scan_reference,
    write_tsv,
)

SPECTRA = [
    dict(scan=1, level=1, mass=0, rt=30.0, mz=[1, 2], intensity=[3, 4]),
    dict(scan=2, mass=445.12, charge=2, rt=60.0, mz=[100.5, 200.25], intensity=[10, 20]),
    dict(scan=3, mass=500.5, charge=None, rt=90.0, mz=[], intensity=[]),
    dict(scan=7, mass=300.0, charge=1, rt=120.0, mz=[50.0], intensity=[1.5]),
]


@pytest.mark.parametrize(
    "packed,double,minutes,shared",
    [(True, True, False, False), (False, False, True, False), (True, False, True, True)],
)
def test_mzml_variants(spark, tmp_path, packed, double, minutes, shared):
    (tmp_path / "a.mzML").write_text(mzml_text(SPECTRA, packed, double, minutes, shared))
    (tmp_path / "consensus.mzML").write_text(mzml_text(SPECTRA))
    (tmp_path / "note.txt").write_text("no spectra")
    rows = read_mzml(spark, str(tmp_path)).orderBy("scan").collect()
    assert [r.scan for r in rows] == [2, 3, 7]
    assert [r.charge for r in rows] == [2, None, 1]
    assert [r.rt_sec for r in rows] == pytest.approx([60.0, 90.0, 120.0])
    assert rows[0].mz == [100.5, 200.25] and rows[0].intensity == [10.0, 20.0]
    assert rows[1].mz == []
    assert rows[0].filename == "a.mzML" and rows[0].path.endswith("/a.mzML")


def test_mzml_bad_spectrum(spark, tmp_path):
    broken = dict(scan=4, mass=1.0, rt=1.0, mz=[1], intensity=[1], no_ion=True)
    (tmp_path / "a.mzML").write_text(mzml_text([*SPECTRA, broken]))
    assert read_mzml(spark, str(tmp_path), "DROPMALFORMED").count() == 3
    assert read_mzml(spark, str(tmp_path)).where("error is not null").count() == 1
    with pytest.raises(Exception, match="unreadable spectrum"):
        read_mzml(spark, str(tmp_path), "FAILFAST").collect()


def test_mzml_is_split_by_bytes(spark, tmp_path):
    many = [dict(scan=n, mass=400.0 + n, charge=1, rt=1.0, mz=list(range(1, 50)), intensity=list(range(49))) for n in range(1, 201)]
    (tmp_path / "a.mzML").write_text(mzml_text(many))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        df = read_mzml(spark, str(tmp_path))
        assert df.rdd.getNumPartitions() > 3
        assert sorted(r.scan for r in df.select("scan").collect()) == list(range(1, 201))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_mzml_round_trip(spark, tmp_path):
    rows = [(f"controllerType=0 controllerNumber=1 scan={n}", 400.0 + n, float(n), n % 3, [1.0 * n, 2.5], [3.0, 4.0]) for n in range(1, 11)]
    df = spark.createDataFrame(rows, "native_id string, precursor_mz double, rt_sec double, charge int, mz array<double>, intensity array<double>")
    for _ in range(2):  # the second write replaces the first
        write_mzml(df.repartition(3), str(tmp_path / "out"), "consensus", max_records=2)
    names = [p.name for p in (tmp_path / "out").iterdir()]
    assert len([n for n in names if n.endswith(".mzML")]) >= 5 and not any(n.startswith("_pending") for n in names)
    back = read_mzml(spark, str(tmp_path / "out")).orderBy("scan").collect()
    assert [r.scan for r in back] == list(range(1, 11))
    assert [(r.precursor_mz, r.rt_sec, r.charge, r.mz) for r in back] == [(a[1], a[2], a[3], a[4]) for a in rows]


def test_mgf(spark, tmp_path):
    (tmp_path / "a.mgf").write_text(
        "BEGIN IONS\r\nTITLE=a=b BEGIN\r\nCLUSTER=3\r\nPEPMASS=445.12 1000\r\nCHARGE=2+\r\nRTINSECONDS=12.5\r\n"
        "100.5 10\r\n200.25\t20\r\nbad line here\r\n1 x\r\n3e2 .5\r\nEND IONS\r\n\r\n"
        "BEGIN IONS\ncluster=-1\nprecursor_mz=7\ncharge=-1\ncluster=5\nEND IONS\n"
        "BEGIN IONS\nCLUSTER=9\n1 2\n"
    )
    rows = {r.cluster: r for r in read_mgf(spark, str(tmp_path / "a.mgf")).collect()}
    assert set(rows) == {3, 5}
    a, b = rows[3], rows[5]
    assert (a.title, a.precursor_mz, a.rt_sec, a.charge) == ("a=b BEGIN", 445.12, 12.5, 2)
    assert a.mz == [100.5, 200.25, 300.0] and a.intensity == [10.0, 20.0, 0.5]
    assert (b.precursor_mz, b.charge, b.rt_sec, b.mz) == (7.0, 0, 0.0, [])
    assert a.fields["pepmass"] == "445.12 1000" and b.fields["cluster"] == "5"


def test_clustering_csv_and_assignment(spark, tmp_path):
    (tmp_path / "c.csv").write_text(
        "# made by a tool\ncluster,precursor_mz,retention_time,precursor_charge,identifier\n"
        "1,400.5,10,2,mzspec:X:run1:scan:17\n-1,401.5,11,2,mzspec:X:run2:scan:18\n0,402,12,1,mzspec:X:run1:scan:19\n"
    )
    rows = with_scan_reference(read_clustering_csv(spark, str(tmp_path / "c.csv")))
    ordered = in_noise_last_order(rows, "filename", "scan").collect()
    assert [(r.cluster, r.filename, r.scan, r.precursor_mz) for r in ordered] == [
        (0, "run1.mzML", "19", 402.0), (1, "run1.mzML", "17", 400.5), (-1, "run2.mzML", "18", 401.5),
    ]
    write_tsv(rows, str(tmp_path / "t.tsv"))
    assert read_tsv(spark, str(tmp_path / "t.tsv")).count() == 3
    back = assignment_rows(read_assignment_tsv(spark, str(tmp_path / "t.tsv")), "/data/")
    assert {(r.temp_cluster, r.path, r.scan) for r in back.collect()} == {
        (1, "/data/run1.mzML", 17), (-1, "/data/run2.mzML", 18), (0, "/data/run1.mzML", 19),
    }


def test_legacy_lists_and_consensus(spark, tmp_path):
    table = pa.table({"cluster_id": [1, 1, 2], "filename": ["/d/a.mzML", "/d/a.mzML", "/d/b.mzML"], "scan": [5, 6, 7]})
    feather.write_feather(table, tmp_path / "s.feather", chunksize=2)
    rows = legacy.read_feather(spark, str(tmp_path / "s.feather")).orderBy("scan").collect()
    assert [(r.cluster_id, r.path, r.filename, r.scan, r.precursor_mz) for r in rows] == [
        (1, "/d/a.mzML", "a.mzML", 5, 0.0), (1, "/d/a.mzML", "a.mzML", 6, 0.0), (2, "/d/b.mzML", "b.mzML", 7, 0.0),
    ]
    pack = lambda *v: np.array(v, "<f4").tobytes()
    pq.write_table(
        pa.table(
            {
                "cluster_id": pa.array([1, 2], pa.int32()), "filename": ["consensus_1", "consensus_2"], "scan": [1, 2],
                "spectrum_mz": [pack(1, 2), b""], "spectrum_intensity": [pack(3, 4), b""],
                "precursor_mz": pa.array([5.5, 0], pa.float32()), "rtinseconds": pa.array([1, 2], pa.float32()),
                "charge": pa.array([1, 0], pa.int32()), "title": ["t", ""],
                "spec_pool_mz": [[pack(1), b""], [pack(9, 8)]], "spec_pool_intensity": [[pack(2), b""], [pack(7, 6)]],
            }
        ),
        tmp_path / "c.parquet",
    )
    got = legacy.read_consensus(spark, str(tmp_path / "c.parquet")).orderBy("cluster_id").collect()
    assert (got[0].mz, got[0].intensity, got[0].precursor_mz, got[1].mz) == ([1.0, 2.0], [3.0, 4.0], 5.5, [])
    pools = legacy.read_member_pools(spark, str(tmp_path / "c.parquet")).orderBy("cluster_id").collect()
    assert [(p.cluster_id, p.member_no, p.mz) for p in pools] == [(1, 0, [1.0]), (2, 0, [9.0, 8.0])]


def test_legacy_store(spark, tmp_path):
    db = sqlite3.connect(tmp_path / "spectra_index.db")
    db.execute(
        "CREATE TABLE spectrum_index (filename TEXT, scan INTEGER, offset INTEGER, size INTEGER, precursor_mz REAL,"
        " rtinseconds REAL, charge INTEGER, peak_count INTEGER, PRIMARY KEY (filename, scan))"
    )
    with open(tmp_path / "spectra.bin", "wb") as out:
        for n in range(25):
            blob = struct.pack("<ddii", 400.0 + n, 1.0 * n, 1, 2) + struct.pack("<ffff", 1 + n, 10, 2 + n, 20)
            db.execute("INSERT INTO spectrum_index VALUES (?,?,?,?,?,?,?,?)", ("/d/a.mzML", n, out.tell(), len(blob), 0, 0, 1, 2))
            out.write(blob)
    db.commit()
    db.close()
    old, legacy.ROWS_PER_TASK = legacy.ROWS_PER_TASK, 10
    try:
        store = legacy.read_spectrum_store(spark, str(tmp_path))
        rows = store.orderBy("scan").collect()
    finally:
        legacy.ROWS_PER_TASK = old
    assert [r.scan for r in rows] == list(range(25))
    assert (rows[3].precursor_mz, rows[3].rt_sec, rows[3].mz, rows[3].intensity) == (403.0, 3.0, [4.0, 5.0], [10.0, 20.0])
    consensus = spark.createDataFrame([(8, 1.5, 2.0, 1, [1.0], [2.0])], "cluster_id long, precursor_mz double, rt_sec double, charge int, mz array<double>, intensity array<double>")
    wanted = spark.createDataFrame([("/d/a.mzML", 3), ("/d/a.mzML", 3), ("x/consensus_8", 8), ("/d/a.mzML", 99)], "path string, scan long")
    got = legacy.stored_or_consensus(wanted, store, consensus)
    assert {(r.scan, r.precursor_mz) for r in got.collect()} == {(3, 403.0), (8, 1.5)}
    assert json.loads(json.dumps(got.select(F.count("*")).first()[0])) == 2


@pytest.mark.parametrize("change,message", [
    (('name="b"', 'name="b"', '</scanList>', '</scanList><cvParam accession="MS:1000128" name="profile spectrum"/>'), "profile"),
    (("MS:1000574", "MS:1002312", "", ""), "compression"),
    (("MS:1000523", "MS:1000522", "", ""), "floats"),
])
def test_mzml_of_a_kind_not_read_fails_in_every_mode(spark, tmp_path, change, message):
    text = mzml_text(SPECTRA[1:])
    for old, new in zip(change[::2], change[1::2], strict=True):
        text = text.replace(old, new) if old else text
    (tmp_path / "a.mzML").write_text(text)
    for mode in ("DROPMALFORMED", "PERMISSIVE", "FAILFAST"):
        with pytest.raises(Exception, match=message):
            read_mzml(spark, str(tmp_path), mode).collect()


@pytest.mark.parametrize("gap", ["\n", "\t", " \r\n  "])
def test_mzml_tag_may_be_followed_by_any_white_space(spark, tmp_path, gap):
    (tmp_path / "a.mzML").write_text(mzml_text(SPECTRA).replace("<spectrum ", f"<spectrum{gap}"))
    assert sorted(r.scan for r in read_mzml(spark, str(tmp_path), "DROPMALFORMED").collect()) == [2, 3, 7]


def test_ids_of_exports_are_read_back(spark, tmp_path):
    ids = ["scan=12", "scan=12_1", "scan=/d/a.mzML_17", "index=4"]
    rows = [(i, 400.0, 1.0, 1, [100.0], [1.0]) for i in ids]
    df = spark.createDataFrame(rows, "native_id string, precursor_mz double, rt_sec double, charge int, mz array<double>, intensity array<double>")
    write_mzml(df, str(tmp_path / "out"))
    got = {r.title: r.scan for r in read_mzml(spark, str(tmp_path / "out")).collect()}
    assert got == dict(zip(ids, [12, 12, 17, 4], strict=True))
