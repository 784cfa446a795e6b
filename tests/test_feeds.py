"""A1-A4, A14, A16 from real files: CSV round trips and file order."""

import csv
import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from parcelgrid import fixtures as fx
from parcelgrid.sources import feeds as FD
from parcelgrid.sources import listing as LS
from parcelgrid.sources.tables import Lake


def _write_csv(path, header, rows):
    with open(path, "w", newline="", encoding="utf-8") as f:
        w = csv.writer(f)
        if header:
            w.writerow(header)
        w.writerows(rows)


def test_ownership_csv_round_trip(spark, tmp):
    lake = Lake(spark, SF_SMALL)
    feed = fx.ownership_feed(lake).orderBy("_seq")
    data = [tuple(r)[:-1] for r in feed.collect()]
    half = len(data) // 2
    _write_csv(os.path.join(tmp, "a.csv"), FD.OWNERSHIP_COLUMNS, data[:half])
    _write_csv(os.path.join(tmp, "b.csv"), FD.OWNERSHIP_COLUMNS, data[half:])
    raw = FD.read_csv(spark, tmp, FD.OWNERSHIP_COLUMNS)
    c_file, o_file, s_file = FD.load_ownership(raw)
    c_mem, o_mem, s_mem = FD.load_ownership(feed)
    key = lambda r: tuple("" if v is None else str(v) for v in r)
    assert sorted(map(tuple, c_file.collect()), key=key) == sorted(map(tuple, c_mem.collect()), key=key)
    assert sorted(map(tuple, s_file.collect()), key=key) == sorted(map(tuple, s_mem.collect()), key=key)
    assert o_file.count() == o_mem.count()


def test_file_order_picks_first_and_last_row_per_key(spark, tmp):
    for i, name in enumerate(["p1.csv", "p2.csv", "p3.csv"]):
        _write_csv(os.path.join(tmp, name), ["k", "v"], [(f"k{j % 5}", f"{name}:{j}") for j in range(200)])
    raw = FD.read_csv(spark.newSession(), tmp, ["k", "v"])
    first = {r.k: r.v for r in FD.dedup_first(raw.select("k", "v", "_seq"), ["k"], "_seq").collect()}
    last = {r.k: r.v for r in FD.dedup_last(raw.select("k", "v", "_seq"), ["k"], "_seq").collect()}
    assert first == {f"k{j}": f"p1.csv:{j}" for j in range(5)}
    assert last == {f"k{j}": f"p3.csv:{195 + j}" for j in range(5)}


def test_sales_headerless_csv(spark, tmp):
    rows = [("{1}", "250000", "2021-03-04 00:00", "E1 1AA", "F", "N", "L", "12", "", "HIGH ST", "", "LONDON",
             "X", "Y", "A", "A"),
            ("{2}", "99", "not a date", "E1 1AA", "F", "N", "L", "3", "FLAT 2", "LOW RD", "", "", "", "", "A", "A"),
            ("{3}", "100", "2019-01-01 00:00", "E1 1AB", "D", "N", "F", " 7", "", "\tLANE ", "", "", "", "", "A", "A")]
    _write_csv(os.path.join(tmp, "pp.csv"), None, rows)
    raw = FD.read_csv(spark, tmp, header=False, n_columns=16)
    out = {r.transaction_id: r for r in FD.load_sales(raw).collect()}
    assert out["{1}"].full_address == "12  HIGH ST"          # empty saon leaves a double space
    assert out["{2}"].transfer_date is None
    assert out["{3}"].full_address == "7  \tLANE"             # strip only at the ends
    kept = {r.transaction_id for r in FD.load_sales(raw, min_year=2020).collect()}
    assert kept == {"{1}"}                                    # NULL dates drop out of the year filter


def test_postcode_file_needs_nine_columns(spark, tmp):
    _write_csv(os.path.join(tmp, "cp.csv"), None, [("E1 1AA", "10", "530000", "180000")])
    raw = FD.read_csv(spark, tmp, header=False, n_columns=4)
    with pytest.raises(ValueError):
        FD.load_postcodes(raw)


def test_listing_from_binary_files(spark, tmp):
    os.makedirs(os.path.join(tmp, "raw", "epc"))
    for n in ["x_certificates.csv", "x_recommendations_certificates.csv", "y.txt"]:
        with open(os.path.join(tmp, "raw", "epc", n), "w") as f:
            f.write("abc")
    listing = LS.list_files(spark, tmp)
    keys = sorted(os.path.basename(r.object_key) for r in
                  LS.select_feed_files(listing, "", "certificates.csv", "recommendations").collect())
    assert keys == ["x_certificates.csv"]


def test_folder_rule(spark):
    df = spark.createDataFrame([("a/b/c.csv",), ("a/c.csv",), ("c.csv",)], "object_key string")
    got = [r[0] for r in df.select(LS.folder_of(F.col("object_key"))).collect()]
    assert got == ["a/b", "a", "root"]


def test_csv_columns_are_picked_by_header_name(spark, tmp_path):
    import pytest

    from parcelgrid.sources.feeds import read_csv
    (tmp_path / "a.csv").write_text('Tenure,Title Number,District,Postcode,Address\nFreehold,T1,D,P1,"1 ""Old"" High St, London"\n')
    got = read_csv(spark, str(tmp_path), ["Title Number", "Address", "Postcode"]).collect()
    assert [(r["Title Number"], r["Address"], r["Postcode"]) for r in got] == [("T1", '1 "Old" High St, London', "P1")]
    with pytest.raises(ValueError, match="Town"):
        read_csv(spark, str(tmp_path), ["Title Number", "Town"])


def _folder(tmp_path, files):
    for name, data in files.items():
        (tmp_path / name).write_bytes(data if isinstance(data, bytes) else data.encode())
    return str(tmp_path)


def test_bad_files_are_set_aside_whole_and_the_rest_loads(spark, tmp_path):
    path = _folder(tmp_path, {
        "good.csv": '﻿a,b\r\n1,"x, ""y"""\r\n\r\n,"z"\n',
        "other_order.csv": "extra,b,a\nq,2,1\nq,,\n",
        "short_lines.csv": "a,b\n5\n",
        "header_only.csv": "a,b\n",
        "empty.csv": "", "blank.csv": "\n  \n",
        "no_b.csv": "a,c\n1,2\n",
        "long_line.csv": "a,b\n1,2\n1,2,3\n",
        "open_quote.csv": 'a,b\n1,"2\n3,4\n', "after_quote.csv": 'a,b\n1,"2"x\n', "inner_quote.csv": 'a,b\n1,2"x\n',
        "latin.csv": b"a,b\n1,caf\xe9\n",
    })
    rows, verdicts = FD.read_files(spark, path, ["a", "b"])
    got = {r.file.rsplit("/", 1)[1]: (r.reason, r.n_lines, r.n_bad) for r in verdicts.collect()}
    assert got == {
        "good.csv": (None, 2, 0), "other_order.csv": (None, 2, 0), "short_lines.csv": (None, 1, 0), "header_only.csv": (None, 0, 0),
        "empty.csv": ("empty", 0, 0), "blank.csv": ("empty", 0, 0), "no_b.csv": ("missing columns", 1, 0), "long_line.csv": ("too many fields", 2, 1),
        "open_quote.csv": ("malformed line", 2, 1), "after_quote.csv": ("malformed line", 1, 1), "inner_quote.csv": ("malformed line", 1, 1),
        "latin.csv": ("not UTF-8", 1, 1)}
    assert sorted((r._file, r.a, r.b) for r in rows.orderBy("_file", "a").collect() if r.a) == [
        ("good.csv", "1", 'x, "y"'), ("other_order.csv", "1", "2"), ("short_lines.csv", "5", None)]
    assert sorted((r._file, r.b) for r in rows.collect() if r.a is None) == [("good.csv", "z"), ("other_order.csv", None)]


def test_files_without_a_header_and_folders_without_files(spark, tmp_path):
    wide = ",".join("0123456789")
    (tmp_path / "in").mkdir()
    path = _folder(tmp_path / "in", {"w.csv": wide + "\n" + wide + "\n", "n.csv": "E1 1AA,10,530000,180000\n", "ragged.csv": "1,2,3,4,5,6,7,8,9\n" + wide + "\n"})
    rows, verdicts = FD.read_files(spark, path, min_columns=9)
    assert {r.file.rsplit("/", 1)[1]: r.reason for r in verdicts.collect()} == {"w.csv": None, "n.csv": "too few columns", "ragged.csv": "too many fields"}
    assert [tuple(r)[:9] for r in rows.collect()] == [tuple("012345678")] * 2
    assert FD.load_postcodes(rows.drop("_path")).count() == 2
    (tmp_path / "none").mkdir()
    assert [f.count() for f in FD.read_files(spark, str(tmp_path / "none"), ["a"])] == [0, 0]


def test_rows_of_readable_files_keep_their_order(spark, tmp_path):
    path = _folder(tmp_path, {f"p{k}.csv": "k,v\n" + "".join(f"k{j % 3},p{k}:{j}\n" for j in range(300)) for k in (1, 2)})
    rows, _ = FD.read_files(spark, path, ["K", "V"], ignore_case=True)
    last = {r.K: r.V for r in FD.dedup_last(rows.select("K", "V", "_seq"), ["K"], "_seq").collect()}
    assert last == {"k0": "p2:297", "k1": "p2:298", "k2": "p2:299"}
