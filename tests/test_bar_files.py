"""Bars from many CSV files: headers of all kinds in one scan, thousands of files, odd files."""

import pytest

from tapeline.sources import bars


def test_headers_of_all_kinds(spark, tmp_path):
    files = {
        "A.csv": '﻿"Date ","Open_Price","High","Low","Close","Total Traded Quantity","Series"\n01-02-2024,"1,000.5",1002,999,1001,"12,345",EQ\n02-02-2024,1,2,0.5,1.5,10,BE\n',
        "B.csv": "volume,close,date,open,high,low,extra,columns,here\n7,4,2024-02-01,1,5,1,x,y,z\n\n7,-,2024-02-02,1,5,1\n8,4,2024-02-03,2\n",
        "C.csv": "Date,Open,High,Low\n01/02/2024,1,2,1\n",
        "D.csv": "",
        "E.csv": "Date,Close,Prev Close,Volume\n03-Feb-2024,5,4,9\nDate,Close,Prev Close,Volume\n04-Feb-2024,6,5,10\n",
    }
    for name, text in files.items():
        (tmp_path / name).write_text(text, encoding="utf-8")
    got = {(r["symbol"], str(r["date"])): tuple(r)[2:] for r in bars.read_bars(spark, [f"{tmp_path}/*.csv"]).collect()}
    assert got == {
        ("A", "2024-02-01"): (1000.5, 1002.0, 999.0, 1001.0, 12345.0), ("B", "2024-02-01"): (1.0, 5.0, 1.0, 4.0, 7.0), ("B", "2024-02-03"): (2.0, None, None, 4.0, 8.0),
        ("E", "2024-02-03"): (None, None, None, 5.0, 9.0), ("E", "2024-02-04"): (None, None, None, 6.0, 10.0),
    }
    assert bars.read_bars(spark, [f"{tmp_path}/A.csv"], series=None).count() == 2 and bars.read_bars(spark, [f"{tmp_path}/D.csv"]).count() == 0


def test_thousands_of_files_are_one_scan(spark, tmp_path):
    for k in range(2000):
        head = ("Date,Open,High,Low,Close,Volume", "Close,Date,Low,High,Open,Qty")[k % 2]
        row = (f"01-02-2024,1,3,1,2,{k}", f"2,01-02-2024,1,3,1,{k}")[k % 2]
        (tmp_path / f"S{k}.csv").write_text(f"{head}\n{row}\n")
    df = bars.read_bars(spark, [str(tmp_path)])
    got = {r["symbol"]: (r["open"], r["close"], r["volume"]) for r in df.collect()}
    assert got == {f"S{k}": (1.0, 2.0, float(k)) for k in range(2000)}
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("text") == 1 and str(tmp_path) + "/S1" not in plan


def test_a_line_is_parsed_once(spark, tmp_path):
    (tmp_path / "A.csv").write_text("Date,Open,High,Low,Close,Volume,Series\n01-02-2024,1,3,1,2,7,EQ\n02-02-2024,1,3,1,2,7,BE\n03-02-2024,1,3,1,-,7,EQ\n")
    df = bars.read_bars(spark, [str(tmp_path)])
    assert df.count() == 1
    assert df._jdf.queryExecution().optimizedPlan().toString().count("from_csv") == 1


def test_days_of_all_formats(spark):
    texts = ["01-02-2024", "01/02/2024", " 01-Feb-2024", "01 Feb 2024", "2024-02-01", "1-2-2024", "01.02.2024", "31-02-2024", "", None, "01-2024-02", "01-Fub-2024"]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string")
    got = [str(r[1]) for r in sorted(df.select("k", bars.to_day(df.t)).collect())]
    assert got == ["2024-02-01"] * 5 + ["None"] * 7
