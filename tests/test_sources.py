import datetime as dt
from decimal import Decimal
from pathlib import Path

import pytest
from conftest import day, rows
from pyspark.sql import functions as F

from ledgerloom import schemas as S
from ledgerloom.sources.csv_files import (
    Delimited,
    EncodingError,
    read_delimited,
    resolve_encoding,
    write_delimited,
)

D = Decimal


def test_columns_by_name_in_any_case_and_order(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text("NAME;Code;EXTRA\nАктив;007;x\nNULL;;y\n", encoding="utf-8")
    got = read_delimited(spark, str(path), ["code", "name"])
    assert rows(got) == sorted([("007", "Актив"), (None, None)], key=str)
    with pytest.raises(ValueError, match="no column other"):
        read_delimited(spark, str(path), ["code", "other"])


@pytest.mark.parametrize("bad", ["1;a;b;c", "1"])
def test_rows_with_a_wrong_number_of_fields_fail(spark, tmp_path, bad):
    path = tmp_path / "a.csv"
    path.write_text(f'k;v;w\n1;"a;b";c\n{bad}\n')
    with pytest.raises(Exception, match="malformed row"):
        read_delimited(spark, str(path), ["k", "v"]).collect()
    path.write_text('k;v;w\n1;"a;b";c\n')
    assert rows(read_delimited(spark, str(path), ["w", "v"])) == [("c", "a;b")]


def test_files_of_a_folder_must_agree(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "1.csv").write_text("k;v\n1;a\n")
    (folder / "2.csv").write_text("v;k\nb;2\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_delimited(spark, str(folder), ["k", "v"]).collect()


def test_encoding_is_found(spark, tmp_path):
    style = Delimited(sep=",")
    for encoding, expected in (("utf-8", "UTF-8"), ("cp1251", "windows-1251")):
        path = tmp_path / f"{encoding}.csv"
        path.write_bytes("k,name\n1,Рубль\n2,Доллар\n".encode(encoding))
        assert resolve_encoding(spark, str(path), style) == expected
        assert rows(read_delimited(spark, str(path), ["k", "name"], style)) == [
            ("1", "Рубль"),
            ("2", "Доллар"),
        ]


def test_no_candidate_decodes_the_file(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_bytes("k;name\n1;Рубль\n".encode("cp1251"))
    with pytest.raises(EncodingError):
        read_delimited(spark, str(path), ["k", "name"], Delimited(encodings=("UTF-8",)))
    # 98 has no meaning in this code page.
    path.write_bytes(b"k;name\n1;\x98\n")
    with pytest.raises(EncodingError):
        read_delimited(spark, str(path), ["k", "name"])


def test_code_page_in_the_header_too(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_bytes("код;имя\n1;Рубль\n".encode("cp1251"))
    assert rows(read_delimited(spark, str(path), ["код", "имя"])) == [("1", "Рубль")]


def test_missing_file(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_delimited(spark, str(tmp_path / "none.csv"), ["a"])


def test_round_trip_of_awkward_texts(spark, tmp_path):
    data = [("1", 'a"b'), ("2", "a;b"), ("3", None), ("4", " pad ")]
    df = spark.createDataFrame(data, "k string, v string")
    path = str(tmp_path / "out")
    assert write_delimited(df, path) == 4
    parts = [p.read_text() for p in Path(path).glob("part-*.csv")]
    assert any("3;NULL" in p for p in parts)
    assert rows(read_delimited(spark, path, ["k", "v"])) == sorted(data, key=str)


def test_line_breaks_inside_quotes(spark, tmp_path):
    style = Delimited(multi_line=True)
    df = spark.createDataFrame([("1", "a\nb"), ("2", "c")], "k string, v string")
    path = str(tmp_path / "out")
    write_delimited(df, path, style)
    assert rows(read_delimited(spark, path, ["k", "v"], style)) == rows(df)


def test_rewrite_reads_from_itself_and_keeps_old_versions(store, frame):
    spec = S.CURRENCY_NAME
    assert store.read(spec).count() == 0
    store.rewrite(spec, frame(spec, [("1", "a")]))
    for _ in range(4):
        store.rewrite(spec, store.read(spec).union(frame(spec, [("2", "b")])))
    assert store.read(spec).count() == 5
    assert len(store._versions(spec)) == 2


def test_failed_rewrite_changes_nothing(store, frame):
    spec = S.CURRENCY_NAME
    store.rewrite(spec, frame(spec, [("1", "a")]))
    bad = frame(spec, [("2", "b")]).withColumn("currency_name", F.raise_error(F.lit("boom")).cast("string"))
    with pytest.raises(Exception, match="boom"):
        store.rewrite(spec, bad)
    assert rows(store.read(spec)) == [("1", "a")]
    store.rewrite(spec, frame(spec, [("3", "c")]))
    assert rows(store.read(spec)) == [("3", "c")]


def test_measures_during_the_write(store, frame):
    seen = store.rewrite(
        S.CURRENCY_NAME,
        frame(S.CURRENCY_NAME, [("1", "a"), ("2", None)]),
        measures=[F.count_if(F.col("currency_name").isNull()).alias("holes")],
    )
    assert seen == {"rows": 2, "holes": 1}


@pytest.mark.parametrize("compact", [False, True])
def test_replace_dates(store, frame, compact):
    spec = S.DAILY_BALANCE
    d1, d2, d3 = (day(f"2018-01-0{i}") for i in (1, 2, 3))
    first = [(d, rk, D(rk), D(rk)) for d in (d1, d2, d3) for rk in (1, 2)]
    assert store.replace_dates(spec, frame(spec, first), [d1, d2, d3], compact) == 6
    # The table is rewritten from itself; d2 gets no rows and must become empty.
    again = store.read(spec).filter("account_rk = 1 AND on_date = '2018-01-01'")
    assert store.replace_dates(spec, again, [d1, d2], compact) == 1
    assert rows(store.read(spec), "on_date", "account_rk") == [(d1, 1), (d3, 1), (d3, 2)]
    with pytest.raises(Exception, match="2018-01-03 is not a date to replace"):
        store.replace_dates(spec, store.read(spec), [d1])
    assert store.read(spec).count() == 3
    store.truncate(spec)
    assert store.read(spec).count() == 0


def test_reading_one_date_prunes_partitions(store, frame):
    spec = S.TURNOVER
    days = [day("2018-01-01") + dt.timedelta(days=i) for i in range(4)]
    store.replace_dates(spec, frame(spec, [(d, 1, *[D(1)] * 4) for d in days]), days)
    one = store.read(spec).filter(F.col("on_date") == days[1])
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(on_date" in plan
    assert len(one.inputFiles()) >= 1 and rows(one, "on_date") == [(days[1],)]
