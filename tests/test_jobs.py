import datetime as dt
import threading
from decimal import Decimal

import pytest
from conftest import day, money, rows

from ledgerloom import schemas as S
from ledgerloom.functions.casts import DOTTED_DATE
from ledgerloom.plans import jobs
from ledgerloom.plans.jobs import IngestSpec, detail_specs, reject_table
from ledgerloom.sources.csv_files import Delimited, EncodingError
from ledgerloom.streaming.file_drop import bad_files_table, load_dropped_files

FILES = {
    "ft_balance_f": """ON_DATE;ACCOUNT_RK;CURRENCY_RK;BALANCE_OUT
31.12.2017;1;34;100.50
31.12.2017;2;35;20
31.12.2017;2;35;20
31.12.2017;3;34;7
""",
    "ft_posting_f": """OPER_DATE;CREDIT_ACCOUNT_RK;DEBET_ACCOUNT_RK;CREDIT_AMOUNT;DEBET_AMOUNT
09-01-2018;1;2;10;10
09-01-2018;1;2;10;10
10-01-2018;2;1;5.25;5.25
10-01-2018;2;9;;1
""",
    "md_account_d": """DATA_ACTUAL_DATE;DATA_ACTUAL_END_DATE;ACCOUNT_RK;ACCOUNT_NUMBER;CHAR_TYPE;CURRENCY_RK;CURRENCY_CODE
2018-01-01;2018-01-31;1;30102810000000000001;А;34;810
2018-01-01;2018-01-31;2;30109840000000000002;П;35;840
""",
    "md_currency_d": """CURRENCY_RK;DATA_ACTUAL_DATE;DATA_ACTUAL_END_DATE;CURRENCY_CODE;CODE_ISO_CHAR
34;2018-01-01;2050-12-31;643;RUB
35;2018-01-01;;840;USD
36;2018-01-01;;999;XXX
37;2018-01-01;;100;NON
""",
    "md_exchange_rate_d": """DATA_ACTUAL_DATE;DATA_ACTUAL_END_DATE;CURRENCY_RK;REDUCED_COURCE;CODE_ISO_NUM
2017-12-31;2018-01-09;35;57.5;840
2018-01-10;2018-01-31;35;60;840
""",
    "md_ledger_account_s": """CHAPTER;CHAPTER_NAME;SECTION_NUMBER;SECTION_NAME;SUBSECTION_NAME;LEDGER1_ACCOUNT;LEDGER1_ACCOUNT_NAME;LEDGER_ACCOUNT;LEDGER_ACCOUNT_NAME;CHARACTERISTIC;START_DATE;END_DATE
А;Балансовые счета;3;РАСЧЕТЫ;СЧЕТА;301;Счета;30102;Первый;А;2008-01-01;2050-12-31
А;Балансовые счета;3;РАСЧЕТЫ;СЧЕТА;301;Счета;30109;Второй;П;2008-01-01;2050-12-31
""",
}
POSTING_DATES = "dd-MM-yyyy"


@pytest.fixture
def folder(tmp_path):
    where = tmp_path / "in"
    where.mkdir()
    for name, text in FILES.items():
        encoding = "cp1251" if name == "md_ledger_account_s" else "utf-8"
        (where / f"{name}.csv").write_bytes(text.encode(encoding))
    return where


def month(house):
    house.fill_turnover(day("2018-01-01"), day("2018-01-31"))
    house.seed_balances(day("2017-12-31"))
    house.fill_balances(day("2018-01-01"), day("2018-01-31"))
    house.fill_ledger_report(day("2018-02-01"))


def test_whole_month(house, folder):
    stats = house.load_detail(str(folder), POSTING_DATES)
    counted = {n: (s.input, s.inserted, s.updated, s.skipped) for n, s in stats.items()}
    assert counted == {
        "ft_balance_f": (4, 3, 0, 1),
        "ft_posting_f": (4, 3, 0, 1),
        "md_account_d": (2, 2, 0, 0),
        "md_currency_d": (4, 2, 0, 2),
        "md_exchange_rate_d": (2, 2, 0, 0),
        "md_ledger_account_s": (2, 2, 0, 0),
    }
    assert stats["md_currency_d"].message == (
        "2: Несоответствие данных - currency_rk: 36, data_actual_date: 2018-01-01 .. "
        "Несоответствие данных - currency_rk: 37, data_actual_date: 2018-01-01"
    )
    assert stats["ft_posting_f"].message.endswith("credit_amount: , debet_amount: 1.00000000")
    assert stats["md_account_d"].message is None
    # The one file in a single-byte code page was recognised.
    assert rows(house.store.read(S.LEDGER_ACCOUNT), "ledger_account_name") == [("Второй",), ("Первый",)]
    month(house)
    read = house.store.read
    assert rows(read(S.TURNOVER)) == sorted(
        [
            (day("2018-01-09"), 1, *map(money, (10, 10, 0, 0))),
            (day("2018-01-09"), 2, *map(money, (0, 0, 10, 575))),
            (day("2018-01-10"), 1, *map(money, (0, 0, "5.25", "5.25"))),
            (day("2018-01-10"), 2, *map(money, ("5.25", 315, 0, 0))),
            (day("2018-01-10"), 9, *map(money, (0, 0, 1, 1))),
        ],
        key=str,
    )
    balance = {(r.on_date, r.account_rk): r.balance_out_rub for r in read(S.DAILY_BALANCE).collect()}
    assert len(balance) == 3 + 2 * 31
    assert balance[day("2018-01-08"), 2] == money(1150)
    assert balance[day("2018-01-09"), 2] == money(575)
    assert balance[day("2018-01-31"), 2] == money(890)
    assert balance[day("2018-01-31"), 1] == money("95.75")
    report = {r.ledger_account: r for r in read(S.LEDGER_REPORT).collect()}
    assert report["30109"].balance_in_val == money(1150)
    assert report["30109"].turn_deb_val == money(575)
    assert report["30102"].balance_out_rub == money("95.75")

    # Rejected rows are kept by run; clean loads look for none.
    kept = read(reject_table(detail_specs(POSTING_DATES)[3]))
    assert kept.count() == 2 and kept.select("run_id").distinct().count() == 1
    assert not house.store.exists(reject_table(detail_specs(POSTING_DATES)[2]))

    # A second run of everything gives the same tables.
    before = {s.name: rows(read(s)) for s in (S.BALANCE, S.TURNOVER, S.DAILY_BALANCE, S.LEDGER_REPORT)}
    again = house.load_detail(str(folder), POSTING_DATES)
    assert again["ft_balance_f"].inserted == again["ft_balance_f"].updated == 0
    month(house)
    for s in (S.BALANCE, S.TURNOVER, S.DAILY_BALANCE, S.LEDGER_REPORT):
        assert rows(read(s)) == before[s.name]
    states = house.audit.latest()
    assert {r.status for r in states.collect()} == {"SUCCESS"}
    assert states.count() == 2 * (6 + 4)
    assert states.filter("end_time <= start_time").isEmpty()

    # One day at a time gives the period's balances.
    for i in range(1, 5):
        house.fill_balances(day("2018-01-01") + dt.timedelta(days=i - 1))
    assert rows(read(S.DAILY_BALANCE)) == before[S.DAILY_BALANCE.name]

    # Export, import into a twin, compare.
    path = str(folder / "report_out")
    twin = S.LEDGER_REPORT.twin("dm_f101_round_f_v2")
    assert house.export_csv(S.LEDGER_REPORT, path).input == 2
    for _ in range(2):
        assert house.import_csv(twin, path, truncate_first=True).inserted == 2
    assert rows(read(twin)) == before[S.LEDGER_REPORT.name]


def test_overlapping_rates_stop_the_seed(house, folder):
    rates = FILES["md_exchange_rate_d"] + "2017-12-30;2018-01-02;35;99;840\n"
    (folder / "md_exchange_rate_d.csv").write_text(rates)
    for spec in detail_specs(POSTING_DATES):
        if spec.table in (S.BALANCE, S.EXCHANGE_RATE):
            house.load_file(spec, str(folder / spec.file_name))
    with pytest.raises(Exception, match="key is not unique"):
        house.seed_balances(day("2017-12-31"))
    assert house.store.read(S.DAILY_BALANCE).count() == 0
    assert "md_exchange_rate_d (data_actual_date date" in house.store.preview(S.EXCHANGE_RATE)


def test_failures_are_recorded(house, folder):
    spec = detail_specs(POSTING_DATES)[0]
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        house.load_file(spec, str(folder / "absent.csv"))
    bad = folder / "bad.csv"
    bad.write_text("ON_DATE;ACCOUNT_RK;CURRENCY_RK;BALANCE_OUT\n31.12.2017;x;1;1\n")
    with pytest.raises(Exception):
        house.load_file(spec, str(bad))
    states = house.audit.latest().collect()
    assert [r.status for r in states] == ["FAILED", "FAILED"]
    assert any("PATH_NOT_FOUND" in r.message for r in states)
    assert house.store.read(S.BALANCE).count() == 0


def test_null_key_is_rejected_and_null_attribute_stops(house, folder):
    path = folder / "accounts.csv"
    head = FILES["md_account_d"].splitlines()[0]
    path.write_text(f"{head}\n2018-01-01;2018-01-31;;301;А;34;810\n2018-01-01;2018-01-31;5;301;А;34;810\n")
    spec = IngestSpec(S.ACCOUNT, "yyyy-MM-dd")
    stats = house.load_file(spec, str(path))
    assert (stats.inserted, stats.skipped) == (1, 1)
    path.write_text(f"{head}\n2018-01-01;2018-01-31;6;301;;34;810\n")
    with pytest.raises(Exception, match="NULL in required columns"):
        house.load_file(spec, str(path))
    assert house.store.read(S.ACCOUNT).count() == 1


def test_source_copies(house, folder, frame):
    start, end = day("2023-03-15"), day("2999-12-31")
    old = [(1, "mortgge", start, end), (2, "card", start, end), (2, "card", start, end)]
    house.store.rewrite(S.PRODUCT, frame(S.PRODUCT, old))
    path = folder / "product.csv"
    path.write_text(
        "product_rk,product_name,effective_from_date,effective_to_date\n"
        "1,mortgage,2023-03-15,2999-12-31\n2,card,2023-03-15,2999-12-31\n2,card,2023-03-15,2999-12-31\n"
    )
    extra = S.PRODUCT.twin("product_extra")
    with pytest.raises(ExceptionGroup):
        house.import_many({str(folder / "no.csv"): extra, str(path): extra}, Delimited(sep=","))
    assert house.store.read(extra).count() == 3
    house.import_csv(extra, str(path), Delimited(sep=","))
    assert house.store.read(extra).count() == 6
    assert house.append_file_rows(S.PRODUCT, extra).inserted == 5
    assert house.replace_by_file_rows(S.PRODUCT, extra).inserted == 2
    assert rows(house.store.read(S.PRODUCT), "product_name") == [("card",), ("mortgage",)]
    clients = [(1, start, end, None), (1, start, end, dt.datetime(2020, 1, 1)), (1, start, None, None)]
    house.store.rewrite(S.CLIENT, frame(S.CLIENT, clients))
    house.remove_duplicates(S.CLIENT, ["effective_to_date", "client_open_dttm"])
    assert rows(house.store.read(S.CLIENT)) == [(1, start, None, None)]
    house.store.rewrite(S.DEAL, frame(S.DEAL, [(1, 2, start, end)], ["deal_rk", "product_rk", "effective_from_date", "effective_to_date"]))
    assert house.reload_loan_holidays().inserted == 1
    assert house.store.read(S.LOAN_HOLIDAY_INFO).first().product_name == "card"


def test_load_touches_staged_dates_and_finishes_what_was_pending(house, folder, frame):
    spec = IngestSpec(S.BALANCE, DOTTED_DATE)
    path = folder / "b.csv"
    head = "ON_DATE;ACCOUNT_RK;CURRENCY_RK;BALANCE_OUT\n"
    path.write_text(head + "30.12.2017;1;34;1\n31.12.2017;1;34;2\n")
    house.load_file(spec, str(path))
    first = f"{house.store.folder(S.BALANCE)}/on_date=2017-12-30"
    files = house.store._children(first)
    path.write_text(head + "31.12.2017;1;34;3\n31.12.2017;2;34;4\n")
    stats = house.load_file(spec, str(path))
    assert (stats.inserted, stats.updated) == (1, 1)
    assert house.store._children(first) == files
    # A job died after preparing 2017-12-31 anew: the next load takes that over first.
    left = [(day("2017-12-31"), 1, 34, Decimal(9)), (day("2017-12-31"), 2, 34, Decimal(4))]
    house.store.rewrite(S.BALANCE.twin("ft_balance_f_pending", "work"), frame(S.BALANCE, left))
    path.write_text(head + "01.01.2018;7;34;7\n")
    house.load_file(spec, str(path))
    assert rows(house.store.read(S.BALANCE), "on_date", "account_rk", "balance_out") == sorted(
        [
            (day("2017-12-30"), 1, money(1)),
            (day("2017-12-31"), 1, money(9)),
            (day("2017-12-31"), 2, money(4)),
            (day("2018-01-01"), 7, money(7)),
        ],
        key=str,
    )


def test_import_into_a_dated_table(house, folder):
    path = folder / "sums.csv"
    path.write_text(
        "account_rk;effective_date;account_in_sum;account_out_sum\n1;2024-01-01;0;10\n1;2024-01-02;10;NULL\n"
    )
    for expected in (2, 4):
        house.import_csv(S.SOURCE_BALANCE, str(path))
        assert house.store.read(S.SOURCE_BALANCE).count() == expected
    house.import_csv(S.SOURCE_BALANCE, str(path), truncate_first=True)
    assert rows(house.store.read(S.SOURCE_BALANCE)) == sorted(
        [
            (1, day("2024-01-01"), money(0), money(10)),
            (1, day("2024-01-02"), money(10), None),
        ],
        key=str,
    )


def test_balance_repair_job(house, frame):
    first, second = day("2024-01-01"), day("2024-01-02")
    sums = [(1, first, Decimal(0), Decimal(10)), (1, second, Decimal(11), Decimal(20))]
    house.store.replace_dates(S.SOURCE_BALANCE, frame(S.SOURCE_BALANCE, sums), [first, second])
    house.store.rewrite(S.SOURCE_ACCOUNT, frame(S.SOURCE_ACCOUNT, [(1, 1, "1")]))
    untouched = house.store._children(f"{house.store.folder(S.SOURCE_BALANCE)}/effective_date=2024-01-01")
    assert house.correct_balances().updated == 1
    assert house.correct_balances().updated == 0
    assert untouched == house.store._children(
        f"{house.store.folder(S.SOURCE_BALANCE)}/effective_date=2024-01-01"
    )
    house.reload_balance_turnover()
    assert rows(house.store.read(S.BALANCE_TURNOVER), "account_in_sum", "currency_name") == sorted(
        [(money(0), "-1"), (money(10), "-1")], key=str
    )


def test_dropped_files_are_loaded_once(house, tmp_path):
    drop, progress = tmp_path / "drop", str(tmp_path / "progress")
    drop.mkdir()
    head = "ON_DATE;ACCOUNT_RK;CURRENCY_RK;BALANCE_OUT\n"
    spec = IngestSpec(S.BALANCE, DOTTED_DATE)
    (drop / "1.csv").write_text(head + "31.12.2017;1;34;5\n31.12.2017;2;NULL;6\n")
    load_dropped_files(house, spec, str(drop), progress)
    (drop / "2.csv").write_text(head + "31.12.2017;1;34;9\n")
    load_dropped_files(house, spec, str(drop), progress)
    load_dropped_files(house, spec, str(drop), progress)
    assert rows(house.store.read(S.BALANCE)) == sorted(
        [
            (day("2017-12-31"), 1, 34, money(9)),
            (day("2017-12-31"), 2, None, money(6)),
        ],
        key=str,
    )
    states = rows(house.audit.latest(), "input_rows", "inserted_rows", "updated_rows")
    assert states == [(1, 0, 1), (2, 2, 0)]


def test_bad_files_are_set_aside(house, tmp_path):
    """Of four files one is undecodable and one has a torn row: the stream ends, the
    others are loaded, and a repetition changes nothing."""
    drop, progress = tmp_path / "drop", str(tmp_path / "progress")
    drop.mkdir()
    head = "ON_DATE;ACCOUNT_RK;CURRENCY_RK;BALANCE_OUT\n"
    spec = IngestSpec(S.BALANCE, DOTTED_DATE)
    (drop / "1.csv").write_text(head + "31.12.2017;1;34;5\n")
    (drop / "2.csv").write_bytes((head + "31.12.2017;2;34;шесть\n31.12.2017;7;34;6\n").encode("cp1251"))
    (drop / "3.csv").write_text(head + "31.12.2017;3;34;7\n")
    (drop / "4.csv").write_text(head + "31.12.2017;4;34;7\n31.12.2017;5\n")
    kept = [(day("2017-12-31"), 1, 34, money(5)), (day("2017-12-31"), 3, 34, money(7))]

    def state():
        aside = house.store.read(bad_files_table(spec))
        return rows(house.store.read(S.BALANCE)), sorted((r.file.split("/")[-1], r.reason, r.rows) for r in aside.collect())

    load_dropped_files(house, spec, str(drop), progress)
    bad = [("2.csv", "1 undecodable rows", 2), ("4.csv", "1 rows with a wrong number of fields", 2)]
    assert state() == (kept, bad)
    failed = [r.message for r in house.audit.latest().filter("status = 'FAILED'").collect()]
    assert len(failed) == 2 and all("2.csv" in m or "4.csv" in m for m in failed)
    # The batch again, as after a lost checkpoint.
    load_dropped_files(house, spec, str(drop), str(tmp_path / "again"))
    assert state() == (kept, bad)
    assert house.audit.latest().filter("status = 'FAILED'").count() == 2


def test_undecodable_file_is_not_loaded(house, tmp_path):
    path = tmp_path / "a.csv"
    path.write_bytes("CURRENCY_CD;CURRENCY_NAME\n1;Рубль\n".encode("cp1251"))
    spec = IngestSpec(S.CURRENCY_NAME, "yyyy-MM-dd", style=Delimited(encodings=("UTF-8",)))
    with pytest.raises(EncodingError):
        house.load_file(spec, str(path))
    assert house.store.read(S.CURRENCY_NAME).count() == 0
    assert [r.status for r in house.audit.latest().collect()] == ["FAILED"]


def test_long_failure_text_is_kept_whole(house):
    text = "x" * 5000
    with pytest.raises(ValueError), house.audit.run("job", "t"):
        raise ValueError(text)
    assert house.audit.latest().first().message == text


def test_message_covers_all_rejects(house, tmp_path):
    lines = [f"{k};2018-01-01;;999;XXX" for k in range(100, 150)]
    path = tmp_path / "c.csv"
    head = "CURRENCY_RK;DATA_ACTUAL_DATE;DATA_ACTUAL_END_DATE;CURRENCY_CODE;CODE_ISO_CHAR"
    path.write_text("\n".join([head, *lines]) + "\n")
    stats = house.load_file(detail_specs(POSTING_DATES)[3], str(path))
    assert stats.message.startswith("50: ") and "currency_rk: 149" in stats.message


def test_malformed_import_leaves_the_table(house, tmp_path, frame):
    house.store.rewrite(S.CURRENCY_NAME, frame(S.CURRENCY_NAME, [("1", "a")]))
    path = tmp_path / "bad.csv"
    path.write_text("currency_cd;currency_name\n1;b;c\n")
    with pytest.raises(Exception, match="malformed"):
        house.import_csv(S.CURRENCY_NAME, str(path), truncate_first=True)
    assert rows(house.store.read(S.CURRENCY_NAME)) == [("1", "a")]


def test_marts_of_a_period_have_their_rows_together_by_date(house):
    """Not a file of every task for every date."""
    spark, (first, last) = house.spark, (day("2018-01-01"), day("2018-01-05"))
    house.store.rewrite(
        S.ACCOUNT,
        spark.range(400).selectExpr(
            "DATE'2018-01-01' AS data_actual_date", "DATE'2018-12-31' AS data_actual_end_date",
            "id AS account_rk", "lpad(id, 20, '3') AS account_number", "'А' AS char_type",
            "34L AS currency_rk", "'810' AS currency_code",
        ),
    )
    house.store.rewrite(
        S.POSTING,
        spark.range(2000).selectExpr(
            "date_add(DATE'2018-01-01', CAST(id % 5 AS INT)) AS oper_date",
            "id % 400 AS credit_account_rk", "(id + 7) % 400 AS debet_account_rk",
            "CAST(1 AS DECIMAL(23,8)) AS credit_amount", "CAST(1 AS DECIMAL(23,8)) AS debet_amount",
        ),
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        house.fill_turnover(first, last)
        house.fill_balances(first, last)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert house.store.read(S.DAILY_BALANCE).count() == 5 * 400
    for mart in (S.TURNOVER, S.DAILY_BALANCE):
        for date in house.store.dates(mart):
            place = f"{house.store.folder(mart)}/{mart.partition_by}={date.isoformat()}"
            assert len([n for n in house.store._children(place) if n.endswith(".parquet")]) == 1


def test_files_of_a_day_are_loaded_at_the_same_time(house, folder, monkeypatch):
    all_there = threading.Barrier(6)
    load = house.load_file

    def meet(spec, path):
        all_there.wait(30)
        return load(spec, path)

    monkeypatch.setattr(house, "load_file", meet)
    stats = house.load_detail(str(folder), POSTING_DATES)
    assert list(stats) == [s.table.name for s in detail_specs(POSTING_DATES)]
    assert stats["md_currency_d"].skipped == 2
    # No event of the six is lost.
    assert house.audit.events().count() == 12
    assert {r.status for r in house.audit.latest().collect()} == {"SUCCESS"}


def test_first_failure_in_table_order_is_raised_when_all_files_have_ended(house, folder):
    (folder / "ft_posting_f.csv").write_text("OPER_DATE\n09-01-2018\n")
    (folder / "md_currency_d.csv").write_text("CURRENCY_RK\n1\n")
    with pytest.raises(LookupError, match="ft_posting_f"):
        house.load_detail(str(folder), POSTING_DATES)
    states = {r.table_name: r.status for r in house.audit.latest().collect()}
    assert states.pop("ft_posting_f") == states.pop("md_currency_d") == "FAILED"
    assert set(states.values()) == {"SUCCESS"} and len(states) == 4


def test_rejects_are_the_same_for_few_and_for_many_doubtful_keys(house, monkeypatch):
    spec = detail_specs(POSTING_DATES)[3]
    text = house.spark.createDataFrame(
        [
            ("1", "2018-01-01", "2050-12-31", "840", "USD"),
            ("1", "2018-01-01", "2050-12-31", "978", "EUR"),
            ("2", "2018-01-01", None, "0", "NON"),
            (None, "2018-01-01", None, "840", "USD"),
            ("3", "2018-01-01", None, "840", "USD"),
            ("3", "2018-01-01", None, "840", "USD"),
        ],
        ", ".join(f"{c} string" for c in S.CURRENCY.columns),
    )
    found = []
    for most in (jobs.FEW_KEYS, 0):
        monkeypatch.setattr(jobs, "FEW_KEYS", most)
        house.store.truncate(S.CURRENCY)
        house.store.truncate(reject_table(spec))
        stats = house.load_rows(spec, text)
        found.append((stats, rows(house.store.read(reject_table(spec)).select("line"))))
        # Rejected: a version of key 1, key 2, no key. The second row of key 3 equals the first.
        assert (stats.input, stats.inserted, len(found[-1][1])) == (6, 2, 3)
    assert found[0] == found[1]
    # All keys that may have rejected rows were stored first.
    held = S.TableSpec("work", "md_currency_d_keys", S.T.StructType([S.CURRENCY.schema[c] for c in S.CURRENCY.key]))
    assert sorted(r[0] for r in house.store.read(held).collect()) == [1, 2, 3]
