from decimal import Decimal

import pytest
from conftest import day, money

from ledgerloom import schemas as S
from ledgerloom.plans.ledger_report import ledger_report

D = Decimal


def account(rk, prefix, kind, code, start="2018-01-01", end="2018-01-31"):
    return (day(start), day(end) if end else None, rk, prefix + "0" * 15, kind, 1, code)


@pytest.fixture
def inputs(frame):
    accounts = frame(
        S.ACCOUNT,
        [
            account(1, "30102", "А", "810"),
            account(2, "30102", "А", "840"),
            account(3, "30102", "А", "643"),
            account(4, "30109", "П", "840"),
            account(5, "30110", "А", "810", "2018-02-01", None),
            account(6, "30110", "А", "810", "2017-01-01", "2017-12-31"),
        ],
    )
    ledger = frame(S.LEDGER_ACCOUNT, [("А", 30102), ("Б", 30109)], ["chapter", "ledger_account"])
    balances = frame(
        S.DAILY_BALANCE,
        [
            (day("2017-12-31"), 1, D(1), D(10)),
            (day("2017-12-31"), 2, D(1), D(20)),
            (day("2018-01-30"), 1, D(1), D(999)),
            (day("2018-01-31"), 1, D(1), D(11)),
            (day("2018-01-31"), 3, None, None),
        ],
    )
    turnover = frame(
        S.TURNOVER,
        [
            (day("2018-01-01"), 1, D(1), D(2), D(3), D(4)),
            (day("2018-01-31"), 1, D(1), D(2), D(3), D(4)),
            (day("2018-02-01"), 1, D(1), D(200), D(3), D(400)),
        ],
    )
    return accounts, ledger, balances, turnover


def test_measures_and_null_rules(inputs):
    got = {r.ledger_account: r for r in ledger_report(*inputs, day("2018-02-01")).collect()}
    assert set(got) == {"30102", "30109"}
    a, p = got["30102"], got["30109"]
    assert (a.from_date, a.to_date, a.chapter, a.characteristic) == (
        day("2018-01-01"),
        day("2018-01-31"),
        "А",
        "А",
    )
    assert (a.balance_in_rub, a.balance_in_val, a.balance_in_total) == tuple(map(money, (10, 20, 30)))
    assert (a.turn_deb_rub, a.turn_deb_val, a.turn_deb_total) == tuple(map(money, (8, 0, 8)))
    assert (a.turn_cre_rub, a.turn_cre_val, a.turn_cre_total) == tuple(map(money, (4, 0, 4)))
    assert (a.balance_out_rub, a.balance_out_val, a.balance_out_total) == tuple(map(money, (11, 0, 11)))
    # No account in the class: 0. All accounts of the class without a row: NULL.
    assert (p.balance_in_rub, p.balance_in_val, p.balance_in_total) == (money(0), None, None)
    assert all(a[f"r_{m}"] is None for m in S.REPORT_MEASURES)


def test_month_is_clamped_at_its_end(inputs):
    r = ledger_report(*inputs, day("2018-03-31"), allow_unmapped=True).first()
    assert (r.from_date, r.to_date) == (day("2018-02-28"), day("2018-03-30"))


def test_unmapped_accounts(inputs, frame):
    accounts, ledger, *rest = inputs
    more = accounts.union(frame(S.ACCOUNT, [account(7, "3010X", "А", "810"), account(8, "40817", "П", "810")]))
    with pytest.raises(Exception, match="no ledger account"):
        ledger_report(more, ledger, *rest, day("2018-02-01")).collect()
    got = ledger_report(more, ledger, *rest, day("2018-02-01"), allow_unmapped=True).collect()
    assert {r.ledger_account for r in got if r.chapter is None} == {"3010X", "40817"}
