import datetime as dt
import random
from decimal import Decimal

import pytest
from conftest import day, money, rows

from ledgerloom import schemas as S
from ledgerloom.plans.balance import balance_for_day, balance_for_period, seed_balance

FIRST, LAST = day("2018-01-01"), day("2018-01-12")
BEFORE = FIRST - dt.timedelta(days=1)
DAYS = [FIRST + dt.timedelta(days=i) for i in range((LAST - FIRST).days + 1)]


def random_ledger(seed, accounts=120):
    """Versions with holes and open ends, unknown kinds, sparse turnover, seeds."""
    rng = random.Random(seed)
    versions, moved, seeds = [], [], []
    for rk in range(accounts):
        at = BEFORE + dt.timedelta(days=rng.randint(-3, 6))
        while at <= LAST and rng.random() < 0.8:
            end = at + dt.timedelta(days=rng.randint(0, 7))
            last = rng.random() < 0.2
            versions.append((at, None if last else end, rk, "3" * 20, rng.choice("АПАПX"), 1, "810"))
            if last:
                break
            at = end + dt.timedelta(days=rng.choice([1, 1, 2, 4]))
        for d in DAYS:
            if rng.random() < 0.25:
                credit, debet = (Decimal(rng.randint(0, 500)) for _ in range(2))
                moved.append((d, rk, credit, credit * 2, debet, debet * 3))
        if rng.random() < 0.6:
            value = Decimal(rng.randint(-100, 100)) if rng.random() < 0.9 else None
            seeds.append((BEFORE, rk, value, value))
    return versions, moved, seeds


def chained(versions, moved, seeds):
    turnover = {(m[0], m[1]): m for m in moved}
    stored = {(s[0], s[1]): s[2:] for s in seeds}
    out = []
    for d in DAYS:
        for start, end, rk, _, kind, *_ in versions:
            if not start <= d <= (end or d):
                continue
            prev = stored.get((d - dt.timedelta(days=1), rk), (None, None))
            _, _, c, cr, x, xr = turnover.get((d, rk), (0, 0, 0, 0, 0, 0))
            sign = {"А": 1, "П": -1}.get(kind)
            if sign is None:
                now = (None, None)
            else:
                now = ((prev[0] or 0) + sign * (x - c), (prev[1] or 0) + sign * (xr - cr))
            stored[d, rk] = now
            out.append((d, rk, money(now[0]), money(now[1])))
    return sorted(out, key=str)


@pytest.mark.parametrize("seed", range(3))
def test_period_equals_days_chained(frame, seed):
    versions, moved, seeds = random_ledger(seed)
    got = balance_for_period(
        frame(S.ACCOUNT, versions),
        frame(S.TURNOVER, moved),
        frame(S.DAILY_BALANCE, seeds),
        FIRST,
        LAST,
    )
    expected = chained(versions, moved, seeds)
    assert rows(got) == expected
    late = balance_for_period(
        frame(S.ACCOUNT, versions),
        frame(S.TURNOVER, moved),
        frame(S.DAILY_BALANCE, seeds),
        FIRST,
        LAST,
        shown_from=DAYS[-3],
    )
    assert rows(late) == [r for r in expected if r[0] >= DAYS[-3]]


def test_single_days_chain_to_the_period(spark, frame, store):
    versions, moved, seeds = random_ledger(9, 30)
    accounts, turnover = frame(S.ACCOUNT, versions), frame(S.TURNOVER, moved)
    balances = frame(S.DAILY_BALANCE, seeds)
    store.replace_dates(S.DAILY_BALANCE, balances, [BEFORE])
    for d in DAYS[:4]:
        one = balance_for_day(accounts, turnover, store.read(S.DAILY_BALANCE), d)
        store.replace_dates(S.DAILY_BALANCE, one, [d])
    whole = balance_for_period(accounts, turnover, balances, FIRST, DAYS[3])
    stored = store.read(S.DAILY_BALANCE).filter(f"on_date >= '{FIRST}'")
    assert rows(stored) == rows(whole)


@pytest.mark.parametrize(
    "second",
    [
        (day("2018-01-05"), None),
        (day("2018-01-01"), day("2018-01-09")),
        (day("2018-01-01"), day("2018-01-10")),
    ],
)
def test_overlapping_versions_fail(frame, second):
    versions = [
        (day("2018-01-01"), day("2018-01-10"), 1, "3" * 20, "А", 1, "810"),
        (*second, 1, "3" * 20, "А", 1, "810"),
    ]
    got = balance_for_period(
        frame(S.ACCOUNT, versions), frame(S.TURNOVER, []), frame(S.DAILY_BALANCE, []), FIRST, LAST
    )
    with pytest.raises(Exception, match="overlapping versions"):
        got.collect()


def test_seed_takes_the_rate_of_its_day(frame):
    balances = frame(
        S.BALANCE,
        [
            (BEFORE, 1, 10, Decimal("2.5")),
            (BEFORE, 2, 99, Decimal("3")),
            (FIRST, 3, 10, Decimal("7")),
        ],
    )
    rates = frame(
        S.EXCHANGE_RATE,
        [
            (BEFORE, BEFORE, 10, Decimal("60"), "840"),
            (FIRST, LAST, 10, Decimal("61"), "840"),
        ],
    )
    assert rows(seed_balance(balances, rates, BEFORE)) == [
        (BEFORE, 1, money("2.5"), money("150")),
        (BEFORE, 2, money("3"), money("3")),
    ]
