"""Balances of long periods, an account's history being several tasks.

``balance_for_period`` sorts the turnover of an account in one window. Here the
history is cut into blocks of days. Windows run within (account, block); what
passes from one block to the next are its first and last point and its sums, a
row for each block, over which a second window runs per account. The rows are
exchanged once, by account and block; the carried rows are joined to them there.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.plans.balance import balance_points, balance_rows

BLOCK_DAYS = 92
_ORDER = ("v_from", "v_to", "moved_on")
_ENTRY = (*_ORDER, "known")


def balance_in_blocks(
    accounts: DataFrame,
    turnover: DataFrame,
    balances: DataFrame,
    first: dt.date,
    last: dt.date,
    shown_from: dt.date | None = None,
    block_days: int = BLOCK_DAYS,
) -> DataFrame:
    """The rows of ``balance_for_period``, by blocks of ``block_days`` days."""
    at = F.coalesce("moved_on", "v_from")
    points = balance_points(accounts, turnover, balances, first, last, spread=True).withColumn(
        "block", F.floor(F.datediff(at, F.lit(first)) / block_days).cast("int")
    )
    points = points.repartition("account_rk", "block")
    key = ["account_rk", "block"]
    order = [F.col(c).asc_nulls_first() for c in _ORDER]
    within = Window.partitionBy(*key).orderBy(*order)
    between = Window.partitionBy("account_rk").orderBy("block")

    # First pass: the neighbours of each point.
    entry, sorting = F.struct(*_ENTRY), F.struct(*_ORDER)
    ends = points.groupBy(*key).agg(F.min_by(entry, sorting).alias("head"), F.max_by(entry, sorting).alias("tail"))
    ends = ends.select(*key, F.lag("tail").over(between).alias("came"), F.lead("head").over(between).alias("comes"))
    seen = points.join(ends, key).withColumns({
        "prev": F.coalesce(F.lag(entry).over(within), F.col("came")),
        "next": F.coalesce(F.lead(entry).over(within), F.col("comes")),
    })
    neighbours = seen.select(
        *points.columns,
        *[F.col(f"prev.{c}").alias(f"prev_{n}") for c, n in (("v_from", "from"), ("v_to", "to"), ("known", "known"), ("moved_on", "moved"))],
        F.col("next.v_from").alias("next_from"),
        F.col("next.moved_on").alias("next_moved"),
    )
    return balance_rows(neighbours, first, last, shown_from, _totals)


def _totals(marked: DataFrame) -> DataFrame:
    """Second pass: running sums, and what they were at the last break."""
    key = ["account_rk", "block"]
    order = [F.col(c).asc_nulls_first() for c in _ORDER]
    so_far = Window.partitionBy(*key).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = Window.partitionBy("account_rk").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    local = marked
    for s in ("", "_rub"):
        local = local.withColumn(f"total{s}", F.sum(f"step{s}").over(so_far))
    for s in ("", "_rub"):
        at_break = F.when(F.col("breaks"), F.col(f"total{s}") - F.col(f"step{s}"))
        local = local.withColumn(f"base{s}", F.last(at_break, True).over(so_far))
    sorting = F.struct(*_ORDER)
    sums = local.groupBy(*key).agg(
        *[F.sum(f"step{s}").alias(f"sum{s}") for s in ("", "_rub")],
        *[F.max_by(f"base{s}", sorting).alias(f"last{s}") for s in ("", "_rub")],
    )
    carried = sums
    for s in ("", "_rub"):
        carried = carried.withColumn(f"earlier{s}", F.coalesce(F.sum(f"sum{s}").over(before), F.lit(0)))
    for s in ("", "_rub"):
        carried = carried.withColumn(f"held{s}", F.last(F.col(f"last{s}") + F.col(f"earlier{s}"), True).over(before))
    carried = carried.select(*key, *[f"{c}{s}" for c in ("earlier", "held") for s in ("", "_rub")])
    joined = local.join(carried, key)
    for s in ("", "_rub"):
        joined = joined.withColumns({
            f"total{s}": F.col(f"total{s}") + F.col(f"earlier{s}"),
            f"base{s}": F.coalesce(F.col(f"base{s}") + F.col(f"earlier{s}"), F.col(f"held{s}")),
        })
    return joined
