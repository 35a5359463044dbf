"""Connected components of links, by contraction.

Each round hooks every node to its least neighbour, follows the hooks twice and
keeps only the links between different roots, so the links shrink from round to
round. Links of a hub are combined before they are shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.work import Work
from ledgerloom.operators.lookup import spread_join


def components(work: Work, links: DataFrame) -> DataFrame:
    """``links`` (a, b) to (node, root): the least node reachable, for all nodes
    that have a link."""
    open_links = work.keep(_between(links), "links")
    roots = None
    while not open_links.isEmpty():
        both = open_links.select("a", "b").unionByName(
            open_links.select(F.col("b").alias("a"), F.col("a").alias("b"))
        )
        hooks = work.keep(
            both.groupBy("a").agg(F.min("b").alias("b")).select("a", F.least("a", "b").alias("r")), "hooks"
        )
        # Hooks lead to lesser nodes, so following them ends at a root.
        step = hooks.select(F.col("a").alias("r"), F.col("r").alias("rr"))
        jumped = work.keep(
            spread_join(hooks, step, ["r"], "inner").select("a", F.col("rr").alias("r")), "roots"
        )
        if roots is None:
            known = jumped.select(F.col("a").alias("node"), F.col("r").alias("root"))
        else:
            moved = jumped.select(F.col("a").alias("root"), "r")
            known = spread_join(roots, moved, ["root"], "left").select(
                "node", F.coalesce("r", "root").alias("root")
            )
        roots = work.keep(known, "known")
        to = jumped.select("a", F.col("r").alias("ra"))
        other = jumped.select(F.col("a").alias("b"), F.col("r").alias("rb"))
        contracted = spread_join(spread_join(open_links, to, ["a"], "inner"), other, ["b"], "inner")
        open_links = work.keep(
            _between(contracted.select(F.col("ra").alias("a"), F.col("rb").alias("b"))), "links"
        )
    if roots is None:
        return open_links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots


def _between(links: DataFrame) -> DataFrame:
    return links.filter("a <> b").select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    ).distinct()
