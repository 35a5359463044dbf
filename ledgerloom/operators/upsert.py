"""Keyed load of staged rows into a stored table.

Rules: a target row whose key is staged with other attributes takes the staged
ones; a staged key the target lacks is inserted; the rest is skipped. When
several different staged rows share a key, the first in attribute order *that
changes something* is taken, so the result does not depend on row order.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerloom.functions.predicates import all_of, any_of, differs
from ledgerloom.operators.lookup import numbered_copies, spread_join

ACTION = "_action"
# Not staged, staged as stored, changed, new.
KEEP, SAME, UPDATE, INSERT = "keep", "same", "update", "insert"
REASON = "reject_reason"


@dataclass(frozen=True)
class LoadStats:
    """Counters of one load; ``skipped`` covers equal, repeated and bad rows."""

    input: int = 0
    inserted: int = 0
    updated: int = 0
    message: str | None = None

    @property
    def skipped(self) -> int:
        return self.input - self.inserted - self.updated


def _has_key(key: Sequence[str]) -> Column:
    return all_of(F.col(k).isNotNull() for k in key)


def _candidates(
    stage: DataFrame, key: Sequence[str], attributes: Sequence[str]
) -> DataFrame:
    """One row per staged key with its two first different attribute sets.

    Two are enough: a target row can equal at most one of them. Both steps
    shrink a hot key before the shuffle: ``distinct`` combines on the map side,
    and the ``row_number`` limit is applied per task ahead of the exchange.
    """
    by_key = W.partitionBy(*key).orderBy(
        *[F.col(a).asc_nulls_first() for a in attributes]
    )
    values = F.struct(*attributes)
    return (
        stage.select(*key, *attributes)
        .distinct()
        .withColumn("_rank", F.row_number().over(by_key))
        .filter(F.col("_rank") <= 2)
        .select(
            *key, "_rank", values.alias("_first"), F.lead(values).over(by_key).alias("_second")
        )
        .filter(F.col("_rank") == 1)
        .drop("_rank")
    )


def merge_rows(
    target: DataFrame,
    stage: DataFrame,
    key: Sequence[str],
    attributes: Sequence[str],
    valid: Column | None = None,
) -> DataFrame:
    """The table after the load, each row marked in ``_action``.

    One full outer join on the key: target and stage are each read and shuffled
    once. A target kept by date is given by its staged dates only.
    """
    attributes = list(attributes)
    staged = _candidates(_usable(stage, key, valid), key, attributes)
    stored = F.col("_stored").isNotNull()
    return (
        target.withColumn("_stored", F.lit(True))
        .join(staged, list(key), "full_outer")
        .withColumn(
            "_new", F.when(stored, _change(attributes)).otherwise(F.col("_first"))
        )
        .withColumn(
            ACTION,
            F.when(~stored, F.lit(INSERT)).otherwise(_stored_action()),
        )
        .select(*_taking_new(target.columns, attributes), ACTION)
    )


def _change(attributes: Sequence[str]) -> Column:
    """The first staged attributes that differ from the stored ones, or NULL."""
    same = all_of(F.col(a).eqNullSafe(F.col(f"_first.{a}")) for a in attributes)
    return F.when(same, F.col("_second")).otherwise(F.col("_first"))


def _stored_action() -> Column:
    return (
        F.when(F.col("_new").isNotNull(), F.lit(UPDATE))
        .when(F.col("_first").isNotNull(), F.lit(SAME))
        .otherwise(F.lit(KEEP))
    )


def _taking_new(columns: Sequence[str], attributes: Sequence[str]) -> list[Column]:
    return [
        F.when(F.col("_new").isNotNull(), F.col(f"_new.{c}"))
        .otherwise(F.col(c))
        .alias(c)
        if c in attributes
        else F.col(c)
        for c in columns
    ]


def _usable(stage: DataFrame, key: Sequence[str], valid: Column | None) -> DataFrame:
    usable = stage.filter(_has_key(key))
    return usable if valid is None else usable.filter(valid)


def merge_rows_by_probing(
    target: DataFrame,
    stage: DataFrame,
    key: Sequence[str],
    attributes: Sequence[str],
    valid: Column | None = None,
) -> DataFrame:
    """``merge_rows`` in a form for a target that should not be shuffled.

    The left join and the semi join have the staged keys on the right, where the
    planner broadcasts them if their size allows. New keys are those not among
    the target keys found. It reads both sides more often than ``merge_rows``,
    so it is for the caller to ask for; no job chooses it.
    """
    key, attributes = list(key), list(attributes)
    staged = _candidates(_usable(stage, key, valid), key, attributes)
    matched = (
        target.join(staged, key, "left")
        .withColumn("_new", _change(attributes))
        .withColumn(ACTION, _stored_action())
        .select(*_taking_new(target.columns, attributes), ACTION)
    )
    found = target.select(*key).join(staged.select(*key), key, "left_semi")
    added = staged.join(found, key, "left_anti").select(
        *[
            F.col(f.name)
            if f.name in key
            else F.col(f"_first.{f.name}").alias(f.name)
            if f.name in attributes
            else F.lit(None).cast(f.dataType).alias(f.name)
            for f in target.schema
        ],
        F.lit(INSERT).alias(ACTION),
    )
    return matched.unionByName(added)


def snapshot(merged: DataFrame) -> DataFrame:
    return merged.drop(ACTION)


def action_counts() -> list[Column]:
    """Aggregates for an ``Observation`` on a merged frame while it is written."""
    return [
        F.count_if(F.col(ACTION) == INSERT).alias("inserted"),
        F.count_if(F.col(ACTION) == UPDATE).alias("updated"),
        F.count_if(F.col(ACTION) == SAME).alias("same"),
    ]


def load_counters(merged: DataFrame, stage: DataFrame) -> DataFrame:
    """The four counters as one row."""
    total = stage.agg(F.count(F.lit(1))).scalar()
    return (
        merged.agg(*action_counts())
        .withColumn("input", total)
        .select(
            F.col("input").alias("input_count"),
            F.col("inserted").alias("inserted_count"),
            F.col("updated").alias("updated_count"),
            (F.col("input") - F.col("inserted") - F.col("updated")).alias(
                "skipped_count"
            ),
        )
    )


_SPREAD = "_spread"


def _without_match(key: Sequence[str], others: Sequence[str]) -> Column:
    """A second join key: rows without a key match nothing and are dealt out by
    their other columns, so they do not meet in one task."""
    return F.when(_has_key(key), F.xxhash64(*key)).otherwise(F.xxhash64(*others))


def _compared(
    stage: DataFrame, stored: DataFrame, key: list[str], attributes: list[str], valid: Column | None
) -> DataFrame:
    """Staged rows that differ from ``stored`` (key, _stored) or are not there."""
    found = F.col("_stored").isNotNull()
    changed = any_of(differs(F.col(a), F.col(f"_stored.{a}")) for a in attributes)
    refused = F.lit(False) if valid is None else ~valid
    left = stage.withColumn(_SPREAD, _without_match(key, stage.columns))
    right = stored.withColumn(_SPREAD, F.xxhash64(*key))
    return (
        left.join(right, [*key, _SPREAD], "left")
        .filter(~found | changed)
        .select(
            *stage.columns,
            F.when(~_has_key(key), "null_key")
            .when(refused, "invalid")
            .when(~found, "missing")
            .otherwise("other_version")
            .alias(REASON),
        )
    )


def rejected_rows(
    loaded: DataFrame,
    stage: DataFrame,
    key: Sequence[str],
    attributes: Sequence[str],
    valid: Column | None = None,
) -> DataFrame:
    """Every staged row the loaded table lacks or holds with other attributes."""
    key, attributes = list(key), list(attributes)
    stored = loaded.select(*key, F.struct(*attributes).alias("_stored"))
    return _compared(stage, stored, key, attributes, valid)


def rejects_of_load(
    target: DataFrame,
    stage: DataFrame,
    key: Sequence[str],
    attributes: Sequence[str],
    valid: Column | None = None,
) -> DataFrame:
    """``rejected_rows`` of a load that need not have run: no merged table.

    What a staged key holds after the load follows from its stored row and its
    two first valid versions. So the target is read once and the stage twice:
    for the versions by key, and to be compared with the outcome.
    """
    key, attributes = list(key), list(attributes)
    refused = F.lit(False) if valid is None else ~valid
    ok = stage.filter(_has_key(key)).select(*key, *attributes, (~refused).alias("_ok"))
    by_key = W.partitionBy(*key).orderBy(
        F.col("_ok").desc(), *[F.col(a).asc_nulls_first() for a in attributes]
    )
    version = F.when(F.col("_ok"), F.struct(*attributes))
    staged = (
        ok.distinct()
        .withColumn("_rank", F.row_number().over(by_key))
        .filter(F.col("_rank") <= 2)
        .select(*key, "_rank", version.alias("_first"), F.lead(version).over(by_key).alias("_second"))
        .filter(F.col("_rank") == 1)
    )
    held = target.select(*key, F.struct(*attributes).alias("_held"))
    same = F.col("_held").eqNullSafe(F.col("_first"))
    taken = F.when(same, F.col("_second")).otherwise(F.col("_first"))
    outcome = spread_join(staged, held, key, "left").select(
        *key, F.coalesce(taken, F.col("_held")).alias("_stored")
    )
    return _compared(stage, outcome, key, attributes, valid)


def repeated_or_invalid(
    stage: DataFrame, key: Sequence[str], valid: Column | None = None
) -> DataFrame:
    """The staged keys with several rows or an invalid one.

    All keys of ``contested_rows`` are among them. Counts alone tell, without
    comparing (and sorting) the attributes.
    """
    refused = F.lit(False) if valid is None else ~valid
    return (
        stage.filter(_has_key(key))
        .groupBy(*key)
        .agg(F.count(F.lit(1)).alias("_rows"), F.max(refused).alias("_refused"))
        .filter((F.col("_rows") > 1) | F.col("_refused"))
        .select(*key)
    )


def contested_rows(
    stage: DataFrame,
    key: Sequence[str],
    attributes: Sequence[str],
    valid: Column | None = None,
    keys: DataFrame | None = None,
) -> DataFrame:
    """The staged rows that a load of this stage can possibly reject.

    A key staged with a single version, all valid, ends up stored as staged. So
    only rows without a key, and rows whose key has several versions or an
    invalid one, need comparing with the loaded table; usually they are few.
    ``keys`` may give the keys in question, or more of them, from before.
    """
    key, version = list(key), F.struct(*attributes)
    refused = F.lit(False) if valid is None else ~valid
    if keys is None:
        keys = (
            stage.filter(_has_key(key))
            .groupBy(*key)
            .agg(
                (F.min(version) != F.max(version)).alias("_several"),
                F.max(refused).alias("_refused"),
            )
            .filter(F.col("_several") | F.col("_refused"))
            .select(*key)
        )
    keyed = spread_join(stage, keys, key, "left_semi").select(*stage.columns)
    return keyed.unionByName(stage.filter(~_has_key(key)))


def unmatched_rows(stage: DataFrame, stored: DataFrame) -> DataFrame:
    """Staged rows without an equal stored row, column by column.

    Plain equality on purpose: a NULL never matches, so rows holding one are
    reported even when they were stored. Complete rows are counted per content
    together with the stored ones; copies shrink to one row before the shuffle,
    and those not stored are written out as often as they were staged.
    """
    every = stage.columns
    incomplete = any_of(F.col(c).isNull() for c in every)
    staged = stage.filter(~incomplete).select(
        *every, F.lit(1).alias("_one"), F.lit(False).alias("_held")
    )
    held = stored.select(*every).filter(~incomplete).select(
        "*", F.lit(0).alias("_one"), F.lit(True).alias("_held")
    )
    missing = (
        staged.unionByName(held)
        .groupBy(*every)
        .agg(F.sum("_one").alias("_rows"), F.max("_held").alias("_held"))
        .filter(~F.col("_held"))
    )
    return (
        numbered_copies(missing, "_rows", every)
        .select(*every)
        .unionByName(stage.filter(incomplete))
    )


def unmatched_after_replace(stage: DataFrame) -> DataFrame:
    """``unmatched_rows`` against the distinct rows of the same stage.

    A complete row always finds itself there, so only rows with a NULL are left:
    a filter says the same as the self join, without any shuffle.
    """
    return stage.filter(any_of(F.col(c).isNull() for c in stage.columns))


def replace_with_distinct(stage: DataFrame) -> DataFrame:
    """New content of a keyless table: the distinct staged rows."""
    return stage.distinct()


def append_distinct(stored: DataFrame, extra: DataFrame) -> DataFrame:
    """Stored rows as they are plus the distinct rows of a newer file."""
    return stored.unionByName(extra.select(*stored.columns).distinct())


def update_from(
    target: DataFrame, changes: DataFrame, key: Sequence[str], columns: Sequence[str]
) -> DataFrame:
    """Overwrite ``columns`` where ``changes`` has the key with other values.

    ``changes`` must hold one row per key.
    """
    values = changes.select(*key, F.struct(*columns).alias("_new"))
    differ = F.col("_new").isNotNull() & any_of(
        differs(F.col(c), F.col(f"_new.{c}")) for c in columns
    )
    return spread_join(target, values, key, "left").select(
        *[
            F.when(differ, F.col(f"_new.{c}")).otherwise(F.col(c)).alias(c)
            if c in columns
            else F.col(c)
            for c in target.columns
        ]
    )
