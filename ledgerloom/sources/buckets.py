"""Keyed tables stored by hash of their business key, so that a load touches the
buckets it has news for and no others.

``data/generation=G/_bucket=B`` holds the rows that load G wrote for bucket B.
A manifest lists the segments (bucket, generation) that make up the table, each
with its number of rows and a bitmap of its keys: one bit of 32,768 for each key's
second hash. A key whose bit is in no segment of its bucket is new for certain.

A load reads the manifest and asks for each staged key's bit. Buckets without a
hit take their new keys as one more segment and are not read. Buckets with a hit
are read and merged; those in which something changes are replaced by one new
segment, the others keep their files. The new manifest becomes current only when
Spark marks it complete, so a load that dies leaves the table as it was, and what
it wrote is removed by the next one. A bucket of ``MOST_SEGMENTS`` segments is
merged in full by the next load that has a row for it.

On the driver are only numbers of buckets and generations. Choose ``count`` so that
a bucket has some ten thousand keys at most: with more, nearly every bit is set,
and the load reads buckets it might have left alone.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from typing import TYPE_CHECKING, Any

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions.predicates import all_of
from ledgerloom.operators import upsert as U
from ledgerloom.schemas import TableSpec

if TYPE_CHECKING:
    from ledgerloom.sources.tables import TableStore

BUCKET, BITS = "_bucket", 1 << 15
MOST_SEGMENTS = 4
_MANIFEST = "bucket int, generation long, rows long, marks binary"
_CHANGED = "changed"


@dataclass(frozen=True)
class BucketLoad:
    """What a load did: its counters, and the buckets it read and wrote."""

    counts: dict[str, Any]
    read: tuple[int, ...]
    written: tuple[int, ...]
    touched: tuple[int, ...]


class BucketedTable:
    """One table of a store, kept in ``count`` buckets."""

    def __init__(self, store: TableStore, spec: TableSpec, count: int):
        if not spec.key or spec.partition_by:
            raise ValueError(f"{spec.name} has no key or is stored by date")
        self.store, self.spec, self.count = store, spec, count
        self.spark, self.folder = store.spark, f"{store.folder(spec)}/buckets"
        self.schema = spec.schema

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.spec.key), F.lit(self.count)).cast("int")

    def _bit(self) -> Column:
        return F.pmod(F.xxhash64(F.lit("mark"), *self.spec.key), F.lit(BITS))

    # --- manifest ----------------------------------------------------------

    def _versions(self) -> list[int]:
        """Complete manifests, oldest first."""
        found = [n for n in self.store._children(f"{self.folder}/manifest") if n.startswith("version=")]
        numbers = sorted(int(n.split("=")[1]) for n in found)
        return [n for n in numbers if "_SUCCESS" in self.store._children(f"{self.folder}/manifest/version={n}")]

    def exists(self) -> bool:
        return bool(self._versions())

    def manifest(self, version: int | None = None) -> DataFrame:
        versions = self._versions()
        if not versions:
            return self.spark.createDataFrame([], _MANIFEST)
        at = version or versions[-1]
        return self.spark.read.schema(_MANIFEST).parquet(f"{self.folder}/manifest/version={at}")

    def segments(self, version: int | None = None) -> list[tuple[int, int]]:
        """(bucket, generation) of the table: ``count`` times ``MOST_SEGMENTS`` at most."""
        found = self.manifest(version).filter("rows > 0").select("bucket", "generation").collect()
        return sorted(tuple(r) for r in found)

    def _place(self, bucket: int, generation: int) -> str:
        return f"{self.folder}/data/generation={generation}/{BUCKET}={bucket}"

    def _rows(self, segments: Sequence[tuple[int, int]]) -> DataFrame:
        if not segments:
            return self.spark.createDataFrame([], self.schema)
        places = [self._place(*s) for s in segments]
        return self.spark.read.schema(self.schema).parquet(*places).select(*self.spec.columns)

    def read(self, buckets: Sequence[int] | None = None) -> DataFrame:
        """The table, or only the files of some of its buckets."""
        wanted = None if buckets is None else set(buckets)
        return self._rows([s for s in self.segments() if wanted is None or s[0] in wanted])

    # --- writing -----------------------------------------------------------

    def _write(self, rows: DataFrame, measures: Sequence[Column], drop: Sequence[str] = ()) -> tuple[int, dict[str, Any]]:
        """A new generation of files, and what was measured while writing it."""
        numbers = [int(n.split("=")[1]) for n in self.store._children(f"{self.folder}/data") if "=" in n]
        generation, watch = max(numbers, default=0) + 1, Observation()
        (
            # Measured after the exchange: an empty one would take the measures along.
            rows.hint("rebalance", BUCKET)
            .observe(watch, F.count(F.lit(1)).alias("rows"), *measures)
            .drop(*drop)
            .select(*self.spec.columns, BUCKET)
            .write.partitionBy(BUCKET)
            .parquet(f"{self.folder}/data/generation={generation}")
        )
        return generation, dict(watch.get)

    def _summary(self, generation: int, buckets: Sequence[int]) -> DataFrame:
        """Rows and key bits of the buckets a generation has written."""
        where = f"{self.folder}/data/generation={generation}"
        schema = T.StructType([f for f in self.schema if f.name in self.spec.key]).add(BUCKET, T.IntegerType())
        keys = self.spark.read.schema(schema).option("basePath", where).parquet(
            *[self._place(b, generation) for b in buckets]
        )
        return keys.groupBy(F.col(BUCKET).alias("bucket")).agg(
            F.lit(generation).cast("long").alias("generation"),
            F.count(F.lit(1)).alias("rows"),
            F.bitmap_construct_agg(self._bit()).alias("marks"),
        )

    def _commit(self, manifest: DataFrame) -> None:
        done = self._versions()
        every = [n for n in self.store._children(f"{self.folder}/manifest") if n.startswith("version=")]
        number = max((int(n.split("=")[1]) for n in every), default=0) + 1
        manifest.write.parquet(f"{self.folder}/manifest/version={number}")
        kept = [*done, number][-self.store.keep_versions:]
        for name in every:
            if int(name.split("=")[1]) not in kept:
                self.store._remove(f"{self.folder}/manifest/{name}")
        self._sweep(kept)

    def _sweep(self, versions: Sequence[int]) -> None:
        """Remove segments that no kept manifest names."""
        used = {s for v in versions for s in self.segments(v)}
        for name in self.store._children(f"{self.folder}/data"):
            generation = int(name.split("=")[1])
            for child in self.store._children(f"{self.folder}/data/{name}"):
                if child.startswith(f"{BUCKET}=") and (int(child.split("=")[1]), generation) not in used:
                    self.store._remove(f"{self.folder}/data/{name}/{child}")
            if not any(g == generation for _, g in used):
                self.store._remove(f"{self.folder}/data/{name}")

    def _found(self, generation: int) -> list[int]:
        children = self.store._children(f"{self.folder}/data/generation={generation}")
        return sorted(int(c.split("=")[1]) for c in children if c.startswith(f"{BUCKET}="))

    def rewrite(self, df: DataFrame, measures: Sequence[Column] = (), drop: Sequence[str] = ()) -> dict[str, Any]:
        """Replace the whole table; ``measures`` as in ``TableStore.rewrite``."""
        generation, seen = self._write(df.withColumn(BUCKET, self._bucket()), measures, drop)
        written = self._found(generation)
        empty = self.spark.createDataFrame([], _MANIFEST)
        self._commit(self._summary(generation, written) if written else empty)
        return seen

    def append(self, df: DataFrame, measures: Sequence[Column] = ()) -> dict[str, Any]:
        """Add rows as further segments, without looking at keys."""
        old = self.manifest()
        generation, seen = self._write(df.withColumn(BUCKET, self._bucket()), measures)
        if written := self._found(generation):
            self._commit(old.unionByName(self._summary(generation, written)))
        return seen

    def _probe(self, stage: DataFrame) -> tuple[list[int], list[int]]:
        """The buckets of the staged keys, and those of them to be read."""
        asked = stage.filter(all_of(F.col(k).isNotNull() for k in self.spec.key)).select(
            self._bucket().alias("bucket"), self._bit().alias("bit")
        ).distinct()
        byte = F.conv(F.hex(F.substring("marks", (F.col("bit") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        is_set = F.expr("shiftright(_byte, CAST(bit % 8 AS INT)) & 1") == 1
        held = self.manifest().select("bucket", "marks", F.lit(1).alias("_one"))
        seen = asked.join(held, "bucket", "left").withColumn("_byte", byte)
        # A row for each bucket.
        known = seen.groupBy("bucket").agg(F.max(F.coalesce(is_set, F.lit(False))).alias("hit")).collect()
        many: dict[int, int] = {}
        for bucket, _ in self.segments():
            many[bucket] = many.get(bucket, 0) + 1
        touched = sorted(r["bucket"] for r in known)
        return touched, sorted(r["bucket"] for r in known if r["hit"] or many.get(r["bucket"], 0) >= MOST_SEGMENTS)

    def merge(
        self, stage: DataFrame, attributes: Sequence[str], valid: Column | None = None, measures: Sequence[Column] = ()
    ) -> BucketLoad:
        """Keyed load by the rule of ``upsert.merge_rows``."""
        spec, old = self.spec, self.manifest()
        touched, read = self._probe(stage)
        changed = F.when(F.col(U.ACTION).isin(U.INSERT, U.UPDATE), F.col(BUCKET))
        merged = U.merge_rows(self.read(read), stage, spec.key, list(attributes), valid).withColumn(BUCKET, self._bucket())
        # At most one number a bucket.
        wanted = [F.collect_set(changed).alias(_CHANGED), *U.action_counts(), *measures]
        generation, seen = self._write(merged, wanted, [U.ACTION])
        written = sorted(seen.pop(_CHANGED))
        if written:
            replaced = [b for b in written if b in set(read)]
            stay = old.filter(~F.col("bucket").isin(replaced)) if replaced else old
            self._commit(stay.unionByName(self._summary(generation, written)))
        else:
            self._sweep(self._versions()[-self.store.keep_versions:])
        return BucketLoad(seen, tuple(read), tuple(written), tuple(touched))
