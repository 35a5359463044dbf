"""Embedding whitening on the exact spectrum of the vectors' integer scatter.

1. Entries c become integers x = floor(1024 * c) + 100000. Tasks add up x and the
   products of its entries exactly, in floating point matrix products small
   enough to be exact; the sums of all tasks meet row by row of the matrix.
2. The characteristic polynomial of n * sum(x x') - S S', which is n * n times the
   covariance, modulo one prime a Spark row; Chinese remaindering; the largest
   roots by exact bisection; and their null spaces, again a Spark row each (see
   ``spectrum``).
3. Vectors are centred exactly, projected in Arrow batches and scaled.

What reaches the driver depends on the number of dimensions only.

Defined cases: rows whose vector is NULL or has a NULL or non-finite entry are
left out. If lengths differ, the vectors are those of the most frequent length
(of equally frequent ones the greatest), others belong to another space and are
left out. floor(1024 * c) ends at +-2**62. Rows with the same id, or without one,
are vectors of their own. A component needs a positive eigenvalue, so there are
as many as the covariance has rank, up to the number asked: none for a single
vector, and then no row. Eigenvectors of a repeated eigenvalue are some
orthonormal basis of its space. A deviation beyond 64 bits is NULL in
``deviation`` and exact in ``deviation_exact`` up to 38 digits, beyond them NULL.
Other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass
from fractions import Fraction
from functools import reduce
from math import gcd, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm import spectrum
from ledgerloom.llm.work import Work, shuffle_partitions

COMPONENTS = 8
SHIFT, SCALE = 100_000, 1024
#: Whole numbers below 2**20 in products of this many rows are exact doubles.
EXACT_ROWS, EXACT_BITS = 4096, 20
LIMBS, LIMB_BITS = 6, 40


@dataclass
class Spectrum:
    """Number and sums of the vectors, and unit eigenvectors by falling eigenvalue."""

    n: int
    sums: list[int]
    vectors: np.ndarray
    values: list[Fraction]
    explained: list[float]


def usable(embeddings: DataFrame) -> DataFrame:
    """Rows (vec_id, embedding) with finite vectors of one length."""
    bad = F.exists("embedding", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    rows = embeddings.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    rows = rows.filter(F.col("embedding").isNotNull() & ~bad & (F.size("embedding") > 0))
    # At most one row leaves this query.
    size = F.size("embedding")
    common = rows.groupBy(size.alias("size")).count().orderBy(F.desc("count"), F.desc("size")).limit(1).collect()
    return rows.filter(size == (common[0][0] if common else 0))


def _whole(column) -> np.ndarray:
    """floor(1024 * c) of a list column as a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    y = np.floor(SCALE * flat)
    return np.clip(y, -(2.0**62), 2.0**62).astype(np.int64).reshape(len(column), -1)


def _slices(y: np.ndarray):
    step = max(1, min(EXACT_ROWS, (1 << 22) // max(1, y.shape[1])))
    for i in range(0, len(y), step):
        yield y[i: i + step]


def _limbs(values: np.ndarray) -> np.ndarray:
    """Integers as signed sums of limb * 2**(40 * place)."""
    out, rest = np.zeros((*values.shape, LIMBS), np.int64), values.astype(object)
    for place in range(LIMBS - 1):
        out[..., place] = (rest & ((1 << LIMB_BITS) - 1)).astype(np.int64)
        rest = rest >> LIMB_BITS
    out[..., LIMBS - 1] = rest.astype(np.int64)
    return out


def _scatter(batches):
    """Exact sums of products; row i of the matrix, then the sums, then the count."""
    total = sums = None
    rows = adds = 0
    small = None
    for batch in batches:
        if not batch.num_rows:
            continue
        for y in _slices(_whole(batch.column("embedding"))):
            d = y.shape[1]
            if total is None:
                total, sums, small = np.zeros((d, d), object), np.zeros(d, object), np.zeros((d, d), np.int64)
            rows += len(y)
            high, low = y >> 31, y & ((1 << 31) - 1)
            sums += high.sum(axis=0).astype(object) * (1 << 31) + low.sum(axis=0).astype(object)
            if np.abs(y).max() < 1 << EXACT_BITS:
                part = y.astype(np.float64)
                small += (part.T @ part).astype(np.int64)
                adds += 1
                if adds == 512:
                    total, adds = total + small, 0
                    small[:] = 0
                continue
            parts, rest = [], y
            while len(parts) < 3:
                parts.append((rest & ((1 << EXACT_BITS) - 1)).astype(np.float64))
                rest = rest >> EXACT_BITS
            parts.append(rest.astype(np.float64))
            for i, a in enumerate(parts):
                for j, b in enumerate(parts):
                    total += (a.T @ b).astype(np.int64).astype(object) << (EXACT_BITS * (i + j))
    if total is None:
        return
    total = total + small
    lines = [*total, sums, np.array([rows], object)]
    yield pa.RecordBatch.from_arrays(
        [pa.array(range(len(lines)), pa.int32()), pa.array([_limbs(x).tobytes() for x in lines], pa.binary())],
        ["line", "limbs"],
    )


def _added(batches):
    lines: dict[int, np.ndarray] = {}
    for batch in batches:
        for line, limbs in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            add = np.frombuffer(limbs, np.int64)
            lines[line] = lines[line] + add if line in lines else add
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(lines), pa.int32()), pa.array([x.tobytes() for x in lines.values()], pa.binary())],
        ["line", "limbs"],
    )


def scatter(rows: DataFrame) -> tuple[int, list[int], np.ndarray] | None:
    """Number of vectors, sums, and sums of products, without the shift of x."""
    parts = shuffle_partitions(rows.sparkSession)
    schema = "line int, limbs binary"
    lines = rows.select("embedding").mapInArrow(_scatter, schema).repartition(parts, "line").mapInArrow(_added, schema)
    found = {}
    for line, limbs in lines.collect():
        given = np.frombuffer(limbs, np.int64).reshape(-1, LIMBS)
        found[line] = [sum(int(v) << (LIMB_BITS * i) for i, v in enumerate(entry)) for entry in given]
    if not found:
        return None
    d = max(found) - 1
    return found[d + 1][0], found[d], np.array([found[i] for i in range(d)], object)


def _polynomials(matrix):
    def run(batches):
        for batch in batches:
            primes = batch.column("p").to_pylist()
            # Entries are reduced as Python integers, the rest fits 64 bits.
            residues = [
                spectrum.characteristic_mod((matrix.value % p).astype(np.int64), p) for p in primes
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array(primes, pa.int64()), pa.array(residues, pa.list_(pa.int64()))], ["p", "residues"]
            )

    return run


def _null_spaces(matrix):
    def run(batches):
        for batch in batches:
            for first, place, bits, times in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                found = spectrum.null_vectors(matrix.value, int(place), bits, times)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(range(first, first + times), pa.int32()), pa.array(found.tolist(), pa.list_(pa.float64()))],
                    ["component", "vector"],
                )

    return run


def fitted(rows: DataFrame, components: int = COMPONENTS) -> Spectrum | None:
    """The largest components of the covariance of ``rows``."""
    spark = rows.sparkSession
    sums = scatter(rows)
    if sums is None:
        return None
    n, total, products = sums
    wide = np.array(total, object)  # Not 64 bits: products of sums are longer.
    centred = n * products - np.outer(wide, wide)
    trace = int(np.trace(centred))
    if not trace:
        return Spectrum(n, total, np.zeros((0, len(total))), [], [])
    factor = reduce(gcd, (int(v) for v in centred.ravel()))
    matrix, small_trace = centred // factor, trace // factor
    shared = spark.sparkContext.broadcast(matrix)
    primes = spectrum.primes_for(small_trace, len(matrix))
    parts = min(len(primes), shuffle_partitions(spark))
    given = spark.createDataFrame([(p,) for p in primes], "p long").repartition(parts)
    found = given.mapInArrow(_polynomials(shared), "p long, residues array<long>").collect()
    polynomial = spectrum.remaindered([p for p, _ in found], [list(r) for _, r in found])
    roots, bits = spectrum.largest_roots(polynomial, small_trace, components)
    firsts = np.cumsum([0, *(times for _, times in roots)]).tolist()
    asked = [(int(i), str(place), bits, times) for i, (place, times) in zip(firsts, roots, strict=False)]
    spaces = spark.createDataFrame(asked, "first int, place string, bits int, times int").repartition(len(asked))
    made = dict(spaces.mapInArrow(_null_spaces(shared), "component int, vector array<double>").collect())
    values = [spectrum.root_value(place, bits) * factor for place, times in roots for _ in range(times)][:components]
    vectors = np.array([made[i] for i in range(len(values))])
    shared.unpersist()
    return Spectrum(n, total, vectors, [v / (n * n) for v in values], [float(v / trace) for v in values])


def _centred(y: np.ndarray, model: Spectrum) -> np.ndarray:
    """n * x - S, as 64-bit integers where they fit."""
    sums = np.array(model.sums, object)
    most = model.n * int(np.abs(y).max(initial=0)) + max(abs(s) for s in model.sums)
    if most < 1 << 62:
        return model.n * y - sums.astype(np.int64)
    return model.n * y.astype(object) - sums


def _whitened(centred: np.ndarray, model: Spectrum) -> np.ndarray:
    scale = np.array([sqrt(v) for v in model.values])
    return ((centred / model.n).astype(np.float64) @ model.vectors.T) / scale


def _squares(centred: np.ndarray) -> pa.Array:
    """Exact sums of squares as decimals; NULL beyond 38 digits."""
    if centred.dtype != object and float(np.abs(centred).max(initial=0)) ** 2 * centred.shape[1] < 2**62:
        return pa.array((centred * centred).sum(axis=1)).cast(pa.decimal128(38, 0))
    if centred.dtype == object:
        exact = (centred * centred).sum(axis=1)
    else:
        parts = [centred & ((1 << 21) - 1), (centred >> 21) & ((1 << 21) - 1), centred >> 42]
        exact = np.zeros(len(centred), object)
        for i, a in enumerate(parts):
            for j, b in enumerate(parts):
                exact += (a * b).sum(axis=1).astype(object) << (21 * (i + j))
    from decimal import Context, Decimal

    wide = Context(prec=60)
    return pa.array([wide.create_decimal(int(v)) if v < 10**38 else None for v in exact], pa.decimal128(38, 0))


def _moments(model):
    """Count, means and centred products of a task's whitened rows."""

    def run(batches):
        m = len(model.value.values)
        count, mean, products = 0, np.zeros(m), np.zeros((m, m))
        for batch in batches:
            if not batch.num_rows:
                continue
            for y in _slices(_whole(batch.column("embedding"))):
                w = _whitened(_centred(y, model.value), model.value)
                own = w.mean(axis=0)
                off, both = own - mean, count + len(w)
                products += (w - own).T @ (w - own) + np.outer(off, off) * count * len(w) / both
                mean += off * len(w) / both
                count = both
        if count:
            i, j = np.triu_indices(m)
            yield pa.RecordBatch.from_arrays(
                [pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(np.full(len(i), float(count))), pa.array(mean[i]), pa.array(mean[j]), pa.array(products[i, j])],
                ["i", "j", "rows", "mi", "mj", "c"],
            )

    return run


def identity_error(work: Work, rows: DataFrame, model: Spectrum, shared) -> float:
    """Largest absolute entry of the whitened rows' covariance less the identity."""
    schema = "i int, j int, rows double, mi double, mj double, c double"
    tasks = work.keep(rows.select("embedding").mapInArrow(_moments(shared), schema), "moments")
    weighted = [F.sum(F.col("rows") * F.col(m)) / F.sum("rows") for m in ("mi", "mj")]
    means = tasks.groupBy("i", "j").agg(weighted[0].alias("all_i"), weighted[1].alias("all_j"))
    off = F.col("rows") * (F.col("mi") - F.col("all_i")) * (F.col("mj") - F.col("all_j"))
    entries = tasks.join(means, ["i", "j"]).groupBy("i", "j").agg((F.sum(F.col("c") + off) / F.sum("rows")).alias("v"))
    expected = F.when(F.col("i") == F.col("j"), 1.0).otherwise(0.0)
    return entries.agg(F.max(F.abs(F.col("v") - expected))).first()[0]


def _rows(model, error: float):
    def run(batches):
        fit = model.value
        m = len(fit.values)
        for batch in batches:
            if not batch.num_rows:
                continue
            y, at = _whole(batch.column("embedding")), 0
            for part in _slices(y):
                ids = batch.column("vec_id").slice(at, len(part))
                at += len(part)
                centred = _centred(part, fit)
                exact = _squares(centred)
                take = pa.array(np.repeat(np.arange(len(part)), m))
                fits = pa.compute.if_else(
                    pa.compute.less(exact, pa.scalar(2**63, pa.decimal128(38, 0))), exact, pa.scalar(None, pa.decimal128(38, 0))
                ).cast(pa.int64())
                rows = len(part) * m
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.take(take),
                        pa.array(np.tile(np.arange(1, m + 1, dtype=np.int32), len(part))),
                        pa.array(np.full(rows, fit.n)),
                        fits.take(take),
                        pa.array(_whitened(centred, fit).ravel()),
                        pa.array(np.tile(np.array(fit.explained), len(part))),
                        pa.array(np.full(rows, error)),
                        exact.take(take),
                    ],
                    ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error", "deviation_exact"],
                )

    return run


def whitened(embeddings: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """A row for each vector and component: vec_id, component, n, deviation,
    whitened, explained, identity_error, deviation_exact."""
    spark = embeddings.sparkSession
    work = Work(spark, "whitening")
    kind = embeddings.schema["vec_id"].dataType.simpleString()
    schema = (
        f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, "
        "identity_error double, deviation_exact decimal(38,0)"
    )
    rows = usable(embeddings)
    model = fitted(rows, components)
    if model is None or not model.values:
        return spark.createDataFrame([], schema)
    shared = spark.sparkContext.broadcast(model)
    error = identity_error(work, rows, model, shared)
    return rows.mapInArrow(_rows(shared, error), schema)


def op12_whitening(embeddings: DataFrame) -> DataFrame:
    return whitened(embeddings)
