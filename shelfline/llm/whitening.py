"""Whitened principal components of embeddings, the eigenpairs by FEAST contour integration.

1. *Moments.* Entries become integers (``floor(SCALE * c) + SHIFT``), so that sums and, after
   taking off a whole number near the mean, cross products are exact whatever the order of
   rows and tasks. Every task adds up its own rows; partial sums meet by matrix row, never
   all in one task. The fraction of the mean that was not taken off is corrected at the end;
   it is at most a half, so nothing cancels.
2. *Intervals.* Inertia counts (signs of the pivots of a symmetric factorisation of the
   shifted covariance) say how many eigenvalues lie above a shift. Bisection by them cuts the
   top of the spectrum into intervals of a few eigenvalues.
3. *FEAST*, one Spark task an interval: Gauss-Legendre quadrature of the complex shifted
   solves on a circle around it projects a random block onto the wanted eigenvectors;
   Rayleigh-Ritz extracts them; this is repeated until residuals are at rounding and the
   number found is the inertia count. A block as wide as the matrix ends any search.
4. Rows are projected where they are, written once, and their own covariance is checked.

Only matrices of the vectors' dimension reach the driver, never rows.

Defined cases: vectors that are null or empty, or hold null or non-finite entries or entries
of ``MOST`` or more (which have no exact integer) take no part; of several lengths
the most frequent counts (the longer one of ties) and others take no part; null and repeated
ids are kept as rows; repeated vectors count as often as they occur; directions without
variance beyond rounding are no components, so a table of one vector, of equal vectors or of
none gives no row; a deviation that a long cannot hold is null; equal eigenvalues give some
orthonormal basis of their space. Further columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline.llm.common import saved

COMPONENTS = 8
SCALE, SHIFT = 1_024, 100_000
#: Entries below this in magnitude become integers that doubles hold exactly.
MOST = float(1 << 42)
EXACT = float(1 << 53)
#: Eigenvalues of one interval, and quadrature nodes on half its circle.
PER_INTERVAL, NODES = 4, 8
ROUNDS = 30


def usable(vectors: DataFrame, vector: str = "embedding", key: str = "vec_id") -> DataFrame:
    """``key`` and ``vector`` (doubles) of the rows that take part."""
    both = vectors.select(F.col(f"`{key}`").alias("key"), F.col(f"`{vector}`").cast("array<double>").alias("vector"))
    # NaN compares as greater than any number.
    return both.where("size(vector) > 0").where(F.forall("vector", lambda c: F.coalesce(F.abs(c) < MOST, F.lit(False))))


def whole(column: pa.Array, dim: int) -> np.ndarray:
    """The integers of a batch of vectors, one row each."""
    return np.floor(column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim) * SCALE).astype(np.int64) + SHIFT


def _text(numbers: np.ndarray) -> str:
    return ",".join(map(str, numbers.tolist()))


def _numbers(text: str) -> np.ndarray:
    return np.array([int(x) for x in text.split(",")], object)


def _added(parts: DataFrame) -> DataFrame:
    """Sums of ``numbers`` (comma-separated integers) and of ``n`` by ``at``, streamed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, n, total = None, 0, None
        out: list[tuple[int, int, str]] = []
        for batch in batches:
            for a, m, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if a != at:
                    if at is not None:
                        out.append((at, n, _text(total)))
                    at, n, total = a, m, _numbers(text)
                else:
                    n, total = n + m, total + _numbers(text)
        if at is not None:
            out.append((at, n, _text(total)))
        yield pa.RecordBatch.from_pydict({k: [r[i] for r in out] for i, k in enumerate(("at", "n", "numbers"))}, KINDS)

    return parts.repartition("at").sortWithinPartitions("at").mapInArrow(run, "at bigint, n bigint, numbers string")


KINDS = pa.schema([("at", pa.int64()), ("n", pa.int64()), ("numbers", pa.string())])


def column_sums(rows: DataFrame) -> tuple[int, int, list[int]]:
    """Dimension, number and exact column sums of the vectors of the most frequent length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, list] = {}
        for batch in batches:
            column = batch.column(0)
            lengths = np.diff(column.offsets.to_numpy())
            for dim in np.unique(lengths).tolist():
                x = whole(column.filter(pa.array(lengths == dim)), dim)
                own = sums.setdefault(dim, [0, np.zeros(dim, object)])
                own[0] += len(x)
                # Rows of a batch times the greatest integer stay below 2 to the 63rd.
                for start in range(0, len(x), 1_024):
                    own[1] = own[1] + x[start : start + 1_024].sum(axis=0).astype(object)
        found = sorted(sums.items())
        yield pa.RecordBatch.from_pydict(
            {"at": [d for d, _ in found], "n": [s[0] for _, s in found], "numbers": [_text(s[1]) for _, s in found]}, KINDS
        )

    parts = rows.select("vector").mapInArrow(run, "at bigint, n bigint, numbers string")
    most = _added(parts).orderBy(F.desc("n"), F.desc("at")).first()
    return (0, 0, []) if most is None else (most["at"], most["n"], _numbers(most["numbers"]).tolist())


def cross_products(block: np.ndarray) -> np.ndarray:
    """Exact integer ``block.T @ block``: in doubles while every sum stays below 2 to the 53rd."""
    big = float(np.abs(block).max(initial=0))
    if big * big >= EXACT:
        wide = block.astype(object)
        return wide.T @ wide
    step = len(block) if not big else max(1, int(EXACT / (big * big)))
    total = np.zeros((block.shape[1],) * 2, object)
    for start in range(0, len(block), max(1, step)):
        part = block[start : start + step].astype(float)
        total = total + (part.T @ part).astype(np.int64)
    return total


def covariance(rows: DataFrame, dim: int, n: int, sums: list[int]) -> np.ndarray:
    """Covariance of the integers, divisor ``n``, to double precision."""
    centre, rest = centred(n, sums)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = None, 0
        for batch in batches:
            if batch.num_rows:
                found = cross_products(whole(batch.column(0), dim) - centre)
                total, seen = found if total is None else total + found, seen + batch.num_rows
        if total is not None:
            yield pa.RecordBatch.from_pydict(
                {"at": list(range(dim)), "n": [seen] * dim, "numbers": [_text(row[i:]) for i, row in enumerate(total)]}, KINDS
            )

    parts = rows.select("vector").mapInArrow(run, "at bigint, n bigint, numbers string")
    out = np.zeros((dim, dim))
    for at, _, numbers in _added(parts).collect():
        # n * sum(y y') - r r', in integers, over n squared.
        exact = _numbers(numbers) * n - np.array([rest[at] * r for r in rest[at:]], object)
        out[at, at:] = out[at:, at] = [e / (n * n) for e in exact]
    return out


def centred(n: int, sums: list[int]) -> tuple[np.ndarray, list[int]]:
    """A whole number near each mean, and ``n`` times what it falls short of it."""
    centre = [round(s / n) if abs(s) < 1 << 52 else s // n for s in sums]
    return np.array(centre, np.int64), [s - n * c for s, c in zip(sums, centre, strict=True)]


def negatives(matrix: np.ndarray) -> int:
    """Negative eigenvalues of a symmetric matrix: signs of its pivots (Sylvester's law of inertia).

    Pivots of one or two rows are chosen by the greatest entry, so growth is bounded.
    """
    a, found = matrix.copy(), 0
    alpha = (1 + 17**0.5) / 8
    while len(a):
        diagonal = np.abs(np.diagonal(a))
        p = int(diagonal.argmax())
        off = np.abs(a)
        np.fill_diagonal(off, 0)
        q, r = np.unravel_index(int(off.argmax()), off.shape)
        if not max(diagonal[p], off[q, r]):
            break
        if diagonal[p] >= alpha * off[q, r]:
            found += int(a[p, p] < 0)
            keep = np.arange(len(a)) != p
            column = a[keep, p]
            a = a[np.ix_(keep, keep)] - np.outer(column, column / a[p, p])
        else:
            found += 1  # such a pair of rows has one eigenvalue of either sign
            keep = np.ones(len(a), bool)
            keep[[q, r]] = False
            block, columns = a[np.ix_([q, r], [q, r])], a[np.ix_(keep, [q, r])]
            a = a[np.ix_(keep, keep)] - columns @ np.linalg.solve(block, columns.T)
    return found


def above(matrix: np.ndarray, shift: float) -> int:
    """How many eigenvalues are above ``shift``."""
    return negatives(shift * np.eye(len(matrix)) - matrix)


def intervals(matrix: np.ndarray, wanted: int) -> list[tuple[float, float, int]]:
    """Intervals (low, high, number of eigenvalues) that hold the ``wanted`` greatest."""
    trace = float(np.trace(matrix))
    least = float(4 * len(matrix) * np.finfo(float).eps * trace)
    high = float(np.abs(matrix).sum(axis=1).max(initial=0)) * (1 + 1e-9)
    total = above(matrix, least) if trace > 0 else 0
    wanted = min(wanted, total)
    out, stack = [], [(least, high, total, 0)]
    while stack:
        low, top, n_low, n_top = stack.pop()
        if n_low == n_top or n_top >= wanted:
            continue
        middle = (low + top) / 2
        if n_low - n_top <= PER_INTERVAL or top - low <= 1e-12 * high or not low < middle < top:
            out.append((low, top, n_low - n_top))
            continue
        n_middle = above(matrix, middle)
        stack += [(low, middle, n_low, n_middle), (middle, top, n_middle, n_top)]
    return sorted(out, reverse=True)


def feast(matrix: np.ndarray, low: float, high: float, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` eigenvalues in ``(low, high]`` with their eigenvectors (columns)."""
    dim = len(matrix)
    norm = float(np.abs(matrix).sum(axis=1).max())
    enough = 10 * dim * np.finfo(float).eps * norm
    x, weight = np.polynomial.legendre.leggauss(NODES)
    turns = np.exp(0.5j * np.pi * (1 + x))
    middle, radius = (low + high) / 2, (high - low) / 2
    random, width = np.random.default_rng(7), min(dim, 2 * count + 4)
    block = random.standard_normal((dim, width))
    while True:
        for _ in range(ROUNDS):
            if width < dim:
                projected = np.zeros((dim, width))
                for turn, w in zip(turns, weight, strict=True):
                    solved = np.linalg.solve((middle + radius * turn) * np.eye(dim) - matrix, block)
                    projected += (0.5 * w * radius * turn * solved).real
                block = projected
            basis = np.linalg.qr(block)[0]
            values, mixed = np.linalg.eigh(basis.T @ matrix @ basis)
            block = basis @ mixed
            inside = (values > low) & (values <= high)
            residuals = np.linalg.norm(matrix @ block[:, inside] - block[:, inside] * values[inside], axis=0)
            if width == dim or (inside.sum() == count and residuals.max(initial=0) <= enough):
                top = np.argsort(values)[::-1]
                place = top[inside[top]] if inside.sum() == count else top[np.argsort(np.abs(values[top] - middle))[:count]]
                return values[place], block[:, place]
        width = min(dim, 2 * width)
        block = np.concatenate([block, random.standard_normal((dim, width - block.shape[1]))], axis=1)


def eigenpairs(spark: SparkSession, matrix: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The greatest eigenvalues, falling, and their orthonormal eigenvectors (rows)."""
    cuts = intervals(matrix, wanted)
    if not cuts:
        return np.zeros(0), np.zeros((0, len(matrix)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, count in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                vectors = feast(matrix, low, high, count)[1]
                yield pa.RecordBatch.from_arrays([pa.array(vectors.T.tolist(), pa.list_(pa.float64()))], names=["vector"])

    asked = spark.createDataFrame(cuts, "low double, high double, held long").repartition(len(cuts))
    found = np.array([r[0] for r in asked.mapInArrow(run, "vector array<double>").collect()]).T
    basis = np.linalg.qr(found)[0]
    values, mixed = np.linalg.eigh(basis.T @ matrix @ basis)
    vectors = (basis @ mixed)[:, ::-1].T[:wanted]
    if len(values) != above(matrix, min(c[0] for c in cuts)):
        raise ArithmeticError("the intervals do not hold what the inertia counts say")
    signs = np.sign(vectors[np.arange(len(vectors)), np.abs(vectors).argmax(axis=1)])
    return values[::-1][:wanted], vectors * signs[:, None]


@dataclass(frozen=True)
class Whitening:
    """What was fitted: exact moments, eigenvalues (falling), eigenvectors (rows), trace."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float


def fit(vectors: DataFrame, components: int = COMPONENTS, vector: str = "embedding", key: str = "vec_id") -> Whitening:
    rows = usable(vectors, vector, key)
    dim, n, sums = column_sums(rows)
    if not n:
        return Whitening(0, [], np.zeros(0), np.zeros((0, 0)), 0.0)
    matrix = covariance(rows.where(F.size("vector") == dim), dim, n, sums)
    values, found = eigenpairs(vectors.sparkSession, matrix, components)
    return Whitening(n, sums, values, found, float(np.trace(matrix)))


def deviations(x: np.ndarray, centre: np.ndarray, n: int, rest: list[int]) -> list[int | None]:
    """Exact ``sum((n * x - S) ** 2)`` of every row, from ``x`` less ``centre``."""
    y = x - centre
    big = (int(np.abs(y).max(initial=0)) + 1) * n
    if y.shape[1] * big * big < 1 << 63:
        away = n * y - np.array(rest, np.int64)
        return (away * away).sum(axis=1).tolist()
    # Whole numbers of any size, column by column.
    totals = np.zeros(len(y), object)
    for column, r in zip(y.T, rest, strict=True):
        away = column.astype(object) * n - r
        totals = totals + away * away
    return [t if t < 1 << 63 else None for t in totals.tolist()]


def transform(vectors: DataFrame, model: Whitening, vector: str = "embedding", key: str = "vec_id") -> DataFrame:
    """``key``, ``deviation`` and ``whitened`` (an array, one entry a component) of the rows that take part."""
    rows = usable(vectors, vector, key).where(F.size("vector") == len(model.sums))
    doubles = T.ArrayType(T.DoubleType())
    schema = T.StructType([rows.schema["key"], T.StructField("deviation", T.LongType()), T.StructField("whitened", doubles)])
    n, dim = model.n, len(model.sums)
    centre, rest = centred(n, model.sums) if n else (np.zeros(0, np.int64), [])
    fraction = np.array([r / n for r in rest])
    scaled = (model.vectors / np.sqrt(model.values)[:, None]).T if len(model.values) else np.zeros((dim, 0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = whole(batch.column(1), dim)
            white = ((x - centre) - fraction) @ scaled
            away = pa.array(deviations(x, centre, n, rest), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), away, pa.array(white.tolist(), pa.list_(pa.float64()))], names=schema.names)

    return rows.mapInArrow(run, schema).withColumnRenamed("key", key)


def identity_error(whitened: DataFrame, components: int) -> float | None:
    """Largest entry of the covariance of ``whitened`` less the identity, in magnitude."""
    entry = lambda i: F.col("whitened")[i]
    pairs = [(i, j) for i in range(components) for j in range(i, components)]
    sums = whitened.agg(
        F.count("*").alias("n"),
        *[F.sum(entry(i)).alias(f"s{i}") for i in range(components)],
        *[F.sum(entry(i) * entry(j)).alias(f"p{i}_{j}") for i, j in pairs],
    ).first()
    n = sums["n"]
    if not n or not components:
        return None
    return max(abs(sums[f"p{i}_{j}"] / n - sums[f"s{i}"] / n * sums[f"s{j}"] / n - (i == j)) for i, j in pairs)


def report(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """One row for each vector that takes part and each component."""
    model = fit(vectors, components)
    whitened = saved(transform(vectors, model), "whitened")
    error = identity_error(whitened, len(model.values))
    explained = F.array(*[F.lit(float(v / model.trace)) for v in model.values]).cast("array<double>")
    return whitened.select("vec_id", F.posexplode("whitened").alias("at", "whitened"), "deviation").select(
        "vec_id",
        (F.col("at") + 1).alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.element_at(explained, F.col("at") + 1).alias("explained") if len(model.values) else F.lit(None).cast("double").alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
    )
