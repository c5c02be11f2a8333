"""Whitening of embeddings along their main components, by Chebyshev-filtered subspace iteration.

Vectors enter as whole numbers, so counts and sums are exact.  The covariance is
never formed: a pass over the distinct vectors multiplies it with a narrow block,
and only that block, as wide as a vector and a few columns, comes to the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from gablework.session import stage

#: Components returned, and further columns of the block that speed up the filter.
COMPONENTS, GUARDS = 4, 20
#: Columns of the block drawn anew in each round: they would find a component missed so far.
PROBES = 2
#: Passes of a filter, and rounds after which an uncertified block is doubled.
DEGREE, PATIENCE = 12, 8
#: Vectors in a block of the staged table.
BLOCK = 4096
#: Whole steps to a unit of a vector's entry.
STEPS = 256
#: Share of the greatest eigenvalue below which a component counts as absent.
ABSENT = 1e-12


def usable(vector: str) -> Column:
    """Neither null nor empty, and every component a finite number."""
    finite = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))))
    return F.col(vector).isNotNull() & (F.size(vector) > 0) & finite


def whole(vector: str) -> Column:
    return F.transform(vector, lambda c: F.floor(F.lit(float(STEPS)) * c.cast("double")).cast("bigint"))


def _rows_by_length(lists: pa.ListArray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, matrix) of the rows of each length in a column of lists."""
    ends = lists.offsets.to_numpy()
    starts, lengths = ends[:-1], np.diff(ends)
    flat = lists.values.to_numpy(zero_copy_only=False)
    for d in np.unique(lengths).tolist():
        rows = np.flatnonzero(lengths == d)
        yield rows, flat[starts[rows][:, None] + np.arange(d)]


def _exact_sums(block: np.ndarray) -> list[Decimal]:
    """Column sums of 64-bit numbers, in two halves that cannot overflow."""
    high, low = (block >> 26).sum(axis=0), (block & ((1 << 26) - 1)).sum(axis=0)
    return [Decimal((int(h) << 26) + int(l)) for h, l in zip(high, low)]


def distinct_blocks(rows: DataFrame, vector: str) -> DataFrame:
    """(d, n, block, sums): the distinct whole-number vectors, some thousand to a row, with exact sums."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[int, list[np.ndarray]] = {}

        def out(d: int) -> pa.RecordBatch:
            block = np.concatenate(waiting.pop(d)).astype("<i8")
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([d], pa.int32()),
                    pa.array([len(block)], pa.int64()),
                    pa.array([block.tobytes()], pa.binary()),
                    pa.array([_exact_sums(block)], pa.list_(pa.decimal128(38, 0))),
                ],
                names=["d", "n", "block", "sums"],
            )

        for batch in batches:
            for _, matrix in _rows_by_length(batch.column(0)):
                d = matrix.shape[1]
                waiting.setdefault(d, []).append(matrix)
                if sum(map(len, waiting[d])) >= BLOCK:
                    yield out(d)
        for d in list(waiting):
            yield out(d)

    distinct = rows.where(usable(vector)).select(whole(vector).alias("x")).distinct()
    return distinct.mapInArrow(task, "d int, n bigint, block binary, sums array<decimal(38,0)>")


@dataclass
class Whitening:
    """Exact count and sums of the fit list, and its main components, one a column."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float
    residual: float

    @property
    def width(self) -> int:
        return len(self.sums)


class Passes:
    """Products of the fit list's covariance with a block, a pass over the staged blocks each."""

    def __init__(self, blocks: DataFrame, n: int, sums: list[int]):
        self.blocks, self.n = blocks, n
        self.d = len(sums)
        self.mean = np.array([float(Decimal(s) / n) for s in sums])
        self.made = 0

    def _summed(self, task, cells: int) -> np.ndarray:
        found = self.blocks.select("block").mapInArrow(task, "cell bigint, v double").groupBy("cell").agg(F.sum("v").alias("v"))
        rows = found.toArrow()  # as many rows as a block has entries
        out = np.zeros(cells)
        out[rows.column("cell").to_numpy()] = rows.column("v").to_numpy()
        self.made += 1
        return out

    def trace(self) -> float:
        mean, d = self.mean, self.d

        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = 0.0
            for batch in batches:
                for raw in batch.column(0):
                    x = np.frombuffer(raw.as_buffer(), dtype="<i8").reshape(-1, d) - mean
                    total += float(np.einsum("ij,ij->", x, x))
            yield pa.RecordBatch.from_arrays([pa.array([0], pa.int64()), pa.array([total])], names=["cell", "v"])

        return float(self._summed(task, 1)[0]) / self.n

    def times(self, q: np.ndarray) -> np.ndarray:
        """X'XQ / n over the centred vectors."""
        mean, d = self.mean, self.d

        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(q.shape)
            for batch in batches:
                for raw in batch.column(0):
                    x = np.frombuffer(raw.as_buffer(), dtype="<i8").reshape(-1, d) - mean
                    total += x.T @ (x @ q)
            cells = np.arange(total.size, dtype=np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(total.ravel())], names=["cell", "v"])

        return self._summed(task, q.size).reshape(q.shape) / self.n


def filtered(times, q: np.ndarray, low: float, high: float, top: float, degree: int) -> np.ndarray:
    """The scaled Chebyshev polynomial that stays small on [low, high] and grows towards ``top``."""
    half, centre = (high - low) / 2, (high + low) / 2
    scale = start = half / (top - centre)
    before, now = q, (times(q) - centre * q) * (scale / half)
    for _ in range(degree - 1):
        following = 1 / (2 / start - scale)
        before, now = now, (times(now) - centre * now) * (2 * following / half) - before * (scale * following)
        scale = following
    return now


def subspace(times, d: int, wanted: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray, float]:
    """Greatest eigenvalues, their vectors and the largest residual, of a product ``times`` with a positive operator.

    Each round filters the block, makes it orthonormal, and solves the small
    problem within it.  It ends once every wanted residual is at rounding level,
    the fresh probe columns having been filtered with the rest.  A block that is
    not certified after some rounds doubles; as wide as the space it is exact.
    """
    rng = np.random.default_rng(seed)
    wide = min(d, wanted + GUARDS)
    q = np.linalg.qr(rng.normal(size=(d, wide)))[0]
    rounds = 0
    while True:
        product = times(q)
        small = q.T @ product
        values, turn = np.linalg.eigh((small + small.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        q, product = q @ turn, product @ turn
        residual = np.linalg.norm(product - q * values, axis=0)[:wanted].max()
        done = residual <= 4 * d * np.finfo(float).eps * max(values[0], 0.0)
        if (done and rounds) or wide == d:
            return values[:wanted], q[:, :wanted], float(residual)
        rounds += 1
        if rounds % PATIENCE == 0:
            wide = min(d, 2 * wide)
            q = np.hstack([q, rng.normal(size=(d, wide - q.shape[1]))])
        else:
            q[:, wide - PROBES :] = rng.normal(size=(d, PROBES))
        top, high = float(values[0]), float(values[-1])
        if wide < d and 0 < high < top:
            q = filtered(times, np.linalg.qr(q)[0], 0.0, high, top, DEGREE)
        q = np.linalg.qr(q)[0]


def fit(rows: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> Whitening | None:
    """Main components of the distinct whole-number vectors; None without a usable vector.

    Where usable vectors differ in length, the length of most distinct vectors
    counts, of equal numbers the greater, and other rows are left out.
    """
    blocks = stage(distinct_blocks(rows, vector), "vector-blocks")
    lengths = blocks.groupBy("d").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), F.desc("d")).limit(1).collect()
    if not lengths:
        return None
    d, n = int(lengths[0]["d"]), int(lengths[0]["n"])
    blocks = blocks.where(F.col("d") == d)
    summed = blocks.select(F.posexplode("sums").alias("at", "s")).groupBy("at").agg(F.sum("s").alias("s"))
    found = {int(r["at"]): int(r["s"]) for r in summed.collect()}
    sums = [found[i] for i in range(d)]
    passes = Passes(blocks, n, sums)
    trace = passes.trace()
    if trace == 0:
        return Whitening(n, sums, np.zeros(0), np.zeros((d, 0)), 0.0, 0.0, 0.0)
    values, vectors, residual = subspace(passes.times, d, min(components, d))
    present = values > ABSENT * values[0]
    values, vectors = values[present], vectors[:, present]
    white = vectors / np.sqrt(values)
    # The covariance of the whitened fit list, from a pass of its own.
    error = np.abs(white.T @ passes.times(white) - np.eye(len(values))).max()
    return Whitening(n, sums, values, vectors, trace, float(error), residual)


def transform(rows: DataFrame, model: Whitening, vector: str = "embedding", id_column: str = "vec_id") -> DataFrame:
    """(vec_id, deviation, whitened): every usable row of the model's width on all its components.

    ``deviation`` is exact; where it exceeds a long it is null.
    """
    kind = rows.schema[id_column].dataType.simpleString()
    n, width = model.n, model.width
    exact = np.array(model.sums, dtype=object)
    most_sum = max(map(abs, model.sums))
    white = model.vectors / np.sqrt(model.values)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            most = n * int(max(abs(int(x.max())), abs(int(x.min())))) + most_sum
            if width * most * most < 1 << 62:
                moved = n * x - exact.astype(np.int64)
                deviation = (moved * moved).sum(axis=1).tolist()
            else:
                moved = n * x.astype(object) - exact
                deviation = [v if v < 1 << 63 else None for v in (moved * moved).sum(axis=1)]
            onto = (moved.astype(float) / n) @ white
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(deviation, pa.int64()), pa.array(list(onto), pa.list_(pa.float64()))],
                names=[id_column, "deviation", "whitened"],
            )

    fitting = rows.where(usable(vector) & (F.size(vector) == width)).select(id_column, whole(vector).alias("x"))
    return fitting.mapInArrow(task, f"{id_column} {kind}, deviation bigint, whitened array<double>")


SCHEMA = "component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"


def report(rows: DataFrame, vector: str = "embedding", id_column: str = "vec_id") -> DataFrame:
    """A row per usable vector and component: its whitened value and the fit's figures.

    Vectors that are null, empty, or hold null or non-finite entries give no
    rows, nor do vectors of another length than the fit list's.  Repeated rows
    and null ids come as often as they are there; copies count once in the fit.
    Components without variance (fewer distinct vectors than components) are
    left out, and a table without usable vectors gives no rows.  Equal
    eigenvalues leave the choice within their space open, the same for all rows.
    Other columns are ignored.
    """
    kind = rows.schema[id_column].dataType.simpleString()
    model = fit(rows, vector)
    if model is None or not len(model.values):
        return rows.sparkSession.createDataFrame([], f"{id_column} {kind}, {SCHEMA}")
    explained = F.array(*[F.lit(float(v / model.trace)) for v in model.values])
    placed = transform(rows, model, vector, id_column).select(id_column, "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return placed.select(
        id_column,
        (F.col("at") + 1).alias("component"),
        F.lit(model.n).cast("bigint").alias("n"),
        "deviation",
        "whitened",
        F.element_at(explained, F.col("at") + 1).alias("explained"),
        F.lit(model.identity_error).alias("identity_error"),
    )
