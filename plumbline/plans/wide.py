"""Leading principal components of very wide vectors, without a matrix of columns by columns anywhere.

The vectors' covariance is only ever multiplied with a few columns: a pass multiplies every block of rows with them and back
and adds up the products, columns by few. The columns of all passes together span the space in which the components are
sought; each pass widens it by the products of the last, made orthonormal, until the components' residuals are small.
The driver holds some columns of the vectors' length for each pass.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.plans.sums import add_up

#: Columns of a pass beyond the components asked for, and passes after which the search ends in any case.
SPARE, MOST_PASSES = 12, 24


@dataclass
class WideComponents:
    """Means and deviations of the components, unit loadings (one column each), and their shares of all variance."""

    centre: np.ndarray
    scale: np.ndarray
    loadings: np.ndarray
    ratios: np.ndarray
    passes: int


def _blocks(batches: Iterator, width: int) -> Iterator[np.ndarray]:
    for frame in batches:
        table = np.array(frame["v"].tolist(), dtype=float)
        if len(table):
            yield table.reshape(-1, width)


def wide_components(df: DataFrame, vector: str, count: int, tolerance: float = 1e-9, seed: int = 5) -> WideComponents:
    """The ``count`` leading components of the standardized elements of an array column. Rows whose array is null, of
    another length than the longest, or holds a null or NaN are left out; without rows this is an error. Signs: the
    largest loading is positive."""
    width = df.agg(F.max(F.size(vector))).first()[0] or 0
    rows = df.select(F.col(vector).cast("array<double>").alias("v")).where(
        (F.size("v") == width) & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x)))
    first = rows.first() if width > 0 else None
    if first is None:
        raise ValueError("no complete vectors")
    tasks, shift = rows.rdd.getNumPartitions(), np.array(first["v"], dtype=float)

    def moments(batches: Iterator) -> dict[int, np.ndarray]:
        out = np.zeros((3, width))
        for x in _blocks(batches, width):
            off = x - shift
            out += off.sum(axis=0), (off * off).sum(axis=0), np.full(width, float(len(x)))
        return {0: out.ravel()}

    total, square, n = add_up(rows, tasks, moments, 3 * width)[0].reshape(3, width)
    mean = total / n
    variance = np.maximum(square / n - mean ** 2, 0.0)
    moving = variance > 1e-13 * (square / n)
    centre, scale = shift + mean, np.where(moving, np.sqrt(variance), 1.0)

    def times(columns: np.ndarray) -> np.ndarray:
        """Correlations, never made, times these columns; a constant element counts as zero."""
        def measure(batches: Iterator) -> dict[int, np.ndarray]:
            out = np.zeros(columns.shape)
            for x in _blocks(batches, width):
                z = (x - centre) / scale * moving
                out += z.T @ (z @ columns)
            return {0: out.ravel()}

        return add_up(rows, tasks, measure, columns.size)[0].reshape(columns.shape) / n[0]

    many = min(width, count + SPARE)
    basis, image = np.zeros((width, 0)), np.zeros((width, 0))
    new = np.linalg.qr(np.random.default_rng(seed).normal(size=(width, many)))[0]
    for passes in range(1, MOST_PASSES + 1):
        product = times(new)
        basis, image = np.hstack([basis, new]), np.hstack([image, product])
        values, turns = np.linalg.eigh((basis.T @ image + image.T @ basis) / 2)
        values, turns = values[::-1][:count], turns[:, ::-1][:, :count]
        loadings = basis @ turns
        miss = np.linalg.norm(image @ turns - loadings * values, axis=0)
        # the products, less what the basis spans already, twice against rounding
        new = product
        for _ in range(2):
            new = new - basis @ (basis.T @ new)
        left, sizes, _ = np.linalg.svd(new, full_matrices=False)
        new = left[:, sizes > 1e-10 * max(values.max(initial=0.0), 1e-300)][:, :width - basis.shape[1]]
        if (miss <= tolerance * max(values.max(initial=0.0), 1e-300)).all() or not new.shape[1]:
            break
    loadings = loadings * np.where(loadings[np.abs(loadings).argmax(axis=0), np.arange(loadings.shape[1])] < 0, -1.0, 1.0)
    return WideComponents(centre, scale, loadings, np.maximum(values, 0) / max(1, moving.sum()), passes)


def wide_scores(df: DataFrame, vector: str, found: WideComponents, name: str = "scores") -> DataFrame:
    """Adds the array of component scores; null where the vector is no complete one."""
    width = len(found.centre)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column(batch.schema.get_field_index(vector)).to_pylist()
            out = [None if v is None or len(v) != width or any(x is None or x != x for x in v)
                   else (((np.array(v, dtype=float) - found.centre) / found.scale) @ found.loadings).tolist() for v in vectors]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.list_(pa.float64()))], [*batch.schema.names, name])

    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema], f"`{name}` array<double>"])
    return df.mapInArrow(project, schema)
