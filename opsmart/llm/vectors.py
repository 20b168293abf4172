"""Vectors of numbers as rows of integers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map

#: Squared length from which on a vector takes no part: below it, inner products and squared distances fit a long.
LONGEST = float(2**60)


def id_and_vector(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """Only the columns an operator reads, so that others can have any name."""
    return df.select(
        F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{vector_col}`").cast("array<double>").alias("vector")
    )


def rows_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Values of a list column end to end, where each row starts in them, and which rows are null."""
    starts, ends = column.offsets.to_numpy()[:-1], column.offsets.to_numpy()[1:]
    values = column.values.slice(starts[0], ends[-1] - starts[0]) if len(column) else column.values.slice(0, 0)
    offsets = np.append(starts, ends[-1:]) - (starts[0] if len(column) else 0)
    return values.to_numpy(zero_copy_only=False), offsets, column.is_null().to_numpy(zero_copy_only=False)


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of a list column without nulls as a matrix of long integers; shorter rows are filled with zeros."""
    values, offsets, _ = rows_of(column)
    sizes = np.diff(offsets)
    if (sizes == width).all():
        return values.astype(np.int64).reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), np.int64)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    out[owner, np.arange(len(values)) - offsets[:-1][owner]] = values
    return out


def integer_vectors(
    df: DataFrame, scale: int, size: int | None = None, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """(vec_id, q): every component x as the integer floor(scale * x).

    Vectors that are null or hold a null, NaN or infinite component are left out, with ``size`` also those of another
    number of components, and those with a squared length of 2^60 or more after scaling, since their products have
    no long. Without ``size`` an empty vector stays. Repeated rows stay; a null id stays.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            values, offsets, null = rows_of(batch.column("vector"))
            sizes = np.diff(offsets)
            owner = np.repeat(np.arange(len(sizes)), sizes)
            with np.errstate(over="ignore"):
                scaled = np.floor(values * scale)  # a null component is NaN here
            squares = np.bincount(owner, np.where(np.isfinite(scaled), np.minimum(np.abs(scaled), 2.0**40) ** 2, 2.0**80), len(sizes))
            fits = ~null & (squares < LONGEST)
            if size is not None:
                fits &= sizes == size
            whole = np.where(fits[owner], scaled, 0).astype(np.int32)[fits[owner]]
            starts = np.append(0, np.cumsum(sizes[fits]))
            kept = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(whole, pa.int32()))
            yield {"vec_id": batch.column("vec_id").filter(pa.array(fits)), "q": kept}

    return arrow_map(id_and_vector(df, id_col, vector_col), "vec_id long, q array<int>", rows)
