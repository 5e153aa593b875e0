"""Helpers for operators on vectors: which rows take part, and matrices of Arrow lists."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MOST = 2.0**40  # entries beyond are no fixed-point numbers: products of two would not fit


def finite(vector: str) -> Column:
    """Whether a vector is there and all its components are; false for null."""
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(MOST)))
    return F.col(vector).isNotNull() & F.coalesce(good, F.lit(False))


def fixed_point(vector: str, scale: int, offset: int) -> Column:
    """floor(scale * x) + offset of every component, as whole numbers."""
    return F.transform(
        F.col(vector).cast("array<double>"),
        lambda x: F.floor(x * F.lit(float(scale))).cast("long") + F.lit(offset).cast("long"),
    )


def widest(rows: DataFrame, vector: str) -> int:
    """The number of components of the longest vector."""
    return rows.agg(F.max(F.size(vector))).first()[0] or 0


def matrix(column: pa.Array, width: int, fill: int = 0) -> np.ndarray:
    """Lists of whole numbers as rows of a matrix; short ones end in ``fill``."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False)
    lengths = pc.list_value_length(column).to_numpy(zero_copy_only=False)
    if len(values) == len(column) * width:
        return values.reshape(len(column), width)
    out = np.full((len(column), width), fill, np.int64)
    row = np.repeat(np.arange(len(column)), lengths)
    place = np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out[row, place] = values
    return out
