"""Reading embedding columns: which rows take part, and their vectors in double precision."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def usable(vectors: DataFrame, id_col: str, vector_col: str, *more: str) -> DataFrame:
    """(id, vector array<double>, ...) of the rows with an id and a finite vector that is not zero."""
    plain = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vector"), *more)
    finite = "forall(vector, x -> x is not null and not isnan(x) and abs(x) < double('Infinity'))"
    return plain.where(f"id is not null and vector is not null and {finite} and exists(vector, x -> x <> 0)")


def matrix(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, size).astype(np.float64)


def exact_cosine(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Cosine of the rows of x with the rows of y; large and small vectors are scaled first."""
    x = x / np.abs(x).max(1, keepdims=True)
    y = y / np.abs(y).max(1, keepdims=True)
    return np.einsum("ij,ij->i", x, y) / np.sqrt(np.einsum("ij,ij->i", x, x) * np.einsum("ij,ij->i", y, y))


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]
