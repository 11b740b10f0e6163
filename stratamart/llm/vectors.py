"""What the operators on embeddings share."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from stratamart.llm.common import key_of


def usable(column: str) -> Column:
    """True for a vector that is not null or empty, has only finite components, and is not zero."""
    c = F.col(column)
    finite = F.forall(c, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(c.isNotNull() & finite & F.exists(c, lambda x: x != 0), F.lit(False))


def vectors(rows: DataFrame) -> DataFrame:
    """`_vec` (the id, a null as the largest long) and `embedding` (doubles) of every row; other columns are left out."""
    return rows.select(key_of("vec_id").alias("_vec"), F.col("embedding").cast("array<double>").alias("embedding"))


def scale_factors(column: str) -> tuple[Column, Column]:
    """Two powers of two by which a usable vector's largest component comes near 1, so that no product of two overflows or
    vanishes; two, as one may be out of range. Store them before use: a lambda would compute them once per component."""
    power = F.floor(F.log2(F.array_max(F.transform(column, F.abs))))
    half = F.floor(power / 2)
    return F.pow(F.lit(2.0), -half), F.pow(F.lit(2.0), half - power)


def matrix(column: pa.Array) -> np.ndarray:
    """A batch's vectors of one length as a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), -1) if len(column) else values.reshape(0, 0)
