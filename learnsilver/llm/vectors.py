"""Helpers for columns of vectors."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(embedding: Column) -> Column:
    """Vectors that take part: not null, all components finite, not all zero."""
    finite = F.forall(
        embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    return F.coalesce(finite & F.exists(embedding, lambda x: x != 0), F.lit(False))


def matrix(column: pd.Series) -> np.ndarray:
    """Vectors of one length, as rows in double precision."""
    return np.stack(column.to_numpy()).astype(np.float64)


def usable_rows(rows: DataFrame) -> DataFrame:
    """The rows of ``rows`` that have an id and a usable vector."""
    return rows.filter(F.col("vec_id").isNotNull() & usable(F.col("embedding")))
