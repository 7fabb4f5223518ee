"""z-scores with moments fitted on one table and applied to another."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fit_moments(df: DataFrame, names) -> dict[str, tuple[float, float]]:
    """name -> (mean, population standard deviation; 1 for a constant column). One row comes back."""
    row = df.agg(*[F.avg(n).alias(f"m_{n}") for n in names],
                 *[F.stddev_pop(n).alias(f"s_{n}") for n in names]).first()
    return {n: (row[f"m_{n}"], row[f"s_{n}"] or 1.0) for n in names}


def standardise(df: DataFrame, moments: dict[str, tuple[float, float]]) -> DataFrame:
    """Replace each named column by its z-score."""
    return df.withColumns({n: (F.col(n) - F.lit(m)) / F.lit(s) for n, (m, s) in moments.items()})
