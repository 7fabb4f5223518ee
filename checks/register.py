"""Registration of queries: a function (spark, sf_dir) -> DataFrame, with its SQL counterpart if it has one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks.base_sql import with_inputs

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None, *ctes: str):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            SQL[fn.__name__] = with_inputs(sql, *ctes)
        return fn
    return add


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles to a fixed number of decimals, so that both engines print the same value."""
    return df.select(*[F.round(c, digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def r6(*names: str) -> str:
    return ", ".join(f"round({n}, 6) AS {n.split('.')[-1]}" for n in names)
