"""Where query modules register a query with its DuckDB counterpart."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its own name; ``sql``: the same result in DuckDB."""

    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return add


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded, so that sums in another order compare equal."""
    from pyspark.sql import functions as F

    return df.select(*[F.round(c, digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])
