"""Registered queries: a name, the Spark job, and the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Job = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Job] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Job], Job]:
    def register(job: Job) -> Job:
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = job
        if sql is not None:
            ORACLES[name] = sql
        return job
    return register


def rounded(df: DataFrame, *exact: str, digits: int = 6) -> DataFrame:
    """Round every double column so that two engines can be compared value by value."""
    return df.select(*[F.round(c, digits).alias(c) if t == "double" and c not in exact else F.col(c)
                       for c, t in df.dtypes])
