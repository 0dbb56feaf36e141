"""Metrics of analysis runs as a long table: run, kind, metric name, value, tags."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paceline.operators.prep import numeric_columns

KINDS = ("clustering", "anomaly", "changepoint", "pipeline")


def run_metrics(metrics: DataFrame, run_id: str, kind: str, tags: Mapping[str, str] | None = None) -> DataFrame:
    """Numeric columns of a metrics table as (run_id, kind, name, value, tags) rows; ``run_id`` is a column."""
    if kind not in KINDS:
        raise ValueError(f"unknown run kind {kind!r}")
    pairs = F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("double").alias("value"))
                      for c in numeric_columns(metrics) if c != run_id])
    labels = F.create_map(*[F.lit(x) for kv in (tags or {}).items() for x in kv]) if tags else \
        F.create_map().cast("map<string,string>")
    return (metrics.select(F.col(run_id).cast("string").alias("run_id"), F.lit(kind).alias("kind"), F.explode(pairs).alias("_p"),
                           labels.alias("tags")).select("run_id", "kind", "_p.name", "_p.value", "tags")
            .where(F.col("value").isNotNull()))


def append(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").partitionBy("kind").parquet(path)


def compare_runs(log: DataFrame, names: Sequence[str], max_runs: int = 10) -> DataFrame:
    """One row per run with the chosen metrics as columns, the latest runs (by id) first."""
    wide = log.groupBy("run_id").agg(*[F.max(F.when(F.col("name") == n, F.col("value"))).alias(n) for n in names])
    return wide.orderBy(F.col("run_id").desc()).limit(max_runs)


def best_run(log: DataFrame, name: str, ascending: bool = False) -> DataFrame:
    """The run with the highest (or lowest) value of a metric."""
    pick = F.min_by if ascending else F.max_by
    place = F.struct(F.col("value"), F.col("run_id"))
    row = log.where(F.col("name") == name).agg(pick(F.struct("run_id", "value"), place).alias("_b"))
    return row.where(F.col("_b").isNotNull()).select("_b.run_id", F.col("_b.value").alias(name))
