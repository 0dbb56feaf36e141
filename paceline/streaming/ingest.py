"""Incremental ingest of landed race files with Structured Streaming."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from paceline.sources.tables import write_table


def land_stream(spark: SparkSession, path: str, schema: StructType | str, files_per_batch: int = 1000) -> DataFrame:
    """A stream of the Parquet files under ``path``; every file is seen once, new ones in the next run."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def ingest(source: DataFrame, target: str, checkpoint: str, keys: Sequence[str], partition_by: Sequence[str] = ("year", "round"),
           normalize: Callable[[DataFrame], DataFrame] | None = None) -> StreamingQuery:
    """Append the rows whose key is new since the first run with this ``checkpoint``, then stop.

    The keys seen so far live in the stream's state store, spread over the shuffle partitions, so the
    cost of a batch follows the batch and not the target, and a row delivered twice changes nothing,
    in the same run or in a later one. Of the rows with one key, one is kept. The file sink lists the
    files of a batch in its log when the batch is complete: a batch that is replayed after a failure
    replaces the lost attempt, and readers of ``target`` see whole batches only. ``normalize`` works
    row by row. NULL is a key value like any other. The target belongs to its checkpoint.
    """
    rows = (normalize(source) if normalize else source).dropDuplicates(list(keys))
    return (rows.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint)
            .partitionBy(*partition_by).outputMode("append").trigger(availableNow=True).start())


def process_races(tables: dict[str, DataFrame], races: Sequence[tuple[int, int]] | None, steps: dict[str, Callable[[DataFrame], DataFrame]],
                  target: str) -> dict[str, str]:
    """Normalise and write several landed tables for many races at once; returns the written paths.

    The list of races becomes a filter on the partition columns, so other races are not even read.
    """
    written = {}
    for name, df in tables.items():
        if races is not None:
            wanted = F.struct("year", "round").isin([F.struct(F.lit(y).alias("year"), F.lit(r).alias("round")) for y, r in races])
            df = df.where(F.col("year").isin(sorted({y for y, _ in races})) & wanted)
        path = f"{target}/{name}"
        write_table(steps[name](df) if name in steps else df, path)
        written[name] = path
    return written
