"""Reading, normalising and writing the race tables. All normalisers are stateless and also stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paceline.functions.columns import seconds
from paceline.operators.keyed import top_by
from paceline.operators.signal import distance
from paceline.sources import schemas


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN in float columns becomes NULL, so that aggregates skip it."""
    return df.select(*[F.when(~F.isnan(c), F.col(c)).alias(c) if t in ("double", "float") else F.col(c)
                       for c, t in df.dtypes])


def project_existing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The listed columns that exist, in the listed order."""
    return df.select(*[c for c in columns if c in df.columns])


_COMPARE = {"=": Column.__eq__, "!=": Column.__ne__, "<": Column.__lt__, "<=": Column.__le__, ">": Column.__gt__, ">=": Column.__ge__,
            "in": lambda c, values: c.isin(list(values))}


def read_table(spark: SparkSession, root: str, name: str, filters: Sequence[tuple[str, str, object]] = ()) -> DataFrame:
    """A landed table, partitioned by year and round (telemetry also by driver).

    ``filters`` are (column, comparison, value), all of which must hold. They stand below the mapping of
    NaN to NULL, where they prune directories and reach the scan, and once more above it, which drops
    NaN (the largest number for a scan). Comparisons are never true for NULL, so both places agree.
    """
    tests = [_COMPARE[op](F.col(c), v) for c, op, v in filters]
    df = spark.read.schema(schemas.table_schema(name)).parquet(f"{root}/{name}")
    for t in tests:
        df = df.where(t)
    df = nan_to_null(df)
    for t in tests:
        df = df.where(t)
    return df


def read_file_per_entity(spark: SparkSession, paths: str | Sequence[str], entity: str = "Driver") -> DataFrame:
    """Files named after their entity, as one table with the file stem as entity column."""
    df = spark.read.parquet(*([paths] if isinstance(paths, str) else paths))
    stem = F.regexp_extract(F.col("_metadata.file_name"), r"^(.*)\.parquet$", 1)
    return df.select("*", stem.alias(entity))


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = ("year", "round")) -> None:
    """Overwrite only the partitions present in ``df``.

    Rows are spread over tasks by partition value plus a random-free salt (a hash of the row), so one
    large partition is written by many tasks and small ones do not make a file per task.
    """
    keys = list(partition_by)
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns if c not in keys]), F.lit(8))
    (df.repartition(*keys, salt).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*keys).parquet(path))


def write_json(df: DataFrame, path: str) -> None:
    """One JSON object per line, absent fields left out."""
    df.write.mode("overwrite").json(path)


def read_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def write_artifact(df: DataFrame, filename: str, folder: str) -> str:
    """CSV or Parquet by the extension of ``filename``; anything else is an error."""
    path = f"{folder}/{filename}"
    if filename.endswith(".csv"):
        df.write.mode("overwrite").option("header", True).csv(path)
    elif filename.endswith(".parquet"):
        df.write.mode("overwrite").parquet(path)
    else:
        raise ValueError(f"unsupported format: {filename}")
    return path


def _with_seconds(df: DataFrame, names: Sequence[str]) -> DataFrame:
    types = dict(df.dtypes)
    new = [seconds(c, types[c]).alias(f"{c}_seconds") for c in names if c in types]
    return df.select("*", *new)


def normalize_laps(df: DataFrame) -> DataFrame:
    """Durations to seconds, then the critical columns that exist."""
    out = _with_seconds(df, [c for c in schemas.DURATIONS if f"{c}_seconds" not in df.columns])
    keys = [c for c in ("year", "round") if c in df.columns]
    return nan_to_null(project_existing(out, [*keys, *schemas.names(schemas.LAPS)]))


def normalize_telemetry(df: DataFrame, keys: Sequence[str] = ("year", "round", "Driver"),
                        drivers: Sequence[str] | None = None, ties: Sequence[str] = ()) -> DataFrame:
    """Selected drivers, time to seconds, distance added (``ties`` order samples of the same time), known channels."""
    out = df.where(F.col(keys[-1]).isin(list(drivers))) if drivers is not None else df
    if "Time_seconds" not in df.columns:
        out = _with_seconds(out, ["Time"])
    if "Distance" not in df.columns:
        out = distance(out, keys, ties=ties)
    return nan_to_null(project_existing(out, [*keys, *schemas.names(schemas.TELEMETRY)]))


def normalize_control(df: DataFrame) -> DataFrame:
    """Messages as they come, with time in seconds when it is a duration."""
    is_duration = dict(df.dtypes).get("Time", "").startswith("interval")
    return _with_seconds(df, ["Time"]) if is_duration and "Time_seconds" not in df.columns else df


def normalize_weather(df: DataFrame) -> DataFrame:
    out = _with_seconds(df, ["Time"]) if "Time_seconds" not in df.columns else df
    keys = [c for c in ("year", "round") if c in df.columns]
    return nan_to_null(project_existing(out, [*keys, *schemas.names(schemas.WEATHER)]))


def normalize_results(df: DataFrame) -> DataFrame:
    keys = [c for c in ("year", "round") if c in df.columns]
    return nan_to_null(project_existing(df, [*keys, *schemas.names(schemas.RESULTS)]))


def event_info(calendar: DataFrame, year: Column | str = "year") -> DataFrame:
    """One metadata row per race: year, round, name, location, country."""
    return calendar.select((F.col(year) if isinstance(year, str) else year).alias("year"),
                           F.col("RoundNumber").alias("round_number"), F.col("EventName").alias("event_name"),
                           F.col("Location").alias("location"), F.col("Country").alias("country"))


def driver_codes(df: DataFrame, results: DataFrame, part: Sequence[str], number: str = "DriverNumber",
                 code: str = "Abbreviation", out: str = "Driver") -> DataFrame:
    """Append the driver code of the number; a number without code stands for itself."""
    known = results.select(*part, F.col(number).alias(number), F.col(code).alias("_code")).distinct()
    joined = df.join(known, [*part, number], "left")
    return joined.select(*df.columns, F.coalesce("_code", F.col(number).cast("string")).alias(out))


def inventory(df: DataFrame, part: Sequence[str], entity: str, sample: int = 5) -> DataFrame:
    """Per part: rows, columns, distinct entities and the first few of them.

    Entities are reduced to one row each before they are counted or listed.
    """
    part = list(part)
    per = df.groupBy(*part, entity).agg(F.count(F.lit(1)).alias("_n"))
    counts = per.groupBy(*part).agg(F.sum("_n").alias("n_rows"), F.count(entity).alias("n_entities"))
    first = top_by(per.where(F.col(entity).isNotNull()), part, [F.col(entity).asc()], sample)
    names = first.groupBy(*part).agg(F.array_join(F.sort_array(F.collect_list(F.col(entity).cast("string"))), ", ").alias("sample"))
    return counts.join(names, part, "left").withColumn("n_columns", F.lit(len(df.columns)))


def file_inventory(df: DataFrame) -> DataFrame:
    """Per file of a table: name, bytes, rows."""
    m = F.col("_metadata")
    return (df.groupBy(m["file_name"].alias("file"), m["file_size"].alias("bytes"))
            .agg(F.count(F.lit(1)).alias("n_rows")))


def channels(df: DataFrame) -> list[str]:
    """Sensor channels a table has."""
    return [c for c in df.columns if c in ("Speed", "RPM", "Throttle", "Brake", "DRS", "Distance")]


def head(df: DataFrame, columns: Sequence[str] | None = None, n: int = 5) -> DataFrame:
    """A few rows for display."""
    return (df.select(*columns) if columns else df).limit(n)
