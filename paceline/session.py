"""Session settings, and the one place that writes intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = 8, app: str = "paceline") -> SparkSession:
    """A session for tests and benches; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


#: Folder used where the session names none; only for sessions whose executors run in this process.
_FALLBACK: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder for intermediate tables: the cluster's ``spark.checkpoint.dir``.

    Where the session names none, a local-mode session (tests, a laptop) gets one fresh folder per
    application. On a cluster a machine-local folder would lose data, so the missing setting is an
    error there.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    master = spark.conf.get("spark.master", "")
    if not (master == "local" or master.startswith("local[")):
        raise ValueError("spark.checkpoint.dir is not set; it must name a folder that the driver and all executors share")
    app = spark.conf.get("spark.app.id", "")
    if app not in _FALLBACK:
        _FALLBACK[app] = tempfile.mkdtemp(prefix="spark-paceline-")
    return _FALLBACK[app]


def path_exists(spark: SparkSession, path: str) -> bool:
    """True for an existing, non-empty folder or file on whatever file system the path names."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(p) and len(fs.listStatus(p)) > 0


#: Spark deletes the shuffle files of a query when it ends, not when the driver collects garbage.
_TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    This cuts the lineage: a lost executor re-reads files instead of recomputing the history, and
    plans built on the result start from a columnar scan.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(_TIDY, None)
    spark.conf.set(_TIDY, "true")  # the shuffle files of a table that is written serve nothing else
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(_TIDY) if before is None else spark.conf.set(_TIDY, before)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Empty a table that :func:`stage` wrote and nothing reads any more."""
    spark = df.sparkSession
    folders = {f.rsplit("/", 1)[0] for f in df.inputFiles()}
    for folder in folders:
        spark.createDataFrame([], df.schema).write.mode("overwrite").parquet(folder)
