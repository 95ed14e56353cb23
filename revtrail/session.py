"""Session construction and lineage cutting.

On a cluster the session is built by the caller (``spark-submit``); the
helpers here only read its settings.  ``get_spark`` exists for tests, the
bench and the command line, and pins the settings our results depend on
(UTC session time zone, AQE on, UI off).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CHECKPOINT_KEY = "spark.checkpoint.dir"


def get_spark(cpus: int | str | None = None, shuffle_partitions: int | None = None,
              app: str = "revtrail") -> SparkSession:
    cpus = cpus or os.environ.get("BENCH_CPUS") or "*"
    parts = shuffle_partitions or (int(cpus) * 2 if str(cpus).isdigit() else 16)
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("REVTRAIL_DRIVER_MEMORY", "16g"))
        .config("spark.sql.autoBroadcastJoinThreshold", str(32 * 1024 * 1024))
        # many queries with long plans: don't keep their texts
        .config("spark.sql.ui.retainedExecutions", "5")
        .config("spark.sql.maxPlanStringLength", "10000")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Settings every job needs regardless of who built the session."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    ship_package()
    ensure_checkpoint_dir(spark)
    return spark


def ship_package() -> None:
    """Pickle this package's functions by value, so Python workers run the
    Arrow UDFs without the package being installed on the executors."""
    import revtrail
    from pyspark import cloudpickle
    try:
        cloudpickle.register_pickle_by_value(revtrail)
    except ValueError:  # already registered
        pass


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's shared ``spark.checkpoint.dir``; a local session
    without it gets a scratch folder, a cluster without it is an error (its
    executors would each write to their own disk)."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get(DEFAULT_CHECKPOINT_KEY, None) or sc.getConf().get(
        DEFAULT_CHECKPOINT_KEY, None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError(f"set {DEFAULT_CHECKPOINT_KEY} to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="revtrail-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def path_exists(spark: SparkSession, path: str) -> bool:
    """Is there a file or folder at ``path`` (on any store Spark reaches)?
    Storage errors are raised, not taken for absence."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of what is in a folder (none if there is no folder)."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def fingerprint(spark: SparkSession, path: str) -> str:
    """Names, sizes and times of the files in a folder and the folders in it."""
    import hashlib
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    rows = []
    for s in fs.listStatus(p) if fs.exists(p) else []:
        inner = fs.listStatus(s.getPath()) if s.isDirectory() else [s]
        rows += [f"{x.getPath()} {x.getLen()} {x.getModificationTime()}" for x in inner]
    return hashlib.sha1("\n".join(sorted(rows)).encode()).hexdigest()


def dealt(df: DataFrame, *by: str) -> DataFrame:
    """Rows dealt by columns to as many tasks as the session shuffles to.  For
    steps that take long for the bytes they read: merged by size to about
    one task per core, they end with a few tasks while other cores wait."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *by)


#: While a table is written: Spark removes the shuffles of an execution that has ended, not when the driver
#: happens to collect garbage; and a join's side that is read from a file is taken for ten times the file.  As
#: zstd Parquet it is a tenth of what it takes on the driver as a broadcast (10 MB made 100 MB).
WHILE_WRITING = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.sources.fileCompressionFactor": "10.0"}


def cut_lineage(df: DataFrame) -> DataFrame:
    """The rows written as Parquet below the shared checkpoint folder and read
    back (survives the loss of an executor, unlike a local checkpoint).  Against
    a checkpoint, which holds whole rows uncompressed, a reader takes the columns
    it needs, and the size is known when a join is planned.  What was shuffled
    to make them is removed with the write: nothing else reads it."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/cut-{uuid.uuid4().hex}"
    before = {k: spark.conf.get(k, None) for k in WHILE_WRITING}
    for k, v in WHILE_WRITING.items():
        spark.conf.set(k, v)
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    made = spark.read.schema(df.schema).parquet(path)
    made.cut_path = path
    return made


def let_go(*cuts: DataFrame) -> None:
    """Removes tables as ``cut_lineage`` returned them, once nothing reads them any more."""
    for df in cuts:
        p = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df.cut_path)
        p.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(p, True)
