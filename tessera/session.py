"""Session helpers: a local session for tests/bench and checkpoint handling."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import DataFrame, SparkSession


#: Spark's setting by which a query's shuffle files go when it ends.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def local_session(cores: int = 8, shuffle_partitions: int | None = None,
                  app: str = "tessera", driver_memory: str = "16g",
                  event_log_dir: str | None = None) -> SparkSession:
    """Local session with AQE on and the web UI off (tests and bench only)."""
    b = (SparkSession.builder.master(f"local[{cores}]").appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cores))
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.driver.memory", driver_memory)
         .config("spark.sql.execution.arrow.pyspark.enabled", "true")
         .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true"))
    if event_log_dir:
        b = (b.config("spark.eventLog.enabled", "true")
             .config("spark.eventLog.dir", event_log_dir))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names.

    ``spark.checkpoint.dir`` (or an earlier ``setCheckpointDir``) wins.  Only a
    local-mode session without one gets a private folder under /tmp, as in
    tests; on a cluster a missing setting is an error, because a machine-local
    folder would not survive the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if conf:
        sc.setCheckpointDir(conf)
        return sc.getCheckpointDir() or conf
    if re.match(r"local(\[|$)", sc.master):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="tessera-ckpt-", dir="/tmp"))
        return sc.getCheckpointDir()
    raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for written tables."""
    import uuid
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, **options) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    Cuts lineage like a checkpoint, and the optimizer knows the table's real
    size, so joins with it are planned by that.  The table goes with
    :func:`drop_written` or when the session ends; ``options`` are the writer's.
    The shuffle files of the write go at its end, not whenever the driver collects garbage.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.options(**options).parquet(path)
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    out = spark.read.schema(df.schema).parquet(path)
    out._written_path = path
    return out


def drop_written(*frames: DataFrame) -> None:
    """Delete tables made by :func:`written` that no later step reads."""
    for df in frames:
        sc = df.sparkSession.sparkContext
        path = sc._jvm.org.apache.hadoop.fs.Path(df._written_path)
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared folder (never a local checkpoint)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def ship_package(spark: SparkSession) -> None:
    """Make ``tessera`` importable in Python workers (once per SparkContext).

    Functions shipped to tasks (pandas UDFs, map/reduce user code) are pickled
    by reference, so workers must import the package; this zips it and hands it
    to ``addPyFile``, which serves it to every executor -- the same thing
    ``spark-submit --py-files`` does.
    """
    import os
    import zipfile
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: the package is deployed with the client
        return
    if getattr(sc, "_tessera_shipped", False):
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    fd, path = tempfile.mkstemp(prefix="tessera-", suffix=".zip")
    os.close(fd)
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    sc.addPyFile(path)
    sc._tessera_shipped = True
