"""Session helpers.

Cluster settings (master, memory, checkpoint folder) come from the cluster's
own configuration. ``local_session`` is for tests, the bench and the smoke
entry: it sets a scratch checkpoint folder only when the session has none.
"""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: One folder per driver process, so that its tables can be removed together.
_RUN = uuid.uuid4().hex
_ROOTS: dict[str, SparkSession] = {}

_LOCAL_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  driver_memory: str = "16g", app: str = "cohortkit") -> SparkSession:
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", driver_memory))
    for k, v in _LOCAL_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's shared checkpoint folder; create a scratch one
    only for a local master that names none.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used as
    is (it is a static setting, read here, never changed). A cluster session
    without one raises: a machine-local folder there would leave each
    executor's files where the others cannot read them.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    sc = None
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect has no SparkContext
        pass
    if not path and sc is not None:
        path = sc.getCheckpointDir()
    if not path:
        if sc is None or not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="cohortkit-ckpt-")
    if sc is not None and not sc.getCheckpointDir():
        sc.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str = "table") -> str:
    """A new path under this application's folder in the shared checkpoint
    folder. The folder is removed by :func:`release` or when the driver's
    Python ends."""
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/cohortkit-{_RUN}"
    if root not in _ROOTS:
        _ROOTS[root] = spark
        atexit.register(release, spark, root)
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"


def release(spark: SparkSession, root: str | None = None) -> None:
    """Remove the tables that :func:`materialize` and ``scratch_path`` wrote.

    DataFrames that still read them fail afterwards, so call it when their
    results are written.
    """
    for path in [root] if root else list(_ROOTS):
        if _ROOTS.pop(path, None) is None:
            continue
        try:
            _delete(spark, path)
        except Exception:  # noqa: BLE001 - the context is gone: a shared folder's own cleaner is left to do it
            pass


def materialize(df: DataFrame, name: str = "table") -> DataFrame:
    """Cut lineage by writing ``df`` as a Parquet table under the session's
    checkpoint folder and reading it back.

    Used before loops and passes that reuse one input many times: a lost
    executor then re-reads the table instead of re-running the source scans
    and joins. One job writes it; the read-back is columnar, so later
    projections prune.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.mode("error").parquet(path)
    written = df.sparkSession.read.schema(df.schema).parquet(path)
    written._scratch_path = path
    return written


def discard(*written: DataFrame) -> None:
    """Remove tables of :func:`materialize` that nothing reads any more."""
    for df in written:
        _delete(df.sparkSession, df._scratch_path)


def _delete(spark: SparkSession, path: str) -> None:
    jvm, jsc = spark.sparkContext._jvm, spark.sparkContext._jsc
    conf = jsc.hadoopConfiguration() if jsc else jvm.org.apache.hadoop.conf.Configuration()  # none once stopped
    hadoop = jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(conf).delete(hadoop, True)
