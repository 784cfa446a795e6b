"""Session helpers: one place for the settings every job assumes."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # small shuffles that feed output-heavy joins (similarity candidates) keep
    # one partition per core; no effect once shuffles exceed ~1 MB per core
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "parcelgrid", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings the jobs rely on.

    On a cluster, ``master`` stays None and the cluster's own defaults win for
    anything not listed in DEFAULT_CONF.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the cluster's shared checkpoint location.

    The location is read from the session (``spark.checkpoint.dir`` or the
    context's checkpoint dir).  Only when neither is set (local tests) is a
    private folder created and registered as the checkpoint dir.
    """
    base = ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to a fresh shared folder and read back: its plan runs once, its lineage ends there, and a
    lost executor costs only its own tasks."""
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dealt(df: DataFrame) -> DataFrame:
    """The side of a join that grows with the rows: both sides are dealt out by key and none goes to every executor.  Left to itself the planner
    takes a frame for as small as the files it comes from, however many rows an explode or a join has made of them, and
    the driver gathers it whole for a broadcast."""
    return df.hint("merge")


def discard(*frames: DataFrame) -> None:
    """Delete the folders of :func:`written` frames that nothing reads any more."""
    for df in frames:
        spark = df.sparkSession
        hadoop = spark._jvm.org.apache.hadoop.fs.Path
        for folder in {hadoop(f).getParent().toString() for f in df.inputFiles()}:
            path = hadoop(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def local_path(uri: str) -> str:
    """Strip a ``file:`` scheme for code that needs an OS path (tests only)."""
    return uri[len("file:"):] if uri.startswith("file:") else uri


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder.  Where none is set, a private one on a ``local`` master, whose
    threads share the disk; elsewhere an error, since executors do not see each other's folders."""
    d = spark.sparkContext.getCheckpointDir()
    if d:
        return d
    conf = spark.conf.get("spark.checkpoint.dir", None)
    master = spark.sparkContext.master
    if not conf and (not master.startswith("local") or master.startswith("local-cluster")):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    spark.sparkContext.setCheckpointDir(conf or tempfile.mkdtemp(prefix="parcelgrid-ckpt-"))
    return spark.sparkContext.getCheckpointDir()


def materialize_bounded(df, max_rows: int):
    """Materialise a frame with a proven bound of ``max_rows`` rows (a top-k
    report cut) once, as a local relation: the plan under it runs a single
    time even though the caller uses the rows in several joins, and the rows
    re-enter the plan the way a broadcast build side does.  Refuses to
    bring more than ``max_rows`` rows."""
    rows = df.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        raise ValueError(f"frame exceeds its bound of {max_rows} rows")
    return df.sparkSession.createDataFrame(rows, df.schema)
