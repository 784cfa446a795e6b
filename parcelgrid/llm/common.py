"""Helpers shared by the corpus operators."""

from __future__ import annotations

import gc
import os
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: characters that separate words: space and U+0009..U+000D
WORD_BREAK = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """Words of a text as an array, JVM-side; a null or blank text has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), WORD_BREAK), "")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names that do not clash (case-insensitively) with those of ``df``."""
    taken = {c.lower() for c in df.columns}
    out = []
    for n in names:
        while n.lower() in taken:
            n = "_" + n
        taken.add(n.lower())
        out.append(n)
    return out


def named(df: DataFrame, name: str) -> Column:
    """A column by its literal name (dots and spaces included)."""
    return df["`" + name.replace("`", "``") + "`"]


def shared_root(spark: SparkSession) -> str:
    """The cluster's shared folder for intermediate tables: ``spark.checkpoint.dir``
    or the context's checkpoint folder.  Only a ``local`` master, where all
    threads see the same disk, gets a private folder when neither is set."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    spark.sparkContext.setCheckpointDir(os.path.join(tempfile.gettempdir(), "corpus-shared"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def shared_path(spark: SparkSession, name: str) -> str:
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex[:16]}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write ``df`` to the shared folder and read it back.  A
    lost executor then costs only its own tasks, and the plan above runs once."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, *frames: DataFrame) -> None:
    """Delete tables of :func:`written` that nothing reads any more: all that was made from them is written itself."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    root = path(shared_root(spark))
    for df in frames:
        for file in df.inputFiles()[:1]:
            folder = path(file).getParent()
            fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
            if fs.makeQualified(folder.getParent()).equals(fs.makeQualified(root)):
                fs.delete(folder, True)


def release_shuffles(spark: SparkSession) -> None:
    """Let Spark's cleaner drop shuffle files of finished jobs.  They go when the
    driver collects the plans that own them; a long job of several heavy
    passes would otherwise hold the shuffles of all passes at once."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def slices(batches: Iterator, rows: int = 256) -> Iterator:
    """Cut Arrow batches into small ones, so that what a task makes of a batch stays small; takes
    series or tuples of series."""
    for b in batches:
        n = len(b[0] if isinstance(b, tuple) else b)
        for at in range(0, n, rows):
            yield tuple(x.iloc[at:at + rows] for x in b) if isinstance(b, tuple) else b.iloc[at:at + rows]
