"""Object-store listings as DataFrames.

A listing is (object_key, size[, seq]); on a real store it comes from
``spark.read.format("binaryFile")`` without the content column, or from a
landed inventory report.  Nothing is listed on the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SHOWN_PER_FOLDER = 20    # the reference prints the first 20 files per folder
MB = 1024 * 1024


def list_files(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    """Listing of a folder tree via the binaryFile source (content pruned)."""
    df = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
          .option("pathGlobFilter", glob).load(root).select("path", "length"))
    return df.select(F.col("path").alias("object_key"), F.col("length").alias("size"))


def select_feed_files(listing: DataFrame, prefix: str = "", include: str | None = None,
                      exclude: str | None = None, suffix: str | None = None) -> DataFrame:
    """Keys under ``prefix`` containing ``include``, not ``exclude``,
    ending with ``suffix`` (each test optional)."""
    k = F.col("object_key")
    cond = k.startswith(prefix)
    if include:
        cond = cond & k.contains(include)
    if exclude:
        cond = cond & ~k.contains(exclude)
    if suffix:
        cond = cond & k.endswith(suffix)
    return listing.where(cond)


def folder_of(key) -> F.Column:
    """First two path parts when the key has more than two, the first part
    when it has two, else 'root'."""
    parts = F.split(key, "/")
    n = F.size(parts)
    return (F.when(n > 2, F.concat(parts[0], F.lit("/"), parts[1]))
             .when(n == 2, parts[0]).otherwise(F.lit("root")))


def lake_inventory(listing: DataFrame) -> DataFrame:
    """Per folder files, bytes, MB (2 places, half-even), files beyond
    the first 20; a grand-total row ('TOTAL') from the same rollup."""
    f = listing.select(folder_of(F.col("object_key")).alias("folder"), "size")
    g = f.rollup("folder").agg(F.count(F.lit(1)).alias("files"), F.sum("size").alias("size_bytes"))
    return g.select(
        F.coalesce("folder", F.lit("TOTAL")).alias("folder"), "files", "size_bytes",
        F.bround(F.col("size_bytes") / F.lit(float(MB)), 2).alias("size_mb"),
        F.when(F.col("folder").isNull(), F.lit(0))
         .otherwise(F.greatest(F.col("files") - SHOWN_PER_FOLDER, F.lit(0))).alias("more_files"))


def lake_inventory_files(listing: DataFrame, top_n: int = SHOWN_PER_FOLDER) -> DataFrame:
    """The first ``top_n`` keys per folder in listing (key) order."""
    f = listing.select(folder_of(F.col("object_key")).alias("folder"), "object_key", "size")
    w = Window.partitionBy("folder").orderBy("object_key")
    return (f.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= top_n).drop("_rn")
             .withColumn("size_mb", F.bround(F.col("size") / F.lit(float(MB)), 2)))
