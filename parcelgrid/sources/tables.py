"""Read and write conformed tables.

Tables are parquet folders; the declared ones (``sources.schemas``) are brought to their schema when written and compared with it when read.
``write_bucketed`` lays a declared table out in buckets of its join column (title or property), so that joins on it
need no shuffle of that side.  A merge never overwrites the folder it reads
from: each write goes to a new version folder and the caller swaps the
pointer (``write_version`` returns the new path).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from parcelgrid.session import shared_dir
from parcelgrid.sources.schemas import TABLES, checked, conformed


class Lake:
    """Access to one folder of ``<name>.parquet`` tables."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{name}.parquet")


def read_table(spark: SparkSession, path: str, schema=None) -> DataFrame:
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(path)


def write_table(df: DataFrame, path: str, mode: str = "errorifexists",
                partition_by: list[str] | None = None,
                sort_within: list[str] | None = None) -> str:
    """Write ``df`` as parquet.  ``sort_within`` clusters rows inside each
    file (e.g. by postcode) so min/max statistics prune row groups."""
    if sort_within:
        df = df.sortWithinPartitions(*sort_within)
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def write_version(df: DataFrame, table: str, partition_by: list[str] | None = None) -> str:
    """Write a new immutable version of ``table`` under the shared folder and
    return its path; the old version stays readable until the pointer moves."""
    path = shared_dir(df.sparkSession, f"table-{table}")
    return write_table(df, path, mode="errorifexists", partition_by=partition_by)


def write_declared(df: DataFrame, table: str, path: str | None = None) -> str:
    """Write a declared table in its schema (to a new version folder unless a path is given) and return the path."""
    return write_table(conformed(df, table), path or shared_dir(df.sparkSession, f"table-{table}"))


def read_declared(spark: SparkSession, table: str, path: str) -> DataFrame:
    """Read a declared table; a folder whose columns differ from the declaration is an error."""
    return spark.read.schema(checked(spark.read.parquet(path).schema, table)).parquet(path)


def write_bucketed(df: DataFrame, table: str, buckets: int | None = None) -> str:
    """Write a declared table as a catalog table in ``buckets`` buckets of its bucket column (as many as shuffle partitions unless given), sorted
    in each, its files in the shared folder; returns the catalog name.  One task writes a bucket, so a bucket is one file."""
    spark, column = df.sparkSession, TABLES[table].bucket
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = shared_dir(spark, f"bucketed-{table}")
    name = f"{table}_{path.rsplit('-', 1)[1]}"
    (conformed(df, table).repartition(n, column).write.bucketBy(n, column).sortBy(column).option("path", path).saveAsTable(name))
    return name
