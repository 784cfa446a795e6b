"""F1/F2: a file stream merged into a table, one micro-batch at a time.

``readStream`` over a landing folder -> conform -> ``foreachBatch`` that applies a keyed merge rule (B1-B3) to the last version of the
table and writes the next one as a plain folder named by the batch's number, ``batch=<id>``.  Nothing that is being read is
ever overwritten: a batch that is run again reads the version before its own and writes its own once more.  The
version before the last stays for that; older ones are deleted.  ``availableNow`` drains what is there and stops; the final state equals
the batch merge of all inputs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def _folders(spark: SparkSession, root: str):
    """The file system of ``root`` and its complete versions by batch number."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    found = [s.getPath() for s in fs.listStatus(path)] if fs.exists(path) else []
    done = {int(p.getName()[len("batch="):]): p for p in found if p.getName().startswith("batch=")}
    return fs, {k: p for k, p in done.items() if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))}


def last_version(spark: SparkSession, root: str, before: int | None = None) -> str | None:
    """Folder of the last complete version (of those before a batch, if one is given)."""
    _, done = _folders(spark, root)
    ids = [k for k in done if before is None or k < before]
    return done[max(ids)].toString() if ids else None


def stream_merge(source: DataFrame, base: DataFrame, rule: Callable[[DataFrame, DataFrame], DataFrame], root: str, checkpoint: str,
                 prepare: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """F1: drain ``source`` (a streaming DataFrame) with ``rule(target, batch) -> new target`` per micro-batch, and return the table.

    ``base`` is the table before the stream's first batch and has its schema.  ``root`` holds the versions and ``checkpoint``
    the stream's progress; both belong to one stream, and a later call with them goes on where this one ended.  Another stream has
    folders of its own and starts from this one's table."""
    spark, schema = source.sparkSession, base.schema

    def read(before: int | None) -> DataFrame:
        path = last_version(spark, root, before)
        return spark.read.schema(schema).parquet(path) if path else base

    def apply(batch: DataFrame, batch_id: int) -> None:
        rows = prepare(batch) if prepare else batch
        rule(read(batch_id), rows).select(*schema.names).write.mode("overwrite").parquet(f"{root}/batch={batch_id}")
        fs, done = _folders(spark, root)
        for k in sorted(k for k in done if k < batch_id)[:-1]:
            fs.delete(done[k], True)

    q = (source.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return read(None)


def file_stream(spark: SparkSession, folder: str, schema, fmt: str = "parquet", glob: str | None = None,
                max_files: int | None = None) -> DataFrame:
    r = spark.readStream.format(fmt).schema(schema)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.load(folder)
