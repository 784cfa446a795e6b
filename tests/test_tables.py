"""Conformed-table IO and versioned writes."""

import os
import re

from pyspark.sql import functions as F

from parcelgrid.session import local_path
from parcelgrid.sources.tables import read_table, write_table, write_version


def test_write_read_round_trip_with_partitions(spark, tmp):
    df = spark.createDataFrame([("a", "E1", 1), ("b", "E2", 2), ("c", "E1", 3)], "k string, pc string, v int")
    path = os.path.join(tmp, "t")
    write_table(df, path, partition_by=["pc"], sort_within=["k"])
    back = read_table(spark, path)
    assert sorted(tuple(r) for r in back.select("k", "pc", "v").collect()) == [("a", "E1", 1), ("b", "E2", 2), ("c", "E1", 3)]
    # partition pruning: the filter on the partition column reaches the scan
    plan = back.where("pc = 'E2'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(pc" in plan


def test_write_version_never_reuses_a_folder(spark):
    df = spark.createDataFrame([("a", 1)], "k string, v int")
    p1 = write_version(df, "demo")
    p2 = write_version(df, "demo")
    assert p1 != p2
    assert os.path.isdir(local_path(p1)) and os.path.isdir(local_path(p2))
    assert read_table(spark, p2).count() == 1


def test_declared_tables_are_enforced(spark, tmp):
    import pytest

    from parcelgrid.sources.schemas import TABLES
    from parcelgrid.sources.tables import read_declared, write_declared
    df = spark.createDataFrame([("u1", "T1", "51.5")], "uprn string, title_number string, latitude string")
    path = write_declared(df, "master_properties", os.path.join(tmp, "props"))
    back = read_declared(spark, "master_properties", path)
    assert back.columns == TABLES["master_properties"].schema.names
    assert [(r.uprn, r.latitude, r.postcode) for r in back.collect()] == [("u1", 51.5, None)]
    with pytest.raises(ValueError, match="not declared: colour"):
        write_declared(df.selectExpr("*", "1 AS colour"), "master_properties")
    with pytest.raises(ValueError, match="key missing: uprn"):
        write_declared(df.drop("uprn"), "master_properties")
    for bad in ("cast(null AS string) AS uprn", "'u2' AS uprn, 'north' AS latitude"):
        with pytest.raises(Exception, match="uprn is null|CAST_INVALID_INPUT"):
            write_declared(spark.sql(f"SELECT {bad}"), "master_properties")
    other = write_table(df, os.path.join(tmp, "other"))
    with pytest.raises(ValueError, match="latitude is string, declared double"):
        read_declared(spark, "master_properties", other)


def test_every_conformed_table_is_declared():
    from parcelgrid.sources.schemas import TABLES
    assert len(TABLES) == 14
    for t in TABLES.values():
        assert set(t.key) <= set(t.schema.names) and (t.bucket is None or t.bucket in t.schema.names)
        assert [f.nullable for f in t.schema if f.name in t.key] == [False] * len(t.key)


def _exchanges_over(plan, scan):
    """Lines of the plan between a scan and the first join above it that are exchanges."""
    lines = plan.splitlines()
    depth = lambda x: len(re.match(r"[ :]*([+:]- )?", x)[0])
    out = []
    for at, line in enumerate(lines):
        if "Scan parquet" in line and scan in line:
            level, i = depth(line), at
            while i >= 0:
                if depth(lines[i]) < level:
                    level = depth(lines[i])
                    if "Join" in lines[i]:
                        break
                    out += [lines[i].strip()] if "Exchange" in lines[i] else []
                i -= 1
    return out


def test_joins_on_bucketed_tables_do_not_shuffle_them(spark):
    """D1, D4 and D7 over bucketed tables: no exchange over certificates and properties (by uprn) and owners (by title)."""
    from conftest import SF_SMALL
    from parcelgrid.jobs import bucketed_tables
    from parcelgrid.plans import distress as D
    from parcelgrid.sources.tables import Lake
    quiet = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in quiet}
    try:
        for k, v in quiet.items():
            spark.conf.set(k, v)
        epc, props, owners, companies = bucketed_tables(Lake(spark, SF_SMALL))
        plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
        base = D.distressed_certificates(epc, props)
        own = owners.select("title_number", "company_number", "date_registered")
        d1 = plan(base.withColumnRenamed("title_number", "_title").join(own, own.title_number == F.col("_title"), "left"))
        d4, d7 = plan(D.distressed_overseas(epc, props, owners, companies)), plan(D.enrichment_targets(companies, owners, props, epc))
        for text in (d1, d4):
            assert "Bucketed: true" in text
            assert not any(_exchanges_over(text, t) for t in ("epc_assessments", "master_properties", "ownership_records"))
        assert not any(_exchanges_over(d7, t) for t in ("epc_assessments", "ownership_records"))
        plain = plan(D.distressed_overseas(*[spark.read.parquet(df.inputFiles()[0].rsplit("/", 1)[0]) for df in (epc, props, owners, companies)]))
        assert "Exchange" in plain and plain.count("Exchange") > d4.count("Exchange")
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
