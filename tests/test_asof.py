"""As-of join against a scan; attribution of landed payloads; profiles; counts of a load."""

import datetime as dt
import json
import random

import pytest

from parcelgrid.operators.asof import asof_join


@pytest.mark.parametrize("salts,bucket", [(1, 3600), (16, 3600), (4, 60)])
def test_asof_join_equals_a_scan(spark, salts, bucket):
    rnd = random.Random(salts)
    start = dt.datetime(2024, 3, 30, 23, 0)
    moment = lambda: start + dt.timedelta(seconds=rnd.randrange(0, 50_000, 10))
    left = [(i, moment()) for i in range(300)] + [(300 + i, start + dt.timedelta(hours=2)) for i in range(200)] + [(900, None), (901, start - dt.timedelta(days=9))]
    right = [(moment(), f"u{i:03d}") for i in range(60)] + [(None, "never")]
    right += [(right[0][0], "zz"), (start + dt.timedelta(hours=2), "exact")]
    got = {(r.id, r.at): r.name for r in asof_join(spark.createDataFrame(left, "id int, at timestamp"), spark.createDataFrame(right, "asked timestamp, name string"),
                                                  "at", "asked", ["name"], bucket, salts).collect()}
    want = {}
    for i, at in left:
        before = [(t, n) for t, n in right if at is not None and t is not None and t <= at]
        want[(i, at)] = max(before)[1] if before else None
    assert got == want


def test_asof_join_with_empty_sides(spark):
    left, right = spark.createDataFrame([], "id int, at timestamp"), spark.createDataFrame([], "asked timestamp, name string")
    assert asof_join(left, right, "at", "asked", ["name"]).collect() == []
    one = spark.createDataFrame([(1, dt.datetime(2024, 1, 1))], "id int, at timestamp")
    assert [tuple(r)[2] for r in asof_join(one, right, "at", "asked", ["name"]).collect()] == [None]


def test_profiles_of_several_shapes(spark):
    from parcelgrid.plans.corporate import corporate_tree
    from parcelgrid.sources.payloads import load_company_payloads, load_company_profiles
    full = {"company_name": "A LTD", "company_status": "active", "registered_office_address": {"address_line_1": "1 Road", "postal_code": "P1"},
            "accounts": {"last_accounts": {"made_up_to": "2024-03-31"}}, "sic_codes": ["1", "2"], "other": [1, {"x": None}]}
    odd = {"company_name": "B LTD", "company_status": 7, "registered_office_address": "somewhere", "accounts": [], "sic_codes": "68100"}
    rows = [("1", json.dumps(full)), ("2", json.dumps(odd)), ("3", None), ("4", '{"errors":[]}'), ("5", '{"company_name":'), ("6", "[]"), ("7", '{"company_name":null}'), ("8", "")]
    df = spark.createDataFrame(rows, "company_number string, profile string")
    got = {r.company_number: tuple(r)[1:] for r in load_company_profiles(df).collect()}
    assert got["1"] == ("A LTD", "active", "1 Road, P1", dt.date(2024, 3, 31), "1,2")
    assert got["2"][0] == "B LTD" and got["2"][2:4] == ("", None) and set(got) == {"1", "2"}
    parsed = load_company_payloads(df.selectExpr("company_number", "'{}' AS officers", "cast(null AS string) AS owners", "'x' AS charges"))
    tree = {r.company_number: (r.company_status, r.address, r.n_officers) for r in corporate_tree(load_company_profiles(df), parsed).collect()}
    assert tree["1"] == ("active", "1 Road, P1", 0) and set(tree) == {"1", "2"}


def test_counts_are_observed_and_the_feed_is_scanned_once(spark, tmp_path):
    """The feed is a folder that is removed after the staged write has read it: nothing else may scan it."""
    from parcelgrid.operators.merge import append_reject
    from parcelgrid.plans.signals import load_with_counts
    rows = [("k1", "a"), ("k2", "a"), ("k1", "b"), ("k9", "c"), ("k3", "d"), ("k3", "d")]
    spark.createDataFrame(rows, "k string, f string").write.parquet(str(tmp_path / "feed"))
    feed = spark.read.parquet(str(tmp_path / "feed"))
    target = spark.createDataFrame([("k9",)], "k string")
    want = sorted(r.k for r in append_reject(target, feed, ["k"], "f").collect())
    loaded, counts = load_with_counts(target, feed.where(feed.k.isNotNull()), ["k"], "f")
    for part in (tmp_path / "feed").glob("*.parquet"):
        part.unlink()
    assert sorted(r.k for r in loaded.collect()) == want == ["k1", "k2", "k9"]
    assert {r.unit: (r.rows, r.rows_loaded) for r in counts.collect()} == {"a": (2, 2), "b": (1, 0), "c": (1, 0), "d": (2, 0), "TOTAL": (6, 2)}
