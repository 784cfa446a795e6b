"""E8-E12 rules that depend on key presence and JS/Python truthiness."""

from pyspark.sql import functions as F

from parcelgrid.functions.signals import active_officers, short_address, title_line
from parcelgrid.plans.corporate import charge_summary
from parcelgrid.session import materialize_bounded
from parcelgrid.sources.payloads import load_company_payloads

import pytest


def test_active_officers_uses_key_presence(spark):
    js = ('{"items":[{"name":"A"},{"name":"B","resigned_on":null},{"resigned_on":"2020-01-01"},'
          '{"role":"x"},{"name":"C"},{"name":"D"}]}')
    df = spark.createDataFrame([("S1", js, "{}", "{}")], "company_number string, officers string, owners string, charges string")
    parsed = load_company_payloads(df)
    got = parsed.select(active_officers(F.col("officers"), 3)).first()[0]
    # 'B' has the key (null value) -> resigned; the nameless record -> 'Unknown'
    assert got == "A, Unknown, C"


def test_charge_labels_and_js_fallbacks(spark):
    js = ('{"items":[{"status":"outstanding","created_on":"2021-01-01","persons_entitled":[{"name":""}],'
          '"particulars":{"description":""}},{"status":"satisfied"}]}')
    df = spark.createDataFrame([("S1", "{}", "{}", js), ("S2", "{}", "{}", "{}")],
                               "company_number string, officers string, owners string, charges string")
    rows = {r.company_number: r for r in charge_summary(load_company_payloads(df)).collect()}
    assert rows["S1"].charges_label == "1 CHARGES" and rows["S1"].debt_label == "MATURING DEBT DETECTED"
    assert rows["S1"].first_lender == "UNKNOWN LENDER" and rows["S1"].first_description == "Fixed Charge over Property"
    assert rows["S2"].charges_label == "CLEAR" and rows["S2"].debt_label == "NO CHARGES FILED"


def test_card_text_rules(spark):
    df = spark.createDataFrame([("12 High St, London", "", "Office"), (None, None, None), ("", "ACME", "Shop")],
                               "address string, company_name string, property_type string")
    got = df.select(short_address("address"), title_line("company_name", "property_type")).collect()
    assert [tuple(r) for r in got] == [("12 High St", "Office"), ("Unknown Address", "Commercial Asset"),
                                       ("Unknown Address", "ACME")]


def test_materialize_bounded_checks_its_bound(spark):
    df = spark.range(10)
    assert materialize_bounded(df.limit(5), 5).count() == 5
    with pytest.raises(ValueError):
        materialize_bounded(df, 5)


def test_transport_accepts_bare_list_and_envelope(spark):
    from parcelgrid.sources.payloads import load_transport
    env = '{"stopPoints":[{"id":"S1","commonName":"A","lat":51.5,"lon":-0.1,"lines":[{"id":"x"}]}]}'
    bare = '[{"id":"S2","commonName":"B","lat":51.6,"lon":-0.2}]'
    later = '{"stopPoints":[{"id":"S1","commonName":"A2","lat":51.5,"lon":-0.1,"lines":[]}]}'
    df = spark.createDataFrame([(1, "tube", env), (2, "dlr", bare), (3, "overground", later)],
                               "seq long, mode string, payload string")
    got = {r.location_id: (r.name, r.annual_footfall, r.metric_type) for r in load_transport(df).collect()}
    assert got == {"S1": ("A2", 1000000, "TFL_OVERGROUND"), "S2": ("B", 1000000, "TFL_DLR")}


def test_planning_days_left_floor_with_time_of_day(spark):
    import datetime as dt
    from parcelgrid.sources.payloads import load_planning
    rec = '{"records":[{"uid":"PA/1","status":"Granted","date_decision":"2022-06-15"},{"uid":"PA/2","status":"Refused","date_decision":"2022-06-15"}]}'
    df = spark.createDataFrame([(1, rec)], "seq long, payload string")
    expiry = dt.datetime(2022, 6, 15) + dt.timedelta(days=365 * 3)      # midnight 2025-06-14
    for as_of in (dt.datetime(2025, 1, 1, 9, 0), dt.datetime(2025, 1, 1, 0, 0)):
        want = (expiry - as_of).days                                      # 163 with a time of day, 164 at midnight
        r = load_planning(df, as_of, window=False).collect()
        assert [(x.application_id, str(x.expiry_date), x.days_remaining, x.is_lapsing_soon) for x in r] == \
            [("PA/1", "2025-06-14", want, 0 < want < 180)]


def test_property_search_like_semantics(spark):
    from parcelgrid.plans.distress import property_search
    props = spark.createDataFrame([("1", "12 High St"), ("2", "50% Off Unit"), ("3", "5x0 Lane"), ("4", "HIGH ROAD")],
                                  "uprn string, address_line_1 string")
    epc = spark.createDataFrame([("1", "C1", "G")], "uprn string, certificate_id string, asset_rating_band string")
    hits = lambda q, esc: sorted(r.uprn for r in property_search(props, epc, q, escape=esc).collect())
    assert hits("high", False) == ["1", "4"]          # case-insensitive contains
    assert hits("5_0", False) == ["3"]                 # '_' stays a wildcard, as in the reference
    assert hits("0%", True) == ["2"]                   # escaped: literal percent sign
    assert hits("0%", False) == ["2", "3"]             # unescaped: '%' matches anything


def test_last_entry_of_a_page_wins(spark):
    import datetime as dt
    import json

    from parcelgrid.sources.payloads import load_hygiene, load_planning, load_transport
    page = json.dumps({"establishments": [{"FHRSID": 1, "BusinessName": "Zed first"}, {"FHRSID": 1, "BusinessName": "Ann last"}]})
    df = spark.createDataFrame([("A", 1, page), ("B", 1, page.replace("1,", "2,"))], "area string, page int, payload string")
    got = {r.fsa_id: (r.business_name, r.local_authority_code) for r in load_hygiene(df, authority_col="area").collect()}
    assert got == {1: ("Ann last", "A"), 2: ("Ann last", "B")}
    stops = json.dumps([{"id": "s", "commonName": "Zed"}, {"id": "s", "commonName": "Ann"}])
    df = spark.createDataFrame([("tube", 0, stops)], "mode string, seq int, payload string")
    assert [r.name for r in load_transport(df).collect()] == ["Ann"]
    plans = json.dumps({"records": [{"uid": "p", "status": "Granted", "date_decision": "2024-01-01", "address": a} for a in ("Z", "A")]})
    df = spark.createDataFrame([(0, "7", plans)], "seq int, target string, payload string")
    got = load_planning(df, dt.datetime(2026, 9, 1), uprn_col="target", window=False).collect()
    assert [(r.address, r.uprn) for r in got] == [("A", "7")]
