"""Edge cases of single records and times."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from auditlake.functions import parse_event_time
from auditlake.operators import classify_records

from helpers import event

TIMES = [
    # text, accepted, route, instant
    ("2024-01-01T05:06:07Z", "2024/01/01/05", "2024-01-01T05:06:07+00:00"),
    ("2024-01-01T05:06:07.123456789Z", "2024/01/01/05", "2024-01-01T05:06:07.123456+00:00"),
    ("2024-01-01T05:06:07,5Z", "2024/01/01/05", "2024-01-01T05:06:07.500000+00:00"),
    ("2024-01-01T00:30:00+05:30", "2024/01/01/00", "2023-12-31T19:00:00+00:00"),
    ("2024-01-01T23:30:00-01:00", "2024/01/01/23", "2024-01-02T00:30:00+00:00"),
    ("2024-01-01T12:00:00+23:59", "2024/01/01/12", "2023-12-31T12:01:00+00:00"),
    ("2024-01-01T5:06:07Z", "2024/01/01/05", "2024-01-01T05:06:07+00:00"),
    ("2024-02-29T00:00:00Z", "2024/02/29/00", "2024-02-29T00:00:00+00:00"),
    ("2024-01-01t05:06:07z", None, None),
    ("2024-01-01T05:06:07z", None, None),
    ("2023-02-29T00:00:00Z", None, None),
    ("2024-02-30T00:00:00Z", None, None),
    ("2024-13-01T00:00:00Z", None, None),
    ("2024-01-01T24:00:00Z", None, None),
    ("2024-01-01T23:59:60Z", None, None),
    ("2024-01-01T05:06:07", None, None),
    ("2024-01-01 05:06:07Z", None, None),
    ("2024-01-01", None, None),
    ("2024-01-01T05:06:07+25:00", None, None),
    ("2024-01-01T05:06:07.Z", None, None),
    ("2024-01-01T05:06:07Z\n", None, None),
    (" 2024-01-01T05:06:07Z", None, None),
    ("", None, None),
]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_times(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([(t,) for t, _, _ in TIMES], "event_time string")
        got = {r.event_time: r for r in parse_event_time(df).collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    for text, route, instant in TIMES:
        r = got[text]
        assert r.time_ok == (route is not None), text
        if route is None:
            assert r.event_micros is None
            continue
        assert "/".join((r.year, r.month, r.day, r.hour)) == route
        at = dt.datetime.fromisoformat(instant)
        assert r.event_micros == round(at.timestamp() * 1_000_000), text


RAW = [
    (event("a"), None),
    (' {"eventTime" : "2024-01-01T00:00:00Z",\n "recipientAccountId":"1"} ', None),
    (event(None), None),
    (event("a", region=None), None),
    (event("a", userIdentity=None), None),
    (event("a", userIdentity={"accountId": "2"}, account=""), None),
    (event("a", userIdentity={"accountId": "2"}, account=None), None),
    (event("a", eventIDs=7, extra={"accountId": 5}), None),
    (event(7), "malformed"),
    (event(True), "malformed"),
    (event({"x": 1}), "malformed"),
    (event("a", account=123456789012), "malformed"),
    (event("a", region=["x"]), "malformed"),
    (event("a", time=5), "malformed"),
    (event("a", userIdentity="x"), "malformed"),
    (event("a", userIdentity=["x"]), "malformed"),
    (event("a", userIdentity={"accountId": 5}), "malformed"),
    ('{"\\u0065ventID":7}', "malformed"),
    ('{"eventID":"a', "malformed"),
    ("null", "malformed"), ("5", "malformed"), ('"str"', "malformed"), ("[1,2]", "malformed"),
    ("", "malformed"), (None, "malformed"),
    (event("a", time="nope"), "bad_time"),
    (event("a", time=None), "bad_time"),
    (event("a", time="nope", account=""), "bad_time"),
    ("{}", "bad_time"),
    (event("a", account=""), "no_account"),
    (event("a", account=None, userIdentity={"accountId": ""}), "no_account"),
    (event("a", account=None, userIdentity={}), "no_account"),
]


def test_reasons(spark):
    df = spark.createDataFrame([(i, r) for i, (r, _) in enumerate(RAW)], "i int, raw string")
    got = {r.i: r.reject_reason for r in classify_records(df).collect()}
    assert {RAW[i][0]: got[i] for i in got} == dict(RAW)


def test_lax_types_are_text(spark):
    df = spark.createDataFrame([(event(7),)], "raw string")
    r = classify_records(df, strict=False).first()
    assert (r.reject_reason, r.event_id) == (None, "7")


def test_missing_and_fallback_fields(spark):
    df = spark.createDataFrame([
        (event(None, region=None),), (event("b", account="", userIdentity={"accountId": "22"}),)], "raw string")
    a, b = classify_records(df).orderBy("event_id").collect()
    assert (a.event_id, a.region) == ("", "")
    assert b.account_id == "22"


def test_escapes_are_read(spark):
    df = spark.createDataFrame([('{"eventID":"\\u00e9\\n","eventID2":1}',)], "raw string")
    assert classify_records(df).select(F.col("event_id")).first()[0] == "é\n"
