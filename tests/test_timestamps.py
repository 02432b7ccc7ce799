"""Instants against values computed by the standard library, and the defined results of odd input."""

from datetime import UTC, datetime, timedelta
from zoneinfo import ZoneInfo

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from corpusloom.operators.timestamps import with_instant
from corpusloom.plans.problems import p2_found

NY, BERLIN = "America/New_York", "Europe/Berlin"


def us(*at, tz="UTC"):
    when = datetime(*at, tzinfo=ZoneInfo(tz)) if tz != "UTC" else datetime(*at, tzinfo=UTC)
    return int((when - datetime(1970, 1, 1, tzinfo=UTC)).total_seconds()) * 1_000_000 + when.microsecond


CASES = [
    ("2024-05-31T10:20:30Z", NY, "en-US", us(2024, 5, 31, 10, 20, 30)),
    ("2024-05-31t10:20z", NY, "en-US", us(2024, 5, 31, 10, 20)),
    ("2024-05-31 10:20:30,123456789", BERLIN, "de-DE", us(2024, 5, 31, 8, 20, 30, 123456)),
    ("2024-05-31T10:20:30+0530", NY, "en-US", us(2024, 5, 31, 4, 50, 30)),
    ("2024-05-31T10:20:30-04", NY, "en-US", us(2024, 5, 31, 14, 20, 30)),
    ("2024-05-31T10:20:30[Europe/Berlin]", NY, "en-US", us(2024, 5, 31, 8, 20, 30)),
    ("2024-05-31T10:20:30+02:00[Europe/Berlin]", NY, "en-US", us(2024, 5, 31, 8, 20, 30)),
    ("2024-05-31T10:20:30 Asia/Kathmandu", NY, "en-US", us(2024, 5, 31, 4, 35, 30)),
    ('  "2024/05/31"\t', BERLIN, "de-DE", us(2024, 5, 30, 22)),
    ("20240531", "UTC", "en-US", us(2024, 5, 31)),
    ("20240531102030", BERLIN, "de-DE", us(2024, 5, 31, 8, 20, 30)),
    ("20240531T102030Z", BERLIN, "de-DE", us(2024, 5, 31, 10, 20, 30)),
    ("2024-W22-5", "UTC", "en-US", us(2024, 5, 31)),
    ("2020-W53-7", "UTC", "en-US", us(2021, 1, 3)),
    ("2021-W53-1", "UTC", "en-US", None),
    ("2024-366", "UTC", "en-US", us(2024, 12, 31)),
    ("2023-366", "UTC", "en-US", None),
    ("05/06/2024 07:08", "UTC", "en-US", us(2024, 5, 6, 7, 8)),
    ("05/06/2024 07:08", "UTC", "en-GB", us(2024, 6, 5, 7, 8)),
    ("5/6/24 12:08 a.m.", "UTC", "en-US", us(2024, 5, 6, 0, 8)),
    ("5/6/24 12:08 PM", "UTC", "en-US", us(2024, 5, 6, 12, 8)),
    ("13/06/2024", "UTC", "en-US", None),
    ("31.12.2024 23:59", "UTC", "de-DE", us(2024, 12, 31, 23, 59)),
    ("Wed, 31 May 2023 13:52:45 +1000", NY, "en-US", us(2023, 5, 31, 3, 52, 45)),
    ("Wed, 24 Jul 2019 22:22:49 EDT", "UTC", "en-US", us(2019, 7, 25, 2, 22, 49)),
    ("30 Apr 2022 21:30:40 UT", NY, "en-US", us(2022, 4, 30, 21, 30, 40)),
    ("Fri May 31 10:20:30 2024", "UTC", "en-US", us(2024, 5, 31, 10, 20, 30)),
    ("Tue Feb  4 17:04:37 2020", "UTC", "en-US", us(2020, 2, 4, 17, 4, 37)),
    ("November 4, 2018 1:38 AM", NY, "en-US", us(2018, 11, 4, 5, 38)),
    ("22-Apr-17", "UTC", "es-ES", us(2017, 4, 22)),
    ("27. Oktober 2024, 03:08 Uhr", BERLIN, "de-DE", us(2024, 10, 27, 2, 8)),
    ("31. März 2024, 02:30 Uhr", BERLIN, "de-DE", us(2024, 3, 31, 1, 30)),
    ("1er avril 2022 à 10h08", "Europe/Paris", "fr-FR", us(2022, 4, 1, 8, 8)),
    ("18 de noviembre de 2025, 10:30", "Europe/Madrid", "es-ES", us(2025, 11, 18, 9, 30)),
    ("1674859781", NY, "en-US", 1674859781000000),
    ("1674859781.5", NY, "en-US", 1674859781500000),
    ("1674859781686", NY, "en-US", 1674859781686000),
    ("1674859781686123", NY, "en-US", 1674859781686123),
    ("2024-11-03T01:30:00", NY, "en-US", us(2024, 11, 3, 5, 30)),  # occurs twice: the earlier
    ("2024-03-10T02:30:00", NY, "en-US", us(2024, 3, 10, 7, 30)),  # doesn't occur: the offset before
    *[(v, "UTC", "en-US", None) for v in ("", " ", "--", "n/a", "yesterday", "3 days ago", "2022", "Q3 2022", "May 2023", "2024-W05", "25:61", "10:20", "0000-00-00", "2024-02-30", "2024-13-05T10:00:00Z", "2024-05-31T10:20:30[Mars/Base]", "123456789012", "2024-05-31T25:00:00")],
    (None, "UTC", "en-US", None),
    ("2024-05-31", None, None, us(2024, 5, 31)),
]


def run(spark, rows):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, value string, tz string, locale string")
    return {r.i: r.utc_us for r in with_instant(df, "value", "tz", "locale").collect()}


def test_cases(spark):
    got = run(spark, [c[:3] for c in CASES])
    assert [(c[0], got[i]) for i, c in enumerate(CASES)] == [(c[0], c[3]) for c in CASES]


@pytest.fixture(scope="module")
def spark_again(spark):
    return spark


def test_every_hour_of_a_year_by_zone(spark):
    """Local times across all changes of a year, against the standard library's fold 0."""
    for tz in (NY, BERLIN, "Australia/Sydney", "Asia/Kathmandu"):
        local = [datetime(2024, 1, 1) + timedelta(hours=7 * k, minutes=30) for k in range(1250)]
        want = [int((x.replace(tzinfo=ZoneInfo(tz)) - datetime(1970, 1, 1, tzinfo=UTC)).total_seconds()) * 1_000_000 for x in local]
        got = run(spark, [(x.strftime("%d-%m-%Y %H:%M:%S"), tz, "en-GB") for x in local])
        assert [got[i] for i in range(len(local))] == want


@settings(max_examples=1, deadline=None)
@given(st.lists(st.datetimes(datetime(1900, 1, 1), datetime(2100, 1, 1)), min_size=300, max_size=300))
def test_any_instant_in_many_forms(spark_again, times):
    forms = ("%Y-%m-%dT%H:%M:%S.%fZ", "%Y%m%dT%H%M%SZ", "%d %b %Y %H:%M:%S GMT", "%Y-%jT%H:%M:%SZ", "%G-W%V-%uT%H:%M:%SZ")
    rows, want = [], []
    for t in times:
        for f in forms:
            rows.append((t.strftime(f), "UTC", "en-US"))
            want.append(us(*(t if "%f" in f else t.replace(microsecond=0)).timetuple()[:6]) + (t.microsecond if "%f" in f else 0))
    got = run(spark_again, rows)
    assert [got[i] for i in range(len(rows))] == want


def test_odd_tables(spark, folder, tmp_path):
    df = spark.createDataFrame([("2024-01-01", "UTC", "en-US", 7)] * 2, "value string, tz string, locale string, _ts_p int")
    assert [tuple(r) for r in with_instant(df, "value", "tz", "locale").collect()] == [("2024-01-01", "UTC", "en-US", 7, us(2024, 1, 1))] * 2
    assert with_instant(df.limit(0), "value", "tz", "locale").count() == 0
    long_ = spark.createDataFrame([("9" * 200_000, "UTC", "en-US"), ("a " * 50_000, "UTC", "en-US")], "value string, tz string, locale string")
    assert [r.utc_us for r in with_instant(long_, "value", "tz", "locale").collect()] == [None, None]


def test_parsed_once(spark, folder):
    plan = p2_found(spark, folder)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("(?iu)^") == 1
