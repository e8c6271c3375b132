import datetime as dt
from zoneinfo import ZoneInfo

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from weftline.functions import timestamps as X


def one(value, zone="Europe/Berlin"):
    got = X.normalise(pd.Series([value], dtype=object), pd.Series([zone], dtype=object))[0]
    return got if isinstance(got, str) else None


@pytest.mark.parametrize(
    ("value", "want"),
    [
        ("20 août 2024", "2024-08-20"), ("28 de noviembre de 2019", "2019-11-28"), ("17. Juni 2021", "2021-06-17"), ("DEC 10 2020", "2020-12-10"),
        ("21st March 2019", "2019-03-21"), ("08-NOV-20", "2020-11-08"), ("2021-W31-1", "2021-08-02"), ("2024-366", "2024-12-31"), ("2023-366", None),
        ("12/10/2020", "2020-12-10"), ("02.08.2021", "2021-08-02"), ("2026.03.12", "2026-03-12"), ("20200503", "2020-05-03"), (" 2025-12-26 ", "2025-12-26"),
        ("1733168462", "2024-12-02T19:41:02.000000Z"), ("1621191868000", "2021-05-16T19:04:28.000000Z"), ("20230219T163621Z", "2023-02-19T16:36:21.000000Z"),
        ("Wed, 24 Feb 2021 17:40:00 +0100", "2021-02-24T16:40:00.000000Z"), ("Mar 12, 2026 1:29 AM CET", "2026-03-12T00:29:00.000000Z"),
        ("04.03.2025 11:54:41,516544", "2025-03-04T10:54:41.516544Z"), ("12:00 noon", None), ("31 Feb 2024", None), ("00/00/0000", None), ("Q3 2025", None), ("mid 2024", None),
        ("n/a", None), ("", None), ("2024-13-05", None), ("06/11/2024 12:35 AM", "2024-06-10T22:35:00.000000Z"), ("06/11/2024 13:35 PM", None), ("2024-06-11T24:00:00Z", None),
    ],
)
def test_notations(value, want):
    assert one(value) == want


def test_repeated_reading_is_the_earlier_and_a_skipped_one_moves_on():
    assert one("2021-10-31 02:30:00") == "2021-10-31T00:30:00.000000Z"
    assert one("2021-03-28 02:30:00") == "2021-03-28T01:30:00.000000Z"
    assert one("2021-11-07T01:30:00", "America/New_York") == "2021-11-07T05:30:00.000000Z"


def test_unknown_or_absent_zone_gives_nothing_for_local_times_only():
    assert one("2021-10-31 02:30:00", None) is None
    assert one("2021-10-31 02:30:00", "Mars/Olympus") is None
    assert one("2021-10-31", None) == "2021-10-31"
    assert one("2021-10-31T02:30Z", None) == "2021-10-31T02:30:00.000000Z"


@settings(max_examples=200, deadline=None)
@given(st.datetimes(dt.datetime(1990, 1, 1), dt.datetime(2035, 1, 1)), st.sampled_from(["America/New_York", "Europe/London", "Australia/Sydney", "Asia/Kolkata", "Asia/Tokyo", "America/Los_Angeles"]))
def test_local_times_as_zoneinfo(t, zone):
    z = ZoneInfo(zone)
    early = t.replace(tzinfo=z, fold=0)
    want = early.astimezone(dt.timezone.utc).strftime("%Y-%m-%dT%H:%M:%S.%fZ")
    assert one(t.strftime("%Y-%m-%dT%H:%M:%S.%f"), zone) == want
    table = X.transitions(zone)
    assert np.all(np.diff(table[0]) > 0)


def test_column_with_nulls_and_empty(spark):
    df = spark.createDataFrame([(None, "UTC"), ("2020-01-02", None)], "v string, z string")
    got = [r[0] for r in df.select(X.normal_timestamp(df.v, df.z)).collect()]
    assert got == [None, "2020-01-02"]
    none = spark.createDataFrame([], "v string, z string")
    assert none.select(X.normal_timestamp(none.v, none.z)).count() == 0


def test_version_is_named():
    assert X.zone_database_version()
