"""N1: µs rounding, UTC hour buckets, ISO text — independent of session tz."""

import datetime as dt
import random

from pyspark.sql import functions as F

from skytrace.functions.timefn import epoch_us, hour_of_day, iso_utc, ntz_from_us, utc_seconds_text


def test_rounding_matches_python_datetime(spark):
    rnd = random.Random(7)
    rows = []
    for _ in range(3000):
        base = float(rnd.randrange(1_600_000_000, 1_800_000_000))
        off = rnd.uniform(0, 90_000)
        rows.append((base, off))
    df = spark.createDataFrame(rows, "b DOUBLE, o DOUBLE").select("b", "o", epoch_us("b", "o").alias("us"))
    got = {(r.b, r.o): r.us for r in df.collect()}
    epoch = dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)
    for (b, o), us in got.items():
        ref = dt.datetime.fromtimestamp(b + o, tz=dt.timezone.utc)
        assert us == (ref - epoch) // dt.timedelta(microseconds=1)


def test_out_of_range_is_null(spark):
    df = spark.createDataFrame([(1e20, 0.0), (None, 1.0), (1.0, None)], "b DOUBLE, o DOUBLE")
    assert [r[0] for r in df.select(epoch_us("b", "o")).collect()] == [None, None, None]


def test_hour_edges_and_pre_1970(spark):
    base = 1738972800  # 2025-02-08 00:00:00 UTC
    us = [base * 10**6 + 3600 * 10**6 - 1, (base + 3600) * 10**6, (base + 4 * 3600 - 1) * 10**6,
          (base + 4 * 3600) * 10**6, -1, -3600 * 10**6]
    df = spark.createDataFrame([(u,) for u in us], "us BIGINT")
    hours = [r[0] for r in df.select(hour_of_day("us")).collect()]
    assert hours == [0, 1, 3, 4, 23, 23]


def test_iso_text(spark):
    df = spark.createDataFrame([(1738976401623000,), (1738976401000000,), (5,)], "us BIGINT")
    got = [r[0] for r in df.select(iso_utc("us")).collect()]
    epoch = dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)
    want = [(epoch + dt.timedelta(microseconds=u)).isoformat() for u in (1738976401623000, 1738976401000000, 5)]
    assert got == want


def test_ntz_and_seconds_text(spark):
    df = spark.createDataFrame([(1738976401623456,)], "us BIGINT")
    r = df.select(ntz_from_us("us").alias("t"), utc_seconds_text("us").alias("s")).first()
    assert r.t == dt.datetime(2025, 2, 8, 1, 0, 1, 623456)
    assert r.s == "2025-02-08 01:00:01 UTC"


def test_ntz_to_us_ignores_session_dst(spark):
    """Session is America/New_York: 02:30 on the spring-forward day does not
    exist there, yet as a UTC wall clock it is an ordinary instant."""
    from skytrace.functions.timefn import us_from_ntz

    vals = [dt.datetime(2024, 3, 10, 2, 30, 0, 5), dt.datetime(2024, 7, 15, 12, 0, 0, 123456),
            dt.datetime(2024, 11, 3, 1, 30), dt.datetime(1969, 12, 31, 23, 59, 59, 999999)]
    df = spark.createDataFrame([(v,) for v in vals], "ts TIMESTAMP_NTZ")
    got = [r[0] for r in df.select(us_from_ntz("ts")).collect()]
    epoch = dt.datetime(1970, 1, 1)
    assert got == [(v - epoch) // dt.timedelta(microseconds=1) for v in vals]


def test_us_to_ntz_ignores_session_dst(spark):
    vals = [dt.datetime(2024, 3, 10, 2, 30, 0, 5), dt.datetime(2024, 11, 3, 1, 30), dt.datetime(1969, 12, 31, 23, 59, 59)]
    epoch = dt.datetime(1970, 1, 1)
    df = spark.createDataFrame([((v - epoch) // dt.timedelta(microseconds=1),) for v in vals], "us BIGINT")
    assert [r[0] for r in df.select(ntz_from_us("us")).collect()] == vals
