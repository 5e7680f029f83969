"""Ground/air state machine: hysteresis, missing ground marks, legs, split tracks."""

import pytest
from conftest import SF_SMALL

from skytrace.operators import movement as mv
from skytrace.operators import sequence
from skytrace.plans import queries as Q

SCHEMA = ("source_date STRING, icao STRING, event_us BIGINT, path STRING, seq INT, datetime_utc TIMESTAMP_NTZ, latitude DOUBLE, longitude DOUBLE, "
          "altitude_ft_num INT, on_ground BOOLEAN, ground_speed_kts DOUBLE, vertical_rate_fpm INT, flags_bitfield INT")


def track(spark, rows, icao="aaaaaa"):
    """Rows (altitude, ground mark, speed, rate, flags), one a second."""
    out = [("2025.02.08", icao, i * 1_000_000, "p", i, None, 1.5, 104.5, alt, ground, speed, rate, flags)
           for i, (alt, ground, speed, rate, flags) in enumerate(rows)]
    return spark.createDataFrame(out, SCHEMA)


def found(df):
    return [(r.leg, r.movement, r.prev_time.second) for r in mv.movements(df).orderBy("leg", "prev_time").collect()]


GROUND, AIR = (None, True, 10.0, 0, 0), (3000, False, 200.0, 1200, 0)


def test_mark_and_altitude(spark):
    assert found(track(spark, [GROUND, AIR, AIR, GROUND, GROUND, AIR])) == [(0, "departure", 0), (0, "arrival", 2), (0, "departure", 4)]


def test_band_keeps_the_state(spark):
    # Between 200 and 500 ft, or low but fast and level: no change, so no flutter.
    band = [(300, False, 60.0, 100, 0), (480, False, 70.0, 400, 0), (150, False, 90.0, 100, 0)]
    assert found(track(spark, [GROUND, *band, GROUND, *band, AIR, *band, AIR])) == [(0, "departure", 4)]


def test_without_ground_marks(spark):
    # Altitude near 0, slow and level is ground; low, fast and climbing is air.
    taxi, climb = (40, False, 12.0, 0, 0), (350, False, 150.0, 1500, 0)
    assert found(track(spark, [taxi, taxi, climb, AIR, climb, taxi])) == [(0, "departure", 1), (0, "arrival", 4)]
    # Speed or rate unknown near 0: still ground. No altitude at all: speed and rate decide together.
    assert found(track(spark, [(0, None, None, None, 0), AIR, (30, None, None, 0, 0)])) == [(0, "departure", 0), (0, "arrival", 1)]
    assert found(track(spark, [(None, None, 5.0, 0, 0), (None, None, 120.0, 900, 0), (None, None, 5.0, None, 0)])) == [(0, "departure", 0)]
    assert found(track(spark, [(None, None, None, None, 0)] * 3)) == []


def test_new_leg_forgets_the_state(spark):
    mark = lambda r: (*r[:4], 2)
    assert found(track(spark, [GROUND, mark(AIR), GROUND])) == [(1, "arrival", 1)]
    unknown = (300, False, 60.0, 0, 2)
    assert found(track(spark, [GROUND, unknown, AIR, GROUND])) == [(1, "arrival", 2)]


@pytest.mark.parametrize("rows_per_split", [2, 3, 10])
def test_split_tracks_agree(spark, monkeypatch, rows_per_split):
    p = Q.located(spark, SF_SMALL)
    want = sorted(map(str, mv.movements(p).collect()))
    long = track(spark, [GROUND, AIR, (300, False, 60.0, 0, 0), AIR, GROUND, (300, False, 60.0, 0, 0)] * 40)
    whole = found(long)
    monkeypatch.setattr(sequence, "DEFAULT_ROWS_PER_SPLIT", rows_per_split)
    assert sorted(map(str, mv.movements(p).collect())) == want and len(want) > 50
    assert found(long) == whole and len(whole) == 80
