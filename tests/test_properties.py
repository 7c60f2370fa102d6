"""U1 / U2 do not depend on how arrivals are split into batches, and replaying
a batch changes nothing."""

import datetime as dt

from hypothesis import given, settings, HealthCheck
from hypothesis import strategies as st

from skyroll.operators import upsert as U

T0 = dt.datetime(2024, 7, 1)
SCHEMA = ("arrival long, station string, dt timestamp_ntz, temps_avg_f double, vel_avg_mph double, "
          "dir_avg_deg long, hum_avg_pct double, pres_avg_pa long, lux_avg_lx long, rain_inc_in double")

row = st.tuples(st.sampled_from(["a", "b", "c"]), st.integers(0, 3),
                st.one_of(st.none(), st.floats(-50, 120, allow_nan=False)))


def _rows(df, cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(row, min_size=1, max_size=25), st.lists(st.integers(1, 24), max_size=3))
def test_split_independence(spark, items, cuts):
    data = [(i, s, T0 + dt.timedelta(minutes=m), v, 1.0, 1, 1.0, 100000, 1, 0.0) for i, (s, m, v) in enumerate(items)]
    whole = spark.createDataFrame(data, SCHEMA)
    bounds = sorted({c for c in cuts if c < len(data)})
    batches = [data[a:b] for a, b in zip([0] + bounds, bounds + [len(data)])]
    keys, cols = ["station", "dt"], ["station", "dt", "temps_avg_f"]
    one_shot_raw = U.latest_wins(whole, keys, ["arrival"])
    one_shot_latest = U.latest_per_station(whole)

    stored_raw = None
    stored_latest = None
    for b in batches:
        bdf = spark.createDataFrame(b, SCHEMA)
        if stored_raw is None:
            stored_raw = U.latest_wins(bdf, keys, ["arrival"])
            stored_latest = U.latest_per_station(bdf)
        else:
            stored_raw = U.merge_upsert(stored_raw, bdf, keys, ["arrival"])
            stored_latest = U.merge_latest(stored_latest, bdf)
        stored_raw = spark.createDataFrame(stored_raw.collect(), stored_raw.schema)
        stored_latest = spark.createDataFrame(stored_latest.collect(), stored_latest.schema)
    assert _rows(stored_raw, cols) == _rows(one_shot_raw, cols)
    assert _rows(stored_latest, ["station", "dt", "temperature"]) == _rows(one_shot_latest, ["station", "dt", "temperature"])

    # Replaying the last batch is idempotent.
    last = spark.createDataFrame(batches[-1], SCHEMA)
    assert _rows(U.merge_upsert(stored_raw, last, keys, ["arrival"]), cols) == _rows(stored_raw, cols)
    assert _rows(U.merge_latest(stored_latest, last), ["station", "dt", "temperature"]) == \
        _rows(stored_latest, ["station", "dt", "temperature"])
