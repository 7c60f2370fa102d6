import datetime as dt

import pytest

from skyroll.plans import queries as Q

T0 = dt.datetime(2024, 7, 1, 15, 4)


def _latest(spark):
    return spark.createDataFrame(
        [("wx_waverly", T0, 71.25, 3.0, 270.0, 0.126, 55.0, 1013.25, 12345.0),
         ("wx_east_st", T0, None, None, None, None, None, None, None)],
        "station string, dt timestamp_ntz, temperature double, wind_speed double, wind_direction double, "
        "rain_inches double, humidity double, pressure double, lux double")


def test_validation(spark):
    df = _latest(spark)
    with pytest.raises(ValueError):
        Q.latest(df, metric="tempb")
    with pytest.raises(ValueError):
        Q.history(df, window="decade")
    with pytest.raises(ValueError):
        Q.chart_series(df.select("station"), "temperature")


def test_latest_filters(spark):
    df = _latest(spark)
    assert Q.latest(df, station="all").count() == 2
    rows = Q.latest(df, station="wx_waverly", metric="rainfall").collect()
    assert [tuple(r) for r in rows] == [("wx_waverly", T0, 0.126)]


def test_card_formats(spark):
    rows = {r.station: r for r in Q.conditions_card(_latest(spark)).collect()}
    w = rows["wx_waverly"]
    assert (w.temperature_text, w.wind_direction_text, w.rainfall_text, w.lux_text, w.time_text) == \
        ("71.2 °F", "270 °", "0.13 in", "12,345 lx", "03:04 PM")
    e = rows["wx_east_st"]
    assert e.temperature_text == "N/A" and e.pressure_text == "N/A"


def test_chart_labels_and_units(spark):
    hist = spark.createDataFrame([(T0, "wx_waverly", "101325"), (T0, "zz", "x"), (None, "zz", "5")],
                                 "bucket_ts timestamp_ntz, station string, pressure string")
    rows = Q.chart_series(hist, "pressure").collect()
    assert [(r.station, r.station_label, r.pressure) for r in rows] == [("wx_waverly", "Waverly", 1013.25)]


def test_labels_change_between_micro_batches(spark, tmp_path, monkeypatch):
    from skyroll.plans import queries as Q
    src, dim = str(tmp_path / "src"), str(tmp_path / "labels")
    seen = []

    def apply(rows, _batch):
        labels = spark.read.parquet(dim)
        seen.append({r.station: r.station_label for r in Q.with_labels(rows, labels).collect()})

    def send(labels, *stations):
        spark.createDataFrame(labels, "station string, label string").write.mode("overwrite").parquet(dim)
        spark.createDataFrame([(s,) for s in stations], "station string").coalesce(1).write.mode("append").parquet(src)
        stream = spark.readStream.schema("station string").parquet(src)
        stream.writeStream.foreachBatch(apply).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination(300)

    send([("a", "Alpha"), ("b", None)], "a", "b", "x")
    monkeypatch.setattr(Q, "MAX_LABEL_BYTES", 0)  # beyond the bound: a plain join
    send([("a", "Alpha 2"), ("x", "Ex"), ("x", "E")], "a", "x", None)
    assert seen == [{"a": "Alpha", "b": "b", "x": "x"}, {"a": "Alpha 2", "x": "Ex", None: None}]
