import os
import tempfile

from skyroll.operators.parse import good_rows, parse_lines
from skyroll.sources.files import list_station_files, read_station_lines
from skyroll.sources.kafka import publish_rows
from pyspark.sql import functions as F


def _write(root, station, name, lines):
    os.makedirs(os.path.join(root, station), exist_ok=True)
    with open(os.path.join(root, station, name), "w") as f:
        f.write("\n".join(lines) + "\n")


def test_station_files_listing_and_pruning(spark):
    root = tempfile.mkdtemp(prefix="skyroll-files-", dir="/tmp")
    for n in ("20240630.txt", "20240701.txt", "20240701_b.txt", "notes.txt", "20240702.csv"):
        _write(root, "wx_a", n, ['{"dt":"2024-07-01T00:00:00-0400","node":{"hostname":"wx_a"}}'])
    assert [f[1] for f in list_station_files(spark, root)] == ["20240630.txt", "20240701.txt", "20240701_b.txt"]
    lines = read_station_lines(spark, root, min_date={"wx_a": "20240701"})
    assert sorted(r.file_name for r in lines.collect()) == ["20240701.txt", "20240701_b.txt"]
    parsed = good_rows(parse_lines(lines, default_station="station_dir", keep=["station_dir", "file_name"]))
    assert {r.station for r in parsed.collect()} == {"wx_a"}


def test_publish_rows_key_and_value(spark):
    df = spark.createDataFrame([("wx_a", "2024-07-01 12:00:00", 1.5)], "station string, dt string, temps_avg_f double")
    df = df.withColumn("dt", F.col("dt").cast("timestamp_ntz"))
    r = publish_rows(df, {"ingestion_mode": F.lit("backfill")}).collect()[0]
    assert bytes(r.key).decode() == "wx_a|2024-07-01T12:00:00"
    assert bytes(r.value).decode() == '{"dt":"2024-07-01T12:00:00","station":"wx_a","temps_avg_f":1.5,"ingestion_mode":"backfill"}'


def test_newest_files_only(spark):
    from skyroll.operators.progress import source_latest
    from skyroll.sources.files import newest_files_lines
    root = tempfile.mkdtemp(prefix="skyroll-newest-", dir="/tmp")
    _write(root, "wx_a", "20240630.txt", ['{"dt":"2024-06-30T23:00:00"}'])
    _write(root, "wx_a", "20240701.txt", ['{"dt":"2024-07-01T01:00:00"}', '{"dt":"2024-07-01T00:30:00"}', '{bad'])
    lines = newest_files_lines(spark, root)
    assert {r.file_name for r in lines.collect()} == {"20240701.txt"}
    r = source_latest(lines).collect()[0]
    assert (r.station, r.newest_file, str(r.source_latest_ts)) == ("wx_a", "20240701.txt", "2024-07-01 01:00:00")


def test_reset_hides_earlier_runs(spark):
    from skyroll.streaming.tables import Tables
    tables = Tables(spark, tempfile.mkdtemp(prefix="skyroll-reset-", dir="/tmp"))
    df = spark.createDataFrame([("a",)], "station string")
    tables.write(df, "t", "w", 0)
    assert tables.read("t", df.schema).count() == 0
    tables.finish("w", 0)
    assert tables.read("t", df.schema).count() == tables.newest("t", df.schema, "w").count() == 1
    tables.reset()
    assert tables.read("t", df.schema).count() == tables.newest("t", df.schema, "w").count() == 0
    assert tables.last_run("w") == 0
    tables.write(df, "t", "w", 1)
    tables.write(df, "t", "w", 1)  # again: its own partition is overwritten
    tables.finish("w", 1)
    assert tables.read("t", df.schema).count() == 1


def test_source_latest_reads_newest_file_of_each_station(spark):
    from skyroll.operators.progress import source_latest
    rows = [("A", "20240701.txt", 1, '{"dt":"2024-07-09T00:00:00"}'),
            ("A", "20240702.txt", 2, '{"dt":"2024-07-02T00:00:00"}'),
            ("B", "20240701.txt", 3, '{"dt":"2024-07-01T00:00:00"}')]
    lines = spark.createDataFrame(rows, "station_dir string, file_name string, arrival long, line string")
    got = {r.station: (r.newest_file, str(r.source_latest_ts)) for r in source_latest(lines).collect()}
    assert got == {"A": ("20240702.txt", "2024-07-02 00:00:00"), "B": ("20240701.txt", "2024-07-01 00:00:00")}


def test_publish_forwards_original_object_with_station_set(spark):
    import json
    from skyroll.operators.parse import good_rows, parse_lines
    lines = ['{"dt":"2024-07-01T12:00:00-0400","station":"old","extra_field":{"a":[1,2]},"node":{"hostname":"h1"}}',
             '{"dt":"2024-07-01T13:00:00"}']
    df = spark.createDataFrame([("wx_a", l) for l in lines], "station_dir string, line string")
    rows = good_rows(parse_lines(df, default_station="station_dir", keep=["station_dir", "line"]))
    msgs = publish_rows(rows, {"ingestion_mode": F.lit("backfill")}).collect()
    values = sorted((bytes(m.key).decode(), json.loads(bytes(m.value).decode())) for m in msgs)
    assert values[0][0] == "h1|2024-07-01T12:00:00" and values[0][1]["station"] == "h1"
    assert values[0][1]["extra_field"] == {"a": [1, 2]} and values[0][1]["ingestion_mode"] == "backfill"
    assert values[1][0] == "wx_a|2024-07-01T13:00:00" and values[1][1]["station"] == "wx_a"
    # The consumer side reads the overriding (last) station too.
    back = spark.createDataFrame([(bytes(m.value).decode(),) for m in msgs], "line string")
    assert sorted(r.station for r in good_rows(parse_lines(back)).collect()) == ["h1", "wx_a"]


def test_scale_conf_sizes():
    from skyroll.session import scale_conf
    c = scale_conf(100 * 2**40, 8000)
    assert c["spark.sql.shuffle.partitions"] == str(100 * 2**40 // (256 << 20))
    assert scale_conf(1, 8)["spark.sql.shuffle.partitions"] == "16"


def test_enrich_line_edge_cases(spark):
    import json
    from skyroll.sources.kafka import enrich_line
    df = spark.createDataFrame([("{}", 'a"b'), ('  {"x": 1}  ', None)], "line string, st string")
    out = [json.loads(r[0]) for r in df.select(enrich_line(F.col("line"), {"station": F.col("st")})).collect()]
    assert out == [{"station": 'a"b'}, {"x": 1, "station": None}]


def test_later_file_wins_whatever_its_size(spark):
    from skyroll.operators.parse import good_rows, parse_lines
    from skyroll.operators.upsert import latest_wins
    root = tempfile.mkdtemp(prefix="skyroll-order-", dir="/tmp")
    line = lambda v: f'{{"dt":"2024-07-01T00:00:00","temps_avg_f":{v}}}'
    _write(root, "wx_a", "20240701.txt", [line(1), line(2)])
    _write(root, "wx_a", "20240701_b.txt", [line(i) for i in range(1000, 3000)])
    _write(root, "wx_a", "20240701_c.txt", [line(7), line(8)])
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("16k", "1k", old):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            lines = read_station_lines(spark, root)
            rows = good_rows(parse_lines(lines, default_station="station_dir", keep=["station_dir", "arrival", "file_name"]))
            rows = rows.select("station", "dt", "arrival", "temps_avg_f", "file_name")
            assert [r.temps_avg_f for r in latest_wins(rows, ["station", "dt"], ["arrival"]).collect()] == [8.0]
            middle = rows.filter(F.col("file_name") == "20240701_b.txt")
            assert [r.temps_avg_f for r in latest_wins(middle, ["station", "dt"], ["arrival"]).collect()] == [2999.0]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_listing_takes_any_form_of_href(spark):
    from skyroll.sources.listing import listing_links
    html = ("<A HREF='20240701.txt'>x</A><a class=b href=20240702.txt>y</a><a\nhref = \"20240703.txt\">z</a>"
            "<a data-href='20240704.txt'>no</a><a href=\"20240705_a&amp;b.txt\">w</a><a href='about.txt'>no</a>")
    got = [r.href for r in listing_links(spark.createDataFrame([(1, html)], "page_id long, html string")).collect()]
    assert got == ["20240701.txt", "20240702.txt", "20240703.txt", "20240705_a&b.txt"]


def _files_read(spark, df):
    """Files of the largest scan of an executed plan."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        again = df.select("*")
        plan = again._jdf.queryExecution().executedPlan()
        rows = again.count(), plan.toString()
        leaves = again._jdf.queryExecution().executedPlan().collectLeaves()
        again._jdf.queryExecution().toRdd().count()
        scans = [leaves.apply(i) for i in range(leaves.size())]
        return rows, max(int(x.metrics().get("numFiles").get().value()) for x in scans if "file_name" in x.toString())
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_landed_lines_are_pruned_by_station_and_date(spark):
    import datetime as dt
    from skyroll.operators.progress import source_latest
    from skyroll.sources.files import land_lines, landed_lines, lines_since, newest_lines
    path = os.path.join(tempfile.mkdtemp(prefix="skyroll-landed-", dir="/tmp"), "lines")
    rows = [(s, f"202407{d:02d}{x}.txt", i, f'{{"dt":"2024-07-{d:02d}T0{i}:00:00"}}')
            for s in ("007", "b", "c") for d in range(1, 11) for x in ("", "_b") for i in range(2)]
    lines = spark.createDataFrame([*rows, ("b", "notes.txt", 0, "x")], "station_dir string, file_name string, arrival long, line string")
    land_lines(lines, path)
    landed = landed_lines(spark, path)
    assert {r.station_dir for r in landed.select("station_dir").distinct().collect()} == {"007", "b", "c"}
    cutoffs = spark.createDataFrame([("007", dt.datetime(2024, 7, 9, 13)), ("b", None)], "station string, cutoff timestamp_ntz")
    got = lines_since(landed, cutoffs)
    want = sorted(r[:3] for r in rows if r[0] == "b" or (r[0] == "007" and r[1] >= "20240709"))
    assert sorted((r.station_dir, r.file_name, r.arrival) for r in got.collect()) == want
    (n, plan), files = _files_read(spark, got)
    assert n == len(want) and "dynamicpruning" in plan and files == 12  # of 30 folders
    newest = newest_lines(landed)
    assert {(r.station_dir, r.file_name) for r in newest.collect()} == {(s, "20240710_b.txt") for s in ("007", "b", "c")}
    assert _files_read(spark, newest)[1] == 3
    assert {str(r.source_latest_ts) for r in source_latest(newest).collect()} == {"2024-07-10 01:00:00"}
    assert lines_since(landed, cutoffs.limit(0)).count() == 0
