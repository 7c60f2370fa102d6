import datetime as dt


from skyroll.operators.parse import good_rows, parse_lines, reject_rows


def _parse(spark, lines, **kw):
    df = spark.createDataFrame([(i, l) for i, l in enumerate(lines)], "arrival long, line string")
    return parse_lines(df, keep=["arrival"], **kw)


def test_numbers_to_bigint_and_double(spark):
    lines = ['{"dt":"2024-07-01T00:00:00","station":"a","dir_avg_deg":12.5,"lux_avg_lx":13.5,"pres_avg_pa":"12",'
             '"rain_inc_count":null,"temps_avg_f":"71.5","vel_avg_mph":3}']
    r = good_rows(_parse(spark, lines)).collect()[0]
    assert (r.dir_avg_deg, r.lux_avg_lx, r.pres_avg_pa, r.rain_inc_count) == (12, 14, 12, None)
    assert (r.temps_avg_f, r.vel_avg_mph) == (71.5, 3.0)


def test_rejects_and_objects(spark):
    lines = ['{"dt":"2024-07-01T00:00:00","station":"a","node":null}',
             '{"dt":"2024-07-01T00:00:00","node":{"hostname":"h1","uptime_seconds":5}}',
             '[1]', '7', '   ', '{bad', '{"dt":"junk","station":"a"}',
             '{"dt":"2024-07-01T00:00:00","station":"","node":{"hostname":""}}',
             '{"dt":"2024-07-01T00:00:00","station":"s","node":{"hostname":""}}']
    parsed = _parse(spark, lines)
    rej = {r.arrival: r.reject_reason for r in reject_rows(parsed, keep=["arrival"]).collect()}
    assert rej == {2: "malformed_json", 3: "malformed_json", 4: "blank_line", 5: "malformed_json",
                   6: "bad_dt", 7: "no_station"}
    good = {r.arrival: r for r in good_rows(parsed).collect()}
    assert good[0].station == "a" and good[0].uptime_seconds is None and good[0].hostname == "a"
    assert good[1].station == "h1" and good[1].hostname == "h1" and good[1].uptime_seconds == 5
    assert good[8].station == "s" and good[8].hostname == "s"
    assert good[0].dt == dt.datetime(2024, 7, 1)


def test_writer_side_station_defaults_to_dir(spark):
    df = spark.createDataFrame([("wx_a", '{"dt":"2024-07-01T00:00:00"}'),
                                ("wx_a", '{"dt":"2024-07-01T00:00:00","node":{"hostname":"h"}}')],
                               "station_dir string, line string")
    rows = good_rows(parse_lines(df, default_station="station_dir", keep=["station_dir"])).collect()
    assert sorted(r.station for r in rows) == ["h", "wx_a"]


def test_strict_json_and_bad_numbers(spark):
    good = '{"dt":"2024-07-01T00:00:00","station":"a"}'
    lines = [good + "\t", "\t" + good + " \r", "\t", good + " x", good + "}", good + good, good + "," + good, good.replace('"', "'"),
             good + '],"z":[{"b":1}', good[:-1] + ',"tags":["x]","y"]}', good[:-1] + ',"rain_inc_count":"x"}',
             good[:-1] + ',"node":{"millis":"soon"}}', good[:-1] + ',"temps_avg_f":" 7 "}', "null", "[" + good + "]", None]
    parsed = _parse(spark, lines)
    rej = {r.arrival: r.reject_reason for r in reject_rows(parsed, keep=["arrival"]).collect()}
    bad = "malformed_json"
    assert rej == {2: "blank_line", 3: bad, 4: bad, 5: bad, 6: bad, 7: bad, 8: bad, 10: "bad_number", 11: "bad_number", 13: bad, 14: bad, 15: "blank_line"}


def test_forwarded_line_has_no_space_left(spark):
    from skyroll.sources.kafka import enrich_line
    from pyspark.sql import functions as F
    import json
    df = spark.createDataFrame([('{"a":1}\t',), ("  {}\r\n",), ('\n{"a":"}"} ',)], "line string")
    got = [json.loads(r[0]) for r in df.select(enrich_line(F.col("line"), {"station": F.lit("s")})).collect()]
    assert got == [{"a": 1, "station": "s"}, {"station": "s"}, {"a": "}", "station": "s"}]


def test_generated_code_compiles(spark, tmp_path):
    """No method beyond 64 KB: the parse's generated code is compiled and not given up for interpreted rows."""
    log4j = spark._jvm.org.apache.logging.log4j
    name = "org.apache.spark.sql.catalyst.expressions.codegen.CodeGenerator"
    context = log4j.LogManager.getContext(False)
    layout = spark._jvm.org.apache.logging.log4j.core.layout.PatternLayout.createDefaultLayout()
    file = tmp_path / "codegen.log"
    appender = (spark._jvm.org.apache.logging.log4j.core.appender.FileAppender.newBuilder()
                .withFileName(str(file)).setName("codegen-test").setLayout(layout).build())
    appender.start()
    logger = context.getLogger(name)
    logger.addAppender(appender)
    try:
        df = spark.createDataFrame([(f'{{"dt":"2024-01-01T00:00:0{i}","station":"a","lux_avg_lx":{i}}}',) for i in range(5)], "line string")
        parsed = parse_lines(df)
        assert good_rows(parsed).count() == 5 and len(parsed.collect()) == 5 and reject_rows(parsed).count() == 0
    finally:
        logger.removeAppender(appender)
        appender.stop()
    assert "grows beyond" not in file.read_text()
