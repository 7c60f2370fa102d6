import __spark_entry__ as entry
from skyroll.plans.catalog import QUERIES


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert [f.name for f in df.schema.fields][:3] == ["window_name", "bucket_ts", "station"]


def test_every_query_of_the_catalog_has_an_oracle():
    q, o = entry.queries(), entry.oracle_sql()
    assert set(QUERIES) <= set(q) and set(QUERIES) <= set(o) <= set(q)
