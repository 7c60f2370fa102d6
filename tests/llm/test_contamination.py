import hashlib
import random
import re

import duckdb

from skyroll.llm import contamination as c

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def split(t):
    return WORD.findall("".join(chr(ord(x) + 32) if "A" <= x <= "Z" else x for x in t or ""))


def brute(docs, items, size, slop=0):
    out = []
    windows = {(i, tuple(w[s : s + size])) for i, t in items if (w := split(t)) for s in range(max(1, len(w) - size + 1))}
    for k, t in docs:
        w = split(t)
        hit, found = set(), set()
        for i, x in windows:
            for s in range(len(w) if slop else len(w) - len(x) + 1):
                if slop:
                    ok = all(x[j] in w[max(0, s + j - slop) : s + j + slop + 1] for j in range(len(x)))
                else:
                    ok = tuple(w[s : s + len(x)]) == x
                if ok:
                    hit.update(range(s, s + len(x)))
                    found.add(i)
        ids = ",".join(sorted(str(i) for i in found if i is not None))
        out.append((k, len(w), len(hit), len(found - {None}), hashlib.sha256(ids.encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def items_frame(spark, items):
    return spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, at int")


def result(df):
    return sorted(((r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in df.collect()), key=str)


def test_odd_rows(spark, documents, odd_rows):
    items = [(1, " ".join(f"W1X{i}" for i in range(30, 45))), (2, None), (3, "..."), (3, "Line"), (None, "tail"), (20, "日本語 日本語"), (3, "Line"), (4, "w9x5 w9x7")]
    got = c.decontaminate(documents(odd_rows), items_frame(spark, items))
    assert result(got) == brute(odd_rows, items, 10)
    kept = c.clean(documents(odd_rows), items_frame(spark, items))
    clean = {r[0] for r in brute(odd_rows, items, 10) if not r[5]}
    assert sorted(map(str, kept.collect())) == sorted(str(r) for r in documents(odd_rows).collect() if r.doc_id in clean)


def test_frequent_words_and_overlaps(spark, documents):
    rng = random.Random(8)
    docs = [(i, " ".join(rng.choices("the of And to x1 y2".split(), k=60))) for i in range(30)]
    items = [(i, " ".join(rng.choices("the of and to".split(), k=rng.randint(1, 12)))) for i in range(12)] + [(50, docs[3][1]), (51, docs[3][1] + " end")]
    assert result(c.decontaminate(documents(docs), items_frame(spark, items), size=4)) == brute(docs, items, 4)


def test_proximity(spark, documents):
    rng = random.Random(9)
    docs = [(i, " ".join(rng.choices([f"t{j}" for j in range(12)], k=40))) for i in range(12)]
    items = [(i, " ".join(rng.sample([f"t{j}" for j in range(12)], 4))) for i in range(8)]
    got = c.decontaminate(documents(docs), items_frame(spark, items), size=4, slop=2)
    want = {(k, i) for k, t in docs for i, x in items if brute([(k, t)], [(i, x)], 4, 2)[0][5]}
    assert {(r.doc_id, int(m.item)) for r in got.collect() for m in r.found} == want


def test_empty_tables(spark, documents, odd_rows):
    assert c.decontaminate(documents([]), items_frame(spark, [(1, "a b")])).count() == 0
    assert not any(r.contaminated for r in c.decontaminate(documents(odd_rows), items_frame(spark, [])).collect())


def test_sql_and_no_python(spark):
    d = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{d}/{t}.parquet'")
    df = c.op6_decontamination(spark, d)
    want = con.sql(c.OP6_SQL).df()[df.columns]
    assert sorted(map(str, df.toPandas().values.tolist())) == sorted(map(str, want.values.tolist()))
    plan = df._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_clean_sends_no_text_on(spark, documents, odd_rows):
    kept = c.clean(documents(odd_rows), items_frame(spark, [(1, " ".join(f"W1X{i}" for i in range(30, 45)))]))
    assert kept.count() == 7
    assert "Exchange hashpartitioning" not in kept._jdf.queryExecution().executedPlan().toString()
