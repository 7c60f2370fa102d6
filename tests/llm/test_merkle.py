import hashlib
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from skyroll.llm import merkle
from skyroll.llm.common import numbered


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(values):
    return sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def climb(nodes, fanout):
    """Root and each node's steps of (hashes before, hashes after)."""
    steps = [[] for _ in nodes]
    at = list(range(len(nodes)))
    while len(nodes) > 1:
        for i, a in enumerate(at):
            run = a // fanout * fanout
            steps[i].append(("".join(nodes[run:a]), "".join(nodes[a + 1 : run + fanout])))
            at[i] = a // fanout
        nodes = [sha(*nodes[i : i + fanout]) for i in range(0, len(nodes), fanout)]
    return nodes[0], steps


def brute(rows, fanout, cut):
    """Rows are (doc_id, source, lang, n_chars, text)."""
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append((r[0] is not None, r[0] or 0, leaf(r), leaf((*r[:4], cut(r)))))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = []
    for g in order:
        members = sorted(groups[g])
        trees.append((members, *climb([m[2] for m in members], fanout)))
    if not trees:
        return []
    root, above = climb([t[1] for t in trees], fanout)
    out = []
    for (members, top, steps), upper in zip(trees, above, strict=True):
        for m, path in zip(members, steps, strict=True):
            h = m[3]
            for before, after in path + upper:
                h = sha(before, h, after)
            out.append((m[1] if m[0] else None, m[2], top, root, [tuple(s) for s in path + upper], h, h == root))
    return sorted(out, key=str)


def result(df):
    return sorted(
        ((r.doc_id, r.leaf, r.subroot, r.root, [tuple(s) for s in r.steps], r.folded_root, r.verified) for r in df.collect()), key=str
    )


def cut(row):
    even = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0
    return row[4].replace("\n", "") if even and row[4] is not None else row[4]


def tampered():
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    return {"text": F.when(even, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))}


@pytest.mark.parametrize("fanout", [2, 3, 5])
def test_odd_rows(spark, documents, odd_rows, fanout):
    source = F.expr("CASE WHEN doc_id IN (3, 4) THEN NULL WHEN doc_id = 6 THEN 'é' WHEN doc_id = 5 THEN '' ELSE 'z' END")
    docs = documents(odd_rows + [(8, "x\ny")] * 3).withColumn("source", source)
    rows = [(r.doc_id, r.source, r.lang, r.n_chars, r.text) for r in docs.collect()]
    got = result(merkle.manifest(docs.withColumn("tree", F.lit(1)).withColumn("leaf", F.lit("")), fanout=fanout, tampered=tampered()))
    assert got == brute(rows, fanout, cut)
    assert any(r[-1] for r in got) and not all(r[-1] for r in got)


@pytest.mark.parametrize("n", [0, 1, 4, 28])
def test_sizes(spark, documents, n):
    docs = documents([(i, f"t{i}\n") for i in range(n)]).withColumn("source", F.expr("CASE WHEN doc_id < 3 THEN 'a' ELSE 'b' END"))
    rows = [(r.doc_id, r.source, r.lang, r.n_chars, r.text) for r in docs.collect()]
    assert result(merkle.manifest(docs, tampered=tampered())) == brute(rows, 3, cut)


def test_many_copies_of_a_row_are_leaves_of_their_own(spark):
    docs = spark.range(0, 2000, 1, 8).selectExpr("7L AS doc_id", "'s' AS source", "'en' AS lang", "1L AS n_chars", "'t' AS text")
    rows = merkle.manifest(docs).collect()
    want = brute([(7, "s", "en", 1, "t")] * 2000, 3, lambda r: r[4])
    assert len(rows) == 2000 and {r.root for r in rows} == {want[0][3]} and all(r.verified for r in rows)


def test_numbered_deals_equal_rows_out(spark):
    df = spark.range(0, 5000, 1, 8).selectExpr("IF(id % 100 = 0, NULL, 3L) AS k")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = numbered(df, ["k"], "at").collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sorted(r["at"] for r in got) == list(range(5000))
    assert max(r["at"] for r in got if r.k is None) == 49
    sizes = {}
    for r in got:
        sizes[r._part] = sizes.get(r._part, 0) + 1
    assert max(sizes.values()) < 3500


def test_sql_equals(spark, documents, odd_rows):
    rows = [(i, t) for i, t in odd_rows if i is not None] + [(i, f"a\nb {i}") for i in range(20, 60)]
    docs = documents(rows).withColumn("source", F.expr("IF(doc_id % 7 = 0, NULL, concat('s', doc_id % 5))"))
    con = duckdb.connect()
    con.register("documents", docs.select("doc_id", "text", "lang", "source", "n_chars").toArrow())
    want = sorted(con.execute(merkle.OP12_SQL).fetchall(), key=str)
    proof = F.sha2(F.array_join(F.transform("steps", lambda s: F.concat(s["left"], s["right"])), ""), 256)
    got = merkle.manifest(docs, tampered=tampered()).select("doc_id", "leaf", "subroot", "root", proof, "folded_root", "verified")
    assert sorted(map(tuple, got.collect()), key=str) == want
