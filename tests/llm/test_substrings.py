import hashlib
import re

import duckdb
import pytest

from skyroll.llm import substrings


def brute(rows, size):
    split = [(k, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for k, t in rows]
    order = lambda k: -(2**63) if k is None else k
    first = {}
    for k, w in split:
        for s in range(len(w) - size + 1):
            x = tuple(w[s : s + size])
            first[x] = min(first.get(x, (order(k), s)), (order(k), s))
    out = []
    for k, w in split:
        gone = set()
        for s in range(len(w) - size + 1):
            if first[tuple(w[s : s + size])] < (order(k), s):
                gone.update(range(s, s + size))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((k, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest(), kept))
    return sorted(out, key=str)


@pytest.mark.parametrize("size", [2, 20])
def test_odd_rows_as_brute_force(documents, odd_rows, size):
    got = substrings.dedup_substrings(documents(odd_rows), size, with_text=True).collect()
    assert sorted([(r.doc_id, r.n_words, r.n_removed, r.kept_sha256, r.kept_text) for r in got], key=str) == brute(odd_rows, size)
    for r in got:
        assert sum(b - a for a, b in r.removed) == r.n_removed
        assert all(x[1] < y[0] for x, y in zip(r.removed, r.removed[1:], strict=False))  # maximal


def test_empty_table(documents):
    assert substrings.dedup_substrings(documents([])).count() == 0


def test_repeats_within_and_across(documents):
    a = " ".join(f"a{i}" for i in range(25))
    got = {r.doc_id: r for r in substrings.dedup_substrings(documents([(2, a), (1, a + " x " + a)])).collect()}
    assert got[1].n_removed == 25 and got[1].removed == [[26, 51]]
    assert got[2].n_removed == 25


def test_sql(spark):
    d = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{d}/documents.parquet'")
    cols = ["doc_id", "n_words", "n_removed", "kept_sha256"]
    want = con.sql(substrings.OP1_SQL).df()[cols]
    got = substrings.op1_substrings(spark, d).toPandas()[cols]
    assert sorted(map(tuple, got.values.tolist())) == sorted(map(tuple, want.values.tolist()))
