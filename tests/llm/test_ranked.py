import math
import random
import re

import duckdb
import numpy as np
import pytest

from skyroll.llm import ranked
from skyroll.llm.common import written

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def split(t):
    return TERM.findall("".join(chr(ord(x) + 32) if "A" <= x <= "Z" else x for x in t or ""))


def brute(docs, items, k=10):
    docs = [(i, w) for i, t in docs if (w := split(t))]
    n_docs, n_terms = len(docs), sum(len(w) for _, w in docs)
    of_item = {}
    for i, t in items:
        of_item.setdefault(i, set()).update(split(t))
    held = {t: sum(t in set(w) for _, w in docs) for t in set().union(*of_item.values(), ())}
    out = []
    for i, terms in of_item.items():
        found = []
        for key, words in docs:
            m = 100 - 90 + (90 * len(words) * n_docs) // n_terms
            score = 0
            for t in terms:
                if tf := words.count(t):
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * held[t] + 1)))
                    score += w * ((1000000000 * tf) // (1000 * tf + 8 * m))
            if score > 0:
                found.append((-score, ranked.NULL_KEY if key is None else key))
        for rank, (score, key) in enumerate(sorted(found)[:k], 1):
            out.append((i, rank, None if key == ranked.NULL_KEY else key, -score))
    return sorted(out, key=str)


def result(df):
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in df.collect()), key=str)


def items_frame(spark, items):
    return spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, score int")


ITEMS = [(1, "W1X30 w1x31 line W9X7 w9x29999"), (2, None), (3, "..."), (4, "日本語 LINE é"), (4, "a"), (None, "tail key cödé"), (5, "nowhere"), (1, "b"), (1, "b")]


def test_odd_rows(spark, documents, odd_rows):
    rows = odd_rows + [(11, "line " * 7), (10, "LINE-" * 7), (None, "tail tail"), (12, "b " * 70)]
    for size in (200, ranked.BLOCK_BYTES):
        blocks = written(ranked.index(documents(rows), block_bytes=size))
        assert result(ranked.search(blocks, items_frame(spark, ITEMS), k=3)) == brute(rows, ITEMS, 3)


def test_ties_and_many_copies(spark, documents):
    rng = random.Random(3)
    vocabulary = [f"t{i}" for i in range(40)]
    rows = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(1, 80)))) for i in range(400)]
    rows += [(1000 - i, rows[5][1]) for i in range(300)]
    items = [(i, " ".join(rng.choices(vocabulary, k=6))) for i in range(20)] + [(99, rows[5][1])]
    blocks = written(ranked.index(documents(rows).repartition(5), block_bytes=3000))
    assert blocks.count() > 10
    got = result(ranked.search(blocks, items_frame(spark, items)))
    assert got == brute(rows, items)
    assert len([r for r in got if r[0] == 99]) == 10


def test_items_in_several_parts(spark, documents, odd_rows, monkeypatch):
    monkeypatch.setattr(ranked, "QUERY_ITEMS", 2)
    blocks = written(ranked.index(documents(odd_rows)))
    assert result(ranked.search(blocks, items_frame(spark, ITEMS))) == brute(odd_rows, ITEMS)


def test_text_beyond_one_piece(monkeypatch):
    text = ("word " * 50 + "longer-and x" * 3 + " ende").encode()
    monkeypatch.setattr(ranked, "PIECE", 7)
    parts = list(ranked.pieces(text))
    assert b"".join(parts) == text and len(parts) > 20
    assert [t for p in parts for t in ranked.TERM.findall(p)] == ranked.TERM.findall(text)
    assert list(ranked.pieces(b"x" * 50)) == [b"x" * 50] and list(ranked.pieces(b"")) == [b""]


@pytest.mark.parametrize("seed", [1, 2])
def test_bounds_hold_and_exclude(seed):
    rng = random.Random(seed)
    block = ranked.Block()
    texts = [" ".join(f"w{int(rng.paretovariate(0.6))}" for _ in range(rng.randint(1, 400))) for _ in range(200)]
    for i, t in enumerate(texts):
        block.add(i, t)
    row = block.record().to_pylist()[0]
    names = [f"w{i}".encode() for i in range(1, 60)]
    weights = np.array([rng.randint(0, 9000) for _ in names])
    query = ranked.Query([0, 1], names, weights, [np.arange(0, 30), np.arange(20, 59)])
    keys = ranked.unpacked_keys(row["keys"])
    m = np.array([10 + len(texts[k].split()) for k in keys])
    got = ranked.bounds(row["groups"], query, ranked.hashes_of(names), m)
    loose = 0
    for j, k in enumerate(keys):
        words = texts[k].encode().split()
        for i, numbers in enumerate(query.of_item):
            true = sum(int(weights[n]) * ((10**9 * c) // (1000 * c + 8 * int(m[j]))) for n in numbers if (c := words.count(names[n])))
            assert got[i, j] >= true
            loose += got[i, j] > 1.5 * true + 1e9
    assert loose < 40


def test_empty_tables(spark, documents):
    empty, some = written(ranked.index(documents([]))), written(ranked.index(documents([(1, "a")])))
    assert ranked.search(empty, items_frame(spark, ITEMS)).count() == 0
    assert ranked.search(some, items_frame(spark, [])).count() == 0
    assert ranked.search(written(ranked.index(documents([(1, None), (2, "--")]))), items_frame(spark, ITEMS)).count() == 0


def test_sql_equals(spark, documents, odd_rows):
    rows = [r for r in odd_rows if r[0] is not None]
    con = duckdb.connect()
    con.register("documents", documents(rows).toArrow())
    con.register("benchmark", items_frame(spark, ITEMS).toArrow())
    assert sorted(con.execute(ranked.OP11_SQL).fetchall(), key=str) == brute(rows, ITEMS)
