import zlib

import numpy as np

from skyroll.llm import shard


def jump(key, n):
    key &= (1 << 64) - 1
    b, j = -1, 0
    while j < n:
        b = j
        key = (key * 2862933555777941757 + 1) & ((1 << 64) - 1)
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def test_jump_hash():
    keys = np.array([0, 1, -1, 2**62, -(2**63), *range(1000, 1200)])
    for n in (1, 2, 24, 25):
        assert shard.jump_hash(keys, n).tolist() == [jump(int(k), n) for k in keys]


def test_odd_rows(documents, odd_rows):
    rows = odd_rows + [(None, "t"), (None, None), (8, "x" * 100_000)] * 3
    got = shard.assign_shards(documents(rows), 5).collect()
    assert len(got) == len(rows)
    want = sorted(((k, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for k, t in rows), key=str)
    assert sorted(((r.doc_id, r["size"], r.text_crc32) for r in got), key=str) == want
    for r in got:
        key = shard.NULL_KEY if r.doc_id is None else r.doc_id
        assert (r.shard, r.grown_shard) == (jump(key, 5), jump(key, 6)) and r.law == "key"
        assert r.grown_shard in (r.shard, 5)
    for s in {r.shard for r in got}:
        mine = sorted((r for r in got if r.shard == s), key=lambda r: r.slot)
        assert [r.slot for r in mine] == list(range(len(mine)))
        order = [(shard.NULL_KEY if r.doc_id is None else r.doc_id, r.text_crc32, r["size"]) for r in mine]
        assert order == sorted(order)


def test_slots_over_many_levels(spark):
    ids = [0, 1, 4095, 4096, 1 << 20, (1 << 28) - 1, 1 << 28, 1 << 45, -1, -5000, -(1 << 50), 2**63 - 1]
    df = spark.createDataFrame([(i, "t") for i in ids], "doc_id long, text string")
    got = shard.assign_shards(df, 1).orderBy("slot").collect()
    assert [r.doc_id for r in got] == sorted(ids) and [r.slot for r in got] == list(range(len(ids)))


def test_many_copies_of_a_row(spark):
    df = spark.range(25_000).selectExpr("7L as doc_id", "'t' as text")
    got = shard.assign_shards(df, 3).agg({"slot": "max", "*": "count"}).first()
    assert tuple(got) in ((24_999, 25_000), (25_000, 24_999))


def test_empty_table(documents):
    assert shard.assign_shards(documents([]), 4).count() == 0
