import re
import zlib

import duckdb

from skyroll.llm import chat

COLUMNS = "conv_id long, turn long, role string, text string, perspective string, start int"


def brute(rows):
    out = []
    for conv in {r[0] for r in rows}:
        mine = [(c, -(2**63) if t is None else t, s or "unknown" if s is None else s, x or "") for c, t, s, x in rows if c == conv]
        mine.sort(key=lambda r: (r[1], zlib.crc32(f"{r[2]}\n{r[3]}".encode()), r[2], r[3]))
        for p in {r[2] for r in mine} - {"system"}:
            at = 0
            for seq, (_, _, s, x) in enumerate(mine):
                role = "system" if s == "system" else "assistant" if s == p else "user"
                name = s if role == "user" else None
                head = f"<|im_start|>{role}{'' if name is None else ' name=' + name}\n"
                segment = head + x + "<|im_end|>\n"
                mask = (at + len(head), at + len(segment) - 1) if role == "assistant" else (at, at)
                out.append((conv, p, seq, role, name, segment, at, *mask))
                at += len(segment)
    return sorted(out, key=str)


def result(df):
    return sorted((tuple(r) for r in df.select("conv_id", "perspective", "seq", "role", "name", "segment", "start", "mask_from", "mask_to").collect()), key=str)


def test_odd_rows(spark):
    rows = [(1, 0, "system", "be kind"), (1, 1, "ann", "hi 🙂"), (1, 2, "bob", None), (1, 3, "cy", ""), (1, 3, "ann", "tie"), (1, 3, "ann", "tie")]
    rows += [(2, 0, "system", "alone"), (None, None, None, "who"), (None, 4, "ann", "x" * 50_000), (3, -5, "user", "a\nb"), (3, 1 << 40, "assistant", "c")]
    df = spark.createDataFrame([(*r, "clash", 7) for r in rows], COLUMNS)
    assert result(chat.rotate(df)) == brute(rows)
    assert chat.rotate(df.limit(0)).count() == 0


def test_one_long_conversation(spark):
    rows = [(1, i, f"s{i % 3}", f"text {i}") for i in range(9000)]
    assert result(chat.rotate(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))) == brute(rows)


def test_sql_orders_repeated_turns_alike(spark):
    rows = [(1, t, s, x) for t in (2, None, 2) for s in ("ann", "bob", None, "system") for x in ("é 1", "two", "", None, "two")]
    con = duckdb.connect()
    con.sql("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    df = chat.rotate(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    names = ", ".join(df.columns)
    assert result(df) == sorted(con.sql(f"SELECT {names} FROM ({chat.OP2_SQL})").fetchall(), key=str)


def test_sql_and_no_python(spark):
    d = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.sql(f"CREATE VIEW conversations AS SELECT * FROM '{d}/conversations.parquet'")
    df = chat.op2_chat(spark, d)
    want = con.sql(chat.OP2_SQL).df()[df.columns].astype(object)
    got = df.toPandas().astype(object)
    assert sorted(map(str, got.where(got.notna(), None).values.tolist())) == sorted(map(str, want.where(want.notna(), None).values.tolist()))
    assert not re.search("Python|Pandas|Arrow", df._jdf.queryExecution().toString())
