import math
import random
import zlib
from collections import Counter

import duckdb
import pytest
import regex
from pyspark.sql import functions as F

from skyroll.llm import langid

WORD = regex.compile(r"\p{L}[\p{L}\p{M}]{0,63}")
SYLLABLES = {"en": "the ing er and re on".split(), "de": "sch ein ung er ge ß".split(), "ja": "日 本 語 の は".split()}


def split(t):
    return WORD.findall((t or "").lower())


def grams(word, n):
    marked = word if n == 1 else f" {word} "
    return [marked[i : i + n] for i in range(len(marked) - n + 1)]


def brute_model(rows, entries):
    counts = {}
    for lang, text in rows:
        if lang is not None and text is not None:
            for w in split(text):
                counts.setdefault((lang, 0), Counter())[w] += 1
                for n in range(1, 6):
                    counts.setdefault((lang, n), Counter()).update(grams(w, n))
    total = {k: c.total() for k, c in counts.items()}
    langs = sorted({lang for lang, _ in counts}, key=lambda x: (-total[x, 0], x))
    known = {}
    for (lang, kind), c in counts.items():
        least = 2
        while sum(v >= least for v in c.values()) > entries // (6 * len(langs)):
            least *= 2
        top = max(total.get((x, kind), 0) for x in langs)
        for unit, n in c.items():
            if n >= least:
                known.setdefault((kind, unit), {})[lang] = math.floor(1000 * math.log(2 * top * n / total[lang, kind]) + 0.5)
    return langs, known


def brute_vote(known, word):
    if (0, word) in known:
        return known[0, word]
    for n in range(5, 0, -1):
        hits = [known[n, g] for g in grams(word, n) if (n, g) in known]
        if hits:
            sums = Counter()
            for h in hits:
                sums.update(h)
            return {x: v // len(hits) for x, v in sums.items()}
    return None


def brute(langs, known, text):
    words = split(text)
    if not words or not langs:
        return "und", 0.0
    total, votes = Counter({x: 0 for x in langs}), 0
    for w in words:
        vote = brute_vote(known, w)
        if vote is not None:
            total.update(vote)
            votes += 1
    best = max(langs, key=lambda x: (total[x], -langs.index(x)))
    score = 1 / sum(math.exp((total[x] - total[best]) / (1000 * max(votes, 1))) for x in langs)
    return best, math.floor(score * 1e6 + 0.5) / 1e6


def text_of(lang, rng, n):
    return " ".join("".join(rng.choices(SYLLABLES[lang], k=rng.randint(1, 3))) for _ in range(n))


@pytest.fixture
def labelled(documents, odd_rows):
    rng = random.Random(4)
    rows = [(100 + i, text_of(("en", "en", "de", "ja")[i % 4], rng, rng.randint(1, 60))) for i in range(60)]
    rows += odd_rows + [(50, "SCHEIN-schein É́ x2y 42 ²"), (51, "Ωμέγα"), (52, "42 !"), (53, "z" * 200 + " qq" * 90)]
    lang = F.expr(
        "CASE WHEN doc_id >= 100 AND doc_id % 4 < 2 THEN 'en' WHEN doc_id >= 100 AND doc_id % 4 = 2 THEN 'de'"
        " WHEN doc_id >= 100 THEN 'ja' WHEN doc_id IN (1, 50) THEN NULL WHEN doc_id = 3 THEN 'xx' ELSE 'en' END"
    )
    return documents(rows).withColumn("lang", lang).withColumn("score", F.lit(1))


@pytest.mark.parametrize(("entries", "flush"), [(langid.ENTRIES, langid.FLUSH_WORDS), (400, 20)])
def test_odd_rows(labelled, entries, flush, monkeypatch):
    monkeypatch.setattr(langid, "FLUSH_WORDS", flush)
    rows = [(r.doc_id, r.lang, r.text) for r in labelled.collect()]
    langs, known = brute_model([r[1:] for r in rows], entries)
    model = langid.learn(labelled, entries=entries)
    assert model.languages == langs and len(langs) == 3
    assert sum(len(k.gains) for k in model.kinds) == sum(map(len, known.values())) <= entries
    got = sorted(((r.doc_id, r.lang_pred, r.score) for r in langid.identify(labelled, model).collect()), key=str)
    assert got == sorted(((i, *brute(langs, known, t)) for i, _, t in rows), key=str)
    assert {"und", "de", "en", "ja"} == {x[1] for x in got}


def test_held_out_rows_are_not_learned(spark, documents):
    rows = [(i, f"word{chr(97 + i % 26)} " * 3) for i in range(60)]
    docs = documents(rows).withColumn("lang", F.expr("IF(crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 4 = 2, 'no', 'yes')"))
    marked = docs.withColumn("held_out", langid.held_out(F.col("doc_id")))
    assert {r.doc_id for r in marked.where("held_out").collect()} == {i for i in range(60) if zlib.crc32(str(i).encode()) % 4 == 2}
    model = langid.learn(marked.where("NOT held_out"))
    assert model.languages == ["yes"]
    assert {r.lang_pred for r in langid.identify(marked, model).collect()} == {"yes"}


def test_held_out_accuracy(spark):
    got = langid.op13_language(spark, "/root/testdata/sf0.001")
    labels = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "lang")
    right = got.where("held_out").join(labels, "doc_id").agg(F.avg(F.expr("CAST(lang_pred = lang AS INT)"))).first()[0]
    assert right >= 0.98


def test_long_texts_in_parts(monkeypatch):
    text = "Wort ab" * 500 + "x" * 300 + " Ende"
    whole = [w for part in langid.word_lists(text) for w in part]
    monkeypatch.setattr(langid, "PIECE", 64)
    parts = list(langid.word_lists(text))
    assert len(parts) > 3 and [w for part in parts for w in part] == whole == split(text)


def test_empty_tables(documents):
    empty = documents([])
    model = langid.learn(empty)
    assert model.languages == [] and langid.identify(empty, model).count() == 0
    assert [tuple(r) for r in langid.identify(documents([(1, "text"), (None, None)]), model).collect()] == [(1, "und", 0.0), (None, "und", 0.0)]
    learned = langid.learn(documents([(1, "text text")]))
    assert langid.identify(empty, learned).count() == 0


def test_sql_equals(labelled):
    con = duckdb.connect()
    con.register("documents", labelled.where("doc_id IS NOT NULL").drop("score").toArrow())
    marked = labelled.where("doc_id IS NOT NULL").withColumn("held_out", langid.held_out(F.col("doc_id")))
    got = langid.identify(marked, langid.learn(marked.where("NOT held_out")), keep=("doc_id", "held_out"))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(con.execute(langid.OP13_SQL).fetchall(), key=str)
