import collections
import random
import zlib

import corpus_pipeline
import numpy as np
import public_tokenizers
from test_contamination import brute as contaminated
from test_lines import removed
from test_near import classes
from test_quality import counts
from tokenizers import Tokenizer


def rows():
    rng = random.Random(7)
    prose = lambda n, s: " ".join(f"{s}{rng.randint(0, 5000)}" for _ in range(n))
    shared = prose(12, "l")
    out = [(i, f"{prose(rng.randint(40, 90), 'a')}\n{shared} {'z' * (i % 2)}\n{prose(30, 'b')}") for i in range(20)]
    out += [(100 + i, out[i][1] + " end") for i in range(4)] + [(200, None), (201, ""), (202, "too short"), (203, "again " * 80)]
    out += [(300, prose(1500, "c")), (301, "keep " + prose(70, "d")), (302, "item " + " ".join(f"q{i}" for i in range(10)) + " " + prose(60, "e"))]
    return out


ITEMS = [(1, " ".join(f"Q{i}" for i in range(12))), (2, "never seen")]


def plain(docs, items):
    """The pipeline from line dedup up to packing, in plain Python."""
    gone = removed(docs)
    docs = [(k, "\n".join(x for i, x in enumerate(t.split("\n")) if (k, i) not in gone)) for k, t in docs]
    kept = {k for k, c in classes(docs) if k == c}
    docs = [(k, t) for k, t in docs if k in kept]
    dirty = {r[0] for r in contaminated(docs, items, 10) if r[5]}
    return [(k, t) for k, t in docs if k not in dirty]


def test_run_as_plain_python(spark, documents, tmp_path):
    docs = rows()
    assert corpus_pipeline.ORACLE_SQL is None and [n for n, _ in corpus_pipeline.STAGES][0] == "quality rules"
    spark.createDataFrame([(k, t, "en", "s", len(t or "")) for k, t in docs], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(ITEMS, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    # the outlier test's verdicts are taken as they are: the quality operator's own tests hold them
    passing = {r.doc_id for r in corpus_pipeline.quality_rules(spark, spark.read.parquet(f"{tmp_path}/documents.parquet"), str(tmp_path)).collect()}
    by_rule = {k for k, t in docs if (c := counts(t))[0] >= 50 and 100 * c[4] <= 50 * c[0]}
    assert passing <= by_rule and len(by_rule - passing) <= 2
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = collections.Counter()
    for k, t in plain([(k, t) for k, t in docs if k in passing], ITEMS):
        ids = np.array([*tokenizer.encode(t, add_special_tokens=False).ids, 2], dtype="<u4")
        first = len(ids) % 1024 or 1024 if len(ids) > 1024 else len(ids)
        for i, a in enumerate([0, *range(first, len(ids), 1024)]):
            piece = ids[a : a + (1024 if i else first)]
            want[k, i, a, len(piece), zlib.crc32(piece.tobytes())] += 1
    assert len({k for k, *_ in want}) > 15
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want


def test_stages_return_documents(spark, documents, tmp_path):
    spark.createDataFrame(ITEMS, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for docs in (documents(rows()), documents([])):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, str(tmp_path))
            assert out.columns == docs.columns and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema], name
            out.count()
