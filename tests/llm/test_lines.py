import collections
import random
import re

import numpy as np
import pyarrow as pa
import zstandard

from skyroll.llm import lines


def removed(rows, percent=80):
    order = lambda k: -(2**63) if k is None else k
    places = []
    for k, t in rows:
        for i, line in enumerate((t or "").split("\n")):
            if w := frozenset(re.findall(r"[^\x20\x09-\x0D]+", line)):
                places.append((order(k), i, w))
    out = set()
    for k, i, w in places:
        if any((a, b) < (k, i) and 100 * len(w & v) >= percent * len(w | v) for a, b, v in places):
            out.add((k, i))
    return out


def check(documents, rows):
    got = lines.dedup_lines(documents(rows)).collect()
    assert len(got) == len(rows)
    want = removed(rows)
    order = lambda k: -(2**63) if k is None else k
    assert {(order(r.doc_id), i) for r in got for i in r.removed} == want
    texts = collections.Counter()
    for k, t in rows:
        kept = None if t is None else "\n".join(x for i, x in enumerate(t.split("\n")) if (order(k), i) not in want)
        texts[k, kept] += 1
    assert texts == collections.Counter((r.doc_id, r.kept_text) for r in got)


def test_odd_rows(documents, odd_rows):
    check(documents, odd_rows)


def test_near_lines_in_a_large_group(documents):
    base = [f"b{i}" for i in range(12)]
    rows = [(i, " ".join(base[: i % 12] + [f"c{i}"] + base[i % 12 + 1 :]) + f"\nown{i} line{i}") for i in range(60)]
    rows += [(100 + i, " ".join(base[: i % 10] + [f"d{i}", f"e{i}"] + base[i % 10 + 2 :])) for i in range(40)]
    rows += [(200, " ".join(base)), (201, " ".join(reversed(base))), (202, "a b c d"), (203, "a b c d e"), (204, "a b c")]
    check(documents, rows)
    check(documents, [(500 - k, t) for k, t in rows])


def test_sketches_of_wide_sets_and_long_words(documents):
    base = [f"w{i}" for i in range(lines.WIDE + 30)]
    rows = [(i, " ".join([*base[: lines.WIDE - 2 + i], f"own{i}"])) for i in range(8)]
    rows += [(20 + i, " ".join([*base[:95], *[f"n{i}x{k}" for k in range(18 + i)]])) for i in range(8)]
    long = ["a" * n + z for n in (7, 8, 15, 16, lines.LONG - 1, lines.LONG, lines.LONG + 1, 300) for z in ("", "b", "\x01")]
    rows += [(40, " ".join(long)), (41, " ".join(long[:-4])), (42, " ".join([*long[:-8], *"cdefgh"])), (43, " ".join(long[:-8]) + "\n" + "\n \n" + long[0])]
    check(documents, rows)
    check(documents, [(500 - k, t) for k, t in rows])


def test_words_taken_for_one(documents, monkeypatch):
    rng = random.Random(4)
    rows = []
    for i in range(40):
        words = [f"v{rng.randrange(60)}" for _ in range(rng.randrange(4, 14))]
        rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join([*words[1:], f"n{i}"]) + "\n" + " ".join(words[::-1]))]
    for spared in (8, 20, 24):
        monkeypatch.setattr(lines, "SPARED_BITS", spared)
        check(documents, rows)


def block_of(texts):
    squeeze = zstandard.ZstdCompressor().compress
    rows = range(len(texts))
    return pa.table({"_key": rows, "_row": rows, "_text": pa.array([None if t is None else squeeze(t.encode()) for t in texts], pa.binary())})


def test_only_lines_that_meet_are_split_again():
    texts = ["a b\n\nc", None, "", "d\n", "\n \n\u00e9\te\x0bf"]
    block = lines.Block(block_of(texts))
    whole = [line for t in texts for line in (t or "").split("\n")]
    assert [block.data[a:b].tobytes().decode() for a, b in zip([0, *block.ends[:-1] + 1], block.ends)] == whole
    for some in ([0], [2], [0, 1, 2], [2, 5, 9], list(range(len(whole)))):
        assert block.only(np.array(some)).tobytes().decode() == "".join(whole[i] + "\n" for i in some)
    key, place = block.places(np.arange(len(whole)))
    assert list(zip(key, place)) == [(k, i) for k, t in enumerate(texts) for i in range(len((t or "").split("\n")))]


def test_order_by_cut_and_size():
    rng = np.random.default_rng(1)
    for top in (20, 63):
        cut = rng.integers(0, 1 << top, 200).astype(np.uint64)[rng.integers(0, 200, 500)]
        size, sketch = rng.integers(1, 1 << 12, 500), rng.integers(0, 9, 500).astype(np.uint64)
        order = np.argsort(lines.by_cut_and_size(cut, size, sketch))
        assert list(zip(cut[order], size[order])) == sorted(zip(cut, size))


def test_each_step_runs_once(documents, odd_rows):
    out = lines.dedup_lines(documents(odd_rows))
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    # reused exchanges are shown without what is below them
    assert plan.count("FlatMapCoGroupsInArrow") + plan.count("FlatMapGroupsInArrow") < 20, plan


def test_pipeline_rows(documents, odd_rows):
    df = documents(odd_rows)
    out = lines.with_lines_removed(df)
    assert out.columns == df.columns and out.schema["n_chars"].dataType == df.schema["n_chars"].dataType
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in out.collect())


def test_empty_table(documents):
    assert lines.dedup_lines(documents([])).count() == 0
