import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from skyroll.llm import quality


def counts(t):
    t = t or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    twice = {x for x in windows if windows.count(x) > 1}
    hit = {j for i, x in enumerate(windows) if x in twice for j in range(i, i + 3)}
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(hit))


def test_counts(odd_rows):
    rows = [t for _, t in odd_rows if len(t or "") < 5000] + ["a b c a b c", "a a a a", "# * $ %&|<>", "x\x0by z\x0cw", "é ö\xa0ü"]
    got = quality.count_texts(pa.array(rows, pa.string()))
    assert list(zip(*(got[n].tolist() for n in quality.NAMES), strict=True)) == [counts(t) for t in rows]


def prose(n, rng):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 8))) for _ in range(n))


def test_outliers_go_and_prose_stays(documents):
    rng = random.Random(1)
    rows = [(i, prose(rng.randint(60, 400), rng)) for i in range(300)]
    junk = [(1000 + i, " ".join(x + "$$$&&&" for x in prose(200, rng).split())) for i in range(20)]
    got = {r.doc_id: r for r in quality.judge(documents(rows + junk), ["doc_id"]).collect()}
    assert all(got[i].kept for i, _ in rows) and not any(got[i].kept or got[i].base_failed for i, _ in junk)
    again = {r.doc_id: r.distance for r in quality.judge(documents((rows + junk)[::-1]).repartition(7), ["doc_id"]).collect()}
    assert again == {i: r.distance for i, r in got.items()}  # the same bits in any order


def test_odd_rows(documents, odd_rows):
    got = quality.judge(documents(odd_rows), ["doc_id"]).collect()
    assert len(got) == len(odd_rows)
    for r in got:
        failed = r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words
        assert r.base_failed == failed and r.kept == (not failed)  # too few for an estimate


def test_pipeline_rows(documents, odd_rows):
    df = documents(odd_rows)
    out = quality.passing(df)
    assert out.columns == df.columns
    kept = {r.doc_id for r in quality.judge(df, ["doc_id"]).collect() if r.kept}
    assert sorted(map(str, out.collect())) == sorted(str(r) for r in df.collect() if r.doc_id in kept)


def test_empty_table(documents):
    assert quality.judge(documents([]), ["doc_id"]).count() == 0
    assert quality.passing(documents([])).count() == 0


@pytest.fixture
def grouped(spark):
    """Maker of a documents table from (doc_id, text, lang, source) rows."""
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    return lambda rows: spark.createDataFrame([(*r, len(r[1])) for r in rows], schema)


def spoilt(text, share, rng):
    return " ".join(x + rng.choice(["$$$", "###", "&&&", "***"]) if rng.random() < share else x for x in text.split())


def mixture(first, n, junk, share, rng, lang, source):
    """n rows, of which the last ``junk`` have symbols in a share of their words."""
    texts = [prose(rng.randint(60, 400), rng) for _ in range(n)]
    texts[n - junk :] = [spoilt(t, share, rng) for t in texts[n - junk :]]
    return [(first + i, t, lang, source) for i, t in enumerate(texts)]


def test_junk_up_to_nearly_half_of_a_group_goes(grouped):
    rng = random.Random(2)
    sizes = {0: 30, 1000: 60, 2000: 90}  # first id and junk rows of 200
    rows = [r for first, junk in sizes.items() for r in mixture(first, 200, junk, 1, rng, "en", f"s{first}")]
    kept = {r.doc_id for r in quality.judge(grouped(rows), ["doc_id"]).collect() if r.kept}
    for first, junk in sizes.items():
        assert not kept & set(range(first + 200 - junk, first + 200))
        assert len(kept & set(range(first, first + 200 - junk))) >= 0.97 * (200 - junk)


def test_part_junk_goes(grouped):
    rng = random.Random(3)
    rows = mixture(0, 200, 40, 0.3, rng, "en", "a") + mixture(1000, 200, 70, 0.5, rng, "en", "b")
    kept = {r.doc_id for r in quality.judge(grouped(rows), ["doc_id"]).collect() if r.kept}
    assert not kept & {*range(160, 200), *range(1130, 1200)}
    assert len(kept) >= 0.97 * (160 + 130)


def test_small_groups_follow_their_own_language(grouped):
    rng = random.Random(4)
    runs = lambda: " ".join("".join(rng.choice("かきくけこさしすせそ") for _ in range(rng.randint(8, 40))) for _ in range(rng.randint(60, 200)))
    rows = mixture(0, 300, 0, 0, rng, "en", "big") + mixture(1000, 20, 4, 1, rng, "en", "small")
    rows += [(first + i, runs(), lang, "s") for first, n, lang in ((2000, 59, "ja"), (3000, 60, "zh"), (4000, 4, "th")) for i in range(n)]
    rows += [(5000, rows[315 + 1][1], "en", "one")]  # alone in its source, junk
    kept = {r.doc_id for r in quality.judge(grouped(rows), ["doc_id"]).collect() if r.kept}
    assert {*range(2000, 2059), *range(3000, 3060), *range(4000, 4004), *range(1000, 1016)} <= kept
    assert not kept & {*range(1016, 1020), 5000}


def test_cutoff_by_rows():
    assert quality.cutoff(5) == float("inf") and abs(quality.cutoff(1e6) - quality.quantile(0.999)) < 0.2
    values = [quality.cutoff(n) for n in (6, 7, 10, 30, 59, 60, 200)]
    assert values == sorted(values, reverse=True) and values[4] / values[5] < 1.01


def vector(c):
    words, chars, symbols, lines, repeats = c
    x = (math.log(words) / 4, math.log((chars + 1) / words), math.sqrt(symbols / max(chars, 1)), repeats / (words + 50), math.log1p(lines) / 8)
    return [round(v * 4096) / 4096 for v in x]


def plain_mcd(x, rng, starts=60):
    """Distance and verdict of each row: the half with the least determinant over many starts, exact order statistics, reweighted."""
    n, p = x.shape
    h, floor = min(n, (n + p + 1) // 2), np.diag(np.array(quality.LEAST_SD) ** 2)

    def far(rows, factor):
        mean, cov = rows.mean(0), np.cov(rows.T, bias=True) * factor + floor
        away = x - mean
        return np.einsum("ij,jk,ik->i", away, np.linalg.inv(cov), away), np.linalg.det(cov)

    def spread(d):
        return max(1.0, np.sort(d)[(n + 1) // 2 - 1] / 4.35146)

    best = (math.inf, None)
    for _ in range(starts):
        near = rng.choice(n, min(n, p + 1), replace=False)
        for _ in range(15):
            near = np.argsort(far(x[near], quality.consistency(h / n))[0], kind="stable")[:h]
        d, det = far(x[near], quality.consistency(h / n))
        best = min(best, (det, d.tolist()))
    d = np.array(best[1])
    near = d <= 12.8325 * spread(d)
    d, _ = far(x[near], quality.consistency(0.975))
    return d, d <= spread(d) * quality.cutoff(int(near.sum()))


def test_against_plain_mcd(grouped):
    rng, random_rows = random.Random(5), np.random.default_rng(5)
    sizes = [(n, round(n * share)) for n in (6, 7, 12, 30, 60, 200, 500) for share in (0.05, 0.25, 0.45)]
    rows = []
    for g, (n, junk) in enumerate(sizes):  # a language each, so that its estimate is its group's
        rows += mixture(1000 * g, n, junk, 1 if n != 200 else 0.4, rng, f"l{g}", "s")
    texts = {r[0]: r[1] for r in rows}
    got = {r.doc_id: r for r in quality.judge(grouped(rows), ["doc_id"]).collect()}
    wrong = 0
    for g, (n, junk) in enumerate(sizes):
        ids = range(1000 * g, 1000 * g + n)
        d, kept = plain_mcd(np.array([vector(counts(texts[i])) for i in ids]), random_rows)
        wrong += sum(got[i].kept != k for i, k in zip(ids, kept, strict=True))
        clean = np.array([got[i].distance for i in ids[: n - junk]]) / np.maximum(d[: n - junk], 0.5)
        assert 0.8 < np.median(clean) < 1.25
    assert wrong <= 0.005 * len(rows)
