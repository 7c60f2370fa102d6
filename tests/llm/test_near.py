import collections
import math
import random
import re

import numpy as np

from skyroll.llm import near


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def weights(rows):
    sets = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", lower(t))
        sets.append(collections.Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else collections.Counter())
    holders, n = collections.Counter(x for s in sets for x in s), len(rows)
    return [{x: c * (1 + near.RARITY * math.log(n / holders[x]) / math.log(max(n, 2))) for x, c in s.items()} for s in sets]


def jaccard(a, b):
    shared = sum(min(v, b[x]) for x, v in a.items() if x in b)
    return shared / (sum(a.values()) + sum(b.values()) - shared)


def classes(rows):
    w = weights(rows)
    part = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if w[i] and w[j] and jaccard(w[i], w[j]) >= near.THRESHOLD:
                a, b = part[i], part[j]
                part = [a if x == b else x for x in part]
    order = lambda k: (k is not None, k)
    least = {p: min((rows[i][0] for i in range(len(rows)) if part[i] == p), key=order) for p in part}
    return collections.Counter((rows[i][0], least[part[i]]) for i in range(len(rows)))


def edited(words, n, rng):
    words = list(words)
    for i in rng.sample(range(len(words)), n):
        words[i] = f"e{rng.random()}"
    return " ".join(words)


def test_odd_rows(documents, odd_rows):
    got = near.near_duplicates(documents(odd_rows)).collect()
    assert collections.Counter((r.doc_id, r.class_id) for r in got) == classes(odd_rows)
    assert all(r.kept == (r.class_id == r.doc_id) for r in got)


def test_groups_of_edited_copies(documents):
    rng = random.Random(3)
    rows = []
    for g in range(4):
        base = [f"g{g}w{i}" for i in range(150)]
        rows += [(len(rows) + i, edited(base, rng.randint(0, 6), rng)) for i in range(30)]
    passage = " ".join(f"p{i}" for i in range(60))
    rows += [(1000 + i, passage + " " + " ".join(f"q{i}x{j}" for j in range(100))) for i in range(30)]
    got = near.near_duplicates(documents(rows)).collect()
    assert collections.Counter((r.doc_id, r.class_id) for r in got) == classes(rows)
    assert all(r.class_id == r.doc_id for r in got if r.doc_id >= 1000)


def test_samples_agree_as_often_as_similar():
    rng = np.random.default_rng(5)
    hashes = np.sort(rng.integers(0, 2**63, 300, dtype=np.uint64))
    a, b = np.arange(0, 220), np.arange(80, 300)
    wa, wb = rng.integers(1, 4, 300).astype(float), rng.integers(1, 4, 300).astype(float)
    drawn = near.samples(np.concatenate((hashes[a], hashes[b])), np.concatenate((wa[a], wb[b])), np.array([0, 220, 440]))
    fa, fb = np.zeros(300), np.zeros(300)
    fa[a], fb[b] = wa[a], wb[b]
    true = np.minimum(fa, fb).sum() / np.maximum(fa, fb).sum()
    assert abs((drawn[0] == drawn[1]).mean() - true) < 4 * math.sqrt(true * (1 - true) / near.SAMPLES)


def test_pipeline_rows(documents, odd_rows):
    df = documents(odd_rows)
    out = near.without_near_duplicates(df)
    assert out.columns == df.columns
    got = collections.Counter(r.doc_id for r in out.collect())
    keep = classes(odd_rows)
    assert set(got) == {k for k, c in keep if k == c} and all(n == 1 for n in got.values())


def test_empty_table(documents):
    assert near.near_duplicates(documents([])).count() == 0
    assert near.without_near_duplicates(documents([])).count() == 0
