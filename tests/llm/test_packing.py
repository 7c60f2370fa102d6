import bisect
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from skyroll.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")
TOKENIZER = Tokenizer.from_file(PATH)


def coded(text):
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids


def test_ids_of_odd_texts():
    ids, rng = packing.Ids(PATH), random.Random(4)
    assert ids.ranks is not None
    for _ in range(2000):
        text = "".join(rng.choices(" \n\tab'sét\x1c 　日🙂1²%Ⅷ\r", k=rng.randint(0, 25))) + rng.choice(["", " the dog's 1st", "<|endoftext|>x"])
        assert ids.of(text) == np.array(coded(text), dtype="<u4").tobytes()


def test_plan_uses_each_piece_once_and_at_most_two_large():
    rng = random.Random(5)
    for _ in range(150):
        histogram = {rng.randint(1, 1024): rng.randint(1, 50) for _ in range(rng.randint(1, 80))}
        found: dict[int, int] = {}
        for g in packing.plan(histogram):
            assert g.lengths and g.count > 0 and sum(g.lengths) <= 1024 and sum(x > 341 for x in g.lengths) <= 2
            for x in g.lengths:
                found[x] = found.get(x, 0) + g.count
        assert found == histogram


def test_few_sequences():
    rng = random.Random(6)
    histogram = {x: rng.randint(1, 30) for x in range(1, 1025)}
    total = sum(x * n for x, n in histogram.items())
    singles = sum(n for x, n in histogram.items() if x > 512)
    assert sum(g.count for g in packing.plan(histogram)) <= 1.02 * max(total / 1024, singles) + 1


def item_by_item(lengths, capacity):
    """Room left in each sequence: large-item matching done one piece at a time."""
    third = capacity // 3
    large, small = sorted(x for x in lengths if x > third), sorted((x for x in lengths if x <= third), reverse=True)
    rooms = []
    while large:
        room = capacity - large.pop()
        if (i := bisect.bisect_right(large, room)) > 0:
            room -= large.pop(i - 1)
        rooms.append(room)
    rooms.sort()
    for x in small:
        i = bisect.bisect_left(rooms, x)
        bisect.insort(rooms, (rooms.pop(i) if i < len(rooms) else capacity) - x)
    return rooms


def test_plan_equals_item_by_item_matching():
    rng = random.Random(7)
    for capacity in (9, 10, 16, 100, 1024):
        for _ in range(150):
            most = rng.choice([capacity, capacity // 2, capacity // 3])
            lengths = [rng.randint(1, most) for _ in range(rng.randint(1, 400))]
            found = []
            for g in packing.plan(Counter(lengths), capacity):
                found += [capacity - sum(g.lengths)] * g.count
            assert sorted(found) == item_by_item(lengths, capacity)


@pytest.mark.parametrize("capacity", [16, 1024])
def test_odd_rows(documents, odd_rows, capacity):
    got = packing.pack(documents(odd_rows), PATH, capacity=capacity).collect()
    want = []
    for k, t in odd_rows:
        ids = coded(t) + [2]
        first = len(ids) % capacity or capacity if len(ids) > capacity else len(ids)
        for i, a in enumerate([0, *range(first, len(ids), capacity)]):
            piece = ids[a : a + (first if not i else capacity)]
            want.append((k, i, a, len(piece), zlib.crc32(np.array(piece, dtype="<u4").tobytes())))
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got), key=str) == sorted(want, key=str)
    bins = {}
    for r in got:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in bins.values():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end
            end += length
        assert end <= capacity
    assert sorted(bins) == list(range(len(bins)))


def test_empty_table(documents):
    assert packing.pack(documents([]), PATH).count() == 0
