"""Operator 10, line dedup: an exact set-similarity join of lines with prefix, positional and length filters.

A line is its set of words. Words are ordered by how rare they are in the whole
corpus, and two lines can only reach the threshold if they share a word in
their prefixes. Lines meet at these words. The length filter, the positional
filter and a bound from parity sketches of the sets first tell which postings
have a partner at all; only the lines of those are split again and sent whole,
and only for the pairs that longer sketches leave are the words compared. A
line goes if an earlier line is similar enough.

Equal sets meet by their hash and are joined only once. A line needs a single
similar earlier line, so each word's meeting place first names only the most
similar one; only for lines where that one fails are all others named. The
words of the earlier set are sent to where the later one's are, and compared
there. No group emits its pairs. The lines that go are told to the block by
their numbers, so their words are not made again.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyroll.llm import blocks as B
from skyroll.llm.common import table, tidy
from skyroll.llm.words import mix

#: Least Jaccard similarity, in percent.
PERCENT = 80
NULL_KEY = -(2**63)
#: Text in a block: more than elsewhere, as a word is sent once for each block that has it.
BLOCK_BYTES = 6 << 20
#: Words travel in so many bits fewer than keys elsewhere: two that are taken for one only let more lines meet, as
#: postings keep the place of each.
SPARED_BITS = 8
#: Words of more bytes are hashed one by one.
LONG = 64
#: Sets of more words have a second half of their sketch sent with their postings.
WIDE = 96

KEEP = np.array([(1 << 8 * n) - 1 for n in range(9)], dtype=np.uint64)


def words_in(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where words begin and end that \x20 and \x09-\x0D end."""
    inside = np.zeros(len(data) + 2, dtype=bool)
    np.greater(data - np.uint8(9), np.uint8(4), out=inside[1:-1])
    inside[1:-1] &= data != 32
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return edges[::2], edges[1::2]


#: Words hashed at once, few enough for a processor's cache.
HASHED = 1 << 14


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of words, taken eight bytes at a time."""
    out = np.empty(len(starts), np.uint64)
    padded = np.concatenate((data, np.zeros(8, np.uint8)))
    eight = np.ndarray(len(data), "<u8", padded, strides=(1,))
    for i in range(0, len(starts), HASHED):
        start, end = starts[i : i + HASHED], ends[i : i + HASHED]
        size = end - start
        part = mix(eight[start] & KEEP[np.minimum(size, 8)]) + size.astype(np.uint64)
        rest, at = np.flatnonzero(size > 8), 8
        while len(rest) and at < LONG:
            part[rest] = mix(part[rest] ^ (eight[start[rest] + at] & KEEP[np.minimum(size[rest] - at, 8)]))
            at += 8
            rest = rest[size[rest] > at]
        for k in rest.tolist():
            part[k] = int.from_bytes(hashlib.blake2b(data[start[k] : end[k]].tobytes(), digest_size=8).digest(), "little")
        out[i : i + HASHED] = mix(part)
    return out


def texts_of(docs: pa.Table) -> list[bytes | None]:
    """The texts of a block's rows as in_blocks() sent them."""
    expand = zstandard.ZstdDecompressor().decompress
    return [None if t is None else expand(t) for t in docs.column("_text").to_pylist()]


def joined_texts(texts: list[bytes | None]) -> np.ndarray:
    """All bytes of texts, with a newline after each."""
    return np.frombuffer(b"\n".join([*(t or b"" for t in texts), b""]), np.uint8)


def in_order(docs: pa.Table) -> pa.Table:
    """A block's rows, as they come, in an order that is the same whenever they are read; only rows of equal key and text may change places."""
    return docs.take(pa.array(np.lexsort((docs.column("_row").to_numpy(), row_keys(docs)))))


def row_keys(docs: pa.Table) -> np.ndarray:
    return docs.column("_key").fill_null(NULL_KEY).to_numpy().astype(np.int64)


class Block:
    """The bytes of a block's texts, and the key and the place in its text of each of its lines, which count through the block."""

    def __init__(self, docs: pa.Table):
        texts = texts_of(docs)
        self.data = joined_texts(texts)
        #: where each line ends
        self.ends = np.flatnonzero(self.data == 10)
        sizes = np.array([1 if t is None else len(t) + 1 for t in texts], dtype=np.int64)
        #: number of each text's first line
        self.first = np.searchsorted(self.ends, np.cumsum(sizes) - sizes)
        self.keys = row_keys(docs)

    def places(self, lines: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Key and place of lines."""
        doc = np.searchsorted(self.first, lines, side="right") - 1
        return self.keys[doc], lines - self.first[doc]

    def only(self, lines: np.ndarray) -> np.ndarray:
        """The bytes of these lines, with the newlines."""
        change = np.zeros(len(self.data) + 1, dtype=np.int8)
        change[np.where(lines > 0, self.ends[lines - 1] + 1, 0)] += 1
        change[self.ends[lines] + 1] -= 1
        return self.data[np.cumsum(change[:-1], dtype=np.int8).view(bool)]


def narrow(numbers: np.ndarray) -> np.ndarray:
    """Non-negative numbers in two bytes each if they fit: these are sorted in linear time."""
    return numbers.astype(np.uint16) if len(numbers) and numbers.max() < 1 << 16 else numbers


class Lines:
    """Lines that have words: their numbers, distinct words and set hashes; ``ends`` has where the lines of ``data`` end.

    The words of a line are in order of rarity if ``totals_of`` counts them (in order of hash), else in any order.
    """

    def __init__(self, data: np.ndarray, ends: np.ndarray, totals_of=None):
        word_starts, word_ends = words_in(data)
        codes, vocabulary = pd.factorize(word_hashes(data, word_starts, word_ends))
        if totals_of:
            order = np.argsort(vocabulary)
            totals = totals_of(vocabulary[order], np.bincount(codes, minlength=len(vocabulary))[order])
            rarest = np.argsort(narrow(totals), kind="stable")
            order, totals = order[rarest], totals[rarest]
            rank = np.empty(len(order), dtype=np.int64)
            rank[order] = np.arange(len(order))
            codes, vocabulary = rank[codes], vocabulary[order]
        count = np.diff(np.searchsorted(word_starts, ends), prepend=0)
        #: numbers of the lines that have words
        self.lines = np.flatnonzero(count)
        owner = np.repeat(np.arange(len(self.lines)), count[self.lines])
        both = np.sort(owner << 32 | codes)
        new = np.ones(len(both), dtype=bool)
        new[1:] = both[1:] != both[:-1]
        both = both[new]
        words = both & 0xFFFFFFFF
        #: distinct words of all lines, line by line, by their numbers in the vocabulary, and how often each of that comes
        self.words, self.vocabulary, self.totals = words, vocabulary, totals if totals_of else None
        self.size = np.bincount(both >> 32, minlength=len(self.lines))
        self.at = np.cumsum(self.size) - self.size
        add = lambda x: np.add.reduceat(x[words], self.at) if len(self.at) else np.zeros(0, np.uint64)
        self.one = mix(add(mix(vocabulary)))
        self.two = add(mix(vocabulary ^ np.uint64(0x2545F4914F6CDD1D)))

    def sketches(self, upper: bool = False) -> np.ndarray:
        """Parity sketches: the sets of two lines differ in at least as many words as these in bits.

        They have 64 bits, both halves of a longer sketch in one; or ``upper``, the upper half.
        """
        if not len(self.lines):
            return np.zeros(0, np.uint64)
        bit = np.uint64(1) << ((self.vocabulary >> np.uint64(8)) & np.uint64(63))
        if upper:
            bit *= (self.vocabulary >> np.uint64(14)) & np.uint64(1)
        return np.bitwise_xor.reduceat(bit[self.words], self.at)


class Sets:
    """Equal lines put together: ``heads`` has the earliest of each set, in order of set hash.

    ``members`` has the lines set by set, and ``members_at`` where each set's begin.
    """

    def __init__(self, x: Lines, key: np.ndarray, place: np.ndarray):
        self.members = np.lexsort((place, key, x.two, x.one))
        new = np.ones(len(self.members), dtype=bool)
        new[1:] = (np.diff(x.one[self.members]) != 0) | (np.diff(x.two[self.members]) != 0)
        self.heads = self.members[new]
        self.members_at = np.append(np.flatnonzero(new), len(self.members))
        head = self.heads[np.cumsum(new) - 1] if len(new) else self.members
        #: which members come after the head of their set
        self.later = (key[self.members] > key[head]) | (place[self.members] > place[head])


def spans(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers of these ranges, one range after the other."""
    return np.arange(sizes.sum()) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)


def shared_at_least(size_a: np.ndarray, size_b: np.ndarray, percent: int) -> np.ndarray:
    """Words that two sets of these sizes must share for the threshold."""
    return -(-percent * (size_a + size_b) // (100 + percent))


def table_of(rows: list[dict], schema: pa.Schema) -> pa.Table:
    return pa.table({n: pa.array([r.get(n) for r in rows], schema.field(n).type) for n in schema.names}, schema=schema)


def in_buckets(cuts: np.ndarray, plan: B.Layout) -> list[tuple[int, np.ndarray]]:
    """Buckets that have any of the cut keys, and which in order of key."""
    order = np.argsort(cuts)
    edges = B.bucket_edges(cuts[order], plan)
    return [(b, order[edges[b] : edges[b + 1]]) for b in np.flatnonzero(np.diff(edges)).tolist()]


def set_bucket(one: np.ndarray, plan: B.Layout) -> np.ndarray:
    """Bucket of a set's hash; these come after the words' buckets."""
    return ((one >> np.uint64(32)) % np.uint64(plan.buckets)).astype(np.int64) + plan.buckets


def schema_of(*binary: str) -> pa.Schema:
    return pa.schema([("bucket", pa.int32()), ("block", pa.int32()), *((c, pa.binary()) for c in binary)])


FIRST = schema_of("cut", "number", "pos", "size", "sketch", "id", "one", "two", "key", "place", "members", "lines", "later")
ALIVE = schema_of("number", "cut", "pos")
FULL = schema_of("cut", "one", "size", "pos", "low", "high", "key", "place", "lengths", "tokens")
GONE = pa.schema([("block", pa.int32()), ("lines", pa.binary())])
raw = lambda x: np.frombuffer(x, np.uint64)


def six_bytes(tokens: np.ndarray) -> bytes:
    """The upper 48 bits of hashes: enough to tell the words of two lines apart."""
    return tokens.astype("<u8").view(np.uint8).reshape(-1, 8)[:, 2:].tobytes()


def from_six_bytes(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 6, 8), dtype=np.uint8)
    out[:, 2:] = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return out.view("<i8").ravel()


def ddl(schema: pa.Schema) -> str:
    return ", ".join(f"{f.name} {'binary' if f.type == pa.binary() else 'int'}" for f in schema)


def prefixes(dealt: DataFrame, plan: B.Layout, percent: int) -> DataFrame:
    """FIRST rows: in the words' buckets the prefix words of the sets of each block, with short sketches; in the sets'
    buckets all sets, with the lines of each."""

    def counted(docs: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        data = joined_texts(texts_of(docs))
        return B.distinct_cuts(word_hashes(data, *words_in(data)), plan)

    def send(docs: pa.Table, answer: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return FIRST.empty_table()

        def totals(vocabulary: np.ndarray, counts: np.ndarray) -> np.ndarray:
            cuts = B.cut_keys(vocabulary, plan)
            new = np.ones(len(cuts), dtype=bool)
            new[1:] = cuts[1:] != cuts[:-1]
            summed = np.add.reduceat(counts, np.flatnonzero(new)) if len(cuts) else counts
            return B.totals_of(cuts[new], summed, answer, plan)[np.cumsum(new) - 1]

        block = Block(docs)
        x = Lines(block.data, block.ends, totals)
        key, place = block.places(x.lines)
        sets, number = Sets(x, key, place), docs.column("block")[0].as_py()
        heads = sets.heads
        size = x.size[heads]
        # a set of n words can be similar to an unequal one only if n of n + 1 words reach the threshold
        prefix = np.where(percent * (size + 1) <= 100 * size, np.minimum(size, size - (percent * size + 99) // 100 + 1), 0)
        at, who = spans(x.at[heads], prefix), np.repeat(np.arange(len(heads)), prefix)
        often = (x.totals > 1)[x.words[at]]
        at, who = at[often], who[often]
        cut, pos, line = B.cut_keys(x.vocabulary, plan)[x.words[at]], at - x.at[heads[who]], x.lines[heads[who]]
        sketch, ids = x.sketches()[heads], (x.one[heads] & np.uint64(0xFFFFFFFF)).astype("<u4")
        rows = [
            {"bucket": b, "block": number, "cut": B.rising(cut[i]), "number": B.packed(line[i]), "pos": B.packed(pos[i])}
            | {"size": B.packed(size[who[i]]), "sketch": sketch[who[i]].tobytes(), "id": ids[who[i]].tobytes()}
            for b, i in in_buckets(cut, plan)
        ]
        members = np.diff(sets.members_at)
        for b, i in rows_by(set_bucket(x.one[heads], plan)):
            at = spans(sets.members_at[i], members[i])
            of = heads[i]
            row = {"bucket": b, "block": number, "one": x.one[of].tobytes(), "two": x.two[of].tobytes(), "key": B.packed_keys(key[of])}
            row |= {"place": B.packed(place[of]), "lines": B.packed(x.lines[sets.members[at]])}
            if len(at) > len(i):  # else each set has one line
                row |= {"members": B.packed(members[i]), "later": B.packed(sets.later[at])}
            rows.append(row)
        return table_of(rows, FIRST)

    return B.with_answers(dealt, B.answers(dealt, plan, counted, lambda docs: docs), send, ddl(FIRST), in_order)


def by_cut_and_size(cut: np.ndarray, size: np.ndarray, sketch: np.ndarray) -> np.ndarray:
    """Numbers in order of cut and size, and as far as they have bits left of a hash of the sketch."""
    first = cut - cut.min()
    bits = int(size.max()).bit_length()
    left = 64 - bits - int(first.max()).bit_length()
    if left < 0:  # as numbers of the distinct pairs
        _, where = np.unique(np.stack((cut, size.astype(np.uint64))), axis=1, return_inverse=True)
        return where.ravel().astype(np.uint64)
    both = first << np.uint64(bits) | size.astype(np.uint64)
    return both << np.uint64(left) | mix(sketch) >> np.uint64(64 - left) if left else both


def alive(first: DataFrame, plan: B.Layout, percent: int) -> DataFrame:
    """ALIVE rows: postings that the filters leave at least one partner."""

    def meet(sent: pa.Table) -> pa.Table:
        if sent.column("bucket")[0].as_py() >= plan.buckets:
            return ALIVE.empty_table()
        col = {c: sent.column(c).to_pylist() for c in sent.column_names}
        cuts = [B.risen(c) for c in col["cut"]]
        cut = np.concatenate(cuts)
        number, pos, size = (np.concatenate([B.unpacked(x) for x in col[c]]).astype(np.int64) for c in ("number", "pos", "size"))
        sketch, ids = np.concatenate([raw(x) for x in col["sketch"]]), np.concatenate([np.frombuffer(x, "<u4") for x in col["id"]])
        order = np.argsort(by_cut_and_size(cut, size, sketch))
        c, s, k, i_, p = cut[order], size[order], sketch[order], ids[order], pos[order]
        new = np.ones(len(order), dtype=bool)  # copies of a set count once, if next to each other
        new[1:] = (c[1:] != c[:-1]) | (s[1:] != s[:-1]) | (i_[1:] != i_[:-1]) | (k[1:] != k[:-1]) | (p[1:] != p[:-1])
        c, s, k, p = c[new], s[new], k[new], p[new]
        found = np.zeros(len(c), dtype=bool)
        i, d = np.arange(len(c)), 0
        while len(i):
            d += 1
            i = i[i + d < len(c)]
            i = i[(c[i] == c[i + d]) & (percent * s[i + d] <= 100 * s[i])]
            j = i + d
            need = shared_at_least(s[i], s[j], percent)
            ok = (s[i] + s[j] - np.bitwise_count(k[i] ^ k[j])) // 2 >= need
            ok &= np.minimum(p[i], p[j]) + np.minimum(s[i] - p[i], s[j] - p[j]) >= need
            found[i[ok]] = found[j[ok]] = True
        lives = np.empty(len(order), dtype=bool)
        lives[order] = found[np.cumsum(new) - 1]
        ends = np.cumsum([len(x) for x in cuts])
        rows = []
        for block, n, end in zip(col["block"], map(len, cuts), ends, strict=True):
            at = np.flatnonzero(lives[end - n : end]) + end - n
            if len(at):
                rows.append({"bucket": sent.column("bucket")[0].as_py(), "block": block, "number": B.packed(number[at]), "cut": B.rising(cut[at]), "pos": B.packed(pos[at])})
        return table_of(rows, ALIVE)

    return first.groupBy("bucket").applyInArrow(tidy(meet), ddl(ALIVE))


def cells(dealt: DataFrame, first: DataFrame, plan: B.Layout, percent: int) -> DataFrame:
    """FULL rows of the sets with postings that live: in the words' buckets these postings, in the sets' buckets the words."""

    def send(docs: pa.Table, answer: pa.Table) -> pa.Table:
        if not docs.num_rows or not answer.num_rows:
            return FULL.empty_table()
        block, answers = Block(docs), answer.to_pylist()
        numbers = [B.unpacked(a["number"]).astype(np.int64) for a in answers]
        lines = np.unique(np.concatenate(numbers))
        data = block.only(lines)
        x = Lines(data, np.flatnonzero(data == 10))
        key, place = block.places(lines)
        both, high = x.sketches(), x.sketches(upper=True)
        wide = x.size > WIDE
        low = np.where(wide, both ^ high, both)
        number = docs.column("block")[0].as_py()
        rows = []
        for a, n in zip(answers, numbers, strict=True):
            i = np.searchsorted(lines, n)
            row = {"bucket": a["bucket"], "block": number, "one": x.one[i].tobytes(), "key": B.packed_keys(key[i]), "place": B.packed(place[i])}
            row |= {"cut": a["cut"], "pos": a["pos"], "size": B.packed(x.size[i]), "low": low[i].tobytes(), "high": high[i[wide[i]]].tobytes()}
            rows.append(row)
        for b, i in rows_by(set_bucket(x.one, plan)):
            tokens = six_bytes(x.vocabulary[x.words[spans(x.at[i], x.size[i])]])
            rows.append({"bucket": b, "block": number, "one": x.one[i].tobytes(), "lengths": B.packed(x.size[i]), "tokens": tokens})
        return table_of(rows, FULL)

    return B.with_answers(dealt, alive(first, plan, percent), send, ddl(FULL), in_order)


class Postings:
    """Postings of one bucket of words: one for each word and set, in order of word and size, with the set's first place.

    With ``wanted``, only those of words that the sets of these hashes have.
    """

    def __init__(self, sent: pa.Table, wanted: np.ndarray | None = None):
        col = {c: sent.column(c).to_pylist() for c in sent.column_names}
        join = lambda c, f: np.concatenate([f(x) for x in col[c]])
        cut, one, key = join("cut", B.risen), join("one", raw), join("key", B.unpacked_keys)
        size, pos, place = (join(c, B.unpacked).astype(np.int64) for c in ("size", "pos", "place"))
        low, high = join("low", raw), np.zeros(len(cut), np.uint64)
        high[size > WIDE] = join("high", raw)
        if wanted is not None:
            near = np.flatnonzero(np.isin(cut, cut[np.isin(one, wanted)]))
            cut, one, key, size, pos, place, low, high = (x[near] for x in (cut, one, key, size, pos, place, low, high))
        order = np.lexsort((place, key, pos, one, cut))
        new = np.ones(len(order), dtype=bool)
        new[1:] = (np.diff(cut[order]) != 0) | (np.diff(one[order]) != 0) | (np.diff(pos[order]) != 0)
        first = order[new]
        first = first[np.lexsort((one[first], size[first], cut[first]))]
        self.cut, self.one, self.key, self.place = cut[first], one[first], key[first], place[first]
        self.size, self.pos, self.low, self.high = size[first], pos[first], low[first], high[first]

    def pairs(self, percent: int):
        """Pairs (later, earlier, how alike their sketches are) that pass all filters, in parts."""
        i, d = np.arange(len(self.cut)), 0
        while len(i):
            d += 1
            i = i[i + d < len(self.cut)]
            i = i[(self.cut[i] == self.cut[i + d]) & (percent * self.size[i + d] <= 100 * self.size[i])]
            j = i + d
            total = self.size[i] + self.size[j]
            need = shared_at_least(self.size[i], self.size[j], percent)
            rest = np.minimum(self.pos[i], self.pos[j]) + np.minimum(self.size[i] - self.pos[i], self.size[j] - self.pos[j])
            low, high = self.low[i] ^ self.low[j], self.high[i] ^ self.high[j]
            # a short sketch is compared with both halves of a long one in one
            both = (self.size[i] > WIDE) == (self.size[j] > WIDE)
            differ = np.bitwise_count(np.where(both, low, low ^ high)).astype(np.int64) + np.bitwise_count(np.where(both, high, np.uint64(0)))
            shared = (total - differ) // 2
            same = (self.key[i] == self.key[j]) & (self.place[i] == self.place[j])
            ok = (rest >= need) & (shared >= need) & ~same
            a, b = i[ok], j[ok]
            swap = (self.key[a] < self.key[b]) | ((self.key[a] == self.key[b]) & (self.place[a] < self.place[b]))
            yield np.where(swap, b, a), np.where(swap, a, b), shared[ok] * 1000 // total[ok]


#: What is sent between the buckets of words and of sets.
MAIL = pa.schema([(c, pa.int32()) for c in ("bucket", "kind", "source")] + [(c, pa.binary()) for c in ("x", "y", "n", "more")])
TOLD = pa.schema([("bucket", pa.int32()), ("x", pa.binary())])
ASKS, PAIRS, SOURCES, WORDS = range(4)


def rows_by(to: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """Each bucket of ``to``, and which numbers have it."""
    order = np.argsort(narrow(to), kind="stable")
    starts = np.flatnonzero(np.diff(to[order], prepend=-1))
    return [(int(to[order[a]]), order[a:b]) for a, b in zip(starts, np.append(starts[1:], len(order)), strict=True)]


def joined(rows: list[dict], column: str, read=raw) -> np.ndarray:
    return np.concatenate([read(r[column]) for r in rows]) if rows else np.zeros(0, np.uint64)


def candidates(p: Postings, x: np.ndarray, y: np.ndarray, score: np.ndarray, more: np.ndarray, source: int, plan: B.Layout) -> pa.Table:
    """MAIL rows of pairs to the buckets of their later sets."""
    one, two = p.one[x], p.one[y]
    return table_of(
        [
            {"bucket": b, "kind": PAIRS, "source": source, "x": one[i].tobytes(), "y": two[i].tobytes(), "n": B.packed(score[i]), "more": B.packed(more[i])}
            for b, i in rows_by(set_bucket(one, plan))
        ],
        MAIL,
    )


class Held:
    """Words of sets by their hashes."""

    def __init__(self, one: np.ndarray, lengths: np.ndarray, tokens: np.ndarray):
        at = np.cumsum(lengths) - lengths
        full = np.flatnonzero(lengths)
        self.one, first = np.unique(one[full], return_index=True)
        self.at, self.size, self.tokens = at[full[first]], lengths[full[first]], tokens

    def of(self, ones: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The words of these sets, one set after the other, and the number of words of each."""
        i = np.searchsorted(self.one, ones)
        size = self.size[i]
        return self.tokens[np.arange(size.sum()) + np.repeat(self.at[i] - (np.cumsum(size) - size), size)], size


def held_by(rows: list[dict], one: str, lengths: str, tokens: str) -> Held:
    return Held(joined(rows, one), joined(rows, lengths, B.unpacked).astype(np.int64), joined(rows, tokens, from_six_bytes).view(np.uint64))


#: Pairs compared at once.
AT_ONCE = 1 << 14


def reaching(x: Held, y: Held, later: np.ndarray, earlier: np.ndarray, percent: int) -> np.ndarray:
    """Which pairs of sets reach the threshold, by their words."""
    out = [np.zeros(0, dtype=bool)]
    for a in range(0, len(later), AT_ONCE):
        (one, m), (two, n) = x.of(later[a : a + AT_ONCE]), y.of(earlier[a : a + AT_ONCE])
        pair = np.concatenate((np.repeat(np.arange(len(m)), m), np.repeat(np.arange(len(n)), n))).astype(np.uint64)
        words = np.sort(pair << np.uint64(48) | np.concatenate((one, two)) >> np.uint64(16))
        shared = np.bincount((words[1:][words[1:] == words[:-1]] >> np.uint64(48)).astype(np.int64), minlength=len(m))
        out.append(shared * (100 + percent) >= (m + n) * percent)
    return np.concatenate(out)


def similar(posted: DataFrame, plan: B.Layout, percent: int) -> DataFrame:
    """TOLD rows: in the sets' buckets the hashes of sets with a similar set that comes earlier."""

    def most_similar(sent: pa.Table) -> pa.Table:
        bucket = sent.column("bucket")[0].as_py()
        if bucket >= plan.buckets:
            return MAIL.empty_table()
        p = Postings(sent)
        best, score, number = (np.full(len(p.cut), v, dtype=np.int64) for v in (-1, -1, 0))
        for later, earlier, close in p.pairs(percent):
            number += np.bincount(later, minlength=len(number))
            order = np.lexsort((earlier, -close, later))
            later, earlier, close = later[order], earlier[order], close[order]
            lead = np.ones(len(later), dtype=bool)
            lead[1:] = np.diff(later) != 0
            later, earlier, close = later[lead], earlier[lead], close[lead]
            better = close > score[later]
            best[later[better]], score[later[better]] = earlier[better], close[better]
        x = np.flatnonzero(best >= 0)
        return candidates(p, x, best[x], score[x], number[x] > 1, bucket, plan)

    def all_others(sent: pa.Table, asked: pa.Table) -> pa.Table:
        if not asked.num_rows or not sent.num_rows or (bucket := sent.column("bucket")[0].as_py()) >= plan.buckets:
            return MAIL.empty_table()
        sets = joined(asked.to_pylist(), "x")
        p = Postings(sent, sets)
        wanted = np.isin(p.one, sets)
        none = np.zeros(0, np.int64)
        parts = [(none, none)] + [(later[wanted[later]], earlier[wanted[later]]) for later, earlier, _ in p.pairs(percent)]
        x, y = (np.concatenate([part[i] for part in parts]) for i in (0, 1))
        return candidates(p, x, y, np.zeros_like(x), np.zeros_like(x), bucket, plan)

    def asking(best: bool):
        def ask(sent: pa.Table) -> pa.Table:
            """The pairs to compare, the most similar one of each set or all, with the buckets that know more, and what asks for words."""
            rows, bucket = sent.to_pylist(), sent.column("bucket")[0].as_py()
            x, y, score, more = joined(rows, "x"), joined(rows, "y"), joined(rows, "n", B.unpacked), joined(rows, "more", B.unpacked) > 0
            order = np.lexsort((y, score, x))
            last = np.ones(len(order), dtype=bool)
            last[:-1] = (np.diff(x[order]) != 0) if best else (np.diff(x[order]) != 0) | (np.diff(y[order]) != 0)
            chosen = order[last]
            later, earlier = x[chosen], y[chosen]
            out = [{"bucket": bucket, "kind": PAIRS, "x": later.tobytes(), "y": earlier.tobytes()}]
            wanted = np.unique(earlier)
            out += [{"bucket": b, "kind": ASKS, "source": bucket, "x": wanted[i].tobytes()} for b, i in rows_by(set_bucket(wanted, plan))]
            if best:
                at = np.searchsorted(later, x)
                others = np.zeros(len(later), dtype=bool)
                others[at[more | (y != earlier[at])]] = True
                sizes = [len(raw(r["x"])) for r in rows]
                for r, here in zip(rows, np.split(at, np.cumsum(sizes)[:-1]), strict=True):
                    if others[here].any():
                        out.append({"bucket": bucket, "kind": SOURCES, "source": r["source"], "n": B.packed(here[others[here]])})
            return table_of(out, MAIL)

        return ask

    def answer(sent: pa.Table, asked: pa.Table) -> pa.Table:
        """The words that are asked for, to where they are; the rest goes on."""
        if not asked.num_rows or not sent.num_rows:
            return MAIL.empty_table()
        rows = asked.to_pylist()
        held, out = held_by(sent.to_pylist(), "one", "lengths", "tokens"), [r for r in rows if r["kind"] != ASKS]
        for r in rows:
            if r["kind"] == ASKS:
                tokens, size = held.of(raw(r["x"]))
                out.append({"bucket": r["source"], "kind": WORDS, "x": r["x"], "n": B.packed(size), "more": six_bytes(tokens)})
        return table_of(out, MAIL)

    def judge(sent: pa.Table, got: pa.Table) -> pa.Table:
        """The sets that go, and to the buckets that know more those that stay so far."""
        if not got.num_rows or not sent.num_rows:
            return TOLD.empty_table()
        rows, bucket = got.to_pylist(), got.column("bucket")[0].as_py()
        of = lambda kind: [r for r in rows if r["kind"] == kind]
        later, earlier = joined(of(PAIRS), "x"), joined(of(PAIRS), "y")
        ok = reaching(held_by(sent.to_pylist(), "one", "lengths", "tokens"), held_by(of(WORDS), "x", "n", "more"), later, earlier, percent)
        out = [{"bucket": bucket, "x": np.unique(later[ok]).tobytes()}]
        for r in of(SOURCES):
            at = B.unpacked(r["n"]).astype(np.int64)
            out.append({"bucket": r["source"], "x": later[at[~ok[at]]].tobytes()})
        return table_of([r for r in out if r["x"]], TOLD)

    def judged(found: DataFrame, best: bool) -> DataFrame:
        asked = found.groupBy("bucket").applyInArrow(tidy(asking(best)), ddl(MAIL))
        words = posted.groupBy("bucket").cogroup(asked.groupBy("bucket")).applyInArrow(tidy(answer), ddl(MAIL))
        # dealt out here, so that what reads it twice does not run it twice
        return posted.groupBy("bucket").cogroup(words.groupBy("bucket")).applyInArrow(tidy(judge), ddl(TOLD)).repartition("bucket")

    firsts = judged(posted.groupBy("bucket").applyInArrow(tidy(most_similar), ddl(MAIL)), True)
    others = posted.groupBy("bucket").cogroup(firsts.groupBy("bucket")).applyInArrow(tidy(all_others), ddl(MAIL))
    return firsts.union(judged(others, False))


def dedup_lines(df: DataFrame, percent: int = PERCENT, key: str = "doc_id", text: str = "text", more: tuple[str, ...] = ()) -> DataFrame:
    """One row per input row: ``key``, ``more`` columns, n_lines, n_removed, removed, kept_text.

    Lines are the parts between newlines that have a word; words end at white
    space. A line is removed if the Jaccard similarity of its set of words with
    that of an earlier line (smaller key, or same key and earlier) is at least
    ``percent``; all lines of the input count as earlier ones, also removed ones.
    ``removed`` has the numbers, from 0, of the lines removed; the others,
    wordless ones too, stay as they are, joined by newlines. A null key is
    smaller than all others; lines at the same key and place are neither earlier
    nor later, so repeated rows lose the same lines. A null text stays null and
    an empty one empty; other columns are ignored; an empty table gives no rows.
    """
    plan = B.layout(df, text, BLOCK_BYTES)
    # what a bucket gets is small beside the text: half as many make half as many packed rows
    plan = plan._replace(buckets=max(B.LEAST_BUCKETS, -(-plan.buckets // 2)), bits=plan.bits - SPARED_BITS)
    names = tuple(f"_more{i}" for i in range(len(more)))
    row = F.xxhash64(df[key].cast("long"), df[text].cast("string")).alias("_row")
    dealt = B.in_blocks(df.select(key, text, row, *[df[c].alias(n) for c, n in zip(more, names, strict=True)]), plan, key, text, ("_row", *names))

    first = prefixes(dealt, plan, percent)
    told = similar(cells(dealt, first, plan, percent), plan, percent)

    def verdicts(sent: pa.Table, gone: pa.Table) -> pa.Table:
        """Lines of each block that go: of sets equal to an earlier one or similar, and those that come later in the block."""
        if not sent.num_rows or sent.column("bucket")[0].as_py() < plan.buckets:
            return GONE.empty_table()
        rows = sent.to_pylist()
        one, two, key, place = joined(rows, "one"), joined(rows, "two"), joined(rows, "key", B.unpacked_keys), joined(rows, "place", B.unpacked)
        order = np.lexsort((place, key, two, one))
        new = np.ones(len(order), dtype=bool)
        new[1:] = (np.diff(one[order]) != 0) | (np.diff(two[order]) != 0)
        first = order[new][np.cumsum(new) - 1]
        goes = np.zeros(len(order), dtype=bool)
        goes[order] = (key[order] > key[first]) | (place[order] > place[first])
        goes |= np.isin(one, joined(gone.to_pylist(), "x"))
        out, end = [], 0
        for r in rows:
            n = len(raw(r["one"]))
            going = goes[end : end + n]
            end += n
            if r["members"] is not None:
                going = np.repeat(going, B.unpacked(r["members"]).astype(np.int64)) | (B.unpacked(r["later"]) > 0)
            if going.any():
                out.append({"block": r["block"], "lines": B.packed(B.unpacked(r["lines"])[going])})
        return table_of(out, GONE)

    judged = first.groupBy("bucket").cogroup(told.groupBy("bucket")).applyInArrow(tidy(verdicts), ddl(GONE))

    def remove(docs: pa.Table, answer: pa.Table) -> pa.Table:
        texts, start, a = texts_of(docs), 0, 0
        n_lines, removed, goes = [], [], np.sort(joined(answer.to_pylist(), "lines", B.unpacked)).tolist()
        for i, text in enumerate(texts):
            lines = (text or b"").split(b"\n")
            b = bisect_left(goes, start + len(lines), a)
            drop = [n - start for n in goes[a:b]]
            start, a = start + len(lines), b
            n_lines.append(sum(map(bool, map(bytes.strip, lines))))
            removed.append(drop)
            if drop:
                gone = set(drop)
                texts[i] = b"\n".join([line for k, line in enumerate(lines) if k not in gone])
        return pa.table(
            {
                "_key": docs.column("_key").combine_chunks(),
                **{n: docs.column(n).combine_chunks() for n in names},
                "n_lines": pa.array(n_lines, pa.int64()),
                "n_removed": pa.array([len(r) for r in removed], pa.int64()),
                "removed": pa.array(removed, pa.list_(pa.int64())),
                "kept_text": pa.array(texts, pa.binary()).cast(pa.string()),
            }
        )

    kinds = "".join(f", {n} {dealt.schema[n].dataType.simpleString()}" for n in names)
    out = B.with_answers(dealt, judged, remove, f"_key long{kinds}, n_lines long, n_removed long, removed array<long>, kept_text string", in_order)
    return out.withColumnsRenamed({"_key": key, **dict(zip(names, more, strict=True))})


def with_lines_removed(df: DataFrame, key: str = "doc_id", text: str = "text", length: str = "n_chars") -> DataFrame:
    """All rows of ``df`` with the kept lines as their text, and its code points as ``length`` if there is that column."""
    others = [c for c in df.columns if c not in (key, text)]
    names = tuple(f"_in{i}" for i in range(len(others)))
    marked = df.select(df[key].alias("_k"), df[text].alias("_t"), *[df[c].alias(n) for c, n in zip(others, names, strict=True)])
    out = dedup_lines(marked, PERCENT, "_k", "_t", names)
    of = dict(zip(others, names, strict=True))
    value = {key: F.col("_k"), text: F.col("kept_text")} | {c: F.col(n) for c, n in of.items()}
    if length in of:
        value[length] = F.char_length("kept_text").cast(df.schema[length].dataType)
    return out.select(*[value[c].alias(c) for c in df.columns])


def op10_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without lines similar to an earlier one; the kept text as its hash."""
    out = dedup_lines(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("kept_text", F.lit("")), 256).alias("kept_sha256"))
