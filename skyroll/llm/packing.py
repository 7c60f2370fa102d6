"""Operator 8, best-fit packing with large-item matching.

Texts become ids and pieces in one pass. Which lengths share a sequence is
planned from the histogram of piece lengths alone (at most 1,024 numbers, for
any input): pieces above a third of the capacity are matched greedily, at most
two in a sequence, and shorter ones, longest first, go where they leave the
least room. The plan says how many sequences of each make-up there are; the
pieces of a length take those places by their gapless rank.
"""

from __future__ import annotations

import json
import re
import zlib
from array import array
from collections.abc import Iterator
from pathlib import Path
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyroll.llm.common import checkpointed, gapless_starts, ship, table
from skyroll.llm.quality import slices

CAPACITY, END_ID = 1024, 2
#: Chunks of text whose ids a task remembers; it forgets all when full. Results don't depend on it.
REMEMBERED = 400_000
NULL_KEY = -(2**63)


#: Fixed value: how the byte-level tokenizer of the file cuts a text before it merges bytes.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: White space other than a space or newline.
OTHER_SPACE = re.compile(r"[^\S \n]")


def byte_ranks(path: str) -> tuple[dict[bytes, int], list[str]] | None:
    """Vocabulary of a byte-level BPE file as bytes with ranks, and its added tokens.

    None if the file is of another kind, or its merges aren't in the order of
    their ids, which ranks stand for.
    """
    spec = json.loads(Path(path).read_text())
    model, pre = spec["model"], spec.get("pre_tokenizer") or {}
    if model["type"] != "BPE" or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True) or spec.get("normalizer"):
        return None
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    byte_of = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}
    added = [t["content"] for t in spec.get("added_tokens", [])]
    ranks = {bytes(byte_of[c] for c in token): i for token, i in model["vocab"].items() if token not in added}
    merged = [model["vocab"]["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
    return (ranks, added) if merged == sorted(merged) else None


class Ids(dict):
    """Ids, as bytes, of each chunk of text after a space, filled as chunks come.

    The pre-tokenizer never joins a word to the space after it, so a text whose
    spaces all stand alone between other characters falls into chunks that can
    be tokenized apart; any other text is tokenized whole. A byte-level BPE file
    is read as ranks, which give the same ids sooner; texts with an added token
    and other kinds of file go through the file's own tokenizer.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.ranks, self.added = None, []
        if found := byte_ranks(path):
            import tiktoken

            ranks, self.added = found
            self.ranks = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> bytes:
        if self.ranks and not any(t in text for t in self.added):
            return array("I", self.ranks.encode_ordinary(text)).tobytes()
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def __missing__(self, chunk: str) -> bytes:
        self[chunk] = out = self.encode(" " + chunk)
        return out

    def of(self, text: str) -> bytes:
        if len(self) > REMEMBERED:
            self.clear()
        if not text or text[0] == " " or text[-1] == " " or any(x in text for x in ("  ", " \n", "\n ")) or OTHER_SPACE.search(text):
            return self.encode(text)
        chunks = text.split(" ")
        return self.encode(chunks[0]) + b"".join(map(self.__getitem__, chunks[1:]))


_ids: dict[str, Ids] = {}


def ids(path: str) -> Ids:
    """The worker's tokenizer, kept from task to task."""
    if path not in _ids:
        _ids[path] = Ids(path)
    return _ids[path]


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """Start and length of the pieces of a document of n ids: the first takes what the full ones leave."""
    first = n if n <= capacity else n % capacity or capacity
    return [(0, first)] + [(i, capacity) for i in range(first, n, capacity)]


def pieces(df: DataFrame, path: str, key: str, text: str, capacity: int) -> DataFrame:
    """One row per piece: _key, piece, start, length, ids_crc32."""
    rows = df.select(df[key].cast("long").alias("_key"), df[text].cast("string").alias("_text"))
    end = np.array([END_ID], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = ids(path)
        for batch in batches:
            for part in slices(batch):
                keys, texts = part.column(0).to_pylist(), part.column(1).to_pylist()
                out: list[tuple] = []
                for k, t in zip(keys, texts, strict=True):
                    coded = tokenizer.of(t or "") + end
                    out += [(k, i, a, n, zlib.crc32(coded[4 * a : 4 * (a + n)])) for i, (a, n) in enumerate(cut(len(coded) // 4, capacity))]
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
                columns = list(zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["_key", "piece", "start", "length", "ids_crc32"]
                )

    return rows.mapInArrow(run, "_key long, piece int, start long, length long, ids_crc32 long")


class Group(NamedTuple):
    """So many sequences made up of the same lengths, in order."""

    lengths: tuple[int, ...]
    count: int


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[Group]:
    """Make-up of all sequences for so many pieces of each length."""
    left = [0] * (capacity + 1)
    for length, count in histogram.items():
        left[length] = count
    third = capacity // 3
    open_: list[list[Group]] = [[] for _ in range(capacity + 1)]  # by room
    for a in range(capacity, third, -1):
        b = min(a, capacity - a)
        while left[a]:
            while b > third and (not left[b] or b == a and left[a] < 2):
                b -= 1
            if b <= third:
                open_[capacity - a].append(Group((a,), left[a]))
                left[a] = 0
            else:
                n = left[a] // 2 if a == b else min(left[a], left[b])
                open_[capacity - a - b].append(Group((a, b), n))
                left[a] -= n
                left[b] -= n
    for a in range(third, 0, -1):
        room = a
        while left[a]:
            while room <= capacity and not open_[room]:
                room += 1
            group = open_[room].pop() if room <= capacity else Group((), left[a])
            space = min(room, capacity)
            fit = space // a  # after the first, that sequence has the least room that is enough
            full = min(group.count, left[a] // fit)
            rest = left[a] - full * fit if full < group.count else 0
            if full:
                open_[space - fit * a].append(Group(group.lengths + (a,) * fit, full))
            if rest:
                open_[space - rest * a].append(Group(group.lengths + (a,) * rest, 1))
            left[a] -= full * fit + rest
            if unused := group.count - full - bool(rest):
                if group.lengths:
                    open_[room].append(Group(group.lengths, unused))
    return [g for groups in open_ for g in groups]


def places(groups: list[Group]) -> dict[int, np.ndarray]:
    """For each length its runs of places: rank of the first piece, first sequence, offset."""
    out: dict[int, list[tuple[int, int, int]]] = {}
    used: dict[int, int] = {}
    sequence = 0
    for g in groups:
        offset = 0
        for length in g.lengths:
            out.setdefault(length, []).append((used.get(length, 0), sequence, offset))
            used[length] = used.get(length, 0) + g.count
            offset += length
        sequence += g.count
    return {length: np.array(runs, dtype=np.int64) for length, runs in out.items()}


def pack(df: DataFrame, path: str, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: key, piece, start, length, ids_crc32, sequence_id, offset.

    ``path`` names a tokenizer file that every executor has. A null or empty
    text is the end id alone; a null key stays null; repeated rows are packed
    as often as they come; other columns are ignored; an empty table gives no
    rows. Only documents above the capacity are cut.
    """
    ship(df.sparkSession)
    cuts = checkpointed(pieces(df, path, key, text, capacity).withColumn("_order", F.coalesce("_key", F.lit(NULL_KEY))).withColumn("_one", F.lit(1)))
    histogram = {r["length"]: r["n"] for r in cuts.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # capacity rows at most
    runs = places(plan(histogram, capacity))
    ranked = gapless_starts(cuts, ["length"], "_order", {"_rank": "_one"}, tie="ids_crc32", then=("piece",))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, ranks = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "_rank"))
            sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
            order = np.argsort(lengths, kind="stable")
            edges = np.flatnonzero(np.diff(lengths[order], prepend=-1, append=-1))
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                at = order[a:b]
                known = runs[int(lengths[at[0]])]
                which = np.searchsorted(known[:, 0], ranks[at], side="right") - 1
                sequence[at] = known[which, 1] + ranks[at] - known[which, 0]
                offset[at] = known[which, 2]
            kept = [batch.column(c) for c in ("_key", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(sequence), pa.array(offset)],
                names=["_key", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    packed = ranked.mapInArrow(run, "_key long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
    return packed.withColumnRenamed("_key", key)


def op8_packing(spark: SparkSession, sf_dir: str, name: str = "byte_bpe_50k.json") -> DataFrame:
    """All documents in sequences of 1,024 tokens."""
    import public_tokenizers

    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path(name))
