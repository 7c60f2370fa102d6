"""Counting 64-bit keys over all rows when there are too many for a Spark row each.

Documents are dealt into blocks by a hash of their key and text. A block makes
its distinct keys with numpy, sorts them and sends each bucket of the key space
one packed row; a bucket adds up the counts of all blocks and answers each
block with the ranks of the keys that are held more than once. Blocks and
buckets grow in number with the input, so each stays of a bounded size, and a
key reaches its bucket at most once from each block: a key that a third of all
rows share is no hot spot.

Keys travel cut to their upper bits, of which there are 16 more than it takes
to number all keys. Two keys that are equal in those bits count as one, so an
answer may be too high but never too low; what must be exact is decided by the
caller from whole keys.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyroll.llm.common import ship, tidy

#: Text in a block, and the bytes of text that one bucket's keys come from.
BLOCK_BYTES = 2 << 20
BUCKET_BYTES = 6 << 20
LEAST_BUCKETS = 64


class Layout(NamedTuple):
    """How documents and keys are dealt out."""

    blocks: int
    buckets: int
    bits: int  # that keys are cut to


def layout(df: DataFrame, text: str, block_bytes: int = BLOCK_BYTES) -> Layout:
    size = df.agg(F.sum(F.octet_length(F.col(text)).cast("long"))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    return Layout(blocks, max(LEAST_BUCKETS, -(-size // BUCKET_BYTES)), min(64, (size // 4).bit_length() + 16))


def in_blocks(df: DataFrame, plan: Layout, key: str, text: str, more: tuple[str, ...] = ()) -> DataFrame:
    """Columns _key, _text (compressed, see opened()), ``more`` and block; equal rows share a block.

    Read more than once, dealt out once.
    """
    ship(df.sparkSession)
    rows = df.select(df[key].cast("long").alias("_key"), df[text].cast("string").alias("_text"), *more)
    block = F.pmod(F.xxhash64("_key", "_text"), F.lit(plan.blocks)).cast("int")
    rows = rows.withColumn("block", block)

    def compress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            small = [None if t is None else squeeze(t) for t in batch.column("_text").cast(pa.binary()).to_pylist()]
            at = batch.schema.get_field_index("_text")
            yield batch.set_column(at, "_text", pa.array(small, pa.binary()))

    kinds = {f.name: "binary" if f.name == "_text" else f.dataType.simpleString() for f in rows.schema}
    return rows.mapInArrow(compress, ", ".join(f"{n} {k}" for n, k in kinds.items())).repartition("block")


def opened(docs: pa.Table) -> pa.Table:
    """A block's rows with their texts."""
    expand = zstandard.ZstdDecompressor().decompress
    texts = [None if t is None else expand(t).decode() for t in docs.column("_text").to_pylist()]
    return docs.set_column(docs.schema.get_field_index("_text"), "_text", pa.array(texts, pa.string()))


@lru_cache(maxsize=1)
def coders() -> tuple[zstandard.ZstdCompressor, zstandard.ZstdDecompressor]:
    """Made once a process: making them takes longer than most packed rows."""
    return zstandard.ZstdCompressor(level=1, write_content_size=True), zstandard.ZstdDecompressor()


def packed(values: np.ndarray) -> bytes:
    """Non-negative whole numbers in the narrowest of 1, 2, 4 or 8 bytes each, byte by byte of all and compressed."""
    top = int(values.max()) if len(values) else 0
    kind = next(k for k in (1, 2, 4, 8) if top < 1 << (8 * k))
    planes = values.astype(f"<u{kind}").view(np.uint8).reshape(-1, kind).T.tobytes()
    return bytes([kind]) + coders()[0].compress(planes)


def unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(coders()[1].decompress(data[1:]), np.uint8)
    return np.ascontiguousarray(planes.reshape(data[0], -1).T).view(f"<u{data[0]}").ravel().astype(np.uint64)


def rising(values: np.ndarray) -> bytes:
    """Like packed(), for numbers in order: as differences."""
    return packed(np.diff(values.astype(np.uint64), prepend=np.uint64(0)))


def risen(data: bytes) -> np.ndarray:
    return np.cumsum(unpacked(data), dtype=np.uint64)


def packed_keys(keys: np.ndarray) -> bytes:
    """Like packed(), for any longs: as distances from the least, which comes first."""
    least = keys.min() if len(keys) else np.int64(0)
    return int(least).to_bytes(8, "little", signed=True) + packed(keys.view(np.uint64) - least.astype(np.int64).view(np.uint64))


def unpacked_keys(data: bytes) -> np.ndarray:
    least = np.frombuffer(data, np.uint64, 1)[0]
    return (unpacked(data[8:]) + least).view(np.int64)


def distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values in order, and how often each comes."""
    values = np.sort(values)
    new = np.ones(len(values), dtype=bool)
    new[1:] = values[1:] != values[:-1]
    at = np.flatnonzero(new)
    return values[at], np.diff(np.append(at, len(values)))


def cut_keys(keys: np.ndarray, plan: Layout) -> np.ndarray:
    return keys >> np.uint64(64 - plan.bits)


def bucket_edges(cuts: np.ndarray, plan: Layout) -> np.ndarray:
    """Where each bucket begins within keys in order, cut to the plan's bits; one more than there are buckets."""
    width = -(-(1 << plan.bits) // plan.buckets)
    firsts = np.arange(plan.buckets + 1, dtype=object) * width
    limits = np.array([min(int(x), (1 << 64) - 1) for x in firsts], dtype=np.uint64)
    edges = np.searchsorted(cuts, limits).astype(np.int64)
    edges[-1] = len(cuts)
    return edges


def distinct_cuts(keys: np.ndarray, plan: Layout) -> tuple[np.ndarray, np.ndarray]:
    """Distinct cut keys in order, and how often each comes."""
    return distinct(cut_keys(keys, plan))


KeysOf = Callable[[pa.Table], tuple[np.ndarray, np.ndarray]]


def answers(blocks: DataFrame, plan: Layout, cuts_of: KeysOf, read: Callable[[pa.Table], pa.Table] = opened) -> DataFrame:
    """Rows (block, bucket, ranks, totals): keys of a block whose count over all blocks is two or more.

    ``cuts_of`` gives a block's distinct cut keys in order with their counts, from what ``read`` makes of its rows.
    """

    def send(table: pa.Table) -> pa.Table:
        cuts, counts = cuts_of(read(table))
        edges = bucket_edges(cuts, plan)
        full = np.flatnonzero(np.diff(edges))
        parts = [(edges[b], edges[b + 1]) for b in full]
        return pa.table(
            {
                "bucket": pa.array(full, pa.int32()),
                "block": pa.array(np.full(len(full), table.column("block")[0].as_py()), pa.int32()),
                "cuts": pa.array([rising(cuts[a:b]) for a, b in parts], pa.binary()),
                "counts": pa.array([packed(counts[a:b]) if counts[a:b].max() > 1 else b"" for a, b in parts], pa.binary()),
            }
        )

    def add(table: pa.Table) -> pa.Table:
        cells = [risen(x) for x in table.column("cuts").to_pylist()]
        numbers = [unpacked(x).astype(np.int64) if x else np.ones(len(c), np.int64) for x, c in zip(table.column("counts").to_pylist(), cells, strict=True)]
        keys, where = np.unique(np.concatenate(cells), return_inverse=True)
        total = np.bincount(where, weights=np.concatenate(numbers)).astype(np.int64)[where]
        ends = np.cumsum([len(c) for c in cells])
        out: dict[str, list] = {"block": [], "bucket": [], "ranks": [], "totals": []}
        bucket = table.column("bucket")[0].as_py()
        for block, cell, end in zip(table.column("block").to_pylist(), cells, ends, strict=True):
            here = total[end - len(cell) : end]
            ranks = np.flatnonzero(here > 1)
            if len(ranks):
                for name, value in zip(out, (block, bucket, rising(ranks), packed(here[ranks])), strict=True):
                    out[name].append(value)
        return pa.table(out, schema=ANSWER)

    cells = blocks.groupBy("block").applyInArrow(tidy(send), "bucket int, block int, cuts binary, counts binary")
    return cells.groupBy("bucket").applyInArrow(tidy(add), "block int, bucket int, ranks binary, totals binary")


ANSWER = pa.schema([("block", pa.int32()), ("bucket", pa.int32()), ("ranks", pa.binary()), ("totals", pa.binary())])


def totals_of(cuts: np.ndarray, counts: np.ndarray, answer: pa.Table, plan: Layout) -> np.ndarray:
    """Count over all blocks of each of a block's distinct cut keys."""
    out = counts.astype(np.int64)
    edges = bucket_edges(cuts, plan)
    for bucket, ranks, totals in zip(*(answer.column(c).to_pylist() for c in ("bucket", "ranks", "totals")), strict=True):
        out[edges[bucket] + risen(ranks).astype(np.int64)] = unpacked(totals)
    return out


def with_answers(
    blocks: DataFrame, given: DataFrame, fn: Callable[[pa.Table, pa.Table], pa.Table], schema: str, read: Callable[[pa.Table], pa.Table] = opened
) -> DataFrame:
    """``fn`` on each block, as ``read`` makes it, with the answers to it (none: an empty table); answers without a block don't occur."""

    def on_texts(docs: pa.Table, answer: pa.Table) -> pa.Table:
        return fn(read(docs), answer)

    return blocks.groupBy("block").cogroup(given.groupBy("block")).applyInArrow(tidy(on_texts), schema)
