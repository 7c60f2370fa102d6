"""Operator 11, ranked lexical search: bit-sliced Bloom signatures bound every document's score, and only those that may win are scored."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skyroll.llm.blocks import packed, packed_keys, unpacked, unpacked_keys
from skyroll.llm.common import ship, table, written
from skyroll.llm.words import mix

#: Words of lower-cased UTF-8, and the same for Java's and DuckDB's expressions.
TERM = re.compile(rb"[0-9a-z\x80-\xff]+")
TERM_PATTERN = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BREAK = re.compile(rb"[^0-9a-z\x80-\xff]")

#: Text and documents in a block of the index, and the part of a text that is split at once.
BLOCK_BYTES, BLOCK_DOCS = 8 << 20, 4096
PIECE = 1 << 20
#: Bits of a signature for each entry, and those that an entry sets.
BITS, HASHES = 12, 4
#: Terms and items that are searched for at once.
QUERY_BYTES, QUERY_ITEMS = 1 << 18, 512
#: Stands for a null key; it orders first.
NULL_KEY = -(2**63)
#: A block's best of one item are compared in so many parts before they meet.
SPREAD = 64

INDEX = """n_docs long, n_terms long, keys binary, lengths binary, vocabulary binary, holders binary,
sizes binary, terms binary, counts binary, groups array<struct<docs:int,rows:int,levels:int,bits:binary>>"""
ARROW_GROUPS = pa.list_(pa.struct([("docs", pa.int32()), ("rows", pa.int32()), ("levels", pa.int32()), ("bits", pa.binary())]))


class Numbers(dict):
    """Numbers terms in order of their first use."""

    def __missing__(self, term: bytes) -> int:
        self[term] = n = len(self)
        return n


def pieces(data: bytes) -> Iterator[bytes]:
    """``data`` in parts of about PIECE bytes that end between terms."""
    at = 0
    while len(data) - at > PIECE:
        end = BREAK.search(data, at + PIECE)
        if not end:
            break
        yield data[at : end.start()]
        at = end.start()
    yield data[at:] if at else data


def hashes_of(terms: list[bytes]) -> np.ndarray:
    return np.fromiter((xxhash.xxh3_64_intdigest(t) for t in terms), np.uint64, len(terms))


def slices_of(hashes: np.ndarray, level: int, which: int, rows: int) -> np.ndarray:
    """The slice that each term sets at a level, for one of its HASHES."""
    step = (level * HASHES + which + 1) * 0x9E3779B97F4A7C15 % (1 << 64)
    return (mix(hashes + np.uint64(step)) % np.uint64(rows)).astype(np.int64)


class Block:
    """Documents that one row of the index holds."""

    def __init__(self) -> None:
        self.numbers = Numbers()
        self.keys: list[int] = []
        self.lengths: list[int] = []
        self.docs: list[tuple[np.ndarray, np.ndarray]] = []
        self.bytes = 0

    def add(self, key: int | None, text: str | None) -> None:
        if text is None:
            return
        data = text.encode().lower()  # bytes: A-Z alone
        number = self.numbers.__getitem__
        found = [np.array(list(map(number, TERM.findall(p))), np.int64) for p in pieces(data)]
        all_terms = found[0] if len(found) == 1 else np.concatenate(found)
        if len(all_terms):
            self.docs.append(np.unique(all_terms, return_counts=True))
            self.keys.append(NULL_KEY if key is None else key)
            self.lengths.append(len(all_terms))
        self.bytes += len(data)

    def record(self) -> pa.RecordBatch:
        """Documents by the number of entries; those of one power of two share a signature width.

        An entry is a term with a level: a term that comes c times has the
        levels 0 to log2(c).
        """
        levels = [np.frexp(c)[1] for _, c in self.docs]  # levels that each term has
        entries = np.array([int(x.sum()) for x in levels])
        order = np.argsort(entries, kind="stable")
        hashes = hashes_of(list(self.numbers))
        groups = []
        widths = np.frexp(entries - 1)[1][order]
        for width in np.unique(widths):
            members = order[widths == width]
            rows, most = BITS << int(width), max(int(levels[m].max()) for m in members)
            bits = np.zeros((rows, len(members)), dtype=bool)
            for column, m in enumerate(members):
                for level in range(int(levels[m].max())):
                    at = hashes[self.docs[m][0][levels[m] > level]]
                    for which in range(HASHES):
                        bits[slices_of(at, level, which, rows), column] = True
            squeezed = zstandard.ZstdCompressor(level=1).compress(np.packbits(bits, axis=1).tobytes())
            groups.append({"docs": len(members), "rows": rows, "levels": most, "bits": squeezed})
        terms = np.concatenate([self.docs[i][0] for i in order])
        lengths = np.array(self.lengths)[order]
        row = {
            "n_docs": len(order),
            "n_terms": int(lengths.sum()),
            "keys": packed_keys(np.array(self.keys, np.int64)[order]),
            "lengths": packed(lengths),
            "vocabulary": zstandard.ZstdCompressor(level=3).compress(b"\n".join(self.numbers)),
            "holders": packed(np.bincount(terms, minlength=len(self.numbers))),
            "sizes": packed(np.array([len(self.docs[i][0]) for i in order])),
            "terms": packed(terms),
            "counts": packed(np.concatenate([self.docs[i][1] for i in order])),
        }
        columns = {n: pa.array([v], pa.int64() if isinstance(v, int) else pa.binary()) for n, v in row.items()}
        return pa.RecordBatch.from_pydict(columns | {"groups": pa.array([groups], ARROW_GROUPS)})


def index(df: DataFrame, key: str = "doc_id", text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per block of documents: signatures cut into slices, one bitmap over the documents for each bit,
    and each document's terms with their counts. Documents without a term have no part in it.

    Blocks are cut where the rows lie, without a shuffle, at ``block_bytes`` of text or BLOCK_DOCS documents.
    """
    ship(df.sparkSession)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = Block()
        for batch in batches:
            for k, t in zip(batch.column("_key").to_pylist(), batch.column("_text"), strict=True):
                block.add(k, t.as_py())
                if block.bytes >= block_bytes or len(block.docs) >= BLOCK_DOCS:
                    if block.docs:
                        yield block.record()
                    block = Block()
        if block.docs:
            yield block.record()

    rows = df.select(F.col(key).cast("long").alias("_key"), F.col(text).cast("string").alias("_text"))
    return rows.mapInArrow(build, INDEX)


class Query(NamedTuple):
    """Items that are searched for at once."""

    ids: list[int | None]
    terms: list[bytes]
    weights: np.ndarray
    of_item: list[np.ndarray]  # numbers of each item's terms


def saturation(count: np.ndarray | int, m: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * count) // (1000 * count + 8 * m)


def bounds(groups: list[dict], query: Query, hashes: np.ndarray, m: np.ndarray) -> np.ndarray:
    """For each item and document of a block a number that its score doesn't exceed.

    ANDed slices show which documents may hold a term at a level, never too
    few; a term at level l comes less than 2^(l+1) times. For each level the
    weights of an item's terms are summed over the bitmaps.
    """
    out = np.zeros((len(query.ids), len(m)), np.int64)
    begin = 0
    for group in groups:
        docs, rows = group["docs"], group["rows"]
        width = -(-docs // 8)
        flat = np.frombuffer(zstandard.ZstdDecompressor().decompress(group["bits"], rows * width), np.uint8)
        bits = flat.reshape(rows, width)
        at = slice(begin, begin + docs)
        begin += docs
        maybe, reached = None, np.zeros(docs, np.int64)
        for level in range(group["levels"]):
            for which in range(HASHES):
                found = bits[slices_of(hashes, level, which, rows)]
                maybe = found if maybe is None else maybe & found
            top = saturation(2 ** (level + 1) - 1, m[at])
            more, reached = top - reached, top
            held = maybe.any(axis=1)
            if not held.any():
                break
            presence = np.unpackbits(maybe, axis=1, count=docs)
            for i, numbers in enumerate(query.of_item):
                there = numbers[held[numbers]]
                if len(there):
                    out[i, at] += (query.weights[there].astype(np.float64) @ presence[there]).astype(np.int64) * more
    return out


class Best:
    """The k highest scores so far of one item; equal scores by ascending key."""

    def __init__(self, k: int) -> None:
        self.k = k
        self.scores = np.zeros(0, np.int64)
        self.keys = np.zeros(0, np.int64)

    def open(self, bound: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """Which documents aren't excluded by their bound."""
        if len(self.scores) < self.k:
            return bound > 0
        return (bound > self.scores[-1]) | ((bound == self.scores[-1]) & (keys < self.keys[-1]))

    def add(self, scores: np.ndarray, keys: np.ndarray) -> None:
        scores, keys = np.append(self.scores, scores), np.append(self.keys, keys)
        order = np.lexsort((keys, -scores))[: self.k]
        order = order[scores[order] > 0]
        self.scores, self.keys = scores[order], keys[order]


def ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Numbers starts[0].., sizes[0] of them, then starts[1].. and so on."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1]) + np.repeat(starts - (ends - sizes), sizes)


def search_block(row: dict, query: Query, hashes: np.ndarray, n_docs: int, n_terms: int, best: list[Best]) -> None:
    """Score the block's documents that may be among an item's best, those with the highest bounds first."""
    keys, sizes = unpacked_keys(row["keys"]), unpacked(row["sizes"]).astype(np.int64)
    m = np.array([10 + 90 * int(n) * n_docs // n_terms for n in unpacked(row["lengths"])], np.int64)
    bound = bounds(row["groups"], query, hashes, m)
    terms, counts = unpacked(row["terms"]).astype(np.int64), unpacked(row["counts"]).astype(np.int64)
    begin = np.cumsum(sizes) - sizes
    vocabulary = zstandard.ZstdDecompressor().decompress(row["vocabulary"]).split(b"\n")
    wanted = {t: i for i, t in enumerate(query.terms)}
    numbers = np.full(len(wanted), -1)
    for number, term in enumerate(vocabulary):
        if term in wanted:
            numbers[wanted[term]] = number
    weight = np.zeros(len(vocabulary), np.int64)
    for i, of_item in enumerate(query.of_item):
        here = of_item[numbers[of_item] >= 0]
        left = np.flatnonzero(best[i].open(bound[i], keys))
        if not len(here) or not len(left):
            continue
        left = left[np.argsort(-bound[i][left], kind="stable")]
        weight[numbers[here]] = query.weights[here]
        at, step = 0, 2 * best[i].k
        while at < len(left):
            some = left[at : at + step]
            at, step = at + step, min(2 * step, 4096)
            some = some[best[i].open(bound[i][some], keys[some])]
            if not len(some):
                break
            entries = ranges(begin[some], sizes[some])
            parts = weight[terms[entries]] * saturation(counts[entries], np.repeat(m[some], sizes[some]))
            best[i].add(np.add.reduceat(parts, np.cumsum(sizes[some]) - sizes[some]), keys[some])
        weight[numbers[here]] = 0


def item_terms(items: DataFrame, key: str, text: str) -> DataFrame:
    """Columns _item and _term, each pair once."""
    lowered = F.translate(F.col(text).cast("string"), UPPER, LOWER)
    found = F.explode(F.regexp_extract_all(lowered, F.lit(TERM_PATTERN), F.lit(0)))
    return items.select(F.col(key).cast("long").alias("_item"), found.alias("_term")).distinct()


def holders(blocks: DataFrame, terms: list[bytes]) -> dict[str, int]:
    """Number of documents that hold each of the terms."""
    wanted = set(terms)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[bytes, int] = {}
        for batch in batches:
            for vocabulary, numbers in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for term, n in zip(zstandard.ZstdDecompressor().decompress(vocabulary).split(b"\n"), unpacked(numbers).tolist(), strict=True):
                    if term in wanted:
                        total[term] = total.get(term, 0) + n
        yield pa.RecordBatch.from_pydict({"term": pa.array([t.decode() for t in total], pa.string()), "n": pa.array(list(total.values()), pa.int64())})

    rows = blocks.select("vocabulary", "holders").mapInArrow(counted, "term string, n long")
    return {r.term: r.n for r in rows.groupBy("term").agg(F.sum("n").alias("n")).collect()}


def best_of(blocks: DataFrame, query: Query, k: int, n_docs: int, n_terms: int) -> DataFrame:
    """Each task's best k documents of each item; its earlier blocks exclude documents of its later ones."""
    hashes = hashes_of(query.terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(k) for _ in query.ids]
        for batch in batches:
            for n in range(batch.num_rows):
                search_block(batch.slice(n, 1).to_pylist()[0], query, hashes, n_docs, n_terms, best)
        found = [len(b.scores) for b in best]
        yield pa.RecordBatch.from_pydict(
            {
                "item": pa.array([i for i, n in zip(query.ids, found, strict=True) for _ in range(n)], pa.int64()),
                "key": pa.array(np.concatenate([b.keys for b in best]), pa.int64()),
                "score": pa.array(np.concatenate([b.scores for b in best]), pa.int64()),
            }
        )

    return blocks.select("keys", "lengths", "vocabulary", "sizes", "terms", "counts", "groups").mapInArrow(run, "item long, key long, score long")


def search(blocks: DataFrame, items: DataFrame, k: int = 10, key: str = "item_id", text: str = "text", doc_key: str = "doc_id") -> DataFrame:
    """Each item's k highest-scoring documents of an index(), with score above 0: item key, rank, document key, score.

    ``blocks`` should be written. Items are searched for in parts of
    QUERY_BYTES of terms, each part against all blocks. Which documents are
    scored depends on how blocks lie in tasks, the result doesn't.

    Nulls and ties: null texts have no terms, so neither null documents nor
    null items come up. A null document key counts as the smallest long, and
    comes back as null. Equal scores rank by ascending key. Rows that repeat
    count as documents of their own; rows of one item key are one item with
    the terms of all. Empty tables give no rows; other columns are ignored.
    """
    spark = blocks.sparkSession
    ship(spark)
    pairs = written(item_terms(items, key, text))
    size, n_items = pairs.agg(F.sum(F.octet_length("_term").cast("long") + 8), F.count_distinct(F.coalesce("_item", F.lit(NULL_KEY)))).first()
    n_docs, n_terms = blocks.agg(F.sum("n_docs"), F.sum("n_terms")).first()
    out = spark.createDataFrame([], "item long, key long, score long")
    parts = max(-(-(size or 0) // QUERY_BYTES), -(-n_items // QUERY_ITEMS)) if n_docs else 0
    for part in range(parts):
        mine = pairs.where(F.pmod(F.xxhash64("_item"), F.lit(parts)) == part).collect()
        numbers: dict[str, int] = {}
        of_item: dict[int | None, list[int]] = {}
        for r in mine:
            of_item.setdefault(r["_item"], []).append(numbers.setdefault(r["_term"], len(numbers)))
        if not mine:
            continue
        terms = [t.encode() for t in numbers]
        held = holders(blocks, terms)
        weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * held.get(t, 0) + 1))) for t in numbers], np.int64)
        query = Query(list(of_item), terms, weights, [np.array(sorted(x)) for x in of_item.values()])
        out = out.union(best_of(blocks, query, k, n_docs, n_terms))
    order = [F.desc("score"), F.asc("key")]
    some = Window.partitionBy("item", F.pmod(F.xxhash64("key", "score"), F.lit(SPREAD))).orderBy(*order)
    out = out.withColumn("_place", F.row_number().over(some)).where(F.col("_place") <= k)
    out = out.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).where(F.col("rank") <= k)
    return out.select(
        F.col("item").alias(key), "rank", F.when(F.col("key") != NULL_KEY, F.col("key")).alias(doc_key), "score"
    )


def op11_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each benchmark item's ten best documents."""
    blocks = written(index(table(spark, sf_dir, "documents")))
    return search(blocks, table(spark, sf_dir, "benchmark"))


OP11_SQL = """
WITH item_terms AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\\x{80}-\\x{10FFFF}]+')) AS term
  FROM benchmark
),
numbered AS (
  SELECT row_number() OVER () AS row_no, doc_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\\x{80}-\\x{10FFFF}]+') AS terms
  FROM documents
),
sized AS (SELECT row_no, doc_id, terms, len(terms) AS n FROM numbered WHERE len(terms) > 0),
totals AS (SELECT count(*) AS n_docs, sum(n)::BIGINT AS n_terms FROM sized),
counted AS (
  SELECT row_no, doc_id, n, term, count(*) AS tf
  FROM (SELECT row_no, doc_id, n, unnest(terms) AS term FROM sized)
  WHERE term IN (SELECT term FROM item_terms) GROUP BY ALL
),
weights AS (
  SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM counted, totals GROUP BY term, n_docs
),
scored AS (
  SELECT i.item_id, c.row_no, c.doc_id,
    sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // n_terms))))::BIGINT AS score
  FROM item_terms i JOIN counted c ON c.term = i.term JOIN weights q ON q.term = i.term, totals
  GROUP BY ALL HAVING score > 0
),
placed AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS FIRST) AS rank, doc_id, score FROM scored
)
SELECT item_id, rank::INT AS rank, doc_id, score FROM placed WHERE rank <= 10
"""
