"""Operator 4, near-duplicates: consistent weighted sampling over TF-IDF shingles, banded, then verified.

A document is its five-word shingles, weighted by how often it has them and by
how rare they are over all documents. Improved consistent weighted sampling
(Ioffe 2010) draws samples that agree between two documents as often as their
weighted Jaccard similarity; documents that agree in a whole band of samples
become candidates, and the exact weighted similarity decides.

A document of which shingles found elsewhere make up less than the threshold
has no near-duplicate, whatever its samples; only the others are sampled.
Equal documents are sampled once. In a band, each document is first held
against the one with most company; what is then still apart is compared with
the rest of its bands, so that no group emits all its pairs and no link between
different texts is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyroll.llm import blocks as B
from skyroll.llm.common import table, tidy, written
from skyroll.llm.graph import components
from skyroll.llm.words import hash_words, mix, space_class, split_words, window_hashes

SHINGLE, THRESHOLD = 5, 0.8
BANDS, ROWS = 32, 5
SAMPLES = BANDS * ROWS
#: How much rarity adds to a shingle's weight at most. Small, so that copies in a large group, whose common shingles
#: are frequent for that very reason, stay similar.
RARITY = 0.25
#: Standard deviations below the threshold at which the samples of a pair rule it out.
DEVIATIONS = 4.0


class Shingles:
    """Distinct shingles of each text with their counts, by text and hash."""

    def __init__(self, docs: pa.Table, size: int = SHINGLE):
        in_word = space_class()
        w = split_words(docs.column("_text"), in_word)
        hashes = hash_words(w, in_word, lower=True)
        n_words = np.diff(w.first)
        every, owner = [], []
        for k in range(1, size + 1):
            if k < size and not (n_words == k).any():
                continue
            found = window_hashes(hashes, k) ^ np.uint64(k)
            at = np.arange(len(found))
            at = at[w.doc[at] == w.doc[at + k - 1]] if len(found) else at
            if k < size:  # shorter texts are one shingle
                at = at[n_words[w.doc[at]] == k] if len(at) else at
            every.append(found[at])
            owner.append(w.doc[at])
        hashes, doc = np.concatenate(every), np.concatenate(owner)
        order = np.lexsort((hashes, doc))
        hashes, doc = hashes[order], doc[order]
        new = np.ones(len(hashes), dtype=bool)
        new[1:] = (np.diff(hashes) != 0) | (np.diff(doc) != 0)
        at = np.flatnonzero(new)
        self.hash, self.doc = hashes[at], doc[at]
        self.count = np.diff(np.append(at, len(hashes)))
        self.first = np.searchsorted(self.doc, np.arange(len(n_words) + 1))
        self.n = np.bincount(doc, minlength=len(n_words))


def weight(count: np.ndarray, holders: np.ndarray, documents: int) -> np.ndarray:
    """TF-IDF weight: a shingle of one document counts 1 + RARITY times, one of all documents once."""
    return count * (1 + RARITY * np.log(documents / np.minimum(holders, documents)) / np.log(max(documents, 2)))


def samples(hashes: np.ndarray, weights: np.ndarray, first: np.ndarray) -> np.ndarray:
    """SAMPLES 64-bit samples of each set (rows): shingle and quantised weight of the least of its draws."""
    n = len(first) - 1
    out = np.empty((n, SAMPLES), dtype=np.uint64)
    owner = np.repeat(np.arange(n), np.diff(first))
    logs = np.log(weights)
    scale = 2.0**-32
    for k in range(SAMPLES):
        seed = mix(np.array([k + 1], dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        one = mix(hashes ^ seed)
        two = mix(one + np.uint64(0xD1342543DE82EF95))
        upper, lower = np.uint64(32), np.uint64(0xFFFFFFFF)
        uniform = lambda x: (x.astype(np.float64) + 0.5) * scale
        r = -np.log(uniform(one >> upper) * uniform(one & lower))
        beta = uniform((one * np.uint64(0xAF251AF3B0F025B5)) >> upper)
        step = np.floor(logs / r + beta)
        c = -np.log(uniform(two >> upper) * uniform(two & lower))
        draw = np.log(c) - r * (step - beta) - r
        least = np.minimum.reduceat(draw, first[:-1])
        hit = np.flatnonzero(draw == least[owner])
        hit = hit[np.unique(owner[hit], return_index=True)[1]]  # ties: the smaller hash, in whose order shingles are
        out[:, k] = mix(hashes[hit] ^ (step[hit].astype(np.int64).view(np.uint64) * np.uint64(0x9FB21C651E98DF25)))
    return out


SKETCH = pa.schema(
    [("_id", pa.int64()), ("_key", pa.int64()), ("block", pa.int32()), ("n_shingles", pa.int64()), ("cid", pa.binary())]
    + [("vector", pa.binary()), ("signature", pa.binary()), ("bands", pa.list_(pa.int64()))]
)


def sketches(dealt: DataFrame, plan: B.Layout, documents: int) -> DataFrame:
    """One row per document: content id, and once for each content of a block its vector, signature and bands.

    Documents that can't have a near-duplicate have no content id.
    """

    def held(docs: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        return B.distinct_cuts(Shingles(docs).hash, plan)

    def sketch(docs: pa.Table, answer: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return pa.table({n: [] for n in SKETCH.names}, schema=SKETCH)
        x = Shingles(docs)
        n = len(x.n)
        cuts, counts = B.distinct_cuts(x.hash, plan)
        holders = B.totals_of(cuts, counts, answer, plan)[np.searchsorted(cuts, B.cut_keys(x.hash, plan))]
        weights = weight(x.count, holders, documents)
        total = np.bincount(x.doc, weights=weights, minlength=n)
        shared = np.bincount(x.doc, weights=weights * (holders > 1), minlength=n)
        live = np.flatnonzero((x.n > 0) & (shared >= (THRESHOLD - 1e-9) * total))
        part = mix(x.hash ^ (x.count.astype(np.uint64) << np.uint64(1)))
        again = mix(part ^ np.uint64(0x632BE59BD9B4E019))
        ids = {}
        for d in live.tolist():
            a, b = x.first[d], x.first[d + 1]
            ids[d] = np.array([np.add.reduce(part[a:b]), np.add.reduce(again[a:b])], dtype=np.uint64).tobytes()
        firsts: dict[bytes, int] = {}
        for d, i in ids.items():
            firsts.setdefault(i, d)
        chosen = np.array(sorted(firsts.values()), dtype=np.int64)
        vectors, signatures, bands = [None] * n, [None] * n, [None] * n
        length = x.first[chosen + 1] - x.first[chosen]
        for some in np.split(chosen, np.flatnonzero(np.diff(np.cumsum(length) >> 16)) + 1) if len(chosen) else []:  # about 65,536 shingles at a time
            sizes = x.first[some + 1] - x.first[some]
            first = np.concatenate(([0], np.cumsum(sizes)))
            at = np.repeat(x.first[some] - first[:-1], sizes) + np.arange(first[-1])
            drawn = samples(x.hash[at], weights[at], first)
            band = drawn.reshape(len(some), BANDS, ROWS)
            joined = np.zeros((len(some), BANDS), dtype=np.uint64)
            for r in range(ROWS):
                joined = mix(joined ^ band[:, :, r] + np.uint64(r))
            joined ^= np.arange(BANDS, dtype=np.uint64)[None, :] * np.uint64(0x9E3779B97F4A7C15)
            for i, d in enumerate(some.tolist()):
                a, b = x.first[d], x.first[d + 1]
                # 40 bits of a shingle's hash tell those of two documents apart
                vectors[d] = _vector(x.hash[a:b], x.count[a:b], holders[a:b])
                signatures[d] = drawn[i].astype(np.uint8).tobytes()
                bands[d] = joined[i].view(np.int64).tolist()
        return pa.table(
            {
                "_id": docs.column("_id").combine_chunks(),
                "_key": docs.column("_key").combine_chunks(),
                "block": docs.column("block").combine_chunks(),
                "n_shingles": pa.array(x.n, pa.int64()),
                "cid": pa.array([ids.get(d) for d in range(n)], pa.binary()),
                "vector": pa.array(vectors, pa.binary()),
                "signature": pa.array(signatures, pa.binary()),
                "bands": pa.array(bands, pa.list_(pa.int64())),
            },
            schema=SKETCH,
        )

    schema = "_id long, _key long, block int, n_shingles long, cid binary, vector binary, signature binary, bands array<long>"
    return B.with_answers(dealt, B.answers(dealt, plan, held), sketch, schema)


def _vector(hashes: np.ndarray, counts: np.ndarray, holders: np.ndarray) -> bytes:
    """A document's shingles for verification: hashes (upper 40 bits), counts and holders, packed."""
    cut = hashes >> np.uint64(24)
    low = (cut & np.uint64(0xFFFFFFFF)).astype("<u4").tobytes()
    number = B.packed(counts)
    parts = [low, (cut >> np.uint64(32)).astype(np.uint8).tobytes(), len(number).to_bytes(4, "little"), number, B.packed(holders)]
    return len(hashes).to_bytes(4, "little") + b"".join(parts)


def _from_vector(data: bytes, documents: int) -> tuple[np.ndarray, np.ndarray]:
    n = int.from_bytes(data[:4], "little")
    hashes = np.frombuffer(data, "<u4", n, 4).astype(np.uint64) | np.frombuffer(data, np.uint8, n, 4 + 4 * n).astype(np.uint64) << np.uint64(32)
    at = 4 + 5 * n
    end = at + 4 + int.from_bytes(data[at : at + 4], "little")
    counts, holders = B.unpacked(data[at + 4 : end]), B.unpacked(data[end:])
    return hashes, weight(counts.astype(np.float64), holders.astype(np.float64), documents)


def similarity(a: bytes, b: bytes, documents: int) -> float:
    """Exact weighted Jaccard similarity of two vectors."""
    (ha, wa), (hb, wb) = _from_vector(a, documents), _from_vector(b, documents)
    _, i, j = np.intersect1d(ha, hb, assume_unique=True, return_indices=True)
    shared = np.minimum(wa[i], wb[j]).sum()
    return float(shared / (wa.sum() + wb.sum() - shared))


def possible(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs (x, y) whose signatures agree often enough for the threshold, but for a chance of DEVIATIONS."""
    signed = pairs.join(texts.select(F.col("cid").alias("x"), F.col("signature").alias("_x")), "x")
    signed = signed.join(texts.select(F.col("cid").alias("y"), F.col("signature").alias("_y")), "y")

    def agree(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                a, b = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint8).reshape(-1, SAMPLES) for i in (2, 3))
                yield batch.select(["x", "y"]).filter(pa.array((a == b).sum(axis=1) >= least_agreement()))

    return signed.select("x", "y", "_x", "_y").mapInArrow(agree, "x binary, y binary")


def least_agreement() -> float:
    return SAMPLES * THRESHOLD - DEVIATIONS * np.sqrt(SAMPLES * THRESHOLD * (1 - THRESHOLD))


def links(pairs: DataFrame, texts: DataFrame, documents: int) -> DataFrame:
    """Of pairs (x, y) of content ids those whose weighted Jaccard similarity reaches the threshold."""
    with_x = pairs.join(texts.select(F.col("cid").alias("x"), F.col("vector").alias("_x")), "x")
    with_y = with_x.join(texts.select(F.col("cid").alias("y"), F.col("vector").alias("_y")), "y")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [similarity(a.as_py(), b.as_py(), documents) for a, b in zip(batch.column(2), batch.column(3), strict=True)]
            out = batch.select(["x", "y"]).append_column("similarity", pa.array(values, pa.float64()))
            yield out.filter(pa.array([v >= THRESHOLD - 1e-9 for v in values], pa.bool_()))

    return with_y.select("x", "y", "_x", "_y").mapInArrow(verify, "x binary, y binary, similarity double")


def apart(entries: DataFrame, documents: int) -> DataFrame:
    """Links (x, y) of one band between different components, enough of them to join all that the band's links join.

    Texts of the band's largest component are compared with the others alone.
    A pair is verified from its first common band, unless links found before
    join its components already; so a band gives fewer links than it has components.
    """

    def compare(rows: pa.Table) -> pa.Table:
        cid = np.array(rows.column("cid").to_pylist(), dtype=object)
        part, sizes = np.unique(np.array(rows.column("component").to_pylist(), dtype=object), return_inverse=True, return_counts=True)[1:]
        signature = np.frombuffer(b"".join(rows.column("signature").to_pylist()), np.uint8).reshape(-1, SAMPLES)
        bands = np.array(rows.column("bands").to_pylist(), dtype=np.int64)
        vectors = rows.column("vector")
        this = int(np.flatnonzero(bands[0] == rows.column("band")[0].as_py())[0])
        outside = part != sizes.argmax()
        xs, ys = [], []
        for i in np.flatnonzero(outside):
            # each pair of two outsiders once
            j = np.flatnonzero((part != part[i]) & (~outside | (np.arange(len(cid)) > i)))
            j = j[(signature[j] == signature[i]).sum(axis=1) >= least_agreement()]
            j = j[~(bands[j, :this] == bands[i, :this]).any(axis=1)]
            for k in j.tolist():
                if part[k] != part[i] and similarity(vectors[int(i)].as_py(), vectors[k].as_py(), documents) >= THRESHOLD - 1e-9:
                    xs.append(cid[i])
                    ys.append(cid[k])
                    part[part == part[k]] = part[i]
        return pa.table({"x": pa.array(xs, pa.binary()), "y": pa.array(ys, pa.binary())})

    return entries.groupBy("band").applyInArrow(tidy(compare), "x binary, y binary")


def near_classes(dealt: DataFrame, plan: B.Layout) -> DataFrame:
    """One row per document of ``dealt`` (with _id): _id, _key, block, n_shingles, class_key, kept.

    ``kept`` marks the documents with their class's smallest (key, content).
    """
    documents = dealt.count()
    every = written(sketches(dealt, plan, documents))
    texts = every.where(F.col("vector").isNotNull()).groupBy("cid").agg(
        F.any_value("vector").alias("vector"), F.any_value("signature").alias("signature"), F.any_value("bands").alias("bands")
    )
    texts = written(texts)
    entries = texts.select("cid", F.explode("bands").alias("band"))
    crowds = entries.groupBy("band").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    met = written(entries.join(crowds, "band"))
    company = met.groupBy("cid").agg(F.sum("_n").alias("_company"))
    hubs = met.join(company, "cid").groupBy("band").agg(F.max(F.struct("_company", "cid"))["cid"].alias("y"))
    pairs = met.join(hubs, "band").where("cid <> y").select(F.col("cid").alias("x"), "y").distinct()
    # written in between, so that no task runs two Python workers
    first = written(links(written(possible(pairs, texts)), texts, documents))
    joined = components(first, "x", "y")
    placed = met.join(joined.withColumnRenamed("node", "cid"), "cid", "left").select("cid", "band", F.coalesce("component", "cid").alias("component"))
    mixed = placed.groupBy("band").agg(F.min("component").alias("_a"), F.max("component").alias("_b")).where("_a <> _b").select("band")
    rest = placed.join(mixed, "band").join(texts.select("cid", "signature", "bands", "vector"), "cid")
    second = apart(rest, documents)
    of = joined.select("node", "component")
    across = second.join(of.select(F.col("node").alias("x"), F.col("component").alias("_cx")), "x", "left")
    across = across.join(of.select(F.col("node").alias("y"), F.col("component").alias("_cy")), "y", "left")
    across = written(across.select(F.coalesce("_cx", "x").alias("a"), F.coalesce("_cy", "y").alias("b")))
    merged = components(across, "a", "b").select(F.col("node").alias("component"), F.col("component").alias("_merged"))
    contents = texts.select("cid").join(joined.withColumnRenamed("node", "cid"), "cid", "left").withColumn("component", F.coalesce("component", "cid"))
    contents = contents.join(merged, "component", "left").select("cid", F.coalesce("_merged", "component").alias("component"))
    least = every.where(F.col("cid").isNotNull()).groupBy("cid").agg(F.min(F.struct("_key", "cid")).alias("_first"))
    firsts = least.join(contents, "cid")
    heads = firsts.groupBy("component").agg(F.min("_first").alias("_head"))
    known = firsts.join(heads, "component").select("cid", "_head")
    own = every.select("_id", "_key", "block", "n_shingles", "cid")
    # documents without a partner have no cid; they take no part in the join
    alone = own.where(F.col("cid").isNull()).withColumn("_head", F.lit(None).cast(known.schema["_head"].dataType))
    own = own.where(F.col("cid").isNotNull()).join(known, "cid", "left").unionByName(alone)
    kept = F.col("_head").isNull() | (F.col("_head._key").eqNullSafe(F.col("_key")) & (F.col("_head.cid") == F.col("cid")))
    return own.select(
        "_id", "_key", "block", "n_shingles", F.when(F.col("_head").isNull(), F.col("_key")).otherwise(F.col("_head._key")).alias("class_key"), kept.alias("kept")
    )


def _dealt(df: DataFrame, plan: B.Layout, key: str, text: str, more: tuple[str, ...] = ()) -> DataFrame:
    marked = df.select(df[key].alias("_k"), df[text].cast("string").alias("_t"), *more).withColumn("_id", F.xxhash64("_k", "_t", F.lit(4)))
    return B.in_blocks(marked, plan, "_k", "_t", ("_id", *more))


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: ``key``, class_id, n_shingles, kept.

    Words end at white space and A-Z count as a-z; a text of fewer than five
    words is one shingle. Texts of equal shingles, and chains of texts of
    weighted Jaccard similarity 0.8 or more, are one class, named by its smallest
    key (null before all); ``kept`` marks the documents of that key and content.
    Null, empty and wordless texts are classes of their own. Other columns are
    ignored; an empty table gives no rows.
    """
    plan = B.layout(df, text)
    out = near_classes(_dealt(df, plan, key, text), plan)
    return out.select(F.col("_key").alias(key), F.col("class_key").alias("class_id"), "n_shingles", "kept")


def without_near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``df``, unchanged, that near_duplicates() keeps; of rows equal in key and text one."""
    plan = B.layout(df, text)
    names = tuple(f"_in{i}" for i in range(len(df.columns)))
    of = dict(zip(df.columns, names, strict=True))
    dealt = _dealt(df.toDF(*names), plan, of[key], of[text], tuple(n for n in names if n != of[text]))
    gone = near_classes(dealt, plan).where("not kept").select("block", "_id")

    def remove(docs: pa.Table, answer: pa.Table) -> pa.Table:
        ids = docs.column("_id").to_numpy()
        stays = ~np.isin(ids, answer.column("_id").to_numpy())
        again = np.ones(len(ids), dtype=bool)
        again[np.unique(ids, return_index=True)[1]] = False
        if again.any():
            stays &= ~again | (Shingles(docs).n == 0)
        columns = {n: docs.column("_text" if n == of[text] else n) for n in names}
        return pa.table(columns).filter(pa.array(stays))

    kinds = {n: "string" if n == of[text] else dealt.schema[n].dataType.simpleString() for n in names}
    out = B.with_answers(dealt, gone, remove, ", ".join(f"{n} {k}" for n, k in kinds.items()))
    return out.withColumnsRenamed({n: c for c, n in of.items()})


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes of all documents."""
    return near_duplicates(table(spark, sf_dir, "documents"))
