"""Operator 1, substring dedup: repeated windows of words, merged into maximal removal intervals.

Every window of a fixed number of words gets a Rabin-Karp hash. A first round
counts the hashes of all windows; a second compares those found more than once
by a second, independent hash and finds each one's first place. What starts
later is removed, as maximal intervals of words.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from skyroll.llm import blocks as B
from skyroll.llm.common import table
from skyroll.llm.words import Words, hash_words, space_class, split_words, window_hashes, window_starts

#: Order of a null key: before all others.
NULL_KEY = -(2**63)


class Windows:
    """All windows of a block, grouped by both hashes, and each group's first place in the block."""

    def __init__(self, table: pa.Table, size: int):
        in_word = space_class()
        self.words: Words = split_words(table.column("_text"), in_word)
        keys = table.column("_key").fill_null(NULL_KEY).to_numpy().astype(np.int64)
        hashes = hash_words(self.words, in_word)
        at = window_starts(self.words, size)
        one, two = window_hashes(hashes, size)[at], window_hashes(hashes, size, 1)[at]
        doc = self.words.doc[at]
        self.key, self.start = keys[doc], at - self.words.first[doc]
        order = np.argsort(one, kind="stable")
        if len(one) and (np.diff(two[order])[np.diff(one[order]) == 0] != 0).any():
            order = np.lexsort((two, one))
        new = np.ones(len(at), dtype=bool)
        new[1:] = (np.diff(one[order]) != 0) | (np.diff(two[order]) != 0)
        self.group = np.empty(len(at), dtype=np.int64)
        self.group[order] = np.cumsum(new) - 1
        firsts = order[new]
        self.at, self.one, self.two = at, one[firsts], two[firsts]
        # smallest (key, start) of each group
        best = np.lexsort((self.start, self.key, self.group))
        lead = np.ones(len(at), dtype=bool)
        lead[1:] = np.diff(self.group[best]) != 0
        self.first_key, self.first_start = self.key[best[lead]], self.start[best[lead]]


def first_places(blocks: DataFrame, repeated: DataFrame, plan: B.Layout, size: int) -> DataFrame:
    """Rows (block, bucket, groups): groups of windows of a block that start earlier in another one."""

    def send(docs: pa.Table, answer: pa.Table) -> pa.Table:
        if not docs.num_rows or not answer.num_rows:
            return pa.table({n: [] for n in SENT.names}, schema=SENT)
        w = Windows(docs, size)
        cuts, counts = B.distinct_cuts(w.one, plan)
        asked = B.totals_of(cuts, np.ones(len(cuts), np.int64), answer, plan) > 1
        groups = np.flatnonzero(np.repeat(asked, counts))
        edges = B.bucket_edges(B.cut_keys(w.one[groups], plan), plan)
        full = np.flatnonzero(np.diff(edges))
        parts = [groups[edges[b] : edges[b + 1]] for b in full]
        return pa.table(
            {
                "bucket": full,
                "block": np.full(len(full), docs.column("block")[0].as_py()),
                "groups": [B.rising(g) for g in parts],
                "one": [B.rising(B.cut_keys(w.one[g], plan)) for g in parts],
                "two": [w.two[g].tobytes() for g in parts],
                "keys": [w.first_key[g].tobytes() for g in parts],
                "starts": [B.packed(w.first_start[g]) for g in parts],
            },
            schema=SENT,
        )

    def compare(sent: pa.Table) -> pa.Table:
        cells = {c: sent.column(c).to_pylist() for c in sent.column_names}
        groups = [B.risen(x) for x in cells["groups"]]
        one = np.concatenate([B.risen(x) for x in cells["one"]])
        two = np.concatenate([np.frombuffer(x, np.uint64) for x in cells["two"]])
        key = np.concatenate([np.frombuffer(x, np.int64) for x in cells["keys"]])
        start = np.concatenate([B.unpacked(x) for x in cells["starts"]])
        order = np.lexsort((start, key, two, one))
        new = np.ones(len(order), dtype=bool)
        new[1:] = (np.diff(one[order]) != 0) | (np.diff(two[order]) != 0)
        first = order[new][np.cumsum(new) - 1]
        later = np.zeros(len(order), dtype=bool)
        later[order] = (key[order] > key[first]) | (start[order] > start[first])
        out: dict[str, list] = {"block": [], "groups": []}
        end = 0
        for block, g in zip(cells["block"], groups, strict=True):
            here = later[end : end + len(g)]
            end += len(g)
            if here.any():
                out["block"].append(block)
                out["groups"].append(B.rising(g[here]))
        return pa.table(out, schema=LATER)

    sent = B.with_answers(blocks, repeated, send, "bucket int, block int, groups binary, one binary, two binary, keys binary, starts binary")
    return sent.groupBy("bucket").applyInArrow(compare, "block int, groups binary")


SENT = pa.schema([("bucket", pa.int32()), ("block", pa.int32()), *((c, pa.binary()) for c in ("groups", "one", "two", "keys", "starts"))])
LATER = pa.schema([("block", pa.int32()), ("groups", pa.binary())])


def dedup_substrings(
    df: DataFrame, size: int = 20, key: str = "doc_id", text: str = "text", with_text: bool = False
) -> DataFrame:
    """One row per input row: ``key``, n_words, n_removed, kept_sha256, removed, and kept_text if asked for.

    A word is removed if a window of ``size`` words of its document covers it
    whose words also start earlier: in a document with a smaller key, or in the
    same one. ``removed`` has the maximal intervals of such words, as [from, to).
    A null key is smaller than all others; rows with the same key and place are
    neither earlier nor later, so repeated rows keep the same words. Null, empty
    and short texts lose nothing; other columns are ignored; an empty table gives
    no rows.
    """
    plan = B.layout(df, text)
    dealt = B.in_blocks(df, plan, key, text)

    def cuts_of(docs: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        in_word = space_class()
        words = split_words(docs.column("_text"), in_word)
        one = window_hashes(hash_words(words, in_word), size)[window_starts(words, size)]
        cuts, _ = B.distinct_cuts(one, plan)
        return cuts, np.ones(len(cuts), np.int64)

    later = first_places(dealt, B.answers(dealt, plan, cuts_of), plan, size)

    def remove(docs: pa.Table, answer: pa.Table) -> pa.Table:
        w = Windows(docs, size)
        elsewhere = np.zeros(len(w.one), dtype=bool)
        for groups in answer.column("groups").to_pylist():
            elsewhere[B.risen(groups).astype(np.int64)] = True
        g = w.group
        repeats = elsewhere[g] | (w.key > w.first_key[g]) | (w.start > w.first_start[g])
        n = len(w.words.starts)
        edges = np.zeros(n + 1, dtype=np.int64)
        edges[w.at[repeats]] += 1
        edges[w.at[repeats] + size] -= 1
        gone = np.cumsum(edges[:-1]) > 0
        data, starts, ends = w.words.data.tobytes(), w.words.starts.tolist(), w.words.ends.tolist()
        shas, spans, texts = [], [], []
        for a, b in zip(w.words.first[:-1].tolist(), w.words.first[1:].tolist(), strict=True):
            here = gone[a:b]
            kept = b" ".join([data[starts[i] : ends[i]] for i in (np.flatnonzero(~here) + a).tolist()])
            shas.append(hashlib.sha256(kept).hexdigest())
            turns = np.flatnonzero(np.diff(here.astype(np.int8), prepend=0, append=0))
            spans.append(turns.reshape(-1, 2).tolist())
            if with_text:
                texts.append(kept.decode())
        removed = np.concatenate(([0], np.cumsum(gone)))
        first = w.words.first
        out = {
            "_key": docs.column("_key").combine_chunks(),
            "n_words": pa.array(np.diff(first), pa.int64()),
            "n_removed": pa.array(removed[first[1:]] - removed[first[:-1]], pa.int64()),
            "kept_sha256": pa.array(shas, pa.string()),
            "removed": pa.array(spans, pa.list_(pa.list_(pa.int64()))),
        }
        return pa.table(out | ({"kept_text": pa.array(texts, pa.string())} if with_text else {}))

    schema = "_key long, n_words long, n_removed long, kept_sha256 string, removed array<array<long>>" + ", kept_text string" * with_text
    return B.with_answers(dealt, later, remove, schema).withColumnRenamed("_key", key)


def op1_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without repeated windows of 20 words."""
    return dedup_substrings(table(spark, sf_dir, "documents")).drop("removed")


OP1_SQL = r"""
WITH docs AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (
  SELECT doc_id, s, array_to_string(w[s:s + 19], ' ') AS t
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS s FROM docs WHERE len(w) >= 20)
),
later AS (
  SELECT doc_id, s FROM (SELECT doc_id, s, row_number() OVER (PARTITION BY t ORDER BY doc_id NULLS FIRST, s) AS n FROM windows) WHERE n > 1
),
gone AS (SELECT doc_id, list(DISTINCT p) AS ps FROM (SELECT doc_id, unnest(range(s, s + 20)) AS p FROM later) GROUP BY doc_id),
words AS (
  SELECT d.doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM docs d
),
flags AS (
  SELECT words.doc_id, word, words.p AS p, g.p IS NOT NULL AS removed FROM words
  LEFT JOIN (SELECT doc_id, unnest(ps) AS p FROM gone) g ON words.doc_id = g.doc_id AND words.p = g.p
),
kept AS (
  SELECT doc_id, count(*) AS n_words, count(*) FILTER (WHERE removed) AS n_removed,
    coalesce(string_agg(word, ' ' ORDER BY p) FILTER (WHERE NOT removed), '') AS t
  FROM flags GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM docs d LEFT JOIN kept k ON d.doc_id = k.doc_id
"""
