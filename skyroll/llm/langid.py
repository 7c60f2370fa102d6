"""Operator 13, language ID: word-first backoff from known words to shorter and shorter character n-grams."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import islice
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyroll.llm.common import ship, table, written
from skyroll.llm.words import mix

#: A word: a letter and up to 63 letters or marks more; a longer run is several words.
WORD = regex.compile(r"\p{L}[\p{L}\p{M}]{0,63}")
#: Longest character n-gram. Kind 0 are words, kind n are n-grams.
LONGEST = 5
#: Bounds of the model: languages (those with the most words) and entries in all.
LANGUAGES, ENTRIES = 1000, 1_000_000
#: A word or n-gram seen fewer times isn't known.
LEAST_COUNT = 2
#: Letters of a text split at once, distinct words counted before they leave a task, texts judged at once.
PIECE, FLUSH_WORDS, CHUNK = 1 << 20, 100_000, 1000
UNKNOWN = "und"


def word_lists(text: str) -> Iterator[list[str]]:
    """The words of a text, in parts if it is long."""
    lowered = text.lower()
    if len(lowered) <= PIECE:
        yield WORD.findall(lowered)
        return
    found = WORD.finditer(lowered)
    while part := [m[0] for m in islice(found, PIECE // 8)]:
        yield part


def word_keys(words: list[str]) -> np.ndarray:
    return np.fromiter((xxhash.xxh3_64_intdigest(w.encode()) for w in words), np.uint64, len(words))


def gram_keys(words: list[str], n: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the n-grams of all words, and the number of the word each is of; from two letters on a space marks the ends."""
    marked = words if n == 1 else [f" {w} " for w in words]
    sizes = np.fromiter(map(len, marked), np.int64, len(marked))
    points = np.frombuffer("".join(marked).encode("utf-32-le"), np.uint32).astype(np.uint64)
    if len(points) < n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    factors = mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
    total = np.zeros(len(points) - n + 1, np.uint64)
    for j in range(n):
        total += points[j : j + len(total)] * factors[j]
    of_word = np.repeat(np.arange(len(marked)), sizes)
    inside = of_word[: len(total)] == of_word[n - 1 :]
    return mix(total[inside]), of_word[: len(total)][inside]


def signed(keys: np.ndarray) -> pa.Array:
    return pa.array(keys.view(np.int64), pa.int64())


def counts(df: DataFrame, text: str, label: str) -> DataFrame:
    """How often each word and n-gram comes in each language: lang, kind, key (a 64-bit hash), n. Null texts and labels don't count."""

    def rows_of(lang: str, words: Counter) -> Iterator[pa.RecordBatch]:
        names, times = list(words), np.fromiter(words.values(), np.int64, len(words))
        for kind in range(LONGEST + 1):
            keys, of_word = (word_keys(names), np.arange(len(names))) if kind == 0 else gram_keys(names, kind)
            distinct, at = np.unique(keys, return_inverse=True)
            n = np.bincount(at, weights=times[of_word], minlength=len(distinct)).astype(np.int64)
            columns = {"lang": pa.array([lang] * len(distinct), pa.string()), "kind": pa.array(np.full(len(distinct), kind), pa.int32())}
            yield pa.RecordBatch.from_pydict(columns | {"key": signed(distinct), "n": pa.array(n, pa.int64())})

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: dict[str, Counter] = {}
        held = 0
        for batch in batches:
            for lang, content in zip(batch.column("_lang").to_pylist(), batch.column("_text"), strict=True):
                mine = words.setdefault(lang, Counter())
                for part in word_lists(content.as_py()):
                    before = len(mine)
                    mine.update(part)
                    held += len(mine) - before
                    if held >= FLUSH_WORDS:
                        for k, w in words.items():
                            yield from rows_of(k, w)
                        words, held = {lang: (mine := Counter())}, 0
        for lang, w in words.items():
            yield from rows_of(lang, w)

    known = df.select(F.col(label).cast("string").alias("_lang"), F.col(text).cast("string").alias("_text"))
    rows = known.where("_lang IS NOT NULL AND _text IS NOT NULL").mapInArrow(count, "lang string, kind int, key long, n long")
    return rows.groupBy("lang", "kind", "key").agg(F.sum("n").alias("n"))


class Kind(NamedTuple):
    """What a model knows of one kind: keys in order, and for each the languages and gains at starts[i]..starts[i+1]."""

    keys: np.ndarray
    starts: np.ndarray
    langs: np.ndarray
    gains: np.ndarray

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Place of each key, -1 if it isn't known."""
        if not len(self.keys):
            return np.full(len(keys), -1)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, at, -1)

    def entries(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For known keys: which of ``at``, language and gain of each entry."""
        sizes = self.starts[at + 1] - self.starts[at]
        which = np.repeat(np.arange(len(at)), sizes)
        ends = np.cumsum(sizes)
        entry = np.arange(len(which)) + np.repeat(self.starts[at] - (ends - sizes), sizes)
        return which, self.langs[entry], self.gains[entry]


class Model(NamedTuple):
    """Languages, those with the most words first, and one Kind for words and each n-gram length."""

    languages: list[str]
    kinds: list[Kind]


def learn(df: DataFrame, text: str = "text", label: str = "lang", entries: int = ENTRIES) -> Model:
    """Count words and n-grams of all rows; the model holds at most ``entries`` (language, word or n-gram) pairs.

    A pair is known when it comes LEAST_COUNT times; where a language and kind
    have more known ones than their even part of ``entries``, the least count
    doubles until they fit. The gain of a pair is 1000 times the logarithm of
    its frequency over half of the least frequency that any language can show.
    """
    ship(df.sparkSession)
    all_counts = written(counts(df, text, label))
    totals = all_counts.groupBy("lang", "kind").agg(F.sum("n").alias("total"))
    most = totals.where("kind = 0").orderBy(F.desc("total"), "lang").limit(LANGUAGES).collect()
    languages = [r.lang for r in most]
    if not languages:
        return Model([], [])
    spark = df.sparkSession
    numbers = spark.createDataFrame([(x, i) for i, x in enumerate(languages)], "lang string, number int")
    known = all_counts.join(F.broadcast(numbers), "lang")
    total = {(r.number, r.kind): r.total for r in known.groupBy("number", "kind").agg(F.sum("n").alias("total")).collect()}
    # bin i holds the counts from 2^i to 2^(i+1) - 1
    binned = known.groupBy("number", "kind", (F.length(F.bin("n")) - 1).alias("bin")).agg(F.count(F.lit(1)).alias("rows")).collect()
    sizes: dict[tuple[int, int], dict[int, int]] = {}
    for r in binned:
        sizes.setdefault((r.number, r.kind), {})[r.bin] = r.rows
    part = entries // (len(languages) * (LONGEST + 1))
    floors = []
    for (number, kind), bins in sizes.items():
        least = LEAST_COUNT.bit_length() - 1
        while sum(rows for i, rows in bins.items() if i >= least) > part:
            least += 1
        floors.append((number, kind, 1 << least))
    floor = spark.createDataFrame(floors, "number int, kind int, least long")
    held = known.join(F.broadcast(floor), ["number", "kind"]).where("n >= least").select("number", "kind", "key", "n").toArrow()
    lang, kinds, n = (held.column(c).to_numpy() for c in ("number", "kind", "n"))
    keys = held.column("key").to_numpy().view(np.uint64)
    out = []
    for kind in range(LONGEST + 1):
        order = np.flatnonzero(kinds == kind)
        order = order[np.lexsort((lang[order], keys[order]))]
        distinct, starts = np.unique(keys[order], return_index=True)
        own = np.array([total.get((i, kind), 1) for i in range(len(languages))], np.float64)
        ratio = 2.0 * own.max() * n[order] / own[lang[order]]
        gains = np.floor(1000 * np.log(ratio) + 0.5).astype(np.int32)
        out.append(Kind(distinct, np.append(starts, len(order)), lang[order].astype(np.int32), gains))
    return Model(languages, out)


def votes_of(model: Model, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Entries (word, language, gain) of distinct words; a word that no part of is known has none.

    A known word has the gains of its own. Otherwise the longest length at
    which any of its n-grams is known decides, by the mean over those known.
    """
    at = model.kinds[0].find(word_keys(words))
    seen = np.flatnonzero(at >= 0)
    which, langs, gains = model.kinds[0].entries(at[seen])
    parts = [(seen[which], langs, gains)]
    left = np.flatnonzero(at < 0)
    for n in range(LONGEST, 0, -1):
        if not len(left):
            break
        keys, of_word = gram_keys([words[i] for i in left], n)
        at = model.kinds[n].find(keys)
        hit = at >= 0
        grams = np.bincount(of_word[hit], minlength=len(left))
        which, langs, gains = model.kinds[n].entries(at[hit])
        cells, where = np.unique(of_word[hit][which] * len(model.languages) + langs, return_inverse=True)
        sums = np.bincount(where, weights=gains, minlength=len(cells)).astype(np.int64)
        word, lang = np.divmod(cells, len(model.languages))
        parts.append((left[word], lang, sums // grams[word]))
        left = left[grams == 0]
    return tuple(np.concatenate(x).astype(np.int64) for x in zip(*parts, strict=True))


def judged(model: Model, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
    """Language and score of each text."""
    numbers: dict[str, int] = {}
    docs, words, times = [], [], []
    for i, text in enumerate(texts):
        found: Counter = Counter()
        for part in word_lists(text) if text else ():
            found.update(part)
        docs.append(np.full(len(found), i))
        words.append(np.fromiter((numbers.setdefault(w, len(numbers)) for w in found), np.int64, len(found)))
        times.append(np.fromiter(found.values(), np.int64, len(found)))
    doc, word, n = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (docs, words, times))
    has_words = np.bincount(doc, minlength=len(texts)) > 0
    wide = len(model.languages)
    if not wide:
        return [UNKNOWN] * len(texts), np.zeros(len(texts))
    of_word, lang, gain = votes_of(model, list(numbers))
    # entries lie by word; each (document, word) takes its word's
    order = np.argsort(of_word, kind="stable")
    of_word, lang, gain = of_word[order], lang[order], gain[order]
    first = np.searchsorted(of_word, np.arange(len(numbers) + 1))
    sizes = np.diff(first)[word]
    pair = np.repeat(np.arange(len(word)), sizes)
    entry = np.arange(len(pair)) + np.repeat(first[word] - (np.cumsum(sizes) - sizes), sizes)
    total = np.bincount(doc[pair] * wide + lang[entry], weights=n[pair] * gain[entry], minlength=len(texts) * wide).reshape(-1, wide)
    votes = np.bincount(doc, weights=n * (sizes > 0), minlength=len(texts))
    best = total.argmax(axis=1)
    mean = (total - total.max(axis=1, keepdims=True)) / (1000 * np.maximum(votes, 1))[:, None]
    score = 1 / np.exp(mean).sum(axis=1)
    named = [model.languages[b] if h else UNKNOWN for b, h in zip(best, has_words, strict=True)]
    return named, np.where(has_words, np.floor(score * 1e6 + 0.5) / 1e6, 0.0)


def identify(df: DataFrame, model: Model, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns of every row with lang_pred and score (0 to 1).

    Each word of the whole text votes as often as it comes; the score is the
    share of the winner when the mean votes are taken as logarithms of odds.
    Nulls and texts without a letter are ``und`` with score 0, also every text
    if the model has no language. Ties, and texts of unknown letters alone, go
    to the language with the most words. Rows that repeat are judged each; an
    empty table gives no rows; other columns are ignored.
    """
    ship(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(model)  # at most ENTRIES pairs
    kept = df.select(*[F.col(c).alias(f"_keep{i}") for i, c in enumerate(keep)], F.col(text).cast("string").alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, CHUNK):
                part = batch.slice(begin, CHUNK)
                named, score = judged(shared.value, part.column("_text").to_pylist())
                columns = part.columns[:-1] + [pa.array(named, pa.string()), pa.array(score, pa.float64())]
                yield pa.RecordBatch.from_arrays(columns, schema.names)

    schema = kept.drop("_text").schema.add("lang_pred", "string").add("score", "double")
    out = kept.mapInArrow(run, schema)
    return out.select(*[F.col(f"_keep{i}").alias(c) for i, c in enumerate(keep)], "lang_pred", "score")


def held_out(key: Column) -> Column:
    """Whether a row is kept from learning; one without a key isn't."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def op13_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, learned from those not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", held_out(F.col("doc_id")).alias("held_out"))
    return identify(docs, learn(docs.where("NOT held_out")), keep=("doc_id", "held_out"))


#: crc32 byte by byte with a table made from its polynomial; the bound of LANGUAGES isn't in it.
OP13_SQL = f"""
WITH RECURSIVE bits(i, k, c) AS (
  SELECT i::BIGINT, 0, i::BIGINT FROM range(256) t(i)
  UNION ALL
  SELECT i, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM bits WHERE k < 8
),
crc_table AS (SELECT list(c ORDER BY i) AS t FROM bits WHERE k = 8),
docs AS (
  SELECT row_number() OVER () AS row_no, doc_id, lang, regexp_extract_all(lower(text), '\\p{{L}}[\\p{{L}}\\p{{M}}]{{0,63}}') AS words,
    coalesce(xor(list_reduce(
      [4294967295::BIGINT] || list_transform(range(strlen(doc_id::VARCHAR)), lambda i: ascii(substr(doc_id::VARCHAR, i + 1, 1))::BIGINT),
      lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1])), 4294967295) % 4 = 2, false) AS held_out
  FROM documents, crc_table
),
doc_words AS (SELECT row_no, word, count(*) AS n FROM (SELECT row_no, unnest(words) AS word FROM docs) GROUP BY ALL),
learned AS (
  SELECT d.lang, w.word, sum(w.n)::BIGINT AS n FROM doc_words w JOIN docs d USING (row_no)
  WHERE d.lang IS NOT NULL AND NOT d.held_out GROUP BY ALL
),
sizes(kind) AS (SELECT unnest(range(1, {LONGEST + 1}))),
all_words AS (SELECT DISTINCT word FROM doc_words),
grams AS (
  SELECT word, kind, unnest(list_transform(range(length(marked) - kind + 1), lambda i: substr(marked, i + 1, kind))) AS gram
  FROM (SELECT word, kind, CASE WHEN kind = 1 THEN word ELSE ' ' || word || ' ' END AS marked FROM all_words, sizes)
  WHERE length(marked) >= kind
),
units AS (
  SELECT lang, 0 AS kind, word AS unit, n FROM learned
  UNION ALL
  SELECT lang, kind, gram, sum(n)::BIGINT FROM learned JOIN grams USING (word) GROUP BY ALL
),
totals AS (SELECT lang, kind, sum(n)::BIGINT AS total FROM units GROUP BY ALL),
langs AS (SELECT lang, row_number() OVER (ORDER BY total DESC, lang) - 1 AS number, count(*) OVER () AS many FROM totals WHERE kind = 0),
floors AS (
  SELECT lang, kind, min(f) AS least
  FROM (
    SELECT u.lang, u.kind, p.f, count(*) FILTER (WHERE u.n >= p.f) AS fit
    FROM units u, (SELECT CAST(pow(2, i) AS BIGINT) AS f FROM range({LEAST_COUNT.bit_length() - 1}, 50) t(i)) p GROUP BY ALL
  ), (SELECT DISTINCT many FROM langs)
  WHERE fit <= {ENTRIES} // (many * {LONGEST + 1}) GROUP BY ALL
),
tops AS (SELECT kind, max(total) AS top FROM totals GROUP BY ALL),
known AS (
  SELECT lang, kind, unit, floor(1000 * ln((2 * top * n)::DOUBLE / total::DOUBLE) + 0.5)::BIGINT AS gain
  FROM units JOIN totals USING (lang, kind) JOIN tops USING (kind) JOIN floors USING (lang, kind) WHERE n >= least
),
known_units AS (SELECT DISTINCT kind, unit FROM known),
known_grams AS (
  SELECT word, grams.kind, gram FROM grams JOIN known_units ON known_units.kind = grams.kind AND unit = gram
  WHERE word NOT IN (SELECT unit FROM known_units WHERE kind = 0)
),
longest AS (SELECT word, arg_max(hits, kind) AS hits, max(kind) AS kind FROM (SELECT word, kind, count(*) AS hits FROM known_grams GROUP BY ALL) GROUP BY word),
gains AS (
  SELECT unit AS word, lang, gain FROM known WHERE kind = 0
  UNION ALL
  SELECT g.word, k.lang, sum(k.gain)::BIGINT // any_value(l.hits)
  FROM known_grams g JOIN longest l ON l.word = g.word AND l.kind = g.kind JOIN known k ON k.kind = g.kind AND k.unit = g.gram
  GROUP BY g.word, k.lang
),
votes AS (SELECT row_no, sum(n) AS votes FROM doc_words WHERE word IN (SELECT word FROM gains) GROUP BY ALL),
sums AS (SELECT row_no, lang, sum(n * gain) AS total FROM doc_words JOIN gains USING (word) GROUP BY ALL),
filled AS (
  SELECT d.row_no, l.lang, l.number, coalesce(s.total, 0) AS total, coalesce(v.votes, 1) AS votes
  FROM (SELECT DISTINCT row_no FROM doc_words) d CROSS JOIN langs l
  LEFT JOIN sums s ON s.row_no = d.row_no AND s.lang = l.lang LEFT JOIN votes v ON v.row_no = d.row_no
),
best AS (
  SELECT row_no, first(lang ORDER BY total DESC, number) AS lang, max(total) AS top, list(total) AS totals, any_value(votes) AS votes FROM filled GROUP BY row_no
)
SELECT d.doc_id, d.held_out, coalesce(b.lang, '{UNKNOWN}') AS lang_pred,
  coalesce(floor(1e6 / list_sum(list_transform(b.totals, lambda x: exp((x - b.top)::DOUBLE / (1000 * b.votes)::DOUBLE))) + 0.5) / 1e6, 0.0) AS score
FROM docs d LEFT JOIN best b USING (row_no)
"""
