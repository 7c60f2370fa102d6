"""Operator 6, benchmark decontamination over a distributed positional inverted index.

Postings are (term, document, position). Only terms of the test items are
posted, and of each window of an item only its rarest terms are looked up: their
lists, moved back by the term's offset in the window, must meet at the same
start. A document's postings are dealt to one task, so that their starts meet
there without being sent on. What is left is compared with the document word by
word, exactly or, for proximity matches, within a number of places; only the
text of documents with something left is read again. Everything is DataFrame
expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyroll.llm.common import checkpointed, join_small, table, written

WINDOW = 10
#: Terms of a window whose postings are met before whole windows are compared.
RAREST = 3
#: What stands between words, in lower case. Splitting at it is several times faster than matching all words.
BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Rows of ids alone that a join broadcasts.
MAX_IDS = 1_000_000
#: Stands after a document's last word, so that its position is the number of words. No word is empty.
END = ""
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(text: Column) -> Column:
    """Words of a text with A-Z as a-z; none if null. Only letters of ASCII change case."""
    plain = F.octet_length(text) == F.char_length(text)
    lowered = F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
    return F.array_remove(F.split(F.coalesce(lowered, F.lit("")), BREAK), "")


def item_windows(items: DataFrame, item: str, text: str, size: int) -> DataFrame:
    """Windows of all items: item, uid, at, words; an item of fewer words, but not none, is one window."""
    split = items.select(F.col(item).alias("item"), F.xxhash64(F.col(item), F.col(text)).alias("uid"), words_of(F.col(text).cast("string")).alias("_w"))
    split = split.where(F.size("_w") > 0).distinct()
    starts = F.sequence(F.lit(0), F.greatest(F.size("_w") - size, F.lit(0)))
    return split.select("item", "uid", "_w", F.explode(starts).alias("at")).select("item", "uid", "at", F.slice("_w", F.col("at") + 1, F.lit(size)).alias("words"))


def postings(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """Positional index over the given terms (one row each, column term): _id, _key, pos, term. END is posted as any term."""
    words = F.array_append(words_of(F.col("_text")), F.lit(END))
    return join_small(docs.select("_id", "_key", F.posexplode(words).alias("pos", "term")), terms, ["term"], "inner")


def rarest_terms(windows: DataFrame, docs: DataFrame) -> DataFrame:
    """uid, at, offset, term, bit: the rarest terms of each window all of whose terms occur in the documents."""
    terms = windows.select("uid", "at", F.posexplode("words").alias("offset", "term"))
    counts = postings(docs, checkpointed(terms.select("term").distinct())).groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    counted = terms.join(checkpointed(counts), "term")
    lists = counted.groupBy("uid", "at").agg(F.sort_array(F.collect_list(F.struct("n", "term", "offset"))).alias("t"))
    whole = lists.join(windows.select("uid", "at", F.size("words").alias("n")), ["uid", "at"]).where(F.size("t") == F.col("n"))
    return whole.select("uid", "at", F.posexplode(F.slice("t", 1, RAREST)).alias("i", "t")).select(
        "uid", "at", F.col("t.offset").alias("offset"), F.col("t.term").alias("term"), F.expr("shiftleft(1, i)").alias("bit")
    )


def listed_terms(docs: DataFrame, rare: DataFrame) -> DataFrame:
    """Postings of the rare terms only, so that a frequent word's list is read where a window has nothing rarer; and of END."""
    end = rare.sparkSession.range(1).select(F.lit(END).alias("term"))
    return written(postings(docs, checkpointed(rare.select("term").distinct().union(end))))


def candidates(listed: DataFrame, rare: DataFrame, slop: int) -> DataFrame:
    """_id, uid, at, start: places where the lists of a window's rarest terms meet."""
    own = listed.where(F.col("term") != END).select("_id", "pos", "term").repartition("_id")
    met = join_small(own, rare, ["term"], "inner").select("_id", "uid", "at", "bit", (F.col("pos") - F.col("offset")).alias("start"))
    if slop:
        met = met.withColumn("start", F.explode(F.sequence(F.col("start") - slop, F.col("start") + slop)))
    full = rare.groupBy("uid", "at").agg(F.bit_or("bit").alias("full"))
    found = met.where("start >= 0").groupBy("_id", "uid", "at", "start").agg(F.bit_or("bit").alias("bits"))
    return found.join(full, ["uid", "at"]).where("bits = full").select("_id", "uid", "at", "start")


def matches(docs: DataFrame, items: DataFrame, item: str, text: str, size: int, slop: int = 0) -> tuple[DataFrame, DataFrame]:
    """Number of words of each document of ``docs`` (with _id, _key and _text), and found, (item, start, len) of
    every match, of those that have any: _id, _key, n_words and _id, _key, found, one row for all rows of one id and key.

    A window matches at a start if each of its words is within ``slop`` places
    of its own: 0 is the exact phrase, more a proximity match.
    """
    windows = checkpointed(item_windows(items, item, text, size))
    rare = checkpointed(rarest_terms(windows, docs))
    listed = listed_terms(docs, rare)
    sizes = listed.where(F.col("term") == END).groupBy("_id", "_key").agg(F.max("pos").cast("long").alias("n_words"))
    placed = candidates(listed, rare, slop).join(windows, ["uid", "at"])
    lists = written(placed.groupBy("_id").agg(F.collect_list(F.struct("item", "start", "words")).alias("_c")))
    texts = join_small(docs.select("_id", "_key", "_text"), lists.select("_id"), ["_id"], "left_semi", MAX_IDS)
    rows = texts.dropDuplicates(["_id", "_key"]).join(lists, "_id")
    # out of a generator, so that words are split once a text and not for each place
    rows = rows.select("_id", "_key", "_c", F.explode(F.array(words_of(F.col("_text")))).alias("_w"))
    if slop:
        fits = lambda c: F.forall(
            F.sequence(F.lit(0), F.size(c["words"]) - 1),
            lambda k: F.array_contains(
                F.slice(F.col("_w"), F.greatest(c["start"] + k - slop, F.lit(0)) + 1, F.least(c["start"] + k, F.lit(slop)) + slop + 1),
                F.get(c["words"], k),
            ),
        )
    else:
        fits = lambda c: F.slice(F.col("_w"), c["start"] + 1, F.size(c["words"])) == c["words"]
    real = F.filter("_c", fits)
    found = F.transform(real, lambda c: F.struct(c["item"].alias("item"), c["start"].alias("start"), F.size(c["words"]).alias("len")))
    as_text = found.cast("array<struct<item:string,start:int,len:int>>")
    return sizes, rows.select("_id", "_key", as_text.alias("found")).where(F.size("found") > 0)


def identified(docs: DataFrame, key: str, text: str, more: tuple[str, ...] = ()) -> DataFrame:
    """_id, _key, _text and the ``more`` columns; equal rows have one _id and share their matches."""
    return docs.select(
        F.xxhash64(docs[key], docs[text].cast("string")).alias("_id"), docs[key].alias("_key"), docs[text].cast("string").alias("_text"), *[docs[c] for c in more]
    )


def covered() -> Column:
    """Positions within any match."""
    inside = F.transform("found", lambda m: F.sequence(m["start"], m["start"] + m["len"] - 1))
    return F.array_distinct(F.flatten(inside))


def decontaminate(
    docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", size: int = WINDOW, slop: int = 0
) -> DataFrame:
    """One row per document: ``key``, n_words, n_hit, n_items, items_sha256, contaminated, found.

    A document's word is hit if a window of ``size`` words of an item covers it;
    ``found`` lists the matches as (item, start, len). Null and empty texts have
    no words and are clean; items without words match nothing, repeated items
    count once by their id, and a null item id is left out of n_items. Repeated
    documents are judged alike; other columns are ignored. Without items, or
    without documents, nothing is found.
    """
    named = identified(docs, key, text)
    sizes, hits = matches(named, items, item, item_text, size, slop)
    same = [F.col("_id") == F.col("_hid"), F.col("_key").eqNullSafe(F.col("_hkey"))]
    marks = sizes.join(hits.select(F.col("_id").alias("_hid"), F.col("_key").alias("_hkey"), "found"), same, "left")
    none = F.array().cast("array<struct<item:string,start:int,len:int>>")
    marks = marks.select(F.col("_id").alias("_mid"), F.col("_key").alias("_mkey"), "n_words", F.coalesce("found", none).alias("found"))
    rows = named.select("_id", "_key").join(marks, [F.col("_id") == F.col("_mid"), F.col("_key").eqNullSafe(F.col("_mkey"))])
    ids = F.array_sort(F.array_compact(F.array_distinct(F.transform("found", lambda m: m["item"]))))
    out = rows.withColumn("_ids", ids).withColumn("n_hit", F.size(covered()).cast("long"))
    return out.select(
        F.col("_key").alias(key),
        "n_words",
        "n_hit",
        F.size("_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("_ids", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
        "found",
    )


def clean(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", size: int = WINDOW) -> DataFrame:
    """The rows of ``docs``, unchanged, in which no window of an item occurs."""
    names = [f"_in{i}" for i in range(len(docs.columns))]
    of = dict(zip(docs.columns, names, strict=True))
    rows = identified(docs.toDF(*names), of[key], of[text], tuple(names))
    _, hits = matches(rows, items, item, item_text, size)
    kept = join_small(rows, written(hits.select("_id", "_key")), ["_id", "_key"], "left_anti", MAX_IDS)
    return kept.select(*[F.col(n).alias(c) for c, n in of.items()])


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents against all benchmark items."""
    return decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("found")


OP6_SQL = r"""
WITH low AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
),
items AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
),
windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[s:s + least(len(w), 10) - 1], ' ') AS t
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s FROM items WHERE len(w) > 0)
),
places AS (
  SELECT doc_id, s, n, array_to_string(w[s:s + n - 1], ' ') AS t
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM low, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n)
),
found AS (SELECT doc_id, item_id, s, p.n FROM places p JOIN windows v ON p.t = v.t AND p.n = v.n),
hits AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM found) GROUP BY doc_id),
ids AS (
  SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS i FROM found) GROUP BY doc_id
)
SELECT l.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM low l LEFT JOIN hits h ON l.doc_id = h.doc_id LEFT JOIN ids i ON l.doc_id = i.doc_id
"""
