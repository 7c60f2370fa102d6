"""Operator 7, quality rules: minimum-covariance-determinant outliers per language and source.

Each document gets its text counts; a fixed rule rejects texts that are too
short or repeat too much. The others become vectors of transformed statistics,
and each (language, source) group gets a robust mean and covariance from
concentration steps: keep the half of the rows nearest to the current estimate,
estimate again from those; at the end once more from all rows that are not far.
Half is the most that still withstands close to half of a group being junk.
Rows beyond the 99.9 % distance of a normal cloud, measured by the group's
median distance, are rejected. The fewer rows a group has, the more of its
estimate is its language's, and the fewer those are, the wider the cutoff.

Every step is a map-side combined aggregate over all rows of the narrow
statistics table. The nearest half is found from a histogram of distances, so
no group is ever sorted or gathered, however many rows it has. Vectors are
whole numbers (fixed point) and their sums decimals, so a recomputed task gives
the same sums in any order.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyroll.llm.common import checkpointed, join_small, ship, table
from skyroll.llm.words import hash_words, space_class, split_words, text_bytes, window_hashes, window_starts

SYMBOLS = b"#*$%&|<>"
#: Rules of the fixed part.
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
#: Steps of a unit in a transformed statistic.
SCALE = 4096
#: Share of a normal cloud whose distances count in the last estimate of a group.
REWEIGHT = 0.975
#: Rows at which a group's estimate is half its own and half its language's, and concentration steps.
MIN_ROWS, STEPS = 60, 5
#: Bins for each doubling of the squared distance.
BINS = 16
#: Least standard deviation of each dimension: below it a deviation isn't worth a rejection.
LEAST_SD = (0.05, 0.02, 0.05, 0.05, 0.05)
#: Share of a normal cloud within the distance beyond which a row is rejected (the squared distance is 20.5).
WITHIN = 0.999
DIMS = 5
PAIRS = [(i, j) for i in range(DIMS) for j in range(i, DIMS)]
NAMES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def chi_square(x: float, more: int = 0) -> float:
    """Chi-square distribution function for DIMS (5) degrees of freedom, or with ``more`` = 2 for 7."""
    head = math.erf(math.sqrt(x / 2)) - math.sqrt(2 * x / math.pi) * math.exp(-x / 2) * (1 + x / 3)
    return head - (math.sqrt(2 * x / math.pi) * math.exp(-x / 2) * x * x / 15 if more else 0)


@functools.cache
def quantile(share: float) -> float:
    """Squared distance within which this share of a normal cloud lies."""
    low, high = 0.0, 200.0
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (mid, high) if chi_square(mid) < share else (low, mid)
    return high


def consistency(share: float) -> float:
    """What the covariance of the nearest share of a normal cloud is multiplied with to give the cloud's."""
    return share / chi_square(quantile(share), 2) if share < 1 else 1.0


@functools.lru_cache(1 << 16)
def cutoff(rows: float) -> float:
    """Squared distance within which the share WITHIN of new rows lies if the estimate is from so many rows.

    Hotelling's distribution: the normal quantile for many rows, without bound towards DIMS of them.
    """
    more = rows - DIMS
    if more <= 0:
        return math.inf
    log = np.linspace(-7.0, 40.0, 8001)  # of the distance
    density = DIMS * log - (more + DIMS) / 2 * np.logaddexp(0, 2 * log - math.log(more))
    total = np.cumsum(np.exp(density - density.max()))
    at = float(np.interp(WITHIN * total[-1], total, log)) + (log[1] - log[0]) / 2
    return math.exp(2 * at) * (rows * rows - 1) / (rows * more)


def count_texts(texts: pa.ChunkedArray | pa.Array) -> dict[str, np.ndarray]:
    """The five counts of each text, whole."""
    in_word = space_class()
    w = split_words(texts, in_word)
    n = len(w.first) - 1

    def per_doc(flags: np.ndarray) -> np.ndarray:
        total = np.zeros(len(w.data) + 1, dtype=np.int64)
        np.cumsum(flags, out=total[1:])
        return total[w.offsets[1:]] - total[w.offsets[:-1]]

    symbol = np.zeros(256, dtype=bool)
    symbol[list(SYMBOLS)] = True
    repeated = np.zeros(len(w.starts) + 1, dtype=np.int64)
    at = window_starts(w, 3)
    if len(at):
        hashes = hash_words(w, in_word)
        one, two, doc = (x[at] for x in (window_hashes(hashes, 3), window_hashes(hashes, 3, 1), w.doc))
        order = np.lexsort((two, one, doc))
        same = np.zeros(len(at) + 1, dtype=bool)
        a, b = order[1:], order[:-1]
        same[1:-1] = (one[a] == one[b]) & (two[a] == two[b]) & (doc[a] == doc[b])
        found = at[order[same[:-1] | same[1:]]]
        np.add.at(repeated, found, 1)
        np.add.at(repeated, found + 3, -1)
    covered = np.concatenate(([0], np.cumsum(np.cumsum(repeated[:-1]) > 0)))
    lines = np.zeros(n, dtype=np.int64)
    data = w.data.tobytes()
    for i, (a, b) in enumerate(zip(w.offsets[:-1].tolist(), w.offsets[1:].tolist(), strict=True)):
        full = [x for x in data[a:b].split(b"\n") if x.strip()]
        lines[i] = len(full) - len(set(full))
    return {
        "n_words": np.diff(w.first),
        "word_chars": per_doc(in_word[w.data] & ((w.data & 0xC0) != 0x80)),
        "n_symbols": per_doc(symbol[w.data]),
        "n_dup_lines": lines,
        "n_repeat_words": covered[w.first[1:]] - covered[w.first[:-1]],
    }


def statistics(df: DataFrame, carry: list[str], text: str = "text") -> DataFrame:
    """``carry`` columns and the counts of each text; a null text has none of anything."""
    ship(df.sparkSession)
    names = [f"_c{i}" for i in range(len(carry))]
    rows = df.select(*[F.col(c).alias(n) for c, n in zip(carry, names, strict=True)], F.col(text).cast("string").alias("_t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cut in slices(batch):
                counts = count_texts(cut.column(len(names)))
                yield pa.RecordBatch.from_arrays([*cut.columns[:-1], *(pa.array(counts[n]) for n in NAMES)], names=[*names, *NAMES])

    schema = ", ".join([f"{n} {rows.schema[n].dataType.simpleString()}" for n in names] + [f"{n} long" for n in NAMES])
    out = rows.mapInArrow(run, schema)
    return out.select(*[F.col(n).alias(c) for c, n in zip(carry, names, strict=True)], *NAMES)


def slices(batch: pa.RecordBatch, size: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about ``size`` bytes of the text in its last column, at least one row each."""
    _, offsets = text_bytes(batch.column(batch.num_columns - 1))
    i = 0
    while i < batch.num_rows:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + size, side="right")) - 1)
        yield batch.slice(i, j - i)
        i = j


def vectors() -> list[Column]:
    """Fixed-point transforms: log words, log mean word length, and shares of symbols, repeats and repeated lines.

    Repeats have long tails in clean text, most of all in short ones, where one
    repeated phrase is a large share: theirs is the share, not its root, of the
    words and MIN_WORDS more, and repeated lines count by an eighth of their log.
    """
    words = F.greatest(F.col("n_words"), F.lit(1))
    shares = (
        F.log(words) / 4,
        F.log((F.col("word_chars") + 1) / words),
        F.sqrt(F.col("n_symbols") / F.greatest(F.col("word_chars"), F.lit(1))),
        F.col("n_repeat_words") / (words + MIN_WORDS),
        F.log1p(F.col("n_dup_lines").cast("double")) / 8,
    )
    return [F.round(x * SCALE).cast("long").alias(f"x{i}") for i, x in enumerate(shares)]


def moments(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Count, sums and sums of products of the vectors per group; exact. _total is the group's size."""
    total = lambda c: F.sum(c.cast("decimal(18,0)"))
    return rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"),
        F.max("_total").alias("_total"),
        *[total(F.col(f"x{i}")).alias(f"_s{i}") for i in range(DIMS)],
        *[total(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"_q{i}{j}") for i, j in PAIRS],
    )


def centre(d: dict[str, list], r: int, of: str = "") -> tuple[np.ndarray, np.ndarray]:
    """Mean and covariance of row ``r`` of moments, in columns whose names end in ``of``."""
    n = d[f"_n{of}"][r]
    mean = np.array([int(d[f"_s{i}{of}"][r]) / n for i in range(DIMS)])
    cov = np.zeros((DIMS, DIMS))
    for i, j in PAIRS:  # whole numbers until the last division
        cov[i, j] = cov[j, i] = (int(d[f"_q{i}{j}{of}"][r]) * n - int(d[f"_s{i}{of}"][r]) * int(d[f"_s{j}{of}"][r])) / (n * n) / SCALE**2
    return mean / SCALE, cov


def estimates(sums: DataFrame, keys: list[str], share: float | None = None) -> DataFrame:
    """Mean m0.. and inverse covariance p00.. of each group from its moments (one small matrix a row).

    The covariance is scaled to undo that only the nearest rows count: ``share``
    of a normal cloud, by default the counted share of the group.
    """
    schema = sums.schema
    fields = [f"{k} {schema[k].dataType.simpleString()}" for k in keys] + ["_n long"]
    fields += [f"m{i} double" for i in range(DIMS)] + [f"p{i}{j} double" for i, j in PAIRS]
    floor = np.array(LEAST_SD) ** 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            d = {k: batch.column(k).to_pylist() for k in batch.schema.names}
            out: list[list[float]] = []
            for r in range(batch.num_rows):
                mean, cov = centre(d, r)
                inv = np.linalg.inv(cov * consistency(share or d["_n"][r] / d["_total"][r]) + np.diag(floor))
                out.append([*mean, *(inv[i, j] for i, j in PAIRS)])
            cols = [batch.column(k) for k in keys] + [batch.column("_n")]
            cols += [pa.array([row[c] for row in out], pa.float64()) for c in range(DIMS + len(PAIRS))]
            yield pa.RecordBatch.from_arrays(cols, names=[f.split(" ")[0] for f in fields])

    return sums.mapInArrow(run, ", ".join(fields))


def distance() -> Column:
    """Squared Mahalanobis distance of a row joined with its group's estimate."""
    dev = [F.col(f"x{i}") / SCALE - F.col(f"m{i}") for i in range(DIMS)]
    return sum(((1 if i == j else 2) * dev[i] * dev[j] * F.col(f"p{i}{j}") for i, j in PAIRS[1:]), dev[0] * dev[0] * F.col("p00"))


def half(total: Column) -> Column:
    """Rows of a group that an estimate needs for the highest breakdown."""
    return F.least(total, F.floor((total + DIMS + 1) / 2))


def nearest(rows: DataFrame, keys: list[str], need: Callable[[Column], Column] = half) -> DataFrame:
    """Per group its size, and the largest bin of distance that the nearest ``need`` of its rows reach.

    A group's histogram has a bounded number of bins (BINS for each power of two
    that a double can have), so summing it up is a small job for any input.
    """
    bins = rows.groupBy(*keys, "_bin").agg(F.count(F.lit(1)).alias("_c"))
    pair = F.struct(F.col("_bin").cast("long").alias("b"), F.col("_c").alias("c"))
    lists = bins.groupBy(*keys).agg(F.sort_array(F.collect_list(pair)).alias("_b"), F.sum("_c").alias("_total"))
    return lists.select(*keys, "_total", reached("_b", need(F.col("_total"))).alias("_reach"))


def middle(total: Column) -> Column:
    return F.ceil(total / 2)


def reached(pairs: str, need: Column) -> Column:
    """First value at which the counts of a sorted array of (value, count) reach ``need``."""
    step = F.struct(F.lit(0).cast("long").alias("c"), F.lit(None).cast("long").alias("b"))
    return F.aggregate(
        pairs,
        step,
        lambda a, x: F.struct((a["c"] + x["c"]).alias("c"), F.when(a["c"] < need, x["b"]).otherwise(a["b"]).alias("b")),
    )["b"]


def start(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Median and median absolute deviation of each dimension as the first estimate, from exact histograms."""
    flat = rows.select(*keys, F.posexplode(F.array(*[F.col(f"x{i}") for i in range(DIMS)])).alias("_dim", "_x"))
    counts = flat.groupBy(*keys, "_dim", F.expr("_x div 32").alias("b")).agg(F.count(F.lit(1)).alias("c"))
    lists = counts.groupBy(*keys, "_dim").agg(F.sort_array(F.collect_list(F.struct("b", "c"))).alias("_h"), F.sum("c").alias("_n"))
    mid = lists.withColumn("_m", reached("_h", middle(F.col("_n"))))
    away = F.sort_array(F.transform("_h", lambda x: F.struct(F.abs(x["b"] - F.col("_m")).alias("b"), x["c"].alias("c"))))
    both = mid.withColumn("_a", away).withColumn("_a", reached("_a", middle(F.col("_n"))))
    pick = lambda c, i: F.max(F.when(F.col("_dim") == i, F.col(c)))
    wide = both.groupBy(*keys).agg(F.max("_n").alias("_n"), *[pick(c, i).alias(f"{c}{i}") for c in ("_m", "_a") for i in range(DIMS)])
    sd = [F.col(f"_a{i}") * (1.4826 * 32 / SCALE) for i in range(DIMS)]
    return wide.select(
        *keys,
        "_n",
        *[((F.col(f"_m{i}") * 32 + 16) / SCALE).alias(f"m{i}") for i in range(DIMS)],
        *[((1 / (sd[i] * sd[i] + LEAST_SD[i] ** 2)) if i == j else F.lit(0.0)).alias(f"p{i}{j}") for i, j in PAIRS],
    )


def spread() -> Column:
    """How far a group's median squared distance is above a normal cloud's, 1 at least; from nearest(..., middle)."""
    return F.greatest(F.lit(1.0), F.pow(F.lit(2.0), (F.col("_reach") + 0.5) / BINS) / quantile(0.5))


def concentrated(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Minimum-covariance-determinant estimate of each group as moments and spread, by concentration steps.

    The last one counts all rows within the REWEIGHT quantile, measured by the
    group's median distance: as resistant as the nearest half, but less noisy.
    """
    fit = checkpointed(start(rows, keys))
    binned = F.floor(F.log2(F.col("_d") + 1e-9) * BINS).cast("int")

    def place(fit: DataFrame) -> DataFrame:
        placed = join_small(rows, fit.drop("_n"), keys, "inner")
        return placed.select(*rows.columns, distance().alias("_d")).withColumn("_bin", binned)

    for _ in range(STEPS):
        placed = place(fit)
        reach = checkpointed(nearest(placed, keys))
        near = join_small(placed, reach, keys, "inner").where("_bin <= _reach")
        fit = checkpointed(estimates(moments(near, keys), keys))
    placed = place(fit)
    reach = checkpointed(nearest(placed, keys, middle).select(*keys, "_total", spread().alias("_spread")))
    near = join_small(placed, reach, keys, "inner").where(F.col("_d") <= quantile(REWEIGHT) * F.col("_spread"))
    sums = checkpointed(moments(near, keys))
    reach = nearest(place(estimates(sums, keys, REWEIGHT)), keys, middle)
    return checkpointed(join_small(sums, checkpointed(reach.select(*keys, spread().alias("_spread"))), keys, "inner"))


KEYS = ["_lang", "_source"]
PARAMS = [f"m{i}" for i in range(DIMS)] + [f"p{i}{j}" for i, j in PAIRS] + ["cut"]


def measured(df: DataFrame, carry: list[str], text: str, lang: str, source: str) -> DataFrame:
    """``carry`` columns, language and source, the counts, base_failed and the vectors of all texts."""
    prepared = df.select(*carry, df[lang].cast("string").alias("_lang"), df[source].cast("string").alias("_source"), df[text].alias("_text"))
    rows = statistics(prepared, [*carry, *KEYS], "_text")
    failed = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT)
    return rows.select("*", failed.alias("base_failed"), *vectors())


def shrunk(sums: DataFrame) -> DataFrame:
    """Estimate and cutoff of each (language, source) group, drawn towards its language's (_level 1) by MIN_ROWS.

    The weight of n own rows is n^2 / (n^2 + MIN_ROWS^2): a few rows, which junk
    may well be most of, hardly count, and no size switches anything.
    """
    renamed = {c: f"{c}_l" for c in sums.columns if c not in ("_level", *KEYS)}
    languages = sums.where("_level = 1").drop("_level", "_source").withColumnsRenamed(renamed)
    both = join_small(sums.where("_level = 0").drop("_level"), languages, KEYS[:1], "inner")
    floor = np.diag(np.array(LEAST_SD) ** 2)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            d = {k: batch.column(k).to_pylist() for k in batch.schema.names}
            out: list[list[float]] = []
            for r in range(batch.num_rows):
                (mean, cov), (mean_l, cov_l) = centre(d, r), centre(d, r, "_l")
                n, n_l = d["_n"][r], d["_n_l"][r]
                own = n * n / (n * n + MIN_ROWS * MIN_ROWS)
                away = mean - mean_l
                inv = np.linalg.inv(
                    (own * cov + (1 - own) * cov_l) * consistency(REWEIGHT) + own * (1 - own) * np.outer(away, away) + floor
                )
                rows = min(1 / (own * own / n + (1 - own) ** 2 / n_l), n_l)
                wide = own * d["_spread"][r] + (1 - own) * d["_spread_l"][r]
                out.append([*(mean_l + own * away), *(inv[i, j] for i, j in PAIRS), wide * cutoff(rows)])
            cols = [batch.column(k) for k in KEYS] + [pa.array([row[c] for row in out], pa.float64()) for c in range(len(PARAMS))]
            yield pa.RecordBatch.from_arrays(cols, names=[*KEYS, *PARAMS])

    return both.mapInArrow(run, ", ".join([f"{k} string" for k in KEYS] + [f"{p} double" for p in PARAMS]))


def fit(rows: DataFrame) -> DataFrame:
    """Estimates of the (language, source) groups of measured rows, of those that pass the fixed rule.

    ``rows`` is read many times: give it checkpointed.
    """
    good = rows.where("not base_failed").select(*KEYS, *[f"x{i}" for i in range(DIMS)])
    levels = good.withColumn("_level", F.explode(F.array(F.lit(0), F.lit(1))))
    levels = levels.withColumn("_source", F.when(F.col("_level") == 0, F.col("_source")))
    return checkpointed(shrunk(concentrated(levels, ["_level", *KEYS])))


def verdict(rows: DataFrame, fitted: DataFrame) -> DataFrame:
    """Measured rows with kept and distance instead of the vectors."""
    result = [c for c in rows.columns if c not in (*KEYS, *[f"x{i}" for i in range(DIMS)])]
    kept = ~F.col("base_failed") & (F.col("distance") <= F.col("cut"))
    return join_small(rows, fitted, KEYS, "left").withColumn("distance", distance()).select(*result, kept.alias("kept"), "distance")


def judge(df: DataFrame, carry: list[str], text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """One row per input row: ``carry``, the five counts, base_failed, kept, distance.

    Small groups are held against an estimate that is mostly their language's,
    never another's; in a language of few documents that pass the fixed rule
    (five at most) only that rule speaks. distance is null where none of the
    group passes it. Null languages and sources are groups of their own; null and empty texts have no
    words and fail the rule; repeated rows are judged alike; an empty table
    gives no rows. Other columns are ignored.
    """
    rows = checkpointed(measured(df, carry, text, lang, source))
    return verdict(rows, fit(rows))


def passing(df: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """The rows of ``df`` that judge() keeps, unchanged; texts are counted twice rather than moved or stored."""
    fitted = fit(checkpointed(measured(df, [], text, lang, source)))
    names = [f"_in{i}" for i in range(len(df.columns))]
    marked = df.toDF(*names)
    of = dict(zip(df.columns, names, strict=True))
    kept = verdict(measured(marked, names, of[text], of[lang], of[source]), fitted).where("kept")
    return kept.select(*[F.col(n).alias(c) for c, n in of.items()])


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, judged."""
    return judge(table(spark, sf_dir, "documents"), ["doc_id"]).drop("distance")
