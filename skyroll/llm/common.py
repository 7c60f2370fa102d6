"""Helpers shared by the operators: tables, checkpoints, skew-safe joins, gapless ranks."""

from __future__ import annotations

import atexit
import ctypes
import math
import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def ship(spark: SparkSession) -> None:
    """Give this package to the executors' Python, once per application (as --py-files does)."""
    sc = spark.sparkContext
    if getattr(sc, "_skyroll_shipped", False):
        return
    top = Path(__file__).resolve().parents[1]
    handle, name = tempfile.mkstemp(prefix="skyroll-", suffix=".zip")
    os.close(handle)
    with zipfile.ZipFile(name, "w") as z:
        for p in sorted(top.rglob("*.py")):
            z.write(p, p.relative_to(top.parent))
    sc.addPyFile(name)
    atexit.register(Path(name).unlink, missing_ok=True)
    sc._skyroll_shipped = True


def give_back() -> None:
    """Return this process's freed memory to the system; allocators keep it otherwise, also in idle Python workers."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # glibc only
        trim(0)


def tidy(fn: Callable) -> Callable:
    """``fn`` on one or two Arrow tables (applyInArrow counts arguments), which gives its memory back after each call."""

    def after(out: pa.Table) -> pa.Table:
        give_back()
        return out

    if fn.__code__.co_argcount == 1:
        return lambda rows: after(fn(rows))
    return lambda left, right: after(fn(left, right))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """A folder of this application's own in the session's ``spark.checkpoint.dir``.

    Only a local master without that setting (tests) gets a folder elsewhere.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        shared = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
        if not shared:
            if not sc.master.startswith("local[") and sc.master != "local":
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            shared = tempfile.mkdtemp(prefix="checkpoint-")
        sc.setCheckpointDir(shared)
    return sc.getCheckpointDir()


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written to the shared checkpoint folder, so later jobs neither repeat nor lose it."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> DataFrame:
    """Like checkpointed(), as a Parquet table: its size is known from its files, so plans over many rounds stay small."""
    path = f"{shared_folder(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def numbered(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """``df`` with a long ``name`` that counts rows from 0 without gaps by ``order`` (nulls first), and _part.

    A range partitioning deals the rows out, equal ones too; only the number
    of rows of each partition is summed in one task. The result is written.
    """
    spread = df.withColumn("_salt", F.xxhash64(F.monotonically_increasing_id()))
    dealt = spread.repartitionByRange(*order, "_salt").sortWithinPartitions(*order, "_salt").drop("_salt")
    part = F.spark_partition_id()
    row = F.monotonically_increasing_id() - F.shiftleft(part.cast("long"), 33)
    rows = written(dealt.select("*", part.alias("_part"), row.alias("_row")))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = rows.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    starts = sizes.select("_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"))
    return rows.join(F.broadcast(starts), "_part").withColumn(name, F.col("_start") + F.col("_row")).drop("_start", "_row")


def join_small(
    big: DataFrame, small: DataFrame, keys: list[str], how: str = "left", max_rows: int = 100_000, salts: int = 64
) -> DataFrame:
    """Join a large side that may have hot keys with one row per key of ``small``.

    ``small`` is broadcast after a count shows at most ``max_rows`` rows. Beyond
    that every row of ``small`` is repeated once per salt and the rows of ``big``
    are spread over the salts, so a hot key is split over ``salts`` tasks. Keys
    match null-safely. ``small`` should be cheap to read twice.
    """
    renamed = small.select(*[F.col(k).alias(f"_k_{k}") for k in keys], *[c for c in small.columns if c not in keys])
    match = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys]
    if len(small.limit(max_rows + 1).select(F.lit(1)).take(max_rows + 1)) <= max_rows:
        out = big.join(F.broadcast(renamed), match, how)
    else:
        others = [c for c in big.columns if c not in keys] or keys
        spread = F.pmod(F.xxhash64(*[F.col(c).cast("string") for c in others]), F.lit(salts))
        copies = renamed.withColumn("_salt2", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
        out = big.withColumn("_salt", spread).join(copies, [*match, F.col("_salt") == F.col("_salt2")], how)
        out = out.drop("_salt", "_salt2")
    return out.drop(*[f"_k_{k}" for k in keys])


def block_count(df: DataFrame, text: str, block_bytes: int) -> int:
    """Blocks of about ``block_bytes`` of text that ``df`` needs; grows with the input."""
    size = df.agg(F.sum(F.octet_length(F.col(text)).cast("long"))).first()[0] or 0
    return max(1, math.ceil(size / block_bytes))


#: Bits of an id that one level of gapless_starts resolves: at most 2^12, 2^16, 2^16 and 2^20 rows meet in a window.
LEVELS = (12, 28, 44)


def gapless_starts(
    df: DataFrame, group: list[str], key: str, sums: dict[str, str], tie: str | None = None, then: tuple[str, ...] = ()
) -> DataFrame:
    """Add columns: for each out, weight of ``sums`` the sum of weight over the rows of the group that come before.

    Rows are in order of (key, tie); groups must not be null.

    ``key`` is a non-null long. Sums come from a radix tree over the key's
    bits: each level sums its children and runs a window over at most 2^20 of
    them, so no window ever holds a whole group, whatever the group's size.
    ``tie`` is a non-null long below 2^32 that orders rows of one key, with
    levels of its own, and ``then`` orders the few rows that are equal in both.
    ``df`` is read twice: give it checkpointed unless that is cheap.
    """
    chain: list[list[Column]] = []
    if tie:
        chain += [[F.col(key), F.shiftright(tie, 12)], [F.col(key)]]
    chain += [[F.shiftright(key, n)] for n in LEVELS] + [[]]
    names = [[f"_p{i}_{j}" for j in range(len(cols))] for i, cols in enumerate(chain)]
    marked = df.withColumns({n: c for ns, cs in zip(names, chain, strict=True) for n, c in zip(ns, cs, strict=True)})

    def before(level: int, order: list[str], weight: str) -> Column:
        w = Window.partitionBy(*group, *names[level]).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum(weight).over(w), F.lit(0)).cast("long")

    own = [tie, *then] if tie else [key, *then]
    rows = marked.select("*", *[before(0, own, w).alias(out) for out, w in sums.items()])
    totals = marked.select("*", *[F.col(w).cast("long").alias(f"_w_{out}") for out, w in sums.items()])
    offsets = None
    for i in range(len(chain) - 1):
        coarser = [n for ns in names[i + 1 :] for n in ns]
        keys = list(dict.fromkeys([*group, *names[i], *coarser]))
        totals = totals.groupBy(*keys).agg(*[F.sum(f"_w_{out}").alias(f"_w_{out}") for out in sums])
        here = totals.select("*", *[before(i + 1, names[i], f"_w_{out}").alias(f"_o{i}_{out}") for out in sums])
        if offsets is None:
            offsets = here.drop(*[f"_w_{out}" for out in sums])
        else:
            offsets = offsets.join(here.select(*group, *names[i], *[f"_o{i}_{out}" for out in sums]), [*group, *names[i]])
    levels = range(1, len(chain) - 1)
    offset = lambda out: sum((F.col(f"_o{i}_{out}") for i in levels), F.col(f"_o0_{out}"))
    offsets = offsets.select(*group, *names[0], *[offset(out).alias(f"_offset_{out}") for out in sums])
    back = rows.join(offsets, [*group, *names[0]])
    return back.select(*df.columns, *[(F.col(out) + F.col(f"_offset_{out}")).alias(out) for out in sums])
