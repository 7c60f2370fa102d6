"""Operator 12, Merkle dataset manifest: sibling-shift self-joins build the tree of each group and the tree over the groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyroll.llm.common import numbered, table, written

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
NO_STEPS = "array<struct<left:string,right:string>>"


def encoded(value: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of the parts put together."""
    return F.sha2(F.concat(*parts), 256)


def with_siblings(nodes: DataFrame, fanout: int) -> DataFrame:
    """Add left and right: the hashes of the run's other nodes before and after each node, put together.

    A sibling is found by an equijoin with its index: the node's index with
    the lowest bit flipped where runs are pairs, otherwise the run's start plus
    the slot shifted round.
    """
    slot = F.col("idx") % fanout
    out = nodes
    for d in range(1, fanout):
        other = F.col("idx").bitwiseXOR(F.lit(1).cast("long")) if fanout == 2 else F.col("idx") - slot + (slot + d) % fanout
        found = nodes.select(F.col("tree").alias("_tree"), F.col("idx").alias("_idx"), F.col("hash").alias(f"_h{d}"))
        out = out.withColumn("_other", other)
        out = out.join(found, (F.col("tree") == F.col("_tree")) & (F.col("_other") == F.col("_idx")), "left").drop("_tree", "_idx")
    after = F.concat_ws("", *[F.when(slot + d < fanout, F.col(f"_h{d}")) for d in range(1, fanout)])
    before = F.concat_ws("", *[F.when(slot + d >= fanout, F.col(f"_h{d}")) for d in range(1, fanout)])
    return out.select(*nodes.columns, before.alias("left"), after.alias("right"))


def climb(nodes: DataFrame, most: int, fanout: int) -> tuple[list[DataFrame], list[DataFrame]]:
    """Levels of all trees from ``nodes`` (tree, idx, size, hash, more) up; ``most`` is the size of the largest tree.

    Gives each level's nodes that have a parent, with their siblings, and each
    level's tops: nodes alone in their tree. More columns stay on the lowest level.
    """
    levels, tops = [], []
    while True:
        tops.append(nodes.where("size = 1"))
        if most <= 1:
            return levels, tops
        level = written(with_siblings(nodes.where("size > 1"), fanout))
        levels.append(level)
        parents = level.where(F.col("idx") % fanout == 0)
        nodes = parents.select(
            "tree",
            F.expr(f"idx div {fanout}").alias("idx"),
            F.expr(f"(size + {fanout - 1}) div {fanout}").alias("size"),
            digest(F.col("hash"), F.col("right")).alias("hash"),
        )
        most = -(-most // fanout)


def descend(levels: list[DataFrame], tops: list[DataFrame], above: DataFrame, fanout: int, more: list[str]) -> DataFrame:
    """Nodes of the lowest level with their steps up to the root: each step the siblings before and after.

    ``above`` has the steps that follow a tree's top (tree, steps) and any
    columns that every node of the tree gets.
    """
    given = [c for c in above.columns if c not in ("tree", "steps")]
    started = [top.join(above, "tree") for top in tops]
    below = None
    for i in reversed(range(len(tops))):
        kept = more if i == 0 else []
        here = started[i].select("tree", "idx", *given, "steps", *kept)
        if below is not None:
            parent = below.select(F.col("tree").alias("_tree"), F.col("idx").alias("_idx"), *given, F.col("steps").alias("_steps"))
            level = levels[i].join(parent, (F.col("tree") == F.col("_tree")) & (F.expr(f"idx div {fanout}") == F.col("_idx")))
            steps = F.concat(F.array(F.struct("left", "right")), F.col("_steps"))
            here = here.unionByName(level.select("tree", "idx", *given, steps.alias("steps"), *kept))
        below = here
    return below


def manifest(
    df: DataFrame,
    key: str = "doc_id",
    group: str = "source",
    fields: tuple[str, ...] = FIELDS,
    fanout: int = 3,
    tampered: dict[str, Column] | None = None,
) -> DataFrame:
    """One row per input row: ``key``, leaf, subroot, root, steps, folded_root, verified.

    A leaf is the digest of the row's ``fields``. The leaves of a group ascend
    by (key, leaf); runs of ``fanout`` become their parent until one node, the
    subroot, is left. The subroots, by group, become the root likewise.
    ``steps`` is the row's proof: for each level the hashes of the siblings
    before and after. ``folded_root`` is what the steps make of the leaf with
    the values of ``tampered`` in place of the fields' own.

    Nulls: a null field is encoded as ``-``, a null group is a group that comes
    first, a null key comes first in its group. Rows that repeat are leaves of
    their own. A lone leaf is its group's subroot, a lone subroot the root. An
    empty table gives no rows; other columns are ignored.
    """
    changed = [(tampered or {}).get(f, F.col(f)) for f in fields]
    leaves = df.select(
        F.col(key).cast("long").alias("_key"),
        F.col(group).cast("string").alias("_group"),
        digest(*[encoded(F.col(f)) for f in fields]).alias("leaf"),
        digest(*[encoded(c) for c in changed]).alias("candidate"),
    )
    at = numbered(leaves, ["_group", "_key", "leaf"], "_at")
    # the rows of one group in one partition, so that a group of any size is no hot key
    runs = at.groupBy("_part", "_group").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    groups = runs.groupBy("_group").agg(F.min("_first").alias("tree"), F.sum("_rows").alias("size"))
    groups = written(numbered(groups, ["tree"], "place").drop("_part"))
    heads = runs.join(groups.withColumnRenamed("_group", "_g"), F.col("_group").eqNullSafe(F.col("_g"))).select(
        F.col("_part").alias("_p"), "_g", "tree", "size"
    )
    nodes = at.join(heads, (F.col("_part") == F.col("_p")) & F.col("_group").eqNullSafe(F.col("_g")))
    nodes = written(nodes.select("tree", (F.col("_at") - F.col("tree")).alias("idx"), "size", F.col("leaf").alias("hash"), "_key", "candidate"))

    most, count = groups.agg(F.max("size"), F.count(F.lit(1))).first()
    levels, tops = climb(nodes, most or 0, fanout)
    subroots = tops[0].select("tree", "hash")
    for top in tops[1:]:
        subroots = subroots.unionByName(top.select("tree", "hash"))
    of_groups = written(
        groups.join(subroots, "tree").select(
            F.lit(0).cast("long").alias("tree"), F.col("place").alias("idx"), F.lit(count).cast("long").alias("size"), "hash", F.col("tree").alias("_tree_below")
        )
    )
    group_levels, group_tops = climb(of_groups, count, fanout)
    root = group_tops[-1].select("tree", F.col("hash").alias("root"), F.array().cast(NO_STEPS).alias("steps"))
    above = descend(group_levels, group_tops, root, fanout, ["hash", "_tree_below"])
    above = written(above.select(F.col("_tree_below").alias("tree"), F.col("hash").alias("subroot"), "root", "steps"))
    rows = descend(levels, tops, above, fanout, ["hash", "_key", "candidate"])
    folded = F.aggregate("steps", F.col("candidate"), lambda h, s: digest(s["left"], h, s["right"]))
    rows = rows.select(F.col("_key").alias(key), F.col("hash").alias("leaf"), "subroot", "root", "steps", folded.alias("folded_root"))
    return rows.withColumn("verified", F.col("folded_root") == F.col("root"))


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, runs of three; tampering deletes the line ends of the texts whose key has an even crc32."""
    docs = table(spark, sf_dir, "documents")
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    cut = F.when(even, F.replace(F.col("text"), F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    proof = F.array_join(F.transform("steps", lambda s: F.concat(s["left"], s["right"])), "")
    rows = manifest(docs, tampered={"text": cut})
    return rows.select("doc_id", "leaf", "subroot", "root", F.sha2(proof, 256).alias("proof_sha256"), "folded_root", "verified")


#: The trees by a recursive query; crc32 byte by byte with a table made from its polynomial.
OP12_SQL = """
WITH RECURSIVE bits(i, k, c) AS (
  SELECT i::BIGINT, 0, i::BIGINT FROM range(256) t(i)
  UNION ALL
  SELECT i, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM bits WHERE k < 8
),
crc_table AS (SELECT list(c ORDER BY i) AS t FROM bits WHERE k = 8),
crcs AS (
  SELECT doc_id, xor(list_reduce(
      [4294967295::BIGINT] || list_transform(range(strlen(doc_id::VARCHAR)), lambda i: ascii(substr(doc_id::VARCHAR, i + 1, 1))::BIGINT),
      lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1])), 4294967295) AS crc
  FROM (SELECT DISTINCT doc_id FROM documents WHERE doc_id IS NOT NULL), crc_table
),
coded AS (
  SELECT d.doc_id, d.source,
    coalesce(strlen(d.doc_id::VARCHAR) || ':' || d.doc_id, '-') || coalesce(strlen(d.source) || ':' || d.source, '-')
      || coalesce(strlen(d.lang) || ':' || d.lang, '-') || coalesce(strlen(d.n_chars::VARCHAR) || ':' || d.n_chars, '-') AS head,
    d.text, CASE WHEN c.crc % 2 = 0 THEN replace(d.text, chr(10), '') ELSE d.text END AS cut
  FROM documents d LEFT JOIN crcs c ON d.doc_id = c.doc_id
),
leaves AS (
  SELECT doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
    sha256(head || coalesce(strlen(cut) || ':' || cut, '-')) AS candidate
  FROM coded
),
placed AS (
  SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree,
    row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx,
    count(*) OVER (PARTITION BY source) AS size
  FROM leaves
),
tree(tree, lvl, idx, size, h) AS (
  SELECT tree, 0, idx, size, leaf FROM placed
  UNION ALL
  SELECT tree, any_value(lvl) + 1, idx // 3, (any_value(size) + 2) // 3, sha256(string_agg(h, '' ORDER BY idx))
  FROM tree WHERE size > 1 GROUP BY tree, idx // 3
),
subroots AS (SELECT tree, h, count(*) OVER () AS n FROM tree WHERE size = 1),
top(lvl, idx, size, h) AS (
  SELECT 0, tree, n, h FROM subroots
  UNION ALL
  SELECT any_value(lvl) + 1, idx // 3, (any_value(size) + 2) // 3, sha256(string_agg(h, '' ORDER BY idx))
  FROM top WHERE size > 1 GROUP BY idx // 3
),
steps(tree, idx, step, sides) AS (
  SELECT p.tree, p.idx, t.lvl,
    [coalesce(string_agg(t.h, '' ORDER BY t.idx) FILTER (WHERE t.idx < p.idx // CAST(pow(3, t.lvl) AS BIGINT)), ''),
     coalesce(string_agg(t.h, '' ORDER BY t.idx) FILTER (WHERE t.idx > p.idx // CAST(pow(3, t.lvl) AS BIGINT)), '')]
  FROM placed p JOIN tree t ON t.tree = p.tree AND t.size > 1 AND t.idx // 3 = p.idx // CAST(pow(3, t.lvl + 1) AS BIGINT)
  GROUP BY p.tree, p.idx, t.lvl
),
top_steps(tree, step, sides) AS (
  SELECT s.tree, 1000 + t.lvl,
    [coalesce(string_agg(t.h, '' ORDER BY t.idx) FILTER (WHERE t.idx < s.tree // CAST(pow(3, t.lvl) AS BIGINT)), ''),
     coalesce(string_agg(t.h, '' ORDER BY t.idx) FILTER (WHERE t.idx > s.tree // CAST(pow(3, t.lvl) AS BIGINT)), '')]
  FROM subroots s JOIN top t ON t.size > 1 AND t.idx // 3 = s.tree // CAST(pow(3, t.lvl + 1) AS BIGINT)
  GROUP BY s.tree, t.lvl
),
proofs AS (
  SELECT p.tree, p.idx, list(a.sides ORDER BY a.step) AS sides
  FROM placed p JOIN (
    SELECT * FROM steps UNION ALL SELECT p.tree, p.idx, s.step, s.sides FROM placed p JOIN top_steps s USING (tree)
  ) a ON a.tree = p.tree AND a.idx = p.idx
  GROUP BY p.tree, p.idx
),
joined AS (
  SELECT p.doc_id, p.leaf, s.h AS subroot, (SELECT h FROM top WHERE size = 1) AS root,
    p.candidate, coalesce(f.sides, []) AS sides
  FROM placed p JOIN subroots s ON s.tree = p.tree LEFT JOIN proofs f ON f.tree = p.tree AND f.idx = p.idx
),
folded AS (
  SELECT *, list_reduce([[candidate, '']] || sides, lambda a, s: [sha256(s[1] || a[1] || s[2]), ''])[1] AS folded_root FROM joined
)
SELECT doc_id, leaf, subroot, root,
  sha256(array_to_string(list_transform(sides, lambda s: s[1] || s[2]), '')) AS proof_sha256,
  folded_root, folded_root = root AS verified
FROM folded
"""
