"""Merkle manifest of a dataset: a hash of every row, of every source and of the whole.

A leaf is the hash of a row's fields; per source, in the order of ids, every ``FANOUT`` consecutive
nodes become the hash of their joined digests, level by level, until one is left: the source's
subroot. Subroots become the root by the same levels. Hashes are SHA-256 of digests as hex text.

1. Row numbers. Leaves are dealt by range over (source, id, leaf), so that a source with a third of all
   rows lies in many parts; ``row_number`` counts within a part, and parts' own counts (a row per part
   and source) are summed to offsets. No task holds a source.
2. Up. A level is grouped by (tree, number div FANOUT); a group has FANOUT children at most, whose
   sorted array is hashed into the parent. Levels shrink by FANOUT, so all of them cost half a table more.
3. Down. A level is joined with its parents; each node appends its siblings in front of the parent's
   proof, up to the root. A proof is a list of (before, after): digests left and right of the own one.

Every level is written in the shared folder, so a lost executor costs its tasks alone.

Defined results: null fields are ``-``, so null and empty differ; rows with a null source are a source of
their own, which comes first; null ids come first in their source; rows with one id are ordered by their
leaf, equal rows in any order; one row alone is leaf and subroot; an empty table has no rows and no root;
a very long text is hashed whole where it is read and never travels; other columns play no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folioscope.llm.common import Scratch, table

FANOUT = 3
#: Fields of a leaf, in this order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Rows of one range part, about 200 bytes each.
PART_ROWS = 250_000
LEAST_PARTS = 24

NO_PROOF = "CAST(array() AS array<struct<before:string,after:string>>)"


def digest(text: Column) -> Column:
    """Lowercase hex SHA-256 of a text."""
    return F.sha2(text.cast("binary"), 256)


def field_text(value: Column) -> Column:
    """A field as it enters a leaf: byte count, colon and value, or a dash for null."""
    shown = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(shown).cast("string"), F.lit(":"), shown), F.lit("-"))


def leaf_hash(columns: dict[str, Column]) -> Column:
    """Hash of a row's fields."""
    return digest(F.concat(*[field_text(c) for c in columns.values()]))


def numbered(nodes: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """``nodes`` (tree, a number ``ord`` and ``hash``, which order them, and others) with ``idx`` in the tree and ``n``, the tree's size."""
    parts = max(LEAST_PARTS, -(-nodes.count() // PART_ROWS))
    ranged = nodes.repartitionByRange(parts, "tree", F.col("ord").asc_nulls_first(), "hash", F.monotonically_increasing_id())
    ranged = scratch.settle(ranged.withColumn("part", F.spark_partition_id()), f"{name}-ranged")
    before = Window.partitionBy("tree").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = scratch.settle(
        ranged.groupBy("tree", "part").count()
        .withColumn("offset", F.coalesce(F.sum("count").over(before), F.lit(0)))
        .withColumn("n", F.sum("count").over(Window.partitionBy("tree"))).select("tree", "part", "offset", "n"), f"{name}-counts",
    )
    within = Window.partitionBy("tree", "part").orderBy(F.col("ord").asc_nulls_first(), "hash")
    placed = ranged.withColumn("place", F.row_number().over(within)).join(counts, ["tree", "part"])
    out = scratch.settle(placed.withColumn("idx", F.col("offset") + F.col("place") - 1).drop("part", "place", "offset"), f"{name}-0")
    scratch.drop(f"{name}-ranged")
    return out


def raised(level: DataFrame, fanout: int) -> DataFrame:
    """The parents (tree, idx, n, kids, hash) of a level's nodes in trees of several nodes."""
    kids = F.transform(F.array_sort(F.collect_list(F.struct("idx", "hash"))), lambda k: k.hash)
    parents = level.where("n > 1").groupBy("tree", F.expr(f"idx div {fanout}").alias("idx"), F.expr(f"(n + {fanout - 1}) div {fanout}").alias("n")).agg(kids.alias("kids"))
    return parents.withColumn("hash", digest(F.array_join("kids", "")))


def climb(leaves: DataFrame, scratch: Scratch, name: str, fanout: int = FANOUT) -> list[DataFrame]:
    """All levels over numbered leaves; a tree ends with the level in which it has one node."""
    levels, size = [leaves], leaves.agg(F.max("n")).first()[0] or 0
    while size > 1:
        levels.append(scratch.settle(raised(levels[-1], fanout), f"{name}-{len(levels)}"))
        size = -(-size // fanout)
    return levels


def siblings(kids: str, fanout: int) -> Column:
    """The other digests of a node's run, (before, after) its own place."""
    place = F.expr(f"CAST(idx % {fanout} AS INT)")
    return F.struct(F.array_join(F.slice(kids, F.lit(1), place), "").alias("before"), F.array_join(F.slice(kids, place + 2, F.lit(fanout)), "").alias("after"))


def descend(levels: list[DataFrame], above: DataFrame, scratch: Scratch, name: str, fanout: int = FANOUT) -> DataFrame:
    """The leaves with ``proof`` and ``subroot``; ``above`` has (tree, proof): what lies over the top of each tree."""
    proved = None
    for i in range(len(levels) - 1, -1, -1):
        level = levels[i]
        found = level.where("n = 1").join(above, "tree").withColumn("subroot", F.col("hash")).select(*level.columns, "subroot", "proof")
        if proved is not None:
            parents = proved.select("tree", F.col("idx").alias("up"), F.col("kids").alias("run"), "subroot", F.col("proof").alias("rest"))
            below = level.where("n > 1").withColumn("up", F.expr(f"idx div {fanout}")).join(parents, ["tree", "up"])
            found = found.union(below.select(*level.columns, "subroot", F.concat(F.array(siblings("run", fanout)), "rest").alias("proof")))
        proved = scratch.settle(found, f"{name}-proof-{i}")
    return proved


def fold(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(proof, leaf, lambda held, s: digest(F.concat(s.before, held, s.after)))


def proof_hash(proof: Column) -> Column:
    """Hash of all siblings, from the leaf's to those below the root, left to right."""
    return digest(F.array_join(F.transform(proof, lambda s: F.concat(s.before, s.after)), ""))


def merkle_manifest(docs: DataFrame, doc_id: str = "doc_id", source: str = "source", fields: tuple[str, ...] = FIELDS, changed: dict[str, Column] | None = None, fanout: int = FANOUT) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof, changed_leaf) of every row.

    ``changed`` replaces fields as a later reader may find them; ``changed_leaf`` is their hash, to be folded with ``proof``.
    """
    scratch = Scratch(docs.sparkSession, "manifest")
    columns = {f: F.col(f"`{f}`") for f in fields}
    leaves = docs.select(
        F.coalesce(F.concat(F.lit("s"), F.col(f"`{source}`").cast("string")), F.lit("-")).alias("tree"),  # a dash comes before all others
        F.col(f"`{doc_id}`").alias("ord"), leaf_hash(columns).alias("hash"), leaf_hash(columns | (changed or {})).alias("changed_leaf"),
    )
    leaves = scratch.settle(leaves, "leaves")
    levels = climb(numbered(leaves, scratch, "rows"), scratch, "rows", fanout)
    scratch.drop("leaves")
    tops = [level.where("n = 1").select(F.lit("").alias("tree"), F.col("tree").alias("ord"), "hash") for level in levels]
    subroots = tops[0]
    for t in tops[1:]:
        subroots = subroots.union(t)
    upper = climb(numbered(subroots, scratch, "sources"), scratch, "sources", fanout)
    none = docs.sparkSession.range(1).select(F.lit("").alias("tree"), F.expr(NO_PROOF).alias("proof"))
    tree_proofs = descend(upper, none, scratch, "sources", fanout)
    # of the trees over sources there is one, so its subroot is the root
    proofs = scratch.settle(tree_proofs.select(F.col("ord").alias("tree"), "proof", F.col("subroot").alias("root")), "above")
    rows = descend(levels, proofs.select("tree", "proof"), scratch, "rows", fanout)
    root = proofs.select("root").limit(1)
    scratch.drop(*[f"rows-{i}" for i in range(len(levels))], *[f"rows-proof-{i}" for i in range(1, len(levels))])
    root_hash = (root.first() or [None])[0]
    return rows.select(F.col("ord").alias("doc_id"), F.col("hash").alias("leaf"), "subroot", F.lit(root_hash).cast("string").alias("root"), "proof", "changed_leaf")


def checked(manifest: DataFrame, leaf: str = "changed_leaf") -> DataFrame:
    """``manifest`` with ``folded_root`` of the given leaf and the stored siblings, and whether it is the root."""
    folded = manifest.withColumn("folded_root", fold(F.col(leaf), F.col("proof")))
    return folded.withColumn("verified", F.col("folded_root") == F.col("root"))


def op11_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merkle manifest of documents; every second row (by the id's CRC) is checked without its line breaks."""
    docs = table(spark, sf_dir, "documents").select(*FIELDS)
    tampered = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, F.lit(False))
    later = F.when(tampered, F.translate("text", "\n", "")).otherwise(F.col("text"))
    rows = checked(merkle_manifest(docs, changed={"text": later}))
    return rows.select("doc_id", "leaf", "subroot", "root", proof_hash(F.col("proof")).alias("proof_sha256"), "folded_root", "verified")


OP11_SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, CASE WHEN source IS NULL THEN '-' ELSE 's' || source END AS tree, text,
  coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS head FROM documents),
bits AS (SELECT DISTINCT doc_id, list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: [ascii(c)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
  lambda a, b: xor(xor(a, b) >> 1, 3988292384 * (xor(a, b) & 1))) & 1 = 1 AS even FROM documents WHERE doc_id IS NOT NULL),
l AS (SELECT doc_id, tree, head, text, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf FROM d),
z AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id, leaf) - 1 AS idx, count(*) OVER (PARTITION BY tree) AS n FROM l),
up AS (SELECT 0 AS lvl, tree, idx, n, leaf AS h FROM z UNION ALL
  SELECT lvl + 1, tree, idx // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY idx)) FROM up WHERE n > 1 GROUP BY lvl, tree, idx // 3, (n + 2) // 3),
tops AS (SELECT tree, h, lvl, row_number() OVER (ORDER BY encode(tree)) - 1 AS idx, count(*) OVER () AS n FROM up WHERE n = 1),
up2 AS (SELECT 0 AS lvl, idx, n, h FROM tops UNION ALL
  SELECT lvl + 1, idx // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY idx)) FROM up2 WHERE n > 1 GROUP BY lvl, idx // 3, (n + 2) // 3),
nodes AS (SELECT 0 AS top, tree, lvl, idx, n, h FROM up UNION ALL SELECT 1, '', lvl, idx, n, h FROM up2),
sib AS (SELECT a.top, a.tree, a.lvl, a.idx, a.n, coalesce(string_agg(b.h, '' ORDER BY b.idx) FILTER (WHERE b.idx < a.idx), '') AS bef, coalesce(string_agg(b.h, '' ORDER BY b.idx) FILTER (WHERE b.idx > a.idx), '') AS aft
  FROM nodes a JOIN nodes b ON a.top = b.top AND a.tree = b.tree AND a.lvl = b.lvl AND a.idx // 3 = b.idx // 3 WHERE a.n > 1 GROUP BY ALL),
steps AS (SELECT z.tree, z.idx AS leaf_idx, s.lvl AS k, bef, aft FROM z JOIN sib s ON s.top = 0 AND s.tree = z.tree AND s.idx = z.idx // CAST(pow(3, s.lvl) AS BIGINT)
  UNION ALL SELECT z.tree, z.idx, 1000 + s.lvl, bef, aft FROM z JOIN tops t ON t.tree = z.tree JOIN sib s ON s.top = 1 AND s.idx = t.idx // CAST(pow(3, s.lvl) AS BIGINT)),
ordered AS (SELECT *, row_number() OVER (PARTITION BY tree, leaf_idx ORDER BY k) AS step FROM steps),
start AS (SELECT tree, idx AS leaf_idx, sha256(head || coalesce(strlen(c) || ':' || c, '-')) AS h FROM
  (SELECT *, CASE WHEN even THEN replace(text, chr(10), '') ELSE text END AS c FROM z LEFT JOIN bits USING (doc_id))),
folded AS (SELECT tree, leaf_idx, 0 AS step, h FROM start UNION ALL
  SELECT f.tree, f.leaf_idx, f.step + 1, sha256(o.bef || f.h || o.aft) FROM folded f JOIN ordered o ON o.tree = f.tree AND o.leaf_idx = f.leaf_idx AND o.step = f.step + 1),
last AS (SELECT tree, leaf_idx, arg_max(h, step) AS folded_root FROM folded GROUP BY 1, 2),
proof AS (SELECT tree, leaf_idx, sha256(string_agg(bef || aft, '' ORDER BY step)) AS proof_sha256 FROM ordered GROUP BY 1, 2)
SELECT z.doc_id, z.leaf, t.h AS subroot, r.h AS root, coalesce(p.proof_sha256, sha256('')) AS proof_sha256, f.folded_root, f.folded_root = r.h AS verified
FROM z JOIN tops t ON t.tree = z.tree JOIN up2 r ON r.n = 1 JOIN last f ON f.tree = z.tree AND f.leaf_idx = z.idx LEFT JOIN proof p ON p.tree = z.tree AND p.leaf_idx = z.idx
"""
