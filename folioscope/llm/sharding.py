"""Uniform shuffle into shards of exact size by a hypergeometric communication matrix.

A uniform random permutation of N rows that lie in P source partitions sends to every shard a
number of rows per partition that follows the multivariate hypergeometric law with the partition
sizes and the shard sizes as margins. The operator draws this P x K matrix first, permutes each
partition locally, hands the leading rows of the permuted partition to the shards as the matrix
says, exchanges, and permutes every shard again. Sizes are exact, and one row moves once.

Everything is DataFrame and SQL functions. The matrix is drawn in two levels (groups of about
sqrt(P) partitions, then the partitions of each group in parallel), so no fold is longer than sqrt(P).

Defined results: an empty table gives no rows; repeated rows are placed one by one; null columns
are carried along; input columns are kept, but ``shard`` or ``slot`` is replaced; very long texts move like any other
row, so callers pass digests and ids where texts needn't move. Ties of the random keys go by the row's number.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from folioscope.llm.common import make_room, settle, table, utf8_size

SHARDS = 24
#: Rows that one task orders in the second permutation, on average.
BLOCK_ROWS = 100_000
#: Half width of the summed part of the distribution in standard deviations; the tails beyond weigh less than 1e-30.
WIDTH = 12


def _let(name: str, value: str, body: str) -> str:
    """SQL for ``body`` with ``name`` bound to ``value``."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def _hypergeometric(total: str, marked: str, drawn: str, u: str) -> str:
    """SQL that draws how many of ``marked`` rows are among ``drawn`` of ``total``, by inversion of ``u``.

    Weights relative to the mode follow from the ratio of neighbours, so no factorials occur.
    The values are enumerated from the mode upwards, then downwards.
    """
    up = "(d.marked - x) / (x + 1D) * ((d.drawn - x) / (d.pool - d.marked - d.drawn + x + 1D))"
    down = "x / (d.marked - x + 1D) * ((d.pool - d.marked - d.drawn + x) / (d.drawn - x + 1D))"
    above = "if(d.hi > d.mode, sequence(d.mode, d.hi - 1), array())"
    below = "if(d.lo < d.mode, sequence(d.mode, d.lo + 1, -1L), array())"

    def mass(values: str, ratio: str) -> str:
        return (
            f"aggregate({values}, named_struct('w', 1D, 's', 0D), "
            f"(t, x) -> named_struct('w', t.w * {ratio}, 's', t.s + t.w * {ratio})).s"
        )

    def find(values: str, ratio: str, step: int, target: str) -> str:
        return (
            f"aggregate({values}, named_struct('w', 1D, 's', 0D, 'v', -1L), (t, x) -> named_struct("
            f"'w', t.w * {ratio}, 's', t.s + t.w * {ratio}, "
            f"'v', if(t.v < 0 AND t.s + t.w * {ratio} > {target}, x + ({step}), t.v))).v"
        )

    pick = (
        "CASE WHEN e.at < 1 THEN d.mode "
        f"WHEN e.at < 1 + e.up THEN {find(above, up, 1, '(e.at - 1)')} "
        f"ELSE {find(below, down, -1, '(e.at - 1 - e.up)')} END"
    )
    chosen = _let(
        "f",
        f"named_struct('up', {mass(above, up)}, 'down', {mass(below, down)})",
        _let("e", f"named_struct('up', f.up, 'at', {u} * (1 + f.up + f.down))", f"if({pick} < 0, d.mode, {pick})"),
    )
    spread = f"CAST(ceil({WIDTH} * sqrt(c.drawn * (c.marked / CAST(c.pool AS DOUBLE)) * (1 - c.marked / CAST(c.pool AS DOUBLE)) * ((c.pool - c.drawn) / greatest(c.pool - 1D, 1D))) + {WIDTH}) AS BIGINT)"
    mode = "CAST(floor((c.drawn + 1D) * ((c.marked + 1D) / (c.pool + 2D))) AS BIGINT)"
    bounds = (
        f"named_struct('pool', c.pool, 'marked', c.marked, 'drawn', c.drawn, "
        f"'mode', greatest(c.low, least(c.high, {mode})), "
        f"'lo', greatest(c.low, least(c.high, {mode}) - {spread}), 'hi', least(c.high, greatest(c.low, {mode}) + {spread}))"
    )
    margins = (
        f"named_struct('pool', {total}, 'marked', {marked}, 'drawn', {drawn}, "
        f"'low', greatest(0L, {drawn} + {marked} - {total}), 'high', least({drawn}, {marked}))"
    )
    return f"if({total} <= 0 OR {marked} <= 0 OR {drawn} <= 0, 0L, {_let('c', margins, _let('d', bounds, chosen))})"


def _deal(members: str, capacity: str, seed: int) -> str:
    """SQL: for each of ``members`` (array of id, n) the rows it sends to each shard; ``capacity`` is what the shards take."""
    u = f"(pmod(xxhash64({seed}, m.id, k), 9007199254740992L) + 0.5D) / 9007199254740992D"
    draw = _hypergeometric("b.pool", "element_at(a.room, CAST(k AS INT))", "b.left", u)
    row = (
        f"aggregate(sequence(1L, CAST(size(a.room) AS BIGINT)), "
        f"named_struct('pool', aggregate(a.room, 0L, (s, r) -> s + r), 'left', m.n, 'sent', CAST(array() AS ARRAY<BIGINT>)), "
        f"(b, k) -> {_let('h', draw, "named_struct('pool', b.pool - element_at(a.room, CAST(k AS INT)), 'left', b.left - h, 'sent', array_append(b.sent, h))")}, b -> b.sent)"
    )
    step = _let(
        "g",
        row,
        "named_struct('room', zip_with(a.room, g, (r, s) -> r - s), 'sent', array_append(a.sent, named_struct('id', m.id, 'sent', g)))",
    )
    start = f"named_struct('room', {capacity}, 'sent', CAST(array() AS ARRAY<STRUCT<id: BIGINT, sent: ARRAY<BIGINT>>>))"
    return f"aggregate({members}, {start}, (a, m) -> {step}, a -> a.sent)"


def communication_matrix(counts: DataFrame, shards: int, seed: int, groups: int) -> DataFrame:
    """(src, n) -> (src, ends): ``ends[k]`` is how many rows of the partition go to the shards 0 to k.

    ``counts`` has a row per source partition. Shard sizes differ by one at most.
    """
    grouped = (
        counts.withColumn("g", F.col("src") % F.lit(groups))
        .groupBy("g")
        .agg(
            F.array_sort(F.collect_list(F.struct(F.col("src").cast("long").alias("id"), F.col("n").cast("long").alias("n")))).alias("members"),
            F.sum("n").cast("long").alias("n"),
        )
    )
    level1 = grouped.groupBy().agg(
        F.array_sort(F.collect_list(F.struct(F.col("g").cast("long").alias("id"), F.col("n").alias("n")))).alias("members"),
        F.sum("n").cast("long").alias("rows"),
    )
    capacity = f"transform(sequence(0L, {shards - 1}L), k -> CAST(rows div {shards} + if(k < rows % {shards}, 1, 0) AS BIGINT))"
    to_group = level1.where("rows > 0").select(F.explode(F.expr(_deal("members", capacity, seed))).alias("d"))
    dealt = (
        grouped.join(to_group.select(F.col("d.id").alias("g"), F.col("d.sent").alias("room")), "g")
        .select(F.explode(F.expr(_deal("members", "room", seed + 1))).alias("d"))
    )
    ends = "transform(sequence(1, size(d.sent)), i -> aggregate(slice(d.sent, 1, i), 0L, (s, x) -> s + x))"
    return dealt.select(F.col("d.id").alias("src"), F.expr(ends).alias("ends"))


def shuffle_into_shards(df: DataFrame, shards: int = SHARDS, seed: int = 20260) -> DataFrame:
    """``df`` with ``shard`` (int, 0 to shards-1) and ``slot`` (long, gapless from 0 within the shard).

    Pass only the columns that should move. The input is checkpointed once with its partition
    number and a random key, so that all later steps see the same partitions even after a loss.
    """
    df = make_room(df, "shard", "slot")
    if shards < 1:
        raise ValueError("at least one shard is needed")
    names = [F.col(f"`{c}`") for c in df.columns]
    placed = settle(
        df.select(
            F.struct(*names).alias("row"),
            F.spark_partition_id().cast("long").alias("src"),
            F.monotonically_increasing_id().alias("id"),
        )
    ).withColumn("key", F.xxhash64(F.lit(seed), "id"))
    counts = placed.groupBy("src").agg(F.count("*").alias("n"))
    rows, sources = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    matrix = communication_matrix(counts, shards, seed, max(1, math.isqrt(sources)))
    local = placed.withColumn("rank", F.row_number().over(Window.partitionBy("src").orderBy("key", "id")) - 1)
    sent = local.join(matrix, "src").select(
        "row",
        "id",
        F.expr("CAST(size(filter(ends, e -> e <= rank)) AS INT)").alias("shard"),
        F.xxhash64(F.lit(seed + 7), "id").alias("key"),
    )
    blocks = max(1, -(-rows // (shards * BLOCK_ROWS)))
    sent = sent.withColumn("block", F.pmod(F.xxhash64(F.lit(seed + 9), "id"), F.lit(blocks)))
    starts = (
        sent.groupBy("shard", "block").agg(F.count("*").alias("n"))
        .withColumn("start", F.sum("n").over(Window.partitionBy("shard").orderBy("block")) - F.col("n"))
        .drop("n")
    )
    inside = F.row_number().over(Window.partitionBy("shard", "block").orderBy("key", "id"))
    return (
        sent.withColumn("inside", inside)
        .join(starts, ["shard", "block"])
        .select("row.*", "shard", (F.col("start") + F.col("inside") - 1).cast("long").alias("slot"))
    )


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 shards whose row counts differ by one at most."""
    docs = table(spark, sf_dir, "documents").select(
        "doc_id",
        (utf8_size("text") + 8).alias("size"),
        F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"),
    )
    return shuffle_into_shards(docs).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
