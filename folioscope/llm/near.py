"""Near duplicates by MinHash: many universal hash minima, banding, verification, components by stars.

1. Signatures. A document's set is its distinct word shingles. Of each of ``HASHES`` multiply-shift
   functions (a * x + b modulo 2**64 of a 32-bit shingle number x, upper half) a set keeps the least value.
   ``ROWS`` minima make a band, ``BANDS`` bands a signature. A pair of similarity 0.85 has no band in common
   with probability (1 - 0.85**7)**36, below one in a million, and a more similar one more rarely.
   Documents with equal sets form a class, and one set per class goes on.
2. Buckets. Sets that agree in a band share a bucket. Every member meets the bucket's least set; pairs are
   verified by their signatures: at least ``AGREE`` of the minima must be equal, which a pair of similarity 0.85
   misses with a probability of about 1e-9. Verified pairs make cells by stars. Buckets whose members
   lie in several cells are then compared pair by pair, in blocks of signatures, and only links that join
   cells leave a block. So every pair that shares a bucket and is near enough by its signatures lies in one cell.
3. Confirmation. Cells are compared on full sets, exactly: blocks of a cell's sets meet, and partial overlaps
   of strips are summed as counts. Confirmed links make the components, by stars again.

No group is gathered: buckets' least members come from a grouping, hot buckets and cells are cut into
blocks, pairs inside a block are cells of an array and not rows. A bucket that holds much of the corpus
in several cells costs the square of its size in comparisons of signatures (some nanoseconds each).

The documents are read twice: for signatures, and for the full sets of those that have a candidate.

Defined results: null, empty and wordless texts have the empty set, are linked with nothing and kept; fewer
words than the shingle's make one shingle of the whole; repeated rows are copies of each other; rows with a
null id take their component's smallest id, null where it has none, and are kept only there; an empty table
gives no rows; extra columns play no part. A very long text is one set, hashed in slices. Words, shingles
and classes are compared by 64-bit hashes, taken as random.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscope.llm import hashing, jaccard
from folioscope.llm.common import Scratch, table
from folioscope.llm.stars import star_components

SIZE, PERCENT = 5, 85
BANDS, ROWS = 36, 7
HASHES = BANDS * ROWS
#: Equal minima that a candidate pair must have.
AGREE = 176
#: Shingles that are hashed in one go, so that their values stay in a processor's cache.
SLICE = 128
#: Sets of a block of signatures, and rows of small buckets that are compared in one go.
BLOCK, UNIT = 512, 4_096
#: Shingles and sets of a block of full sets, and strips in which overlaps are counted.
BLOCK_TOKENS, BLOCK_SETS, STRIPS = 300_000, 600, 8

_U = np.uint64
MULTIPLIERS = hashing.mix(np.arange(1, HASHES + 1, dtype=_U) * _U(0x9E3779B97F4A7C15)) | _U(1)
SHIFTS = hashing.mix(MULTIPLIERS + _U(17))


def signature(grams: np.ndarray) -> np.ndarray:
    """Least value of every hash function over a set of shingles."""
    numbers = grams >> _U(32)
    rest = -len(numbers) % SLICE
    numbers = np.concatenate([numbers, numbers[:1].repeat(rest)])  # a repeated shingle changes no minimum
    values = np.empty((HASHES, SLICE), _U)
    least = np.full((HASHES, SLICE), np.iinfo(np.uint64).max, _U)
    for at in range(0, len(numbers), SLICE):
        np.multiply(MULTIPLIERS[:, None], numbers[None, at : at + SLICE], out=values)
        np.add(values, SHIFTS[:, None], out=values)
        np.minimum(least, values, out=least)
    out = least.min(axis=1)
    return out >> _U(32)


def band_keys(minima: np.ndarray) -> np.ndarray:
    """A 64-bit key of every band, different for equal minima in different bands."""
    keys = np.arange(1, BANDS + 1, dtype=_U)
    for row in minima.reshape(BANDS, ROWS).T:
        keys = hashing.mix(keys * hashing.STEP + row)
    return keys


SIGNED = pa.schema([("doc_id", pa.int64()), ("text_key", pa.int64()), ("n_shingles", pa.int64()), ("set_key", pa.int64()), ("bands", pa.list_(pa.int64())), ("minima", pa.binary())])


def _signed(size: int):
    """Sets of (id, text key, text) rows; of sets that a task meets again, the signature isn't computed again."""

    def run(batches: Iterator[pa.RecordBatch]):
        known: dict[int, tuple] = {}
        for batch in batches:
            rows = []
            for *own, grams in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), jaccard.shingle_sets(batch.column(2).to_pylist(), size)):
                key = jaccard.class_key(grams)
                if not len(grams):
                    rows.append((*own, 0, key, None, None))
                    continue
                if key not in known:
                    if len(known) > 5_000:
                        known.clear()
                    minima = signature(grams)
                    known[key] = band_keys(minima).view(np.int64).tolist(), (minima & _U(0xFFFF)).astype("<u2").tobytes()
                rows.append((*own, len(grams), key, *known[key]))
            yield from jaccard._rows(SIGNED, rows).to_batches()

    return run


def _agreeing(pairs: DataFrame, signatures: DataFrame) -> DataFrame:
    """The pairs (u, v) whose signatures agree often enough."""
    both = pairs.join(signatures.toDF("u", "left"), "u").join(signatures.toDF("v", "right"), "v")

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            left, right = (np.frombuffer(b"".join(batch.column(i).to_pylist()), "<u2").reshape(-1, HASHES) for i in (2, 3))
            near = (left == right).sum(axis=1) >= AGREE
            yield pa.RecordBatch.from_arrays([batch.column(i).filter(pa.array(near)) for i in (0, 1)], ["u", "v"])

    return both.select("u", "v", "left", "right").mapInArrow(run, "u long, v long")


LINKS = pa.schema([("u", pa.int64()), ("v", pa.int64())])


def joined_cells(left: np.ndarray, right: np.ndarray, cells: tuple[np.ndarray, np.ndarray]) -> list[tuple[int, int]]:
    """Links (u, v) of cells that signatures of the left and the right block bring together, each pair of cells once."""
    found: set[tuple[int, int]] = set()
    for own, cell in zip(left, cells[0].tolist()):
        near = (right == own).sum(axis=1) >= AGREE
        found.update((max(cell, c), min(cell, c)) for c in np.unique(cells[1][near]).tolist() if c != cell)
    return list(found)


def _met(group: pa.Table) -> pa.Table:
    """Small buckets, or two blocks of a large one, or one with itself: which cells they join."""
    group = group.sort_by("band")
    band, block, cells = (group[c].to_numpy() for c in ("band", "block", "cell"))
    minima = np.frombuffer(b"".join(group["minima"].to_pylist()), "<u2").reshape(-1, HASHES)
    found: set[tuple[int, int]] = set()
    _, _, cuts = hashing.by_value(band)
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        low, high = a + np.flatnonzero(block[a:b] == block[a:b].min()), a + np.flatnonzero(block[a:b] == block[a:b].max())
        found.update(joined_cells(minima[low], minima[high], (cells[low], cells[high])))
    return jaccard._rows(LINKS, list(found))


def candidate_cells(signed: DataFrame, scratch: Scratch) -> DataFrame:
    """(set_key, cell) of all sets that have a candidate; near sets lie in one cell."""
    sets = signed.where("n_shingles > 0").dropDuplicates(["set_key"])
    bands = sets.select("set_key", F.explode("bands").alias("band"))
    least = bands.groupBy("band").agg(F.min("set_key").alias("least"), F.max("set_key").alias("most")).where("least < most").select("band", "least")
    members = scratch.settle(bands.join(least, "band"), "members")
    signatures = signed.where("n_shingles > 0").select("set_key", "minima").join(members.select("set_key").distinct(), "set_key", "left_semi").dropDuplicates(["set_key"])
    signatures = scratch.settle(signatures, "signatures")
    pairs = members.where("set_key <> least").select(F.col("set_key").alias("u"), F.col("least").alias("v")).distinct()
    first = scratch.settle(_agreeing(pairs, signatures), "first")
    cells = star_components(first, scratch, "first-cells")
    celled = members.join(cells.toDF("set_key", "cell"), "set_key", "left").select("band", "set_key", F.coalesce("cell", "set_key").alias("cell"))
    celled = scratch.settle(celled, "celled")
    scratch.drop("members")
    mixed = celled.groupBy("band").agg(F.count("*").alias("n"), F.min("cell").alias("a"), F.max("cell").alias("b")).where("a < b")
    mixed = scratch.settle(mixed.select("band", "n", F.expr(f"CAST(ceil(n / {BLOCK}) AS INT)").alias("blocks")), "mixed")
    # small buckets share units; of a large one every two blocks are a unit
    units = max(1, -(-mixed.agg(F.sum("n")).first()[0] // UNIT)) if not mixed.isEmpty() else 1
    unit = F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("band"), F.lit(units))).otherwise(F.xxhash64("band", F.least("block", "other"), F.greatest("block", "other")))
    dealt = (
        celled.join(mixed.drop("n"), "band").withColumn("block", F.pmod(F.xxhash64("set_key"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(unit.alias("unit"), "band", "block", "cell", "set_key").join(signatures, "set_key").drop("set_key")
    )
    second = dealt.groupBy("unit").applyInArrow(_met, "u long, v long")
    second = scratch.settle(second.distinct(), "second")
    merged = star_components(second, scratch, "second-cells")
    cells = cells.toDF("set_key", "first").join(merged.toDF("first", "cell"), "first", "left").select("set_key", F.coalesce("cell", "first").alias("cell"))
    # single sets that the second step joined aren't nodes of the first
    singles = merged.toDF("set_key", "cell").join(cells.select("set_key"), "set_key", "left_anti")
    out = scratch.settle(cells.unionByName(singles), "candidates")
    scratch.drop("celled", "mixed", "signatures", "first", "second", "first-cells", "second-cells")
    return out


SETS = pa.schema([("cell", pa.int64()), ("set_key", pa.int64()), ("n", pa.int64()), ("tokens", pa.binary())])


def _full_sets(size: int):
    """(cell, set_key, text) to the sorted shingles."""

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            sets = jaccard.shingle_sets(batch.column(2).to_pylist(), size)
            yield from jaccard._rows(SETS, [(c, k, len(s), s.tobytes()) for c, k, s in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), sets)]).to_batches()

    return run


def _partial(group: pa.Table) -> pa.Table:
    """One strip of one unit: partial overlaps of all its pairs; shingles that one set alone has are left out first."""
    tokens = [np.frombuffer(x.as_buffer(), "<u8") for x in group["tokens"]]
    lengths = np.array([len(t) for t in tokens])
    joined = np.concatenate([*tokens, np.zeros(0, _U)])
    order, _, cuts = hashing.by_value(joined)
    several = np.empty(len(joined), bool)
    several[order] = np.repeat(np.diff(cuts) > 1, np.diff(cuts))
    ends = np.cumsum(lengths)
    kept = [joined[a:b][several[a:b]].tobytes() for a, b in zip((ends - lengths).tolist(), ends.tolist())]
    return jaccard._partial(group.set_column(group.schema.get_field_index("tokens"), "tokens", pa.array(kept, pa.binary())))


def confirmed(docs: DataFrame, signed: DataFrame, cells: DataFrame, scratch: Scratch, size: int, percent: int) -> DataFrame:
    """(u, v, links): links between sets of a cell that reach the threshold on their full shingles; see ``jaccard._summed``."""
    first = signed.groupBy("set_key").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")).alias("one"))
    first = cells.join(first, "set_key").select("cell", "set_key", F.col("one.doc_id").alias("own"), F.col("one.text_key").alias("text_key"))
    # one document of each set; of rows without an id, or of repeated ones, all come, and one stays
    texts = docs.join(first, (docs["text_key"] == first["text_key"]) & docs["doc_id"].eqNullSafe(first["own"])).select("cell", "set_key", "text")
    placed = scratch.settle(texts.mapInArrow(_full_sets(size), "cell long, set_key long, n long, tokens binary").dropDuplicates(["set_key"]), "placed")
    sizes = placed.groupBy("cell").agg(F.sum("n").alias("grams"), F.count("*").alias("sets"))
    blocks = F.greatest(F.ceil(F.col("grams") / BLOCK_TOKENS), F.ceil(F.col("sets") / BLOCK_SETS)).cast("int")
    sizes = scratch.settle(sizes.select("cell", "grams", blocks.alias("blocks")), "sizes")
    units = max(1, -(-int(sizes.agg(F.coalesce(F.sum("grams"), F.lit(0))).first()[0]) // BLOCK_TOKENS))
    unit = F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("cell"), F.lit(units))).otherwise(F.xxhash64("cell", F.least("block", "other"), F.greatest("block", "other")))
    dealt = (
        placed.join(sizes.drop("grams"), "cell").withColumn("block", F.pmod(F.xxhash64("set_key"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(unit.alias("unit"), "block", "cell", "set_key", "n", "tokens")
    )
    strips = dealt.mapInArrow(jaccard._strips(1 << 32), jaccard.STRIP_DDL)
    partial = strips.groupBy("unit", "strip").applyInArrow(_partial, "unit long, sets binary, counts binary")
    found = scratch.settle(partial.groupBy("unit").applyInArrow(jaccard._summed(percent), "u long, v long, links long"), "found")
    scratch.drop("placed", "sizes")
    return found


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row; the bands are made for similarities of 0.85 or more, so ``percent`` is 85 at least."""
    if percent < PERCENT:
        raise ValueError(f"the bands find similarities from {PERCENT} percent on")
    scratch = Scratch(docs.sparkSession, "near")
    docs = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.xxhash64(F.col(f"`{text}`")).alias("text_key"), F.col(f"`{text}`").alias("text"))
    signed = docs.mapInArrow(_signed(size), "doc_id long, text_key long, n_shingles long, set_key long, bands array<long>, minima binary")
    signed = scratch.settle(signed, "signed")
    found = confirmed(docs, signed, candidate_cells(signed, scratch), scratch, size, percent)
    parts = star_components(found.select("u", "v"), scratch, "parts")
    scratch.drop("found", "candidates")
    keyed = signed.select("doc_id", "n_shingles", "set_key")
    classes = keyed.where("n_shingles > 0").groupBy("set_key").agg(F.min("doc_id").alias("first"))
    classes = scratch.settle(classes.join(parts.toDF("set_key", "part"), "set_key", "left").select("set_key", "first", F.coalesce("part", "set_key").alias("part")), "classes")
    named = classes.join(classes.groupBy("part").agg(F.min("first").alias("component_id")), "part").select("set_key", "component_id")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    out = keyed.join(named, "set_key", "left").select("doc_id", "n_shingles", component.alias("component_id"))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def op13_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose 5-word shingle sets have a Jaccard similarity of 0.85 or more, and which one of each stays."""
    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


OP13_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(ws[i : i + least(len(ws), 5) - 1], ' ') AS g FROM w, unnest(generate_series(1, greatest(len(ws) - 4, 1))) AS t(i) WHERE len(ws) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
e AS (SELECT x, y FROM p JOIN n u ON u.doc_id = x JOIN n v ON v.doc_id = y WHERE 100 * c >= 85 * (u.n + v.n - c)),
l AS (SELECT x, y FROM e UNION ALL SELECT y, x FROM e),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT a, y FROM reach JOIN l ON b = x)
SELECT w.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, low AS component_id, w.doc_id = low AS kept FROM w LEFT JOIN n USING (doc_id) JOIN (SELECT a AS doc_id, min(b) AS low FROM reach GROUP BY 1) USING (doc_id)
"""
