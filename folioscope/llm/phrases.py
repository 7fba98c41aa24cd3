"""Phrases that keep together: n-grams mined by pivot words, scored by their weakest cut.

Everything is counted per language (null: ``und``), over words in pieces between punctuation marks and line ends.

1. Words. A task holds some texts of a language at a time (a batch), as numbers of the batch's own word list. Lists
   with counts are exploded and summed to word frequencies; words of fewer than ``LEAST`` occurrences are in no
   candidate. Frequent words get a number; their numbers and frequencies return to the batches by a join
   in which a word comes once per batch, however often it occurs.
2. Pivots. The rarest word of an n-gram (the first of equal ones) is its pivot. Around every occurrence of a
   word the batch cuts the fragment of more frequent words that reaches ``LONGEST - 1`` words to either side and ends at
   infrequent words and pieces' ends; every n-gram occurrence lies in its pivot's fragment alone. Equal fragments of a batch
   become one with a weight and are routed to the pivot's part. Pivots that occur very often are dealt over several parts
   by fragment.
3. Mining. A part counts the n-grams of its fragments that contain the pivot, and no others. Counts of a pivot that one
   part holds are final there; those of dealt pivots are summed after it.
4. Scores. Every cut of a candidate looks up both sides; the lowest score counts. Products are decimals. A candidate inside a
   longer one of nearly its frequency is dropped: longer ones announce their parts with the greatest count.

Defined results: null, empty and wordless texts count nothing; repeated rows count as often as they occur; a
phrase counts overlapping occurrences; equal scores and counts are ordered by the phrase's bytes; an empty table gives
no rows; ids and other columns play no part. A very long text is cut into batches between pieces; a piece itself is held
whole. Fragments are grouped by 64-bit hashes and compared in full, so counts are exact.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folioscope.llm import hashing
from folioscope.llm.common import Scratch, table, utf8_size

LEAST, LONGEST, TOP = 30, 4, 2000
#: A longer candidate with this share of a candidate's count replaces it.
PERCENT = 80
SCALE = 2_000_000
#: Bytes of one language's batch, and of all languages that a task holds.
BATCH_TEXT, HELD_TEXT = 2_000_000, 6_000_000
#: Text bytes whose fragments make one part, about ten times as much.
PART_TEXT = 2_000_000
LEAST_PARTS = 16
#: Occurrences of a pivot that one part takes.
SHARE = 1 << 19

UND = "und"
#: Small letters for ASCII capitals, a line break for every mark that ends a piece, a space for a tab.
MARKS = b".,;:!?\n\x0b\x0c\r"
PLAIN = bytes(10 if b in MARKS else 32 if b == 9 else b + 32 if 65 <= b <= 90 else b for b in range(256))

_U = np.uint64
WORDS = pa.schema([("batch", pa.int64()), ("lang", pa.string()), ("seq", pa.binary()), ("words", pa.list_(pa.string())), ("counts", pa.list_(pa.int64()))])
WORDS_DDL = "batch long, lang string, seq binary, words array<string>, counts array<bigint>"


def pieces(raw: bytes) -> bytes:
    """A text whose words stand between spaces and whose pieces between line breaks."""
    return raw.translate(PLAIN)


def encode(raw: bytes) -> tuple[np.ndarray, list[bytes], np.ndarray]:
    """Numbers of the words in their order (-1 between pieces), the distinct words and their counts."""
    numbers: defaultdict[bytes, int] = defaultdict(count(1).__next__)
    numbers[b"\n"] = 0
    seq = np.array([numbers[w] for w in raw.replace(b"\n", b" \n ").split(b" ") if w], np.int32) - 1
    words = list(numbers)[1:]
    return seq, words, np.bincount(seq[seq >= 0], minlength=len(words))


def _encoded(most: int, held_most: int):
    """Batches of (lang, text) rows."""

    def run(batches: Iterator[pa.RecordBatch]):
        number = TaskContext.get().partitionId() << 32
        held: dict[str, list[bytes]] = {}
        size: dict[str, int] = {}

        def row(lang: str) -> pa.RecordBatch:
            nonlocal number
            number += 1
            seq, words, counts = encode(b"\n".join(held.pop(lang)))
            size.pop(lang)
            lists = pa.array([[w.decode("utf-8", "surrogatepass") for w in words]], pa.list_(pa.string())), pa.array([counts.tolist()], pa.list_(pa.int64()))
            return pa.RecordBatch.from_arrays([pa.array([number]), pa.array([lang]), pa.array([seq.tobytes()], pa.binary()), *lists], schema=WORDS)

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                raw, at = pieces((text or "").encode("utf-8", "surrogatepass")), 0
                while at < len(raw):
                    end = raw.find(b"\n", at + most)  # a long text is cut between two pieces
                    end = len(raw) if end < 0 else end
                    held.setdefault(lang, []).append(raw[at:end])
                    size[lang] = size.get(lang, 0) + end - at
                    at = end
                    if size[lang] > most:
                        yield row(lang)
                if sum(size.values()) > held_most:
                    yield from [row(x) for x in list(held)]
        yield from [row(x) for x in list(held)]

    return run


def distinct_rows(rows: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every different row once, with the sum of its weights."""
    if not len(rows):
        return rows, weights
    keys = np.zeros(len(rows), _U)
    for column in rows.T:
        keys = hashing.mix(keys * hashing.STEP + column.astype(_U))
    order, _, cuts = hashing.by_value(keys)
    own = np.repeat(order[cuts[:-1]], np.diff(cuts))
    if (rows[order] != rows[own]).any():  # different rows of one hash
        found, at = np.unique(rows, axis=0, return_inverse=True)
        sums = np.zeros(len(found), weights.dtype)
        np.add.at(sums, at.ravel(), weights)
        return found, sums
    return rows[order[cuts[:-1]]], np.add.reduceat(weights[order], cuts[:-1])


def fragments(ranks: np.ndarray, reach: int) -> np.ndarray:
    """One row for every place with a rank: itself in the middle and, to either side, the neighbours up to the first that lies before it in the order.

    Ranks are 1 for the rarest word and upwards, 0 for what no n-gram contains. An equal word on the left takes precedence. Zeros
    fill a row; places without any neighbour give none.
    """
    padded = np.concatenate([np.zeros(reach, ranks.dtype), ranks, np.zeros(reach, ranks.dtype)])
    n = len(ranks)
    out = np.zeros((n, 2 * reach + 1), ranks.dtype)
    out[:, reach] = ranks
    left = right = ranks > 0
    for d in range(1, reach + 1):
        before, after = padded[reach - d : reach - d + n], padded[reach + d : reach + d + n]
        left, right = left & (before > ranks), right & (after >= ranks)
        out[:, reach - d], out[:, reach + d] = np.where(left, before, 0), np.where(right, after, 0)
    return out[(out[:, reach - 1] > 0) | (out[:, reach + 1] > 0)]


def squeezed(values: np.ndarray) -> bytes:
    """Numbers as compressed bytes, a row of the array after the other."""
    return zstandard.compress(np.ascontiguousarray(values, np.int64).tobytes(), 1)


def loosened(cells: pa.ChunkedArray, rows: int) -> np.ndarray:
    """The numbers of all cells side by side, in so many rows."""
    return np.concatenate([np.frombuffer(zstandard.decompress(x.as_buffer()), np.int64).reshape(rows, -1) for x in cells], axis=1)


ROUTED = pa.schema([("part", pa.int32()), ("dealt", pa.bool_()), ("weights", pa.binary()), ("rows", pa.binary())])
ROUTED_DDL = "part int, dealt boolean, weights binary, rows binary"


def _routed(parts: int, longest: int, share: int):
    """One batch and its frequent words (at, gid, f): fragments by the pivot's part."""

    def run(texts: pa.Table, known: pa.Table) -> pa.Table:
        if not known.num_rows or not texts.num_rows:
            return ROUTED.empty_table()
        seq = np.frombuffer(texts["seq"][0].as_buffer(), np.int32)
        at, gid, f = (known[c].to_numpy() for c in ("at", "gid", "f"))
        order = np.lexsort((gid, f))  # from the rarest on
        at, gid, f = at[order], np.concatenate([[0], gid[order]]), np.concatenate([[0], f[order]])
        rank_of = np.zeros(max(int(seq.max()), int(at.max())) + 2, np.int32)  # the last one is for -1
        rank_of[at] = np.arange(1, len(at) + 1)
        rows = fragments(rank_of[seq], longest - 1)
        rows, weights = distinct_rows(rows, np.ones(len(rows), np.int64))
        if not len(rows):
            return ROUTED.empty_table()
        pivot = rows[:, longest - 1]
        grams = gid[rows]
        shares = -(-f[pivot] // share)
        key = grams[:, longest - 1].astype(_U)
        mixed = key.copy()
        for column in grams.T:
            mixed = hashing.mix(mixed * hashing.STEP + column.astype(_U))
        part = (hashing.mix(key * hashing.STEP + mixed % shares.astype(_U)) % _U(parts)).astype(np.int64)
        groups = 2 * part + (shares > 1)
        order = np.lexsort((key, groups))
        grams, weights = grams[order], weights[order]
        _, groups, cuts = hashing.by_value(groups[order])
        spans = list(zip(cuts[:-1].tolist(), cuts[1:].tolist()))
        return pa.table(
            [
                pa.array((groups // 2).astype(np.int32)), pa.array(groups % 2 == 1),
                pa.array([squeezed(weights[a:b]) for a, b in spans], pa.binary()), pa.array([squeezed(grams[a:b].T) for a, b in spans], pa.binary()),
            ], schema=ROUTED,
        )

    return run


GRAMS = pa.schema([("gram", pa.list_(pa.int64())), ("a", pa.int64())])


def mine(rows: np.ndarray, weights: np.ndarray, longest: int, least: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """The n-grams of fragments that contain the middle one, with their counts, by length; those of fewer than ``least`` are left out."""
    out = []
    for size in range(2, longest + 1):
        starts = range(longest - size, longest)
        whole = [(rows[:, s : s + size] != 0).all(axis=1) for s in starts]
        grams = np.concatenate([rows[w][:, s : s + size] for s, w in zip(starts, whole)])
        grams, counts = distinct_rows(grams, np.concatenate([weights[w] for w in whole]))
        out.append((grams[counts >= least], counts[counts >= least]))
    return out


def _mined(longest: int, least: int):
    """One part's n-grams; counts of dealt pivots are not final, so all of them go on."""

    def run(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        rows, weights = loosened(group["rows"], 2 * longest - 1).T, loosened(group["weights"], 1)[0]
        found = mine(rows, weights, longest, 1 if key[1].as_py() else least)
        lists = [pa.ListArray.from_arrays(np.arange(0, g.size + 1, g.shape[1], dtype=np.int32), g.ravel()) for g, _ in found]
        return pa.table([pa.chunked_array(lists), pa.chunked_array([pa.array(c) for _, c in found])], schema=GRAMS)

    return run


def frequent_grams(docs: DataFrame, scratch: Scratch, lang: str, text: str, least: int, longest: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(gram, a) of all n-grams with ``least`` occurrences, (gid, lang, word, f) of all such words, and (lang, n) of all languages."""
    spoken = F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit(UND))
    parts = max(LEAST_PARTS, -(-docs.agg(F.coalesce(F.sum(utf8_size(text)), F.lit(0))).first()[0] // PART_TEXT))
    encoded = scratch.settle(docs.select(spoken.alias("lang"), F.col(f"`{text}`").alias("text")).mapInArrow(_encoded(BATCH_TEXT, HELD_TEXT), WORDS_DDL), "encoded")
    totals = encoded.groupBy("lang").agg(F.sum(F.aggregate("counts", F.lit(0).cast("long"), lambda s, c: s + c)).alias("n"))
    listed = encoded.select("lang", F.explode(F.arrays_zip("words", "counts")).alias("w")).select("lang", F.col("w.words").alias("word"), F.col("w.counts").alias("c"))
    frequent = listed.groupBy("lang", "word").agg(F.sum("c").alias("f")).where(F.col("f") >= least)
    frequent = scratch.settle(frequent.select((F.monotonically_increasing_id() + 1).alias("gid"), "lang", "word", "f"), "frequent")
    own = encoded.select(F.col("batch").alias("home"), "lang", F.posexplode("words").alias("at", "word"))
    known = own.join(frequent, ["lang", "word"]).select("home", F.col("at").cast("long").alias("at"), "gid", "f")
    routed = encoded.select("batch", "seq").groupBy("batch").cogroup(known.groupBy("home")).applyInArrow(_routed(parts, longest, SHARE), ROUTED_DDL)
    mined = routed.groupBy("part", "dealt").applyInArrow(_mined(longest, least), "gram array<bigint>, a long")
    grams = mined.groupBy("gram").agg(F.sum("a").alias("a")).where(F.col("a") >= least)
    return scratch.settle(grams, "grams"), frequent, totals


def scored(grams: DataFrame, frequent: DataFrame, longest: int = LONGEST) -> DataFrame:
    """(gram, a, l, r, score) by the cut with the lowest score."""
    counts = grams.union(frequent.select(F.array("gid").alias("gram"), F.col("f").alias("a")))
    cuts = grams.select("gram", "a", F.explode(F.sequence(F.lit(1), F.size("gram") - 1)).alias("k"))
    cuts = cuts.withColumn("first", F.slice("gram", F.lit(1), F.col("k"))).withColumn("rest", F.slice("gram", F.col("k") + 1, F.lit(longest)))
    cuts = cuts.join(counts.toDF("first", "l"), "first").join(counts.toDF("rest", "r"), "rest")
    score = F.expr(f"(CAST({SCALE} AS DECIMAL(8,0)) * CAST(a AS DECIMAL(20,0))) div (CAST(l AS DECIMAL(20,0)) + CAST(r AS DECIMAL(20,0)))")
    best = cuts.withColumn("score", score).groupBy("gram").agg(F.min(F.struct("score", "k", "a", "l", "r")).alias("best"))
    return best.select("gram", "best.a", "best.l", "best.r", "best.score")


def outdone(grams: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(gram, longer): of every n-gram inside longer ones the greatest count of those."""
    inner = F.expr("""flatten(transform(sequence(2, size(gram) - 1), m -> transform(sequence(1, size(gram) - m + 1), s -> slice(gram, s, m))))""")
    return grams.where(F.size("gram") > 2).select(F.explode(inner).alias("gram"), "a").groupBy("gram").agg(F.max("a").alias("longer"))


def collocations(docs: DataFrame, lang: str = "lang", text: str = "text", least: int = LEAST, longest: int = LONGEST, top: int = TOP, percent: int = PERCENT) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's first ``top`` phrases."""
    scratch = Scratch(docs.sparkSession, "phrases")
    grams, frequent, totals = frequent_grams(docs, scratch, lang, text, least, longest)
    big = "DECIMAL(24,0)"
    left = scored(grams, frequent, longest).join(outdone(grams), "gram", "left")
    left = left.where(F.expr(f"longer IS NULL OR CAST(longer AS {big}) * 100 < CAST(a AS {big}) * {percent}"))
    words = left.select("gram", "a", "l", "r", "score", F.posexplode("gram").alias("at", "gid")).join(frequent.select("gid", "lang", "word"), "gid")
    told = words.groupBy("gram").agg(
        F.first("lang").alias("lang"), F.first("a").alias("a"), F.first("l").alias("l"), F.first("r").alias("r"), F.first("score").alias("score"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "word"))), lambda w: w.word), " ").alias("phrase"),
    )
    best = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    ranked = told.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each language's 2000 phrases of two to four words with the highest scores."""
    return collocations(table(spark, sf_dir, "documents").select("lang", "text"))


OP12_SQL = r"""
WITH t AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS x FROM documents),
q AS MATERIALIZED (SELECT lang, unnest(regexp_split_to_array(x, '[.,;:!?\x0A-\x0D]')) AS piece FROM t),
p AS MATERIALIZED (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM q),
o AS (SELECT lang, m, unnest(list_transform(generate_series(1, len(ws) - m + 1), lambda i: array_to_string(ws[i : i + m - 1], ' '))) AS g FROM p, (VALUES (1), (2), (3), (4)) AS s(m) WHERE len(ws) >= m),
g AS MATERIALIZED (SELECT lang, m, g, count(*) AS f FROM o GROUP BY ALL HAVING count(*) >= 30),
n AS (SELECT lang, CAST(sum(len(ws)) AS BIGINT) AS n FROM p GROUP BY 1),
c AS MATERIALIZED (SELECT lang, m, g, f AS a, string_split(g, ' ') AS ws FROM g WHERE m > 1),
u AS MATERIALIZED (SELECT lang, m, g, a, k, array_to_string(ws[1 : k], ' ') AS head, array_to_string(ws[k + 1 : m], ' ') AS rest FROM c, (VALUES (1), (2), (3)) AS s(k) WHERE k < m),
k AS (SELECT u.lang, u.g, u.a, k, x.f AS l, y.f AS r, CAST((2000000 * CAST(u.a AS HUGEINT)) // (x.f + y.f) AS BIGINT) AS score
  FROM u JOIN g x ON x.lang = u.lang AND x.g = u.head JOIN g y ON y.lang = u.lang AND y.g = u.rest),
b AS MATERIALIZED (SELECT * FROM k QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1),
v AS MATERIALIZED (SELECT lang, array_to_string(ws[i : i + j - 1], ' ') AS g, a FROM c, (VALUES (2), (3)) AS s(j), (VALUES (1), (2), (3)) AS r(i) WHERE j < m AND i + j - 1 <= m),
w AS MATERIALIZED (SELECT lang, g, max(a) AS longer FROM v GROUP BY 1, 2),
z AS (SELECT b.*, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, b.a DESC, encode(b.g)) AS rank FROM b LEFT JOIN w ON w.lang = b.lang AND w.g = b.g WHERE longer IS NULL OR 100 * CAST(longer AS HUGEINT) < 80 * CAST(b.a AS HUGEINT))
SELECT z.lang, rank, z.g AS phrase, a, l, r, n, score FROM z JOIN n USING (lang) WHERE rank <= 2000
"""
